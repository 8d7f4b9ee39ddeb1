"""Code to label expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_label(code: Column, labels: Mapping[int, str], default: str | None = None) -> Column:
    """Label of a code; a null or unlisted code gets the default (null when absent)."""
    chain = F.lit(default).cast("string")
    for value, label in labels.items():
        chain = F.when(code == value, F.lit(label)).otherwise(chain)
    return chain


def code_or_name(code: Column, name: Column, none_label: str, other_label: str) -> Column:
    """0: a fixed label; 1: the looked-up name, null when unknown; else another label."""
    return F.when(code == 0, F.lit(none_label)).when(code == 1, name).otherwise(F.lit(other_label))


def stock_status(quantity: Column, critical_at: float, critical: str, ok: str) -> Column:
    return F.when(quantity <= critical_at, F.lit(critical)).otherwise(F.lit(ok))


def stock_level(quantity: Column, critical_at: float, low_at: float) -> Column:
    return (
        F.when(quantity <= critical_at, F.lit("critical"))
        .when(quantity <= low_at, F.lit("low"))
        .otherwise(F.lit("normal"))
    )
