"""Row digests: a target remembers each row's compared columns as one digest, so a comparison reads keys and digests only.

A digest is the SHA-256 of the columns' canonical texts, each with its length, in the given types. Columns that compare
equal have equal texts: null and empty text are one, numbers have one form whatever their trailing zeros or the zero's
sign. A row without a digest (of an older table) counts as changed, and gets one when it is written again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.delta import dates_only
from ledgerline.operators.joins import lookup
from ledgerline.operators.loads import last_per_key

DIGEST = "row_digest"


def canonical(value: Column, kind: str) -> Column:
    """Text that is equal for equal values of a type, and null for null; null and empty text are one."""
    typed = value.cast(kind)
    if kind == "string":
        return F.nullif(typed, F.lit(""))
    if kind.startswith("decimal"):
        # One form for 1, 1.0 and 1.00: no zeros at the end of the decimals, and no point without decimals.
        text = typed.cast("string")
        short = F.regexp_replace(F.regexp_replace(text, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
        plain = F.when(text.contains("."), short).otherwise(text)
        return F.when(typed == 0, F.lit("0")).otherwise(plain)
    if kind in ("double", "float"):
        return F.when(typed == 0, F.lit("0")).otherwise(typed.cast("string"))
    if kind == "timestamp":
        return F.unix_micros(typed).cast("string")
    return typed.cast("string")


def row_digest(kinds: Mapping[str, str]) -> Column:
    """Digest of the named columns in their types, in the order of their names."""
    parts = []
    for name in sorted(kinds):
        text = canonical(F.col(f"`{name}`"), kinds[name])
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts, F.lit("")), 256))


def compared_kinds(columns: Sequence[tuple[str, str]], keys: Sequence[str], date_column: str, metadata: Sequence[str] = ("created_at", DIGEST)) -> dict[str, str]:
    """Types of a target's columns that a comparison looks at: neither keys, date nor metadata."""
    return {name: kind for name, kind in columns if name not in (*keys, date_column, *metadata)}


def with_digest(rows: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    return rows.withColumn(DIGEST, row_digest(kinds))


def new_or_changed(
    source: DataFrame, target: DataFrame, keys: Sequence[str], date_column: str, kinds: Mapping[str, str]
) -> DataFrame:
    """``delta.new_or_changed`` against a target with digests: source rows, with theirs, that are new or differ.

    Of the target only keys and digest are read. The rows that come back are the source's, so no other column is needed.
    """
    latest = with_digest(last_per_key(dates_only(source, date_column), keys, [date_column]), kinds)
    before = target.select(*keys, F.col(DIGEST).alias("_before"), F.lit(True).alias("_known"))
    merged = lookup(latest, before, list(keys), "left")
    differs = F.col("_known").isNull() | ~F.col(DIGEST).eqNullSafe(F.col("_before"))
    return merged.where(differs).select(*source.columns, DIGEST)
