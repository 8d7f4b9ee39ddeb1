"""Predicates. All keep SQL's three-valued logic, so null means "not selected"."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def since(day: Column, start: date | Column) -> Column:
    """On or after a day. On a bare column the test reaches the file scan."""
    return day >= (start if isinstance(start, Column) else F.lit(start))


def on_day(moment: Column, day: date) -> Column:
    """Any time on the given day; Catalyst turns the day test into a range for the scan."""
    return F.to_date(moment) == F.lit(day)


def recent_or_modified(issued: Column, modified: Column, recent_start: date, mark: date | Column) -> Column:
    """Issued lately, or modified since the mark; a null modification time decides nothing."""
    return since(issued, recent_start) | since(modified, mark)


def listed(code: Column, values: Sequence) -> Column:
    return code.isin(*dict.fromkeys(values))


def listed_or_null(code: Column, values: Sequence) -> Column:
    return listed(code, values) | code.isNull()


def other_than(code: Column, value) -> Column:
    """Different from the value; null is not "different"."""
    return code != F.lit(value)


def is_true(flag: Column) -> Column:
    return flag.eqNullSafe(F.lit(True))


def name_matches_any(name: Column, patterns: Sequence[str]) -> Column:
    """Case-insensitive LIKE against any pattern."""
    test = F.lit(False)
    for pattern in patterns:
        test = test | name.ilike(pattern)
    return test


def keep_listed(df: DataFrame, column: str, dimension: DataFrame, key: str) -> DataFrame:
    """Rows whose code occurs in a configured dimension, repeated entries counting once."""
    return df.join(dimension.select(F.col(key).alias(column)).distinct(), column, "left_semi")
