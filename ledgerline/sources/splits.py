"""Split planner: reads of equal depth from the quantiles of a column, whatever its skew.

The quantiles of the column (it alone is read) cut its values into ranges of about equal row counts. A value that
fills several quantiles is a split of its own, and nulls are one. The ranges are counted once, and neighbours that
came out small, next to such a value, are joined. The result is a list of predicates, disjoint and covering
all rows, for ``spark.read.jdbc(predicates=...)`` or any other reader.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    """A predicate in SQL and how many rows it had when it was planned."""

    predicate: str
    rows: int


def _literal(value: Any) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, float):
        return repr(value)
    raise TypeError(f"no splits by values such as {value!r}")


def _pieces(column: str, bounds: Sequence[Any]) -> list[str]:
    """Ranges between rising bounds; a bound that occurs more than once is a piece of its own."""
    pieces, low = [], None
    values = sorted(set(bounds))
    for value in values:
        text = _literal(value)
        below = f"{column} < {text}" if low is None else f"{low} AND {column} < {text}"
        pieces.append(below)
        if bounds.count(value) > 1:
            pieces.append(f"{column} = {text}")
            low = f"{column} > {text}"
        else:
            low = f"{column} >= {text}"
    return [*pieces, low if low is not None else f"{column} IS NOT NULL"]


def plan_splits(df: DataFrame, column: str, splits: int, quote: str = "") -> list[Split]:
    """About ``splits`` predicates over ``column`` (numbers, dates or timestamps) of equal row counts.

    ``quote`` is put around the column's name in the predicates. A value that fills more than a split's share
    cannot be cut by this column and is one split. Two small aggregates reach the driver, no rows.
    """
    name = f"{quote}{column}{quote}"
    values = df.select(F.col(f"`{column}`").alias("value"))
    shares = [i / splits for i in range(1, splits)]
    found = values.agg(F.percentile_approx("value", shares or [0.5], max(10_000, 100 * splits)).alias("q")).first()["q"]
    bounds = list(found) if found and shares else []
    pieces = [*_pieces(name, bounds), f"{name} IS NULL"]
    tests = [F.count_if(F.expr(piece.replace(name, "value"))) for piece in pieces]
    counts = values.agg(*[test.alias(f"n{i}") for i, test in enumerate(tests)]).first()
    sized = [Split(piece, counts[f"n{i}"]) for i, piece in enumerate(pieces)]
    target = sum(split.rows for split in sized[:-1]) / splits
    return [*_joined(sized[:-1], target), sized[-1]] if len(sized) > 1 else sized


def _joined(pieces: list[Split], target: float) -> list[Split]:
    """Pieces of less than the target's share joined in their order, as long as together they stay near it."""
    result: list[Split] = []
    for piece in sorted(pieces, key=lambda p: -p.rows):
        if piece.rows >= target * 0.7 or not result:
            result.append(piece)
            continue
        least = min(range(len(result)), key=lambda i: result[i].rows)
        if result[least].rows + piece.rows <= target * 1.4:
            result[least] = Split(f"({result[least].predicate}) OR ({piece.predicate})", result[least].rows + piece.rows)
        else:
            result.append(piece)
    return result
