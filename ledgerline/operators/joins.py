"""Join helpers.

No join is forced to broadcast here: Catalyst broadcasts a side below
``spark.sql.autoBroadcastJoinThreshold`` (by statistics, and again by measured size
under AQE) and sorts and merges beyond it. Hot keys of a sort-merge join are split by
AQE; rows whose key is *null* are spread beforehand, as they match nothing and would
otherwise all meet in one partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def role(df: DataFrame, key: str, as_key: str, **columns: str) -> DataFrame:
    """A dimension in one role: its key and the wanted columns under role names.

    ``role(party, "party_id", "customer_id", customer="name")``
    """
    return df.select(F.col(key).alias(as_key), *[F.col(source).alias(name) for name, source in columns.items()])


def _spread_keys(left: DataFrame, right: DataFrame, pairs: Mapping[str, str], spread_by: Sequence[str]) -> Column:
    """The keys' equality, with the rows that have a null in a left key dealt by ``spread_by``.

    Where a left key is null, a hash stands in for one of the keys and the pair is refused. The right side's
    keys stay as they are, so that it is not dealt again where it is dealt by them already. Keys that are neither long
    nor text get an extra key instead, whose 0 on the right is computed from the right key, lest it be folded into a constant.
    """
    any_null = F.lit(False)
    for name in pairs:
        any_null = any_null | F.col(name).isNull()
    varied = F.xxhash64(*spread_by)
    kinds = {name: left.schema[name].dataType for name in pairs}
    able = [
        name for name, other in pairs.items()
        if isinstance(kinds[name], (T.LongType, T.StringType)) and kinds[name] == right.schema[other].dataType
    ]
    stands_in = able[0] if able else None
    condition = ~any_null if able else F.lit(True)
    for name, other in pairs.items():
        value = F.col(name)
        if name == stands_in:
            value = F.when(any_null, varied.cast(kinds[name])).otherwise(value)
        condition = condition & (value == F.col(f"_key_{other}"))
    if able:
        return condition
    extra = F.when(any_null, varied.bitwiseOR(F.lit(1).cast("bigint"))).otherwise(F.lit(0)).cast("bigint")
    first = F.col(f"_key_{next(iter(pairs.values()))}")
    return condition & (extra == F.xxhash64(first).bitwiseAND(F.lit(0).cast("bigint")))


def lookup(
    left: DataFrame,
    right: DataFrame,
    keys: str | Sequence[str] | Mapping[str, str],
    how: str = "left",
    spread_by: Sequence[str] = (),
) -> DataFrame:
    """Join ``right`` to ``left`` on equal keys and drop the right side's keys.

    Apart from its keys the right side must not repeat column names of the left.

    ``keys``: names shared by both sides, or {left name: right name}. ``spread_by`` names
    left columns that vary from row to row; it is given when a left key is often null
    and the right side is large; where the left's schema excludes nulls there is nothing to spread.
    """
    if isinstance(keys, str):
        keys = [keys]
    pairs = keys if isinstance(keys, Mapping) else {key: key for key in keys}
    renamed = right.withColumnsRenamed({name: f"_key_{name}" for name in pairs.values()})
    if spread_by and how in ("left", "left_anti") and any(left.schema[name].nullable for name in pairs):
        condition = _spread_keys(left, right, pairs, spread_by)
    else:
        condition = F.lit(True)
        for left_name, right_name in pairs.items():
            condition = condition & (F.col(left_name) == F.col(f"_key_{right_name}"))
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_key_{name}" for name in pairs.values()])


def matches_per_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """How many rows each key has.

    A join whose columns are not used still repeats the rows it matches. Multiplying by
    this count says the same without producing the repeated rows.
    """
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def times(*counts: Column) -> Column:
    """Product of match counts; no match on an outer side counts as one row."""
    product = F.lit(1).cast("bigint")
    for count in counts:
        product = product * F.coalesce(count, F.lit(1).cast("bigint"))
    return product


def with_group_total(rows: DataFrame, keys: Sequence[str], measure: str, name: str) -> DataFrame:
    """Add to each row the measure's sum over all rows with the same keys.

    The sums are made first and joined back, so that no group is held in one place, as a
    window over the keys would do.
    """
    sums = rows.groupBy(*keys).agg(F.sum(measure).alias(name))
    return lookup(rows, sums, list(keys), "inner")
