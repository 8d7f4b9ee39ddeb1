"""Load semantics as DataFrame to DataFrame functions: each returns the new target.

None of them writes; ``sinks`` does. An empty batch always gives the target back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.functions.texts import strict_cast
from ledgerline.operators.joins import lookup
from ledgerline.operators.tables import conform


def typed_keys(
    batch: DataFrame,
    keys: Sequence[str],
    key_types: Mapping[str, str] | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Keys of a batch's rows, each cast to its target type first.

    A value that does not fit its type raises, as does a null in a ``required`` key.
    """
    key_types = key_types or {}
    columns = []
    for key in keys:
        value = F.col(key)
        if key in key_types or key in required:
            kind = key_types.get(key, batch.schema[key].dataType.simpleString())
            value = strict_cast(value, kind, f"key {key}", key in required)
        columns.append(value.alias(key))
    return batch.select(*columns)


def batch_keys(
    batch: DataFrame,
    keys: Sequence[str],
    key_types: Mapping[str, str] | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """Distinct ``typed_keys``."""
    return typed_keys(batch, keys, key_types, required).distinct()


def rows_outside(target: DataFrame, keys_table: DataFrame, keys: Sequence[str], null_safe_keys: bool = False) -> DataFrame:
    """Target rows whose key is not among the given keys.

    As with SQL's tuple ``IN``, a key holding a null matches nothing, so such rows stay;
    they are spread over the cluster by the other columns. ``null_safe_keys`` makes null
    equal to null instead.
    """
    if null_safe_keys:
        wanted = keys_table.withColumnsRenamed({key: f"_key_{key}" for key in keys})
        condition = F.lit(True)
        for key in keys:
            condition = condition & F.col(key).eqNullSafe(F.col(f"_key_{key}"))
        return target.join(wanted, condition, "left_anti")
    return lookup(target, keys_table.dropna(subset=list(keys)), list(keys), "left_anti", spread_by=target.columns)


def replace_by_key(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    key_types: Mapping[str, str] | None = None,
    required: Sequence[str] = (),
    null_safe_keys: bool = False,
    defaults: Mapping[str, Column] | None = None,
    kind: str | None = None,
) -> DataFrame:
    """Drop the target rows whose key occurs in the batch, then add the whole batch.

    The key need not be unique. If it does not name the document, replacing a key also
    removes older lines of that key which the batch does not bring back. Rows with a null
    in the key are never removed, so loading the same batch twice repeats them. ``kind`` names
    a column to add that says what became of each row: ``kept`` or ``loaded``.
    """
    kept = rows_outside(target, batch_keys(batch, keys, key_types, required), keys, null_safe_keys)
    return _of_kind(kept, kind, KEPT).unionByName(_of_kind(conform(batch, target, defaults), kind, LOADED))


KEPT, LOADED, INSERTED, UPDATED, REMOVED = "kept", "loaded", "inserted", "updated", "removed"


def _of_kind(rows: DataFrame, column: str | None, value: str | Column) -> DataFrame:
    return rows if column is None else rows.withColumn(column, F.lit(value) if isinstance(value, str) else value)


def replace_snapshot(target: DataFrame, snapshot: DataFrame, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """The snapshot in the target's shape; with an empty snapshot the target stays.

    The emptiness test is an uncorrelated EXISTS, evaluated once inside the plan.
    """
    stays = target.where(~snapshot.select(F.lit(1)).exists())
    return stays.unionByName(conform(snapshot, target, defaults))


def last_per_key(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order_by``, ties broken by all other columns.

    Written as a maximum over the row, which is combined before the shuffle, so that a
    key with very many rows costs no more than any other. Rows with a null in the key
    conflict with nothing and are all kept; where the schema excludes nulls, none are looked for,
    so that the result stays dealt by its key and is joined on it without another exchange.
    """
    rest = [name for name in rows.columns if name not in keys and name not in order_by]
    open_keys = [key for key in keys if rows.schema[key].nullable]
    complete = F.lit(True)
    for key in open_keys:
        complete = complete & F.col(key).isNotNull()
    row = F.struct(*order_by, *rest)
    winners = (
        rows.where(complete)
        .groupBy(*keys)
        .agg(F.max(row).alias("_row"))
        .select(*keys, *[F.col(f"_row.{name}").alias(name) for name in (*order_by, *rest)])
        .select(*rows.columns)
    )
    return winners.unionByName(rows.where(~complete)) if open_keys else winners


def upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert the changes; where the key exists, set all columns the changes carry.

    Of several changes to one key the last wins. Target columns the changes do not carry
    (such as a creation time) keep their value on an update and take the default on an insert.
    """
    return apply_latest(target, last_per_key(changes, keys, order_by), keys, defaults)


def apply_latest(
    target: DataFrame,
    latest: DataFrame,
    keys: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
    kind: str | None = None,
) -> DataFrame:
    """``upsert`` of changes that have one row per key already, as ``last_per_key`` and ``new_or_changed`` give.

    ``kind`` names a column to add that says what became of each row: ``kept``, ``inserted`` or ``updated``.
    """
    kept = _of_kind(rows_outside(target, latest.select(*keys), keys), kind, KEPT)
    defaults = defaults or {}
    own = [name for name in target.columns if name not in latest.columns]
    if not own and kind is None:
        return kept.unionByName(conform(latest, target))
    held = target.select(*keys, *own).withColumn("_held", F.lit(True))
    if not own:
        held = held.distinct()
    joined = lookup(latest, held, list(keys), "left").withColumns(
        {
            name: F.when(F.col("_held"), F.col(name)).otherwise(
                defaults.get(name, F.lit(None)).cast(target.schema[name].dataType)
            )
            for name in own
        }
    )
    became = F.when(F.col("_held"), UPDATED).otherwise(INSERTED)
    shaped = conform(joined.drop("_held"), target)
    if kind is not None:
        shaped = joined.select(*[F.col(f"`{name}`").cast(target.schema[name].dataType).alias(name) for name in target.columns], became.alias(kind))
    return kept.unionByName(shaped)


def counts_by_kind(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], key_types: Mapping[str, str] | None = None, required: Sequence[str] = ()
) -> DataFrame:
    """``kind, row_count`` of a ``replace_by_key`` in one pass over target and batch: kept, removed and loaded rows."""
    gone = batch_keys(batch, keys, key_types, required).dropna(subset=list(keys)).withColumn("_gone", F.lit(True))
    old = lookup(target.select(*keys), gone, list(keys), "left", spread_by=list(keys))
    kinds = old.select(F.when(F.col("_gone"), REMOVED).otherwise(KEPT).alias("kind"))
    return kinds.unionByName(batch.select(F.lit(LOADED).alias("kind"))).groupBy("kind").agg(F.count(F.lit(1)).alias("row_count"))


def load_counts(kinds: DataFrame) -> DataFrame:
    """``load, row_count`` of a replacement's ``counts_by_kind``: the target before, the batch, and what was written.

    The few counts are spread over the loads they belong to, so no row is counted twice.
    """
    belongs = {KEPT: ("target", "written"), REMOVED: ("target",), LOADED: ("batch", "written")}
    named = F.create_map(*[F.lit(x) for kind, loads in belongs.items() for x in (kind, ",".join(loads))])
    rows = kinds.select(F.explode(F.split(named[F.col("kind")], ",")).alias("load"), "row_count")
    every = F.explode(F.array(*[F.lit(name) for name in ("target", "batch", "written")])).alias("load")
    none = kinds.agg(F.count(F.lit(1))).select(every, F.lit(0).cast("bigint").alias("row_count"))
    return rows.unionByName(none).groupBy("load").agg(F.sum("row_count").alias("row_count"))


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The same rows, counted while they are written."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("row_count")), observation


def observed_kinds(df: DataFrame, kind: str, name: str) -> tuple[DataFrame, Observation]:
    """The same rows without the column ``kind``, counted by it while they are written.

    The counts are those of the tasks that write, of which only one attempt each is taken.
    """
    observation = Observation(name)
    counts = [F.count_if(F.col(kind) == value).alias(value) for value in (KEPT, LOADED, INSERTED, UPDATED)]
    return df.observe(observation, *counts).drop(kind), observation
