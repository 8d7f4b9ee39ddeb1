from __future__ import annotations

from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.operators import delta, loads, tables

SCHEMA = "code string, sku string, qty int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def contents(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_replace_keeps_null_keys_and_replaces_whole_keys(spark):
    target = frame(spark, [("1", "A", 1), ("1", "A", 2), ("1", "A", 3), (None, "A", 4), ("2", "A", 5)])
    batch = frame(spark, [("1", "A", 10), ("1", "A", 11), (None, "A", 12)])
    assert contents(loads.replace_by_key(target, batch, ["code", "sku"])) == contents(
        frame(spark, [("1", "A", 10), ("1", "A", 11), (None, "A", 4), (None, "A", 12), ("2", "A", 5)])
    )
    safe = loads.replace_by_key(target, batch, ["code", "sku"], null_safe_keys=True)
    assert (None, "A", 4) not in contents(safe)


def test_replace_conforms_the_batch(spark):
    target = frame(spark, [("1", "A", 1, date(2024, 1, 1))], SCHEMA + ", created date")
    batch = frame(spark, [("2", "B", 2, "gone")], SCHEMA + ", more string")
    result = loads.replace_by_key(target, batch, ["code"], defaults={"created": F.lit(date(2024, 2, 2))})
    assert contents(result) == [("1", "A", 1, date(2024, 1, 1)), ("2", "B", 2, date(2024, 2, 2))]


def test_typed_keys_raise_on_bad_or_missing_values(spark):
    target = frame(spark, [(1, "A", 1)], "code int, sku string, qty int")
    good = loads.replace_by_key(target, frame(spark, [("1", "A", 9)]), ["code", "sku"], {"code": "int"}, ["code"])
    assert contents(good) == [(1, "A", 9)]
    for bad in ("x", None):
        with pytest.raises(Exception, match="key code"):
            batch = frame(spark, [(bad, "A", 9)])
            loads.replace_by_key(target, batch, ["code", "sku"], {"code": "int"}, ["code"]).collect()


def test_empty_batches_change_nothing(spark):
    target = frame(spark, [("1", "A", 1), (None, "B", 2)])
    nothing = target.limit(0)
    assert contents(loads.replace_by_key(target, nothing, ["code"])) == contents(target)
    assert contents(loads.replace_snapshot(target, nothing)) == contents(target)
    assert contents(loads.upsert(target, nothing, ["code"], ["qty"])) == contents(target)


def test_snapshot_replaces_everything(spark):
    target = frame(spark, [("1", "A", 1)])
    assert contents(loads.replace_snapshot(target, frame(spark, [("2", "B", 2)]))) == [("2", "B", 2)]


def test_upsert_last_change_wins_and_own_columns_stay(spark):
    target = frame(spark, [("1", "A", 1, "old")], SCHEMA + ", created string")
    changes = frame(spark, [("1", "A", 5), ("1", "A", 7), ("1", "A", None), ("2", "B", 8)])
    result = loads.upsert(target, changes, ["code", "sku"], ["qty"], {"created": F.lit("new")})
    assert contents(result) == [("1", "A", 7, "old"), ("2", "B", 8, "new")]


def test_last_per_key_keeps_rows_with_a_null_key(spark):
    rows = [(None, "A", 1), (None, "A", 1), ("1", "A", 1), ("1", "A", 2)]
    assert contents(loads.last_per_key(frame(spark, rows), ["code", "sku"], ["qty"])) == contents(
        frame(spark, [(None, "A", 1), (None, "A", 1), ("1", "A", 2)])
    )


def test_counts(spark):
    target = frame(spark, [("1", "A", 1)])
    counts = loads.load_counts(loads.counts_by_kind(target, target.limit(0), ["code"])).collect()
    assert {row.load: row.row_count for row in counts} == {"target": 1, "batch": 0, "written": 1}
    target = frame(spark, [("1", "A", 1), ("1", "A", 2), (None, "A", 3), ("2", "B", 4)])
    batch = frame(spark, [("1", "A", 9), (None, "A", 8), ("3", "C", 7)])
    kinds = loads.counts_by_kind(target, batch, ["code", "sku"])
    assert {row.kind: row.row_count for row in kinds.collect()} == {"kept": 2, "removed": 2, "loaded": 3}
    counts = loads.load_counts(kinds).collect()
    assert {row.load: row.row_count for row in counts} == {"target": 4, "batch": 3, "written": 5}
    nothing = loads.load_counts(loads.counts_by_kind(target.limit(0), target.limit(0), ["code"])).collect()
    assert {row.load: row.row_count for row in nothing} == {"target": 0, "batch": 0, "written": 0}
    seen, observation = loads.observed(target, "seen")
    seen.collect()
    assert observation.get["row_count"] == 4


def test_allowlist_and_coercion(spark):
    df = frame(spark, [("12.5", "abc", 1), ("", None, 2), ("NaN", " 7 ", 3), ("1e3", "inf", 4)])
    numbers = tables.coerce_numbers(df, ["code", "sku", "absent"]).orderBy("qty")
    assert [(float(row.code), float(row.sku)) for row in numbers.collect()] == [(12.5, 0), (0, 0), (0, 7), (1000, 0)]
    kept = tables.project_allowlist(df, [("qty", "bigint"), ("absent", "int"), ("code", "string")])
    assert kept.dtypes == [("qty", "bigint"), ("code", "string")]
    assert tables.lower_names(df.withColumnRenamed("sku", "SKU")).columns == ["code", "sku", "qty"]


ORDER = "code int, sku string, day date, text string, qty int"
DAY = date(2024, 1, 1)


def test_delta_finds_new_and_changed_only(spark):
    source = frame(spark, [
        (1, "same", DAY, "t", 1), (1, "changed", DAY, "t", 2), (1, "new", DAY, "t", 3), (1, "date", DAY, "t", 4),
        (1, "null text", DAY, None, 5),
    ], ORDER)
    target = frame(spark, [
        (1, "same", DAY, "t", 1, 0), (1, "changed", DAY, "t", 9, 0), (1, "date", date(2024, 1, 2), "t", 4, 0),
        (1, "null text", DAY, "", 5, 0), (1, "gone", DAY, "t", 6, 0),
    ], ORDER + ", created_at int")
    found = delta.new_or_changed(source, target, ["code", "sku"], "day")
    assert found.columns == source.columns
    assert sorted(row.sku for row in found.collect()) == ["changed", "new"]


def test_delta_writes_the_row_as_it_is(spark):
    source = frame(spark, [(1, "A", DAY, None, 2)], ORDER)
    target = frame(spark, [(1, "A", DAY, "", 1)], ORDER)
    row, = delta.new_or_changed(source, target, ["code", "sku"], "day").collect()
    assert row.text is None


def test_delta_ignores_columns_the_target_lacks(spark):
    source = frame(spark, [(1, "A", DAY, "t", 2)], ORDER)
    assert delta.new_or_changed(source, source.drop("qty"), ["code", "sku"], "day").count() == 0
    assert delta.new_or_changed(source, source.limit(0), ["code", "sku"], "day").count() == 1


keys = st.sampled_from(["1", "2", "3", None])
records = st.lists(st.tuples(keys, st.sampled_from(["A", "B"]), st.integers(0, 3)), max_size=8)
by_example = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@by_example
@given(target=records, batch=records)
def test_replace_matches_its_definition(spark, target, batch):
    """The tuple IN of SQL, in Python; loading again changes only null-keyed rows."""
    batch_keys = {row[:2] for row in batch if row[0] is not None}
    expected = [row for row in target if row[:2] not in batch_keys] + batch
    once = loads.replace_by_key(frame(spark, target), frame(spark, batch), ["code", "sku"])
    assert contents(once) == sorted(expected, key=str)
    whole = [row for row in batch if row[0] is not None]
    first = loads.replace_by_key(frame(spark, target), frame(spark, whole), ["code", "sku"])
    assert contents(loads.replace_by_key(first, frame(spark, whole), ["code", "sku"])) == contents(first)


@by_example
@given(target=records, changes=records)
def test_upsert_matches_its_definition(spark, target, changes):
    known = {row[:2]: row for row in target if row[0] is not None}
    start = list(known.values())
    for row in sorted(changes, key=lambda row: row[2]):
        if row[0] is not None:
            known[row[:2]] = row
    expected = [*known.values(), *[row for row in changes if row[0] is None]]
    result = loads.upsert(frame(spark, start), frame(spark, changes), ["code", "sku"], ["qty"])
    assert contents(result) == sorted(expected, key=str)
