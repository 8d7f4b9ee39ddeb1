"""Key windows, one-scan fields, bucketed tables, row digests, day states and split planning."""

from __future__ import annotations

import random
import uuid
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import RUN, table
from pyspark.sql import functions as F

from ledgerline.operators import attributes, day_states, delta, digests, windows
from ledgerline.sinks.bucketed import write_bucketed
from ledgerline.sinks.tables import Folder, PartitionedTable
from ledgerline.sources import readers
from ledgerline.sources.splits import plan_splits


def contents(df):
    return sorted(map(tuple, df.collect()), key=str)


def scanned_rows(spark, df, column):
    """Rows that the file scans with a column gave out, after row groups were pruned."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        return sum(s.metrics().get("numOutputRows").get().value() for s in scans if column in s.toString())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_windows_key_range_reaches_the_item_scan(spark, tmp_path):
    ids = list(range(4000))
    random.Random(2).shuffle(ids)  # the file's order is not the ids' order, but each file holds a range
    items = spark.createDataFrame([(i, i * 10) for i in ids], "document_id long, item long")
    items.repartitionByRange(20, "document_id").write.parquet(str(tmp_path / "items"))
    stored = spark.read.parquet(str(tmp_path / "items"))
    wanted = spark.createDataFrame([(1215,), (1203,), (1290,), (1203,), (None,)], "doc long")
    found = windows.of_keys(stored, "document_id", wanted)
    assert contents(found) == [(1203, 12030), (1215, 12150), (1290, 12900)]
    assert scanned_rows(spark, windows.of_keys(stored, "document_id", wanted), "item") <= 400
    nothing = windows.of_keys(stored, "document_id", wanted.where("doc < 0"))
    assert nothing.count() == 0
    far = spark.createDataFrame([(3,), (3990,)], "doc long")
    assert contents(windows.of_keys(stored, "document_id", far)) == [(3, 30), (3990, 39900)]


def test_fields_per_sale_count_equal_values_and_keep_nulls(spark):
    types = spark.createDataFrame([(1, "Freight x"), (2, "TRAFFIC"), (4, "traffic"), (3, "Prospect")], "attribute_type_id long, name string")
    rows = [(7, 1, "1"), (7, 1, "1"), (7, 2, "old code"), (7, 4, "a"), (7, 4, "a"), (7, 4, None), (8, 3, "yes"), (9, 2, "no"), (None, 4, "z")]
    values = spark.createDataFrame(rows, "sale_id long, attribute_type_id long, value string")
    shown = {"traffic": "traffic", "missing": "nothing such"}
    found = attributes.fields_per_sale(types, values, shown, {"freight": "freight%", "none": None})
    rows = {r.sale_id: r for r in found.collect()}
    assert set(rows) == {7, None}
    assert sorted(map(tuple, rows[7].traffic), key=str) == [("a", 2), (None, 1)] and rows[7].missing == []
    assert rows[7].freight_rows == 2 and rows[7].none_rows is None and rows[None].freight_rows is None
    empty = attributes.fields_per_sale(types, values, {}, {"none": None})
    assert empty.count() == 0


def test_bucketed_tables_meet_without_a_shuffle(spark, tmp_path):
    name = f"b_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        documents = table(spark, "document", [{"document_id": i, "issue_date": RUN - timedelta(days=i)} for i in range(50)])
        items = table(spark, "document_item", [{"item_id": i, "document_id": i % 60, "quantity": 1} for i in range(300)])
        write_bucketed(spark, {"document": documents, "document_item": items}, name, 8, str(tmp_path))
        kept = readers.catalog_tables(spark, name, ["document", "document_item"])
        assert contents(kept["document_item"]) == contents(items) and kept["document"].dtypes == documents.dtypes
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        window = kept["document"].where(F.col("issue_date") >= F.lit(RUN - timedelta(days=9))).select("document_id")
        found = kept["document_item"].join(window, "document_id").groupBy("document_id").agg(F.sum("quantity").alias("q"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert contents(found) == [(i, Decimal("5.0000")) for i in range(10)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.sql(f"DROP DATABASE {name} CASCADE")


# ---------------------------------------------------------------- digests

ROW = "id long, day date, name string, amount decimal(20,6), share double, at timestamp_ntz, note string"
KEYS = ["id"]


def digest_rows(spark, rows):
    return spark.createDataFrame(rows, ROW)


@pytest.mark.parametrize("seed", range(3))
def test_digests_find_what_comparing_columns_finds(spark, seed):
    rng = random.Random(seed)

    def row(i):
        return (
            rng.choice([i, i, None]), date(2024, 1, 1 + i % 20), rng.choice(["a", "", None, "b:1"]),
            rng.choice([Decimal("1"), Decimal("1.50"), Decimal("0"), None, Decimal("-10.25")]),
            rng.choice([0.0, -0.0, 1.5, float("nan"), None]),
            rng.choice([datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 0, 5), None]), rng.choice(["", None, "x"]),
        )

    source, target = digest_rows(spark, [row(i) for i in range(120)]), digest_rows(spark, [row(i) for i in range(100)])
    target = target.dropDuplicates(["id"])
    kinds = digests.compared_kinds(target.dtypes, KEYS, "day")
    stored = digests.with_digest(target, kinds)
    found = digests.new_or_changed(source, stored, KEYS, "day", kinds).drop(digests.DIGEST)
    expected = delta.new_or_changed(source, target, KEYS, "day")
    assert list(map(str, contents(found))) == list(map(str, contents(expected)))


def test_digests_see_numbers_not_their_spelling(spark):
    kinds = {"name": "string", "amount": "decimal(20,6)", "share": "double"}
    wide = spark.createDataFrame([("", Decimal("10"), -0.0)], "name string, amount decimal(10,0), share double")
    fine = spark.createDataFrame([(None, Decimal("10.000"), 0.0)], "name string, amount decimal(12,3), share double")
    other = spark.createDataFrame([(None, Decimal("1.000"), 0.0)], "name string, amount decimal(12,3), share double")
    one, same, not_same = (df.select(digests.row_digest(kinds).alias("d")).first().d for df in (wide, fine, other))
    assert one == same != not_same
    # Lengths keep columns apart.
    pair = spark.createDataFrame([("a", "bc"), ("ab", "c")], "x string, y string")
    assert pair.select(digests.row_digest({"x": "string", "y": "string"})).distinct().count() == 2


def test_a_digest_comparison_reads_keys_and_digest_only(spark, tmp_path):
    rows = [(i, date(2024, 1, 1), "a", Decimal(i), 1.0, None, None) for i in range(20)]
    kinds = digests.compared_kinds(digest_rows(spark, rows).dtypes, KEYS, "day")
    digests.with_digest(digest_rows(spark, rows), kinds).write.parquet(str(tmp_path / "t"))
    changed = digest_rows(spark, [(3, date(2024, 1, 1), "b", Decimal(3), 1.0, None, None), *rows[4:6]])
    found = digests.new_or_changed(changed, spark.read.parquet(str(tmp_path / "t")), KEYS, "day", kinds)
    assert [r.id for r in found.collect()] == [3]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,row_digest:binary>" in plan
    no_digest = digest_rows(spark, rows).withColumn(digests.DIGEST, F.lit(None).cast("binary"))
    assert digests.new_or_changed(changed, no_digest, KEYS, "day", kinds).count() == 3


# ---------------------------------------------------------------- day states

WHAT = day_states.DayStates("day", "doc", ("net", "freight"))
LINES = "doc string, day date, net decimal(20,4), freight decimal(20,4), key string"


def random_lines(seed, n=300):
    rng = random.Random(seed)
    docs = ["0", "7", "007", "99999", "1000000", "X-1", "", None, "123456789012345678", "1234567890123456789", "-5", " 7"]
    amounts = [Decimal("1.25"), Decimal("-3"), None, Decimal("0.0001")]
    return [(rng.choice(docs), date(2024, 1, rng.randint(1, 3)), rng.choice(amounts), rng.choice(amounts), f"k{rng.randint(0, 40)}") for _ in range(n)]


def test_states_of_any_split_merge_to_the_totals_of_the_lines(spark):
    lines = spark.createDataFrame(random_lines(1), LINES)
    parts = [day_states.states_of(lines.where(F.pmod(F.xxhash64("key"), F.lit(3)) == i), WHAT) for i in range(3)]
    states = parts[0].unionByName(parts[1]).unionByName(day_states.merged(parts[2]))
    for day in (date(2024, 1, 1), date(2024, 1, 3), date(2025, 1, 1)):
        expected = lines.where(F.col("day") == F.lit(day)).agg(F.count_distinct("doc"), F.sum(F.col("net") + F.col("freight"))).first()
        found = day_states.day_totals(states, day).first()
        assert (found.orders, found.total) == tuple(expected)
    assert day_states.day_totals(day_states.states_of(lines.limit(0), WHAT), date(2024, 1, 1)).first().orders == 0


def test_states_kept_with_loads_equal_the_lines_after_replacements(spark, tmp_path):
    columns = (("doc", "string"), ("day", "date"), ("net", "decimal(20,4)"), ("freight", "decimal(20,4)"), ("key", "string"))
    target = PartitionedTable(spark, str(tmp_path), columns, "month", F.date_format(F.col("day"), "yyyy-MM-dd"), day_states=WHAT)
    for load, seed in enumerate((1, 2, 2, 3)):
        target.replace_by_key(spark.createDataFrame(random_lines(seed, 60), LINES), f"load{load if load != 2 else 1}", ["key"])
        for number in (1, 2, 3):
            day = date(2024, 1, number)
            lines = target.read().where(F.col("day") == F.lit(day))
            truth = lines.agg(F.count_distinct("doc"), F.sum(F.col("net") + F.col("freight"))).first()
            found = day_states.day_totals(target.states(since="2024-01-01"), day).first()
            assert (found.orders, found.total) == tuple(truth)
    # The lines are not needed; without states they are.
    before = contents(day_states.merged(target.states()).drop("bits"))
    Folder(spark, str(tmp_path)).remove("states")
    assert contents(day_states.merged(target.states()).drop("bits")) == before


# ---------------------------------------------------------------- splits


@pytest.mark.parametrize("case", ["even", "skewed", "dates", "few", "nulls", "empty"])
def test_splits_cover_all_rows_once_and_are_of_equal_depth(spark, case):
    rng = random.Random(3)
    values = {
        "even": list(range(5000)),
        "skewed": [7] * 2000 + [int(rng.paretovariate(1.0)) for _ in range(3000)],
        "dates": [date(2020, 1, 1) + timedelta(days=int(rng.expovariate(0.01))) for _ in range(4000)],
        "few": [1, 2, 3] * 100,
        "nulls": [None] * 1000 + list(range(1000)),
        "empty": [],
    }[case]
    kind = "date" if case == "dates" else "long"
    df = spark.createDataFrame([(v,) for v in values], f"k {kind}").repartition(4)
    splits = plan_splits(df, "k", 8)
    counts = [df.where(split.predicate).count() for split in splits]
    assert counts == [split.rows for split in splits] and sum(counts) == len(values)
    tests = [F.coalesce(F.expr(split.predicate), F.lit(False)).cast("int") for split in splits]
    assert df.where(sum(tests[1:], tests[0]) != 1).count() == 0
    known = [c for c, s in zip(counts, splits) if not s.predicate.endswith("IS NULL") and c]
    if case in ("even", "dates", "nulls"):
        assert max(known) <= 2 * min(known) and len(known) >= 7
    if case == "skewed":
        heavy = max(values.count(v) for v in set(values))
        assert max(known) == heavy and sorted(known)[-2] <= 2 * sorted(known)[0] + 5000 // 8


def test_large_database_tables_may_be_read_by_planned_predicates(spark):
    names = [n for n in readers.LARGE_TABLES if n != "document_item"]
    source = readers.JdbcSource("jdbc:none:x", predicates={name: ("a < 1", "a >= 1") for name in names})
    with pytest.raises(ValueError, match="document_item$"):
        readers.jdbc_tables(spark, source)
