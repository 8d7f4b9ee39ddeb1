"""Key summaries: only partitions that can hold a key are opened; counts by kind are those of the rows written."""

from __future__ import annotations

import os
import random
import subprocess
import sys
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.sinks import summaries
from ledgerline.sinks.tables import Folder, PartitionedTable

COLUMNS = (("doc", "bigint"), ("sku", "string"), ("day", "date"), ("qty", "int"))
SCHEMA = "doc long, sku string, day date, qty int"
KEYS = ["doc", "sku"]


def monthly(spark, path):
    return PartitionedTable(spark, str(path), COLUMNS, "month", F.date_format(F.col("day"), "yyyy-MM"))


def year_of_rows(per_month=300):
    """Document numbers rise with the months."""
    rng = random.Random(1)
    first = date(2023, 1, 1)
    return [(m * per_month + i, f"S{rng.randint(0, 9)}", first + timedelta(days=30 * m + i % 28), i) for m in range(12) for i in range(per_month)]


def contents(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_load_opens_only_partitions_whose_summary_can_match(spark, tmp_path):
    rows = year_of_rows()
    table = monthly(spark, tmp_path)
    table.replace_by_key(spark.createDataFrame(rows, SCHEMA), "first", KEYS)
    months = sorted(table.current().folders)
    batch = [(3005, rows[3005][1], rows[3005][2], -1), (9999, "S0", rows[3005][2], -2)]
    wanted = spark.createDataFrame(batch, SCHEMA).select(*KEYS)
    month = f"{rows[3005][2]:%Y-%m}"
    near = table.candidates(table.current(), wanted, KEYS)
    assert month in near and len(near) <= 2
    # All other partitions' data is out of reach: the load must not need it.
    folders = table.current().folders
    for name in set(months) - near:
        Folder(spark, f"{tmp_path}/data/load_folder={folders[name]}").remove(f"month={name}")
    table.replace_by_key(spark.createDataFrame(batch, SCHEMA), "second", KEYS)
    after = table._rows_of({month: table.current().folders[month]}).drop("month")
    expected = [r for r in rows if f"{r[2]:%Y-%m}" == month and r[:2] != rows[3005][:2]] + batch
    assert contents(after) == sorted(expected, key=str)


def test_hashed_bits_tell_partitions_with_one_range_apart(spark):
    rows = [(i, f"S{i}", f"p{i % 8}") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc long, sku string, part string")
    found = summaries.summarised(df, "part", KEYS)
    for i in (17, 1234, 3999):
        near = summaries.candidates(found, "part", df.where(F.col("doc") == i).select(*KEYS), KEYS, [f"p{k}" for k in range(8)])
        assert f"p{i % 8}" in near and len(near) <= 3
    stranger = spark.createDataFrame([(2000, "never")], "doc long, sku string")
    assert len(summaries.candidates(found, "part", stranger, KEYS, [f"p{k}" for k in range(8)])) <= 2


def test_null_keys_unknown_partitions_and_other_keys(spark):
    df = spark.createDataFrame([(1, "a", "p"), (None, "a", "p"), (None, None, "q")], "doc long, sku string, part string")
    found = summaries.summarised(df, "part", KEYS)
    assert {r.part: r.row_count for r in found.select("part", "row_count").distinct().collect()} == {"p": 2, "q": 1}
    wanted = spark.createDataFrame([(1, "a"), (None, "a")], "doc long, sku string")
    assert summaries.candidates(found, "part", wanted, KEYS, ["p", "q", "old"]) == {"p", "old"}
    assert summaries.candidates(found, "part", wanted.limit(0), KEYS, ["p", "q"]) == set()
    assert summaries.candidates(found, "part", wanted, ["doc"], ["p", "q"]) == {"p", "q"}


@pytest.mark.parametrize("seed", range(3))
def test_loads_with_summaries_equal_loads_over_everything(spark, tmp_path, seed):
    rng = random.Random(seed)
    first = date(2024, 1, 1)
    table, truth = monthly(spark, tmp_path), []
    for load in range(4):
        rows = [(rng.choice([None, *range(40)]), rng.choice("ab"), first + timedelta(days=rng.randint(0, 200)), load * 100 + i) for i in range(25)]
        table.replace_by_key(spark.createDataFrame(rows, SCHEMA), f"load{load}", KEYS)
        gone = {r[:2] for r in rows if r[0] is not None}
        before = len(truth)
        left = [r for r in truth if r[:2] not in gone]
        removed, truth = before - len(left), left + rows
        assert contents(table.read()) == sorted(truth, key=str)
        counts = table.counts(f"load{load}")
        assert counts["loaded"] == 25 and counts["removed"] == removed and counts["kept"] <= len(left)
        assert counts["inserted"] == counts["updated"] == 0


def test_upsert_counts_inserted_and_updated_rows(spark, tmp_path):
    rows = year_of_rows(20)
    table = monthly(spark, tmp_path)
    table.replace_by_key(spark.createDataFrame(rows, SCHEMA), "first", KEYS)
    changes = [(*rows[3][:3], 77), (*rows[4][:3], 78), (5000, "new", rows[3][2], 79)]
    table.upsert(spark.createDataFrame(changes, SCHEMA), "second", KEYS)
    month = [r for r in rows if f"{r[2]:%Y-%m}" == f"{rows[3][2]:%Y-%m}"]
    assert table.counts("second") == {"kept": len(month) - 2, "loaded": 0, "inserted": 1, "updated": 2, "removed": 0}
    assert contents(table.read()) == sorted([r for r in rows if r[:2] not in (rows[3][:2], rows[4][:2])] + changes, key=str)


def test_old_tables_without_summaries_and_bounded_load_lists(spark, tmp_path):
    rows = year_of_rows(5)
    table = monthly(spark, tmp_path)
    table.keep_loads = 2
    table.replace_by_key(spark.createDataFrame(rows, SCHEMA), "first", KEYS)
    Folder(spark, str(tmp_path)).remove("summaries")
    for i in range(3):
        table.replace_by_key(spark.createDataFrame([(*rows[7][:3], i)], SCHEMA), f"more{i}", KEYS)
    assert contents(table.read()) == sorted([r for r in rows if r != rows[7]] + [(*rows[7][:3], 2)], key=str)
    assert list(table.current().loads) == ["more1", "more2"] and set(table.current().counts) == {"more1", "more2"}


RETRIED = """
import sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from ledgerline.operators.loads import observed_kinds

spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()

def fail_once(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().partitionId() == 1 and TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

df = spark.range(0, 1000, 1, 4).mapInArrow(fail_once, "id long").withColumn("_kind", F.lit("kept"))
counted, observation = observed_kinds(df, "_kind", "again")
counted.write.parquet(sys.argv[1])
assert observation.get["kept"] == 1000 == spark.read.parquet(sys.argv[1]).count()
"""


def test_a_repeated_attempt_of_a_writing_task_counts_once(tmp_path):
    """In a session of its own, as the tests' session does not repeat tasks."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = {**os.environ, "PYTHONPATH": os.pathsep.join([root, *sys.path])}
    command = [sys.executable, "-c", RETRIED, str(tmp_path / "out")]
    done = subprocess.run(command, env=environment, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "RuntimeError: lost" in done.stderr


def test_partitions_the_batch_writes_are_not_searched(spark, tmp_path, monkeypatch):
    columns = (("id", "bigint"), ("day", "date"), ("note", "string"))
    table = PartitionedTable(spark, str(tmp_path / "t"), columns, "month", F.date_format("day", "yyyy-MM"))

    def batch(*rows):
        values = ", ".join(f"({i}L, DATE'{day}', '{note}')" for i, day, note in rows)
        return spark.sql(f"SELECT * FROM VALUES {values} AS t(id, day, note)")

    searched = []
    found = PartitionedTable.candidates

    def candidates(self, version, wanted, keys):
        searched.append(set(version.folders))
        return found(self, version, wanted, keys)

    monkeypatch.setattr(PartitionedTable, "candidates", candidates)
    table.replace_by_key(batch((1, "2024-01-05", "a"), (2, "2024-02-05", "a"), (3, "2024-03-05", "a")), "first", ["id"])
    # Key 1 moves from January to March, 3 stays in March: January is found by its summary, March is written anyway.
    table.replace_by_key(batch((1, "2024-03-06", "b"), (3, "2024-03-07", "b")), "second", ["id"])
    assert searched == [{"2024-01", "2024-02"}]
    assert sorted((r.id, str(r.day), r.note) for r in table.read().collect()) == [
        (1, "2024-03-06", "b"), (2, "2024-02-05", "a"), (3, "2024-03-07", "b"),
    ]
    assert dict(table.counts("second")) == {"kept": 0, "loaded": 2, "inserted": 0, "updated": 0, "removed": 2}
    assert set(table.current().folders) == {"2024-02", "2024-03"}
