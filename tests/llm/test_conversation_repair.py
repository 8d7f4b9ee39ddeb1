"""Conversation repair against an exhaustive search and against SQL over odd rows, with few and many partitions."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import block_tables, conversation_repair, oracle

SCHEMA = "conv_id long, turn long, role string, text string, part int, state string"


def cheapest(codes):
    """Least (cost, edits) of all edits, from the beginning on, for each state."""

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for q, (cost, edits) in list(best.items()):
                to = block_tables.WRITTEN[q][1]
                best[to] = min(best.get(to, (99, "")), (cost + 2, edits + "I"))
        return best

    best = {0: (0, "")}
    for code in codes:
        after = {}
        for q, (cost, edits) in inserted(best).items():
            for edit, price, to in block_tables._moves(q, code):
                after[to] = min(after.get(to, (10**9, "")), (cost + price, edits + edit))
        best = after
    best = inserted(best)
    return min(best[q] for q in (0, 3) if q in best)


@pytest.mark.parametrize("n", range(14))
def test_tables_equal_exhaustive_search_and_split_anywhere(n):
    rng, t = np.random.default_rng(n), block_tables.tables()
    for _ in range(200):
        codes = rng.integers(0, 9, n)
        cost, edits = cheapest(codes.tolist())
        found, state = t.trace(codes, t.end, 0)
        assert (t.least_cost(codes), found + t.closing(state)) == (cost, edits)
        at = int(rng.integers(0, n + 1))
        step, price = t.composed(codes[at:])
        left, state = t.trace(codes[:at], int(step[t.end]), 0)
        right, state = t.trace(codes[at:], t.end, state)
        assert left + right + t.closing(state) == edits
        before, more = t.composed(codes[:at])
        assert price[t.end] + more[step[t.end]] + t.vectors[before[step[t.end]]][0] == cost


def odd_rows():
    rng = random.Random(6)
    rows = [
        (None, None, None, None), (None, 1, "user", "Hi."), (1, None, "user", "a"), (1, None, "assistant", "b."), (1, 1, None, "x."),
        (2, 1, "", "Role?"), (2, 2, "user", " \n\t "), (3, 5, "user", "A" * 20_000 + "."), (3, 9, "assistant", "é ü 😀!"),
        (4, 1, "system", "s."), (4, 2, "system", "s."), (4, 3, "system", "t."), (5, -(1 << 63), "user", "a."), (5, (1 << 63) - 2, "user", "b."),
    ]
    rows += [(6, 1, "user", "same.")] * 7
    texts = ["Yes.", "No!", "Why?", "so", "", "  ", "done. \n", "x"]
    for conv in range(7, 90):
        for turn in range(rng.randint(0, 9)):
            rows.append((conv, turn * rng.choice([1, 1, 2]), rng.choice(["user", "assistant", "system", "tool"]), rng.choice(texts)))
    for turn in range(700):  # one conversation with most rows
        rows.append((1000, turn // 2, rng.choice(["user", "assistant"]), rng.choice(texts) + str(rng.randint(0, 300)) + rng.choice(".!?x")))
    return rows


@pytest.mark.parametrize("partitions", [1, 13, 90])
def test_reports_equal_sql_and_rows_equal_reports(spark, partitions):
    rows = [r for r in odd_rows() if r[0] != 5]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    connection = duckdb.connect()
    frame = df.select("conv_id", "turn", "role", "text").toArrow()
    connection.register("conversations", frame)
    names = "conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256"
    expected = connection.execute(f"SELECT {names} FROM ({oracle.OP12_REPAIR})").fetchall()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        reports, repaired = conversation_repair.repair(conversation_repair.damaged(df.repartition(4)), with_rows=True)
        found = [tuple(r) for r in reports.collect()]
        texts = repaired.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert Counter(found) == Counter(expected)
    by_conversation = {}
    for r in sorted(texts, key=lambda r: (r.part, r.place)):
        by_conversation.setdefault(r.conv_id, []).append((r.role, r.text))
    for report in found:
        lines = by_conversation.get(report[0], [])
        assert conversation_repair.digest_of(lines) == report[-1]
        assert sum(e != "D" for e in report[7]) == len(lines)


def test_without_damage_and_extreme_turns(spark):
    df = spark.createDataFrame([(*r, 1, "x") for r in odd_rows()[:14]], SCHEMA)
    found = {r.conv_id: r for r in conversation_repair.repair(conversation_repair.rows_of(df))[0].collect()}
    assert set(found) == {None, 1, 2, 3, 4, 5}
    assert found[5].gaps == (1 << 63) - 1 and found[5].audit == "KR"
    assert found[4].duplicate == 1 and found[4].audit == "KDIR" and found[4].cost == 7
    assert found[3].gaps == 3 and found[3].audit == "KK" and found[3].cost == 0


def test_empty_table_and_dropped_conversations(spark):
    none = spark.createDataFrame([], SCHEMA)
    reports, repaired = conversation_repair.repair(conversation_repair.damaged(none), with_rows=True)
    assert reports.count() == 0 and repaired.count() == 0
    live = conversation_repair.rows_of(spark.createDataFrame([(1, 1, "user", "a.", 1, "x")], SCHEMA)).withColumn("live", F.lit(False))
    row = conversation_repair.repair(live)[0].first()
    assert tuple(row)[:8] == (1, 0, 0, 0, 0, 0, 0, "") and row.digest == conversation_repair.digest_of([])
