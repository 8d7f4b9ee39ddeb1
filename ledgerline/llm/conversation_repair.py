"""Conversation structure repair: faults, the cheapest edits to a legal order of roles, and the repaired rows.

Rows are dealt once by ranges of (conversation, turn, role, text), so a conversation that holds a third of all rows lies
over many partitions in its order. A conversation within one partition is repaired there, in one pass. Those at a
partition's edge go on as pieces, one a partition: earlier copies are found by the least place of each content
(combined before the shuffle), each piece becomes a transition of cost vectors, the few pieces of a conversation are
composed, and each piece is then traced from all four states at once; only what leads from piece to piece is gathered.

Defined results. A null role, text, turn or conversation id is read as one space where its text matters; null turns
come first, and a null id is a conversation. Rows of one turn follow by role and text. A role without a letter is
none of the known ones. A conversation of which no row is left has zeros and no rows. An empty table gives none. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.llm.block_tables import KEPT, MUST_GO, START, WRITTEN, symbol, tables
from ledgerline.llm.shared import checkpointed

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
GONE = 9  # a dropped row: keeps its conversation, nothing else
REPORT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, digest string"
REPAIRED = "conv_id long, part int, place long, role string, text string"
OUT_ROWS = 10_000
_LEGAL = {"su", "ua", "au"}


def rows_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live) of a table of turns as it is; nulls in role and text as one space."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.lit(True).alias("live"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with a fifth of them damaged by the crc of ``conv_id:turn``: dropped, emptied, without their ends of
    sentences, repeated, or given to the user. Dropped rows stay as rows that are not live."""
    rows = rows_of(conversations)
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    changed = rows.select(
        "conv_id",
        "turn",
        F.when(kind == 0, " ").otherwise(role).alias("role"),
        F.when(kind == 0, " ").otherwise(text).alias("text"),
        (kind != 0).alias("live"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
    )
    return changed.select("conv_id", "turn", "role", "text", "live", F.explode(F.sequence(F.lit(1), "copies"))).drop("col")


# ------------------------------------------------------------------ one piece of a conversation


@dataclass
class Row:
    turn: int | None
    role: str
    text: str
    live: bool


def fault_symbol(row: Row) -> tuple[int, bytes | None]:
    """The row's symbol but for copies, and its content's digest, by which copies are known (none of a blank row)."""
    if not row.live:
        return GONE, None
    body = row.text.rstrip(SPACE)
    if not body:
        return MUST_GO, None
    content = hashlib.sha256(f"{len(row.role)}:{row.role}{row.text}".encode()).digest()
    return symbol(row.role, body[-1] not in ENDS), content


@dataclass
class Piece:
    """What one piece tells of its rows; pieces of a conversation are added in their order."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first_turn: int | None = None
    last_turn: int | None = None
    turns: int = 0
    first_initial: str | None = None
    last_initial: str | None = None

    def take(self, row: Row, code: int, copy: bool) -> int | None:
        """Count a row; its symbol, or None of a dropped one."""
        if code == GONE:
            return None
        if row.turn is not None and row.turn != self.last_turn:
            self.first_turn = row.turn if self.turns == 0 else self.first_turn
            self.last_turn, self.turns = row.turn, self.turns + 1
        mark = row.role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + mark not in _LEGAL
        else:
            self.first_initial = mark
        self.last_initial = mark
        if code == MUST_GO:
            self.blank += 1
        elif copy:
            self.duplicate += 1
            return MUST_GO
        else:
            self.truncated += code % 2
        return code

    def add(self, other: Piece) -> None:
        self.blank += other.blank
        self.duplicate += other.duplicate
        self.truncated += other.truncated
        self.illegal += other.illegal
        if other.first_initial is not None:
            if self.last_initial is not None:
                self.illegal += self.last_initial + other.first_initial not in _LEGAL
            self.last_initial = other.last_initial
        if other.turns:
            self.turns += other.turns - (self.turns > 0 and self.last_turn == other.first_turn)
            self.first_turn = other.first_turn if self.first_turn is None else self.first_turn
            self.last_turn = other.last_turn

    @property
    def gaps(self) -> int:
        if not self.turns:
            return 0
        return min(self.last_turn - self.first_turn + 1 - self.turns, (1 << 63) - 1)


class Writer:
    """Repaired rows from rows and edits, a row at a time."""

    def __init__(self, edits: str, state: int):
        self.edits, self.at, self.state = edits, 0, state

    def _inserts(self) -> Iterator[tuple[str, str]]:
        while self.edits[self.at : self.at + 1] == "I":
            role, self.state = WRITTEN[self.state]
            self.at += 1
            yield role, ""

    def take(self, row: Row) -> Iterator[tuple[str, str]]:
        yield from self._inserts()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.state = KEPT[self.state, row.role[:1]]
            yield row.role, row.text
        elif edit == "R":
            role, self.state = WRITTEN[self.state]
            yield role, row.text

    def rest(self) -> Iterator[tuple[str, str]]:
        yield from self._inserts()


def repaired_whole(rows: list[Row]) -> tuple[Piece, int, str, list[tuple[str, str]]]:
    """Counts, cost, audit and repaired rows of a whole conversation, its rows in order."""
    piece, seen, codes, live = Piece(), set(), [], []
    for row in rows:
        code, content = fault_symbol(row)
        code = piece.take(row, code, content in seen)
        if code is not None:
            codes.append(code)
            live.append(row)
            seen |= {content} if content else set()
    symbols = np.array(codes, np.int8)
    edits, state = tables().trace(symbols, tables().end, START)
    edits += tables().closing(state)
    writer = Writer(edits, START)
    result = [pair for row in live for pair in writer.take(row)] + list(writer.rest())
    return piece, tables().least_cost(symbols), edits, result


def digest_of(rows: list[tuple[str, str]]) -> str:
    return hashlib.sha256("\n".join([f"{role}:{text}" for role, text in rows]).encode()).hexdigest()


# ------------------------------------------------------------------ Spark jobs


def _schema(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _batches(rows: Iterator[dict], ddl: str) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "byte": pa.int8(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    kinds["array<int>"], kinds["array<long>"], kinds["array<string>"] = pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string())
    schema = pa.schema([(name, kinds[kind]) for name, kind in (column.split() for column in ddl.split(","))])
    waiting, size = [], 0
    for row in rows:
        waiting.append(row)
        size += len(row.get("text") or "")
        if len(waiting) >= OUT_ROWS or size > 8 << 20:
            yield pa.RecordBatch.from_pylist(waiting, schema)
            waiting, size = [], 0
    if waiting:
        yield pa.RecordBatch.from_pylist(waiting, schema)


def _dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            yield from batch.slice(at, 1000).to_pylist()


def in_order(rows: DataFrame) -> DataFrame:
    """Rows dealt in order of conversation, turn, role and text, written once, with their partition and place."""
    numbered = rows.select("conv_id", "turn", "role", "text", "live", F.monotonically_increasing_id().alias("row"))
    keys = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")] + [F.asc("row")]
    dealt = checkpointed(numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("row"))
    return dealt.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id())


_KIND = f"kind byte, {REPORT}, part int, place long, turn long, role string, text string, live boolean, pos long, symbol byte, content binary"


def _first_pass(dealt: DataFrame, with_rows: bool) -> DataFrame:
    """Reports (kind 0) of the conversations within one partition, with their repaired rows (kind 2) if wanted, and the
    rows (kind 1) of those at its edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(made(_dicts(batches)), _KIND)

    def edge(row: dict) -> dict:
        code, content = fault_symbol(Row(row["turn"], row["role"], row["text"], row["live"]))
        return row | {"kind": 1, "symbol": code, "content": content}

    def made(rows: Iterator[dict]) -> Iterator[dict]:
        first, current, run_rows = True, None, []
        started = False
        for row in rows:
            if started and row["conv_id"] != current:
                if not first:
                    yield from whole(current, run_rows)
                first, run_rows = False, []
            started, current = True, row["conv_id"]
            if first:
                yield edge(row)
            else:
                run_rows.append(row)
        yield from map(edge, run_rows)

    def whole(conv_id: int | None, rows: list[dict]) -> Iterator[dict]:
        piece, cost, audit, result = repaired_whole([Row(r["turn"], r["role"], r["text"], r["live"]) for r in rows])
        yield _report(conv_id, piece, cost) | {"kind": 0, "audit": audit, "digest": digest_of(result)}
        if with_rows:
            for place, (role, text) in enumerate(result):
                yield {"kind": 2, "conv_id": conv_id, "part": rows[0]["part"], "place": place, "role": role, "text": text}

    return dealt.mapInArrow(run, _schema(_KIND))


def _report(conv_id: int | None, piece: Piece, cost: int) -> dict:
    counts = {name: getattr(piece, name) for name in ("blank", "duplicate", "truncated", "illegal")}
    return counts | {"conv_id": conv_id, "gaps": piece.gaps, "cost": cost}


_FACTS = ("blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns", "first_initial", "last_initial")
_PIECE = (
    "conv_id long, part int, blank long, duplicate long, truncated long, illegal long, first_turn long, last_turn long, "
    "turns long, first_initial string, last_initial string, symbols binary, steps array<int>, costs array<long>"
)


def _pieces(edges: DataFrame) -> DataFrame:
    """One row a conversation and partition: counts, symbols, and the transition of cost vectors."""
    firsts = edges.where("content IS NOT NULL").groupBy("conv_id", "content").agg(F.min("pos").alias("pos"))
    nothing = [F.lit(None).cast(kind).alias(name) for name, kind in (("conv_id", "long"), ("turn", "long"), ("role", "string"), ("symbol", "byte"))]
    slim = edges.select("part", "pos", "conv_id", "turn", F.substring("role", 1, 1).alias("role"), "symbol", F.lit(False).alias("mark"))
    marks = firsts.select(F.shiftright("pos", 33).cast("int").alias("part"), "pos", *nothing, F.lit(True).alias("mark"))
    together = slim.unionByName(marks).repartition("part").sortWithinPartitions("part", "pos", "mark")

    def with_copies(rows: Iterator[dict]) -> Iterator[tuple[dict, bool]]:
        """Rows, and whether each is a copy: a mark behind a row says that it is the first of its content."""
        before = None
        for row in rows:
            if row["mark"]:
                yield before, False
                before = None
            else:
                if before is not None:
                    yield before, True
                before = row
        if before is not None:
            yield before, True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(made(_dicts(batches)), _PIECE)

    def made(rows: Iterator[dict]) -> Iterator[dict]:
        key, piece, codes = None, Piece(), bytearray()
        for row, copy in with_copies(rows):
            if key != (row["part"], row["conv_id"]):
                if key is not None:
                    yield done(key, piece, codes)
                key, piece, codes = (row["part"], row["conv_id"]), Piece(), bytearray()
            code = piece.take(Row(row["turn"], row["role"], "", True), row["symbol"], copy)
            if code is not None:
                codes.append(code)
        if key is not None:
            yield done(key, piece, codes)

    def done(key: tuple, piece: Piece, codes: bytearray) -> dict:
        steps, costs = tables().composed(np.frombuffer(bytes(codes), np.int8))
        facts = {name: getattr(piece, name) for name in _FACTS}
        return facts | {"part": key[0], "conv_id": key[1], "symbols": bytes(codes), "steps": steps.tolist(), "costs": costs.tolist()}

    return checkpointed(together.mapInArrow(run, _schema(_PIECE)))


def _by_conversation(rows: DataFrame, made, ddl: str) -> DataFrame:
    """``made`` (list of rows by part -> rows) for each conversation's pieces, of which there are as many as partitions."""

    def run(table: pa.Table) -> pa.Table:
        pieces = sorted(table.to_pylist(), key=lambda r: r["part"])
        return pa.Table.from_batches(list(_batches(iter(made(pieces)), ddl)), None)

    return rows.groupBy("conv_id").applyInArrow(run, _schema(ddl))


def _edge_reports(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports of the conversations at edges, and their repaired rows."""
    pieces = _pieces(edges)

    def composed(parts: list[dict]) -> list[dict]:
        vector, total, rows = tables().end, 0, []
        whole = Piece()
        for part in parts:
            whole.add(Piece(**{name: part[name] for name in _FACTS}))
        for part in reversed(parts):
            rows.append({"conv_id": part["conv_id"], "part": part["part"], "after": vector})
            total += part["costs"][vector]
            vector = part["steps"][vector]
        rows[-1] |= _report(parts[0]["conv_id"], whole, total + tables().vectors[vector][START])
        return rows

    facts = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    small = pieces.drop("symbols")
    ends = checkpointed(_by_conversation(small, composed, f"conv_id long, part int, after int, {facts}"))

    def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            for row in _dicts(batches):
                symbols = np.frombuffer(row["symbols"], np.int8)
                found = [tables().trace(symbols, row["after"], state) for state in range(4)]
                yield {"conv_id": row["conv_id"], "part": row["part"], "edits": [e for e, _ in found], "exits": [s for _, s in found]}

        return _batches(made(), ways)

    def entered(parts: list[dict]) -> list[dict]:
        state, rows = START, []
        for part in parts:
            rows.append({"conv_id": part["conv_id"], "part": part["part"], "state": state, "edits": part["edits"][state]})
            state = part["exits"][state]
        rows[-1]["edits"] += tables().closing(state)
        return rows

    ways = "conv_id long, part int, edits array<string>, exits array<int>"
    same = F.col("p.conv_id").eqNullSafe(F.col("e.conv_id")) & (F.col("p.part") == F.col("e.part"))
    joined = pieces.alias("p").join(ends.alias("e"), same).select("p.conv_id", "p.part", "p.symbols", "e.after")
    chosen = checkpointed(_by_conversation(joined.mapInArrow(traced, _schema(ways)), entered, "conv_id long, part int, state int, edits string"))
    repaired = _repaired(edges, chosen)

    audits = chosen.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "edits"))).alias("parts"))
    audit = F.array_join(F.transform("parts", lambda p: p["edits"]), "")
    names = [c.split()[0] for c in facts.split(", ")]
    empty = {c: F.lit(None).cast("string").alias(c) for c in ("audit", "digest")}
    none = [F.lit(None).cast("long").alias(c) for c in names]
    # Each conversation has one row with its counts, one with its audit, and one with its digest if rows are left.
    parts = ends.where("cost IS NOT NULL").select("conv_id", *names, empty["audit"], empty["digest"])
    parts = parts.unionByName(audits.select("conv_id", *none, audit.alias("audit"), empty["digest"]))
    parts = parts.unionByName(digests(repaired).select("conv_id", *none, empty["audit"], "digest"))
    merged = parts.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in (*names, "audit", "digest")])
    return merged.withColumn("digest", F.coalesce("digest", F.sha2(F.lit(""), 256))), repaired


def _repaired(edges: DataFrame, chosen: DataFrame) -> DataFrame:
    """The repaired rows of pieces: each piece's edits meet its rows in the order of their places."""
    given = edges.where("live").select("conv_id", "part", "pos", "turn", "role", "text", F.lit(None).cast("int").alias("state"))
    first = chosen.select(
        "conv_id", "part", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("edits").alias("text"), "state"
    )
    together = given.unionByName(first).repartition("part").sortWithinPartitions("part", F.asc_nulls_first("conv_id"), "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(made(_dicts(batches)), REPAIRED)

    def made(rows: Iterator[dict]) -> Iterator[dict]:
        key, writer, place = (None, None), None, 0
        for row in rows:
            if row["state"] is not None:
                if writer is not None:
                    for role, text in writer.rest():
                        yield {"conv_id": key[0], "part": key[1], "place": place, "role": role, "text": text}
                        place += 1
                key, writer, place = (row["conv_id"], row["part"]), Writer(row["text"], row["state"]), 0
                continue
            for role, text in writer.take(Row(row["turn"], row["role"], row["text"], True)):
                yield {"conv_id": key[0], "part": key[1], "place": place, "role": role, "text": text}
                place += 1
        if writer is not None:
            for role, text in writer.rest():
                yield {"conv_id": key[0], "part": key[1], "place": place, "role": role, "text": text}
                place += 1

    return together.mapInArrow(run, _schema(REPAIRED))


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, digest) of repaired rows. SHA-256 has one order, so a conversation passes through one task, but as a stream
    of which only a batch is held."""
    together = repaired.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "part", "place")
    ddl = "conv_id long, digest string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(made(_dicts(batches)), ddl)

    def made(rows: Iterator[dict]) -> Iterator[dict]:
        key, state = None, None
        for row in rows:
            line = f"{row['role']}:{row['text']}".encode()
            if state is None or row["conv_id"] != key:
                if state is not None:
                    yield {"conv_id": key, "digest": state.hexdigest()}
                key, state = row["conv_id"], hashlib.sha256(line)
            else:
                state.update(b"\n" + line)
        if state is not None:
            yield {"conv_id": key, "digest": state.hexdigest()}

    return together.mapInArrow(run, _schema(ddl))


def repair(rows: DataFrame, with_rows: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """Reports (``REPORT``) of all conversations of :func:`rows_of` or :func:`damaged`, and if wanted the repaired rows
    (``REPAIRED``), ordered within a conversation by part and place."""
    first = checkpointed(_first_pass(in_order(rows), with_rows))
    names = _schema(REPORT).names
    reports, repaired = _edge_reports(first.where("kind = 1").select("conv_id", "part", "pos", "turn", "role", "text", "live", "symbol", "content"))
    all_reports = first.where("kind = 0").select(*names).unionByName(reports.select(*names))
    if not with_rows:
        return all_reports, None
    columns = _schema(REPAIRED).names
    return all_reports, first.where("kind = 2").select(*columns).unionByName(repaired)
