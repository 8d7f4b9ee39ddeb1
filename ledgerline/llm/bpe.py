"""Byte-level BPE encoding and decoding by DuckDB recursive queries, one small database per Spark partition.

Each match of the splitting pattern is a word. The words of some MB of text that are not known yet become
token-position rows; a recursive query joins them with the merge table and contracts, round by round, the leftmost pair
of least rank of every word, until no pair has a rank. Known words, and pieces of text of one or more words, are kept
by the Python worker in tables bounded by bytes, from which only what is long out of use is dropped (``pieces.py``).
Decoding joins (text, position, id) rows with the vocabulary and aggregates in the order of the positions.

The vocabulary is read by the driver and sent to the tasks (its size is that of the file, not of the data). Words of
more than ``LONG_WORD`` bytes, as in texts without any space, would need as many rounds as they have merges over as many
rows; they are contracted in the same order by a heap of pairs instead.

A null text is encoded like an empty one, to no ids. Repeated rows and ties give equal rows; a null id is kept.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.pieces import Pieces, encoded, joined
from ledgerline.llm.words import slices
from ledgerline.llm.worker import kept

LONG_WORD = 512
QUERY_WORDS = 50_000
WORD_BYTES = 96 << 20
PIECE_BYTES = 112 << 20
SLICE_BYTES = 2 << 20
DECODE_IDS = 1 << 20

_START = """
CREATE OR REPLACE TEMP TABLE start AS
SELECT p.w, p.pos, p.pos + 1 AS nxt, p.id, p.nid, m.t
FROM positions p LEFT JOIN merges m ON p.id = m.l AND p.nid = m.r
"""

# A row is a token of a word: its position, the next token's position and id, and the id t that both merge to.
# Ids are ranks, so the least of (t, position) is the leftmost pair of least rank.
_ENCODE = """
WITH RECURSIVE state(w, pos, nxt, id, nid, t, done) AS (
  SELECT w, pos, nxt, id, nid, t, false FROM start
  UNION ALL (
    WITH least AS (
      SELECT w, min(t * 1048576 + pos) AS k FROM state WHERE NOT done GROUP BY w
    ), hit AS (
      SELECT h.w, (h.k & 1048575)::INT AS spot, (h.k >> 20)::INT AS merged, n.pos AS gone, n.nxt, n.nid
      FROM least h
      JOIN state s ON s.w = h.w AND s.pos = (h.k & 1048575)
      JOIN state n ON n.w = h.w AND n.pos = s.nxt
      WHERE h.k IS NOT NULL
    ), moved AS (
      SELECT s.w, s.pos, s.t, s.pos = h.spot OR s.nxt = h.spot AS changed,
             CASE WHEN s.pos = h.spot THEN h.nxt ELSE s.nxt END AS nxt,
             CASE WHEN s.pos = h.spot THEN h.merged ELSE s.id END AS id,
             CASE WHEN s.pos = h.spot THEN h.nid WHEN s.nxt = h.spot THEN h.merged ELSE s.nid END AS nid
      FROM state s JOIN hit h ON s.w = h.w
      WHERE s.pos <> h.gone
    )
    SELECT w, pos, nxt, id, nid, t, false FROM moved WHERE NOT changed
    UNION ALL
    SELECT c.w, c.pos, c.nxt, c.id, c.nid, m.t, false
    FROM moved c LEFT JOIN merges m ON c.id = m.l AND c.nid = m.r WHERE c.changed
    UNION ALL
    SELECT s.w, s.pos, s.nxt, s.id, s.nid, s.t, true FROM state s JOIN least h ON s.w = h.w WHERE h.k IS NULL
  )
)
SELECT w, list(id ORDER BY pos) AS ids FROM state WHERE done GROUP BY w ORDER BY w
"""

_DECODE = """
SELECT i.doc, string_agg(v.chars, '' ORDER BY i.pos) AS chars
FROM token_ids i JOIN vocabulary v ON v.id = i.id GROUP BY i.doc
"""

def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Codec:
    """The merge table and the vocabulary in a DuckDB database in memory."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.findall = regex.compile(pattern).findall
        self.words = Pieces(self._learn, max_bytes=WORD_BYTES)
        self.pieces = Pieces(self._joined, max_bytes=PIECE_BYTES)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB", "temp_directory": ""})
        merges = [
            (ranks[token[:cut]], ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        columns = zip(("l", "r", "t"), zip(*merges), (pa.int32(), pa.int32(), pa.int64()))
        self._load("merges", {name: pa.array(values, kind) for name, values, kind in columns})
        ids, chars = zip(*((rank, token.decode("latin-1")) for token, rank in ranks.items()))
        self._load("vocabulary", {"id": pa.array(ids, pa.int32()), "chars": pa.array(chars)})

    def _load(self, name: str, columns: dict[str, pa.Array]) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _contract_long(self, word: bytes) -> list[int]:
        """The same contractions with a heap of (rank, position) over a linked list of tokens."""
        ranks = self.ranks
        end = [at + 1 for at in range(len(word))]
        before = [at - 1 for at in range(len(word))]
        heap: list[tuple[int, int, int]] = []

        def offer(at: int) -> None:
            stop = end[at]
            if stop < len(word) and (rank := ranks.get(word[at : end[stop]])) is not None:
                heapq.heappush(heap, (rank, at, end[stop]))

        for at in range(len(word) - 1):
            offer(at)
        gone = bytearray(len(word))
        while heap:
            rank, at, stop = heapq.heappop(heap)
            middle = end[at]
            if gone[at] or middle >= len(word) or end[middle] != stop or ranks.get(word[at:stop]) != rank:
                continue
            gone[middle], end[at] = 1, stop
            if stop < len(word):
                before[stop] = at
            offer(at)
            if before[at] >= 0:
                offer(before[at])
        result, at = [], 0
        while at < len(word):
            result.append(ranks[word[at : end[at]]])
            at = end[at]
        return result

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Encode words: all their ids in a row, and the number of ids of each."""
        results: list[np.ndarray | None] = [None] * len(words)
        short = []
        for i, word in enumerate(words):
            raw = word.encode()
            if raw in self.ranks:
                results[i] = np.array([self.ranks[raw]], np.int32)
            elif len(raw) > LONG_WORD:
                results[i] = np.array(self._contract_long(raw), np.int32)
            else:
                short.append((i, raw))
        for at in range(0, len(short), QUERY_WORDS):
            part = short[at : at + QUERY_WORDS]
            sizes = np.array([len(raw) for _, raw in part])
            ids = self.byte_ids[np.frombuffer(b"".join(raw for _, raw in part), np.uint8)]
            ends = np.cumsum(sizes)
            following = np.append(ids[1:], np.int32(-1))
            following[ends - 1] = -1
            positions = np.arange(len(ids)) - np.repeat(ends - sizes, sizes)
            columns = {"w": np.repeat(np.arange(len(part)), sizes), "pos": positions, "id": ids, "nid": following}
            self.db.register("positions", pa.table({k: pa.array(v.astype(np.int32)) for k, v in columns.items()}))
            self.db.execute(_START)
            found = self.db.sql(_ENCODE).to_arrow_table()["ids"].combine_chunks()
            flat = found.flatten().to_numpy(zero_copy_only=False)
            limits = np.append(0, np.cumsum(pa.compute.list_value_length(found).to_numpy())).tolist()
            for (i, _), begin, end in zip(part, limits, limits[1:]):
                results[i] = flat[begin:end]
        return (np.concatenate(results) if results else np.zeros(0, np.int32)), np.array([len(r) for r in results], np.int64)

    def _joined(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, from those of their words."""
        return joined([self.findall(piece) for piece in pieces], self.words)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and the number of ids of each; a null text has none."""
        return encoded(texts, self.pieces)

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes that each text's ids stand for."""
        result = [b""] * len(sizes)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            begin = int(ends[at] - sizes[at])
            to = max(at + 1, int(np.searchsorted(ends, begin + DECODE_IDS, "right")))
            part, stop = sizes[at:to], int(ends[to - 1])
            rows = {"doc": pa.array(np.repeat(np.arange(at, to), part)), "pos": pa.array(np.arange(stop - begin)), "id": pa.array(ids[begin:stop])}
            self.db.register("token_ids", pa.table(rows))
            for doc, chars in self.db.execute(_DECODE).fetchall():
                result[doc] = chars.encode("latin-1")
            at = to
        return result


OPERATOR = "bpe"


def _codec(ranks: dict[bytes, int], pattern: str) -> Codec:
    """One codec per Python worker, which keeps what it knows from task to task."""
    codecs = kept(OPERATOR)
    key = (len(ranks), hash(frozenset(ranks.items())), pattern)
    if key not in codecs:
        codecs.clear()
        codecs[key] = Codec(ranks, pattern)
    return codecs[key]


def encode(
    docs: DataFrame,
    path: str,
    pattern: str,
    outputs: tuple[str, ...] = ("ids",),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_tokens, outputs) of every row.

    ``outputs``: ``ids`` (array), ``ids_sha256`` (of the ids as little-endian unsigned 32-bit integers), ``decoded``
    (bytes, from the ids by the decoding query) and ``decoded_sha256``.
    """
    kinds = {"ids": "array<int>", "ids_sha256": "string", "decoded": "binary", "decoded_sha256": "string"}
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for part in slices(batches, "text", SLICE_BYTES, OPERATOR):
            ids, sizes = codec.encode(part.column(1))
            limits = np.append(0, np.cumsum(sizes))
            columns = {"doc_id": part.column(0), "n_tokens": pa.array(sizes)}
            decoded = codec.decode(ids, sizes) if {"decoded", "decoded_sha256"} & set(outputs) else None
            for name in outputs:
                if name == "ids":
                    columns[name] = pa.ListArray.from_arrays(pa.array(limits.astype(np.int32)), pa.array(ids))
                elif name == "decoded":
                    columns[name] = pa.array(decoded, pa.binary())
                elif name == "ids_sha256":
                    raw = memoryview(ids.astype("<u4").tobytes())
                    digests = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(limits.tolist(), limits[1:].tolist())]
                    columns[name] = pa.array(digests, pa.string())
                else:
                    columns[name] = pa.array([hashlib.sha256(x).hexdigest() for x in decoded], pa.string())
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id long, n_tokens long" + "".join(f", {name} {kinds[name]}" for name in outputs)
    return wanted.mapInArrow(run, schema)


def decode(tokens: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, decoded): the bytes of every row's ids; a null list is an empty one."""
    shared = tokens.sparkSession.sparkContext.broadcast(read_ranks(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for part in batches:
            lists = part.column(1)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            columns = [part.column(0), pa.array(codec.decode(ids, sizes), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "decoded"])

    wanted = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return wanted.mapInArrow(run, "doc_id long, decoded binary")
