"""Token ids as binary files of Re-Pair grammars, in ascending document order, readable as a whole or by document.

Documents are dealt by ranges of their id (copies of one id apart, so that no id can fill a task), encoded piece by
piece by the tokenizer, and packed in blocks of about ``BLOCK_IDS`` ids, each a grammar of its own. Spark's Parquet
writer puts the blocks of a range in one file: it commits whole files only, so a lost executor leaves nothing half
written. A block's row holds its documents (ids and sizes), where it begins within its range, and the grammar's parts.
Readers know each document's place from the sums over the ranges, one small row a range.

Defined results. A null text is an empty one and has the end id only. A null document id comes first; rows with one id
follow by the hash of their text, and copies one after the other. A very long document is a block of its own. An empty
table gives no blocks. Other columns are not read.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.llm import matches
from ledgerline.llm.pieces import Pieces, cut, encoded, gather
from ledgerline.llm.repair_grammar import Grammar, compress
from ledgerline.llm.shared import small_batches
from ledgerline.llm.words import slices
from ledgerline.llm.worker import kept

BLOCK_IDS = 1 << 18
SLICE_BYTES = 6 << 20
PIECE_BYTES = 320 << 20
WORDS_AT_ONCE = 8192
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
OTHER_STEPS = ("ignore_merges", "dropout", "continuing_subword_prefix", "end_of_word_suffix")
GRAMMAR = ("alphabet", "rules", "lengths", "symbols", "samples")
BLOCK = (
    "part int, block int, start_in_part long, n_ids long, first_id long, last_id long, doc_ids array<long>, doc_sizes array<long>, "
    + ", ".join(f"{name} binary" for name in GRAMMAR)
)


def _byte_chars() -> dict[int, str]:
    """The character that stands for each byte: itself if it is printable, else the next one from 256 on."""
    shown = {b for b in range(256) if chr(b).isprintable() and b != 0x20 and b != 0xAD}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_CHARS = _byte_chars()


def usual_steps(vocabulary: dict) -> bool:
    """Whether a tokenizer of the library splits by the usual byte-level pattern and does nothing but merges to a word."""
    model = vocabulary["model"]
    plain = vocabulary["pre_tokenizer"] == BYTE_LEVEL and vocabulary.get("normalizer") is None and not any(model.get(x) for x in OTHER_STEPS)
    return plain and all(char in model["vocab"] for char in BYTE_CHARS.values())


def library_encoder(vocabulary: str, ordinary: bool = True) -> Callable[..., tuple[np.ndarray, np.ndarray]]:
    """Encodes pieces by the tokenizers library. The library is slow on many short texts, so pieces that are one match of its
    pattern go to its BPE model some thousands at a time, as one text of words that are split already; all others are encoded
    whole. ``ordinary``: strings of special tokens in a text are text like any other."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import CharDelimiterSplit

    tokenizer = Tokenizer.from_str(vocabulary)
    tokenizer.encode_special_tokens = ordinary
    steps = json.loads(vocabulary)
    tokens, special = steps["model"]["vocab"], [added["content"] for added in steps.get("added_tokens") or ()]
    plain_steps = usual_steps(steps)
    # The same model; words are given to it in its characters, between line breaks, which are none of them.
    of_words = Tokenizer(tokenizer.model)
    of_words.pre_tokenizer = CharDelimiterSplit("\n")
    chars = np.full(256, ord("\n"), "<u2")  # 0xFF, which is in no text, goes between words
    chars[[b for b in BYTE_CHARS if b != 0xFF]] = [ord(char) for b, char in BYTE_CHARS.items() if b != 0xFF]
    token_bytes = np.zeros(max(tokens.values(), default=0) + 1, np.int64)
    token_bytes[list(tokens.values())] = list(map(len, tokens))  # one character a byte

    def words(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one after the other, and the number of ids of each: every byte is in one token."""
        text = chars[np.frombuffer(b"\xff".join(found), np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(of_words.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        word_ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        return ids, np.diff(np.searchsorted(np.cumsum(token_bytes[ids]), word_ends), prepend=-1)

    def encode(pieces: list[str], table: Pieces | None = None) -> tuple[np.ndarray, np.ndarray]:
        if plain_steps:
            alone = matches.single(pieces)
            if not ordinary and special:
                alone &= ~np.fromiter((any(token in piece for token in special) for piece in pieces), bool, len(pieces))
        else:
            alone = np.zeros(len(pieces), bool)
        sizes, parts = np.zeros(len(pieces), np.int64), []
        plain = np.flatnonzero(alone)
        for begin in range(0, len(plain), WORDS_AT_ONCE):
            at = plain[begin : begin + WORDS_AT_ONCE]
            ids, sizes[at] = words([pieces[i].encode() for i in at.tolist()])
            parts.append(ids)
        others = np.flatnonzero(~alone)
        if len(others):
            whole = [encoding.ids for encoding in tokenizer.encode_batch_fast([pieces[i] for i in others.tolist()], add_special_tokens=False)]
            sizes[others] = list(map(len, whole))
            parts.append(np.fromiter(chain.from_iterable(whole), np.int32))
        if not parts:
            return np.zeros(0, np.int32), sizes
        # The parts are those of the words and of the others; the result is in the order of the pieces.
        order = np.concatenate([plain, others])
        starts = np.zeros(len(pieces), np.int64)
        starts[order] = np.cumsum(sizes[order]) - sizes[order]
        return np.concatenate(parts)[gather(starts, sizes)], sizes

    return encode


OPERATOR = "token_files"


def _pieces(vocabulary: str) -> tuple[Pieces, Callable]:
    """One table a Python worker, which keeps what it knows from task to task, and how texts are cut for it."""
    tables = kept(OPERATOR)
    key = hash(vocabulary)
    if key not in tables:
        tables.clear()
        by_class = usual_steps(json.loads(vocabulary))
        tables[key] = Pieces(library_encoder(vocabulary), max_bytes=PIECE_BYTES), matches.cut if by_class else cut
    return tables[key]


def ordered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text) in ascending order of id, null first, then of the text's hash; partitions follow one another."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.xxhash64(text).alias("tie"),
        F.monotonically_increasing_id().alias("row"),
    )
    keys = [F.asc_nulls_first("doc_id"), F.asc("tie"), F.asc("row")]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "text")


def write(docs: DataFrame, path: str, vocabulary_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every document, append ``end_id`` to each, and write the blocks to the folder ``path``."""
    small_batches(docs.sparkSession, SLICE_BYTES)
    with open(vocabulary_path, encoding="utf-8") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())

    def row_of(part: int, block: int, start: int, doc_ids: list, sizes: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        known = [d for d in doc_ids if d is not None]
        values = [part, block, start, len(ids), known[0] if known else None, known[-1] if known else None, doc_ids, sizes.tolist()]
        values += list(compress(ids).columns().values())
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, values))], schema)

    kinds = [pa.int32(), pa.int32(), *[pa.int64()] * 4, *[pa.list_(pa.int64())] * 2, *[pa.binary()] * len(GRAMMAR)]
    schema = pa.schema(list(zip(StructType.fromDDL(BLOCK).names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (table, cutter), part = _pieces(vocabulary.value), TaskContext.get().partitionId()
        block, start = 0, 0
        open_ids: list[np.ndarray] = []
        open_docs: list = []
        open_sizes: list[np.ndarray] = []
        waiting = 0
        for batch in slices(batches, "text", SLICE_BYTES, OPERATOR):
            ids, sizes = encoded(batch.column(1), table, cutter)
            ends = np.cumsum(sizes + 1)
            whole = np.full(int(ends[-1]), end_id, np.int32)
            whole[gather(ends - sizes - 1, sizes)] = ids
            doc_ids, at, begin = batch.column(0).to_pylist(), 0, 0
            while at < len(ends):
                # As many documents as the block still takes, one at least.
                to = max(int(np.searchsorted(ends, begin + BLOCK_IDS - waiting, "right")), at + (waiting == 0))
                stop = int(ends[to - 1]) if to > at else begin
                open_ids.append(whole[begin:stop])
                open_docs += doc_ids[at:to]
                open_sizes.append(sizes[at:to] + 1)
                waiting += stop - begin
                at, begin = to, stop
                if at < len(ends) or waiting >= BLOCK_IDS:
                    yield row_of(part, block, start, open_docs, np.concatenate(open_sizes), np.concatenate(open_ids))
                    block, start, waiting, open_ids, open_docs, open_sizes = block + 1, start + waiting, 0, [], [], []
        if open_docs:
            yield row_of(part, block, start, open_docs, np.concatenate(open_sizes), np.concatenate(open_ids))

    # Grammars are packed already.
    ordered(docs, id_col, text_col).mapInArrow(run, BLOCK).write.option("compression", "none").parquet(path)


def blocks(spark: SparkSession, path: str) -> DataFrame:
    """The blocks of a folder with ``start``, the ids of all blocks before each."""
    found = spark.read.schema(BLOCK).parquet(path)
    # One row a range of documents: as many as the writer had tasks.
    totals = found.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return found.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("start_in_part")).drop("before")


def _documents(found: DataFrame, added: str, digest: Callable[[Grammar, np.ndarray, np.ndarray], list[pa.Array]], wanted=None) -> DataFrame:
    """(doc_id, start, n_tokens, added columns) of the documents of blocks, all or those of the ids ``wanted``."""

    small_batches(found.sparkSession, SLICE_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("")  # the writer's table goes
        for batch in batches:
            for block in range(batch.num_rows):
                row = batch.slice(block, 1).to_pylist()[0]
                sizes = np.array(row["doc_sizes"], np.int64)
                starts = np.cumsum(sizes) - sizes
                chosen = np.arange(len(sizes)) if wanted is None else np.flatnonzero([d in wanted for d in row["doc_ids"]])
                if not len(chosen):
                    continue
                columns = [
                    pa.array([row["doc_ids"][i] for i in chosen.tolist()], pa.int64()),
                    pa.array(row["start"] + starts[chosen]),
                    pa.array(sizes[chosen]),
                    *digest(Grammar.of_columns(row), starts[chosen], sizes[chosen]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"doc_id long, start long, n_tokens long, {added}"
    names = StructType.fromDDL(schema).names
    return found.select("start", "doc_ids", "doc_sizes", *GRAMMAR).mapInArrow(run, schema)


def checksums(found: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the expanded blocks."""

    def digest(grammar: Grammar, starts: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
        data = memoryview(grammar.all().astype("<u4").tobytes())
        limits = zip((4 * starts).tolist(), (4 * (starts + sizes)).tolist())
        return [pa.array([zlib.crc32(data[begin:end]) for begin, end in limits], pa.int64())]

    return _documents(found, "ids_crc32 long", digest)


def read(found: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document; the end id is the last of each."""

    def digest(grammar: Grammar, starts: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
        limits = np.append(starts, starts[-1:] + sizes[-1:]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(limits), pa.array(grammar.all().astype(np.int32)))]

    return _documents(found, "ids array<int>", digest)


def lookup(found: DataFrame, doc_ids: list[int]) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of some documents. The range of ids in a block's row lets Parquet leave out files and
    row groups; within a block only the symbols that a document needs are expanded, found by their expansion lengths."""
    wanted = set(doc_ids)

    def digest(grammar: Grammar, starts: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
        ids = [grammar.range(int(start), int(size)).astype(np.int32) for start, size in zip(starts, sizes)]
        return [pa.array(ids, pa.list_(pa.int32()))]

    near = found.where((F.col("first_id") <= max(wanted, default=0)) & (F.col("last_id") >= min(wanted, default=0)))
    return _documents(near, "ids array<int>", digest, wanted)
