"""Substring dedup: words in a run of ``window`` words that also starts earlier in the corpus are removed.

"Earlier" is a smaller document id, or the same document at an earlier word; all windows are judged on the input.

1. Every window is led by its least hash of ``GRAM`` consecutive words, so equal windows have equal leaders.
   Successive windows with one leader make a run: (leader, document, first window, number of windows). Runs whose
   leader is in no other run, and not twice in their own, hold no repeated window and end here.
2. The other runs' words are cut out of their documents and dealt to shards by leader. Windows of a leader of over
   ``HOT_RUNS`` runs are dealt one by one, by their own hash, so that a passage that very many documents have, with other
   words around it, spreads over shards; equal contents within a task are one row from then on.
3. A shard takes whole groups of leaders until a block is full, builds a compressed FM-index of the distinct contents in
   the order of their first places, and streams all windows through its backward search. The matching statistics
   say where ``window`` words or more also occur elsewhere, the suffix range where they first do. Intervals of windows
   that start earlier elsewhere are reported.
4. The intervals go back to their documents, and the covered words are dropped.

Nulls, ties, repeats: a null text has no words. A null id sorts before all others. Rows with one id are one document if
their texts are equal; they are not earlier than each other, whatever their texts. Texts shorter than the window
lose nothing. Other columns of the input, whatever their names, are carried in the struct ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.fmindex import FMIndex
from ledgerline.llm.shared import keyed, with_row
from ledgerline.llm.words import Words, range_hashes, slices, split

GRAM = 6
LEADER_SHIFT = 16  # leaders have 48 bits: two that meet by chance cost a candidate, and lose none
HOT_RUNS = 64
PLACE_SHIFT = 31  # a run's first window and number of windows in one value
BLOCK_WORDS = 1 << 18
REMEMBERED = 100_000
SHARD_SCHEMA = "key long, uid long, did long, th long, start int, n int, words binary"


def leaders(words: Words, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one leader: leader, text, first window (word of the text), windows, and weight.

    The weight is 2 if the leader may be twice in the run, so that the run may repeat itself.
    """
    begin, owner = words.windows(window)
    if not len(begin):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    total = words.hashes()
    at = np.arange(len(total) - gram + 1)
    grams = range_hashes(total, at, at + gram)
    places = window - gram + 1
    least, twice = grams[begin], np.zeros(len(begin), np.int64)
    for shift in range(1, places):
        least = np.minimum(least, grams[begin + shift])
    for shift in range(places):
        twice += grams[begin + shift] == least
    new = np.append(True, (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]))
    first = np.flatnonzero(new)
    sizes = np.diff(np.append(first, len(begin)))
    repeats = (np.maximum.reduceat(twice, first) > 1) | (sizes > places)
    local = begin[first] - words.first[:-1][owner[first]]
    return (least[first] >> np.uint64(LEADER_SHIFT)).view(np.int64), owner[first], local, sizes, np.where(repeats, 2, 1)


def runs(prepared: DataFrame, window: int, gram: int) -> DataFrame:
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            leader, owner, start, n, weight = leaders(split(part.column(1)), window, gram)
            uid = part.column(0).to_numpy(zero_copy_only=False)[owner]
            columns = [pa.array(x, pa.int64()) for x in (leader, uid, start << PLACE_SHIFT | n)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(weight.astype(np.int32))], ["leader", "uid", "place", "weight"])

    return prepared.select("uid", "text").mapInArrow(compute, "leader long, uid long, place long, weight int")


def shared_runs(prepared: DataFrame, window: int, gram: int) -> DataFrame:
    """Per document, its runs that may hold a repeated window (where texts share an id, those of all of them)."""
    found = runs(prepared, window, gram)
    counts = found.groupBy("leader").agg(F.sum("weight").alias("weight"), F.count("*").alias("runs"))
    counts = counts.filter("weight > 1").select("leader", (F.col("runs") > HOT_RUNS).alias("hot"))
    kept = found.drop("weight").join(counts, "leader")
    return kept.groupBy("uid").agg(F.collect_set(F.struct("place", "leader", "hot")).alias("spans"))


def _flat(lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers and fields of a column of lists of structs; a null list is empty."""
    owner = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    flat = lists.flatten()
    return owner, [flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)]


def _text(rows: pa.Array, text_col: str) -> pa.Array:
    return rows.field(text_col).cast(pa.string())


def _cut(base: DataFrame, text_col: str, spans: DataFrame, window: int) -> DataFrame:
    """The words of the shared runs: a row each (windows of hot leaders one by one), for the shards."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bytes], tuple[int, int]] = {}
        for part in _row_slices(batches, text_col):
            words = split(_text(part.column(0), text_col))
            joined, starts, ends = words.joined()
            raw = joined.tobytes()
            owner, (place, leader, hot) = _flat(part.column(4))
            start, n = place >> PLACE_SHIFT, place & ((1 << PLACE_SHIFT) - 1)
            # Of texts that share an id, a run of one may be beyond the end of another.
            fits = start + n + window - 1 <= words.counts[owner]
            owner, start, n, leader, hot = (x[fits] for x in (owner, start.astype(np.int64), n, leader, hot.astype(bool)))
            times = np.where(hot, n, 1)
            each = np.repeat(np.arange(len(n)), times)
            offset = np.arange(len(each)) - np.repeat(np.cumsum(times) - times, times)
            owner, leader, hot = owner[each], leader[each], hot[each]
            start, n = start[each] + offset, np.where(hot, 1, n[each])
            first = words.first[:-1][owner] + start
            last = first + n + window - 2
            key = leader.copy()  # of a hot leader, the one window's own hash
            key[hot] = range_hashes(words.hashes(1), first[hot], last[hot] + 1).view(np.int64)
            uid, did, th = (part.column(i).to_numpy(zero_copy_only=False)[owner] for i in (1, 2, 3))
            contents = []
            rows = zip(starts[first].tolist(), ends[last].tolist(), key.tolist(), did.tolist(), start.tolist())
            for a, b, k, d, s in rows:
                content = raw[a:b]
                before = seen.get((k, content))
                # An earlier place of the same words is on its way: this one is removed, without the words.
                if before is not None and before < (d, s):
                    contents.append(b"")
                    continue
                seen[k, content] = (d, s)
                contents.append(content)
            if len(seen) > REMEMBERED:
                seen = {}
            gone = np.fromiter((not content for content in contents), bool, len(contents))
            sent = np.flatnonzero(~gone)
            first, last = _merged(owner, start, n, np.flatnonzero(gone))
            size = np.concatenate([n[sent], start[last] + n[last] - start[first]])
            rows = np.concatenate([sent, first])
            key = np.concatenate([key[sent], uid[first]])  # what is removed already needs no shard of its own
            longs = [pa.array(x, pa.int64()) for x in (key, uid[rows], did[rows], th[rows])]
            small = [pa.array(x.astype(np.int32)) for x in (start[rows], size)]
            words_of = pa.array([contents[i] for i in sent.tolist()] + [b""] * len(first), pa.binary())
            names = ["key", "uid", "did", "th", "start", "n", "words"]
            yield pa.RecordBatch.from_arrays([*longs, *small, words_of], names)

    # In one order, so that a repeated task sends the same rows with words as the first one did.
    joined = base.join(spans, "uid").select("row", "uid", "did", "th", F.sort_array("spans").alias("spans"))
    joined = joined.sortWithinPartitions("uid", "th")
    return joined.mapInArrow(compute, SHARD_SCHEMA)


def _merged(owner: np.ndarray, start: np.ndarray, n: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last row of each stretch of windows without a gap, among ``rows``."""
    rows = rows[np.lexsort([start[rows], owner[rows]])]
    if not len(rows):
        return rows, rows
    joined = (owner[rows][1:] == owner[rows][:-1]) & (start[rows][1:] == (start + n)[rows][:-1])
    return rows[np.append(True, ~joined)], rows[np.append(~joined, True)]


def _row_slices(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = _text(batch.column(0), text_col)
        numbered = pa.RecordBatch.from_arrays([texts, pa.array(np.arange(len(texts)))], ["text", "at"])
        for part in slices(iter([numbered]), "text"):
            yield batch.slice(part.column(1)[0].as_py(), part.num_rows)


def search_block(rows: list[tuple], window: int) -> list[tuple[int, int, int, int]]:
    """(uid, th, first window, last window + 1) that start earlier elsewhere, of (uid, did, th, start, n, words) rows."""
    places: dict[bytes, tuple[int, int]] = {}
    for _, did, _, start, _, content in rows:
        places[content] = min(places.get(content, (did, start)), (did, start))
    contents = sorted(places, key=places.__getitem__)
    words = split(pa.array(contents, pa.binary()))
    joined, begins, _ = words.joined()
    # Words are told apart by their bytes (and the space after each), not by hashes.
    listed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(np.append(begins, len(joined))), pa.py_buffer(joined)])
    symbols = listed.dictionary_encode().indices.to_numpy().astype(np.int64)
    # Symbol 0 stands before every content, so that no match goes beyond one.
    counts = words.counts
    text = np.insert(symbols + 1, words.first[:-1], 0)
    begin, owner = words.windows(window)
    starts = begin + owner + 1
    matched, earliest = FMIndex(text, window).earlier_matches(starts, window)
    repeated = (matched >= window) & (earliest < starts)
    flags = np.split(repeated, np.cumsum(np.maximum(counts - window + 1, 0))[:-1])
    own = dict(zip(contents, flags))
    found = []
    for uid, did, th, start, n, content in rows:
        if places[content] < (did, start):
            found.append((uid, th, start, start + n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], own[content].astype(np.int8), [0]])))
        found.extend((uid, th, start + int(a), start + int(b)) for a, b in zip(edges[::2], edges[1::2]))
    return found


def repeated_windows(prepared: DataFrame, base: DataFrame, text_col: str, window: int, gram: int) -> DataFrame:
    """(uid, th, begin, end): intervals of first words of windows that also start earlier."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(found: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*found)) if found else [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["uid", "th", "begin", "end"])

        block: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            found = []
            for key, uid, did, th, start, n, content in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if not content:
                    found.append((uid, th, start, start + n))
                    continue
                if size >= BLOCK_WORDS and key != last:
                    found += search_block(block, window)
                    block, size = [], 0
                block.append((uid, did, th, start, n, content))
                size, last = size + n + window - 1, key
            yield emit(found)
        if block:
            yield emit(search_block(block, window))

    cut = _cut(base, text_col, shared_runs(prepared, window, gram), window)
    sharded = cut.repartition("key").sortWithinPartitions("key", "did", "start")
    return sharded.mapInArrow(compute, "uid long, th long, begin int, end int")


def dedup(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, n_words, n_removed, kept) of every row of ``docs``: ``kept`` are the words left, joined by one space."""
    gram = min(GRAM, window)
    prepared = keyed(docs, id_col, text_col)
    # Both joins take the same columns, texts only once, so that their shuffle is made once.
    base = prepared.select("row", "uid", "did", "th")
    found = repeated_windows(prepared, base, text_col, window, gram)
    spans = found.groupBy("uid").agg(F.collect_list(F.struct("th", "begin", "end")).alias("spans"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _row_slices(batches, text_col):
            words = split(_text(part.column(0), text_col))
            owner, (th, begin, end) = _flat(part.column(4))
            own = th == part.column(3).to_numpy(zero_copy_only=False)[owner]
            owner, begin, end = owner[own], begin[own].astype(np.int64), end[own].astype(np.int64)
            base = words.first[:-1][owner]
            edge = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(edge, base + begin, 1)
            np.add.at(edge, base + end + window - 1, -1)
            gone = np.cumsum(edge)[:-1] > 0
            total = np.append(0, np.cumsum(gone))
            removed = total[words.first[1:]] - total[words.first[:-1]]
            left = np.append(0, np.cumsum(~gone))[words.first]
            kept = Words(words.data, words.limits, words.starts[~gone], words.ends[~gone], left)
            joined, starts, ends = kept.joined()
            raw = joined.tobytes()
            texts = [raw[starts[a] : ends[b - 1]] if b > a else b"" for a, b in zip(left[:-1], left[1:])]
            columns = [part.column(0), pa.array(words.counts), pa.array(removed), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "n_words", "n_removed", "kept"])

    marked = base.join(spans, "uid", "left").select("row", "uid", "did", "th", "spans")
    return marked.mapInArrow(compute, with_row(prepared, "n_words long, n_removed long, kept string"))
