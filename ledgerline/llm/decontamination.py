"""Benchmark decontamination by template windows: finds benchmark items in documents, also with other numbers and names.

Words are made canonical: punctuation at their ends goes, ASCII letters become lower case, numbers, units after a number
and names (capitalised words that do not begin a sentence) become typed placeholders. Every run of ``WINDOW`` canonical
words with ``LEAST_LITERALS`` or more plain words is a template window; a shorter item is one window of its own size if it
has a plain word. Every run is also an exact window, with its lower-case words in place of the placeholders, so that
verbatim items are found whatever their words.

The windows of both sides are joined by hash. A bitmap of fixed size over the benchmark's hashes drops most windows of
documents before the shuffle, whatever the benchmark's size, and loses none. Matching windows that lie on one diagonal of a
document and an item are a match. A value of the item stands for the document's value that it meets at the most
places of the diagonal; with a tie, for none. Windows with another pair of values are dropped, unless they are equal to the
item's. If less than half of a diagonal's windows are left, only the equal ones count. Several values of the item may
stand for one of the document.

:func:`clean` drops a document only for a share of an item: within twice the item's length, windows of all diagonals
together that make up ``LEAST_SHARE`` of the item's; template windows must be ``LEAST_RUN`` or more, so that an item of
fewer is only dropped verbatim.

A null or empty text has no windows. Repeated items with one text count as the smallest id; repeated documents are all
reported, once per id and text. A null document id is reported as null. Other columns are carried in ``row`` by
:func:`clean`.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import FIRST_ID, keyed, unpacked
from ledgerline.llm.words import mix, range_hashes, slices, split

WINDOW = 8
LEAST_LITERALS = 4
LEAST_SHARE = 0.25
LEAST_RUN = 3
BITMAP_SLOTS = 1 << 21
NUMBER, NAME, UNIT = (np.uint64(x) for x in (11, 12, 13))
# FIXED VALUES: words for units, after a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yard yards mile miles g kg mg lb lbs pound pounds ounce ounces ton tons l ml "
    "liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks "
    "month months year years percent % degree degrees dollar dollars euro euros cent cents $ € usd eur mph kmh watt watts "
    "volt volts byte bytes kb mb gb"
)
# FIXED VALUES: words for numbers.
NUMBERS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
)


def _flags(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


_CORE = _flags((48, 57), (65, 90), (97, 122), (128, 255), (36, 37))
_DIGIT, _UPPER, _LOWER = _flags((48, 57)), _flags((65, 90)), _flags((97, 122))
_STOP = _flags((33, 33), (46, 46), (58, 58), (63, 63))


def _within(data: np.ndarray) -> np.ndarray:
    """Which bytes are part of a word's core; quotation marks, dashes and the like of more than one byte are not."""
    result = _CORE[data]
    lead, second = data[:-1], data[1:]
    for first, seconds, size in ((0xC2, (0xA0, 0xA1, 0xAB, 0xB7, 0xBB, 0xBF), 2), (0xE2, (0x80, 0x81), 3), (0xE3, (0x80,), 3)):
        at = np.flatnonzero((lead == first) & np.isin(second, seconds))
        for shift in range(size):
            result[np.minimum(at + shift, len(data) - 1)] = False
    return result


def _hashes_of(listed: str) -> np.ndarray:
    return np.sort(split(pa.array([listed])).hashes())


_UNIT_HASHES, _NUMBER_HASHES = _hashes_of(UNITS), _hashes_of(NUMBERS)


def canonical(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Canonical words: kind (0 for a plain word), hash, hash as they are, first of each text, and their place in the bytes."""
    words = split(column)
    data = words.data
    lowered = np.where(_UPPER[data], data + 32, data).astype(np.uint8)
    within = _within(data)
    core = np.append(0, np.cumsum(within))
    inside = core[words.ends] > core[words.starts]
    at = np.flatnonzero(within)
    starts, ends = words.starts[inside], words.ends[inside]
    begin = at[core[starts]] if len(starts) else starts
    end = at[core[ends] - 1] + 1 if len(starts) else ends
    first = np.append(0, np.cumsum(inside))[words.first]
    hashes = range_hashes(lowered, begin, end)
    number = np.isin(hashes, _NUMBER_HASHES)
    if len(begin):
        number |= _DIGIT[data[begin]]
        # A sentence begins after a stop, at the start of a text, and on a new line.
        stops = np.append(True, _STOP[data[ends - 1]][:-1])
        lines = np.append(0, np.cumsum(data == 0x0A))
        stops[1:] |= lines[starts[1:]] > lines[ends[:-1]]
        stops[first[:-1][first[:-1] < len(begin)]] = True
        second = np.minimum(begin + 1, len(data) - 1)
        name = _UPPER[data[begin]] & (end - begin > 1) & (_LOWER[data[second]] | (data[second] >= 128)) & ~stops
        unit = np.isin(hashes, _UNIT_HASHES) & np.append(False, number[:-1])
    else:
        name = unit = number
    kind = np.select([number, unit, name], [NUMBER, UNIT, NAME], np.uint64(0))
    return kind, np.where(kind > 0, mix(kind), hashes), hashes, first, begin, end, data


def _windows(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Windows of items: hash, text, first canonical word, size, whether exact; texts of fewer words are one window."""
    kind, hashes, plain, first, begin, end, data = canonical(column)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(owner))
    full = at + WINDOW <= first[1:][owner] if len(owner) else np.zeros(0, bool)
    few = np.flatnonzero((counts > 0) & (counts < WINDOW))
    starts, texts = np.concatenate([at[full], first[:-1][few]]), np.concatenate([owner[full], few])
    sizes = np.concatenate([np.full(int(full.sum()), WINDOW), counts[few]])
    literals = _literals(kind, starts, sizes)
    # A window without placeholders is found as an exact one.
    template = (literals < sizes) & (literals >= np.where(sizes < WINDOW, 1, LEAST_LITERALS))
    keys = np.concatenate([range_hashes(plain, starts, starts + sizes, 1), range_hashes(hashes, starts, starts + sizes)[template]])
    exact = np.arange(len(keys)) < len(starts)
    starts, sizes, texts = (np.concatenate([x, x[template]]) for x in (starts, sizes, texts))
    return keys, texts, starts, sizes, exact, (kind, first, begin, end, data)


def _literals(kind: np.ndarray, starts: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
    total = np.append(0, np.cumsum(kind == 0))
    return total[starts + sizes] - total[starts]


def _slots(start: int, size: int, parts: tuple) -> list[str]:
    """Place in the window, type and value of its slots, in order."""
    kind, _, begin, end, data = parts
    places = np.flatnonzero(kind[start : start + size])
    return [f"{i}:{int(kind[start + i])}:{data[begin[start + i] : end[start + i]].tobytes().decode(errors='replace').lower()}" for i in places.tolist()]


SCHEMA = "hash long, id long, th long, at int, slots array<string>, exact boolean, n int"


def _batch(hashes, ids, th, at, slots, exact, n) -> pa.RecordBatch:
    columns = [pa.array(hashes.view(np.int64)), pa.array(ids, pa.int64()), pa.array(th, pa.int64()), pa.array(at.astype(np.int32)), pa.array(slots, pa.list_(pa.string()))]
    columns += [pa.array(exact, pa.bool_()), pa.array(n.astype(np.int32))]
    return pa.RecordBatch.from_arrays(columns, ["hash", "id", "th", "at", "slots", "exact", "n"])


def benchmark_windows(items: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            hashes, texts, starts, sizes, exact, parts = _windows(part.column(1))
            slots = [[] if e else _slots(s, n, parts) for s, n, e in zip(starts.tolist(), sizes.tolist(), exact.tolist())]
            ids = part.column(0).to_numpy(zero_copy_only=False)[texts]
            windows = np.maximum(np.diff(parts[1]) - WINDOW + 1, 1)[texts]
            # In place of the text's hash, the window's size.
            yield _batch(hashes, ids, sizes, starts - parts[1][:-1][texts], slots, exact, windows)

    once = items.groupBy(F.col("text").cast("string").alias("text")).agg(F.min(F.col("item_id").cast("long")).alias("id"))
    once = once.select(F.coalesce("id", F.lit(FIRST_ID)).alias("id"), "text")
    return once.mapInArrow(run, SCHEMA)


def _accepted(windows: list[dict]) -> tuple[list[dict], int]:
    """Of one diagonal, the windows that are consistent, and the number of their different pairs of values."""
    pairs: dict[int, tuple[str, str]] = {}
    own = []
    for window in windows:
        slots = []
        for item, doc in zip(window["item_slots"], window["doc_slots"]):
            place, value = item.split(":", 1)
            slots.append((value, doc.split(":", 1)[1]))
            pairs[window["doc_at"] + int(place)] = slots[-1]
        own.append(slots)
    stands: dict[str, list] = {}
    for (item, doc), n in Counter(pairs.values()).items():
        most = stands.setdefault(item, [0, None])
        if n >= most[0]:
            stands[item] = [n, doc if n > most[0] else None]
    equal = [all(item == doc for item, doc in slots) for slots in own]
    good = [same or all(stands[item][1] == doc for item, doc in slots) for slots, same in zip(own, equal)]
    places = {window["doc_at"] for window in windows}
    if 2 * len({window["doc_at"] for window, g in zip(windows, good) if g}) < len(places):
        good = equal
    left = [window for window, g in zip(windows, good) if g]
    return left, len({pair for slots, g in zip(own, good) if g for pair in slots})


def diagonals(prepared: DataFrame, items: DataFrame) -> DataFrame:
    """(did, th, item_id, offset, n, n_slots, windows): consistent windows by diagonal; ``n`` is how many the item has."""
    wanted = benchmark_windows(items)
    slot = F.pmod(F.col("hash"), F.lit(BITMAP_SLOTS)).cast("int").alias("slot")
    found = wanted.select(slot).distinct().toArrow()["slot"].to_numpy()
    sizes = [row["th"] for row in wanted.select("th").distinct().collect()]  # at most WINDOW different ones
    bits = np.zeros(BITMAP_SLOTS, np.uint8)
    bits[found] = 1
    bitmap = prepared.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bitmap.value, np.uint8)
        for part in slices(batches, "text"):
            kind, hashes, plain, first, begin, end, data = canonical(part.column(2))
            parts = (kind, first, begin, end, data)
            counts = np.diff(first)
            owner = np.repeat(np.arange(len(counts)), counts)
            for size in sizes:
                at = np.arange(len(owner))
                starts = at[at + size <= first[1:][owner]] if len(owner) else at
                for exact in (True, False):
                    begins = starts if exact else starts[_literals(kind, starts, size) < size]
                    keys = range_hashes(plain, begins, begins + size, 1) if exact else range_hashes(hashes, begins, begins + size)
                    place = keys.view(np.int64) % BITMAP_SLOTS
                    hit = (known[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
                    begins, keys = begins[hit], keys[hit]
                    texts = owner[begins]
                    ids, th = (part.column(i).to_numpy(zero_copy_only=False)[texts] for i in (0, 1))
                    slots = [[] if exact else _slots(s, size, parts) for s in begins.tolist()]
                    yield _batch(keys, ids, th, begins - first[:-1][texts], slots, np.full(len(keys), exact), np.zeros(len(keys)))

    seen = prepared.select("did", "th", "text").mapInArrow(run, SCHEMA)
    seen = seen.select("hash", F.col("id").alias("did"), F.col("th"), F.col("at").alias("doc_at"), F.col("slots").alias("doc_slots"))
    asked = wanted.select("hash", F.col("id").alias("item_id"), F.col("at").alias("item_at"), F.col("slots").alias("item_slots"), "exact", "n")
    met = seen.join(asked, "hash").filter(F.size("doc_slots") == F.size("item_slots"))
    met = met.withColumn("offset", F.col("doc_at") - F.col("item_at"))
    # A diagonal has no more windows than its item.
    windows = F.collect_set(F.struct("doc_at", "exact", "item_slots", "doc_slots")).alias("windows")
    whole = met.groupBy("did", "th", "item_id", "offset").agg(F.max("n").alias("n"), windows)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_accepted(windows) for windows in batch.column(5).to_pylist()]
            kept = pa.array([bool(left) for left, _ in found], pa.bool_())
            windows = [[{"doc_at": w["doc_at"], "exact": w["exact"]} for w in left] for left, _ in found]
            kind = pa.list_(pa.struct([("doc_at", pa.int32()), ("exact", pa.bool_())]))
            columns = [*batch.columns[:5], pa.array([n for _, n in found], pa.int64()), pa.array(windows, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["did", "th", "item_id", "offset", "n", "n_slots", "windows"]).filter(kept)

    schema = "did long, th long, item_id long, offset int, n int, n_slots long, windows array<struct<doc_at: int, exact: boolean>>"
    return whole.mapInArrow(judge, schema)


def matches(prepared: DataFrame, items: DataFrame) -> DataFrame:
    """(did, th, item_id, offset, n_windows, first_word, n_slots): consistent matches by diagonal."""
    places = F.col("windows.doc_at")
    counted = F.size(F.array_distinct(places)).cast("long").alias("n_windows")
    return diagonals(prepared, items).select("did", "th", "item_id", "offset", counted, F.array_min(places).alias("first_word"), "n_slots")


def _held(n: int, diagonals: list[dict]) -> bool:
    """Whether some stretch of a document, of twice the item's length, holds enough of the item's ``n`` windows."""
    span = 2 * (n + WINDOW - 1)
    share = math.ceil(LEAST_SHARE * n)
    for exact, least in ((True, share), (False, max(LEAST_RUN, share))):
        places = sorted((w["doc_at"], w["doc_at"] - d["offset"]) for d in diagonals for w in d["windows"] if w["exact"] or not exact)
        inside: Counter[int] = Counter()
        tail = 0
        for at, own in places:
            inside[own] += 1
            while places[tail][0] < at - span:
                gone = places[tail][1]
                inside[gone] -= 1
                if not inside[gone]:
                    del inside[gone]
                tail += 1
            if len(inside) >= least:
                return True
    return False


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_windows, n_slots, first_word): per document and item, its longest consistent match."""
    found = matches(keyed(docs, id_col, text_col), items)
    best = F.max_by(F.struct("n_windows", "n_slots", "first_word"), F.struct("n_windows", -F.col("first_word"))).alias("b")
    found = found.groupBy("did", "th", "item_id").agg(best)
    return found.select(F.when(F.col("did") != FIRST_ID, F.col("did")).alias("doc_id"), F.when(F.col("item_id") != FIRST_ID, F.col("item_id")).alias("item_id"), "b.*")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that do not hold ``LEAST_SHARE`` of an item."""
    prepared = keyed(docs, id_col, text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [_held(n, found) for n, found in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select([0, 1]).filter(pa.array(held, pa.bool_()))

    found = diagonals(prepared, items).groupBy("did", "th", "item_id")
    found = found.agg(F.max("n").alias("n"), F.collect_list(F.struct("offset", "windows")).alias("found"))
    found = found.select("did", "th", "n", "found").mapInArrow(judge, "did long, th long").distinct()
    left = prepared.join(found, (prepared["did"] == found["did"]) & prepared["th"].eqNullSafe(found["th"]), "left_anti")
    return unpacked(left, docs.columns)
