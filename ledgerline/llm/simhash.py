"""SimHash near-dedup: exact pairs of 64-bit fingerprints at a small Hamming distance, by vantage-point trees.

A fingerprint has a bit set if the XXH64 (seed 42) of over half of the text's shingles has it. Fingerprints at
``max_bits`` or fewer differing bits are linked, and a component is everything reachable by links.

The search for pairs:

* The 64 bits are cut into segments, each with a radius, so that the sum of (radius + 1) is ``max_bits + 1``: of any
  pair in reach, at least one segment differs by no more than its radius.
* Every segment has a vantage-point tree. A level has a vantage point and its median distance to all fingerprints; the
  distance counts differing bits of the segment (for radius 0: of an odd number of them), and obeys the triangle
  inequality. A fingerprint is at home in one leaf, and is sent as a query to every leaf that its ball of the segment's
  radius reaches; the triangle bound prunes all others. So a pair in reach meets in the home leaf of one of the two.
* A leaf is one group: it compares its rows with the ones at home and gives each linked row the smallest fingerprint
  of its component in the leaf: as many rows as there are members, never all pairs. Large leaves are split in
  blocks; each pair of blocks is a group of its own.
* Equal fingerprints are one row from the start. Components are joined by large-star and small-star rounds, each
  written as a checkpoint.

Nulls, ties, repeats: a null or empty text has fingerprint zero, linked like any other; repeated rows are returned as
often as they come; a null id counts in no minimum (a component of nothing else has a null id).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import checkpointed, keyed, unpacked
from ledgerline.llm.words import mix, range_hashes, slices, split

SEED = 42
SEGMENTS = ((0, 23, 1), (23, 23, 1), (46, 18, 0))  # first bit, bits, radius: reach of 4 bits
LEAF_ROWS = 256
BLOCK_ROWS = 8192
SLICE = 1 << 18
ROUND_ROWS = 1 << 16


# ---------------------------------------------------------------- fingerprints


def majority(hashes: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
    """For each text, the bits that over half of its hashes have; owners are in order, a text without hashes has 0."""
    result = np.zeros(texts, np.uint64)
    if len(owners):
        new = np.flatnonzero(np.append(True, owners[1:] != owners[:-1]))
        sizes = np.diff(np.append(new, len(owners)))
        value = np.zeros(len(new), np.uint64)
        for bit in range(64):
            b = np.uint64(bit)
            ones = np.add.reduceat((hashes >> b) & np.uint64(1), new)
            value |= (2 * ones.astype(np.int64) > sizes).astype(np.uint64) << b
        result[owners[new]] = value
    return result


def fingerprints_of(column: pa.Array, shingle_words: int) -> np.ndarray:
    """Fingerprint of each text, as signed 64-bit integers."""
    words = split(column)
    words.data = np.where((words.data >= 65) & (words.data <= 90), words.data + 32, words.data).astype(np.uint8)
    joined, starts, ends = words.joined()
    counts = words.counts
    begin, owner = words.windows(shingle_words)
    short = np.flatnonzero((counts > 0) & (counts < shingle_words))
    firsts = np.concatenate([begin, words.first[:-1][short]])
    lasts = np.concatenate([begin + shingle_words, words.first[1:][short]]) - 1
    owners = np.concatenate([owner, short])
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    ranges = zip(starts[firsts].tolist(), ends[lasts].tolist())
    hashes = np.fromiter((digest(raw[s:e], SEED) for s, e in ranges), np.uint64, len(firsts))
    order = np.argsort(owners, kind="stable") if len(short) else slice(None)
    hashes, owners = hashes[order], owners[order]
    return majority(hashes, owners, len(counts)).view(np.int64)


def fingerprints(docs: DataFrame, shingle_words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            fp = pa.array(fingerprints_of(part.column(1), shingle_words))
            yield pa.RecordBatch.from_arrays([part.column(0), fp], ["doc_id", "fp"])

    wanted = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return wanted.mapInArrow(compute, "doc_id long, fp long")


# ---------------------------------------------------------------- vantage-point trees


def vantage_points(levels: int, segments=SEGMENTS) -> list[list[tuple[int, int]]]:
    """For each tree and level: vantage point and the mask of the bits that count; the same in every run."""
    rng = np.random.default_rng(64)
    trees = []
    for low, width, radius in segments:
        points = []
        for _ in range(min(levels, width)):
            odd = width if radius else width // 2 | 1
            bits = low + rng.permutation(width)[:odd]
            mask = sum(1 << int(b) for b in bits)
            points.append((int(rng.integers(0, 1 << 63)) << 1 & mask, mask))
        trees.append(points)
    return trees


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _median_distances(fps: DataFrame, trees) -> list[list[int]]:
    """Of every tree and level, the median distance of all fingerprints to the vantage point: a single row."""
    wanted = []
    for t, points in enumerate(trees):
        for level, (vantage, mask) in enumerate(points):
            differing = F.col("fp").bitwiseXOR(F.lit(_signed(vantage))).bitwiseAND(F.lit(_signed(mask)))
            wanted.append(F.percentile_approx(F.bit_count(differing), 0.5, 1000).alias(f"m{t}_{level}"))
    row = fps.agg(*wanted).first() if wanted else {}
    return [[row[f"m{t}_{level}"] for level in range(len(points))] for t, points in enumerate(trees)]


def leaf_rows(fps: np.ndarray, points, medians, radius: int, everywhere: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and leaves: the home leaf of each fingerprint, or all leaves that its ball reaches."""
    rows, leaves = np.arange(len(fps)), np.zeros(len(fps), np.int64)
    for level, ((vantage, mask), median) in enumerate(zip(points, medians)):
        distance = np.bitwise_count((fps ^ np.uint64(vantage)) & np.uint64(mask)).astype(np.int64)[rows]
        reach = radius if everywhere else 0
        inner, outer = distance - reach <= median, distance + reach > median
        rows = np.concatenate([rows[inner], rows[outer]])
        leaves = np.concatenate([leaves[inner], leaves[outer] | (1 << level)])
    return rows, leaves


def local_components(rows: dict[str, np.ndarray], max_bits: int, side_bits: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Of one leaf, the ids of linked rows and the smallest id of each one's component; lone ones are left out.

    Rows are linked if their fingerprints, and their side fingerprints if ``side_bits`` is given, are near.
    """
    fp, ids, home = rows["fp"].view(np.uint64), rows["id"], rows["home"]
    sides = [rows["s1"].view(np.uint64), rows["s2"].view(np.uint64)]

    def agree(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if side_bits is None:
            return np.ones(len(b), bool)
        differing = [np.bitwise_count(side[a] ^ side[b]).astype(np.int64) for side in sides]
        return differing[0] + differing[1] <= side_bits

    at_home = np.flatnonzero(home)
    size = max(1, (1 << 20) // max(1, len(at_home)))
    candidates = np.zeros(len(fp), bool)
    for at in range(0, len(fp), size):
        near = np.bitwise_count(fp[at : at + size, None] ^ fp[at_home][None, :]) <= max_bits
        a, b = np.nonzero(near)
        a, b = a + at, at_home[b]
        a, b = a[a != b], b[a != b]
        good = agree(a, b)
        candidates[a[good]] = candidates[b[good]] = True
    waiting = np.flatnonzero(candidates)
    found_ids, labels = [], []
    while len(waiting):
        members, frontier, waiting = [], waiting[:1], waiting[1:]
        while len(frontier):
            members.append(frontier)
            reached = np.zeros(len(waiting), bool)
            for one in frontier:
                near = np.flatnonzero((np.bitwise_count(fp[waiting] ^ fp[one]) <= max_bits) & ~reached)
                reached[near[agree(np.full(len(near), one), waiting[near])]] = True
            frontier, waiting = waiting[reached], waiting[~reached]
        found = ids[np.concatenate(members)]
        found_ids.append(found)
        labels.append(np.full(len(found), found.min()))
    empty = np.zeros(0, np.int64)
    return np.concatenate([empty, *found_ids]), np.concatenate([empty, *labels])


def links(
    fps: DataFrame,
    max_bits: int = 4,
    segments=SEGMENTS,
    leaf_size: int = LEAF_ROWS,
    block: int = BLOCK_ROWS,
    side_bits: int | None = None,
) -> DataFrame:
    """Of rows (fp, id, s1, s2) with different ids: (id, label) rows that join all that are linked, and no others.

    With ``side_bits``, linked rows must also differ in no more bits of ``s1`` and ``s2`` together.
    """
    if sum(radius + 1 for _, _, radius in segments) < max_bits + 1:
        raise ValueError("the segments' radii do not reach max_bits")
    count = fps.count()
    levels = max(0, math.ceil(math.log2(max(1, count) / leaf_size)))
    trees = vantage_points(levels, segments)
    medians = _median_distances(fps, trees) if count else [[0] * len(p) for p in trees]
    radii = [radius for _, _, radius in segments]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            others = [batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3)]
            for t, (points, middle) in enumerate(zip(trees, medians)):
                for everywhere in (False, True) if radii[t] else (False,):
                    for at in range(0, len(values), 4096):
                        part = values[at : at + 4096]
                        rows, leaves = leaf_rows(part, points, middle, radii[t], everywhere)
                        if everywhere:
                            own = np.empty(len(part), np.int64)
                            np.put(own, *leaf_rows(part, points, middle, 0, False))
                            away = leaves != own[rows]
                            rows, leaves = rows[away], leaves[away]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(len(rows), t, np.int32)),
                                pa.array(leaves),
                                pa.array(np.full(len(rows), not everywhere)),
                                pa.array(part[rows].view(np.int64)),
                                *(pa.array(other[at + rows], pa.int64()) for other in others),
                            ],
                            ["tree", "leaf", "home", "fp", "id", "s1", "s2"],
                        )

    carried = ("home", "fp", "id", "s1", "s2")
    schema = "tree int, leaf long, home boolean, fp long, id long, s1 long, s2 long"
    dealt = fps.select("fp", "id", "s1", "s2").mapInArrow(deal, schema)
    large = dealt.groupBy("tree", "leaf").count().filter(F.col("count") > block)
    large = large.select("tree", "leaf", F.ceil(F.col("count") / block).cast("int").alias("k"))
    parted = dealt.join(large, ["tree", "leaf"], "left").withColumn("k", F.coalesce("k", F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("k")).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), F.col("k") - 1),
        lambda other: F.struct(F.least(own, other).alias("i"), F.greatest(own, other).alias("j")),
    )
    blocks = parted.select("tree", "leaf", F.explode(pair).alias("pair"), *carried)
    blocks = blocks.select("tree", "leaf", "pair.i", "pair.j", *carried)

    def search(group: pa.Table) -> pa.Table:
        rows = {name: group[name].to_numpy(zero_copy_only=False) for name in carried}
        found, label = local_components(rows, max_bits, side_bits)
        return pa.table({"id": pa.array(found, pa.int64()), "label": pa.array(label, pa.int64())})

    return blocks.groupBy("tree", "leaf", "i", "j").applyInArrow(search, "id long, label long")


# ---------------------------------------------------------------- components


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each component, of (u, v) edges; rounds of large-star and small-star.

    A round's rows lie in as many partitions as they fill: the driver holds, sends and records every task of a round.
    """
    edges = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = checkpointed(edges.distinct())
    state = _state(edges)
    while True:
        # A round makes a row for each edge and each node at most.
        parts = max(1, math.ceil(2 * state[0] / ROUND_ROWS))
        edges = edges.coalesce(parts)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct().coalesce(parts)
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(smallest, "u")
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).union(smallest.select("u", F.col("m").alias("v")))
        edges = checkpointed(small.filter("u <> v").distinct().coalesce(parts))
        now = _state(edges)
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
        state = now


def relabelled(labels: DataFrame, joins: DataFrame) -> DataFrame:
    """(node, label) rows of :func:`components` after edges between labels have joined some of their components; nodes that
    were in none may be joined too. Only the labels' own graph, the smaller one, is searched again."""
    tops = components(joins)
    renamed = tops.select(F.col("node").alias("label"), F.col("label").alias("top"))
    return labels.join(renamed, "label", "left").select("node", F.coalesce("top", "label").alias("label")).union(tops)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def linked_prints(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """(fp, first_id, label) of every fingerprint of (doc_id, fp) rows: label is the least fingerprint reachable by links."""
    firsts = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    none = F.lit(0).cast("long")
    found = links(firsts.select("fp", F.col("fp").alias("id"), none.alias("s1"), none.alias("s2")), max_bits)
    labels = components(found.select(F.col("id").alias("u"), F.col("label").alias("v")))
    labelled = firsts.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    return labelled.select("fp", "first_id", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, shingle_words: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text"):
    """(doc_id, fingerprint, component_id, fp) of every row of ``docs``; component_id is the smallest id reachable."""
    prints = checkpointed(fingerprints(docs, shingle_words, id_col, text_col))
    labelled = linked_prints(prints, max_bits)
    least = labelled.groupBy("label").agg(F.min("first_id").alias("component_id"))
    classes = labelled.join(least, "label").select("fp", "component_id")
    text = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return prints.join(classes, "fp", "left").select("doc_id", text.alias("fingerprint"), "component_id", "fp")


# ---------------------------------------------------------------- near copies of 0.8 or more

STAGE_SHINGLE = 5
PRINT_SHINGLE = 4
SIMILARITY = 0.8
BANDS = 20
BAND_ROWS = 6  # a pair of similarity s shares a bucket with probability 1 - (1 - s^6)^20: 0.998 at 0.8
GROUP_SHINGLES = 1 << 16
BITMAP_SLOTS = 1 << 21
_SEEDS = np.random.default_rng(5).integers(0, 1 << 63, (2, BANDS * BAND_ROWS), np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of five words (a shorter text is one), ascending in each text, and their limits."""
    words = split(column)
    words.data = np.where((words.data >= 65) & (words.data <= 90), words.data + 32, words.data).astype(np.uint8)
    counts, owner, hashes = words.counts, words.text_of_words(), words.hashes()
    sizes = np.minimum(STAGE_SHINGLE, np.repeat(counts, counts))
    at = np.arange(len(owner))
    full = at + sizes <= words.first[1:][owner] if len(owner) else np.zeros(0, bool)
    begin, owner = at[full], owner[full]
    shingles = range_hashes(hashes, begin, begin + sizes[full])
    order = np.lexsort([shingles, owner])
    shingles, owner = shingles[order], owner[order]
    new = np.append(True, (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1]))[: len(owner)]
    return shingles[new], np.searchsorted(owner[new], np.arange(len(counts) + 1))


def band_keys(shingles: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Of each text that has shingles, a key for every band: a hash of the band's ``BAND_ROWS`` minima."""
    firsts = limits[:-1][limits[:-1] < limits[1:]]
    keys = np.zeros((len(firsts), BANDS), np.uint64)
    for band in range(BANDS if len(firsts) else 0):
        keys[:, band] = band
        for row in range(band * BAND_ROWS, (band + 1) * BAND_ROWS):
            least = np.minimum.reduceat((shingles ^ _SEEDS[0, row]) * _SEEDS[1, row], firsts)
            keys[:, band] = mix(keys[:, band] * np.uint64(0x9E3779B97F4A7C15) + least)
    return keys


def set_prints(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(did, th, fp, size, h1, h2, keys): a text's fingerprint, number and two hashes of its set of shingles, keys by band."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", SLICE):
            shingles, limits = shingle_sets(part.column(2))
            sizes = np.diff(limits)
            some = sizes > 0
            sums = [np.zeros(len(sizes), np.uint64) for _ in range(2)]
            for total, salt in zip(sums, (1, 2)):
                if some.any():
                    total[some] = np.add.reduceat(mix(shingles + np.uint64(salt)), limits[:-1][some])
            keys = pa.array(band_keys(shingles, limits).view(np.int64).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(some * BANDS)).astype(np.int32)), keys)
            fp = pa.array(fingerprints_of(part.column(2), PRINT_SHINGLE))
            columns = [part.column(0), part.column(1), fp, pa.array(sizes, pa.int64()), *(pa.array(x.view(np.int64)) for x in sums), lists]
            yield pa.RecordBatch.from_arrays(columns, ["did", "th", "fp", "size", "h1", "h2", "keys"])

    wanted = keyed(docs, id_col, text_col).select("did", "th", "text")
    return wanted.mapInArrow(compute, "did long, th long, fp long, size long, h1 long, h2 long, keys array<long>")


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, hashes) of the ``wanted`` (node, did, th): a text's shingle hashes, ascending.

    A bitmap of fixed size over the wanted texts' hashes drops most other texts before the shuffle, and no wanted one.
    """
    slot = F.pmod(F.col("th"), F.lit(BITMAP_SLOTS)).cast("int").alias("slot")
    bits = np.zeros(BITMAP_SLOTS, np.uint8)
    bits[wanted.filter("th IS NOT NULL").select(slot).distinct().toArrow()["slot"].to_numpy()] = 1
    bitmap = docs.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = np.frombuffer(bitmap.value, np.uint8)
        for part in slices(batches, "text", SLICE):
            place = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64) % BITMAP_SLOTS
            hit = (known[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            part = pa.Table.from_batches([part]).filter(pa.array(hit)).combine_chunks()
            shingles, limits = shingle_sets(part["text"])
            hashes = pa.array([shingles[a:b].tobytes() for a, b in zip(limits[:-1], limits[1:])], pa.binary())
            columns = [part["did"].combine_chunks(), part["th"].combine_chunks(), hashes]
            yield pa.RecordBatch.from_arrays(columns, ["did", "th", "hashes"])

    texts = keyed(docs, id_col, text_col).select("did", "th", "text").filter("text IS NOT NULL")
    found = texts.mapInArrow(compute, "did long, th long, hashes binary")
    return found.join(wanted, ["did", "th"]).dropDuplicates(["did", "th"]).select("node", "hashes")


def similar(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The (u, v) pairs of nodes whose sets have a Jaccard similarity of ``similarity`` or more."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for at in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(i)[at].as_buffer(), np.uint64) for i in (2, 3))
                if min(len(a), len(b)) >= similarity * max(len(a), len(b)):
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    good[at] = both / (len(a) + len(b) - both) >= similarity
            yield batch.select([0, 1]).filter(pa.array(good))

    first = sets.select(F.col("node").alias("u"), F.col("hashes").alias("a"))
    second = sets.select(F.col("node").alias("v"), F.col("hashes").alias("b"))
    met = pairs.join(first, "u").join(second, "v").select("u", "v", "a", "b")
    return met.mapInArrow(decide, "u long, v long")


def joined_labels(rows: dict[str, np.ndarray], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Of one group, the pairs of labels that a similar pair joins; one of the pair must be ``seeking``."""
    limits = np.append(0, np.cumsum([len(s) for s in sets]))
    different, symbols = np.unique(np.concatenate(sets), return_inverse=True)
    symbols, sizes = symbols.ravel(), np.diff(limits)
    _, labels = np.unique(rows["label"], return_inverse=True)
    names, current = rows["label"], labels.ravel().copy()
    marked = np.zeros(len(different), bool)
    found = []
    for one in np.flatnonzero(rows["seeking"]):
        fits = np.minimum(sizes, sizes[one]) >= similarity * np.maximum(sizes, sizes[one])
        others = np.flatnonzero((current != current[one]) & fits)
        if not len(others):
            continue
        own = symbols[limits[one] : limits[one + 1]]
        marked[own] = True
        starts = np.append(0, np.cumsum(sizes[others]))
        places = np.arange(starts[-1]) + np.repeat(limits[:-1][others] - starts[:-1], sizes[others])
        both = np.add.reduceat(marked[symbols[places]].astype(np.int64), starts[:-1])
        marked[own] = False
        for other in others[both / (sizes[others] + sizes[one] - both) >= similarity]:
            if current[other] != current[one]:
                found.append((int(names[one]), int(names[other])))
                current[current == current[other]] = current[one]
    return found


def remaining(met: DataFrame, labels: DataFrame, sets: DataFrame, similarity: float, block: int) -> DataFrame:
    """(u, v): labels that a similar pair within a bucket joins, of (key, node, size) rows that the stars left apart.

    Only pairs of different labels are compared. Where a bucket is large, the rows of its largest label, among which
    nothing is left to compare, are cut into blocks, the others too, and each of the others' blocks meets all blocks.
    """
    rows = met.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sums = rows.groupBy("key", "label").agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    sums = sums.groupBy("key").agg(
        F.max_by("label", F.struct("w", "label")).alias("main"), F.max("w").alias("main_w"), F.sum("w").alias("w"),
        F.sum("n").alias("n"), F.count("*").alias("labels"),
    )
    # In a bucket of two, the star was the only pair.
    open_ = sums.filter("labels > 1 AND n > 2").select(
        "key", "main",
        F.when(F.col("w") <= block, 0).otherwise(F.ceil(F.col("main_w") / block)).cast("int").alias("mains"),
        F.when(F.col("w") <= block, 1).otherwise(F.ceil((F.col("w") - F.col("main_w")) / block)).cast("int").alias("others"),
    )
    rows = rows.join(open_, "key")
    main = (F.col("label") == F.col("main")) & (F.col("mains") > 0)
    own = F.pmod(F.xxhash64("node"), F.when(main, F.col("mains")).otherwise(F.col("others"))).cast("int")
    rows = rows.select("key", "node", "label", "mains", "others", main.alias("in_main"), own.alias("own"))
    last = F.col("others") - 1

    def cell(i, j):
        return F.struct(F.least(i, j).cast("int").alias("i"), F.greatest(i, j).cast("int").alias("j"))

    # The others' blocks are 0 to others - 1, those of the largest label come after them.
    with_others = F.transform(F.sequence(F.lit(0), last), lambda i: cell(i, F.col("own")))
    with_mains = F.transform(F.sequence(F.lit(1), F.col("mains")), lambda j: cell(F.col("own"), last + j))
    of_main = F.transform(F.sequence(F.lit(0), last), lambda i: cell(i, F.col("others") + F.col("own")))
    none = F.slice(with_others, 1, 0)
    cells = F.when(F.col("in_main"), of_main).otherwise(F.concat(with_others, F.when(F.col("mains") > 0, with_mains).otherwise(none)))
    dealt = rows.select("key", "node", "label", F.explode(cells).alias("cell"), (~F.col("in_main")).alias("seeking"))
    dealt = dealt.select("key", "cell.i", "cell.j", "node", "label", "seeking").join(sets, "node")

    def search(group: pa.Table) -> pa.Table:
        found = joined_labels(
            {name: group[name].to_numpy(zero_copy_only=False) for name in ("label", "seeking")},
            [np.frombuffer(x.as_buffer(), np.uint64) for x in group["hashes"]],
            similarity,
        )
        u, v = zip(*found) if found else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    dealt = dealt.select("key", "i", "j", "label", "seeking", "hashes")
    return dealt.groupBy("key", "i", "j").applyInArrow(search, "u long, v long")


def without_near_copies(
    docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", block: int = GROUP_SHINGLES
) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; all columns stay.

    Texts are linked if the Jaccard similarity of their sets of five-word shingles is ``similarity`` or more, which is
    decided on the sets. Compared are the texts whose fingerprints the vantage-point trees link to one component, and
    those that share a bucket of one of ``BANDS`` bands of minhashes, as texts of that similarity often differ in more bits
    than the trees reach: in each such group first each with its least, then those that this has not joined with each
    other. Groups of copies are everything reachable by links. Texts with equal sets are one from the start. Rows that
    share the smallest id stay.
    """
    prints = checkpointed(set_prints(docs, id_col, text_col))
    own = ["size", "h1", "h2"]
    firsts = F.min(F.struct("did", "th")).alias("one")
    # Sets are equal if their sizes and both hashes are; the node is only a short name for the three.
    classes = prints.groupBy(*own).agg(firsts, F.first("keys").alias("keys"))
    classes = checkpointed(classes.withColumn("node", F.monotonically_increasing_id()))
    linked = checkpointed(linked_prints(prints.select(F.col("did").alias("doc_id"), "fp"))).select("fp", "label")
    by_print = prints.filter("size > 0").select(*own, "fp").distinct().join(linked, "fp").select(*own, "label").distinct()
    by_print = by_print.join(classes.select(*own, "node"), own).select(F.xxhash64(F.lit("fp"), "label").alias("key"), "node", "size")
    rows = classes.select(F.explode("keys").alias("key"), "node", "size").unionByName(by_print)
    shared = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least")).filter("n > 1").drop("n")
    met = checkpointed(rows.join(shared, "key"))
    wanted = classes.join(met.select("node").distinct(), "node", "left_semi").select("node", "one.did", "one.th")
    sets = checkpointed(sets_of(docs, checkpointed(wanted), id_col, text_col))
    stars = met.filter("node <> least").select(F.col("node").alias("u"), F.col("least").alias("v")).distinct()
    edges = checkpointed(similar(stars, sets, similarity))
    labels = components(edges)
    rest = checkpointed(remaining(met.drop("least"), labels, sets, similarity, block))
    if not rest.isEmpty():
        labels = relabelled(labels, rest)
    labelled = classes.join(labels, "node", "left").select(*own, "one.did", F.coalesce("label", "node").alias("label"))
    least = labelled.groupBy("label").agg(F.min("did").alias("stays"))
    fates = labelled.join(least, "label").select(*own, "stays")
    gone = prints.join(fates, own).filter("did <> stays").select("did", "th").distinct()
    left = keyed(docs, id_col, text_col).join(gone, ["did", "th"], "left_anti")
    return unpacked(left, docs.columns)
