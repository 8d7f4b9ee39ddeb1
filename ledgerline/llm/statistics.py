"""Statistics of whole texts, counted by numpy over their bytes; a null text counts as an empty one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.shared import keyed, with_row
from ledgerline.llm.words import Words, mix, range_hashes, slices, split

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_chars", "n_lines", "n_upper", "n_lower", "n_digits", "n_marks", "n_ends", "n_distinct", "n_single", "longest",
)


def _table(chars: str) -> np.ndarray:
    known = np.zeros(256, bool)
    known[np.frombuffer(chars.encode(), np.uint8)] = True
    return known


_SYMBOLS, _MARKS, _ENDS = _table("#*$%&|<>"), _table("!?"), _table(".:;,")
_UPPER, _LOWER, _DIGITS = (_table("".join(map(chr, range(ord(a), ord(b) + 1)))) for a, b in ("AZ", "az", "09"))
_LEADS = np.ones(256, bool)  # the first byte of each code point
_LEADS[0x80:0xC0] = False


def salted(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one text."""
    return mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def repeated(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are there twice or more, and which of them have come before."""
    order = np.argsort(hashes, kind="stable")
    equal = hashes[order][1:] == hashes[order][:-1]
    often, again = np.zeros(len(hashes), bool), np.zeros(len(hashes), bool)
    often[order[1:]] = equal
    again[order[1:]] = equal
    often[order[:-1]] |= equal
    return often, again


def covered(words: Words, begin: np.ndarray, size: int) -> np.ndarray:
    """Which words are in a window of ``size`` words that starts at one of ``begin``."""
    edge = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + size, -1)
    return np.cumsum(edge)[:-1] > 0


def count_texts(column: pa.Array) -> dict[str, np.ndarray]:
    words = split(column)
    data, limits, texts = words.data, words.limits, len(words.counts)

    def between(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(flags, dtype=np.int64))
        return total[edges[1:]] - total[edges[:-1]]

    lead = np.append(0, np.cumsum(_LEADS[data], dtype=np.int64))
    word_sizes = lead[words.ends] - lead[words.starts]
    owner = words.text_of_words()
    hashes = words.hashes()

    begin, of = words.windows(3)
    often, _ = repeated(salted(range_hashes(hashes, begin, begin + 3), of))
    repeat_words = between(covered(words, begin[often], 3), words.first)
    _, again = repeated(salted(hashes, owner))

    newline = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate([limits[:-1], newline + 1]), kind="stable")
    ends = np.sort(np.concatenate([newline, limits[1:]]), kind="stable")
    # Where a text ends with a line break, its last line is empty and begins where the next text does.
    line_text = np.sort(np.concatenate([np.arange(texts), np.searchsorted(limits, newline, "right") - 1]), kind="stable")
    inside = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends, line_text = starts[inside], ends[inside], line_text[inside]
    _, line_again = repeated(salted(range_hashes(data, starts, ends, 1), line_text))

    longest = np.zeros(texts, np.int64)
    np.maximum.at(longest, owner, word_sizes)
    counts = words.counts
    return {
        "n_words": counts,
        "word_chars": np.bincount(owner, word_sizes, texts).astype(np.int64),
        "n_symbols": between(_SYMBOLS[data], limits),
        "n_dup_lines": np.bincount(line_text[line_again], minlength=texts),
        "n_repeat_words": repeat_words,
        "n_chars": between(_LEADS[data], limits),
        "n_lines": np.bincount(line_text, minlength=texts),
        "n_upper": between(_UPPER[data], limits),
        "n_lower": between(_LOWER[data], limits),
        "n_digits": between(_DIGITS[data], limits),
        "n_marks": between(_MARKS[data], limits),
        "n_ends": between(_ENDS[data], limits),
        "n_distinct": counts - np.bincount(owner[again], minlength=texts),
        "n_single": np.bincount(owner[word_sizes == 1], minlength=texts),
        "longest": longest,
    }


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and the counts of every row."""
    prepared = keyed(docs, id_col, text_col)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            counts = count_texts(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(counts[name], pa.int64()) for name in COUNTS)], ["row", *COUNTS]
            )

    schema = with_row(prepared, ", ".join(f"{name} long" for name in COUNTS))
    return prepared.select("row", "text").mapInArrow(compute, schema)


def features() -> dict[str, F.Column]:
    """Shares and means over the counts: what the learned rules put thresholds on."""

    def per(count: str, whole: str) -> F.Column:
        return F.col(count) / F.greatest(F.col(whole), F.lit(1))

    return {
        "words": F.col("n_words").cast("double"),
        "word_length": per("word_chars", "n_words"),
        "longest": F.col("longest").cast("double"),
        "symbols": per("n_symbols", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"),
        "line_words": per("n_words", "n_lines"),
        "upper": F.col("n_upper") / F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1)),
        "digits": per("n_digits", "n_chars"),
        "marks": per("n_marks", "n_words"),
        "ends": per("n_ends", "n_words"),
        "distinct": per("n_distinct", "n_words"),
        "single": per("n_single", "n_words"),
    }


# ---------------------------------------------------------------- labelled sample


def held_out(id_col: str = "doc_id") -> F.Column:
    """Rows that are never learned from: a fifth, by a checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> tuple[list[str], list, list]:
    """Feature names, feature rows and 0/1 labels of about ``rows`` labelled documents that are not held out.

    The sample is a share of the ids by hash; with at most ``rows`` labels it is all of them.
    """
    known = labels.filter(F.col(label).isin(0, 1) & ~held_out() & F.col("doc_id").isNotNull())
    # An id with repeated labels counts once with each.
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).distinct()
    count = known.count()
    if count > rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(rows / count * (1 << 20)))
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    wanted = features()
    counted = text_statistics(chosen).select("row.label", *[c.alias(name) for name, c in wanted.items()])
    found = counted.toArrow()
    names = list(wanted)
    matrix = np.column_stack([found[name].to_numpy() for name in names]) if found.num_rows else np.zeros((0, len(names)))
    order = np.lexsort([*matrix.T, found["label"].to_numpy()])  # the same order whatever the partitions
    return names, matrix[order], found["label"].to_numpy()[order]


def condition(rule: tuple[tuple[int, float, bool], ...], columns: list[F.Column]) -> F.Column:
    """A conjunction of (feature, threshold, above) as a Spark expression."""
    parts = [columns[f] > threshold if above else columns[f] <= threshold for f, threshold, above in rule]
    result = parts[0]
    for part in parts[1:]:
        result = result & part
    return result


def holds(rule: tuple[tuple[int, float, bool], ...], matrix: np.ndarray) -> np.ndarray:
    """The same conjunction over a matrix of features."""
    result = np.ones(len(matrix), bool)
    for f, threshold, above in rule:
        result &= matrix[:, f] > threshold if above else matrix[:, f] <= threshold
    return result
