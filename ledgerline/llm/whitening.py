"""Embedding whitening by spectrum slicing: the leading principal components of all distinct vectors, certified by counts.

Vectors become whole numbers, so counts, sums and products of the fit list (each distinct vector once) are exact and do
not depend on how Spark deals or repeats tasks. Spark finds the distinct vectors (by their packed bytes, combined before
the shuffle, so that a vector that most rows share is one row), adds up products and measures the result; only tables
whose size follows from the dimension reach the driver. There LDL' inertia counts of the shifted covariance isolate each
leading eigenvalue, Rayleigh quotient iteration refines it, and counts on both sides certify its number.

Defined results. A null vector, or one with null or non-finite entries, is left out; so is one whose dimension is not
that of most distinct vectors (ties: the greater dimension). Repeated rows are all returned and count once in the fit. A
null id is kept. Eigenvalues below ``LEAST_SHARE`` of the first cannot be told from rounding and give no component, so a
table without two different vectors gives no rows; nor does an empty one. Equal eigenvalues give any orthonormal
basis of their space, the same for all rows. Scaled entries beyond 2^52 are held there. Other columns are not read.
A deviation that does not fit a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructField, StructType

from ledgerline.llm.shared import checkpointed

SCALE = 64
OFFSET = 1_000_000
LIMIT = float(1 << 52)
COMPONENTS = 16
LEAST_SHARE = 1e-11
EXACT_FLOAT = 1 << 53
EXACT_LONG = 1 << 62
OUT_ROWS = 2_000
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)


# ------------------------------------------------------------------ vectors of a batch


def whole_numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled entries less the offset of all usable vectors in a row, the dimension of each, and their row numbers."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    bad = np.append(0, np.cumsum(~np.isfinite(flat)))
    ends = np.cumsum(sizes)
    usable = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - sizes])
    entries = flat[np.repeat(usable, sizes)]
    scaled = np.floor(np.clip(SCALE * entries, -LIMIT, LIMIT)).astype(np.int64)
    return scaled, sizes[usable], np.flatnonzero(usable)


def packed(scaled: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Each vector as bytes of the least width that holds it, after one byte that names the width."""
    limits = np.append(0, np.cumsum(sizes))
    result = []
    for begin, end in zip(limits.tolist(), limits[1:].tolist()):
        vector = scaled[begin:end]
        low, high = (int(vector.min()), int(vector.max())) if end > begin else (0, 0)
        code = next(i for i, w in enumerate(_WIDTHS) if np.iinfo(w).min <= low and high <= np.iinfo(w).max)
        result.append(bytes([code]) + vector.astype(_WIDTHS[code]).tobytes())
    return result


def unpacked_vectors(column: pa.Array, dimension: int) -> np.ndarray:
    rows = np.empty((len(column), dimension), np.int64)
    for i, value in enumerate(column.to_pylist()):
        rows[i] = np.frombuffer(value, _WIDTHS[value[0]], dimension, 1)
    return rows


def exact_product(rows: np.ndarray) -> np.ndarray:
    """Sum of the outer products of whole-number rows, exact; as Python numbers where a long would overflow."""
    top = max(abs(int(rows.max())), abs(int(rows.min()))) if rows.size else 0
    if top * top * len(rows) < EXACT_FLOAT:
        as_float = rows.astype(np.float64)
        return (as_float.T @ as_float).astype(np.int64)
    if top * top * len(rows) < EXACT_LONG:
        return rows.T @ rows
    as_number = rows.astype(object)
    return as_number.T @ as_number


# ------------------------------------------------------------------ spectrum slicing


def negative_pivots(matrix: np.ndarray) -> int:
    """Eigenvalues of a symmetric matrix below zero: the inertia of D in P A P' = L D L' (Bunch-Kaufman pivoting).

    By Sylvester's law D has as many negative eigenvalues as the matrix; a zero pivot counts as positive.
    """
    a = np.array(matrix, np.float64)
    n, at, negative = len(a), 0, 0
    alpha = (1 + 17**0.5) / 8
    tiny = np.finfo(np.float64).tiny
    while at < n:
        step = 1
        if at < n - 1:
            column = np.abs(a[at + 1 :, at])
            r = at + 1 + int(np.argmax(column))
            largest = column[r - at - 1]
            if largest > tiny and abs(a[at, at]) < alpha * largest:
                others = np.abs(a[r, at:])
                others[r - at] = 0
                if abs(a[at, at]) * others.max() < alpha * largest**2:
                    step = 1 if abs(a[r, r]) >= alpha * others.max() else 2
                    to = at + step - 1
                    if r != to:
                        a[[to, r]] = a[[r, to]]
                        a[:, [to, r]] = a[:, [r, to]]
        if step == 1:
            pivot = a[at, at]
            negative += pivot < 0
            if abs(pivot) > tiny and at < n - 1:
                below = a[at + 1 :, at].copy()
                a[at + 1 :, at + 1 :] -= np.outer(below / pivot, below)
        else:
            block = a[at : at + 2, at : at + 2]
            det = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0]
            negative += 1 if det < 0 else 2 * (block[0, 0] < 0)
            below = a[at + 2 :, at : at + 2].copy()
            if below.size:
                a[at + 2 :, at + 2 :] -= below @ np.linalg.solve(block, below.T)
        at += step
    return int(negative)


def above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues greater than ``shift``."""
    return negative_pivots(shift * np.eye(len(matrix)) - matrix)


def _isolated(matrix: np.ndarray, wanted: int, least: float) -> list[tuple[float, float, int, int]]:
    """Slices (low, high, eigenvalues above high, eigenvalues above low) with one eigenvalue, or several too near to
    be told apart, of the first ``wanted`` ones; eigenvalues up to ``least`` are not sought."""
    bound = float(np.abs(matrix).sum(axis=1).max()) * (1 + 1e-12)
    narrow = 4 * len(matrix) * np.finfo(np.float64).eps * bound
    found, todo = [], [(least, bound, 0, above(matrix, least))]
    while todo:
        low, high, over, total = todo.pop()
        if total == over or over >= wanted:
            continue
        if total - over == 1 or high - low <= narrow:
            found.append((low, high, over, total))
            continue
        middle = (low + high) / 2
        count = min(max(above(matrix, middle), over), total)
        todo += [(low, middle, count, total), (middle, high, over, count)]
    return sorted(found, key=lambda s: s[2])


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(matrix - shift * np.eye(len(matrix)), right)
    except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
        step = np.finfo(np.float64).eps * max(abs(shift), np.abs(matrix).max())
        return np.linalg.solve(matrix - (shift + step) * np.eye(len(matrix)), right)


def _halved(matrix: np.ndarray, low: float, high: float, over: int) -> tuple[float, float]:
    """The half of a slice that holds its one eigenvalue."""
    middle = (low + high) / 2
    return (low, middle) if above(matrix, middle) <= over else (middle, high)


def _iterated(
    matrix: np.ndarray, block: np.ndarray, found: np.ndarray, low: float, high: float, rounding: float
) -> tuple[bool, np.ndarray, np.ndarray]:
    """Whether the iteration from ``block`` settled in the slice, the quotients, falling, and their vectors as columns."""
    size, several = float(np.abs(matrix).sum(axis=1).max()), block.shape[1] > 1
    shift, settled = (low + high) / 2, False
    for turn in range(40 if several else 12):
        block = block - found.T @ (found @ block)
        block = np.linalg.qr(_solve(matrix, shift, block))[0]
        block = np.linalg.qr(block - found.T @ (found @ block))[0]
        inside = block.T @ matrix @ block
        rest = np.abs(matrix @ block - block @ inside).max()
        quotient = float(np.trace(inside)) / block.shape[1]
        # Cubic once near; a quotient outside the slice belongs to another eigenvalue and is not used as a shift.
        done = rest <= 8 * np.finfo(np.float64).eps * size and low <= quotient <= high
        settled = turn >= 2 and (done or high - low <= rounding)
        if settled:
            break
        if low < quotient < high:
            shift = quotient
    if several:  # one space: any basis, in falling order of the quotients
        inner, turned = np.linalg.eigh(inside)
        return True, inner[::-1], block @ turned[:, ::-1]
    return settled, np.array([quotient]), block


def leading(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows."""
    d = len(matrix)
    size = float(np.abs(matrix).sum(axis=1).max()) if d else 0.0
    if size == 0:
        return np.zeros(0), np.zeros((0, d))
    start = np.random.default_rng(13).standard_normal((d, d))
    margin = 64 * d * np.finfo(np.float64).eps * size
    rounding = max(1e-13, 4 * d * np.finfo(np.float64).eps) * size
    values, vectors = [], np.zeros((0, d))
    for low, high, over, total in _isolated(matrix, wanted, LEAST_SHARE * size):
        one = total - over == 1
        # A narrow slice first, so that the iteration starts next to its own eigenvalue only.
        while one and high - low > 1e-3 * max(abs(low), abs(high)):
            low, high = _halved(matrix, low, high, over)
        while True:
            settled, quotients, block = _iterated(matrix, start[:, : total - over], vectors, low, high, rounding)
            placed = above(matrix, min(quotients) - margin) >= total and above(matrix, max(quotients) + margin) <= over
            if settled and placed:
                break
            if not one or high - low <= rounding:
                raise ArithmeticError(f"eigenvalues {over + 1} to {total} are not where the counts place them")
            # The iteration went to a neighbour, which may be as near to the slice's middle as the eigenvalue itself
            # (many nearly equal ones, as of vectors in no preferred direction). Counts narrow the slice until it is not.
            for _ in range(4):
                low, high = _halved(matrix, low, high, over)
        values += list(quotients)
        vectors = np.vstack([vectors, block.T])
    return np.array(values[:wanted]), vectors[:wanted]


# ------------------------------------------------------------------ Spark jobs


@dataclass
class Whitening:
    """What the fit list taught: its size, exact sums, and the components; all of a size set by the dimension."""

    n: int
    sums: list[int]  # of the scaled entries without the offset
    eigenvalues: np.ndarray
    directions: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def centred(self, rows: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        top = max((abs(s) for s in self.sums), default=0)
        reach = max(abs(int(rows.max())), abs(int(rows.min()))) if rows.size else 0
        if self.n * reach + top < EXACT_LONG:
            return self.n * rows - np.array(self.sums, np.int64)
        return self.n * rows.astype(object) - np.array(self.sums, object)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        values = centred.astype(np.float64) / float(self.n)
        return values @ self.directions.T / np.sqrt(self.eigenvalues)


def deviations(centred: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None where it is no long."""
    top = max(abs(int(centred.max())), abs(int(centred.min()))) if centred.size else 0
    if top * top * centred.shape[1] < EXACT_LONG:
        return (centred.astype(np.int64) ** 2).sum(axis=1).tolist()
    found = [sum(v * v for v in map(int, row)) for row in centred.tolist()]
    return [v if v < 1 << 63 else None for v in found]


def _summed(entries: DataFrame) -> dict[tuple[int, int], int]:
    return {(r.i, r.j): int(r.v) for r in entries.groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}


def fit_list(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Every distinct vector once: (dimension, x), packed."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled, sizes, _ = whole_numbers(batch.column(0))
            columns = [pa.array(sizes, pa.int64()), pa.array(packed(scaled, sizes), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["dimension", "x"])

    given = vectors.select(F.col(f"`{vector_col}`").cast("array<double>").alias("v")).where("v IS NOT NULL")
    return given.mapInArrow(pack, "dimension long, x binary").distinct()


def fit(vectors: DataFrame, vector_col: str = "embedding", wanted: int = COMPONENTS) -> Whitening:
    distinct = checkpointed(fit_list(vectors, vector_col))
    sizes = distinct.groupBy("dimension").count().orderBy(F.desc("count"), F.desc("dimension")).limit(1).collect()
    n, d = (sizes[0]["count"], sizes[0]["dimension"]) if sizes else (0, 0)
    if not n or not d:
        return Whitening(n, [0] * d, np.zeros(0), np.zeros((0, d)), 0.0)
    fitted = distinct.where(F.col("dimension") == d).select("x")
    entry = StructType([*StructType.fromDDL("i int, j int").fields, StructField("v", DecimalType(38, 0))])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        return (unpacked_vectors(batch.column(0), d) for batch in batches if batch.num_rows)

    def entries(table: np.ndarray) -> pa.RecordBatch:
        i, j = np.nonzero(np.triu(np.ones((len(table), len(table)), bool)))
        numbers = pa.array([Decimal(int(v)) for v in table[i, j].tolist()], pa.decimal128(38, 0))
        return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), numbers], ["i", "j", "v"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(d, object)
        for rows in rows_of(batches):
            total = total + rows.sum(axis=0).astype(object)
        columns = [pa.array(range(d), pa.int32()), pa.array([0] * d, pa.int32())]
        columns.append(pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "v"])

    found = _summed(fitted.mapInArrow(sums, entry))
    totals = [found[(i, 0)] for i in range(d)]
    middle = np.array([round(Fraction(s, n)) for s in totals], np.int64)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for rows in rows_of(batches):
            total = total + exact_product(rows - middle)
        yield entries(total)

    # Centred on the nearest whole numbers before multiplying, so that products stay exact; what is left of the mean
    # is below one half and is taken off in exact arithmetic.
    found = _summed(fitted.mapInArrow(products, entry))
    left = [s - n * int(m) for s, m in zip(totals, middle)]
    covariance = np.zeros((d, d))
    exact_trace = 0
    for (i, j), value in found.items():
        exact = n * value - left[i] * left[j]
        exact_trace += exact if i == j else 0
        covariance[i, j] = covariance[j, i] = exact / (n * n)
    eigenvalues, directions = leading(covariance, wanted)
    model = Whitening(n, totals, eigenvalues, directions, exact_trace / (n * n))

    k = len(eigenvalues)

    def second_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments = np.zeros((k + 1, k + 1))
        for rows in rows_of(batches):
            values = np.hstack([model.whitened(model.centred(rows)), np.ones((len(rows), 1))])
            moments += values.T @ values
        i, j = np.indices(moments.shape)
        columns = [pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(moments.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "v"])

    if k:
        measured = np.zeros((k + 1, k + 1))
        for row in fitted.mapInArrow(second_moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
            measured[row.i, row.j] = row.v
        mean = measured[:k, k] / n
        model.identity_error = float(np.abs(measured[:k, :k] / n - np.outer(mean, mean) - np.eye(k)).max())
    return model


def transform(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    k, d = len(model.eigenvalues), model.dimension
    explained = model.eigenvalues / model.trace if k else np.zeros(0)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows if k else 0, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                scaled, sizes, rows = whole_numbers(part.column(1))
                kept = sizes == d
                if not kept.any():
                    continue
                centred = model.centred(scaled[np.repeat(kept, sizes)].reshape(-1, d))
                rows = np.repeat(rows[kept], k)
                m = len(centred)
                deviation = pa.array(deviations(centred), pa.int64())
                columns = [
                    part.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    deviation.take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(model.whitened(centred).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    wanted = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    added = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = StructType.fromDDL(f"`{id_col}` long, {added}")
    return wanted.mapInArrow(apply, schema)
