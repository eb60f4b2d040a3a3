"""Whitening of embeddings by spectrum slicing.

Entries become whole numbers, and everything that is summed over the rows is summed as whole numbers: per dimension the
sum, then the products of the entries less the rounded mean. Products of small whole numbers are exact in floating point,
so a task multiplies matrices as usual; sums are exact and the same in whatever order tasks finish or are repeated. The
covariance follows from them exactly before it is rounded, once, to double precision.

Its leading eigenvalues are found one by one. A symmetric factorisation L D L' of the covariance less a shift (with
1x1 and 2x2 pivots) has as many positive pivots as there are eigenvalues above the shift. Such counts halve an interval
until it holds the k-th eigenvalue alone; Rayleigh quotient iteration converges from there to the eigenvector, and counts
just above and below the result certify that it is number k. Eigenvalues that no interval of working precision parts
are taken together, as an invariant subspace. Vectors are kept orthogonal to those before.

The matrix has a row and a column per dimension; it and what follows from it are all that the driver holds. The rows are
read four times: sums, products, the covariance of the result, the result.

Cases: rows whose vector is null, empty, or holds a null or a non-finite entry are left out; a null id is carried along;
equal rows count each; an empty table, or one without a vector that counts, gives no rows; directions in which all rows
agree (eigenvalue zero to working precision) cannot be scaled and are left out; other columns are ignored. Vectors of
different lengths, or entries beyond 2**42, stop the job with an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depthbook.llm.common import python_path, table

COMPONENTS = 32
#: An entry c becomes floor(SCALE * c) + OFFSET. The offset is left out of all sums, which do not depend on it.
SCALE = 64
OFFSET = 1_000_000
LARGEST = 2.0**42
EPS = np.finfo(float).eps


# ------------------------------------------------------------------ the spectrum of a symmetric matrix


def count_above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues are larger than the shift: the positive pivots of L D L' = matrix - shift."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, positive = len(a), 0, 0
    worth = (1 + 17**0.5) / 8  # least relative size of a single pivot that keeps the factors bounded
    while k < n:
        step = 1
        below = np.abs(a[k + 1 :, k])
        largest = below.max(initial=0.0)
        if abs(a[k, k]) < worth * largest:
            r = k + 1 + int(below.argmax())
            others = np.abs(a[k:, r])
            others[r - k] = 0
            most = others.max()
            if abs(a[k, k]) * most < worth * largest * largest:
                step = 1 if abs(a[r, r]) >= worth * most else 2
                to = k + step - 1
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        pivot, side = a[k : k + step, k : k + step], a[k + step :, k : k + step]
        if step == 1:
            positive += bool(pivot[0, 0] > 0)
            if pivot[0, 0]:
                a[k + 1 :, k + 1 :] -= side @ (side.T / pivot[0, 0])
        else:
            positive += 1  # such a pair has a negative determinant
            a[k + 2 :, k + 2 :] -= side @ np.linalg.solve(pivot, side.T)
        k += step
    return positive


class Slice(NamedTuple):
    """Eigenvalues low < e <= high, numbered first .. last from the largest on."""

    low: float
    high: float
    first: int
    last: int


def slices(matrix: np.ndarray, wanted: int) -> list[Slice]:
    """Intervals that hold the `wanted` largest eigenvalues, each alone where working precision parts them."""
    norm = np.abs(matrix).sum(axis=1).max()
    tolerance = 8 * len(matrix) * EPS * norm
    open_ends = [(-norm - tolerance, len(matrix), norm + tolerance, 0)]
    found: list[Slice] = []
    while open_ends:
        low, above_low, high, above_high = open_ends.pop()
        if above_low == above_high or above_high >= wanted:
            continue
        if high - low <= tolerance or above_low - above_high == 1 and high - low <= 0.05 * abs(high):
            found.append(Slice(low, high, above_high + 1, above_low))
            continue
        middle = (low + high) / 2
        above = count_above(matrix, middle)
        open_ends += [(low, above_low, middle, above), (middle, above, high, above_high)]
    return sorted(found, key=lambda s: s.first)


def _orthogonal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
    return block


def _solved(matrix: np.ndarray, shift: float, block: np.ndarray) -> np.ndarray:
    """(matrix - shift)^-1 block; a shift that is an eigenvalue to the last bit is moved by one."""
    a = matrix - shift * np.eye(len(matrix))
    try:
        out = np.linalg.solve(a, block)
    except np.linalg.LinAlgError:
        out = np.linalg.solve(a + EPS * np.abs(matrix).max() * np.eye(len(matrix)), block)
    return out


def _single(matrix: np.ndarray, part: Slice, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The slice's eigenpair by Rayleigh quotient iteration; None if it strays from the slice."""
    norm = np.abs(matrix).sum(axis=1).max()
    vector = _orthogonal(np.random.default_rng(part.first).standard_normal((len(matrix), 1)), basis)
    shift = (part.low + part.high) / 2
    for _ in range(3):  # inverse iteration, until the quotient is in the slice for good
        vector = _orthogonal(_solved(matrix, shift, vector), basis)
    best, residual = None, np.inf
    for _ in range(12):
        value = float((vector.T @ matrix @ vector)[0, 0])
        away = float(np.linalg.norm(matrix @ vector - value * vector))
        if not part.low - 4 * EPS * norm <= value <= part.high + 4 * EPS * norm:
            return None
        if away >= residual:
            break
        best, residual = (np.array([value]), vector), away
        vector = _orthogonal(_solved(matrix, value, vector), basis)
    return best if residual <= 32 * len(matrix) * EPS * norm else None


def _together(matrix: np.ndarray, part: Slice, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The eigenpairs of a slice by inverse iteration of a block, and the spectrum within the subspace."""
    n = part.last - part.first + 1
    block = _orthogonal(np.random.default_rng(part.first).standard_normal((len(matrix), n)), basis)
    for _ in range(6):
        block = _orthogonal(_solved(matrix, (part.low + part.high) / 2, block), basis)
    values, turn = np.linalg.eigh(block.T @ matrix @ block)
    return values[::-1], block @ turn[:, ::-1]


def leading(matrix: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above zero, falling, and their unit eigenvectors as columns (largest entry positive)."""
    n = len(matrix)
    norm = np.abs(matrix).sum(axis=1).max(initial=0.0)
    tolerance = 16 * n * EPS * norm
    wanted = min(wanted, count_above(matrix, tolerance)) if norm else 0
    values, basis = np.zeros(0), np.zeros((n, 0))
    waiting = slices(matrix, wanted)[::-1] if wanted else []
    while waiting:
        part = waiting.pop()
        pair = _single(matrix, part, basis) if part.first == part.last else _together(matrix, part, basis)
        if pair is None:
            # The slice was too wide for its neighbours: halve it where counts say.
            middle = (part.low + part.high) / 2
            inside = count_above(matrix, middle) == part.last
            narrower = part._replace(low=middle) if inside else part._replace(high=middle)
            if middle in (part.low, part.high):
                raise ArithmeticError(f"no eigenvector for eigenvalue {part.first}")
            waiting.append(narrower)
            continue
        values, basis = np.concatenate([values, pair[0]]), np.hstack([basis, pair[1]])
        if count_above(matrix, pair[0].max() + tolerance) >= part.first or count_above(matrix, pair[0].min() - tolerance) < part.last:
            raise ArithmeticError(f"eigenvalue {part.first} is not where counts say")
    values, basis = values[:wanted], basis[:, :wanted]
    signs = np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])]) if wanted else np.ones(0)
    return values, basis * signs


# ------------------------------------------------------------------------------------- sums over the rows


def whole_vectors(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """vec_id and z, floor(SCALE * entry) as long, of the rows that count."""
    entries = F.col(vector).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    small = F.when(F.forall(entries, lambda c: F.abs(c) <= LARGEST), entries)
    small = F.coalesce(small, F.raise_error(F.lit(f"an entry beyond {LARGEST}")).cast("array<double>"))
    return kept.select(F.col(key).cast("long").alias("vec_id"), F.transform(small, lambda c: F.floor(c * SCALE)).alias("z"))


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column as a matrix of whole numbers."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.unique(lists.value_lengths().to_numpy(zero_copy_only=False))
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {sizes.tolist()}")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.int64)


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch and dimension: rows, sum, least and largest."""
    for batch in batches:
        if not len(batch):
            continue
        z = _matrix(batch.column(0))
        n = z.shape[1]
        columns = [np.full(n, n), np.arange(n), np.full(n, len(z)), z.sum(axis=0), z.min(axis=0), z.max(axis=0)]
        names = ["size", "i", "rows", "total", "low", "high"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


class Sums(NamedTuple):
    """Rows, and per dimension the sum of z, the rounded mean, and the farthest that an entry is from it."""

    n: int
    total: list[int]
    middle: np.ndarray
    reach: int


def sums_of(vectors: DataFrame) -> Sums | None:
    parts = vectors.select("z").mapInArrow(_sum_rows, "size long, i long, rows long, total long, low long, high long")
    found = parts.groupBy("size", "i").agg(
        F.sum("rows").alias("rows"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    found = sorted(found.collect(), key=lambda r: r["i"])  # a row per dimension
    if not found:
        return None
    if len({r["size"] for r in found}) > 1:
        raise ValueError(f"vectors of different lengths: {sorted({r['size'] for r in found})}")
    n, total = found[0]["rows"], [int(r["total"]) for r in found]
    middle = [(2 * t + n) // (2 * n) for t in total]
    reach = max(max(r["high"] - m, m - r["low"]) for r, m in zip(found, middle, strict=True))
    return Sums(n, total, np.asarray(middle, np.int64), max(reach, 1))


def _product_rows(sums: Sums) -> Callable:
    """Per task the sums of products of entries less the middle, exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(sums.middle)
        exact = 2**53 // sums.reach**2  # rows whose products a double adds without rounding
        total = np.zeros((d, d), dtype=object)
        for batch in batches:
            y = _matrix(batch.column(0)) - sums.middle if len(batch) else np.zeros((0, d), np.int64)
            if exact:
                for at in range(0, len(y), exact):
                    part = y[at : at + exact].astype(float)
                    total += (part.T @ part).astype(np.int64).astype(object)
            else:
                y = y.astype(object)
                total += y.T @ y
        i, j = np.triu_indices(d)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(map(Decimal, total[i, j]), pa.decimal128(38, 0))]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "total"])

    return run


def covariance(vectors: DataFrame, sums: Sums) -> np.ndarray:
    """The covariance matrix (divisor n): every entry a quotient of exact whole numbers, rounded once."""
    parts = vectors.select("z").mapInArrow(_product_rows(sums), "i int, j int, total decimal(38,0)")
    found = parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect()  # a row per pair of dimensions
    n = sums.n
    rest = [t - n * m for t, m in zip(sums.total, sums.middle.tolist(), strict=True)]
    out = np.zeros((len(rest), len(rest)))
    for i, j, total in found:
        out[i, j] = out[j, i] = (n * int(total) - rest[i] * rest[j]) / (n * n)
    return out


# --------------------------------------------------------------------------------------------- whitening


class Whitening(NamedTuple):
    """What whitens a vector: its sums, the eigenvalues, and the eigenvectors over the roots of these, as columns."""

    sums: Sums
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whitened(self, z: np.ndarray) -> np.ndarray:
        n = self.sums.n
        rest = np.asarray([(t - n * m) / n for t, m in zip(self.sums.total, self.sums.middle.tolist(), strict=True)])
        return ((z - self.sums.middle) - rest) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, z: np.ndarray) -> pa.Array:
        """The sum over dimensions of (n x - S)^2, exact."""
        n = self.sums.n
        rest = [t - n * m for t, m in zip(self.sums.total, self.sums.middle.tolist(), strict=True)]
        far = n * self.sums.reach + max(map(abs, rest))
        kind = np.int64 if far * far * len(rest) < 2**63 else object
        away = (z - self.sums.middle).astype(kind) * n - np.asarray(rest, kind)
        found = (away * away).sum(axis=1)
        return pa.array([Decimal(int(v)) for v in found] if kind is object else found).cast(pa.decimal128(38, 0))


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fitted on all vectors; None if there are none."""
    python_path(vectors.sparkSession)
    sums = sums_of(vectors)
    if sums is None:
        return None
    matrix = covariance(vectors, sums)
    values, found = leading(matrix, components)
    return Whitening(sums, values, found, float(np.trace(matrix)))


def _check_rows(fitted: Whitening) -> Callable:
    """Per task the sums of products of whitened entries, and in a last column of the entries themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(fitted.values)
        total = np.zeros((k, k + 1))
        for batch in batches:
            if len(batch):
                w = fitted.whitened(_matrix(batch.column(0)))
                total += w.T @ np.hstack([w, np.ones((len(w), 1))])
        i, j = np.indices(total.shape).reshape(2, -1)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel())]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "total"])

    return run


def identity_error(vectors: DataFrame, fitted: Whitening) -> float:
    """How far the whitened vectors' own covariance is from the identity, at the entry where it is farthest."""
    k, n = len(fitted.values), fitted.sums.n
    parts = vectors.select("z").mapInArrow(_check_rows(fitted), "i int, j int, total double")
    total = np.zeros((k, k + 1))
    for i, j, value in parts.groupBy("i", "j").agg(F.sum("total")).collect():  # a row per pair of components
        total[i, j] = value
    mean = total[:, k] / n
    return float(np.abs(total[:, :k] / n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def _apply(fitted: Whitening) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            z = _matrix(batch.column(1))
            w = fitted.whitened(z)
            offsets = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), fitted.deviations(z), lists], ["vec_id", "deviation", "whitened"])

    return run


_OUT = "vec_id long, deviation decimal(38,0), whitened array<double>"


def whitened(vectors: DataFrame, fitted: Whitening | None) -> DataFrame:
    """vec_id, deviation (exact) and the whitened vector of every row of `whole_vectors`."""
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], _OUT)
    return vectors.mapInArrow(_apply(fitted), _OUT)


def op11_spectrum_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"))
    fitted = fit(vectors)
    rows = whitened(vectors, fitted)
    explained = [float(v / fitted.trace) for v in fitted.values] if fitted else []
    error = identity_error(vectors, fitted) if fitted else 0.0
    rows = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("component", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("component") + 1).alias("component"),
        F.lit(fitted.sums.n if fitted else 0).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        F.get(F.array(*map(F.lit, explained)).cast("array<double>"), "component").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
