"""Embedding whitening by shifted Cholesky QR.

The centred rows A are orthogonalised by passes over the data: each pass sums the
Gram matrix of A·T, factors it as RᵀR and goes on with T·R⁻¹. While the Gram
matrix is far from the identity a small multiple of the identity is added before
it is factored, so that the factor exists however badly conditioned the rows are;
the next pass makes up for it. The composed factors give one small matrix W with
WᵀW = AᵀA, whose singular values and vectors are those of A without the Gram
matrix having been squared. Components are its right singular vectors.

Entries are integers, so sums, centring and deviations are exact. What a task
sends is a Gram matrix, d × d numbers whatever its rows, added up row by row of
the matrix on the executors; the driver gets one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import doc_columns, read, stored

SCALE, OFFSET, COMPONENTS = 64.0, 1_000_000, 16
#: Passes after which the composed factor is taken as it is.
MAX_PASSES = 8
#: Below this share of the largest standard deviation a direction's variance is rounding.
LEAST_SPREAD = 1e-9
_EPS = float(np.finfo(float).eps)
_LIMIT = 2.0**62  # entries beyond are held there
_BLOCK, _STRIP = 4096, 32  # rows multiplied at once, columns solved at once
_WIDTHS = ("<i2", "<i4", "<i8")


def _valid(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def _pack(row: np.ndarray) -> bytes:
    """One spelling per vector: the narrowest width that holds it, then its entries."""
    low, high = (int(row.min()), int(row.max())) if len(row) else (0, 0)
    width = next(w for w in _WIDTHS if np.iinfo(w).min <= low and high <= np.iinfo(w).max)
    return width[2:].encode() + row.astype(width).tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, f"<i{packed[:1].decode()}", offset=1).astype(np.int64)


def _integers(scale: float):
    """Steps of ``scale`` per entry, without the offset, which centring takes out again."""
    schema = pa.schema([("vec_id", pa.int64()), ("size", pa.int32()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("embedding")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            flat = np.clip(np.floor(scale * flat), -_LIMIT, _LIMIT).astype(np.int64)
            size = column.value_lengths().to_numpy(zero_copy_only=False)
            rows = [_pack(r) for r in np.split(flat, np.cumsum(size)[:-1])] if len(size) else []
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(size, pa.int32()), pa.array(rows, pa.binary())], schema=schema
            )

    return run


def integer_vectors(embeddings: DataFrame, scale: float = SCALE) -> DataFrame:
    """(vec_id, size, x): vectors without null or non-finite entries, in whole steps, packed."""
    x = doc_columns(embeddings, "vec_id", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    return x.filter(_valid(F.col("embedding"))).mapInArrow(_integers(scale), "vec_id long, size int, x binary")


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for at in range(0, b.num_rows, _BLOCK):
            part = b.slice(at, _BLOCK)
            yield part, np.array([_unpack(v) for v in part.column("x").to_pylist()], np.int64)


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(i, n, s): a task's exact sums by dimension."""
    from decimal import Decimal

    total, n = None, 0
    for _, u in _matrices(batches):
        wide = np.abs(u).max(initial=0) > 2**40
        part = u.astype(object).sum(axis=0) if wide else u.sum(axis=0).astype(object)
        total, n = (part if total is None else total + part), n + len(u)
    if n:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(len(total)), pa.int32()), pa.array([n] * len(total), pa.int64()),
                pa.array([Decimal(int(s)) for s in total], pa.decimal128(38, 0)),
            ],
            names=["i", "n", "s"],
        )


@dataclass(frozen=True)
class Centre:
    """Number of fitted vectors and the exact sums of their entries."""

    n: int
    sums: tuple[int, ...]

    def deviations(self, u: np.ndarray) -> np.ndarray:
        """n·u − sums, exact: 64-bit where that holds them, Python integers beyond."""
        most = max(1, int(np.abs(u).max(initial=0)), -(-max(map(abs, self.sums), default=0) // max(self.n, 1)))
        kind = np.int64 if 2 * self.n * most < 2**62 else object
        return u.astype(kind) * self.n - np.array(self.sums, dtype=kind)

    def rows(self, u: np.ndarray) -> np.ndarray:
        return self.deviations(u).astype(float) / self.n


def centre(vectors: DataFrame) -> Centre:
    sums = vectors.mapInArrow(_column_sums, "i int, n long, s decimal(38,0)")
    found = sums.groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()  # one row per dimension
    return Centre(found[0]["n"] if found else 0, tuple(int(r["s"]) for r in found))


def solve_rows(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q with Q·r = a for an upper triangular r, by substitution, a strip of columns at a time."""
    q = np.empty_like(a)
    for at in range(0, len(r), _STRIP):
        end = min(at + _STRIP, len(r))
        q[:, at:end] = a[:, at:end] - q[:, :at] @ r[:at, at:end]
        for j in range(at, end):
            q[:, j] = (q[:, j] - q[:, at:j] @ r[at:j, j]) / r[j, j]
    return q


def _gram_rows(middle: Centre, factors: list[np.ndarray], turn: np.ndarray | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for _, u in _matrices(batches):
            a = middle.rows(u)
            for r in factors:
                a = solve_rows(a, r)
            a = a if turn is None else a @ turn
            total = a.T @ a if total is None else total + a.T @ a
        if total is not None:
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(len(total)), pa.int32()), pa.array([part] * len(total), pa.int32()),
                    pa.array([r.tobytes() for r in total], pa.binary()),
                ],
                names=["i", "part", "g"],
            )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one index follow each other; one is held."""
    at, total = None, None
    out = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["i", "g"])
    for b in batches:
        for i, g in zip(b.column("i").to_pylist(), b.column("g").to_pylist(), strict=True):
            if i != at:
                if at is not None:
                    yield out()
                at, total = i, np.zeros(len(g) // 8)
            total = total + np.frombuffer(g)
    if at is not None:
        yield out()


def gram(vectors: DataFrame, middle: Centre, factors: list[np.ndarray] = [], turn: np.ndarray | None = None) -> np.ndarray:  # noqa: B006
    """The Gram matrix of the centred rows, each solved through ``factors`` and times ``turn``, summed in one order
    whatever the schedule."""
    parts = vectors.mapInArrow(_gram_rows(middle, factors, turn), "i int, part int, g binary")
    summed = parts.repartition("i").sortWithinPartitions("i", "part").mapInArrow(_added, "i int, g binary")
    rows = sorted(summed.collect(), key=lambda r: r["i"])  # one row per dimension
    return np.array([np.frombuffer(r["g"]) for r in rows])


def _factor(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper R with RᵀR = g + shift, the shift raised until the factor exists."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, _EPS * float(np.trace(g)), np.finfo(float).tiny)


def triangle(vectors: DataFrame, middle: Centre) -> tuple[np.ndarray, int]:
    """W with WᵀW = AᵀA for the centred rows A, and the passes it took.

    A pass ends the search when the solved rows are orthonormal but for directions in which they have nothing: its
    Gram matrix is then well conditioned where it is not zero, and its own root closes the product, the triangular one
    if it has full rank."""
    d = len(middle.sums)
    composed, factors = np.eye(d), []
    while True:
        g = gram(vectors, middle, factors)
        values, ways = np.linalg.eigh(g)
        top = float(values[-1]) if d else 0.0
        if not top > 0:
            return np.zeros((d, d)), len(factors) + 1
        share = values / top
        if factors and (np.all((share > 0.1) | (share < 1e-6)) or len(factors) + 1 >= MAX_PASSES):
            if share[0] > 0.1:
                return np.linalg.cholesky(g).T @ composed, len(factors) + 1
            values = np.where(share > _EPS * 100 * d, values, 0.0)
            return np.sqrt(values)[:, None] * ways.T @ composed, len(factors) + 1
        # On the first pass the shift of the published error analysis, for the largest eigenvalue.
        shift = 11 * (middle.n * d + d * (d + 1)) if not factors else d
        factors.append(_factor(g, shift * _EPS * top))
        composed = factors[-1] @ composed


@dataclass(frozen=True)
class Whitening:
    """Components as columns, falling eigenvalues, and their shares of the whole variance."""

    centre: Centre
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    passes: int

    def transform(self, u: np.ndarray) -> np.ndarray:
        return self.centre.rows(u) @ self.components / np.sqrt(self.eigenvalues)


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The leading components of ``distinct``, a stored table with each vector ``x`` of one size once. Directions with
    less than ``LEAST_SPREAD`` of the largest standard deviation are no components, so there are at most as many as the
    rank."""
    middle = centre(distinct)
    w, passes = triangle(distinct, middle)
    _, singular, turned = np.linalg.svd(w)
    d = len(singular)
    kept = int((singular > singular[0] * LEAST_SPREAD).sum()) if d and singular[0] > 0 else 0
    kept = min(kept, components)
    e = singular**2 / max(middle.n, 1)
    ways = turned[:kept].T
    if kept:  # either sign is right; the largest entry is made positive
        ways = ways * np.sign(ways[np.abs(ways).argmax(axis=0), range(kept)])
    return Whitening(middle, ways, e[:kept], e[:kept] / e.sum() if kept else e[:0], passes)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, from one more pass."""
    if not len(model.eigenvalues):
        return 0.0
    g = gram(distinct, model.centre, turn=model.components / np.sqrt(model.eigenvalues))
    return float(np.abs(g / model.centre.n - np.eye(len(g))).max())


_ROWS = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, "
    "deviation_exact decimal(38,0)"
)


def _rows(model: Whitening, error: float):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        k = len(model.eigenvalues)
        for b, u in _matrices(batches):
            rows = len(u)
            moved = model.centre.deviations(u)
            if np.abs(moved.astype(float)).max(initial=0) ** 2 * moved.shape[1] >= 2.0**62:
                moved = moved.astype(object)
            away = [int(v) for v in (moved * moved).sum(axis=1)]
            each = np.repeat(np.arange(rows), k)
            exact = pa.array([Decimal(v) if v < 10**38 else None for v in away], pa.decimal128(38, 0))
            columns = [
                b.column("vec_id").take(pa.array(each)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.centre.n, np.int64)),
                pa.array([v if v < 2**63 else None for v in away], pa.int64()).take(pa.array(each)),
                pa.array(model.transform(u).reshape(-1)),
                pa.array(np.tile(model.explained, rows)),
                pa.array(np.full(rows * k, error)),
                exact.take(pa.array(each)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def whitened(embeddings: DataFrame, scale: float = SCALE, components: int = COMPONENTS) -> DataFrame:
    """A row per remaining vector and component: (vec_id, component, n, deviation, whitened, explained,
    identity_error, deviation_exact).

    Vectors that are null, empty or hold null or non-finite entries have no rows. Repeated vectors count once in the
    fit and are all returned, null ids too. Vectors of different sizes are fitted size by size, since they share no
    space. Entries beyond ±2^62 steps are held there. A deviation beyond 64 bits is null in ``deviation`` and whole in
    ``deviation_exact`` up to 38 digits. Vectors without any variance, as a single one, have no component and no row."""
    each = stored(integer_vectors(embeddings, scale).filter("size > 0"), "vectors")
    distinct = stored(each.select("size", "x").distinct(), "distinct-vectors")
    sizes = [r[0] for r in distinct.select("size").distinct().orderBy("size").collect()]  # one number per kind of vector
    out = each.sparkSession.createDataFrame([], _ROWS)
    for size in sizes:
        fitted = distinct.filter(F.col("size") == size)
        model = fit(fitted, components)
        rows = each.filter(F.col("size") == size).mapInArrow(_rows(model, identity_error(fitted, model)), _ROWS)
        out = rows if len(sizes) == 1 else out.unionByName(rows)
    return out


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened coordinates of every vector of ``embeddings``, see :func:`whitened` for nulls, repeated
    rows, other sizes and vectors without variance."""
    return whitened(read(spark, sf_dir, "embeddings"))
