"""Exact top-k by inner product over norm buckets.

Vectors are cut into buckets of similar length, longest first. A first look at
the longest gives every query a lower bound of its k-th best product. Divided by
the lengths of query and bucket it becomes the cosine that a vector of the bucket
must reach. Above 1 the whole bucket is skipped; where it is high, few vectors
lie within the range it leaves the query's largest coordinates, and those ranges
are tested first; where it is low, only vectors too short are left out. All that
remains is verified by exact integer products.

Queries travel in blocks to the buckets that may hold something for them; a
bucket returns at most k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.llm.common import numbered, read, stored

SCALE, K = 1024.0, 10
BUCKET, QUERY_BLOCK = 4096, 1024
#: Local cosine from which coordinates are tested before products, and how many.
COORDINATE_FROM, FOCUS = 0.5, 3
_SLACK = 1 - 1e-9  # bounds are doubles, products are exact
_MOST, _LONG = 2.0**62, 2**63 - 1

_VECTORS = "vec_id long, norm double, v binary"


def _integers(dimensions: int, scale: float):
    schema = pa.schema([("vec_id", pa.int64()), ("norm", pa.float64()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column("embedding")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            size = column.value_lengths().to_numpy(zero_copy_only=False)
            x = np.zeros((len(size), dimensions))
            x[np.arange(dimensions) < size[:, None]] = np.clip(np.floor(scale * flat), -_MOST, _MOST)
            rows = [r.tobytes() for r in x.astype("<i8")]
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(np.sqrt((x * x).sum(axis=1))), pa.array(rows, pa.binary())], schema=schema
            )

    return run


def integer_vectors(embeddings: DataFrame, scale: float = SCALE) -> DataFrame:
    """(_row, vec_id, norm, v) stored: floor(scale * x) of all vectors without null or non-finite components, as
    little-endian 64-bit integers; shorter vectors are padded with zeros, components beyond ±2^62 are held there."""
    x = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = x.filter(F.col("embedding").isNotNull() & ~F.coalesce(bad, F.lit(False)))
    dimensions = x.agg(F.max(F.size("embedding"))).first()[0] or 0
    return numbered(x.mapInArrow(_integers(dimensions, scale), _VECTORS), "vectors")


_GROUPS = "block long, size long, longest double, shortest double, ids binary, known binary, rows binary, norms binary, v binary"


def _blocks(size: int):
    names = [f.split()[0] for f in _GROUPS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), *[pa.binary()] * 5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first, held, count = TaskContext.get().partitionId() << 32, [], 0
        number = 0

        def send(rows: list[tuple]) -> pa.RecordBatch:
            ids, row, norm, v = zip(*rows, strict=True)
            known = np.array([i is not None for i in ids])
            columns = [
                [first + number], [len(rows)], [max(norm)], [min(norm)],
                [np.array([i or 0 for i in ids], np.int64).tobytes()], [known.tobytes()], [np.array(row, np.int64).tobytes()],
                [np.array(norm).tobytes()], [b"".join(v)],
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

        for b in batches:
            held += zip(*(b.column(c).to_pylist() for c in ("vec_id", "_row", "norm", "v")), strict=True)
            while len(held) >= size:
                yield send(held[:size])
                held, number = held[size:], number + 1
        if held:
            yield send(held)

    return run


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Stored blocks of at most ``size`` vectors, similar in length, each longest first."""
    order = [F.desc("norm"), F.col("_row")]
    tasks = max(1, vectors.count() // (4 * size))
    ranged = vectors.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return stored(ranged.mapInArrow(_blocks(size), _GROUPS), "blocks")


class _Block:
    def __init__(self, row: dict, name: str):
        get = lambda f, t: np.frombuffer(row[f"{name}_{f}"], t)
        self.ids, self.known, self.rows, self.norms = get("ids", np.int64), get("known", bool), get("rows", np.int64), get("norms", float)
        self.whole = get("v", "<i8").reshape(len(self.ids), -1)
        self.v = self.whole.astype(float)


def _products(q: _Block, of: np.ndarray, c: _Block, at: np.ndarray | slice) -> np.ndarray:
    """Exact integer products of some rows of both blocks: in doubles up to 2 ** 53, in 64 bits as far as they hold them,
    beyond in Python integers. A product that does not fit a long is held at the long's end."""
    a, b = q.v[of], c.v[at]
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < 2.0**53:
        return a @ b.T
    if most < 2.0**62:
        return q.whole[of] @ c.whole[at].T
    exact = q.whole[of].astype(object) @ c.whole[at].astype(object).T
    return np.clip(exact, -_LONG, _LONG).astype(np.int64)


def _best(scores: np.ndarray, at: np.ndarray, block: _Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest of a query's scores and where they are; ties to the smaller id, null last, then the earlier row."""
    if len(scores) > k:
        enough = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, at = scores[enough], at[enough]
    by = np.lexsort((block.rows[at], block.ids[at], ~block.known[at], -scores))[:k]
    return scores[by], at[by]


def _search(q: _Block, bound: np.ndarray, c: _Block, k: int, coordinate_from: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, scores, places) of each query's k best products in a bucket that reach its bound."""
    longest = c.norms[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        local = np.where((q.norms > 0) & (longest > 0), bound / (q.norms * longest), -np.inf) * _SLACK
        enough = np.where(q.norms > 0, bound / q.norms, -np.inf) * _SLACK
    unit = c.v / np.maximum(c.norms, 1e-300)[:, None]
    prefix = np.searchsorted(-c.norms, -enough, side="right")  # candidates long enough; all for a bound below 0
    prefix[enough <= 0] = len(c.norms)
    by_length = np.flatnonzero((local <= 1) & (local < coordinate_from))
    if len(by_length):
        most = int(prefix[by_length].max())
        for i, row in zip(by_length.tolist(), _products(q, by_length, c, slice(most)), strict=True):
            row = row[: prefix[i]]
            at = np.flatnonzero((row >= bound[i]) & (c.rows[: prefix[i]] != q.rows[i]))
            if len(at):
                yield i, *_best(row[at], at, c, k)
    for i in np.flatnonzero((local <= 1) & (local >= coordinate_from)).tolist():
        t, u, m = local[i], q.v[i] / q.norms[i], int(prefix[i])
        fits = c.rows[:m] != q.rows[i]
        for f in np.argsort(-np.abs(u))[:FOCUS].tolist():
            # Unit vectors at cosine t or more differ in a coordinate by no more than this from t times the query's.
            reach = np.sqrt(max(0.0, (1 - t * t) * (1 - u[f] * u[f]))) + 1e-9
            if u[f] >= -t:
                fits &= unit[:m, f] >= t * u[f] - reach
            if u[f] <= t:
                fits &= unit[:m, f] <= t * u[f] + reach
        at = np.flatnonzero(fits)
        if len(at):
            row = _products(q, np.array([i]), c, at)[0]
            keep = row >= bound[i]
            if keep.any():
                yield i, *_best(row[keep], at[keep], c, k)


def _bounds(k: int):
    """A query block with the bounds that one bucket gives: its k-th best product, or none if it has fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                q, c = _Block(row, "q"), _Block(row, "c")
                bound = np.full(len(q.ids), -np.inf)
                for i, scores, _ in _search(q, bound, c, k, np.inf):
                    if len(scores) == k:
                        # The nearest double of a score beyond 2 ** 53 may lie above it.
                        bound[i] = np.nextafter(float(scores[-1]), -np.inf) if abs(int(scores[-1])) >= 2**53 else scores[-1]
                with np.errstate(divide="ignore", invalid="ignore"):
                    reach = np.where((q.norms > 0) & (bound > 0), bound / q.norms, -np.inf).min()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["q_block"]]), pa.array([bound.tobytes()], pa.binary()), pa.array([float(reach * _SLACK)])],
                    names=["q_block", "bound", "reach"],
                )

    return run


_FOUND = "query_row long, query_id long, vec_id long, vec_row long, score long"


def _verify(k: int, coordinate_from: float):
    names = [f.split()[0] for f in _FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                q, c = _Block(row, "q"), _Block(row, "c")
                out: list[list] = [[] for _ in names]
                for i, scores, at in _search(q, np.frombuffer(row["bound"], float), c, k, coordinate_from):
                    ids = [int(x) if y else None for x, y in zip(c.ids[at], c.known[at], strict=True)]
                    values = ([int(q.rows[i])] * len(at), [int(q.ids[i])] * len(at), ids, c.rows[at].tolist(), scores.astype(np.int64).tolist())
                    for column, value in zip(out, values, strict=True):
                        column.extend(value)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=names)

    return run


def top_k(
    vectors: DataFrame, queries: Column, k: int = K, bucket: int = BUCKET, query_block: int = QUERY_BLOCK,
    coordinate_from: float = COORDINATE_FROM,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest products of each vector that satisfies ``queries`` with all others.

    ``vectors`` is a table as ``integer_vectors`` stores it. Ties go to the smaller vec_id, null last, then to the earlier
    row. A score beyond 64 bits is held at their end, and such scores tie. A repeated vec_id is a vector of its own; a query meets its copies, not itself. Fewer than k others give fewer
    rows, no vectors or no queries none.
    """
    named = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in df.columns])
    c, q = named(blocks(vectors, bucket), "c"), named(blocks(vectors.filter(queries), query_block), "q")
    top = c.agg(F.max_by("c_block", F.struct("c_longest", -F.col("c_block")))).first()[0]
    if top is None or q.limit(1).count() == 0:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    first = q.withColumn("c_block", F.lit(top)).join(c, "c_block")
    bounds = stored(first.mapInArrow(_bounds(k), "q_block long, bound binary, reach double"), "bounds")
    # Pairs of numbers first; blocks join them by number, queries move to buckets.
    ends = c.select("c_block", "c_longest")
    pairs = bounds.join(F.broadcast(ends) if ends.count() <= 100_000 else ends, F.col("c_longest") >= F.col("reach"))
    pairs = pairs.select("q_block", "c_block")
    joined = q.join(bounds.select("q_block", "bound"), "q_block").join(pairs, "q_block").join(c, "c_block")
    found = joined.mapInArrow(_verify(k, coordinate_from), _FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").isNull(), "vec_id", "vec_row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(integer_vectors(read(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


#: The SQL multiplies every query with every vector.
OP3_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS cr, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, cr) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
