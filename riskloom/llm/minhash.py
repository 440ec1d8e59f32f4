"""MinHash near-duplicates with circulant signatures.

A signature takes two permutations of the 32-bit numbers. The first scatters a
shingle; the second, shifted circularly by k, gives coordinate k: the least value
over the document's shingles. Shifting replaces the k independent permutations of
plain MinHash, and two documents still agree in a coordinate with a probability
that is their Jaccard similarity.

Four coordinates make a band; documents that share a band are compared, exactly,
on their full sets, in two steps that never form all pairs of a band:

1. every document of a band with the band's first one. Links are contracted to
   components, and a band whose documents are then connected is done.
2. in the other bands, documents of different components. Jaccard distance obeys
   the triangle inequality, so two linked documents are at distances from the
   band's first one that differ by no more than a link's length. Documents are
   dealt to cells of that width by their distance, known from step 1, and meet
   only in their own and the next cell. Cells are cut into chunks of bounded size;
   a task returns no more links than join its documents into groups.

Documents with one set are one row before any of this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import doc_columns, read, small, stored, text_blocks, texts
from riskloom.llm.components import components

SHINGLE, PERCENT, SEED = 3, 85, 42
BANDS, WIDTH = 28, 4
#: Documents at 85 % similarity agree in fewer of the 112 coordinates less often than once in 10^9 pairs.
LEAST_AGREED = 64
#: Shingles whose coordinates are computed at once; members that are checked with a band's first document in one task;
#: documents and shingles of a cell's chunk.
_BLOCK, STAR, CHUNK, CHUNK_SHINGLES = 1 << 9, 1_000, 1_000, 4_000_000

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_ODD[3])
    x = (x ^ (x >> np.uint64(32))) * np.uint64(_ODD[3])
    return x ^ (x >> np.uint64(32))


def _permute(x: np.ndarray, spare: np.ndarray) -> None:
    """A permutation of the 32-bit numbers, in place: xor-shifts and odd factors can be undone."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=spare)
    np.bitwise_xor(x, spare, out=x)


def shingle_set(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles, each made of its words' hashes."""
    digest, parts, rest = xxhash.xxh64_intdigest, [], []
    for block in text_blocks(text.lower()):
        words = block.split()
        h = np.array(rest + [digest(w, seed) for w in words], np.uint64)
        if len(h) >= shingle:
            n = len(h) - shingle + 1
            total = np.zeros(n, np.uint64)
            for k in range(shingle):
                total = total * np.uint64(_ODD[0]) + h[k : k + n]
            parts.append(np.unique(_mix64(total)))
        rest = h[max(0, len(h) - shingle + 1) :].tolist()
    if not parts:
        if not rest:
            return np.zeros(0, np.uint64)
        total = np.uint64(len(rest))  # fewer words than a shingle: the whole sequence, told apart by its length
        with np.errstate(over="ignore"):
            for h in rest:
                total = total * np.uint64(_ODD[1]) + np.uint64(h)
        return _mix64(np.array([total], np.uint64))
    return parts[0] if len(parts) == 1 else np.unique(np.concatenate(parts))


def signature(shingles: np.ndarray, size: int = BANDS * WIDTH) -> np.ndarray:
    """Coordinate k: the least value of the second permutation, shifted by k steps, over the scattered shingles."""
    best = np.full(size, 0xFFFFFFFF, np.uint32)
    steps = (np.arange(1, size + 1, dtype=np.uint64) * np.uint64(_ODD[4] >> 32)).astype(np.uint32)[:, None]
    scattered = (shingles >> np.uint64(32)).astype(np.uint32)  # the hashes are mixed already: their upper half
    for at in range(0, len(scattered), _BLOCK):
        shifted = scattered[at : at + _BLOCK] - steps
        _permute(shifted, np.empty_like(shifted))
        np.minimum(best, shifted.min(axis=1), out=best)
    return best


def bands(sig: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """One number per band, the band's place included."""
    rows = sig.reshape(-1, width).astype(np.uint64)
    total = np.arange(1, len(rows) + 1, dtype=np.uint64) * np.uint64(_ODD[2])
    for k in range(width):
        total = _mix64(total * np.uint64(_ODD[0]) + rows[:, k])
    return total.view(np.int64)


_EACH = "doc_id long, n long, digest binary, bands array<long>, agree binary, text string"


def _signed(shingle: int, seed: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())),
         ("agree", pa.binary()), ("text", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text in texts(b):
                s = shingle_set(text, shingle, seed)
                if not len(s):
                    rows.append((0, None, None, None))
                    continue
                sig = signature(s)
                # Low bytes of the coordinates are enough to count how many agree.
                rows.append((len(s), xxhash.xxh128_digest(s.tobytes()), bands(sig), sig.astype(np.uint8).tobytes()))
            n, digest, band, agree = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(band, pa.list_(pa.int64())),
                 pa.array(agree, pa.binary()), b.column("text").cast(pa.string())], schema=schema
            )

    return run


def _sets(shingle: int, seed: int):
    schema = pa.schema([("_row", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t, shingle, seed).tobytes() for t in texts(b)]
            yield pa.RecordBatch.from_arrays([b.column("_row"), pa.array(sets, pa.binary())], schema=schema)

    return run


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many numbers two sorted sets share."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def _stars():
    """Members of a star after its first document: (u, v, shared, total) for each."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("shared", pa.int64()), ("total", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held = None, None
        for b in batches:
            rows = []
            for star, u, raw in zip(b.column("star").to_pylist(), b.column("u").to_pylist(), b.column("shingles"), strict=True):
                s = np.frombuffer(raw.as_py(), np.uint64)
                if u == star:
                    first, held = star, s
                    continue
                assert first == star
                both = common(s, held)
                rows.append((u, star, both, len(s) + len(held) - both))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

    return run


class _Cell:
    """Documents of one chunk pair of a cell: natives of both chunks, guests of the cell before."""

    def __init__(self):
        self.rows: list[tuple] = []

    def add(self, row: tuple) -> None:
        self.rows.append(row)

    def links(self, percent: int) -> list[tuple[int, int]]:
        """Enough links to connect all that links among the rows connect, found in the first band that a pair shares."""
        rows = self.rows
        if len(rows) < 2:
            return []
        n = np.array([len(r["shingles"]) // 8 for r in rows])
        root = np.array([r["root"] for r in rows])
        native = np.array([r["native"] for r in rows])
        chunk = np.array([r["chunk"] for r in rows])
        agree = np.array([np.frombuffer(r["agree"], np.uint8) for r in rows])
        band = np.array([r["bands"] for r in rows], np.int64)
        here = int(np.flatnonzero(band[0] == rows[0]["band"])[0])
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        low, high = rows[0]["low"], rows[0]["high"]
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        found = []
        for i in np.flatnonzero(native):
            # Guests once with each native; natives once with each other: a pair of chunks compares across only.
            other = np.where(native, np.arange(len(rows)) > i, True) & (root != root[i])
            if low != high:
                other &= chunk != chunk[i]
            other &= (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & ~(band[:, :here] == band[i, :here]).any(axis=1)
            near = np.flatnonzero(other)
            if not len(near):
                continue
            alike = (agree[near] == agree[i]).sum(axis=1)
            near, alike = near[alike >= LEAST_AGREED], alike[alike >= LEAST_AGREED]
            for j in near[np.argsort(-alike, kind="stable")]:
                p, q = top(int(root[i])), top(int(root[j]))
                if p == q:
                    continue
                both = common(sets[i], sets[j])
                if 100 * both >= percent * (n[i] + n[j] - both):
                    parent[max(p, q)] = min(p, q)
                    found.append((rows[i]["u"], rows[j]["u"]))
        return found


def _in_cells(percent: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    names = ("band", "cell", "low", "high", "u", "root", "native", "chunk", "agree", "bands", "shingles")

    def send(cell: _Cell) -> pa.RecordBatch:
        found = cell.links(percent)
        u, v = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, _Cell()
        for b in batches:
            for row in b.select(names).to_pylist():
                key = (row["band"], row["cell"], row["low"], row["high"])
                if key != at:
                    yield send(held)
                    at, held = key, _Cell()
                held.add(row)
        yield send(held)

    return run


def _star_links(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(u, v, shared, total) of stored ``pairs`` (u, v), v a star's first document. A star's members are dealt to
    several tasks, each with a copy of its set."""
    parts = pairs.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / F.lit(STAR)).cast("int").alias("_parts"))
    parts = small(stored(parts, "stars"))
    part = F.pmod(F.xxhash64("u"), F.col("_parts"))
    members = pairs.join(parts, "v").select(F.col("v").alias("star"), part.cast("int").alias("part"), "u")
    heads = parts.select(F.col("v").alias("star"), F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"), F.col("v").alias("u"))
    dealt = members.unionByName(heads).join(sets.withColumnRenamed("_row", "u"), "u")
    ordered = dealt.repartition("star", "part").sortWithinPartitions("star", "part", F.col("u") != F.col("star"), "u")
    return ordered.mapInArrow(_stars(), "u long, v long, shared long, total long")


def _cell_links(sets: DataFrame, open_rows: DataFrame, percent: int) -> DataFrame:
    """(u, v): links between documents of different components within the open bands' cells.

    ``open_rows`` is stored: (band, u, root, n, bands, agree, cell)."""
    home = open_rows.filter("cell > 0").withColumn("native", F.lit(True))
    guest = open_rows.withColumn("native", F.lit(False)).withColumn("cell", F.col("cell") + 1)
    entered = home.unionByName(guest)
    chunks = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(CHUNK)), F.ceil(F.sum("n") / F.lit(CHUNK_SHINGLES)))
    cells = entered.groupBy("band", "cell").agg(
        chunks.cast("int").alias("chunks"), F.bool_or("native").alias("_any"), F.min("root").alias("_a"), F.max("root").alias("_b")
    )
    cells = small(stored(cells.filter("_any and _a <> _b").select("band", "cell", "chunks"), "cells"))
    dealt = entered.join(cells, ["band", "cell"]).withColumn("chunk", F.pmod(F.xxhash64("u"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.withColumn("_other", other).select(
        "band", "cell", F.least("chunk", "_other").alias("low"), F.greatest("chunk", "_other").alias("high"), "u", "root", "native",
        "chunk", "agree", "bands",
    )
    key = ["band", "cell", "low", "high"]
    with_sets = dealt.join(sets.withColumnRenamed("_row", "u"), "u")
    return with_sets.repartition(*key).sortWithinPartitions(*key, "u").mapInArrow(_in_cells(percent), "u long, v long")


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n, component_id): a row per document; documents linked by 100·intersection ≥ ``percent``·union of their
    shingle sets, directly or through others, share the smallest doc_id among them.

    A null, empty or blank text has an empty set and is linked with nothing: its component is its own id. Repeated rows
    and texts share a component. A null id stays null; a component without any id has a null component_id. Sets are of
    64-bit hashes. ``percent`` below 85 needs other bands, at 100 the digests of sets are enough."""
    if not PERCENT <= percent < 100:
        raise ValueError(f"bands of {WIDTH} coordinates are made for similarities from {PERCENT} % to below 100 %")
    signed = doc_columns(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = signed.mapInArrow(_signed(shingle, seed), _EACH).withColumn("_row", F.monotonically_increasing_id())
    each = stored(signed, "signed")
    with_words = each.filter("n > 0")
    # One row per set; the first row stands for it.
    folded = with_words.groupBy("digest").agg(
        F.min(F.struct("_row", "n", "bands", "agree")).alias("_first"), F.min("doc_id").alias("least")
    )
    distinct = stored(folded.select("digest", "least", "_first.*"), "distinct-sets")

    entries = distinct.select(F.col("_row").alias("u"), F.explode("bands").alias("band"))
    shared = entries.groupBy("band").agg(F.min("u").alias("v"), F.count(F.lit(1)).alias("_members")).filter("_members > 1")
    shared = stored(shared, "bands")
    members = stored(entries.join(shared, "band").select("band", "u", "v", "_members"), "members")
    pairs = stored(members.filter("u <> v").select("u", "v").distinct(), "pairs")
    needed = small(stored(pairs.select(F.explode(F.array("u", "v")).alias("_row")).distinct(), "needed"))
    texts_of = each.select("_row", "text").join(needed, "_row", "left_semi")
    sets = stored(texts_of.mapInArrow(_sets(shingle, seed), "_row long, shingles binary"), "sets")

    checked = stored(_star_links(sets, pairs), "checked")
    linked = F.col("shared") * 100 >= F.col("total") * percent
    first = checked.filter(linked).select("u", "v")
    roots = stored(components(first), "roots")

    # Bands that are not connected yet, by the components of their documents.
    rooted = members.filter("_members > 2").join(small(roots).withColumnRenamed("node", "u"), "u", "left")
    rooted = stored(rooted.withColumn("root", F.coalesce("root", "u")), "rooted")
    open_bands = rooted.groupBy("band").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).filter("_a <> _b").select("band")
    open_bands = small(stored(open_bands, "open-bands"))
    # ceil(distance / longest link) - 1 in integers: cell 0 holds what is linked with the first document.
    step = F.expr(f"{100 - percent} * total")
    cell = F.greatest(F.floor((100 * (F.col("total") - F.col("shared")) + step - 1) / step) - 1, F.lit(0)).cast("int")
    spread = rooted.join(open_bands, "band", "left_semi").join(checked.select("u", "v", cell.alias("cell")), ["u", "v"], "left")
    open_rows = spread.join(distinct.select(F.col("_row").alias("u"), "n", "bands", "agree"), "u").select(
        "band", "u", "root", "n", "bands", "agree", F.coalesce("cell", F.lit(0)).alias("cell")
    )
    rest = _cell_links(sets, stored(open_rows, "open-rows"), percent)
    everything = stored(components(stored(first.union(rest), "links")), "all-roots")

    named = distinct.select("digest", F.col("_row").alias("node"), "least").join(small(everything), "node", "left")
    named = stored(named.select("digest", "least", F.coalesce("root", "node").alias("root")), "named")
    least = small(stored(named.groupBy("root").agg(F.min("least").alias("component_id")), "least-ids"))
    by_digest = named.join(least, "root").select("digest", "component_id")
    return (
        each.select("doc_id", "n", "digest").join(by_digest, "digest", "left")
        .select("doc_id", "n", F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    )


def op13_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set size and component of every document; ``kept`` marks the one that carries the component's id, and documents
    without an id in components without one. See :func:`near_duplicates` for empty texts, ties and repeated rows."""
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
