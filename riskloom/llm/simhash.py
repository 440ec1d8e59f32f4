"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into 16 segments of 4 bits; the vector of their bit
counts is its place in a grid. Flipping one bit moves the place by one step, so
the Manhattan distance of two places is never above the Hamming distance of the
fingerprints: places more than ``max_bits`` apart need no comparison. With two
steps allowed, two places meet in a cell at most one step from each, so every
distinct fingerprint is entered in its own cell and its at most 32 neighbours,
and only fingerprints that share a cell are compared, exactly, bit by bit. Cells
are keys of a range join, sorted by Spark, read batch by batch.

Identical fingerprints are one row before any of this, so a group of copies
costs its first member. A task passes on no more links than join its
fingerprints into groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import doc_columns, few_rows, nulls_last, read, small, stored, text_blocks, texts, whole_rows
from riskloom.llm.components import components

SHINGLE, MAX_BITS, SEED = 3, 2, 42
_BLOCK = 200_000  # shingles whose bits are counted at once


def _count(words: list[bytes], shingle: int, seed: int, digest, ones: np.ndarray) -> int:
    """Add the set bits of the words' shingles to ``ones``; the number of shingles."""
    if len(words) < shingle:
        return 0
    line = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(size + 1) - size - 1
    ends = (starts + size)[shingle - 1 :].tolist()
    starts = starts[: len(ends)].tolist()
    for i in range(0, len(ends), _BLOCK):
        hashes = np.array([digest(line[a:b], seed) for a, b in zip(starts[i : i + _BLOCK], ends[i : i + _BLOCK])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return len(ends)


def simhash(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Fingerprint of a whole text: a bit is 1 if it is set in over half the shingles' hashes."""
    digest, ones, total, rest = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0, []
    for block in text_blocks(text.lower()):
        words = rest + block.split()
        total += _count(words, shingle, seed, digest, ones)
        rest = words[max(0, len(words) - shingle + 1) :]
    if not total:
        if not rest:
            return 0
        total = _count(rest, len(rest), seed, digest, ones)
    bits = np.packbits(2 * ones > total, bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprints(shingle: int, seed: int, keys: list[str]):
    schema = pa.schema([*[(k, pa.int64()) for k in keys], ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in few_rows(batches, 2_000):
            fps = np.array([simhash(t, shingle, seed) for t in texts(b)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], pa.array(fps)], schema=schema)

    return run


def fingerprints(documents: DataFrame, keys: list[str], shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(``keys``, fp): long key columns as they are, and the fingerprint of ``text`` as a signed long."""
    schema = ", ".join([*[f"{k} long" for k in keys], "fp long"])
    return doc_columns(documents, *keys, "text").mapInArrow(_fingerprints(shingle, seed, keys), schema)


def place(fp: Column) -> Column:
    """Bit counts of the 16 segments, each in its own 4 bits of a long: two half adders for each segment, joined by bits."""
    a, b, c, d = (F.shiftrightunsigned(fp, n).bitwiseAND(F.lit(0x1111111111111111)) for n in range(4))
    both, other = a.bitwiseAND(b), c.bitwiseAND(d)
    one, two = a.bitwiseXOR(b), c.bitwiseXOR(d)
    twos = both.bitwiseXOR(other).bitwiseXOR(one.bitwiseAND(two))
    return one.bitwiseXOR(two).bitwiseOR(F.shiftleft(twos, 1)).bitwiseOR(F.shiftleft(both.bitwiseAND(other), 2))


def cells(places: Column) -> Column:
    """The place itself and every place one step away, counts staying within 0 to 4."""
    steps = []
    for i in range(16):
        count = F.shiftrightunsigned(places, 4 * i).bitwiseAND(F.lit(15))
        one = F.lit(1 << 4 * i)
        steps += [F.when(count < 4, places + one), F.when(count > 0, places - one)]
    return F.array_compact(F.array(places, *steps))


def _places(fps: np.ndarray) -> np.ndarray:
    x = fps.view(np.uint64)
    for_shift = [(1, 0x7777777777777777), (2, 0x3333333333333333), (3, 0x1111111111111111)]
    return x - sum((x >> np.uint64(n)) & np.uint64(m) for n, m in for_shift)


def _verified(cell: np.ndarray, fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked pairs within the runs of equal cells, each pair in one of the cells it shares."""
    at, step = np.arange(len(cell)), 1
    while len(at := at[at + step < len(cell)]):
        at = at[cell[at] == cell[at + step]]
        a, b = fp[at], fp[at + step]
        near = np.bitwise_count((a ^ b).view(np.uint64)) <= max_bits
        a, b = a[near], b[near]
        pa_, pb, c = _places(a), _places(b), cell[at][near].view(np.uint64)
        own_a, own_b = pa_ == c, pb == c
        # Same place: its own cell. One step: the cell of the smaller. Two steps: the lower of the cells between.
        once = np.where(pa_ == pb, own_a, np.where(own_a | own_b, own_a == (a < b), c <= pa_ + pb - c))
        if once.any():
            yield a[once], b[once]
        step += 1


def _forest(pairs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int]]:
    """As few of the pairs as connect the same fingerprints."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    kept = []
    for a, b in pairs:
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            if (p := root(x)) != (q := root(y)):
                parent[max(p, q)] = min(p, q)
                kept.append((x, y))
    return kept


def _linked(max_bits: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def emit(cell, fp) -> pa.RecordBatch:
        kept = _forest(list(_verified(cell, fp, max_bits)))
        a, b = zip(*kept, strict=True) if kept else ([], [])
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            cell, fp = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("cell", "fp"))
            if not len(cell):
                continue
            whole = np.searchsorted(cell, cell[-1])  # the last cell may go on in the next batch
            if whole:
                yield emit(*(np.concatenate([*[h[k] for h in held], x[:whole]]) for k, x in enumerate((cell, fp))))
                held = []
            held.append((cell[whole:], fp[whole:]))
        if held:
            yield emit(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): pairs of fingerprints at ``max_bits`` or fewer differing bits, enough of them to connect all that
    such pairs connect. ``distinct`` is a stored table with one row per fingerprint ``fp``."""
    if not 0 <= max_bits <= 2:
        raise ValueError("cells one step away find pairs of up to 2 differing bits")
    entered = distinct.select("fp", place(F.col("fp")).alias("_p")).select("fp", F.explode(cells(F.col("_p"))).alias("cell"))
    return entered.repartition("cell").sortWithinPartitions("cell", "fp").mapInArrow(_linked(max_bits), "a long, b long")


def near_duplicates(
    documents: DataFrame, keys: list[str], shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED
) -> DataFrame:
    """(``keys``, fp, root): one row per document; documents with one ``root`` are connected by links.

    A null or empty text, or one without words, has the fingerprint 0 and is linked like any other. Repeated rows
    share a root. Null keys stay null. No documents give no rows."""
    each = stored(fingerprints(documents, keys, shingle, seed), "fingerprints")
    distinct = stored(each.select("fp").distinct(), "distinct-fingerprints")
    roots = components(links(distinct, max_bits))
    return each.join(small(stored(roots, "roots")).withColumnRenamed("node", "fp"), "fp", "left").select(
        *keys, "fp", F.coalesce("root", "fp").alias("root")
    )


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint and the smallest doc_id of its component (null only if the component has none)."""
    found = stored(near_duplicates(read(spark, sf_dir, "documents"), ["doc_id"]), "near-duplicates")
    least = stored(found.groupBy("root").agg(F.min("doc_id").alias("component_id")), "components")
    return found.join(small(least), "root").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents, one of each group of near-duplicates: the smallest doc_id, the first row among equal ids, a row
    without an id only if the group has no other."""
    rows = whole_rows(documents, "documents")
    found = near_duplicates(rows.select("_row", "_doc.doc_id", "_doc.text"), ["_row", "doc_id"], shingle, max_bits)
    first = F.min(F.struct(*nulls_last("doc_id"), F.col("_row").alias("_row"))).alias("first")
    kept = stored(found.groupBy("root").agg(first).select("first._row"), "kept")
    return rows.join(small(kept), "_row", "left_semi").select("_doc.*")
