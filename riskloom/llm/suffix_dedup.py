"""Removal of repeated passages by merged Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it starts earlier too:
in an earlier document, or further up in its own.

1. Anchors. Of the 32-byte grams inside a window of ``length`` bytes, the one
   with the lowest hash is its anchor, so equal windows have equal anchors. Runs
   of neighbouring windows with one anchor are units, about one per 36 bytes of
   text; the text itself stays where it is, hashes and places of units are dealt
   by anchor. Equal units fold into the first, before the shuffle within a task,
   after it over all; the others' windows all start earlier elsewhere. Units
   whose anchor no other unit has are done.
2. Transforms. Distinct units that share an anchor may still share windows. Their
   bytes, gathered by anchor, become shards with a transform each; the shards
   are merged by interleave refinement (``bwt``), and intervals of ``length``
   equal bytes give the repeated windows.
3. Removal. Intervals meet their document again.

An anchor with more than ``HOT`` distinct units (a common line among varying
neighbours) does not go to one task: its windows are dealt by their own hash and
compared there, which is exact for groups of any size.

Blocks of arrays are shuffled in place of rows. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.bwt import repeated
from riskloom.llm.common import doc_columns, numbered, read, small, stored, texts
from riskloom.operators.ordering import dense_key

LENGTH, GRAM = 100, 32
#: Distinct units of an anchor that are merged together; beyond, windows are dealt by hash.
HOT = 20_000
#: Bytes of text per bucket of anchors, and of unit bytes per bucket of transforms.
BUCKET_BYTES, MERGE_BYTES = 32 << 20, 4 << 20
_CHUNK = 1 << 18  # text bytes whose grams are hashed together
_FLUSH = 1_000_000  # units that a task folds before it sends them on
_GROUP = 1 << 17  # unit bytes, rounded up to whole anchors, whose transforms are merged

_U = np.uint64
_M1, _M2, _M3 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _M3
    return x ^ (x >> _U(29))


def gram_hashes(text: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at each place, joined from hashes of halves."""
    h, have = (text.astype(np.uint64) + _U(1)) * _M1, 1
    while have < size:
        step = min(have, size - have)
        a, b = h[: len(h) - step], h[step:]
        h = (a * _M2) ^ (b + (a >> _U(29)))
        have += step
    return _finish(h)


def _least(x: np.ndarray, size: int) -> np.ndarray:
    """Minimum of the ``size`` values at each place."""
    have = 1
    while have < size:
        step = min(have, size - have)
        x = np.minimum(x[: len(x) - step], x[step:])
        have += step
    return x


def units(text: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(anchor, content hash, first window, windows) of the units of documents that lie end to end in ``text``."""
    if len(text) < length:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    h = gram_hashes(text, gram)
    least = _least(h, length - gram + 1)
    whole = np.zeros(len(least), bool)  # windows inside one document
    begin = np.concatenate([[0], ends[:-1]])
    for a, b in zip(begin.tolist(), (ends - length + 1).tolist(), strict=True):
        if b > a:
            whole[a:b] = True
    # The leftmost lowest gram anchors a window; once it stood at a window's first place, the next has another one. So
    # no unit holds two equal windows.
    gone = h[: len(least) - 1] == least[:-1]
    new = np.concatenate([[True], (least[1:] != least[:-1]) | gone | (whole[1:] != whole[:-1])])
    if len(ends) > 1:
        new[begin[(begin > 0) & (begin < len(new))]] = True
    start = np.flatnonzero(new)
    n = np.diff(np.append(start, len(least)))
    kept = whole[start]
    start, n = start[kept], n[kept]
    size = n + length - 1
    content = (size.astype(np.uint64) * _M1) ^ h[start + size - gram]
    for k in range(0, 2 * length - gram, gram):
        inside = size >= k + gram
        content[inside] = _finish(content[inside] * _M2 + h[start[inside] + k])
    return least[start], content, start, n


_FIELDS = ("a", "b", "doc", "start", "n")
_DDL = "kind int, bucket long, " + ", ".join(f"{f} binary" for f in _FIELDS)
_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), *[(f, pa.binary()) for f in _FIELDS]])
_UNITS, _GONE, _MERGE, _HASHES = range(4)


def _blocks(kind: int, place: np.ndarray, buckets: int, *columns: np.ndarray) -> list[tuple]:
    """A row per bucket with its share of the columns; a None column is empty."""
    by = np.argsort(place, kind="stable")
    ends = np.searchsorted(place[by], np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(ends)).tolist():
        part = by[ends[b] : ends[b + 1]]
        rows.append((kind, b, *[b"" if c is None else c[part].tobytes() for c in columns]))
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SCHEMA.types, strict=True)], schema=_SCHEMA)


def _spread(x: np.ndarray, buckets: int) -> np.ndarray:
    return ((x >> _U(33)) % _U(buckets)).astype(np.int64)


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A document in pieces of at most a chunk that share length - 1 bytes, so that every window is in one of them."""
    for at in range(0, max(1, len(text) - length + 1), _CHUNK):
        yield at, text[at : at + _CHUNK + length - 1]


def _first_of(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys, most important first, and where in it the values of all but the last two keys change."""
    by = np.lexsort(keys[::-1])
    new = np.zeros(len(by), bool)
    if len(by):
        new[0] = True
        for k in keys[:-2]:
            new[1:] |= k[by][1:] != k[by][:-1]
    return by, new


def _find_units(length: int, gram: int, buckets: int):
    def send(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        if not found:
            return _batch([])
        anchor, content, doc, start, n = (np.concatenate(c) for c in zip(*found, strict=True))
        by, new = _first_of(anchor, content, doc, start)
        first, more = by[new], by[~new]
        rows = _blocks(
            _UNITS, _spread(anchor[first], buckets), buckets,
            anchor[first], content[first], doc[first], start[first], n[first].astype(np.uint16),
        )
        if len(more):
            rows += _blocks(
                _GONE, _spread(anchor[more], buckets), buckets, None, None, doc[more], start[more], n[more].astype(np.uint16)
            )
        return _batch(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        held: list[tuple[int, int, bytes]] = []
        weight = 0

        def work() -> int:
            joined = np.frombuffer(b"".join(p for _, _, p in held), np.uint8)
            ends = np.cumsum([len(p) for _, _, p in held])
            anchor, content, start, n = units(joined, ends, length, gram)
            which = np.searchsorted(ends, start, side="right")
            begin = np.concatenate([[0], ends[:-1]])
            docs = np.array([d for d, _, _ in held], np.int64)
            at = np.array([a for _, a, _ in held], np.int64)
            found.append((anchor, content, docs[which], start - begin[which] + at[which], n))
            return len(n)

        for b in batches:
            for doc, text in zip(b.column("_doc").to_pylist(), texts(b), strict=True):
                for at, piece in _pieces(text, length):
                    if len(piece) >= length:
                        held.append((doc, at, piece))
                        weight += len(piece)
                    if weight >= _CHUNK:
                        size += work()
                        held, weight = [], 0
                if size >= _FLUSH:
                    yield send(found)
                    found, size = [], 0
        if held:
            work()
        yield send(found)

    return run


_MARKS = "hot boolean, doc long, start long, n long, anchor long"


def _fold(hot: int):
    """Equal units of all tasks: all but the first are gone (anchor null); first ones that share an anchor go on."""

    def read_block(pdf: pd.DataFrame, kind: int) -> list[np.ndarray]:
        rows = pdf[pdf["kind"] == kind]
        kinds = (np.uint64, np.uint64, np.int64, np.int64, np.uint16)
        return [np.concatenate([np.zeros(0, t), *[np.frombuffer(x, t) for x in rows[f]]]) for f, t in zip(_FIELDS, kinds, strict=True)]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        _, _, doc0, start0, n0 = read_block(pdf, _GONE)
        anchor, content, doc, start, n = read_block(pdf, _UNITS)
        by, new = _first_of(anchor, content, doc, start)
        more, first = by[~new], by[new]
        a = anchor[first]
        change = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.zeros(0, np.int64)
        count = np.diff(np.append(change, len(a)))
        count = np.repeat(count, count)
        shared, many = first[count > 1], count[count > 1] > hot
        gone = [np.concatenate([x0, x[more]]) for x0, x in ((doc0, doc), (start0, start), (n0, n))]
        return pd.DataFrame(
            {
                "hot": np.concatenate([np.zeros(len(gone[0]), bool), many]),
                **{k: np.concatenate([g, x[shared]]).astype(np.int64) for k, g, x in zip(("doc", "start", "n"), gone, (doc, start, n), strict=True)},
                "anchor": pd.array([None] * len(gone[0]) + anchor[shared].view(np.int64).tolist(), dtype="Int64"),
            }
        )

    return run


def _gather(length: int, merge_buckets: int, hash_buckets: int):
    """Bytes of the units to merge, dealt by anchor, and window hashes of those of hot anchors, dealt by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            merged: list[tuple[int, int, int, int, bytes]] = []
            hashed: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            weight = 0
            rows: list[tuple] = []

            def send() -> list[tuple]:
                out = []
                if merged:
                    anchor = np.array([m[0] for m in merged], np.int64)
                    place = _spread(anchor.view(np.uint64), merge_buckets)
                    for bucket in np.unique(place).tolist():
                        part = np.flatnonzero(place == bucket).tolist()
                        columns = [np.array([merged[i][k] for i in part], np.int64).tobytes() for k in range(4)]
                        out.append((_MERGE, bucket, columns[0], b"".join(merged[i][4] for i in part), columns[1], columns[2], columns[3]))
                if hashed:
                    h, doc, start = (np.concatenate(c) for c in zip(*hashed, strict=True))
                    out += _blocks(_HASHES, _spread(h, hash_buckets), hash_buckets, h, None, doc, start, None)
                return out

            for doc, text, found in zip(b.column("_doc").to_pylist(), texts(b), b.column("found"), strict=True):
                for f in found.as_py() or ():
                    body = text[f["start"] : f["start"] + f["n"] + length - 1]
                    weight += len(body)
                    if f["hot"]:
                        h = gram_hashes(np.frombuffer(body, np.uint8), length)
                        hashed.append((h, np.full(len(h), doc), f["start"] + np.arange(len(h))))
                    else:
                        merged.append((f["anchor"], doc, f["start"], f["n"], body))
                if weight > _CHUNK << 4:
                    rows += send()
                    merged, hashed, weight = [], [], 0
            yield _batch(rows + send())

    return run


def _later(length: int):
    """Windows that start earlier too: (doc, start, n) in runs."""

    def runs(doc: np.ndarray, start: np.ndarray) -> pd.DataFrame:
        by = np.lexsort((start, doc))
        doc, start = doc[by], start[by]
        new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)]) if len(doc) else np.zeros(0, bool)
        at = np.flatnonzero(new)
        return pd.DataFrame({"hot": False, "doc": doc[at], "start": start[at], "n": np.diff(np.append(at, len(doc))), "anchor": pd.array([None] * len(at), dtype="Int64")})

    def merged(pdf: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        anchor, doc, start, n = (np.concatenate([np.frombuffer(x, np.int64) for x in pdf[f]]) for f in ("a", "doc", "start", "n"))
        body = np.frombuffer(b"".join(pdf["b"]), np.uint8)
        size = n + length - 1
        begin = np.cumsum(size) - size
        by = np.lexsort((start, doc, anchor))
        new = np.flatnonzero(np.concatenate([[True], anchor[by][1:] != anchor[by][:-1]]))
        before = np.concatenate([[0], np.cumsum(size[by])])[new]
        group = np.searchsorted(np.arange(_GROUP, before[-1] + _GROUP, _GROUP), before, side="right")
        cuts = new[np.concatenate([[True], group[1:] != group[:-1]])]
        for i, j in zip(cuts, np.append(cuts[1:], len(by)), strict=True):
            part = by[i:j]
            lengths = size[part]
            text = np.concatenate([body[a : a + s] for a, s in zip(begin[part].tolist(), lengths.tolist(), strict=True)])
            place, interval = repeated(text, lengths, length, _GROUP >> 3)
            upto = np.cumsum(lengths)
            which = np.searchsorted(upto, place, side="right")
            d, s = doc[part][which], start[part][which] + place - (upto - lengths)[which]
            order, first = _first_of(interval, d, s)
            yield d[order[~first]], s[order[~first]]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["kind"].iloc[0] == _MERGE:
            found = list(merged(pdf))
            return runs(*(np.concatenate(c) for c in zip(*found, strict=True)))
        h = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["a"]])
        doc, start = (np.concatenate([np.frombuffer(x, np.int64) for x in pdf[f]]) for f in ("doc", "start"))
        order, first = _first_of(h, doc, start)
        return runs(doc[order[~first]], start[order[~first]])

    return run


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _removed(length: int, with_text: bool):
    names = [f.split()[0] for f in _RESULT.split(", ")] + ["text"] * with_text
    kinds = [*[pa.int64()] * 4, pa.string()] + [pa.string()] * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, text, found in zip(b.column("doc_id").to_pylist(), texts(b), b.column("found"), strict=True):
                spans: list[list[int]] = []
                for start, end in sorted((f["start"], f["start"] + f["n"] + length - 1) for f in found.as_py() or ()):
                    if spans and start <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([start, end])
                edges = [0, *[e for s in spans for e in s], len(text)]
                kept = b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)) if spans else text
                row = (doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept.decode("utf-8", "replace")) if with_text else row)
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return run


def ordered(documents: DataFrame) -> DataFrame:
    """(_doc, doc_id, text): ``_doc`` numbers rows in document order. Distinct ids are their own numbers; where ids are
    null or repeated, rows are numbered by id, null last, rows of one id as they were read."""
    docs = doc_columns(documents, "doc_id", "text")
    rows, known, distinct = docs.agg(F.count(F.lit(1)), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if rows == known == distinct:
        return docs.withColumn("_doc", F.col("doc_id"))
    docs = numbered(docs, "ordered").withColumnRenamed("_row", "_nth")
    keys = docs.select("_nth", "doc_id", F.col("doc_id").isNull().alias("_null"))
    keys = stored(dense_key(keys, ["_null", "doc_id", "_nth"], "_doc").select("_nth", "_doc"), "document-order")
    return docs.join(small(keys), "_nth").select("_doc", "doc_id", "text")


def remove_repeats(
    documents: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, bucket_bytes: int = BUCKET_BYTES,
    merge_bytes: int = MERGE_BYTES, with_text: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256, and with
    ``with_text`` what is left (a character cut at its middle shows as U+FFFD).

    Null and empty texts have 0 bytes and lose none; texts below ``length`` lose none. Of repeated rows the first stays.
    No documents give no rows."""
    if not 0 < gram <= length:
        raise ValueError("a gram is no longer than the strings looked for")
    docs = ordered(documents)
    octets = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + octets // bucket_bytes
    found = docs.select("_doc", "text").mapInArrow(_find_units(length, gram, buckets), _DDL)
    folded = stored(found.groupBy("bucket").applyInPandas(_fold(hot), _MARKS), "units")

    shared = folded.filter("anchor IS NOT NULL")
    merge_size, hash_size = shared.agg(
        F.sum(F.when(~F.col("hot"), F.col("n") + length - 1)), F.sum(F.when(F.col("hot"), F.col("n") * 24))
    ).first()
    later = folded.filter("anchor IS NULL").select("doc", "start", "n")
    if merge_size or hash_size:
        wanted = shared.groupBy("doc").agg(F.collect_list(F.struct("hot", "start", "n", "anchor")).alias("found"))
        gather = _gather(length, 1 + (merge_size or 0) // merge_bytes, 1 + (hash_size or 0) // bucket_bytes)
        gathered = docs.join(wanted, docs["_doc"] == wanted["doc"]).select("_doc", "text", "found").mapInArrow(gather, _DDL)
        windows = gathered.groupBy("kind", "bucket").applyInPandas(_later(length), _MARKS)
        later = later.union(stored(windows.select("doc", "start", "n"), "windows"))
    spans = later.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("found"))
    joined = docs.join(spans, docs["_doc"] == spans["doc"], "left").select("doc_id", "text", "found")
    return joined.mapInArrow(_removed(length, with_text), _RESULT + ", text string" * with_text)


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents"))
