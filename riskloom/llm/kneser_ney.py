"""Interpolated modified Kneser-Ney n-gram model, counted in Spark, looked up in memory-mapped arrays.

Three passes read the texts: word counts, n-gram counts, scores. Tasks turn words
into 64-bit hashes, combine equal n-grams before the shuffle, and send each
bucket one block of arrays instead of a row per n-gram. A bucket holds all
n-grams whose last history word hashes to it, so that continuation counts and
history totals of every order above one are local to it; words too frequent for
that are found by the first pass, and their n-grams are spread by the predicted
word. A reducer merges its blocks and writes sorted hash arrays to a folder that
all executors mount; scoring tasks map these files into memory and look their
distinct n-grams up in sorted order. No task and no worker holds the model.

Files are renamed into place when whole, and a repeated task writes the same
bytes, so losing an executor does no harm.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import doc_columns, read, text_blocks, texts, worker_memory
from riskloom.storage import scratch_path

ORDER = 2
#: Bytes of text per bucket: the unit of a reducer's memory.
BUCKET_BYTES = 16 << 20
#: Tokens that a task combines before it sends them on, and that are scored together.
FLUSH, CHUNK = 2_000_000, 500_000
MAX_WORDS = 600_000
#: Base model: additive smoothing.
ADDED = 0.1
FALLBACK_DISCOUNTS = (0.5, 1.0, 1.5)

_U = np.uint64
_BEGIN, _END = _U(0x9AE16A3B2F90404F), _U(0xC949D7C7509E6557)
_M1, _M2 = _U(0x9E3779B97F4A7C15), _U(0xBF58476D1CE4E5B9)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the pair (a, b)."""
    x = (a * _M1) ^ (b + (a >> _U(31)))
    x = (x ^ (x >> _U(30))) * _M2
    x = (x ^ (x >> _U(27))) * _M1
    return x ^ (x >> _U(31))


class _Memo(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _hashes(text: bytes, memo: _Memo) -> Iterator[np.ndarray]:
    """Word hashes of a lower-cased text, block by block."""
    for block in text_blocks(text):
        words = block.lower().split()
        if len(memo) > MAX_WORDS:
            memo.clear()
        yield np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def _memo() -> _Memo:
    held = worker_memory("kneser-ney")
    if "memo" not in held:
        held["memo"] = _Memo()
    return held["memo"]


def _grams(text: bytes, order: int, memo: _Memo) -> Iterator[np.ndarray]:
    """Blocks of a text's tokens, each behind the order - 1 tokens before it; the last block ends with the end token."""
    head = np.full(order - 1, _BEGIN, np.uint64)
    for words in _hashes(text, memo):
        yield (block := np.concatenate([head, words]))
        head = block[len(block) - order + 1 :]
    yield np.concatenate([head, [_END]])


def _columns(block: np.ndarray, order: int) -> list[np.ndarray]:
    """[h_n, ..., h_2, w]: hash of the n-1 words before each token, then of fewer, then the token."""
    n = len(block) - order + 1
    out = [block[order - 1 :], block[order - 2 : order - 2 + n]] if order > 1 else [block]
    for k in range(3, order + 1):
        out.append(_mix(block[order - k : order - k + n], out[-1]))
    return out[::-1]


@dataclass
class Plan:
    """What workers need to find an n-gram's bucket."""

    folder: str
    order: int
    buckets: int
    hot: list[int] = field(default_factory=list)


def _spread(x: np.ndarray, buckets: int) -> np.ndarray:
    return ((x >> _U(33)) % _U(buckets)).astype(np.int64)


def _bucket(last: np.ndarray, word: np.ndarray, plan: Plan) -> np.ndarray:
    """Bucket of the n-grams of history word ``last`` and predicted ``word``."""
    home = _spread(_mix(last, np.zeros_like(last)), plan.buckets)
    if not plan.hot:
        return home
    return np.where(np.isin(last, np.array(plan.hot, np.uint64)), _spread(_mix(last, word), plan.buckets), home)


def _groups(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Distinct keys in order, sums of the values per key, and one place of each key."""
    if not len(keys):
        return keys, [v[:0] for v in values], np.zeros(0, np.int64)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], [np.add.reduceat(v[order], first) for v in values], order[first]


_BLOCK_FIELDS = ("keys", "sizes", "words", "more", "counts")
_BLOCK = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), *[(f, pa.binary()) for f in _BLOCK_FIELDS]])
_BLOCK_DDL = "kind int, bucket long, " + ", ".join(f"{f} binary" for f in _BLOCK_FIELDS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_BLOCK)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _BLOCK.types, strict=True)], schema=_BLOCK)


def _save(plan: Plan, name: str, array: np.ndarray) -> None:
    part = f"{plan.folder}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as f:
        np.save(f, array)
    os.replace(part, f"{plan.folder}/{name}.npy")


def _save_counts(plan: Plan, name: str, keys: np.ndarray, counts: np.ndarray) -> None:
    """Sorted keys, a byte per count, and the counts of 255 and more apart."""
    large = counts >= 255
    _save(plan, f"{name}-keys", keys)
    _save(plan, f"{name}-counts", np.where(large, 255, counts).astype(np.uint8))
    _save(plan, f"{name}-large", np.stack([keys[large], counts[large].astype(np.uint64)]) if large.any() else np.zeros((2, 0), np.uint64))


# Words ----------------------------------------------------------------------------------------------------------------


def _count_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, size = _memo(), [], 0

        def send() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64),) * 2
            place = _spread(keys, buckets)
            order = np.argsort(place, kind="stable")
            ends = np.searchsorted(place[order], np.arange(buckets + 1))
            rows = []
            for b in np.flatnonzero(np.diff(ends)).tolist():
                part = order[ends[b] : ends[b + 1]]
                rows.append((0, b, keys[part].tobytes(), b"", b"", b"", counts[part].astype(np.uint64).tobytes()))
            return _rows(rows)

        for batch in batches:
            for text in texts(batch):
                for words in _hashes(text, memo):
                    held.append(words)
                    size += len(words)
                held.append(np.array([_END]))
                size += 1
                if size > FLUSH:
                    yield send()
                    held, size = [], 0
        yield send()

    return run


def _reduce_words(plan: Plan, hot_count: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["bucket"].iloc[0])
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["keys"]])
        counts = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["counts"]])
        keys, (counts,), _ = _groups(keys, counts)
        _save(plan, f"words-{bucket}-keys", keys)
        _save(plan, f"words-{bucket}-counts", counts)
        hot = np.sort(keys[counts >= hot_count]).view(np.int64).tolist()
        return pd.DataFrame({"types": [len(keys)], "tokens": [int(counts.sum())], "hot": [hot]})

    return run


# N-grams --------------------------------------------------------------------------------------------------------------


def _count_grams(plan: Plan):
    order = plan.order

    def send(held: list[list[np.ndarray]]) -> pa.RecordBatch:
        if not held:
            return _rows([])
        columns = [np.concatenate(c) for c in zip(*held, strict=True)]
        _, (counts,), at = _groups(_mix(columns[0], columns[-1]), np.ones(len(columns[0]), np.uint64))
        columns = [c[at] for c in columns]
        last, words = columns[-2], columns[-1]
        place = _bucket(last, words, plan)
        by = np.lexsort((last, place))
        last, words, counts, place, more = last[by], words[by], counts[by], place[by], [c[by] for c in columns[:-2]]
        ends = np.searchsorted(place, np.arange(plan.buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(ends)).tolist():
            s = slice(ends[b], ends[b + 1])
            start = np.flatnonzero(np.concatenate([[True], last[s][1:] != last[s][:-1]]))
            sizes = np.diff(np.append(start, len(last[s]))).astype(np.uint32)
            extra = b"".join(np.ascontiguousarray(m[s]).tobytes() for m in more)
            rows.append((2, b, last[s][start].tobytes(), sizes.tobytes(), words[s].tobytes(), extra, counts[s].astype(np.uint32).tobytes()))
        return _rows(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, size = _memo(), [], 0
        for batch in batches:
            for text in texts(batch):
                for block in _grams(text, order, memo):
                    held.append(_columns(block, order))
                    size += len(block)
                if size > FLUSH:
                    yield send(held)
                    held, size = [], 0
        yield send(held)

    return run


def _count_of_counts(counts: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)[1:5].tolist()


def _reduce_grams(plan: Plan):
    """Per bucket: the orders' count arrays. Sent on: continuation counts of words (kind 1), history totals of order k
    (kind k), and count-of-counts (kind 0)."""

    def sent(kind: int, keys: np.ndarray, values: list[np.ndarray], out: list[tuple]) -> None:
        place = _spread(keys, plan.buckets)
        by = np.argsort(place, kind="stable")
        ends = np.searchsorted(place[by], np.arange(plan.buckets + 1))
        for b in np.flatnonzero(np.diff(ends)).tolist():
            part = by[ends[b] : ends[b + 1]]
            out.append((kind, b, keys[part].tobytes(), b"", b"", b"", np.stack([v[part].astype(np.uint64) for v in values]).tobytes()))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket, columns = int(pdf["bucket"].iloc[0]), []
        for r in pdf.itertuples(index=False):
            words = np.frombuffer(r.words, np.uint64)
            last = np.repeat(np.frombuffer(r.keys, np.uint64), np.frombuffer(r.sizes, np.uint32))
            more = np.frombuffer(r.more, np.uint64).reshape(plan.order - 2, len(words))
            columns.append([*more, last, words, np.frombuffer(r.counts, np.uint32).astype(np.uint64)])
        *columns, counts = [np.concatenate(c) for c in zip(*columns, strict=True)]
        out: list[tuple] = []
        seen = []
        for k in range(plan.order, 1, -1):
            keys, (counts,), at = _groups(_mix(columns[0], columns[-1]), counts)
            columns = [c[at] for c in columns]
            _save_counts(plan, f"grams{k}-{bucket}", keys, counts)
            seen.append([k, *_count_of_counts(counts)])
            ones = [(counts == n).astype(np.uint64) if n < 3 else (counts >= 3).astype(np.uint64) for n in (1, 2, 3)]
            histories, sums, _ = _groups(columns[0], counts, *ones)
            sent(k, histories, sums, out)
            counts = np.ones(len(keys), np.uint64)  # each distinct n-gram continues the shorter one behind its first word
            columns = columns[1:] if k > 2 else columns
        words, (counts,), _ = _groups(columns[-1], counts)
        sent(1, words, [counts], out)
        out.append((0, 0, b"", b"", b"", b"", np.array(seen, np.uint64).tobytes()))
        return pd.DataFrame(out, columns=["kind", "bucket", *_BLOCK_FIELDS])

    return run


def _reduce_totals(plan: Plan):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kind, bucket = int(pdf["kind"].iloc[0]), int(pdf["bucket"].iloc[0])
        if kind == 0:
            seen = np.concatenate([np.frombuffer(x, np.uint64).reshape(-1, 5) for x in pdf["counts"]])
            kinds, sums, _ = _groups(seen[:, 0], *seen[:, 1:].T)
            rows = np.stack([kinds, *sums], axis=1).astype(np.int64).tolist()
            return pd.DataFrame({"kind": [r[0] for r in rows], "seen": [r[1:] for r in rows], "total": 0})
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["keys"]])
        values = np.concatenate(
            [np.frombuffer(x, np.uint64).reshape(-1, len(k) // 8) for x, k in zip(pdf["counts"], pdf["keys"], strict=True)], axis=1
        )
        keys, sums, _ = _groups(keys, *values)
        if kind == 1:
            _save_counts(plan, f"grams1-{bucket}", keys, sums[0])
            return pd.DataFrame({"kind": [1], "seen": [_count_of_counts(sums[0])], "total": [int(sums[0].sum())]})
        _save(plan, f"history{kind}-{bucket}-keys", keys)
        _save(plan, f"history{kind}-{bucket}-totals", sums[0].astype(np.float64))
        _save(plan, f"history{kind}-{bucket}-kinds", np.stack(sums[1:]).astype(np.uint32))
        return pd.DataFrame({"kind": [kind], "seen": [[0, 0, 0, 0]], "total": [0]})

    return run


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of 1, 2, and 3 or more, from the numbers of n-grams seen 1 to 4 times;
    fixed ones where a number is 0 or an estimate leaves its range, as in tiny corpora."""
    if min(n) == 0:
        return FALLBACK_DISCOUNTS
    y = n[0] / (n[0] + 2 * n[1])
    found = tuple(k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3))
    return found if all(0 < d <= k for k, d in enumerate(found, 1)) else FALLBACK_DISCOUNTS


@dataclass
class Model:
    """The small part of a fitted model; ``plan.folder`` has the arrays."""

    plan: Plan
    tokens: int
    types: int
    continuations: int
    discounts: dict[int, tuple[float, float, float]]

    def save(self) -> None:
        with open(f"{self.plan.folder}/model.json", "w") as f:
            json.dump(asdict(self), f)

    @staticmethod
    def load(folder: str) -> Model:
        with open(f"{folder}/model.json") as f:
            d = json.load(f)
        return Model(Plan(**{**d["plan"], "folder": folder}), d["tokens"], d["types"], d["continuations"], {int(k): tuple(v) for k, v in d["discounts"].items()})


def mounted_folder(spark: SparkSession) -> str:
    """A new folder under the session's shared one, as a path for workers. A model is made of files that workers map, so
    the shared folder must be mounted; in another store, give ``fit`` a folder that is."""
    path = scratch_path(spark, "llm-kneser-ney")
    if "://" in path and not path.startswith("file:"):
        raise ValueError("spark.checkpoint.dir is not a mounted folder; give fit a folder that all executors mount")
    return path.removeprefix("file:").replace("//", "/", 1) if path.startswith("file:") else path


def fit(train: DataFrame, order: int = ORDER, folder: str | None = None, bucket_bytes: int = BUCKET_BYTES) -> Model:
    """Count ``train.text`` and write the model. Null texts count as empty: their end token is seen. A corpus without
    rows gives a model that knows nothing and gives every token probability 1 / (types + 1) = 1."""
    if order < 2:
        raise ValueError("the order is at least 2")
    spark = train.sparkSession
    docs = train.select("text")
    octets = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    plan = Plan(folder or mounted_folder(spark), order, 1 + octets // bucket_bytes)
    os.makedirs(plan.folder, exist_ok=True)
    # A history word whose n-grams would fill a quarter of a bucket is spread; at eight bytes or more per token there
    # are at most four such words per bucket.
    hot_count = max(2, octets // 8 // (4 * plan.buckets)) if plan.buckets > 1 else 1 << 62
    words = docs.mapInArrow(_count_words(plan.buckets), _BLOCK_DDL).groupBy("kind", "bucket")
    found = words.applyInPandas(_reduce_words(plan, hot_count), "types long, tokens long, hot array<long>")
    types, tokens, hot = found.agg(F.sum("types"), F.sum("tokens"), F.flatten(F.collect_list("hot"))).first()
    plan.hot = [h % (1 << 64) for h in hot or []]
    counted = docs.mapInArrow(_count_grams(plan), _BLOCK_DDL).groupBy("bucket").applyInPandas(_reduce_grams(plan), _BLOCK_DDL)
    totals = counted.groupBy("kind", "bucket").applyInPandas(_reduce_totals(plan), "kind int, seen array<long>, total long")
    sums = totals.groupBy("kind").agg(*[F.sum(F.get("seen", F.lit(i))).alias(f"n{i}") for i in range(4)], F.sum("total").alias("total"))
    by = {r["kind"]: r for r in sums.collect()}
    ds = {k: discounts([by[k][f"n{i}"] for i in range(4)]) if k in by else FALLBACK_DISCOUNTS for k in range(1, order + 1)}
    unigrams = by[1]["total"] if 1 in by else 0
    model = Model(plan, tokens or 0, types or 0, unigrams, ds)
    low = [by[1][f"n{i}"] for i in range(4)] if 1 in by else [0] * 4
    _save(plan, "unigram-kinds", np.array([low[0], low[1], (types or 0) - low[0] - low[1]], np.float64))
    model.save()
    return model


# Scoring --------------------------------------------------------------------------------------------------------------


class _Arrays:
    """The model's files, mapped when first asked for."""

    def __init__(self, folder: str):
        self.folder, self.open = folder, {}

    def __call__(self, name: str) -> np.ndarray | None:
        if name not in self.open:
            path = f"{self.folder}/{name}.npy"
            self.open[name] = np.load(path, mmap_mode="r") if os.path.exists(path) else None
        return self.open[name]

    def find(self, name: str, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of sorted keys in a sorted file, and which of them are there."""
        held = self(name)
        if held is None or not len(held):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(held, keys), len(held) - 1)
        return at, held[at] == keys

    def each(self, bucket: np.ndarray, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(bucket, places of its keys, in the order of the keys)."""
        by = np.lexsort((keys, bucket))
        b = bucket[by]
        cut = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1], [True]])) if len(b) else [0]
        for i, j in zip(cut[:-1], cut[1:], strict=True):
            yield int(b[i]), by[i:j]

    def counts(self, name: str, bucket: np.ndarray, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys))
        for b, at in self.each(bucket, keys):
            place, hit = self.find(f"{name}-{b}-keys", keys[at])
            if hit.any():
                found = self(f"{name}-{b}-counts")[place[hit]].astype(float)
                large = found == 255
                if large.any():
                    more = self(f"{name}-{b}-large")
                    found[large] = more[1][np.searchsorted(more[0], keys[at][hit][large])]
                out[at[hit]] = found
        return out


def _distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one place of each distinct combination, which of them each row is)."""
    key = columns[0]
    for c in columns[1:]:
        key = _mix(key, c)
    _, first, inverse = np.unique(key, return_index=True, return_inverse=True)
    return first, inverse


class Scorer:
    """Log10 probabilities of tokens under both models."""

    def __init__(self, model: Model):
        self.model, self.plan, self.arrays = model, model.plan, _Arrays(model.plan.folder)

    def word_counts(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words))
        for b, at in self.arrays.each(_spread(words, self.plan.buckets), words):
            place, hit = self.arrays.find(f"words-{b}-keys", words[at])
            if hit.any():
                out[at[hit]] = self.arrays(f"words-{b}-counts")[place[hit]]
        return out

    def _discounted(self, counts: np.ndarray, level: int) -> np.ndarray:
        d = np.array([0.0, *self.model.discounts[level]])
        return counts - d[np.minimum(counts, 3).astype(np.int64)]

    def unigrams(self, words: np.ndarray) -> np.ndarray:
        """Continuation probabilities, the share of unknown words spread over one more type."""
        m = self.model
        if not m.continuations:
            return np.full(len(words), 1.0 / (m.types + 1))
        counts = self.arrays.counts("grams1", _spread(words, self.plan.buckets), words)
        kinds = self.arrays("unigram-kinds")
        free = sum(d * k for d, k in zip(m.discounts[1], kinds, strict=True))
        return (self._discounted(counts, 1) + free / (m.types + 1)) / m.continuations

    def _histories(self, keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """(total, discounted mass) of histories; total 0 where unseen."""
        total, free = np.zeros(len(keys)), np.zeros(len(keys))
        for b, at in self.arrays.each(_spread(keys, self.plan.buckets), keys):
            place, hit = self.arrays.find(f"history{level}-{b}-keys", keys[at])
            if hit.any():
                total[at[hit]] = self.arrays(f"history{level}-{b}-totals")[place[hit]]
                kinds = self.arrays(f"history{level}-{b}-kinds")[:, place[hit]]
                free[at[hit]] = np.array(self.model.discounts[level]) @ kinds
        return total, free

    def tokens(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(training count, probability) of each token; columns as ``_columns`` gives them."""
        word, which = np.unique(columns[-1], return_inverse=True)
        count, p = self.word_counts(word)[which], self.unigrams(word)[which]
        for level in range(2, self.plan.order + 1):
            history = columns[-level]
            one, inverse = _distinct(history)
            total, free = self._histories(history[one], level)
            total, free = total[inverse], free[inverse]
            one, inverse = _distinct(history, columns[-1])
            keys = _mix(history[one], columns[-1][one])
            counts = self.arrays.counts(f"grams{level}", _bucket(columns[-2][one], columns[-1][one], self.plan), keys)
            known = total > 0
            p[known] = (self._discounted(counts, level)[inverse][known] + free[known] * p[known]) / total[known]
        return count, p


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def score(documents: DataFrame, model: Model, held_out: Column | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity. Null texts
    are empty: they have the end token alone. Null and repeated doc_ids are documents of their own."""
    about, folder = json.dumps(asdict(model)), model.plan.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = json.loads(about)
        held = worker_memory("kneser-ney-model")
        if held.get("folder") != folder:
            held.clear()
            ds = {int(k): tuple(v) for k, v in d["discounts"].items()}
            held.update(folder=folder, scorer=Scorer(Model(Plan(**d["plan"]), d["tokens"], d["types"], d["continuations"], ds)))
        scorer, memo, order = held["scorer"], _memo(), d["plan"]["order"]
        whole = np.log10(d["tokens"] + ADDED * (d["types"] + 1))

        def add(docs: np.ndarray, columns: list[list[np.ndarray]], sums: np.ndarray) -> None:
            count, p = scorer.tokens([np.concatenate(c) for c in zip(*columns, strict=True)])
            for k, v in enumerate((np.ones(len(p)), count > 0, np.log10(count + ADDED) - whole, np.log10(p))):
                sums[k] += np.bincount(docs, v, sums.shape[1])

        for batch in batches:
            sums, docs, columns, size = np.zeros((4, batch.num_rows)), [], [], 0
            for i, text in enumerate(texts(batch)):
                for block in _grams(text, order, memo):
                    columns.append(_columns(block, order))
                    docs.append(np.full(len(columns[-1][0]), i))
                    size += len(block)
                    if size > CHUNK:
                        add(np.concatenate(docs), columns, sums)
                        docs, columns, size = [], [], 0
            if docs:
                add(np.concatenate(docs), columns, sums)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"), pa.array(sums[0].astype(np.int64)),
                    pa.array(sums[1].astype(np.int64)), pa.array(np.full(n, d["tokens"], np.int64)), pa.array(sums[2]),
                    pa.array(sums[3]), pa.array(10.0 ** (-sums[3] / np.maximum(sums[0], 1))),
                ],
                names=[f.split()[0] for f in _SCORES.split(", ")],
            )

    flag = F.lit(False) if held_out is None else held_out
    return documents.select("doc_id", "text", flag.alias("held_out")).mapInArrow(run, _SCORES)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document without an id counts as held out."""
    documents = doc_columns(read(spark, sf_dir, "documents"), "doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(True))
    return score(documents, fit(documents.filter(~held_out)), held_out)
