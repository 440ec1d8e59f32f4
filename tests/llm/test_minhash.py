"""MinHash near-duplicates against all pairs of shingle sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest

from riskloom.llm import minhash
from tests.conftest import DATA
from tests.llm.conftest import DOCUMENTS, prose

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").encode().lower())
    return frozenset(b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def brute(rows, percent=85):
    """Per row: (set size, smallest id reachable), by comparing every two sets."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    kinds = sorted({s for s in sets if s}, key=len)
    first = {}
    for k, s in enumerate(sets):
        if s:
            parent[top(k)] = top(first.setdefault(s, k))
    for a in range(len(kinds)):
        for b in range(a + 1, len(kinds)):
            if 100 * len(kinds[a]) < percent * len(kinds[b]):
                break
            both = len(kinds[a] & kinds[b])
            if 100 * both >= percent * (len(kinds[a]) + len(kinds[b]) - both):
                parent[top(first[kinds[a]])] = top(first[kinds[b]])
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None and sets[k]:
            least[top(k)] = min(least.get(top(k), i), i)
    return sorted(
        ((i, len(sets[k]), least.get(top(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str
    )


def got(df, **settings):
    return sorted(((r.doc_id, r.n, r.component_id) for r in minhash.near_duplicates(df, **settings).collect()), key=str)


def test_corpus(corpus, clashing):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    want = brute(rows)
    assert got(corpus) == want and got(clashing) == want


def family(rnd, size, words, edits):
    """Copies of a text with so many words changed, and some copies of copies: chains that the first document misses."""
    base = prose(rnd, words).split()
    out = []
    for k in range(size):
        text = list(rnd.choice(out[-5:]) if out and k % 3 == 0 else base)
        for _ in range(rnd.randint(0, edits)):
            text[rnd.randrange(len(text))] = f"x{rnd.randrange(10**6)}"
        out.append(text)
    return [" ".join(t) for t in out]


@pytest.mark.parametrize("chunk", [minhash.CHUNK, 7])
def test_families_of_near_copies(spark, monkeypatch, chunk):
    monkeypatch.setattr(minhash, "CHUNK", chunk)
    monkeypatch.setattr(minhash, "STAR", 10)
    rnd = random.Random(11)
    texts = [t for words, edits in ((60, 4), (150, 9), (200, 25), (12, 1)) for t in family(rnd, 60, words, edits)]
    rnd.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCUMENTS).repartition(3)
    assert got(df) == brute(rows)
    assert got(df, percent=92) == brute(rows, 92)


def test_edge_texts(spark, nothing):
    rows = [(1, "A b C"), (2, "a B c a b c"), (3, "a b"), (4, "A\tb"), (5, "a"), (6, None), (7, ""), (None, "A"), (None, "zz"), (None, "zz"), (8, "ab")]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)
    assert got(df) == brute(rows)
    assert got(nothing) == []
    with pytest.raises(ValueError):
        minhash.near_duplicates(df, percent=50)


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(1)
    whole = np.unique(rnd.integers(0, 2**64, 3000, np.uint64))
    agreed = np.mean([
        np.mean(minhash.signature(np.sort(s[:900])) == minhash.signature(np.sort(s[100:])))
        for s in (rnd.permutation(whole)[:1000] for _ in range(60))
    ])
    assert agreed == pytest.approx(0.8, abs=0.01)
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65_537)
    y = x.copy()
    minhash._permute(y, np.empty_like(y))
    assert len(np.unique(y)) == len(x)


def test_long_texts_by_blocks(monkeypatch):
    text = prose(random.Random(3), 5_000).encode()
    want = minhash.shingle_set(text)
    monkeypatch.setattr(minhash, "text_blocks", lambda t: re.split(rb"(?<=e)(?= )", t))
    assert np.array_equal(minhash.shingle_set(text), want) and len(want) == len(shingles(text.decode()))


def test_registered_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    found = minhash.op13_minhash_near_dedup(spark, DATA).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    groups = defaultdict(list)
    for r in found:
        groups[r.component_id].append(r.kept)
    assert all(sum(g) == 1 for g in groups.values())
