"""The registered queries over the provided tables, against brute force. Those with SQL are compared in tests/test_queries."""

import html
import importlib
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from riskloom.llm import packing, unigram
from tests.conftest import DATA
from tests.llm.test_model_operators import Counted, removed, tokens
from tests.llm.test_text_operators import WORD, fingerprint, groups, library, targets

QUERIES = importlib.import_module("__spark_entry__").queries()


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def by_id(spark, name):
    rows = QUERIES[name](spark, DATA).collect()
    out = {r.doc_id: r for r in rows}
    assert len(out) == len(rows)
    return out


def test_op1(spark, documents):
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in documents}
    brute = Counted([d.text for i, d in documents.items() if not held[i]], 2)
    got = by_id(spark, "op1_lm_scoring")
    assert set(got) == set(documents)
    for i, r in got.items():
        words = tokens(documents[i].text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(words), sum(w in brute.words for w in words), brute.n)
        assert r.base_score == pytest.approx(brute.base(documents[i].text))
        assert r.score == pytest.approx(brute.score(documents[i].text))


def test_op2(spark, documents):
    found = defaultdict(list)
    for r in QUERIES["op2_secret_scan"](spark, DATA).collect():
        found[r.doc_id].append(r)
    for i, d in documents.items():
        for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', d.text or ""):
            assert any(r.start <= m.start(1) and m.end(1) <= r.start + r.length and r.is_secret for r in found[i])
        for r in found[i]:
            assert not (r.is_secret and d.text[r.start : r.start + r.length].isdigit())


def test_op5(spark, documents):
    size = {i: len(WORD.findall(d.text or "")) for i, d in documents.items()}
    sources = defaultdict(int)
    for i, d in documents.items():
        sources[d.source] += size[i]
    want, taken = targets(sources), defaultdict(int)
    got = by_id(spark, "op5_source_mixing")
    for i, r in got.items():
        source = documents[i].source
        assert (r["size"], r.source_size) == (size[i], sources[source]) and r.target == pytest.approx(want[source])
        assert 0 <= r.taken <= 3 * size[i]
        taken[source] += r.taken
    assert all(abs(taken[s] - t) <= 0.02 * t + 20 for s, t in want.items())
    assert {i: r.taken for i, r in by_id(spark, "op5_source_mixing").items()} == {i: r.taken for i, r in got.items()}


def test_op6(spark, documents):
    prints = {i: fingerprint(d.text) for i, d in documents.items()}
    group, least = groups(prints.values()), {}
    for i, p in prints.items():
        least[group[p]] = min(least.get(group[p], i), i)
    got = by_id(spark, "op6_simhash_near_dedup")
    assert {i: (r.fingerprint, r.component_id) for i, r in got.items()} == {
        i: (f"{p:016x}", least[group[p]]) for i, p in prints.items()
    }


def test_op7(spark, documents):
    made = library(unigram.vocabulary(unigram.default_vocabulary()), True)
    got = by_id(spark, "op7_token_counts")
    assert {i: r.n_tokens for i, r in got.items()} == {
        i: len(made.encode(d.text or "", add_special_tokens=False).ids) for i, d in documents.items()
    }


def test_op8(spark, documents):
    from tokenizers import Tokenizer

    made, want, total = Tokenizer.from_file(packing.default_tokenizer()), set(), 0
    for i, d in documents.items():
        ids = np.array(made.encode(d.text or "", add_special_tokens=False).ids + [0], "<u4")
        total += len(ids)
        want |= {(i, k, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())) for k, at in enumerate(range(0, len(ids), 2048))}
    rows = QUERIES["op8_best_fit_packing"](spark, DATA).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= 2048
    assert len(sequences) <= 1.02 * total / 2048 + 1


def test_op9(spark, documents):
    got = by_id(spark, "op9_suffix_array_dedup")
    rows = sorted((i, d.text) for i, d in documents.items())
    assert [tuple(got[i])[1:] for i, _ in rows] == removed(rows, 100)


def test_op10(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = {r.page_id: r for r in QUERIES["op10_html_extraction"](spark, DATA).collect()}
    assert set(got) == set(pages)
    for i, p in pages.items():
        article = re.search("<article>(.*?)(</article>|$)", p.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split("</?(?:p|h1|br)>", article)]
        want = "\n".join(x for x in parts if x)
        assert (got[i].url, got[i].text, got[i].n_chars) == (p.url, want, len(want))
