"""Cross-tokenizer alignment against whole-text encodings and counters."""

import hashlib
import json
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskloom.llm import alignment
from tests.conftest import DATA
from tests.llm.conftest import DOCUMENTS, prose


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    files = alignment.default_files()
    a = Tokenizer.from_file(files[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=files[1])
    pieces = {i: p for p, i in json.load(open(files[0]))["model"]["vocab"].items()}
    plain = {c: ByteLevel().decode([c]) for p in pieces.values() for c in p}
    letter = alignment._byte_letters()
    assert all(letter[c] == ord(d) for c, d in plain.items() if len(d) == 1 and ord(d) < 128)
    return a, b, pieces, letter


def brute(rows, tokenizers):
    """Whole texts, every pair of tokens whose byte ranges overlap."""
    a_model, b_model, pieces, letter = tokenizers
    out, links = [], []
    for i, text in rows:
        zero = (i, 0, 0, 0, 0, "")
        links.append([])
        if not text:
            out.append(zero)
            continue
        want = (" " + text).encode()
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        a_bytes = [bytes(letter[c] for c in pieces[x]) for x in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if b_model.is_byte(y) else p.replace("▁", " ").encode()
                   for y, p in ((y, b_model.id_to_piece(y)) for y in b)]
        if b"".join(a_bytes) != want or b"".join(b_bytes) != want:
            out.append(zero)
            continue
        a_end, b_end = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        a_at, b_at = a_end - [len(x) for x in a_bytes], b_end - [len(x) for x in b_bytes]
        ends = sorted(set(a_end.tolist()) & set(b_end.tolist()))
        parts, low = [], 0
        for e in ends:
            parts.append("|".join(",".join(str(t) for t, x, y in zip(ids, at, end, strict=True) if low <= x and y <= e)
                                  for ids, at, end in ((a, a_at, a_end), (b, b_at, b_end))) if len(want) < 3000 else None)
            low = e
        first = np.searchsorted(b_end, a_at, side="right")
        last = np.searchsorted(b_at, a_end, side="left")
        links[-1] = [(a[k], b[m]) for k in range(len(a)) for m in range(first[k], last[k])]
        digest = hashlib.sha256(";".join(parts).encode()).hexdigest() if None not in parts else None
        out.append((i, len(a), len(b), len(ends), len(links[-1]), digest))
    docs = Counter(p for doc in links for p in set(doc))
    most = defaultdict(int)
    for (x, _), n in docs.items():
        most[x] = max(most[x], n)
    rows = [(*r[:5], sum(docs[p] == most[p[0]] for p in doc), sum(docs[p] for p in doc), r[5]) for r, doc in zip(out, links, strict=True)]
    return rows, docs, Counter(p for doc in links for p in doc)


def same(got, want):
    got = sorted([(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got], key=str)
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert g[:7] == w[:7] and (w[7] is None or g[7] == w[7])


HARD = [
    "a  b", " lead", "trail ", "\n\nx y", "x \n y", "tab\tand  two", "it's we'll   nbsp em", "a▁b", "▁", "<0x41> <s> <unk>",
    "<|endoftext|> plain", "日本語のテキスト 🎉 ünï", "é combining", "x\x00y z\x85 w", " ", "  ", "\n", "1234567890 12,345.67", "'s 's",
    "\x1c \x1d a \x1e b", "ﬁ ½ Å", "a 　b", "word\r\nword \r word", "........ ---- ====", "﻿bom", "𝔘𝔫𝔦 ​ zero",
]


def test_corpus_and_hard_texts(spark, corpus, tokenizers, monkeypatch):
    rnd = random.Random(2)
    mixed = ["".join(rnd.choice((" ", " ", "\n", "\t", "a", "The", "é", "'s", "12", "。", " ", ".", "\x85")) for _ in range(60)) for _ in range(40)]
    rows = [(r.doc_id, r.text) for r in corpus.collect()] + [(1000 + k, t) for k, t in enumerate(HARD + mixed)]
    df = spark.createDataFrame([(i, t, "x", "x", 1) for i, t in rows], DOCUMENTS).repartition(3)
    for settings in ({}, {"BLOCK_ENTRIES": 300, "TOGETHER": 500, "MEMORY": 2_000, "LONGEST": 8}):
        for name, value in settings.items():
            monkeypatch.setattr(alignment, name, value)
        each, pairs = alignment.alignments(df, alignment.default_files())
        want, docs, links = brute(rows, tokenizers)
        same(each.collect(), want)
        got = {(r.pair >> 32, r.pair & 0xFFFFFFFF): (r.docs, r.links) for r in pairs.collect()}
        assert got == {p: (docs[p], links[p]) for p in docs}


def test_clashing_and_empty(spark, clashing, nothing, corpus):
    files = alignment.default_files()
    plain = lambda df: sorted(map(tuple, alignment.alignments(df, files)[0].collect()), key=str)
    assert plain(clashing) == plain(corpus)
    assert plain(nothing) == []


def test_containers():
    rnd = np.random.default_rng(1)
    pair = np.sort(np.repeat(rnd.integers(0, 50, 20), rnd.integers(1, 400, 20)))
    place = np.concatenate([np.arange(n) for n in np.unique(pair, return_counts=True)[1]])
    want = sorted(zip(pair.tolist(), place.tolist(), strict=True))
    for docs in (400 * 20, 1 << 16):
        got = []
        for dense, pairs, bits in alignment.containers(pair, place, docs):
            of, at = alignment.places(bits, dense)
            got += zip(pairs[of].tolist(), at.tolist(), strict=True)
            of, at = alignment.places(bits[1:], dense)  # a slice with an offset of its own
            assert len(of) == 0 or pairs[1:][of].min() >= pairs.min()
        assert sorted(got) == want
    assert alignment.places(pa.array([], pa.binary()), False)[1].size == 0


def test_long_text(spark, tokenizers):
    text = prose(random.Random(4), 4_000) + "Z" * 3_000
    rows = [(1, text), (2, text)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS)
    same(alignment.alignments(df, alignment.default_files())[0].collect(), brute(rows, tokenizers)[0])


def test_registered_query(spark, tokenizers):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    same(alignment.op12_cross_tokenizer_alignment(spark, DATA).collect(), brute(rows, tokenizers)[0])
