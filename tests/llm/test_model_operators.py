"""The n-gram model, repeated passages, pages, top-k and the pipeline against brute force, over awkward inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskloom.llm import bwt, kneser_ney, pages, suffix_dedup, topk
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) + ["</s>"]


class Counted:
    """The model over dictionaries, by its definition."""

    def __init__(self, texts, order):
        self.order, self.words = order, Counter()
        self.counts = {order: Counter()}
        for text in texts:
            line = ["<s>"] * (order - 1) + tokens(text)
            self.words.update(line[order - 1 :])
            self.counts[order].update(tuple(line[i - order + 1 : i + 1]) for i in range(order - 1, len(line)))
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.d = {k: kneser_ney.discounts([sum(c == j for c in self.counts[k].values()) for j in (1, 2, 3, 4)]) for k in self.counts}
        self.history = defaultdict(lambda: [0, 0, 0, 0])
        for k, counts in self.counts.items():
            for g, c in counts.items():
                held = self.history[k, g[:-1]]
                held[0] += c
                held[min(c, 3)] += 1

    def p(self, gram):
        k = len(gram)
        lower = self.p(gram[1:]) if k > 1 else 1 / (self.v + 1)
        if (k, gram[:-1]) not in self.history:
            return lower
        held, d, c = self.history[k, gram[:-1]], (0, *self.d[k]), self.counts[k].get(gram, 0)
        return (c - d[min(c, 3)] + sum(d[j] * held[j] for j in (1, 2, 3)) * lower) / held[0]

    def score(self, text):
        line = ["<s>"] * (self.order - 1) + tokens(text)
        return sum(math.log10(self.p(tuple(line[i - self.order + 1 : i + 1]))) for i in range(self.order - 1, len(line)))

    def base(self, text):
        return sum(math.log10((self.words.get(t, 0) + 0.1) / (self.n + 0.1 * (self.v + 1))) for t in tokens(text))


@pytest.mark.parametrize(("order", "bucket_bytes"), [(2, 32 << 20), (2, 40_000), (3, 100_000), (4, 60_000)])
def test_scores(corpus, clashing, order, bucket_bytes, monkeypatch):
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(True))
    rows = corpus.collect()
    out = lambda r: r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 10 == 0
    brute = Counted([r.text for r in rows if not out(r)], order)
    model = kneser_ney.fit(clashing.filter(~held_out), order, bucket_bytes=bucket_bytes)
    assert (model.tokens, model.types) == (brute.n, brute.v)
    got = sorted(kneser_ney.score(clashing, model, held_out).collect(), key=lambda r: (str(r.doc_id), r.n_tokens, round(r.score, 6)))
    want = sorted(
        (str(r.doc_id), len(tokens(r.text)), round(brute.score(r.text), 6), brute.base(r.text), sum(t in brute.words for t in tokens(r.text)), out(r))
        for r in rows
    )
    for r, (doc, n, score, base, known, held) in zip(got, want, strict=True):
        assert (str(r.doc_id), r.n_tokens, r.n_known, r.held_out, r.train_tokens) == (doc, n, known, held, brute.n)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score, abs=1e-5)


def test_probabilities_sum_to_one():
    brute = Counted(["a b a c", "b a b", "c c a d d"], 3)
    for h in (("a", "b"), ("x", "a"), ("<s>", "<s>")):
        assert sum(brute.p((*h, w)) for w in [*brute.words, "unseen"]) == pytest.approx(1)


def test_better_than_the_base_on_held_out_text(spark):
    from tests.conftest import DATA

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    rows = kneser_ney.score(docs, kneser_ney.fit(docs.filter(~held_out)), held_out).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_model_from_nothing(corpus, nothing):
    model = kneser_ney.fit(nothing)
    assert (model.tokens, model.types) == (0, 0)
    assert all(r.score == r.base_score == 0 and r.n_known == 0 for r in kneser_ney.score(corpus, model).collect())
    assert kneser_ney.score(nothing, model).count() == 0
    assert kneser_ney.Model.load(model.plan.folder) == model


# Repeated passages


def test_merged_transforms():
    rnd = random.Random(3)
    for i in range(120):
        strings = [bytes(rnd.choice(b"abc") for _ in range(rnd.randint(1, 30))) * rnd.randint(1, 1 + 3 * (i % 3 == 0)) for _ in range(rnd.randint(1, 15))]
        depth = rnd.choice((1, 2, 3, 5, 8))
        text, lengths = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
        place, interval = bwt.repeated(text, lengths, depth, rnd.choice((10, 40, 1000)))
        want, at = defaultdict(list), 0
        for s in strings:
            for k in range(len(s) - depth + 1):
                want[s[k : k + depth]].append(at + k)
            at += len(s)
        got = defaultdict(list)
        for p, n in zip(place.tolist(), interval.tolist(), strict=True):
            got[n].append(p)
        assert sorted(sorted(v) for v in got.values()) == sorted(v for v in want.values() if len(v) > 1)


def test_a_round_takes_only_rows_that_lead_to_whole_strings(monkeypatch):
    rnd = random.Random(5)
    strings = [rnd.randbytes(40).replace(b"\xff", b"a") + b"x" * 40 + rnd.randbytes(40).replace(b"\xff", b"a") for _ in range(30)] + [b"short"]
    text, lengths = np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings])
    taken, refined = [], bwt._refined
    monkeypatch.setattr(bwt, "_refined", lambda b, longer, rows, block: taken.append(len(rows)) or refined(b, longer, rows, block))
    place, interval = bwt.repeated(text, lengths, 100, 1000)
    assert len(place) == len(interval) == 0
    assert taken[0] == 30 * 21 and sum(taken) < 30 * 21 * 30  # one row per window, fewer once windows differ


def test_merge_order_and_common_prefixes():
    strings = [b"banana", b"ananas", b"bandana", b"nab"]
    split = [strings[:2], strings[2:]]
    shards = [bwt.shard(np.frombuffer(b"".join(p), np.uint8), np.array([len(s) for s in p])) for p in split]
    rows, common, border = bwt.merge(shards, 20)
    suffixes = []
    for j, part in enumerate(split):
        ended = b"".join(s + b"\0" for s in part)
        for p in shards[j].places.tolist():
            suffixes.append(ended[p : ended.index(0, p)])
    merged = [suffixes[r] for r in rows.tolist()]
    assert merged == sorted(merged) and border.all()
    for k in range(1, len(merged)):
        a, b = merged[k - 1], merged[k]
        same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert common[k] == same


def removed(rows, length):
    """By the definition, over (order, text) in document order."""
    seen, out = set(), []
    for _, text in rows:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            window = body[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(x for x, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(body), len(body) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture(scope="module")
def passages(spark):
    """Passages in changing surroundings, periodic texts, copies; distinct ids."""
    rnd = random.Random(11)
    shared = [prose(rnd, n) for n in (8, 20, 60, 200)]
    texts = []
    for i in range(120):
        parts = [prose(rnd, rnd.randint(1, 40)) for _ in range(3)]
        texts.append(parts[0] + " " + rnd.choice(shared) + " " + parts[1] + (" " + rnd.choice(shared) if i % 3 == 0 else "") + parts[2])
    texts += [texts[5], texts[5] + "x", "x" + texts[6], "ab" * 300, "abc" * 400, "x" * 777, ("na " * 90 + "é") * 3, None, "", "ü" * 49, "ü" * 50 + "ü" * 50]
    texts += [t[:150] + "#" + t[150:] for t in texts[:20]] + [prose(rnd, 60_000)]
    rnd.shuffle(texts)
    rows = list(enumerate(texts))
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows


@pytest.mark.parametrize("given", [{}, {"hot": 1}, {"hot": 4, "bucket_bytes": 20_000, "merge_bytes": 5_000}, {"length": 50, "gram": 20}, {"length": 30, "gram": 30}])
def test_repeats(passages, given):
    docs, rows = passages
    got = [tuple(r)[1:] for r in sorted(suffix_dedup.remove_repeats(docs, **given).collect(), key=lambda r: r.doc_id)]
    assert got == removed(rows, given.get("length", 100))


def test_repeats_in_small_chunks(passages, monkeypatch):
    docs, rows = passages
    for name, value in (("_CHUNK", 500), ("_FLUSH", 300), ("_GROUP", 400)):
        monkeypatch.setattr(suffix_dedup, name, value)
    got = [tuple(r)[1:] for r in sorted(suffix_dedup.remove_repeats(docs).collect(), key=lambda r: r.doc_id)]
    assert got == removed(rows, 100)


def test_repeats_with_null_and_repeated_ids(corpus, clashing, nothing):
    rows = corpus.collect()
    got = suffix_dedup.remove_repeats(clashing, with_text=True).collect()
    # Rows of one id are equal, empty, or differ in their first bytes here, so any order of theirs gives these results.
    want = removed(sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in rows if r.text is not None) , 100)
    assert Counter(tuple(r)[1:5] for r in got if r.n_bytes) == Counter(w for w in want if w[0])
    assert len(got) == len(rows)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == r.kept_sha256 for r in got if "�" not in r.text)
    assert suffix_dedup.remove_repeats(nothing).count() == 0


# Pages


PAGES = [
    (None, ""), ("", ""), ("no markup, just text", "no markup, just text"),
    ("<p>One,  two.<p>Three &amp; four&nbsp;five <!-- c --> six</p><nav>Menu</nav>", "One, two.\nThree & four five six"),
    (
        '<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>'
        '<ul class="menu"><li><a href="/">Home</a></li></ul><div id="content"><h2>Head</h2><p>Long text, with commas, and so on. More.</p>'
        '<ul><li>One item, here.</li><li>Two items.</li></ul><section class="comments"><p>Great article, thanks!</p></section></div>'
        '<div class="cookie-notice"><p>We use cookies, ok.</p></div><aside>Side</aside><form><p>Name</p></form><footer>&copy; us</footer></body></html>',
        "Head\nLong text, with commas, and so on. More.\nOne item, here.\nTwo items.",
    ),
    (
        "<article><header><h1>Title</h1></header><p>Body, text. It goes on, and on.</p><p>The.</p><div class='ad'>Buy, now! Cheap, good.</div>"
        "<table><tr><td>a<td>b<tr><td>c</table></article><div hidden>x</div>",
        "Title\nBody, text. It goes on, and on.\nThe.\na\nb\nc",
    ),
    ("<body class='has-sidebar'><p>Kept text, of course.</p></body>", "Kept text, of course."),
    ("<div><p>a <b>b <i>c</b> d</i><br>e</p>f</div><", "a b c d e\nf\n<"),
    ("<p title='a > b'>quoted, fine.</p><p>cut in a tag <a href=", "quoted, fine.\ncut in a tag"),
    ("<p>Text here, with a <a href='#'>link</a> or two, and enough around them.</p><p><a href='#'>Only a link in this one, long as it may be.</a></p>",
     "Text here, with a link or two, and enough around them.\nOnly a link in this one, long as it may be."),
    ("<div class='page sidebar-left'><nav>Menu</nav><p>All there is, on this page.</p></div>", "All there is, on this page."),
    ("<p>&lt;b&gt; &#233; &unknown; &#x41;</p>", "<b> é &unknown; A"),
]


_LONG = "A long paragraph, with commas, of the body itself; it goes on, and on, until it is far longer than all that stands beside it. " * 3
WRAPPED = [
    ("<article><h1>Title</h1><p class=lead>Short lead</p><div class=byline>By A. Writer</div><div class=body><p>{0}</p><p>{0}</p></div></article>",
     "Title\nShort lead\nBy A. Writer\n{0}\n{0}"),
    ("<div class=x>Unmarked, elsewhere.</div><main><h1><a href=/t>Linked title</a></h1><section class=one><p>{0}</p></section>"
     "<section class=two><h2>More</h2><p>Small.</p></section><ul><li><a href=/a>Only links</a></li></ul></main>",
     "Linked title\n{0}\nMore\nSmall."),
    ("<article><div class=body><p>{0}</p><p>{0}</p><table><thead><tr><th>k</th></tr></thead><tbody><tr><td>1</td><td>2</td></tr></tbody></table>"
     "<ul><li>a<ul><li>b<ul><li>c</li></ul></li></ul></li></ul></div></article>", "{0}\n{0}\nk\n1\n2\na\nb\nc"),
    ("<body><div id=page><h1>Title</h1><p>Short lead</p><div class=body><p>{0}</p><p>{0}</p></div></div></body>", "Title\nShort lead\n{0}\n{0}"),
    ("<body><div class=text><p>{0}</p><p>{0}</p></div><div class=low>Unmarked, short.</div></body>", "{0}\n{0}"),
]


def test_all_of_an_article_around_its_body():
    for page, want in WRAPPED:
        assert pages.main_text(page.format(_LONG)) == want.format(_LONG.strip())


def test_pages(spark):
    rows = [(i, f"u{i}", page, "mine") for i, (page, _) in enumerate(PAGES)]
    rows += [(None, None, PAGES[3][0], "x"), (0, "u0", None, "x")]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = pages.extract(table)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    out = got.collect()
    assert Counter(r.text for r in out) == Counter([w for _, w in PAGES] + [PAGES[3][1], ""])
    assert all(r.n_chars == len(r.text) for r in out)
    assert pages.extract(table.limit(0)).count() == 0


def test_provided_pages(spark):
    """All blocks of the article element, nothing else."""
    import html

    from tests.conftest import DATA

    for r in pages.extract(spark.read.parquet(f"{DATA}/pages.parquet")).join(spark.read.parquet(f"{DATA}/pages.parquet"), "page_id").collect():
        article = re.search("<article>(.*?)(</article>|$)", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", x)).split()) for x in re.split("</?(?:p|h1|br)>", article)]
        assert r.text == "\n".join(p for p in parts if p)


def test_broken_pages_take_linear_time():
    import time

    began = time.time()
    for page in ('<a "' * 30_000, "<div>" * 20_000 + "</b>" * 20_000, "<" * 100_000, "<p>a" * 20_000, "<!--" * 30_000, "<script>" * 30_000):
        pages.main_text(page)
    assert time.time() - began < 20


# Top-k


@pytest.mark.parametrize("given", [{}, {"bucket": 40, "query_block": 3}, {"bucket": 16, "coordinate_from": 0.05}, {"bucket": 16, "coordinate_from": 0.0, "k": 3}])
def test_top_k(spark, given):
    rnd = np.random.default_rng(5)
    x = rnd.normal(size=(300, 8)) * rnd.lognormal(0, 1, (300, 1))
    x[50:120] = x[50]  # one very common vector
    x[120:130] = 0
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(100, [1.0] * 8), (100, [1.0] * 8), (None, [0.5] * 8), (400, None), (500, [1.0, None] + [0.0] * 6), (600, [float("nan")] * 8), (700, [float("inf")] * 8), (800, [2.0, 3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit("mine"))
    vectors = topk.integer_vectors(table)
    kept = [(i, np.pad(np.floor(1024 * np.array(v)), (0, 8 - len(v)))) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    assert vectors.count() == len(kept)
    k = given.get("k", 10)
    want = []
    for a, (i, v) in enumerate(kept):
        if i is not None and i % 20 == 0:
            scored = sorted(((-int(v @ w), j is None, j or 0) for b, (j, w) in enumerate(kept) if a != b))[:k]
            want += [(i, r, None if none else j, -s) for r, (s, none, j) in enumerate(scored, 1)]
    got = [tuple(r) for r in topk.top_k(vectors, F.col("vec_id") % 20 == 0, **given).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_top_k_of_few_or_no_vectors(spark):
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, None)], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in topk.top_k(topk.integer_vectors(table), F.col("vec_id") >= 0).collect())
    assert got == [(0, 1, 1, 2 << 20), (1, 1, 0, 2 << 20)]
    assert topk.top_k(topk.integer_vectors(table.limit(0)), F.lit(True)).count() == 0
    assert topk.top_k(topk.integer_vectors(table), F.lit(False)).count() == 0


def test_large_components(spark):
    rnd = np.random.default_rng(8)
    sizes = [3.0e6, 2.0**21, 2.0**31, 2.0**40, 1e30, -1e30, 1.0]
    rows = [(i, [float(np.float32(rnd.normal() * sizes[(i + j) % 7 if i % 3 else 6])) for j in range(5)]) for i in range(90)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    held = {i: [max(-(2**62), min(2**62, math.floor(1024 * c))) for c in v] for i, v in rows}
    want = []
    for i in range(0, 90, 20):
        score = {j: sum(a * b for a, b in zip(held[i], held[j], strict=True)) for j in held if j != i}
        score = {j: max(-(2**63) + 1, min(2**63 - 1, s)) for j, s in score.items()}
        want += [(i, r, j, score[j]) for r, j in enumerate(sorted(score, key=lambda j: (-score[j], j))[:10], 1)]
    for given in ({}, {"bucket": 16, "query_block": 3}):
        got = topk.top_k(topk.integer_vectors(table), F.col("vec_id") % 20 == 0, **given).collect()
        assert sorted(map(tuple, got)) == sorted(want)
