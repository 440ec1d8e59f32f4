"""The secret scan against a plain second version of its candidates, features and votes, one character and one node at a time."""

import math
import random
import re
import time

import pytest

from riskloom.llm import secrets

RUN = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")
#: A told value, tried from the shortest end on.
TOLD = re.compile(
    r"(?i)\b(?:token|secret|passw(?:or)?d|pwd|key|bearer|credential)s?\s{1,3}(?:is\s{1,3})?[\"']?([^\s\"',;<>=]{8,}?)(?=[.:)\]]*(?:[\s\"',;<>]|$))"
)


def mixed(s):
    letters = 0
    for a, b in zip(s, s[1:], strict=False):
        letters += a.isalpha() and b.isalpha() and a.islower() is not b.islower()
    return any(c.isdigit() for c in s) or letters >= 3


def proposed(text):
    spans, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in RUN:
            end += 1
        if end - at >= 16:
            start, told = at, False
            while start < end:
                if text[start] == "=":
                    start, told = start + 1, True
                    continue
                stop = start
                while stop < end and text[stop] != "=":
                    stop += 1
                last = not text[stop:end].strip("=")
                value = text[start : end if last else stop]
                if len(value) >= (8 if told else 16) and mixed(value):
                    spans.append((start, start + len(value)))
                start = end if last else stop
        at = max(end, at + 1)
    spans += [m.span(1) for m in secrets._ASSIGNED.finditer(text)] + [m.span() for m in secrets._PREFIXED.finditer(text)]
    spans += [m.span(1) for m in TOLD.finditer(text) if mixed(m[1]) or set(m[1]) & set("!@$%^&*")]
    covered = [False] * (len(text) + 1)
    firsts = {a for a, _ in spans}
    for a, b in spans:
        covered[a:b] = [True] * (b - a)
    inner = {a for a in firsts if any(x < a < y for x, y in spans)}
    out, start = [], None
    for i, held in enumerate(covered):
        if start is not None and (not held or i in firsts - inner):
            out.append((start, i))
            start = None
        if held and start is None:
            start = i
    return out


def measured(text, a, b, words, pairs):
    s, n = text[a:b], b - a
    entropy = -sum(s.count(c) / n * math.log2(s.count(c) / n) for c in set(s))
    low = "abcdefghijklmnopqrstuvwxyz"
    logs = [pairs[low.index(x)][low.index(y)] for x, y in zip(s.lower(), s.lower()[1:], strict=False) if x in low and y in low]
    kind = lambda c: 0 if c.isdigit() else 1 if c.isupper() else 2 if c.isalpha() else 3
    covered = longest = at = 0
    while at < n:
        size = max((k for k in range(4, 15) if s.lower()[at : at + k] in words and at + k <= n), default=0)
        covered, longest, at = covered + size, max(longest, size), at + (size or 1)
    before, after = text[max(0, a - 60) : a], text[b : b + 60]
    near = [w.lower() for w in re.findall(r"[A-Za-z_0-9]+", before)][-5:]
    nearby = near + [w.lower() for w in re.findall(r"[A-Za-z_0-9]+", after)][:3]
    split = lambda ws: {p for w in ws for p in [w, *w.split("_")]}
    left = re.search(r"\S*\Z", before)[0]
    return [
        n, entropy, sum(logs) / len(logs) if logs else 0, sum(kind(x) != kind(y) for x, y in zip(s, s[1:], strict=False)) / max(1, n - 1),
        sum(c.isdigit() for c in s) / n, sum(c.isupper() and not c.isdigit() for c in s) / n, sum(c in "0123456789abcdefABCDEF" for c in s) / n,
        len(set(s)) / n, covered / n, longest, (s.count("/") + s.count("_")) / n,
        any(c in left for c in "/\\.") or s.count("/") >= 2 or (after[:1] in {"/", "."} and after[1:2].isalnum()),
        re.search(r"[:=]\s*[\"']?$", before) is not None, before[-1:] in {'"', "'"} and after[:1] in {'"', "'", ""},
        len(split(near) & secrets._FOR), len(split(nearby) & secrets._AGAINST), s.count("-") / n, secrets._PREFIXED.match(s) is not None,
    ]


def vote(tree, row):
    node = 0
    while tree["child"][node] != node:
        node = tree["child"][node] + (row[tree["feature"][node]] > tree["threshold"][node])
    return tree["value"][node]


@pytest.fixture(scope="module")
def scanner(spark):
    return secrets.fit(spark, secrets.labelled_findings(1_000))


def awkward(rnd):
    names = ("token", "the password is", "API_KEY", "key", "Bearer", "commit", "see", "PASSWORD", "a", "secrets", "path/to/", "sha256")
    glue = (" ", " ", "=", ": ", '="', " '", "\n", "==", "...", ".", ")", "; ", "&x=", "/", " = ", ",")
    chars = ("0123456789abcdef", "ABCabcXYZxyz019", "ab+/=", "é日!$.:)", "-_", "password")
    parts = []
    for _ in range(rnd.randint(1, 14)):
        parts += [rnd.choice(names), rnd.choice(glue), "".join(rnd.choice(rnd.choice(chars)) for _ in range(rnd.randint(0, 40))), rnd.choice(glue)]
    return "".join(parts)


def test_scan_equals_its_twin(scanner):
    rnd = random.Random(5)
    texts = [awkward(rnd) for _ in range(700)] + list(secrets.labelled_findings(500, seed=77)["text"]) + ["", None, "=" * 40, "a=" * 30]
    seen = 0
    for text, found in zip(texts, scanner.scan(texts), strict=True):
        assert [(a, b) for a, b, _ in found] == proposed(text or "")
        for a, b, p in found:
            row = measured(text, a, b, scanner.words, scanner.pairs)
            assert secrets.features(text, a, b, scanner.words, scanner.pairs) == pytest.approx([float(x) for x in row])
            assert p == pytest.approx(sum(vote(t, secrets.features(text, a, b, scanner.words, scanner.pairs)) for t in scanner.trees) / len(scanner.trees))
            seen += 1
    assert seen > 800


def test_time_is_linear_in_hostile_texts():
    for unit in ("key " + "." * 40, "a=", "token ", "&a", "x1", "token=", "sk-", ")]"):
        text = "password is " + unit * (1_000_000 // len(unit))
        started = time.process_time()
        secrets.candidates(text)
        assert time.process_time() - started < 20
    started = time.process_time()
    secrets.candidates("secret is " + "." * 1_000_000 + "=")
    assert time.process_time() - started < 20
