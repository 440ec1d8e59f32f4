"""Secret scans: a wide pattern proposes findings, a random forest removes the false ones.

Candidates are long runs of token characters, cut at assignment signs so that
the value stands alone, values assigned to telling names or told after them, and
keys of known prefixes. Features: length, character transitions under a letter-pair model,
coverage by dictionary words, the path around the candidate, and neighbouring
words. MLlib fits the forest on labelled findings; node tables, whose size
depends on the number and depth of trees, go to the workers, and one pass over
the texts proposes, scores and, if asked, redacts.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import doc_columns, few_rows, read
from riskloom.models.trees import Ensemble, leaf_values
from riskloom.storage import scratch_path

#: Labelled findings that the forest is fitted on; the bound of the training sample.
LABELLED = 6_000
TREES, DEPTH, SEED = 40, 10, 17
THRESHOLD = 0.5
MARK = "[secret]"
VOCABULARY = "word_bpe_49k.json"

_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
_ASSIGNED = re.compile(
    r"(?i)(?:token|secret|passw(?:or)?d|pwd|api_?key|access_?key|private_?key|credential)s?[\"']?\s{0,3}[:=]{1,2}>?\s{0,3}[\"']?((?:(?!&\w+=)[^\s\"',;<>]){8,})"
)
#: A value told in prose: "the password is ...", "Bearer ...".
_TOLD = re.compile(
    r"(?i)\b(?:token|secret|passw(?:or)?d|pwd|key|bearer|credential)s?\s{1,3}(?:is\s{1,3})?[\"']?([^\s\"',;<>=]{8,}+)(?!=)"
)
#: Keys that say by their first letters what they are.
_PREFIXED = re.compile(r"(?<![A-Za-z0-9])(?:(?:AKIA|ASIA)[A-Z2-7]{16}(?![A-Za-z0-9])|(?:gh[opsu]_|sk_live_|glpat-|xox[abp]-|sk-)[A-Za-z0-9_-]{16,})")
_PART = re.compile(r"[^=]+=*")
_LEAST_VALUE = 8  # characters of an assigned or told value
#: Words that speak for and against a secret nearby.
_FOR = frozenset("token secret password passwd pwd key apikey api_key access credential credentials auth authorization bearer private login".split())
_AGAINST = frozenset("commit sha sha1 sha256 md5 checksum digest hash uuid guid id build version example placeholder sample test dummy revision etag integrity".split())
_NEAR = 60  # characters looked at on either side
FEATURES = (
    "length", "entropy", "pair_score", "class_changes", "digits", "upper", "hex", "distinct", "dictionary", "longest_word",
    "separators", "in_path", "assigned", "quoted", "words_for", "words_against", "dashes", "prefixed",
)
_WORD = re.compile(r"[A-Za-z_0-9]+")


def _dictionary(vocabulary: str) -> frozenset[str]:
    """Whole words of four letters and more in a public tokenizer's vocabulary file."""
    import json

    with open(vocabulary, encoding="utf-8") as f:
        words = json.load(f)["model"]["vocab"]
    cut = (w.removesuffix("</w>") for w in words if w.endswith("</w>"))
    return frozenset(w for w in cut if len(w) >= 4 and w.isascii() and w.isalpha())


def _pairs(words: frozenset[str]) -> np.ndarray:
    """Log-odds of a letter pair within words against letters drawn at random."""
    seen = np.ones((26, 26))
    for w in sorted(words):
        x = np.frombuffer(w.encode(), np.uint8).astype(int) - 97
        if ((0 <= x) & (x < 26)).all():
            np.add.at(seen, (x[:-1], x[1:]), 1)
    return np.log2(seen / seen.sum() * 26 * 26)


def _mixed(s: str) -> bool:
    """A digit, or letters that change case at least three times, as those of words and rules of dashes do not."""
    return any(c.isdigit() for c in s) or sum(a.islower() != b.islower() for a, b in zip(s, s[1:], strict=False) if a.isalpha() and b.isalpha()) >= 3


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of proposed findings, in order, none inside another. A run is cut at every "=" that more follows,
    so NAME=value proposes the value and padding stays; parts count only if they are mixed. A told value ends before
    the stops and brackets that close its sentence. Linear in the text, whatever it is made of."""
    found = []
    for m in _RUN.finditer(text):
        run = m.group()
        parts = list(_PART.finditer(run))
        for k, part in enumerate(parts):
            value = part.group() if k == len(parts) - 1 else part.group().rstrip("=")
            assigned = k > 0 or run.startswith("=")
            if len(value) >= (_LEAST_VALUE if assigned else 16) and _mixed(value):
                found.append((m.start() + part.start(), m.start() + part.start() + len(value)))
    found += [m.span(1) for m in _ASSIGNED.finditer(text)]
    for m in _TOLD.finditer(text):
        value = m[1][: max(_LEAST_VALUE, len(m[1].rstrip(".:)]")))]
        if _mixed(value) or any(c in "!@$%^&*" for c in value):
            found.append((m.start(1), m.start(1) + len(value)))
    found += [m.span() for m in _PREFIXED.finditer(text)]
    out: list[tuple[int, int]] = []
    for a, b in sorted(found, key=lambda s: (s[0], -s[1])):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _covered(s: str, words: frozenset[str]) -> tuple[int, int]:
    """Characters under dictionary words, longest first from the left, and the longest such word."""
    low, at, total, longest = s.lower(), 0, 0, 0
    while at < len(low) - 3:
        for size in range(min(14, len(low) - at), 3, -1):
            if low[at : at + size] in words:
                total, longest, at = total + size, max(longest, size), at + size
                break
        else:
            at += 1
    return total, longest


def features(text: str, start: int, end: int, words: frozenset[str], pairs: np.ndarray) -> list[float]:
    """FEATURES of one candidate, in time linear in its length."""
    s = text[start:end]
    n = len(s)
    shares = np.array(list(Counter(s).values())) / n
    letters = np.frombuffer(s.lower().encode("ascii", "replace"), np.uint8).astype(int) - 97
    both = (letters[:-1] >= 0) & (letters[:-1] < 26) & (letters[1:] >= 0) & (letters[1:] < 26)
    kind = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o" for c in s]
    covered, longest = _covered(s, words)
    before, after = text[max(0, start - _NEAR) : start], text[end : end + _NEAR]
    near = [w.lower() for w in _WORD.findall(before)[-5:]]
    nearby = near + [w.lower() for w in _WORD.findall(after)[:3]]
    parts = lambda ws: {p for w in ws for p in (w, *w.split("_"))}
    left = before.rsplit(None, 1)[-1] if before and not before[-1].isspace() else ""
    return [
        float(n),
        float(-(shares * np.log2(shares)).sum()),
        float(pairs[letters[:-1][both], letters[1:][both]].mean()) if both.any() else 0.0,
        sum(a != b for a, b in zip(kind, kind[1:], strict=False)) / max(1, n - 1),
        kind.count("d") / n,
        kind.count("u") / n,
        sum(c in "0123456789abcdefABCDEF" for c in s) / n,
        len(shares) / n,
        covered / n,
        float(longest),
        sum(c in "/_" for c in s) / n,
        float("/" in left or "\\" in left or "." in left or s.count("/") >= 2 or after[:1] in ("/", ".") and after[1:2].isalnum()),
        float(bool(re.search(r"[:=]\s*[\"']?$", before))),
        float(before[-1:] in "\"'" and after[:1] in "\"'" and bool(before)),
        float(len(parts(near) & _FOR)),
        float(len(parts(nearby) & _AGAINST)),
        s.count("-") / n,
        float(bool(_PREFIXED.match(s))),
    ]


def labelled_findings(rows: int = LABELLED, seed: int = SEED, vocabulary: str | None = None) -> pd.DataFrame:
    """(text, start, end, secret): findings with known labels, ``rows`` of them, half of them secrets, drawn from a seed.
    Secrets are random keys of the usual lengths and alphabets in assignments, as unquoted NAME=value, beside telling
    words, or bare where their prefix tells; the others are hashes, ids, numbers, paths, long words, identifiers and
    placeholders, hashes and ids as NAME=value too. Pass real labelled findings in the same
    columns to ``fit`` where there are any."""
    rnd = random.Random(seed)
    words = sorted(_dictionary(vocabulary or default_vocabulary()))
    some = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    chars = lambda alphabet, k: "".join(rnd.choice(alphabet) for _ in range(k))
    hexa, low = "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz"
    base = low + low.upper() + "0123456789"

    def secret() -> str:
        kind = rnd.randrange(6)
        if kind == 0:
            s = chars(hexa, rnd.choice((32, 40, 40, 48, 64)))
            return s.upper() if rnd.random() < 0.2 else s
        if kind == 1:
            return rnd.choice(("AKIA", "ASIA")) + chars(low.upper() + "234567", 16)
        if kind == 2:
            return rnd.choice(("ghp_", "sk_live_", "glpat-", "xoxb-", "sk-")) + chars(base, rnd.choice((20, 24, 36, 40)))
        if kind == 3:
            return chars(base + "+/", rnd.choice((22, 32, 43, 64))) + rnd.choice(("", "=", "=="))
        if kind == 4:
            return chars(base, rnd.randint(16, 48))
        return chars(base + "!@$%^&*", rnd.randint(10, 20))

    def told(value: str) -> tuple[str, str]:
        if _PREFIXED.match(value) and rnd.random() < 0.4:
            return rnd.choice(("", "", "(", "use ", "see ", "then ")), ""
        if rnd.random() < 0.25:
            name = rnd.choice(("TOKEN", "SECRET", "PASSWORD", "API_KEY", "ACCESS_KEY", "PRIVATE_KEY", "token", "api_key"))
            return rnd.choice(("", "", "export ", "?", "config.")) + rnd.choice(("", rnd.choice(words).upper() + "_")) + name + "=", ""
        name = rnd.choice(("token", "secret", "password", "api_key", "apikey", "access_key", "auth_token", "client_secret", "private_key", "TOKEN", "PASSWORD"))
        q = rnd.choice(('"', '"', "'", ""))
        sign = rnd.choice((" = ", "=", ": ", ":", " => "))
        if rnd.random() < 0.12:
            return rnd.choice(("Authorization: Bearer ", "login with key ", "the password is ", "auth token ")), ""
        return f"{name}{sign}{q}", q

    def other() -> tuple[str, str, str]:
        kind = rnd.randrange(9)
        if kind == 0:
            return rnd.choice(("commit ", "sha1 ", "revision ", "build ", "at commit ", "GIT_COMMIT=", "BUILD_SHA=")), chars(hexa, 40), ""
        if kind == 1:
            return rnd.choice(("sha256:", "md5 ", "checksum ", 'integrity="sha256-', "etag: ", "IMAGE_DIGEST=", "checksum=")), chars(hexa, rnd.choice((32, 64))), ""
        if kind == 2:
            return rnd.choice(("id=", "REQUEST_ID=", "uuid ", "guid: ", '"id": "', "request ")), str(uuid.UUID(int=rnd.getrandbits(128))), ""
        if kind == 3:
            return rnd.choice(("", "card ", "order ", "number ")), chars("0123456789", rnd.randint(16, 22)), ""
        if kind == 4:
            return rnd.choice(("", "https://", "http://")), "/".join(rnd.choice(words) for _ in range(rnd.randint(3, 5))) + f"/{rnd.randint(1, 9999)}", ".html"
        if kind == 5:
            return rnd.choice(("", "call ", "the ")), "_".join(rnd.choice(words) for _ in range(rnd.randint(2, 4))) + f"_{rnd.randint(1, 99)}", ""
        if kind == 6:
            return "", "".join(rnd.choice(words).title() for _ in range(4)), ""
        if kind == 7:
            head, tail = told("")
            filler = rnd.choice(("your_api_key_here", "x" * rnd.randint(8, 40), "changeme", "example_token_value", "<placeholder>", "0" * rnd.randint(8, 32), "getenv_token_1", "os.environ", "config.password", "123456789", "replace-with-your-key", "null_or_empty"))
            return head, filler, tail
        return "", "-".join(rnd.choice(words) for _ in range(4)) + f"-{rnd.randint(1990, 2030)}", ""

    out = []
    for k in range(rows):
        if k % 2:
            value = secret()
            head, tail = told(value)
        else:
            head, value, tail = other()
        lead = some(rnd.randint(0, 8))
        lead += rnd.choice((" ", "\n", ", ")) if lead else ""
        out.append((f"{lead}{head}{value}{tail} {some(rnd.randint(0, 6))}", len(lead) + len(head), len(lead) + len(head) + len(value), bool(k % 2)))
    return pd.DataFrame(out, columns=["text", "start", "end", "secret"])


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


class Scanner:
    """Words, letter pairs and trees, as workers hold them."""

    def __init__(self, words: frozenset[str], pairs: np.ndarray, trees: list[dict], threshold: float):
        self.words, self.pairs, self.trees, self.threshold = words, pairs, trees, threshold

    def plain(self) -> tuple:
        """What a broadcast carries: data that unpickles without this package."""
        return self.words, self.pairs, self.trees, self.threshold

    def scan(self, texts: list[str | None]) -> list[list[tuple[int, int, float]]]:
        """Per text the proposed (start, end, probability)."""
        spans = [candidates(t) if t else [] for t in texts]
        x = [features(t, a, b, self.words, self.pairs) for t, found in zip(texts, spans, strict=True) for a, b in found]
        p = iter(leaf_values(self.trees, np.array(x)).mean(axis=0).tolist() if x else [])
        return [[(a, b, next(p)) for a, b in found] for found in spans]


def fit(
    spark: SparkSession, labelled: pd.DataFrame, vocabulary: str | None = None, trees: int = TREES, depth: int = DEPTH,
    threshold: float = THRESHOLD, seed: int = SEED,
) -> Scanner:
    """Fit the forest on labelled findings (text, start, end, secret), a bounded sample. It learns the spans that a scan
    proposes for them, or the labelled span where it proposes none."""
    words = _dictionary(vocabulary or default_vocabulary())
    pairs = _pairs(words)
    rows = [
        ([float(v) for v in features(t, i, j, words, pairs)], float(y))
        for t, a, b, y in labelled[["text", "start", "end", "secret"]].itertuples(index=False)
        for i, j in [c for c in candidates(t) if c[0] < b and a < c[1]] or [(a, b)]
    ]
    made = spark.createDataFrame(rows, "x array<double>, label double").coalesce(1).withColumn("features", array_to_vector("x"))
    model = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=2, seed=seed).fit(made)
    path = scratch_path(spark, "llm-forest")
    model.write().save(path)
    flat = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        (F.get("nodeData.impurityStats", F.lit(1)) / F.aggregate("nodeData.impurityStats", F.lit(0.0), lambda a, b: a + b)).alias("value"),
    ).toArrow().to_pandas()
    nodes = []
    for tree, part in flat.groupby("tree"):
        by = part.set_index("id")
        order = {node: k for k, node in enumerate(_breadth_first(by))}
        leaf = part["left"] < 0
        nodes.append(
            pd.DataFrame(
                {
                    "tree": tree, "node": part["id"].map(order), "feature": np.where(leaf, -1, part["feature"]).astype(int),
                    "threshold": part["threshold"], "child": np.where(leaf, -1, part["left"].map(order).fillna(-1)).astype(int),
                    "value": part["value"], "gain": 0.0,
                }
            )
        )
    forest = Ensemble("random_forest", FEATURES, pd.concat(nodes, ignore_index=True))
    return Scanner(words, pairs, forest.arrays(), threshold)


def _breadth_first(by: pd.DataFrame) -> list[int]:
    """Node ids, a node's two children next to each other."""
    queue = [0]
    for node in queue:
        if by.at[node, "left"] >= 0:
            queue += [by.at[node, "left"], by.at[node, "right"]]
    return queue


_FINDINGS = "doc_id long, start long, length long, probability double, is_secret boolean, sha256 string"


def findings(documents: DataFrame, scanner: Scanner) -> DataFrame:
    """One row per proposed finding: doc_id, start and length in characters, the forest's probability, is_secret, and
    the finding's SHA-256 in place of its text. Null and empty texts have none; null and repeated doc_ids are documents
    like any other."""
    shared = documents.sparkSession.sparkContext.broadcast(scanner.plain())
    names = [f.split()[0] for f in _FINDINGS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(*shared.value)
        for b in few_rows(batches):
            docs, texts = b.column("doc_id").to_pylist(), b.column("text").to_pylist()
            rows = [
                (doc, a, e - a, p, p >= scan.threshold, hashlib.sha256(text[a:e].encode()).hexdigest())
                for doc, text, found in zip(docs, texts, scan.scan(texts), strict=True)
                for a, e, p in found
            ]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return doc_columns(documents, "doc_id", "text").mapInArrow(run, _FINDINGS)


def redacted(documents: DataFrame, scanner: Scanner, mark: str = MARK) -> DataFrame:
    """The documents with ``mark`` in place of every secret in ``text``; an ``n_chars`` that held the length still does.
    No document goes, other columns stay as they are."""
    shared = documents.sparkSession.sparkContext.broadcast(scanner.plain())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(*shared.value)
        for b in few_rows(batches):
            texts, out = b.column("text").to_pylist(), []
            for text, found in zip(texts, scan.scan(texts), strict=True):
                for a, e, p in reversed(found):
                    if p >= scan.threshold:
                        text = text[:a] + mark + text[e:]
                out.append(text)
            at = b.schema.get_field_index("text")
            done = b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))
            at = b.schema.get_field_index("n_chars")
            if at >= 0 and pa.types.is_integer(b.schema.field(at).type):
                counts = [
                    len(new) if old is not None and n == len(old) else n
                    for n, old, new in zip(b.column(at).to_pylist(), texts, out, strict=True)
                ]
                done = done.set_column(at, b.schema.field(at), pa.array(counts, b.schema.field(at).type))
            yield done

    return documents.mapInArrow(run, documents.schema)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(read(spark, sf_dir, "documents"), fit(spark, labelled_findings()))
