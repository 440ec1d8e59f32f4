import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that users may have and operators may use inside.
CLASHES = (
    "_row", "_doc", "_key", "size", "target", "taken", "bin", "fill", "open", "fp", "root", "cell", "found", "component_id", "n_words",
    "fail_bits", "_q_words", "_q_fail_bits", "held_out", "score", "anchor", "kind", "bucket", "_h", "_sid", "block", "start", "copies",
)


def prose(rnd, words):
    vocabulary = ["".join(rnd.choice("abcdeilnorst") for _ in range(rnd.randint(2, 8))) for _ in range(200)]
    return " ".join(rnd.choice(vocabulary) + rnd.choice(("", "", ",", ".")) for _ in range(words))


@pytest.fixture(scope="session")
def corpus(spark):
    """Small documents with nulls in every column, empty, very long, equal and nearly equal texts, repeated rows and ids."""
    rnd = random.Random(7)
    base = [prose(rnd, rnd.randint(40, 160)) for _ in range(30)]
    rows = [(i, t, "en", f"s{i % 4}", len(t)) for i, t in enumerate(base)]
    rows += [(100 + i, base[3], "en", "s0", len(base[3])) for i in range(20)]  # copies
    rows += [(200 + i, base[5] + f" tail{i}", "en", "s1", 1) for i in range(5)]  # near copies
    rows += [
        (300, None, None, None, None), (301, "", "", "", 0), (302, " \n\t ", "en", "s9", 4), (None, base[7], "en", None, None),
        (None, None, "fr", "s2", 3), (303, "one", "en", "s2", 3), (304, "Zwei Wörter", "de", "s2", 11),
        (305, "日本語 🎉 ünï \x85 x", "xx", "s3", 1), (306, "a" * 5000, "en", "s3", 5000), (4, base[4], "en", "s0", len(base[4])),
        (4, base[4], "en", "s0", len(base[4])), (4, "same id, another text " + base[9], "en", "s0", 5),
        (307, "<|endoftext|> The <|ENDOFTEXT|>. U.S.A. don't", "en", "s1", 2), (308, "\n".join(["again and again"] * 60), "en", "s1", 2),
        (309, prose(rnd, 60_000), "en", "s1", 9), (310, "la " * 3000, "es", "s5", 9000), (311, "# * $ " * 100, "es", "s5", 600),
    ]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3).cache()


@pytest.fixture(scope="session")
def clashing(corpus):
    from pyspark.sql import functions as F

    return corpus.select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)
