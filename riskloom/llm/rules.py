"""Quality rules as a bitmask ledger, in DataFrame functions only.

Every rule is evaluated once per document. The ledger holds the measurements and
one bit per failed rule, and is written before a policy sees it. A policy is a
version number and a mask of rules; it is applied to the stored bits, without
reading a text again. Ablations need no more than the number of documents per
bit pattern, at most 2 ** rules rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import SPACE, doc_columns, read
from riskloom.storage import scratch_path

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Rule -> when it fails, over the measurements. A rule's place is its bit; append new rules, never reorder.
RULES = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 10 * n_words",
}
BASE = ("few_words", "repeated_windows")
#: Version -> enforced rules. Published versions stay as they are.
POLICIES = {1: BASE, 2: tuple(RULES)}
LATEST = max(POLICIES)


def rule_mask(rules: tuple[str, ...]) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def measured(df: DataFrame, text: str = "text", prefix: str = "_q_") -> DataFrame:
    """``df`` with the measurements and ``fail_bits``, each name prefixed. A null text counts as empty."""
    p = lambda name: prefix + name
    c = lambda name: F.col(prefix + name)
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    no_space = F.translate(body, " \t\n\x0b\x0c\r", "")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    out = df.withColumns(
        {
            p("words"): F.array_remove(F.split(body, f"[{SPACE}]+"), ""),
            p("lines"): lines,
            p("word_chars"): F.length(no_space).cast("long"),
            p("n_symbols"): (F.length(no_space) - F.length(F.translate(no_space, SYMBOLS, ""))).cast("long"),
        }
    )
    window = lambda i: F.xxhash64(*[F.get(c("words"), i + F.lit(k)) for k in range(3)])
    out = out.withColumns(
        {
            p("n_words"): F.size(c("words")).cast("long"),
            p("n_lines"): F.size(c("lines")).cast("long"),
            p("n_dup_lines"): (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long"),
            p("windows"): F.when(
                F.size(c("words")) >= 3, F.transform(F.sequence(F.lit(0), F.size(c("words")) - 3), window)
            ).otherwise(F.array().cast("array<bigint>")),
        }
    ).drop(p("words"), p("lines"))
    # Windows by hash and place; in that order equal windows are neighbours. Most texts repeat none and are not sorted.
    placed = F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    repeats = F.size(F.array_distinct(c("windows"))) < F.size(c("windows"))
    out = out.withColumn(p("sorted"), F.when(repeats, F.sort_array(placed)))
    same = lambda a, b: F.get(c("sorted"), a)["h"] == F.get(c("sorted"), b)["h"]
    met = F.filter(
        F.sequence(F.lit(0), F.size(c("windows")) - 1),
        lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)),
    )
    out = out.withColumn(p("met"), F.when(F.col(p("sorted")).isNotNull(), met))
    starts = F.sort_array(F.transform(c("met"), lambda k: F.get(c("sorted"), k)["i"]))
    out = out.withColumn(p("starts"), starts).drop(p("windows"), p("sorted"), p("met"))
    # A window covers three words, fewer where the next one starts sooner.
    gaps = F.transform(
        c("starts"), lambda s, k: F.least(F.lit(3), F.coalesce(F.get(c("starts"), k + 1) - s, F.lit(3))).cast("long")
    )
    covered = F.aggregate(gaps, F.lit(0).cast("long"), lambda total, g: total + g)
    out = out.withColumn(p("n_repeat_words"), F.coalesce(covered, F.lit(0).cast("long"))).drop(p("starts"))
    # Adds nothing, but as it depends on the row's place the optimizer leaves a filter on the bits above the
    # measurements; pushed below them it would carry their whole expressions along and evaluate them again.
    bits = (F.monotonically_increasing_id() < 0).cast("int")
    for k, rule in enumerate(RULES.values()):
        failed = F.expr(" ".join(f"`{p(w)}`" if w in MEASURES else w for w in rule.split()))
        bits = bits + F.when(failed, F.lit(1 << k)).otherwise(F.lit(0))
    return out.withColumn(p("fail_bits"), bits)


def kept(fail_bits: Column, version: int = LATEST) -> Column:
    return fail_bits.bitwiseAND(F.lit(rule_mask(POLICIES[version]))) == 0


def ledger(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measurements, fail_bits. Repeated and null doc_ids stay rows of their own; a
    null or empty text measures 0 everywhere and fails ``few_words``."""
    rows = measured(doc_columns(documents, "doc_id", "text"))
    return rows.select("doc_id", *[F.col(f"_q_{m}").alias(m) for m in (*MEASURES, "fail_bits")])


def ablations(ledger_rows: DataFrame, version: int = LATEST) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone (kept if it were dropped), and that the policy
    keeps without it. No documents give no rows."""
    mask = rule_mask(POLICIES[version])
    patterns = ledger_rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    names = list(RULES)
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(rule_mask((r,))).alias("bit")) for r in names if r in POLICIES[version]])
    each = patterns.select("bits", "n", F.inline(rules))
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    return each.groupBy("rule", "bit").agg(
        count(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        count(F.col("bits") == F.col("bit")).alias("failed_alone"),
        count(F.col("bits").bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"),
    )


def write_ledger(documents: DataFrame, folder: str) -> DataFrame:
    """The ledger, written to ``folder``/ledger and reread, with the ablations of every policy, by version and rule, in
    ``folder``/ablations. Texts are read once; both tables are replaced. Without documents both are empty."""
    spark = documents.sparkSession
    ledger(documents).write.mode("overwrite").parquet(f"{folder}/ledger")
    rows = spark.read.parquet(f"{folder}/ledger")
    found = [ablations(rows, v).select(F.lit(v).alias("version"), "*") for v in POLICIES]
    reduce(DataFrame.unionByName, found).coalesce(1).write.mode("overwrite").parquet(f"{folder}/ablations")
    return rows


def accept(documents: DataFrame, version: int = LATEST) -> DataFrame:
    """The documents that a policy keeps, with their own columns."""
    rows = measured(documents.select(F.struct("*").alias("_doc"), "text"))
    return rows.filter(kept(F.col("_q_fail_bits"), version)).select("_doc.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both policies over the stored ledger of all ``documents``."""
    rows = write_ledger(read(spark, sf_dir, "documents"), scratch_path(spark, "llm-rules"))
    base_failed = ~kept(F.col("fail_bits"), 1)
    return rows.select(
        "doc_id", *MEASURES[:5], base_failed.alias("base_failed"), kept(F.col("fail_bits")).alias("kept"), "n_lines", "fail_bits"
    )


#: The SQL counts windows as strings, in a grouped list per text, and covers words by position.
OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
), pos AS (
  SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3
), win AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, ws[i], ws[i + 1], ws[i + 2]) AS c FROM pos
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM win, (VALUES (0), (1), (2)) v(k) WHERE c >= 2 GROUP BY r
), m AS (
  SELECT w.r, doc_id, len(ws)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines
  FROM w LEFT JOIN covered ON w.r = covered.r
), b AS (
  SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
         + 8 * (2 * n_dup_lines > n_lines)::INT + 16 * (word_chars < 3 * n_words)::INT
         + 32 * (word_chars > 10 * n_words)::INT AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, n_lines, fail_bits
FROM b
"""
