"""Isolation forest (Liu, Ting and Zhou, 2008): sampling and scoring on Spark.

Rows are drawn by hashing their id, so a re-run draws the same rows whatever
the partitioning. A tree's group holds its sample and no more.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from math import ceil, log2, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.models.trees import NODES, Ensemble, score_column
from riskloom.operators.ordering import exact_quantiles
from riskloom.storage import materialize

TREES, SAMPLE, SEED = 300, 4_096, 42
_POOL_FACTOR = 2  # pooled rows per sampled row; a pool this large makes trees nearly independent
_UNIT = float(1 << 53)


def mean_path(n: np.ndarray | float) -> np.ndarray:
    """Average depth of an unsuccessful search in a binary search tree of n keys."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    harmonic = np.log(big - 1.0) + np.euler_gamma
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, 2.0 * harmonic - 2.0 * (big - 1.0) / big))


def _uniform(*parts: Column) -> Column:
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(_UNIT)


def sample_trees(
    train: DataFrame, rows: int, row_id: str, trees: int, sample: int, seed: int
) -> DataFrame:
    """(tree, draw, ``train`` columns): at least ``sample`` rows per tree where
    the data allow, few more. One hash per row decides on a pool; only pooled
    rows are tried against every tree."""
    pool_share = min(1.0, _POOL_FACTOR * trees * sample / max(rows, 1))
    tree_share = min(1.0, (sample + 8 * sqrt(sample)) / max(rows * pool_share, 1))
    pool = train.filter(_uniform(F.col(row_id), F.lit(seed)) < pool_share)
    numbered = pool.select("*", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    draw = _uniform(F.col(row_id), F.col("tree"), F.lit(seed + 1))
    return numbered.withColumn("draw", draw).filter(F.col("draw") < tree_share)


def _grow(x: np.ndarray, limit: int, rng: np.random.Generator) -> pd.DataFrame:
    """One random tree, a whole level at a time."""
    made = {k: [] for k in ("node", "feature", "threshold", "child", "value")}
    node_of = np.zeros(len(x), dtype=int)
    level, first, depth = 1, 0, 0  # nodes on this level, number of its first node
    while level:
        order = np.argsort(node_of, kind="stable")
        node_of, x = node_of[order], x[order]
        counts = np.bincount(node_of, minlength=level)
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        low, high = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
        open_ = high > low
        split = open_.any(axis=1) & (depth < limit)
        chosen = np.where(open_, rng.random(open_.shape), -1.0).argmax(axis=1)
        each = np.arange(level)
        lo, hi = low[each, chosen], high[each, chosen]
        cut = lo + rng.random(level) * (hi - lo)
        cut = np.where(cut >= hi, lo, cut)
        rank = np.cumsum(split) - 1
        made["node"].append(first + each)
        made["feature"].append(np.where(split, chosen, -1))
        made["threshold"].append(cut)
        made["child"].append(np.where(split, first + level + 2 * rank, -1))
        made["value"].append(depth + mean_path(counts))
        kept = split[node_of]
        x, node_of = x[kept], node_of[kept]
        right = x[np.arange(len(x)), chosen[node_of]] > cut[node_of]
        node_of = 2 * rank[node_of] + right
        first, level, depth = first + level, 2 * int(split.sum()), depth + 1
    return pd.DataFrame({k: np.concatenate(v) for k, v in made.items()})


def fit_forest(
    train: DataFrame,
    columns: Sequence[str],
    row_id: str = "transaction_id",
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> Ensemble:
    """Fit on the given rows, no labels; scale from the same rows' scores so
    that a typical row scores 0 and the most extreme one 100."""
    columns = list(columns)
    rows = train.count()
    if rows == 0:
        raise ValueError("no training rows")
    drawn = min(sample, rows)
    limit = ceil(log2(max(drawn, 2)))

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["draw", row_id]).head(drawn)
        out = _grow(pdf[columns].to_numpy(dtype=float), limit, np.random.default_rng([seed, int(key[0])]))
        return out.assign(tree=int(key[0]), gain=0.0)[["tree", "node", "feature", "threshold", "child", "value", "gain"]]

    picked = sample_trees(train.select(row_id, *columns), rows, row_id, trees, sample, seed)
    # At most trees * (2 * sample - 1) rows, whatever the size of the data.
    nodes = picked.groupBy("tree").applyInPandas(grow, NODES).toArrow().to_pandas()
    model = Ensemble("isolation_forest", tuple(columns), nodes, {"sample": drawn, "seed": seed})
    raw = materialize(train.select(anomaly(train, model).alias("raw")), "anomaly")
    middle = exact_quantiles(raw, [], ["raw"]).first()[0]
    return replace(model, params={**model.params, "median": middle, "max": raw.agg(F.max("raw")).first()[0]})


def anomaly(df: DataFrame, model: Ensemble) -> Column:
    """Raw score in (0, 1], higher is stranger: 2 ** -(mean depth / expected depth)."""
    expected = float(mean_path(model.params["sample"])) or 1.0
    return score_column(
        df.sparkSession, model, lambda v: np.exp2(-v.mean(axis=0) / expected), model.columns
    )


def score_forest(df: DataFrame, model: Ensemble, name: str = "isolation_anomaly_score") -> DataFrame:
    """Adds the scaled score, 0 to 100, two decimals."""
    low, high = model.params["median"], model.params["max"]
    share = (F.col("_raw") - F.lit(low)) / F.lit((high - low) or 1.0)
    scaled = F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * 100
    return (
        df.withColumn("_raw", anomaly(df, model))
        .withColumn(name, F.bround(scaled, 2).cast("decimal(5,2)"))
        .drop("_raw")
    )
