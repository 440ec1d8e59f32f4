"""Tree ensembles as a node table, walked by vectorised workers.

A node row is (tree, node, feature, threshold, child, value, gain): values up to
the threshold go to ``child``, larger ones to ``child + 1``; ``feature`` is -1 in
a leaf. The table's size depends on the number and depth of trees, never on the
data, so it travels to the workers as one broadcast.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODES = "tree int, node int, feature int, threshold double, child int, value double, gain double"
_BLOCK = 10_000  # rows walked at once: long vectors, while one tree's nodes stay in cache


@dataclass(frozen=True)
class Ensemble:
    kind: str
    columns: tuple[str, ...]
    nodes: pd.DataFrame
    params: dict = field(default_factory=dict)

    @property
    def trees(self) -> int:
        return int(self.nodes["tree"].max()) + 1

    def first(self, trees: int) -> Ensemble:
        """The ensemble of the first trees."""
        return Ensemble(self.kind, self.columns, self.nodes[self.nodes["tree"] < trees], self.params)

    def arrays(self) -> list[dict[str, np.ndarray | int]]:
        """Per tree, node arrays and depth; a leaf is its own child."""
        out = []
        for _, n in self.nodes.sort_values(["tree", "node"]).groupby("tree"):
            feature, child = n["feature"].to_numpy(), n["child"].to_numpy()
            depth, level = 0, np.zeros(1, dtype=int)
            while len(level := level[feature[level] >= 0]):
                level = np.concatenate([child[level], child[level] + 1])
                depth += 1
            leaf = feature < 0
            out.append(
                {
                    "feature": np.where(leaf, 0, feature).astype(np.int64),
                    "threshold": np.where(leaf, np.inf, n["threshold"].to_numpy(dtype=float)),
                    "child": np.where(leaf, np.arange(len(n)), child).astype(np.int64),
                    "value": n["value"].to_numpy(dtype=float),
                    "depth": depth,
                }
            )
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame(self.nodes, NODES).write.mode("overwrite").parquet(f"{path}/nodes")
        about = json.dumps({"kind": self.kind, "columns": list(self.columns), "params": self.params})
        spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Ensemble:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        nodes = spark.read.schema(NODES).parquet(f"{path}/nodes").toArrow().to_pandas()
        return Ensemble(about["kind"], tuple(about["columns"]), nodes, about["params"])


def leaf_values(trees: Sequence[dict[str, np.ndarray | int]], x: np.ndarray) -> np.ndarray:
    """(trees, rows) leaf values of a (rows, features) block; one stored by features is not copied. Steps write into
    the same few arrays, which stay in cache; all positions are within bounds, so ``clip`` only spares a check."""
    rows = len(x)
    flat, row = np.ascontiguousarray(x.T, dtype=float).reshape(-1), np.arange(rows, dtype=np.int64)
    at, place, right = np.empty(rows, np.int64), np.empty(rows, np.int64), np.empty(rows, bool)
    value, threshold = np.empty(rows), np.empty(rows)
    out = np.empty((len(trees), rows))
    for k, tree in enumerate(trees):
        start = tree["feature"] * rows
        at[:] = 0
        for _ in range(tree["depth"] if rows else 0):
            np.add(start.take(at, out=place, mode="clip"), row, out=place)
            flat.take(place, out=value, mode="clip")
            tree["threshold"].take(at, out=threshold, mode="clip")
            np.greater(value, threshold, out=right)
            np.add(tree["child"].take(at, out=place, mode="clip"), right, out=at)
        tree["value"].take(at, out=out[k], mode="clip")
    return out


def blocks(frame: np.ndarray) -> Iterator[np.ndarray]:
    for i in range(0, len(frame), _BLOCK):
        yield frame[i : i + _BLOCK]


def score_column(
    spark: SparkSession, ensemble: Ensemble, combine: Callable[[np.ndarray], np.ndarray], columns: Sequence[str]
) -> Column:
    """Score from the per-tree leaf values. Only the feature columns travel to
    Python; all other columns stay in the JVM."""
    shared = spark.sparkContext.broadcast(ensemble.arrays())

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        arrays = shared.value
        for batch in batches:
            x = np.array([c.to_numpy(dtype=float) for c in batch]).T
            parts = [combine(leaf_values(arrays, b)) for b in blocks(x)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return score(*[F.col(c) for c in columns])


def feature_importance(ensemble: Ensemble, spark: SparkSession) -> DataFrame:
    """(feature, importance): mean gain of the splits on each feature, as a
    share, four decimals, largest first; unused features have 0."""
    splits = ensemble.nodes[ensemble.nodes["feature"] >= 0]
    mean = splits.groupby("feature")["gain"].mean().reindex(range(len(ensemble.columns)), fill_value=0.0)
    total = mean.sum()
    rows = [(c, float(mean[i] / total) if total else 0.0) for i, c in enumerate(ensemble.columns)]
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .withColumn("importance", F.bround("importance", 4))
        .orderBy(F.desc("importance"), "feature")
    )
