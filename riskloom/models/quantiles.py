"""Weighted quantile summaries that merge, and the bins made of them.

A summary is a sorted list of distinct values with weights. Beyond ``most``
entries it is thinned: values whose ranks fall into one of ``most`` equal shares
of the weight are stood for by the largest of them, so no rank moves by more than
a share. Summaries are merged eight by eight, on each task and then over the
tasks, so a rank moves once per level, of which there are few; with fewer than
``most`` distinct values nothing is thinned and the bins are those of the sorted
column however it is partitioned.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Summary = tuple[np.ndarray, np.ndarray]

#: Entries of a summary per bin: with 16 levels of merging a rank is off by less than a quarter of a bin.
ENTRIES_PER_BIN = 64
_FAN = 8  # summaries merged at once
_TOGETHER = 64  # tasks whose summaries meet in one group


def thinned(values: np.ndarray, weights: np.ndarray, most: int) -> Summary:
    """At most about ``most`` entries of sorted distinct values; weights move up by less than 1/``most`` of the total."""
    if len(values) <= most:
        return values, weights
    before = np.cumsum(weights) - weights
    share = np.floor(before * (most / weights.sum())).astype(np.int64)
    last = np.flatnonzero(np.append(share[1:] != share[:-1], True))
    return values[last], np.diff(np.concatenate([[0.0], np.cumsum(weights)[last]]))


def merged(parts: Sequence[Summary], most: int) -> Summary:
    values, place = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    weights = np.bincount(place, weights=np.concatenate([w for _, w in parts]), minlength=len(values))
    return thinned(values, weights, most)


class Merger:
    """Summaries of one column, merged eight by eight into levels."""

    def __init__(self, most: int):
        self.most = most
        self.levels: list[list[Summary]] = [[]]

    def add(self, part: Summary) -> None:
        level = 0
        self.levels[0].append(part)
        while len(self.levels[level]) == _FAN:
            part, self.levels[level] = merged(self.levels[level], self.most), []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(part)

    def whole(self) -> Summary | None:
        left = [p for level in self.levels for p in level]
        return merged(left, self.most) if left else None


_SCHEMA = pa.schema([("feature", pa.int32()), ("part", pa.int32()), ("v", pa.binary()), ("w", pa.binary())])
_DDL = "feature int, part int, v binary, w binary"


def _row(feature: int, part: int, summary: Summary) -> pa.RecordBatch:
    v, w = (x.astype(np.float64).tobytes() for x in summary)
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((feature, part, v, w), _SCHEMA, strict=True)], schema=_SCHEMA)


def _of_tasks(columns: list[str], most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = [Merger(most) for _ in columns]
        for b in batches:
            if not b.num_rows:
                continue
            weight = b.column("_w").to_numpy(zero_copy_only=False)
            for name, merger in zip(columns, held, strict=True):
                merger.add(merged([(b.column(name).to_numpy(zero_copy_only=False).astype(float), weight)], most))
        for k, merger in enumerate(held):
            if (summary := merger.whole()) is not None:
                yield _row(k, TaskContext.get().partitionId(), summary)

    return run


def _of_groups(most: int):
    """Rows of one feature and group follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, Merger(most)
        for b in batches:
            for row in b.to_pylist():
                key = (row["feature"], row["group"])
                if key != at:
                    if at is not None:
                        yield _row(*at, held.whole())
                    at, held = key, Merger(most)
                held.add((np.frombuffer(row["v"]), np.frombuffer(row["w"])))
        if at is not None:
            yield _row(*at, held.whole())

    return run


def summaries(df: DataFrame, columns: Sequence[str], weight: Column, most: int) -> list[Summary]:
    """A summary per column of all rows; the driver gets at most about ``most`` entries of each."""
    columns = list(columns)
    found = df.select(*columns, weight.cast("double").alias("_w")).mapInArrow(_of_tasks(columns, most), _DDL)
    for group in (F.floor(F.col("part") / _TOGETHER).cast("int"), F.lit(0)):
        grouped = found.withColumn("group", group).repartition("feature", "group").sortWithinPartitions("feature", "group", "part")
        found = grouped.mapInArrow(_of_groups(most), _DDL)
    rows = {r["feature"]: (np.frombuffer(r["v"]), np.frombuffer(r["w"])) for r in found.collect()}
    return [rows.get(k, (np.zeros(0), np.zeros(0))) for k in range(len(columns))]


def cuts(summary: Summary, bins: int) -> np.ndarray:
    """Upper bounds of all bins but the last, which is open: equal shares of the weight, a bin per value if they fit."""
    values, weights = summary
    if len(values) <= bins:
        return values[:-1].copy()
    upto = np.cumsum(weights)
    at = np.searchsorted(upto, upto[-1] * np.arange(1, bins) / bins)
    found = np.unique(values[at])
    return found[found < values[-1]]


def binned(x: np.ndarray, bounds: Sequence[np.ndarray]) -> np.ndarray:
    """Bin numbers of a (rows, features) block, one byte each."""
    out = np.empty(x.shape, np.uint8)
    for k, b in enumerate(bounds):
        out[:, k] = np.searchsorted(b, x[:, k], side="left")
    return out
