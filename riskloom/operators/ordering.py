"""Global order without a single-task window.

A global ``row_number`` would pull every row into one task. Here Spark's range
exchange cuts the order into balanced slices, each slice is sorted and numbered
on its own, and the slices' sizes give the offsets. The sliced table is written
before it is counted, so that a lost executor cannot change the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.storage import BROADCAST_ROWS, materialize

SLICE_ROWS = 5_000_000
_ROW_BITS = 33  # monotonically_increasing_id keeps the row index in its low 33 bits


def dense_key(df: DataFrame, order: Sequence[Column | str], name: str, start: int = 1) -> DataFrame:
    """Consecutive integers over the global order of ``order``, which must be
    unique. There are as many slices as the rows, counted first, ask for."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    slices = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // SLICE_ROWS)
    ranged = df.repartitionByRange(slices, *order).sortWithinPartitions(*order)
    row_id = F.monotonically_increasing_id()
    sliced = materialize(
        ranged.withColumn("_id", row_id)
        .withColumn("_slice", F.shiftright("_id", _ROW_BITS))
        .withColumn("_row", F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_id"),
        "sliced",
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    if slices <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return sliced.join(offsets, "_slice").withColumn(name, F.col("_before") + F.col("_row") + F.lit(start)).drop(
        "_slice", "_row", "_before"
    )


# Bins per power of two: each bin spans 0.4 to 0.8 % of its value, near zero as anywhere.
_BINS_PER_POWER = 128
_LEAST_POWER = -1080  # below the smallest double


def value_bin(value: Column, finer: int = 1) -> Column:
    """Monotone bin of a number, by its power of two and the leading bits behind
    it; all doubles fall in under 600,000 bins, the usual amounts and scores in a
    few thousand. ``finer``, a power of two, cuts each bin into that many."""
    bins = _BINS_PER_POWER * finer
    power = F.floor(F.log2(F.abs(value)))
    part = F.floor((F.abs(value) / F.pow(F.lit(2.0), power) - 1) * F.lit(float(bins)))
    size = (power - F.lit(_LEAST_POWER)) * bins + part
    return F.when(value < 0, -size).when(value > 0, size).otherwise(F.lit(0).cast("bigint"))


def _same(left: str, right: str, groups: Sequence[str]) -> Column:
    match = F.lit(True)
    for g in groups:
        match = match & F.col(f"{left}.{g}").eqNullSafe(F.col(f"{right}.{g}"))
    return match


def running_totals(
    hist: DataFrame,
    groups: Sequence[str],
    value: str,
    counts: Sequence[str],
    descending: bool = False,
    finer: int = 1,
) -> DataFrame:
    """Adds ``<count>_upto``, the inclusive running total along ``value`` within
    each group, and ``<count>_all``, the group total. ``hist`` has one row per
    (group, value). Two levels: totals of value bins, then the running sum
    inside a bin, so no task sees a whole group."""
    groups = list(groups)
    order = lambda c: F.col(c).desc() if descending else F.col(c).asc()
    binned = hist.withColumn("_bin", value_bin(F.col(value).cast("double"), finer))
    per_group = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = per_group.orderBy(order("_bin")).rowsBetween(Window.unboundedPreceding, -1)
    bins = binned.groupBy(*groups, "_bin").agg(*[F.sum(c).alias(f"_t_{c}") for c in counts])
    bins = bins.select(
        *groups,
        "_bin",
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_b_{c}") for c in counts],
        *[F.sum(f"_t_{c}").over(per_group).alias(f"{c}_all") for c in counts],
    )
    inside = Window.partitionBy(*groups, "_bin").orderBy(order(value))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = binned.select("*", *[F.sum(c).over(running).alias(f"_l_{c}") for c in counts])
    joined = local.alias("l").join(bins.alias("b"), _same("l", "b", groups) & (F.col("l._bin") == F.col("b._bin")))
    return joined.select(
        *[f"l.{c}" for c in hist.columns],
        *[(F.col(f"_b_{c}") + F.col(f"_l_{c}")).alias(f"{c}_upto") for c in counts],
        *[F.col(f"{c}_all") for c in counts],
    )


# Up to this many rows all distinct values are counted, without a bracket.
DIRECT_ROWS = 1_000_000
_ACCURACY = 10_000
_FINE = 4_096  # bins of a bracketed histogram, per ordinary bin


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], values: Sequence[str], q: float | Column = 0.5, direct_rows: int = DIRECT_ROWS
) -> DataFrame:
    """Exact quantile of each value column per group, linearly interpolated,
    NULLs skipped; output columns keep the value names, as doubles.

    A quantile sketch brackets each quantile; then the values below the bracket
    are counted and the distinct values inside it, a few in ten thousand of the
    rows, are ranked. Sketches and counts combine before the shuffle, so a group
    with most of the rows costs no more than any other. Should a rank fall
    outside its bracket, all distinct values are ranked instead. ``df`` is read
    several times; pass a stored table.
    """
    if not isinstance(q, (int, float)):
        q = df.sparkSession.range(1).select(q.cast("double")).first()[0]
    q = 0.5 if q is None else float(q)  # no rows: every quantile is NULL
    keys = [*groups, "_one"]
    named = df.select(*groups, F.lit(0).alias("_one"), *[F.col(v).cast("double").alias(f"_v_{v}") for v in values])
    found = _ranked(named, keys, values, q, bracketed=True) if df.count() > direct_rows else None
    if found is None:
        found = _ranked(named, keys, values, q, bracketed=False)
    point = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part")
    return found.groupBy(*groups).agg(*[F.max(F.when(F.col("_metric") == v, point)).alias(v) for v in values])


def _ranked(
    named: DataFrame, keys: Sequence[str], values: Sequence[str], q: float, bracketed: bool
) -> DataFrame | None:
    """(keys, _metric, _a, _b, _part): the values at the ranks around each
    quantile and the position between them; None if a bracket missed."""
    metric = [*keys, "_metric"]
    rows = named
    if bracketed:
        ends = [max(0.0, q - 2 / _ACCURACY), min(1.0, q + 2 / _ACCURACY)]
        sketch = [F.percentile_approx(f"_v_{v}", ends, _ACCURACY).alias(f"_e_{v}") for v in values]
        brackets = materialize(named.groupBy(*keys).agg(*sketch), "brackets")
        side = F.broadcast(brackets) if brackets.count() <= BROADCAST_ROWS else brackets
        rows = named.alias("l").join(side.alias("r"), _same("l", "r", keys)).select(
            "l.*", *[f"r._e_{v}" for v in values]
        )
        below = {v: F.col(f"_v_{v}") < F.col(f"_e_{v}")[0] for v in values}
        inside = {v: F.col(f"_v_{v}").between(F.col(f"_e_{v}")[0], F.col(f"_e_{v}")[1]) for v in values}
    else:
        below = {v: F.lit(False) for v in values}
        inside = {v: F.col(f"_v_{v}").isNotNull() for v in values}

    counted = rows.groupBy(*keys).agg(
        *[F.struct(F.count(f"_v_{v}").alias("all"), F.count_if(below[v]).alias("below")).alias(f"_c_{v}") for v in values]
    )
    sizes = F.array(*[F.struct(F.lit(v).alias("m"), F.col(f"_c_{v}").alias("c")) for v in values])
    spot = q * (F.col("s.c.all") - F.lit(1))
    ranks = materialize(
        counted.withColumn("s", F.explode(sizes)).filter("s.c.all > 0").select(
            *keys, F.col("s.m").alias("_metric"), F.col("s.c.below").alias("_below"),
            F.floor(spot).alias("_low"), F.ceil(spot).alias("_high"), (spot - F.floor(spot)).alias("_part"),
        ),
        "ranks",
    )
    kept = F.array(
        *[F.when(inside[v], F.struct(F.lit(v).alias("m"), F.col(f"_v_{v}").alias("x"))) for v in values]
    )
    hist = materialize(
        rows.select(*keys, F.explode(kept).alias("p")).filter("p IS NOT NULL")
        .groupBy(*keys, F.col("p.m").alias("_metric"), F.col("p.x").alias("_x"))
        .agg(F.count(F.lit(1)).alias("_n")),
        "histogram",
    )
    side = F.broadcast(ranks) if ranks.count() <= BROADCAST_ROWS else ranks
    if bracketed:
        got = hist.groupBy(*metric).agg(F.sum("_n").alias("_in"))
        missed = (F.col("_low") < F.col("_below")) | (F.col("_high") >= F.col("_below") + F.coalesce("_in", F.lit(0)))
        checked = side.alias("l").join(got.alias("r"), _same("l", "r", metric), "left")
        if checked.filter(missed).limit(1).count():
            return None
    finer = _FINE if bracketed else 1
    runs = running_totals(hist, metric, "_x", ["_n"], finer=finer)
    upto = F.col("_below") + F.col("_n_upto")
    first = lambda rank: F.min(F.when(upto > F.col(rank), F.col("_x")))
    return (
        runs.alias("l").join(side.alias("r"), _same("l", "r", metric))
        .groupBy(*[F.col(f"l.{k}") for k in metric])
        .agg(first("_low").alias("_a"), first("_high").alias("_b"), F.max("_part").alias("_part"))
    )
