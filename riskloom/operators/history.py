"""Per-key history: time-range totals, sequence, previous row, first use.

Totals over ``[t - W, t]`` are the difference of two running totals, "everything
up to t" minus "everything before t - W". Both frames start at the first row, so
Spark extends them row by row and the work stays linear in a key's rows, however
many fall in the range. Values are integers, so the difference is exact.

A key with more than ``hot_rows`` rows would still be one window partition. Such
keys take another route: each row becomes an entry at ``t`` and, per range, an
exit just after ``t + W``; events are added up per instant; a range exchange on
(key, time) cuts the instants into balanced slices; totals inside a slice plus
the totals of earlier slices give the same numbers, with no task holding a key.
Rows are numbered in slices of (key, time, row id), which cut an instant too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.exact import micros
from riskloom.storage import BROADCAST_ROWS, materialize

HOT_ROWS = 5_000_000
SLICE_ROWS = 2_000_000
FEW_SLICES = 1_000  # more only where slices would be larger than SLICE_ROWS: bounds are sampled and tasks booked on the driver
MAX_SLICES = 50_000  # beyond it slices grow instead, to keep the exchange's bookkeeping small
_SECOND = 1_000_000


def sized(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint for a side with a counted size; otherwise Spark decides."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def slices_for(rows: int, slice_rows: int) -> int:
    """Slices of about ``slice_rows`` rows; beyond FEW_SLICES they grow up to SLICE_ROWS rows before there are more."""
    asked = ceil(rows / slice_rows)
    return min(MAX_SLICES, max(1, min(asked, max(FEW_SLICES, ceil(rows / SLICE_ROWS)))))


def hot_keys(df: DataFrame, key: str, limit: int) -> tuple[DataFrame | None, int, int]:
    """Keys with more than ``limit`` rows as a table, how many, and their rows.
    Counting is one map-side combined pass over the key column."""
    heavy = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    found = heavy.agg(F.count(F.lit(1)), F.coalesce(F.sum("_n"), F.lit(0))).first()
    if found[0] == 0:
        return None, 0, 0
    return materialize(heavy.select(key), "hot_keys"), int(found[0]), int(found[1])


def with_history(
    df: DataFrame,
    *,
    key: str,
    us: str,
    row_id: str,
    value: str,
    frames: Mapping[str, int],
    previous: Sequence[str] = (),
    first_use: str | None = None,
    attributes: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Adds to every row of ``df``, whose time ``us`` is in microseconds,

    * ``sum_<f>``, ``cnt_<f>`` for each frame ``f`` (seconds back, bounds and
      same-time rows included), over the integer column ``value``;
    * ``seq``, the 1-based position by (time, row id), and ``prev_<c>`` for the
      columns in ``previous``, from the row before;
    * ``first_use_us``, the earliest time of (key, ``first_use`` column);
    * the columns of ``attributes``, one row per key, joined on the key.
    """
    heavy, n_heavy, n_rows = hot_keys(df, key, hot_rows)
    plain = dict(key=key, us=us, value=value, row_id=row_id, frames=frames, previous=previous, first_use=first_use)
    if heavy is None:
        out = _by_key(df, **plain)
        return out if attributes is None else out.join(attributes, key)
    heavy = sized(heavy, n_heavy)
    calm = _by_key(df.join(heavy, key, "left_anti"), **plain)
    slices = slices_for(n_rows * (1 + len(frames)), slice_rows)
    busy = _by_slice(df.join(heavy, key, "left_semi"), slices=slices, n_keys=n_heavy, **plain)
    if attributes is not None:
        calm = calm.join(attributes, key)
        busy = busy.join(sized(attributes.join(heavy, key, "left_semi"), n_heavy), key)
    return calm.unionByName(busy)


def _previous(columns: Sequence[str], take) -> list[Column]:
    return [take(c).alias(f"prev_{c}") for c in columns]


def _by_key(rows: DataFrame, *, key, us, value, row_id, frames, previous, first_use) -> DataFrame:
    # Sequence first: its (time, id) order also serves the time-only frames.
    seq = Window.partitionBy(key).orderBy(us, row_id)
    out = rows.select(
        "*", F.row_number().over(seq).cast("bigint").alias("seq"), *_previous(previous, lambda c: F.lag(c).over(seq))
    )
    by_time = Window.partitionBy(key).orderBy(us)
    upto = by_time.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    one = F.lit(1).cast("bigint")
    totals = []
    for name, seconds in frames.items():
        before = by_time.rangeBetween(Window.unboundedPreceding, -seconds * _SECOND - 1)
        totals += [
            (F.sum(value).over(upto) - F.coalesce(F.sum(value).over(before), F.lit(0))).alias(f"sum_{name}"),
            (F.count(one).over(upto) - F.count(one).over(before)).alias(f"cnt_{name}"),
        ]
    out = out.select("*", *totals)
    if first_use:
        out = out.withColumn("first_use_us", F.min(us).over(Window.partitionBy(key, first_use)))
    return out


def _sliced(df: DataFrame, slices: int, order: Sequence[str], name: str) -> DataFrame:
    """Stored, cut into balanced slices of the order."""
    return materialize(df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()), name)


def _carried_over(parts: DataFrame, key: str, sums: Mapping[str, Column], *more: Column) -> DataFrame:
    """Per key and slice, the totals of earlier slices as ``_b_<name>``: at most one row per slice and key."""
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return parts.groupBy(key, "_slice").agg(*[F.sum(c).alias(n) for n, c in sums.items()], *more).select(
        key, "_slice", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_b_{n}") for n in sums],
        *[F.last("_last", ignorenulls=True).over(earlier).alias("_last") for _ in more],
    )


def _totals_by_instant(rows: DataFrame, *, key, us, value, frames, slices, n_keys) -> DataFrame:
    """(key, us, sum and count per frame): one row per instant that has rows. Rows and exits of an instant are added up
    before the slicing, so an instant is one row however many rows it has."""
    exits = F.array(
        *[
            F.struct(F.lit(i + 1).alias("tag"), (F.col(us) + F.lit(s * _SECOND + 1)).alias("us"))
            for i, s in enumerate(frames.values())
        ]
    )
    left = rows.select(key, value, F.explode(exits).alias("e")).select(key, F.col("e.us").alias(us), value, F.col("e.tag").alias("_tag"))
    events = rows.select(key, us, value, F.lit(0).alias("_tag")).unionByName(left)
    is_row, change = F.col("_tag") == 0, {}
    for i, name in enumerate(frames):
        gone = F.col("_tag") == i + 1
        change[f"sum_{name}"] = F.when(is_row, F.col(value)).when(gone, -F.col(value)).otherwise(0)
        change[f"cnt_{name}"] = F.when(is_row, 1).when(gone, -1).otherwise(0).cast("bigint")
    instants = events.groupBy(key, us).agg(*[F.sum(c).alias(n) for n, c in change.items()], F.bool_or(is_row).alias("_rows"))
    instants = _sliced(instants, slices, (key, us), "instants")
    handed = _carried_over(instants, key, {n: F.col(n) for n in change})
    upto = Window.partitionBy(key, "_slice").orderBy(us).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = instants.select(key, us, "_slice", "_rows", *[F.sum(n).over(upto).alias(f"_l_{n}") for n in change])
    joined = local.filter("_rows").join(sized(handed, slices + n_keys), [key, "_slice"])
    return joined.select(key, us, *[(F.col(f"_b_{n}") + F.col(f"_l_{n}")).alias(n) for n in change])


def _by_slice(rows: DataFrame, *, key, us, value, row_id, frames, previous, first_use, slices, n_keys) -> DataFrame:
    names = [f"{kind}_{name}" for name in frames for kind in ("sum", "cnt")]
    cut = _sliced(rows, slices, (key, us, row_id), "slices")
    carried = F.struct(*[F.col(c) for c in previous]) if previous else F.struct(F.lit(0).alias("none"))
    one = F.lit(1).cast("bigint")
    handed = _carried_over(cut, key, {"seq": one}, F.max_by(carried, F.struct(us, row_id)).alias("_last"))
    by_row = Window.partitionBy(key, "_slice").orderBy(us, row_id)
    local = cut.select("*", F.row_number().over(by_row).cast("bigint").alias("_l_seq"), F.lag(carried).over(by_row).alias("_near"))
    local = local.join(sized(handed, slices + n_keys), [key, "_slice"])
    before = F.coalesce(F.col("_near"), F.col("_last"))
    out = local.select(
        *rows.columns, "_slice", (F.col("_b_seq") + F.col("_l_seq")).alias("seq"), *_previous(previous, lambda c: before[c])
    )
    if frames:
        totals = _totals_by_instant(rows, key=key, us=us, value=value, frames=frames, slices=slices, n_keys=n_keys)
        # One row of totals for all rows of an instant: a join whose large side Spark may split.
        out = out.join(totals, [key, us]).select(*out.columns, *names)
    if first_use:
        # Groups of the join are bounded by a slice, even when one (key, value) is most of the key.
        use = cut.groupBy(key, first_use, "_slice").agg(F.min(us).alias("_first"))
        use = use.select(
            key, first_use, "_slice", F.min("_first").over(Window.partitionBy(key, first_use)).alias("first_use_us")
        )
        out = out.join(use, [key, first_use, "_slice"])
        out = out.select(*[c for c in out.columns if c != "first_use_us"], "first_use_us")
    return out.drop("_slice")


def rolling(df: DataFrame, key: str, ts: str, value: str, seconds: int, row_id: str, **options) -> DataFrame:
    """Sum and count of an integer ``value`` over the last ``seconds`` per key."""
    timed = df.withColumn("_us", micros(ts))
    out = with_history(timed, key=key, us="_us", row_id=row_id, value=value, frames={"w": seconds}, **options)
    return out.drop("_us", "seq").withColumnsRenamed({"sum_w": "sum", "cnt_w": "count"})
