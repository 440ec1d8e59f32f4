"""Report queries from stored aggregates.

A cube holds the additive parts of the measures, rows, sums and counts of the
measured columns, per combination of some columns: the axes of a tile, the
slicers of its page and every column that a measure fixes. Parts of new rows are
appended, since a query adds up all parts of a combination anyway. A query takes
the smallest cube that holds all its columns, and the fact if there is none.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans.measures import MEASURES, Base, Filter, StarModel, all_of, matches
from riskloom.plans.tiles import SLICERS, TILES

MEASURED = ("amount", "anomaly_risk_score")
#: Columns that measures fix or show, or that pages filter by: part of every cube.
ALWAYS = tuple(
    sorted({"model_period", *[c for m in MEASURES.values() if isinstance(m, Base) for c in (*m.where, *([m.column] if m.kind == "selected" else []))]})
)
_TOO_FINE = {"transaction_id"}  # axes as fine as the fact


def tile_cubes() -> dict[str, tuple[str, ...]]:
    """Per tile, the columns of its cube; one cube stands for all tiles whose columns it holds."""
    wanted: dict[str, tuple[str, ...]] = {}
    for name, tile in TILES.items():
        if _TOO_FINE & set(tile.axes):
            continue
        page = SLICERS["investigation" if "risk_tier" in tile.page else "overview"]
        wanted[name] = tuple(dict.fromkeys((*tile.axes, *tile.page, *page, *ALWAYS)))
    return {n: c for n, c in wanted.items() if not any(set(c) < set(o) or (set(c) == set(o) and m < n) for m, o in wanted.items())}


def parts(model: StarModel, columns: Sequence[str]) -> DataFrame:
    """The additive parts per combination of ``columns``, in one pass over the fact."""
    sums = [part for c in MEASURED for part in (F.sum(c).alias(f"_sum_{c}"), F.count(c).alias(f"_n_{c}"))]
    return model.rows(columns, {}).groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"), *sums)


def write_cubes(model: StarModel, base: str, cubes: Mapping[str, Sequence[str]], mode: str = "overwrite") -> None:
    """Write each cube under ``base``; with ``mode`` "append", ``model`` holds new rows only and nothing else is read."""
    for name, columns in cubes.items():
        parts(model, columns).write.mode(mode).parquet(f"{base}/{name}")


@dataclass(frozen=True)
class Cube:
    columns: tuple[str, ...]
    table: DataFrame
    rows: int


def read_cubes(spark: SparkSession, base: str, names: Collection[str]) -> tuple[Cube, ...]:
    def read(name: str) -> Cube:
        table = spark.read.parquet(f"{base}/{name}")
        return Cube(tuple(c for c in table.columns if not c.startswith("_")), table, table.count())

    return tuple(read(name) for name in names)


@dataclass(frozen=True)
class CubeModel(StarModel):
    """A star whose queries read a cube where one holds all their columns. Filters drop rows without a value there, as
    a filter on a dimension drops rows without a dimension row; a filter that keeps NULL of a dimension differs."""

    cubes: tuple[Cube, ...] = ()

    def source(
        self, columns: Sequence[str], filters: Mapping[str, Filter], bases: Collection[Base] = ()
    ) -> tuple[DataFrame, Callable[[Base, Column], Column]]:
        asked = {*columns, *filters, *[c for b in bases for c in b.where], *[b.column for b in bases if b.kind == "selected"]}
        summed = {b.column for b in bases if b.kind in ("sum", "avg")}
        fits = [c for c in self.cubes if asked <= set(c.columns) and summed <= set(MEASURED)]
        if not fits:
            return super().source(columns, filters, bases)
        cube = min(fits, key=lambda c: c.rows)
        types = {f.name: f.dataType for f in cube.table.schema}

        def over(b: Base, condition: Column) -> Column:
            total = lambda part: F.sum(F.when(condition, F.col(part)))
            if b.kind == "count":
                return F.nullif(total("_rows"), F.lit(0))
            if b.kind == "selected":
                return b.over(condition)
            if b.kind == "sum":
                return total(f"_sum_{b.column}").cast(types[f"_sum_{b.column}"])
            return total(f"_sum_{b.column}").cast("double") / F.nullif(total(f"_n_{b.column}"), F.lit(0))

        return cube.table.filter(all_of([matches(F.col(c), w) for c, w in filters.items()])), over
