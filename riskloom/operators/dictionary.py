"""Dictionary encoding: each column's sorted distinct values, coded from 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.operators.history import sized
from riskloom.operators.ordering import dense_key
from riskloom.storage import BROADCAST_ROWS, materialize


def dictionaries(df: DataFrame, columns: Sequence[str], short: int = BROADCAST_ROWS) -> tuple[DataFrame, dict[str, int]]:
    """Long table (dimension, value, code) over all columns, and each column's
    number of values. One pass: values are made distinct before and after the shuffle."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    values = materialize(
        df.select(F.explode(pairs).alias("p")).select("p.dimension", "p.value").distinct(), "dictionary"
    )
    sizes = {r["dimension"]: r["count"] for r in values.groupBy("dimension").count().collect()}
    if max(sizes.values(), default=0) <= short:
        order = Window.partitionBy("dimension").orderBy("value")
        return values.withColumn("code", F.row_number().over(order).cast("bigint") - 1), sizes
    keyed = dense_key(values, ["dimension", "value"], "position")
    first = keyed.groupBy("dimension").agg(F.min("position").alias("first"))
    coded = keyed.join(first, "dimension").withColumn("code", F.col("position") - F.col("first"))
    return materialize(coded.select("dimension", "value", "code"), "dictionary_codes"), sizes


def dictionary_encode(df: DataFrame, columns: Sequence[str], short: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """``df`` with every listed column replaced by its code, and the dictionaries."""
    table, sizes = dictionaries(df, columns, short)
    out = df
    for c in columns:
        codes = table.filter(F.col("dimension") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("code").alias(f"_c_{c}")
        )
        out = out.join(sized(codes, sizes.get(c, 0)), F.col(c).cast("string").eqNullSafe(F.col(f"_v_{c}")))
    return out.select(*[F.col(f"_c_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]), table
