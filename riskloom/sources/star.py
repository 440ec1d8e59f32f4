"""Loading and publishing star-schema tables."""

from __future__ import annotations

import csv
import uuid
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskloom.sources.schemas import FEATURES, SCORES, STAR, TableSpec
from riskloom.storage import children, exists, mark, remove, scratch_path

# Tables derived from the base tables; a reload makes them stale.
DERIVED = {"txn_features": FEATURES, "txn_risk_scores": SCORES}
# What reports read; emptied by a reload if it is there.
REPORTING = (
    "feature_validation", "feature_importance", "bi_fact_transactions", "bi_dim_customer", "bi_dim_date",
    "bi_model_performance", "bi_scenario_recall",
)
EXTRACT = ("columns", "dictionaries", "alerts", "model", "header")


_FILE_ALONE = str(1 << 40)  # bytes: as the cost of opening a file, no task takes a second one


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header), stored: the first line that is not blank of every file under ``path``, in any store Spark reads.
    One job with a short task per file, which stops reading after the first lines; files without a line are left out."""
    other = spark.newSession()  # settings of this read alone
    other.conf.set("spark.sql.files.maxPartitionBytes", _FILE_ALONE)
    other.conf.set("spark.sql.files.openCostInBytes", _FILE_ALONE)
    other.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    place = F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for line, file in zip(b.column("value").to_pylist(), b.column("file").to_pylist(), strict=True):
                if line.strip("\ufeff \t\r"):
                    header = line.removeprefix("\ufeff").removesuffix("\r")
                    yield pa.RecordBatch.from_pydict({"file": [unquote(file)], "header": [header]})
                    return

    lines = other.read.text(path).select("value", *place).filter("at = 0").select("value", "file")
    out = scratch_path(spark, "headers")
    lines.mapInArrow(first, "file string, header string").write.parquet(out)
    return spark.read.schema("file string, header string").parquet(out)


def read_csv(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """CSV with a header: columns are taken by name, types from the schema.
    Files may have their columns in different orders; files that agree are read
    together, and Spark compares each header once more while it reads. File names
    are listed on the driver only if headers differ."""
    types = {f.name: f.dataType for f in spec.schema}
    held = file_headers(spark, path)
    headers = sorted(r[0] for r in held.select("header").distinct().collect())
    if not headers:
        raise ValueError(f"{path}: no files with a header")
    parts = []
    for line in headers:
        header = next(csv.reader([line]))
        missing = set(spec.required) - set(header)
        if missing:
            raise ValueError(f"{path}: missing columns {sorted(missing)}")
        schema = ", ".join(f"`{c}` {types[c].simpleString() if c in types else 'string'}" for c in header)
        files = path if len(headers) == 1 else sorted(r[0] for r in held.filter(F.col("header") == line).select("file").collect())
        rows = (
            spark.read.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)
            .schema(schema).csv(files)
        )
        parts.append(rows.select(*[F.col(c) if c in header else F.lit(None).cast(t).alias(c) for c, t in types.items()]))
    return reduce(DataFrame.unionByName, parts)


def read_star_csv(spark: SparkSession, folder: str, names: Sequence[str] = tuple(STAR)) -> dict[str, DataFrame]:
    return {name: read_csv(spark, f"{folder}/{STAR[name].file}", STAR[name]) for name in names}


def home(spark: SparkSession, base: str) -> str:
    """Where the tables under ``base`` are: the folder of the last complete load, ``base`` itself before the first."""
    complete = children(spark, f"{base}/complete")
    return f"{base}/versions/{complete[-1]}" if complete else base


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{home(spark, base)}/{name}")


def read_star(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The base tables, all of one load."""
    place = home(spark, base)
    return {name: spark.read.parquet(f"{place}/{name}") for name in STAR}


def _write(df: DataFrame, path: str, name: str, partition_by: tuple[str, ...] = ()) -> int:
    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return seen.get["rows"]


def publish(df: DataFrame, base: str, name: str, partition_by: tuple[str, ...] = ()) -> int:
    """Replace a published table and return its row count, taken during the write."""
    return _write(df, f"{home(df.sparkSession, base)}/{name}", name, partition_by)


def load_star(tables: Mapping[str, DataFrame], base: str) -> dict[str, int]:
    """Replace the base tables and empty every table, report and extract that an
    earlier run derived from them. Running it again gives the same contents.

    A load writes to a folder of its own, which counts once its name is listed
    as complete, after its last table. Until then, and after a load that failed,
    readers see the load before it, whole. That one is kept for readers that
    began with it; older ones go. Of two loads at once, one is read."""
    spark = tables["fact_transaction"].sparkSession
    complete, old = children(spark, f"{base}/complete"), home(spark, base)
    number = int(complete[-1].split("-")[0]) + 1 if complete else 1
    version = f"{number:012d}-{uuid.uuid4().hex}"
    place = f"{base}/versions/{version}"
    counts = {name: _write(tables[name].select(*spec.schema.names), f"{place}/{name}", name) for name, spec in STAR.items()}
    for name, spec in DERIVED.items():
        spark.createDataFrame([], spec.schema).write.parquet(f"{place}/{name}")
    for name in REPORTING:
        if exists(spark, f"{old}/{name}"):
            spark.createDataFrame([], spark.read.parquet(f"{old}/{name}").schema).write.parquet(f"{place}/{name}")
    mark(spark, f"{base}/complete/{version}")
    for name in EXTRACT:
        if exists(spark, f"{base}/web/{name}"):
            spark.createDataFrame([], "row bigint").write.mode("overwrite").json(f"{base}/web/{name}")
    for name in children(spark, f"{base}/versions"):
        if name not in (version, *complete[-1:]) and name < version:
            remove(spark, f"{base}/complete/{name}")
            remove(spark, f"{base}/versions/{name}")
    return counts


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)
