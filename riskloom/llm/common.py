"""Small helpers of the operators: words, worker memory, shared folders."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.storage import BROADCAST_ROWS, materialize

#: White space between words, as a Java and DuckDB character class. ``bytes.split()`` cuts at the same six bytes.
SPACE = r"\x20\x09-\x0D"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small(df: DataFrame) -> DataFrame:
    """``df``, a stored table, with a broadcast hint if its counted rows allow one."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def stored(df: DataFrame, name: str) -> DataFrame:
    return materialize(df, f"llm-{name}")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored with ``_row``, a number of its own for every row. It is
    written once, so a lost executor cannot deal other numbers."""
    return stored(df.withColumn("_row", F.monotonically_increasing_id()), name)


def whole_rows(documents: DataFrame, name: str) -> DataFrame:
    """(_row, _doc) stored: the documents with all their columns folded into one, so that none can clash."""
    return numbered(documents.select(F.struct("*").alias("_doc")), name)


def worker_memory(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, over many tasks, until a task asks for another name: a
    worker that goes on to another operator does not hold both. Callers bound its size."""
    home = sys.modules.setdefault("_riskloom_worker", types.ModuleType("_riskloom_worker"))
    held = home.__dict__.setdefault("held", {})
    for other in set(held) - {name}:
        del held[other]
    return held.setdefault(name, {})


def texts(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """UTF-8 bytes of a text column, null as empty, without a copy of the whole batch."""
    column = batch.column(name)
    column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
    for value in column:
        yield value.as_py() or b""


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that a worker holds copies of few texts at a time. A batch
    without rows stays one. For operators that keep nothing between tasks: what another one kept goes."""
    worker_memory("nothing")
    for b in batches:
        for at in range(0, max(1, b.num_rows), rows):
            yield b.slice(at, rows)
    pa.default_memory_pool().release_unused()


_BREAK = re.compile(rb"[\x20\x09-\x0D]")


def text_blocks(text: bytes, size: int = 4 << 20) -> Iterator[bytes]:
    """A text in blocks of about ``size`` bytes that end between words, so that a very long one is never a single list."""
    at = 0
    while len(text) - at > size:
        found = _BREAK.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text


def nulls_last(column: str) -> list[Column]:
    return [F.col(column).isNull(), F.col(column)]


def doc_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns can clash with nothing."""
    return df.select(*[F.col(f"`{n}`") for n in names])
