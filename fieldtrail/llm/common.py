"""Helpers shared by the operators: stored intermediates, worker import path, row identity."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldtrail.session import scratch_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch; texts can be long.
BATCH_ROWS = 1000


def workers_can_import(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it, and get small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: later steps neither repeat its
    work nor depend on shuffle files of executors that may be lost."""
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_key(text: Column) -> list[Column]:
    """96 bits that identify a text; rows with the same text share them."""
    return [F.xxhash64(text).alias("k1"), F.hash(text, F.length(text)).alias("k2")]


def kinds(df: DataFrame) -> str:
    """The columns of ``df`` as a schema text."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def text_batches(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20) -> Iterator[tuple[int, int, list[bytes]]]:
    """Slices (first row, end row, texts as UTF-8) of a batch, each of about ``max_bytes``.

    NULL counts as empty. A single longer text forms its own slice.
    """
    texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > max_bytes:
            yield start, i, texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts), texts[start:]
