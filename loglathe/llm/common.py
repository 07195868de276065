"""What the operators share: scratch tables, plain document columns, Arrow batches of a bounded size, the registry."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from loglathe.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# words as in every contract: what lies between blanks, tabs and line ends
WORD = r"[^\x20\x09-\x0D]+"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 2,000 rows or 16 MB, so that a Python worker's memory doesn't follow the text length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, and outlives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` for each Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def bounded_sample(df: DataFrame, by: Column, size: int) -> list[Row]:
    """At most ``size`` rows, those with the least hash of ``by`` among a part of all that holds a few more than that.

    A plain ordered limit would send ``size`` rows of every task to the driver; here all tasks together send about that many.
    The same rows give the same sample.
    """
    rows = df.withColumn("_place", F.pmod(F.xxhash64(by), F.lit(1 << 32)))
    n = rows.count()
    if n > size:
        rows = rows.where(F.col("_place") < int(1.2 * size / n * (1 << 32)) + 1)
    return sorted(rows.collect(), key=lambda r: (r["_place"], str(r)))[:size]


def long_array(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark longs."""
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def list_array(values: pa.Array, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), values)


def binary_array(pieces: list[bytes]) -> pa.Array:
    return pa.array(pieces, pa.binary())


def crc_mod(column: str, divisor: int):
    """crc32 of a column written as text, modulo a divisor; null stays null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor
