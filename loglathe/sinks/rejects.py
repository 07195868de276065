"""The reject store: one JSON envelope per line, UTF-8 text, one folder per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglathe.operators.route import reject_envelope
from loglathe.sinks.commits import batch_folder

FILE = "part"


def roll_by_bytes(lines: DataFrame, max_bytes: int) -> DataFrame:
    """``lines`` (value) with ``part``, the number of the file a line belongs to: a file ends with the line that fills it.

    Lines are counted in bytes with their newline, in the order of the tasks that hold them.  Each task's sum gives the next ones their start, so
    what is gathered is one number a task; a task's own lines are added up in one task, as they lie there.
    """
    held = lines.select(
        "value",
        (F.octet_length("value") + 1).cast("long").alias("bytes"),
        F.spark_partition_id().alias("chunk"),
        F.monotonically_increasing_id().alias("at"),
    )
    inside = Window.partitionBy("chunk").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each task
    starts = held.groupBy("chunk").agg(F.sum("bytes").alias("all")).select("chunk", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("start"))
    own = held.withColumn("own", F.coalesce(F.sum("bytes").over(inside), F.lit(0)))
    place = F.coalesce("start", F.lit(0)) + F.col("own")
    return own.join(starts, "chunk", "left").select("value", F.floor(place / max_bytes).alias(FILE), place.alias("place"))


def write_reject_text(
    reject_table: DataFrame,
    path: str,
    run: str | None = None,
    batch: int = 0,
    *,
    max_records_per_file: int = 0,
    max_bytes_per_file: int = 0,
) -> None:
    """Append envelopes under ``path``; with a run the folder of its batch is replaced instead.

    A file ends after ``max_records_per_file`` envelopes (0: no limit).  With ``max_bytes_per_file`` envelopes are dealt to files that end with
    the envelope which brings them to so many bytes; none is split, and a batch's files are full but for the last.
    """
    lines = reject_envelope(reject_table)
    one_file = max_bytes_per_file and (lines.agg(F.sum(F.octet_length("value") + 1)).head()[0] or 0) <= max_bytes_per_file
    if one_file:
        writer = lines.coalesce(1).write
    elif max_bytes_per_file:
        dealt = roll_by_bytes(lines, max_bytes_per_file).repartition(FILE).sortWithinPartitions(FILE, "place").drop("place")
        writer = dealt.write.partitionBy(FILE)
    else:
        writer = lines.write
    writer = writer.option("maxRecordsPerFile", str(max_records_per_file))
    if run is None:
        writer.mode("append").text(path)
    else:
        writer.mode("overwrite").text(batch_folder(path, run, batch))


def read_reject_text(spark: SparkSession, path: str) -> DataFrame:
    """All stored envelopes."""
    return spark.read.option("recursiveFileLookup", "true").text(path)
