"""Log files as rows: one line each, with the file it came from. The same columns in batch and as a stream."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE_COLUMNS = ("value", "file_path", "file_name")


def _with_origin(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
    )


def scan_lines(spark: SparkSession, path: str | list[str], *, recursive: bool = True, glob: str | None = None) -> DataFrame:
    """Every line of every file under ``path``: ``value, file_path, file_name``.

    Large files are split between tasks by size (``spark.sql.files.maxPartitionBytes``).  Compressed files that cannot be
    split are read by one task each, so keep those small.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _with_origin(reader.text(path))


def stream_lines(
    spark: SparkSession,
    path: str,
    *,
    max_files_per_batch: int | None = 1000,
    max_bytes_per_batch: str | None = None,
    recursive: bool = True,
    glob: str | None = None,
) -> DataFrame:
    """Lines of files as they appear under ``path``. Each batch is bounded by a number of files or by bytes.

    Files must appear whole: write them elsewhere and move them in, since a file is read once.
    """
    reader = spark.readStream.option("recursiveFileLookup", str(recursive).lower())
    if max_bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_batch)
    elif max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_batch))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _with_origin(reader.text(path))


def log_type_from_path(types: dict[str, str], path_col: str = "file_path") -> Column:
    """Log type by file path: the first entry of ``{log type: substring of the path}`` that fits.

    Paths come URL-encoded and are compared decoded.
    """
    kind: Column | None = None
    for name, part in types.items():
        hit = F.contains(F.coalesce(F.try_url_decode(F.col(path_col)), F.col(path_col)), F.lit(part))
        kind = F.when(hit, F.lit(name)) if kind is None else kind.when(hit, F.lit(name))
    if kind is None:
        raise ValueError("No log types given")
    return kind
