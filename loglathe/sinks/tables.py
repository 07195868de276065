"""Writing rows: layout, tables with a checked schema, and the one-pass writer for good rows and rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.sinks.commits import ATTEMPT, MERGED, batch_folder, newest_attempt, visible, write_batch

DEFAULT_TABLE = "parsed_logs"
#: marks columns that take no null; file formats keep no such constraint of their own
REQUIRED = "required"
GOOD, REJECT = "good", "reject"

_PLACES = ("run", "batch", "outcome", "event_date")


@dataclass(frozen=True)
class Layout:
    """File layout of a table."""

    row_group_bytes: int = 128 * 1024 * 1024
    page_bytes: int = 1024 * 1024
    max_records_per_file: int = 0  # 0 = no limit
    target_file_bytes: int = 128 * 1024 * 1024  # what merging aims at
    reject_file_bytes: int = 128 * 1024 * 1024  # where a file of reject texts ends; 0 = no limit
    compression: str = "zstd"

    def options(self) -> dict[str, str]:
        return {
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "maxRecordsPerFile": str(self.max_records_per_file),
            "compression": self.compression,
        }


def table_name(database: str | None, table: str | None = None) -> str:
    """``database.table``, quoted. A blank database is an error; the table has a default name."""
    if database is None or not database.strip():
        raise ValueError("Invalid database name: null or empty")
    chosen = DEFAULT_TABLE if table is None else table
    if not chosen.strip():
        raise ValueError("Invalid table name: null or empty")
    return ".".join("`" + part.replace("`", "``") + "`" for part in (database, chosen))


def schema_differences(found: T.StructType, expected: T.StructType) -> list[str]:
    """What differs by column name and type. Order and nullability do not count: files relax the latter."""
    have = {f.name: f.dataType for f in found.fields}
    want = {f.name: f.dataType for f in expected.fields}
    out = [f"missing column {n}" for n in want if n not in have]
    out += [f"unexpected column {n}" for n in have if n not in want]
    out += [
        f"column {n} is {have[n].simpleString()}, expected {t.simpleString()}"
        for n, t in want.items()
        if n in have and have[n] != t
    ]
    return out


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    *,
    partition_by: Sequence[str] = ("event_date",),
    location: str | None = None,
    layout: Layout | None = None,
    properties: Mapping[str, str] | None = None,
    provider: str = "parquet",
    add_columns: bool = False,
) -> str:
    """Create the table if it is absent; otherwise compare its schema and fail when it has drifted.

    With ``add_columns`` an existing table gets the columns that it doesn't have, null in older rows; ``sinks.evolving`` takes wider types too.
    """
    if spark.catalog.tableExists(name):
        if add_columns:
            have = set(spark.table(name).schema.names)
            new = [f for f in schema.fields if f.name not in have]
            if new:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS (" + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new) + ")")
            schema = T.StructType([*schema.fields, *[f for f in spark.table(name).schema.fields if f.name not in schema.names]])
        differences = schema_differences(spark.table(name).schema, schema)
        if differences:
            raise ValueError(f"Table {name} does not have the expected schema: " + "; ".join(differences))
        return name
    missing = [c for c in partition_by if c not in schema.names]
    if missing:
        raise ValueError(f"Partition columns not in the schema: {missing}")
    required = {f.name for f in schema.fields if not f.nullable and f.name not in partition_by}
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT '{REQUIRED}'" if f.name in required else "") for f in schema.fields
    )
    options = (layout or Layout()).options()
    ddl = f"CREATE TABLE {name} ({columns}) USING {provider}"
    ddl += " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
    if partition_by:
        ddl += " PARTITIONED BY (" + ", ".join(f"`{c}`" for c in partition_by) + ")"
    if location:
        ddl += f" LOCATION '{location}'"
    if properties:
        ddl += " TBLPROPERTIES (" + ", ".join(f"'{k}'='{v}'" for k, v in properties.items()) + ")"
    spark.sql(ddl)
    return name


def append_table(df: DataFrame, name: str, *, distribution: str = "none") -> None:
    """Append rows to an existing table, matching columns by name; a null in a required column ends the job.

    ``distribution`` as in ``distribute``.
    """
    table = df.sparkSession.table(name)
    differences = schema_differences(df.schema, table.schema)
    if differences:
        raise ValueError(f"Rows do not fit table {name}: " + "; ".join(differences))
    partitions = [c.name for c in df.sparkSession.catalog.listColumns(name) if c.isPartition]
    required = [f.name for f in table.schema.fields if f.metadata.get("comment") == REQUIRED]
    rows = distribute(df, partitions, distribution).select(*[_required(c) if c in required else F.col(f"`{c}`") for c in table.columns])
    rows.write.mode("append").insertInto(name)


def _required(name: str) -> Column:
    """The column; a null in it ends the job."""
    message = F.lit(f"Required column {name} is null")
    return F.when(F.col(f"`{name}`").isNull(), F.raise_error(message)).otherwise(F.col(f"`{name}`")).alias(name)


def distribute(df: DataFrame, partition_by: Sequence[str], mode: str) -> DataFrame:
    """How rows reach the writing tasks.

    ``none``       no exchange: each task writes what it has; right when a batch spans few partition values
    ``rebalance``  by partition value, with AQE cutting large values into several tasks and joining small ones

    Plain hashing by partition value is not offered: with one processing date per batch it would send the whole batch
    to one task.
    """
    if mode == "none" or not partition_by:
        return df
    if mode == "rebalance":
        return df.hint("rebalance", *[F.col(c) for c in partition_by])
    raise ValueError(f"Unknown distribution: {mode}")


def write_outcomes(
    outcomes: DataFrame,
    root: str,
    run: str,
    batch: int,
    *,
    layout: Layout | None = None,
    distribution: str = "none",
    keep_replaced: bool = False,
) -> None:
    """Write good rows and rejects of one batch in a single pass over it.

    Files land in ``root/run=R/batch=N/outcome=good|reject/event_date=..``.  Writing the same batch of the same run again
    replaces all that it left, good and rejected, whatever the dates and also when there are no rows now; nothing else is
    touched.  The new attempt is written beside the old one and counts from its marker on (``commits``), so readers find the old
    rows until they find the new ones, also if the job is killed.  The old attempt's folder is deleted then; readers that are still in
    it fail, and ``keep_replaced`` leaves it to them.  A batch that was merged with others can't be replaced.
    """
    if run.startswith(MERGED):
        raise ValueError(f"Run names that start with {MERGED} are for merged batches: {run}")
    rows = distribute(outcomes, ("outcome", "event_date"), distribution)
    writer = (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .options(**(layout or Layout()).options())
        .partitionBy("outcome", "event_date")
    )
    write_batch(outcomes.sparkSession, root, run, batch, writer.parquet, keep_replaced=keep_replaced)


def read_outcomes(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    outcome: str,
    run: str | None = None,
    batch: int | None = None,
) -> DataFrame:
    """One kind of outcome, of all batches or of one of a run; only those folders are listed and read.

    ``schema`` holds the wanted columns, ``event_date``, ``run`` and ``batch`` too if wanted.  A folder that does not exist is an
    error; a batch that was not finished has no rows.
    """
    kept = [f for f in schema.fields if f.name not in _PLACES]
    full = T.StructType([*kept, *[T.StructField(n, T.LongType() if n == "batch" else T.StringType()) for n in _PLACES]])
    seen = F.col("outcome") == outcome
    if run is None:
        rows = spark.read.schema(full).option("basePath", root).parquet(root)
        seen &= visible(spark, root)
    else:
        attempt = newest_attempt(spark, root, run, batch or 0)
        folder = batch_folder(root, run, batch or 0, attempt or 1)
        rows = spark.read.schema(full).option("basePath", root).parquet(folder)
        seen &= F.lit(attempt > 0)
    own = F.substring_index("run", ATTEMPT, 1).alias("run")
    return rows.where(seen).select(*[own if c == "run" else c for c in schema.names])
