"""The whole way from lines to tables, as one plan for batch and stream."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.functions.text import MAX_LINE_LENGTH
from loglathe.operators.parse import (
    BLANK,
    OK,
    TOO_LONG,
    check_log_type,
    check_patterns,
    parse_lines,
    parse_multi_format,
)
from loglathe.operators.quality import counter_columns
from loglathe.operators.route import reject_columns
from loglathe.operators.shape import EVENT_DATE, UNDATED, mixed_row_columns, processing_date, row_columns
from loglathe.plans.formats import LogFormat, log_format
from loglathe.sinks.merge import compact
from loglathe.sinks.rejects import write_reject_text
from loglathe.sinks.tables import GOOD, REJECT, Layout, read_outcomes, write_outcomes
from loglathe.sources.files import log_type_from_path, scan_lines

REJECT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("rejected_at", "error_class", "error_type", "error_message", "record")]
)


@dataclass(frozen=True)
class Flow:
    """What to do with the lines of one log type, or of several at once.

    ``fmt`` is a preset name, format or template or, for several log types, ``{log type: one of these}``; templates may use the
    names in ``custom``.  The type of a line is
    then its ``log_type`` column, or follows from ``type_paths``, ``{log type: part of the file path}``.
    """

    fmt: str | LogFormat | Mapping[str, str | LogFormat]
    log_type: str = "generic"
    columns: tuple[str, ...] | None = None
    types: dict[str, str] = field(default_factory=dict)
    mask: dict[str, int] = field(default_factory=dict)
    mask_json: tuple[str, ...] = ()
    event_date_from: str | None = None
    event_time_from: str | None = None
    year: int | None = None
    undated: str = UNDATED  # partition of lines without a readable date; "today" for the processing date
    custom: dict[str, str] = field(default_factory=dict)
    max_length: int | None = MAX_LINE_LENGTH
    oversize: str = "reject"  # or "drop"
    layout: Layout = Layout()
    distribution: str = "auto"  # or "none", "rebalance"
    type_paths: dict[str, str] = field(default_factory=dict)

    @property
    def mixed(self) -> bool:
        return isinstance(self.fmt, Mapping)

    def __post_init__(self) -> None:
        check_log_type(self.log_type)
        if self.mixed:
            for name, fmt in self.fmt.items():
                check_log_type(name)
                log_format(fmt, self.custom).compiled  # raises for a bad template
        else:
            log_format(self.fmt, self.custom).compiled
        if self.oversize not in ("reject", "drop"):
            raise ValueError(f"Unknown oversize rule: {self.oversize}")

    def parse(self, lines: DataFrame) -> DataFrame:
        if not self.mixed:
            return parse_lines(lines, self.fmt, custom=self.custom, max_length=self.max_length)
        if self.type_paths:
            lines = lines.withColumn("log_type", log_type_from_path(self.type_paths))
        return parse_multi_format(lines, self.fmt, custom=self.custom, max_length=self.max_length)

    def check(self, spark: SparkSession) -> None:
        """Fail on a pattern that is no valid regex, before any data is read."""
        check_patterns(spark, *(self.fmt.values() if self.mixed else [self.fmt]), custom=self.custom)

    def cells(self, parsed: DataFrame) -> dict[str, Column]:
        options = {
            "columns": self.columns,
            "types": self.types,
            "mask": self.mask,
            "mask_json": self.mask_json,
            "event_date_from": self.event_date_from,
            "event_time_from": self.event_time_from,
            "year": self.year,
            "undated": self.undated,
            "custom": self.custom,
        }
        if self.mixed:
            return mixed_row_columns(self.fmt, **options)
        return row_columns(parsed, self.fmt, **options)

    def outcomes(self, lines: DataFrame, observation: Observation | str | None = None) -> DataFrame:
        """Good rows and rejects side by side, told apart by ``outcome``; blank lines are counted, then dropped."""
        parsed = self.parse(lines)
        if observation is not None:
            parsed = parsed.observe(observation, *counter_columns(F.col("status"), F.col("value")))
        cells = self.cells(parsed)
        ok = F.col("status") == OK
        good = {n: F.when(ok, c) for n, c in cells.items() if n != EVENT_DATE}
        bad = {n: F.when(~ok, c) for n, c in reject_columns(F.col("value")).items()}
        clash = set(good) & {*bad, "outcome", "run", "batch"}
        if clash:
            raise ValueError(f"Field names in use by the reject columns: {sorted(clash)}")
        skipped = [BLANK, TOO_LONG] if self.oversize == "drop" else [BLANK]
        return parsed.where(~F.col("status").isin(*skipped)).select(
            *[c.alias(n) for n, c in {**good, **bad}.items()],
            F.when(ok, GOOD).otherwise(REJECT).alias("outcome"),
            F.when(ok, cells[EVENT_DATE]).otherwise(processing_date()).alias(EVENT_DATE),
        )

    def good_schema(self, spark: SparkSession) -> T.StructType:
        """Columns of the good table, in order, partition date last. All are required; a typed field may be null."""
        empty = self.parse(spark.createDataFrame([], "value string, file_path string, log_type string"))
        cells = self.cells(empty)
        shaped = empty.select(*[c.alias(n) for n, c in cells.items()]).schema
        return T.StructType(
            [T.StructField(f.name, f.dataType, not isinstance(f.dataType, T.StringType)) for f in shaped.fields]
        )

    # -- results ---------------------------------------------------------------------------------------------------

    def store(self, outcomes: DataFrame, root: str, run: str, batch: int, reject_path: str | None = None) -> None:
        """Write one batch of a run; then copy its rejects, which by now are a small table of their own, to the text store."""
        write_outcomes(outcomes, root, run, batch, layout=self.layout, distribution=self.spread)
        if reject_path is not None:
            mine = read_outcomes(outcomes.sparkSession, root, REJECT_SCHEMA, REJECT, run, batch)
            limits = {"max_records_per_file": self.layout.max_records_per_file, "max_bytes_per_file": self.layout.reject_file_bytes}
            write_reject_text(mine, reject_path, run, batch, **limits)

    def compact(self, spark: SparkSession, root: str) -> str | None:
        """Merge small files of all runs to about the layout's target size."""
        return compact(spark, root, self.layout.target_file_bytes)

    @property
    def spread(self) -> str:
        """``auto``: rows are brought together by date when dates come from the lines, and else stay where they are."""
        if self.distribution == "auto":
            return "rebalance" if self.event_date_from else "none"
        return self.distribution

    def good_table(self, spark: SparkSession, root: str) -> DataFrame:
        return read_outcomes(spark, root, self.good_schema(spark), GOOD)

    def reject_table(self, spark: SparkSession, root: str) -> DataFrame:
        return read_outcomes(spark, root, REJECT_SCHEMA, REJECT)


def run_batch(
    spark: SparkSession,
    source: str | DataFrame,
    flow: Flow,
    root: str,
    *,
    run: str | None = None,
    batch: int = 0,
    reject_path: str | None = None,
) -> dict[str, int]:
    """Parse a folder (or a DataFrame with a ``value`` column) once, store everything, return the counters.

    Without ``run`` the rows are added as a run of their own.  With it, this batch of that run is replaced as a whole.
    """
    flow.check(spark)
    lines = scan_lines(spark, source) if isinstance(source, str) else source
    observation = Observation()
    flow.store(flow.outcomes(lines, observation), root, run or f"batch-{uuid.uuid4().hex}", batch, reject_path)
    try:
        return observation.get
    except Py4JJavaError:
        # a plan that turned out to have no rows to write is replaced while it runs, and what it observed is lost
        parsed = flow.parse(lines)
        return parsed.agg(*counter_columns(F.col("status"), F.col("value"))).head().asDict()
