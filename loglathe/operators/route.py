"""Split parsed lines into good rows and rejects, and bring rejects back."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.operators.parse import BLANK, OK, parse_lines
from loglathe.plans.formats import LogFormat

# How a rejected line is labelled.
ERROR_CLASS = "PARSE_ERROR"
ERROR_MESSAGE = "Failed to parse log"

ENVELOPE_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("timestamp", "errorType", "errorMessage", "record")]
)


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("status") == OK)


def reject_rows(parsed: DataFrame) -> DataFrame:
    """Lines that failed. Blank lines are skipped: they are neither good nor rejected."""
    return parsed.where(~F.col("status").isin(OK, BLANK))


def reject_columns(line: Column, at: Column | None = None) -> dict[str, Column]:
    """Reject table cells: when (epoch milliseconds as text), class, reason, message and the line itself."""
    when = F.current_timestamp() if at is None else at
    return {
        "rejected_at": F.unix_millis(when.cast("timestamp")).cast("string"),
        "error_class": F.lit(ERROR_CLASS),
        "error_type": F.col("status"),
        "error_message": F.lit(ERROR_MESSAGE),
        "record": line,
    }


def rejects(parsed: DataFrame, col: str = "value", at: str | None = None) -> DataFrame:
    """The reject table; ``at`` names a timestamp column to use instead of the current time."""
    cells = reject_columns(F.col(col), F.col(at) if at else None)
    return reject_rows(parsed).select(*[c.alias(n) for n, c in cells.items()])


def reject_envelope(reject_table: DataFrame) -> DataFrame:
    """One JSON text per reject, with properly escaped content."""
    envelope = F.struct(
        F.col("rejected_at").alias("timestamp"),
        F.col("error_class").alias("errorType"),
        F.col("error_message").alias("errorMessage"),
        F.col("record"),
    )
    return reject_table.select(F.to_json(envelope).alias("value"))


def replay_rejects(
    envelopes: DataFrame,
    pattern: str | LogFormat,
    col: str = "value",
    *,
    custom: Mapping[str, str] | None = None,
    max_length: int | None = None,
) -> DataFrame:
    """Parse stored rejects again, by a preset name, a format, or a pattern template.

    There is no length limit unless one is given, so lines that were too long before can be brought back.
    """
    records = envelopes.select(F.from_json(F.col(col), ENVELOPE_SCHEMA).alias("e")).select(
        F.col("e.timestamp").alias("rejected_at"), F.col("e.record").alias("value")
    )
    return parse_lines(records, pattern, custom=custom, max_length=max_length)
