"""Raw log lines rendered from the ``events`` table: one line per event, in any of the supported formats.

The rendering is a plain projection, so it scales with the table and gives the same text in every run.  A fixed part of
the lines is disturbed: 2 % blank, 5 % malformed, 0.1 % longer than the length limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loglathe.functions.text import MAX_LINE_LENGTH


EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table; its schema is known, so no file is opened to find it."""
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


_LEVEL = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' ELSE 'INFO' END"
_ISO = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")"
_APPLICATION = f"concat_ws(' ', {_ISO}, {_LEVEL}, event_type, 'by user', string(user_id), props)"
_ACCESS = (
    "concat('10.0.', user_id % 256, '.1 - - [', date_format(ts, 'dd/MMM/yyyy:HH:mm:ss'), ' +0000] \"GET /', event_type,"
    " '/', event_id, ' HTTP/1.1\" ', if(event_type = 'error', '500', '200'), ' ',"
    " if(event_id % 10 = 0, '-', string(user_id * 7)), if(event_id % 2 = 0, ' \"-\" \"agent/1.0\"', ''))"
)

# format -> the line of an event, as a SQL expression
LINES: dict[str, str] = {
    "application": _APPLICATION,
    "loglevel": _APPLICATION,
    "access": _ACCESS,
    "access_combined": _ACCESS,
    "syslog": (
        "concat(date_format(ts, 'MMM dd HH:mm:ss'), ' host', user_id % 5, ' app',"
        " if(event_id % 3 = 0, '', concat('[', event_id, ']')), ': ', event_type, ' ', props)"
    ),
    "nginx_error": (
        "concat(date_format(ts, 'yyyy/MM/dd HH:mm:ss'), ' [', CASE event_type WHEN 'error' THEN 'error'"
        " WHEN 'purchase' THEN 'warn' ELSE 'info' END, '] ', event_id, '#0: *1 ', event_type)"
    ),
    "custom_app": (
        f"concat('[', date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS'), '] [', {_LEVEL}, '] [', event_type,"
        " 'Service] user ', user_id)"
    ),
    "json": (
        f"concat('{{\"timestamp\":\"', {_ISO}, '\",\"level\":\"', {_LEVEL}, '\",\"service\":\"', event_type,"
        " '\",\"message\":\"user ', user_id, '\"}')"
    ),
}


def _disturbed(fmt: str) -> str:
    if fmt not in LINES:
        raise ValueError(f"No rendering for format: {fmt}")
    return (
        "CASE WHEN event_id % 50 = 3 THEN '   ' WHEN event_id % 20 = 7 THEN concat('malformed line ', event_id)"
        f" ELSE concat({LINES[fmt]}, if(event_id % 1000 = 11, repeat('x', {MAX_LINE_LENGTH}), '')) END"
    )


def event_lines(events: DataFrame, fmt: str = "application") -> DataFrame:
    """``event_id, ts, event_type, user_id, value``, where ``value`` is the log line of the event."""
    return events.selectExpr("event_id", "ts", "event_type", "user_id", f"{_disturbed(fmt)} AS value")


def mixed_lines(events: DataFrame, formats: list[str]) -> DataFrame:
    """``event_id, ts, log_type, value``: each event as a line of one of ``formats``, in turn by event id."""
    turn = f"event_id % {len(formats)}"
    kinds = " ".join(f"WHEN {i} THEN '{fmt}'" for i, fmt in enumerate(formats))
    values = " ".join(f"WHEN {i} THEN {_disturbed(fmt)}" for i, fmt in enumerate(formats))
    return events.selectExpr("event_id", "ts", f"CASE {turn} {kinds} END AS log_type", f"CASE {turn} {values} END AS value")
