"""Queries: what was written reads back the same, in batch and as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglathe.operators.infer import infer_schema, inferred_struct
from loglathe.operators.parse import BLANK, OK, fields_map, keep_valid, parse_lines
from loglathe.operators.quality import parse_counters
from loglathe.operators.route import rejects, replay_rejects
from loglathe.operators.shape import GENERIC_COLUMNS, generic_schema, shape_rows
from loglathe.plans.flow import Flow, run_batch
from loglathe.registry.core import SQL, query
from loglathe.registry.lines_sql import lines_cte, parsed_cte
from loglathe.registry.parsing import MULTI, lines
from loglathe.registry.quality import NOW
from loglathe.session import scratch_dir
from loglathe.sinks.evolving import append_evolving, read_evolving
from loglathe.sinks.merge import remove_replaced
from loglathe.sinks.rejects import read_reject_text, write_reject_text
from loglathe.sinks.tables import append_table, ensure_table
from loglathe.sources.event_lines import mixed_lines, read_events
from loglathe.sources.files import scan_lines, stream_lines
from loglathe.streaming.ledger import (
    STREAM,
    file_ledger,
    health_ledger,
    rate_ledger,
    read_health,
    read_quarantine,
    read_rates,
    run_ledger,
    streak_ledger,
)
from loglathe.streaming.runner import open_rates, run_stream, stream_rates

_GENERIC_ROWS = (
    f"WITH {parsed_cte('application')} SELECT f.timestamp AS \"timestamp\", f.level AS level, f.message AS message,"
    " strftime(ts, '%Y-%m-%d') AS event_date FROM parsed WHERE status = 'OK'"
)
_REJECT_LINES = (
    f"WITH {parsed_cte('application')} SELECT 'PARSE_ERROR' AS error_class, status AS error_type,"
    " 'Failed to parse log' AS error_message, value AS record FROM parsed WHERE status NOT IN ('OK', 'BLANK')"
)
_FLOW = Flow("application", "application", columns=GENERIC_COLUMNS, event_date_from="timestamp")


def _written_lines(spark: SparkSession, sf_dir: str, fmt: str = "application") -> str:
    folder = scratch_dir(spark, f"{fmt}-lines")
    lines(spark, sf_dir, fmt).select("value").write.text(folder)
    return folder


@query("append_table", _GENERIC_ROWS)
def _append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a partitioned table, append to it by column name, read it back."""
    folder = scratch_dir(spark, "table")
    name = "logs_" + folder.rsplit("-", 1)[1]
    ensure_table(spark, name, generic_schema(), location=folder)
    parsed = parse_lines(lines(spark, sf_dir), "application")
    append_table(shape_rows(parsed, "application", columns=GENERIC_COLUMNS, event_date_from="timestamp"), name)
    return spark.table(name)


@query("store_good", _GENERIC_ROWS)
def _store_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "outcomes")
    run_batch(spark, _written_lines(spark, sf_dir), _FLOW, root)
    return _FLOW.good_table(spark, root)


@query("store_rejects", _REJECT_LINES)
def _store_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "outcomes")
    run_batch(spark, _written_lines(spark, sf_dir), _FLOW, root)
    return _FLOW.reject_table(spark, root).drop("rejected_at")


_MIXED_ROWS = {
    "application": ("f.message", "f.level", "strftime(ts, '%Y-%m-%d')"),
    "access": ("''", "''", "strftime(ts, '%Y-%m-%d')"),
    "syslog": ("f.message", "''", "strftime(ts, '%Y-%m-%d')"),
    "nginx_error": ("f.message", "f.level", "strftime(ts, '%Y-%m-%d')"),
    "custom_app": ("f.message", "f.level", "strftime(ts, '%Y-%m-%d')"),
    "json": ("value->>'message'", "value->>'level'", "strftime(ts, '%Y-%m-%d')"),
}


def _mixed_sql() -> str:
    parts = []
    for i, (fmt, (message, level, day)) in enumerate(_MIXED_ROWS.items()):
        if fmt == "json":
            parts.append(
                f"SELECT 'json' AS log_type, value->>'timestamp' AS \"timestamp\", {message} AS message, {level} AS level, {day}"
                f" AS event_date FROM (WITH {lines_cte('json')} SELECT * FROM lines) WHERE length(value) <= 10000"
                f" AND json_valid(value) AND event_id % {len(_MIXED_ROWS)} = {i}"
            )
            continue
        parts.append(
            f"SELECT '{fmt}' AS log_type, f.timestamp AS \"timestamp\", {message} AS message, {level} AS level,"
            f" {day} AS event_date FROM (WITH {parsed_cte(fmt)} SELECT * FROM parsed) WHERE status = 'OK'"
            f" AND event_id % {len(_MIXED_ROWS)} = {i}"
        )
    return " UNION ALL ".join(parts)


@query("store_mixed", _mixed_sql())
def _store_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of five formats through one flow into one table."""
    flow = Flow(
        {name: name for name in MULTI}, columns=("timestamp", "message", "level"), event_date_from="timestamp", year=2024
    )
    root = scratch_dir(spark, "outcomes")
    run_batch(spark, mixed_lines(read_events(spark, sf_dir), list(MULTI)), flow, root)
    return flow.good_table(spark, root)


def _typed_sql() -> str:
    return (
        f"SELECT log_type, \"timestamp\", substring(message, 1, 2) || repeat('*', greatest(length(message) - 2, 0)) AS message,"
        f" CAST(NULL AS INTEGER) AS level, event_date FROM ({_mixed_sql()})"
    )


@query("store_mixed_typed", _typed_sql())
def _store_mixed_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a type and a mask; levels are no numbers."""
    flow = Flow(
        {name: name for name in MULTI}, columns=("timestamp", "message", "level"), types={"level": "int"}, mask={"message": 2},
        event_date_from="timestamp", year=2024,
    )
    root = scratch_dir(spark, "outcomes")
    run_batch(spark, mixed_lines(read_events(spark, sf_dir), list(MULTI)), flow, root)
    return flow.good_table(spark, root)


@query("store_appended", f"{_GENERIC_ROWS} UNION ALL SELECT * FROM ({_GENERIC_ROWS})")
def _store_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch run and a stream into one table: both stay."""
    root, folder = scratch_dir(spark, "outcomes"), _written_lines(spark, sf_dir)
    run_batch(spark, folder, _FLOW, root)
    run_stream(spark, folder, _FLOW, root, scratch_dir(spark, "offsets"), every_minutes=None).awaitTermination()
    return _FLOW.good_table(spark, root)


@query("store_replaced", _GENERIC_ROWS)
def _store_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch written with a pattern that fits too much, and then again with the right one."""
    root, folder = scratch_dir(spark, "outcomes"), _written_lines(spark, sf_dir)
    loose = Flow("%{GREEDYDATA:message}", "application", columns=GENERIC_COLUMNS)
    run_batch(spark, folder, loose, root, run="nightly")
    run_batch(spark, folder, _FLOW, root, run="nightly")
    return _FLOW.good_table(spark, root)


@query(
    "table_from_inferred",
    f"WITH {parsed_cte('access')} SELECT DISTINCT f.verb AS verb, CAST(f.response AS INTEGER) AS response,"
    " strftime(ts, '%Y-%m-%d') AS event_date FROM parsed WHERE status = 'OK'",
)
def _table_from_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made from what the lines hold, then filled."""
    parsed = parse_lines(lines(spark, sf_dir, "access"), "access")
    some = fields_map(keep_valid(parsed)).select(F.map_filter("fields", lambda k, _: k.isin("verb", "response")).alias("fields"))
    schema = inferred_struct(infer_schema(some, by_value=True))
    folder = scratch_dir(spark, "table")
    name = ensure_table(spark, f"inferred_{uuid.uuid4().hex}", schema, location=folder)
    rows = shape_rows(parsed, "access", columns=["verb", "response"], types={"response": "int"}, event_date_from="timestamp")
    append_table(rows.distinct(), name)
    out = spark.read.schema(spark.table(name).schema).parquet(folder)
    spark.sql(f"DROP TABLE {name}")
    return out


@query(
    "reject_text",
    f"WITH {parsed_cte('syslog')} SELECT CAST(epoch_us(ts) // 1000 AS VARCHAR) AS rejected_at, value,"
    " CASE WHEN regexp_matches(value, 'malformed line [0-9]+') THEN 'OK' ELSE 'NO_MATCH' END AS status,"
    " nullif(regexp_extract(value, 'malformed line ([0-9]+)', 1), '') AS line FROM parsed WHERE status NOT IN ('OK', 'BLANK')",
)
def _reject_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects written as text, read again and parsed by a pattern that fits most of them."""
    folder = scratch_dir(spark, "rejects")
    write_reject_text(rejects(parse_lines(lines(spark, sf_dir, "syslog"), "syslog"), at="ts"), folder)
    again = replay_rejects(read_reject_text(spark, folder), "malformed line %{INT:line}")
    return again.select("rejected_at", "value", "status", "fields.line")


@query(
    "counters_by_file",
    f"WITH {parsed_cte('nginx_error')} SELECT event_type AS kind, count(*) AS received, count(*) FILTER (status = 'BLANK') AS blank,"
    " count(*) FILTER (status = 'OK') AS parsed_success, count(*) FILTER (status NOT IN ('OK', 'BLANK')) AS parsed_failed,"
    " CAST(sum(strlen(value)) AS BIGINT) AS bytes FROM parsed GROUP BY 1",
)
def _counters_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress per folder of files, one for each type of event."""
    folder = scratch_dir(spark, "kinds")
    lines(spark, sf_dir, "nginx_error").select("value", "event_type").write.partitionBy("event_type").text(folder)
    parsed = parse_lines(scan_lines(spark, folder), "nginx_error")
    kind = F.regexp_extract("file_path", "event_type=([^/]+)/", 1).alias("kind")
    return parse_counters(parsed, [kind], "value")


@query("stream_good", _GENERIC_ROWS)
def _stream_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "stream")
    run_stream(
        spark, _written_lines(spark, sf_dir), _FLOW, root, scratch_dir(spark, "offsets"), every_minutes=None
    ).awaitTermination()
    return _FLOW.good_table(spark, root)


@query("stream_rejects", f"SELECT record FROM ({_REJECT_LINES})")
def _stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, texts = scratch_dir(spark, "stream"), scratch_dir(spark, "rejects")
    run_stream(
        spark, _written_lines(spark, sf_dir), _FLOW, root, scratch_dir(spark, "offsets"), reject_path=texts,
        every_minutes=None,
    ).awaitTermination()
    return replay_rejects(read_reject_text(spark, texts), "application").select(F.col("value").alias("record"))


_RATES = (
    "WITH w AS (SELECT time_bucket(INTERVAL 10 SECONDS, ts) - to_seconds(10 * CAST(s AS INTEGER)) AS window_start"
    " FROM events, range(6) t(s)) SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS records,"
    " count(*) / 60.0::DOUBLE AS records_per_second{} FROM w GROUP BY 1"
)


def _stamped(rates: DataFrame) -> DataFrame:
    return rates.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_events(spark, sf_dir)
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("stream_records_per_second", _RATES.format(""))
def _stream_records_per_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All windows of a stream: those that the watermark has closed, and those that are open when it stops."""
    folder, state = scratch_dir(spark, "rates"), scratch_dir(spark, "offsets")
    writer = stream_rates(_event_stream(spark, sf_dir)).writeStream.format("parquet").option("path", folder)
    writer.option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return _stamped(spark.read.parquet(folder).unionByName(open_rates(spark, state)))


@query("stream_rates_ledger", _RATES.format(", CAST(0 AS BIGINT) AS late"))
def _stream_rates_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a ledger; the table comes in one batch, so nothing is late."""
    ledger = rate_ledger(scratch_dir(spark, "ledger"))
    run_ledger(_event_stream(spark, sf_dir), [ledger], scratch_dir(spark, "offsets"), every_minutes=None).awaitTermination()
    return _stamped(read_rates(spark, ledger))


def _line_stream(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """Lines of ``fmt`` as a stream of four batches, one after the other in time, parsed; blank lines are left out."""
    folder = scratch_dir(spark, f"{fmt}-weeks")
    rows = lines(spark, sf_dir, fmt)
    for week in range(4):
        # files are taken in the order in which they were written
        rows.where(F.least((F.dayofmonth("ts") - 1) / 8, F.lit(3)).cast("int") == week).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return parse_lines(stream, fmt).where(F.col("status") != BLANK)


@query("stream_health", SQL["health_status"])
def _stream_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health of ten sources over the batches of a stream, those before the last joined to one."""
    parsed = _line_stream(spark, sf_dir, "application").withColumn("source", F.col("user_id") % 10)
    ledger = health_ledger(scratch_dir(spark, "ledger"), ["source"], F.col("status") == OK, F.col("status"), "ts", "event_id")
    run_ledger(parsed, [ledger], scratch_dir(spark, "offsets"), every_minutes=None).awaitTermination()
    ledger.fold(spark)
    return read_health(spark, ledger, F.lit(NOW).cast("timestamp"))


@query("stream_quarantine", SQL["pattern_quarantine"])
def _stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of failures that go on from batch to batch of a stream."""
    parsed = _line_stream(spark, sf_dir, "loglevel").withColumn("source", F.col("event_type"))
    ledger = streak_ledger(scratch_dir(spark, "ledger"), ["source"], ["ts", "event_id"], F.col("status") == OK)
    run_ledger(parsed, [ledger], scratch_dir(spark, "offsets"), every_minutes=None).awaitTermination()
    ledger.fold(spark)
    return read_quarantine(spark, ledger).drop(STREAM)


@query("stream_counters_by_file", SQL["counters_by_file"])
def _stream_counters_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Progress per folder of files, whose files come in several batches."""
    folder = scratch_dir(spark, "kinds")
    rows = lines(spark, sf_dir, "nginx_error").select("value", "event_type").repartition(3)
    rows.write.partitionBy("event_type").text(folder)
    parsed = parse_lines(stream_lines(spark, folder, max_files_per_batch=4), "nginx_error")
    ledger = file_ledger(scratch_dir(spark, "ledger"), ["kind"])
    kinds = parsed.withColumn("kind", F.regexp_extract("file_path", "event_type=([^/]+)/", 1))
    run_ledger(kinds, [ledger], scratch_dir(spark, "offsets"), every_minutes=None).awaitTermination()
    return ledger.read(spark)


@query("store_compacted", f"{_GENERIC_ROWS} UNION ALL SELECT * FROM ({_GENERIC_ROWS})")
def _store_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small files of a stream and of two runs, merged to a size, whatever run they are of, and again after more have come."""
    root, folder, half = scratch_dir(spark, "outcomes"), _written_lines(spark, sf_dir), F.crc32(F.col("value").cast("binary")) % 2
    text = scan_lines(spark, folder)
    run_batch(spark, text.where(half == 0), _FLOW, root)
    run_batch(spark, text.where(half == 1), _FLOW, root)
    _FLOW.compact(spark, root)
    run_stream(spark, folder, _FLOW, root, scratch_dir(spark, "offsets"), every_minutes=None).awaitTermination()
    _FLOW.compact(spark, root)
    remove_replaced(spark, root)
    return _FLOW.good_table(spark, root)


@query(
    "table_evolved",
    "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE 'u' || user_id END AS code,"
    " strftime(ts, '%Y-%m-%d') AS event_date, CASE WHEN event_id % 2 = 1 THEN event_type END AS kind FROM events",
)
def _table_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a number, then rows with a wider id, a text in its place and a new column."""
    root, events = scratch_dir(spark, "evolving"), read_events(spark, sf_dir)
    even, day = F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd").alias("event_date")
    append_evolving(events.where(even).select(F.col("event_id").cast("int").alias("event_id"), F.col("user_id").cast("int").alias("code"), day), root)
    code = F.concat(F.lit("u"), F.col("user_id")).alias("code")
    append_evolving(events.where(~even).select("event_id", code, day, F.col("event_type").alias("kind")), root)
    return read_evolving(spark, root)


@query(
    "reject_text_rolled",
    f"WITH r AS ({_REJECT_LINES}) SELECT record FROM r",
)
def _reject_text_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects dealt to files of a size, read again."""
    folder = scratch_dir(spark, "rejects")
    write_reject_text(rejects(parse_lines(lines(spark, sf_dir), "application"), at="ts"), folder, max_bytes_per_file=16 * 1024)
    return replay_rejects(read_reject_text(spark, folder), "application").select(F.col("value").alias("record"))
