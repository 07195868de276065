"""Queries: parse quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglathe.operators.anchored import error_counts_anchored, error_sample_anchored
from loglathe.operators.parse import BLANK, OK, parse_lines
from loglathe.operators.quality import (
    error_counts,
    error_sample,
    health_status,
    parse_counters,
    pattern_quarantine,
    records_per_second,
    success_rates,
)
from loglathe.registry.core import query
from loglathe.registry.lines_sql import parsed_cte
from loglathe.registry.parsing import lines
from loglathe.session import scratch_dir
from loglathe.sources.event_lines import read_events

NOW = "2024-01-31 00:02:00"
_COUNTS = (
    "count(*) AS received, count(*) FILTER (status = 'BLANK') AS blank, count(*) FILTER (status = 'OK') AS parsed_success,"
    " count(*) FILTER (status NOT IN ('OK', 'BLANK')) AS parsed_failed"
)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Application lines by level: received, blank, parsed, failed and bytes."""
    parsed = parse_lines(lines(spark, sf_dir), "application")
    return parse_counters(parsed, [F.col("fields.level").alias("level")], "value")


query(
    "parse_counters",
    f"WITH {parsed_cte('application')} SELECT CASE WHEN status = 'OK' THEN f.level END AS level, {_COUNTS},"
    " CAST(sum(strlen(value)) AS BIGINT) AS bytes FROM parsed GROUP BY 1",
)(flagship)


@query(
    "success_rate",
    f"WITH {parsed_cte('access')}, c AS (SELECT event_type, {_COUNTS} FROM parsed GROUP BY event_type)"
    " SELECT *, coalesce(100.0::DOUBLE * parsed_success / nullif(parsed_success + parsed_failed, 0), 100.0::DOUBLE)"
    " AS success_rate FROM c",
)
def _success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return success_rates(parse_lines(lines(spark, sf_dir, "access"), "access"), ["event_type"])


def _health_sql(source: str, by: str, ok: str, error: str) -> str:
    """Totals and the last record, found by ranking each group's records."""
    return (
        f"{source} r AS (SELECT {by} AS source, ts, event_id, {ok} AS ok, {error} AS error FROM rows_in),"
        " ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts DESC, event_id DESC) AS rn FROM r),"
        " t AS (SELECT source, count(*) FILTER (ok) AS processed, count(*) FILTER (NOT ok) AS failed,"
        " coalesce(max(ts) FILTER (ok), min(ts)) AS since, bool_or(rn = 1 AND ok) AS last_ok,"
        " max(CASE WHEN rn = 1 AND NOT ok THEN error END) AS last_error FROM ranked GROUP BY source),"
        f" i AS (SELECT *, epoch_us(TIMESTAMP '{NOW}') // 1000 - epoch_us(since) // 1000 AS idle_ms FROM t)"
        " SELECT source, CASE WHEN (NOT last_ok AND processed + failed > 100 AND failed > (processed + failed) // 2)"
        " OR idle_ms > 300000 THEN 'DOWN' ELSE 'UP' END AS status, processed, failed,"
        " coalesce(100.0::DOUBLE * processed / nullif(processed + failed, 0), 100.0::DOUBLE) AS success_rate, idle_ms,"
        " last_error FROM i"
    )


@query(
    "health_status",
    _health_sql(
        f"WITH {parsed_cte('application')}, rows_in AS (SELECT * FROM parsed WHERE status <> 'BLANK'),",
        "user_id % 10",
        "status = 'OK'",
        "status",
    ),
)
def _health_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health of ten sources by the outcome of parsing their lines."""
    parsed = parse_lines(lines(spark, sf_dir), "application").where(F.col("status") != BLANK)
    rows = parsed.withColumn("source", F.col("user_id") % 10)
    now = F.lit(NOW).cast("timestamp")
    return health_status(rows, ["source"], F.col("status") == OK, F.col("status"), "ts", "event_id", now)


@query(
    "health_by_event_type",
    _health_sql("WITH rows_in AS (SELECT * FROM events),", "event_type", "event_type <> 'error'", "event_type || ' ' || user_id"),
)
def _health_by_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source fails throughout, so it is down; its last error text is one of many."""
    rows = read_events(spark, sf_dir).withColumn("source", F.col("event_type"))
    error = F.concat_ws(" ", "event_type", F.col("user_id").cast("string"))
    now = F.lit(NOW).cast("timestamp")
    return health_status(rows, ["source"], F.col("event_type") != "error", error, "ts", "event_id", now)


@query(
    "records_per_second",
    "WITH w AS (SELECT time_bucket(INTERVAL 10 SECONDS, ts) - to_seconds(10 * CAST(s AS INTEGER)) AS window_start"
    " FROM events, range(6) t(s))"
    " SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS records,"
    " count(*) / 60.0::DOUBLE AS records_per_second FROM w GROUP BY 1",
)
def _records_per_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = records_per_second(read_events(spark, sf_dir))
    return rates.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_events(spark, sf_dir).where(F.col("event_type") == "error")
    return rows.select((F.col("user_id") % 10).alias("operation"), "ts", "event_id")


def _sample_sql(unit: str) -> str:
    return (
        f"WITH e AS (SELECT user_id % 10 AS operation, date_trunc('{unit}', ts) AS t, ts, event_id FROM events"
        " WHERE event_type = 'error'), r AS (SELECT *, row_number() OVER (PARTITION BY operation, t ORDER BY ts, event_id)"
        f" AS n FROM e) SELECT operation, strftime(t, '%Y-%m-%d %H:%M') AS {unit}, event_id, CAST(n AS INTEGER) AS rank"
        " FROM r WHERE n <= 10"
    )


def _counts_sql(unit: str) -> str:
    return (
        f"WITH e AS (SELECT user_id % 10 AS operation, date_trunc('{unit}', ts) AS t, count(*) AS errors FROM events"
        " WHERE event_type = 'error' GROUP BY 1, 2)"
        f" SELECT operation, strftime(t, '%Y-%m-%d %H:%M') AS {unit}, errors, least(errors, 10) AS kept,"
        " greatest(errors - 10, 0) AS suppressed, errors > 10 AS limit_reached FROM e"
    )


def _stamp(df: DataFrame, unit: str) -> DataFrame:
    return df.withColumn(unit, F.date_format(unit, "yyyy-MM-dd HH:mm"))


@query("error_sample", _sample_sql("minute"))
def _error_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = error_sample(_errors(spark, sf_dir), "operation", "ts", "event_id")
    return _stamp(sample, "minute").select("operation", "minute", "event_id", "rank")


@query("error_sample_daily", _sample_sql("day"))
def _error_sample_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = error_sample(_errors(spark, sf_dir), "operation", "ts", "event_id", unit="day")
    return _stamp(sample, "day").select("operation", "day", "event_id", "rank")


@query("error_counts", _counts_sql("minute"))
def _error_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(error_counts(_errors(spark, sf_dir), "operation", "ts"), "minute")


@query("error_counts_daily", _counts_sql("day"))
def _error_counts_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamp(error_counts(_errors(spark, sf_dir), "operation", "ts", unit="day"), "day")


def _anchored_sql(select: str) -> str:
    """Windows of each operation one after the other, each from the first error over a minute after the last one's start."""
    return (
        "WITH RECURSIVE e AS (SELECT user_id % 10 AS operation, epoch_us(ts) // 1000 AS ms, ts, event_id FROM events WHERE event_type = 'error'),"
        " a AS (SELECT operation, min(ms) AS s FROM e GROUP BY 1 UNION ALL SELECT operation, s FROM (SELECT a.operation, (SELECT min(ms) FROM e"
        " WHERE e.operation = a.operation AND e.ms > a.s + 60000) AS s FROM a) WHERE s IS NOT NULL),"
        " r AS (SELECT e.operation, s, event_id, row_number() OVER (PARTITION BY e.operation, s ORDER BY ts, event_id) AS n FROM e JOIN a"
        f" ON e.operation = a.operation AND ms BETWEEN s AND s + 60000), w AS (SELECT *, strftime(make_timestamp(s * 1000), '%Y-%m-%d %H:%M:%S.%g') AS window_start FROM r) {select}"
    )


def _start(df: DataFrame) -> DataFrame:
    return df.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss.SSS"))


@query("error_sample_anchored", _anchored_sql("SELECT operation, window_start, event_id, CAST(n AS INTEGER) AS rank FROM w WHERE n <= 10"))
def _error_sample_anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = error_sample_anchored(_errors(spark, sf_dir), "operation", "ts", "event_id")
    return _start(sample).select("operation", "window_start", "event_id", "rank")


@query(
    "error_counts_anchored",
    _anchored_sql(
        "SELECT operation, window_start, count(*) AS errors, least(count(*), 10) AS kept, greatest(count(*) - 10, 0) AS suppressed,"
        " count(*) > 10 AS limit_reached FROM w GROUP BY 1, 2"
    ),
)
def _error_counts_anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _start(error_counts_anchored(_errors(spark, sf_dir), "operation", "ts"))


def _streak_sql(source: str, by: str, threshold: int) -> str:
    return (
        f"{source} s AS (SELECT {by} AS source, ts, event_id, ok,"
        f" sum(CAST(ok AS INTEGER)) OVER (PARTITION BY {by} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island"
        " FROM rows_in), g AS (SELECT source, island, count(*) FILTER (NOT ok) AS run FROM s GROUP BY 1, 2)"
        f" SELECT source, max(run) AS max_streak, max_by(run, island) AS current_streak, max(run) > {threshold}"
        " AS quarantined FROM g GROUP BY source"
    )


@query(
    "pattern_quarantine",
    _streak_sql(
        f"WITH {parsed_cte('loglevel')}, rows_in AS (SELECT *, status = 'OK' AS ok FROM parsed WHERE status <> 'BLANK'),",
        "event_type",
        10,
    ),
)
def _pattern_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(lines(spark, sf_dir, "loglevel"), "loglevel").where(F.col("status") != BLANK)
    rows = parsed.select(F.col("event_type").alias("source"), "ts", "event_id", "status")
    stage = scratch_dir(spark, "outcome-order")
    return pattern_quarantine(rows, ["source"], ["ts", "event_id"], F.col("status") == OK, stage=stage)


@query(
    "pattern_quarantine_errors",
    _streak_sql("WITH rows_in AS (SELECT *, event_type <> 'error' AS ok FROM events),", "user_id % 3", 3),
)
def _pattern_quarantine_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_events(spark, sf_dir).withColumn("source", F.col("user_id") % 3)
    return pattern_quarantine(rows, ["source"], ["ts", "event_id"], F.col("event_type") != "error", threshold=3)
