"""Queries: fields, table rows, masking, JSON clean-up, routing and schema inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglathe.functions.casts import int_field, string_field
from loglathe.functions.text import drop_empty_json, mask_from, mask_json_values
from loglathe.operators.infer import infer_schema
from loglathe.operators.nested import nested_columns
from loglathe.operators.parse import fields_map, flatten, keep_valid, parse_lines, parse_multi_format
from loglathe.operators.route import good_rows, reject_envelope, rejects, replay_rejects
from loglathe.operators.shape import GENERIC_COLUMNS, cast_fields, event_date, shape_rows
from loglathe.registry.core import query
from loglathe.registry.lines_sql import REGEX_SQL, lines_cte, parsed_cte
from loglathe.registry.parsing import _MIXED, JSON_GOOD, MULTI, lines
from loglathe.sources.event_lines import mixed_lines, read_events

# -- fields --------------------------------------------------------------------------------------------------------


@query(
    "field_string",
    f"WITH {parsed_cte('access')} SELECT event_id, CASE WHEN status = 'OK' THEN f.referrer ELSE '' END AS referrer,"
    " CASE WHEN status = 'OK' THEN f.bytes ELSE '' END AS \"bytes\" FROM parsed WHERE status <> 'BLANK'",
)
def _field_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(lines(spark, sf_dir, "access"), "access").where(F.col("status") != "BLANK")
    return parsed.select(
        "event_id",
        string_field(F.col("fields.referrer")).alias("referrer"),
        string_field(F.col("fields.bytes")).alias("bytes"),
    )


@query(
    "field_int",
    f"WITH {parsed_cte('access')} SELECT event_id,"
    " CASE WHEN status = 'OK' THEN coalesce(try_cast(nullif(f.bytes, '') AS INTEGER), 0) ELSE 0 END AS \"bytes\","
    " CASE WHEN status = 'OK' THEN coalesce(try_cast(f.response AS INTEGER), 0) ELSE 0 END AS response, 0 AS verb"
    " FROM parsed WHERE status <> 'BLANK'",
)
def _field_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(lines(spark, sf_dir, "access"), "access").where(F.col("status") != "BLANK")
    return parsed.select("event_id", *[int_field(F.col(f"fields.{n}")).alias(n) for n in ("bytes", "response", "verb")])


@query(
    "cast_fields",
    f"WITH {parsed_cte('access')} SELECT event_id, CAST(f.response AS INTEGER) AS response,"
    " CAST(nullif(f.bytes, '') AS BIGINT) AS \"bytes\", CAST(f.httpversion AS DOUBLE) AS httpversion,"
    " CAST(NULL AS BOOLEAN) AS ident, f.verb AS verb FROM parsed WHERE status = 'OK'",
)
def _cast_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = flatten(parse_lines(lines(spark, sf_dir, "access"), "access"), keep=["event_id"])
    types = {"response": "int", "bytes": "Long", "httpversion": "double", "ident": "boolean", "verb": "STRING"}
    return cast_fields(flat, types).select("event_id", *types)


@query(
    "shape_rows",
    f"WITH {parsed_cte('application')} SELECT event_id, f.timestamp AS \"timestamp\", f.level AS level,"
    " f.message AS message, strftime(ts, '%Y-%m-%d') AS event_date FROM parsed WHERE status = 'OK'",
)
def _shape_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(lines(spark, sf_dir), "application")
    return shape_rows(parsed, "application", keep=["event_id"], columns=GENERIC_COLUMNS, event_date_from="timestamp")


@query(
    "shape_rows_access",
    f"WITH {parsed_cte('access')} SELECT event_id, f.clientip AS clientip, CAST(f.response AS INTEGER) AS response,"
    " CAST(nullif(f.bytes, '') AS BIGINT) AS \"bytes\", coalesce(f.agent, '') AS agent, '' AS user_name,"
    " strftime(ts, '%Y-%m-%d') AS event_date FROM parsed WHERE status = 'OK'",
)
def _shape_rows_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(lines(spark, sf_dir, "access"), "access")
    return shape_rows(
        parsed,
        "access",
        keep=["event_id"],
        columns=["clientip", "response", "bytes", "agent", "user_name"],
        types={"response": "int", "bytes": "long"},
        event_date_from="timestamp",
    )


@query(
    "shape_rows_syslog",
    f"WITH {parsed_cte('syslog')} SELECT event_id, f.logsource AS logsource, f.program AS program, f.pid AS pid,"
    " f.message AS message, strftime(ts, '%Y-%m-%d') AS event_date FROM parsed WHERE status = 'OK'",
)
def _shape_rows_syslog(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(lines(spark, sf_dir, "syslog"), "syslog")
    return shape_rows(
        parsed,
        "syslog",
        keep=["event_id"],
        columns=["logsource", "program", "pid", "message"],
        event_date_from="timestamp",
        year=2024,
    )


@query(
    "shape_event_time",
    f"WITH {parsed_cte('access')} SELECT event_id, f.timestamp AS \"timestamp\","
    " strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time FROM parsed WHERE status = 'OK'",
)
def _shape_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The timestamp text and, beside it, the point in time it stands for."""
    parsed = parse_lines(lines(spark, sf_dir, "access"), "access")
    rows = shape_rows(parsed, "access", keep=["event_id"], columns=["timestamp"], event_time_from="timestamp")
    utc = F.to_utc_timestamp("event_time", F.current_timezone())
    return rows.select("event_id", "timestamp", F.date_format(utc, "yyyy-MM-dd HH:mm:ss").alias("event_time"))


_DATES = {
    "application": ("strftime(ts, '%Y-%-m-%-dT10:00:00Z')", "concat(year(ts), '-', month(ts), '-', day(ts), 'T10:00:00Z')"),
    "access": ("strftime(ts, '%-d/%b/%Y:10:00:00 +0000')", "concat(day(ts), date_format(ts, '/MMM/yyyy'), ':10:00:00 +0000')"),
    "syslog": ("strftime(ts, '%b %-d 10:00:00')", "concat(date_format(ts, 'MMM '), day(ts), ' 10:00:00')"),
    "nginx_error": ("strftime(ts, '%Y/%-m/%-d 10:00:00')", "concat(year(ts), '/', month(ts), '/', day(ts), ' 10:00:00')"),
    "custom_app": ("strftime(ts, '%Y-%-m-%-d 10:00:00,5')", "concat(year(ts), '-', month(ts), '-', day(ts), ' 10:00:00,5')"),
}


@query(
    "event_dates",
    "SELECT event_id, "
    + ", ".join(f"{text} AS {f}_text, strftime(ts, '%Y-%m-%d') AS {f}_date" for f, (text, _) in _DATES.items())
    + ", 'unknown' AS unreadable FROM events",
)
def _event_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates with one-digit days and months, as each format writes them."""
    cells = {f: F.expr(text) for f, (_, text) in _DATES.items()}
    return read_events(spark, sf_dir).select(
        "event_id",
        *[c.alias(f"{f}_text") for f, c in cells.items()],
        *[event_date(c, f, 2024).alias(f"{f}_date") for f, c in cells.items()],
        event_date(F.col("event_type"), "application").alias("unreadable"),
    )


# -- masking and JSON ----------------------------------------------------------------------------------------------


@query(
    "mask_from",
    "SELECT event_id, substring(event_type, 1, 4) || repeat('*', greatest(length(event_type) - 4, 0)) AS masked,"
    " repeat('*', length(props)) AS hidden FROM events",
)
def _mask_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_events(spark, sf_dir).select(
        "event_id", mask_from(F.col("event_type"), 4).alias("masked"), mask_from(F.col("props"), 0).alias("hidden")
    )


@query(
    "mask_pii_json",
    "WITH v AS (SELECT event_id, event_type, CAST(user_id AS VARCHAR) || 'u' || event_id AS vuid,"
    " event_type || user_id AS vp FROM events)"
    " SELECT event_id, '{\"vuid\":\"' || substring(vuid, 1, 3) || repeat('*', greatest(length(vuid) - 3, 0))"
    " || '\", \"vp_id\":\"' || substring(vp, 1, 3) || repeat('*', greatest(length(vp) - 3, 0))"
    " || '\", \"other\":\"' || event_type || '\"}' AS value FROM v",
)
def _mask_pii_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, event = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    text = F.concat(
        F.lit('{"vuid":"'), user, F.lit("u"), event, F.lit('", "vp_id":"'), F.col("event_type"), user,
        F.lit('", "other":"'), F.col("event_type"), F.lit('"}'),
    )
    return read_events(spark, sf_dir).select("event_id", mask_json_values(text).alias("value"))


@query(
    "json_drop_empty",
    "SELECT event_id, CASE WHEN event_id % 11 = 5 THEN NULL ELSE '{\"id\":' || event_id"
    " || CASE WHEN event_id % 3 = 0 THEN '' ELSE ',\"kind\":\"' || event_type || '\"' END"
    " || ',\"nested\":{\"a\":null,\"user\":' || user_id || '}}' END AS value FROM events",
)
def _json_drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    kind = F.when(n % 3 == 0, F.lit(" ")).otherwise(F.col("event_type"))
    text = F.concat(
        F.lit('{"id":'), n.cast("string"), F.lit(',"gone":null,"kind":"'), kind, F.lit('","empty":"","nested":{"a":null,"user":'),
        F.col("user_id").cast("string"), F.lit("}"), F.when(n % 11 == 5, "").otherwise("}"),
    )
    return read_events(spark, sf_dir).select("event_id", drop_empty_json(text).alias("value"))


# -- routing -------------------------------------------------------------------------------------------------------

_REJECTS = "SELECT {cells} FROM parsed WHERE status NOT IN ('OK', 'BLANK')"
_MILLIS = "CAST(epoch_us(ts) // 1000 AS VARCHAR)"


@query(
    "route_good",
    f"WITH {parsed_cte('custom_app')} SELECT event_id, f.service AS service, f.message AS message"
    " FROM parsed WHERE status = 'OK'",
)
def _route_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_lines(lines(spark, sf_dir, "custom_app"), "custom_app")
    return good_rows(parsed).select("event_id", "fields.service", "fields.message")


@query(
    "route_rejects",
    f"WITH {parsed_cte('application')} "
    + _REJECTS.format(
        cells=f"{_MILLIS} AS rejected_at, 'PARSE_ERROR' AS error_class, status AS error_type,"
        " 'Failed to parse log' AS error_message, value AS record"
    ),
)
def _route_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(parse_lines(lines(spark, sf_dir), "application"), at="ts")


@query(
    "reject_envelope",
    f"WITH {parsed_cte('access')} "
    + _REJECTS.format(
        cells=f"'{{\"timestamp\":\"' || {_MILLIS} || '\",\"errorType\":\"PARSE_ERROR\",\"errorMessage\":"
        "\"Failed to parse log\",\"record\":' || CAST(to_json(value) AS VARCHAR) || '}' AS value"
    ),
)
def _reject_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reject_envelope(rejects(parse_lines(lines(spark, sf_dir, "access"), "access"), at="ts"))


@query(
    "replay_rejects",
    f"WITH {parsed_cte('application')}, again AS (SELECT {_MILLIS} AS rejected_at,"
    " regexp_extract(value, 'malformed line ([0-9]+)', 1) AS line, value FROM parsed WHERE status NOT IN ('OK', 'BLANK'))"
    " SELECT rejected_at, CASE WHEN line <> '' OR length(value) > 10000 THEN 'OK' ELSE 'NO_MATCH' END AS status,"
    " CAST(nullif(line, '') AS BIGINT) AS line, length(value) > 10000 AS was_long FROM again",
)
def _replay_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = reject_envelope(rejects(parse_lines(lines(spark, sf_dir), "application"), at="ts"))
    again = replay_rejects(stored, "(?:malformed line %{INT:line:long}|%{EXES:tail})", custom={"EXES": "x{10000}$"})
    return again.select("rejected_at", "status", "fields.line", F.col("fields.tail").isNotNull().alias("was_long"))


# -- schema inference ----------------------------------------------------------------------------------------------


def _presence(fmt: str) -> tuple[str, str]:
    if fmt == "json":
        cells = {n: f"value->>'{n}'" for n in ("timestamp", "level", "service", "message")} | {"json_data": "value"}
        pairs = [f"SELECT '{n}' AS name, {cell} AS value FROM json_f" for n, cell in cells.items()]
        return f"json_f AS (SELECT value FROM mixed WHERE {JSON_GOOD})", " UNION ALL ".join(pairs)
    regex, names, optional = REGEX_SQL[fmt]
    listed = ", ".join(f"'{n}'" for n in names)
    parts = [
        f"SELECT '{n}' AS name, f.\"{n}\" AS value FROM {fmt}_f" + (f" WHERE f.\"{n}\" <> ''" if n in optional else "")
        for n in names
    ]
    source = (
        f"{fmt}_f AS (SELECT regexp_extract(value, '{regex}', [{listed}]) AS f FROM mixed WHERE log_type = '{fmt}'"
        f" AND NOT regexp_full_match(value, '[\\x00-\\x20]*') AND length(value) <= 10000"
        f" AND regexp_matches(value, '{regex}'))"
    )
    return source, " UNION ALL ".join(parts)


_SOURCES = ", ".join(_presence(f)[0] for f in MULTI)
_PAIRS = " UNION ALL ".join(_presence(f)[1] for f in MULTI)
_TAIL = " UNION ALL SELECT 'event_date', 'string', CAST(NULL AS BIGINT)"
_ALL_INT = "coalesce(bool_and(coalesce(CAST(try_cast(value AS INTEGER) AS VARCHAR) = value, false)), false)"


def _mixed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(parse_multi_format(mixed_lines(read_events(spark, sf_dir), list(MULTI)), MULTI))


@query(
    "infer_schema",
    f"WITH {_MIXED}, {_SOURCES}, pairs AS ({_PAIRS}) SELECT name, CASE WHEN name = 'response' THEN 'int' ELSE 'string' END"
    f" AS type, count(*) AS present FROM pairs GROUP BY name{_TAIL}",
)
def _infer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer_schema(_mixed_fields(spark, sf_dir), declared={"response": "int"})


@query(
    "infer_schema_by_value",
    f"WITH {_MIXED}, {_SOURCES}, pairs AS ({_PAIRS}) SELECT name, CASE WHEN {_ALL_INT} THEN 'int' ELSE 'string' END"
    f" AS type, count(*) AS present FROM pairs GROUP BY name{_TAIL}",
)
def _infer_schema_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infer_schema(_mixed_fields(spark, sf_dir), by_value=True)


@query(
    "infer_schema_json",
    f"WITH pairs AS (SELECT unnest(json_keys(props)) AS name, props FROM events),"
    f" kv AS (SELECT name, json_extract_string(props, '$.' || name) AS value FROM pairs)"
    f" SELECT name, CASE WHEN {_ALL_INT} THEN 'int' ELSE 'string' END AS type, count(*) AS present FROM kv"
    f" GROUP BY name{_TAIL}",
)
def _infer_schema_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = read_events(spark, sf_dir).select(F.from_json("props", "map<string,string>").alias("fields"))
    return infer_schema(props, by_value=True)


@query(
    "fields_map",
    f"WITH {parsed_cte('syslog')} SELECT event_id, CAST(4 + CAST(f.pid <> '' AS INTEGER) AS INTEGER) AS n_fields,"
    " nullif(f.pid, '') AS pid, f.logsource AS logsource FROM parsed WHERE status = 'OK'",
)
def _fields_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = fields_map(keep_valid(parse_lines(lines(spark, sf_dir, "syslog"), "syslog")))
    found = F.col("fields")
    return parsed.select(
        "event_id", F.size(found).alias("n_fields"), found["pid"].alias("pid"), found["logsource"].alias("logsource")
    )


@query(
    "json_nested",
    "SELECT event_id, strftime(ts, '%Y-%m-%d') AS at, CAST(props->>'k' AS BIGINT) AS props_k, user_id AS user_id, event_type AS user_kind,"
    " CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) ELSE 'x' END AS mixed, user_id AS list_end FROM events",
)
def _json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns from nested objects whose keys nobody declared; a key with numbers and texts stays beside them."""
    pieces = [
        '{"at":"', F.date_format("ts", "yyyy-MM-dd"), '","user":{"id":', "user_id", ',"kind":"', "event_type", '"},"list":[', "event_id", ",", "user_id",
        '],"mixed":', F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise('"x"'), ',"props":', "props", "}",
    ]
    events = read_events(spark, sf_dir)
    cells = [p if not isinstance(p, str) else F.col(p).cast("string") if p in events.columns else F.lit(p) for p in pieces]
    wide = nested_columns(events.select("event_id", F.concat(*cells).alias("value")), "value")
    return wide.select("event_id", "at", "props_k", "user_id", "user_kind", F.col("rest")["mixed"].cast("string").alias("mixed"), F.element_at("list", -1).alias("list_end"))
