"""Queries: reading, filtering and parsing lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglathe.functions.text import MAX_LINE_LENGTH
from loglathe.operators.parse import (
    drop_blank,
    drop_oversize,
    flatten,
    grok,
    keep_valid,
    parse_lines,
    parse_multi_format,
)
from loglathe.operators.quality import parse_counters
from loglathe.plans.formats import FORMATS
from loglathe.registry.core import query
from loglathe.registry.lines_sql import (
    BLANK_SQL,
    LINE_SQL,
    REGEX_SQL,
    disturbed,
    field_sql,
    lines_cte,
    parsed_cte,
    status_sql,
)
from loglathe.session import scratch_dir
from loglathe.sources.event_lines import event_lines, mixed_lines, read_events
from loglathe.sources.files import scan_lines

MULTI = {f: f for f in ("application", "access", "syslog", "nginx_error", "custom_app", "json")}


def lines(spark: SparkSession, sf_dir: str, fmt: str = "application") -> DataFrame:
    return event_lines(read_events(spark, sf_dir), fmt)


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "value"))


# -- sources and filters -------------------------------------------------------------------------------------------


@query("scan_lines", f"WITH {lines_cte('application')} SELECT value FROM lines")
def _scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "lines")
    lines(spark, sf_dir).select("value").write.text(folder)
    return scan_lines(spark, folder).select("value")


_DOCUMENT_LINES = (
    "document_lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS value,"
    " CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no FROM documents)"
)


@query("filter_blank", f"WITH {_DOCUMENT_LINES} SELECT doc_id, line_no, value FROM document_lines WHERE NOT {BLANK_SQL}")
def _filter_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_blank(document_lines(spark, sf_dir)).select("doc_id", "line_no", "value")


@query(
    "filter_oversize",
    "SELECT doc_id, text FROM documents"
    r" WHERE length(regexp_replace(text, '[\x{10000}-\x{10FFFF}]', 'xx', 'g')) <= 10000",
)
def _filter_oversize(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return drop_oversize(docs, "text").select("doc_id", "text")


@query(
    "filter_valid",
    f"WITH {parsed_cte('application')} SELECT event_id, value FROM parsed WHERE status = 'OK'",
)
def _filter_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keep_valid(parse_lines(lines(spark, sf_dir), "application")).select("event_id", "value")


_OCTET = "(?:25[0-5]|2[0-4][0-9]|[0-1]?[0-9][0-9]?)"
_ADDRESS = rf"(?:^|[^0-9])({_OCTET}[.]{_OCTET}[.]{_OCTET}[.]{_OCTET})(?:[^0-9]|$)"


@query(
    "grok_search",
    f"WITH {_DOCUMENT_LINES} SELECT doc_id, line_no, regexp_extract(value, '{_ADDRESS}', 1) AS ip FROM document_lines"
    f" WHERE regexp_matches(value, '{_ADDRESS}')",
)
def _grok_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pattern that may sit anywhere in a line, over all lines of all documents."""
    return flatten(grok(document_lines(spark, sf_dir), "%{IPV4:ip}"), keep=["doc_id", "line_no"])


@query(
    "document_counters",
    f"WITH {_DOCUMENT_LINES}, s AS (SELECT lang, CASE WHEN {BLANK_SQL} THEN 'BLANK'"
    r" WHEN length(regexp_replace(value, '[\x{10000}-\x{10FFFF}]', 'xx', 'g')) > 10000 THEN 'TOO_LONG'"
    r" WHEN regexp_matches(value, '(?:^|[^\p{L}\p{N}_])[0-9A-Za-z_]+ [+-]?[0-9]+') THEN 'OK'"
    " ELSE 'NO_MATCH' END AS status FROM document_lines JOIN documents USING (doc_id))"
    " SELECT lang, count(*) AS received, count(*) FILTER (status = 'BLANK') AS blank,"
    " count(*) FILTER (status = 'OK') AS parsed_success,"
    " count(*) FILTER (status NOT IN ('OK', 'BLANK')) AS parsed_failed FROM s GROUP BY lang",
)
def _document_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters over real prose, most of which is no log line."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines_of = docs.select("lang", F.explode(F.split("text", "\n", -1)).alias("value"))
    return parse_counters(grok(lines_of, "%{WORD:key} %{INT:n:long}", max_length=MAX_LINE_LENGTH), ["lang"])


# -- one query per format ------------------------------------------------------------------------------------------


def _register_format(name: str, fmt: str) -> None:
    sql = f"WITH {parsed_cte(fmt)} SELECT event_id, {field_sql(fmt)} FROM parsed WHERE status = 'OK'"

    @query(name, sql)
    def _run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flatten(parse_lines(lines(spark, sf_dir, fmt), fmt), keep=["event_id"])


for _name, _fmt in {
    "grok_application": "application",
    "grok_loglevel": "loglevel",
    "grok_access": "access",
    "grok_access_combined": "access_combined",
    "grok_syslog": "syslog",
    "grok_nginx_error": "nginx_error",
    "grok_custom_app": "custom_app",
}.items():
    _register_format(_name, _fmt)


@query(
    "grok_json_capture",
    f"WITH {lines_cte('json')} SELECT event_id, value AS json_data FROM lines WHERE {status_sql('.*', limited=False)} = 'OK'",
)
def _grok_json_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(grok(lines(spark, sf_dir, "json"), FORMATS["json"].pattern), keep=["event_id"])


@query(
    "parse_json_lines",
    f"WITH {lines_cte('json')}, j AS (SELECT event_id, CASE WHEN length(value) <= 10000 AND json_valid(value)"
    " THEN CAST(value AS JSON) END AS v FROM lines)"
    " SELECT event_id, v->>'timestamp' AS \"timestamp\", v->>'level' AS level, v->>'service' AS service,"
    " v->>'message' AS message, CAST(v AS VARCHAR) AS json_data FROM j WHERE v IS NOT NULL",
)
def _parse_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(parse_lines(lines(spark, sf_dir, "json"), "json"), keep=["event_id"])


# -- several formats, optional parts -------------------------------------------------------------------------------

_MIXED = (
    f"mixed AS (SELECT event_id, CASE event_id % {len(MULTI)} "
    + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(MULTI))
    + f" END AS log_type, CASE event_id % {len(MULTI)} "
    + " ".join(f"WHEN {i} THEN {disturbed(LINE_SQL[f])}" for i, f in enumerate(MULTI))
    + " END AS value FROM events)"
)


#: lines of JSON that are good, of ``mixed``
JSON_GOOD = "log_type = 'json' AND length(value) <= 10000 AND json_valid(value)"


def _common(fmt: str) -> str:
    if fmt == "json":
        cells = [f"value->>'{c}' AS \"{c}\"" for c in ("timestamp", "level", "message")]
        none = [f'CAST(NULL AS VARCHAR) AS "{c}"' for c in ("pid", "bytes")]
        return f"SELECT event_id, log_type, {', '.join(cells + none)}, CAST(5 AS INTEGER) AS n_fields FROM mixed WHERE {JSON_GOOD}"
    regex, names, optional = REGEX_SQL[fmt]
    listed = ", ".join(f"'{n}'" for n in names)
    found = f"regexp_extract(value, '{regex}', [{listed}])"
    cells = [
        f"nullif({found}.\"{c}\", '') AS \"{c}\"" if c in names else f'CAST(NULL AS VARCHAR) AS "{c}"'
        for c in ("timestamp", "level", "message", "pid", "bytes")
    ]
    always = sum(n not in optional for n in names)
    extra = " + ".join([str(always), *[f"CAST({found}.\"{n}\" <> '' AS INTEGER)" for n in names if n in optional]])
    return (
        f"SELECT event_id, log_type, {', '.join(cells)}, CAST({extra} AS INTEGER) AS n_fields FROM mixed"
        f" WHERE log_type = '{fmt}' AND {status_sql(regex)} = 'OK'"
    )


@query("parse_multi_format", f"WITH {_MIXED} " + " UNION ALL ".join(_common(f) for f in MULTI))
def _parse_multi_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = keep_valid(parse_multi_format(mixed_lines(read_events(spark, sf_dir), list(MULTI)), MULTI))
    found = F.col("fields")
    return parsed.select(
        "event_id",
        "log_type",
        *[found[c].alias(c) for c in ("timestamp", "level", "message", "pid", "bytes")],
        F.size("fields").alias("n_fields"),
    )


@query(
    "grok_optional",
    f"WITH {lines_cte('syslog')}, p AS (SELECT event_id, {status_sql('([a-z]+[0-9]) app(?:.([0-9]+).)?: ([a-z]+)', limited=False)} AS status,"
    r" regexp_extract(value, '([a-z]+[0-9]) app(?:\[([0-9]+)\])?: ([a-z]+)', ['host', 'pid', 'word']) AS f FROM lines)"
    " SELECT event_id, f.host AS host, CAST(nullif(f.pid, '') AS BIGINT) AS pid, f.word AS word FROM p WHERE status = 'OK'",
)
def _grok_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inline capture, an optional part and a declared type in one template."""
    parsed = grok(lines(spark, sf_dir, "syslog"), r"(?<host>[a-z]+[0-9]) app(?:\[%{INT:pid:long}\])?: %{WORD:word}")
    return flatten(parsed, keep=["event_id"])


@query(
    "flow_custom",
    f"WITH {lines_cte('application')} SELECT event_id, regexp_extract(value, 'by user ([0-9]+)', 1) AS user, ts IS NULL AS undated"
    f" FROM lines WHERE {status_sql('by user [0-9]+')} = 'OK'",
)
def _flow_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A template with a pattern name of its own."""
    parsed = parse_lines(lines(spark, sf_dir), "by user %{ACCOUNT:user}", custom={"ACCOUNT": "[0-9]+"})
    return keep_valid(parsed).select("event_id", F.col("fields.user").alias("user"), F.col("ts").isNull().alias("undated"))
