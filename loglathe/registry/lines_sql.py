"""SQL twins of the rendered log lines and the formats' regular expressions, for checking results in another engine.

Written on their own, not derived from the Spark side: the regexes are simpler and in the dialect both engines share.
"""

from __future__ import annotations

_LEVEL = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' ELSE 'INFO' END"
_ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')"

LINE_SQL = {
    "application": f"{_ISO} || ' ' || {_LEVEL} || ' ' || event_type || ' by user ' || user_id || ' ' || props",
    "access": (
        "'10.0.' || (user_id % 256) || '.1 - - [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] \"GET /' || event_type"
        " || '/' || event_id || ' HTTP/1.1\" ' || CASE WHEN event_type = 'error' THEN '500' ELSE '200' END || ' '"
        " || CASE WHEN event_id % 10 = 0 THEN '-' ELSE CAST(user_id * 7 AS VARCHAR) END"
        " || CASE WHEN event_id % 2 = 0 THEN ' \"-\" \"agent/1.0\"' ELSE '' END"
    ),
    "syslog": (
        "strftime(ts, '%b %d %H:%M:%S') || ' host' || (user_id % 5) || ' app'"
        " || CASE WHEN event_id % 3 = 0 THEN '' ELSE '[' || event_id || ']' END || ': ' || event_type || ' ' || props"
    ),
    "nginx_error": (
        "strftime(ts, '%Y/%m/%d %H:%M:%S') || ' [' || CASE event_type WHEN 'error' THEN 'error' WHEN 'purchase' THEN 'warn'"
        " ELSE 'info' END || '] ' || event_id || '#0: *1 ' || event_type"
    ),
    "custom_app": (
        f"'[' || strftime(ts, '%Y-%m-%d %H:%M:%S.%g') || '] [' || {_LEVEL} || '] [' || event_type || 'Service] user '"
        " || user_id"
    ),
    "json": (
        f"'{{\"timestamp\":\"' || {_ISO} || '\",\"level\":\"' || {_LEVEL} || '\",\"service\":\"' || event_type"
        " || '\",\"message\":\"user ' || user_id || '\"}'"
    ),
}
LINE_SQL["loglevel"] = LINE_SQL["application"]
LINE_SQL["access_combined"] = LINE_SQL["access"]

_STAMP = r"[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:[.,][0-9]+)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?"
_ACCESS = (
    r'([^ ]+) ([^ ]+) ([^ ]+) \[([^\]]+)\] "(?:([A-Za-z]+) ([^ "]+)(?: HTTP/([0-9.]+))?|([^"]*))" ([0-9]+) (?:([0-9]+)|-)'
)

# format -> (regex, fields, fields that may be absent)
REGEX_SQL: dict[str, tuple[str, list[str], set[str]]] = {
    "application": (rf"({_STAMP}) ([A-Za-z0-9_]+) (.*)", ["timestamp", "level", "message"], set()),
    "loglevel": (rf"({_STAMP}) (INFO|WARN|ERROR) (.*)", ["timestamp", "level", "message"], set()),
    "access": (
        _ACCESS + r'(?: ("[^"]*") ("[^"]*"))?',
        ["clientip", "ident", "auth", "timestamp", "verb", "request", "httpversion", "rawrequest", "response", "bytes",
         "referrer", "agent"],
        {"verb", "request", "httpversion", "rawrequest", "bytes", "referrer", "agent"},
    ),
    "syslog": (
        r"([A-Z][a-z]{2} +[0-9]{1,2} [0-9]{2}:[0-9]{2}:[0-9]{2}) (?:<([0-9]+).([0-9]+)> )?([^ ]+) ([^ \[:]+)"
        r"(?:\[([0-9]+)\])?: (.*)",
        ["timestamp", "facility", "priority", "logsource", "program", "pid", "message"],
        {"facility", "priority", "pid"},
    ),
    "nginx_error": (
        r"([0-9]{4}/[0-9]{2}/[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}) \[([a-z]+)\] ([0-9]+)#[0-9]+: (.*)",
        ["timestamp", "level", "pid", "message"],
        set(),
    ),
    "custom_app": (
        r"\[([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9:.]+)\] \[([A-Za-z]+)\] \[([A-Za-z0-9_]+)\] (.*)",
        ["timestamp", "level", "service", "message"],
        set(),
    ),
}
REGEX_SQL["access_combined"] = (
    _ACCESS + r' ("[^"]*") ("[^"]*")',
    REGEX_SQL["access"][1],
    {"verb", "request", "httpversion", "rawrequest", "bytes"},
)

BLANK_SQL = r"regexp_full_match(value, '[\x00-\x20]*')"


def disturbed(line: str) -> str:
    """The line with the same disturbances as the Spark rendering."""
    return (
        "CASE WHEN event_id % 50 = 3 THEN '   ' WHEN event_id % 20 = 7 THEN 'malformed line ' || event_id"
        f" WHEN event_id % 1000 = 11 THEN ({line}) || repeat('x', 10000) ELSE {line} END"
    )


def lines_cte(fmt: str) -> str:
    """``lines(event_id, ts, event_type, user_id, value)``."""
    return f"lines AS (SELECT event_id, ts, event_type, user_id, {disturbed(LINE_SQL[fmt])} AS value FROM events)"


def status_sql(regex: str, value: str = "value", miss: str = "NO_MATCH", limited: bool = True) -> str:
    long = f" WHEN length({value}) > 10000 THEN 'TOO_LONG'" if limited else ""
    return (
        f"CASE WHEN regexp_full_match({value}, '[\\x00-\\x20]*') THEN 'BLANK'{long}"
        f" WHEN regexp_matches({value}, '{regex}') THEN 'OK' ELSE '{miss}' END"
    )


def parsed_cte(fmt: str) -> str:
    """``lines`` and ``parsed(.., status, f)``, where ``f`` is a struct of the captured texts."""
    regex, names, _ = REGEX_SQL[fmt]
    listed = ", ".join(f"'{n}'" for n in names)
    return (
        f"{lines_cte(fmt)}, parsed AS (SELECT *, {status_sql(regex)} AS status,"
        f" regexp_extract(value, '{regex}', [{listed}]) AS f FROM lines)"
    )


def field_sql(fmt: str) -> str:
    """Select list of all captured fields."""
    _, names, optional = REGEX_SQL[fmt]
    return ", ".join(f'nullif(f."{n}", \'\') AS "{n}"' if n in optional else f'f."{n}" AS "{n}"' for n in names)
