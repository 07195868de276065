"""Ready-made log formats: a pattern, the columns it yields and how to read a date from its timestamp."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import types as T

from loglathe.functions.patterns import CompiledPattern, compile_pattern
from loglathe.operators.skeleton import ACCESS, AGENT, Skeleton


@dataclass(frozen=True)
class LogFormat:
    name: str
    pattern: str
    date_regex: str | None = None  # finds the date in ``timestamp``; its groups are put into ``date_layout``
    date_layout: str | None = None
    date_format: str | None = None  # how the text made from them is read
    time_format: str | None = None  # how ``timestamp`` is written; None = ISO 8601
    json_schema: T.StructType | None = None  # set when the captured text is JSON to be expanded
    custom: tuple[tuple[str, str], ...] = ()  # own pattern names
    parts: tuple[str, ...] = ()  # fixed texts that every line of the format holds
    skeleton: Skeleton | None = None  # how its pattern is put together, for long lines

    @property
    def compiled(self) -> CompiledPattern:
        return compile_pattern(self.pattern, dict(self.custom))

    @property
    def field_names(self) -> list[str]:
        """All fields that a line of this format may have."""
        return self.compiled.names if self.json_schema is None else [*self.json_schema.names, JSON_TEXT]


#: the field that keeps the whole text of a JSON line, and with it all keys that have no field
JSON_TEXT = "json_data"

JSON_LOG_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("timestamp", "level", "service", "message")]
)

HTTP_TIME = "dd/MMM/yyyy:HH:mm:ss Z"

_ISO_DATE = (r"^([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})(?![0-9])", "$1-$2-$3", "yyyy-M-d")
_HTTP_DATE = (r"^([0-9]{1,2})/([A-Za-z]{3})[a-z]*/([0-9]{4})(?![0-9])", "$3-$2-$1", "yyyy-MMM-d")
_HTTP_PARTS = (" [", '] "')
_SYSLOG_DATE = (r"^([A-Za-z]{3})[a-z]* +([0-9]{1,2})(?![0-9])", "$1-$2", "MMM-d")
_SLASH_DATE = (r"^([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})(?![0-9])", "$1-$2-$3", "yyyy-M-d")

# The documented patterns of each log format.
FORMATS: dict[str, LogFormat] = {
    f.name: f
    for f in (
        LogFormat(
            "application",
            "%{TIMESTAMP_ISO8601:timestamp} %{WORD:level} %{GREEDYDATA:message}",
            *_ISO_DATE,
        ),
        LogFormat(
            "loglevel",
            "%{TIMESTAMP_ISO8601:timestamp} %{LOGLEVEL:level} %{GREEDYDATA:message}",
            *_ISO_DATE,
        ),
        LogFormat(
            "access", "%{COMBINEDAPACHELOG}", *_HTTP_DATE, HTTP_TIME, parts=_HTTP_PARTS,
            skeleton=replace(ACCESS, rest=f"{ACCESS.rest}(?:{AGENT})?"),
        ),
        LogFormat(
            "access_combined", "%{COMMONAPACHELOG} %{QS:referrer} %{QS:agent}", *_HTTP_DATE, HTTP_TIME, parts=_HTTP_PARTS,
            skeleton=replace(ACCESS, rest=ACCESS.rest + AGENT),
        ),
        LogFormat("syslog", "%{SYSLOGBASE} %{GREEDYDATA:message}", *_SYSLOG_DATE, "MMM d HH:mm:ss"),
        LogFormat("json", "%{GREEDYDATA:json_data}", *_ISO_DATE, json_schema=JSON_LOG_SCHEMA),
        LogFormat(
            "nginx_error",
            r"(?<timestamp>%{YEAR}/%{MONTHNUM}/%{MONTHDAY} %{TIME}) \[%{LOGLEVEL:level}\] "
            r"%{NONNEGINT:pid}#%{NONNEGINT}: %{GREEDYDATA:message}",
            *_SLASH_DATE,
            "yyyy/MM/dd HH:mm:ss",
        ),
        LogFormat(
            "custom_app",
            r"\[%{TIMESTAMP_ISO8601:timestamp}\] \[%{WORD:level}\] \[%{WORD:service}\] %{GREEDYDATA:message}",
            *_ISO_DATE,
        ),
    )
}


def log_format(fmt: str | LogFormat, custom: Mapping[str, str] | None = None) -> LogFormat:
    """A preset by name, a template as a format without a known date, or a ready ``LogFormat``; with own pattern names."""
    if isinstance(fmt, LogFormat):
        chosen = fmt
    elif fmt in FORMATS:
        chosen = FORMATS[fmt]
    elif "%{" in fmt or "(?<" in fmt:
        # its date, if a field holds one, is read as ISO 8601
        chosen = LogFormat("template", fmt, *_ISO_DATE)
    else:
        raise ValueError(f"Unknown log format: {fmt}; known: {', '.join(sorted(FORMATS))}")
    return replace(chosen, custom=(*chosen.custom, *custom.items())) if custom else chosen
