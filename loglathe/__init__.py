"""Log parsing and log quality on Spark: text lines in, typed tables, rejects and quality figures out."""

from loglathe.functions.patterns import compile_pattern
from loglathe.operators.parse import flatten, grok, parse_json_lines, parse_lines, parse_multi_format
from loglathe.plans.flow import Flow, run_batch
from loglathe.plans.formats import FORMATS, LogFormat
from loglathe.session import local_session
from loglathe.sources.files import scan_lines, stream_lines
from loglathe.streaming.runner import run_stream

__all__ = [
    "FORMATS",
    "Flow",
    "LogFormat",
    "compile_pattern",
    "flatten",
    "grok",
    "local_session",
    "parse_json_lines",
    "parse_lines",
    "parse_multi_format",
    "run_batch",
    "run_stream",
    "scan_lines",
    "stream_lines",
]
