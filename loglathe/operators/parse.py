"""Turn a column of text lines into fields with one regular expression pass per line.

``parse_lines`` adds two columns and changes nothing else:

``status``
    ``OK``, ``BLANK``, ``TOO_LONG``, ``NO_MATCH`` or ``BAD_JSON``
``fields``
    a struct with one string per captured field; every field is null unless the status is ``OK``
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.functions.casts import cast_text
from loglathe.functions.patterns import CompiledPattern, compile_pattern
from loglathe.functions.text import MAX_LINE_LENGTH, is_blank, is_oversize, json_object
from loglathe.operators.skeleton import LONG_LINE, Skeleton
from loglathe.plans.formats import JSON_TEXT, LogFormat, log_format

OK, BLANK, TOO_LONG, NO_MATCH, BAD_JSON = "OK", "BLANK", "TOO_LONG", "NO_MATCH", "BAD_JSON"

_MARK, _FENCE = "\u0001", "\u0002"
_PARTS = "__parts"
_MARKS = "__mark"
_CUT = "__cut"
_JSON = "__json"
_LOG_TYPE = re.compile(r"[a-zA-Z0-9_-]{1,50}")


def _own_mark(line: Column) -> Column:
    """What separates the groups of a line: one control character, or, for a line that holds it, a run of them that is
    longer than the line and so not part of it."""
    run = F.concat(F.lit(_FENCE), F.repeat(F.lit(_MARK), F.length(line) + 1), F.lit(_FENCE))
    return F.when(F.contains(line, F.lit(_MARK)), run).otherwise(F.lit(_MARK))


def _rewritten(
    line: Column, pattern: CompiledPattern, mark: Column, parts: Sequence[str] = (), skeleton: Skeleton | None = None
) -> Column:
    """A matching line rewritten to its groups, each behind a mark; any other line as it is.

    The pattern may match anywhere in the line, and it is matched once however many fields it has.  Lines without the fixed
    ``parts`` that every match has are not tried, and long ones were cut along the ``skeleton`` before.
    """
    search = F.lit(f"^(?s:.*?)(?:{pattern.regex})(?s:.*)$")
    layout = F.lit("".join(f"{_MARK}${g}" for c in pattern.captures for g in c.groups))
    own_layout = F.replace(layout, F.lit(_MARK), mark)
    subject = line if skeleton is None else F.coalesce(F.col(_CUT), line)
    found = F.regexp_replace(subject, search, F.when(mark == _MARK, layout).otherwise(own_layout))
    for part in parts:
        found = F.when(F.contains(line, F.lit(part)), found).otherwise(line)
    return found


def _cut(line: Column, skeleton: Skeleton) -> Column:
    """A long line cut along the skeleton; null if the whole of it has to be tried.

    The work is put into a lambda, which Spark doesn't compile into the code that all lines run through: few lines need it, and it is long.
    """
    return F.transform(F.array(line), skeleton.cut)[0]


def _with_parts(
    df: DataFrame, line: Column, split: Callable[[Column], Column], max_length: int | None, skeletons: Sequence[tuple[Column, Skeleton]] = ()
) -> DataFrame:
    """Add the parts column: ``['', group 1, .., group N]`` on a match and a one-element array on a miss.

    It is null for blank and oversize lines, which never reach the regex.  Long lines are cut beforehand, by the skeleton whose condition
    holds.
    """
    usable = ~is_blank(line) & ~is_oversize(line, max_length)
    rows = df.withColumn(_MARKS, _own_mark(line))
    if skeletons:
        cut = F.lit(None).cast("string")
        for condition, skeleton in skeletons:
            cut = F.when((F.octet_length(line) > LONG_LINE) & usable & condition, _cut(line, skeleton)).otherwise(cut)
        rows = rows.withColumn(_CUT, cut)
    return _evaluate_once(rows, F.when(usable, split(F.col(_MARKS))), _PARTS).drop(_MARKS, _CUT)


def _regex_parts(
    line: Column, pattern: CompiledPattern, mark: Column, parts: Sequence[str] = (), skeleton: Skeleton | None = None
) -> Column:
    return F.split(_rewritten(line, pattern, mark, parts, skeleton), mark, -1)


def _json_parts(line: Column, schema: T.StructType) -> Column:
    """The same for a JSON object: its declared fields, null where absent, and the whole text."""
    record = json_object(line, schema.simpleString())
    cells = F.transform(F.array(record), lambda r: F.when(r.isNull(), F.array(F.lit(""))).otherwise(F.array(F.lit(""), *[r[f.name].cast("string") for f in schema.fields], line)))
    return cells[0]


def _field_texts(pattern: CompiledPattern, typed: bool = False) -> dict[str, str]:
    """SQL text of each field, read from the parts column; a string unless ``typed`` and declared otherwise.

    ``''`` of a group that took no part in the match becomes null.
    """
    out, position = {}, 1
    for capture in pattern.captures:
        values = []
        for _ in capture.groups:
            value = f"get({_PARTS}, {position})"
            values.append(f"nullif({value}, '')" if capture.optional else value)
            position += 1
        text = values[0] if len(values) == 1 else f"coalesce({', '.join(values)})"
        if typed and capture.type_name:
            text = cast_text(text, capture.type_name)
        out[capture.name] = text
    return out


def _fields_struct(pattern: CompiledPattern) -> Column:
    cells = _field_texts(pattern, typed=True)
    return F.expr("named_struct(" + ", ".join(f"'{name}', {text}" for name, text in cells.items()) + ")")


def _fields_map(fmt: LogFormat) -> str:
    """SQL text of a map of all fields, absent ones with null."""
    if fmt.json_schema is not None:
        listed = ", ".join(f"'{n}'" for n in fmt.field_names)
        return f"map_from_arrays(array({listed}), slice({_PARTS}, 2, {len(fmt.field_names)}))"
    pattern = fmt.compiled
    names = ", ".join(f"'{c.name}'" for c in pattern.captures)
    if any(len(c.groups) > 1 for c in pattern.captures):
        values = f"array({', '.join(_field_texts(pattern).values())})"
    else:
        # array functions, since a line of code per field and format would grow past what the JVM compiles
        values = f"slice({_PARTS}, 2, {len(pattern.captures)})"
        if any(c.optional for c in pattern.captures):
            flags = ", ".join(str(c.optional).lower() for c in pattern.captures)
            values = f"zip_with({values}, array({flags}), (v, o) -> if(o AND v = '', null, v))"
    return f"map_from_arrays(array({names}), {values})"


def _status(line: Column, parts: Column, pattern: CompiledPattern) -> Column:
    width = 1 + sum(len(c.groups) for c in pattern.captures)
    return (
        F.when(F.size(parts) == width, F.lit(OK))
        .when(parts.isNotNull(), F.lit(NO_MATCH))
        .when(is_blank(line), F.lit(BLANK))
        .otherwise(F.lit(TOO_LONG))
    )


def _evaluate_once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add ``value`` as a column that later filters and projections read instead of computing it again.

    A plain projection would not do: the optimizer copies its expression into every filter pushed below it, and the
    regex would run once for the filter and once for the fields.  Nothing is pushed through a generator's output.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def grok(
    df: DataFrame,
    pattern: str,
    col: str = "value",
    *,
    custom: Mapping[str, str] | None = None,
    max_length: int | None = None,
    parts: Sequence[str] = (),
    skeleton: Skeleton | None = None,
) -> DataFrame:
    """Apply a pattern template to a text column; adds ``status`` and ``fields`` (see the module text).

    All texts are searched; with ``max_length`` longer ones are ``TOO_LONG``.  ``parts`` are texts that every match holds: lines
    without them are misses that cost no regex.  ``skeleton`` says how the pattern is put together, for long lines.
    """
    compiled = compile_pattern(pattern, dict(custom or {}))
    line, found = F.col(col), F.col(_PARTS)
    return (
        _with_parts(df, line, lambda mark: _regex_parts(line, compiled, mark, parts, skeleton), max_length, [(F.lit(True), skeleton)] if skeleton else [])
        .withColumns({"status": _status(line, found, compiled), "fields": _fields_struct(compiled)})
        .drop(_PARTS)
    )


def check_patterns(spark: SparkSession, *formats: str | LogFormat, custom: Mapping[str, str] | None = None) -> None:
    """Have Spark compile the regexes on an empty line, so that a bad one fails now and not in the middle of a job."""
    tries = [F.lit("").rlike(log_format(f, custom).compiled.regex).alias(f"p{i}") for i, f in enumerate(formats)]
    spark.range(1).select(*tries).collect()


def parse_json_lines(
    df: DataFrame, schema: T.StructType, col: str = "value", *, max_length: int | None = MAX_LINE_LENGTH
) -> DataFrame:
    """Parse one JSON object per line by a declared schema; text that is not such an object gets ``BAD_JSON``.

    The field ``json_data`` keeps the whole text, so keys without a field of their own are not lost.
    """
    line, record = F.col(col), F.col(_JSON)
    parsed = F.when(~is_oversize(line, max_length), json_object(line, schema.simpleString()))
    status = (
        F.when(record.isNotNull(), F.lit(OK))
        .when(is_blank(line), F.lit(BLANK))
        .when(is_oversize(line, max_length), F.lit(TOO_LONG))
        .otherwise(F.lit(BAD_JSON))
    )
    text = F.when(record.isNotNull(), line).alias(JSON_TEXT)
    fields = F.struct(*[record[f.name].alias(f.name) for f in schema.fields], text)
    return _evaluate_once(df, parsed, _JSON).withColumns({"status": status, "fields": fields}).drop(_JSON)


def parse_lines(
    df: DataFrame,
    fmt: str | LogFormat,
    col: str = "value",
    *,
    custom: Mapping[str, str] | None = None,
    max_length: int | None = MAX_LINE_LENGTH,
) -> DataFrame:
    """Parse lines of one format: a preset, a ``LogFormat`` or a template, which may use ``custom`` names.

    JSON formats are expanded into their declared fields.  ``max_length`` is the rule for log lines; None lifts it.
    """
    chosen = log_format(fmt, custom)
    if chosen.json_schema is not None:
        return parse_json_lines(df, chosen.json_schema, col, max_length=max_length)
    known = {"parts": chosen.parts, "skeleton": chosen.skeleton}
    return grok(df, chosen.pattern, col, custom=dict(chosen.custom), max_length=max_length, **known)


def parse_multi_format(
    df: DataFrame,
    formats: Mapping[str, str | LogFormat],
    type_col: str = "log_type",
    col: str = "value",
    *,
    custom: Mapping[str, str] | None = None,
    max_length: int | None = MAX_LINE_LENGTH,
) -> DataFrame:
    """Parse lines of several formats in one scan; ``type_col`` says which pattern a line belongs to.

    ``fields`` is a ``map<string,string>`` holding the captured fields of the line's own format (absent fields are not
    in the map).  Lines of a type without a pattern are ``NO_MATCH``; text that is no object is ``BAD_JSON`` where the type's
    format is JSON.  Only the branch of its own type runs for a line.
    """
    if not formats:
        raise ValueError("No formats given")
    chosen = {check_log_type(name): log_format(f, custom) for name, f in formats.items()}
    regexes = {name: (f.compiled, f.parts, f.skeleton) for name, f in chosen.items() if f.json_schema is None}
    schemas = {name: f.json_schema for name, f in chosen.items() if f.json_schema is not None}
    line, kind, parts = F.col(col), F.col(type_col), F.col(_PARTS)

    def split(mark: Column) -> Column:
        branch = F
        for name, (pattern, fixed, skeleton) in regexes.items():
            branch = branch.when(kind == name, _rewritten(line, pattern, mark, fixed, skeleton))
        found = F.split(branch.otherwise(F.lit("")) if regexes else F.lit(""), mark, -1)
        for name, schema in schemas.items():
            found = F.when(kind == name, _json_parts(line, schema)).otherwise(found)
        return found

    cases = " ".join(f"WHEN '{name}' THEN {_fields_map(f)}" for name, f in chosen.items())
    pairs = F.expr(f"CASE WHEN size({_PARTS}) > 1 THEN CASE `{type_col}` {cases} END END")
    status = (
        F.when(F.size(parts) > 1, F.lit(OK))
        .when(parts.isNotNull() & kind.isin(*schemas), F.lit(BAD_JSON))
        .when(parts.isNotNull(), F.lit(NO_MATCH))
        .when(is_blank(line), F.lit(BLANK))
        .otherwise(F.lit(TOO_LONG))
    )
    present = F.map_filter(pairs, lambda _, v: v.isNotNull())
    return (
        _with_parts(df, line, split, max_length, [(kind == name, s) for name, (_, _, s) in regexes.items() if s is not None])
        .withColumns({"status": status, "fields": present})
        .drop(_PARTS)
    )


def fields_map(df: DataFrame) -> DataFrame:
    """Replace the ``fields`` struct by a map of the fields that are present."""
    names = df.schema["fields"].dataType.names
    entries = F.map_from_arrays(
        F.array(*[F.lit(n) for n in names]), F.array(*[F.col("fields")[n].cast("string") for n in names])
    )
    return df.withColumn("fields", F.map_filter(entries, lambda _, v: v.isNotNull()))


def flatten(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Good rows only, with the captured fields as top-level columns behind the ``keep`` columns."""
    return df.where(F.col("status") == OK).select(*keep, "fields.*")


def keep_valid(df: DataFrame) -> DataFrame:
    """Rows whose line yielded at least one field."""
    return df.where(F.col("status") == OK)


def drop_blank(df: DataFrame, col: str = "value") -> DataFrame:
    """Lines with something on them."""
    return df.where(~is_blank(F.col(col)))


def drop_oversize(df: DataFrame, col: str = "value", limit: int = MAX_LINE_LENGTH) -> DataFrame:
    """Lines within the length limit."""
    return df.where(~is_oversize(F.col(col), limit))


def check_log_type(name: str) -> str:
    """Log type names are 1 to 50 letters, digits, ``_`` or ``-``."""
    if not isinstance(name, str) or not _LOG_TYPE.fullmatch(name):
        raise ValueError(f"Invalid log type: {name}")
    return name
