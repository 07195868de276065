"""From parsed lines to table rows: typed columns, masking and the partition date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.functions.casts import cast_as, spark_type, string_field
from loglathe.functions.text import mask_from, mask_json_values
from loglathe.operators.parse import OK
from loglathe.plans.formats import LogFormat, log_format

EVENT_DATE = "event_date"
EVENT_TIME = "event_time"
DATE_PATTERN = "yyyy-MM-dd"
#: partition of lines whose date can't be read
UNDATED = "unknown"

# The columns of the generic log table, all required.
GENERIC_COLUMNS = ("timestamp", "level", "message")


def generic_schema() -> T.StructType:
    """Schema of the generic log table."""
    return T.StructType([T.StructField(c, T.StringType(), nullable=False) for c in (*GENERIC_COLUMNS, EVENT_DATE)])


def processing_date() -> Column:
    """Today's date as text. Inside a streaming plan it is fixed per batch, so a replayed batch keeps its date."""
    return F.date_format(F.current_date(), DATE_PATTERN)


def _year_of(text: Column, pattern: str) -> Column:
    """The year in which a date without one was written: this year, or the last one for a date still to come."""
    now = F.current_date()
    this = F.try_to_timestamp(F.concat_ws("-", F.year(now).cast("string"), text), F.lit(f"yyyy-{pattern}"))
    # clocks and zones may differ by a day
    return F.when(this.cast("date") > F.date_add(now, 1), F.year(now) - 1).otherwise(F.year(now))


def _date_text(timestamp: Column, chosen: LogFormat) -> Column:
    """The date's parts, one behind the other; null where the text doesn't begin with a date."""
    if chosen.date_format == "yyyy-M-d" and "-(" in chosen.date_regex:
        return F.regexp_extract(timestamp, chosen.date_regex, 0)  # already in this order
    parts = F.regexp_replace(timestamp, chosen.date_regex + "(?s:.*)$", chosen.date_layout)
    return F.when(timestamp.rlike(chosen.date_regex), parts)


def _with_year(text: Column, chosen: LogFormat, year: int | None) -> tuple[Column, str]:
    """Put a year before a date that lacks one."""
    written = F.lit(year) if year is not None else _year_of(text, chosen.date_format)
    return F.concat_ws("-", written.cast("string"), text), f"yyyy-{chosen.date_format}"


def event_time(timestamp: Column, fmt: str | LogFormat, year: int | None = None) -> Column:
    """A log timestamp as a point in time; null where it cannot be read.

    Text without a time zone is read in the session's zone.  Stamps without a year get ``year``, or else this year, or the
    last one when they would lie in the future.
    """
    chosen = log_format(fmt)
    pattern = chosen.time_format
    if pattern is None:
        return F.regexp_replace(timestamp, ",", ".").try_cast("timestamp")
    if "y" not in pattern:
        written = F.lit(year) if year is not None else _year_of(_date_text(timestamp, chosen), chosen.date_format)
        timestamp = F.regexp_replace(F.concat(written.cast("string"), F.lit(" "), timestamp), " +", " ")
        pattern = f"yyyy {pattern}"
    return F.try_to_timestamp(timestamp, F.lit(pattern))


def event_date(timestamp: Column, fmt: str | LogFormat, year: int | None = None, *, undated: str = UNDATED) -> Column:
    """The date written in a log timestamp, as ``yyyy-MM-dd``; ``undated`` where there is none that can be read.

    The date is found by its parts, so one-digit months and days are fine, and the time zone in the text does not move it.
    ``undated="today"`` stands for the processing date.  Years as in ``event_time``.
    """
    chosen = log_format(fmt)
    missing = processing_date() if undated == "today" else F.lit(undated)
    if chosen.date_regex is None:
        return missing
    text, pattern = _date_text(timestamp, chosen), chosen.date_format
    if "y" not in pattern:
        text, pattern = _with_year(text, chosen, year)
    read = text.try_cast("date") if pattern == "yyyy-M-d" else F.try_to_timestamp(text, F.lit(pattern))
    return F.coalesce(F.date_format(read, DATE_PATTERN), missing)


def cast_fields(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast top-level columns by type name; an unknown type name or column raises before anything runs."""
    for name, type_name in types.items():
        spark_type(type_name)
        if name not in df.columns:
            raise ValueError(f"No such field: {name}")
    return df.withColumns({name: cast_as(F.col(name), type_name) for name, type_name in types.items()})


def row_columns(
    parsed: DataFrame,
    fmt: str | LogFormat,
    *,
    columns: Sequence[str] | None = None,
    types: Mapping[str, str] | None = None,
    mask: Mapping[str, int] | None = None,
    mask_json: Sequence[str] = (),
    event_date_from: str | None = None,
    event_time_from: str | None = None,
    year: int | None = None,
    undated: str = UNDATED,
    custom: Mapping[str, str] | None = None,
) -> dict[str, Column]:
    """Column expressions of a table row, by name.

    ``columns``          wanted fields (default: all captured ones); strings are never null, missing ones are ``''``
    ``types``            type name per field; the pattern's own declarations count too
    ``mask``             field -> number of characters left readable
    ``mask_json``        fields holding JSON text whose personal values are masked
    ``event_date_from``  field to take the partition date from; default is the processing date
    ``event_time_from``  field to add as a timestamp column ``event_time``; the text itself stays as it is
    """
    chosen = log_format(fmt, custom)
    captured = parsed.schema["fields"].dataType.names
    declared = {} if chosen.json_schema is not None else chosen.compiled.declared_types
    type_names = {**declared, **(types or {})}
    out: dict[str, Column] = {}
    for name in columns if columns is not None else captured:
        value = F.col("fields")[name] if name in captured else F.lit(None).cast("string")
        out[name] = _cell(name, value, type_names, mask or {}, mask_json)
    if event_time_from is not None:
        out[EVENT_TIME] = event_time(F.col("fields")[event_time_from], chosen, year)
    out[EVENT_DATE] = processing_date()
    if event_date_from is not None:
        out[EVENT_DATE] = event_date(F.col("fields")[event_date_from], chosen, year, undated=undated)
    return out


def _cell(name: str, value: Column, types: Mapping[str, str], mask: Mapping[str, int], mask_json: Sequence[str]) -> Column:
    """A field as a table cell: masked where asked for, then typed; strings are never null."""
    if name in mask:
        value = mask_from(value, mask[name])
    if name in mask_json:
        value = mask_json_values(value)
    type_name = types.get(name, "string")
    return string_field(value) if type_name.lower() == "string" else cast_as(value.cast("string"), type_name)


def mixed_row_columns(
    formats: Mapping[str, str | LogFormat],
    *,
    type_col: str = "log_type",
    columns: Sequence[str] | None = None,
    types: Mapping[str, str] | None = None,
    mask: Mapping[str, int] | None = None,
    mask_json: Sequence[str] = (),
    event_date_from: str | None = None,
    event_time_from: str | None = None,
    year: int | None = None,
    undated: str = UNDATED,
    custom: Mapping[str, str] | None = None,
) -> dict[str, Column]:
    """Row cells for lines of several formats, whose ``fields`` are a map.

    The log type comes first, then the wanted ``columns`` (``''``, or null when typed, where a format has no such field), or
    the whole map as ``fields`` when no columns are named; its entries are masked all the same.  Types that the patterns
    declare count for columns that all formats declare alike.  Dates and times are read the way each format writes them.
    """
    found, kind = F.col("fields"), F.col(type_col)
    chosen = {n: log_format(f, custom) for n, f in formats.items()}
    out: dict[str, Column] = {"log_type": string_field(kind)}
    if columns is None:
        if mask or mask_json:
            found_masked = F.transform_values(found, lambda k, v: _masked_by_key(k, v, mask or {}, mask_json))
            out["fields"] = found_masked
        else:
            out["fields"] = found
    else:
        type_names = {**_declared_alike(chosen, columns), **(types or {})}
        out.update({name: _cell(name, found[name], type_names, mask or {}, mask_json) for name in columns})
    if event_time_from is not None:
        out[EVENT_TIME] = _by_kind(kind, {n: event_time(found[event_time_from], f, year) for n, f in chosen.items()})
    out[EVENT_DATE] = processing_date()
    if event_date_from is not None:
        dates = {n: event_date(found[event_date_from], f, year, undated=undated) for n, f in chosen.items()}
        out[EVENT_DATE] = F.coalesce(_by_kind(kind, dates), processing_date() if undated == "today" else F.lit(undated))
    return out


def _by_kind(kind: Column, cells: Mapping[str, Column]) -> Column:
    branch = F
    for name, cell in cells.items():
        branch = branch.when(kind == name, cell)
    return branch


def _declared_alike(formats: Mapping[str, LogFormat], columns: Sequence[str]) -> dict[str, str]:
    """Types declared for a column by every format that has it."""
    out = {}
    for name in columns:
        having = [f for f in formats.values() if name in f.field_names]
        declared = {None if f.json_schema is not None else f.compiled.declared_types.get(name) for f in having}
        if len(declared) == 1 and None not in declared:
            out[name] = declared.pop()
    return out


def _masked_by_key(key: Column, value: Column, mask: Mapping[str, int], mask_json: Sequence[str]) -> Column:
    for name in {*mask, *mask_json}:
        value = F.when(key == name, _cell(name, value, {}, mask, mask_json)).otherwise(value)
    return value


def shape_rows(parsed: DataFrame, fmt: str | LogFormat, *, keep: Sequence[str] = (), **options) -> DataFrame:
    """Good lines as table rows, columns by name, partition date last. Options as in ``row_columns``."""
    cells = row_columns(parsed, fmt, **options)
    return parsed.where(F.col("status") == OK).select(*keep, *[c.alias(n) for n, c in cells.items()])
