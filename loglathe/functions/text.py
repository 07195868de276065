"""Line predicates, masking and JSON clean-up as column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LINE_LENGTH = 10_000
PII_KEYS = ("vuid", "vp_id")
PII_VISIBLE_CHARS = 3

_CORRUPT = "__corrupt"

# Everything up to and including the space: what trimming a line removes.
_BLANK_CHARS = "".join(chr(c) for c in range(0x21))


def is_blank(col: Column) -> Column:
    """Null, empty, or nothing but characters up to U+0020 (tabs and control characters included)."""
    # trimming one side is enough, and it stops at the first other character
    return col.isNull() | (F.ltrim(col, F.lit(_BLANK_CHARS)) == "")


def utf16_length(col: Column) -> Column:
    """Length in UTF-16 units: characters outside the basic plane count twice."""
    return (F.octet_length(F.encode(col, "UTF-16BE")) / 2).cast("int")


def is_oversize(col: Column, limit: int | None = MAX_LINE_LENGTH) -> Column:
    """Longer than ``limit`` UTF-16 units; nothing is without a limit.

    UTF-8 never uses fewer bytes than UTF-16 uses units, so the byte length, which Spark stores, settles almost
    every line without decoding it.
    """
    if limit is None:
        return F.lit(False)
    return (F.octet_length(col) > limit) & (F.octet_length(F.encode(col, "UTF-16BE")) > 2 * limit)


def mask_from(col: Column, keep: int) -> Column:
    """Keep the first ``keep`` characters and star out the rest."""
    if keep < 0:
        raise ValueError("keep must not be negative")
    return F.concat(F.substring(col, 1, keep), F.repeat(F.lit("*"), F.greatest(F.length(col) - keep, F.lit(0))))


def mask_json_values(col: Column, keys: Sequence[str] = PII_KEYS, visible: int = PII_VISIBLE_CHARS) -> Column:
    """Star out the string and number values of ``keys`` inside JSON text, leaving ``visible`` characters readable.

    Every occurrence is masked, with blanks on either side of the colon; an escaped character counts, and is starred, as one.
    The rest of the text stays as it is.  A masked number is no number any more.
    """
    out = col
    for key in keys:
        # \G continues right behind the character masked last, so one pass walks through the whole value.
        for opening, unit in (('"', r'(?:\\[^u]|\\u[0-9A-Fa-f]{4}|\\|[^"\\])'), ("", "[0-9.eE+-]")):
            out = F.regexp_replace(out, rf'("{re.escape(key)}"\s*:\s*{opening}{unit}{{{visible}}}|(?<!^)\G){unit}', "$1*")
    return out


def json_object(col: Column, element_type: str) -> Column:
    """The JSON object a text consists of, read as ``element_type``; null for any other text.

    Spark's reader stops after the first value and ignores what follows, so text holding a second object or a torn end
    would lose it unnoticed.  Read as the only element of an array inside an object, nothing may follow.
    """
    wrapped = F.concat(F.lit('{"o":['), col, F.lit("]}"))
    read_as = f"o array<{element_type}>, {_CORRUPT} string"
    outer = F.from_json(wrapped, read_as, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    # the lambda gives the parsed value a name, so that reading it three times does not parse it three times
    found = F.transform(
        F.array(outer), lambda x: F.when(x[_CORRUPT].isNull() & (F.size(x["o"]) == 1), x["o"][0])
    )[0]
    # other text need not fail in the reader, which is slow
    return F.when(F.ltrim(col, F.lit(" \t\r\n")).startswith("{"), found)


def drop_empty_json(col: Column) -> Column:
    """JSON object text without its null and blank top-level values; null when the text is not a JSON object.

    Numbers may be spelled anew (``1.50`` as ``1.5``), yet keep their value: integers of any length stay as they are written, and an
    object with a number that no double can hold is null as well.
    """
    read = json_object(col, "map<string,variant>")
    kept = F.map_filter(
        read,
        lambda _, v: v.isNotNull()
        & ~F.is_variant_null(v)
        & (F.coalesce(F.btrim(_variant_text(v), F.lit(_BLANK_CHARS)), F.lit("?")) != ""),
    )
    too_large = F.exists(F.map_values(kept), lambda v: (F.schema_of_variant(v) == "DOUBLE") & (F.abs(_double(v)) == float("inf")))
    return (
        F.when(col.rlike("[0-9]{38}"), _as_written(col, kept))
        .when(col.rlike("[eE][+]?[0-9]{3}") & too_large, None)
        .otherwise(F.to_json(kept))
    )


def _double(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def _as_written(col: Column, kept: Column) -> Column:
    """The members of ``kept`` as JSON text, numbers and nested values as ``col`` has them."""
    texts = json_object(col, "map<string,string>")
    both = F.transform(F.array(F.struct(kept.alias("kept"), texts.alias("texts"))), lambda x: _members(x["kept"], x["texts"]))
    return both[0]


def _members(kept: Column, texts: Column) -> Column:
    def member(entry: Column) -> Column:
        text = F.element_at(texts, entry["key"])
        value = F.when(F.schema_of_variant(entry["value"]) == "STRING", _quoted(text)).otherwise(text)
        return F.concat(_quoted(entry["key"]), F.lit(":"), value)

    return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(kept), member), ","), F.lit("}"))


def _quoted(text: Column) -> Column:
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _variant_text(v: Column) -> Column:
    """Text of a scalar variant; null for objects and arrays, which are never blank."""
    return F.try_variant_get(v, "$", "string")
