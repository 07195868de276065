"""Type names and lenient readers for captured text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The type names a schema may use.
TYPE_NAMES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "double": T.DoubleType(),
}


def spark_type(name: str) -> T.DataType:
    """Spark type for a type name, in any letter case."""
    try:
        return TYPE_NAMES[name.lower()]
    except KeyError:
        raise ValueError(f"Unsupported type: {name}") from None


# What a cast may succeed on. A failing cast raises and catches an exception inside, which costs some fifty times as much
# as looking at the text first; these tests accept everything that the casts accept.
_BLANKS = r"[\x00-\x20]*"
_WRITTEN_AS = {
    "int": rf"^{_BLANKS}[+-]?[0-9]+{_BLANKS}\z",
    "long": rf"^{_BLANKS}[+-]?[0-9]+{_BLANKS}\z",
    "boolean": rf"^{_BLANKS}(?i:t|true|y|yes|1|f|false|n|no|0){_BLANKS}\z",
    "double": rf"^{_BLANKS}[+-]?(?i:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?[df]?|inf|infinity|nan){_BLANKS}\z",
}


def cast_text(text: str, type_name: str) -> str:
    """SQL text that casts captured text; text that does not fit becomes null instead of failing the job."""
    target = spark_type(type_name)
    if isinstance(target, T.StringType):
        return text
    return f"CASE WHEN {text} RLIKE r'{_WRITTEN_AS[type_name.lower()]}' THEN try_cast({text} AS {target.simpleString()}) END"


def cast_as(col: Column, type_name: str) -> Column:
    """The same for a column."""
    target = spark_type(type_name)
    if isinstance(target, T.StringType):
        return col
    return F.when(col.rlike(_WRITTEN_AS[type_name.lower()]), col.try_cast(target))


def string_field(col: Column) -> Column:
    """The text, or '' when the field is missing."""
    return F.coalesce(col.cast("string"), F.lit(""))


def int_field(col: Column) -> Column:
    """A 32-bit integer, or 0 when the field is missing or is not exactly an integer (no blanks, no decimals)."""
    text = col.cast("string")
    return F.coalesce(F.when(text.rlike(r"^[+-]?[0-9]+\z"), text.try_cast("int")), F.lit(0))
