"""Schema inference over captured fields: what the data holds, looked up in all of it and not in one sample."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.functions.casts import spark_type
from loglathe.operators.shape import EVENT_DATE

MAX_FIELDS = 10_000


def _is_int_text(value: Column) -> Column:
    """True when the text is exactly how a 32-bit integer is written (``007`` and overflows are not)."""
    fits = value.cast("long").between(-(2**31), 2**31 - 1)
    return F.coalesce(F.when(value.rlike(r"^(?:0|-?[1-9][0-9]{0,9})\z"), fits), F.lit(False))


def infer_schema(
    df: DataFrame, fields: str = "fields", *, declared: Mapping[str, str] | None = None, by_value: bool = False
) -> DataFrame:
    """``name, type, present``: one row per field found in a ``map<string,string>`` column, plus the partition date.

    Fields are strings unless the pattern declares another type.  ``by_value`` also makes a field an int when every
    value of it reads as one.  Map entries are counted per task first, so only a few rows per field are shuffled.
    """
    found = (
        df.select(F.explode(fields).alias("name", "value"))
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("present"), F.bool_and(_is_int_text(F.col("value"))).alias("all_int"))
    )
    type_name = F.when(F.col("all_int"), F.lit("int")).otherwise(F.lit("string")) if by_value else F.lit("string")
    for name, declared_type in (declared or {}).items():
        spark_type(declared_type)
        type_name = F.when(F.col("name") == name, F.lit(declared_type.lower())).otherwise(type_name)
    rows = df.sparkSession.range(1).select(
        F.lit(EVENT_DATE).alias("name"), F.lit("string").alias("type"), F.lit(None).cast("long").alias("present")
    )
    return found.select("name", type_name.alias("type"), "present").unionByName(rows)


def inferred_struct(schema_rows: DataFrame) -> T.StructType:
    """The inferred rows as a Spark schema: fields by name, partition date last, all required."""
    rows = schema_rows.select("name", "type").limit(MAX_FIELDS + 1).collect()
    if len(rows) > MAX_FIELDS:
        raise ValueError(f"More than {MAX_FIELDS} distinct fields: these are data, not a schema")
    rows.sort(key=lambda r: (r["name"] == EVENT_DATE, r["name"]))
    return T.StructType([T.StructField(r["name"], spark_type(r["type"]), nullable=False) for r in rows])
