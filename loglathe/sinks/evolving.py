"""A store whose schema follows the data: new columns are added and types widen, and no file is written again.

Types form a lattice: each pair has a least type that holds the values of both without loss, ``string`` at the top.  A batch's schema is joined with
the store's; the result, if it says more, becomes the next schema version, a small file under ``_schemas``.  Each batch is written with
the version of its time, which its marker notes (``commits``); readers take each version's batches with its schema and cast them to the newest.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.sinks.commits import load_state, names_in, read_small, write_batch, write_small
from loglathe.sinks.tables import Layout

_SCHEMAS = "_schemas"
_PLACES = ("run", "batch")
_NUMBERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds all values of both; long and double meet in string, since neither holds all values of the other."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.NullType):
            return y
        if isinstance(y, T.DoubleType) and isinstance(x, T.FloatType | T.IntegerType | T.ShortType | T.ByteType):
            return y
        if isinstance(y, T.TimestampNTZType) and isinstance(x, T.DateType):
            return y
    if a in _NUMBERS and b in _NUMBERS:
        return max(a, b, key=_NUMBERS.index)
    for t in (a, b):
        if isinstance(t, T.ArrayType | T.MapType | T.StructType | T.BinaryType | T.VariantType):
            raise ValueError(f"No common type of {a.simpleString()} and {b.simpleString()}")
    return T.StringType()


def join_schemas(schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns in the order they came up, with the least common types; a column is required only if all have it and require it."""

    def join(a: T.StructType, b: T.StructType) -> T.StructType:
        theirs = {f.name: f for f in b.fields}
        out = []
        for f in a.fields:
            o = theirs.pop(f.name, None)
            out.append(T.StructField(f.name, join_types(f.dataType, o.dataType) if o else f.dataType, f.nullable or o is None or o.nullable))
        return T.StructType([*out, *[T.StructField(f.name, f.dataType, True) for f in theirs.values()]])

    return reduce(join, schemas)


def schema_versions(spark: SparkSession, root: str) -> dict[int, T.StructType]:
    """All versions of the schema; a version counts when its file is there."""
    found = [int(n.removesuffix(".json")) for n in names_in(spark, f"{root}/{_SCHEMAS}") if n.endswith(".json") and not n.startswith(".")]
    return {v: T.StructType.fromJson(json.loads(read_small(spark, f"{root}/{_SCHEMAS}/{v}.json"))) for v in sorted(found)}


def _relaxed(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def evolve_schema(spark: SparkSession, root: str, schema: T.StructType) -> int:
    """Join ``schema`` into the store's; returns the version that holds both. One writer may change the schema at a time."""
    clash = [c for c in schema.names if c in _PLACES]
    if clash:
        raise ValueError(f"Column names in use by the store: {clash}")
    versions = schema_versions(spark, root)
    newest = max(versions, default=0)
    wanted = _relaxed(join_schemas([versions[newest], schema]) if versions else schema)
    if versions and wanted == versions[newest]:
        return newest
    write_small(spark, f"{root}/{_SCHEMAS}/{newest + 1}.json", json.dumps(wanted.jsonValue()))
    return newest + 1


def append_evolving(df: DataFrame, root: str, *, run: str | None = None, batch: int = 0, layout: Layout | None = None) -> None:
    """Add rows with whatever columns they have; with a run its batch is replaced.

    Narrower types are widened as they are written and missing columns are null.  What the store lacks is added to its schema first, which
    readers may see before the rows.
    """
    spark = df.sparkSession
    version = evolve_schema(spark, root, df.schema)
    schema = schema_versions(spark, root)[version]
    rows = df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
    writer = rows.write.mode("overwrite").options(**(layout or Layout()).options())
    write_batch(spark, root, run or f"batch-{uuid.uuid4().hex}", batch, writer.parquet, note=str(version))


def read_evolving(spark: SparkSession, root: str) -> DataFrame:
    """All rows with the newest schema."""
    versions = schema_versions(spark, root)
    if not versions:
        raise ValueError(f"No schema under {root}")
    target = versions[max(versions)]
    state = load_state(spark, root)
    places = [T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())]
    parts = []
    for version in sorted({int(note) for _, note in state.marks.values()}):
        own = versions[version]
        rows = spark.read.schema(T.StructType([*own.fields, *places])).parquet(root).where(state.condition(str(version)))
        parts.append(rows.select(*[(F.col(f"`{f.name}`") if f.name in own.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields]))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], target)
