"""Nested JSON as typed columns, without a declared schema.

The schema is that of all values, merged by Spark over the whole column, not of a sample.  Every path to a value of one type becomes a
column, arrays stay arrays, and what has no one type, or is beyond the limit of columns, stays as it is in a map of variants.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_COLUMNS = 1_000
_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


@dataclass(frozen=True)
class Leaf:
    """A path into an object and its type; None is a value of no one type."""

    path: tuple[str, ...]
    type: T.DataType | None

    @property
    def name(self) -> str:
        return "_".join(re.sub(r"[^A-Za-z0-9_]", "_", p) for p in self.path)

    @property
    def json_path(self) -> str:
        steps = (f".{p}" if _PLAIN.fullmatch(p) else "['" + p.replace("\\", "\\\\").replace("'", "\\'") + "']" for p in self.path)
        return "$" + "".join(steps)


def as_object(col: str) -> Column:
    """The text as a variant if it is a JSON object, else null."""
    v = F.try_parse_json(F.col(col))
    return F.when(F.schema_of_variant(v).startswith("OBJECT<"), v)


def nested_schema(df: DataFrame, col: str) -> T.StructType:
    """The merged type of all objects in a text column; what isn't an object says nothing.

    Integers come as ``bigint``, other numbers as ``double``.  The driver sees one text, the schema.
    """
    merged = df.select(as_object(col).alias("v")).agg(F.schema_of_variant_agg("v")).head()[0]
    return _parsed(merged) if merged and merged.startswith("OBJECT<") else T.StructType([])


def _parsed(text: str) -> T.DataType:
    """Spark's description of a variant's type as a type: VARIANT and VOID stand for values without a common type, or only nulls."""
    name = r"`(?:[^`]|``)*`|[^\s:<>,`]+"
    tokens = re.findall(rf"OBJECT<|ARRAY<|DECIMAL\([0-9]+,\s*-?[0-9]+\)|{name}|[:,<>]", text)
    at = 0

    def take() -> str:
        nonlocal at
        at += 1
        return tokens[at - 1]

    def one() -> T.DataType:
        token = take()
        if token == "ARRAY<":
            inner = one()
            take()
            return T.ArrayType(inner)
        if token == "OBJECT<":
            fields = []
            while tokens[at] != ">":
                if tokens[at] == ",":
                    take()
                key = take()
                take()  # the colon
                fields.append(T.StructField(key[1:-1].replace("``", "`") if key.startswith("`") else key, one()))
            take()
            return T.StructType(fields)
        if token.startswith("DECIMAL") or token in ("DOUBLE", "FLOAT"):
            return T.DoubleType()
        return {"BIGINT": T.LongType(), "BOOLEAN": T.BooleanType(), "STRING": T.StringType()}.get(token, T.VariantType())

    return one()


def _mixed(t: T.DataType) -> bool:
    if isinstance(t, T.ArrayType):
        return _mixed(t.elementType)
    if isinstance(t, T.StructType):
        return any(_mixed(f.dataType) for f in t.fields)
    return isinstance(t, T.VariantType)


def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[Leaf]:
    """Every path to a value, in the order of keys; arrays are values."""
    out = []
    for f in sorted(schema.fields, key=lambda f: f.name):
        here = (*path, f.name)
        if isinstance(f.dataType, T.StructType) and f.dataType.fields:
            out += leaves(f.dataType, here)
        else:
            out.append(Leaf(here, None if _mixed(f.dataType) or isinstance(f.dataType, T.StructType) else f.dataType))
    return out


def nested_columns(df: DataFrame, col: str, *, schema: T.StructType | None = None, prefix: str = "", rest: str = "rest", max_columns: int = MAX_COLUMNS) -> DataFrame:
    """``df`` with a typed column for each path of the objects in the text column ``col``, and ``rest`` for what has none.

    Columns are named by their path, joined by ``_``, behind ``prefix``; a name that is taken raises.  A missing value is null, and so are all where
    the text is no object.  ``rest`` maps the paths of values without a common type, and of those beyond ``max_columns``, to the values as variants.
    """
    found = leaves(schema if schema is not None else nested_schema(df, col))
    typed = [x for x in found if x.type is not None][:max_columns]
    others = [x for x in found if x not in typed]
    names = [prefix + x.name for x in typed]
    taken = {n for n in names if names.count(n) > 1 or n in df.columns} | ({rest} & {*df.columns, *names})
    if taken:
        raise ValueError(f"Column names in use: {sorted(taken)}; give another prefix or name for the rest")
    held = "__object"
    rows = df.withColumn(held, as_object(col))
    cells = [F.try_variant_get(held, x.json_path, x.type.simpleString()).alias(n) for x, n in zip(typed, names, strict=True)]
    kind = "map<string,variant>"
    pairs = [F.struct(F.lit(".".join(x.path)).alias("k"), F.try_variant_get(held, x.json_path, "variant").alias("v")) for x in others]
    left = F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["v"].isNotNull())) if pairs else F.lit(None).cast(kind)
    return rows.select(*[F.col(f"`{c}`") for c in df.columns], *cells, left.cast(kind).alias(rest))
