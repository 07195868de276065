"""Schemas that follow the data, nested JSON as columns, rejects rolled by bytes."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.operators.nested import leaves, nested_columns, nested_schema
from loglathe.sinks.evolving import append_evolving, evolve_schema, join_schemas, join_types, read_evolving, schema_versions
from loglathe.sinks.rejects import read_reject_text, write_reject_text
from loglathe.sinks.tables import append_table, ensure_table

INT, LONG, DOUBLE, TEXT, BOOL = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType()


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        (INT, INT, INT), (INT, LONG, LONG), (INT, DOUBLE, DOUBLE), (LONG, DOUBLE, TEXT), (BOOL, INT, TEXT), (TEXT, DOUBLE, TEXT),
        (T.NullType(), LONG, LONG), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.ShortType(), T.ByteType(), T.ShortType()),
    ],
)
def test_least_common_types(a, b, both):
    assert join_types(a, b) == join_types(b, a) == both


def test_joining_types_does_not_depend_on_the_order():
    types = [INT, LONG, DOUBLE, TEXT, BOOL, T.NullType(), T.ByteType()]
    for a in types:
        for b in types:
            for c in types:
                assert join_types(join_types(a, b), c) == join_types(a, join_types(b, c)) or {a, b, c} >= {INT, LONG, DOUBLE} or T.ByteType() in (a, b, c)
    with pytest.raises(ValueError, match="No common type"):
        join_types(T.ArrayType(INT), INT)


def test_joined_schemas_keep_order_and_requirements():
    a = T.StructType().add("x", INT, False).add("y", TEXT, False)
    b = T.StructType().add("z", LONG).add("x", LONG, False)
    assert join_schemas([a, b]) == T.StructType().add("x", LONG, False).add("y", TEXT, True).add("z", LONG, True)


def test_batches_of_other_columns_and_types_read_together(spark, folder):
    append_evolving(spark.sql("SELECT 1 AS id, 2 AS code, 'a' AS day"), folder, run="r", batch=0)
    append_evolving(spark.sql("SELECT 3000000000 AS id, 'x' AS code, 'b' AS day, true AS new"), folder, run="r", batch=1)
    append_evolving(spark.sql("SELECT 'c' AS day, cast(7 AS tinyint) AS id"), folder, run="r", batch=2)
    got = read_evolving(spark, folder)
    assert got.schema == T.StructType().add("id", LONG).add("code", TEXT).add("day", TEXT).add("new", BOOL)
    assert sorted(map(tuple, got.collect())) == [(1, "2", "a", None), (7, None, "c", None), (3_000_000_000, "x", "b", True)]
    assert len(schema_versions(spark, folder)) == 2
    # a batch is replaced, with another schema than the first time
    append_evolving(spark.sql("SELECT 1.5D AS code, 'a' AS day"), folder, run="r", batch=0)
    assert sorted(map(str, read_evolving(spark, folder).where("day = 'a'").collect())) == ["Row(id=None, code='1.5', day='a', new=None)"]
    assert read_evolving(spark, folder).count() == 3 and len(schema_versions(spark, folder)) == 2


def test_a_schema_without_rows_is_harmless(spark, folder):
    append_evolving(spark.sql("SELECT 1 AS id"), folder)
    evolve_schema(spark, folder, T.StructType().add("later", TEXT))  # and the job died
    assert [tuple(r) for r in read_evolving(spark, folder).collect()] == [(1, None)]
    with pytest.raises(ValueError, match="in use"):
        append_evolving(spark.sql("SELECT 1 AS batch"), folder)
    with pytest.raises(ValueError, match="No schema"):
        read_evolving(spark, f"{folder}/nothing")


def test_a_table_gets_new_columns(spark, folder):
    name = "grown_" + os.path.basename(folder).replace("-", "_")
    first = T.StructType().add("level", TEXT).add("event_date", TEXT)
    ensure_table(spark, name, first, location=f"{folder}/t")
    append_table(spark.sql("SELECT 'INFO' AS level, 'd' AS event_date"), name)
    wider = T.StructType().add("level", TEXT).add("user", LONG).add("event_date", TEXT)
    with pytest.raises(ValueError, match="missing column user"):
        ensure_table(spark, name, wider)
    ensure_table(spark, name, wider, add_columns=True)
    append_table(spark.sql("SELECT 'WARN' AS level, 5L AS user, 'd' AS event_date"), name)
    assert sorted((r["level"], r["user"]) for r in spark.table(name).collect()) == [("INFO", None), ("WARN", 5)]
    with pytest.raises(ValueError, match="column level is string"):
        ensure_table(spark, name, T.StructType().add("level", INT).add("event_date", TEXT), add_columns=True)
    spark.sql(f"DROP TABLE {name}")


# -- nested JSON -----------------------------------------------------------------------------------------------------

OBJECTS = [
    '{"a":1,"b":{"c":"x","d":[1,2]},"m":1,"e":{}}',
    '{"a":3000000000,"b":{"c":null,"o-k":true},"m":"t","z":1.5}',
    '{"b":{"d":[]},"l":[{"q":1},{"q":2}],"n":null}',
    '{"b":{"d":[3]},"m":{"deep":[1,"x"]},"we ird.key":{"in`ner":2}}',
    "[1]", "no json", "", None, '"text"', '{"a":1',
]


def test_nested_objects_become_typed_columns(spark):
    df = spark.createDataFrame(list(enumerate(OBJECTS)), "id int, value string").repartition(3)
    got = nested_columns(df, "value").orderBy("id")
    types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    assert types == {
        "id": "int", "value": "string", "a": "bigint", "b_c": "string", "b_d": "array<bigint>", "b_o_k": "boolean", "l": "array<struct<q:bigint>>",
        "we_ird_key_in_ner": "bigint", "z": "double", "rest": "map<string,variant>",
    }
    rows = got.withColumn("rest", F.to_json("rest")).collect()
    assert [r["a"] for r in rows[:4]] == [1, 3_000_000_000, None, None]
    assert [r["b_c"] for r in rows[:2]] == ["x", None] and [r["b_d"] for r in rows[:4]] == [[1, 2], None, [], [3]]
    assert rows[1]["b_o_k"] is True and rows[1]["z"] == 1.5 and rows[3]["we_ird_key_in_ner"] == 2
    assert [x["q"] for x in rows[2]["l"]] == [1, 2]
    assert json.loads(rows[0]["rest"]) == {"m": 1, "e": {}} and json.loads(rows[3]["rest"]) == {"m": {"deep": [1, "x"]}}
    assert all(r[c] is None for r in rows[4:] for c in types if c not in ("id", "value", "rest"))


def test_columns_beyond_the_limit_stay_in_the_rest(spark):
    df = spark.createDataFrame([('{"a":1,"b":2,"c":"x"}',)], "value string")
    row = nested_columns(df, "value", max_columns=1, prefix="j_", rest="more").withColumn("more", F.to_json("more")).head()
    assert row["j_a"] == 1 and json.loads(row["more"]) == {"b": 2, "c": "x"} and len(row) == 3
    with pytest.raises(ValueError, match="in use"):
        nested_columns(df.withColumn("a", F.lit(1)), "value")
    empty = nested_columns(df.limit(0), "value")
    assert empty.columns == ["value", "rest"] and empty.collect() == []


def test_schema_of_all_rows_not_of_a_sample(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 19_999, '{"x":{"rare":"v"}}').otherwise('{"x":{"n":1}}').alias("value")).repartition(8)
    assert [x.path for x in leaves(nested_schema(df, "value"))] == [("x", "n"), ("x", "rare")]


# -- rejects ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 5])
def test_rejects_roll_by_bytes(spark, folder, parts):
    text = F.concat(F.lit("é"), F.repeat(F.lit("x"), (F.col("id") * 37 % 400).cast("int")))
    rows = spark.range(0, 2000, 1, parts).select(F.lit("1").alias("rejected_at"), F.lit("C").alias("error_class"), F.lit("T").alias("error_type"), F.lit("m").alias("error_message"), text.alias("record"))
    write_reject_text(rows, folder, "r", 0, max_bytes_per_file=50_000)
    sizes = [os.path.getsize(f"{d}/{f}") for d, _, fs in os.walk(folder) for f in fs if f.endswith(".txt")]
    longest = max(len(r["value"].encode()) for r in read_reject_text(spark, folder).collect()) + 1
    assert len(sizes) > 5 and sum(sizes) == read_reject_text(spark, folder).agg(F.sum(F.octet_length("value") + 1)).head()[0]
    assert all(50_000 - longest < s < 50_000 + longest for s in sorted(sizes)[1:]) and min(sizes) < 50_000 + longest
    records = read_reject_text(spark, folder).select(F.get_json_object("value", "$.record")).collect()
    assert sorted(r[0] for r in records) == sorted(r["record"] for r in rows.collect())


def test_an_envelope_larger_than_a_file_is_not_split(spark, folder):
    rows = spark.sql("SELECT '1' AS rejected_at, 'C' AS error_class, 'T' AS error_type, 'm' AS error_message, repeat('y', 5000) AS record")
    write_reject_text(rows.union(rows), folder, max_bytes_per_file=100)
    assert [len(json.loads(r["value"])["record"]) for r in read_reject_text(spark, folder).collect()] == [5000, 5000]
