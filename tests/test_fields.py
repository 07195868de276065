import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.functions.casts import cast_as, cast_text, int_field, spark_type, string_field
from loglathe.functions.text import drop_empty_json, mask_from, mask_json_values
from loglathe.operators.infer import infer_schema, inferred_struct
from loglathe.operators.parse import parse_lines
from loglathe.operators.route import reject_envelope, rejects, replay_rejects
from loglathe.operators.shape import GENERIC_COLUMNS, cast_fields, event_date, event_time, generic_schema, shape_rows


def column(spark, values, expr):
    df = spark.createDataFrame(list(enumerate(values)), "n int, v string").coalesce(1)
    return [r[0] for r in df.orderBy("n").select(expr(F.col("v"))).collect()]


def test_int_and_string_getters(spark):
    values = ["8080", "not-a-number", None, " 8 ", "-7", "+7", "2147483648", "1.5", "", "8\n", "007"]
    assert column(spark, values, int_field) == [8080, 0, 0, 0, -7, 7, 0, 0, 0, 0, 7]
    assert column(spark, ["a", None, ""], string_field) == ["a", "", ""]


def test_type_names():
    expected = {"String": "string", "INT": "int", "long": "bigint", "Boolean": "boolean", "double": "double"}
    assert {n: spark_type(n).simpleString() for n in expected} == expected
    with pytest.raises(ValueError, match="Unsupported type: unsupported_type"):
        spark_type("unsupported_type")


def test_cast_fields(spark):
    df = spark.createDataFrame([("1", "x", "true", "2.5", "7")], "a string, b string, c string, d string, e string")
    got = cast_fields(df, {"a": "int", "b": "int", "c": "boolean", "d": "double", "e": "long"})
    assert got.head() == (1, None, True, 2.5, 7)
    assert [f.dataType.simpleString() for f in got.schema] == ["int", "int", "boolean", "double", "bigint"]
    with pytest.raises(ValueError, match="No such field"):
        cast_fields(df, {"z": "int"})


def test_casts_take_what_spark_takes(spark):
    """The look at the text before a cast changes no result."""
    values = [" 8 ", "8", "+8", "-8", "1.5", "abc", "", None, "2147483648", "9223372036854775808", "1e3", ".5", "5.", "1d",
              "NaN", "Infinity", "-inf", "yes", "T", "0", " true ", "on", "0x1F", "1_000", "٨", "1e", "\t7\n"]
    for name in ("int", "long", "double", "boolean"):
        plain = column(spark, values, lambda c, n=name: c.try_cast(spark_type(n)).cast("string"))
        assert column(spark, values, lambda c, n=name: cast_as(c, n).cast("string")) == plain
        assert column(spark, values, lambda c, n=name: F.expr(cast_text("v", n)).cast("string")) == plain


def test_mask_from(spark):
    assert column(spark, ["test1234", None, "", "abc"], lambda c: mask_from(c, 4)) == ["test****", None, "", "abc"]
    assert column(spark, ["test"], lambda c: mask_from(c, 10)) == ["test"]
    assert column(spark, ["test", ""], lambda c: mask_from(c, 0)) == ["****", ""]
    with pytest.raises(ValueError):
        mask_from(F.lit("x"), -1)


def test_mask_json_values(spark):
    cases = {
        '{"vuid":"abc123def456", "other":"value"}': '{"vuid":"abc*********", "other":"value"}',
        '{"vp_id":"xyz789", "other":"value"}': '{"vp_id":"xyz***", "other":"value"}',
        '{"vuid":"abc123", "vp_id":"xyz789"}': '{"vuid":"abc***", "vp_id":"xyz***"}',
        '{"normal":"value"}': '{"normal":"value"}',
        '{"vuid": "abc123"}': '{"vuid": "abc***"}',  # a blank after the colon
        '{"vuid":"abcd"},{"vuid":"efgh"}': '{"vuid":"abc*"},{"vuid":"efg*"}',  # every occurrence
        '{"vuid":"ab","x":"long text"}': '{"vuid":"ab","x":"long text"}',  # short values stay
        '{"vuid":"","x":"abcdef"}': '{"vuid":"","x":"abcdef"}',
        '{"vuid":123456}': '{"vuid":123***}',
        '{"vuid" : "abcdefgh"}': '{"vuid" : "abc*****"}',
        r'{"vuid":"a\"bcdefgh"}': r'{"vuid":"a\"b******"}',
        r'{"vuid":"abc\"d\\","x":"abcdef"}': '{"vuid":"abc***","x":"abcdef"}',
        '{"vuid":-1.25e7,"n":12345}': '{"vuid":-1.****,"n":12345}',
        "": "",
    }
    assert column(spark, list(cases), mask_json_values) == list(cases.values())
    assert column(spark, [None], mask_json_values) == [None]


def test_drop_empty_json(spark):
    cases = {
        '{"a":1,"b":null,"c":"","d":"  ","e":"x"}': '{"a":1,"e":"x"}',
        '{"n":{"x":null},"l":[],"f":1.5,"t":true}': '{"n":{"x":null},"l":[],"f":1.5,"t":true}',
        "{}": "{}",
        '{"a":': None,
        '{"a":1}{"b":2}': None,
        '[{"a":1}]': None,
        "": None,
        '{"tab":"\\t\\n","z":0}': '{"z":0}',
        '{"n":12345678901234567890123456789012345678901234567890,"b":null,"s":"1e5"}':
            '{"n":12345678901234567890123456789012345678901234567890,"s":"1e5"}',
        '{"e":1e400,"x":"1e400"}': None,
        '{"x":"1e400","y":1e300,"z":""}': '{"x":"1e400","y":1.0E300}',
    }
    assert column(spark, list(cases), drop_empty_json) == list(cases.values())


def test_event_dates(spark):
    cases = [
        ("application", "2024-01-15T23:30:00.123-07:00", None, "2024-01-15"),
        ("access", "15/Jan/2024:23:30:00 -0700", None, "2024-01-15"),
        ("syslog", "Jan 15 10:30:00", 2023, "2023-01-15"),
        ("syslog", "Feb  3 10:30:00", 2024, "2024-02-03"),
        ("nginx_error", "2024/01/15 10:30:00", None, "2024-01-15"),
    ]
    for fmt, text, year, expected in cases:
        assert column(spark, [text], lambda c, f=fmt, y=year: event_date(c, f, y)) == [expected]
    short = {
        "application": "2024-1-5T10:30:00Z", "access": "5/Jan/2024:10:30:00 +0000", "nginx_error": "2024/1/5 10:30:00",
        "custom_app": "2024-01-5 10:30:00",
    }
    for fmt, text in short.items():
        assert column(spark, [text], lambda c, f=fmt: event_date(c, f)) == ["2024-01-05"]
    unread = ["2024-13-45T00:00:00Z", "24-01-15T00:00:00Z", "", None]
    assert column(spark, unread, lambda c: event_date(c, "application")) == ["unknown"] * 4
    today = spark.sql("SELECT date_format(current_date(), 'yyyy-MM-dd')").head()[0]
    assert column(spark, unread, lambda c: event_date(c, "application", undated="today")) == [today] * 4


def test_years_of_stamps_without_one(spark):
    """This year, or the last for a date still to come."""
    days = spark.sql("SELECT date_add(current_date(), d) AS d FROM VALUES (-200), (-1), (0), (2), (100) AS t(d)").collect()
    texts = [r["d"].strftime("%b %d 10:30:00") for r in days]
    today = days[2]["d"]
    expected = []
    for r in days:
        d = r["d"].replace(year=today.year)
        expected.append((d if d <= today + datetime.timedelta(days=1) else d.replace(year=today.year - 1)).isoformat())
    assert column(spark, texts, lambda c: event_date(c, "syslog")) == expected
    assert column(spark, texts, lambda c: F.date_format(event_time(c, "syslog"), "yyyy-MM-dd")) == expected


def test_event_times(spark):
    cases = [
        ("application", "2024-01-15T23:30:00.123-07:00", None, "2024-01-16 06:30:00.123"),
        ("custom_app", "2024-01-15 10:30:00,500", None, "2024-01-15 10:30:00.500"),
        ("access", "15/Jan/2024:23:30:00 -0700", None, "2024-01-16 06:30:00.000"),
        ("syslog", "Feb  3 10:30:00", 2024, "2024-02-03 10:30:00.000"),
        ("nginx_error", "2024/01/15 10:30:00", None, "2024-01-15 10:30:00.000"),
        ("application", "2024-13-45T00:00:00Z", None, None),
    ]
    for fmt, text, year, expected in cases:

        def at(c, f=fmt, y=year):
            return F.date_format(event_time(c, f, y), "yyyy-MM-dd HH:mm:ss.SSS")

        assert column(spark, [text], at) == [expected]


def test_rows_are_shaped_by_name(spark):
    lines = ["2024-01-15T10:30:00.123Z INFO started", "bad", ""]
    parsed = parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), "application")
    rows = shape_rows(parsed, "application", columns=["message", "missing", "timestamp"], event_date_from="timestamp")
    assert rows.columns == ["message", "missing", "timestamp", "event_date"]
    assert rows.collect() == [("started", "", "2024-01-15T10:30:00.123Z", "2024-01-15")]
    today = spark.sql("SELECT date_format(current_date(), 'yyyy-MM-dd')").head()[0]
    assert shape_rows(parsed, "application", columns=GENERIC_COLUMNS).head()["event_date"] == today
    masked = shape_rows(parsed, "application", columns=["message"], mask={"message": 2}).head()
    assert masked["message"] == "st*****"


def test_generic_schema():
    schema = generic_schema()
    assert schema.names == ["timestamp", "level", "message", "event_date"]
    assert all(isinstance(f.dataType, T.StringType) and not f.nullable for f in schema)


def test_schema_inference(spark):
    rows = [({"user_id": "12345", "count": "42", "status": "active"},), ({"count": "007"},), ({"user_id": "3000000000"},)]
    df = spark.createDataFrame(rows, "fields map<string,string>")
    declared = inferred_struct(infer_schema(df, declared={"count": "int"}))
    assert [(f.name, f.dataType.simpleString(), f.nullable) for f in declared] == [
        ("count", "int", False), ("status", "string", False), ("user_id", "string", False), ("event_date", "string", False),
    ]
    by_value = {r["name"]: r["type"] for r in infer_schema(df.limit(1), by_value=True).collect()}
    assert by_value == {"user_id": "int", "count": "int", "status": "string", "event_date": "string"}
    assert {r["name"]: r["type"] for r in infer_schema(df, by_value=True).collect()}["count"] == "string"


def test_rejects_round_trip(spark):
    odd = 'a "quote" \\ back\tslash \x02 ünï'
    df = spark.createDataFrame([(odd,), ("",), ("x" * 10_001,), ("2024-01-15T10:30:00Z INFO fine",)], "value string")
    table = rejects(parse_lines(df, "application"))
    assert {(r["error_class"], r["error_type"]) for r in table.collect()} == {
        ("PARSE_ERROR", "NO_MATCH"), ("PARSE_ERROR", "TOO_LONG"),
    }
    envelopes = reject_envelope(table)
    assert spark.createDataFrame(envelopes.collect(), "value string").select(
        F.json_object_keys("value").alias("k")
    ).distinct().collect() == [(["timestamp", "errorType", "errorMessage", "record"],)]
    again = replay_rejects(envelopes, "%{WORD:first} %{GREEDYDATA:rest}").where("status = 'OK'").collect()
    assert [r["value"] for r in again] == [odd]
    assert again[0]["fields"]["first"] == "a" and again[0]["rejected_at"].isdigit()
