"""Value tests: documented example lines and difficult ones."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.functions.patterns import compile_pattern
from loglathe.operators.parse import (
    check_patterns,
    drop_blank,
    drop_oversize,
    fields_map,
    flatten,
    grok,
    parse_json_lines,
    parse_lines,
    parse_multi_format,
)
from loglathe.plans.formats import FORMATS

APP = "2024-01-15T10:30:00.123Z INFO Application started successfully"


def test_application_line(parse_all):
    (good, fields), (bad, _), (blank, _), (null, _) = parse_all(
        [APP, "This is not a valid log format", "", None], "application"
    )
    assert (good, bad, blank, null) == ("OK", "NO_MATCH", "BLANK", "BLANK")
    assert fields == {
        "timestamp": "2024-01-15T10:30:00.123Z",
        "level": "INFO",
        "message": "Application started successfully",
    }


@pytest.mark.parametrize(
    ("line", "level", "message"),
    [
        ("2024-01-15T10:30:01.456Z WARN Database connection pool is running low", "WARN", "Database connection pool is running low"),
        ("2024-01-15T10:30:02.789Z ERROR Failed to process request: timeout exceeded", "ERROR", "Failed to process request: timeout exceeded"),
        ("2024-01-15T10:30:03.012Z INFO Request processed in 150ms", "INFO", "Request processed in 150ms"),
    ],
)
def test_generic_samples(parse_all, line, level, message):
    for fmt in ("application", "loglevel"):
        status, fields = parse_all([line], fmt)[0]
        assert (status, fields["level"], fields["message"]) == ("OK", level, message)


def test_loglevel_is_strict(parse_all):
    line = "2024-01-15T10:30:00Z LOUD hello"
    assert parse_all([line], "application")[0][0] == "OK"
    assert parse_all([line], "loglevel")[0][0] == "NO_MATCH"


def test_access_without_and_with_agent(parse_all):
    common = '127.0.0.1 - - [10/Oct/2024:13:55:36 -0700] "GET /index.html HTTP/1.1" 200 2326'
    full = common + ' "http://a.example/\\"q\\"" "Mozilla/5.0 (X11)"'
    unsent = '10.0.0.1 - bob [10/Oct/2024:13:55:38 -0700] "-" 408 -'
    (s1, plain), (s2, rich), (s3, raw) = parse_all([common, full, unsent], "access")
    assert (s1, s2, s3) == ("OK", "OK", "OK")
    assert plain == {
        "clientip": "127.0.0.1", "ident": "-", "auth": "-", "timestamp": "10/Oct/2024:13:55:36 -0700", "verb": "GET",
        "request": "/index.html", "httpversion": "1.1", "rawrequest": None, "response": "200", "bytes": "2326",
        "referrer": None, "agent": None,
    }
    assert rich["referrer"] == '"http://a.example/\\"q\\""' and rich["agent"] == '"Mozilla/5.0 (X11)"'
    assert (raw["verb"], raw["rawrequest"], raw["response"], raw["bytes"], raw["auth"]) == (None, "-", "408", None, "bob")
    assert [s for s, _ in parse_all([common, full], "access_combined")] == ["NO_MATCH", "OK"]


def test_access_samples(parse_all):
    got = parse_all(
        [
            '192.168.1.1 - - [10/Oct/2024:13:55:37 -0700] "POST /api/data HTTP/1.1" 201 512',
            '10.0.0.1 - - [10/Oct/2024:13:55:38 -0700] "GET /health HTTP/1.1" 200 15',
            'fe80::1 - - [10/Oct/2024:13:55:38 -0700] "GET /health HTTP/1.1" 200 15',
        ],
        "access",
    )
    assert [(f["clientip"], f["verb"], f["request"], f["response"], f["bytes"]) for _, f in got] == [
        ("192.168.1.1", "POST", "/api/data", "201", "512"),
        ("10.0.0.1", "GET", "/health", "200", "15"),
        ("fe80::1", "GET", "/health", "200", "15"),
    ]


def test_syslog(parse_all):
    got = parse_all(
        [
            "Jan 15 10:30:00 server1 app[1234]: User login successful",
            "Jan 15 10:30:00 server1 sshd[12345]: Accepted publickey for admin from 192.168.1.100",
            "Feb  3 01:02:03 server1 cron: ran",
            "Feb  3 01:02:03 <3.4> server1 cron: ran",
        ],
        "syslog",
    )
    assert [s for s, _ in got] == ["OK"] * 4
    assert got[0][1] == {
        "timestamp": "Jan 15 10:30:00", "facility": None, "priority": None, "logsource": "server1", "program": "app",
        "pid": "1234", "message": "User login successful",
    }
    assert (got[1][1]["program"], got[1][1]["pid"]) == ("sshd", "12345")
    assert (got[2][1]["pid"], got[2][1]["timestamp"]) == (None, "Feb  3 01:02:03")
    assert (got[3][1]["facility"], got[3][1]["priority"]) == ("3", "4")


def test_nginx_error_and_documented_template(parse_all):
    line = "2024/01/15 10:30:00 [error] 12345#12345: *1 connect() failed (111: Connection refused)"
    assert parse_all([line], "nginx_error") == [
        ("OK", {"timestamp": "2024/01/15 10:30:00", "level": "error", "pid": "12345",
                "message": "*1 connect() failed (111: Connection refused)"})
    ]
    documented = r"%{YEAR}/%{MONTHNUM}/%{MONTHDAY} %{TIME} \[%{LOGLEVEL:level}\] %{GREEDYDATA:message}"
    assert parse_all([line], documented)[0][1] == {
        "level": "error",
        "message": "12345#12345: *1 connect() failed (111: Connection refused)",
    }


def test_custom_app(parse_all):
    line = "[2024-01-15 10:30:00.123] [INFO] [UserService] User login successful - userId=12345"
    assert parse_all([line], "custom_app")[0] == (
        "OK",
        {"timestamp": "2024-01-15 10:30:00.123", "level": "INFO", "service": "UserService",
         "message": "User login successful - userId=12345"},
    )


def test_documented_templates_with_data_number_and_user(parse_all):
    assert parse_all(
        ["2024-01-15T10:30:00Z [main] INFO a.B - started"],
        r"%{TIMESTAMP_ISO8601:timestamp} \[%{DATA:thread}\] %{LOGLEVEL:level} %{DATA:logger} - %{GREEDYDATA:message}",
    )[0][1] == {"timestamp": "2024-01-15T10:30:00Z", "thread": "main", "level": "INFO", "logger": "a.B", "message": "started"}
    assert parse_all(["1.2.3.4 GET 12.5"], "%{IP:client_ip} %{WORD:method} %{NUMBER:response_time}")[0][1] == {
        "client_ip": "1.2.3.4", "method": "GET", "response_time": "12.5",
    }
    optional = "%{IP:ip} (?:%{USER:user})? %{GREEDYDATA:message}"
    got = parse_all(["1.2.3.4 bob hello", "1.2.3.4  hello", "1.2.3.4 bob "], optional)
    assert [(f["user"], f["message"]) for _, f in got] == [("bob", "hello"), (None, "hello"), ("bob", "")]


def test_json_lines(parse_all):
    got = parse_all(
        [
            '{"timestamp":"2024-01-15T10:30:00Z","level":"INFO","service":"api","message":"Request processed"}',
            '{"timestamp":"2024-01-15T10:30:00Z","level":"INFO"',
            "[1,2]",
            '"text"',
            " \t ",
            "{}",
        ],
        "json",
    )
    assert [s for s, _ in got] == ["OK", "BAD_JSON", "BAD_JSON", "BAD_JSON", "BLANK", "OK"]
    assert got[0][1] == {
        "timestamp": "2024-01-15T10:30:00Z", "level": "INFO", "service": "api", "message": "Request processed",
        "json_data": '{"timestamp":"2024-01-15T10:30:00Z","level":"INFO","service":"api","message":"Request processed"}',
    }
    assert got[5][1]["level"] is None and got[1][1]["level"] is None


def test_nothing_behind_a_json_object_is_lost(parse_all):
    lines = ['{"level":"I"} xyz', '{"level":"I"}{"level":"W"}', '{"level":"I"},{"level":"W"}', '{"level":"I"}]',
             '{"level":"I"}],[{"level":"W"}', '[{"level":"I"},{"level":"W"}]', '{"level":"I",}']
    assert {s for s, _ in parse_all(lines, "json")} == {"BAD_JSON"}
    got = parse_all([' \t{"level":5,"message":{"a":1}} ', '{"level":null}'], "json")
    assert [(s, f["level"], f["message"]) for s, f in got] == [("OK", "5", '{"a":1}'), ("OK", None, None)]


def test_json_fields_with_types(spark):
    df = spark.createDataFrame([('{"n":5}',), ('{"n":"x"}',)], "value string")
    got = parse_json_lines(df, T.StructType([T.StructField("n", T.IntegerType())])).collect()
    assert [(r["status"], r["fields"]["n"]) for r in got] == [("OK", 5), ("BAD_JSON", None)]


def test_json_captured_whole(spark):
    line = '{"a":1}'
    df = grok(spark.createDataFrame([(line,), ("  ",)], "value string"), FORMATS["json"].pattern)
    assert [(r["status"], r["fields"]["json_data"]) for r in df.collect()] == [("OK", line), ("BLANK", None)]


def test_difficult_lines(parse_all):
    mark = "\u0001"
    got = parse_all(
        [
            f"2024-01-15T10:30:00Z INFO a{mark}b",  # holds the mark itself
            f"nothing{mark}here{mark}at{mark}all",
            "prefix 2024-01-15T10:30:00Z INFO text behind a prefix",
            "2024-01-15T10:30:00Z INFO ",  # empty last field
            r"2024-01-15T10:30:00Z INFO $1 \2 ${f0}",
            "2024-01-15T10:30:00Z INFO first\nsecond",  # a field ends with its line
            "2024-01-15T10:30:00Z INFO \"q\" \t\x02 ünïcödé \U0001f600",
        ],
        "application",
    )
    assert [s for s, _ in got] == ["OK", "NO_MATCH", "OK", "OK", "OK", "OK", "OK"]
    assert [f["message"] for _, f in got] == [
        f"a{mark}b", None, "text behind a prefix", "", r"$1 \2 ${f0}", "first", "\"q\" \t\x02 ünïcödé \U0001f600",
    ]


def test_single_field_template_knows_a_miss(parse_all):
    got = parse_all(["id=7", "none", "id=\u0001 id=8"], "id=%{INT:n:int}")
    assert got == [("OK", {"n": 7}), ("NO_MATCH", {"n": None}), ("OK", {"n": 8})]


def test_length_limit_counts_utf16_units(parse_all, spark):
    head = "2024-01-15T10:30:00Z INFO "
    fits = head + "x" * (10_000 - len(head))
    wide = head + "\U0001f600" * 4_990  # under 10,000 characters, over 10,000 UTF-16 units
    euro = head + "€" * (10_000 - len(head))  # three bytes each, one unit each
    assert [s for s, _ in parse_all([fits, fits + "x", wide, euro], "application")] == ["OK", "TOO_LONG", "TOO_LONG", "OK"]
    df = spark.createDataFrame([(fits,), (fits + "x",), (wide,), (None,)], "value string")
    assert [r[0] for r in drop_oversize(df).collect()] == [fits]


def test_blank_lines(spark):
    df = spark.createDataFrame([("",), (" \t\x00\x1f",), (None,), (" ",), ("a",)], "value string")
    assert [r[0] for r in drop_blank(df).collect()] == [" ", "a"]


def test_several_formats_in_one_scan(spark):
    rows = [
        ("app", APP),
        ("web", '127.0.0.1 - - [10/Oct/2024:13:55:36 -0700] "GET / HTTP/1.1" 200 -'),
        ("sec", "2024-01-15T10:30:00Z login bob from home"),
        ("app", "nope"),
        ("other", APP),
        ("web", "   "),
        (None, APP),
    ]
    formats = {
        "app": "application",
        "web": "access",
        "sec": "%{TIMESTAMP_ISO8601:timestamp} %{DATA:event_type} %{DATA:user} %{GREEDYDATA:details}",
    }
    got = parse_multi_format(spark.createDataFrame(rows, "log_type string, value string"), formats).collect()
    assert [r["status"] for r in got] == ["OK", "OK", "OK", "NO_MATCH", "NO_MATCH", "BLANK", "NO_MATCH"]
    assert got[0]["fields"]["level"] == "INFO"
    assert "bytes" not in got[1]["fields"] and got[1]["fields"]["response"] == "200"
    assert got[2]["fields"] == {
        "timestamp": "2024-01-15T10:30:00Z", "event_type": "login", "user": "bob", "details": "from home",
    }
    with pytest.raises(ValueError, match="Invalid log type"):
        parse_multi_format(spark.createDataFrame(rows, "log_type string, value string"), {"a b": "application"})


def test_json_among_several_formats_keeps_every_key(spark):
    line = '{"level":"INFO","user_id":7,"trace":"x"}'
    rows = [("js", line), ("js", '{"level":"INFO"'), ("js", "[1]"), ("app", line), ("js", " "), ("js", "{" + "x" * 10_000)]
    df = spark.createDataFrame(rows, "log_type string, value string")
    got = parse_multi_format(df, {"js": "json", "app": "application"}).collect()
    assert [r["status"] for r in got] == ["OK", "BAD_JSON", "BAD_JSON", "NO_MATCH", "BLANK", "TOO_LONG"]
    assert got[0]["fields"] == {"level": "INFO", "json_data": line}
    only = parse_multi_format(df, {"js": "json"}).collect()
    assert [r["status"] for r in only[:3]] == ["OK", "BAD_JSON", "BAD_JSON"]


def test_fields_map_drops_absent_fields(spark):
    df = parse_lines(spark.createDataFrame([("Feb  3 01:02:03 s cron: ran",)], "value string"), "syslog")
    assert fields_map(df).head()["fields"] == {
        "timestamp": "Feb  3 01:02:03", "logsource": "s", "program": "cron", "message": "ran",
    }


@pytest.mark.parametrize("text", ["a." * 5000, "x" * 10_000, "/" * 10_000, '1.1.1.1 - - [' + '"\\"' * 3000, ":" * 9_999])
def test_long_odd_lines_do_not_break_the_task(parse_all, text):
    for fmt in ("access", "syslog", "application"):
        assert parse_all([text], fmt)[0][0] == "NO_MATCH"
    assert parse_all([text], "%{URI:u} %{HOSTNAME:h} %{QS:q}")[0][0] == "NO_MATCH"


def test_a_bad_regex_fails_before_the_job(spark):
    check_patterns(spark, "application", FORMATS["access"], "%{INT:n}")
    with pytest.raises(Exception, match="INVALID_PARAMETER_VALUE"):
        check_patterns(spark, "%{INT:n} (")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_regex_runs_once_per_line_without_python_or_shuffle(spark, folder):
    with open(f"{folder}/a.log", "w") as f:
        f.write(APP + "\n")
    text = spark.read.text(folder)
    for fmt in ("application", "access", "syslog"):
        physical = plan(flatten(parse_lines(text, fmt)).where(F.col("timestamp") > "2024"))
        assert len(re.findall(r"regexp_replace\(", physical)) == 1
        assert "Exchange" not in physical and "Python" not in physical and "Arrow" not in physical


@pytest.mark.parametrize(
    ("template", "regex"),
    [
        ("(?<a>[a1]+)(?<b>.*)", "(?P<a>[a1]+)(?P<b>.*)"),
        ("(?<a>.*?) (?:(?<b>[0-9]+)|(?<c>x+))?", "(?P<a>.*?) (?:(?P<b>[0-9]+)|(?P<c>x+))?"),
        ("(?<a>[^a])", "(?P<a>[^a])"),
        ("(?<a>\u0001*)a(?<b>\u0002?)(?<c>.)", "(?P<a>\u0001*)a(?P<b>\u0002?)(?P<c>.)"),
    ],
)
def test_random_lines_against_a_plain_regex(spark, template, regex):
    """Control characters used as marks, replacement signs and line breaks in every position."""
    rng = random.Random(template)
    lines = ["".join(rng.choices("a1x \u0001\u0002$\\\n\"{}", k=rng.randrange(1, 12))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(lines)), "n int, value string").repartition(4)
    absent = {c.name for c in compile_pattern(template).captures if c.optional}
    for row in grok(df, template).collect():
        line = lines[row["n"]]
        hit = re.search(regex, line)
        if not line.strip("".join(map(chr, range(33)))):
            assert row["status"] == "BLANK"
        elif hit is None:
            assert row["status"] == "NO_MATCH" and not any(row["fields"])
        else:
            expected = {k: (v or None) if k in absent else v for k, v in hit.groupdict().items()}
            assert (row["status"], row["fields"].asDict()) == ("OK", expected), repr(line)
