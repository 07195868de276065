"""Long access lines: the same fields as the whole pattern, in little time."""

import random
import time

import pytest

from loglathe.functions.patterns import NAMED_PATTERNS
from loglathe.operators import parse, skeleton
from loglathe.operators.parse import grok, parse_lines
from loglathe.operators.skeleton import ACCESS, AGENT
from loglathe.plans.formats import FORMATS

DATE = "[10/Oct/2024:13:55:36 +0000]"


def test_skeletons_are_the_documented_patterns():
    assert ACCESS.template == NAMED_PATTERNS["COMMONAPACHELOG"]
    assert NAMED_PATTERNS["COMBINEDAPACHELOG"].removeprefix("%{COMMONAPACHELOG}") == f"(?:{AGENT})?"


def both(spark, monkeypatch, lines, fmt):
    """Status and fields by the skeleton, whatever the length, and by the whole pattern."""
    monkeypatch.setattr(parse, "LONG_LINE", -1)
    df = spark.createDataFrame(list(enumerate(lines)), "n int, value string").coalesce(4)
    cut = parse_lines(df, fmt, max_length=None).orderBy("n").collect()
    whole = grok(df, FORMATS[fmt].pattern, parts=FORMATS[fmt].parts).orderBy("n").collect()
    return cut, whole


def random_line(rng):
    host = lambda: rng.choice(["10.0.0.1", "a.b", "a..b", "-x.y", "x-", "h" * 70, "ab-" * 30, "::1", "fe80::1%eth 0", "fe80::1%e", "1:2:3:4:5:6:7:8", "host.", "h_q.z", "é.b", "x,y.z", ""])
    word = lambda: rng.choice(["-", "u.s-r", "a b", "é", "", "frank", "x\t"])
    date = lambda: rng.choice([DATE, DATE, DATE, "[10/Oct/2024:13:55:36]", "[1/Jan/24:1:02:03 5]", "10/Oct/2024:13:55:36 +0000"])
    request = lambda: rng.choice(['"GET /a HTTP/1.1"', '"GET /a"', '"-"', '""', '"GET /a" 5 "x"', '"GET /\x01 HTTP/1.0"', f'"{DATE} "'])
    end = lambda: rng.choice(["200 5", "200 -", "200", "x 5", "200 5.5", "+1 -2", '200 5 "a" "b"', "200 5 \"a\\\"b\" 'c'", '200 5 "a" b'])
    one = lambda: f"{host()} {word()} {word()} {date()} {request()} {end()}"
    line = rng.choice(["", "", "prefix ", "a.b c d ", "x" * 40 + " "]) + one() + rng.choice(["", "", " tail", f" {one()}"])
    if rng.random() < 0.3:
        at = rng.randrange(len(line))
        line = line[:at] + rng.choice(["", " ", ".", "\x01", '"', "[", "\n", "%"]) + line[at + 1 :]
    return line


@pytest.mark.parametrize("fmt", ["access", "access_combined"])
def test_random_lines_have_the_same_fields(spark, monkeypatch, fmt):
    rng = random.Random(4)
    lines = [random_line(rng) for _ in range(6000)]
    cut, whole = both(spark, monkeypatch, lines, fmt)
    wrong = [(a["value"], a["fields"], b["fields"]) for a, b in zip(cut, whole, strict=True) if (a["status"], a["fields"]) != (b["status"], b["fields"])]
    assert not wrong, wrong[:3]
    assert sum(r["status"] == "OK" for r in whole) > 250


HOSTILE = [
    "a." * 4960 + f' - - {DATE} "GET / HTTP/1.1" 200',
    "a." * 4960 + f'a - - {DATE} "GET / HTTP/1.1" 200 x',
    ("a" * 62 + ".") * 156 + f' - - {DATE} "GET / HTTP/1.1" 200 5',
    ("a" * 62 + ".") * 150 + f'_ - - {DATE} "GET / HTTP/1.1" 200 5',
    "a-" * 4940 + f' - - {DATE} "GET / HTTP/1.1" 200 5',
    "a " * 4940 + f'- - {DATE} "GET / HTTP/1.1" 200 x',
    "1:" * 4940 + f' - - {DATE} "GET / HTTP/1.1" 200 5',
    "10.0.0.1 " * 1000 + f'{DATE} "GET / HTTP/1.1" 200 5',
    f'h - - {DATE} "' + '" 1 ' * 2400,
    f'h - - {DATE} "GET ' + "a HTTP/1." * 1080 + '" x',
    "[10/Oct/2024:13:55:36 +0000 " * 350 + '] "',
    f'h - - {DATE} "GET /" 200 5 "' + '\\"' * 4900,
]


def test_hostile_lines_take_little_time(spark):
    assert all(9_000 < len(x) <= 10_000 for x in HOSTILE)
    for line in HOSTILE:
        df = spark.createDataFrame([(line,)] * 50, "value string").coalesce(1).cache()
        df.count()
        best = min(_seconds(df) for _ in range(3))
        assert best / 50 < 0.02, (best / 50, line[:40])


def _seconds(df):
    t = time.time()
    parse_lines(df, "access").select("status", "fields.clientip").write.format("noop").mode("overwrite").save()
    return time.time() - t


def test_short_lines_take_the_whole_pattern(spark, parse_all):
    line = f'10.0.0.1 - frank {DATE} "GET /x HTTP/1.0" 200 5'
    status, fields = parse_all([line + " " * (skeleton.LONG_LINE - len(line)), line + " " * skeleton.LONG_LINE], "access")[1]
    assert status == "OK" and fields["clientip"] == "10.0.0.1" and fields["bytes"] == "5"
