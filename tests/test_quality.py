"""Quality figures against plain loops over the rows."""

import datetime as dt
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from loglathe.operators.parse import parse_lines
from loglathe.operators.quality import (
    error_counts,
    error_sample,
    health_status,
    parse_counters,
    pattern_quarantine,
    records_per_second,
    success_rates,
)

START = dt.datetime(2024, 1, 1)
ROWS = "source string, ts timestamp_ntz, id long, ok boolean, error string"


def random_rows(seed, sources, n, fail_rate):
    """Rows of several sources; many share a time stamp, so the id decides their order."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(sources)
        ok = rng.random() >= fail_rate[source]
        rows.append((source, START + dt.timedelta(seconds=rng.randrange(max(n // 3, 1))), i, ok, f"e{rng.randrange(5)}"))
    return rows


def health_loop(rows, now):
    out = {}
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    for source, items in groups.items():
        items.sort(key=lambda r: (r[1], r[2]))
        done = failed = 0
        healthy, last_error, last = True, None, items[0][1]
        for _, ts, _, ok, error in items:
            if ok:
                done += 1
                last, healthy, last_error = ts, True, None
            else:
                failed += 1
                last_error = error
                if done + failed > 100 and failed > (done + failed) // 2:
                    healthy = False
        idle = int((now - last).total_seconds() * 1000)
        rate = 100.0 * done / (done + failed)
        out[source] = ("UP" if healthy and idle <= 300_000 else "DOWN", done, failed, pytest.approx(rate), idle, last_error)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_health_equals_a_row_loop(spark, seed):
    rates = {"a": 0.0, "b": 0.3, "c": 0.51, "d": 0.7, "e": 1.0, "f": 0.9}
    rows = random_rows(seed, list(rates), 900, rates)
    rows += [("tiny", START, 10_000, False, "only")]
    for now in (START + dt.timedelta(seconds=310), START + dt.timedelta(hours=1)):
        df = spark.createDataFrame(rows, ROWS).repartition(4)
        got = health_status(
            df, ["source"], F.col("ok"), F.col("error"), "ts", "id", F.lit(now.isoformat(sep=" ")).cast("timestamp")
        )
        assert {r[0]: tuple(r)[1:] for r in got.collect()} == health_loop(rows, now)


def test_health_sends_a_row_per_group_and_task(spark):
    df = spark.createDataFrame(random_rows(1, ["a"], 10, {"a": 0.5}), ROWS)
    got = health_status(df, ["source"], F.col("ok"), F.col("error"), "ts", "id", F.current_timestamp())
    plan = got._jdf.queryExecution().executedPlan().toString()
    # one row per group and task is shuffled, whatever the texts; the last one rides along, so rows are read once
    assert "partial_count_if" in plan or "partial_count" in plan
    assert not re.search(r"Aggregate\(keys=\[[^]]*error", plan) and "partial_max_by(" in plan
    assert plan.count("Scan ExistingRDD") == 1


def streaks(rows):
    out = {}
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    for source, items in groups.items():
        best = run = 0
        for r in sorted(items, key=lambda r: (r[1], r[2])):
            run = 0 if r[3] else run + 1
            best = max(best, run)
        out[source] = (best, run, best > 10)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_quarantine_equals_a_row_loop_across_chunks(spark, seed):
    rates = {"hot": 0.8, "b": 0.95, "never": 0.0, "always": 1.0, "half": 0.5}
    sources = ["hot"] * 6 + list(rates)  # one source holds most rows
    rows = random_rows(seed, sources, 800, rates)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for partitions in (1, 7, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            got = pattern_quarantine(spark.createDataFrame(rows, ROWS), ["source"], ["ts", "id"], F.col("ok"))
            assert {r[0]: tuple(r)[1:] for r in got.collect()} == streaks(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_counters_and_rates(spark):
    lines = ["2024-01-15T10:30:00Z INFO a", "bad", "", "x" * 10_001]
    df = spark.createDataFrame([("f1", x) for x in lines] + [("f2", ""), ("f3", lines[0])], "file string, value string")
    parsed = parse_lines(df, "application")
    got = {r["file"]: r.asDict() for r in parse_counters(parsed, ["file"], "value").collect()}
    assert got["f1"] == {
        "file": "f1", "received": 4, "blank": 1, "parsed_success": 1, "parsed_failed": 2,
        "bytes": sum(len(x) for x in lines),
    }
    rates = {r["file"]: r["success_rate"] for r in success_rates(parsed, ["file"]).collect()}
    assert rates == {"f1": pytest.approx(100 / 3), "f2": 100.0, "f3": 100.0}
    assert success_rates(parsed.limit(0)).head()["success_rate"] == 100.0


def test_records_per_second_equals_sliding_windows(spark):
    rng = random.Random(5)
    stamps = [START + dt.timedelta(milliseconds=rng.randrange(400_000)) for _ in range(500)]
    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate(stamps)], "ts timestamp_ntz, k int")
    got = {(r["k"], r["window_start"]): r["records"] for r in records_per_second(df, by=["k"]).collect()}
    direct = df.groupBy("k", F.window("ts", "60 seconds", "10 seconds")).count().collect()
    assert got == {(r["k"], r["window"]["start"]): r["count"] for r in direct}
    with pytest.raises(ValueError):
        records_per_second(df, window_seconds=60, slide_seconds=7)


def test_error_sample_and_counts(spark):
    rng = random.Random(9)
    rows = [
        (rng.choice(["storm"] * 8 + ["calm"]), START + dt.timedelta(seconds=rng.randrange(300)), i) for i in range(400)
    ]
    df = spark.createDataFrame(rows, "op string, ts timestamp_ntz, id long").repartition(6)
    expected = set()
    groups = defaultdict(list)
    for op, ts, i in rows:
        groups[op, ts.replace(second=0)].append((ts, i))
    for items in groups.values():
        expected |= {i for _, i in sorted(items)[:10]}
    sample = error_sample(df, "op", "ts", "id")
    assert {r["id"] for r in sample.collect()} == expected
    counts = error_counts(df, "op", "ts").collect()
    sizes = Counter((op, ts.replace(second=0)) for op, ts, _ in rows)
    assert sum(r["errors"] for r in counts) == len(rows) and len(counts) == len(sizes)
    for r in counts:
        n = sizes[r["op"], r["minute"].replace(tzinfo=None)]
        assert (r["errors"], r["kept"], r["suppressed"], r["limit_reached"]) == (n, min(n, 10), max(n - 10, 0), n > 10)
    assert sum(r["kept"] for r in counts) == len(expected)
    plan = sample._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
