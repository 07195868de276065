"""Windows from the first error, against a plain loop."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from loglathe.operators.anchored import anchors, error_counts_anchored, error_sample_anchored

START = datetime.datetime(2024, 1, 1)


def plain(rows, keep=10, window=60_000):
    """``(operation, window start in ms, id, rank)`` kept, and errors per window."""
    kept, counts = [], {}
    start = {}
    for op, us, i in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        ms = us // 1000
        if op not in start or ms - start[op] > window:
            start[op] = ms
        key = op, start[op]
        counts[key] = counts.get(key, 0) + 1
        if counts[key] <= keep:
            kept.append((op, start[op], i, counts[key]))
    return sorted(kept, key=str), counts


def table(spark, rows):
    data = [(op, START + datetime.timedelta(microseconds=us), i, "x") for op, us, i in rows]
    return spark.createDataFrame(data, "op string, ts timestamp, id long, anchor string").repartition(5)


def check(spark, rows, keep=10):
    kept, counts = plain(rows, keep)
    base = F.unix_millis(F.lit(START).cast("timestamp"))
    df = table(spark, rows)
    sample = error_sample_anchored(df, "op", "ts", "id", keep)
    assert sample.columns == [*df.columns, "window_start", "rank"]
    got = [tuple(r) for r in sample.select("op", F.unix_millis("window_start") - base, "id", "rank").collect()]
    assert sorted(got, key=str) == kept
    found = error_counts_anchored(df, "op", "ts", keep).withColumn("w", F.unix_millis("window_start") - base).collect()
    assert {(r["op"], r["w"]): r["errors"] for r in found} == counts
    assert all(r["kept"] == min(keep, r["errors"]) and r["suppressed"] == max(0, r["errors"] - keep) and r["limit_reached"] == (r["errors"] > keep) for r in found)


@pytest.mark.parametrize("seed", range(3))
def test_windows_equal_a_loop(spark, seed):
    rng = random.Random(seed)
    rows, at = [], 0
    for i in range(500):
        at += rng.choice([0, 1, 999, 59_000_000, 60_000_000, 60_000_001, 60_001_000, 20_000_000, 500_000_000])
        rows.append((rng.choice(["a", "a", "a", "b", None]), at, i))
    check(spark, rows, keep=3)


def test_one_hot_operation_without_a_pause(spark):
    rng = random.Random(7)
    rows = [("hot", rng.randrange(3_600_000_000), i) for i in range(6000)] + [("b", 10, 6001)]
    check(spark, rows)


def test_edges_of_a_window(spark):
    check(spark, [("a", 0, 1), ("a", 60_000_000, 2), ("a", 60_000_999, 3), ("a", 60_001_000, 4), ("a", 120_001_000, 5), ("a", 120_002_000, 6)])
    check(spark, [("a", 5, i) for i in range(30)])
    check(spark, [])
    no_time = table(spark, [("a", 0, 1)]).union(spark.createDataFrame([("a", None, 2, "x")], "op string, ts timestamp, id long, anchor string"))
    assert error_sample_anchored(no_time, "op", "ts", "id").count() == 1


def test_rounds_grow_with_the_logarithm(spark):
    moments = spark.range(3000).select(F.lit("a").alias("op"), (F.col("id") * 30_001).alias("ms"))
    got = sorted(r["anchor"] for r in anchors(moments).collect())
    assert got == [i * 30_001 for i in range(0, 3000, 2)]
