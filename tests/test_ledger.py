"""Ledgers: what batches add up to equals what one batch of all rows gives; replays and folding change nothing."""

import os
import random

import pytest
from pyspark.sql import functions as F

from loglathe.operators.quality import health_status, parse_counters, pattern_quarantine, records_per_second
from loglathe.streaming import ledger as ledgers
from loglathe.streaming.ledger import STREAM, file_ledger, health_ledger, rate_ledger, read_health, read_quarantine, read_rates, record_all, run_ledger, streak_ledger

SCHEMA = "n long, ts timestamp, source string, status string, value string, file_path string"
NOW = "timestamp '2024-01-01 02:00:00'"


def ok_row():
    return F.col("status") == "OK"


def events(spark, seed=1, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        bad = (i // 40) % 3 == 1 or rng.random() < 0.2
        source = rng.choice(["a", "a", "b", None])
        rows.append((i, i * 5, source, "NO_MATCH" if bad else "OK", f"line {i}", f"/logs/{i // 250}.log"))
    df = spark.createDataFrame(rows, "n long, s long, source string, status string, value string, file_path string")
    return df.withColumn("ts", F.expr("timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)")).drop("s").cache()


def same(a, b):
    columns = sorted(b.columns)
    assert sorted(map(str, a.select(columns).collect())) == sorted(map(str, b.select(columns).collect()))


@pytest.mark.parametrize("cuts", [[0, 900], [0, 1, 2, 300, 301, 899, 900], [0, 37, 120, 121, 600, 900]])
def test_batches_say_what_all_rows_say(spark, folder, cuts):
    rows = events(spark)
    error = F.concat("status", F.lit(" "), F.col("n").cast("string"))
    health = health_ledger(f"{folder}/h", ["source"], ok_row(), error, "ts", "n")
    streaks = streak_ledger(f"{folder}/s", ["source"], ["n"], ok_row())
    files = file_ledger(f"{folder}/f")
    rates = rate_ledger(f"{folder}/r", by=["source"])
    every = [health, streaks, files, rates]

    def check():
        same(read_health(spark, health, F.expr(NOW)), health_status(rows, ["source"], ok_row(), error, "ts", "n", F.expr(NOW)))
        same(read_quarantine(spark, streaks).drop(STREAM), pattern_quarantine(rows, ["source"], ["n"], ok_row()))
        same(files.read(spark), parse_counters(rows, ["file_path"], "value"))
        same(read_rates(spark, rates).drop("late"), records_per_second(rows, by=["source"]))

    for batch, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        record_all(rows.where(f"n >= {a} and n < {b}"), every, "stream-x", batch)
    check()
    last = len(cuts) - 2
    record_all(rows.where(f"n >= {cuts[last]}"), every, "stream-x", last)  # replayed
    check()
    assert {x.fold(spark) for x in every} == {last}
    check()
    for batch in range(last + 1):  # all of them again: folded ones are left out
        record_all(rows.where(f"n >= {cuts[batch]} and n < {cuts[batch + 1]}"), every, "stream-x", batch)
    check()
    assert {x.fold(spark) for x in every} == {0}


def test_folding_again_joins_folded_rows_too(spark, folder):
    rows, files = events(spark), file_ledger(f"{folder}/f")
    for batch in range(9):
        files.record(rows.where(F.col("n") % 9 == batch), "stream-x", batch)
        if batch in (3, 6, 8):
            files.fold(spark)
    same(files.read(spark), parse_counters(rows, ["file_path"], "value"))
    assert files.rows(spark).select("place").distinct().count() == 2


def test_streams_keep_their_own_runs_of_failures(spark, folder):
    streaks, rows = streak_ledger(f"{folder}/s", ["source"], ["n"], ok_row()), events(spark)
    bad = rows.where("status <> 'OK' and source = 'a'").limit(8)
    streaks.record(bad, "stream-x", 0)
    streaks.record(bad, "stream-y", 0)
    assert [r["quarantined"] for r in read_quarantine(spark, streaks).collect()] == [False, False]
    streaks.record(bad, "stream-y", 1)
    assert {r[STREAM]: r["max_streak"] for r in read_quarantine(spark, streaks).collect()} == {"stream-x": 8, "stream-y": 16}


def test_late_rows_are_counted_apart(spark, folder):
    rates = rate_ledger(f"{folder}/r", delay="1 minute")
    at = lambda *seconds: spark.createDataFrame([(s,) for s in seconds], "s long").select(F.expr("timestamp '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, s)").alias("ts"))
    rates.record(at(0, 100), "stream-x", 0)
    rates.record(at(5, 29, 30, 35, 41, 200), "stream-x", 1)  # the mark is at 40: slides that end there or before are late
    rates.record(at(100), "stream-x", 2)
    for _ in range(2):
        got = read_rates(spark, rates, 10).orderBy("window_start").select(F.second("window_start"), "records", "late").collect()
        assert [tuple(r) for r in got] == [(0, 2, 1), (20, 1, 1), (30, 2, 2), (40, 1, 0), (40, 2, 1), (20, 1, 0)]
        rates.fold(spark)


def test_a_silent_source_goes_down(spark, folder):
    health = health_ledger(f"{folder}/h", ["source"], ok_row(), F.col("status"), "ts", "n")
    health.record(events(spark).where("source = 'b'"), "stream-x", 0)
    last = "timestamp '2024-01-01 01:14:55'"
    up = read_health(spark, health, F.expr(f"{last} + interval 1 minute")).head()
    down = read_health(spark, health, F.expr(f"{last} + interval 10 minutes")).head()
    assert (up["status"], down["status"]) == ("UP", "DOWN")


def test_health_reads_its_rows_once(spark, folder):
    events(spark).write.parquet(f"{folder}/in")
    rows = spark.read.parquet(f"{folder}/in")
    plan = health_status(rows, ["source"], ok_row(), F.col("status"), "ts", "n", F.expr(NOW))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_a_stream_that_dies_says_nothing_twice(spark, folder, monkeypatch):
    rows = events(spark)
    for i in range(3):
        rows.where(F.col("n") % 3 == i).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    files = [file_ledger(f"{folder}/f"), file_ledger(f"{folder}/g", ["source"])]
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    real, calls = ledgers.record_all, []

    def record(*args):
        real(*args)
        calls.append(args[3])
        if len(calls) == 2:
            raise RuntimeError("killed")

    monkeypatch.setattr(ledgers, "record_all", record)
    with pytest.raises(Exception, match="killed"):
        run_ledger(stream, files, f"{folder}/state", every_minutes=None).awaitTermination()
    run_ledger(stream, files, f"{folder}/state", every_minutes=None).awaitTermination()
    assert calls == [0, 1, 1, 2]
    same(files[0].read(spark), parse_counters(rows, ["file_path"], "value"))
    same(files[1].read(spark), parse_counters(rows, ["source"], "value"))
    assert os.path.isdir(f"{folder}/f/_done")


@pytest.mark.parametrize("by", [[], ["source"]])
def test_emitted_and_open_windows_are_all_windows(spark, folder, by):
    from loglathe.streaming.runner import open_rates, stream_rates

    rows = events(spark, 3, 500)
    for i in range(3):
        rows.where(F.col("n").between(170 * i, 170 * i + 169)).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run():
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
        rates = stream_rates(stream, watermark="30 seconds", by=by)
        writer = rates.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
        writer.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        closed, left = spark.read.parquet(f"{folder}/out"), open_rates(spark, f"{folder}/state", by=by)
        assert closed.count() and left.count()
        return closed.unionByName(left)

    same(run(), records_per_second(rows, by=by))
    more = rows.withColumn("ts", F.col("ts") + F.expr("interval 1 hour"))
    more.coalesce(1).write.mode("append").parquet(f"{folder}/in")  # the stream goes on, and emits what was open
    same(run(), records_per_second(rows.unionByName(more), by=by))
