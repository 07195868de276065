"""Tables, the one-pass store, streams and replays."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loglathe.operators.parse import parse_lines
from loglathe.operators.shape import GENERIC_COLUMNS, generic_schema, shape_rows
from loglathe.plans.flow import Flow, run_batch
from loglathe.session import scratch_dir
from loglathe.sinks.merge import merge_batches, remove_replaced, visible
from loglathe.sinks.rejects import read_reject_text
from loglathe.sinks.tables import Layout, append_table, ensure_table, table_name
from loglathe.sources.files import log_type_from_path, scan_lines, stream_lines
from loglathe.streaming.runner import COUNTERS, run_stream, stream_counters, trigger_options

FLOW = Flow("application", "app", columns=GENERIC_COLUMNS, event_date_from="timestamp")


def write_lines(folder, name, first, n=40):
    """A log file over three days with blank, bad and oversize lines among the good ones."""
    os.makedirs(folder, exist_ok=True)
    lines = []
    for i in range(first, first + n):
        if i % 10 == 3:
            lines.append("  ")
        elif i % 10 == 7:
            lines.append(f"bad \"{i}\" \\ line")
        elif i == first + 20:
            lines.append("x" * 10_001)
        else:
            lines.append(f"2024-01-{15 + i % 3}T10:30:{i % 60:02d}Z INFO line {i}")
    with open(f"{folder}/.{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")
    return lines


def expected(lines):
    good = sorted(tuple(x.split(" ", 2)) + (x[:10],) for x in lines if x.startswith("2024"))
    bad = sorted(x for x in lines if x.strip() and not x.startswith("2024"))
    return good, bad


def stored(spark, root):
    good = sorted(tuple(r) for r in FLOW.good_table(spark, root).collect())
    return good, sorted(r["record"] for r in FLOW.reject_table(spark, root).collect())


def test_scan_gives_lines_and_files(spark, folder):
    write_lines(f"{folder}/a/web", "one.log", 0)
    write_lines(f"{folder}/a/app", "two.log", 40)
    df = scan_lines(spark, folder)
    assert df.columns == ["value", "file_path", "file_name"] and df.count() == 80
    kinds = df.select(log_type_from_path({"web": "/web/", "app": "/app/"}).alias("k")).groupBy("k").count().collect()
    assert {r["k"]: r["count"] for r in kinds} == {"web": 40, "app": 40}
    assert scan_lines(spark, folder, glob="one*").count() == 40


def test_batch_stores_everything_once(spark, folder):
    lines = write_lines(f"{folder}/in", "a.log", 0) + write_lines(f"{folder}/in", "b.log", 40)
    root, texts = f"{folder}/out", f"{folder}/rejects"
    counters = run_batch(spark, f"{folder}/in", FLOW, root, reject_path=texts)
    good, bad = expected(lines)
    assert counters == {
        "received": 80, "blank": 8, "parsed_success": len(good), "parsed_failed": len(bad),
        "bytes": sum(len(x) for x in lines),
    }
    assert counters["received"] == counters["blank"] + counters["parsed_success"] + counters["parsed_failed"]
    assert stored(spark, root) == (good, bad)
    assert sorted(
        r[0] for r in read_reject_text(spark, texts).select(F.get_json_object("value", "$.record")).collect()
    ) == bad
    # a run of its own adds to what is there, and so does another batch of a run; the same batch replaces itself
    run_batch(spark, f"{folder}/in", FLOW, root, run="r", reject_path=texts)
    assert stored(spark, root) == (sorted(good * 2), sorted(bad * 2))
    run_batch(spark, f"{folder}/in", FLOW, root, run="r", reject_path=texts)
    assert stored(spark, root) == (sorted(good * 2), sorted(bad * 2))
    assert read_reject_text(spark, texts).count() == 2 * len(bad)
    run_batch(spark, f"{folder}/in", FLOW, root, run="r", batch=1, reject_path=texts)
    assert stored(spark, root) == (sorted(good * 3), sorted(bad * 3))


def test_a_replaced_batch_leaves_nothing_behind(spark, folder):
    lines = write_lines(f"{folder}/in", "a.log", 0)
    root, texts = f"{folder}/out", f"{folder}/rejects"
    good, bad = expected(lines)
    run_batch(spark, f"{folder}/in", FLOW, root, run="r", reject_path=texts)
    # a mended pattern, whose dates are others and which rejects less
    mended = Flow("%{GREEDYDATA:message}", "app", columns=GENERIC_COLUMNS, max_length=20_000)
    run_batch(spark, f"{folder}/in", mended, root, run="r", reject_path=texts)
    assert mended.good_table(spark, root).count() == len(good) + len(bad)
    assert mended.reject_table(spark, root).count() == 0 and read_reject_text(spark, texts).count() == 0
    # and no rows at all
    os.makedirs(f"{folder}/none")
    open(f"{folder}/none/empty.log", "w").close()
    run_batch(spark, f"{folder}/none", FLOW, root, run="r", reject_path=texts)
    assert stored(spark, root) == ([], [])
    with open(f"{folder}/none/empty.log", "w") as f:
        f.write("  \n\n")
    assert run_batch(spark, f"{folder}/none", FLOW, root)["received"] == 2


def test_streams_and_runs_share_a_root(spark, folder):
    lines = write_lines(f"{folder}/one", "a.log", 0) + write_lines(f"{folder}/two", "b.log", 40)
    root = f"{folder}/out"
    for source, state in (("one", "s1"), ("two", "s2")):
        run_stream(spark, f"{folder}/{source}", FLOW, root, f"{folder}/{state}", every_minutes=None).awaitTermination()
    assert stored(spark, root) == expected(lines)
    # a new checkpoint reads everything again, and adds it
    run_stream(spark, f"{folder}/one", FLOW, root, f"{folder}/s3", every_minutes=None).awaitTermination()
    run_batch(spark, f"{folder}/two", FLOW, root)
    good, bad = expected(lines)
    assert stored(spark, root) == (sorted(good * 2), sorted(bad * 2))


def test_merged_batches_read_the_same(spark, folder):
    lines = []
    for i in range(5):
        lines += write_lines(f"{folder}/in", f"{i}.log", 40 * i)
    root = f"{folder}/out"
    run_stream(spark, f"{folder}/in", FLOW, root, f"{folder}/s", every_minutes=None, max_files_per_batch=1).awaitTermination()
    run = next(d for d in os.listdir(root) if d.startswith("run=stream")).removeprefix("run=")

    def files():
        kept = spark.read.parquet(root).where(visible(spark, root))
        return len({r[0] for r in kept.select("_metadata.file_path").collect()})

    before = files()
    # a merge that stopped before its list was written
    lost = spark.read.option("basePath", root).parquet(f"{root}/run={run}/batch=0").drop("run", "batch")
    lost.write.partitionBy("outcome", "event_date").parquet(f"{root}/run=merged-lost/batch=0")
    assert stored(spark, root) == expected(lines)
    assert merge_batches(spark, root, run, 3) is not None and merge_batches(spark, root, run, 3) is None
    assert stored(spark, root) == expected(lines) and files() < before
    assert remove_replaced(spark, root) == 4 and not os.path.exists(f"{root}/run={run}/batch=0")
    assert stored(spark, root) == expected(lines)
    with pytest.raises(ValueError, match="has been merged"):
        run_batch(spark, f"{folder}/in", FLOW, root, run=run, batch=2)
    write_lines(f"{folder}/in", "9.log", 400)
    run_stream(spark, f"{folder}/in", FLOW, root, f"{folder}/s", every_minutes=None).awaitTermination()
    assert len(stored(spark, root)[0]) > len(expected(lines)[0])


def test_a_wrong_root_is_an_error(spark, folder):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        FLOW.good_table(spark, f"{folder}/nowhere").count()


def test_good_table_prunes_by_date_and_outcome(spark, folder):
    write_lines(f"{folder}/in", "a.log", 0)
    run_batch(spark, f"{folder}/in", FLOW, f"{folder}/out")
    day = FLOW.good_table(spark, f"{folder}/out").where("event_date = '2024-01-16'").select("message")
    plan = day._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "event_date" in filters and "outcome" in filters
    assert "ReadSchema: struct<message:string>" in plan and day.count() > 0


def test_storing_is_one_scan_without_a_shuffle(spark, folder):
    write_lines(f"{folder}/in", "a.log", 0)
    outcomes = FLOW.outcomes(scan_lines(spark, f"{folder}/in"))
    plan = outcomes._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1 and plan.count("regexp_replace(value#") == 1


def test_rebalanced_store_and_layout(spark, folder):
    lines = write_lines(f"{folder}/in", "a.log", 0)
    flow = Flow(
        "application", "app", columns=GENERIC_COLUMNS, event_date_from="timestamp", distribution="rebalance",
        layout=Layout(max_records_per_file=5),
    )
    run_batch(spark, f"{folder}/in", flow, f"{folder}/out")
    assert stored(spark, f"{folder}/out") == expected(lines)
    files = spark.read.parquet(f"{folder}/out").groupBy(F.col("_metadata.file_path").alias("p")).count().collect()
    assert max(r["count"] for r in files) <= 5


def test_oversize_lines_can_be_dropped(spark, folder):
    lines = write_lines(f"{folder}/in", "a.log", 0)
    flow = Flow("application", "app", columns=GENERIC_COLUMNS, oversize="drop")
    run_batch(spark, f"{folder}/in", flow, f"{folder}/out")
    rejected = [r["record"] for r in flow.reject_table(spark, f"{folder}/out").collect()]
    assert sorted(rejected) == [x for x in expected(lines)[1] if len(x) <= 10_000]


def test_masks_and_types_in_a_flow(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/a.log", "w") as f:
        f.write('2024-01-15T10:30:00Z 42 {"vuid":"abcdef"}\n')
    flow = Flow(
        "application", "app", columns=("level", "message", "timestamp"), types={"level": "int"}, mask={"timestamp": 4},
        mask_json=("message",), event_date_from="timestamp",
    )
    run_batch(spark, f"{folder}/in", flow, f"{folder}/out")
    row = flow.good_table(spark, f"{folder}/out").head()
    assert tuple(row) == (42, '{"vuid":"abc***"}', "2024" + "*" * 16, "2024-01-15")


def test_several_log_types_told_apart_by_path(spark, folder):
    for kind, line in {
        "app": "2024-01-15T10:30:00Z INFO hello",
        "web": '127.0.0.1 - - [16/Jan/2024:10:30:00 +0000] "GET / HTTP/1.1" 200 -',
        "own": "id=7",
    }.items():
        os.makedirs(f"{folder}/in/{kind}")
        with open(f"{folder}/in/{kind}/x.log", "w") as f:
            f.write(line + "\nbad\n")
    flow = Flow(
        {"app": "application", "web": "access", "own": "id=%{INT:id}"},
        event_date_from="timestamp",
        type_paths={"app": "/app/", "web": "/web/", "own": "/own/"},
    )
    run_batch(spark, f"{folder}/in", flow, f"{folder}/out")
    rows = {r["log_type"]: r for r in flow.good_table(spark, f"{folder}/out").collect()}
    assert rows["app"]["fields"]["message"] == "hello" and rows["app"]["event_date"] == "2024-01-15"
    assert rows["web"]["fields"]["verb"] == "GET" and rows["web"]["event_date"] == "2024-01-16"
    assert rows["own"]["fields"] == {"id": "7"}
    assert flow.reject_table(spark, f"{folder}/out").count() == 3


def test_flow_checks_its_arguments():
    for bad in (
        {"fmt": {"a b": "application"}},
        {"fmt": "nope"},
        {"fmt": "access", "log_type": "a b"},
        {"fmt": "access", "oversize": "keep"},
    ):
        with pytest.raises(ValueError):
            Flow(**bad)


def test_table_is_created_checked_and_appended_by_name(spark, folder):
    name = ensure_table(spark, "generic_logs", generic_schema(), location=f"{folder}/t", layout=Layout(32 * 2**20))
    assert ensure_table(spark, name, generic_schema()) == name
    drifted = T.StructType([*generic_schema().fields[1:], T.StructField("extra", T.IntegerType())])
    with pytest.raises(ValueError, match="missing column extra; unexpected column timestamp"):
        ensure_table(spark, name, drifted)
    line = "2024-01-15T10:30:00Z INFO hello"
    parsed = parse_lines(spark.createDataFrame([(line,)], "value string"), "application")
    rows = shape_rows(parsed, "application", columns=("message", "level", "timestamp"), event_date_from="timestamp")
    append_table(rows, name)
    append_table(rows, name, distribution="rebalance")
    assert [tuple(r) for r in spark.table(name).collect()] == [
        ("2024-01-15T10:30:00Z", "INFO", "hello", "2024-01-15")
    ] * 2
    with pytest.raises(ValueError, match="do not fit"):
        append_table(rows.drop("level"), name)
    with pytest.raises(Exception, match="Required column level is null"):
        append_table(rows.withColumn("level", F.lit(None).cast("string")), name)
    spark.sql(f"DROP TABLE {name}")


def test_table_names():
    assert table_name("test-db", "test-generic-table") == "`test-db`.`test-generic-table`"
    assert table_name("test-db") == "`test-db`.`parsed_logs`"
    for bad in ("", "  ", None):
        with pytest.raises(ValueError, match="Invalid database name"):
            table_name(bad)
    with pytest.raises(ValueError, match="Invalid table name"):
        table_name("db", " ")


def test_scratch_follows_the_cluster_setting(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


# -- streams -------------------------------------------------------------------------------------------------------


def test_stream_equals_batch_and_picks_up_new_files(spark, folder):
    lines = write_lines(f"{folder}/in", "a.log", 0) + write_lines(f"{folder}/in", "b.log", 40)
    root, texts, state = f"{folder}/out", f"{folder}/rejects", f"{folder}/state"

    def run():
        query = run_stream(
            spark, f"{folder}/in", FLOW, root, state, reject_path=texts, every_minutes=None, max_files_per_batch=1
        )
        query.awaitTermination()
        return query

    query = run()
    assert stored(spark, root) == expected(lines)
    observed = [p.observedMetrics[COUNTERS] for p in query.recentProgress if COUNTERS in p.observedMetrics]
    assert sum(m["received"] for m in observed) == len(lines)
    assert sum(m["parsed_failed"] for m in observed) == len(expected(lines)[1])
    run_batch(spark, f"{folder}/in", FLOW, f"{folder}/batch")
    assert stored(spark, f"{folder}/batch") == stored(spark, root)
    lines += write_lines(f"{folder}/in", "c.log", 80)
    run()
    run()  # nothing new
    assert stored(spark, root) == expected(lines)
    assert read_reject_text(spark, texts).count() == len(expected(lines)[1])


def test_a_batch_replayed_after_a_failure_adds_nothing(spark, folder):
    lines = write_lines(f"{folder}/in", "a.log", 0) + write_lines(f"{folder}/in", "b.log", 40)
    root, state = f"{folder}/out", f"{folder}/state"
    outcomes = Flow("application", "app", columns=GENERIC_COLUMNS).outcomes(stream_lines(spark, f"{folder}/in"))
    failures = ["once"]

    def store(rows, batch):
        FLOW.store(rows, root, "r", batch)
        if failures:
            failures.pop()
            raise RuntimeError("lost after writing, before the batch was committed")

    def run():
        writer = outcomes.writeStream.foreachBatch(store).option("checkpointLocation", state)
        return writer.trigger(availableNow=True).start()

    with pytest.raises(Exception, match="lost after writing"):
        run().awaitTermination()
    assert spark.read.parquet(root).count() == len([x for x in lines if x.strip()])
    run().awaitTermination()
    assert spark.read.parquet(root).count() == len([x for x in lines if x.strip()])


def test_running_counters(spark, folder):
    lines = write_lines(f"{folder}/in", "a.log", 0) + write_lines(f"{folder}/in", "b.log", 40)
    parsed = parse_lines(stream_lines(spark, f"{folder}/in", max_files_per_batch=1), "application")
    query = (
        stream_counters(parsed, ["file_name"]).writeStream.outputMode("complete").format("memory")
        .queryName("running_counters").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.table("running_counters").collect()
    assert {r["file_name"] for r in rows} == {"a.log", "b.log"}
    assert sum(r["parsed_success"] for r in rows) == len(expected(lines)[0])


def test_trigger_options():
    assert trigger_options(None) == {"availableNow": True}
    assert trigger_options(5) == {"processingTime": "300 seconds"}
    assert trigger_options(0.5) == {"processingTime": "30 seconds"}
    with pytest.raises(ValueError):
        trigger_options(0)
