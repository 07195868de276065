"""Merging small files to a size across runs, and replacing without a gap."""

import os
import random

import pytest
from pyspark.sql import functions as F

from loglathe.plans.flow import run_batch
from loglathe.sinks import merge
from loglathe.sinks.commits import batches_of, load_state, spans_of, visible
from loglathe.sinks.merge import compact, merge_batches, remove_replaced, stored_files
from loglathe.sinks.tables import read_outcomes, write_outcomes
from loglathe.streaming.runner import run_stream
from test_storage import FLOW, expected, stored, write_lines


def many_lines(folder, name, seed, n):
    """Lines of three days and of one without a date, hard to compress."""
    rng = random.Random(seed)
    os.makedirs(folder, exist_ok=True)
    lines = []
    for i in range(n):
        text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=60))
        lines.append(f"bad {text}" if i % 50 == 7 else f"2024-01-{15 + i % 3}T10:30:{i % 60:02d}Z INFO {text}")
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")
    return lines


def sizes(spark, root):
    """Bytes of the files that count, by outcome and date."""
    out = {}
    for r in stored_files(spark, root).where(visible(spark, root)).collect():
        out.setdefault((r["outcome"], r["event_date"]), []).append(r["bytes"])
    return out


def rows(spark, root):
    good, bad = stored(spark, root)
    return good, bad


def test_runs_of_their_own_are_merged_to_the_target(spark, folder):
    root, lines = f"{folder}/out", []
    for i in range(6):
        lines += many_lines(f"{folder}/in{i}", "a.log", i, 1500)
        run_batch(spark, f"{folder}/in{i}", FLOW, root)
    before, target = rows(spark, root), 60_000
    assert before == expected(lines) and max(map(max, sizes(spark, root).values())) < target / 2 * 2
    assert compact(spark, root, target) is not None
    assert rows(spark, root) == before
    good = [b for k, v in sizes(spark, root).items() if k[0] == "good" for b in v]
    assert len(good) >= 3 and all(target / 2 <= b <= 2 * target for b in good), good
    assert len(sizes(spark, root)["reject", next(k[1] for k in sizes(spark, root) if k[0] == "reject")]) == 1
    assert compact(spark, root, target) is None
    assert remove_replaced(spark, root) == 6 and rows(spark, root) == before
    assert len([d for d in os.listdir(root) if d.startswith("run=")]) == 1
    # more comes, and merged runs are merged again, to a larger size
    lines += many_lines(f"{folder}/more", "a.log", 99, 1500)
    run_batch(spark, f"{folder}/more", FLOW, root)
    assert compact(spark, root, 300_000) is not None and rows(spark, root) == expected(lines)
    assert all(len(v) == 1 for v in sizes(spark, root).values())
    remove_replaced(spark, root)
    assert rows(spark, root) == expected(lines)
    state = load_state(spark, root)
    assert not (state.gone or state.kept or state.parts or state.marks) and len(state.merged) == 1
    assert len([f for f in os.listdir(f"{root}/_lists") if f.endswith(".json") and f[0] != "."]) <= 2 and not os.listdir(f"{root}/_done")


def test_a_file_far_above_the_target_is_cut(spark, folder):
    lines = many_lines(f"{folder}/in", "a.log", 1, 9000)
    run_batch(spark, f"{folder}/in", FLOW, f"{folder}/out")
    assert compact(spark, f"{folder}/out", 40_000) is not None and rows(spark, f"{folder}/out") == expected(lines)
    assert all(20_000 <= b <= 80_000 for k, v in sizes(spark, f"{folder}/out").items() if k[0] == "good" for b in v)


def test_only_small_parts_of_a_batch_are_taken(spark, folder):
    root = f"{folder}/out"
    lines = many_lines(f"{folder}/a", "a.log", 1, 6000) + many_lines(f"{folder}/b", "b.log", 2, 6000)
    run_batch(spark, f"{folder}/a", FLOW, root, run="a")
    run_batch(spark, f"{folder}/b", FLOW, root, run="b")
    assert compact(spark, root, 120_000) is not None  # rejects only
    assert rows(spark, root) == expected(lines)
    state = load_state(spark, root)
    assert state.merged and state.kept and state.parts and not state.gone
    with pytest.raises(ValueError, match="has been merged"):
        run_batch(spark, f"{folder}/a", FLOW, root, run="a")
    assert remove_replaced(spark, root) == 2 and rows(spark, root) == expected(lines)
    with pytest.raises(ValueError, match="has been merged"):
        run_batch(spark, f"{folder}/b", FLOW, root, run="b")


def test_a_merge_that_dies_before_its_list_changes_nothing(spark, folder, monkeypatch):
    root, lines = f"{folder}/out", []
    for i in range(3):
        lines += write_lines(f"{folder}/in{i}", "a.log", 40 * i)
        run_batch(spark, f"{folder}/in{i}", FLOW, root)

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(merge, "save_list", die)
        with pytest.raises(RuntimeError, match="killed"):
            compact(spark, root, 1_000_000)
    assert any(d.startswith("run=merged-") for d in os.listdir(root)) and rows(spark, root) == expected(lines)
    assert compact(spark, root, 1_000_000) is not None and rows(spark, root) == expected(lines)


def test_newest_batch_of_a_stream_is_left_alone(spark, folder):
    lines = []
    for i in range(4):
        lines += write_lines(f"{folder}/in", f"{i}.log", 40 * i)
    root = f"{folder}/out"
    run_stream(spark, f"{folder}/in", FLOW, root, f"{folder}/s", every_minutes=None, max_files_per_batch=1).awaitTermination()
    assert compact(spark, root, 1_000_000) is not None and rows(spark, root) == expected(lines)
    assert list(load_state(spark, root).gone.values()) == [[(0, 2)]]


def test_names_of_merged_runs_are_refused(spark, folder):
    write_lines(f"{folder}/in", "a.log", 0)
    with pytest.raises(ValueError, match="for merged batches"):
        run_batch(spark, f"{folder}/in", FLOW, f"{folder}/out", run="merged-x")


def test_a_job_that_dies_leaves_the_old_rows(spark, folder):
    lines, root = write_lines(f"{folder}/in", "a.log", 0), f"{folder}/out"
    run_batch(spark, f"{folder}/in", FLOW, root, run="r")
    text = spark.read.text(f"{folder}/in")
    bad = F.when(F.rand() < 2, F.raise_error(F.lit("killed"))).otherwise(F.col("value"))
    with pytest.raises(Exception, match="killed"):
        run_batch(spark, text.withColumn("value", bad), FLOW, root, run="r")
    assert rows(spark, root) == expected(lines)
    # files of an attempt that was cut off between its last file and its marker
    outcomes = FLOW.outcomes(spark.read.text(f"{folder}/in"))
    outcomes.write.partitionBy("outcome", "event_date").mode("overwrite").parquet(f"{root}/run=r@2/batch=0")
    outcomes.write.partitionBy("outcome", "event_date").parquet(f"{root}/run=new/batch=0")
    assert rows(spark, root) == expected(lines)
    more = write_lines(f"{folder}/other", "b.log", 80)
    run_batch(spark, f"{folder}/other", FLOW, root, run="r")
    assert rows(spark, root) == expected(more) and not os.path.exists(f"{root}/run=r/batch=0")


def test_a_reader_finds_old_or_new_rows_while_a_batch_is_replaced(spark, folder, monkeypatch):
    old, root, seen = write_lines(f"{folder}/a", "a.log", 0), f"{folder}/out", []
    new = write_lines(f"{folder}/b", "b.log", 40)
    run_batch(spark, f"{folder}/a", FLOW, root, run="r")
    from loglathe.sinks import commits

    real = commits.mark_done

    def mark(*args):
        seen.append(rows(spark, root))
        real(*args)
        seen.append(rows(spark, root))

    monkeypatch.setattr(commits, "mark_done", mark)
    run_batch(spark, f"{folder}/b", FLOW, root, run="r")
    assert seen == [expected(old), expected(new)] and rows(spark, root) == expected(new)


def test_replaced_attempts_can_be_kept_for_their_readers(spark, folder):
    root, text = f"{folder}/out", write_lines(f"{folder}/in", "a.log", 0)
    outcomes = FLOW.outcomes(spark.read.text(f"{folder}/in"))
    write_outcomes(outcomes, root, "r", 3)
    reader = FLOW.good_table(spark, root)
    write_outcomes(outcomes.limit(0), root, "r", 3, keep_replaced=True)
    assert reader.count() == len(expected(text)[0]) and FLOW.good_table(spark, root).count() == 0
    assert read_outcomes(spark, root, FLOW.good_schema(spark), "good", "r", 3).count() == 0


def test_lists_hold_ranges():
    batches = {("a", b) for b in (*range(100_000), 100_005)} | {("b", 7)}
    assert spans_of(batches) == {"a": [(0, 99_999), (100_005, 100_005)], "b": [(7, 7)]} and batches_of(spans_of(batches)) == batches


def test_merge_of_one_run_takes_all_its_batches(spark, folder):
    root, lines = f"{folder}/out", []
    for i in range(3):
        lines += write_lines(f"{folder}/in{i}", "a.log", 40 * i)
        run_batch(spark, f"{folder}/in{i}", FLOW, root, run="day", batch=i)
    assert merge_batches(spark, root, "day", 0) is None
    assert merge_batches(spark, root, "day", 5) is not None and rows(spark, root) == expected(lines)
    assert remove_replaced(spark, root) == 3 and not os.path.exists(f"{root}/run=day/batch=0")
