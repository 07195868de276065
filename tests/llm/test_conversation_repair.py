"""Conversation repair against the cheapest edits found by trying all."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest

from loglathe.llm import run_paths as paths
from loglathe.llm.conversation_repair import damaged, repair, repair_report, repaired_turns

sys.setrecursionlimit(20_000)

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {0: 2, 1: 2, 2: 3, 3: 2}
NAME = {0: "user", 1: "user", 2: "assistant", 3: "user"}
TAKES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}


def cheapest(rows):
    """``(cost, audit)`` over rows of (initial, must go, cut off), least of all ways."""

    @lru_cache(maxsize=None)
    def best(i, state, inserted):
        ways = []
        if i == len(rows) and state in (0, 3):
            ways.append((0, ""))
        if inserted < 3:
            cost, rest = best(i, NEXT[state], inserted + 1)
            ways.append((cost + 2, "I" + rest))
        if i < len(rows):
            initial, gone, cut = rows[i]
            cost, rest = best(i + 1, state, 0)
            ways.append((cost + 3, "D" + rest))
            if not gone:
                cost, rest = best(i + 1, NEXT[state], 0)
                ways.append((cost + 2 + cut, "R" + rest))
                if (state, initial) in TAKES:
                    cost, rest = best(i + 1, TAKES[state, initial], 0)
                    ways.append((cost + cut, "K" + rest))
        return min(ways, default=(10**9, ""))

    return best(0, 0, 0)


def plain(table):
    """The whole report, one conversation after the other."""
    conversations = defaultdict(list)
    for conv_id, turn, role, text in table:
        held = conversations[conv_id]
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        held += [(turn, role, text)] * (2 if kind == 3 else 1)
    out = []
    for conv_id, rows in conversations.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in rows:
            inside = re.findall(r"[^\x20\x09-\x0D]", text)
            faults.append("blank" if not inside else "duplicate" if (role, text) in seen else "truncated" if inside[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in rows if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit = cheapest(tuple((r[1][:1], f in ("blank", "duplicate"), f == "truncated") for r, f in zip(rows, faults, strict=True)))
        state, made, left = 0, [], iter(rows)
        for letter in audit:
            if letter == "I":
                made.append(NAME[state] + ":")
                state = NEXT[state]
                continue
            _, role, text = next(left)
            if letter == "R":
                made.append(f"{NAME[state]}:{text}")
                state = NEXT[state]
            elif letter == "K":
                made.append(f"{role}:{text}")
                state = TAKES[state, role[:1]]
        digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
        out.append((conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest))
    return sorted(out, key=str)


def check(spark, rows, parts=4):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert sorted((tuple(r) for r in repair_report(df).collect()), key=str) == plain(rows)


def test_unrolled_runs_are_the_least_of_all_ways():
    rng = random.Random(1)
    for _ in range(400):
        symbols = "".join(rng.choice("xsuaoSUAOuaua") * rng.choice([1, 1, 1, 2, 5]) for _ in range(rng.randrange(0, 7)))
        runs = [(k, len(list(g))) for k, g in itertools.groupby(symbols)]
        cost = paths.borders(runs, paths.LAST)[0][0]
        assert (cost, paths.unroll(runs, paths.LAST, 0, True)[0]) == cheapest(tuple((s.lower(), s == "x", s.isupper()) for s in symbols))
        assert paths.ahead(paths.matrix(runs), paths.LAST)[0] == cost


def test_a_run_of_any_length_takes_a_few_products():
    assert paths.borders([("u", 10**15)], paths.LAST)[0][0] == 10**15
    assert max(max(line) for line in paths.matrix([("s", 1 << 40), ("x", 1 << 50)])) <= paths.FAR


def conversations(rng, count, longest):
    texts = ["Yes.", "No!", "why", "", " \n", "same text here.", "cut off", "end ", "a.\t\n", "Ünï?"]
    for conv_id in range(count):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            yield conv_id, rng.choice([turn, turn, turn, turn + 3, None]), role, rng.choice([*texts, f"turn {turn}.", f"cut {turn}", None])


@pytest.mark.parametrize("parts", [1, 7])
def test_report_equals_brute_force(spark, parts):
    check(spark, list(conversations(random.Random(parts), 60, 9)), parts)


def test_null_ids_repeats_and_ties(spark):
    rng = random.Random(5)
    rows = [(None, t, r, x) for _, t, r, x in conversations(rng, 20, 9)]
    rows += [(7, None, "user", "x")] * 30 + [(8, 1, "user", c * 9 + e) for c in "ab" for e in ("1.", "2.", "2.")]
    check(spark, rows)


def test_all_rows_dropped(spark):
    dropped = [(c, t, "user", "Hello.") for c in range(40) for t in range(9) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    got = repair_report(spark.createDataFrame(dropped, SCHEMA)).collect()
    assert {tuple(r)[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert len(got) == len({r[0] for r in dropped})


def test_a_conversation_cut_over_many_partitions(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant"]), rng.choice([f"t{t}.", f"t{t}", "again and again.", ""])) for t in range(700)]
    rows += [(c, t, "user", "Hi.") for c in (0, 2) for t in range(3)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        check(spark, rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_empty_table_and_clashing_columns(spark):
    assert repair_report(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, 0, "user", "Hi."), (1, 1, "assistant", "Hello")]
    extra = "n long, piece int, audit string, first int, m map<string,int>, own string, key string"
    wide = spark.createDataFrame([(*r, 9, 9, "z", 9, {"a": 1}, "o", "k") for r in rows], f"{SCHEMA}, {extra}")
    assert [tuple(r) for r in repair_report(wide).collect()] == plain(rows)


def test_a_very_long_text(spark):
    rows = [(3, 0, "user", "ab. " * 500_000), (3, 1, "assistant", " " * 1_000_000 + "x"), (3, 2, "user", "\n" * 1_000_000)]
    check(spark, rows)


def test_repaired_turns_are_alternating(spark):
    df = spark.createDataFrame(list(conversations(random.Random(3), 30, 9)), SCHEMA)
    turns = defaultdict(list)
    for r in repaired_turns(*repair(damaged(df))).orderBy("conv_id", "turn").collect():
        assert r["turn"] == len(turns[r["conv_id"]])
        turns[r["conv_id"]].append(r["role"][:1])
    assert turns and all(re.fullmatch("(s?(ua)+)?", "".join(t)) for t in turns.values())
