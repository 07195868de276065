"""Spelling variants against all pairs of words compared one by one."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglathe.llm import spelling
from loglathe.llm.letter_trie import LEVELS, Leaf, letter_groups, near_words, one_edit, search, trie, vectors
from loglathe.llm.spelling import damaged_words, spelling_variants, variant_report
from rows import LOWER, ODD


def distance_one(x, y):
    """By the full table of edit distances."""
    row = list(range(len(y) + 1))
    for i, a in enumerate(x, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(y, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return row[-1] == 1


def plain_words(rows):
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                yield run


def plain(counts, times=10):
    out = {}
    for w, n in counts.items():
        near = sorted((-m, x) for x, m in counts.items() if abs(len(x) - len(w)) < 2 and distance_one(w, x))
        form = near[0][1] if near and -near[0][0] >= times * n else None
        out[w] = (form, n, len(near), counts[form] if form else None)
    rows = []
    for w, (form, n, n_near, form_n) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows.append((w, form, root, n, n_near, form_n))
    return sorted(rows)


def edited(rng, word, letters):
    at, kind = rng.randrange(len(word)), rng.randrange(3)
    return word[:at] + ("" if kind == 0 else rng.choice(letters)) + word[at + (kind < 2) :]


def family(rng, size, letters="abcdeéß÷"):
    """Words and words that are an edit or two from them, with counts of very different size."""
    words = ["".join(rng.choices(letters, k=rng.randrange(7, 12))) for _ in range(size // 6)]
    while len(words) < size:
        words.append(edited(rng, rng.choice(words), letters))
    return {w: rng.choice([2, 3, 25, 40, 300, 4000]) for w in words if len(w) >= 7}


def test_one_edit_equals_the_table_of_distances():
    rng = random.Random(1)
    for _ in range(4000):
        x = "".join(rng.choices("ab", k=rng.randrange(2, 9)))
        y = edited(rng, x, "ab") if rng.random() < 0.7 else "".join(rng.choices("ab", k=len(x) + rng.randrange(2)))
        if abs(len(x) - len(y)) < 2:
            assert one_edit(x, y) == one_edit(y, x) == distance_one(x, y), (x, y)


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyzàéø"])
def test_tries_reach_every_near_pair_once(letters):
    words = sorted(family(random.Random(2), 400, letters))
    groups = letter_groups(np.bincount(np.frombuffer("".join(words).encode("latin-1"), np.uint8), minlength=256))
    root, found = trie(words, groups), []
    search(root, root, lambda a, b: found.extend(near_words(a, b)) if a.number <= b.number else None)
    pairs = Counter(tuple(sorted(p)) for p in found)
    assert pairs == Counter((x, y) for i, x in enumerate(words) for y in words[i + 1 :] if distance_one(x, y))
    assert vectors(words, groups).sum(1).tolist() == list(map(len, words)) and vectors(words, groups).shape[1] == LEVELS


def test_large_leaves_are_looked_up_by_halves():
    rng = random.Random(3)
    words = sorted({"".join(rng.sample("aabbccdd", 8)) for _ in range(500)})
    one, two = Leaf(0), Leaf(1)
    one.words = words
    two.words = sorted({edited(rng, w, "e") for w in words if rng.random() < 0.5} | {w[:3] + "e" + w[3:] for w in words})
    two.words = [w for w in two.words if len(w) == 9]
    assert {tuple(sorted(p)) for p in near_words(one, one)} == {(x, y) for i, x in enumerate(words) for y in words[i + 1 :] if one_edit(x, y)}
    both = {(x, y) for x in words for y in two.words if one_edit(x, y)}
    assert both and set(near_words(one, two)) == both and {p[::-1] for p in near_words(two, one)} == both


@pytest.mark.parametrize(("cell_words", "letters"), [(20_000, "abcdeéß÷"), (30, "abcdeéß÷"), (5, "ab")])
def test_variants_equal_brute_force(spark, cell_words, letters):
    counts = family(random.Random(cell_words), 500, letters)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    got = spelling_variants(df, cell_words=cell_words)
    assert sorted((tuple(r) for r in got.collect()), key=lambda r: r[0]) == plain(counts)


def test_chains_of_forms_end_at_their_root(spark):
    chain = {"abcdefgh": 3, "abcdefgx": 30, "abcdefyx": 300, "abcdezyx": 3000, "abcdwzyx": 30000, "abcuwzyx": 300000}
    df = spark.createDataFrame(list(chain.items()), "word string, n long")
    assert {r["root"] for r in spelling_variants(df).collect()} == {"abcuwzyx"}


def test_report_equals_brute_force(spark, table_of):
    rng = random.Random(6)
    words = list(family(rng, 60))
    rows = [(rng.choice([i, i, None]), " ".join(rng.choices(words, k=40)).title()) for i in range(60)]
    rows += [*ODD, (900, "Überhaupt-überhauptİüberhaupt ×÷×÷×÷× ×÷×÷×÷×"), (901, "x" * 3_000_000 + " " + "x" * 3_000_000), (902, "abcdefg. " * 200_000)]
    assert sorted(r["word"] for r in damaged_words(table_of(rows)).collect()) == sorted(plain_words(rows))
    counts = {w: n for w, n in Counter(plain_words(rows)).items() if n >= 2}
    short = {w: n for w, n in counts.items() if len(w) < 100}
    got = sorted((tuple(r) for r in variant_report(table_of(rows)).collect()), key=lambda r: r[0])
    assert [r for r in got if len(r[0]) < 100] == plain(short)
    assert {r[0] for r in got} == set(counts)


def test_empty_tables_and_clashing_columns(spark, table_of):
    assert variant_report(table_of([])).collect() == []
    assert variant_report(table_of([(1, "once only here")])).collect() == []
    rows = [(i, "wordlike wordlike wardlike") for i in range(9)]
    wide = table_of(rows).select("*", *[F.lit(1).alias(c) for c in ("word", "n", "h", "run", "cell", "guest")], F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    assert sorted(map(tuple, variant_report(wide).collect())) == sorted(map(tuple, variant_report(table_of(rows)).collect()))


def test_cells_hold_no_more_words_than_told(spark):
    counts = family(random.Random(8), 600)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    groups = letter_groups(spelling._letter_counts(df))
    leaves, largest = spelling._largest_cells(df, groups)
    sizes = [largest[d] for d in sorted(largest)]
    assert sizes == sorted(sizes, reverse=True) and len(largest) == LEVELS - spelling.FIRST_DEPTH + 1
    parts = spelling._in_parts(spelling._visits(df, groups, LEVELS), leaves, 1)
    assert parts.where("not guest").groupBy("part", "cell").count().agg(F.max("count")).head()[0] <= 3
    assert parts.where("not guest").count() == len(counts)
