import random

import pytest
from pyspark.sql import functions as F

from rows import ODD, words
from loglathe.llm.components import connected_components
from loglathe.llm.near_dedup import keep_one_of_each, near_duplicates


def shingles(text, k):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k):
    """{doc_id: least id reachable} over all pairs."""
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def copies(seed, n):
    """Texts in groups: copies, near copies with few or many edits, and texts that share a passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocabulary, k=40)
    rows = []
    base = rng.choices(vocabulary, k=120)
    for i in range(n):
        kind = i % 6
        if kind == 0:
            base = rng.choices(vocabulary, k=rng.choice((5, 60, 150)))
            text = base
        elif kind < 4:
            text = list(base)
            for _ in range(rng.choice((0, 1, 2, 4, 8))):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
        else:
            text = rng.choices(vocabulary, k=rng.randrange(5, 80)) + passage
        rows.append((i, " ".join(text)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_components_equal_brute_force(table_of, k):
    rows = copies(k, 240)
    found = near_duplicates(table_of(rows), words=k).collect()
    expected = brute(rows, k)
    assert {r["doc_id"]: r["component_id"] for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    sizes = {i: len(shingles(t, k)) for i, t in rows}
    assert {r["doc_id"]: r["n_shingles"] for r in found} == sizes
    kept = [r["doc_id"] for r in keep_one_of_each(table_of(rows), words=k).collect()]
    assert sorted(kept) == sorted({*expected.values()})


def test_a_large_group_that_hangs_together_in_steps(table_of):
    """Each text is like the next, the ends are not alike."""
    rng = random.Random(3)
    text = [f"a{i}" for i in range(100)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(text)))
        text[rng.randrange(100)] = f"b{i}"
    found = near_duplicates(table_of(rows), words=4).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute(rows, 4)


def test_odd_rows(table_of, spark):
    found = near_duplicates(table_of(ODD).withColumn("node", F.lit("clash")).withColumn("sig", F.lit(1)), words=4).collect()
    assert len(found) == len(ODD)
    by_id = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert by_id[1]["n_shingles"] == 0 and by_id[1]["component_id"] == 1 and by_id[3]["kept"]
    assert by_id[4]["n_shingles"] == 1 and by_id[8]["component_id"] == 7 and not by_id[8]["kept"]
    assert [r["component_id"] for r in found if r["doc_id"] is None] == [None, None]
    docs = table_of(ODD).withColumn("node", F.lit("clash"))
    left = keep_one_of_each(docs, words=4)
    assert left.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(["1", "2", "3", "4", "None", "None", "5", "6", "7"])
    assert near_duplicates(table_of([]), words=4).collect() == [] and keep_one_of_each(table_of([])).collect() == []


def test_one_id_for_two_texts_and_a_null_id_for_a_known_text(table_of):
    rows = [(1, "one two three four five six"), (2, "some other words stand here now"), (3, "some other words stand here now")]
    rows += [(3, "one two three four five six"), (None, "one two three four five six")]
    found = near_duplicates(table_of(rows), words=4).collect()
    assert {r["component_id"] for r in found} == {1}
    assert [r["doc_id"] for r in keep_one_of_each(table_of(rows), words=4).collect()] == [1]


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 180)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 180), 100), 200: 200, 201: 200, 202: 200}
