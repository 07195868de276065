import random

from rows import ODD, words
from loglathe.llm.decontaminate import drop_leaks, find_leaks
from pyspark.sql import functions as F


def grams(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    out = []
    for d, text in docs:
        for i, item in items:
            k = min(5, len(words(item)))
            own = grams(item, k) if k else set()
            shared = len(own & grams(text, k)) if own else 0
            if own and 100 * shared >= 80 * len(own):
                out.append((str(d), i, len(own), shared))
    return sorted(out)


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_equals_brute_force(table_of, spark):
    rng = random.Random(2)
    vocabulary = [f"v{i}" for i in range(800)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice((1, 3, 5, 9, 30, 70, 300))))) for i in range(40)]
    items += [(90, None), (91, ""), (92, items[5][1]), (93, items[6][1].upper())]
    docs = []
    for d in range(150):
        text = rng.choices(vocabulary, k=rng.choice((3, 50, 3000)))
        if d % 3:
            inner = (items[d % 40][1] or "").split()
            for _ in range(rng.choice((0, 0, 1, 2))):
                inner[rng.randrange(len(inner))] = "x"
            at = rng.randrange(len(text))
            text[at:at] = inner if d % 2 else inner[: len(inner) * 9 // 10]
        docs.append((d, " ".join(text)))
    found = find_leaks(table_of(docs), bench(spark, items))
    got = sorted((str(r["doc_id"]), r["item_id"], r["n_item"], r["n_shared"]) for r in found.collect())
    assert got == brute(docs, items) and len(got) > 50
    left = {r["doc_id"] for r in drop_leaks(table_of(docs), bench(spark, items)).collect()}
    assert left == {d for d, _ in docs} - {int(d) for d, *_ in got}


def test_an_item_in_pieces_is_found(table_of, spark):
    item = [f"i{n}" for n in range(60)]
    text = ["a"] * 500 + item[:30] + ["b"] * 2000 + item[30:] + ["c"] * 500
    row = find_leaks(table_of([(1, " ".join(text))]), bench(spark, [(7, " ".join(item))])).head()
    assert (row["item_id"], row["n_item"], row["n_shared"]) == (7, 56, 52)


def test_odd_rows(table_of, spark):
    docs = table_of(ODD).withColumn("item_id", F.lit(5)).withColumn("hashes", F.lit(None).cast("string"))
    items = [(1, "same text twice in this table of ours"), (2, "a b c"), (3, "WORD"), (4, None), (5, " \n")]
    got = sorted((r["doc_id"], r["item_id"]) for r in find_leaks(docs, bench(spark, items)).collect())
    assert got == [(4, 3), (5, 1), (5, 1), (7, 2), (8, 2)]
    left = drop_leaks(docs, bench(spark, items))
    assert left.columns == docs.columns and left.count() == len(ODD) - 5
    assert find_leaks(docs, bench(spark, [])).count() == 0 and drop_leaks(docs, bench(spark, [])).count() == len(ODD)
    assert find_leaks(table_of([]), bench(spark, items)).count() == 0
