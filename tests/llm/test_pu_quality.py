"""Quality scores: figures against plain Python, the share of good texts, accuracy on held-out labels."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loglathe.llm import pu_quality
from loglathe.llm.common import crc_mod
from loglathe.llm.pu_quality import Scale, Sums, class_prior, fit_nonnegative, fit_quality, quality_scores, tell_apart
from loglathe.llm.text_shape import FEATURES, KINDS, STATISTICS, shapes
from loglathe.llm.textops import texts_of
from rows import ODD, words

LABELS = "doc_id long, quality int, toxic int"


def kind(c):
    if c in ".!?":
        return 5
    if c in ",;:'\"()-":
        return 6
    if c == "\n":
        return 4
    if c in " \t\x0b\x0c\r":
        return 3
    return 2 if c in "0123456789" else 1 if "A" <= c <= "Z" else 0 if "a" <= c <= "z" or ord(c) > 127 else 7


def plain(text):
    """The figures of one text, one after the other."""
    text = text or ""
    pairs = np.zeros(KINDS * KINDS)
    for a, b in zip(text, text[1:], strict=False):
        pairs[kind(a) * KINDS + kind(b)] += 1
    n, w = max(len(text), 1), words(text)
    sizes = [len(x.encode()) for x in w]
    mean = sum(sizes) / max(len(w), 1)
    times, lines = Counter(w), [x for x in text.split("\n") if x]
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    again = sum(a == b for a, b in zip(w, w[1:], strict=False))
    k = max(len(w), 1)
    figures = {
        "characters": math.log1p(len(text)), "words": math.log1p(len(w)), "word_length": math.log1p(mean),
        "word_spread": math.log1p(math.sqrt(max(sum(s * s for s in sizes) / k - mean**2, 0))),
        "long_words": math.sqrt(sum(s > 20 for s in sizes) / k), "distinct_words": math.sqrt(len(times) / k),
        "commonest_word": math.sqrt(max(times.values(), default=0) / k), "words_again": math.sqrt(again / k),
        "repeated_windows": math.sqrt(sum(v for v in windows.values() if v > 1) / max(len(w) - 2, 1)),
        "lines": math.log1p(len(lines)), "words_a_line": math.log1p(len(w) / max(len(lines), 1)),
        "repeated_lines": math.sqrt((len(lines) - len({x.lower() for x in lines})) / max(len(lines), 1)),
        "kinds": len({kind(c) for c in text}) / KINDS, "one": 1.0,
    }
    return np.concatenate([np.sqrt(pairs / n), [figures[s] for s in STATISTICS]])


def test_figures_equal_plain_ones():
    rng = random.Random(1)
    texts = [t for _, t in ODD] + ["".join(rng.choices("aB3 \n.,#é€\U0001f600", k=rng.randrange(200))) for _ in range(40)]
    texts += ["the the the cat\nsat sat. the the the cat\n\nTHE END", "x" * 300_000, "a b " * 100_000]
    got = shapes(texts_of(pa.array(texts, pa.string())))
    assert got.shape == (len(texts), FEATURES)
    for text, row in zip(texts, got, strict=True):
        assert np.allclose(row, plain(text), atol=1e-5), repr(text)[:80]
    assert shapes(texts_of(pa.array([], pa.string()))).shape == (0, FEATURES)


def prose(rng):
    return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.4 else "".join(rng.choices("aeinrst", k=rng.randrange(3, 9))) for _ in range(rng.randrange(30, 90))) + "."


def junk(rng):
    kinds = [lambda: " ".join(w + rng.choice(["###", "$$$", "|"]) for w in prose(rng).split()), lambda: prose(rng).upper().replace(" ", "!! "), lambda: f"{rng.choice(['buy', 'now'])} " * 60]
    return rng.choice(kinds)()


def corpus(rng, size, share):
    return [(i, prose(rng) if (good := rng.random() < share) else junk(rng), good) for i in range(size)]


@pytest.mark.parametrize("share", [0.85, 0.4])
def test_share_and_accuracy_without_bad_labels(spark, table_of, share):
    rng = random.Random(int(100 * share))
    rows = corpus(rng, 1500, share)
    labels = spark.createDataFrame([(i, 1, 0) for i, _, good in rows if good and rng.random() < 0.4], LABELS)
    got = {r["doc_id"]: r for r in quality_scores(table_of([r[:2] for r in rows]), labels, crc_mod("doc_id", 3) != 1).collect()}
    held = [(got[i]["predicted"] == int(good)) for i, _, good in rows if got[i]["held_out"]]
    assert len(held) > 400 and np.mean(held) >= 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())


def test_prior_is_near_the_true_share(spark, table_of):
    rng = random.Random(5)
    rows = corpus(rng, 2000, 0.6)
    shaped = pu_quality.shaped(table_of([r[:2] for r in rows]), "doc_id").persist()
    good = [i for i, _, g in rows if g and i % 2]
    model = fit_quality(shaped.select("shape"), shaped.where(F.col("doc_id").isin(good)).select("shape"))
    assert -0.03 < model.prior - 0.6 < 0.1  # with few rows the bound is least at a low score, so the share comes out large


def test_no_step_ends_with_a_bad_part_far_below_zero(monkeypatch):
    """With more figures than texts the plain risk would fall without end; the non-negative one does not."""
    rng = np.random.default_rng(2)
    good, every = rng.normal(size=(12, FEATURES)), rng.normal(size=(30, FEATURES))

    def of(x, w):
        f = x @ w
        p = 0.5 * (1 + np.tanh(f / 2))
        return Sums(len(x), f.mean(), np.logaddexp(0, f).mean(), x.mean(0), p @ x / len(x), x.T @ (x * (p * (1 - p))[:, None]) / len(x))

    monkeypatch.setattr(pu_quality, "_sums", lambda rows, scale, w: (of(good, w), of(every, w)))
    w = fit_nonnegative(None, None, 0.7)
    p, u = of(good, w), of(every, w)
    assert u.up - 0.7 * p.up >= -0.05
    at_zero = 0.7 * math.log(2) + max(0, 0.3 * math.log(2))
    assert 0.7 * (p.up - p.f) + max(0, u.up - 0.7 * p.up) < at_zero


def test_held_out_labels_and_other_columns_say_nothing(spark, table_of):
    rng = random.Random(7)
    rows = corpus(rng, 400, 0.7)
    df, rule = table_of([r[:2] for r in rows]), crc_mod("doc_id", 3) != 1
    labels = [(i, int(good), 0) for i, _, good in rows if rng.random() < 0.5]
    held = {r["doc_id"] for r in quality_scores(df, spark.createDataFrame(labels, LABELS), rule).collect() if r["held_out"]}
    flipped = [(i, 1 - q if i in held else q, 1) for i, q, _ in labels]
    score = lambda table, marks: sorted((r["doc_id"], round(r["score"], 9)) for r in quality_scores(table, spark.createDataFrame(marks, LABELS), rule).collect())
    assert score(df, labels) == score(df.withColumn("lang", F.lit("xx")).withColumn("source", F.col("doc_id").cast("string")), flipped)


def test_odd_rows_empty_tables_and_clashing_columns(spark, table_of):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, 1, 0), (None, 1, 0), (6, None, None), (7, 1, 0)], LABELS)
    rule = crc_mod("doc_id", 3) != 1
    odd = table_of(ODD).select("*", *[F.lit(1).alias(c) for c in ("score", "shape", "quality", "grp", "half", "salt")], F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    got = quality_scores(odd, labels, rule).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(i for i, _ in ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert quality_scores(table_of([]), labels, rule).collect() == []
    nothing = quality_scores(table_of(ODD), spark.createDataFrame([], LABELS), rule).collect()
    assert {r["score"] for r in nothing} == {0.5}


def test_labels_of_a_document_must_agree(spark):
    rows = spark.createDataFrame([(i, bytes(4)) for i in (1, 2, 3, None)], "doc_id long, shape binary")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 1, 0), (2, 0, 0), (None, 1, 0)], LABELS)
    assert pu_quality.trusted(rows, labels).count() == 1


def test_labels_never_meet_in_the_driver(spark, folder):
    """A small file of labels with successive ids opens to many rows; one common id has many documents, another many labels."""
    n = 30_000
    ids = F.when(F.col("id") < 500, F.lit(-1)).otherwise(F.col("id"))
    rows = spark.range(n).select(ids.alias("doc_id"), F.encode(F.col("id").cast("string"), "utf-8").alias("shape"))
    marks = spark.range(n).select(F.when(F.col("id") < 500, F.lit(-1)).when(F.col("id") > n - 500, F.lit(-2)).otherwise(F.col("id")).alias("doc_id"), (F.col("id") % 3 != 2).cast("int").alias("quality"))
    marks.where("doc_id <> -1 or quality = 1").coalesce(1).write.parquet(folder + "/labels")
    labels = spark.read.parquet(folder + "/labels")
    good = pu_quality.trusted(rows, labels)
    assert "Broadcast" not in good._jdf.queryExecution().executedPlan().toString()
    expected = [str(i) for i in range(n) if i < 500 or i <= n - 500 and i % 3 != 2]
    got = good.select(F.decode("shape", "utf-8").alias("shape"))
    assert sorted(r["shape"] for r in got.collect()) == sorted(expected)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()  # as it ran


def test_tell_apart_and_prior_on_known_scores(spark):
    """All good rows at one figure, unlabelled ones there and at another: the share is a plain ratio."""
    x = np.zeros((2, FEATURES), np.float32)
    x[0, 0], x[:, -1] = 1, 1
    good, bad = (r.tobytes() for r in x)
    rows = spark.createDataFrame([(0, good)] * 3000 + [(1, good)] * 2100 + [(1, bad)] * 900, "grp int, shape binary")
    scale = Scale(np.zeros(FEATURES), np.ones(FEATURES))
    assert abs(class_prior(rows, scale, tell_apart(rows, scale)) - 0.7) < 1e-9


def test_held_out_labels_of_the_given_table(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in pu_quality.op13(spark, folder).collect()}
    rows = [(r["quality"], got[r["doc_id"]]) for r in spark.read.parquet(f"{folder}/labels.parquet").collect()]
    held = [(q, r["score"]) for q, r in rows if r["held_out"]]
    assert np.mean([q == int(s >= 0.5) for q, s in held]) >= 0.93
    bad, good = ([s for q, s in held if q == k] for k in (0, 1))
    assert np.mean([[b < g for g in good] for b in bad]) >= 0.95
