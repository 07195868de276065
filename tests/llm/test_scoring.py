"""HMM scores and language identification."""

import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglathe.llm.common import crc_mod
from loglathe.llm.hmm_scoring import CLASSES, Model, Sequences, _empty_counts, score_documents
from loglathe.llm.language_id import identify
from rows import ODD, words


def paths(model, seq):
    """Probability of each state path, one by one."""
    for path in itertools.product(range(len(model.start)), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[seq[0], path[0]]
        for a, b, c in zip(path, path[1:], seq[1:], strict=False):
            p *= model.step[a, b] * model.emit[c, b]
        yield path, p


@pytest.fixture()
def model():
    r = np.random.default_rng(1)
    start, step, emit = r.random(3), r.random((3, 3)), r.random((CLASSES, 3))
    return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))


def test_forward_and_expected_counts_equal_the_sum_over_paths(model):
    r = np.random.default_rng(2)
    seqs = [r.integers(0, 6, n) for n in (4, 1, 5, 2, 5)]
    got = Sequences(seqs).forward(model)
    assert np.allclose(got, [math.log(sum(p for _, p in paths(model, s))) for s in seqs])
    counts, expected = _empty_counts(3), _empty_counts(3)
    Sequences(seqs).expected(model, *counts)
    for s in seqs:
        total = sum(p for _, p in paths(model, s))
        for path, p in paths(model, s):
            expected[0][path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                expected[1][a, b] += p / total
            for c, k in zip(s, path, strict=True):
                expected[2][c, k] += p / total
    assert all(np.allclose(a, b) for a, b in zip(counts, expected, strict=True))


def test_baum_welch_never_lowers_the_likelihood(model):
    r = np.random.default_rng(3)
    together = Sequences([r.integers(0, 9, 40) for _ in range(20)])
    last = -math.inf
    for _ in range(8):
        counts = _empty_counts(3)
        now = together.expected(model, *counts)
        assert now >= last - 1e-9
        last = now
        start, step, emit = counts
        model = Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))


def texts(n, seed=4):
    """Texts of two kinds with words of their own."""
    rng = random.Random(seed)
    kinds = [[f"{c}{i}" for i in range(400)] for c in "xy"]
    return [(i, " ".join(rng.choices(kinds[i % 2], k=rng.randrange(5, 60)))) for i in range(n)]


def test_base_scores_equal_brute_force(table_of):
    rows = texts(150) + [(900, None), (901, ""), (902, "never seen BEFORE"), (3, texts(4)[3][1])]
    rule = crc_mod("doc_id", 7) != 2
    got = score_documents(table_of(rows), rule, states=3, rounds=1).collect()
    counts = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*words(t), None])
    total, types = sum(counts.values()), len(counts)
    assert len(got) == len(rows)
    by_id = {i: [*words(t), None] for i, t in rows}
    for r in got:
        tokens = by_id[r["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
        assert (r["n_tokens"], r["train_tokens"]) == (len(tokens), total)
        assert r["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in tokens))


def test_states_help_on_texts_that_were_not_seen(table_of):
    got = score_documents(table_of(texts(400)), crc_mod("doc_id", 7) != 2, states=4).where("held_out").collect()
    assert sum(r["score"] for r in got) > 0.97 * sum(r["base_score"] for r in got)
    assert all(r["score"] < 0 for r in got)


def test_odd_rows_scores(table_of):
    docs = table_of(ODD).withColumn("train", F.lit("clash")).withColumn("uid", F.lit(1))
    got = score_documents(docs, crc_mod("doc_id", 7) != 2, states=2, rounds=1).collect()
    assert len(got) == len(ODD) and all(math.isfinite(r["score"]) for r in got)
    assert all(r["held_out"] is False for r in got if r["doc_id"] is None)
    none = score_documents(table_of(ODD), F.lit(False), states=2, rounds=1).collect()
    assert {r["base_score"] for r in none} == {0.0} and {r["train_tokens"] for r in none} == {0}
    assert score_documents(table_of([]), F.lit(True), states=2, rounds=1).collect() == []


def language_texts():
    rng = random.Random(5)
    parts = {"aa": ("tion", "ing", "the", "er"), "bb": ("sch", "ung", "ein", "keit"), "cc": ("ção", "ão", "nh", "os")}
    rows = []
    for i in range(240):
        lang = sorted(parts)[i % 3]
        rows.append((i, " ".join("".join(rng.choices(parts[lang], k=3)) for _ in range(rng.randrange(3, 40))), "s", lang))
    return rows


def test_languages_of_texts_that_were_not_seen(table_of):
    rows = language_texts()
    got = identify(table_of(rows), crc_mod("doc_id", 4) != 2).collect()
    truth = {r[0]: r[3] for r in rows}
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


def test_odd_rows_languages(table_of):
    rows = language_texts() + [(1000 + n, t, "s", None) for n, (_, t) in enumerate(ODD)] + [(2000, "12 34 !", "s", "aa"), (2001, "x" * 50_000, "s", None)]
    docs = table_of(rows).withColumn("lang_pred", F.lit("clash"))
    got = {r["doc_id"]: r for r in identify(docs, F.lit(True)).collect()}
    assert {got[i]["lang_pred"] for i in (1000, 1001, 1002, 1005, 2000)} == {"und"} and got[1000]["score"] == 0
    assert got[1003]["lang_pred"] in ("aa", "bb", "cc") and got[2001]["lang_pred"] in ("aa", "bb", "cc")
    none = identify(table_of(rows), F.lit(False)).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert identify(table_of([]), F.lit(True)).collect() == []


def plain_languages(rows, train):
    """Prototypes and predictions text by text, trigram by trigram."""
    from loglathe.llm.language_id import DIMENSIONS, _letter_vector

    def bundle(text):
        letters = [c.lower() if len(c.lower()) == 1 else c for c in text or ""]
        symbols = [c if o.isalpha() else " " for c, o in zip(letters, text or "", strict=True)]
        line = " " + " ".join("".join(symbols).split()) + " "
        out, n = np.zeros(DIMENSIONS), 0
        for a, b, c in zip(line, line[1:], line[2:], strict=False):
            if b != " ":
                one, two, three = (_letter_vector(ord(x)) for x in (a, b, c))
                out += np.roll(one, 2) * np.roll(two, 1) * three
                n += 1
        return out, n

    sums = {}
    for i, text, language in rows:
        vector, n = bundle(text)
        if train(i) and language is not None and n:
            sums[language] = sums.get(language, 0) + vector / n
    unit = {k: v / np.linalg.norm(v) for k, v in sums.items()}
    for i, text, _ in rows:
        vector, n = bundle(text)
        cosine = {k: float(v @ vector / np.linalg.norm(vector)) for k, v in unit.items()} if n else {}
        best = max(sorted(cosine), key=cosine.get) if cosine else "und"
        yield i, best, min(1.0, max(0.0, cosine.get(best, 0.0)))


@pytest.mark.parametrize("block", [1 << 15, 64])
def test_languages_equal_brute_force(spark, monkeypatch, block):
    import loglathe.llm.language_id as module

    monkeypatch.setattr(module, "BLOCK", block)
    rng = random.Random(5)
    scripts = {"a": "abcdeé", "b": "fghij k", "c": "".join(map(chr, range(0x4E00, 0x4E40)))}
    rows = [(i, "".join(rng.choices(scripts[k] + " .1", k=rng.randrange(1, 90))), k) for i in range(90) for k in [rng.choice("abc")]]
    rows += [(900, None, "a"), (901, "", "b"), (902, "12 !", "c"), (903, "abc abc", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    got = {r["doc_id"]: (r["lang_pred"], round(r["score"], 4)) for r in identify(df, F.col("doc_id") % 4 != 2).collect()}
    want = {i: (k, round(s, 4)) for i, k, s in plain_languages(rows, lambda i: i % 4 != 2)}
    assert {i: k for i, (k, _) in got.items()} == {i: k for i, (k, _) in want.items()}
    assert all(abs(got[i][1] - want[i][1]) < 2e-3 for i in want)


def test_a_large_script_takes_bounded_memory():
    """A batch of 16 MB in a script of three thousand letters, in a process of its own."""
    import subprocess
    import sys

    code = (
        "import sys, random, resource; sys.path.insert(0, sys.argv[1])\n"
        "import numpy as np\nfrom loglathe.llm.language_id import Trigrams\n"
        "r = random.Random(1)\n"
        "texts = [''.join(chr(0x4E00 + r.randrange(3000)) for _ in range(5600)) for _ in range(1000)]\n"
        "g = Trigrams(texts)\nv = g.bundled(np.arange(1000)[g.text] * 0, g.counts, 1)\n"
        "print(len(g.distinct), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)\n"
    )
    root = __file__.rsplit("/tests/", 1)[0]
    out = subprocess.run([sys.executable, "-c", code, root], capture_output=True, text=True, timeout=300, check=True)
    distinct, megabytes = map(int, out.stdout.split())
    assert distinct > 4_000_000 and megabytes < 1500, out.stdout
