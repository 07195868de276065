"""Models that learn from every row, however many there are."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loglathe.llm import pii, trees
from loglathe.llm.automata import FormatAutomaton
from loglathe.llm.secrets_scan import infer_grammar, scan
from loglathe.llm.trees import Boosted


def test_personal_data_is_learned_from_all_examples(spark):
    """60,000 examples, of which 60 tell what a sample of a third of them would hardly show."""
    n = 60_000
    rare, good = F.col("id") % 1000 == 7, F.col("id") % 2 == 0
    x = F.array(F.lit(3.0), F.when(rare, 1.0).otherwise(0.0), (F.col("id") % 50).cast("double"))
    lesson = F.struct(F.when(rare, 1).when(good, 1).otherwise(0).alias("label"), x.alias("x"))
    none = F.expr("array()").cast("array<struct<kind: string, start: int, end: int>>")
    scanned = spark.range(n).select(F.col("id").alias("doc_id"), none.alias("strict"), F.array(lesson).alias("taught"))
    lessons = pii.lessons_of(scanned)
    assert lessons.agg(F.sum("n")).first()[0] == n
    total, yes = lessons.where("not held").agg(F.sum("n"), F.sum(F.col("n") * F.col("label"))).first()
    model, _ = pii.fit(scanned)
    assert model.base == pytest.approx(np.log(yes / (total - yes)), abs=1e-12)


def test_trees_grown_by_tasks_equal_those_in_memory(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (3000, 4)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3)).astype(np.int64)
    local, dealt = Boosted(rounds=4).fit(x, y), Boosted(rounds=4)
    dealt.prepare([np.unique(x[:, j], return_counts=True) for j in range(4)], y.mean())
    bins = dealt.binned(x).astype(np.uint8)
    rows = spark.createDataFrame([(b.tobytes(), int(t), 1) for b, t in zip(bins, y, strict=True)], "bins binary, label int, n long").repartition(7)
    monkeypatch.setattr(trees, "FEW", 0)
    dealt.fit_rows(rows)
    assert len(dealt.trees) == 4
    for one, other in zip(local.trees, dealt.trees, strict=True):
        assert all(np.array_equal(a, b) for a, b in zip(one, other, strict=True))
    assert np.mean((local.probability(x) > 0.5) == y) > 0.95


def test_secrets_are_learned_from_all_values(table_of):
    rows = [(i, f"plain words of text {hashlib.md5(str(i).encode()).hexdigest()} behind") for i in range(4000)]
    grammar = infer_grammar(scan(table_of(rows)))
    assert grammar.automata["hex", 0].states[0].visits > 2500
    assert sum(m.visits for m in grammar.automata["hex", 0].states) > 33 * 2500


def test_a_tree_from_counts_of_parts_equals_that_of_all():
    rng = random.Random(8)
    values = ["".join(rng.choices("abc123", k=rng.randrange(6, 30))) for _ in range(400)] + [f"key-{rng.randrange(10**6)}" for _ in range(400)] + ["x" * 400]
    whole, parts = FormatAutomaton(values), FormatAutomaton()
    while parts.open:
        counts = parts.count(values[::3])
        counts.update(parts.count(values[1::3]))
        counts.update(parts.count(values[2::3]))
        parts.grow(counts)
    parts.finish()
    assert parts.total == 801 and [s.taken for s in whole.states] == [s.taken for s in parts.states]
    assert all(whole.bits(v) == parts.bits(v) for v in values)
