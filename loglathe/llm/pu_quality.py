"""Quality scores from trusted good texts and unlabelled ones: positive-unlabelled learning with a non-negative risk.

A linear model f over the figures of ``text_shape`` is fitted with the logistic loss.  With the share of good texts among the unlabelled, p, the risk

    p * mean over good of loss(f)  +  max(0, mean over unlabelled of loss(-f)  -  p * mean over good of loss(-f))

needs no bad examples: the second part estimates what bad texts cost, without bias while it is not below zero.  Where a step would bring it below,
the step is undone by going up that part, so the model can't gain from good texts that it has learned by heart.

The share p is estimated first: good texts are told from unlabelled ones, and where the scores are highest the unlabelled are good
almost only, so the ratio of what lies above a score, at the score where its bound is least, is the share.  That model is learned on one half of
the texts and the ratio is taken on the other.

Each step is one pass over all good and all unlabelled rows: tasks add up their part of the sums, Spark adds the parts, and the driver sees a
matrix of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import binary_array, crc_mod, map_arrow, query, small_batches, stored, table
from loglathe.llm.text_shape import FEATURES, shapes
from loglathe.llm.textops import texts_of

RIDGE = 1e-3
ROUNDS = 15
ENOUGH = 1e-6
BINS = 1024
#: the share's bound holds with probability 1 - CHANCE; SLACK weighs the error of the ratio
CHANCE, SLACK = 0.1, 0.01
SALTS = 16
_GOOD, _ALL = 0, 1
_TRIANGLE = np.triu_indices(FEATURES)


def _softplus(f: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, f)


def _sigmoid(f: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(f / 2))


def shaped(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``shape``, the figures of ``text`` as bytes; null texts are empty."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = shapes(texts_of(batch["text"]))
        return pa.record_batch([*[batch[c] for c in keep], binary_array([r.tobytes() for r in rows])], names=[*keep, "shape"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(docs.select("text", *keep), run, f"{kinds}, shape binary")


def _matrix(shape: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(shape.to_pylist()), np.float32).reshape(-1, FEATURES).astype(float)


def _added(rows: DataFrame, fn, size: int) -> np.ndarray:
    """``fn(group, matrix)``, arrays of one length, summed over all rows (grp, shape): one line for each of the two groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, size))
        for batch in batches:
            groups, x = np.asarray(batch["grp"]), _matrix(batch["shape"])
            for g in (_GOOD, _ALL):
                if (groups == g).any():
                    sums[g] += fn(x[groups == g])
        yield pa.record_batch([pa.array([_GOOD, _ALL], pa.int32()), pa.array(list(sums), pa.list_(pa.float64()))], names=["grp", "sums"])

    parts = rows.select("grp", "shape").mapInArrow(run, "grp int, sums array<double>")
    out = np.zeros((2, size))
    for r in parts.select("grp", F.posexplode("sums").alias("at", "x")).groupBy("grp", "at").agg(F.sum("x").alias("x")).collect():
        out[r["grp"], r["at"]] = r["x"]
    return out


@dataclass
class Scale:
    """Figures come to mean 0 and spread 1 over the unlabelled; constant ones stay as they are."""

    mean: np.ndarray
    spread: np.ndarray

    def of(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.spread


def fit_scale(rows: DataFrame) -> Scale:
    sums = _added(rows, lambda x: np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)]), 2 * FEATURES + 1)[_ALL]
    n = max(sums[0], 1.0)
    mean = sums[1 : FEATURES + 1] / n
    spread = np.sqrt(np.maximum(sums[FEATURES + 1 :] / n - mean**2, 0))
    constant = spread < 1e-6
    return Scale(np.where(constant, 0.0, mean), np.where(constant, 1.0, spread))


@dataclass
class Sums:
    """What a risk, its slope and its curvature are made of, as means over one group of rows."""

    n: float
    f: float
    up: float  # softplus of f
    x: np.ndarray
    p: np.ndarray  # sigmoid of f, times x
    curve: np.ndarray


def _sums(rows: DataFrame, scale: Scale, w: np.ndarray) -> tuple[Sums, Sums]:
    def fn(x: np.ndarray) -> np.ndarray:
        x = scale.of(x)
        f = x @ w
        p = _sigmoid(f)
        return np.concatenate([[len(x), f.sum(), _softplus(f).sum()], x.sum(0), p @ x, (x.T @ (x * (p * (1 - p))[:, None]))[_TRIANGLE]])

    out = []
    for line in _added(rows, fn, 3 + 2 * FEATURES + len(_TRIANGLE[0])):
        n = max(line[0], 1.0)
        curve = np.zeros((FEATURES, FEATURES))
        curve[_TRIANGLE] = line[3 + 2 * FEATURES :] / n
        curve += np.triu(curve, 1).T
        out.append(Sums(line[0], line[1] / n, line[2] / n, line[3 : 3 + FEATURES] / n, line[3 + FEATURES : 3 + 2 * FEATURES] / n, curve))
    return out[0], out[1]


def tell_apart(rows: DataFrame, scale: Scale, rounds: int = ROUNDS) -> np.ndarray:
    """Logistic weights that tell good rows from unlabelled ones, both groups with the same weight in all."""
    w, last = np.zeros(FEATURES), np.inf
    for _ in range(rounds):
        good, every = _sums(rows, scale, w)
        risk = (good.up - good.f + every.up) / 2 + RIDGE / 2 * w @ w
        if last - risk < ENOUGH:
            break
        last = risk
        slope = (good.p - good.x + every.p) / 2 + RIDGE * w
        w = w - np.linalg.solve((good.curve + every.curve) / 2 + RIDGE * np.eye(FEATURES), slope)
    return w


def class_prior(rows: DataFrame, scale: Scale, w: np.ndarray) -> float:
    """The share of good texts among the unlabelled ``rows``, by the ratio above the score with the least bound."""
    line = np.linspace(0, 1, BINS + 1)[1:-1]

    def fn(x: np.ndarray) -> np.ndarray:
        return np.bincount(np.searchsorted(line, _sigmoid(scale.of(x) @ w), "right"), minlength=BINS).astype(float)

    above = _added(rows, fn, BINS)[:, ::-1].cumsum(1)
    good, every = above / np.maximum(above[:, -1:], 1)
    noise = sum(np.sqrt(np.log(4 / CHANCE) / (2 * max(n, 1.0))) for n in above[:, -1])
    some = good > 0
    if not some.any():
        return 0.5
    bound = np.where(some, (every + (1 + SLACK) * noise) / np.where(some, good, 1), np.inf)
    at = int(bound.argmin())
    return float(np.clip(every[at] / good[at], 0.01, 0.99))


def fit_nonnegative(rows: DataFrame, scale: Scale, prior: float, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of least non-negative risk found in ``rounds`` passes, by Newton steps.

    The risk is convex while its second part is not below zero.  Where it is, the next step goes from there up the second part, as far as
    is needed to bring it back to zero in its linear approximation.
    """
    w, best, best_risk = np.zeros(FEATURES), np.zeros(FEATURES), np.inf
    for _ in range(rounds):
        good, every = _sums(rows, scale, w)
        bad_part = every.up - prior * good.up
        risk = prior * (good.up - good.f) + max(0.0, bad_part) + RIDGE / 2 * w @ w
        gain = best_risk - risk
        if gain > 0:
            best, best_risk = w, risk
        if bad_part < -ENOUGH:
            slope = every.p - prior * good.p
            w = w - bad_part / max(slope @ slope, 1e-12) * slope
            continue
        if 0 <= gain < ENOUGH:
            break
        slope = every.p - prior * good.x + RIDGE * w
        step = np.linalg.solve(every.curve + RIDGE * np.eye(FEATURES), slope)
        if gain < 0:  # too far: half way back to the best
            w = (w + best) / 2
            continue
        w = w - step
    return best


@dataclass
class QualityModel:
    scale: Scale
    weights: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.scale.of(x) @ self.weights)


def fit_quality(unlabelled: DataFrame, good: DataFrame) -> QualityModel | None:
    """The model from ``shape`` columns of unlabelled rows and of trusted good ones; None where one of them is empty."""
    half = F.pmod(F.xxhash64("shape"), F.lit(2)).alias("half")
    both = good.select(F.lit(_GOOD).alias("grp"), "shape", half).unionAll(unlabelled.select(F.lit(_ALL).alias("grp"), "shape", half))
    rows = stored(both, "learning")
    if len(rows.groupBy("grp").count().collect()) < 2:
        return None
    scale = fit_scale(rows)
    prior = class_prior(rows.where("half = 1"), scale, tell_apart(rows.where("half = 0"), scale))
    return QualityModel(scale, fit_nonnegative(rows, scale, prior), prior)


def trusted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``shape`` of the rows (doc_id, shape) whose labels all say quality 1.

    The few bytes of a label go to several places, so that rows of one very common id don't meet in one task.  Both sides are dealt out and sorted:
    Spark would take the labels for as small as their compressed file, and build all of them SALTS times over in the driver to send them round.
    """
    ids = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.coalesce("quality", F.lit(0))).alias("quality")).where("quality = 1")
    spread = ids.select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.where("doc_id is not null").select("doc_id", "shape", F.pmod(F.xxhash64("shape"), F.lit(SALTS)).cast("int").alias("salt"))
    return salted.join(spread.hint("merge"), ["doc_id", "salt"], "left_semi").select("shape")


def quality_scores(docs: DataFrame, labels: DataFrame, train_rule: Column) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs`` (doc_id, text); ``labels`` has doc_id and quality.

    Learns from rows where ``train_rule`` holds (null counts as true): all of them unlabelled, and of those the ones whose labels all say 1 as good
    ones; other labels say nothing.  Null texts are empty and have a score like any.  Repeated rows count as often as they are there; a
    null id has no label.  Texts of any length are read whole.  If nothing can be learned every score is 0.5.  An empty table gives no rows.
    Other columns are left out, whatever their names.
    """
    small_batches(docs.sparkSession)
    held_out = ~F.coalesce(train_rule, F.lit(True))
    rows = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    rows = stored(shaped(rows, "doc_id", "held_out"), "shapes")
    training = rows.where("not held_out")
    model = fit_quality(training.select("shape"), trusted(training, labels))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.scores(_matrix(batch["shape"])) if model else np.full(batch.num_rows, 0.5)
        return pa.record_batch(
            [batch["doc_id"], batch["held_out"], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"]
        )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, run, f"doc_id {kind}, held_out boolean, score double, predicted int")


@query("op13_quality_classifier")
def op13(spark, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_mod("doc_id", 3) != 1)
