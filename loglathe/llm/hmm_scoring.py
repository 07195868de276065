"""Scores of texts under a hidden Markov language model.

Words are counted over all training texts. The commonest get a class of their own, the others share 128 classes by their last letters; a state emits
a class, and a class its word with the probability that counts give. Baum-Welch starts from a model fitted to a bounded sample
of text pieces, then runs over all training texts: each task sums its expected counts, Spark sums those of the tasks.
Texts are scored whole by the scaled forward recursion, many at a time.

The model's size is fixed. Counts of the commonest words go to the tasks; the rest, rare by definition, are joined by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import bounded_sample, crc_mod, list_array, long_array, map_arrow, query, small_batches, stored, table
from loglathe.llm.textops import Texts, lower_bytes, mix, texts_of, words_of

STATES = 12
OWN_CLASSES = 4096
SHARED_CLASSES = 128
_CLASS_BITS = np.uint64(SHARED_CLASSES - 1)
CLASSES = OWN_CLASSES + SHARED_CLASSES
#: words whose counts every task holds, 2 MB
HEAD_WORDS = 131_072
END = np.uint64(0x5DEECE66D1CE4E5B)
#: training sequences are cut to pieces of so many tokens, all of which count
PIECE = 512
#: the bounded sample that the first model is fitted to
SAMPLE_PIECES, SAMPLE_ROUNDS = 1024, 20
ROUNDS = 2
SMOOTH = 0.1


@dataclass
class Vocabulary:
    """Counts of the head words in order of hash, totals, and what the classes need."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    tokens: int
    types: int
    shared_logs: np.ndarray  # log10 of tokens + types + 1 of each shared class

    @property
    def base_log(self) -> float:
        return float(np.log10(self.tokens + self.types + 1))

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word is in the head, its count if so, and its class."""
        if not len(self.words):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64), _shared(hashes)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[at] == hashes
        return known, np.where(known, self.counts[at], 0), np.where(known, self.classes[at], _shared(hashes))


def _shared(hashes: np.ndarray) -> np.ndarray:
    return OWN_CLASSES + (hashes % np.uint64(SHARED_CLASSES)).astype(np.int64)


@dataclass
class Model:
    start: np.ndarray  # [K]
    step: np.ndarray  # [K, K]
    emit: np.ndarray  # [C, K], each column sums to one

    @staticmethod
    def from_counts(start: np.ndarray, step: np.ndarray, emit: np.ndarray, prior: np.ndarray) -> Model:
        """``prior`` [C], the classes' share of all tokens, keeps every probability above zero."""
        start, step = start + SMOOTH, step + SMOOTH
        emit = emit + SMOOTH * CLASSES * prior[:, None]
        return Model(start / start.sum(), step / step.sum(1, keepdims=True), emit / emit.sum(0))


def word_ids(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, with its shared class in the lowest bits, and per text the place of its first word.

    The class follows from the last letters, which tell more of a word than nothing when it is rare.
    """
    words = words_of(texts)
    last = np.zeros(len(words.ends), np.uint64)
    for k in (1, 2, 3):
        at = words.ends - k
        letter = np.where(at >= words.starts, lower_bytes(texts.data)[np.maximum(at, 0)], 0) if len(at) else last
        last = last * np.uint64(256) + letter.astype(np.uint64)
    return words.hashes & ~_CLASS_BITS | mix(last + np.uint64(1)) & _CLASS_BITS, words.first


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` over the training rows of ``docs`` (text, train): counts per batch, then summed. The end counts as a word."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, _ = word_ids(texts_of(batch["text"]))
        words, n = np.unique(np.append(hashes, np.full(batch.num_rows, END)), return_counts=True)
        return pa.record_batch([long_array(words), pa.array(n.astype(np.int64))], names=["word", "n"])

    rows = map_arrow(docs.where("train").select("text"), run, "word long, n long")
    return stored(rows.groupBy("word").agg(F.sum("n").alias("n")), "counts")


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The head is collected, at most ``HEAD_WORDS`` rows; totals come from all words.

    Where the head ends is read off a histogram of counts in steps of four in a hundred, a few hundred rows.
    """
    step = F.floor(16 * F.log2("n")).cast("int").alias("step")
    steps = counts.groupBy(step).count().orderBy(F.desc("step")).collect()
    sizes = np.cumsum([r["count"] for r in steps])
    fitting = int(np.searchsorted(sizes, HEAD_WORDS, "right"))
    least = steps[fitting - 1]["step"] if fitting else 1 << 30
    head = sorted(counts.where(step >= least).collect(), key=lambda r: (-r["n"], r["word"]))
    words = np.array([r["word"] for r in head], np.int64).view(np.uint64)
    n = np.array([r["n"] for r in head], np.int64)
    classes = np.where(np.arange(len(words)) < OWN_CLASSES, np.arange(len(words)), _shared(words))
    # 2**64 is a multiple of the number of shared classes, so signed and unsigned hashes agree
    sums = counts.groupBy(F.pmod("word", F.lit(SHARED_CLASSES)).alias("c")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    tokens, types = np.zeros(SHARED_CLASSES, np.int64), np.zeros(SHARED_CLASSES, np.int64)
    for r in sums:
        tokens[r["c"]], types[r["c"]] = r["n"], r["v"]
    whole = int(tokens.sum()), int(types.sum())
    own = _shared(words[:OWN_CLASSES]) - OWN_CLASSES
    np.subtract.at(tokens, own, n[:OWN_CLASSES])
    np.subtract.at(types, own, 1)
    order = np.argsort(words)
    return Vocabulary(words[order], n[order], classes[order], *whole, np.log10(tokens + types + 1))


def encode(docs: DataFrame, v: Vocabulary) -> DataFrame:
    """Per row: its classes as uint16, sums over head words, and the words outside the head with their numbers."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, first = word_ids(texts_of(batch["text"]))
        rows = batch.num_rows
        hashes = np.insert(found, first[1:], END)
        first = first + np.arange(rows + 1)
        known, counts, classes = v.lookup(hashes)
        base = np.where(known, np.log10(counts + 1.0) - v.base_log, 0.0)
        shared = known & (classes >= OWN_CLASSES)
        inside = np.zeros(len(hashes))
        inside[shared] = np.log10(counts[shared] + 1.0) - v.shared_logs[classes[shared] - OWN_CLASSES]
        sums = [np.concatenate([[0.0], np.cumsum(x)]) for x in (base, inside, known)]
        base, inside, known_n = (s[first[1:]] - s[first[:-1]] for s in sums)
        owner = np.repeat(np.arange(rows), np.diff(first))[~known]
        rare = hashes[~known]
        order = np.lexsort((rare, owner))
        rare, owner = rare[order], owner[order]
        begins = np.flatnonzero(np.concatenate([[True], (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1])])) if len(rare) else np.zeros(0, int)
        times = np.diff(np.append(begins, len(rare)))
        at = np.searchsorted(owner[begins], np.arange(rows + 1), "left")
        raw = classes.astype("<u2")
        return pa.record_batch(
            [
                batch["doc_id"], batch["uid"], batch["train"], pa.array(np.diff(first), pa.int64()), pa.array(known_n.astype(np.int64)),
                pa.array(base), pa.array(inside), pa.array([raw[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()),
                list_array(long_array(rare[begins]), at), list_array(pa.array(times, pa.int32()), at),
            ],
            names=_ENCODED,
        )

    return stored(
        map_arrow(
            docs.select("doc_id", "uid", "train", "text"),
            run,
            "doc_id long, uid long, train boolean, n_tokens long, head_tokens long, head_base double, head_inside double, classes binary, rare array<long>, times array<int>",
        ),
        "encoded",
    )


_ENCODED = ["doc_id", "uid", "train", "n_tokens", "head_tokens", "head_base", "head_inside", "classes", "rare", "times"]


class Sequences:
    """Several sequences, longest first, walked side by side."""

    def __init__(self, sequences: list[np.ndarray]) -> None:
        lengths = np.array([len(s) for s in sequences])
        self.order = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[self.order]
        self.flat = np.concatenate([sequences[i] for i in self.order])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.active = len(self.lengths) - np.searchsorted(self.lengths[::-1], np.arange(self.lengths[0] + 1), "right")

    def forward(self, model: Model, keep: bool = False):
        """Natural logs of the likelihoods, in the given order; with ``keep`` also what the backward pass needs."""
        logs = np.zeros(len(self.lengths))
        alpha, kept = None, []
        for t in range(int(self.lengths[0])):
            n = self.active[t]
            emitted = model.emit[self.flat[self.starts[:n] + t]]
            alpha = emitted * (model.start if alpha is None else alpha[:n] @ model.step)
            scale = alpha.sum(1)
            alpha /= scale[:, None]
            logs[:n] += np.log(scale)
            if keep:
                emitted /= scale[:, None]
                kept.append((alpha, emitted))
        out = np.empty_like(logs)
        out[self.order] = logs
        return (out, kept) if keep else out

    def expected(self, model: Model, start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> float:
        """Add the expected counts under the model; returns the log likelihood."""
        logs, kept = self.forward(model, keep=True)
        states = len(start)
        ahead = np.zeros((0, states))
        gammas, tokens = [], []
        for t in range(len(kept) - 1, -1, -1):
            alpha, _ = kept[t]
            n, going = len(alpha), len(ahead)  # the first of the active sequences go on
            beta = np.ones((n, states))
            if going:
                beta[:going] = ahead @ model.step.T
                step += (alpha[:going].T @ ahead) * model.step
            gammas.append(alpha * beta)
            tokens.append(self.flat[self.starts[:n] + t])
            ahead = kept[t][1] * beta
        start += gammas[-1].sum(0)
        gamma, token = np.concatenate(gammas), np.concatenate(tokens)
        for k in range(states):
            emit[:, k] += np.bincount(token, gamma[:, k], CLASSES)
        return float(logs.sum())


def _pieces(classes: bytes) -> list[np.ndarray]:
    whole = np.frombuffer(classes, "<u2").astype(np.int64)
    return [whole[a : a + PIECE] for a in range(0, len(whole), PIECE)]


def _empty_counts(states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.zeros(states), np.zeros((states, states)), np.zeros((CLASSES, states))


def sample_model(encoded: DataFrame, prior: np.ndarray, states: int) -> Model:
    """Baum-Welch on a fixed number of pieces, those with the least hashes of id and place. They are small and few: the driver fits them."""
    size = F.octet_length("classes")
    begin = F.explode(F.sequence(F.lit(0), size - 1, F.lit(2 * PIECE))).alias("at")
    pieces = encoded.where("train").select("uid", "classes", begin)
    chosen = pieces.select(F.struct("uid", "at").alias("key"), F.substring("classes", F.col("at") + 1, F.lit(2 * PIECE)).alias("piece"))
    rows = bounded_sample(chosen, F.col("key"), SAMPLE_PIECES)
    random = np.random.Generator(np.random.PCG64(2))
    emit = prior[:, None] * random.uniform(0.5, 1.5, (CLASSES, states))
    step = np.full((states, states), 1.0 / states) + 4 * np.eye(states)
    model = Model(np.full(states, 1.0 / states), step / step.sum(1, keepdims=True), emit / emit.sum(0))
    if rows:
        together = Sequences([np.frombuffer(r["piece"], "<u2").astype(np.int64) for r in rows])
        for _ in range(SAMPLE_ROUNDS):
            counts = _empty_counts(states)
            together.expected(model, *counts)
            model = Model.from_counts(*counts, prior)
    return model


def baum_welch_round(encoded: DataFrame, model: Model, prior: np.ndarray) -> Model:
    """One round over all training rows."""
    states = len(model.start)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _empty_counts(states)
        any_rows = False
        for batch in batches:
            held: list[np.ndarray] = []
            tokens = 0
            for value in batch["classes"].to_pylist():
                for piece in _pieces(value):
                    held.append(piece)
                    tokens += len(piece)
                    if tokens >= 1 << 18:
                        Sequences(held).expected(model, *counts)
                        held, tokens = [], 0
            if held:
                Sequences(held).expected(model, *counts)
            any_rows = True
        if any_rows:
            start, step, emit = counts
            rows = [start, *step, *emit.T]
            yield pa.record_batch([pa.array(range(len(rows)), pa.int32()), pa.array(rows, pa.list_(pa.float64()))], names=["row", "counts"])

    parts = encoded.where("train").select("classes").mapInArrow(run, "row int, counts array<double>")
    sums = parts.select("row", F.posexplode("counts").alias("at", "n")).groupBy("row", "at").agg(F.sum("n").alias("n")).collect()
    if not sums:
        return model
    start, step, emit = _empty_counts(states)
    for r in sums:
        if r["row"] == 0:
            start[r["at"]] = r["n"]
        elif r["row"] <= states:
            step[r["row"] - 1, r["at"]] = r["n"]
        else:
            emit[r["at"], r["row"] - states - 1] = r["n"]
    return Model.from_counts(start, step, emit, prior)


def _class_prior(v: Vocabulary) -> np.ndarray:
    prior = np.full(CLASSES, 1e-3)
    own = v.classes < OWN_CLASSES
    prior[v.classes[own]] += v.counts[own]
    prior[OWN_CLASSES:] += 10.0**v.shared_logs
    return prior / prior.sum()


def train(encoded: DataFrame, v: Vocabulary, *, states: int = STATES, rounds: int = ROUNDS) -> Model:
    prior = _class_prior(v)
    model = sample_model(encoded, prior, states)
    for _ in range(rounds):
        model = baum_welch_round(encoded, model, prior)
    return model


def rare_sums(encoded: DataFrame, counts: DataFrame, v: Vocabulary) -> DataFrame:
    """Per row key what its words outside the head add: times, known ones, and both log sums."""
    rare = encoded.select("doc_id", "uid", F.explode(F.arrays_zip("rare", "times")).alias("x"))
    rare = rare.select(F.xxhash64("doc_id", "uid").alias("key"), F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    n = F.coalesce("n", F.lit(0))
    shared = F.element_at(F.array(*[F.lit(float(x)) for x in v.shared_logs]), (F.pmod("word", F.lit(SHARED_CLASSES)) + 1).cast("int"))
    found = rare.join(counts, "word", "left").withColumn("log", F.log10(n + 1.0))
    return found.groupBy("key").agg(
        F.sum("times").alias("rare_tokens"),
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("times") * (F.col("log") - v.base_log)).alias("rare_base"),
        F.sum(F.col("times") * (F.col("log") - shared)).alias("rare_inside"),
    )


def score_documents(docs: DataFrame, train_rule, *, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row of ``docs`` (doc_id, text).

    The model learns from the rows where ``train_rule`` holds; a null there counts as true.  A null text is empty and has one token, the
    end.  Repeated rows score alike.  Without training rows all words are unknown and states alike.  An empty table gives an
    empty result.
    """
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("uid"), F.coalesce(train_rule, F.lit(True)).alias("train"), text.alias("text"))
    counts = word_counts(rows)
    v = vocabulary(counts)
    encoded = encode(rows, v)
    model = train(encoded, v, states=states, rounds=rounds)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sequences = [np.frombuffer(c, "<u2").astype(np.int64) for c in batch["classes"].to_pylist()]
        logs = Sequences(sequences).forward(model) / np.log(10)
        names = [n for n in batch.schema.names if n != "classes"]
        return pa.record_batch([*[batch[n] for n in names], pa.array(logs)], names=[*names, "forward"])

    plain = encoded.select("doc_id", "uid", "train", "n_tokens", "head_tokens", "head_base", "head_inside", "classes")
    walked = map_arrow(plain, run, "doc_id long, uid long, train boolean, n_tokens long, head_tokens long, head_base double, head_inside double, forward double")
    sums = rare_sums(encoded, counts, v)
    whole = walked.withColumn("key", F.xxhash64("doc_id", "uid")).join(sums, "key", "left")
    # repeated rows have put their rare words in several times
    rare = F.col("n_tokens") - F.col("head_tokens")
    part = F.when(rare > 0, rare / F.col("rare_tokens")).otherwise(F.lit(0.0))
    add = {c: F.coalesce(F.col(c) * part, F.lit(0.0)) for c in ("rare_known", "rare_base", "rare_inside")}
    return whole.select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("head_tokens") + F.round(add["rare_known"]).cast("long")).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + add["rare_base"]).alias("base_score"),
        (F.col("forward") + F.col("head_inside") + add["rare_inside"]).alias("score"),
    )


@query("op2_hmm_score")
def op2(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), crc_mod("doc_id", 7) != 2)
