"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, made from its code point. A letter trigram binds three of them, each rotated by its
place; the vector of a text is the bundle (sum) of its trigrams, and a language's prototype bundles the texts of the
language, each with the same weight. A text gets the language whose prototype has the largest cosine.

Texts are lower-cased letters with one blank for all else. Prototypes are sums, so tasks add up their part and Spark adds the
parts; a language has a fixed number of dimensions whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import crc_mod, map_arrow, query, small_batches, stored, table

DIMENSIONS = 512
UNKNOWN = "und"
#: vectors of so many trigrams are held at a time
BLOCK = 1 << 15
#: prototypes are held by every task; more languages than this is an error, as the column would not hold languages
MOST_LANGUAGES = 4096
_POINTS = 0x110000


@lru_cache(maxsize=1)
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """For each code point whether it is a letter, and its lower case where that is one letter."""
    letter = np.fromiter((chr(i).isalpha() for i in range(_POINTS)), bool, _POINTS)
    lower = np.arange(_POINTS, dtype=np.uint32)
    for i in np.flatnonzero(letter).tolist():
        small = chr(i).lower()
        if len(small) == 1:
            lower[i] = ord(small)
    return letter, lower


@lru_cache(maxsize=65536)
def _letter_vector(point: int) -> np.ndarray:
    return (np.random.Generator(np.random.PCG64([10, point])).integers(0, 2, DIMENSIONS, dtype=np.int8) * 2 - 1).astype(np.int8)


class Trigrams:
    """Counts of the distinct letter trigrams of each text of a batch; their vectors are made in blocks.

    A batch in a large script has very many distinct trigrams, so no more than ``BLOCK`` of their vectors are held at a time.
    """

    def __init__(self, texts: list[str | None]) -> None:
        letter, lower = _letters()
        joined = " " + " ".join(t or "" for t in texts) + " "
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter((len(t or "") for t in texts), np.int64, len(texts))
        ends = np.cumsum(sizes + 1)  # position of the blank behind each text
        is_letter = letter[points]
        keep = is_letter.copy()
        keep[0] = True
        keep[1:] |= is_letter[:-1]
        symbols = np.where(is_letter, lower[points], np.uint32(0x20))[keep]
        owner = np.searchsorted(ends, np.flatnonzero(keep), "left")  # a blank belongs to the text before it
        self.alphabet, number = np.unique(symbols, return_inverse=True)
        size = len(self.alphabet)
        blank = int(np.searchsorted(self.alphabet, 0x20))
        a, b, c = number[:-2], number[1:-1], number[2:]
        whole = b != blank
        code = ((a * size + b) * size + c)[whole]
        cube = size**3
        key = np.sort(owner[1:-1][whole] * cube + code)  # by the middle letter's text
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        self.counts = np.diff(np.append(first, len(key))).astype(np.float32)
        self.text, codes = np.divmod(key[first], cube)
        self.totals = np.bincount(self.text, self.counts, len(texts))
        self.distinct, self.at = np.unique(codes, return_inverse=True)
        self.letters = np.stack([_letter_vector(int(p)) for p in self.alphabet])

    def vectors(self, block: slice) -> np.ndarray:
        codes, size = self.distinct[block], len(self.alphabet)
        # a letter's vector is rotated by its place
        one, two, three = (np.roll(self.letters, r, axis=1)[i] for r, i in ((2, codes // size**2), (1, codes // size % size), (0, codes % size)))
        one *= two
        one *= three
        return one.astype(np.float32)

    def bundled(self, groups: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
        """The sum of the vectors of each of ``count`` groups; a group and a weight for each of the counts."""
        out = np.zeros((count, DIMENSIONS))
        order = np.lexsort((groups, self.at // BLOCK))
        block, group = self.at[order] // BLOCK, groups[order]
        first = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (group[1:] != group[:-1])])) if len(order) else np.zeros(0, np.int64)
        held, vectors = -1, np.zeros((0, DIMENSIONS), np.float32)
        for low, high in zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True):
            if block[low] != held:
                held = int(block[low])
                vectors = self.vectors(slice(held * BLOCK, (held + 1) * BLOCK))
            for begin in range(low, high, BLOCK):
                which = order[begin : min(high, begin + BLOCK)]
                out[group[low]] += weights[which].astype(np.float32) @ vectors[self.at[which] - held * BLOCK]
        return out


def language_prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """Unit vectors per language from ``docs`` (text, lang). Rows without letters or language say nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            grams, languages = Trigrams(batch["text"].to_pylist()), batch["lang"].to_pylist()
            names, of = np.unique(np.array(languages, object).astype(str), return_inverse=True)
            weights = grams.counts / np.maximum(grams.totals, 1)[grams.text]
            told = np.bincount(of[np.unique(grams.text)], minlength=len(names)) > 0
            for name, has, vector in zip(names.tolist(), told, grams.bundled(of[grams.text], weights, len(names)), strict=True):
                if has:
                    sums[name] = sums.get(name, 0) + vector
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.array(list(sums.values()), pa.list_(pa.float64()))], names=["lang", "sums"])

    parts = docs.where("lang is not null").select("lang", "text").mapInArrow(run, "lang string, sums array<double>")
    each = parts.select("lang", F.posexplode("sums").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    whole = stored(each.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("v")).select("lang", "v.x"), "prototypes")
    rows = whole.orderBy("lang").limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"More than {MOST_LANGUAGES} languages to learn")
    return {r["lang"]: np.array(r["x"]) / max(np.linalg.norm(r["x"]), 1e-12) for r in rows}


def predict_language(docs: DataFrame, prototypes: dict[str, np.ndarray], *keep: str) -> DataFrame:
    """The columns ``keep`` with ``lang_pred`` and ``score`` for each row of ``docs`` (text and those)."""
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] for n in names]) if names else np.zeros((0, DIMENSIONS))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams = Trigrams(batch["text"].to_pylist())
        vectors = grams.bundled(grams.text, grams.counts, batch.num_rows)
        norms = np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)
        found, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
        for i in np.flatnonzero(grams.totals).tolist() if names else ():
            cosines = matrix @ vectors[i] / norms[i]
            best = int(cosines.argmax())
            found[i], scores[i] = names[best], min(1.0, max(0.0, float(cosines[best])))
        return pa.record_batch([*[batch[c] for c in keep], pa.array(found, pa.string()), pa.array(scores, pa.float64())], names=[*keep, "lang_pred", "score"])

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return map_arrow(docs.select("text", *keep), run, f"{kinds}, lang_pred string, score double")


def identify(docs: DataFrame, train_rule) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs`` (doc_id, text, lang).

    At most ``MOST_LANGUAGES`` languages can be learned, more are an error.  Repeated rows count as often as they are there.  Texts of any length and
    script are read whole; memory follows a batch's bytes, not its distinct trigrams.  An empty table gives no rows.

    Learns from rows with a language where ``train_rule`` holds (null counts as true). Texts that are null or have no letter are ``und``
    with score 0, and so is every text when nothing could be learned.  The score is the cosine, negative ones as 0; between
    equal ones the first language by name wins.
    """
    small_batches(docs.sparkSession)
    held_out = ~F.coalesce(train_rule, F.lit(True))
    rows = docs.select("doc_id", held_out.alias("held_out"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    prototypes = language_prototypes(rows.where("not held_out"))
    return predict_language(rows, prototypes, "doc_id", "held_out")


@query("op10_language_id")
def op10(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"), crc_mod("doc_id", 4) != 2)
