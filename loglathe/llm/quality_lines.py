"""Quality rules on whole texts, and lines that recur across the documents of a host.

Lines are compared without case, digits' values and blanks. Per host, equal texts count once. Lines that more texts than the
limit hold may be boilerplate; what a text has beside them, also in slightly edited form, is its context, told by a sketch, the
least hash of 3-word windows of those other lines. A line is boilerplate when it stands in more distinct contexts than the
limit. Lines of a text that was merely copied or edited here and there share their context, and stay.

One pass over the texts leaves a narrow table of figures and line hashes; counting and the verdict work on that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import map_arrow, query, small_batches, stored, table
from loglathe.llm.textops import (
    Texts,
    fold,
    line_spans,
    mix,
    span_hashes,
    texts_of,
    window_hashes,
    word_spans,
)

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: a line must have so many words to count as boilerplate
LINE_WORDS = 3
#: a line is frequent above so many documents of a host, and above this part of them
LEAST_DOCUMENTS = 8
DOCUMENT_SHARE = 0.003
#: a line's least window hashes, 32 bits of each; with four, a line and its copy with one other word always share one
MARKS = 4
#: a document is depleted when less is left
LEFT_PERCENT = 30
LEFT_WORDS = 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
_MARK = np.uint64(0xFFFFFFFF)


def _digits_hidden(texts: Texts) -> np.ndarray:
    return np.where(_DIGIT[texts.data], np.uint8(0x30), texts.data)


class Figures:
    """Figures of each text of a batch, and its distinct normalised lines."""

    def __init__(self, texts: Texts) -> None:
        starts, ends = word_spans(texts)
        self.first = np.searchsorted(starts, texts.offsets, "left")
        self.n_words = np.diff(self.first)
        points = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])
        per_word = np.concatenate([[0], np.cumsum(points[ends] - points[starts])])
        self.word_chars = per_word[self.first[1:]] - per_word[self.first[:-1]]
        symbols = np.concatenate([[0], np.cumsum(_SYMBOL[texts.data])])
        self.n_symbols = symbols[texts.offsets[1:]] - symbols[texts.offsets[:-1]]
        self._repeats(span_hashes(texts.data, starts, ends, lower=False))
        self._lines(texts, starts, span_hashes(_digits_hidden(texts), starts, ends))

    def _repeats(self, words: np.ndarray) -> None:
        """Words inside 3-word windows that a text has twice or more."""
        windows = window_hashes(words, 3)
        self.n_repeat_words = np.zeros(len(self.n_words), np.int64)
        for i, (a, n) in enumerate(zip(self.first[:-1].tolist(), self.n_words.tolist(), strict=True)):
            own = windows[a : a + n - 2] if n > 3 else windows[:0]
            if not len(own):
                continue
            ordered = np.sort(own)
            twice = ordered[1:][ordered[1:] == ordered[:-1]]
            if len(twice):
                at = np.flatnonzero(np.isin(own, twice))
                covered = np.zeros(n, bool)
                for k in range(3):
                    covered[at + k] = True
                self.n_repeat_words[i] = covered.sum()

    def _lines(self, texts: Texts, word_starts: np.ndarray, words: np.ndarray) -> None:
        starts, ends, first = line_spans(texts)
        raw = span_hashes(texts.data, starts, ends, lower=False)
        word_at = np.searchsorted(word_starts, starts, "left")
        word_to = np.searchsorted(word_starts, ends, "left")
        size = word_to - word_at
        folded = fold(words, word_at, word_to)
        windows = window_hashes(words, 3)
        marks = np.zeros((len(starts), MARKS), np.uint64)
        wide = np.flatnonzero(size >= 3)
        if len(wide):
            n = size[wide] - 2
            cuts = np.cumsum(n) - n
            values = mix(windows)[np.repeat(word_at[wide] - cuts, n) + np.arange(n.sum())]
            for k in range(MARKS):
                least = np.minimum.reduceat(values, cuts)
                marks[wide, k] = np.where(least == _NONE, marks[wide, 0], least)
                values = np.where(values == np.repeat(least, n), _NONE, values)
        marks &= _MARK
        self.n_dup_lines = np.zeros(len(texts), np.int64)
        self.lines, self.marks, self.line_words, counts = [], [], [], []
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
            filled = np.arange(a, b)[size[a:b] > 0]
            self.n_dup_lines[i] = len(filled) - len(np.unique(raw[filled]))
            hashes, at, inverse = np.unique(folded[filled], return_index=True, return_inverse=True)
            in_lines = np.bincount(inverse, weights=size[filled], minlength=len(hashes)).astype(np.int64)
            keep = size[filled][at] >= LINE_WORDS
            counts.append(int(keep.sum()))
            self.lines.append(hashes[keep])
            self.marks.append(marks[filled][at][keep])
            self.line_words.append(in_lines[keep])
        self.line_first = np.concatenate([[0], np.cumsum(counts)])


_LINE = "struct<line: long, low: long, high: long, words: long>"
_KEYS = ["doc_id", "source", "uid"]
_FIGURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def document_figures(docs: DataFrame) -> DataFrame:
    """The figures of each row of ``docs`` (doc_id, text, source), and ``lines``: its line hashes, marks (two in a long) and words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        f = Figures(texts_of(batch["text"]))
        marks = np.concatenate([np.zeros((0, MARKS), np.uint64), *f.marks])
        low, high = (marks[:, k] | (marks[:, k + 1] << np.uint64(32)) for k in (0, 2))
        longs = [x.view(np.int64) for x in (np.concatenate([np.zeros(0, np.uint64), *f.lines]), low, high)]
        words = np.concatenate([np.zeros(0, np.int64), *f.line_words])
        items = pa.StructArray.from_arrays([pa.array(x) for x in (*longs, words)], ["line", "low", "high", "words"])
        lines = pa.ListArray.from_arrays(pa.array(f.line_first, pa.int32()), items)
        columns = [batch[k] for k in _KEYS] + [pa.array(getattr(f, n).astype(np.int64)) for n in _FIGURES] + [lines]
        return pa.record_batch(columns, names=[*_KEYS, *_FIGURES, "lines"])

    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    columns = docs.select("doc_id", F.col("source").cast("string").alias("source"), uid(text).alias("uid"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    figures = ", ".join(f"{n} long" for n in _FIGURES)
    return map_arrow(columns, run, f"doc_id {kind}, source string, uid long, {figures}, lines array<{_LINE}>")


def uid(text):
    """Tells rows of one id apart by their text."""
    return F.xxhash64(text)


def _marks(low, high):
    return [x for y in (low, high) for x in (F.expr(f"{y} & 4294967295"), F.expr(f"shiftrightunsigned({y}, 32)"))]


def contexts(figures: DataFrame) -> DataFrame:
    """``source, sketch, held`` of each distinct text: its context, and those of its lines that may be boilerplate."""
    texts = figures.where(F.size("lines") > 0).groupBy("source", "uid").agg(F.first("lines").alias("lines"))
    texts = stored(texts.withColumn("text_no", F.xxhash64("source", "uid")), "texts")
    each = texts.select("source", "text_no", F.explode("lines").alias("x")).select("source", "text_no", "x.line", "x.low", "x.high")
    able = each.groupBy("source", "line").agg(F.count("*").alias("n"), F.max("low").alias("low"), F.max("high").alias("high"))
    able = able.where(F.col("n") > LEAST_DOCUMENTS)

    def keyed(rows: DataFrame, n, *more: str) -> DataFrame:
        """A row for each line with ``n``, and one for each of its marks with 0."""
        keys = [F.struct(F.col("line").alias("value"), n.alias("n"))]
        keys += [F.struct(m.alias("value"), F.lit(0).cast("long").alias("n")) for m in _marks("low", "high")]
        rows = rows.select("source", *more, F.explode(F.array_distinct(F.array(*keys))).alias("k"))
        return rows.select(F.xxhash64("source", F.col("k.n") > 0, "k.value").alias("key"), "k.value", "k.n", *more)

    wanted = stored(keyed(able, F.col("n")).groupBy("key").agg(F.max("value").alias("value"), F.max("n").alias("n")), "able")
    met = keyed(each, F.lit(1).cast("long"), "text_no").select("key", "text_no").join(wanted, "key")
    hits = met.groupBy("text_no").agg(F.collect_set(F.struct("value", "n")).alias("hits"))
    rows = texts.join(hits, "text_no", "left")
    rows = rows.select("source", "lines", F.coalesce("hits", F.array().cast("array<struct<value: long, n: long>>")).alias("hits"))

    def parts(column: pa.Array, *names: str) -> tuple[list[int], list[np.ndarray]]:
        first = column.offsets.to_numpy()
        flat = column.flatten()
        return (first - first[0]).tolist(), [flat.field(n).to_numpy(zero_copy_only=False) for n in names]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        first, (line, low, high) = parts(batch["lines"], "line", "low", "high")
        hit_first, (value, n) = parts(batch["hits"], "value", "n")
        low, high = low.view(np.uint64), high.view(np.uint64)
        marks = np.stack([low & _MARK, low >> np.uint64(32), high & _MARK, high >> np.uint64(32)], 1).astype(np.int64)
        sketches, held = [], []
        for i in range(batch.num_rows):
            own, lines = marks[first[i] : first[i + 1]], line[first[i] : first[i + 1]]
            hit, count = value[hit_first[i] : hit_first[i + 1]], n[hit_first[i] : hit_first[i + 1]]
            sketches.append(int(own[context_lines(own, lines, hit, count), 0].min()))
            held.append(hit[count > 0].tolist())
        columns = [batch["source"], pa.array(sketches, pa.int64()), pa.array(held, pa.list_(pa.int64()))]
        return pa.record_batch(columns, names=["source", "sketch", "held"])

    small_batches(figures.sparkSession)
    return stored(map_arrow(rows, run, "source string, sketch long, held array<long>"), "contexts")


def context_lines(marks: np.ndarray, lines: np.ndarray, hit: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which lines of a text tell its context: those that few hold and that are not edited from one that many hold.

    Of a text without such lines, what its fewer texts share: lines that at most half as many hold as its commonest, or all.
    """
    own = ~np.isin(marks, hit[count == 0]).any(1)
    if own.any():
        return own
    common, counts = hit[count > 0], count[count > 0]
    for some in (common[2 * counts <= counts.max(initial=0)], common):
        if len(some):
            return np.isin(lines, some)
    return ~own


def frequent_lines(figures: DataFrame) -> DataFrame:
    """``source, line`` of boilerplate lines. A null source is a host of its own."""
    found = contexts(figures)
    held = found.select("source", "sketch", F.explode("held").alias("line")).distinct()
    by_line = held.groupBy("source", "line").agg(F.count("*").alias("n")).where(F.col("n") > LEAST_DOCUMENTS)
    hosts = found.select("source", "sketch").distinct().groupBy(F.col("source").alias("host")).agg(F.count("*").alias("contexts"))
    above = by_line.join(hosts, F.col("source").eqNullSafe(F.col("host"))).where(F.col("n") > DOCUMENT_SHARE * F.col("contexts"))
    return above.select("source", "line")


def boilerplate(figures: DataFrame) -> DataFrame:
    """``doc_id, uid, source, found``: the boilerplate lines of each document that has some, as (line, words)."""
    lines = stored(frequent_lines(figures), "lines").select(F.col("source").alias("host"), "line")
    held = figures.select(*_KEYS, F.explode("lines").alias("x")).select(*_KEYS, "x.line", "x.words")
    hit = held.join(lines, (held["line"] == lines["line"]) & held["source"].eqNullSafe(F.col("host"))).select(*_KEYS, held["line"], "words")
    return hit.groupBy(*_KEYS).agg(F.collect_set(F.struct("line", "words")).alias("found"))


def verdicts(figures: DataFrame) -> DataFrame:
    """``figures`` with ``removed_words``, ``base_failed``, ``kept`` and the boilerplate lines ``found`` (null: none).

    Null and empty texts have no words and fail.  Repeated rows get the same verdict.
    """
    hits = boilerplate(figures).select(*[F.col(k).alias(f"_{k}") for k in _KEYS], "found")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in _KEYS]
    rows = figures.drop("lines").join(hits, same[0] & same[1] & same[2], "left").drop(*[f"_{k}" for k in _KEYS])
    removed = F.coalesce(F.aggregate("found", F.lit(0).cast("long"), lambda a, x: a + x["words"]), F.lit(0).cast("long"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & ((100 * left < LEFT_PERCENT * F.col("n_words")) | (left < LEFT_WORDS))
    return (
        rows.withColumn("removed_words", removed).withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~depleted)
    )


def without_lines(text: str, found: set[int]) -> str:
    """The text without the lines whose hashes are given."""
    texts = texts_of(pa.array([text]))
    starts, ends = word_spans(texts)
    words = span_hashes(_digits_hidden(texts), starts, ends)
    line_at, line_to, _ = line_spans(texts)
    a, b = np.searchsorted(starts, line_at, "left"), np.searchsorted(starts, line_to, "left")
    hashes = fold(words, a, b).view(np.int64).tolist()
    return "\n".join(line for line, h in zip(text.split("\n"), hashes, strict=True) if h not in found)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, n_chars and others) that pass, without their boilerplate lines."""
    verdict = verdicts(stored(document_figures(docs), "figures")).where("kept")
    verdict = verdict.select(*[F.col(k).alias(f"_{k}") for k in _KEYS], "found").dropDuplicates([f"_{k}" for k in _KEYS])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("key", uid(F.col("row.text").cast("string")))
    same = (F.col("key") == F.col("_uid")) & F.col("row.doc_id").eqNullSafe(F.col("_doc_id")) & F.col("row.source").eqNullSafe(F.col("_source"))
    good = rows.join(verdict, same).select("row", F.transform("found", lambda x: x["line"]).alias("found"))
    names = docs.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = dict(zip(names, batch["row"].flatten(), strict=True))
        found = batch["found"].to_pylist()
        if any(found):
            texts = columns["text"].to_pylist()
            texts = [without_lines(t, set(f)) if f else t for t, f in zip(texts, found, strict=True)]
            if "n_chars" in columns:
                sizes = [len(t) if f else n for t, f, n in zip(texts, found, columns["n_chars"].to_pylist(), strict=True)]
                columns["n_chars"] = pa.array(sizes, columns["n_chars"].type)
            columns["text"] = pa.array(texts, columns["text"].type)
        return pa.record_batch(list(columns.values()), names=names)

    small_batches(docs.sparkSession)
    return map_arrow(good, run, docs.schema)


@query("op6_quality_lines")
def op6(spark, sf_dir: str) -> DataFrame:
    figures = stored(document_figures(table(spark, sf_dir, "documents")), "figures")
    return verdicts(figures).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept"
    )
