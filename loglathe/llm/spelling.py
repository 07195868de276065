"""Spelling variants: words one edit apart, the commonest of them as a word's form, and the root that forms lead to.

The vocabulary is the upper part of a frequency-vector trie (``letter_trie``): a node some levels deep is a cell, and cells are dealt to tasks.  A
word is at home in its cell and a guest in the cells that lie one surplus, or one surplus and one deficit, above it; so each near pair
meets in one cell, where the rest of the trie is built and searched.  As many levels make a cell as are needed for the largest to fit
in a task; a cell that is too large at the last level is cut into parts, and guests go to all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import binary_array, query, small_batches, stored, table
from loglathe.llm.letter_trie import LEVELS, letter_groups, near_words, search, trie, vectors

SHORTEST = 7
LEAST_TIMES = 2
FORM_TIMES = 10
DELETED_ONE_IN = 31
#: a cell of more words is cut at deeper levels
CELL_WORDS = 20_000
FIRST_DEPTH = 4
GUEST_BLOCK = 5_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged_words(docs: DataFrame) -> DataFrame:
    """``word`` for each run of letters in ``docs`` (doc_id, text) that has at least 7 code points after the damage.

    A run, in lower case, loses the code point h % length where h, the crc32 of ``<doc_id>:<run>``, is a multiple of 31; a null id
    is empty there.
    """
    runs = F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(rf"([A-Za-zÀ-ÿ]{{{SHORTEST},}}+)"), F.lit(1)))
    lower = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), runs.alias("run")).withColumn("run", F.translate("run", _UPPER, _LOWER))
    hashed = lower.withColumn("h", F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DELETED_ONE_IN == 0, less).otherwise(F.col("run"))
    return hashed.select(word.alias("word")).where(F.length("word") >= SHORTEST)


def vocabulary(words: DataFrame) -> DataFrame:
    """``word, n`` of the words that occur at least twice; counted before and after they are moved."""
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_TIMES)


def _letter_counts(words: DataFrame) -> np.ndarray:
    """How often each of the 256 letters stands in the distinct words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(256, np.int64)
        for batch in batches:
            sums += np.bincount(np.frombuffer("".join(batch["word"].to_pylist()).encode("latin-1"), np.uint8), minlength=256)
        yield pa.record_batch([pa.array(np.arange(256)), pa.array(sums)], names=["letter", "n"])

    out = np.zeros(256)
    for r in words.select("word").mapInArrow(run, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).collect():
        out[r["letter"]] = r["n"]
    return out


def _keys(counts: np.ndarray) -> pa.Array:
    """Rows of counts as binary keys that sort like them."""
    data = np.ascontiguousarray(counts.astype(">u4"))
    width = 4 * counts.shape[1]
    raw = data.tobytes()
    return binary_array([raw[i : i + width] for i in range(0, len(raw), width)])


def _largest_cells(words: DataFrame, groups: np.ndarray) -> tuple[DataFrame, dict[int, int]]:
    """The number of words per full list of counts, and for each depth the words of its largest cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.record_batch([_keys(vectors(batch["word"].to_pylist(), groups))], names=["leaf"])

    leaves = stored(words.select("word").mapInArrow(run, "leaf binary").groupBy("leaf").agg(F.count("*").alias("words")), "leaves")
    depths = F.explode(F.array(*[F.lit(d) for d in range(FIRST_DEPTH, LEVELS + 1)]))
    cells = leaves.select("*", depths.alias("depth")).groupBy("depth", F.substring("leaf", F.lit(1), 4 * F.col("depth")).alias("cell")).agg(F.sum("words").alias("words"))
    return leaves, {r["depth"]: r["words"] for r in cells.groupBy("depth").agg(F.max("words").alias("words")).collect()}


def _visits(words: DataFrame, groups: np.ndarray, depth: int) -> DataFrame:
    """``cell, guest, word, n``: each word at home, and as a guest in the cells above that near words may live in."""
    changes = [np.zeros(depth, np.int64)]
    for i in range(depth):
        for j in [None, *range(i + 1, depth)]:
            change = np.zeros(depth, np.int64)
            change[i] = 1
            if j is not None:
                change[j] = -1
            changes.append(change)
    moved = np.stack(changes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            home = vectors(batch["word"].to_pylist(), groups)[:, :depth]
            cells = home[:, None, :] + moved[None]
            row, which = np.nonzero((cells >= 0).all(2))
            rows = batch.take(pa.array(row))
            yield pa.record_batch([_keys(cells[row, which]), pa.array(which > 0), rows["word"], rows["n"]], names=["cell", "guest", "word", "n"])

    return words.mapInArrow(run, "cell binary, guest boolean, word string, n long")


def _in_parts(visits: DataFrame, leaves: DataFrame, cell_words: int) -> DataFrame:
    """``part, cell, guest, word, n``: words of cells that are still too large live in one of several parts and visit those above."""
    large = leaves.where(F.col("words") > cell_words).select(F.col("leaf").alias("cell"), F.ceil(F.col("words") / cell_words).cast("int").alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    home = F.pmod(F.xxhash64("word"), parts).cast("int")
    rows = visits.join(large, "cell", "left").withColumn("first", F.when(F.col("guest"), 0).otherwise(home))
    return rows.select(F.explode(F.sequence("first", parts - 1)).alias("part"), "cell", (F.col("guest") | (F.col("part") > F.col("first"))).alias("guest"), "word", "n")


def _best(held: dict[str, list], word: str, other: str, n: int) -> None:
    now = held.get(word)
    if now is None:
        held[word] = [1, n, other]
        return
    now[0] += 1
    if n > now[1] or n == now[1] and other < now[2]:
        now[1], now[2] = n, other


def _search_cells(rows: Iterator[tuple], groups: np.ndarray) -> Iterator[tuple]:
    """``word, n_near, near_n, near`` as found in each cell; rows are ``(part, cell, guest, word, n)`` with a cell's homes first."""
    for _, members in groupby(rows, key=lambda r: r[:2]):
        visit = next(members)
        if visit[2]:
            continue  # nobody is at home; groupby skips the rest
        homes: dict[str, int] = {}
        while visit is not None and not visit[2]:
            homes[visit[3]] = visit[4]
            visit = next(members, None)
        home, found = trie(list(homes), groups), {}

        def within(a, b, homes=homes, found=found):
            if a.number <= b.number:
                for x, y in near_words(a, b):
                    _best(found, x, y, homes[y])
                    _best(found, y, x, homes[x])

        search(home, home, within)
        while visit is not None:
            guests = {visit[3]: visit[4], **{g[3]: g[4] for g in islice(members, GUEST_BLOCK - 1)}}
            visiting: dict[str, list] = {}

            def across(a, b, homes=homes, found=found, guests=guests, visiting=visiting):
                for x, y in near_words(a, b):
                    _best(visiting, x, y, homes[y])
                    _best(found, y, x, guests[x])

            search(trie(list(guests), groups), home, across)
            yield from ((w, *v) for w, v in visiting.items())
            visit = next(members, None)
        yield from ((w, *v) for w, v in found.items())


def near_counts(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """``word, n_near, near, near_n`` for the words of ``words`` (word, n) that have near ones: how many, and the commonest of them."""
    groups = letter_groups(_letter_counts(words))
    leaves, largest = _largest_cells(words, groups)
    depth = next((d for d in sorted(largest) if largest[d] <= cell_words), LEVELS)
    visits = _visits(words, groups, depth)
    if largest.get(depth, 0) > cell_words:
        placed = _in_parts(visits, leaves, cell_words)
    else:
        placed = visits.select(F.lit(0).alias("part"), "cell", "guest", "word", "n")
    ordered = placed.repartition("part", "cell").sortWithinPartitions("part", "cell", "guest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        found = _search_cells(rows, groups)
        while held := list(islice(found, 10_000)):
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=["word", "n_near", "near_n", "near"])

    parts = ordered.mapInArrow(run, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near"))
    whole = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return whole.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.m")).alias("near_n"))


def roots(links: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain of ``links`` (word, form).

    Every step doubles the way that is known. A form is ten times as common as its word, so chains have less than twenty steps.
    """
    now = stored(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not now.where("moved").isEmpty():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = stored(now.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
    return now.select("word", "root")


def spelling_variants(words: DataFrame, times: int = FORM_TIMES, cell_words: int = CELL_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``words`` (word, n), which are distinct.

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is the commonest of them, the smallest
    in code-point order among equally common ones, if it is at least ``times`` as common as the word; the root is where forms end.
    Letters are those below U+0100.
    """
    small_batches(words.sparkSession)
    near = near_counts(words, cell_words)
    fits = F.col("near_n") >= times * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word",
        F.when(fits, F.col("near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(fits, F.col("near_n")).alias("form_n"),
    )
    rows = stored(rows, "variants")
    ends = roots(rows.where("form is not null"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variant_report(docs: DataFrame) -> DataFrame:
    """Spelling variants among the damaged words of ``docs`` (doc_id, text).

    Null and empty texts have no words; a null id counts as an empty one; equal rows count each. Texts of any length are read whole. An empty
    table, or one without a word that occurs twice, gives no rows. Other columns are left out, whatever their names.
    """
    small_batches(docs.sparkSession)
    return spelling_variants(stored(vocabulary(damaged_words(docs)), "vocabulary"))


@query("op12_spelling_variants")
def op12(spark, sf_dir: str) -> DataFrame:
    return variant_report(table(spark, sf_dir, "documents"))
