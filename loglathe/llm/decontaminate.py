"""Test items inside training documents: MinHash containment search partitioned by size, then exact shingle containment.

A short item is a small part of a long document, so their sets are never similar as wholes. Items are therefore parted into
size classes (up to 8, 16, 32, ... shingles), and for each class a document is read as overlapping windows of twice the
class size. An item found in a document has a similarity of about 0.2 or more with one of these windows, and then agrees
with it in at least one of 64 hash minima but once in a million. Window minima of all classes come from one pass: those of a
class are the pairwise minima of the class below.  Whoever agrees in a minimum is counted exactly, against the whole
document.

The documents are only mapped, never shuffled. Items reach the tasks in blocks of bounded size, one pass per block.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglathe.llm.common import binary_array, map_arrow, query, small_batches, stored, table
from loglathe.llm.textops import Texts, texts_of, window_hashes, words_of

SHINGLE = 5
HASHES = 64
LEAST_CLASS = 8
#: shingles of items that a task holds at once, 32 MB
BLOCK_SHINGLES = 4_000_000

_random = np.random.Generator(np.random.PCG64(1))
_FACTORS = _random.integers(0, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def _size_class(n: int) -> int:
    return max(LEAST_CLASS, 1 << (n - 1).bit_length())


class ItemIndex:
    """A block of items: their sets, and per size class and hash function their minima in order."""

    def __init__(self, items: list[tuple[int, int, np.ndarray]], percent: int) -> None:
        self.items, self.percent = items, percent
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        classes: dict[int, list[int]] = defaultdict(list)
        for i, (_, size, hashes) in enumerate(items):
            if size < SHINGLE:
                self.short[size][int(hashes[0])].append(i)
            else:
                classes[_size_class(len(hashes))].append(i)
        self.short = {k: dict(v) for k, v in self.short.items()}
        self.classes: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for size, members in sorted(classes.items()):
            self.classes[size] = []
            for factor, term in zip(_FACTORS, _TERMS, strict=True):
                minima = np.array([(items[i][2] * factor + term).min() for i in members])
                order = np.argsort(minima, kind="stable")
                self.classes[size].append((minima[order], np.array(members)[order]))

    def matches(self, texts: Texts) -> list[tuple[int, int, int]]:
        """(number of the text, number of the item, shared shingles) for every item held by a text."""
        words = words_of(texts)
        candidates: set[tuple[int, int]] = set()
        windows = window_hashes(words.hashes, SHINGLE)
        counts = np.maximum(np.diff(words.first) - SHINGLE + 1, 0)
        if self.classes and counts.any():
            owner = np.repeat(np.arange(len(texts)), counts)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            values = windows[words.first[owner] + inside]
            for no, (factor, term) in enumerate(zip(_FACTORS, _TERMS, strict=True)):
                candidates |= self._agreeing(no, values * factor + term, counts)
        found = []
        sets: dict[int, np.ndarray] = {}
        for text, item in candidates:
            if text not in sets:
                a, b = int(words.first[text]), int(words.first[text + 1])
                sets[text] = np.unique(windows[a : b - SHINGLE + 1])
            wanted = self.items[item][2]
            shared = int(np.isin(wanted, sets[text], assume_unique=True).sum())
            if 100 * shared >= self.percent * len(wanted):
                found.append((text, item, shared))
        for size, by_hash in self.short.items():
            found += self._short(words, size, by_hash)
        return found

    def _agreeing(self, no: int, values: np.ndarray, counts: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) pairs that share a minimum of hash function ``no`` in a window of the item's class."""
        out: set[tuple[int, int]] = set()
        size, step = LEAST_CLASS, LEAST_CLASS
        while True:
            blocks = -(-counts // step)  # of each text
            owner = np.repeat(np.arange(len(counts)), blocks)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            starts = np.repeat(np.cumsum(counts) - counts, blocks) + inside * step
            values = np.minimum.reduceat(values, starts)
            if size in self.classes:
                minima, members = self.classes[size][no]
                pairs = values.copy()
                same = owner[1:] == owner[:-1]
                pairs[:-1][same] = np.minimum(values[:-1][same], values[1:][same])
                left = np.searchsorted(minima, pairs, "left")
                hit = np.flatnonzero(minima[np.minimum(left, len(minima) - 1)] == pairs)
                right = np.searchsorted(minima, pairs[hit], "right")
                for at, a, b in zip(hit.tolist(), left[hit].tolist(), right.tolist(), strict=True):
                    out.update((int(owner[at]), int(i)) for i in members[a:b])
            if size >= max(self.classes):
                return out
            size, step, counts = size * 2, 2, blocks

    def _short(self, words, size: int, by_hash: dict[int, list[int]]) -> list[tuple[int, int, int]]:
        """Items of fewer words than a shingle are one shingle of their own length."""
        windows = window_hashes(words.hashes, size)
        known = np.array(sorted(by_hash), np.uint64)
        hit = np.flatnonzero(np.isin(windows, known))
        owner = np.searchsorted(words.first, hit, "right") - 1
        fits = hit + size <= words.first[owner + 1]
        return [(t, i, 1) for t, h in {(int(t), int(h)) for t, h in zip(owner[fits], windows[hit[fits]], strict=True)} for i in by_hash[h]]


def _item_sets(benchmark: DataFrame) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = words_of(texts_of(batch["text"]))
        sizes, sets = [], []
        for i in range(batch.num_rows):
            own = words.hashes[words.of(i)]
            size = min(len(own), SHINGLE)
            sizes.append(size)
            sets.append(np.unique(window_hashes(own, size)).tobytes() if size else b"")
        return pa.record_batch([batch["item_id"], pa.array(sizes, pa.int32()), binary_array(sets)], names=["item_id", "words", "hashes"])

    columns = [F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")]
    return map_arrow(benchmark.select(*columns), run, "item_id long, words int, hashes binary").where("words > 0")


def item_blocks(benchmark: DataFrame, percent: int) -> Iterator[ItemIndex]:
    """The items in blocks that a task can hold, whatever their number."""
    sets = stored(_item_sets(benchmark), "items")
    total = sets.agg(F.sum(F.octet_length("hashes"))).head()[0] or 0
    blocks = -(-total // (8 * BLOCK_SHINGLES))
    for block in range(blocks):
        rows = sets.where(F.pmod(F.xxhash64("hashes"), F.lit(blocks)) == block).collect()
        if rows:
            yield ItemIndex([(r["item_id"], r["words"], np.frombuffer(r["hashes"], np.uint64)) for r in rows], percent)


def find_leaks(docs: DataFrame, benchmark: DataFrame, *, percent: int = 80) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment``: which document holds which item of ``benchmark`` (item_id, text).

    A document holds an item when ``percent`` or more of the item's 5-word shingles occur anywhere in it (A-Z in lower case).
    An item of fewer words is one shingle, found as these words in a row; items without words are found nowhere, and texts
    that are null or empty hold nothing.  Repeated rows on either side give repeated rows.  Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    schema = "doc_id long, item_id long, n_item long, n_shared long, containment double"
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for index in item_blocks(benchmark, percent):

        def run(batch: pa.RecordBatch, index: ItemIndex = index) -> pa.RecordBatch:
            found = index.matches(texts_of(batch["text"]))
            sizes = [len(index.items[i][2]) for _, i, _ in found]
            return pa.record_batch(
                [
                    batch["doc_id"].take(pa.array([t for t, _, _ in found], pa.int64())),
                    pa.array([index.items[i][0] for _, i, _ in found], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array([s for _, _, s in found], pa.int64()),
                    pa.array([s / n for (_, _, s), n in zip(found, sizes, strict=True)], pa.float64()),
                ],
                names=["doc_id", "item_id", "n_item", "n_shared", "containment"],
            )

        out = out.unionAll(map_arrow(columns, run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, *, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item. Cases as in ``find_leaks``."""
    small_batches(docs.sparkSession)
    for index in item_blocks(benchmark, percent):

        def run(batch: pa.RecordBatch, index: ItemIndex = index) -> pa.RecordBatch:
            keep = np.ones(batch.num_rows, bool)
            keep[[t for t, _, _ in index.matches(texts_of(batch["text"]))]] = False
            return batch.filter(pa.array(keep))

        docs = map_arrow(docs, run, docs.schema)
    return docs


_SHINGLES = """
    SELECT DISTINCT {id}, list_aggregate(w[i : i + {n} - 1], 'string_agg', ' ') AS s, {n} AS k
    FROM (SELECT {id}, w, unnest(range(1, len(w) - {n} + 2)) AS i FROM {of} WHERE {rule})"""
_WORDS = """
    SELECT {id}, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM {table}"""
_ITEMS = " UNION ALL ".join(_SHINGLES.format(id="item_id", of="iw", n=n, rule=f"len(w) = {n}") for n in range(1, 5))
LEAKS_SQL = f"""
WITH dw AS ({_WORDS.format(id="doc_id", table="documents")}),
iw AS ({_WORDS.format(id="item_id", table="benchmark")}),
items AS ({_SHINGLES.format(id="item_id", of="iw", n=5, rule="len(w) >= 5")} UNION ALL {_ITEMS}),
docs AS ({" UNION ALL ".join(_SHINGLES.format(id="doc_id", of="dw", n=n, rule=f"len(w) >= {n}") for n in range(1, 6))}),
sizes AS (SELECT item_id, count(*) AS n_item FROM items GROUP BY item_id)
SELECT d.doc_id, i.item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM items i JOIN docs d USING (s, k) JOIN sizes z ON z.item_id = i.item_id
GROUP BY d.doc_id, i.item_id, n_item
HAVING 100 * count(*) >= 80 * n_item
"""


@query("op1_decontaminate", LEAKS_SQL)
def op1(spark, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
