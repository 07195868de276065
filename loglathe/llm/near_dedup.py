"""Near-duplicate documents: MinHash signatures in bands, verified pairs, connected components.

1.  Texts become sets of word shingles; equal sets fold into one node (the least ``doc_id``).
2.  Each set gets 200 universal hash minima in 40 bands of 5. A pair at similarity 0.8 shares no band once in 7 million.
3.  First pass: in each bucket every node meets the bucket's least node only, so a bucket costs what it holds. Of a node's
    candidates that survive the signature check the best is verified on full sets, and components are formed.
4.  Further passes: in buckets that still hold several components, nodes of different components are compared by signature,
    in blocks. Every node's likeliest partner is verified, so that parts of one group grow together; in a last pass nodes that
    still have likely partners meet again with their full sets, and only verified links leave the task.

No step lists the pairs of a group of copies, and no bucket lies in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loglathe.llm.common import (
    binary_array,
    map_arrow,
    query,
    small_batches,
    stored,
    table,
)
from loglathe.llm.components import connected_components
from loglathe.llm.textops import fingerprint, shingle_sets, texts_of, words_of

BANDS, ROWS = 40, 5
HASHES = BANDS * ROWS
#: 200 minima put a pair at 0.8 below this once in ten million
SIGNATURE_LEAST = 0.65
BLOCK = 512
#: full sets that a block holds
BLOCK_BYTES = 4 << 20
#: passes in which a node names one partner, before the one that looks at all
MERGE_ROUNDS = 1
#: bands that such a pass looks at; the last pass looks at all
MERGE_BANDS = 10
#: nodes from here on are documents without an id
FIRST_UNNAMED = (1 << 63) - (1 << 61)

_random = np.random.Generator(np.random.PCG64(5))
_FACTORS = _random.integers(0, 1 << 62, HASHES, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_TERMS = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)[:, None]
_COLUMNS = 512


def signature(hashes: np.ndarray) -> np.ndarray:
    """The upper halves of the least values of ``a * x + b mod 2**64`` over the set, one per (a, b)."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    buffer = np.empty((HASHES, min(_COLUMNS, max(1, len(hashes)))), np.uint64)
    for at in range(0, len(hashes), _COLUMNS):
        part = hashes[at : at + _COLUMNS]
        out = buffer[:, : len(part)]
        np.multiply(_FACTORS, part, out=out)
        out += _TERMS
        np.minimum(least, out.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """Per row: node id, set size, fingerprint of the set and signature."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        spans = words_of(texts_of(batch["text"]))
        sizes, ones, twos, signatures = [], [], [], []
        for hashes in shingle_sets(spans, words):
            one, two = fingerprint(hashes)
            sizes.append(len(hashes))
            ones.append(one)
            twos.append(two)
            signatures.append(signature(hashes).tobytes() if len(hashes) else None)
        return pa.record_batch(
            [batch["doc_id"], batch["uid"], *[pa.array(x, pa.int64()) for x in (sizes, ones, twos)], binary_array(signatures)],
            names=["doc_id", "uid", "n_shingles", "fp1", "fp2", "sig"],
        )

    small_batches(docs.sparkSession)
    return map_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), _uid().alias("uid"), F.col("text").cast("string").alias("text")),
        run,
        "doc_id long, uid long, n_shingles long, fp1 long, fp2 long, sig binary",
    )


def _uid():
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _node():
    """A document is its id; one without an id is named by its set, beyond all real ids."""
    unnamed = F.lit((1 << 63) - 1) - F.pmod(F.col("fp1"), F.lit(1 << 61))  # FIRST_UNNAMED or more
    return F.coalesce(F.col("doc_id"), unnamed)


def _memberships(nodes: DataFrame) -> DataFrame:
    """``key, node`` per band."""
    keys = [F.xxhash64(F.lit(b), F.substring("sig", 1 + 4 * ROWS * b, 4 * ROWS)) for b in range(BANDS)]
    return nodes.select("node", F.posexplode(F.array(*keys)).alias("band", "key"))


def _signatures_agree(pairs: DataFrame) -> DataFrame:
    """Of (a, b, sig_a, sig_b, n_a, n_b) the pairs that can be similar, with the share of equal minima."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
        share = (left == right).mean(axis=1)
        keep = pa.array(share >= SIGNATURE_LEAST)
        return pa.record_batch([batch["a"], batch["b"], pa.array(share)], names=["a", "b", "share"]).filter(keep)

    possible = pairs.where("100 * least(n_a, n_b) >= 80 * greatest(n_a, n_b)")
    return map_arrow(possible.select("a", "b", "sig_a", "sig_b"), run, "a long, b long, share double")


def _with_signatures(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    left = nodes.select(F.col("node").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sig").alias("sig_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sig").alias("sig_b"))
    return pairs.join(right, "b").join(left, "a")


def _full_sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``node, hashes``: the whole sets of the wanted nodes (node, fp1, fp2), made from their texts."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, nodes = [], []
        wanted_fps = zip(batch["fp1"].to_pylist(), batch["fp2"].to_pylist(), strict=True)
        spans = words_of(texts_of(batch["text"]))
        for node, fps, hashes in zip(batch["node"].to_pylist(), wanted_fps, shingle_sets(spans, words), strict=True):
            if fps == fingerprint(hashes):  # rows may share an id and differ in text
                nodes.append(node)
                found.append(hashes.tobytes())
        return pa.record_batch([pa.array(nodes, pa.int64()), binary_array(found)], names=["node", "hashes"])

    named = wanted.where(f"node < {FIRST_UNNAMED}")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    out = map_arrow(texts.join(named, "node"), run, "node long, hashes binary")
    # documents without an id, found again by their set
    unnamed = wanted.where(f"node >= {FIRST_UNNAMED}")
    lost = map_arrow(
        docs.where("doc_id is null").select(F.col("text").cast("string").alias("text")), _hashes_of(words), "fp1 long, fp2 long, hashes binary"
    )
    return out.unionAll(lost.join(unnamed, ["fp1", "fp2"]).select("node", "hashes"))


def _hashes_of(words: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(shingle_sets(words_of(texts_of(batch["text"])), words))
        prints = [fingerprint(s) for s in sets]
        return pa.record_batch(
            [pa.array([p[0] for p in prints], pa.int64()), pa.array([p[1] for p in prints], pa.int64()), binary_array([s.tobytes() for s in sets])],
            names=["fp1", "fp2", "hashes"],
        )

    return run


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough: 100 * intersection >= 80 * union."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch["set_a"], batch["set_b"], strict=True):
            keep.append(_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)))
        return pa.record_batch([batch["a"], batch["b"]], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("set_b"))
    return map_arrow(pairs.select("a", "b").join(right, "b").join(left, "a"), run, "a long, b long")


def _similar(left: np.ndarray, right: np.ndarray) -> bool:
    """Whether 100 * intersection >= 80 * union; both are sorted sets."""
    both = np.concatenate([left, right])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= 80 * (len(both) - shared)


def _likely_pairs(rows: list[dict], every: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """In a cell: row i, later rows of other components that may be similar, and their shares of equal minima.

    With ``every`` a pair counts only in the first band that it shares, so in one cell of all.
    """
    component, size, own = (np.array([r[c] for r in rows]) for c in ("component", "n_shingles", "own"))
    if (component == component[0]).all():
        return
    minima = np.frombuffer(b"".join(r["sig"] for r in rows), np.uint32).reshape(-1, HASHES)
    for i in range(len(rows) - 1):
        rest = slice(i + 1, None)
        fits = (component[rest] != component[i]) & (100 * np.minimum(size[rest], size[i]) >= 80 * np.maximum(size[rest], size[i]))
        if not rows[0]["inner"]:
            fits &= own[rest] != own[i]  # pairs of one block have a cell of their own
        at = np.flatnonzero(fits) + i + 1
        if not len(at):
            continue
        equal = minima[at] == minima[i]
        share = equal.mean(axis=1)
        keep = share >= SIGNATURE_LEAST
        if every:
            keep &= equal.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == rows[0]["band"]
        if keep.any():
            yield i, at[keep], share[keep]


def _best_partners(rows: list[dict]) -> Iterator[tuple[int, int, float]]:
    """For every node of a cell its likeliest partner in another component."""
    likeliest, partner = np.zeros(len(rows)), np.full(len(rows), -1)
    for i, at, share in _likely_pairs(rows, False):
        top = share.argmax()
        if share[top] > likeliest[i]:
            likeliest[i], partner[i] = share[top], at[top]
        better = share > likeliest[at]
        likeliest[at[better]], partner[at[better]] = share[better], i
    for i in np.flatnonzero(partner >= 0):
        yield rows[i]["node"], rows[partner[i]]["node"], float(likeliest[i])


def _with_partner(rows: list[dict]) -> Iterator[tuple[int, int, float]]:
    """The nodes of a cell that have any likely partner, with the bucket."""
    found: set[int] = set()
    for i, at, _ in _likely_pairs(rows, True):
        found.update([i, *at.tolist()])
    for i in found:
        yield rows[i]["node"], rows[i]["key"], 0.0


def _links_in(rows: list[dict]) -> Iterator[tuple[int, int, float]]:
    """The likely pairs of a cell that are similar by their full sets, which the rows hold; one per node and component suffices."""
    sets = [np.frombuffer(r["hashes"], np.uint64) for r in rows]
    for i, at, _ in _likely_pairs(rows, True):
        met: set[int] = set()
        for j in at.tolist():
            if rows[j]["component"] not in met and _similar(sets[i], sets[j]):
                met.add(rows[j]["component"])
                yield rows[i]["node"], rows[j]["node"], 1.0


def _cells(buckets: DataFrame, visit: Callable[[list[dict]], Iterator[tuple[int, int, float]]]) -> DataFrame:
    """``a, b, share`` that ``visit`` finds in cells of buckets (key, band, node, component, n_shingles, sig, members, blocks).

    A bucket is cut into its ``blocks`` by a hash of the node, and each two blocks meet in a cell. A task holds one cell at a time.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    extra = ["hashes"] if "hashes" in buckets.columns else []
    many = (
        buckets.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
            "key", "band", "node", "component", "n_shingles", "sig", "own", (F.col("own") == F.col("other")).alias("inner"), *extra,
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        found: list[tuple[int, int, float]] = []

        def taken() -> pa.RecordBatch:
            columns = [pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)]
            out = pa.record_batch([*columns, pa.array([p[2] for p in found], pa.float64())], names=["a", "b", "share"])
            found.clear()
            return out

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["cell"] != row["cell"]:
                    found += visit(held)
                    held = []
                held.append(row)
            if found:
                yield taken()
        if held:
            found += visit(held)
        if found:
            yield taken()

    return many.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long, share double")


def _last_links(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """All links between components that are left: nodes with a likely partner come together again with their full sets."""
    partners = stored(_cells(buckets, _with_partner), "partners").select(F.col("a").alias("node"), F.col("b").alias("key")).dropDuplicates()
    some = buckets.drop("members", "blocks").join(partners, ["key", "node"]).join(sets, "node")
    load = partners.join(sets.select("node", F.octet_length("hashes").alias("bytes")), "node").groupBy("key")
    load = load.agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("blocks"))
    return _cells(some.join(load, "key"), _links_in).select("a", "b")


def _open_buckets(held: DataFrame, components: DataFrame, nodes: DataFrame) -> DataFrame:
    """The buckets whose nodes lie in several components."""
    placed = held.join(components.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    left = placed.join(mixed.select("key"), "key", "left_semi").join(nodes.select("node", "n_shingles", "sig"), "node")
    return left.withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))


def grouped(docs: DataFrame, *, words: int) -> DataFrame:
    """Per row of ``docs`` its node and component, with ``doc_id``, ``uid`` (a hash of the text) and ``n_shingles``."""
    rows = stored(_sets(docs, words).withColumn("node", _node()), "sets")
    full = rows.where("n_shingles > 0")
    # one node per distinct set
    nodes = stored(
        full.groupBy("fp1", "fp2").agg(F.min(F.struct("node", "n_shingles", "sig")).alias("x")).select("fp1", "fp2", "x.*"), "nodes"
    )
    # copies are tied to their set's node, and rows of one id to all sets of it; a plain join, which AQE can split at large groups
    same = full.select("fp1", "fp2", F.col("node").alias("b")).join(nodes.select("fp1", "fp2", "node"), ["fp1", "fp2"]).where("b <> node")
    same = same.select(F.col("node").alias("a"), "b").dropDuplicates(["a", "b"])

    keyed = _memberships(nodes)
    buckets = keyed.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("members")).where("members > 1")
    held = stored(keyed.join(buckets, "key"), "buckets")
    leads = held.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).dropDuplicates(["a", "b"])
    likely = stored(_signatures_agree(_with_signatures(leads, nodes)), "pairs")

    members = held.select("node").dropDuplicates(["node"])
    sets = stored(_full_sets(docs, nodes.select("node", "fp1", "fp2").join(members, "node", "left_semi"), words), "full")
    best = likely.groupBy("b").agg(F.max_by("a", F.struct("share", "a")).alias("a"))
    links = stored(_verified(best, sets).unionAll(same), "links")

    groups = stored(connected_components(links), "components")
    for turn in range(MERGE_ROUNDS + 1):
        left = _open_buckets(held, groups, nodes)
        if turn < MERGE_ROUNDS:
            found = _cells(left.where(f"band < {MERGE_BANDS}"), _best_partners).groupBy("a").agg(F.max_by("b", F.struct("share", "b")).alias("b"))
            more = stored(_verified(stored(found, "pairs"), sets), "links")
        else:
            more = stored(_last_links(left, sets), "links")
        if more.isEmpty():
            continue
        # what is known already is a star of each component
        stars = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
        groups = stored(connected_components(stars.unionAll(more)), "components")
    return rows.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame, *, words: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs`` (doc_id, text; other columns are ignored).

    Two documents are linked when their sets of ``words``-word shingles have a similarity of 0.8 or more; a component is
    what links reach, named by its least ``doc_id``.  A text of fewer words is one shingle; a null or empty text, or one of
    blanks only, has no shingle and no link, so it is its own component.  Rows with the same ``doc_id`` are one document and
    share what either links to.  A null ``doc_id`` takes part, yet names a component only as null; ``kept`` is then false
    unless no row of the component has an id.  An empty table gives an empty result.
    """
    unnamed = F.col("component") >= F.lit(FIRST_UNNAMED)
    return grouped(docs, words=words).select(
        "doc_id",
        "n_shingles",
        F.when(~unnamed, F.col("component")).alias("component_id"),
        (F.col("component") == F.col("node")).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, *, words: int = 5) -> DataFrame:
    """The rows of ``docs``, all columns, without near copies: of each component one row of its least id stays.

    Among rows of that id one stays, chosen by hashes of text and columns.  Texts without a word are linked with nothing and
    all stay.
    """
    found = grouped(docs, words=words)
    led = found.where("n_shingles > 0 and node = component").groupBy("component").agg(F.min(F.struct("uid", "doc_id")).alias("x"))
    bare = found.where("n_shingles = 0").select("doc_id", "uid").dropDuplicates()
    winners = led.select("x.doc_id", "x.uid", F.lit(True).alias("one")).unionByName(bare.withColumn("one", F.lit(False)))
    no_id = F.lit(-(1 << 63)).cast("long")
    winners = winners.select(F.coalesce("doc_id", no_id).alias("k"), "uid", "one")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), no_id).alias("k"),
        _uid().alias("uid"),
    )
    turn = F.row_number().over(Window.partitionBy("k", "uid").orderBy(F.xxhash64("row")))
    chosen = rows.join(winners, ["k", "uid"]).withColumn("turn", turn).where("turn = 1 or not one")
    return chosen.select("row.*")


GROUPS_SQL = """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (s) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
arcs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS found FROM documents
          UNION SELECT arcs.b, reach.found FROM reach JOIN arcs ON arcs.a = reach.node),
least AS (SELECT node, min(found) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON least.node = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""


@query("op5_near_dedup", GROUPS_SQL)
def op5(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4)
