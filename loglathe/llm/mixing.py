"""Mixing sources to target weights by systematic sampling.

Within a source every document expects the same number of copies, ``target / size of the source``. The expectations are
summed along the documents in order of size; one random offset is added, and a document is emitted once per whole number
that its part of the sum crosses. Neighbours in the order are alike in size, so the words taken come close to the target.

The sum at a document is its rank times the expectation. Ranks come from counts: a source is cut into size classes and these
by a hash of the id into 4,096 blocks, counts of blocks and classes are summed up, and only within a block are rows sorted.
So no source, however large, lies in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglathe.llm.common import WORD, query, stored, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5  # of all sizes
MOST = 2.0  # of a source's size
SEED = "mix"


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, a row for each source.

    Each gets its weight's part of ``SHARE`` of all words, at most ``MOST`` times its own; what is above goes to the others by
    weight, again and again.  The end of that is a level: with sources in order of cap per weight, those before the first
    that holds its part at the level of the rest stay at their caps.  Sources are few: one task orders them.
    """
    everything = Window.partitionBy(F.lit(0))
    order = everything.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    ranked = sizes.withColumn("weight", weight).withColumn("cap", MOST * F.col("source_size"))
    by_cap = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    behind = by_cap.rowsBetween(0, Window.unboundedFollowing)
    level = (SHARE * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(behind)
    levels = ranked.withColumn("at", F.row_number().over(by_cap)).withColumn("level", level)
    holds = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.struct("at", "level"))
    settled = levels.withColumn("level", F.min(holds).over(everything)["level"])
    target = F.coalesce(F.least("cap", F.col("weight") * F.col("level")), F.col("cap"))
    return settled.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, size: Column) -> DataFrame:
    """``row`` (all columns of ``docs``), ``size, source_size, target, copies`` for each row of ``docs`` (doc_id, source).

    ``copies`` says how often the mix takes the row: 0, 1 or 2.  Null ids, null sources (one source, the last), repeated rows and
    rows of size 0 take part like others; a source of size 0 has target 0 and is not taken.  The order of rows with the same
    id and size follows from their other columns, so reruns agree.  An empty table gives an empty result.
    """
    digits = F.col("size").cast("string")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), size.alias("size")).select(
        "*",
        F.col("row.source").isNull().alias("unnamed"),
        F.coalesce("row.source", F.lit("")).alias("name"),
        (F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")).alias("class"),
        F.md5(F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")).cast("binary")).alias("place"),
    )
    rows = rows.withColumn("block", F.substring("place", 1, 3))
    source, classed = ["unnamed", "name"], ["unnamed", "name", "class"]
    blocked = [*classed, "block"]

    blocks = stored(rows.groupBy(*blocked).agg(F.count("*").alias("n"), F.sum("size").alias("words")), "blocks")
    classes = blocks.groupBy(*classed).agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    sources = classes.groupBy(*source).agg(F.sum("words").alias("source_size"))
    targets = source_targets(sources.select(F.when(~F.col("unnamed"), F.col("name")).alias("source"), "source_size"))
    targets = targets.select(F.col("source").isNull().alias("unnamed"), F.coalesce("source", F.lit("")).alias("name"), "source_size", "target")

    def above(keys: list[str], by: str) -> Column:
        ahead = Window.partitionBy(*keys).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(ahead), F.lit(0))

    class_at = classes.select(*classed, above(source, "class").alias("class_at")).join(targets, source)
    block_at = blocks.select(*blocked, above(classed, "block").alias("block_at")).join(class_at, classed)

    inside = Window.partitionBy(*blocked).orderBy("place", "size", F.xxhash64("row"))
    rank = F.col("class_at") + F.col("block_at") + F.row_number().over(inside)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(SEED), "name").cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(offset + expected * F.col("rank")) - F.floor(offset + expected * (F.col("rank") - 1))
    return rows.join(block_at, blocked).withColumn("rank", rank).select("row", "size", "source_size", "target", crossed.alias("copies"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: the rows of ``docs`` (doc_id, text, source), all columns, each as often as it is taken."""
    taken = mix_sources(docs, size_in_words(F.col("text"))).where("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


MIX_SQL = """
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
             [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM s),
l AS (SELECT *, row_number() OVER o AS pos,
             (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
t AS (SELECT source, source_size,
             coalesce(least(cap, weight * (SELECT arg_min(level, pos) FROM l WHERE level <= cap / weight)), cap) AS target FROM l),
r AS (SELECT doc_id, size, source_size, target,
             CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS e,
             ('0x' || md5('mix' || coalesce(d.source, ''))[1:8])::BIGINT / 4294967296.0::DOUBLE AS u,
             row_number() OVER (PARTITION BY d.source ORDER BY length(size::VARCHAR) * 100 + (size::VARCHAR)[1:2]::INT,
                                md5(coalesce(doc_id::VARCHAR, '')), size) AS k
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * (floor(u + e * k) - floor(u + e * (k - 1)))::BIGINT AS taken FROM r
"""


@query("op4_mix_sources", MIX_SQL)
def op4(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # the texts are read once; what follows works on narrow rows
    narrow = stored(docs.select("doc_id", "source", size_in_words(F.col("text")).alias("size")), "sizes")
    rows = mix_sources(narrow, F.col("size"))
    return rows.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
