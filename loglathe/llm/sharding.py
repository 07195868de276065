"""Sharding by fixed virtual slots.

A record's slot is a hash of the record and never changes; a versioned table says which shard holds which of all slots. Bytes are summed
per slot, and a map is edited, not made anew: slots stay where they are unless their shard is above its share or is closed,
and what is loose goes, largest first, to the shard with the fewest bytes. The first map is an edit of an empty one.

Under the law ``bytes`` no key may weigh more than others, so the hash covers all that a record has, and equal records, which are
counted and not told apart, are numbered before they are hashed.  Slots are a fixed few thousand, so the map is small whatever the
data; all of it is DataFrame code.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglathe.llm.common import query, stored, table
from loglathe.session import scratch_dir

SLOTS = 8192
RECORD_BYTES = 16
_MAP = "vslot int, shard int, bytes long, records long"


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("long")


def virtual_slot(*columns: str, slots: int = SLOTS) -> Column:
    """The slot of a record by its values; a null has a place like any other value."""
    return F.pmod(F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]), F.lit(slots)).cast("int")


def numbered_copies(records: DataFrame) -> DataFrame:
    """``records`` with ``copy``, which counts equal ones from 0.

    Equal records are folded to a count before they are moved, and unfolded again from it.
    """
    counted = records.groupBy(*records.columns).agg(F.count("*").alias("copies"))
    return counted.select(*records.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))


def slot_weights(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``vslot, bytes, records`` of rows with ``vslot`` and ``size``, for all slots, empty ones too."""
    held = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    zero = F.lit(0).cast("long")
    return every.join(held, "vslot", "left").select("vslot", F.coalesce("bytes", zero).alias("bytes"), F.coalesce("records", zero).alias("records"))


class SlotMaps:
    """Versions of a slot map in a shared folder; one is written by each edit, and the next edit reads it.

    Only one edit may be under way at a time: a version that exists already is an error.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def newest(self) -> DataFrame | None:
        try:
            maps = self.spark.read.schema(f"{_MAP}, version int").option("basePath", self.root).parquet(self.root)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        version = maps.agg(F.max("version")).head()[0]
        return None if version is None else maps.where(F.col("version") == version)

    def edit(self, weights: DataFrame, shards: int) -> DataFrame:
        """The next version, for ``shards`` shards and slots of these weights."""
        edited = edit_slot_map(weights, shards, self.newest()).persist()
        try:
            version = edited.agg(F.max("version")).head()[0]
            edited.drop("version").coalesce(1).write.parquet(f"{self.root}/version={version}")
        finally:
            edited.unpersist()
        return self.newest()


def edit_slot_map(weights: DataFrame, shards: int, current: DataFrame | None = None) -> DataFrame:
    """``version, vslot, shard, bytes, records``: where each slot of ``weights`` goes when there are ``shards`` shards.

    ``current`` is the map before (version, vslot, shard).  A shard keeps its slots, largest first, while they fit in an equal share
    of all bytes, and empty ones; the others, new slots, and slots of shards that are gone are dealt to the emptiest shard.
    """
    if current is None:
        placed = weights.withColumn("was", F.lit(None).cast("int")).withColumn("version", F.lit(0))
    else:
        known = current.select("vslot", F.col("shard").alias("was"), "version")
        placed = weights.join(known, "vslot", "left")
    order = Window.partitionBy("was").orderBy(F.desc("bytes"), "vslot")
    share = F.sum("bytes").over(Window.partitionBy(F.lit(0))) / shards
    stays = (F.col("was") < shards) & ((F.sum("bytes").over(order) <= share) | (F.col("bytes") == 0))
    rows = placed.withColumn("share", share).withColumn("stays", F.coalesce(stays, F.lit(False)))
    slot = F.struct((-F.col("bytes")).alias("minus"), "vslot", "was", "bytes", "records", "stays")
    # one row of at most SLOTS entries
    whole = rows.agg(F.array_sort(F.collect_list(slot)).alias("slots"), (F.coalesce(F.max("version"), F.lit(0)) + 1).alias("version"))
    kept = F.filter("slots", lambda s: s["stays"])
    loads = F.aggregate(
        kept,
        F.array_repeat(F.lit(0).cast("long"), shards),
        lambda acc, s: F.transform(acc, lambda x, i: F.when(i == s["was"], x + s["bytes"]).otherwise(x)),
    )

    def deal(acc: Column, s: Column) -> Column:
        to = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return F.struct(
            # empty slots are dealt out in turn
            F.transform(acc["loads"], lambda x, i: F.when(i == to, x + F.greatest(s["bytes"], F.lit(1))).otherwise(x)).alias("loads"),
            F.concat(acc["to"], F.array(to)).alias("to"),
        )

    start = F.struct(F.col("loads").alias("loads"), F.array().cast("array<int>").alias("to"))
    dealt = whole.select("version", "slots", kept.alias("kept"), loads.alias("loads"), F.filter("slots", lambda s: ~s["stays"]).alias("loose"))
    dealt = dealt.withColumn("to", F.aggregate("loose", start, deal, lambda acc: acc["to"]))
    moved = F.transform("loose", lambda s, i: F.struct(s["vslot"].alias("vslot"), F.get("to", i).alias("shard"), s["bytes"].alias("bytes"), s["records"].alias("records")))
    stayed = F.transform("kept", lambda s: F.struct(s["vslot"].alias("vslot"), s["was"].alias("shard"), s["bytes"].alias("bytes"), s["records"].alias("records")))
    return dealt.select("version", F.explode(F.concat(stayed, moved)).alias("s")).select("version", "s.*")


def place_records(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """``records`` (vslot and others) with ``shard`` and ``slot``, the row's place in its shard, gapless from 0.

    Places follow from the counts of these records: the slots of a shard lie one behind the other, and rows are ordered within a slot
    only.  A record whose slot is not in the map, or that the map's counts leave out, ends the job.
    """
    ahead = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.select("vslot", "shard", F.col("records").alias("held"), F.coalesce(F.sum("records").over(ahead), F.lit(0)).alias("start"))
    names = [c for c in records.columns if c != "vslot"]
    inside = Window.partitionBy("vslot").orderBy(*[F.col(c).asc_nulls_first() for c in names])
    numbered = records.withColumn("place", F.row_number().over(inside) - 1)
    # the map has a row for each slot
    placed = numbered.join(F.broadcast(starts), "vslot", "left")
    known = F.col("shard").isNotNull() & (F.col("place") < F.col("held"))
    slot = F.when(known, F.col("start") + F.col("place")).otherwise(F.raise_error(F.concat(F.lit("Not in the slot map: slot "), F.col("vslot").cast("string"))).cast("long"))
    return placed.select(*names, "shard", slot.alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 40, maps: SlotMaps | None = None) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for each row of ``docs`` (doc_id, text).

    The law is ``bytes``: shards hold nearly equal sizes.  Size is the text's bytes plus 16; a null text counts, and hashes, like an empty
    one.  Rows of one id, or without one, are spread like all others, and so are equal rows, which get different places.  Texts of any
    length are read whole.  ``grown_shard`` is null under this law.  The map is the next version of ``maps``, or the first of a new folder
    under the shared one; an empty table has one too, and no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    records = docs.select("doc_id", record_bytes(F.col("text").cast("string")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    records = numbered_copies(records).withColumn("vslot", virtual_slot("doc_id", "size", "text_crc32", "copy"))
    records = stored(records, "records")
    slot_map = (maps or SlotMaps(spark, scratch_dir(spark, "slot_maps"))).edit(slot_weights(records), shards)
    return place_records(records, slot_map).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query("op9_shard")
def op9(spark, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
