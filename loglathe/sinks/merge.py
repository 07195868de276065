"""Merging small files into files of a target size, whatever batch or run they are of.

1.  Sizes come from a listing, rows from file footers. A part (run, batch, outcome, date) whose files are small on average, or have one far
    above the target, is taken up.
2.  The parts of one outcome and date lie one behind the other, and the line is cut into bins of equal bytes, as near to the target as
    can be; rows of a file that a cut goes through are split by their place in the file.
3.  The bins are written as a new run ``merged-..``, one file each; readers leave it out.
4.  The list of what counts is written anew (``commits``): from then on readers take the merged run and leave out its parts. A crash before
    or after changes nothing that a reader sees.
5.  ``remove_replaced`` deletes what nobody reads any more, at any time later.

Deleting goes through Hadoop's file system in the driver's JVM, which Spark Connect doesn't offer; all else is DataFrame code.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglathe.sinks.commits import (
    ATTEMPT,
    MERGED,
    PART_KEY,
    State,
    batch_folder,
    batches_of,
    delete_folder,
    delete_if_empty,
    forget_marks,
    load_state,
    plain_run,
    save_list,
    spans_of,
    visible,
)

__all__ = ["compact", "merge_batches", "remove_replaced", "visible"]

TARGET_BYTES = 128 * 1024 * 1024
_PLACE = r"run=([^/]+)/batch=([0-9]+)/outcome=([^/]+)/event_date=([^/]+)/[^/]+$"


def _key(path: Column) -> Column:
    """A file's place under the root; the two ways Spark writes paths differ before it."""
    return F.regexp_extract(path, f"({_PLACE[:-1]})$", 1)


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """``file, bytes, run, batch, outcome, event_date`` of all files under the root."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    place = [F.regexp_extract("path", _PLACE, i + 1).alias(c) for i, c in enumerate(PART_KEY)]
    return found.select(_key(F.col("path")).alias("file"), F.col("length").alias("bytes"), *place).withColumn("batch", F.col("batch").cast("long"))


def _bins(files: DataFrame, target_bytes: int, everything: bool) -> DataFrame:
    """``files`` (file, bytes, rows, outcome, event_date) with ``start, data, share, bins, base``, unless an outcome and date gains nothing.

    What each file costs beside its rows, footers and the like, is taken from how bytes grow with rows, and left out of the sums.  A bin's
    number is ``base`` plus the whole part of a row's place on the line over ``share``.
    """
    line = Window.partitionBy("outcome", "event_date").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.regr_intercept("bytes", "rows")
    overhead = files.groupBy("outcome").agg(F.when(fixed > 0, F.least(fixed, 0.9 * F.min("bytes"))).otherwise(0.0).alias("overhead"))
    sized = files.join(overhead, "outcome").withColumn("data", F.col("bytes") - F.col("overhead"))
    sized = sized.withColumn("start", F.coalesce(F.sum("data").over(line), F.lit(0.0)))
    room = F.greatest(F.lit(target_bytes) - F.first("overhead"), F.lit(target_bytes) * 0.1)
    groups = sized.groupBy("outcome", "event_date").agg(
        F.sum("data").alias("total"),
        F.count("*").alias("files"),
        F.max("bytes").alias("largest"),
        F.greatest(F.lit(1), F.round(F.sum("data") / room)).cast("long").alias("bins"),
    )
    # a row for each outcome and date
    before = Window.orderBy("outcome", "event_date").rowsBetween(Window.unboundedPreceding, -1)
    worth = groups if everything else groups.where((F.col("files") > F.col("bins")) | (F.col("largest") > 2 * target_bytes))
    based = worth.withColumn("base", F.coalesce(F.sum("bins").over(before), F.lit(0))).withColumn("share", F.col("total") / F.col("bins"))
    return sized.join(based.select("outcome", "event_date", "bins", "base", "share"), ["outcome", "event_date"])


def _merge(spark: SparkSession, root: str, target_bytes: int, chosen: Column | None, everything: bool) -> str | None:
    state = load_state(spark, root)
    files = stored_files(spark, root).where(state.condition()).persist()
    try:
        return _merge_files(spark, root, state, files, target_bytes, chosen, everything)
    finally:
        files.unpersist()


def _merge_files(spark: SparkSession, root: str, state: State, files: DataFrame, target_bytes: int, chosen: Column | None, everything: bool) -> str | None:
    from loglathe.sinks.tables import Layout

    # a stream may write its last batch once more
    newest = F.max("batch").over(Window.partitionBy("run"))
    parts = files.groupBy(*PART_KEY).agg(F.sum("bytes").alias("sum"), F.count("*").alias("n"), F.max("bytes").alias("most"))
    if chosen is not None:
        parts = parts.where(chosen)
    else:
        parts = parts.withColumn("newest", newest).where(~F.col("run").startswith("stream-") | (F.col("batch") < F.col("newest")))
    if not everything:
        parts = parts.where((F.col("sum") < target_bytes / 2 * F.col("n")) | (F.col("most") > 2 * target_bytes))
    taken = files.join(parts.select(*PART_KEY), list(PART_KEY), "left_semi")
    if everything and taken.select("run", "batch").distinct().limit(2).count() < 2:
        return None
    places = [r["p"] for r in taken.select(_folder(root).alias("p")).distinct().collect()]
    if not places:
        return None
    source = spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*places)
    rows = source.groupBy(_key(F.col("_metadata.file_path")).alias("file")).agg(F.count("*").alias("rows"))
    plan = _bins(taken.join(rows, "file"), target_bytes, everything).persist()
    try:
        wanted = plan.agg(F.sum("rows")).head()[0]
        if not wanted:
            return None
        name = MERGED + uuid.uuid4().hex
        slots = plan.select(*[F.col(c).alias(f"__{c}") for c in ("file", "rows", "start", "data", "share", "bins", "base")])
        at = F.floor((F.col("__start") + F.col("__data") * F.col("__row") / F.col("__rows")) / F.col("__share"))
        number = F.col("__base") + F.least(at, F.col("__bins") - 1)
        path, row = _key(F.col("_metadata.file_path")).alias("__file"), F.col("_metadata.row_index").alias("__row")
        placed = source.select("*", path, row).join(slots, "__file").withColumn("batch", number.cast("long"))
        dealt = placed.drop("run", "__row", *slots.columns).repartition("batch")
        folder = batch_folder(root, name)
        dealt.write.partitionBy("batch", "outcome", "event_date").options(**Layout().options()).parquet(folder)
        found = spark.read.parquet(folder).agg(F.count("*"), F.max("batch")).head()
        if found[0] != wanted:
            raise RuntimeError(f"{wanted} rows were merged into {found[0]}; {folder} does not count")
        _replace(state, files, plan, name, found[1])
        save_list(spark, root, state)
        return name
    finally:
        plan.unpersist()


def _folder(root: str) -> Column:
    return F.concat(F.lit(root), *[x for c in PART_KEY for x in (F.lit(f"/{c}="), F.col(c).cast("string"))])


def _replace(state: State, files: DataFrame, plan: DataFrame, name: str, last: int) -> None:
    """Let ``state`` say that the files of ``plan`` are replaced by the run ``name``; the driver sees their parts."""
    taken = {tuple(r) for r in plan.select(*PART_KEY).distinct().collect()}
    some = {p[:2] for p in taken}
    batches = plan.select("run", "batch").distinct()
    left = files.join(batches, ["run", "batch"], "left_semi").select(*PART_KEY).distinct().collect()
    partly = {(r["run"], r["batch"]) for r in left if tuple(r) not in taken}
    gone = {(plain_run(run), b) for run, b in some - partly}
    kept = {(plain_run(run), b) for run, b in some & partly}
    state.merged[name] = [(0, last)]
    state.gone = spans_of(batches_of(state.gone) | gone)
    state.kept = spans_of((batches_of(state.kept) | kept) - gone)
    state.parts = {p for p in state.parts | taken if p[:2] in partly or p in state.parts and p[:2] not in some}


def compact(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES) -> str | None:
    """Merge small files of all runs into files of about ``target_bytes``; returns the merged run's name, or None if nothing is small.

    Files come out between half and twice the target where an outcome and date has that much.  Merged runs are merged again when more small
    files have come beside them. The newest batch of a stream is left alone.  Schemas of the files must go together (new columns are null
    in older rows).
    """
    return _merge(spark, root, target_bytes, None, False)


def merge_batches(spark: SparkSession, root: str, run: str, up_to: int, target_bytes: int = TARGET_BYTES) -> str | None:
    """Merge all batches of one run that are not above ``up_to``, which must be finished; returns the merged run's name.

    Batches merged before are left alone; with fewer than two to merge nothing happens.
    """
    return _merge(spark, root, target_bytes, (F.substring_index("run", ATTEMPT, 1) == run) & (F.col("batch") <= up_to), True)


def remove_replaced(spark: SparkSession, root: str) -> int:
    """Delete the folders of batches and parts that no longer count; returns how many there were.

    Readers that began before the merge may still need them. Entries that have done their work leave the list: those of runs that can't come again,
    and parts.
    """
    state = load_state(spark, root)
    if not state.version:
        return 0
    gone, removed = batches_of(state.gone), 0
    folders = {(r["run"], r["batch"]) for r in stored_files(spark, root).select("run", "batch").distinct().collect()}
    for run, batch in sorted(folders):
        if (plain_run(run), batch) in gone:
            removed += delete_folder(spark, f"{root}/run={run}/batch={batch}")
            delete_if_empty(spark, f"{root}/run={run}")
    for part in sorted(state.parts):
        removed += delete_folder(spark, root + "".join(f"/{c}={v}" for c, v in zip(PART_KEY, part, strict=True)))
    forget_marks(spark, root, gone)
    left = {plain_run(run) for run, batch in folders if (plain_run(run), batch) not in gone}
    state.parts = set()
    state.merged = {run: spans for run, spans in state.merged.items() if run in left}
    for kind in ("gone", "kept"):
        setattr(state, kind, {run: spans for run, spans in getattr(state, kind).items() if not _once(run) or run in left})
    save_list(spark, root, state)
    return removed


def _once(run: str) -> bool:
    """Names that are made for one batch and never come again."""
    return run.startswith(("batch-", MERGED))
