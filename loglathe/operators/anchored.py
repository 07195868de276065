"""Error limits whose minute begins with the first error, not with the clock.

The window of an operation starts at its first error and takes all errors up to a minute later; the first one after that starts the next
window.  Where a window starts depends on all windows before it, but only errors whose forerunner is over a minute old certainly start one,
and from these the others are reached by following pointers, each from an error to the first one over a minute later.

Pointers are composed over blocks of time that double.  A window that comes from an earlier block starts in the first minute of its block, or with the
first error after that, so with each doubling only half as many errors need a pointer out of their block: a storm of n minutes takes about log n rounds,
and all rounds together take as much work as the first.  Then the starts are found from the longest blocks down, each round adding those inside.

All of it is done on counts per operation and millisecond, of which a minute has at most 60,000, however many errors there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglathe.operators.quality import ERRORS_KEPT_PER_MINUTE
from loglathe.session import scratch_dir

WINDOW_MS = 60_000
#: windows in a stretch of time that one task looks through
STRETCH = 4


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def _bucket(ms: Column, window_ms: int) -> Column:
    return F.floor(ms / window_ms)


def pointers(moments: DataFrame, window_ms: int = WINDOW_MS) -> DataFrame:
    """``op, ms, prior, next, certain`` for each of ``moments`` (op, ms): the moment before it, the first one over a window later, and whether the
    one before it is over a window earlier.

    Both are looked for in the moment's stretch of a few windows.  A stretch also gets the moments of the next one's first window, and one more on
    each side, from a table of one row for each stretch.
    """
    length = STRETCH * window_ms
    rows = moments.select("op", "ms", F.floor(F.col("ms") / length).alias("stretch"))
    beyond = F.when(F.col("ms") - F.col("stretch") * length > window_ms, F.col("ms"))
    ends = rows.groupBy("op", "stretch").agg(F.min("ms").alias("first"), F.max("ms").alias("last"), F.min(beyond).alias("beyond"))
    following = Window.partitionBy("op").orderBy("stretch")
    lead = lambda name, n=1: F.lead(name, n).over(following)
    later = F.when(lead("stretch") == F.col("stretch") + 1, F.coalesce(lead("beyond"), lead("first", 2))).otherwise(lead("first"))
    sides = ends.select("op", "stretch", later.alias("later"), F.lag("last").over(following).alias("earlier"))
    sides = sides.select("op", "stretch", F.explode(F.array("later", "earlier")).alias("ms")).where("ms is not null")
    ahead = rows.where(F.col("ms") - F.col("stretch") * length <= window_ms).select("op", F.col("stretch") - 1, "ms")
    there = rows.select("op", "stretch", "ms", F.lit(True).alias("own"))
    for more in (ahead, sides):
        there = there.unionAll(more.withColumn("own", F.lit(False)))
    # from the latest one back, where frames that begin with the first row only grow
    back = Window.partitionBy("op", "stretch").orderBy(F.col("back"))
    found = there.withColumn("back", -F.col("ms")).select(
        "op", "ms", "own",
        F.lead("ms").over(back).alias("prior"),
        F.min("ms").over(back.rangeBetween(Window.unboundedPreceding, -(window_ms + 1))).alias("next"),
    )
    return found.where("own").select("op", "ms", "prior", "next", F.coalesce(F.col("ms") - F.col("prior") > window_ms, F.lit(True)).alias("certain"))


def _of(df: DataFrame, name: str) -> DataFrame:
    """``o, m`` and the column ``name``, to be joined with other moments."""
    return df.select(F.col("op").alias("o"), F.col("ms").alias("m"), F.col(name).alias("x"))


def anchors(moments: DataFrame, window_ms: int = WINDOW_MS) -> DataFrame:
    """``op, anchor`` for each window of ``moments`` (op, ms), which are distinct."""
    links = _stored(pointers(moments, window_ms), "pointers")
    certain = links.where("certain").select("op", F.col("ms").alias("anchor"))
    origin = links.agg(F.min("ms")).first()[0]
    same = F.col("op").eqNullSafe(F.col("o"))
    sure = links.where("certain").select(F.col("op").alias("o"), F.col("ms").alias("m"))
    # what certainly starts a window need not be pointed at
    level = _stored(links.where("next is not null").select("op", "ms", "prior", "certain", F.col("next").alias("exit")).join(sure, same & (F.col("exit") == F.col("m")), "left_anti"), "exits")
    levels, length = [], window_ms
    while not level.isEmpty():
        length *= 2
        block = lambda at, length=length: F.floor((F.col(at) - origin) / length)
        stays = block("ms") == block("exit")
        levels.append((level, stays))
        entry = F.col("prior") < origin + block("ms") * length + window_ms
        kept = level.where(F.col("certain") | F.col("prior").isNull() | entry)
        on = kept.where(stays).join(_of(level, "exit"), same & (F.col("exit") == F.col("m"))).select("op", "ms", "prior", "certain", F.col("x").alias("exit"))
        level = _stored(kept.where(~stays).unionAll(on), "exits")
    found = None
    for level, stays in reversed(levels):
        inside = level.where(stays)
        new = inside.where("certain").select("op", F.col("exit").alias("anchor"))
        if found is not None:
            there = found.select(F.col("op").alias("o"), F.col("anchor").alias("m"))
            new = new.unionAll(inside.where("not certain").join(there, same & (F.col("ms") == F.col("m")), "left_semi").select("op", "exit")).unionAll(found)
        found = _stored(new.distinct(), "anchors")
    return certain if found is None else certain.unionAll(found)


def _windows(found: DataFrame, window_ms: int) -> DataFrame:
    """``o, b, anchor``: each window in the two buckets it reaches into."""
    bucket = _bucket(F.col("anchor"), window_ms)
    return found.select(F.col("op").alias("o"), "anchor", F.explode(F.array(bucket, bucket + 1)).alias("b"))


def _inside(ms: str, window_ms: int) -> Column:
    at = F.col(ms)
    return F.col("op").eqNullSafe(F.col("o")) & (_bucket(at, window_ms) == F.col("b")) & at.between(F.col("anchor"), F.col("anchor") + window_ms)


def _moments(errors: DataFrame, operation: str, ts: str) -> DataFrame:
    """Errors per operation and millisecond, counted before they are moved; errors without a time belong to no window."""
    return errors.where(F.col(ts).isNotNull()).groupBy(F.col(operation).alias("op"), _ms(ts).alias("ms")).agg(F.count(F.lit(1)).alias("n"))


def error_sample_anchored(
    errors: DataFrame, operation: str, ts: str, tiebreak: str, keep: int = ERRORS_KEPT_PER_MINUTE, window_ms: int = WINDOW_MS
) -> DataFrame:
    """The first ``keep`` errors of each window, with ``window_start`` and ``rank``, in the order of (ts, tiebreak).

    Of one operation and millisecond only the first ``keep`` can be among them, so a storm sends no more than these to a window.
    """
    found = anchors(_stored(_moments(errors, operation, ts), "moments").select("op", "ms"), window_ms)
    rows = errors.where(F.col(ts).isNotNull()).select(F.struct(*errors.columns).alias("row"), F.col(operation).alias("op"), _ms(ts).alias("ms"), F.col(ts).alias("t"), F.col(tiebreak).alias("tie"))
    first = Window.partitionBy("op", "ms").orderBy("t", "tie")
    few = rows.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= keep).drop("rank")
    order = Window.partitionBy("op", "anchor").orderBy("t", "tie")
    placed = few.join(_windows(found, window_ms), _inside("ms", window_ms)).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    return placed.select("row.*", F.timestamp_millis("anchor").alias("window_start"), "rank")


def error_counts_anchored(errors: DataFrame, operation: str, ts: str, keep: int = ERRORS_KEPT_PER_MINUTE, window_ms: int = WINDOW_MS) -> DataFrame:
    """Errors per operation and window: how many, how many a sample keeps and how many it leaves out."""
    counted = _stored(_moments(errors, operation, ts), "moments")
    placed = counted.join(_windows(anchors(counted.select("op", "ms"), window_ms), window_ms), _inside("ms", window_ms))
    n = F.col("errors")
    return placed.groupBy("op", "anchor").agg(F.sum("n").alias("errors")).select(
        F.col("op").alias(operation),
        F.timestamp_millis("anchor").alias("window_start"),
        "errors",
        F.least(n, F.lit(keep)).alias("kept"),
        F.greatest(n - keep, F.lit(0)).alias("suppressed"),
        (n > keep).alias("limit_reached"),
    )
