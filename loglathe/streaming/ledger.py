"""Ledgers: what a stream's batches add up to, kept as one small row per group and batch.

A stream can't hold a row window over its whole past.  Here each batch is summed up by itself and the sums are recorded under the batch's
number, so a batch that is replayed records the same again, and what all batches say is read by joining their rows.  That works for
whatever can be joined in steps: counters per file, rates, health, runs of failures.  A silent source needs no timer: health is read at a time.

A ledger lies in a folder like the store's (``sinks.commits``): an attempt counts from its marker on, and ``fold`` joins old batches to one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglathe.operators.quality import (
    QUARANTINE_STREAK,
    RATE_SLIDE_SECONDS,
    RATE_WINDOW_SECONDS,
    counter_columns,
    health_at,
    health_pieces,
    join_health,
    join_streaks,
    quarantine_report,
    slide_counts,
    streak_pieces,
    window_rates,
)
from loglathe.sinks.commits import MERGED, batch_folder, batches_of, load_state, save_list, spans_of, write_batch
from loglathe.streaming.runner import stream_run, trigger_options

#: which stream a row is of, and its batch; a folded row has the place before the newest batch
STREAM, PLACE = "stream", "place"


@dataclass(frozen=True)
class Ledger:
    """A folder of sums and the rules that make and join them.

    ``sums`` makes the rows of a batch, one per group of the columns ``by``; ``join(rows, keys)`` makes one row per group from many and what
    it returns can be joined again.  Where ``ordered`` it uses ``place``, and streams stay apart.
    """

    root: str
    by: tuple[str, ...]
    sums: Callable[[DataFrame], DataFrame]
    join: Callable[[DataFrame, list[str]], DataFrame]
    ordered: bool = False

    def record(self, rows: DataFrame, run: str, batch: int) -> None:
        """Sum up a batch; the same batch again replaces what it said, and a folded one has said it already."""
        whole = self.sums(rows).withColumns({STREAM: F.lit(run), PLACE: F.lit(batch).cast("long")})
        write_batch(rows.sparkSession, self.root, run, batch, lambda folder: whole.write.mode("overwrite").parquet(folder), if_merged="skip")

    def rows(self, spark: SparkSession) -> DataFrame:
        """The recorded rows of all batches that count, folded ones too."""
        now = load_state(spark, self.root).condition()
        return spark.read.option("mergeSchema", "true").parquet(self.root).where(now).drop("run", "batch")

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per group, and stream where the order counts, over all batches."""
        return self.join(self.rows(spark), [STREAM, *self.by] if self.ordered else list(self.by))

    def fold(self, spark: SparkSession) -> int:
        """Join all batches but the newest of each stream, which may come again; returns how many there were.

        The folded rows are written as a run of their own, and the list that replaces the batches by it is written last.
        """
        state = load_state(spark, self.root)
        own = {b for b in state.marks if not state.is_fixed(*b)}
        newest: dict[str, int] = {}
        for run, batch in own:
            newest[run] = max(batch, newest.get(run, 0))
        old = {(run, b) for run, b in own if b < newest[run]}
        if not old:
            return 0
        limits = spark.createDataFrame([(run, b - 1) for run, b in newest.items()], f"{STREAM} string, before long")
        before = self.rows(spark).join(limits, STREAM).where(F.col(PLACE) <= F.col("before")).drop("before")
        name = MERGED + uuid.uuid4().hex
        whole = self.join(before, [STREAM, *self.by]).join(limits, STREAM).withColumnRenamed("before", PLACE)
        whole.write.parquet(batch_folder(self.root, name, 0))
        state.gone = spans_of(batches_of(state.gone) | old | batches_of(state.merged))
        state.merged = {name: [(0, 0)]}
        save_list(spark, self.root, state)
        return len(old)


def run_ledger(stream: DataFrame, ledgers: Sequence[Ledger], checkpoint: str, *, every_minutes: float | None = 1) -> StreamingQuery:
    """Record each batch of ``stream`` in the ledgers.

    With several ledgers a batch's rows are kept on the executors' disks while it is summed up, so that they are read and parsed once.
    """

    def store(rows: DataFrame, batch: int) -> None:
        record_all(rows, ledgers, stream_run(rows.sparkSession, checkpoint), batch)

    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**trigger_options(every_minutes)).start()


def record_all(rows: DataFrame, ledgers: Sequence[Ledger], run: str, batch: int) -> None:
    kept = rows.persist(StorageLevel.DISK_ONLY) if len(ledgers) > 1 else rows
    try:
        for ledger in ledgers:
            ledger.record(kept, run, batch)
    finally:
        if len(ledgers) > 1:
            kept.unpersist()


# -- progress per file -----------------------------------------------------------------------------------------------

_COUNTERS = ("received", "blank", "parsed_success", "parsed_failed", "bytes")


def file_ledger(root: str, by: Sequence[str] = ("file_path",), line: str = "value") -> Ledger:
    """Lines received, blank, parsed and failed, and bytes, per file of a parsed stream; a file may come in several batches."""
    return Ledger(
        root,
        tuple(by),
        lambda parsed: parsed.groupBy(*by).agg(*counter_columns(F.col("status"), F.col(line))),
        lambda rows, keys: rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _COUNTERS]),
    )


# -- health ----------------------------------------------------------------------------------------------------------


def health_ledger(root: str, by: Sequence[str], ok: Column, error: Column, ts: str, tiebreak: str) -> Ledger:
    """Health of sources; rows are told apart by (ts, tiebreak), whatever batch they come in."""
    return Ledger(root, tuple(by), lambda rows: health_pieces(rows, by, ok, error, ts, tiebreak), join_health)


def read_health(spark: SparkSession, ledger: Ledger, now: Column) -> DataFrame:
    """``health_status`` over all batches at time ``now``; a source that has sent nothing for too long is down, though no batch says so."""
    return health_at(ledger.read(spark), ledger.by, now)


# -- runs of failures ------------------------------------------------------------------------------------------------


def streak_ledger(root: str, by: Sequence[str], order: Sequence[str], ok: Column) -> Ledger:
    """Runs of failures, also across batches: those of a stream come one after the other, and within a batch rows have the order ``order``."""
    return Ledger(
        root,
        tuple(by),
        lambda rows: join_streaks(streak_pieces(rows, by, order, ok), by, ["piece"]),
        lambda rows, keys: join_streaks(rows, keys, [PLACE]),
        ordered=True,
    )


def read_quarantine(spark: SparkSession, ledger: Ledger, threshold: int = QUARANTINE_STREAK) -> DataFrame:
    """``pattern_quarantine`` over all batches, per stream."""
    return quarantine_report(ledger.read(spark), [STREAM, *ledger.by], threshold)


# -- rates -----------------------------------------------------------------------------------------------------------


def rate_ledger(root: str, ts: str = "ts", by: Sequence[str] = (), delay: str = "2 minutes", slide_seconds: int = RATE_SLIDE_SECONDS) -> Ledger:
    """Records per slide of event time, those that came late too.

    A slide's records in a batch are late if the slide ended ``delay`` or more before the newest record of an earlier batch: a watermark would
    have dropped them.  Here they count, and are counted apart as well.
    """

    def sums(rows: DataFrame) -> DataFrame:
        slides = slide_counts(rows, ts, by, slide_seconds, F.max(ts).alias("newest"))
        return slides.withColumn("late", F.lit(None).cast("long"))

    def join(rows: DataFrame, keys: list[str]) -> DataFrame:
        # a row for each batch
        marks = rows.groupBy(STREAM, PLACE).agg(F.max("newest").alias("mark"))
        earlier = Window.partitionBy(STREAM).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
        marks = marks.withColumn("mark", F.max("mark").over(earlier) - F.expr(f"INTERVAL {delay}"))
        end = F.col("start") + F.make_dt_interval(secs=F.lit(slide_seconds))
        late = F.coalesce("late", F.when(end <= F.col("mark"), F.col("n")).otherwise(0))
        told = rows.join(marks, [STREAM, PLACE]).withColumn("late", late)
        return told.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("newest").alias("newest"), F.sum("late").alias("late"))

    return Ledger(root, (*by, "start"), sums, join)


def read_rates(
    spark: SparkSession, ledger: Ledger, window_seconds: int = RATE_WINDOW_SECONDS, slide_seconds: int = RATE_SLIDE_SECONDS
) -> DataFrame:
    """``records_per_second`` over all batches, windows that are still open too, with the records that came late as ``late``."""
    return window_rates(ledger.read(spark), ledger.by[:-1], window_seconds, slide_seconds, "late")
