"""Parse quality as aggregates: counters, success rate, health, rates, error samples and failing patterns.

All of them reduce each task's rows before anything is shuffled, so a key that holds most of the rows costs no more
than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loglathe.operators.parse import BLANK, OK

# Health and suppression limits.
HEALTH_MIN_TOTAL = 100
STALE_AFTER_SECONDS = 300
ERRORS_KEPT_PER_MINUTE = 10
QUARANTINE_STREAK = 10
RATE_WINDOW_SECONDS = 60
RATE_SLIDE_SECONDS = 10
# up to here Spark limits ranks before it shuffles
RANK_LIMIT = 1000


def counter_columns(status: Column, line: Column | None = None) -> list[Column]:
    """Aggregates over the parse outcome; usable in ``agg`` and in ``observe``."""
    out = [
        F.count(F.lit(1)).alias("received"),
        F.count_if(status == BLANK).alias("blank"),
        F.count_if(status == OK).alias("parsed_success"),
        F.count_if(~status.isin(OK, BLANK)).alias("parsed_failed"),
    ]
    if line is not None:
        out.append(F.coalesce(F.sum(F.octet_length(line).cast("long")), F.lit(0)).alias("bytes"))
    return out


def parse_counters(parsed: DataFrame, by: Sequence[str | Column] = (), col: str | None = None) -> DataFrame:
    """Lines received, blank, parsed and failed per group (say log type or file); bytes too when ``col`` is given."""
    return parsed.groupBy(*by).agg(*counter_columns(F.col("status"), F.col(col) if col else None))


def success_rate(good: Column, failed: Column) -> Column:
    """Percentage of good records; 100 when there are none at all."""
    total = good + failed
    return F.coalesce(100.0 * good / F.nullif(total, F.lit(0)), F.lit(100.0))


def success_rates(parsed: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    counts = parse_counters(parsed, by)
    return counts.withColumn("success_rate", success_rate(F.col("parsed_success"), F.col("parsed_failed")))


def _order_key(ts: Column, tiebreak: Column) -> Column:
    """(ts, tiebreak) as one number, so that its maximum fits a hash aggregate's fixed-width buffer."""
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(18,0)")
    return micros * F.lit(str(10**19)).cast("decimal(20,0)") + tiebreak.cast("decimal(19,0)")


def health_status(
    df: DataFrame, by: Sequence[str], ok: Column, error: Column, ts: str, tiebreak: str, now: Column
) -> DataFrame:
    """Health per group at time ``now``, as if its records had been reported one by one in (ts, tiebreak) order.

    A failure makes a group unhealthy once it has seen more than 100 records and more than half of them failed; a
    success heals it.  Since after the last success both conditions can only turn true, the state follows from the last
    record and the totals.  A group without a success for 300 seconds is down as well; before the first success the
    clock runs from the first record.

    Rows are read once: a task keeps per group the totals and the text of the last record, which ``join_health`` brings together.
    """
    return health_at(join_health(health_pieces(df, by, ok, error, ts, tiebreak), by), by, now)


def health_pieces(df: DataFrame, by: Sequence[str], ok: Column, error: Column, ts: str, tiebreak: str) -> DataFrame:
    """What health follows from, per group: totals, times, and the text of the last record (null after a success) with its position.

    A text has no place in a hash aggregate's fixed-width buffer, so each task sorts its rows by group before it sums them up; that costs less than
    reading and parsing them once more to look the texts up.  A task sends one row a group.
    """
    position = _order_key(F.col(ts), F.col(tiebreak))
    rows = df.select(*by, ok.alias("__ok"), F.when(~ok, error).alias("__error"), F.col(ts).alias("__ts"), position.alias("__at"))
    good = F.col("__ok")
    return rows.groupBy(*by).agg(
        F.count_if(good).alias("processed"),
        F.count_if(~good).alias("failed"),
        F.max(F.when(good, F.col("__ts"))).alias("last_success"),
        F.min("__ts").alias("first_seen"),
        F.max("__at").alias("last_at"),
        F.max_by(F.struct(good.alias("ok"), F.col("__error").alias("error")), "__at").alias("last"),
    )


def join_health(pieces: DataFrame, by: Sequence[str]) -> DataFrame:
    """One piece per group from pieces of any batches, in any order: what this returns can be joined again."""
    return pieces.groupBy(*by).agg(
        F.sum("processed").alias("processed"),
        F.sum("failed").alias("failed"),
        F.max("last_success").alias("last_success"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_at").alias("last_at"),
        F.max_by("last", "last_at").alias("last"),
    )


def health_at(joined: DataFrame, by: Sequence[str], now: Column) -> DataFrame:
    """Health per group at time ``now`` from joined pieces; a group that has been silent for too long is down."""
    total = F.col("processed") + F.col("failed")
    unhealthy = ~F.col("last.ok") & (total > HEALTH_MIN_TOTAL) & (F.col("failed") > F.floor(total / 2))
    since = F.coalesce("last_success", "first_seen")
    idle_ms = (F.unix_micros(now.cast("timestamp")) / 1000).cast("long") - (
        F.unix_micros(since.cast("timestamp")) / 1000
    ).cast("long")
    return joined.select(
        *by,
        F.when(unhealthy | (idle_ms > STALE_AFTER_SECONDS * 1000), "DOWN").otherwise("UP").alias("status"),
        "processed",
        "failed",
        success_rate(F.col("processed"), F.col("failed")).alias("success_rate"),
        idle_ms.alias("idle_ms"),
        F.col("last.error").alias("last_error"),
    )


def records_per_second(
    df: DataFrame,
    ts: str = "ts",
    by: Sequence[str] = (),
    window_seconds: int = RATE_WINDOW_SECONDS,
    slide_seconds: int = RATE_SLIDE_SECONDS,
) -> DataFrame:
    """Records per second over every sliding window that holds a record.

    Rows are first counted per slide; only those counts, not the rows, are copied into the windows that cover them.
    """
    return window_rates(slide_counts(df, ts, by, slide_seconds), by, window_seconds, slide_seconds)


def slide_counts(df: DataFrame, ts: str, by: Sequence[str], slide_seconds: int, *more: Column) -> DataFrame:
    """``start, n`` per slide of time and group, and other aggregates."""
    slides = df.groupBy(*by, F.window(F.col(ts), f"{slide_seconds} seconds").alias("w")).agg(F.count(F.lit(1)).alias("n"), *more)
    return slides.select(*by, F.col("w.start").alias("start"), *[c for c in slides.columns if c not in (*by, "w")])


def window_rates(slides: DataFrame, by: Sequence[str], window_seconds: int, slide_seconds: int, *sums: str) -> DataFrame:
    """Sliding windows from ``slides`` (by, start, n); other columns to add up by name."""
    if window_seconds % slide_seconds:
        raise ValueError("The window must be a whole number of slides")
    steps = window_seconds // slide_seconds
    shifted = F.col("start") - F.make_dt_interval(secs=F.col("step") * F.lit(slide_seconds))
    return (
        slides.select(*by, "start", "n", *sums, F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"))
        .groupBy(*by, shifted.alias("window_start"))
        .agg(F.sum("n").alias("records"), *[F.sum(c).alias(c) for c in sums])
        .withColumn("records_per_second", F.col("records") / F.lit(float(window_seconds)))
    )


def error_sample(
    errors: DataFrame, operation: str, ts: str, tiebreak: str, keep: int = ERRORS_KEPT_PER_MINUTE, unit: str = "minute"
) -> DataFrame:
    """The first ``keep`` errors of each operation and minute (or other ``unit`` of time).

    Up to 1,000 Spark applies the rank limit in every task before the shuffle, so an error storm sends at most ``keep`` rows per
    task, operation and minute.  For more the rows are first ranked in 64 parts of each minute, so that a storm is not
    sorted by one task.
    """
    rows = errors.withColumn(unit, F.date_trunc(unit, F.col(ts)))
    if keep > RANK_LIMIT:
        part = Window.partitionBy(operation, unit, "__part").orderBy(ts, tiebreak)
        rows = rows.withColumn("__part", F.pmod(F.xxhash64(ts, tiebreak), F.lit(64)))
        rows = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= keep).drop("__part", "rank")
    order = Window.partitionBy(operation, unit).orderBy(ts, tiebreak)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def error_counts(
    errors: DataFrame, operation: str, ts: str, keep: int = ERRORS_KEPT_PER_MINUTE, unit: str = "minute"
) -> DataFrame:
    """Errors per operation and minute: how many, how many a sample keeps and how many it leaves out."""
    n, limit = F.col("errors"), F.lit(keep)
    return (
        errors.groupBy(operation, F.date_trunc(unit, F.col(ts)).alias(unit))
        .agg(F.count(F.lit(1)).alias("errors"))
        .select(
            operation,
            unit,
            "errors",
            F.least(n, limit).alias("kept"),
            F.greatest(n - limit, F.lit(0)).alias("suppressed"),
            (n > limit).alias("limit_reached"),
        )
    )


def pattern_quarantine(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    ok: Column,
    threshold: int = QUARANTINE_STREAK,
    stage: str | None = None,
) -> DataFrame:
    """Longest and current run of failures in a row per group; more than ``threshold`` in a row means quarantine.

    ``order`` must be unique within a group.  A run is a property of that order, but no group has to sit in one task for it.  The rows are range-partitioned by
    (group, order), which cuts a large group into even chunks; each chunk is reduced to four numbers; and runs that
    cross chunk borders are joined from those, of which there are at most as many as partitions and groups together.

    Range partitioning reads its input twice, once to find the borders.  ``stage`` names a folder to write the few
    needed columns to first, so that lines are not parsed twice.
    """
    joined = join_streaks(streak_pieces(df, by, order, ok, stage), by, ["piece"])
    return quarantine_report(joined, by, threshold)


def streak_pieces(df: DataFrame, by: Sequence[str], order: Sequence[str], ok: Column, stage: str | None = None) -> DataFrame:
    """Runs of failures per group in pieces of the order: ``piece, successes, head, tail, longest``.

    ``head`` and ``tail`` are the failures before the first and after the last success, both all of them where there is none.
    """
    n_ok = "__n_ok"
    slim = df.select(*by, *order, ok.cast("int").alias("__ok"))
    if stage is not None:
        slim.write.parquet(stage)
        slim = df.sparkSession.read.schema(slim.schema).parquet(stage)
    ranged = slim.repartitionByRange(*by, *order).withColumn("piece", F.spark_partition_id())
    so_far = Window.partitionBy(*by, "piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    runs = (
        ranged.withColumn(n_ok, F.sum("__ok").over(so_far))
        .groupBy(*by, "piece", n_ok)
        .agg(F.count_if(F.col("__ok") == 0).alias("run"))
    )
    return runs.groupBy(*by, "piece").agg(
        F.max(n_ok).alias("successes"),
        F.sum(F.when(F.col(n_ok) == 0, F.col("run")).otherwise(0)).alias("head"),
        F.max_by("run", n_ok).alias("tail"),
        F.max("run").alias("longest"),
    )


def join_streaks(pieces: DataFrame, by: Sequence[str], at: Sequence[str]) -> DataFrame:
    """One piece per group, ``successes, head, tail, longest``, from pieces one behind the other in the order of ``at``.

    Pieces may be joined in any steps: what this returns are pieces again.  A group has a row for each of its pieces here.
    """
    # A run crossing borders: the tail of a piece, heads of pieces without a success, the head of the next with one.
    earlier = Window.partitionBy(*by).orderBy(*at).rowsBetween(Window.unboundedPreceding, -1)
    has_success = F.col("successes") > 0
    island = F.coalesce(F.sum(has_success.cast("int")).over(earlier), F.lit(0))
    ends = F.array(
        F.struct(F.col("island"), F.col("head").alias("length"), F.col("successes")),
        F.struct(
            F.when(has_success, F.col("island") + 1).alias("island"),
            F.col("tail").alias("length"),
            F.lit(0).cast("long").alias("successes"),
        ),
    )
    crossing = (
        pieces.withColumn("island", island)
        .select(*by, "longest", F.inline(ends))
        .where(F.col("island").isNotNull())
        .groupBy(*by, "island")
        .agg(F.sum("length").alias("length"), F.max("longest").alias("longest"), F.sum("successes").alias("successes"))
    )
    return crossing.groupBy(*by).agg(
        F.sum("successes").alias("successes"),
        F.max_by("length", -F.col("island")).alias("head"),
        F.max_by("length", "island").alias("tail"),
        F.greatest(F.max("length"), F.max("longest")).alias("longest"),
    )


def quarantine_report(joined: DataFrame, by: Sequence[str], threshold: int = QUARANTINE_STREAK) -> DataFrame:
    """Longest and current run of failures per group, and whether more than ``threshold`` have come in a row."""
    return joined.select(
        *by,
        F.col("longest").alias("max_streak"),
        F.col("tail").alias("current_streak"),
        (F.col("longest") > threshold).alias("quarantined"),
    )
