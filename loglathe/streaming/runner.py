"""The same flow as a stream: new files are parsed in bounded batches and stored once each."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglathe.operators.quality import RATE_SLIDE_SECONDS, RATE_WINDOW_SECONDS, counter_columns, window_rates
from loglathe.plans.flow import Flow
from loglathe.sources.files import stream_lines

COUNTERS = "parse_counters"


def trigger_options(every_minutes: float | None) -> dict[str, Any]:
    """Poll every so many minutes, or (``None``) take what is there and stop."""
    if every_minutes is None:
        return {"availableNow": True}
    if every_minutes <= 0:
        raise ValueError("The polling interval must be positive")
    return {"processingTime": f"{round(every_minutes * 60)} seconds"}


def run_stream(
    spark: SparkSession,
    source: str | DataFrame,
    flow: Flow,
    root: str,
    checkpoint: str,
    *,
    reject_path: str | None = None,
    every_minutes: float | None = 1,
    **source_options: Any,
) -> StreamingQuery:
    """Watch ``source`` and store each batch in one pass.

    The store keeps the batches of each stream apart by the stream's id, which lies in its checkpoint, and replaces a batch by
    its number: a batch that is replayed after a failure leaves the same rows, and a stream with a new checkpoint adds to
    what is there.  Counters of each batch are in the query's progress under ``parse_counters``.
    """
    flow.check(spark)
    lines = stream_lines(spark, source, **source_options) if isinstance(source, str) else source
    outcomes = flow.outcomes(lines, COUNTERS)

    def store(batch_rows: DataFrame, batch: int) -> None:
        flow.store(batch_rows, root, stream_run(spark, checkpoint), batch, reject_path)

    return (
        outcomes.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger_options(every_minutes))
        .start()
    )


def stream_run(spark: SparkSession, checkpoint: str) -> str:
    """The run name of a stream: the id that Spark has written to its checkpoint."""
    text = spark.read.option("wholetext", "true").text(f"{checkpoint}/metadata").head()[0]
    return "stream-" + json.loads(text)["id"]


def stream_counters(parsed: DataFrame, by: list[str]) -> DataFrame:
    """Running counters per group; for update or complete output."""
    return parsed.groupBy(*by).agg(*counter_columns(F.col("status")))


def stream_rates(
    rows: DataFrame,
    ts: str = "ts",
    watermark: str = "2 minutes",
    window_seconds: int = RATE_WINDOW_SECONDS,
    slide_seconds: int = RATE_SLIDE_SECONDS,
    by: Sequence[str] = (),
) -> DataFrame:
    """Records per second over sliding windows of event time, for append output.

    Rows are counted per slide first, and these counts make the windows, so a row is never copied.  ``watermark`` says how late
    a row may be: later ones are left out, and a window appears once the watermark has passed it.  The windows that are
    still open when a stream stops are in its state, and ``open_rates`` reads them; ``ledger.rate_ledger`` counts late rows too.
    """
    if window_seconds % slide_seconds:
        raise ValueError("The window must be a whole number of slides")
    slide = F.window(ts, f"{slide_seconds} seconds")
    counts = rows.withWatermark(ts, watermark).groupBy(slide.alias("s"), *by).agg(F.count(F.lit(1)).alias("n"))
    window = F.window(F.window_time("s"), f"{window_seconds} seconds", f"{slide_seconds} seconds")
    return (
        counts.groupBy(window.alias("w"), *by)
        .agg(F.sum("n").alias("records"))
        .select(
            F.col("w.start").alias("window_start"),
            *by,
            "records",
            (F.col("records") / F.lit(float(window_seconds))).alias("records_per_second"),
        )
    )


def open_rates(
    spark: SparkSession,
    checkpoint: str,
    window_seconds: int = RATE_WINDOW_SECONDS,
    slide_seconds: int = RATE_SLIDE_SECONDS,
    by: Sequence[str] = (),
) -> DataFrame:
    """The windows that a stopped ``stream_rates`` stream has not emitted, as far as they are counted, from its state.

    With the emitted ones they are all windows, each once.  They are not written anywhere: a stream that goes on emits them when they are
    closed.  Slides that are still open are the state of the first count, windows that are open that of the second.
    """

    # an operator's key holds the group columns in their order, its value the count of the first or the sum of the second
    found = {}
    for operator in (0, 1):
        rows = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
        keys, value = rows.schema["key"].dataType.names, rows.schema["value"].dataType.names[0]
        window, *groups = (F.col(f"key.`{k}`") for k in keys)
        named = [g.alias(b) for g, b in zip(groups, by, strict=True)]
        found[value] = rows.select(window["start"].alias("start"), *named, F.col(f"value.`{value}`").alias("n"))
    slides = window_rates(found["count"], by, window_seconds, slide_seconds).select("window_start", *by, "records")
    windows = found["sum"].select(F.col("start").alias("window_start"), *by, F.col("n").alias("records"))
    whole = slides.unionByName(windows).groupBy("window_start", *by).agg(F.sum("records").alias("records"))
    return whole.withColumn("records_per_second", F.col("records") / F.lit(float(window_seconds)))
