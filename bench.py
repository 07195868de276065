"""Headline queries, timed. Prints one JSON line.

``queries``     seconds per query over ``$BENCH_SF_DIR`` (best of ``$BENCH_RUNS`` runs), written to a sink that takes every
                row and keeps none
``throughput``  lines per second and core for text files of each format, made from the same events repeated
                ``$BENCH_REPEAT`` times; scan and parse only, and scan, parse and store
``latency``     seconds from start to end of a stream's batches, which is apart from throughput
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from loglathe.operators.parse import flatten, parse_lines
from loglathe.operators.shape import GENERIC_COLUMNS
from loglathe.plans.flow import Flow, run_batch
from loglathe.registry import QUERIES
from loglathe.session import local_session
from loglathe.sources.event_lines import event_lines, read_events
from loglathe.sources.files import scan_lines
from loglathe.streaming.runner import run_stream

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "10"))

HEADLINE = (
    "parse_counters", "grok_application", "grok_loglevel", "grok_access", "grok_syslog", "grok_nginx_error",
    "grok_custom_app", "parse_json_lines", "parse_multi_format", "shape_rows", "mask_pii_json", "json_drop_empty",
    "reject_envelope", "success_rate", "health_status", "records_per_second", "error_sample", "error_counts",
    "pattern_quarantine", "infer_schema", "store_good", "stream_good",
)
# published figures of one node with four cores, in lines per second
PUBLISHED = {"access": 50_000, "application": 45_000, "syslog": 30_000}


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def best(run, times: int = RUNS) -> float:
    seconds = []
    for _ in range(times):
        started = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - started)
    return min(seconds)


def throughput(spark, base: str) -> dict[str, dict]:
    events = read_events(spark, SF_DIR)
    many = events.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(REPEAT)))).repartition(CPUS)
    out = {}
    for fmt in PUBLISHED:
        folder = f"{base}/{fmt}"
        event_lines(many, fmt).select("value").write.text(folder)
        lines = scan_lines(spark, folder)
        n, size = lines.agg(F.count("value"), F.sum(F.octet_length("value"))).head()
        columns = GENERIC_COLUMNS if fmt == "application" else None
        flow = Flow(fmt, fmt, columns=columns, event_date_from="timestamp", year=2024)
        parse = best(lambda: drain(flatten(parse_lines(lines, fmt))))
        store = best(lambda: run_batch(spark, folder, flow, f"{base}/out-{fmt}", reject_path=f"{base}/bad-{fmt}"))
        out[fmt] = {
            "lines": n,
            "mean_line_bytes": round(size / n, 1),
            "cores": CPUS,
            "parse_lines_per_sec": round(n / parse),
            "parse_lines_per_sec_core": round(n / parse / CPUS),
            "store_lines_per_sec": round(n / store),
            "published_lines_per_sec": PUBLISHED[fmt],
            "published_lines_per_sec_core": round(PUBLISHED[fmt] / 4),
        }
    return out


def latency(spark, base: str) -> dict[str, float]:
    """Micro-batch durations of a stream over the application files, one file per batch."""
    flow = Flow("application", "application", columns=GENERIC_COLUMNS, event_date_from="timestamp")
    query = run_stream(
        spark, f"{base}/application", flow, f"{base}/stream", f"{base}/state", every_minutes=None, max_files_per_batch=1
    )
    query.awaitTermination()
    batches = sorted(p.durationMs["triggerExecution"] / 1000 for p in query.recentProgress if p.numInputRows)
    return {"batches": len(batches), "median_sec": batches[len(batches) // 2], "max_sec": batches[-1]}


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=CPUS)
    base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    seconds = {name: round(best(lambda: drain(QUERIES[name](spark, SF_DIR))), 3) for name in HEADLINE}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "throughput": throughput(spark, base),
        "latency": latency(spark, base),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
