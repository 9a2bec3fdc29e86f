"""Benchmark at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Two parts, both timed per item:
  * the staged pipeline, the same stages the published baseline reports: ingest (CSV batches
    with drifting headers -> partitioned Parquet), clean, features, serving tables, training,
    stream scoring of the last 7 days of readings (drain and exit);
  * the registered queries, each from the raw input tables, executed in full into the no-op sink.
Set BENCH_PARTS=pipeline or BENCH_PARTS=queries to run one part only, and BENCH_QUERIES=all to time every
registered query instead of the headline ones.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from fleetsight.plans import fixtures, pipeline, registry  # noqa: E402
from fleetsight.session import build_session  # noqa: E402

QUERIES = [
    "model_failure_summary",
    "clean_drive_days",
    "model_zscores",
    "metric_trends",
    "failure_labels",
    "daily_fleet_health",
    "weekly_fleet_health",
    "metric_failure_signal",
    "signal_gap",
    "drive_risk_watchlist",
    "riskiest_drives",
    "model_rows_whole_window",
    "downsampled_rows",
    "threshold_sweep",
    "score_batch_rules",
    "recent_scores",
    "batch_summary",
    "sanity_checks",
]
STREAM_DAYS = 7


def timed(out: dict, name: str, fn) -> None:
    start = time.perf_counter()
    fn()
    out[name] = round(time.perf_counter() - start, 3)


def run_pipeline(spark, sf_dir: str, timings: dict) -> None:
    scratch = tempfile.mkdtemp(prefix="fleetsight-bench-", dir=os.environ.get("BENCH_SCRATCH", "/tmp"))
    layout = pipeline.Layout(scratch)
    raw = fixtures.telemetry_c1(spark, sf_dir)
    cut = F.date_sub(raw.select(F.max("date")).scalar(), STREAM_DAYS)
    history, arriving = raw.filter(F.col("date") <= cut), raw.filter(F.col("date") > cut)
    cols = raw.columns
    # untimed setup: two raw batches whose headers differ (one column order reversed)
    early = F.year("date") < 1996
    pipeline.write_raw_batches(history.filter(early), layout, "batch_a", cols)
    pipeline.write_raw_batches(history.filter(~early), layout, "batch_b", list(reversed(cols)))
    arriving.select(*[F.col(c).cast("string") for c in cols]).write.option("header", True).csv(layout.incoming)

    timed(timings, "stage_ingest", lambda: pipeline.ingest(spark, layout))
    timed(timings, "stage_clean", lambda: pipeline.clean_stage(spark, layout))
    timed(timings, "stage_features", lambda: pipeline.feature_stage(spark, layout))
    timed(timings, "stage_serving", lambda: pipeline.serving_stage(spark, layout))
    timed(timings, "stage_training", lambda: pipeline.training_stage(spark, layout))
    timed(timings, "stage_stream", lambda: pipeline.stream_stage(spark, layout, once=True))


def run_queries(spark, sf_dir: str, timings: dict, names) -> None:
    queries = registry.queries()
    for name in names:
        timed(timings, name, lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save())


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = os.environ.get("BENCH_PARTS", "pipeline,queries").split(",")
    every = os.environ.get("BENCH_QUERIES") == "all"
    names = sys.argv[1:] or (sorted(registry.queries()) if every else QUERIES)
    spark = build_session(
        "fleetsight-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(int(cpus) * 2)),
            "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # JVM warm-up on the smallest tables (code paths only; nothing is cached)
    registry.queries()["model_failure_summary"](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    if "pipeline" in parts:
        run_pipeline(spark, sf_dir, timings)
    if "queries" in parts:
        run_queries(spark, sf_dir, timings, names)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "pipeline_and_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
