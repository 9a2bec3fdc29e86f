"""Stage entry points: ingest -> clean -> features -> serve -> train -> stream.

Each stage reads the previous stage's staged Parquet table and writes its own, so a stage can
be rerun alone and a lost executor only costs the running stage. Paths are arguments.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetsight.operators import clean, features, reports, training
from fleetsight.sinks.publish import publish, publish_all, write_partitioned
from fleetsight.sources.csv import discover_batch_files, read_csv_batches
from fleetsight.sources.tables import footer_extent, load_optional_tables
from fleetsight.spec import DEFAULT_SPEC, TelemetrySpec
from fleetsight.streaming import scoring
from fleetsight.streaming.job import load_model_if_present, start_scoring_stream


@dataclass(frozen=True)
class Layout:
    """Where each staged and published table lives under one root."""

    root: str

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def raw(self) -> str:
        return self._p("raw")

    @property
    def conformed(self) -> str:
        return self._p("conformed")

    @property
    def cleaned(self) -> str:
        return self._p("cleaned")

    @property
    def features(self) -> str:
        return self._p("features")

    @property
    def reports(self) -> str:
        return self._p("reports")

    @property
    def model(self) -> str:
        return self._p("models", "failure_classifier")

    @property
    def model_rows(self) -> str:
        return self._p("model_rows")

    @property
    def metrics(self) -> str:
        return self._p("model_evaluation", "metrics")

    @property
    def importance(self) -> str:
        return self._p("model_evaluation", "feature_importance")

    @property
    def predictions(self) -> str:
        return self._p("predictions")

    @property
    def incoming(self) -> str:
        return self._p("stream", "incoming")

    @property
    def stream_checkpoint(self) -> str:
        return self._p("stream", "checkpoints", "streaming_anomaly_scores")

    @property
    def scores(self) -> str:
        return self._p("stream", "streaming_anomaly_scores")


    @property
    def score_counts(self) -> str:
        return self._p("stream", "streaming_row_counts")


# report name -> key columns, and model table name -> (location, key columns)
REPORT_KEYS = {
    "daily_fleet_health": ["date"],
    "model_failure_summary": ["model"],
    "smart_failure_signal": ["attribute_id", "cohort"],
    "drive_risk_watchlist": ["risk_score", "serial_number"],
}


def ingest(spark: SparkSession, layout: Layout, batches: Sequence[str] = (), spec: TelemetrySpec = DEFAULT_SPEC) -> None:
    """SC1 / SC2 / SC3 / P5 / SK1: raw CSV batches -> conformed table partitioned by year/month."""
    files = discover_batch_files(spark, layout.raw, batches)
    telemetry = read_csv_batches(spark, files, spec.schema())
    if telemetry is None:
        raise FileNotFoundError(f"no CSV files under {layout.raw}")
    write_partitioned(clean.with_date_partitions(telemetry, spec), layout.conformed)


def clean_stage(spark: SparkSession, layout: Layout, spec: TelemetrySpec = DEFAULT_SPEC) -> None:
    """Conformed -> cleaned (statistics are global, so a full rebuild)."""
    conformed = spark.read.parquet(layout.conformed).drop("year", "month")
    cleaned = clean.with_date_partitions(clean.clean_telemetry(conformed, spec), spec)
    write_partitioned(cleaned, layout.cleaned, dynamic=False)


def feature_stage(spark: SparkSession, layout: Layout, spec: TelemetrySpec = DEFAULT_SPEC) -> None:
    """W1-W4 in one pass over all groups; an idempotent overwrite instead of appends."""
    cleaned = spark.read.parquet(layout.cleaned)
    write_partitioned(features.build_features(cleaned, spec), layout.features, dynamic=False)


def report_frames(feats: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> dict[str, DataFrame]:
    return {
        "daily_fleet_health": reports.daily_fleet_health(feats, spec),
        "model_failure_summary": reports.model_failure_summary(feats, spec),
        "smart_failure_signal": reports.metric_failure_signal(feats, spec),
        "drive_risk_watchlist": reports.drive_risk_watchlist(feats, spec),
    }


def serving_stage(spark: SparkSession, layout: Layout, spec: TelemetrySpec = DEFAULT_SPEC) -> dict[str, DataFrame]:
    """SK9: the four report tables. Each scans only the feature columns it needs (columnar
    Parquet), which beats caching all 54 columns of the feature table."""
    feats = spark.read.parquet(layout.features)
    frames = report_frames(feats, spec)
    return publish_all({name: (df, REPORT_KEYS[name]) for name, df in frames.items()}, layout.reports)


def training_stage(spark: SparkSession, layout: Layout, spec: TelemetrySpec = DEFAULT_SPEC, **kw) -> str:
    """M2-M10, SK3, SK4: fit, choose, evaluate; save the model and the three model tables."""
    kw.setdefault("staging_path", layout.model_rows)
    if "last_date" not in kw:
        kw["last_date"] = F.lit(footer_extent(spark, layout.features, spec.date).first()["last"])
    result = training.train_and_evaluate(spark.read.parquet(layout.features), spec, **kw)
    result.model.write().overwrite().save(layout.model)
    publish(result.metrics, layout.metrics, ["model_name", "split", "metric"])
    publish(result.importance, layout.importance, ["feature"])
    publish(result.predictions, layout.predictions, [spec.group, spec.entity, spec.date])
    result.release()
    return result.best_name


def model_tables(spark: SparkSession, layout: Layout) -> tuple[dict[str, DataFrame], list[str]]:
    """SC6: the model tables that exist so far, and the names of those still missing."""
    return load_optional_tables(
        spark,
        {
            "drive_failure_predictions": layout.predictions,
            "model_evaluation_metrics": layout.metrics,
            "model_feature_importance": layout.importance,
        },
    )


def stream_stage(spark: SparkSession, layout: Layout, spec: TelemetrySpec = DEFAULT_SPEC, once: bool = True, **kw):
    """SC7-SC8, ST1-ST6: statistics and context from the staged tables, then the file stream.

    Statistics are one row per group (checked before broadcast). The context is one row per
    entity: it is hash-partitioned by entity once and kept, so each micro-batch only shuffles
    its own readings to meet it.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def sides():
        statistics = scoring.model_statistics(spark.read.parquet(layout.cleaned), spec)
        context = scoring.entity_context(spark.read.parquet(layout.features), spec)
        return statistics, context.repartition(parts, spec.entity).persist()

    statistics, context = sides()
    model = load_model_if_present(layout.model)
    if not once:
        kw.setdefault("reload_sides", sides)  # after each micro-batch; the old context is let go
    kw.setdefault("counts_path", layout.score_counts)
    query = start_scoring_stream(
        spark, layout.incoming, layout.stream_checkpoint, layout.scores, statistics, context, model, spec, once=once, **kw
    )
    if once:
        query.awaitTermination()
        context.unpersist()
    return query


def write_raw_batches(df: DataFrame, layout: Layout, batch: str, columns: Sequence[str] | None = None) -> None:
    """Write readings as one raw CSV batch folder (strings, header on), e.g. for tests and benches."""
    cols = list(columns or df.columns)
    df.select(*[F.col(c).cast("string").alias(c) for c in cols]).write.mode("overwrite").option("header", True).csv(
        f"{layout.raw}/{batch}"
    )
