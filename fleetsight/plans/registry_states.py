"""Registered queries of the mergeable states (A1, A2-A3, A4, A9) and of the keyed streams (ST1-ST3, W2, W6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetsight.operators import clean, features, incremental, reports
from fleetsight.plans import fixtures
from fleetsight.plans import oracle as O
from fleetsight.plans import registry as R
from fleetsight.sinks.publish import publish, publish_all
from fleetsight.sources.tables import footer_extent
from fleetsight.streaming import keyed, scoring

SPEC = R.SPEC
N_BATCHES = 3


def _batch_of():
    """Rows are dealt to batches by a hash of their key, so every group and month has some of each."""
    return F.pmod(F.xxhash64(*SPEC.key), F.lit(N_BATCHES))


# ---- A1 / J2 --------------------------------------------------------------------------------------
@R.register("incremental_statistics", R.oracle_sql()["model_statistics"])
def incremental_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: statistics from stored moments of three batches, the last batch written twice."""
    cleaned = R.cleaned_c1(spark, sf_dir, zscores=False)
    path = R.shared_folder(spark, "moments")
    for batch in (2, 0, 1, 1):
        incremental.write_state(incremental.moment_table(cleaned.filter(_batch_of() == batch), SPEC), path, batch)
    return incremental.statistics_from_moments(incremental.read_state(spark, path), SPEC)


# ---- A4 -------------------------------------------------------------------------------------------
_MEANS = ["reported_share", "mean_zscore", "mean_trend_30d"]


@R.register(
    "signal_from_states",
    O.rounded(
        R._C1_FEATURES
        + R._LONG_SQL
        + R._SIGNAL_SQL
        + "\nSELECT attribute_id, attribute_name, cohort, row_count, reported_share, mean_zscore, mean_trend_30d, "
        + "CASE WHEN median_zscore IS NULL THEN NULL ELSE true END AS median_in_bound, "
        + "CASE WHEN p95_zscore IS NULL THEN NULL ELSE true END AS p95_in_bound FROM signal",
        _MEANS,
    ),
)
def signal_from_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: the metric signal from monthly sketches; its percentiles are held against exact ones at the ranks of the stated error."""
    path = R.shared_folder(spark, "sketched-features")
    used = [c for m in SPEC.metrics for c in (m.zscore, m.reported, m.trend(SPEC.trend_rows[-1]))]
    R.features_c1(spark, sf_dir).select(*SPEC.key, SPEC.label, *used).write.parquet(path)
    feats = spark.read.parquet(path)
    states = R.shared_folder(spark, "sketches")
    for batch in range(N_BATCHES):
        incremental.write_state(incremental.signal_sketches(feats.filter(_batch_of() == batch), SPEC), states, batch)
    found = incremental.signal_from_sketches(incremental.read_state(spark, states), SPEC)
    keys = ["attribute_id", "attribute_name", "cohort"]
    off = incremental.sketch_rank_error()
    ranks = {"m0": 0.5 - off, "m1": 0.5 + off, "p0": 0.95 - off, "p1": min(1.0, 0.95 + off)}
    exact = reports.exact_percentiles(reports.metric_unpivot(feats, SPEC), keys, "zscore", ranks)
    both = found.join(exact, keys, "left")
    return both.select(
        *keys,
        "row_count",
        *_MEANS,
        F.col("median_zscore").between(F.col("m0"), F.col("m1")).alias("median_in_bound"),
        F.col("p95_zscore").between(F.col("p0"), F.col("p1")).alias("p95_in_bound"),
    )


# ---- A2 / A3 / A9 -----------------------------------------------------------------------------------
@R.register(
    "weekly_distinct_drives",
    R._C1_CLEAN_NOZ
    + "\nSELECT date - CAST(dayofweek(date) AS INTEGER) AS week, count(DISTINCT serial_number) AS drive_count, "
    + "true AS sketch_in_bound FROM cleaned GROUP BY 1",
)
def weekly_distinct_drives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 with A2: distinct drives of a week from daily bitmaps of two batches, and daily sketches held against them."""
    path = R.shared_folder(spark, "daily-states")
    # cleaned once, not for each of the batches' states
    R.cleaned_c1(spark, sf_dir, zscores=False).select(*SPEC.key).write.parquet(f"{path}/cleaned")
    cleaned = spark.read.parquet(f"{path}/cleaned")
    numbers = None
    for batch in (0, 1):
        part = cleaned.filter(F.pmod(F.xxhash64(SPEC.entity), F.lit(2)) == batch)
        held = f"{path}/numbers-{batch}"
        incremental.entity_numbers(part, SPEC.entity, numbers).write.parquet(held)
        numbers = spark.read.parquet(held)
        incremental.write_state(incremental.distinct_bitmaps(part, [SPEC.date], SPEC.entity, numbers), f"{path}/bitmaps", batch)
        incremental.write_state(incremental.distinct_sketches(part, [SPEC.date], SPEC.entity), f"{path}/sketches", batch)
    week = [incremental.weekly(SPEC)]
    exact = incremental.distinct_from_bitmaps(incremental.read_state(spark, f"{path}/bitmaps"), week)
    near = incremental.distinct_from_sketches(incremental.read_state(spark, f"{path}/sketches"), week, "estimate")
    bound = 5 * incremental.distinct_error() * F.col("drive_count") + 1
    return exact.join(near, "week").select("week", "drive_count", (F.abs(F.col("estimate") - F.col("drive_count")) <= bound).alias("sketch_in_bound"))


# ---- ST2 / W6 / W2 ------------------------------------------------------------------------------------
TREND_DAYS = 21
_WIDE = R._q([f"{m.raw}" for m in SPEC.metrics])


def _arrivals(spark: SparkSession, sf_dir: str, days: int) -> tuple[DataFrame, DataFrame, int, Column]:
    """Cleaned readings before the last days, those of the last days, the number of both, and the day between.

    As in a deployment, the stream's sides and its deliveries come from a cleaned table that is there."""
    cleaned, rows, last = R.staged_c1(spark, sf_dir)
    cut = F.date_sub(last, days)
    return cleaned.filter(F.col(SPEC.date) <= cut), cleaned.filter(F.col(SPEC.date) > cut), rows, cut


def _deliver(rows: DataFrame, path: str) -> None:
    """One file; only its rows meet in the task that writes it, the table is read by all tasks."""
    rows.repartition(1).write.parquet(path)


@R.register(
    "stream_trends",
    O.rounded(
        R._C1_CLEAN_NOZ
        + ","
        + O.feature_ctes(SPEC, "cleaned")
        + f"""
SELECT serial_number, model, date, age_days, {R._q(SPEC.trend_columns)}
FROM features WHERE date > (SELECT max(date) - {TREND_DAYS} FROM cleaned)""",
        SPEC.trend_columns,
    ),
)
def stream_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2, W6, W2: trends of the arriving readings from keyed state. The readings of the last days come in three
    files of mixed dates, the middle one twice, on top of a state that starts from the history."""
    history, arriving, _, cut = _arrivals(spark, sf_dir, TREND_DAYS)
    root = R.shared_folder(spark, "keyed-stream")
    for n, part in enumerate((2, 0, 0, 1)):
        _deliver(arriving.filter(_batch_of() == part), f"{root}/conformed/{n}")
    started = R.shared_folder(spark, "keyed-history")
    keyed.entity_history(history, SPEC).write.parquet(started)
    start = spark.read.parquet(started)
    query = keyed.start_trend_scoring(
        spark, f"{root}/conformed", f"{root}/checkpoint", f"{root}/scores", scoring.model_statistics(start, SPEC), start, None, SPEC,
        max_files_per_trigger=1,
    )
    query.awaitTermination()
    rows = keyed.current_rows(spark.read.parquet(f"{root}/scores"), SPEC)
    return rows.filter(F.col(SPEC.date) > cut).select("serial_number", "model", "date", "age_days", *SPEC.trend_columns)


# ---- ST1 / ST3 ------------------------------------------------------------------------------------------
_ONCE_SQL = (
    O.with_ctes(O.C1_TELEMETRY)
    + ","
    + O.clean_ctes(SPEC, zscores=False).replace("cleaned AS", "all_cleaned AS")
    + f""",
cutoff AS (SELECT max(date) - {R.STREAM_DAYS} AS c FROM all_cleaned),
cleaned AS (SELECT a.* FROM all_cleaned a, cutoff WHERE a.date <= c),
batch_raw AS (SELECT a.* FROM all_cleaned a, cutoff WHERE a.date > c)"""
    + R._SCORES_SQL
)


@R.register("stream_scores_redelivered", O.rounded(_ONCE_SQL, R._SCORE_DOUBLES))
def stream_scores_redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1, ST3: readings delivered twice, in one micro-batch and again in a later one, give one score row a key."""
    history, arriving, n_rows, _ = _arrivals(spark, sf_dir, R.STREAM_DAYS)
    statistics = scoring.model_statistics(history, SPEC)
    root = R.shared_folder(spark, "distinct-stream")
    # built once, not by each micro-batch
    scoring.entity_context(features.build_features(history, SPEC, n_rows), SPEC, dealt=True).write.parquet(f"{root}/context")
    context = spark.read.parquet(f"{root}/context")
    first = _batch_of() == 0
    once = arriving.filter(first)
    for n, rows in enumerate((once.unionAll(once), arriving.filter(~first), arriving)):
        _deliver(rows, f"{root}/conformed/{n}")
    query = keyed.start_distinct_scoring(
        spark, f"{root}/conformed", f"{root}/checkpoint", f"{root}/scores", statistics, context, None, SPEC, max_files_per_trigger=1
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/scores").drop("batch_id")


# ---- A8 -----------------------------------------------------------------------------------------------
@R.register(
    "staged_extent",
    R._C1_CLEAN_NOZ + "\nSELECT count(*) AS total_rows, min(date) AS first, max(date) AS last FROM cleaned",
)
def staged_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, first and last day of a staged table from its files' footers."""
    path = R.shared_folder(spark, "staged")
    R.cleaned_c1(spark, sf_dir, zscores=False).write.parquet(path)
    return footer_extent(spark, path, SPEC.date)


# ---- T1, T5, T7: reports in the order in which they are shown ---------------------------------------------
def _placed(df: DataFrame) -> DataFrame:
    """Rows with their position as they come."""
    return df.coalesce(1).select(F.monotonically_increasing_id().alias("position"), "*")


@R.register(
    "daily_report_in_order",
    O.rounded(
        R._C1_FEATURES
        + R._DAILY_SQL
        + """
SELECT row_number() OVER (ORDER BY date) - 1 AS position, date, drive_count, failure_count, at_risk_count,
       failure_rate_pct, at_risk_rate_pct, mean_age_days, mean_temperature_celsius FROM daily""",
        R._DAILY_DOUBLES,
    ),
)
def daily_report_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily report by date."""
    daily = reports.daily_fleet_health(R.features_c1(spark, sf_dir, zscores=False), SPEC)
    return _placed(reports.ordered(daily, "daily_fleet_health", SPEC))


@R.register(
    "signal_gap_in_order",
    "SELECT row_number() OVER (ORDER BY gap DESC NULLS LAST, attribute_id) - 1 AS position, * FROM (\n" + R.oracle_sql()["signal_gap"] + "\n) AS shown",
)
def signal_gap_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics by how far their cohorts are apart."""
    return _placed(reports.ordered(R.queries()["signal_gap"](spark, sf_dir), "signal_gap", SPEC))


@R.register(
    "top_features",
    """
WITH importance AS (
  SELECT concat('p', CAST(l_partkey % 60 AS VARCHAR)) AS feature, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / count(*) AS importance
  FROM lineitem GROUP BY 1
)
SELECT row_number() OVER (ORDER BY importance DESC, feature) - 1 AS position, feature, round(importance, 4) AS importance
FROM importance QUALIFY position < 15""",
)
def top_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the 15 features of the greatest importance, of 60."""
    returned = F.count_if(F.col("l_returnflag") == "R").cast("double") / F.count(F.lit(1))
    feature = F.concat(F.lit("p"), (F.col("l_partkey") % 60).cast("string")).alias("feature")
    importance = fixtures.table(spark, sf_dir, "lineitem").groupBy(feature).agg(returned.alias("importance"))
    return _placed(reports.top_features(importance))


# ---- SK3, SK6-SK9 -----------------------------------------------------------------------------------------
@R.register(
    "published_tables",
    R._C1_FEATURES
    + R._DAILY_SQL
    + R._SUMMARY_SQL
    + """
SELECT 'daily_fleet_health' AS table_name, count(*) AS total_rows, CAST(sum(failure_count) AS BIGINT) AS failures FROM daily
UNION ALL SELECT 'model_failure_summary', count(*), CAST(sum(failure_count) AS BIGINT) FROM summary
UNION ALL SELECT 'appended', count(*), CAST(sum(failure_count) AS BIGINT) FROM daily""",
)
def published_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SK3, SK6-SK9: two reports published by key, published again in their place, and one appended in two parts."""
    root = R.shared_folder(spark, "published")
    # each publication reads the features that the reports use; they are built once
    used = [*SPEC.key, SPEC.group, SPEC.event, SPEC.capacity, SPEC.label, "age_days", SPEC.temperature.raw]
    R.features_c1(spark, sf_dir, zscores=False).select(*used).write.parquet(f"{root}-features")
    feats = spark.read.parquet(f"{root}-features")
    daily, summary = reports.daily_fleet_health(feats, SPEC), reports.model_failure_summary(feats, SPEC)
    tables = {"daily_fleet_health": (daily, [SPEC.date]), "model_failure_summary": (summary, [SPEC.group])}
    publish_all(tables, root)
    found = publish_all(tables, root)
    even = F.dayofmonth(SPEC.date) % 2 == 0
    for part in (found["daily_fleet_health"].filter(even), found["daily_fleet_health"].filter(~even)):
        found["appended"] = publish(part, f"{root}/appended", [SPEC.date], mode="append")
    figures = [F.count(F.lit(1)).alias("total_rows"), F.sum("failure_count").alias("failures")]
    rows = [df.agg(*figures).select(F.lit(name).alias("table_name"), "total_rows", "failures") for name, df in found.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
