"""Query registry: every implemented operator as (Spark query, DuckDB oracle SQL).

Each Spark query reads the whole driver tables under ``sf_dir`` and returns a DataFrame whose
floating columns are rounded to 6 digits (engine-independent comparison); the oracle does the
same rounding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from fleetsight.functions.columns import round_doubles
from fleetsight.operators import checks, clean, evaluation, features, reports, training
from fleetsight.plans import fixtures
from fleetsight.plans import oracle as O
from fleetsight.sources.tables import footer_extent, table_rows
from fleetsight.spec import DEFAULT_SPEC
from fleetsight.streaming import scoring

SPEC = DEFAULT_SPEC
QueryFn = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, QueryFn] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return run

    return wrap


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


# ---- shared Spark prefixes ----------------------------------------------------------------------
def cleaned_c1(spark: SparkSession, sf_dir: str, zscores: bool = True) -> DataFrame:
    return clean.clean_telemetry(fixtures.telemetry_c1(spark, sf_dir), SPEC, zscores=zscores)


def features_c1(spark: SparkSession, sf_dir: str, zscores: bool = True) -> DataFrame:
    """The features of all cleaned rows; there are at most as many as rows of lineitem (from its footers)."""
    rows = table_rows(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet")
    return features.build_features(cleaned_c1(spark, sf_dir, zscores), SPEC, rows)


def last_date_c1(spark: SparkSession, sf_dir: str):
    """The last day of the cleaned rows, as a lazy scalar over the rows before any window or join."""
    from pyspark.sql import functions as F

    raw = fixtures.telemetry_c1(spark, sf_dir)
    valid = raw.transform(clean.normalize_group_names, SPEC).transform(clean.drop_invalid_rows, SPEC)
    return valid.select(F.max(SPEC.date)).scalar()


def staged_c1(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int, Column]:
    """The cleaned rows without z-scores as a staged table, their number and last day (from the files' footers)."""
    from pyspark.sql import functions as F

    path = shared_folder(spark, "cleaned")
    cleaned_c1(spark, sf_dir, zscores=False).write.parquet(path)
    extent = footer_extent(spark, path, SPEC.date).first()
    return spark.read.parquet(path), extent["total_rows"], F.lit(extent["last"]).cast("date")


def model_rows_c1(spark: SparkSession, sf_dir: str, censor: str = "whole_window") -> DataFrame:
    return training.prepare_model_rows(
        features_c1(spark, sf_dir), SPEC, censor=censor, last_date=last_date_c1(spark, sf_dir)
    )


def shared_folder(spark: SparkSession, name: str) -> str:
    import uuid

    from fleetsight.session import checkpoint_dir

    return f"{checkpoint_dir(spark, allow_local_default=True).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---- flagship: A3 -------------------------------------------------------------------------------
_SUMMARY_DOUBLES = ["mean_capacity_tb", "mean_age_at_failure_days", "mean_temperature_celsius", "annualized_failure_rate_pct"]


@register(
    "model_failure_summary",
    O.rounded(
        O.with_ctes(O.C1_TELEMETRY, O.clean_ctes(SPEC, zscores=False))
        + """,
aged AS (SELECT *, CAST(date_diff('day', min(date) OVER (PARTITION BY model, serial_number), date) AS INTEGER) AS age_days FROM cleaned)
SELECT model,
       count(DISTINCT serial_number) AS drive_count,
       count(*) AS drive_days,
       CAST(sum(failure) AS BIGINT) AS failure_count,
       avg(capacity_bytes) / 1e12 AS mean_capacity_tb,
       avg(CASE WHEN failure = 1 THEN age_days END) AS mean_age_at_failure_days,
       avg(smart_194_raw) AS mean_temperature_celsius,
       CAST(sum(failure) AS BIGINT) / (count(*) / 365.0) * 100 AS annualized_failure_rate_pct
FROM aged GROUP BY model""",
        _SUMMARY_DOUBLES,
    ),
)
def model_failure_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annualised failure rate per model from raw telemetry."""
    cleaned = cleaned_c1(spark, sf_dir, zscores=False)
    return reports.model_failure_summary(features.add_entity_age(cleaned, SPEC), SPEC)


# ---- SQL building blocks ------------------------------------------------------------------------
_C1_CLEAN = O.with_ctes(O.C1_TELEMETRY, O.clean_ctes(SPEC, zscores=True))
_C1_CLEAN_NOZ = O.with_ctes(O.C1_TELEMETRY, O.clean_ctes(SPEC, zscores=False))
_C1_FEATURES = _C1_CLEAN + "," + O.feature_ctes(SPEC, "cleaned")
_Z = [m.zscore for m in SPEC.metrics]
_TRENDS = SPEC.trend_columns
_COUNTERS = SPEC.error_counters
_KEY = "serial_number, model, date"


def _q(cols) -> str:
    return ", ".join(cols)


# ---- SC3 / U1 -----------------------------------------------------------------------------------
def _drifted_pair(spark: SparkSession, sf_dir: str):
    t = fixtures.telemetry_c1(spark, sf_dir)
    from pyspark.sql import functions as F

    # batch A: one column missing, one extra, a non-numeric marker; batch B: columns reversed
    a_cols = []
    for c in t.columns:
        if c == "smart_9_raw":
            continue
        if c == "smart_188_raw":
            a_cols.append(F.when(F.col(c) == 0, F.lit("n/a")).otherwise(F.col(c).cast("string")).alias(c))
        else:
            a_cols.append(F.col(c).cast("string").alias(c))
    a = t.select(*a_cols, F.lit("dc-1").alias("datacenter"))
    b = t.select(*[F.col(c).cast("string").alias(c) for c in reversed(t.columns)])
    return a, b


@register(
    "conform_schema",
    O.with_ctes(O.C1_TELEMETRY)
    + """
SELECT * REPLACE (CAST(NULL AS BIGINT) AS smart_9_raw,
                  CASE WHEN smart_188_raw = 0 THEN NULL ELSE smart_188_raw END AS smart_188_raw)
FROM telemetry
UNION ALL
SELECT * FROM telemetry""",
)
def conform_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC3 + U1: two drifted string batches conformed to the target schema and unioned."""
    from fleetsight.sources.conform import conform_to_schema, union_all

    a, b = _drifted_pair(spark, sf_dir)
    return union_all([conform_to_schema(a, SPEC.schema()), conform_to_schema(b, SPEC.schema())])


# ---- P1-P5 / A16 --------------------------------------------------------------------------------
@register(
    "clean_drive_days",
    _C1_CLEAN_NOZ + "\nSELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM cleaned",
)
def clean_drive_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised names, valid rows, one row per drive-day, year / month."""
    return clean.with_date_partitions(cleaned_c1(spark, sf_dir, zscores=False), SPEC)


# ---- A1 / P6 / P7 / J1 --------------------------------------------------------------------------
@register(
    "model_statistics",
    O.rounded(
        _C1_CLEAN_NOZ
        + "\nSELECT model, "
        + _q([f"avg({c}) AS {c}_model_mean" for c in SPEC.raw_columns])
        + ", "
        + _q([f"stddev_samp({c}) AS {c}_model_stddev" for c in SPEC.raw_columns])
        + " FROM cleaned GROUP BY model",
        [f"{c}_model_mean" for c in SPEC.raw_columns] + [f"{c}_model_stddev" for c in SPEC.raw_columns],
    ),
)
def model_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: per-model mean and sample standard deviation of the 7 readings."""
    return clean.group_statistics(cleaned_c1(spark, sf_dir, zscores=False), SPEC)


@register("model_zscores", O.rounded(_C1_CLEAN + "\nSELECT * FROM cleaned", _Z))
def model_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z-scores within model (checked broadcast of the statistics) and reported flags."""
    return cleaned_c1(spark, sf_dir, zscores=True)


# ---- W1-W4 / W7 ---------------------------------------------------------------------------------
@register(
    "drive_age",
    _C1_CLEAN_NOZ
    + """
SELECT serial_number, model, date, first_seen, CAST(date_diff('day', first_seen, date) AS INTEGER) AS age_days
FROM (SELECT *, min(date) OVER (PARTITION BY model, serial_number) AS first_seen FROM cleaned)""",
)
def drive_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First-seen date and age in days."""
    out = features.add_entity_age(cleaned_c1(spark, sf_dir, zscores=False), SPEC)
    return out.select("serial_number", "model", "date", "first_seen", "age_days")


def _trend_sql(frame: str) -> str:
    part = "PARTITION BY model, serial_number ORDER BY date"
    cols = []
    for m in SPEC.metrics:
        for n in SPEC.trend_rows:
            bound = f"ROWS BETWEEN {n} PRECEDING" if frame == "rows" else f"RANGE BETWEEN INTERVAL {n} DAYS PRECEDING"
            cols.append(f"avg({m.raw}) OVER ({part} {bound} AND CURRENT ROW) AS {m.trend(n)}")
    return O.rounded(_C1_CLEAN_NOZ + f"\nSELECT {_KEY}, {_q(cols)} FROM cleaned", _TRENDS)


@register("metric_trends", _trend_sql("rows"))
def metric_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing 8-row and 31-row means of the 7 readings."""
    out = features.add_metric_trends(cleaned_c1(spark, sf_dir, zscores=False), SPEC)
    return out.select("serial_number", "model", "date", *_TRENDS)


@register("metric_trends_days", _trend_sql("days"))
def metric_trends_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W2 (calendar option): trailing 7-day and 30-day means by date range, not rows."""
    spec = SPEC.with_(trend_frame="days")
    out = features.add_metric_trends(cleaned_c1(spark, sf_dir, zscores=False), spec)
    return out.select("serial_number", "model", "date", *_TRENDS)


@register(
    "failure_labels",
    _C1_CLEAN_NOZ
    + """,
f AS (SELECT *, max(CASE WHEN failure = 1 THEN date END) OVER (PARTITION BY model, serial_number) AS failure_date FROM cleaned)
SELECT serial_number, model, date, failure, failure_date,
       CAST(date_diff('day', date, failure_date) AS INTEGER) AS days_until_failure,
       CASE WHEN date_diff('day', date, failure_date) BETWEEN 0 AND 30 THEN 1 ELSE 0 END AS failure_label
FROM f""",
)
def failure_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last failure date per drive, days until it, 30-day pre-failure label."""
    out = features.add_failure_labels(cleaned_c1(spark, sf_dir, zscores=False), SPEC)
    return out.select("serial_number", "model", "date", "failure", "failure_date", "days_until_failure", "failure_label")


@register(
    "metric_deltas",
    _C1_CLEAN_NOZ
    + f"\nSELECT {_KEY}, "
    + _q(
        [
            f"{m.raw} - lag({m.raw}, {k}) OVER (PARTITION BY model, serial_number ORDER BY date) AS {name}"
            for m in SPEC.metrics
            for k, name in ((1, m.daily_delta), (7, m.weekly_increase))
        ]
    )
    + " FROM cleaned",
)
def metric_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change against the previous reading and against the reading 7 rows back."""
    out = features.add_metric_deltas(cleaned_c1(spark, sf_dir, zscores=False), SPEC)
    cols = [c for m in SPEC.metrics for c in (m.daily_delta, m.weekly_increase)]
    return out.select("serial_number", "model", "date", *cols)


_ESPEC = fixtures.EVENT_SPEC


@register(
    "generic_device_features",
    O.rounded(
        O.with_ctes(O.C4_EVENTS, O.clean_ctes(_ESPEC, zscores=True), O.feature_ctes(_ESPEC, "cleaned"))
        + "\nSELECT * FROM features",
        ["value", "value_model_zscore", *_ESPEC.trend_columns],
    ),
)
def generic_device_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same clean + feature operators on a second shape (user events as devices)."""
    raw = fixtures.event_devices_c4(spark, sf_dir)
    return features.build_features(clean.clean_telemetry(raw, _ESPEC), _ESPEC)


# ---- A2 / A9 ------------------------------------------------------------------------------------
_DAILY_SQL = """,
daily AS (
  SELECT date, count(DISTINCT serial_number) AS drive_count,
         CAST(sum(failure) AS BIGINT) AS failure_count,
         CAST(sum(failure_label) AS BIGINT) AS at_risk_count,
         avg(age_days) AS mean_age_days, avg(smart_194_raw) AS mean_temperature_celsius,
         CAST(sum(failure) AS BIGINT) / count(DISTINCT serial_number) * 100 AS failure_rate_pct,
         CAST(sum(failure_label) AS BIGINT) / count(DISTINCT serial_number) * 100 AS at_risk_rate_pct
  FROM features GROUP BY date
)"""
_DAILY_DOUBLES = ["mean_age_days", "mean_temperature_celsius", "failure_rate_pct", "at_risk_rate_pct"]


@register("daily_fleet_health", O.rounded(_C1_FEATURES + _DAILY_SQL + "\nSELECT * FROM daily", _DAILY_DOUBLES))
def daily_fleet_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: daily drives, failures, at-risk rows, mean age and temperature, rates."""
    return reports.daily_fleet_health(features_c1(spark, sf_dir, zscores=False), SPEC)


@register(
    "daily_report",
    O.rounded(
        _C1_FEATURES
        + _DAILY_SQL
        + """
SELECT date, drive_count, failure_count, at_risk_count, round(failure_rate_pct, 4) AS failure_rate_pct,
       round(at_risk_rate_pct, 2) AS at_risk_rate_pct, round(mean_temperature_celsius, 1) AS mean_temp_c FROM daily""",
        ["failure_rate_pct", "at_risk_rate_pct", "mean_temp_c"],
    ),
)
def daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily view with its roundings."""
    return reports.daily_report(reports.daily_fleet_health(features_c1(spark, sf_dir, zscores=False), SPEC), SPEC)


@register(
    "weekly_fleet_health",
    O.rounded(
        _C1_FEATURES
        + _DAILY_SQL
        + """
SELECT date - CAST(dayofweek(date) AS INTEGER) AS week,
       CAST(sum(failure_count) AS BIGINT) AS failures,
       round(avg(drive_count)) AS avg_drives,
       round(sum(failure_count) / avg(drive_count) * 100, 4) AS weekly_failure_rate_pct
FROM daily GROUP BY 1""",
        ["avg_drives", "weekly_failure_rate_pct"],
    ),
)
def weekly_fleet_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly rollup with weeks starting on Sunday."""
    return reports.weekly_fleet_health(reports.daily_fleet_health(features_c1(spark, sf_dir, zscores=False), SPEC), SPEC)


# ---- A3 + P21 + T2 ------------------------------------------------------------------------------
_SUMMARY_SQL = """,
summary AS (
  SELECT model, count(DISTINCT serial_number) AS drive_count, count(*) AS drive_days,
         CAST(sum(failure) AS BIGINT) AS failure_count, avg(capacity_bytes) / 1e12 AS mean_capacity_tb,
         avg(CASE WHEN failure = 1 THEN age_days END) AS mean_age_at_failure_days,
         avg(smart_194_raw) AS mean_temperature_celsius,
         CAST(sum(failure) AS BIGINT) / (count(*) / 365.0) * 100 AS annualized_failure_rate_pct
  FROM features GROUP BY model
)"""
TOP_MODELS_MIN_DRIVES = 4  # the fixture fleet is small; the report's own default is 100


@register(
    "top_models_by_afr",
    O.rounded(
        _C1_FEATURES
        + _SUMMARY_SQL
        + f"""
SELECT model, drive_count, drive_days, failure_count, annualized_failure_rate_pct,
       round(annualized_failure_rate_pct, 2) AS afr_pct, round(mean_capacity_tb, 1) AS capacity_tb,
       round(mean_age_at_failure_days) AS mean_age_at_failure_days
FROM summary WHERE drive_count >= {TOP_MODELS_MIN_DRIVES}
ORDER BY annualized_failure_rate_pct DESC NULLS LAST, model LIMIT 25""",
        ["annualized_failure_rate_pct", "afr_pct", "capacity_tb", "mean_age_at_failure_days"],
    ),
)
def top_models_by_afr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + P21 + T2: the 25 models with the highest annualised failure rate."""
    summary = reports.model_failure_summary(features_c1(spark, sf_dir, zscores=False), SPEC)
    return reports.top_models_by_afr(summary, min_drives=TOP_MODELS_MIN_DRIVES, k=25, spec=SPEC)


# ---- U2 / A4 / A12 ------------------------------------------------------------------------------
_LONG_SQL = (
    """,
long AS ("""
    + "\n  UNION ALL\n".join(
        f"  SELECT {m.id} AS attribute_id, '{m.name}' AS attribute_name, "
        f"CASE WHEN failure_label = 1 THEN 'pre_failure' ELSE 'healthy' END AS cohort, "
        f"{m.zscore} AS zscore, CAST({m.reported} AS DOUBLE) AS reported, {m.trend(30)} AS trend_30d FROM features"
        for m in SPEC.metrics
    )
    + "\n)"
)
_SIGNAL_SQL = """,
signal AS (
  SELECT attribute_id, attribute_name, cohort, count(*) AS row_count, avg(reported) AS reported_share,
         avg(zscore) AS mean_zscore, quantile_disc(zscore, 0.5) AS median_zscore,
         quantile_disc(zscore, 0.95) AS p95_zscore, avg(trend_30d) AS mean_trend_30d
  FROM long GROUP BY attribute_id, attribute_name, cohort
)"""


@register("metric_unpivot", O.rounded(_C1_FEATURES + _LONG_SQL + "\nSELECT * FROM long", ["zscore", "reported", "trend_30d"]))
def metric_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 7 metrics unpivoted into rows in one pass."""
    return reports.metric_unpivot(features_c1(spark, sf_dir), SPEC)


@register(
    "metric_failure_signal",
    O.rounded(
        _C1_FEATURES + _LONG_SQL + _SIGNAL_SQL + "\nSELECT * FROM signal",
        ["reported_share", "mean_zscore", "median_zscore", "p95_zscore", "mean_trend_30d"],
    ),
)
def metric_failure_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + P8: per metric and cohort: rows, reported share, mean / median / p95 z, mean trend."""
    return reports.metric_failure_signal(features_c1(spark, sf_dir), SPEC)


@register(
    "signal_gap",
    _C1_FEATURES
    + _LONG_SQL
    + _SIGNAL_SQL
    + """
SELECT attribute_id, attribute_name,
       round(max(CASE WHEN cohort = 'healthy' THEN mean_zscore END), 3) AS healthy_mean_z,
       round(max(CASE WHEN cohort = 'pre_failure' THEN mean_zscore END), 3) AS pre_failure_mean_z,
       round(max(CASE WHEN cohort = 'pre_failure' THEN mean_zscore END)
             - max(CASE WHEN cohort = 'healthy' THEN mean_zscore END), 3) AS gap,
       round(max(CASE WHEN cohort = 'pre_failure' THEN p95_zscore END), 3) AS pre_failure_p95_z,
       round(max(CASE WHEN cohort = 'healthy' THEN reported_share END), 3) AS reported_share
FROM signal GROUP BY attribute_id, attribute_name ORDER BY gap DESC NULLS LAST, attribute_id""",
)
def signal_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 + T7: cohort pivot and gap per metric."""
    return reports.signal_gap(reports.metric_failure_signal(features_c1(spark, sf_dir), SPEC))


# ---- W5 / P14-P17 -------------------------------------------------------------------------------
_LATEST_SQL = """,
latest AS (
  SELECT * EXCLUDE (_r) FROM (
    SELECT *, row_number() OVER (PARTITION BY serial_number ORDER BY date DESC) AS _r FROM features
  ) WHERE _r = 1
)"""
_FEATURE_DOUBLES = _Z + _TRENDS


@register("latest_per_drive", O.rounded(_C1_FEATURES + _LATEST_SQL + "\nSELECT * FROM latest", _FEATURE_DOUBLES))
def latest_per_drive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest feature row of every drive."""
    return reports.latest_per_entity(features_c1(spark, sf_dir), SPEC, dealt=True)


def _count_sql(conds) -> str:
    return "(" + " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in conds) + ")"


_ANOM = _count_sql([f"{m.zscore} > 2.0" for m in _COUNTERS])
_RISING = _count_sql([f"{m.raw} > 0 AND {m.trend(7)} > {m.trend(30)}" for m in _COUNTERS])
_WATCHLIST_SQL = f""",
wl_latest AS (
  SELECT * EXCLUDE (_r) FROM (
    SELECT *, row_number() OVER (PARTITION BY serial_number ORDER BY date DESC) AS _r
    FROM features WHERE failure_date IS NULL
  ) WHERE _r = 1
),
watchlist AS (
  SELECT serial_number, model, date AS as_of_date, age_days, smart_194_raw AS temperature_celsius,
         {_ANOM} + {_RISING} AS risk_score, {_ANOM} AS anomalous_counter_count, {_RISING} AS rising_counter_count,
         {_q([m.raw for m in _COUNTERS])}, {_q([m.zscore for m in _COUNTERS])}
  FROM wl_latest WHERE {_ANOM} + {_RISING} > 0
)"""


@register(
    "drive_risk_watchlist",
    O.rounded(_C1_FEATURES + _WATCHLIST_SQL + "\nSELECT * FROM watchlist", [m.zscore for m in _COUNTERS]),
)
def drive_risk_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P14-P17 + W5: latest reading of never-failed drives with a positive rule score."""
    return reports.drive_risk_watchlist(features_c1(spark, sf_dir), SPEC, dealt=True)


# ---- C5: J4 / A10 / A11 / T3 / T4 ---------------------------------------------------------------
_PRED_SQL = """,
predictions AS (
  SELECT serial_number, model, date, failure_label,
         CAST(coalesce(smart_187_raw, 0) / 50.0 AS DOUBLE) AS failure_probability
  FROM features
)"""


@register(
    "riskiest_drives",
    _C1_FEATURES
    + _WATCHLIST_SQL
    + _PRED_SQL
    + """,
p AS (SELECT serial_number, arg_max(failure_probability, date) AS failure_probability, max(date) AS prediction_date
      FROM predictions GROUP BY serial_number)
SELECT w.serial_number, w.model, w.as_of_date, w.age_days, w.risk_score, w.anomalous_counter_count,
       w.rising_counter_count, w.smart_5_raw AS reallocated, w.smart_197_raw AS pending,
       w.smart_187_raw AS uncorrectable, round(p.failure_probability, 3) AS failure_probability, p.prediction_date
FROM watchlist w LEFT JOIN p ON p.serial_number = w.serial_number
ORDER BY w.risk_score DESC, p.failure_probability DESC NULLS LAST, w.serial_number LIMIT 20""",
)
def riskiest_drives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 + A10 + T3: watchlist with each drive's latest predicted probability, top 20."""
    feats = features_c1(spark, sf_dir)
    return reports.riskiest_drives(
        reports.drive_risk_watchlist(feats, SPEC, dealt=True), fixtures.predictions_c5(feats), k=20, spec=SPEC
    )


@register(
    "top_predicted_drives",
    _C1_FEATURES
    + _PRED_SQL
    + """
SELECT serial_number, model, max(date) AS latest_date, round(max(failure_probability), 3) AS max_probability,
       max(failure_label) AS was_actually_pre_failure
FROM predictions GROUP BY serial_number, model
ORDER BY max(failure_probability) DESC NULLS LAST, serial_number, model LIMIT 20""",
)
def top_predicted_drives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 + T4: drives with the highest predicted probability, top 20."""
    return reports.top_predicted_drives(fixtures.predictions_c5(features_c1(spark, sf_dir, zscores=False)), k=20, spec=SPEC)


# ---- P9-P12 / A5 / A8 / M2 ----------------------------------------------------------------------

_MD5_BUCKET = "CAST(CAST(concat('0x', substr(md5({k}), 1, 8)) AS BIGINT) % {n} AS INTEGER)"


def _model_rows_sql(censor: str) -> str:
    drop = "failure_date IS NULL AND date > d - 30" if censor == "healthy_only" else "date > d - 30"
    feats = [
        f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in SPEC.feature_columns()
    ]
    return f""",
last_day AS (SELECT max(date) AS d FROM features),
model_rows AS (
  SELECT serial_number, model, date, CAST(failure_label AS DOUBLE) AS failure_label, {_q(feats)},
         {_MD5_BUCKET.format(k='serial_number', n=100)} AS split_bucket
  FROM features, last_day WHERE NOT ({drop})
)"""


_ROW_DOUBLES = ["failure_label", *SPEC.feature_columns()]


@register(
    "model_rows",
    O.rounded(_C1_FEATURES + _model_rows_sql("healthy_only") + "\nSELECT * FROM model_rows", _ROW_DOUBLES),
)
def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 (original rule: healthy rows of the last 30 days censored), P10, P11, A8."""
    return model_rows_c1(spark, sf_dir, censor="healthy_only")


@register(
    "model_rows_whole_window",
    O.rounded(_C1_FEATURES + _model_rows_sql("whole_window") + "\nSELECT * FROM model_rows", _ROW_DOUBLES),
)
def model_rows_whole_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 (whole last window censored, the default for training), P10, P11, A8."""
    return model_rows_c1(spark, sf_dir)


@register(
    "split_buckets",
    _C1_CLEAN_NOZ
    + f"""
SELECT serial_number, b AS split_bucket,
       CASE WHEN b < 70 THEN 'train' WHEN b < 80 THEN 'validation' ELSE 'test' END AS split
FROM (SELECT DISTINCT serial_number, {_MD5_BUCKET.format(k='serial_number', n=100)} AS b FROM cleaned)""",
)
def split_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11 + P12: every drive's stable bucket and the split it falls in."""
    drives = cleaned_c1(spark, sf_dir, zscores=False).select("serial_number").distinct()
    drives = drives.withColumn("split_bucket", training.split_bucket(SPEC).cast("int"))
    return drives.withColumn("split", training.split_name())


_TRAIN_SQL = _model_rows_sql("whole_window") + ",\ntrain AS (SELECT * FROM model_rows WHERE split_bucket < 70)"


@register(
    "label_counts",
    O.rounded(
        _C1_FEATURES + _TRAIN_SQL + "\nSELECT failure_label, count(*) AS row_count FROM train GROUP BY failure_label",
        ["failure_label"],
    ),
)
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: rows per label in the training split."""
    return training.label_counts(training.in_split(model_rows_c1(spark, sf_dir), "train"), SPEC)


@register(
    "downsampled_rows",
    O.rounded(
        _C1_FEATURES
        + _TRAIN_SQL
        + """,
cnt AS (SELECT count(*) FILTER (WHERE failure_label = 1.0) AS pos, count(*) FILTER (WHERE failure_label = 0.0) AS neg FROM train),
frac AS (SELECT CASE WHEN neg = 0 THEN 1.0 ELSE least(1.0, pos * 20 / neg) END AS f FROM cnt)
SELECT serial_number, date, failure_label FROM train, frac
WHERE failure_label = 1.0
   OR CAST(concat('0x', substr(md5(concat('s', serial_number, CAST(date AS VARCHAR))), 1, 8)) AS BIGINT) % 1000000 < f * 1000000""",
        ["failure_label"],
    ),
)
def downsampled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: all positives and at most 20 negatives per positive, chosen by a stable hash."""
    train = training.in_split(model_rows_c1(spark, sf_dir), "train")
    kept = training.downsample_negatives(train, SPEC, fraction=training.kept_share(train, SPEC))
    return kept.select("serial_number", "date", "failure_label")


@register(
    "downsampled_rows_exact",
    O.rounded(
        _C1_FEATURES
        + _TRAIN_SQL
        + """,
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY failure_label
    ORDER BY CAST(concat('0x', substr(md5(concat('s', serial_number, CAST(date AS VARCHAR))), 1, 8)) AS BIGINT), serial_number, date
  ) AS place FROM train
)
SELECT serial_number, date, failure_label FROM placed
WHERE failure_label = 1.0 OR place <= 20 * (SELECT count(*) FROM train WHERE failure_label = 1.0)""",
        ["failure_label"],
    ),
)
def downsampled_rows_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: all positives and exactly 20 negatives per positive, those with the smallest hashes."""
    train = training.in_split(model_rows_c1(spark, sf_dir), "train")
    return training.downsample_negatives(train, SPEC, method="exact").select("serial_number", "date", "failure_label")


# ---- C2: A6 / A17 / A7 / P13 / A13 --------------------------------------------------------------
_THRESHOLDS_SQL = "thresholds AS (SELECT CAST(t AS DOUBLE) AS threshold FROM (VALUES {}) v(t))".format(
    ", ".join(f"({t})" for t in evaluation.THRESHOLDS)
)
_SWEEP_SQL = (
    O.with_ctes(O.C2_SCORED, _THRESHOLDS_SQL)
    + """,
counts AS (
  SELECT threshold,
         count(*) FILTER (WHERE failure_probability >= threshold AND failure_label = 1.0) AS tp,
         count(*) FILTER (WHERE failure_probability >= threshold AND NOT failure_label = 1.0) AS fp,
         count(*) FILTER (WHERE NOT failure_probability >= threshold AND failure_label = 1.0) AS fn
  FROM thresholds LEFT JOIN scored ON TRUE GROUP BY threshold
),
pr AS (
  SELECT *, CASE WHEN tp + fp <> 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
            CASE WHEN tp + fn <> 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall
  FROM counts
),
sweep AS (
  SELECT *, CASE WHEN precision + recall <> 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM pr
)"""
)
_SWEEP_DOUBLES = ["threshold", "precision", "recall", "f1"]


def scored_c2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.scored_docs_c2(spark, sf_dir)


@register("threshold_sweep", O.rounded(_SWEEP_SQL + "\nSELECT * FROM sweep", _SWEEP_DOUBLES))
def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + A17: confusion counts, precision, recall and F1 for 19 thresholds in one scan."""
    return evaluation.threshold_sweep(scored_c2(spark, sf_dir))


@register(
    "best_threshold",
    O.rounded(_SWEEP_SQL + "\nSELECT * FROM sweep ORDER BY f1 DESC, threshold ASC LIMIT 1", _SWEEP_DOUBLES),
)
def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best F1 threshold, ties to the lowest."""
    return evaluation.best_threshold(scored_c2(spark, sf_dir))


RATE_THRESHOLD = 0.5


@register(
    "drive_level_rates",
    O.rounded(
        O.with_ctes(O.C2_SCORED)
        + f""",
per AS (
  SELECT entity_group, max(failure_label) AS failed,
         max(CASE WHEN failure_probability >= {RATE_THRESHOLD} THEN 1.0 ELSE 0.0 END) AS flagged
  FROM scored GROUP BY entity_group
),
tot AS (
  SELECT coalesce(sum(failed), 0.0) AS failed_drives, coalesce(sum(failed * flagged), 0.0) AS caught_drives,
         coalesce(sum(1 - failed), 0.0) AS healthy_drives, coalesce(sum((1 - failed) * flagged), 0.0) AS false_alarm_drives
  FROM per
)
SELECT *, CASE WHEN failed_drives <> 0 THEN caught_drives / failed_drives ELSE 0.0 END AS drive_recall,
          CASE WHEN healthy_drives <> 0 THEN false_alarm_drives / healthy_drives ELSE 0.0 END AS drive_false_alarm_rate
FROM tot""",
        ["failed_drives", "caught_drives", "healthy_drives", "false_alarm_drives", "drive_recall", "drive_false_alarm_rate"],
    ),
)
def drive_level_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-level recall and false-alarm rate (entity = doc_id % 200)."""
    return evaluation.drive_level_rates(scored_c2(spark, sf_dir), RATE_THRESHOLD, entity="entity_group")


@register(
    "predicted_flags",
    O.rounded(
        O.with_ctes(O.C2_SCORED)
        + f"\nSELECT *, CAST(failure_probability >= {RATE_THRESHOLD} AS INTEGER) AS predicted_failure FROM scored",
        ["failure_label", "failure_probability"],
    ),
)
def predicted_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag at a threshold as an int."""
    return evaluation.predicted_flags(scored_c2(spark, sf_dir), RATE_THRESHOLD)


# thresholds of the curves are the distinct probabilities; areas are by trapezoids, with the point (0, first precision)
_EVALUATE_SQL = (
    _SWEEP_SQL
    + """,
best AS (SELECT threshold, precision, recall, f1 FROM sweep ORDER BY f1 DESC, threshold LIMIT 1),
steps AS (
  SELECT failure_probability AS p, count(*) FILTER (WHERE failure_label = 1.0) AS pos, count(*) FILTER (WHERE failure_label <> 1.0) AS neg
  FROM scored GROUP BY 1
),
curve AS (
  SELECT CAST(sum(pos) OVER w AS DOUBLE) AS tp, CAST(sum(neg) OVER w AS DOUBLE) AS fp, p,
         sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg
  FROM steps WINDOW w AS (ORDER BY p DESC ROWS UNBOUNDED PRECEDING)
),
points AS (SELECT p, tp / all_pos AS tpr, fp / all_neg AS fpr, tp / (tp + fp) AS prec FROM curve),
pairs AS (
  SELECT tpr, fpr, prec, lag(tpr, 1, 0.0) OVER o AS tpr0, lag(fpr, 1, 0.0) OVER o AS fpr0, lag(prec, 1, prec) OVER o AS prec0
  FROM points WINDOW o AS (ORDER BY p DESC)
),
areas AS (
  SELECT sum((tpr - tpr0) * (prec + prec0) / 2) AS area_under_pr, sum((fpr - fpr0) * (tpr + tpr0) / 2) AS area_under_roc FROM pairs
),
per AS (
  SELECT entity_group, max(failure_label) AS failed, bool_or(failure_probability >= (SELECT threshold FROM best)) AS hit
  FROM scored GROUP BY entity_group
),
rates AS (
  SELECT count(*) FILTER (WHERE failed = 1 AND hit) / greatest(count(*) FILTER (WHERE failed = 1), 1) AS drive_recall,
         count(*) FILTER (WHERE failed = 0 AND hit) / greatest(count(*) FILTER (WHERE failed = 0), 1) AS drive_false_alarm_rate
  FROM per
)
SELECT 'fixture' AS model_name, 'validation' AS split, round(area_under_pr, 4) AS pr_auc, round(area_under_roc, 4) AS roc_auc,
       round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, round(drive_recall, 4) AS drive_recall,
       round(drive_false_alarm_rate, 4) AS drive_false_alarm_rate, threshold
FROM best, areas, rates"""
)


@register("evaluate_scored", O.rounded(_EVALUATE_SQL, ["threshold"]))
def evaluate_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight metrics at the best threshold, as the pivoted report shows them."""
    scored = scored_c2(spark, sf_dir)
    row = evaluation.evaluation_row(scored, entity="entity_group")
    return reports.metrics_pivot(evaluation.metrics_long(row, "fixture", "validation"))


def _metrics_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sweep in long form (model_name, split, metric, value)."""
    from pyspark.sql import functions as F

    sweep = evaluation.threshold_sweep(scored_c2(spark, sf_dir))
    names = ["precision", "recall", "f1", "threshold"]
    entries = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    return sweep.select(
        F.concat(F.lit("t"), F.col("threshold").cast("string")).alias("model_name"),
        F.lit("validation").alias("split"),
        F.explode(entries).alias("e"),
    ).select("model_name", "split", "e.metric", "e.value")


_PIVOT_COLS = ", ".join(
    (f"max(value) FILTER (WHERE metric = '{name}') AS {alias}" if name == "threshold"
     else f"round(max(value) FILTER (WHERE metric = '{name}'), 4) AS {alias}")
    for name, alias in reports.METRIC_PIVOT
)


@register(
    "metrics_pivot",
    O.rounded(
        _SWEEP_SQL
        + """,
long AS (
  SELECT concat('t', CAST(threshold AS VARCHAR)) AS model_name, 'validation' AS split, metric, value
  FROM sweep, (VALUES ('precision'), ('recall'), ('f1'), ('threshold')) m(metric),
       LATERAL (SELECT CASE metric WHEN 'precision' THEN precision WHEN 'recall' THEN recall
                                   WHEN 'f1' THEN f1 ELSE threshold END AS value)
)
SELECT model_name, split, """
        + _PIVOT_COLS
        + " FROM long GROUP BY model_name, split",
        [alias for _, alias in reports.METRIC_PIVOT],
    ),
)
def metrics_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation metrics pivoted to one row per (model, split)."""
    return reports.metrics_pivot(_metrics_long(spark, sf_dir))


# ---- ST2 without a model: J2 / P15 / P18 / J3 / P19 / P20 / W6 ----------------------------------
STREAM_DAYS = 7


def stream_split(spark: SparkSession, sf_dir: str):
    """history = readings before the last 7 days, batch = readings of the last 7 days."""
    from pyspark.sql import functions as F

    raw = fixtures.telemetry_c1(spark, sf_dir)
    cut = F.date_sub(raw.select(F.max("date")).scalar(), STREAM_DAYS)
    return raw.filter(F.col("date") <= cut), raw.filter(F.col("date") > cut)


def stream_sides(spark: SparkSession, sf_dir: str):
    history, batch = stream_split(spark, sf_dir)
    cleaned_history = clean.clean_telemetry(history, SPEC, zscores=False)
    statistics = scoring.model_statistics(cleaned_history, SPEC)
    # the context is first_seen and the trends, none of which reads a z-score
    context = scoring.entity_context(features.build_features(cleaned_history, SPEC), SPEC)
    return statistics, context, batch


def _history_sql(batch_columns: str = "t.*") -> str:
    return (
        O.with_ctes(O.C1_TELEMETRY)
        + f""",
cutoff AS (SELECT max(date) - {STREAM_DAYS} AS c FROM telemetry),
history AS (SELECT t.* FROM telemetry t, cutoff WHERE t.date <= c),
batch_raw AS (SELECT {batch_columns} FROM telemetry t, cutoff WHERE t.date > c),"""
        + O.clean_ctes(SPEC, zscores=False, source="history")
    )


_SCORES_SQL = (
    """,
hstats AS (SELECT model, """
    + _q([f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in SPEC.raw_columns])
    + """ FROM cleaned GROUP BY model),
ctx AS (SELECT serial_number, min(date) AS first_seen FROM cleaned GROUP BY serial_number),
batch AS (
  SELECT * REPLACE (upper(trim(model)) AS model) FROM batch_raw
  WHERE date IS NOT NULL AND serial_number IS NOT NULL AND model IS NOT NULL AND failure IS NOT NULL
    AND capacity_bytes > 0 AND failure IN (0, 1)
),
zb AS (
  SELECT b.*, """
    + _q(
        [
            f"CASE WHEN b.{m.raw} IS NULL THEN NULL WHEN s.{m.raw}_s > 0 THEN (b.{m.raw} - s.{m.raw}_m) / s.{m.raw}_s ELSE 0.0 END AS {m.zscore}"
            for m in _COUNTERS
        ]
    )
    + """
  FROM batch b LEFT JOIN hstats s ON s.model = upper(trim(b.model))
)
SELECT z.date, z.serial_number, z.model, z.failure,
       CAST(coalesce(date_diff('day', c.first_seen, z.date), 0) AS INTEGER) AS age_days,
       """
    + _count_sql([f"{m.zscore} > 2.0" for m in _COUNTERS])
    + """ AS anomalous_counter_count,
       greatest("""
    + _q([f"coalesce({m.zscore}, 0.0)" for m in _COUNTERS])
    + """) AS max_error_zscore,
       CAST(NULL AS DOUBLE) AS failure_probability, """
    + _q([f"z.{m.raw}" for m in _COUNTERS])
    + ", "
    + _q([f"z.{m.zscore}" for m in _COUNTERS])
    + """
FROM zb z LEFT JOIN ctx c ON c.serial_number = z.serial_number"""
)
_STREAM_SQL = _history_sql() + _SCORES_SQL
_SCORE_DOUBLES = ["max_error_zscore", "failure_probability", *[m.zscore for m in _COUNTERS]]


@register("score_batch_rules", O.rounded(_STREAM_SQL, _SCORE_DOUBLES))
def score_batch_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST2 without a model: z-scores against history, rule scores, drive context and age."""
    statistics, context, batch = stream_sides(spark, sf_dir)
    batch = batch.transform(clean.normalize_group_names, SPEC).transform(clean.drop_invalid_rows, SPEC)
    return scoring.score_batch(batch, statistics, context, None, SPEC)


@register(
    "context_trends",
    O.rounded(
        _history_sql()
        + ","
        + O.feature_ctes(SPEC, "cleaned")
        + f"""
SELECT serial_number, first_seen, {_q(_TRENDS)}
FROM (SELECT *, row_number() OVER (PARTITION BY serial_number ORDER BY date DESC) AS rn FROM features) WHERE rn = 1""",
        _TRENDS,
    ),
)
def context_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each drive's first day and its trends at its latest day of the history."""
    return stream_sides(spark, sf_dir)[1]


# ---- C6: P22 / T6 / A14 -------------------------------------------------------------------------
@register(
    "recent_scores",
    O.rounded(
        O.with_ctes(O.C6_STREAM)
        + """
SELECT scored_at, batch_id, date, serial_number, model, anomalous_counter_count,
       round(max_error_zscore, 1) AS max_error_z, round(failure_probability, 3) AS failure_probability
FROM scores WHERE scored_at >= (SELECT max(scored_at) FROM scores) - INTERVAL 1 HOUR
ORDER BY scores.failure_probability DESC NULLS LAST, max_error_zscore DESC NULLS LAST, batch_id, serial_number, date, scored_at
LIMIT 50""",
        ["max_error_z", "failure_probability"],
    ),
)
def recent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P22 + T6: readings scored in the hour before the newest score, worst 50."""
    from pyspark.sql import functions as F

    scores = fixtures.stream_scores_c6(spark, sf_dir)
    as_of = scores.select(F.max("scored_at")).scalar()
    return reports.recent_scores(scores, as_of=as_of, k=50, spec=SPEC)


@register(
    "batch_summary",
    O.with_ctes(O.C6_STREAM)
    + """
SELECT batch_id, min(scored_at) AS scored_at, count(*) AS readings,
       count(*) FILTER (WHERE anomalous_counter_count > 0) AS anomalous,
       count(*) FILTER (WHERE failure_probability >= 0.5) AS predicted_failures
FROM scores GROUP BY batch_id""",
)
def batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-batch first score time, readings, anomalous and predicted counts."""
    return reports.batch_summary(fixtures.stream_scores_c6(spark, sf_dir))


@register(
    "recent_scores_month",
    O.rounded(
        O.with_ctes(O.C6_STREAM)
        + """,
worst AS (
  SELECT row_number() OVER (ORDER BY failure_probability DESC NULLS LAST, max_error_zscore DESC NULLS LAST, batch_id, serial_number, date, scored_at) - 1 AS position, *
  FROM scores WHERE scored_at >= (SELECT max(scored_at) FROM scores) - INTERVAL 30 DAY
)
SELECT position, scored_at, batch_id, date, serial_number, model, anomalous_counter_count,
       round(max_error_zscore, 1) AS max_error_z, round(failure_probability, 3) AS failure_probability
FROM worst WHERE position < 50""",
        ["max_error_z", "failure_probability"],
    ),
)
def recent_scores_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 with more rows than it shows, in its order (position counts the rows as they come)."""
    from pyspark.sql import functions as F

    scores = fixtures.stream_scores_c6(spark, sf_dir)
    as_of = scores.select(F.max("scored_at")).scalar()
    top = reports.recent_scores(scores, as_of=as_of, window="INTERVAL 30 DAYS", k=50, spec=SPEC)
    return top.select(F.monotonically_increasing_id().alias("position"), "*")


# More groups than the report shows, some of them below its least size
_C8_SQL = """
summary AS (
  SELECT CASE WHEN l_partkey % 97 = 0 THEN concat('R', CAST(l_partkey AS VARCHAR)) ELSE concat('P', CAST(l_partkey % 40 AS VARCHAR)) END AS model,
         count(DISTINCT l_orderkey) AS drive_count, count(*) AS drive_days,
         count(*) FILTER (WHERE l_returnflag = 'R') AS failure_count,
         count(*) FILTER (WHERE l_returnflag = 'R') / (count(*) / 365.0) * 100 AS annualized_failure_rate_pct,
         avg(l_quantity) AS mean_capacity_tb, avg(l_linenumber) AS mean_age_at_failure_days
  FROM lineitem GROUP BY 1
)"""


@register(
    "top_groups_default",
    O.rounded(
        O.with_ctes(_C8_SQL)
        + """,
placed AS (SELECT row_number() OVER (ORDER BY annualized_failure_rate_pct DESC NULLS LAST, model) - 1 AS position, * FROM summary WHERE drive_count >= 100)
SELECT position, model, drive_count, drive_days, failure_count, annualized_failure_rate_pct, round(annualized_failure_rate_pct, 2) AS afr_pct,
       round(mean_capacity_tb, 1) AS capacity_tb, round(mean_age_at_failure_days) AS mean_age_at_failure_days
FROM placed WHERE position < 25""",
        ["annualized_failure_rate_pct", "afr_pct", "capacity_tb", "mean_age_at_failure_days"],
    ),
)
def top_groups_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P21 + T2 at their defaults (100 entities, 25 groups), where both cut; rows in their order."""
    from pyspark.sql import functions as F

    returned = F.count_if(F.col("l_returnflag") == "R")
    rare = F.concat(F.lit("R"), F.col("l_partkey").cast("string"))
    common = F.concat(F.lit("P"), (F.col("l_partkey") % 40).cast("string"))
    summary = (
        fixtures.table(spark, sf_dir, "lineitem")
        .groupBy(F.when(F.col("l_partkey") % 97 == 0, rare).otherwise(common).alias("model"))
        .agg(
            F.countDistinct("l_orderkey").alias("drive_count"),
            F.count("*").alias("drive_days"),
            returned.alias("failure_count"),
            (returned / (F.count("*") / F.lit(365.0)) * 100).alias("annualized_failure_rate_pct"),
            F.avg("l_quantity").alias("mean_capacity_tb"),
            F.avg("l_linenumber").alias("mean_age_at_failure_days"),
        )
    )
    return reports.top_models_by_afr(summary).select(F.monotonically_increasing_id().alias("position"), "*")


# ---- Q1-Q6 / J5 / SK8 ---------------------------------------------------------------------------
@register(
    "sanity_checks",
    _C1_FEATURES
    + _DAILY_SQL
    + _SUMMARY_SQL
    + _LONG_SQL
    + _SIGNAL_SQL
    + _WATCHLIST_SQL
    + _PRED_SQL
    + """
SELECT
  (SELECT count(*) = count(DISTINCT date) FROM daily) AS daily_dates_unique,
  (SELECT sum(failure_count) FROM daily) = (SELECT sum(failure_count) FROM summary) AS failure_totals_agree,
  (SELECT count(*) = 2 * count(DISTINCT attribute_id) FROM signal) AS smart_signal_complete,
  (SELECT count(*) = count(DISTINCT serial_number) FROM watchlist) AS watchlist_one_row_per_drive,
  (SELECT count(*) = 0 FROM watchlist WHERE serial_number IN (SELECT serial_number FROM features WHERE failure = 1))
    AS watchlist_has_no_failed_drive,
  (SELECT count(*) = 0 FROM (SELECT serial_number, date FROM features GROUP BY 1, 2 HAVING count(*) > 1))
    AS features_unique_per_drive_day,
  (SELECT count(*) FILTER (WHERE date IS NULL) = 0 FROM daily) AS daily_keys_not_null,
  (SELECT count(*) FILTER (WHERE serial_number IS NULL) = 0 FROM watchlist) AS watchlist_keys_not_null,
  true AS types_publishable,
  (SELECT min(failure_probability) >= 0 AND max(failure_probability) <= 1 FROM predictions) AS probabilities_valid""",
)
def sanity_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q6, Q4b, J5, SK8 as one row of booleans (true = pass)."""
    # as in a deployment, the checks read a feature table that is there, and don't build it for each check
    path = shared_folder(spark, "checked-features")
    features_c1(spark, sf_dir).write.parquet(path)
    feats = spark.read.parquet(path)
    return checks.sanity_checks(
        spark,
        reports.daily_fleet_health(feats, SPEC),
        reports.model_failure_summary(feats, SPEC),
        reports.metric_failure_signal(feats, SPEC),
        reports.drive_risk_watchlist(feats, SPEC),
        feats,
        fixtures.predictions_c5(feats),
        SPEC,
    )


# ---- A18 ----------------------------------------------------------------------------------------
_DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

@register(
    "table_inventory",
    "\nUNION ALL\n".join(
        f"""SELECT '{t}' AS table_name, count(*) AS total_rows,
       (SELECT CAST(count(*) AS INTEGER) FROM information_schema.columns WHERE table_name = '{t}') AS column_count FROM {t}"""
        for t in _DRIVER_TABLES
    ),
)
def table_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and columns of every input table; the rows come from the files' footers."""
    from fleetsight.sources.tables import footer_session

    own = footer_session(spark)
    return reports.table_inventory(own, {t: fixtures.table(own, sf_dir, t) for t in _DRIVER_TABLES})


# ---- M2-M10 (rows-only: model fits are not SQL) -------------------------------------------------
@register("train_and_evaluate")
def train_and_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit both candidates, tune and pick, evaluate once on test; metrics table."""
    # the label counts and the model rows are two passes; both start from rows that are cleaned once
    cleaned, rows, last = staged_c1(spark, sf_dir)
    feats = features.build_features(clean.add_group_zscores(cleaned, SPEC), SPEC, rows)
    result = training.train_and_evaluate(feats, SPEC, staging_path=shared_folder(spark, "model-rows"), last_date=last)
    result.release()
    return result.metrics


# ---- SC1 / SC2: CSV batches with their own headers ----------------------------------------------
@register("csv_ingest", O.with_ctes(O.C1_TELEMETRY) + "\nSELECT * FROM telemetry")
def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC1, SC2, SC3, U1: telemetry written as CSV batches with two column orders, read back."""
    from pyspark.sql import functions as F

    from fleetsight.sources.csv import discover_batch_files, read_csv_batches

    raw = fixtures.telemetry_c1(spark, sf_dir)
    text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    root = shared_folder(spark, "csv ingest %41")  # a space and a percent sign, as folders may have
    for batch, failed, columns in (("a", "0", raw.columns), ("b", "1", raw.columns[::-1])):
        part = text.filter(F.col("failure") == failed).select(*columns)
        part.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/{batch}")
    return read_csv_batches(spark, discover_batch_files(spark, root), SPEC.schema())


# ---- SC7 / ST1-ST6 ------------------------------------------------------------------------------
_ARRIVED = "t.* REPLACE (CASE WHEN t.failure = 0 AND t.smart_188_raw = 0 THEN NULL ELSE t.smart_188_raw END AS smart_188_raw)"


@register(
    "stream_scores",
    O.rounded("SELECT *, CAST(0 AS INTEGER) AS batch_id FROM (\n" + _history_sql(_ARRIVED) + _SCORES_SQL + "\n) AS scored_batch", _SCORE_DOUBLES),
)
def stream_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SC7, ST1-ST6: last-7-day readings written as CSV files with two different headers and a
    malformed value, drained by the file stream into an idempotent table (scored_at dropped)."""
    from pyspark.sql import functions as F

    from fleetsight.streaming.job import start_scoring_stream

    statistics, context, batch = stream_sides(spark, sf_dir)
    root = shared_folder(spark, "stream")
    cols = batch.columns
    as_text = batch.select(*[F.col(c).cast("string").alias(c) for c in cols])
    first = as_text.withColumn("smart_188_raw", F.when(F.col("smart_188_raw") == "0", "n/a").otherwise(F.col("smart_188_raw")))
    first.filter(F.col("failure") == "0").write.option("header", True).csv(f"{root}/staging/a")
    as_text.filter(F.col("failure") != "0").select(*reversed(cols)).write.option("header", True).csv(f"{root}/staging/b")
    query = start_scoring_stream(
        spark, f"{root}/staging", f"{root}/checkpoint", f"{root}/scores", statistics, context, None, SPEC, once=True
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/scores").drop("scored_at")


# the queries of the mergeable states and of the keyed streams register themselves here
from fleetsight.plans import registry_states  # noqa: E402, F401
