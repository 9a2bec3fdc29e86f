"""Data-quality checks over published tables (Q1-Q6, J5, SK8) as one row of booleans.

Each check is a one-row aggregate used as a scalar subquery; nothing is collected to the driver
and no cross join is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, TimestampType

from fleetsight.spec import DEFAULT_SPEC, TelemetrySpec

# fixed values: the column types a published table may use
PUBLISHABLE_TYPES = (DateType, TimestampType, StringType, BooleanType, IntegerType, LongType, DoubleType)


def unique_per(df: DataFrame, *cols: str) -> Column:
    """count(*) = count(distinct cols)."""
    return df.select((F.count(F.lit(1)) == F.count_distinct(*[F.col(c) for c in cols])).alias("ok")).scalar()


def daily_dates_unique(daily: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> Column:
    """Q1."""
    return unique_per(daily, spec.date)


def failure_totals_agree(daily: DataFrame, summary: DataFrame) -> Column:
    """Events summed per day equal events summed per group."""
    return daily.select(F.sum("failure_count")).scalar() == summary.select(F.sum("failure_count")).scalar()


def signal_complete(signal: DataFrame) -> Column:
    """Q3: every metric has both cohorts."""
    return signal.select((F.count(F.lit(1)) == 2 * F.count_distinct("attribute_id")).alias("ok")).scalar()


def watchlist_one_row_per_entity(watchlist: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> Column:
    """Q4."""
    return unique_per(watchlist, spec.entity)


def watchlist_has_no_failed(watchlist: DataFrame, features: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> Column:
    """Nobody on the watchlist has ever failed (semi join is empty)."""
    failed = features.filter(F.col(spec.event) == 1).select(spec.entity)
    return watchlist.join(failed, spec.entity, "left_semi").select((F.count(F.lit(1)) == 0).alias("ok")).scalar()


def probabilities_valid(predictions: DataFrame) -> Column:
    """Q5: all probabilities in [0, 1]."""
    return predictions.select(
        ((F.min("failure_probability") >= 0) & (F.max("failure_probability") <= 1)).alias("ok")
    ).scalar()


def features_unique(features: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> Column:
    """Q6: one feature row per (entity, date); the fault the other checks only hint at."""
    dups = features.groupBy(*spec.key).count().filter(F.col("count") > 1)
    return dups.select((F.count(F.lit(1)) == 0).alias("ok")).scalar()


def keys_not_null(df: DataFrame, keys: list[str]) -> Column:
    """SK8: no NULL in any key column."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return df.select((F.count_if(cond) == 0).alias("ok")).scalar()


def types_publishable(df: DataFrame) -> bool:
    """SK8: every column has one of the publishable types (a schema check, no job)."""
    return all(isinstance(f.dataType, PUBLISHABLE_TYPES) for f in df.schema.fields)


def sanity_checks(
    spark: SparkSession,
    daily: DataFrame,
    summary: DataFrame,
    signal: DataFrame,
    watchlist: DataFrame,
    features: DataFrame,
    predictions: DataFrame | None = None,
    spec: TelemetrySpec = DEFAULT_SPEC,
) -> DataFrame:
    """All checks in one row; true means pass. Each table is read once, by one aggregate for all its checks."""
    failed = features.filter(F.col(spec.event) == 1).select(F.col(spec.entity).alias("_failed")).distinct()
    watched = watchlist.join(failed, F.col(spec.entity) == F.col("_failed"), "left")
    days = F.col(spec.date)
    drives = F.col(spec.entity)
    figures = {
        "daily": daily.agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct(days).alias("keys"), F.count_if(days.isNull()).alias("nulls"), F.sum("failure_count").alias("failures")
        ),
        "summary": summary.agg(F.sum("failure_count").alias("failures")),
        "signal": signal.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("attribute_id").alias("keys")),
        "watch": watched.agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct(drives).alias("keys"), F.count_if(drives.isNull()).alias("nulls"), F.count("_failed").alias("failed")
        ),
        "repeated": features.groupBy(*spec.key).count().agg(F.count_if(F.col("count") > 1).alias("n")),
    }
    if predictions is not None:
        figures["scored"] = predictions.agg(F.min("failure_probability").alias("least"), F.max("failure_probability").alias("most"))
    row = spark.range(1).select(*[df.select(F.struct(*df.columns)).scalar().alias(name) for name, df in figures.items()])
    cols = {
        "daily_dates_unique": F.col("daily.n") == F.col("daily.keys"),
        "failure_totals_agree": F.col("daily.failures") == F.col("summary.failures"),
        "smart_signal_complete": F.col("signal.n") == 2 * F.col("signal.keys"),
        "watchlist_one_row_per_drive": F.col("watch.n") == F.col("watch.keys"),
        "watchlist_has_no_failed_drive": F.col("watch.failed") == 0,
        "features_unique_per_drive_day": F.col("repeated.n") == 0,
        "daily_keys_not_null": F.col("daily.nulls") == 0,
        "watchlist_keys_not_null": F.col("watch.nulls") == 0,
        "types_publishable": F.lit(all(types_publishable(t) for t in (daily, summary, signal, watchlist))),
    }
    if predictions is not None:
        cols["probabilities_valid"] = (F.col("scored.least") >= 0) & (F.col("scored.most") <= 1)
    return row.select(*[c.alias(name) for name, c in cols.items()])
