"""Cleaning: name normalisation, validity filters, deterministic dedup, per-group z-scores.

Covers P1-P7, A1, A16 and J1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetsight.functions.columns import keep_first, zscore
from fleetsight.operators.joins import MAX_BROADCAST_ROWS, join_side_table
from fleetsight.spec import DEFAULT_SPEC, TelemetrySpec

MEAN_SUFFIX = "_model_mean"
STDDEV_SUFFIX = "_model_stddev"


def normalize_group_names(df: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """Group names compared case- and padding-insensitively."""
    return df.withColumn(spec.group, F.upper(F.trim(F.col(spec.group))))


def drop_invalid_rows(df: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """Identity columns present, readable capacity (> 0), event flag in {0, 1}."""
    out = df.na.drop(subset=[spec.date, spec.entity, spec.group, spec.event])
    if spec.capacity:
        # -1 marks an unreadable capacity; NULL fails the comparison and is dropped as well
        out = out.filter(F.col(spec.capacity) > 0)
    return out.filter(F.col(spec.event).isin(0, 1))


def dedup_order(df: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> list:
    """Total order that picks the surviving duplicate: event, capacity, readings, rest; desc, NULLs last."""
    first = [spec.event] + ([spec.capacity] if spec.capacity else []) + spec.raw_columns
    rest = [c for c in df.columns if c not in set(first) | set(spec.key)]
    return [F.col(c).desc_nulls_last() for c in first + rest]


def deduplicate_entity_days(df: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """One row per (entity, date), the survivor chosen by a total order (deterministic)."""
    return keep_first(df, spec.key, dedup_order(df, spec))


def with_date_partitions(df: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """P5: year and month columns for a partitioned layout."""
    return df.withColumn("year", F.year(spec.date)).withColumn("month", F.month(spec.date))


def group_statistics(df: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """A1: per-group mean and sample standard deviation of every reading (partial + final agg)."""
    aggs = [F.avg(c).alias(c + MEAN_SUFFIX) for c in spec.raw_columns]
    aggs += [F.stddev_samp(c).alias(c + STDDEV_SUFFIX) for c in spec.raw_columns]
    return df.groupBy(spec.group).agg(*aggs)


def add_group_zscores(
    df: DataFrame,
    spec: TelemetrySpec = DEFAULT_SPEC,
    statistics: DataFrame | None = None,
    unknown_group: str = "zero",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    group_bound: int | None = None,
    statistics_rows: int | None = None,
) -> DataFrame:
    """Z-score of each reading within its group, plus a reported flag.

    ``statistics`` defaults to the frame's own (A1), which stay in the same query: one scan and
    one deduplication, and no job runs to build it. They are broadcast where the caller knows a
    bound on the groups that is small (``group_bound``). Without one the join is left to AQE: it
    knows the statistics' size when they are made, broadcasts them below its threshold, and
    otherwise joins by shuffle with hot groups split. The streaming scorer passes historic statistics that
    were materialised beforehand; ``statistics_rows`` is then their row count.
    ``unknown_group="null"`` leaves z NULL for a group without statistics instead of 0.0.
    """
    own = statistics is None
    stats = group_statistics(df, spec) if own else statistics
    stats = stats.select(
        spec.group,
        *[F.col(c + MEAN_SUFFIX) for c in spec.raw_columns],
        *[F.col(c + STDDEV_SUFFIX) for c in spec.raw_columns],
        F.lit(True).alias("_has_stats"),
    )
    joined = join_side_table(
        df, stats, on=spec.group, how="left", max_broadcast_rows=max_broadcast_rows, side_rows=group_bound if own else statistics_rows
    )
    zs = []
    for m in spec.metrics:
        z = zscore(F.col(m.raw), F.col(m.raw + MEAN_SUFFIX), F.col(m.raw + STDDEV_SUFFIX))
        if unknown_group == "null":
            z = F.when(F.col("_has_stats").isNull(), F.lit(None).cast("double")).otherwise(z)
        zs.append(z.alias(m.zscore))
    reported = [F.col(m.raw).isNotNull().alias(m.reported) for m in spec.metrics]
    return joined.select(*[F.col(c) for c in df.columns], *zs, *reported)


def clean_telemetry(
    df: DataFrame,
    spec: TelemetrySpec = DEFAULT_SPEC,
    zscores: bool = True,
    partitions: bool = False,
) -> DataFrame:
    """The cleaning stage: normalise, filter, dedup, then (optionally) z-scores."""
    out = df.transform(normalize_group_names, spec).transform(drop_invalid_rows, spec)
    out = out.transform(deduplicate_entity_days, spec)
    if partitions:
        out = out.transform(with_date_partitions, spec)
    if zscores:
        out = add_group_zscores(out, spec)
    return out
