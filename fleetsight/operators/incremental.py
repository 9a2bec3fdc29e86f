"""Mergeable states of the report aggregates, so that a refresh reads new rows and small states only.

A1: moments (n, mean, M2) by group and month; A4: quantile sketches by metric, cohort and month;
A2 / A3 / A9: distinct counts by day, as HyperLogLog sketches or as exact bitmaps.

A state table is written by batch (:func:`write_state`): a batch that runs again replaces its own
part, and reading merges all parts in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetsight.functions.columns import week_start_sunday
from fleetsight.operators.clean import MEAN_SUFFIX, STDDEV_SUFFIX
from fleetsight.operators.reports import cohort
from fleetsight.spec import DEFAULT_SPEC, TelemetrySpec

BATCH = "state_batch"


def write_state(state: DataFrame, path: str, batch_id: int | str) -> None:
    """One batch's part of a state table; the same batch again replaces it."""
    part = state.withColumn(BATCH, F.lit(str(batch_id)))
    part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BATCH)


def month_of(spec: TelemetrySpec = DEFAULT_SPEC) -> Column:
    return F.trunc(F.col(spec.date), "month").alias("month")


# ---- A1: moments ------------------------------------------------------------------------------
def moment_table(cleaned: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """A1 as a state: per group and month, (n, mean, m2) of every reading; m2 is the sum of squared deviations."""
    parts = [
        F.struct(F.count(c).alias("n"), F.avg(c).alias("mean"), (F.var_pop(c) * F.count(c)).alias("m2")).alias(c)
        for c in spec.raw_columns
    ]
    return cleaned.groupBy(spec.group, month_of(spec)).agg(*parts)


def _merge(a: Column, b: Column) -> Column:
    """Moments of two sets of rows together (pairwise, so that no large squares cancel)."""
    n = a["n"] + b["n"]
    gap = b["mean"] - a["mean"]
    mean = a["mean"] + gap * b["n"] / n
    m2 = a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n
    both = F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"))
    return F.when(b["n"] == 0, a).when(a["n"] == 0, b).otherwise(both)


_NO_ROWS = "struct<n: bigint, mean: double, m2: double>"


def _full(moments: Column) -> Column:
    """Moments without NULLs, so that sets of no rows merge."""
    zero = F.lit(0.0)
    return F.struct(moments["n"].alias("n"), F.coalesce(moments["mean"], zero).alias("mean"), F.coalesce(moments["m2"], zero).alias("m2"))


def merge_moments(moments: DataFrame, keys: list[str], spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """Moments of fewer keys, or of several parts with the same keys.

    A key's parts (months times batches, never rows) are folded in order of their values, so the
    order in which they were written doesn't matter.
    """
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2")).cast(_NO_ROWS)
    parts = moments.groupBy(*keys).agg(*[F.sort_array(F.collect_list(_full(F.col(c)))).alias(c) for c in spec.raw_columns])
    return parts.select(*keys, *[F.aggregate(c, start, lambda a, b: _merge(a, b).cast(_NO_ROWS)).alias(c) for c in spec.raw_columns])


def statistics_from_moments(moments: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """A1: the columns of ``clean.group_statistics``, from a moment table of any batches and months."""
    merged = merge_moments(moments, [spec.group], spec)

    def mean(c: str) -> Column:
        return F.when(F.col(c)["n"] > 0, F.col(c)["mean"])

    def stddev(c: str) -> Column:
        return F.when(F.col(c)["n"] > 1, F.sqrt(F.col(c)["m2"] / (F.col(c)["n"] - 1)))

    return merged.select(
        spec.group,
        *[mean(c).alias(c + MEAN_SUFFIX) for c in spec.raw_columns],
        *[stddev(c).alias(c + STDDEV_SUFFIX) for c in spec.raw_columns],
    )


# ---- A4: quantile sketches ----------------------------------------------------------------------
#: k of a KLL sketch. Its rank error is about 2.3 / k ** 0.9 with 99 % confidence, merged or not.
SKETCH_K = 800


def sketch_rank_error(k: int = SKETCH_K) -> float:
    """Bound of a quantile's rank error as a share of the rows (single-sided, 99 % confidence)."""
    return 2.3 / k**0.9


def signal_sketches(features: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC, k: int = SKETCH_K) -> DataFrame:
    """A4 as a state: per metric, cohort and month a sketch of the z-scores, and the counts and sums of the means."""
    trend = f"trend_{spec.trend_rows[-1]}d"

    def summed(c: Column, name: str) -> Column:
        return F.struct(F.count(c).alias("n"), F.sum(c).alias("total")).alias(name)

    def state(m) -> Column:
        return F.struct(
            F.lit(m.id).alias("attribute_id"),
            F.lit(m.name).alias("attribute_name"),
            summed(F.col(m.reported).cast("double"), "reported"),
            summed(F.col(m.trend(spec.trend_rows[-1])), trend),
            summed(F.col(m.zscore), "z"),
            F.kll_sketch_agg_double(m.zscore, F.lit(k)).alias("sketch"),
        )

    # every row counts for every metric, so a row is aggregated once, and the few states are unpivoted instead of the rows
    wide = features.groupBy(cohort(spec).alias("cohort"), month_of(spec)).agg(
        F.count(F.lit(1)).alias("row_count"), *[state(m).alias(f"_{m.id}") for m in spec.metrics]
    )
    long = wide.select("cohort", "month", "row_count", F.explode(F.array(*[f"_{m.id}" for m in spec.metrics])).alias("m"))
    return long.select("m.attribute_id", "m.attribute_name", "cohort", "month", "row_count", "m.reported", f"m.{trend}", "m.z", "m.sketch")


def signal_from_sketches(sketches: DataFrame, spec: TelemetrySpec = DEFAULT_SPEC) -> DataFrame:
    """A4: the columns of ``reports.metric_failure_signal``; means are exact, percentiles within :func:`sketch_rank_error`."""
    trend = f"trend_{spec.trend_rows[-1]}d"
    keys = ["attribute_id", "attribute_name", "cohort"]

    def mean(c: str) -> Column:
        return F.try_divide(F.sum(F.col(c)["total"]), F.sum(F.col(c)["n"]))

    merged = sketches.groupBy(*keys).agg(
        F.sum("row_count").alias("row_count"),
        mean("reported").alias("reported_share"),
        mean("z").alias("mean_zscore"),
        mean(trend).alias(f"mean_{trend}"),
        F.sum(F.col("z")["n"]).alias("_n"),
        F.kll_merge_agg_double("sketch").alias("_sketch"),
    )

    def at(p: float) -> Column:
        return F.when(F.col("_n") > 0, F.kll_sketch_get_quantile_double("_sketch", F.lit(p)))

    return merged.select(
        *keys, "row_count", "reported_share", "mean_zscore", at(0.5).alias("median_zscore"), at(0.95).alias("p95_zscore"), f"mean_{trend}"
    )


# ---- A2 / A3 / A9: distinct counts ----------------------------------------------------------------
#: Registers of a HyperLogLog sketch as a power of two; its relative standard error is about 1.04 / 2 ** (LG_K / 2).
LG_K = 14
_BUCKETS = 1_024


def distinct_error(lg_k: int = LG_K) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(rows: DataFrame, keys: list[str], entity: str, lg_k: int = LG_K) -> DataFrame:
    """A state per ``keys`` from which distinct counts of any coarser keys follow approximately."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(F.col(entity).cast("string"), F.lit(lg_k)).alias("sketch"))


def distinct_from_sketches(sketches: DataFrame, keys: list[str | Column], name: str = "drive_count") -> DataFrame:
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))


def entity_numbers(rows: DataFrame, entity: str, known: DataFrame | None = None, buckets: int = _BUCKETS) -> DataFrame:
    """(entity, number): a number for each entity, dense inside hash buckets, so that bitmaps of them are full.

    ``known`` is the table of earlier batches: its numbers stay, and new entities go on behind them.
    Ranks are taken inside a bucket, so no task sees all entities.
    """
    bucket = F.pmod(F.xxhash64(entity), F.lit(buckets)).alias("_bucket")
    fresh = rows.filter(F.col(entity).isNotNull()).select(entity).distinct().select(entity, bucket)
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(entity))
    number = lambda place: F.col("_bucket") * F.lit(1 << 40) + place
    if known is None:
        return fresh.select(entity, number(rank).alias("number"))
    used = known.groupBy(F.floor(F.col("number") / F.lit(1 << 40)).alias("_bucket")).agg(F.max(F.col("number") % F.lit(1 << 40)).alias("_used"))
    added = fresh.join(known.select(entity), entity, "left_anti").join(used, "_bucket", "left")
    return known.select(entity, "number").unionByName(added.select(entity, number(rank + F.coalesce("_used", F.lit(0))).alias("number")))


def distinct_bitmaps(rows: DataFrame, keys: list[str], entity: str, numbers: DataFrame) -> DataFrame:
    """An exact state per ``keys``: bitmaps of the entities' numbers, one row for each 32,768 numbers that occur."""
    pairs = rows.select(*keys, entity).distinct().join(numbers, entity)
    return pairs.groupBy(*keys, F.bitmap_bucket_number("number").alias("bitmap")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def distinct_from_bitmaps(bitmaps: DataFrame, keys: list[str | Column], name: str = "drive_count") -> DataFrame:
    """Exact distinct counts of coarser keys: bitmaps are united by number range, then counted."""
    columns = [k if isinstance(k, Column) else F.col(k) for k in keys]
    united = bitmaps.select(*columns, "bitmap", "bits")
    names = united.columns[: len(keys)]
    united = united.groupBy(*names, "bitmap").agg(F.bitmap_or_agg("bits").alias("bits"))
    return united.groupBy(*names).agg(F.sum(F.bitmap_count("bits")).alias(name))


def weekly(spec: TelemetrySpec = DEFAULT_SPEC) -> Column:
    """The key that rolls days up to weeks from Sunday."""
    return week_start_sunday(F.col(spec.date)).alias("week")
