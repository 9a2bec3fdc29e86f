"""Built-in column expressions. Nothing here leaves the JVM or whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def zscore(value: Column, mean: Column, stddev: Column) -> Column:
    """NULL reading stays NULL; (x - mean) / sd when sd > 0; otherwise 0.0.

    The last branch covers zero variance, a single-row group (sample sd is NULL) and a group
    without statistics.
    """
    return (
        F.when(value.isNull(), F.lit(None).cast("double"))
        .when(stddev > 0, (value - mean) / stddev)
        .otherwise(F.lit(0.0))
    )


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, or 0.0 when the denominator is 0 or NULL."""
    return F.when(F.coalesce(denominator, F.lit(0)) != 0, numerator / denominator).otherwise(F.lit(0.0))


def count_true(conditions: Iterable[Column]) -> Column:
    """How many of the conditions hold (NULL counts as false), as an int."""
    total = F.lit(0)
    for condition in conditions:
        total = total + F.when(condition, F.lit(1)).otherwise(F.lit(0))
    return total


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    The rank filter lets Catalyst place a partial WindowGroupLimit before the shuffle, so a key
    with millions of rows leaves each map task as one row.
    """
    rank = "_rank_in_key"
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(f"{rank} = 1").drop(rank)


def week_start_sunday(day: Column) -> Column:
    """Start of the week containing ``day`` with weeks starting on Sunday."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def hash_bucket(key: Column, buckets: int) -> Column:
    """Stable bucket in [0, buckets) from the first 32 bits of md5(key).

    Portable: any SQL engine with md5 and hex parsing computes the same bucket.
    """
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(buckets)


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every floating column, for display and engine-independent comparison."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, (DoubleType, FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
