"""SK1-SK9: idempotent Parquet writes and publishing with a key contract; JDBC as an option."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetsight.operators.checks import PUBLISHABLE_TYPES


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str] = ("year", "month"), dynamic: bool = True) -> None:
    """SK1: overwrite only the partitions present in ``df`` (dynamic) or the whole folder (static).

    Rerunning one period is idempotent; a full rebuild should pass ``dynamic=False`` so partitions
    absent from the new data do not stay behind. The ``rebalance`` hint clusters rows by the
    partition columns before writing, so each task writes few, well-sized files; AQE splits a
    hot partition value over several tasks instead of sending it to one.
    """
    (
        df.hint("rebalance", *partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def check_contract(df: DataFrame, keys: Sequence[str]) -> None:
    """SK8: only publishable column types, and no NULL key (checked on the written table)."""
    bad = [f"{f.name}:{f.dataType.simpleString()}" for f in df.schema.fields if not isinstance(f.dataType, PUBLISHABLE_TYPES)]
    if bad:
        raise TypeError(f"columns with unpublishable types: {bad}")
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise KeyError(f"key columns not in frame: {missing}")


def _null_key(keys: Sequence[str], path: str) -> str:
    return f"NULL key in {list(keys)} for {path}"


def keyed(df: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """SK8: ``df`` sorted by its key within each file; the write that runs it fails on a NULL key."""
    check_contract(df, keys)
    if not keys:
        return df
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return df.filter(F.assert_true(present, _null_key(keys, path)).isNull()).sortWithinPartitions(*keys)


def publish(df: DataFrame, path: str, keys: Sequence[str], mode: str = "replace") -> DataFrame:
    """SK3 / SK6 / SK7: write a published table sorted by its key within each file.

    ``replace`` overwrites the table, ``append`` accumulates. The key contract is checked before
    the write (types) and inside the write job itself: a NULL key fails the job through
    ``assert_true`` instead of costing a second pass over the written table.
    """
    if mode not in ("replace", "append"):
        raise ValueError(mode)
    writer = keyed(df, keys, path).write.mode("overwrite" if mode == "replace" else "append")
    try:
        writer.parquet(path)
    except Exception as error:
        message = _null_key(keys, path)
        if message in str(error):
            raise ValueError(message) from None
        raise
    return df.sparkSession.read.parquet(path)


def publish_all(tables: Mapping[str, tuple[DataFrame, Sequence[str]]], root: str, mode: str = "replace") -> dict[str, DataFrame]:
    """SK9: publish a set of named tables, each with its key."""
    return {name: publish(df, f"{root.rstrip('/')}/{name}", keys, mode) for name, (df, keys) in tables.items()}


def jdbc_append(
    df: DataFrame,
    url: str,
    table: str,
    driver: str | None = None,
    batchsize: int = 10_000,
    isolation_level: str = "NONE",
    mode: str = "append",
    **properties: str,
) -> None:
    """SK5: distributed JDBC write, one connection per task, batched inserts."""
    writer = (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batchsize)
        .option("isolationLevel", isolation_level)
    )
    if driver:
        writer = writer.option("driver", driver)
    for key, value in properties.items():
        writer = writer.option(key, value)
    writer.mode(mode).save()
