"""Projections of the driver's tables into telemetry shapes (C1-C7 of FIXTURES.md).

Every fixture is derived by Spark from the whole input tables, so its size follows the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetsight.spec import DEFAULT_SPEC, Metric, TelemetrySpec


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def telemetry_c1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drive-day telemetry from lineitem + supplier + nation (raw, before cleaning)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = li.join(su, F.col("s_suppkey") == F.col("l_suppkey")).join(na, F.col("n_nationkey") == F.col("s_nationkey"))
    failure = (
        (F.col("l_returnflag") == "R")
        & (F.col("l_linestatus") == "F")
        & (F.col("l_quantity") >= 49)
        & (F.col("l_discount") >= 0.09)
        & (F.col("l_suppkey") % 3 == 0)
    )
    qty = F.col("l_quantity").cast("bigint")
    cols = [
        F.col("l_shipdate").cast("date").alias("date"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("serial_number"),
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("model"),
        (F.floor("s_acctbal").cast("bigint") * 1000000000).alias("capacity_bytes"),
        F.when(failure, 1).otherwise(0).cast("int").alias("failure"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("smart_5_raw"),
        (F.col("l_orderkey") % 50000).cast("bigint").alias("smart_9_raw"),
        F.when(F.col("l_returnflag") == "A", F.lit(None).cast("bigint")).otherwise(qty).alias("smart_187_raw"),
        F.when(F.col("l_partkey") % 40 == 0, 1 + F.col("l_partkey") % 7).otherwise(0).cast("bigint").alias("smart_188_raw"),
        (20 + qty % 30).cast("bigint").alias("smart_194_raw"),
        F.when(F.col("l_linenumber") >= 6, F.col("l_linenumber").cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("smart_197_raw"),
        F.when(F.col("s_nationkey") % 5 == 0, F.lit(None).cast("bigint")).otherwise((F.col("l_partkey") % 3).cast("bigint")).alias("smart_198_raw"),
    ]
    cols += [F.lit(None).cast("bigint").alias(c) for c in DEFAULT_SPEC.normalized_columns]
    return j.select(*cols)


# C4: a second shape (user events as devices) that proves the spec is generic
EVENT_SPEC = TelemetrySpec(
    capacity=None,
    metrics=(Metric(1, "value", "value"),),
    error_counter_ids=(1,),
    temperature_id=None,
    horizon_days=7,
)


def event_devices_c4(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "value")
    return ev.select(
        F.col("ts").cast("date").alias("date"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("serial_number"),
        F.concat(F.lit("M"), (F.col("user_id") % 5).cast("string")).alias("model"),
        F.lit(0).alias("failure"),
        F.col("value"),
    )


def scored_docs_c2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored rows from labels + documents (label = quality, p = n_chars / 5000 capped at 1)."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return labels.join(docs, "doc_id").select(
        F.col("doc_id").alias("entity"),
        (F.col("doc_id") % 200).alias("entity_group"),
        F.col("quality").cast("double").alias("failure_label"),
        F.least(F.col("n_chars") / 5000.0, F.lit(1.0)).cast("double").alias("failure_probability"),
    )


def predictions_c5(features: DataFrame) -> DataFrame:
    """Predictions shaped like the classifier's, from cleaned features."""
    return features.select(
        "serial_number",
        "model",
        "date",
        "failure_label",
        (F.coalesce(F.col("smart_187_raw"), F.lit(0)) / 50.0).cast("double").alias("failure_probability"),
    )


def stream_scores_c6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored-stream table from events."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ev.select(
        F.floor(F.col("event_id") / 1000).cast("bigint").alias("batch_id"),
        F.col("ts").alias("scored_at"),
        F.col("ts").cast("date").alias("date"),
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("serial_number"),
        F.concat(F.lit("M"), (F.col("user_id") % 5).cast("string")).alias("model"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("anomalous_counter_count"),
        (F.col("value") / 50.0).alias("max_error_zscore"),
        F.least(F.col("value") / 500.0, F.lit(1.0)).alias("failure_probability"),
    )
