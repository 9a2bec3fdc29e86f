import pytest
from pyspark.sql import functions as F

from fleetsight.sinks.publish import check_contract, publish, write_partitioned


def test_dynamic_overwrite_replaces_only_touched_partitions(spark, scratch):
    path = f"{scratch}/t"
    df = spark.createDataFrame([(2026, 1, "a"), (2026, 2, "b")], "year int, month int, v string")
    write_partitioned(df, path)
    write_partitioned(spark.createDataFrame([(2026, 2, "c")], "year int, month int, v string"), path)
    out = sorted((r.month, r.v) for r in spark.read.parquet(path).collect())
    assert out == [(1, "a"), (2, "c")]
    write_partitioned(spark.createDataFrame([(2026, 3, "d")], "year int, month int, v string"), path, dynamic=False)
    assert [(r.month, r.v) for r in spark.read.parquet(path).collect()] == [(3, "d")]


def test_publish_replace_and_append(spark, scratch):
    df = spark.createDataFrame([("m", 1.0)], "model string, v double")
    publish(df, f"{scratch}/p", ["model"])
    publish(df, f"{scratch}/p", ["model"])
    assert spark.read.parquet(f"{scratch}/p").count() == 1
    publish(df, f"{scratch}/p", ["model"], mode="append")
    assert spark.read.parquet(f"{scratch}/p").count() == 2


def test_contract_rejects_null_keys_and_odd_types(spark, scratch):
    with pytest.raises(ValueError):
        publish(spark.createDataFrame([(None, 1.0)], "model string, v double"), f"{scratch}/n", ["model"])
    with pytest.raises(TypeError):
        check_contract(spark.range(1).select(F.array(F.lit(1)).alias("a")), [])
    with pytest.raises(KeyError):
        check_contract(spark.range(1), ["missing"])
