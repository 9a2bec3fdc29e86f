"""The staged pipeline end to end on the sf0.01 telemetry fixture (raw CSV batches in)."""

import pytest
from pyspark.sql import functions as F

from fleetsight.plans import fixtures, pipeline

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    layout = pipeline.Layout(str(tmp_path_factory.mktemp("fleet")))
    raw = fixtures.telemetry_c1(spark, SF)
    cut = F.date_sub(raw.select(F.max("date")).scalar(), 7)
    history, arriving = raw.filter(F.col("date") <= cut), raw.filter(F.col("date") > cut)
    early = F.year("date") < 1996
    pipeline.write_raw_batches(history.filter(early), layout, "batch_a", raw.columns)
    pipeline.write_raw_batches(history.filter(~early), layout, "batch_b", list(reversed(raw.columns)))
    arriving.select(*[F.col(c).cast("string") for c in raw.columns]).write.option("header", True).csv(layout.incoming)
    return layout


def test_stages_in_order(spark, layout):
    pipeline.ingest(spark, layout)
    conformed = spark.read.parquet(layout.conformed)
    assert {"year", "month"} <= set(conformed.columns)

    pipeline.clean_stage(spark, layout)
    cleaned = spark.read.parquet(layout.cleaned)
    assert cleaned.groupBy("serial_number", "date").count().filter("count > 1").count() == 0
    assert "smart_5_raw_model_zscore" in cleaned.columns

    pipeline.feature_stage(spark, layout)
    feats = spark.read.parquet(layout.features)
    assert feats.count() == cleaned.count()
    assert {"age_days", "failure_label", "smart_5_raw_trend_30d"} <= set(feats.columns)
    # rerunning a stage replaces its output instead of appending
    pipeline.feature_stage(spark, layout)
    assert spark.read.parquet(layout.features).count() == cleaned.count()

    published = pipeline.serving_stage(spark, layout)
    assert set(published) == set(pipeline.REPORT_KEYS)
    assert published["smart_failure_signal"].count() == 14

    found, missing = pipeline.model_tables(spark, layout)
    assert not found and len(missing) == 3

    best = pipeline.training_stage(spark, layout, lr_max_iter=5, gbt_max_iter=3)
    assert best in ("logistic_regression", "gradient_boosted_trees")
    found, missing = pipeline.model_tables(spark, layout)
    assert not missing
    metrics = found["model_evaluation_metrics"]
    assert metrics.filter("split = 'test'").count() == 8
    assert found["model_feature_importance"].count() == 37

    pipeline.stream_stage(spark, layout, once=True)
    scores = spark.read.parquet(layout.scores)
    assert scores.count() > 0
    assert scores.filter(F.col("failure_probability").isNull()).count() == 0  # the saved model was used


def test_staged_model_rows_equal_unstaged(spark, layout):
    from fleetsight.operators import training

    feats = spark.read.parquet(layout.features)
    staged = spark.read.parquet(layout.model_rows)
    rows = training.prepare_model_rows(feats)
    train, validation, test = (training.in_split(rows, name) for name in training.SPLITS)
    expected = {
        "train": training.downsample_negatives(train),
        "validation": validation,
        "test": test,
    }
    for name, frame in expected.items():
        got = staged.filter(F.col("split") == name).select("serial_number", "date", "failure_label")
        want = frame.select("serial_number", "date", "failure_label")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name
