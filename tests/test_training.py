import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetsight.operators import evaluation, training
from fleetsight.spec import DEFAULT_SPEC

S = DEFAULT_SPEC


def label_rows(spark, rows):
    cols = ["serial_number string", "model string", "date date", "failure_label int", "failure_date date"]
    cols += [f"{c} double" for c in S.feature_columns()]
    data = [r + tuple([None] * len(S.feature_columns())) for r in rows]
    return spark.createDataFrame(data, ", ".join(cols))


LAST = dt.date(2024, 7, 15)
HORIZON = S.horizon_days


@pytest.fixture(scope="module")
def rows(spark):
    """Ten units a week apart in age; every third one fails on the last day."""
    made = []
    for i in range(10):
        failed = LAST if i % 3 == 0 else None
        made.append((f"unit-{i}", "kind", LAST - dt.timedelta(days=7 * i), int(failed is not None and 7 * i <= HORIZON), failed))
    return label_rows(spark, made)


@pytest.mark.parametrize("censor", ["healthy_only", "whole_window"])
def test_censoring_drops_what_the_rule_says(rows, censor):
    kept = {r.serial_number for r in training.prepare_model_rows(rows, censor=censor).collect()}
    recent = {f"unit-{i}" for i in range(10) if 7 * i < HORIZON}
    failed = {f"unit-{i}" for i in range(0, 10, 3)}
    everyone = {f"unit-{i}" for i in range(10)}
    assert kept == everyone - (recent - failed if censor == "healthy_only" else recent)


def test_censoring_with_a_given_last_date(rows):
    later = F.lit(LAST + dt.timedelta(days=365))
    assert training.prepare_model_rows(rows, last_date=later).count() == 10
    with pytest.raises(ValueError):
        training.censor_filter(rows, censor="nothing")


def test_model_rows_have_no_nulls_and_a_bucket(rows):
    for method in ("md5", "xxhash64"):
        out = training.prepare_model_rows(rows, censor="healthy_only", bucket=method)
        for r in out.collect():
            assert all(r[c] is not None for c in S.feature_columns()) and r.split_bucket in range(100)


def test_every_bucket_is_in_one_split(spark):
    buckets = spark.range(100).select(F.col("id").cast("int").alias("split_bucket"))
    named = {name: {r.split_bucket for r in training.in_split(buckets, name).collect()} for name in training.SPLITS}
    assert {n: len(b) for n, b in named.items()} == {"train": 70, "validation": 10, "test": 20}
    assert set.union(*named.values()) == set(range(100))
    assert max(named["train"]) < min(named["validation"]) and max(named["validation"]) < min(named["test"])


def test_xxhash_bucket_is_spark_xxhash(spark):
    df = spark.createDataFrame([("unit-1",), ("unit-2",)], "serial_number string")
    row = df.select(training.split_bucket(S, "xxhash64").alias("b"), F.expr("pmod(xxhash64(serial_number), 100)").alias("w")).collect()
    assert all(r.b == r.w for r in row)


def test_downsampling_needs_a_positive(spark):
    df = spark.createDataFrame([("S", dt.date(2026, 1, 1), 0.0)], "serial_number string, date date, failure_label double")
    with pytest.raises(ValueError):
        training.downsample_negatives(df)


def test_downsampling_ratio_and_stability(spark):
    base = spark.range(20000).select(
        F.concat(F.lit("S"), (F.col("id") % 500).cast("string")).alias("serial_number"),
        F.date_add(F.lit(dt.date(2026, 1, 1)), (F.col("id") / 500).cast("int")).alias("date"),
        F.when(F.col("id") < 100, 1.0).otherwise(0.0).alias("failure_label"),
    )
    kept = training.downsample_negatives(base)
    counts = {r.failure_label: r["count"] for r in kept.groupBy("failure_label").count().collect()}
    assert counts[1.0] == 100
    assert 1500 < counts[0.0] < 2500  # about 20 per positive
    again = training.downsample_negatives(base.repartition(7))
    assert sorted(kept.collect()) == sorted(again.collect())


SCORES = [(f"u{i % 7}", float(i % 5 == 0), round((i * 37 % 101) / 100, 2)) for i in range(60)]


def scored(spark):
    return spark.createDataFrame(SCORES, "serial_number string, failure_label double, failure_probability double")


def plain_counts(threshold):
    tp = sum(1 for _, y, p in SCORES if y == 1 and p >= threshold)
    fp = sum(1 for _, y, p in SCORES if y == 0 and p >= threshold)
    return tp, fp, sum(1 for _, y, _ in SCORES if y == 1) - tp


def test_sweep_equals_plain_counts(spark):
    sweep = {r.threshold: r for r in evaluation.threshold_sweep(scored(spark)).collect()}
    assert sorted(sweep) == evaluation.THRESHOLDS
    for t, r in sweep.items():
        assert (r.tp, r.fp, r.fn) == plain_counts(t)
    best = max(sweep.values(), key=lambda r: (r.f1, -r.threshold))
    assert evaluation.best_threshold_value(scored(spark)) == best.threshold


def test_rows_without_label_or_probability_count_nowhere(spark):
    more = spark.createDataFrame([("x", None, 0.9), ("x", 1.0, None)], "serial_number string, failure_label double, failure_probability double")
    row = evaluation.threshold_sweep(scored(spark).union(more), [0.5]).first()
    assert (row.tp, row.fp, row.fn) == plain_counts(0.5)


def test_ratios_are_zero_on_empty_denominators(spark):
    empty = scored(spark).filter("false")
    row = evaluation.threshold_sweep(empty, [0.5]).first()
    assert (row.tp, row.precision, row.recall, row.f1) == (0, 0.0, 0.0, 0.0)
    rates = evaluation.drive_level_rates(empty, 0.5).first()
    assert rates.drive_recall == 0.0 and rates.drive_false_alarm_rate == 0.0


def test_drive_level_rates_equal_plain_ones(spark):
    by_unit = {}
    for u, y, p in SCORES:
        label, hit = by_unit.get(u, (0.0, False))
        by_unit[u] = (max(label, y), hit or p >= 0.9)
    failed = [hit for y, hit in by_unit.values() if y == 1]
    healthy = [hit for y, hit in by_unit.values() if y == 0]
    r = evaluation.drive_level_rates(scored(spark), 0.9).first()
    assert (r.failed_drives, r.caught_drives) == (len(failed), sum(failed))
    assert (r.healthy_drives, r.false_alarm_drives) == (len(healthy), sum(healthy))


def test_evaluate_reports_all_metrics(spark):
    m = evaluation.evaluate(scored(spark), 0.5)
    assert set(m) == {"area_under_pr", "area_under_roc", "threshold", "precision", "recall", "f1", "drive_recall", "drive_false_alarm_rate"}
    positives, negatives = ([p for _, y, p in SCORES if y == want] for want in (1, 0))
    better = sum((a > b) + 0.5 * (a == b) for a in positives for b in negatives)
    assert m["area_under_roc"] == pytest.approx(better / len(positives) / len(negatives))


def test_fit_score_and_importance(spark):
    n = 400
    df = spark.range(n).select(
        F.concat(F.lit("S"), F.col("id").cast("string")).alias("serial_number"),
        F.lit("M").alias("model"),
        F.lit(dt.date(2026, 1, 1)).alias("date"),
        F.when(F.col("id") % 10 == 0, 1.0).otherwise(0.0).alias("failure_label"),
        *[(F.when(F.col("id") % 10 == 0, 5.0).otherwise(0.0) + F.rand(1)).alias(c) for c in S.feature_columns()],
    )
    pipe = training.candidate_pipelines(S, lr_max_iter=10, gbt_max_iter=3)
    for name, p in pipe.items():
        model = p.fit(df)
        out = training.score(model, df)
        assert "failure_probability" in out.columns and "probability" not in out.columns
        probs = [r.failure_probability for r in out.select("failure_probability").collect()]
        assert all(0 <= p <= 1 for p in probs)
        imp = training.feature_importance(spark, model, S)
        assert imp.count() == len(S.feature_columns()) == 37


@pytest.mark.parametrize("shape", ["ties", "random", "perfect", "reversed", "one_score", "no_positive", "no_negative"])
def test_areas_equal_the_library_evaluator(spark, shape):
    import random

    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = random.Random(5)
    made = {
        "ties": lambda i: (float(i % 3 == 0), (i % 7) / 7), "random": lambda i: (float(rng.random() < 0.2), rng.random()),
        "perfect": lambda i: (float(i < 50), 1 - i / 400), "reversed": lambda i: (float(i < 50), i / 400),
        "one_score": lambda i: (float(i % 2), 0.5), "no_positive": lambda i: (0.0, i / 400), "no_negative": lambda i: (1.0, i / 400),
    }
    df = spark.createDataFrame([made[shape](i) for i in range(400)], "failure_label double, failure_probability double")
    got = evaluation.curve_areas(df, slices=16).first()
    for column, metric in (("area_under_pr", "areaUnderPR"), ("area_under_roc", "areaUnderROC")):
        ev = BinaryClassificationEvaluator(labelCol="failure_label", rawPredictionCol="failure_probability", numBins=0, metricName=metric)
        assert got[column] == pytest.approx(ev.evaluate(df), abs=1e-12)


def test_areas_of_no_rows(spark):
    empty = spark.createDataFrame([], "failure_label double, failure_probability double")
    assert tuple(evaluation.curve_areas(empty).first()) == (0.0, 0.0)


@pytest.mark.parametrize("negatives", [0, 7, 60, 500])
def test_exactly_ratio_negatives_under_any_partitioning(spark, negatives):
    rows = [(f"S{i}", dt.date(2026, 1, 1) + dt.timedelta(days=i % 30), float(i >= negatives)) for i in range(negatives + 3)]
    df = spark.createDataFrame(rows, "serial_number string, date date, failure_label double")
    kept = [
        {(r.serial_number, r.date) for r in training.downsample_negatives(part, S, ratio=20, method="exact").collect()}
        for part in (df, df.repartition(7), df.orderBy(F.desc("serial_number")).coalesce(1))
    ]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 3 + min(60, negatives)


def test_no_positive_keeps_no_negative(spark):
    df = spark.createDataFrame([("S", dt.date(2026, 1, 1), 0.0)], "serial_number string, date date, failure_label double")
    assert training.downsample_negatives(df, S, method="exact").count() == 0
    with pytest.raises(Exception, match="never 1"):
        training.downsample_negatives(df, S, fraction=training.kept_share(df, S)).collect()


def test_a_session_that_counted_a_stream_can_still_score(spark, scratch):
    """Counting rows of a micro-batch must not leave the session unfit to score with a freshly fitted model."""
    from fleetsight.streaming.job import make_batch_handler
    from fleetsight.streaming import scoring
    from helpers import telemetry_df, telemetry_row

    with open(f"{scratch}/a.csv", "w") as fh:
        fh.write("serial_number,date,model,capacity_bytes,failure,smart_5_raw\nA,2025-05-05,MODEL_A,9,0,4\n")
    history = telemetry_df(spark, [telemetry_row("A", dt.date(2025, 5, 1))])
    context = scoring.entity_context(history.select("*", F.col("date").alias("first_seen"), *[F.lit(0.0).alias(c) for c in S.trend_columns]))
    handle = make_batch_handler(spark, f"{scratch}/out", scoring.model_statistics(history), context, counts_path=f"{scratch}/counts")
    handle(spark.createDataFrame([(f"file:{scratch}/a.csv",)], "path string"), 0)
    assert spark.read.parquet(f"{scratch}/counts").first().rows_read == 1
    train = spark.range(60).select(F.when(F.col("id") % 3 == 0, 1.0).otherwise(0.0).alias("failure_label"), *[F.rand(2).alias(c) for c in S.feature_columns()])
    model = training.candidate_pipelines(S, lr_max_iter=3)["logistic_regression"].fit(train)
    assert training.score(model, train).count() == 60 and len(training.score(model, train).collect()) == 60
