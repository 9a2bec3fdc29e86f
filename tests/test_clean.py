import pytest
from pyspark.sql import functions as F

from fleetsight.operators import clean
from helpers import PENDING, REALLOCATED, day, telemetry_df, telemetry_row


def test_group_names_are_trimmed_and_upper_cased(spark):
    df = telemetry_df(spark, [telemetry_row("S1", day(0), model="  st4000dm000 ")])
    assert clean.normalize_group_names(df).first().model == "ST4000DM000"


def test_invalid_rows_are_dropped(spark):
    rows = [
        telemetry_row("OK", day(0)),
        telemetry_row("NEG", day(0), capacity=-1),
        telemetry_row("NULLCAP", day(0), capacity=None),
        telemetry_row("BADFLAG", day(0), failure=2),
        telemetry_row(None, day(0)),
        telemetry_row("NODATE", None),
    ]
    kept = [r.serial_number for r in clean.drop_invalid_rows(telemetry_df(spark, rows)).collect()]
    assert kept == ["OK"]


def test_duplicates_keep_one_deterministic_row(spark):
    rows = [
        telemetry_row("S1", day(0), **{REALLOCATED: 1}),
        telemetry_row("S1", day(0), failure=1, **{REALLOCATED: 0}),
        telemetry_row("S1", day(0), **{REALLOCATED: 5}),
        telemetry_row("S1", day(1)),
    ]
    out = clean.deduplicate_entity_days(telemetry_df(spark, rows)).collect()
    assert len(out) == 2
    first_day = [r for r in out if r.date == day(0)][0]
    assert first_day.failure == 1  # event first, then readings, all descending
    shuffled = telemetry_df(spark, list(reversed(rows))).repartition(3)
    again = [r for r in clean.deduplicate_entity_days(shuffled).collect() if r.date == day(0)][0]
    assert again == first_day


def test_dedup_plan_limits_before_the_shuffle(spark):
    df = telemetry_df(spark, [telemetry_row("S1", day(0))])
    plan = clean.deduplicate_entity_days(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_zscores_within_model(spark):
    rows = [
        telemetry_row("A1", day(0), model="A", **{REALLOCATED: 0, PENDING: None}),
        telemetry_row("A2", day(0), model="A", **{REALLOCATED: 10, PENDING: 3}),
        telemetry_row("B1", day(0), model="B", **{REALLOCATED: 4}),
        telemetry_row("B2", day(0), model="B", **{REALLOCATED: 4}),
        telemetry_row("C1", day(0), model="C", **{REALLOCATED: 9}),
    ]
    out = {r.serial_number: r for r in clean.add_group_zscores(telemetry_df(spark, rows)).collect()}
    assert out["A1"]["smart_5_raw_model_zscore"] == pytest.approx(-0.70710678)
    assert out["A2"]["smart_5_raw_model_zscore"] == pytest.approx(0.70710678)
    assert out["B1"]["smart_5_raw_model_zscore"] == 0.0  # zero variance
    assert out["C1"]["smart_5_raw_model_zscore"] == 0.0  # single row: sample sd is NULL
    assert out["A1"]["smart_197_raw_model_zscore"] is None  # missing reading stays missing
    assert out["A1"]["smart_197_raw_reported"] is False and out["A2"]["smart_197_raw_reported"] is True


def test_unknown_group_zero_or_null(spark):
    history = telemetry_df(spark, [telemetry_row("H", day(0), model="A", **{REALLOCATED: 1}), telemetry_row("H2", day(0), model="A", **{REALLOCATED: 3})])
    stats = clean.group_statistics(history)
    batch = telemetry_df(spark, [telemetry_row("X", day(1), model="Z", **{REALLOCATED: 100})])
    assert clean.add_group_zscores(batch, statistics=stats).first()["smart_5_raw_model_zscore"] == 0.0
    assert clean.add_group_zscores(batch, statistics=stats, unknown_group="null").first()["smart_5_raw_model_zscore"] is None


def test_statistics_broadcast_only_under_the_bound(spark):
    df = telemetry_df(spark, [telemetry_row("S", day(0), model=f"M{i}") for i in range(3)])
    small = clean.add_group_zscores(df, group_bound=3)._jdf.queryExecution().optimizedPlan().toString()
    big = clean.add_group_zscores(df, group_bound=3, max_broadcast_rows=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in small.lower()
    assert "broadcast" not in big.lower()
    assert clean.add_group_zscores(df, group_bound=3, max_broadcast_rows=1).count() == 3
