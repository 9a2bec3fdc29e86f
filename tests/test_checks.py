"""The checks catch the fault they exist for: a feature stage appended twice."""

from fleetsight.operators import checks, reports
from fleetsight.plans import fixtures
from fleetsight.plans.registry import features_c1

SF = "/root/testdata/sf0.001"


def run_checks(spark, feats):
    return checks.sanity_checks(
        spark,
        reports.daily_fleet_health(feats),
        reports.model_failure_summary(feats),
        reports.metric_failure_signal(feats),
        reports.drive_risk_watchlist(feats),
        feats,
        fixtures.predictions_c5(feats),
    ).first()


def test_checks_pass_on_clean_features(spark):
    row = run_checks(spark, features_c1(spark, SF))
    assert all(row.asDict().values()), row


def test_duplicated_features_are_caught_only_by_q6(spark):
    feats = features_c1(spark, SF)
    row = run_checks(spark, feats.unionByName(feats)).asDict()
    assert row.pop("features_unique_per_drive_day") is False
    # the report-level checks all still pass on doubled input: none of them detects it
    assert all(row.values()), row
