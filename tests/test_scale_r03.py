"""What the queries on larger tables must not do: build the same rows again, sort wide rows twice, touch state once a row."""

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fleetsight.operators import clean, features, incremental, reports, training
from fleetsight.plans import registry, registry_states
from fleetsight.spec import DEFAULT_SPEC
from fleetsight.streaming import keyed
from helpers import day, telemetry_df, telemetry_row

S = DEFAULT_SPEC


class Stop(Exception):
    pass


def given(monkeypatch, module, name, spark, query):
    """What a query gives to a function of a module, when it first calls it."""
    found = []

    def taken(*args, **kw):
        found.append((args, kw))
        raise Stop

    monkeypatch.setattr(module, name, taken)
    with pytest.raises(Stop):
        registry.queries()[query](spark, SF_SMALL)
    return found[0]


def reads(df, table):
    return any(f"{table}.parquet" in path for path in df.inputFiles())


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def telemetry(spark):
    rows = [telemetry_row(f"U{u}", day(d), model=f"MODEL_{u % 2}", smart_5_raw=u * d) for u in range(5) for d in range(0, 50, u + 1)]
    return telemetry_df(spark, rows)


# ---- stream_trends ------------------------------------------------------------------------------
def test_the_state_is_written_once_an_entity(spark, telemetry):
    writes = []

    class Held:
        def get(self):
            return writes[-1] if writes else None

        def update(self, value):
            writes.append(value)

    class Handle:
        def getValueState(self, name, schema):
            return Held()

    history = keyed._by_entity(keyed.entity_history(telemetry, S), ["smart_5_raw"], S).collect()
    assert sorted(r.serial_number for r in history) == [f"U{u}" for u in range(5)]
    first = next(r for r in history if r.serial_number == "U1")
    state = keyed.TrendState("date", ["smart_5_raw"], ["bigint"], [0], (7, 30), [])
    state.init(Handle())
    state.handleInitialState(("MODEL_1", "U1"), first, None)
    start = day(0).toordinal() - dt.date(1970, 1, 1).toordinal()
    assert writes == [(start, [(start + d, d) for d in range(0, 50, 2)])]


def test_stream_trends_is_started_from_staged_rows(spark, monkeypatch):
    args, kw = given(monkeypatch, keyed, "start_trend_scoring", spark, "stream_trends")
    assert not reads(args[4], "lineitem") and not reads(args[5], "lineitem")


# ---- stream_scores_redelivered ------------------------------------------------------------------
def test_micro_batches_join_a_context_that_is_there(spark, monkeypatch):
    args, kw = given(monkeypatch, keyed, "start_distinct_scoring", spark, "stream_scores_redelivered")
    context = args[5]
    assert not reads(context, "lineitem") and "Window" not in plan_of(context)


# ---- train_and_evaluate -------------------------------------------------------------------------
def test_training_starts_from_rows_cleaned_once(spark, monkeypatch):
    (feats, *_), kw = given(monkeypatch, training, "train_and_evaluate", spark, "train_and_evaluate")
    assert not reads(feats, "lineitem")
    cleaned = clean.clean_telemetry(registry.fixtures.telemetry_c1(spark, SF_SMALL), S, zscores=False)
    want = cleaned.agg(F.count("*"), F.max("date")).first()
    assert (feats.count(), feats.select(kw["last_date"]).first()[0]) == tuple(want)


# ---- drive_risk_watchlist, riskiest_drives ------------------------------------------------------
def test_latest_rows_of_dealt_features(spark, telemetry):
    moved = [telemetry_row("U0", day(90), model="MODEL_1"), telemetry_row("U7", day(3)), telemetry_row("U8", None), Row(**telemetry_row(None, day(2)).asDict())]
    built = features.build_features(telemetry.unionByName(telemetry_df(spark, moved)), S)
    some = ["serial_number", "model", "date", "age_days", *S.trend_columns]
    rows = lambda df: sorted(map(str, df.select(*some).collect()))
    assert rows(reports.latest_per_entity(built, S, dealt=True)) == rows(reports.latest_per_entity(built, S))


@pytest.mark.parametrize("name", ["drive_risk_watchlist", "riskiest_drives", "latest_per_drive"])
def test_only_last_rows_are_sorted_again(spark, name):
    plan = plan_of(registry.queries()[name](spark, SF_SMALL))
    assert "_last#" in plan and plan.index("WindowGroupLimit [serial_number") < plan.index("_last#")


def test_rows_of_a_feature_task_are_bounded(spark, telemetry, monkeypatch):
    monkeypatch.setattr(features, "ROWS_A_TASK", 10)
    n = telemetry.count()
    dealt = features.dealt_by_entity(telemetry, n, S)
    assert dealt.rdd.getNumPartitions() == -(-n // 10) and sorted(map(str, dealt.collect())) == sorted(map(str, telemetry.collect()))
    assert features.dealt_by_entity(telemetry, 20, S) is telemetry
    built = lambda *rows: sorted(map(str, features.build_features(telemetry, S, *rows).collect()))
    assert built(n) == built()


# ---- signal_from_states -------------------------------------------------------------------------
def test_sketches_unpivot_states_not_rows(spark, telemetry):
    feats = features.build_features(clean.add_group_zscores(telemetry, S), S)
    states = incremental.signal_sketches(feats, S)
    plan = plan_of(states)
    assert plan.index("Generate explode") < plan.index("Aggregate") and plan.count("Generate") == 1
    long = reports.metric_unpivot(feats.withColumn("month", incremental.month_of(S)), S, keep=["month"])
    keys = ["attribute_id", "attribute_name", "cohort", "month"]
    sums = [F.count(F.lit(1)), F.count("reported"), F.sum("reported"), F.count("zscore"), F.round(F.sum("zscore"), 9), F.round(F.sum("trend_30d"), 9)]
    want = long.groupBy(*keys).agg(*sums)
    got = states.select(*keys, "row_count", "reported.n", "reported.total", "z.n", F.round("z.total", 9), F.round("trend_30d.total", 9))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


# ---- published_tables, weekly_distinct_drives ---------------------------------------------------
def test_published_tables_read_features_that_are_there(spark, monkeypatch):
    (tables, _), _ = given(monkeypatch, registry_states, "publish_all", spark, "published_tables")
    assert tables.keys() == {"daily_fleet_health", "model_failure_summary"}
    assert not any(reads(df, "lineitem") for df, _ in tables.values())


@pytest.mark.parametrize("step", ["entity_numbers", "distinct_bitmaps", "distinct_sketches"])
def test_distinct_states_read_rows_cleaned_once(spark, monkeypatch, step):
    (rows, *_), _ = given(monkeypatch, incremental, step, spark, "weekly_distinct_drives")
    assert not reads(rows, "lineitem")
