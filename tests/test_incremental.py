"""Mergeable states against the operators that read all rows."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from fleetsight.operators import clean, features, incremental, reports
from fleetsight.spec import DEFAULT_SPEC
from helpers import PENDING, REALLOCATED, day, telemetry_df, telemetry_row

S = DEFAULT_SPEC


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    found = [
        telemetry_row(f"U{u}", day(d), model=f"M{u % 3}", **{REALLOCATED: 10**5 + rng.randrange(10), PENDING: rng.choice([None, 1, 5])})
        for u in range(12)
        for d in range(0, 80, 1 + u % 4)
    ]
    return [*found, telemetry_row("solo", day(3), model="ONE", **{PENDING: None, REALLOCATED: 7})]


@pytest.mark.parametrize("order", list(itertools.permutations(range(3)))[::2])
def test_moments_of_batches_in_any_order(spark, scratch, rows, order):
    for batch in [*order, order[-1]]:  # the last one again: it replaces itself
        part = telemetry_df(spark, rows[batch::3])
        incremental.write_state(incremental.moment_table(part, S), f"{scratch}/moments", batch)
    got = {r[S.group]: r for r in incremental.statistics_from_moments(incremental.read_state(spark, f"{scratch}/moments"), S).collect()}
    want = {r[S.group]: r for r in clean.group_statistics(telemetry_df(spark, rows), S).collect()}
    assert got.keys() == want.keys()
    for group, r in want.items():
        for c in r.asDict():
            expected = r[c]
            assert got[group][c] == (pytest.approx(expected, rel=1e-9, abs=1e-9) if isinstance(expected, float) else expected), (group, c)


def test_large_readings_keep_their_spread(spark, rows):
    """Squares of 10^12 would cancel; merged deviations only lose what a mean of that size can't hold."""
    df = telemetry_df(spark, rows).withColumn(REALLOCATED, F.col(REALLOCATED) + F.lit(10**12))
    sd = REALLOCATED + clean.STDDEV_SUFFIX
    got = incremental.statistics_from_moments(incremental.moment_table(df, S), S).filter("model = 'M0'").first()[sd]
    assert got == pytest.approx(clean.group_statistics(telemetry_df(spark, rows), S).filter("model = 'M0'").first()[sd], rel=1e-4)


def test_months_merge_to_coarser_keys(spark, rows):
    monthly = incremental.moment_table(telemetry_df(spark, rows), S)
    assert monthly.select("month").distinct().count() == 3
    assert incremental.merge_moments(monthly, ["month"], S).agg(F.sum(f"{REALLOCATED}.n")).first()[0] == len(rows)


def test_sketched_percentiles_are_within_the_stated_rank(spark):
    rng = random.Random(8)
    data = [(i % 4, rng.gauss(0, 1) if i % 5 else float(i % 3)) for i in range(40_000)]
    df = spark.createDataFrame(data, "part int, z double")
    merged = df.groupBy("part").agg(F.kll_sketch_agg_double("z", F.lit(incremental.SKETCH_K)).alias("s")).agg(F.kll_merge_agg_double("s").alias("s"))
    values = sorted(z for _, z in data)
    off = incremental.sketch_rank_error() * len(values)
    for p in (0.01, 0.5, 0.95, 0.99):
        found = merged.select(F.kll_sketch_get_quantile_double("s", F.lit(p))).first()[0]
        below, to_here = sum(v < found for v in values), sum(v <= found for v in values)
        assert below - off <= p * len(values) <= to_here + off


def test_signal_from_monthly_states(spark, scratch, rows):
    feats = features.build_features(clean.clean_telemetry(telemetry_df(spark, rows), S), S).cache()
    for batch in range(2):
        part = feats.filter(F.pmod(F.xxhash64(*S.key), F.lit(2)) == batch)
        incremental.write_state(incremental.signal_sketches(part, S), f"{scratch}/s", batch)
    got = {(r.attribute_id, r.cohort): r for r in incremental.signal_from_sketches(incremental.read_state(spark, f"{scratch}/s"), S).collect()}
    want = {(r.attribute_id, r.cohort): r for r in reports.metric_failure_signal(feats, S).collect()}
    assert got.keys() == want.keys()
    for key, r in want.items():
        for c in ("row_count", "reported_share", "mean_zscore", "mean_trend_30d", "median_zscore", "p95_zscore"):  # few rows: the sketch is exact
            assert got[key][c] == (None if r[c] is None else pytest.approx(r[c], rel=1e-9, abs=1e-9)), (key, c)
    feats.unpersist()


def test_distinct_counts_roll_up(spark):
    rng = random.Random(6)
    data = [(f"E{rng.randrange(900)}", day(d)) for d in range(28) for _ in range(200)] + [(None, day(0))]
    df = spark.createDataFrame(data, "serial_number string, date date")
    week = [incremental.weekly(S)]
    want = {r.week: r.n for r in df.groupBy(*week).agg(F.count_distinct("serial_number").alias("n")).collect()}
    early, late = df.filter(F.col("date") < day(14)), df.filter(F.col("date") >= day(14))
    known = incremental.entity_numbers(early, "serial_number", buckets=8)
    numbers = incremental.entity_numbers(late, "serial_number", known, buckets=8)
    before, after = dict(map(tuple, known.collect())), dict(map(tuple, numbers.collect()))
    assert before.items() <= after.items() and len(set(after.values())) == len(after) == df.select("serial_number").na.drop().distinct().count()
    daily = incremental.distinct_bitmaps(early, ["date"], "serial_number", known).unionByName(
        incremental.distinct_bitmaps(late, ["date"], "serial_number", numbers)
    )
    assert {r.week: r.drive_count for r in incremental.distinct_from_bitmaps(daily, week).collect()} == want
    sketched = incremental.distinct_from_sketches(incremental.distinct_sketches(df, ["date"], "serial_number"), week)
    assert all(abs(r.drive_count - want[r.week]) <= 5 * incremental.distinct_error() * want[r.week] for r in sketched.collect())
