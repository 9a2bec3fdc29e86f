"""Distributed algorithms against brute force on random inputs (hypothesis)."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetsight.operators import clean
from fleetsight.operators.reports import exact_percentiles
from helpers import day, telemetry_df, telemetry_row

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def brute_percentile(values, p):
    s = sorted(values)
    return s[max(0, math.ceil(p * len(s)) - 1)]


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(["a", "b", "hot"]), st.integers(-50, 50)), min_size=1, max_size=300),
    st.integers(1, 9),
)
def test_sliced_percentiles_equal_brute_force(spark, rows, slices):
    # one group gets many extra rows so it spans several slices
    rows = rows + [("hot", v) for v in range(-20, 20)] * 3
    df = spark.createDataFrame([(g, float(v)) for g, v in rows], "g string, v double")
    got = {r.g: (r.p50, r.p95, r.p0) for r in exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p95": 0.95, "p0": 0.0}, slices).collect()}
    frame = pd.DataFrame(rows, columns=["g", "v"])
    for g, part in frame.groupby("g"):
        vals = [float(v) for v in part["v"]]
        assert got[g] == (brute_percentile(vals, 0.5), brute_percentile(vals, 0.95), brute_percentile(vals, 0.0))


@SETTINGS
@given(
    st.lists(
        st.tuples(st.integers(0, 3), st.integers(0, 2), st.sampled_from(["A", "B"]), st.integers(0, 1), st.one_of(st.none(), st.integers(0, 9))),
        min_size=1,
        max_size=60,
    )
)
def test_dedup_and_zscores_equal_brute_force(spark, rows):
    data = [telemetry_row(f"S{s}", day(d), model=m, failure=f, smart_5_raw=x) for s, d, m, f, x in rows]
    out = clean.add_group_zscores(clean.deduplicate_entity_days(telemetry_df(spark, data))).toPandas()
    # brute force: per (serial, date) keep the largest (failure, reading[NULL lowest], model)
    frame = pd.DataFrame(rows, columns=["s", "d", "m", "f", "x"])
    frame["xk"] = frame["x"].astype("float").fillna(-1)
    kept = frame.sort_values(["f", "xk", "m"], ascending=False).groupby(["s", "d"]).head(1)
    assert len(out) == len(kept)
    stats = kept.groupby("m")["x"].agg(["mean", "std"])
    for _, r in kept.iterrows():
        got = out[(out.serial_number == f"S{r.s}") & (out.date == day(r.d))].iloc[0]
        assert got.model == r.m and got.failure == r.f
        if pd.isna(r.x):
            assert pd.isna(got.smart_5_raw_model_zscore)
            continue
        mean, sd = stats.loc[r.m, "mean"], stats.loc[r.m, "std"]
        want = (r.x - mean) / sd if (not pd.isna(sd) and sd > 0) else 0.0
        assert math.isclose(got.smart_5_raw_model_zscore, want, rel_tol=1e-9, abs_tol=1e-9)
