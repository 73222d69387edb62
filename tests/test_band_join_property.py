"""Randomised: the time-bucketed band join equals the brute-force pair scan."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from quarry.operators.joins import band_join_by_time

T0 = dt.datetime(2024, 1, 1)
EV = st.tuples(st.sampled_from(["u", "v", None]), st.integers(0, 600))   # key, minute


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=st.lists(EV, max_size=40), right=st.lists(EV, max_size=40),
       width_min=st.sampled_from([1, 30, 60, 90]))
def test_band_join_equals_brute_force(spark, left, right, width_min):
    lrows = [(i, k, T0 + dt.timedelta(minutes=m)) for i, (k, m) in enumerate(left)]
    rrows = [(j, k, T0 + dt.timedelta(minutes=m)) for j, (k, m) in enumerate(right)]
    ldf = spark.createDataFrame(lrows, "lid int, k string, lt timestamp_ntz")
    rdf = spark.createDataFrame(rrows, "rid int, k2 string, rt timestamp_ntz")
    got = sorted((r.lid, r.rid) for r in
                 band_join_by_time(ldf, rdf, "k", "k2", "lt", "rt", width_min * 60).collect())
    width = dt.timedelta(minutes=width_min)
    want = sorted((i, j) for i, k, lt in lrows for j, k2, rt in rrows
                  if k is not None and k == k2 and lt <= rt <= lt + width)
    assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(left=st.lists(EV, max_size=40), right=st.lists(EV, max_size=40))
def test_asof_join_equals_brute_force(spark, left, right):
    from quarry.operators.joins import asof_join
    lrows = [(i, k, T0 + dt.timedelta(minutes=m)) for i, (k, m) in enumerate(left)]
    rrows = [(j, k, T0 + dt.timedelta(minutes=m)) for j, (k, m) in enumerate(right)]
    ldf = spark.createDataFrame(lrows, "lid int, k string, lt timestamp_ntz")
    rdf = spark.createDataFrame(rrows, "rid int, k string, rt timestamp_ntz")
    got = {r.lid: r.rid for r in asof_join(ldf, rdf, "k", "lt", "rt", ["rid"]).collect()}
    want = {}
    for i, k, lt in lrows:
        cands = [(rt, j) for j, k2, rt in rrows if k is not None and k == k2 and rt <= lt]
        want[i] = max(cands)[1] if cands else None      # latest; ties -> highest id
    assert got == want
