"""Property tests on random small inputs (hypothesis)."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelsmith.operators.fill import forward_fill
from panelsmith.operators.quantiles import quantiles

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c"]),
        st.one_of(st.none(), st.integers(min_value=0, max_value=60)),
        st.one_of(st.none(), st.integers(min_value=-5, max_value=5).map(float)),
    ),
    min_size=1,
    max_size=60,
    unique_by=lambda r: (r[0], r[1]),
)


@SETTINGS
@given(rows_strategy, st.integers(min_value=1, max_value=20))
def test_bucketed_fill_equals_window(spark, rows, width):
    df = spark.createDataFrame(rows, "g string, t int, v double")
    a = forward_fill(df, ["v"], ["g"], ["t"], strategy="window")
    b = forward_fill(df, ["v"], ["g"], ["t"], strategy="bucketed", bucket=F.floor(F.col("t") / width))
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    c = forward_fill(df, ["v"], ["g"], ["t"], strategy="ranged")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, c.collect()), key=str)
    # the fill never changes an observed value
    obs = {(g, t): v for g, t, v in rows if v is not None}
    assert all(r.v == obs[(r.g, r.t)] for r in b.collect() if (r.g, r.t) in obs and (r.g, r.t) in {(g, t) for g, t, _ in rows})


def _disc(values, p):
    s = sorted(values)
    return s[max(1, math.ceil(len(s) * p - 1e-9)) - 1]


@SETTINGS
@given(
    st.lists(
        st.tuples(st.sampled_from(["x", "y"]), st.integers(min_value=0, max_value=30).map(float)),
        min_size=1,
        max_size=120,
    ),
    st.sampled_from([20, 100, 10000]),
)
def test_exact_quantiles_match_definition(spark, rows, accuracy):
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = {r.g: tuple(r[f"q{i}"] for i in range(len(probs)))
           for r in quantiles(df, "v", ["g"], probs, method="exact", accuracy=accuracy,
                              names=[f"q{i}" for i in range(len(probs))]).collect()}
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    want = {g: tuple(_disc(vs, p) for p in probs) for g, vs in groups.items()}
    assert got == want
