"""Windows by time against a plain loop over each series."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import series as S

START = dt.datetime(2016, 1, 1)
ROWS = st.lists(st.tuples(st.sampled_from(["a", "a", "b", None]), st.one_of(st.none(), st.integers(-3000, 3000)), st.one_of(st.none(), st.integers(0, 9))), max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, span=st.sampled_from(["15 minutes", "3 hours", "2 days"]), chunk=st.sampled_from([0.01, 0.5, 28]))
def test_sparse_series(spark, rows, span, chunk):
    data = [(n, k, None if m is None else START + dt.timedelta(minutes=m), v) for n, (k, m, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "n long, k string, t timestamp_ntz, v long")
    exprs = [S.span_expr(F.sum, "v", span, "s"), S.span_expr(F.count, "v", span, "c"), S.span_expr(F.max, "v", "1 minute", "m")]
    got = {r.n: (r.s, r.c, r.m) for r in S.over_time(df, ["k"], "t", exprs, chunk).collect()}
    micros = S.tc.width_seconds(span) * 1_000_000
    assert len(got) == len(rows)
    for n, (k, m, _) in enumerate(rows):
        if m is None:
            assert got[n] == (None, None, None)
            continue
        near = [v for k2, m2, v in rows if k2 == k and m2 is not None and v is not None and 0 <= (m - m2) * 60_000_000 < micros]
        now = [v for k2, m2, v in rows if k2 == k and m2 == m and v is not None]
        assert got[n] == (sum(near) if near else None, len(near), max(now) if now else None)


def test_hot_series_is_split_and_extra_columns_stay(spark):
    df = spark.range(3000).select(F.lit("hot").alias("k"), (F.lit(START) + F.make_dt_interval(mins=F.col("id") * 15)).alias("t"), F.col("id").alias("v"), F.lit("x").alias("__tm_note"))
    out = S.over_time(df, ["k"], "t", [S.span_expr(F.avg, "v", "1 hour", "a")], 0.5)
    assert out.columns == ["k", "t", "v", "__tm_note", "a"]
    assert all(math.isclose(r.a, r.v - 1.5) for r in out.where("v >= 3").collect())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "__tm_chunk" in plan and plan.count("Exchange hashpartitioning") == 1
