"""Property tests: exact quantile and histogram against numpy on random data."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickspark.operators.quantile import exact_quantile
from tickspark.operators.risk import histogram

values = st.lists(st.one_of(st.integers(-50, 50).map(float),
                            st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
                  min_size=1, max_size=400)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, q=st.floats(0.0, 1.0), groups=st.integers(1, 3))
def test_exact_quantile_matches_numpy(spark, xs, q, groups):
    pdf = pd.DataFrame({"x": xs, "g": [i % groups for i in range(len(xs))]})
    df = spark.createDataFrame(pdf)
    # force several rounds of narrowing with tiny brackets
    with pytest.MonkeyPatch.context() as m:
        m.setattr("tickspark.operators.quantile.RANKED_ROWS", 3)
        got = {r.g: r.quantile for r in exact_quantile(df, "x", q, ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        want = np.percentile(part.x.to_numpy(), 100 * q) if q not in (0.0, 1.0) else (
            part.x.min() if q == 0.0 else part.x.max())
        assert got[g] == pytest.approx(want, rel=1e-9, abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(xs=values, bins=st.integers(1, 40))
def test_histogram_matches_numpy(spark, xs, bins):
    df = spark.createDataFrame(pd.DataFrame({"RETURN": xs}))
    h = histogram(df, bins).orderBy("bin").toPandas()
    counts, edges = np.histogram(np.array(xs), bins=bins)
    assert h["count"].tolist() == counts.tolist()
    assert np.allclose(h.bin_start.to_numpy(), edges[:-1], rtol=1e-12, atol=1e-9)


tick_rows = st.lists(
    st.tuples(st.integers(-5, 5),                      # Seq (ties and negatives)
              st.integers(0, 3),                       # day offset
              st.integers(0, 2),                       # second within the day (heavy ties)
              st.sampled_from(["A", "B"]),
              st.integers(1, 100).map(float),          # price
              st.integers(0, 3)),                      # volume (0 is filtered out)
    min_size=1, max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=tick_rows)
def test_daily_close_paths_match_brute_force(spark, rows):
    import datetime as dt
    from tickspark.operators.closes import daily_close
    from tickspark.schemas import TICKS
    q = "a;12------------[MMT_CLASS]"
    base = dt.datetime(2024, 1, 1)
    data = [(s, base + dt.timedelta(days=d, seconds=sec), r, p, v, "Trade", q) for s, d, sec, r, p, v in rows]
    df = spark.createDataFrame(data, TICKS)
    pdf = pd.DataFrame(data, columns=[f.name for f in TICKS.fields])
    pdf = pdf[pdf.Volume > 0]
    want = {}
    for (ric, day), g in pdf.groupby([pdf.RIC, pdf.Date_Time.dt.date]):
        for cols in (("Date_Time", "Seq"), ("Date_Time", "Seq", "Volume")):
            top = g.sort_values(list(cols), ascending=False).iloc[0]
            if len(g[(g[list(cols)] == top[list(cols)]).all(axis=1)]) == 1:   # unique winner
                want[(cols, ric, day)] = top.Price
    for cols in (("Date_Time", "Seq"), ("Date_Time", "Seq", "Volume")):
        got = {(r.RIC, r.Date): r.Price for r in daily_close(df, order_cols=cols).collect()}
        for (c, ric, day), price in want.items():
            if c == cols:
                assert got[(ric, day)] == price


closes_rows = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 14),
                                 st.integers(1, 50).map(float)),
                       min_size=2, max_size=40, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=closes_rows, order=st.permutations(["A", "B", "C"]))
def test_alignment_and_returns_match_the_definition(spark, rows, order):
    """First ticker fixes the calendar; a return needs this and the calendar's previous close, for all tickers."""
    import datetime as dt
    from tickspark.operators import risk as R
    from tickspark.operators.closes import align_closes, log_returns
    d0 = dt.date(2024, 1, 1)
    data = [(r, d0 + dt.timedelta(days=d), p) for r, d, p in rows]
    closes = spark.createDataFrame(data, "RIC string, Date date, Price double")
    tickers = list(order)
    price = {(r, d): p for r, d, p in data}
    days = sorted(d for r, d, _ in data if r == tickers[0])
    want = {}
    for before, day in zip(days, days[1:]):
        if all((t, d) in price for t in tickers for d in (before, day)):
            want[day] = [np.log(price[t, day] / price[t, before]) for t in tickers]
    got = log_returns(align_closes(closes, tickers), tickers).collect()
    assert {(r.Date, r.RIC) for r in got} == {(d, t) for d in want for t in tickers}
    for r in got:
        assert r.log_return == pytest.approx(want[r.Date][tickers.index(r.RIC)], rel=1e-12, abs=1e-15)
    m = R.portfolio_moments(log_returns(align_closes(closes, tickers), tickers),
                            R.equal_weights(spark, tickers)).first()
    assert m.n_days == len(want)
    if len(want) >= 2:
        daily = np.array(list(want.values())).mean(axis=1)
        assert m.portfolio_std == pytest.approx(float(daily.std(ddof=1)), rel=1e-9, abs=1e-12)
