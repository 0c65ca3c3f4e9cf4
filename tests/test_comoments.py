"""Mergeable co-moments: day by day equals the whole, lists that grow, compaction."""

import datetime as dt

import numpy as np
import pytest

from tickspark.operators import comoments as M
from tickspark.operators import risk as R


def _returns(spark, k, n, shift, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 0.02, (n, k)) + shift
    x[rng.random((n, k)) < 0.2] = np.nan
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=3 * i) for i in range(n)]
    rows = [(f"T{j}", days[i], float(x[i, j])) for i in range(n) for j in range(k) if not np.isnan(x[i, j])]
    return x, days, spark.createDataFrame(rows, "RIC string, Date date, log_return double")


def _expected(x, k):
    out = {}
    for i in range(k):
        for j in range(k):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            out[f"T{i}", f"T{j}"] = np.cov(x[both, i], x[both, j])[0, 1] if both.sum() > 1 else None
    return out


def _got(df):
    return {(r.RIC_i, r.RIC_j): r.covariance for r in df.collect()}


@pytest.mark.parametrize("shift", [0.0, 1e5])
def test_day_by_day_equals_the_whole(spark, tmp_shared, monkeypatch, shift):
    monkeypatch.setattr(M, "BLOCK_TICKERS", 3)
    x, days, rets = _returns(spark, 5, 9, shift)
    names = [f"T{j}" for j in range(5)]
    for i, day in enumerate(days):
        M.add_comoments(rets.where(f"Date = '{day}'"), names, f"{tmp_shared}/m", f"{i:04d}")
    M.add_comoments(rets.where(f"Date = '{days[4]}'"), names, f"{tmp_shared}/m", "0004")        # a load that ran again
    got = _got(M.covariance_of(M.stored_comoments(spark, f"{tmp_shared}/m"), names))
    whole = _got(R.covariance(rets, names))
    for pair, want in _expected(x, 5).items():
        assert got[pair] == pytest.approx(want, rel=1e-5 if shift else 1e-10) == whole[pair]
    M.compact_comoments(spark, f"{tmp_shared}/m", names, f"{tmp_shared}/c", "all")
    again = _got(M.covariance_of(M.stored_comoments(spark, f"{tmp_shared}/c"), names))
    assert all(again[p] == pytest.approx(got[p], rel=1e-12) for p in got)


def test_a_list_that_grows(spark, tmp_shared, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_TICKERS", 2)
    x, days, rets = _returns(spark, 5, 12, 0.0)
    early = rets.where(f"Date < '{days[6]}' and RIC in ('T0', 'T1', 'T2')")
    M.add_comoments(early, ["T0", "T1", "T2"], f"{tmp_shared}/m", "1")
    names = [f"T{j}" for j in range(5)]
    M.add_comoments(rets.where(f"Date >= '{days[6]}'"), names, f"{tmp_shared}/m", "2")
    x[:6, 3:] = np.nan
    got = _got(M.covariance_of(M.stored_comoments(spark, f"{tmp_shared}/m"), names))
    for pair, want in _expected(x, 5).items():
        assert got[pair] == pytest.approx(want, rel=1e-10)


def test_no_returns(spark):
    _, _, rets = _returns(spark, 2, 3, 0.0)
    got = _got(R.covariance(rets.where("false"), ["T0", "T1"]))
    assert got == {(a, b): None for a in ("T0", "T1") for b in ("T0", "T1")}
