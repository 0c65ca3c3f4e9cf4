"""Many portfolios in one job, the ledger of loaded files, bars from a stream."""

import datetime as dt
import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.operators import portfolios as P
from tickspark.operators import risk as R
from tickspark.operators.bars import bid_bars
from tickspark.schemas import SCENARIO_COLUMNS
from tickspark.sources import files as FS
from tickspark.streaming.bar_lattice import compact_lattice, lattice_bars, stream_bars


# ---- portfolios ------------------------------------------------------------------

def _returns(spark, k=6, n=40):
    rng = np.random.default_rng(2)
    x = rng.normal(0.001, 0.02, (n, k))
    x[rng.random((n, k)) < 0.15] = np.nan
    days = [dt.date(2021, 1, 1) + dt.timedelta(days=11 * i) for i in range(n)]
    rows = [(f"T{j}", days[i], None if np.isnan(x[i, j]) else float(x[i, j])) for i in range(n) for j in range(k)]
    return x, spark.createDataFrame(rows, "RIC string, Date date, log_return double")


def test_moments_of_many_portfolios(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK_PORTFOLIOS", 3)
    monkeypatch.setattr(P, "CHUNK_DAYS", 50)
    x, rets = _returns(spark)
    held = {f"P{p}": {f"T{j}": float(1 + (p * j) % 5) for j in range(6) if (p >> j) & 1} for p in range(1, 40)}
    held["absent"] = {"T0": 0.5, "nobody": 0.5}
    weights = spark.createDataFrame([(p, t, w) for p, ts in held.items() for t, w in ts.items()] + [("P1", "T0", 2.0)],
                                    "PORTFOLIO string, RIC string, weight double")
    held["P1"]["T0"] += 2.0                                      # named twice: the weights add up
    got = {r.PORTFOLIO: r for r in P.portfolio_moments_all(rets, weights).collect()}
    assert got.keys() == held.keys() and got["absent"].n_days == 0 and got["absent"].expected_return is None
    for p, ts in held.items():
        if p != "absent":
            daily = sum(w * x[:, int(t[1:])] for t, w in ts.items())
            daily = daily[~np.isnan(daily)]
            assert got[p].n_days == len(daily)
            assert got[p].expected_return == pytest.approx(daily.mean(), rel=1e-9)
            assert got[p].portfolio_std == pytest.approx(daily.std(ddof=1), rel=1e-9)


def test_vars_of_many_portfolios_equal_one_by_one(spark):
    moments = spark.createDataFrame([("a", 9, 0.001, 0.02), ("b", 9, -0.01, 0.0), ("c", 1, 0.01, None)],
                                    "PORTFOLIO string, n_days long, expected_return double, portfolio_std double")
    got = {r.PORTFOLIO: (r.n, r.VaR) for r in P.portfolio_vars(moments, 5000, days=10, q=0.02).collect()}
    for p, mu, sigma in (("a", 0.001, 0.02), ("b", -0.01, 0.0)):
        one = R.value_at_risk(R.scenarios(spark, mu, sigma, 5000, days=10, mode="lcg"), q=0.02).first()
        assert got[p] == (one.n, pytest.approx(one.VaR, rel=1e-9))
    assert got["c"] == (5000, None)


# ---- ledger ------------------------------------------------------------------------

def _scen(spark, batch, n):
    return R.scenarios(spark, 0.001, 0.02, n, mode="lcg", batch=batch, start_date="2004-02-05", end_date="2024-01-31")


def _count(df):
    return {r.BATCH: r["count"] for r in df.groupBy("BATCH").count().collect()}


def test_each_file_is_loaded_once(spark, tmp_shared):
    csv, table = f"{tmp_shared}/csv", f"{tmp_shared}/table"
    assert FS.read_loaded(spark, table).count() == 0
    FS.write_scenarios_csv(_scen(spark, "007", 30), csv)
    first = FS.load_new_scenarios(spark, csv, table)
    assert first.columns == SCENARIO_COLUMNS and _count(first) == {"007": 30}
    assert _count(FS.load_new_scenarios(spark, csv, table)) == {"007": 30}
    FS.write_scenarios_csv(_scen(spark, "B", 20), csv)
    FS.write_scenarios_csv(_scen(spark, "007", 5), csv)
    assert _count(FS.load_new_scenarios(spark, csv, table)) == {"007": 35, "B": 20}
    assert FS.load_ledger(spark, table).select("LOAD").distinct().count() == 2


@pytest.mark.parametrize("at", ["rows", "ledger"])
def test_a_load_that_failed_leaves_nothing_twice(spark, tmp_shared, at):
    csv, table = f"{tmp_shared}/csv", f"{tmp_shared}/table"
    FS.write_scenarios_csv(_scen(spark, "A", 10), csv)
    FS.load_new_scenarios(spark, csv, table)
    FS.write_scenarios_csv(_scen(spark, "B", 20), csv)
    before = set(os.listdir(table)), set(os.listdir(f"{table}_ledger"))
    FS.load_new_scenarios(spark, csv, table)
    # undo the end of the second load: its ledger entry, and half of its rows
    shutil.copytree(f"{table}_ledger", f"{tmp_shared}/kept")
    for f in set(os.listdir(f"{table}_ledger")) - before[1]:
        os.remove(f"{table}_ledger/{f}")
    if at == "rows":
        load = (set(os.listdir(table)) - before[0]).pop()
        part = next(f for f in os.listdir(f"{table}/{load}") if f.startswith("part"))
        os.remove(f"{table}/{load}/{part}")
    assert _count(FS.read_loaded(spark, table)) == {"A": 10}
    FS.write_scenarios_csv(_scen(spark, "C", 5), csv)              # more has come before it runs again
    assert _count(FS.load_new_scenarios(spark, csv, table)) == {"A": 10, "B": 20, "C": 5}


def test_a_bad_file_fails_the_load_and_stays_new(spark, tmp_shared):
    csv, table = f"{tmp_shared}/csv", f"{tmp_shared}/table"
    FS.write_scenarios_csv(_scen(spark, "A", 10), csv)
    os.makedirs(f"{csv}/BATCH=X")
    with open(f"{csv}/BATCH=X/bad.csv", "w") as f:
        f.write("VENUE,PORTFOLIO,PORTFOLIO_VALUE,START_DATE,END_DATE,DAYS,RETURN,SCENARIO_ID\nLSE,A,no number,,,1,2.0,1\n")
    with pytest.raises(Exception):
        FS.load_new_scenarios(spark, csv, table)
    assert FS.read_loaded(spark, table).count() == 0
    os.remove(f"{csv}/BATCH=X/bad.csv")
    assert _count(FS.load_new_scenarios(spark, csv, table)) == {"A": 10}


# ---- bars ------------------------------------------------------------------------------

def test_late_quotes_change_their_own_bars_only(spark, tmp_shared):
    src, lattice, ckpt = (f"{tmp_shared}/{n}" for n in ("quotes", "lattice", "ckpt"))
    t = dt.datetime(2024, 1, 2, 10, 0)
    at = lambda **d: t + dt.timedelta(**d)
    schema = "date_time timestamp_ntz, RIC string, L2_BidPrice double"
    deliveries = [[(at(), "A", 1.0), (at(seconds=59), "A", 3.0), (at(days=1), "A", 5.0), (None, "A", 9.0)],
                  [(at(seconds=30), "A", 7.0), (at(minutes=1), "A", None), (at(), "B", 2.0)],        # a day late
                  [(at(seconds=30), "A", 7.0), (at(hours=1), None, 4.0)]]                              # a copy
    for rows in deliveries:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        stream_bars(spark, spark.readStream.schema(schema).parquet(src), lattice, ckpt)
    second = f"{lattice}/DAY=2024-01-03"
    assert len(os.listdir(second)) == 1                            # untouched by the later deliveries
    whole = spark.createDataFrame([r for rows in deliveries for r in rows if r[0] is not None], schema)
    compact_lattice(spark, lattice, f"{lattice}-c")
    for unit in ("MINUTE", "HOUR", "DAY"):
        want = sorted(map(repr, map(tuple, bid_bars(whole, unit).collect())))
        for path in (lattice, f"{lattice}-c"):
            assert sorted(map(repr, map(tuple, lattice_bars(spark, path, unit).collect()))) == want
    part = lattice_bars(spark, lattice, "DAY", "2024-01-03 00:00:00", "2024-01-03 23:59:59", ["A"])
    assert [tuple(r) for r in part.collect()] == [("A", dt.datetime(2024, 1, 3), 5.0, 5.0)]
    assert "PartitionFilters: [isnotnull(DAY" in part._jdf.queryExecution().executedPlan().toString()
