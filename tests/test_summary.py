"""Trade summary, daily summary and pivot."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickspark.operators.summary import (daily_trade_summary, pivot_by_date, pivot_by_date_native,
                                         trade_summary, vwap)
from tickspark.sources.fixtures import ticks_from_events

SF01 = "/root/testdata/sf0.01"


def test_trade_summary_expected_values(spark):
    got = {r.RIC: r for r in trade_summary(ticks_from_events(spark, SF01)).collect()}
    assert (got["AAA.L"].VWAP, got["AAA.L"].TWAP, got["AAA.L"].TotalVolume, got["AAA.L"].NumTrades) == \
        (50.604, 49.448, 19449, 820)
    assert (got["BBB.L"].VWAP, got["BBB.L"].TotalVolume, got["BBB.L"].NumTrades) == (49.689, 18029, 735)
    assert (got["CCC.L"].VWAP, got["CCC.L"].TotalVolume, got["CCC.L"].NumTrades) == (48.958, 19825, 807)


def test_vwap_between_min_and_max(spark):
    t = ticks_from_events(spark, SF01)
    s = trade_summary(t, order=False)
    from tickspark.functions.filters import regular_trades
    mm = regular_trades(t).groupBy("RIC").agg(F.min("Price").alias("lo"), F.max("Price").alias("hi"))
    for r in s.join(mm, "RIC").collect():
        assert r.lo - 1e-3 <= r.VWAP <= r.hi + 1e-3


def test_zero_volume_gives_null_vwap(spark):
    df = spark.createDataFrame([("A", 10.0, 0)], "RIC string, Price double, Volume long")
    assert df.groupBy("RIC").agg(vwap().alias("v")).first().v is None


def test_pivot_missing_date_is_null(spark):
    daily = daily_trade_summary(ticks_from_events(spark, SF01))
    p = pivot_by_date(daily, ["2024-01-17", "1999-01-01"]).collect()
    assert len(p) == 3
    assert all(r.VWAP_1999_01_01 is None and r.NumTrades_1999_01_01 is None for r in p)
    assert all(r.NumTrades_2024_01_17 > 0 for r in p)


def test_pivot_native_equals_conditional(spark):
    daily = daily_trade_summary(ticks_from_events(spark, SF01))
    a = pivot_by_date(daily, ["2024-01-17", "2024-01-16"])
    b = pivot_by_date_native(daily, ["2024-01-17", "2024-01-16"])
    assert sorted(a.collect()) == sorted(b.select(*a.columns).collect())


def test_summary_plan_is_partial_aggregate(spark):
    plan = trade_summary(ticks_from_events(spark, SF01))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
