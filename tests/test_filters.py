"""Trade filter edge cases (qualifier shapes, null / zero values, range ends)."""

import datetime as dt

from pyspark.sql import functions as F

from tickspark.functions.filters import market_model_flags, regular_trades
from tickspark.schemas import TICKS

T0 = dt.datetime(2024, 1, 2, 12, 0, 0)


def _ticks(spark, rows):
    full = [(i, r.get("ts", T0), r.get("ric", "A.L"), r.get("price", 10.0), r.get("volume", 5),
             r.get("type", "Trade"), r.get("q", "a;12------------[MMT_CLASS]")) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, TICKS)


def test_qualifier_shapes(spark):
    rows = [
        {"q": "a;x[MMT_CLASS];12------------[MMT_CLASS]"},  # two marks: greedy to the last -> kept
        {"q": "a;12[MMT_CLASS]"},                            # short flags, starts with 12 -> kept
        {"q": "12------------[MMT_CLASS]"},                  # no ';' -> dropped
        {"q": None},                                         # null -> dropped
        {"q": "a;32------------[MMT_CLASS]"},                # wrong class -> dropped
        {"q": "a;12PPPPPPPPPPPP"},                           # no class mark -> dropped
    ]
    kept = sorted(r.Seq for r in regular_trades(_ticks(spark, rows)).collect())
    assert kept == [0, 1]


def test_flags_are_last_fourteen(spark):
    df = spark.createDataFrame([("x;AB12345678901234[MMT_CLASS]",)], "q string")
    assert df.select(market_model_flags("q").alias("f")).first().f == "12345678901234"


def test_value_filters(spark):
    rows = [{"volume": 0}, {"price": 0.0}, {"price": None}, {"type": "Quote"}, {}]
    assert [r.Seq for r in regular_trades(_ticks(spark, rows)).collect()] == [4]


def test_range_is_inclusive(spark):
    start, end = "2024-01-02 12:00:00", "2024-01-02 12:59:59.999999"
    rows = [{"ts": dt.datetime(2024, 1, 2, 12, 0, 0)},
            {"ts": dt.datetime(2024, 1, 2, 12, 59, 59, 999999)},
            {"ts": dt.datetime(2024, 1, 2, 13, 0, 0)}]
    got = sorted(r.Seq for r in regular_trades(_ticks(spark, rows), start, end).collect())
    assert got == [0, 1]


def test_instrument_list_and_single(spark):
    rows = [{"ric": "A.L"}, {"ric": "B.L"}, {"ric": "C.L"}]
    t = _ticks(spark, rows)
    assert sorted(r.RIC for r in regular_trades(t, rics=["A.L", "C.L"]).collect()) == ["A.L", "C.L"]
    assert [r.RIC for r in regular_trades(t, rics="B.L").collect()] == ["B.L"]


def test_time_filter_pushed_to_scan(spark):
    from tickspark.sources.fixtures import ticks_from_events
    df = regular_trades(ticks_from_events(spark, "/root/testdata/sf0.001"),
                        "2024-01-05 00:00:00", "2024-01-06 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(ts" in plan


def test_instrument_universe_as_dataframe(spark):
    from tickspark.operators.summary import trade_summary
    from tickspark.sources.fixtures import ticks_from_events
    t = ticks_from_events(spark, "/root/testdata/sf0.01")
    universe = spark.createDataFrame([("AAA.L",), ("CCC.L",), ("ZZZ.L",)], "RIC string")
    a = sorted(trade_summary(t, rics=universe).collect())
    b = sorted(trade_summary(t, rics=["AAA.L", "CCC.L", "ZZZ.L"]).collect())
    assert a == b and [r.RIC for r in a] == ["AAA.L", "CCC.L"]
    plan = trade_summary(t, rics=universe, order=False)._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
