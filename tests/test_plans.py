"""End-to-end VaR job, chart data and table-name scans."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.operators import risk as R
from tickspark.plans.var_job import chart_series, history_range, run_var
from tickspark.sources.files import load_scenarios, write_scenarios_csv
from tickspark.sources.fixtures import daily_close_from_lineitem, ticks_from_events
from tickspark.sources.tables import read_daily_close, read_l2, read_ticks

SF01 = "/root/testdata/sf0.01"
PORTFOLIO = ["AAA.L", "BBB.L", "CCC.L"]


def test_history_range_uses_365_day_years():
    start, end = history_range(dt.datetime(2024, 1, 31), 20)
    assert end == "2024-01-31 00:00:00.000000"
    assert start == (dt.datetime(2024, 1, 31) - dt.timedelta(days=7300)).strftime("%Y-%m-%d %H:%M:%S.%f")


def test_run_var_end_to_end_with_csv_sink(spark, tmp_shared):
    out = f"{tmp_shared}/scen"
    run = run_var(spark, ticks_from_events(spark, SF01), PORTFOLIO, dt.datetime(2024, 1, 31),
                  years=20, days=20, n=2_000, tasks=3, mode="lcg", batch="job-1",
                  sink=lambda df: write_scenarios_csv(df, out))
    assert round(run.mu, 10) == -0.0286042229 and round(run.sigma, 10) == 1.0889761367
    stored = load_scenarios(spark, out, f"{tmp_shared}/table")
    assert stored.count() == 6_000
    assert {r.PORTFOLIO for r in stored.select("PORTFOLIO").distinct().collect()} == {"AAA.L,BBB.L,CCC.L"}
    gains = np.array([r.RETURN for r in run.scenarios.collect()])
    var = run.var.first()
    assert var.n == 6_000 and var.VaR == pytest.approx(-np.percentile(gains, 1.0), rel=1e-9)
    # the stored table gives the same VaR per batch
    stored_var = R.value_at_risk(stored, by=["BATCH"], q=0.01).first()
    assert stored_var.BATCH == "job-1" and stored_var.VaR == pytest.approx(var.VaR, rel=1e-9)
    charts = chart_series(run, bins=50, ticks=ticks_from_events(spark, SF01), symbol="BBB.L")
    h = charts["histogram"].collect()
    assert len(h) == 50 and sum(r["count"] for r in h) == 6_000
    series = charts["series"].collect()
    assert len(series) == 30 and [r.Date for r in series] == sorted(r.Date for r in series)


def test_run_var_from_close_table(spark, tmp_shared):
    path = f"{tmp_shared}/closes"
    daily_close_from_lineitem(spark, SF01).write.parquet(path)
    closes = read_daily_close(spark, path)
    run = run_var(spark, None, ["Brand#1", "Brand#2", "Brand#3"], dt.datetime(2001, 1, 1), years=10,
                  n=1_000, mode="lcg", closes=closes)
    assert round(run.mu, 10) == -0.0056316446 and round(run.sigma, 10) == 0.5598135090


def test_scan_by_table_names(spark):
    ticks = ticks_from_events(spark, SF01)
    ticks.createOrReplaceTempView("lse_ticks")
    ticks.createOrReplaceGlobalTempView("lse_ticks_g")
    a = read_ticks(spark, "lse_ticks", "2024-01-05 00:00:00", "2024-01-05 23:59:59", rics=["AAA.L"])
    b = read_ticks(spark, "global_temp.lse_ticks_g", "2024-01-05 00:00:00", "2024-01-05 23:59:59",
                   rics=["AAA.L"])
    assert a.count() == b.count() > 0
    assert {r.RIC for r in a.select("RIC").distinct().collect()} == {"AAA.L"}
    l2 = ticks.select(F.col("Date_Time").alias("date_time"), "RIC", F.col("Price").alias("L2_BidPrice"))
    assert read_l2(spark, l2, "2024-01-05 00:00:00", "2024-01-05 23:59:59").count() == \
        ticks.where(F.col("Date_Time").between("2024-01-05 00:00:00", "2024-01-05 23:59:59")).count()


def test_partitioned_ticks_prune_days(spark, tmp_shared):
    from tickspark.operators.summary import trade_summary
    from tickspark.sources.tables import write_ticks
    path = f"{tmp_shared}/ticks"
    ticks = ticks_from_events(spark, SF01)
    write_ticks(ticks, path)
    stored = spark.read.parquet(path)
    rng = ("2024-01-10 00:00:00", "2024-01-11 23:59:59.999999")
    pruned = read_ticks(spark, stored, *rng, rics=["AAA.L", "BBB.L"], trade_date_col="trade_date")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan or "PartitionFilters: [" in plan
    assert "trade_date" in plan.split("PartitionFilters:")[1].split("]")[0]
    a = sorted(trade_summary(pruned).collect())
    b = sorted(trade_summary(read_ticks(spark, ticks, *rng, rics=["AAA.L", "BBB.L"])).collect())
    assert a == b and len(a) == 2


def test_submit_entry_runs_job(spark, tmp_shared):
    from tickspark.plans.submit import main
    ticks_path = f"{tmp_shared}/ticks_src"
    ticks_from_events(spark, SF01).write.parquet(ticks_path)
    out = main(["--ticks", ticks_path, "--tickers", "AAA.L,BBB.L,CCC.L", "--as-of", "2024-01-31T00:00:00",
                "--simulations-per-task", "1000", "--tasks", "2", "--mode", "lcg", "--batch", "b7",
                "--sink", "table", "--out", f"{tmp_shared}/returns"], spark=spark)
    assert round(out["sigma"], 10) == 1.0889761367 and out["scenarios"] == 2000
    stored = spark.read.parquet(f"{tmp_shared}/returns")
    assert stored.count() == 2000 and {r.BATCH for r in stored.select("BATCH").distinct().collect()} == {"b7"}


def test_adjusted_close_files_per_ticker(spark, tmp_shared):
    """One CSV file per ticker (ticker = file name), as a downloaded close series."""
    import os
    from tickspark.sources.tables import read_adjusted_close_csv
    closes = daily_close_from_lineitem(spark, SF01).where(F.col("RIC").isin("Brand#1", "Brand#2", "Brand#3"))
    folder = f"{tmp_shared}/prices"
    os.makedirs(folder)
    pdf = closes.toPandas()
    for ric, g in pdf.groupby("RIC"):
        out = g.sort_values("Date").rename(columns={"Price": "Adj Close"})
        out["Open"] = out["Adj Close"]
        out[["Date", "Open", "Adj Close"]].to_csv(f"{folder}/{ric}.csv", index=False)
    back = read_adjusted_close_csv(spark, folder)
    assert sorted(back.collect()) == sorted(closes.select("RIC", "Date", "Price").collect())
    run = run_var(spark, None, ["Brand#1", "Brand#2", "Brand#3"], dt.datetime(2001, 1, 1), years=10,
                  n=1_000, mode="lcg", closes=back)
    assert round(run.mu, 10) == -0.0056316446 and round(run.sigma, 10) == 0.5598135090


def test_bucketed_ticks_need_no_shuffle(spark):
    from tickspark.operators.closes import daily_close
    from tickspark.operators.summary import daily_trade_summary
    from tickspark.sources.tables import write_bucketed_ticks
    ticks = ticks_from_events(spark, SF01)
    write_bucketed_ticks(ticks, "tickspark_test_bucketed", 8)
    t = spark.table("tickspark_test_bucketed")
    for a, b in ((daily_close(t, trade_date_col="trade_date"), daily_close(ticks)),
                 (daily_trade_summary(t, trade_date_col="trade_date"), daily_trade_summary(ticks))):
        assert "Exchange" not in a._jdf.queryExecution().executedPlan().toString()
        assert sorted(a.collect()) == sorted(b.collect())
    spark.sql("DROP TABLE tickspark_test_bucketed")


def test_write_ticks_splits_a_hot_instrument_day(spark, tmp_shared):
    import os
    from tickspark.sources.tables import write_ticks
    ticks = ticks_from_events(spark, SF01).where("Date_Time < '2024-01-02'")       # one day
    hot = ticks.withColumn("RIC", F.when(F.col("Seq") % 10 < 8, F.lit("HOT.L")).otherwise(F.col("RIC")))
    path = f"{tmp_shared}/hot"
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ticks(hot, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    day = [d for d in os.listdir(path) if d.startswith("trade_date=")]
    files = [f for f in os.listdir(f"{path}/{day[0]}") if f.endswith(".parquet")]
    assert len(day) == 1 and len(files) > 1
    stored = spark.read.parquet(path)
    hot_files = stored.where("RIC = 'HOT.L'").select(F.input_file_name()).distinct().count()
    assert hot_files > 1                                    # the hot instrument-day is split by time
    assert stored.count() == hot.count()
