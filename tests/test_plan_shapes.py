"""Plan checks over every registered query."""

import re

import pytest

import __spark_entry__ as E
from tickspark.plans.catalog import QUERIES

SF001 = "/root/testdata/sf0.001"
# Queries whose library path runs eager jobs or streams first; their final
# plans are still checked.
NAMES = sorted(QUERIES)
# Queries with code in Python workers: text generation, and matrix products of the covariance and of portfolios.
PYTHON = {"report_text", "report_text_sql", "report_text_raw", "covariance", "covariance_wide", "covariance_by_load",
          "portfolio_std", "portfolio_vars"}


def _groups(text: str) -> list[str]:
    """Top-level ``[...]`` groups of a plan line."""
    out, depth, start = [], 0, None
    for i, ch in enumerate(text):
        if ch == "[":
            if depth == 0:
                start = i + 1
            depth += 1
        elif ch == "]":
            depth -= 1
            if depth == 0:
                out.append(text[start:i])
    return out


def _windows_partitioned(physical: str) -> bool:
    for line in physical.splitlines():
        idx = line.find("Window [")
        if idx < 0 or "WindowGroupLimit" in line:
            continue
        # printed as ``Window [exprs], [partition], [order]``; an empty
        # partition list is omitted, leaving the order list second
        groups = _groups(line[idx + len("Window "):])
        if len(groups) < 2 or not groups[1].strip():
            return False
        if len(groups) == 2 and (" ASC" in groups[1] or " DESC" in groups[1]):
            return False
    return True


def _plan(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plan_shape(spark, name):
    plan = _plan(E.queries()[name](spark, SF001))
    # no row-at-a-time Python UDFs anywhere
    assert "BatchEvalPython" not in plan
    # no cartesian products or nested-loop joins
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # every window is partitioned by a key
    assert _windows_partitioned(plan)


def test_window_check_detects_unpartitioned(spark):
    from pyspark.sql import Window, functions as F
    bad = spark.range(10).withColumn("l", F.lag("id").over(Window.orderBy("id")))
    good = spark.range(10).withColumn("l", F.lag("id").over(Window.partitionBy(F.col("id") % 2).orderBy("id")))
    assert not _windows_partitioned(_plan(bad))
    assert _windows_partitioned(_plan(good))


def test_python_only_where_expected(spark):
    for name in NAMES:
        plan = _plan(E.queries()[name](spark, SF001))
        uses_python = any(x in plan for x in ("MapInPandas", "MapInArrow", "ArrowEvalPython", "GroupsInPandas"))
        assert uses_python == (name in PYTHON), name


def test_jobs_read_only_the_days_of_their_range(spark, tmp_path):
    """Day folders are pruned through run_var, run_report and the readers."""
    import datetime as dt

    from tickspark.operators.report import EchoClient
    from tickspark.plans.report_job import run_report
    from tickspark.plans.var_job import run_var
    from tickspark.sources.fixtures import ticks_from_events
    from tickspark.sources.tables import read_ticks, write_ticks
    path = str(tmp_path / "days")
    write_ticks(ticks_from_events(spark, SF001), path)
    ticks = read_ticks(spark, path)
    rics, day = ["AAA.L", "BBB.L"], ("2024-01-15 00:00:00", "2024-01-16 23:59:59")

    def pruned(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        found = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
        return bool(found) and all("trade_date" in f for f in found)

    report = run_report(ticks, rics, *day, "2024-01-15", "2024-01-16", EchoClient, trade_date_col="trade_date")
    assert pruned(report.daily) and pruned(report.generated)
    run = run_var(spark, ticks, rics, dt.datetime(2024, 1, 20), years=1, n=10, mode="lcg", trade_date_col="trade_date")
    assert pruned(run.closes) and pruned(run.returns) and pruned(run.moments)
    assert pruned(read_ticks(spark, path, *day, trade_date_col="trade_date"))


def test_trade_scan_is_pruned(spark):
    plan = E.queries()["vwap_summary_full"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"ReadSchema: struct<([^>]*)>", E.queries()["vwap_summary_full"](spark, SF001)
                       ._jdf.queryExecution().explainString(
                           spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    assert schema is not None
    cols = {c.split(":")[0] for c in schema.group(1).split(",")}
    assert "props" not in cols  # unused columns are not read
    assert "partial_sum" in plan


def test_weights_join_is_broadcast(spark):
    from tickspark.operators import risk as R
    from tickspark.operators.closes import align_closes, log_returns
    from tickspark.sources.fixtures import daily_close_from_lineitem
    tickers = ["Brand#1", "Brand#2", "Brand#3"]
    rets = log_returns(align_closes(daily_close_from_lineitem(spark, SF001), tickers), tickers)
    plan = _plan(R.portfolio_moments(rets, R.equal_weights(spark, tickers)))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
