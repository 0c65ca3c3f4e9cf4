"""``spark-submit`` entry for the VaR job.

The job's parameters (horizon days, history years, scenarios per task,
tasks, tickers) are command-line arguments; the batch id comes from the
argument or, when absent, a fresh UUID.  The session comes from
``spark-submit`` (cluster conf untouched); the sink writes to shared
storage (CSV folders, a Parquet table, or a Kafka topic / message files).

    spark-submit -m tickspark.plans.submit --ticks lse.ticks --tickers VOD.L,ULVR.L \\
        --days 20 --years 20 --simulations-per-task 10000 --tasks 1000 \\
        --sink table --out s3://bucket/var/returns
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from tickspark.plans.var_job import run_var
from tickspark.sources.files import append_scenarios, write_scenarios_csv
from tickspark.sources.messages import write_scenario_messages
from tickspark.sources.tables import read_daily_close, read_table


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="Monte Carlo Value at Risk on Spark")
    p.add_argument("--ticks", help="tick table name or path")
    p.add_argument("--trade-date-col", help="the ticks' day column, if they are partitioned by day")
    p.add_argument("--closes", help="daily close table name or path (instead of --ticks)")
    p.add_argument("--tickers", required=True, help="comma-separated instruments; the first fixes the calendar")
    p.add_argument("--days", type=int, default=20)
    p.add_argument("--years", type=int, default=20)
    p.add_argument("--simulations-per-task", type=int, default=10_000)
    p.add_argument("--tasks", type=int, default=1)
    p.add_argument("--portfolio-value", type=float, default=1_000_000.0)
    p.add_argument("--confidence", type=float, default=0.99)
    p.add_argument("--as-of", help="end of the history, ISO timestamp (default: now, UTC)")
    p.add_argument("--mode", choices=("randn", "lcg"), default="randn")
    p.add_argument("--seed", type=int)
    p.add_argument("--batch")
    p.add_argument("--venue", default="LSE")
    p.add_argument("--sink", choices=("none", "csv", "table", "messages"), default="none")
    p.add_argument("--out", help="sink path")
    p.add_argument("--kafka", help="JSON object of Kafka writer options (messages sink)")
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None) -> dict:
    a = parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    as_of = dt.datetime.fromisoformat(a.as_of) if a.as_of else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    sinks = {
        "none": None,
        "csv": lambda df: write_scenarios_csv(df, a.out),
        "table": lambda df: append_scenarios(df, a.out),
        "messages": lambda df: write_scenario_messages(
            df, a.out, kafka_options=json.loads(a.kafka) if a.kafka else None),
    }
    ticks = read_table(spark, a.ticks) if a.ticks else None
    closes = read_daily_close(spark, a.closes) if a.closes else None
    run = run_var(spark, ticks, a.tickers.split(","), as_of, years=a.years, days=a.days,
                  n=a.simulations_per_task, tasks=a.tasks, portfolio_value=a.portfolio_value,
                  confidence=a.confidence, mode=a.mode, seed=a.seed, batch=a.batch, venue=a.venue,
                  closes=closes, trade_date_col=a.trade_date_col, sink=sinks[a.sink])
    var = run.var.first()
    result = {"batch": run.batch, "mu": run.mu, "sigma": run.sigma, "scenarios": var["n"] if var else 0,
              "VaR": var["VaR"] if var else None, "start_date": run.start_date, "end_date": run.end_date}
    print(json.dumps(result))
    return result


if __name__ == "__main__":
    main()
