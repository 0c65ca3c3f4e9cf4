"""Scale probe: the headline operators on tick tables derived from ``events``
at growing multiples (each event becomes ``m`` ticks, shifted by whole
days, new sequence numbers), and VaR on growing scenario counts.

Usage: python scripts/scale_probe.py [sf_dir] [multiples, comma separated]
Prints one line per (operator, size) with rows and seconds.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from tickspark.operators import risk as R  # noqa: E402
from tickspark.operators.bars import bid_bars  # noqa: E402
from tickspark.operators.closes import daily_close  # noqa: E402
from tickspark.operators.summary import trade_summary  # noqa: E402
from tickspark.session import get_spark  # noqa: E402
from tickspark.sources.fixtures import ticks_from_events  # noqa: E402


def scaled_ticks(spark, sf_dir, m):
    t = ticks_from_events(spark, sf_dir)
    k = F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("k")
    return (t.select("*", k)
             .select((F.col("Seq") * m + F.col("k")).alias("Seq"),
                     (F.col("Date_Time") + F.make_dt_interval(F.col("k") * 31)).alias("Date_Time"),
                     "RIC", "Price", "Volume", "Type", "Qualifiers"))


def timed(label, rows, make):
    """``make`` builds the DataFrame (operators may run eager passes while
    building); the time covers building and running it."""
    t0 = time.perf_counter()
    df = make() if callable(make) else make
    df.write.format("noop").mode("overwrite").save()
    print(f"{label:<24} {rows:>12,} rows  {time.perf_counter() - t0:7.2f} s", flush=True)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    mults = [int(x) for x in (sys.argv[2] if len(sys.argv) > 2 else "1,10,100").split(",")]
    spark = get_spark("local[8]", 8, extra={"spark.driver.memory": "16g"})
    base = spark.read.parquet(f"{sf}/events.parquet").count()
    for m in mults:
        t = scaled_ticks(spark, sf, m)
        n = base * m
        timed(f"trade_summary x{m}", n, trade_summary(t))
        timed(f"daily_close x{m}", n, daily_close(t))
        l2 = t.select(F.col("Date_Time").alias("date_time"), "RIC", F.col("Price").alias("L2_BidPrice"))
        timed(f"bid_bars_minute x{m}", n, bid_bars(l2, "MINUTE"))
    for n in (100_000, 1_000_000, 10_000_000, 100_000_000):
        scen = R.scenarios(spark, 0.0005, 0.01, n // 1000, tasks=1000, mode="randn", seed=1)
        timed("value_at_risk", n, lambda: R.value_at_risk(scen, q=0.01))


if __name__ == "__main__":
    main()
