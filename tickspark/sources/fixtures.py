"""Market-shaped views derived from the driver's test tables.

The test tables hold no market data, so these views map them onto the
tick, quote, close and job-history schemas.  Each view is a pure
projection / aggregation of a given table, so its size grows with the
table.  The matching DuckDB text lives in ``tickspark.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ric_of_user(user_id) -> F.Column:
    m = F.col(user_id) % 3
    return F.when(m == 0, "AAA.L").when(m == 1, "BBB.L").otherwise("CCC.L")


# Fixed values of the fixture qualifier strings: one with no ';', one
# regular, one with a non-regular class, one with two marks.
QUALIFIER_SHAPES = [
    "no qualifiers",
    "U[ACT];12PPPPPPPPPPPP",
    "A[X];32------------[MMT_CLASS]",
    "A[X];B[Y];12-------P----[MMT_CLASS];Z[W]",
]


def ticks_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ticks(Seq, Date_Time, RIC, Price, Volume, Type, Qualifiers)`` from ``events``."""
    ev = _read(spark, sf_dir, "events")
    q = F.col("event_id") % 5
    qualifiers = (F.when(q == 0, QUALIFIER_SHAPES[0]).when(q == 1, QUALIFIER_SHAPES[1])
                  .when(q == 2, QUALIFIER_SHAPES[2]).otherwise(QUALIFIER_SHAPES[3]))
    return ev.select(
        F.col("event_id").alias("Seq"),
        F.col("ts").alias("Date_Time"),
        _ric_of_user("user_id").alias("RIC"),
        F.col("value").alias("Price"),
        (F.col("event_id") % 49).alias("Volume"),
        F.when(F.col("event_type").isin("purchase", "click", "view"), "Trade")
         .otherwise("Quote").alias("Type"),
        qualifiers.alias("Qualifiers"),
    )


def l2_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l2_quotes(date_time, RIC, L2_BidPrice)`` from ``events``."""
    ev = _read(spark, sf_dir, "events")
    return ev.select(F.col("ts").alias("date_time"), _ric_of_user("user_id").alias("RIC"),
                     F.col("value").alias("L2_BidPrice"))


def _lineitem_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    part = _read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    # part is a dimension keyed by p_partkey; the planner picks the join
    # (broadcast when its measured size is under the threshold).
    return li.join(part, li.l_partkey == part.p_partkey)


def daily_close_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gappy ``daily_close(RIC, Date, Price)``: one close per brand and ship day."""
    lp = _lineitem_part(spark, sf_dir)
    return (lp.groupBy(F.col("p_brand").alias("RIC"), F.to_date("l_shipdate").alias("Date"))
              .agg(F.max("l_extendedprice").alias("Price")))


def gappy_close_from_lineitem(spark: SparkSession, sf_dir: str, ric: str) -> DataFrame:
    """``daily_close_from_lineitem`` with null prices of ``ric`` on every seventh day of a month."""
    missing = (F.col("RIC") == ric) & (F.dayofmonth("Date") % 7 == 0)
    return daily_close_from_lineitem(spark, sf_dir).withColumn(
        "Price", F.when(~missing, F.col("Price")))


def monthly_close_from_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many instruments: one close per supplier (``S<key>``) and ship month."""
    li = _read(spark, sf_dir, "lineitem")
    return (li.groupBy(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("RIC"),
                       F.trunc("l_shipdate", "month").alias("Date"))
              .agg(F.max("l_extendedprice").alias("Price")))


def ticks_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Larger tick table (one trade per line item, brand = instrument).

    Every timestamp is a midnight, so last-trade ties are heavy; the line
    item key ``(l_orderkey, l_linenumber, l_partkey, l_suppkey)`` breaks them.
    """
    lp = _lineitem_part(spark, sf_dir)
    return lp.select(
        F.col("l_orderkey").alias("Seq"),
        F.col("l_shipdate").alias("Date_Time"),
        F.col("p_brand").alias("RIC"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("Price"),
        F.col("l_quantity").cast("long").alias("Volume"),
        F.lit("Trade").alias("Type"),
        F.lit(QUALIFIER_SHAPES[3]).alias("Qualifiers"),
        F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
    )


# Tie-break order of the last trade per day for ``ticks_from_lineitem``.
LINEITEM_TICK_ORDER = ("Date_Time", "Seq", "l_linenumber", "l_partkey", "l_suppkey")


def job_history_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``job_history`` with a nested stage array, from ``orders`` and ``lineitem``.

    The stage array of a job is collected per order key; an order has a
    handful of line items, so every collected array is small.
    """
    orders = _read(spark, sf_dir, "orders")
    li = _read(spark, sf_dir, "lineitem")
    stage_name = F.when(F.col("l_linenumber") == 1, F.lit("S00: Input")) \
                  .otherwise(F.concat(F.lit("S0"), F.col("l_linenumber").cast("string")))
    stages = (li.groupBy("l_orderkey")
                .agg(F.collect_list(F.struct(stage_name.alias("name"),
                                             F.col("l_quantity").cast("long").alias("records_read")))
                      .alias("job_stages")))
    query_text = F.concat(
        F.lit("select "), F.col("o_orderpriority"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(" from INFORMATION_SCHEMA.X")).otherwise(F.lit("")))
    jobs = orders.select(
        F.col("o_orderkey").alias("job_id"),
        F.when(F.col("o_orderstatus") == "F", "DONE").otherwise("RUNNING").alias("state"),
        query_text.alias("query"),
        F.col("o_orderdate").alias("creation_time"),
        F.col("o_orderdate").alias("start_time"),
        F.timestamp_add("MILLISECOND", (F.col("o_custkey") * 10 + 5).cast("int"),
                        F.col("o_orderdate")).alias("end_time"),
        F.floor("o_totalprice").cast("long").alias("total_slot_ms"),
        F.floor(F.col("o_totalprice") * 1000).cast("long").alias("total_bytes_processed"),
    )
    return jobs.join(stages, jobs.job_id == stages.l_orderkey).drop("l_orderkey")
