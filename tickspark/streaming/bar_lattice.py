"""High/low bid bars kept current from a stream of quotes.

The stored form is a lattice of minute bars, from which bars of any coarser unit
follow (the high of an hour is the highest high of its minutes).  Highs and lows
merge without the quotes behind them, so a micro-batch stores the bars of its own
quotes in the folders of their days, and reading merges the few bars of a minute.
The stream therefore needs no state and no watermark: no quote is too late, a
late one touches its own day's folder only, and a replay overwrites its folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.filters import in_time_range, restrict_instruments
from tickspark.functions.scalars import truncate_time
from tickspark.operators.bars import BAR_UNITS
from tickspark.streaming.ingest import epoch_name, start_stream

LATTICE = T.StructType([T.StructField("RIC", T.StringType()), T.StructField("minute", T.TimestampNTZType()),
                        T.StructField("high", T.DoubleType()), T.StructField("low", T.DoubleType()),
                        T.StructField("EPOCH", T.StringType()), T.StructField("DAY", T.DateType())])


def stream_bars(spark: SparkSession, quotes: DataFrame, lattice: str, checkpoint: str, ts: str = "date_time",
                price: str = "L2_BidPrice", available_now: bool = True, processing_time: str | None = None):
    """Keep the minute lattice under ``lattice`` current with a stream of quotes (``RIC``, ``ts``, ``price``).

    A quote without a time is in no bar; a minute without a price has a bar of nulls, as in ``bid_bars``."""
    def keep(batch: DataFrame, epoch_id: int) -> None:
        bars = (batch.where(F.col(ts).isNotNull())
                .groupBy("RIC", truncate_time("MINUTE", ts).cast("timestamp_ntz").alias("minute"))
                .agg(F.max(price).cast("double").alias("high"), F.min(price).cast("double").alias("low")))
        (bars.withColumns({"EPOCH": F.lit(epoch_name(checkpoint, epoch_id)), "DAY": F.to_date("minute")})
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("DAY", "EPOCH").parquet(lattice))

    return start_stream(quotes.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint),
                        available_now, processing_time)


def lattice_bars(spark: SparkSession, lattice: str, unit: str = "MINUTE", start=None, end=None, rics=None) -> DataFrame:
    """``RIC, time_group, max_bid, min_bid`` from the lattice, over the minutes from ``start`` to ``end`` (whole minutes).
    Only the range's days are read."""
    unit = unit.upper()
    if unit not in BAR_UNITS:
        raise ValueError(f"unit must be one of {BAR_UNITS}, got {unit!r}")
    rows = spark.read.schema(LATTICE).parquet(lattice)
    for bound, within in ((start, F.col("DAY") >= F.to_date(F.lit(start))), (end, F.col("DAY") <= F.to_date(F.lit(end)))):
        if bound is not None:
            rows = rows.where(within)
    rows = restrict_instruments(rows.where(in_time_range("minute", start, end)), rics)
    return rows.groupBy("RIC", truncate_time(unit, "minute").cast("timestamp_ntz").alias("time_group")).agg(
        F.max("high").alias("max_bid"), F.min("low").alias("min_bid"))


def compact_lattice(spark: SparkSession, lattice: str, out: str) -> None:
    """The lattice with one bar per instrument and minute, one folder per day."""
    rows = spark.read.schema(LATTICE).parquet(lattice)
    bars = rows.groupBy("RIC", "minute").agg(F.max("high").alias("high"), F.min("low").alias("low"))
    bars.withColumns({"EPOCH": F.lit("compacted"), "DAY": F.to_date("minute")}).write.mode("overwrite").partitionBy(
        "DAY", "EPOCH").parquet(out)
