"""Scans of the market tables.

A source is either a catalog table name (``db.table`` or
``catalog.db.table``) or a storage path.  Scans are lazy; the predicates
added here are pushed into the file scan by Catalyst, and a date
predicate prunes partitions when the table is partitioned by day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions.filters import in_time_range, restrict_instruments


def read_table(spark: SparkSession, source: str, fmt: str = "parquet") -> DataFrame:
    """Table name or path -> DataFrame."""
    if "/" in source or source.endswith(f".{fmt}"):
        return spark.read.format(fmt).load(source)
    return spark.table(source)


def read_ticks(spark: SparkSession, source, start=None, end=None, rics=None,
               ts: str = "Date_Time", trade_date_col: str | None = None, end_open: bool = False) -> DataFrame:
    """Trade / quote ticks restricted to a time range (inclusive; ``end_open``
    leaves its end out) and instrument list."""
    df = source if isinstance(source, DataFrame) else read_table(spark, source)
    cond = in_time_range(ts, start, end, end_open)
    if trade_date_col is not None:
        cond = cond & in_time_range(trade_date_col, None if start is None else F.to_date(F.lit(start)),
                                    None if end is None else F.to_date(F.lit(end)))
    return restrict_instruments(df.where(cond), rics)


def read_l2(spark: SparkSession, source, start=None, end=None, rics=None,
            trade_date_col: str | None = None, end_open: bool = False) -> DataFrame:
    """Level-2 quotes (``RIC, date_time, L2_BidPrice``) over a time range."""
    return read_ticks(spark, source, start, end, rics, ts="date_time",
                      trade_date_col=trade_date_col, end_open=end_open)


def read_daily_close(spark: SparkSession, source, fmt: str = "parquet",
                     ric: str = "RIC", date: str = "Date", price: str = "Price") -> DataFrame:
    """Daily closes as a long table ``(RIC, Date, Price)``.

    One row per instrument and day is expected (a downloaded adjusted-close
    series, or the output of ``daily_close``).
    """
    df = source if isinstance(source, DataFrame) else read_table(spark, source, fmt)
    return df.select(F.col(ric).alias("RIC"), F.col(date).cast("date").alias("Date"),
                     F.col(price).cast("double").alias("Price"))


def read_adjusted_close_csv(spark: SparkSession, path: str, price: str = "Adj Close",
                            date: str = "Date", date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Daily closes from downloaded price files, one CSV file per ticker
    (``Date, ..., <price>, ...``; the ticker is the file name without its
    extension).  Returns ``(RIC, Date, Price)``.  All files are read as one
    distributed scan; the ticker comes from each row's file metadata.
    """
    raw = (spark.read.option("header", True).option("mode", "FAILFAST").csv(path)
                .select(F.col(f"`{date}`").alias("_d"), F.col(f"`{price}`").alias("_p"),
                        F.col("_metadata.file_name").alias("_f")))
    # file names come URL-encoded ('#' as %23); keep a literal '+' as '+'
    name = F.url_decode(F.regexp_replace("_f", r"\+", "%2B"))
    return raw.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("RIC"),
                      F.to_date("_d", date_format).alias("Date"),
                      F.col("_p").cast("double").alias("Price"))


def read_job_history(spark: SparkSession, source, fmt: str = "parquet") -> DataFrame:
    """Run-history rows with a nested ``job_stages array<struct<name, records_read>>``."""
    return source if isinstance(source, DataFrame) else read_table(spark, source, fmt)


def write_ticks(ticks: DataFrame, path: str, ts: str = "Date_Time", ric: str = "RIC",
                date_col: str = "trade_date", mode: str = "append") -> None:
    """Store ticks for pruned scans: one folder per UTC trade day, rows
    sorted by instrument and time inside each file.

    Day folders let ``read_ticks(..., trade_date_col='trade_date')`` skip
    whole days (partition pruning); sorting by ``RIC`` keeps each file's
    Parquet row-group statistics narrow, so ``RIC IN (...)`` skips row
    groups.  The shuffle is a range partitioning on (day, instrument,
    time): a hot instrument-day is cut by time into several tasks instead
    of landing in one.
    """
    out = ticks.withColumn(date_col, F.to_date(F.col(ts)))
    (out.repartitionByRange(date_col, ric, ts)
        .sortWithinPartitions(date_col, ric, ts)
        .write.mode(mode).partitionBy(date_col).parquet(path))


def write_bucketed_ticks(ticks: DataFrame, table: str, buckets: int, ts: str = "Date_Time",
                         ric: str = "RIC", date_col: str = "trade_date", mode: str = "overwrite") -> None:
    """Store ticks as a catalog table bucketed by ``(RIC, trade_date)`` and
    sorted by time inside each bucket.

    Aggregations keyed by instrument and day (daily close, daily summary)
    then read data already distributed by their keys, so Spark plans them
    without a shuffle.  The day is part of the bucket key, so a hot
    instrument is spread over many buckets.
    """
    (ticks.withColumn(date_col, F.to_date(F.col(ts)))
          .write.mode(mode).bucketBy(buckets, ric, date_col).sortBy(ric, date_col, ts)
          .saveAsTable(table))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """``CREATE OR REPLACE VIEW``: a lazy, named plan; returns ``df``."""
    df.createOrReplaceTempView(name)
    return df
