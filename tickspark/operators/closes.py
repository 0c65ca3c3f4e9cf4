"""Daily closes, calendar alignment and log returns (long form throughout).

The reference builds a wide date x ticker matrix on one machine.  Here the
matrix stays long, ``(RIC, Date, value)``, so every step is a keyed
aggregate, join or per-instrument window that Spark partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.filters import regular_trades


_DEC = "decimal(38,0)"
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _packed_key(df: DataFrame, order_cols: Sequence[str]):
    """``(timestamp, integral)`` - the usual ``(Date_Time, Seq)`` - packed into
    one ``decimal(38,0)``: microseconds * 10^20 + (seq + 2^63).  Both parts
    fit (16 + 20 digits) and the order is the pair's; a decimal buffer keeps
    ``max_by`` in a hash aggregate.  None for other key shapes."""
    if len(order_cols) == 2:
        ts_t, seq_t = (df.schema[c].dataType for c in order_cols)
        if isinstance(ts_t, (T.TimestampType, T.TimestampNTZType)) and isinstance(seq_t, _INTEGRAL):
            micros = F.unix_micros(F.col(order_cols[0]).cast("timestamp")).cast(_DEC)
            # a null sequence counts as the smallest, as it does under "ORDER BY ... DESC"
            seq = (F.coalesce(F.col(order_cols[1]).cast(_DEC), F.lit("-9223372036854775808").cast(_DEC))
                   + F.lit("9223372036854775808").cast(_DEC))
            return (micros * F.lit("100000000000000000000").cast(_DEC) + seq).cast(_DEC)
    return None


def daily_close(ticks: DataFrame, start=None, end=None, rics=None,
                order_cols: Sequence[str] = ("Date_Time", "Seq"),
                trade_date_col: str | None = None) -> DataFrame:
    """Last regular trade of each instrument and UTC day: ``(RIC, Date, Price)``.

    Same result as ``ROW_NUMBER() OVER (PARTITION BY RIC, DATE(Date_Time)
    ORDER BY Date_Time DESC) = 1`` with ``order_cols`` as the tie-break.
    Every path reduces each map task to one row per (instrument, day)
    before the shuffle, so a hot instrument is safe:

    * ``(timestamp, integral)`` key: ``max_by`` on a packed decimal key - a
      hash aggregate, no sort;
    * longer keys: ``row_number() = 1``, which Spark runs as a partial
      ``WindowGroupLimit`` (top-1 per group on the map side), a shuffle, and
      a final limit (measured faster than ``max_by`` on a struct key);
    * streaming input with a longer key: ``max_by`` on a struct key
      (windows are not allowed on streams).

    ``trade_date_col`` names a stored trade-date column (``to_date`` of
    the timestamp); it prunes day partitions and is used as the day key,
    so a table bucketed by ``(RIC, trade_date)`` needs no shuffle here.
    """
    trades = regular_trades(ticks, start, end, rics, trade_date_col=trade_date_col)
    day = F.col(trade_date_col) if trade_date_col else F.to_date("Date_Time")
    packed = _packed_key(trades, order_cols)
    if packed is not None or trades.isStreaming:
        key = packed if packed is not None else F.struct(*[F.col(c) for c in order_cols])
        return (trades.groupBy("RIC", day.alias("Date"))
                      .agg(F.max_by("Price", key).cast("double").alias("Price")))
    w = Window.partitionBy("RIC", day).orderBy(*[F.col(c).desc() for c in order_cols])
    return (trades.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
                  .select("RIC", day.alias("Date"), F.col("Price").cast("double").alias("Price")))


def align_closes(closes: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """Align every ticker to the first ticker's calendar.

    Result: one row per (listed ticker, day on which ``tickers[0]`` has a
    row); a missing or null close is null, and days the first ticker lacks
    are dropped.  A day of the first ticker whose price is null stays in the
    calendar, so the returns of that day and the next are both undefined.
    Two closes of one ticker and day are an error.

    One aggregate by day gathers the listed tickers' closes into a map (k
    entries, k = portfolio size) that is unpivoted back to long form - no
    join, no cross join, and the closes are computed once.
    """
    tickers = list(dict.fromkeys(tickers))          # a repeated ticker is one column, order kept
    if not tickers:
        raise ValueError("at least one ticker is required")
    rics = F.transform("entries", lambda e: e["RIC"])
    twice = F.size("entries") > F.size(F.array_distinct(rics))
    day = (closes.where(F.col("RIC").isin(tickers)).groupBy("Date")
           .agg(F.collect_list(F.struct("RIC", F.col("Price").cast("double").alias("Price"))).alias("entries"))
           .withColumn("m", F.when(twice, F.raise_error(F.concat(
               F.lit("two closes of one instrument on "), F.col("Date").cast("string"))).cast("map<string,double>"))
               .otherwise(F.map_from_entries("entries"))))
    cells = F.transform(F.array(*[F.lit(t) for t in tickers]),
                        lambda t: F.struct(t.alias("RIC"), F.try_element_at("m", t).alias("Price")))
    return (day.where(F.map_contains_key("m", F.lit(tickers[0])))
               .select("Date", F.inline(cells)).select("RIC", "Date", "Price"))


def gappy_log_returns(aligned: DataFrame) -> DataFrame:
    """``ln(p / previous p)`` on the aligned calendar; null where either close is missing."""
    by_ric = Window.partitionBy("RIC").orderBy("Date")
    return aligned.select("RIC", "Date", F.ln(F.try_divide(F.col("Price"), F.lag("Price").over(by_ric)))
                          .alias("log_return"))


def log_returns(aligned: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """``ln(p / previous p)`` on the aligned calendar, keeping only days on
    which every ticker has a return (the ``dropna`` of the wide matrix).

    The previous close is taken on the aligned rows *before* dropping gaps,
    so a gap kills two days: its own and the next.  ``lag`` runs in a
    per-instrument window (one row per calendar day per ticker); the
    completeness count runs in a per-day window (k rows per day).
    """
    k = len(set(tickers))
    by_day = Window.partitionBy("Date")
    return (gappy_log_returns(aligned).withColumn("_n", F.count("log_return").over(by_day))
            .where(F.col("log_return").isNotNull() & (F.col("_n") == k))
            .select("RIC", "Date", "log_return"))
