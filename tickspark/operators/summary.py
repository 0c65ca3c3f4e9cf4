"""Trade summaries: VWAP, TWAP, volume and trade count; daily pivot.

All aggregates are algebraic (sum / count / avg), so Spark plans a partial
aggregate before the shuffle on the grouping key: a hot instrument is
pre-reduced to one row per map task before it reaches its reducer.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.functions.filters import regular_trades


def vwap(price="Price", volume="Volume", digits: int | None = 3) -> Column:
    """``ROUND(SAFE_DIVIDE(SUM(Volume*Price), SUM(Volume)), 3)``; null on zero volume."""
    p, v = F.col(price), F.col(volume)
    out = F.try_divide(F.sum(v * p), F.sum(v))
    return F.round(out, digits) if digits is not None else out


def twap(price="Price", digits: int | None = 3) -> Column:
    """The reference's "TWAP": the plain mean of trade prices (not time weighted)."""
    out = F.avg(F.col(price))
    return F.round(out, digits) if digits is not None else out


def trade_summary(ticks: DataFrame, start=None, end=None, rics=None,
                  by: Sequence[str] = ("RIC",), order: bool = True,
                  trade_date_col: str | None = None) -> DataFrame:
    """VWAP, TWAP, TotalVolume, NumTrades per instrument over a time range."""
    trades = regular_trades(ticks, start, end, rics, trade_date_col=trade_date_col)
    out = trades.groupBy(*by).agg(
        vwap().alias("VWAP"),
        twap().alias("TWAP"),
        F.sum("Volume").alias("TotalVolume"),
        F.count("RIC").alias("NumTrades"),
    )
    return out.orderBy(*by) if order else out


def daily_trade_summary(ticks: DataFrame, start=None, end=None, rics=None,
                        date_name: str = "vwap_date",
                        trade_date_col: str | None = None) -> DataFrame:
    """VWAP, TotalVolume, NumTrades per instrument and UTC calendar day
    (a stored ``trade_date_col`` is used as the day key when given)."""
    trades = regular_trades(ticks, start, end, rics, trade_date_col=trade_date_col)
    day = F.col(trade_date_col) if trade_date_col else F.to_date("Date_Time")
    return trades.groupBy("RIC", day.alias(date_name)).agg(
        vwap().alias("VWAP"),
        F.sum("Volume").alias("TotalVolume"),
        F.count("RIC").alias("NumTrades"),
    )


def symbol_series(daily: DataFrame, symbol: str, date_name: str = "vwap_date") -> DataFrame:
    """One instrument's daily series sorted by date (chart input)."""
    return daily.where(F.col("RIC") == F.lit(symbol)).orderBy(date_name)


def _date_suffix(d) -> str:
    return str(d).replace("-", "_")


def pivot_by_date(daily: DataFrame, dates: Sequence, date_name: str = "vwap_date") -> DataFrame:
    """Day-over-day report: one row per RIC, ``AVG(VWAP)``, ``SUM(TotalVolume)``,
    ``SUM(NumTrades)`` for each listed date, named ``<agg>_<yyyy_mm_dd>``.

    With the pivot values listed, Spark compiles the pivot into conditional
    aggregates of a single grouped aggregation (no value discovery pass).
    A listed date without trades yields nulls.
    """
    values = [F.lit(str(d)).cast("date") for d in dates]
    aggs = []
    for d, lit_d in zip(dates, values):
        hit = F.col(date_name) == lit_d
        sfx = _date_suffix(d)
        aggs += [
            F.avg(F.when(hit, F.col("VWAP"))).alias(f"VWAP_{sfx}"),
            F.sum(F.when(hit, F.col("TotalVolume"))).alias(f"TotalVolume_{sfx}"),
            F.sum(F.when(hit, F.col("NumTrades"))).alias(f"NumTrades_{sfx}"),
        ]
    return daily.groupBy("RIC").agg(*aggs)


def pivot_by_date_native(daily: DataFrame, dates: Sequence, date_name: str = "vwap_date") -> DataFrame:
    """Same report through ``GroupedData.pivot`` (renamed to the report's names)."""
    values = [datetime.date.fromisoformat(str(d)) for d in dates]
    p = (daily.groupBy("RIC").pivot(date_name, values)
         .agg(F.avg("VWAP").alias("VWAP"), F.sum("TotalVolume").alias("TotalVolume"),
              F.sum("NumTrades").alias("NumTrades")))
    renamed = [F.col("RIC")]
    for d in dates:
        for m in ("VWAP", "TotalVolume", "NumTrades"):
            renamed.append(F.col(f"`{d}_{m}`").alias(f"{m}_{_date_suffix(d)}"))
    return p.select(*renamed)


def cagr(closes: DataFrame, price: str = "Price", date: str = "Date") -> DataFrame:
    """Compound annual growth per instrument: ``(last/first)^(365/days) - 1``."""
    g = closes.groupBy("RIC").agg(
        F.min_by(price, date).alias("first_price"), F.max_by(price, date).alias("last_price"),
        F.min(date).alias("first_date"), F.max(date).alias("last_date"))
    days = F.datediff("last_date", "first_date")
    return g.select("RIC", "first_date", "last_date",
                    F.when(days > 0, F.pow(F.try_divide(F.col("last_price"), F.col("first_price")),
                                           F.lit(365.0) / days) - 1).alias("cagr"))


def normalized_return(closes: DataFrame, price: str = "Price", date: str = "Date") -> DataFrame:
    """Price divided by the instrument's first price (window per instrument)."""
    w = Window.partitionBy("RIC").orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return closes.select("RIC", date, price,
                         F.try_divide(F.col(price), F.first(price).over(w)).alias("normalized"))
