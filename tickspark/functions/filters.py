"""Trade filters: the one predicate every trade query shares.

Filters are plain ``Column`` expressions so Catalyst can push the simple
comparisons (type, price, volume, time range, instrument list) into the
Parquet scan.  The qualifier regex cannot be pushed; it is written last so
it only runs on rows that survived the cheap predicates.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the market-model qualifier test: the text between the
# first ';' and the last '[MMT_CLASS]' mark holds the flag characters; its
# last 14 characters must start with "12" ("On Book" and "Regular Trade").
QUALIFIER_PATTERN = r";(.*)\[MMT_CLASS\]"
FLAG_WIDTH = 14
REGULAR_FLAG_PATTERN = "12%"
TRADE_TYPE = "Trade"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def market_model_flags(qualifiers="Qualifiers") -> Column:
    """Last 14 characters of the greedy ``;...[MMT_CLASS]`` capture.

    ``regexp_extract`` yields '' when nothing matches (never null for a
    non-null input), and ``right`` returns shorter strings whole.
    """
    return F.right(F.regexp_extract(_c(qualifiers), QUALIFIER_PATTERN, 1), F.lit(FLAG_WIDTH))


def in_time_range(ts="Date_Time", start=None, end=None, end_open: bool = False) -> Column:
    """``BETWEEN`` on a timestamp, inclusive (``end_open`` leaves the end out);
    string bounds are coerced to the column's own timestamp type (so the
    predicate pushes into the scan)."""
    col, cond = _c(ts), F.lit(True)
    if start is not None:
        cond = col >= F.lit(start)
    if end is not None:
        upto = col < F.lit(end) if end_open else col <= F.lit(end)
        cond = upto if start is None else cond & upto
    return cond


def in_instruments(rics: Iterable[str] | str | None, ric="RIC") -> Column:
    """``RIC IN (...)``; a single string is a one-element list.  (A
    DataFrame universe is handled by ``restrict_instruments``.)"""
    if rics is None or isinstance(rics, DataFrame):
        return F.lit(True)
    if isinstance(rics, str):
        rics = [rics]
    return _c(ric).isin(list(rics))


def restrict_instruments(df: DataFrame, rics, ric: str = "RIC") -> DataFrame:
    """Keep rows of listed instruments.  A Python list becomes ``IN``; a
    DataFrame universe (one ``RIC`` column, any size) becomes a left-semi
    join, broadcast by the planner when its measured size allows."""
    if isinstance(rics, DataFrame):
        universe = rics.select(F.col(rics.columns[0]).alias(ric)).distinct()
        return df.join(universe, ric, "left_semi")
    return df.where(in_instruments(rics, ric))


def regular_trade(price="Price", volume="Volume", type_="Type",
                  qualifiers="Qualifiers", require_price=True) -> Column:
    """Regular on-book trade: non-null positive price, positive volume,
    ``Type = 'Trade'`` and a market-model flag starting with ``12``."""
    cond = (_c(type_) == F.lit(TRADE_TYPE)) & (_c(volume) > 0) & (_c(price) > 0)
    if require_price:
        cond = _c(price).isNotNull() & cond
    return cond & market_model_flags(qualifiers).like(REGULAR_FLAG_PATTERN)


def regular_trades(ticks: DataFrame, start=None, end=None, rics=None,
                   ts="Date_Time", trade_date_col: str | None = None) -> DataFrame:
    """Rows of ``ticks`` that are regular trades in ``[start, end]`` for ``rics``.

    When the table is partitioned by a date column, pass ``trade_date_col``:
    an extra predicate on it lets Spark prune whole partitions.
    """
    cond = in_time_range(ts, start, end)
    if trade_date_col is not None:
        cond = cond & in_time_range(
            trade_date_col,
            None if start is None else F.to_date(F.lit(start)),
            None if end is None else F.to_date(F.lit(end)))
    if rics is not None and not isinstance(rics, DataFrame):
        cond = cond & in_instruments(rics)          # cheap, pushable: before the regex
    out = ticks.where(cond & regular_trade())
    return restrict_instruments(out, rics) if isinstance(rics, DataFrame) else out
