"""The Monte Carlo VaR job: closes -> returns -> moments -> scenarios -> VaR.

The reference runs this in a thousand containers, each repeating the
whole history pipeline before drawing its share of scenarios.  Here the
history pipeline runs once as a distributed plan, its two scalar results
are folded into the scenario expression, and the fan-out is a
``spark.range`` over partitions.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tickspark.operators.closes import align_closes, daily_close, gappy_log_returns, log_returns
from tickspark.operators.summary import daily_trade_summary, symbol_series
from tickspark.operators.risk import (
    gain_range,
    histogram,
    moments_scalars,
    portfolio_moments,
    scenarios,
    value_at_risk,
    weights_frame,
)

TEXT_TS = "%Y-%m-%d %H:%M:%S.%f"


@dataclass
class VarRun:
    closes: DataFrame
    returns: DataFrame
    moments: DataFrame
    mu: float | None
    sigma: float | None
    scenarios: DataFrame
    var: DataFrame
    start_date: str
    end_date: str
    batch: str


def history_range(as_of: dt.datetime, years: int) -> tuple[str, str]:
    """``[as_of - 365*years days, as_of]`` as timestamp text (years are 365 days)."""
    start = as_of - dt.timedelta(days=365 * years)
    return start.strftime(TEXT_TS), as_of.strftime(TEXT_TS)


def run_var(spark: SparkSession, ticks: DataFrame, tickers: Sequence[str], as_of: dt.datetime,
            years: int = 20, days: int = 20, n: int = 10_000, tasks: int = 1,
            portfolio_value: float = 1_000_000.0, confidence: float = 0.99, mode: str = "randn",
            seed: int | None = None, batch: str | None = None, venue: str = "LSE", weights=None,
            order_cols: Sequence[str] = ("Date_Time", "Seq"),
            closes: DataFrame | None = None, trade_date_col: str | None = None, q: float | None = None,
            sink: Callable[[DataFrame], None] | None = None) -> VarRun:
    """Run the whole job; ``closes`` replaces the tick-derived closes when
    given (a daily adjusted-close table); ``trade_date_col`` names the ticks'
    day column, so only the history's day partitions are read; ``sink``
    receives the scenarios (CSV folder, table append, or message topic)."""
    tickers = list(tickers)
    start, end = history_range(as_of, years)
    if closes is None:
        closes = daily_close(ticks, start, end, tickers, order_cols=order_cols,
                             trade_date_col=trade_date_col)
    aligned = align_closes(closes, tickers)
    rets = log_returns(aligned, tickers)
    moments = portfolio_moments(gappy_log_returns(aligned), weights_frame(spark, tickers, weights),
                                len(set(tickers)))
    mu, sigma = moments_scalars(moments)
    batch = str(batch) if batch is not None else uuid.uuid4().hex
    scen = scenarios(spark, mu, sigma, n, tasks, days, portfolio_value, mode=mode, seed=seed,
                     batch=batch, venue=venue, portfolio=",".join(tickers),
                     start_date=start, end_date=end)
    if sink is not None:
        sink(scen)
    var = value_at_risk(scen, confidence, q=q, guess=gain_range(mu, sigma, days, portfolio_value))
    return VarRun(closes, rets, moments, mu, sigma, scen, var, start, end, batch)


def chart_series(run: VarRun, bins: int = 50, ticks: DataFrame | None = None,
                 symbol: str | None = None) -> dict[str, DataFrame]:
    """Data behind the reference's charts: VaR marker and gain histogram,
    and (given ticks and a symbol) the daily VWAP / volume series."""
    out = {"var": run.var, "histogram": histogram(run.scenarios, bins)}
    if ticks is not None and symbol is not None:
        daily = daily_trade_summary(ticks, run.start_date, run.end_date, rics=[symbol], date_name="Date")
        out["series"] = symbol_series(daily, symbol, date_name="Date")
    return out
