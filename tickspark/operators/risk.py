"""Portfolio moments, Monte Carlo scenarios, Value at Risk and histogram.

Moments are computed once as DataFrames (the reference repeats them in
every task); the scenario fan-out is ``spark.range`` split across
partitions, with the two scalar moments folded in as literals; VaR is an
exact, distributed quantile (``tickspark.operators.quantile``).
"""

from __future__ import annotations

import math
import secrets
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions.scalars import hashed_normal, lcg_normal
from tickspark.operators.comoments import comoments, covariance_of
from tickspark.operators.quantile import exact_quantile
from tickspark.schemas import SCENARIO_COLUMNS

def equal_weights(spark: SparkSession, tickers: Sequence[str]) -> DataFrame:
    """``(RIC, weight)`` with weight ``1/k``; k is the (driver-side) list length.

    Built from the ticker list, so its size is known (k rows): it carries a
    broadcast hint and joins without shuffling the returns."""
    tickers = list(dict.fromkeys(tickers))
    k = len(tickers)
    return F.broadcast(spark.createDataFrame([(t, 1.0 / k) for t in tickers], "RIC string, weight double"))


def weights_frame(spark: SparkSession, tickers: Sequence[str], weights=None) -> DataFrame:
    if weights is None:
        return equal_weights(spark, tickers)
    if isinstance(weights, DataFrame):
        return weights
    weights = list(weights)
    if len(weights) != len(tickers):
        raise ValueError(f"{len(tickers)} tickers but {len(weights)} weights")
    return F.broadcast(spark.createDataFrame([(t, float(w)) for t, w in zip(tickers, weights)],
                                             "RIC string, weight double"))


def mean_returns(returns: DataFrame) -> DataFrame:
    return returns.groupBy("RIC").agg(F.avg("log_return").alias("mean_return"))


def expected_return(returns: DataFrame, weights: DataFrame) -> DataFrame:
    """``sum_i w_i * mean_i`` as a one-row frame ``(expected_return)``.

    The weights frame has one row per ticker (``equal_weights`` /
    ``weights_frame`` mark it for broadcast), so the join does not shuffle
    the returns."""
    return (mean_returns(returns).join(weights, "RIC")
            .agg(F.sum(F.col("mean_return") * F.col("weight")).alias("expected_return")))


def covariance(returns: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """Sample covariance of every ticker pair: ``(RIC_i, RIC_j, covariance)``.

    A pair's covariance is taken over the days on which both have a return
    (all days, after ``log_returns``); with fewer than two it is null.  Chunks
    of days and pairs of ticker blocks are matrix products of separate tasks,
    merged as co-moments (``tickspark.operators.comoments``).
    """
    return covariance_of(comoments(returns, tickers), tickers)


def portfolio_std(cov: DataFrame, weights: DataFrame) -> DataFrame:
    """``sqrt(w' S w)`` as a one-row frame ``(portfolio_std)``."""
    wi = weights.select(F.col("RIC").alias("RIC_i"), F.col("weight").alias("w_i"))
    wj = weights.select(F.col("RIC").alias("RIC_j"), F.col("weight").alias("w_j"))
    return (cov.join(wi, "RIC_i").join(wj, "RIC_j")
               .agg(F.sqrt(F.sum(F.col("w_i") * F.col("w_j") * F.col("covariance"))).alias("portfolio_std")))


def portfolio_returns(returns: DataFrame, weights: DataFrame) -> DataFrame:
    """Daily portfolio return ``sum_i w_i r_i`` per day: ``(Date, portfolio_return)``."""
    return (returns.join(weights, "RIC").groupBy("Date")
                   .agg(F.sum(F.col("weight") * F.col("log_return")).alias("portfolio_return")))


def portfolio_moments(returns: DataFrame, weights: DataFrame, tickers: int | None = None) -> DataFrame:
    """One pass, no k x k matrix: ``(n_days, expected_return, portfolio_std)``.

    Only days with all k returns count, so the mean of the daily portfolio
    return equals ``sum_i w_i mean_i`` and its sample standard deviation
    equals ``sqrt(w' S w)``.  ``returns`` holds such days only
    (``log_returns``), or, with the number of ``tickers``, may have gaps
    (``gappy_log_returns``): one aggregate by day then does both, without
    sorting.  With fewer than two days the deviation is null.
    """
    pr = portfolio_returns(returns, weights) if tickers is None else (
        returns.join(weights, "RIC").groupBy("Date")
        .agg(F.sum(F.col("weight") * F.col("log_return")).alias("portfolio_return"),
             F.count("log_return").alias("n")).where(F.col("n") == tickers))
    return pr.agg(F.count("portfolio_return").alias("n_days"),
                  F.avg("portfolio_return").alias("expected_return"),
                  F.stddev_samp("portfolio_return").alias("portfolio_std"))


def scenario_gain(portfolio_value: float, mu, sigma, z, days: int):
    """``PV*mu*days + PV*sigma*z*sqrt(days)`` (linear in the log return, as in the reference)."""
    pv = F.lit(float(portfolio_value))
    return (pv * F.lit(mu).cast("double") * F.lit(days)
            + pv * F.lit(sigma).cast("double") * z * F.lit(math.sqrt(days)))


def scenarios(spark: SparkSession, mu, sigma, n: int, tasks: int = 1, days: int = 20,
              portfolio_value: float = 1_000_000.0, mode: str = "randn", seed: int | None = None,
              batch: str = "0", venue: str = "LSE", portfolio: str = "",
              start_date=None, end_date=None, num_partitions: int | None = None) -> DataFrame:
    """``n * tasks`` scenario rows in the result-table schema.

    Scenario ids ``1..n*tasks`` are split over partitions by ``spark.range``;
    task ``t`` owns ids ``t*n+1..(t+1)*n``.  Draws are functions of the id
    (and seed) alone, so neither the number of cores nor of partitions
    changes a row: ``mode='randn'`` hashes (seed, id) into a normal draw (a
    fresh seed if none is given), ``mode='lcg'`` is engine independent.
    ``mu`` and ``sigma`` are scalars (see ``moments_scalars``).
    """
    total = int(n) * int(tasks)
    # about 5M scenarios per partition at the top end, 50k at least
    parts = num_partitions or max(1, min(total // 50_000 + 1, max(64, -(-total // 5_000_000))))
    ids = spark.range(1, total + 1, 1, parts)
    if mode == "randn":
        z = hashed_normal("id", seed if seed is not None else secrets.randbits(62))
    elif mode == "lcg":
        z = lcg_normal("id")
    else:
        raise ValueError("mode must be 'randn' or 'lcg'")
    ts = lambda v: F.lit(v).cast("timestamp") if v is not None else F.lit(None).cast("timestamp")
    return ids.select(
        F.lit(str(batch)).alias("BATCH"),
        F.lit(venue).alias("VENUE"),
        F.lit(portfolio).alias("PORTFOLIO"),
        F.lit(float(portfolio_value)).alias("PORTFOLIO_VALUE"),
        ts(start_date).alias("START_DATE"),
        ts(end_date).alias("END_DATE"),
        F.lit(int(days)).cast("long").alias("DAYS"),
        scenario_gain(portfolio_value, mu, sigma, z, days).alias("RETURN"),
        F.col("id").alias("SCENARIO_ID"),
    ).select(*SCENARIO_COLUMNS)


def gain_range(mu, sigma, days: int, portfolio_value: float, sd: float = 10.0) -> tuple[float, float] | None:
    """The gains within ``sd`` standard deviations of their mean: a range in which a quantile is looked for first."""
    if mu is None or sigma is None or not math.isfinite(mu) or not math.isfinite(sigma):
        return None
    mean, width = portfolio_value * mu * days, abs(portfolio_value * sigma * math.sqrt(days)) * sd
    return mean - width, mean + width


def moments_scalars(moments: DataFrame) -> tuple[float | None, float | None]:
    """Pull the two scalars of a one-row moments frame to the driver."""
    row = moments.first()
    if row is None:
        return None, None
    return row["expected_return"], row["portfolio_std"]


def value_at_risk(scen: DataFrame, confidence: float = 0.99, by: Sequence[str] = (),
                  col: str = "RETURN", q: float | None = None, guess: tuple[float, float] | None = None) -> DataFrame:
    """``-percentile(gains, 1 - confidence)`` with linear interpolation, per
    group: ``(by..., n, VaR)``; ungrouped, no gains give ``(0, null)``.  Pass ``q``
    to give the lower-tail fraction exactly (``1 - 0.99`` is not 0.01 in floating
    point), ``guess`` (``gain_range``) to save a scan.  ``scen`` is scanned a few times."""
    qq = q if q is not None else round(1.0 - confidence, 12)
    out = exact_quantile(scen, col, qq, by, guess)
    return out.select(*by, "n", (-F.col("quantile")).alias("VaR"))


def histogram(scen: DataFrame, bins: int = 50, col: str = "RETURN") -> DataFrame:
    """Equal-width histogram over ``[min, max]`` with density, numpy's rules:
    bin ``i`` is ``[e_i, e_{i+1})``, the last bin is closed, a degenerate
    range becomes ``[v-0.5, v+0.5]``; empty bins are kept with 0.

    Columns: ``bin, bin_start, bin_end, count, density``.
    """
    x = scen.select(F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    st = x.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    spark = scen.sparkSession
    bins_df = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    lo, hi, n = st["lo"], st["hi"], st["n"]
    if not n:
        return bins_df.select("bin", F.lit(None).cast("double").alias("bin_start"),
                              F.lit(None).cast("double").alias("bin_end"),
                              F.lit(0).cast("long").alias("count"),
                              F.lit(None).cast("double").alias("density"))
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins

    def edge(i):
        return F.when(i >= bins, F.lit(hi)).otherwise(i.cast("double") * F.lit(step) + F.lit(lo))

    f = F.floor((F.col("_x") - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)).cast("int")
    i1 = F.when(f >= bins, bins - 1).otherwise(f)
    i2 = F.when(F.col("_x") < edge(i1), i1 - 1).otherwise(i1)
    i3 = F.when((F.col("_x") >= edge(i2 + 1)) & (i2 != bins - 1), i2 + 1).otherwise(i2)
    counts = x.select(i3.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    b = F.col("bin")
    return (bins_df.join(counts, "bin", "left")
            .select("bin", edge(b).alias("bin_start"), edge(b + 1).alias("bin_end"),
                    F.coalesce("count", F.lit(0)).cast("long").alias("count"))
            .withColumn("density", F.col("count") / (F.col("bin_end") - F.col("bin_start")) / F.lit(float(n))))


def var_from_store(spark: SparkSession, table: str, confidence: float = 0.99, by: Sequence[str] = ("BATCH",),
                   q: float | None = None) -> DataFrame:
    """VaR per batch over a stored result table (catalog name or path):
    ``(BATCH, n, VaR)``.  Only ``BATCH`` and ``RETURN`` are read; a table
    partitioned by ``BATCH`` prunes to the batches a filter selects."""
    from tickspark.sources.files import read_store
    store = read_store(spark, table).select(*by, "RETURN")
    return value_at_risk(store, confidence, by=list(by), q=q)
