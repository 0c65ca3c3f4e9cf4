"""Many portfolios in one job: block matrix products of returns and weights.

``weights`` is a sparse matrix in long form, ``(PORTFOLIO, RIC, weight)``.  Days are
cut into chunks and portfolios into blocks; a task multiplies one chunk's returns
(days x tickers) with one block's weights (tickers x portfolios) and keeps three
numbers per portfolio - days, mean and centred squares of its daily return - so no
daily return of a portfolio is ever stored.  Returns are sent once per block of
portfolios, weights once per chunk of days, and the numbers merge per block.

As in ``portfolio_moments``, a day counts for a portfolio if all its tickers have
a return.  A ticker named twice in a portfolio has the sum of its weights; a
portfolio with a ticker that never trades has no day.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickspark.functions.scalars import hashed_normal, lcg_normal
from tickspark.operators.quantile import exact_quantile

# Portfolios of a block and days of a chunk: a task holds days x tickers, tickers x portfolios and days x portfolios.
BLOCK_PORTFOLIOS = 1024
CHUNK_DAYS = 256


def _blocks(weights: DataFrame) -> DataFrame:
    """Weights with the block of their portfolio (``pb``) and its number of tickers: blocks are dealt by hash."""
    w = weights.groupBy("PORTFOLIO", "RIC").agg(F.sum(F.col("weight").cast("double")).alias("weight"))
    portfolios = weights.select(F.approx_count_distinct("PORTFOLIO").alias("p")).first().p
    blocks = -(-max(1, portfolios) // BLOCK_PORTFOLIOS)
    return w.withColumn("pb", F.pmod(F.xxhash64("PORTFOLIO"), F.lit(blocks)).cast("int"))


def portfolio_moments_all(returns: DataFrame, weights: DataFrame) -> DataFrame:
    """``(PORTFOLIO, n_days, expected_return, portfolio_std)`` of every portfolio of ``weights``.

    ``returns`` is (RIC, Date, log_return) and may have gaps.  Without a day the
    moments are null, with one the deviation is.
    """
    held = _blocks(weights)
    day = F.datediff("Date", F.lit("1970-01-01").cast("date"))
    rows = (returns.select("RIC", day.alias("day"), F.col("log_return").cast("double").alias("x")).where("x is not null")
            .withColumn("chunk", F.floor(F.col("day") / CHUNK_DAYS)))
    # tickers that a block names, and days that there are: each side is sent where it is needed only
    x = rows.join(held.select("RIC", "pb").distinct(), "RIC")
    places = x.select(F.col("pb").alias("wb"), F.col("chunk").alias("wc")).distinct()
    w = held.toDF("PORTFOLIO", "W_RIC", "weight", "of").join(places, F.col("of") == F.col("wb")).drop("of")

    def product(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"pb": [], "PORTFOLIO": [], "n": [], "mean": [], "m2": []})
        days, d = np.unique(left["day"].to_numpy(), return_inverse=True)
        rics = pd.Index(right["W_RIC"].unique())
        names, p = np.unique(right["PORTFOLIO"].to_numpy(object).astype(str), return_inverse=True)
        m = np.full((len(days), len(rics)), np.nan)
        m[d, rics.get_indexer(left["RIC"])] = left["x"].to_numpy()
        there = ~np.isnan(m)
        v = np.zeros((len(rics), len(names)))
        v[rics.get_indexer(right["W_RIC"]), p] = right["weight"].to_numpy()
        used = np.zeros(v.shape)
        used[rics.get_indexer(right["W_RIC"]), p] = 1.0
        full = there.astype(float) @ used >= used.sum(axis=0) - 0.5
        r = np.where(full, np.where(there, m, 0.0) @ v, 0.0)
        n = full.sum(axis=0)
        mean = r.sum(axis=0) / np.maximum(n, 1)
        m2 = (np.where(full, r - mean, 0.0) ** 2).sum(axis=0)
        return pd.DataFrame({"pb": int(right["wb"].iloc[0]), "PORTFOLIO": names, "n": n, "mean": mean, "m2": m2})

    parts = x.groupBy("pb", "chunk").cogroup(w.groupBy("wb", "wc")).applyInPandas(
        product, "pb int, PORTFOLIO string, n long, mean double, m2 double")
    # chunks of one portfolio: few, merged around their common mean
    by = Window.partitionBy("PORTFOLIO")
    total = F.sum("n").over(by)
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(by), total)
    merged = parts.withColumn("all_mean", mean).groupBy("PORTFOLIO").agg(
        F.sum("n").alias("n_days"), F.first("all_mean").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * F.pow(F.col("mean") - F.col("all_mean"), 2)).alias("m2"))
    every = weights.select("PORTFOLIO").distinct().join(merged, "PORTFOLIO", "left")
    n = F.coalesce("n_days", F.lit(0))
    return every.select("PORTFOLIO", n.alias("n_days"), F.when(n > 0, F.col("mean")).alias("expected_return"),
                        F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("portfolio_std"))


def portfolio_vars(moments: DataFrame, n: int, days: int = 20, portfolio_value: float = 1_000_000.0,
                   confidence: float = 0.99, q: float | None = None, mode: str = "lcg", seed: int = 0) -> DataFrame:
    """``moments`` with ``n`` and ``VaR`` of each portfolio over ``n`` scenarios.

    All portfolios see the same draws, and a gain is an increasing linear function
    of its draw, so one exact quantile of the draws gives every portfolio's:
    the scenarios are drawn once, not once per portfolio.
    """
    spark: SparkSession = moments.sparkSession
    qq = q if q is not None else round(1.0 - confidence, 12)
    z = lcg_normal("id") if mode == "lcg" else hashed_normal("id", seed)
    draws = spark.range(1, n + 1, 1, max(1, min(n // 50_000 + 1, max(64, -(-n // 5_000_000))))).select(z.alias("z"))
    low = exact_quantile(draws, "z", qq, guess=(-10.0, 10.0)).first().quantile
    pv = F.lit(float(portfolio_value))
    gain = (pv * F.col("expected_return") * F.lit(days)
            + pv * F.col("portfolio_std") * F.lit(low).cast("double") * F.lit(math.sqrt(days)))
    return moments.select("*", F.lit(int(n)).cast("long").alias("n"), (-gain).alias("VaR"))
