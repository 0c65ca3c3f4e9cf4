"""Mergeable co-moments of many return series: covariance that grows day by day.

For a list of tickers, cut into blocks of ``BLOCK_TICKERS``, a row holds one pair of
blocks: for every ticker pair the number of days on which both have a return, the
two means over those days and the centred cross product.  Two such rows of
different days merge into one without the days themselves (pairwise update of
means and products), so

* a batch computation is chunks of ``BLOCK_DAYS`` days, each one matrix product in a
  task, merged per block pair;
* a stored matrix takes in new days by one more folder: no history is read
  (``add_comoments``), and reading merges the folders.

Centring within each chunk keeps large means from cancelling, gaps are pairwise,
and the merge goes in the order of the chunks, so results do not depend on how
Spark deals the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tickers of a block, and calendar days of a chunk: one task holds at most two blocks' columns of one chunk, and
# the four matrices of a pair of blocks (4 x 512 x 512 doubles).
BLOCK_TICKERS = 512
BLOCK_DAYS = 256

COMOMENTS = "a int, b int, part string, n binary, mean_a binary, mean_b binary, product binary"
_MATRICES = ["n", "mean_a", "mean_b", "product"]


def _width(block: int, k: int) -> int:
    return min(BLOCK_TICKERS, k - block * BLOCK_TICKERS)


def _index(spark: SparkSession, tickers: Sequence[str]) -> DataFrame:
    # k rows, k = the length of the given list
    return F.broadcast(spark.createDataFrame(list(enumerate(tickers)), "i int, RIC string"))


def comoments(returns: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """Co-moments of ``returns`` (RIC, Date, log_return; null returns are gaps), one row per pair of blocks and
    chunk of days (``part`` orders the chunks)."""
    tickers = list(dict.fromkeys(tickers))
    k = len(tickers)
    blocks = -(-k // BLOCK_TICKERS)
    own = F.floor(F.col("i") / BLOCK_TICKERS).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)),
                        lambda o: F.struct(F.least(own, o).alias("a"), F.greatest(own, o).alias("b")))
    day = F.datediff("Date", F.lit("1970-01-01").cast("date"))
    placed = (returns.select("RIC", F.col("log_return").cast("double").alias("x"), day.alias("day")).where("x is not null")
              .join(_index(returns.sparkSession, tickers), "RIC")
              .select("i", "x", "day", F.floor(F.col("day") / BLOCK_DAYS).alias("chunk"), F.explode(pairs).alias("pair"))
              .select("i", "x", "day", "chunk", "pair.a", "pair.b"))

    def products(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        a, b, chunk = (int(v) for v in key)
        at = np.unique(pdf["day"].to_numpy(), return_inverse=True)[1]

        def side(block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            m = np.full((at.max() + 1, _width(block, k)), np.nan)
            local = pdf["i"].to_numpy() - block * BLOCK_TICKERS
            inside = (local >= 0) & (local < m.shape[1])
            m[at[inside], local[inside]] = pdf["x"].to_numpy()[inside]
            there = ~np.isnan(m)
            mean = np.where(there, m, 0).sum(axis=0) / np.maximum(there.sum(axis=0), 1)
            return np.where(there, m - mean, 0.0), there.astype(float), mean

        (x, tx, mx), (y, ty, my) = side(a), side(b)
        n, sx, sy = tx.T @ ty, x.T @ ty, tx.T @ y
        some = np.maximum(n, 1)
        cells = [n, np.where(n > 0, mx[:, None] + sx / some, 0), np.where(n > 0, my[None, :] + sy / some, 0),
                 x.T @ y - sx * sy / some]
        return _row(a, b, f"{chunk:+012d}", cells)

    return placed.groupBy("a", "b", "chunk").applyInPandas(products, COMOMENTS)


def _row(a: int, b: int, part: str, cells: Sequence[np.ndarray]) -> pd.DataFrame:
    return pd.DataFrame({"a": [a], "b": [b], "part": [part]} |
                        {name: [np.ascontiguousarray(m).tobytes()] for name, m in zip(_MATRICES, cells)})


def _merged(parts: pd.DataFrame, shape: tuple[int, int]) -> list[np.ndarray]:
    """The co-moments of all days of several rows of one pair of blocks.  A row of fewer tickers (the list has
    grown since) has no days for the others."""
    n, ma, mb, c = (np.zeros(shape) for _ in range(4))
    for row in parts.sort_values("part").itertuples():
        cells = [np.frombuffer(getattr(row, name)) for name in _MATRICES]
        height = getattr(row, "height", shape[0])
        new = []
        for cell in cells:
            full = np.zeros(shape)
            old = cell.reshape(height, -1)
            full[:height, : old.shape[1]] = old
            new.append(full)
        n2, ma2, mb2, c2 = new
        both = n + n2
        some = np.maximum(both, 1)
        da, db = np.where(n > 0, ma2 - ma, ma2), np.where(n > 0, mb2 - mb, mb2)
        c = c + c2 + np.where((n > 0) & (n2 > 0), da * db * n * n2 / some, 0)
        ma, mb, n = ma + da * n2 / some, mb + db * n2 / some, both
    return [n, ma, mb, c]


def merged_comoments(parts: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """One row per pair of blocks, of all days in ``parts`` (each day in one part)."""
    k = len(list(dict.fromkeys(tickers)))

    def merge(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = int(key[0]), int(key[1])
        return _row(a, b, max(pdf["part"]), _merged(pdf, (_width(a, k), _width(b, k))))

    return parts.groupBy("a", "b").applyInPandas(merge, COMOMENTS)


def covariance_of(parts: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """``(RIC_i, RIC_j, covariance)`` of every ticker pair, from co-moments; null below two common days."""
    tickers = list(dict.fromkeys(tickers))
    spark, k = parts.sparkSession, len(tickers)

    def cells(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = int(key[0]), int(key[1])
        shape = _width(a, k), _width(b, k)
        n, _, _, c = _merged(pdf, shape)
        with np.errstate(invalid="ignore", divide="ignore"):
            cov = np.where(n > 1, c / (n - 1), np.nan)
        i, j = np.meshgrid(*[np.arange(w) + q * BLOCK_TICKERS for w, q in zip(shape, (a, b))], indexing="ij")
        out = pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "covariance": cov.ravel()})
        if a != b:
            out = pd.concat([out, out.rename(columns={"i": "j", "j": "i"})])
        return out

    found = parts.groupBy("a", "b").applyInPandas(cells, "i int, j int, covariance double")
    index = _index(spark, tickers)
    grid = index.select("i", F.col("RIC").alias("RIC_i"), F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("j"))
    named = grid.join(F.broadcast(index.select(F.col("i").alias("j"), F.col("RIC").alias("RIC_j"))), "j")
    return (named.join(found, ["i", "j"], "left")
            .select("RIC_i", "RIC_j", F.nanvl("covariance", F.lit(None).cast("double")).alias("covariance")))


def add_comoments(returns: DataFrame, tickers: Sequence[str], store: str, load: str) -> None:
    """Take the days of ``returns`` into the stored matrix: one more folder, named by ``load`` (a run of the same
    load again replaces its folder).  Each day belongs to one load; ``tickers`` may have grown at its end."""
    tickers = list(dict.fromkeys(tickers))
    merged = merged_comoments(comoments(returns, tickers), tickers)
    (merged.withColumns({"part": F.lit(load), "tickers": F.lit(len(tickers))}).coalesce(1)
        .write.mode("overwrite").parquet(f"{store}/load={load}"))


def stored_comoments(spark: SparkSession, store: str) -> DataFrame:
    """The folders' rows, for ``covariance_of`` or ``merged_comoments`` (none before the first load)."""
    schema = f"{COMOMENTS}, tickers int, load string"
    try:
        rows = spark.read.schema(schema).parquet(store)
    except AnalysisException:
        rows = spark.createDataFrame([], schema)
    low = F.col("a") * BLOCK_TICKERS
    return rows.select("a", "b", "part", *_MATRICES,
                       F.least(F.lit(BLOCK_TICKERS), F.col("tickers") - low).cast("int").alias("height"))


def compact_comoments(spark: SparkSession, store: str, tickers: Sequence[str], out: str, load: str) -> None:
    """All folders of a store as one load of another."""
    tickers = list(dict.fromkeys(tickers))
    merged = merged_comoments(stored_comoments(spark, store), tickers)
    (merged.withColumns({"part": F.lit(load), "tickers": F.lit(len(tickers))}).coalesce(1)
        .write.mode("overwrite").parquet(f"{out}/load={load}"))
