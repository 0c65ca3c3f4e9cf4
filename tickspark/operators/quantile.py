"""Exact quantiles with linear interpolation, per group, at any size.

The wanted rank is found by counting.  A pass cuts each group's interval of
values into ``CELLS`` cells of equal width, counts the rows of each cell and takes
its least and greatest value: a mergeable summary of a fixed size per group,
added up on the map side.  The cell that holds the rank - which the counts
prove - becomes the next interval, closed and bounded by values that occur.
Once an interval holds at most ``RANKED_ROWS`` values, or only one, a last pass
keeps those inside it (and the least value above, needed to interpolate).

Cells are an increasing function of the value, so rounding cannot move a value
past another; infinities and NaN (the largest, as in Spark's ordering) have cells
of their own; ties end in an interval of one value, which is never gathered.
The first interval is the range of the values, or a given guess: a bad guess
costs a pass, not the result.

No table of values is written and nothing but per-group rows is gathered.  The
input is scanned once per pass (two or three in all, one more for every factor
of about ``CELLS`` above ``RANKED_ROWS * CELLS`` rows in a group), so it has to give
the same values each time; store an input that is costly or not repeatable first.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickspark.session import shared_path

#: Values of a group's interval that the last pass may keep and sort.
RANKED_ROWS = 10_000
#: Cells a pass cuts an interval into.
CELLS = 2048

_LARGEST = sys.float_info.max
_INF = float("inf")
#: Interval of a group: rows n, wanted rank r and fraction, rank and size within [lo, hi], and the end near
#: which the next cut's cells are narrow.
_TYPES = {"n": "long", "r": "long", "frac": "double", "rank": "long", "size": "long", "lo": "double", "hi": "double", "steep": "int"}
_STATE = list(_TYPES)


def _kept(state: DataFrame, keys: list[str]) -> DataFrame | dict | None:
    """The groups' intervals, computed once: without keys the one row as a dictionary, else a table in the shared folder."""
    if not keys:
        row = state.first()
        return row.asDict() if row is not None else None
    spark = state.sparkSession
    path = shared_path(spark, "quantile-state")
    state.write.parquet(path)
    return spark.read.schema(state.schema).parquet(path)


def _beside(values: DataFrame, state: DataFrame | dict, keys: list[str], columns: Sequence[str]) -> DataFrame:
    """Each value beside its group's interval; without keys as constants."""
    if keys:
        return values.join(state.select(*keys, *columns), keys)
    return values.withColumns({c: F.lit(state[c]).cast(_TYPES[c]) for c in columns})


def _cell(x: Column, lo: Column, hi: Column, steep: Column) -> Column:
    """The cell of ``x`` in ``[lo, hi]``, increasing in ``x``: 0 below, ``2 * CELLS + 2`` above, then infinity and NaN.

    The cell that holds zero is two, by sign.  Where ``steep`` is 1 or -1 cells are
    narrower (up to 2^1000 times) towards the lower or upper end.
    """
    low, high = F.greatest(lo, F.lit(-_LARGEST)), F.least(hi, F.lit(_LARGEST))
    # the width of the whole range of doubles is infinite, its half is not
    width = high / 2 - low / 2
    share = lambda from_, to: F.when(width > 0, (to / 2 - from_ / 2) / width).otherwise((to - from_) / (high - low))
    curved = lambda part: F.log1p(part * F.lit(2.0**1000)) / F.log1p(F.lit(2.0**1000))
    part = F.when(steep == 1, curved(share(low, x))).when(steep == -1, 1 - curved(share(x, high))).otherwise(share(low, x))
    inside = F.greatest(F.least(F.floor(part * CELLS), F.lit(CELLS - 1)), F.lit(0))
    return (F.when(F.isnan(x), 2 * CELLS + 4).when(x == _INF, 2 * CELLS + 3).when(x < low, 0).when(x > high, 2 * CELLS + 2)
            .when(low == high, 1).otherwise(2 * inside + F.when(x < 0, 1).otherwise(2)).cast("int"))


def _narrowed(values: DataFrame, state: DataFrame | dict, keys: list[str], q: float, first: bool) -> DataFrame:
    """One counting pass: the interval of each group becomes the cell that holds its rank.

    In a ``first`` pass from a guess all values count, and the rank follows from their number.
    """
    held = _beside(values, state, keys, _STATE if not first else ["lo", "hi", "steep"])
    x, lo, hi = F.col("_x"), F.col("lo"), F.col("hi")
    carried = [] if first else ["n", "r", "frac", "rank", "size"]
    cells = (held if first else held.where((x >= lo) & (x <= hi))).groupBy(
        *keys, *carried, _cell(x, lo, hi, F.col("steep")).alias("cell")).agg(
        F.sum("_w").alias("c"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    if first:
        cells = _ranked(cells.withColumn("n", F.sum("c").over(Window.partitionBy(*keys))), q).withColumn("size", F.col("n"))
    upto = F.sum("c").over(Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    here = cells.withColumn("upto", upto).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("c")))
    return here.select(*keys, "n", "r", "frac", (F.col("rank") - F.col("upto") + F.col("c")).alias("rank"),
                       F.col("c").alias("size"), "lo", "hi", _steep().alias("steep"))


def _steep() -> Column:
    """A cell that kept most rows holds values of very different size next to one of its ends: the next cut's
    cells are narrow there."""
    return F.when(F.col("c") * 2 <= F.col("size"), 0).when(F.col("cell") <= CELLS, 1).otherwise(-1)


def _ranked(groups: DataFrame, q: float) -> DataFrame:
    at = F.lit(q) * (F.col("n") - 1)
    below = F.greatest(F.floor(at), F.lit(0)).cast("long")
    return groups.withColumns({"r": below, "frac": at - F.floor(at), "rank": below})


def exact_quantile(df: DataFrame, col: str, q: float, by: Sequence[str] = (),
                   guess: tuple[float, float] | None = None) -> DataFrame:
    """``(by..., n, quantile)``: the ``q`` quantile of ``col`` per group, linear
    interpolation between ranks ``floor(q(n-1))`` and the next (as numpy's
    default and SQL ``quantile_cont``).  Nulls are ignored; a group without
    values has no row, but without ``by`` there is always one row, of no value
    ``(0, null)``.  ``guess``, a range that may hold the quantile, saves the pass
    that finds the range.  All passes but the last run before this returns.
    """
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be in [0, 1]")
    names = list(by)
    keys = [f"_k{i}" for i in range(len(names))]
    # null keys are groups of their own: they are matched as a flag and a value
    values = df.select(*[F.struct(F.col(c)).alias(k) for c, k in zip(names, keys)],
                       F.col(col).cast("double").alias("_x"), F.lit(1).cast("long").alias("_w")).where("_x is not null")
    state = None
    if guess is not None and not keys and guess[0] <= guess[1]:
        given = {"lo": float(guess[0]), "hi": float(guess[1]), "steep": 0}
        state = _kept(_narrowed(values, given, keys, q, True), keys)
    if state is None:
        groups = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
        state = _kept(_ranked(groups, q).select(
            *keys, "n", "r", "frac", "rank", F.col("n").alias("size"), "lo", "hi", F.lit(0).alias("steep")), keys)
    return _selected(values, state, keys).select(
        *[F.col(f"{k}.{c}").alias(c) for c, k in zip(names, keys)], "n", "quantile")


def tail_quantile(tails: DataFrame, totals: DataFrame, q: float, by: str) -> DataFrame:
    """``(by, n, quantile)`` from the lower tails of groups: ``tails`` holds ``by, x, count`` (a value and how
    often it occurs) and ``totals`` ``by, n``, the number of all values.  A group has a row only if its tail
    holds the two values around the rank."""
    values = tails.select(F.struct(by).alias("_k0"), F.col("x").alias("_x"), F.col("count").alias("_w"))
    held = values.groupBy("_k0").agg(F.sum("_w").alias("size"), F.min("_x").alias("lo"), F.max("_x").alias("hi"))
    groups = _ranked(totals.select(F.struct(by).alias("_k0"), "n"), q).join(held, "_k0").where(
        F.col("size") >= F.least(F.col("r") + 2, F.col("n")))
    state = _kept(groups.select("_k0", "n", "r", "frac", "rank", "size", "lo", "hi", F.lit(0).alias("steep")), ["_k0"])
    return _selected(values, state, ["_k0"]).select(F.col(f"_k0.{by}").alias(by), "n", "quantile")


def _selected(values: DataFrame, state: DataFrame | dict, keys: list[str]) -> DataFrame:
    if not keys:
        # one value only: no less than itself, or NaN (the least is NaN only if all are)
        while state["size"] > RANKED_ROWS and state["lo"] != state["hi"] and not math.isnan(state["lo"]):
            state = _kept(_narrowed(values, state, keys, 0.0, False), keys)
    else:
        wide = (F.col("size") > RANKED_ROWS) & (F.col("lo") < F.col("hi"))
        while not state.where(wide).isEmpty():
            state = _kept(state.where(~wide).unionByName(_narrowed(values, state.where(wide), keys, 0.0, False)), keys)
    return _picked(values, state, keys)


def _picked(values: DataFrame, state: DataFrame | dict, keys: list[str]) -> DataFrame:
    """The last pass: at most ``RANKED_ROWS`` values inside an interval are kept, none where all are equal."""
    x, lo, hi = F.col("_x"), F.col("lo"), F.col("hi")
    near = _beside(values, state, keys, ["lo", "hi"]).where(x >= lo)
    inside = F.when((lo < hi) & (x <= hi), F.array_repeat(x, F.col("_w").cast("int")))
    ends = near.groupBy(*keys).agg(F.sort_array(F.flatten(F.collect_list(inside))).alias("v"),
                                   F.min(F.when(x > hi, x)).alias("above"))
    found = state.join(ends, keys) if keys else _beside(ends, state, keys, _STATE)
    rank = F.col("rank").cast("int")
    x1 = F.when(lo < hi, F.get("v", rank)).otherwise(lo)
    x2 = F.when(F.col("rank") + 1 >= F.col("size"), F.coalesce("above", x1)).otherwise(
        F.when(lo < hi, F.get("v", rank + 1)).otherwise(lo))
    quantile = F.when((F.col("frac") == 0) | (F.col("x2") == F.col("x1")), F.col("x1")).otherwise(
        F.col("x1") + (F.col("x2") - F.col("x1")) * F.col("frac"))
    return found.withColumns({"x1": x1, "x2": x2}).withColumn("quantile", quantile)
