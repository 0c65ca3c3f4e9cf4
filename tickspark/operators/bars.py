"""High/low bid bars at minute / hour / day grain.

``max`` and ``min`` aggregate partially on the map side, so each map task
sends at most one row per (instrument, bar) to the shuffle, however hot
the instrument is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.functions.filters import in_time_range, restrict_instruments
from tickspark.functions.scalars import truncate_time

BAR_UNITS = ("MINUTE", "HOUR", "DAY")


def bid_bars(l2: DataFrame, unit: str, start=None, end=None, rics=None,
             ts: str = "date_time", price: str = "L2_BidPrice",
             preview: int | None = None) -> DataFrame:
    """``RIC, time_group, max_bid, min_bid`` per instrument and truncated time.

    ``preview`` keeps the first ``preview`` bars in ``(RIC, time_group)``
    order: a top-k report (taken per partition, then merged), not a cap on
    the computation.
    """
    unit = unit.upper()
    if unit not in BAR_UNITS:
        raise ValueError(f"unit must be one of {BAR_UNITS}, got {unit!r}")
    ts_type = l2.schema[ts].dataType
    # Group on the truncated value and restore the input's timestamp type
    # afterwards: one conversion per bar instead of one per quote.
    bars = (restrict_instruments(l2.where(in_time_range(ts, start, end)), rics)
              .groupBy("RIC", truncate_time(unit, ts).alias("_bar"))
              .agg(F.max(price).alias("max_bid"), F.min(price).alias("min_bid"))
              .select("RIC", F.col("_bar").cast(ts_type).alias("time_group"), "max_bid", "min_bid"))
    if preview is not None:
        return bars.orderBy("RIC", "time_group").limit(preview)
    return bars
