"""Scalar expressions with engine-neutral semantics."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the deterministic normal generator (Box-Muller over two
# multiplicative congruential streams), used where scenarios must be
# reproducible outside Spark.
LCG_A1, LCG_C1, LCG_M1 = 7368787, 1, 2147483647
LCG_A2, LCG_C2, LCG_M2 = 1299709, 12345, 2147483629


def lcg_normal(id_col) -> Column:
    """Standard normal draw as a pure function of a positive long id."""
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    u1 = (((i * LCG_A1 + LCG_C1) % LCG_M1) + F.lit(0.5)) / F.lit(float(LCG_M1))
    u2 = ((i * LCG_A2 + LCG_C2) % LCG_M2) / F.lit(float(LCG_M2))
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)


def hashed_normal(id_col, seed: int) -> Column:
    """Standard normal draw as a pure function of (seed, id): Box-Muller over two 53-bit hashes."""
    i = F.col(id_col) if isinstance(id_col, str) else id_col

    def uniform(stream: int) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(int(seed)).cast("long"), F.lit(stream), i), 11)
        return (bits + F.lit(0.5)) / F.lit(float(1 << 53))

    return F.sqrt(F.lit(-2.0) * F.ln(uniform(1))) * F.cos(F.lit(2.0 * math.pi) * uniform(2))


def truncate_time(unit: str, ts, like_type=None) -> Column:
    """``date_trunc`` that keeps the input's timestamp flavour.

    ``date_trunc`` on a ``timestamp_ntz`` returns a session-zone timestamp;
    casting back keeps wall-clock values and the original type.
    """
    col = F.col(ts) if isinstance(ts, str) else ts
    out = F.date_trunc(unit, col)
    return out.cast(like_type) if like_type is not None else out
