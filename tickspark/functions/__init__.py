"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from tickspark.functions.filters import (
    in_time_range,
    in_instruments,
    restrict_instruments,
    market_model_flags,
    regular_trade,
    regular_trades,
)
from tickspark.functions.scalars import hashed_normal, lcg_normal, truncate_time

__all__ = [
    "in_time_range", "in_instruments", "restrict_instruments", "market_model_flags", "regular_trade",
    "regular_trades", "hashed_normal", "lcg_normal", "truncate_time",
]
