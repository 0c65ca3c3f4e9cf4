"""Table scans, derived fixture views, and file / message sinks."""

from tickspark.sources.tables import (
    read_table,
    read_ticks,
    read_l2,
    read_daily_close,
    read_adjusted_close_csv,
    read_job_history,
    register_view,
    write_ticks,
    write_bucketed_ticks,
)

__all__ = ["read_table", "read_ticks", "read_l2", "read_daily_close", "read_adjusted_close_csv",
           "read_job_history", "register_view", "write_ticks",
           "write_bucketed_ticks"]
