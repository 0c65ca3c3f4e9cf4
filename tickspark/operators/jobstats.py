"""Job run statistics from a history table with nested stage arrays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the run-statistics query.
DONE_STATE = "DONE"
INPUT_STAGE = "S00: Input"
SELF_QUERY_PATTERN = "%INFORMATION_SCHEMA%"


def explode_stages(jobs: DataFrame, stages: str = "job_stages") -> DataFrame:
    """Lateral unnest: one row per (job, stage); jobs with no stages vanish."""
    others = [c for c in jobs.columns if c != stages]
    return jobs.select(*others, F.inline(F.col(stages)))


def stage_inputs(history: DataFrame, since=None) -> DataFrame:
    """Finished jobs (not the statistics queries themselves) created at or
    after ``since``, one row per job with its input stage's row count.
    ``since='today'`` means the start of the current (session-zone) day."""
    cond = (F.col("state") == F.lit(DONE_STATE)) & ~F.col("query").like(SELF_QUERY_PATTERN)
    if since is not None:
        ts_type = history.schema["creation_time"].dataType
        start = F.current_date() if since == "today" else F.lit(since)
        cond = cond & (F.col("creation_time") >= start.cast(ts_type))
    rows = explode_stages(history.where(cond)).where(F.col("name") == F.lit(INPUT_STAGE))
    exec_ms = F.timestamp_diff("MILLISECOND", F.col("start_time"), F.col("end_time"))
    return rows.select(
        "job_id", "creation_time", "total_slot_ms", "total_bytes_processed",
        exec_ms.alias("execution_time_ms"),
        F.try_divide(F.col("total_slot_ms"), exec_ms).alias("speedup"),
        F.col("records_read").alias("rows_read"),
    )


def job_stats(history: DataFrame, since=None, k: int | None = 1) -> DataFrame:
    """The newest ``k`` runs (``ORDER BY creation_time DESC LIMIT k``), ties
    broken by ``job_id``; ``k=None`` returns every qualifying run."""
    rows = stage_inputs(history, since)
    if k is None:
        return rows
    return rows.orderBy(F.col("creation_time").desc(), F.col("job_id").desc()).limit(k)


def job_scale_summary(stats: DataFrame) -> DataFrame:
    """Rows read in billions, slot time in hours, wall time in seconds."""
    return stats.select(
        "job_id",
        (F.col("rows_read") / F.lit(1e9)).alias("rows_billions"),
        (F.col("total_slot_ms") / F.lit(1000.0) / F.lit(3600.0)).alias("slot_hours"),
        (F.col("execution_time_ms") / F.lit(1000.0)).alias("wall_seconds"),
    )
