"""Run history from Spark's own event log, in the ``job_history`` schema.

The reference reads the warehouse's job-history table to report the run
time, slot time, speed-up and rows read of the queries it just ran.  On
Spark the same facts are in the event log (``spark.eventLog.dir``; plain
or compressed JSON lines, rolling or single-file).  One SQL execution (or
one job outside SQL) becomes one history row; its completed stages, in
id order, become ``job_stages`` named ``S<nn>: Input`` when the stage read
input rows and ``S<nn>: <stage name>`` otherwise, with the rows it read.
Slot time is the summed executor run time of those stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.session import shared_path

EVENT_SCHEMA = T.StructType([
    T.StructField("Event", T.StringType()),
    T.StructField("App ID", T.StringType()),
    T.StructField("Job ID", T.LongType()),
    T.StructField("Submission Time", T.LongType()),
    T.StructField("Completion Time", T.LongType()),
    T.StructField("Stage IDs", T.ArrayType(T.LongType())),
    T.StructField("Properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("Job Result", T.StructType([T.StructField("Result", T.StringType())])),
    T.StructField("Stage Info", T.StructType([
        T.StructField("Stage ID", T.LongType()),
        T.StructField("Stage Attempt ID", T.LongType()),
        T.StructField("Stage Name", T.StringType()),
        T.StructField("Accumulables", T.ArrayType(T.StructType([
            T.StructField("Name", T.StringType()), T.StructField("Value", T.StringType())]))),
    ])),
])

# The event and metric names of Spark's event log.
APP_START = "SparkListenerApplicationStart"
JOB_START, JOB_END, STAGE_DONE = "SparkListenerJobStart", "SparkListenerJobEnd", "SparkListenerStageCompleted"
RUN_TIME = "internal.metrics.executorRunTime"
INPUT_ROWS = "internal.metrics.input.recordsRead"
INPUT_BYTES = "internal.metrics.input.bytesRead"
SHUFFLE_ROWS = "internal.metrics.shuffle.read.recordsRead"


def _log_key():
    """What one application's log files share: the folder of a rolling log, else the file's own name."""
    name = F.input_file_name()
    rolling = F.regexp_extract(name, r"^(.*/eventlog_v2_[^/]*)/[^/]*$", 1)
    return F.when(rolling != "", rolling).otherwise(name)


def read_event_log_jobs(spark: SparkSession, path: str) -> DataFrame:
    """``job_history`` rows (``job_id, state, query, creation_time, start_time,
    end_time, total_slot_ms, total_bytes_processed, job_stages``) from event
    logs under ``path`` (a file, a folder, or a glob).

    The logs are read once: the few events that matter go to a table in the
    shared folder.  Runs are told apart by application id (by log, for a log
    without one); of a stage's attempts the last counts."""
    events = shared_path(spark, "event-log")
    (spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").json(path)
          .where(F.col("Event").isin(APP_START, JOB_START, JOB_END, STAGE_DONE))
          .withColumn("log", _log_key()).write.parquet(events))
    ev = spark.read.parquet(events)
    ids = ev.where(F.col("Event") == APP_START).groupBy("log").agg(F.max("App ID").alias("id"))
    ev = ev.join(ids, "log", "left").withColumn("app", F.coalesce("id", "log")).drop("id")
    props = F.col("Properties")
    starts = ev.where(F.col("Event") == JOB_START).select(
        "app", F.col("Job ID").alias("job"), F.col("Submission Time").alias("submitted"),
        F.col("Stage IDs").alias("stage_ids"),
        F.coalesce(props["spark.job.description"], props["callSite.short"]).alias("query"),
        F.coalesce(F.concat(F.lit("sql-"), props["spark.sql.execution.id"]),
                   F.concat(F.lit("job-"), F.col("Job ID").cast("string"))).alias("run"))
    ends = ev.where(F.col("Event") == JOB_END).select(
        "app", F.col("Job ID").alias("job"), F.col("Completion Time").alias("completed"),
        F.col("Job Result.Result").alias("result"))
    runs = (starts.join(ends, ["app", "job"], "left")
                  .groupBy("app", "run")
                  .agg(F.min("job").alias("job_id"), F.min("submitted").alias("submitted"),
                       F.max("completed").alias("completed"), F.first("query", True).alias("query"),
                       F.min(F.coalesce(F.col("result") == "JobSucceeded", F.lit(False))).alias("ok"),
                       F.array_distinct(F.flatten(F.collect_list("stage_ids"))).alias("stage_ids")))

    info = ev.where(F.col("Event") == STAGE_DONE).select("app", "Stage Info.*")
    metric = lambda name: F.sum(F.when(F.col("acc.Name") == name, F.col("acc.Value").cast("long")))
    last = info.groupBy("app", "Stage ID").agg(F.max("Stage Attempt ID").alias("Stage Attempt ID"))
    info = info.join(last, ["app", "Stage ID", "Stage Attempt ID"])
    stages = (info.select("app", F.col("Stage ID").alias("stage"), F.col("Stage Name").alias("stage_name"),
                          F.explode_outer("Accumulables").alias("acc"))
                  .groupBy("app", "stage", "stage_name")
                  .agg(metric(RUN_TIME).alias("run_ms"), metric(INPUT_ROWS).alias("input_rows"),
                       metric(INPUT_BYTES).alias("input_bytes"), metric(SHUFFLE_ROWS).alias("shuffle_rows")))

    # Stages of each run in id order (skipped stages never complete and drop out).
    per_stage = (runs.select("app", "run", F.explode("stage_ids").alias("stage"))
                     .join(stages, ["app", "stage"]))
    idx = F.row_number().over(Window.partitionBy("app", "run").orderBy("stage")) - 1
    reads_input = F.coalesce(F.col("input_rows"), F.lit(0)) > 0
    named = per_stage.withColumn("idx", idx).withColumn(
        "name", F.concat(F.lit("S"), F.lpad(F.col("idx").cast("string"), 2, "0"), F.lit(": "),
                         F.when(reads_input, F.lit("Input")).otherwise(F.col("stage_name"))))
    rows_read = F.when(reads_input, F.col("input_rows")).otherwise(F.coalesce(F.col("shuffle_rows"), F.lit(0)))
    stage_lists = (named.groupBy("app", "run")
                        .agg(F.sort_array(F.collect_list(F.struct("idx", F.col("name"), rows_read.alias("records_read"))))
                              .alias("s"),
                             F.sum(F.coalesce(F.col("run_ms"), F.lit(0))).alias("total_slot_ms"),
                             F.sum(F.coalesce(F.col("input_bytes"), F.lit(0))).alias("total_bytes_processed"))
                        .select("app", "run", "total_slot_ms", "total_bytes_processed",
                                F.transform("s", lambda e: F.struct(e["name"].alias("name"),
                                                                    e["records_read"].alias("records_read")))
                                 .alias("job_stages")))
    ts = lambda c: F.timestamp_millis(F.col(c)).cast("timestamp_ntz")
    return (runs.join(stage_lists, ["app", "run"], "left")
                .select(F.col("job_id").cast("long").alias("job_id"),
                        F.when(F.col("ok") & F.col("completed").isNotNull(), "DONE")
                         .when(F.col("completed").isNull(), "RUNNING").otherwise("FAILED").alias("state"),
                        F.coalesce(F.col("query"), F.col("run")).alias("query"),
                        ts("submitted").alias("creation_time"), ts("submitted").alias("start_time"),
                        ts("completed").alias("end_time"),
                        F.col("total_slot_ms").cast("long").alias("total_slot_ms"),
                        F.col("total_bytes_processed").cast("long").alias("total_bytes_processed"),
                        F.coalesce(F.col("job_stages"), F.array().cast("array<struct<name:string,records_read:bigint>>"))
                         .alias("job_stages")))
