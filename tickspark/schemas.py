"""Explicit schemas for the tables the operators read and write."""

from pyspark.sql import types as T

TICKS = T.StructType([
    T.StructField("Seq", T.LongType()),
    T.StructField("Date_Time", T.TimestampNTZType()),
    T.StructField("RIC", T.StringType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Qualifiers", T.StringType()),
])

L2_QUOTES = T.StructType([
    T.StructField("date_time", T.TimestampNTZType()),
    T.StructField("RIC", T.StringType()),
    T.StructField("L2_BidPrice", T.DoubleType()),
])

DAILY_CLOSE = T.StructType([
    T.StructField("RIC", T.StringType()),
    T.StructField("Date", T.DateType()),
    T.StructField("Price", T.DoubleType()),
])

# Result table of the Monte Carlo job: the eight columns of the load job,
# plus SCENARIO_ID (ours) so redelivered rows can be recognised.
SCENARIO_RESULT = T.StructType([
    T.StructField("BATCH", T.StringType()),
    T.StructField("VENUE", T.StringType()),
    T.StructField("PORTFOLIO", T.StringType()),
    T.StructField("PORTFOLIO_VALUE", T.DoubleType()),
    T.StructField("START_DATE", T.TimestampType()),
    T.StructField("END_DATE", T.TimestampType()),
    T.StructField("DAYS", T.LongType()),
    T.StructField("RETURN", T.DoubleType()),
    T.StructField("SCENARIO_ID", T.LongType()),
])

SCENARIO_COLUMNS = [f.name for f in SCENARIO_RESULT.fields]

# JSON message: lower-case keys.  ``batch`` may arrive as a number or a
# string and ``return`` as an integer; reading them as string / double
# accepts both.
SCENARIO_MESSAGE = T.StructType([
    T.StructField("batch", T.StringType()),
    T.StructField("venue", T.StringType()),
    T.StructField("portfolio", T.StringType()),
    T.StructField("portfolio_value", T.DoubleType()),
    T.StructField("start_date", T.StringType()),
    T.StructField("end_date", T.StringType()),
    T.StructField("days", T.LongType()),
    T.StructField("return", T.DoubleType()),
    T.StructField("scenario_id", T.LongType()),
])

JOB_STAGE = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("records_read", T.LongType()),
])

JOB_HISTORY = T.StructType([
    T.StructField("job_id", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("creation_time", T.TimestampNTZType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("total_slot_ms", T.LongType()),
    T.StructField("total_bytes_processed", T.LongType()),
    T.StructField("job_stages", T.ArrayType(JOB_STAGE)),
])

# Text form of timestamps in CSV files and messages (microseconds, UTC).
TIMESTAMP_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'"
