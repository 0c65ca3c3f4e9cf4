"""Scenario messages: one JSON object per scenario.

The message topic of the reference has no open-source Spark connector;
messages go to Kafka when options are given, else to text files (one
message per line), which the streaming ingest reads the same way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.schemas import SCENARIO_COLUMNS, SCENARIO_MESSAGE, TIMESTAMP_TEXT_FORMAT


def _ts_text(c: str) -> Column:
    return F.date_format(F.col(c), TIMESTAMP_TEXT_FORMAT)


def scenario_messages(df: DataFrame, *others: str) -> DataFrame:
    """``value``: the JSON text of each scenario row, lower-case keys (after ``others``, columns of ``df``)."""
    body = F.struct(
        F.col("BATCH").alias("batch"), F.col("VENUE").alias("venue"),
        F.col("PORTFOLIO").alias("portfolio"), F.col("PORTFOLIO_VALUE").alias("portfolio_value"),
        _ts_text("START_DATE").alias("start_date"), _ts_text("END_DATE").alias("end_date"),
        F.col("DAYS").alias("days"), F.col("RETURN").alias("return"),
        F.col("SCENARIO_ID").alias("scenario_id"))
    return df.select(*others, F.to_json(body).alias("value"))


def keyed_messages(df: DataFrame) -> DataFrame:
    """``key`` (batch and scenario id; null without an id) and ``value`` of each scenario row, for ``publisher.publish``."""
    key = F.when(F.col("SCENARIO_ID").isNotNull(), F.concat_ws("/", "BATCH", F.col("SCENARIO_ID").cast("string")))
    return scenario_messages(df.withColumn("key", key), "key")


def write_scenario_messages(df: DataFrame, path: str | None = None,
                            kafka_options: dict | None = None, mode: str = "append") -> None:
    """Publish every scenario as one message (Kafka topic or text files)."""
    msgs = scenario_messages(df)
    if kafka_options:
        msgs.write.format("kafka").options(**kafka_options).save()
    elif path:
        msgs.write.mode(mode).text(path)
    else:
        raise ValueError("give a path or kafka_options")


def checked_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """JSON text -> result-table columns, ``PAYLOAD`` (the text), ``ERROR`` and
    the other columns of ``raw``.

    ``batch`` may be a number or a string and ``return`` an integer; both
    parse.  ``ERROR`` is null for a good message, else says what is wrong: text
    that is not such a JSON object, or a date that is none.
    """
    text = F.col(value).cast("string")
    schema = T.StructType([*SCENARIO_MESSAGE.fields, T.StructField("_bad", T.StringType())])
    m = F.from_json(text, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    others = [c for c in raw.columns if c != value]
    # exploded: a condition on what was read would else read the JSON text again, for each of its columns
    parsed = raw.select(text.alias("PAYLOAD"), F.explode(F.array(m)).alias("m"), *others)
    to_ts = lambda c: F.try_to_timestamp(F.col(f"m.{c}"), F.lit(TIMESTAMP_TEXT_FORMAT))
    no_date = lambda c: F.col(f"m.{c}").isNotNull() & to_ts(c).isNull()
    error = (F.when(F.col("m").isNull() | F.col("m._bad").isNotNull(), F.lit("not a scenario message"))
             .when(F.col("m.batch").isNull() & F.col("m.return").isNull(), F.lit("not a scenario message"))
             .when(no_date("start_date") | no_date("end_date"), F.lit("bad date")))
    return parsed.select(
        F.col("m.batch").alias("BATCH"), F.col("m.venue").alias("VENUE"),
        F.col("m.portfolio").alias("PORTFOLIO"), F.col("m.portfolio_value").alias("PORTFOLIO_VALUE"),
        to_ts("start_date").alias("START_DATE"), to_ts("end_date").alias("END_DATE"),
        F.col("m.days").alias("DAYS"), F.col("m.return").alias("RETURN"),
        F.col("m.scenario_id").alias("SCENARIO_ID"), "PAYLOAD", error.alias("ERROR"), *others)


def parse_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """The good messages as result-table columns (with the other columns of ``raw``)."""
    return checked_messages(raw, value).where("ERROR is null").drop("PAYLOAD", "ERROR")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of message text files into result-table rows."""
    return parse_messages(spark.read.text(path)).select(*SCENARIO_COLUMNS)


def sample_messages(spark: SparkSession, n: int = 10, batch: str = "0", venue: str = "LSE",
                    portfolio: str = "", portfolio_value: float = 1_000_000.0,
                    start_date: str | None = None, end_date: str | None = None,
                    days: int = 20) -> DataFrame:
    """Smoke-test publisher payloads: ``n`` messages whose ``return`` is the
    integer ``0..n-1`` (no scenario id, as the reference's test publisher)."""
    body = F.struct(F.lit(batch).alias("batch"), F.lit(venue).alias("venue"),
                    F.lit(portfolio).alias("portfolio"),
                    F.lit(float(portfolio_value)).alias("portfolio_value"),
                    F.lit(start_date).alias("start_date"), F.lit(end_date).alias("end_date"),
                    F.lit(int(days)).alias("days"), F.col("id").alias("return"))
    return spark.range(n).select(F.to_json(body).alias("value"))
