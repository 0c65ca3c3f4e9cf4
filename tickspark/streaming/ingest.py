"""Ingest scenario messages into the cumulative result table; nothing is lost, nothing is stored twice.

Source: Kafka (``kafka_options``) or a folder of message text files.  Every
message is admitted whenever it arrives: a backfill whose files are hours old or
a lagging partition like any other.  A micro-batch writes its own folder (named by
checkpoint and epoch, overwritten on replay), so a failure or a re-run on the
same checkpoint adds nothing twice.  Text that is not a scenario message goes to
a quarantine table with its source and reason.

Redelivered copies - the same ``(BATCH, SCENARIO_ID)`` or, without an id, the same
payload - are removed twice over.  In the stream, ``dropDuplicatesWithinWatermark``
on the time of ingest (which is never late) holds the keys of the last ``window``
in RocksDB and lets them go after it.  Copies that come later than the window, or
through another checkpoint, are found by an anti-join of the micro-batch with
what was stored before the window, in the folders of the batches it names only.
So the store holds every scenario once, and reading it is a plain scan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.schemas import SCENARIO_COLUMNS, SCENARIO_RESULT
from tickspark.sources.files import read_store
from tickspark.sources.messages import checked_messages

#: How long the stream itself remembers a scenario.
WINDOW = "1 hour"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_PARTITIONS = "spark.sql.shuffle.partitions"
#: Counting a state's rows costs a read before each write; a commit uploads the changes, not the files they went to.
_FASTER = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
           "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}

STORED = T.StructType([*SCENARIO_RESULT.fields, T.StructField("PAYLOAD_KEY", T.StringType()),
                       T.StructField("INGESTED", T.TimestampType())])
#: Folders of the store: one per micro-batch, in it one per batch id.
_FOLDERS = [T.StructField("EPOCH", T.StringType()), T.StructField("OF_BATCH", T.StringType())]
QUARANTINE = T.StructType([T.StructField("PAYLOAD", T.StringType()), T.StructField("ERROR", T.StringType()),
                           T.StructField("SOURCE", T.StringType()), T.StructField("ARRIVAL", T.TimestampType())])


def message_stream(spark: SparkSession, path: str | None = None, kafka_options: dict | None = None,
                   max_files_per_trigger: int | None = None, file_options: dict | None = None) -> DataFrame:
    """Streaming frame of raw messages: ``value`` (text), ``SOURCE`` (file, or
    topic, partition and offset) and ``ARRIVAL`` (timestamp).

    For a long-running file source, pass ``file_options={"cleanSource": "archive",
    "sourceArchiveDir": ...}`` so processed files leave the input folder and
    the per-trigger listing stays small."""
    if kafka_options:
        raw = spark.readStream.format("kafka").options(**kafka_options).load()
        return raw.select(F.col("value").cast("string").alias("value"),
                          F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
                          .alias("SOURCE"), F.col("timestamp").alias("ARRIVAL"))
    reader = spark.readStream.format("text").options(**(file_options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(path)
    return raw.select("value", F.col("_metadata.file_path").alias("SOURCE"),
                      F.col("_metadata.file_modification_time").alias("ARRIVAL"))


def batch_key(batch: Column) -> Column:
    """A batch id as a text that is never null (nor empty, which a folder name cannot be)."""
    return F.coalesce(F.concat(F.lit("="), batch), F.lit("null"))


def scenario_key(rows: DataFrame) -> Column:
    """What makes two rows of a batch the same scenario: the id, else ``PAYLOAD_KEY``, else all values."""
    whole = F.sha2(F.to_json(F.struct(*[F.col(c) for c in SCENARIO_COLUMNS])), 256)
    payload = F.coalesce(F.col("PAYLOAD_KEY"), whole) if "PAYLOAD_KEY" in rows.columns else whole
    return F.coalesce(F.col("SCENARIO_ID").cast("string"), payload)


def distinct_scenarios(rows: DataFrame) -> DataFrame:
    """Every scenario once.  The scenario is part of the key, so a batch holding
    most of the rows spreads over many tasks."""
    keyed = rows.withColumn("_key", scenario_key(rows))
    return keyed.dropDuplicates(["BATCH", "_key"]).select(*SCENARIO_COLUMNS)


def ingested(spark: SparkSession, table_path: str) -> DataFrame:
    """The cumulative table.  The ingest stores every scenario once, so this is a plain scan."""
    return (spark.read.schema(STORED).option("recursiveFileLookup", "true").parquet(table_path)
            .select(*SCENARIO_COLUMNS))


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, a new checkpoint's in so many ``partitions`` (None: as the
    session's ``spark.sql.shuffle.partitions`` says).  A query copies the session's settings when it starts."""
    settings = {_PROVIDER: ROCKSDB} | _FASTER | ({_PARTITIONS: str(partitions)} if partitions else {})
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def quarantined(spark: SparkSession, table_path: str) -> DataFrame:
    """Messages that could not be read: ``PAYLOAD, ERROR, SOURCE, ARRIVAL``."""
    return spark.read.schema(QUARANTINE).option("recursiveFileLookup", "true").parquet(f"{table_path}_quarantine")


def start_stream(writer, available_now: bool = True, processing_time: str | None = None):
    """Start a streaming write; with ``available_now`` the call returns after
    everything available is done."""
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(processingTime=processing_time or "10 seconds").start()


def epoch_name(checkpoint: str, epoch_id: int | str) -> str:
    """A folder name per checkpoint and epoch: replays meet their own folder, other runs never do."""
    return f"epoch-{zlib.crc32(checkpoint.encode()):08x}-{epoch_id}"


def _stored_before(spark: SparkSession, table_path: str, checkpoint: str, epoch: str, batch: DataFrame,
                   window: str) -> DataFrame | None:
    """Keys stored before the stream's memory of this checkpoint begins, or through others, of the batches of ``batch``."""
    try:
        rows = spark.read.schema(T.StructType([*STORED.fields, *_FOLDERS])).parquet(table_path)
    except AnalysisException:          # nothing stored yet
        return None
    now = batch.agg(F.max("INGESTED")).first()[0]
    if now is None:                    # no message: the micro-batch only lets old keys go
        return None
    # a key leaves the state when two windows have passed: one is on the safe side
    old = (F.col("INGESTED") <= F.lit(now) - F.expr(f"interval {window}")) | ~F.startswith("EPOCH", F.lit(epoch_name(checkpoint, "")))
    # this micro-batch's own folder, where it runs again, is about to be overwritten
    old = old & (F.col("EPOCH") != epoch)
    named = batch.select(batch_key(F.col("BATCH")).alias("OF_BATCH")).distinct()
    return rows.where(old).join(F.broadcast(named) if named.count() <= 10_000 else named, "OF_BATCH", "left_semi").select(
        "BATCH", scenario_key(rows).alias("_key"))


def ingest_messages(spark: SparkSession, table_path: str, checkpoint: str, path: str | None = None,
                    kafka_options: dict | None = None, available_now: bool = True,
                    processing_time: str | None = None, max_files_per_trigger: int | None = None,
                    window: str = WINDOW, state_partitions: int | None = None):
    """Start the ingest query; with ``available_now`` it processes what is
    there and returns after the query stops.  Returns the query handle.
    ``state_partitions`` of a new checkpoint stay what they are."""
    def store(batch: DataFrame, epoch_id: int) -> None:
        epoch = epoch_name(checkpoint, epoch_id)
        batch = batch.persist()      # the state's output is used several times
        try:
            good = batch.where("ERROR is null")
            before = _stored_before(spark, table_path, checkpoint, epoch, good, window)
            if before is not None:
                same = (F.col("n.BATCH").eqNullSafe(F.col("b.BATCH"))) & (F.col("n._key") == F.col("b._key"))
                good = good.alias("n").join(before.alias("b"), same, "left_anti")
            (good.select(*STORED.fieldNames(), batch_key(F.col("BATCH")).alias("OF_BATCH")).write.mode("overwrite")
                 .partitionBy("OF_BATCH").parquet(f"{table_path}/EPOCH={epoch}"))
            (batch.where("ERROR is not null").select(*QUARANTINE.fieldNames())
                  .write.mode("overwrite").parquet(f"{table_path}_quarantine/{epoch}"))
        finally:
            batch.unpersist()

    checked = checked_messages(message_stream(spark, path, kafka_options, max_files_per_trigger))
    # what only messages without an id or in quarantine need does not travel with the others
    bad, hashed = F.col("ERROR").isNotNull(), F.sha2("PAYLOAD", 256)
    keyed = checked.select(
        *SCENARIO_COLUMNS, *[F.when(bad, F.col(c)).alias(c) for c in ("PAYLOAD", "SOURCE", "ARRIVAL")], "ERROR",
        F.when(bad | F.col("SCENARIO_ID").isNull(), hashed).alias("PAYLOAD_KEY"), F.current_timestamp().alias("INGESTED"))
    key = F.when(F.col("ERROR").isNull(), scenario_key(keyed)).otherwise(F.concat(F.lit("!"), F.col("PAYLOAD_KEY")))
    once = keyed.withColumn("_key", key).withWatermark("INGESTED", window).dropDuplicatesWithinWatermark(["BATCH", "_key"])
    writer = once.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    with rocksdb_state(spark, state_partitions):
        return start_stream(writer, available_now, processing_time)


def compact_store(spark: SparkSession, table_path: str, out_path: str,
                  partition_by_batch: bool = True) -> DataFrame:
    """Rewrite a result table (or an ingest's many small folders) with every scenario exactly once, also where
    rows were appended by other means."""
    rows = spark.read.schema(STORED).option("recursiveFileLookup", "true").parquet(table_path)
    writer = distinct_scenarios(rows).write.mode("overwrite")
    if partition_by_batch:
        writer = writer.partitionBy("BATCH")
    writer.parquet(out_path)
    return read_store(spark, out_path)
