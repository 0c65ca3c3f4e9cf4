"""VaR over the stream of scenario results.

Exact VaR per batch is computed over the cumulative table the ingest writes
(``running_var``), or kept current from keyed state (``stream_var_exact``).
``stream_var_approx`` is a streaming aggregate per batch with
``percentile_approx`` in complete mode.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.operators.quantile import tail_quantile
from tickspark.operators.risk import value_at_risk
from tickspark.schemas import SCENARIO_COLUMNS, SCENARIO_RESULT
from tickspark.streaming.ingest import epoch_name, ingested, rocksdb_state, start_stream
from tickspark.streaming.tail_state import OUT, TailProcessor, batch_of, keyed, unkeyed

VAR_RESULT = T.StructType([T.StructField("BATCH", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("VaR", T.DoubleType())])
_STORED = T.StructType([*SCENARIO_RESULT.fields, T.StructField("EPOCH", T.StringType())])
_TAILS = T.StructType([T.StructField("BATCH", T.StringType()), *OUT.fields[1:2], *OUT.fields[3:]])
#: Batches named in one partition filter.
BATCHES_AT_ONCE = 500


def running_var(spark: SparkSession, table_path: str, confidence: float = 0.99,
                by=("BATCH",), q: float | None = None) -> DataFrame:
    """Exact VaR per batch over everything ingested so far."""
    return value_at_risk(ingested(spark, table_path), confidence, by=list(by), q=q)


def stream_var_approx(results: DataFrame, confidence: float = 0.99, accuracy: int = 100_000,
                      q: float | None = None) -> DataFrame:
    """Streaming aggregate (complete mode): approximate VaR per batch."""
    qq = q if q is not None else round(1.0 - confidence, 12)
    return results.groupBy("BATCH").agg(
        F.count("RETURN").alias("n"),
        (-F.percentile_approx("RETURN", F.lit(qq), accuracy)).alias("VaR"))


def batch_store(spark: SparkSession, store_path: str, batches: list | None = None) -> DataFrame:
    """The store of ``stream_var_exact``, every scenario once; ``batches`` prunes to their folders."""
    rows = spark.read.schema(_STORED).parquet(store_path)
    return (rows if batches is None else rows.where(_named(batches))).select(*SCENARIO_COLUMNS)


def _named(batches: list):
    named = F.col("BATCH").isin([b for b in batches if b is not None])
    return named | F.col("BATCH").isNull() if None in batches else named


def _several(rows: DataFrame) -> Iterator[list]:
    some: list = []
    for r in rows.toLocalIterator():
        some.append(r[0])
        if len(some) == BATCHES_AT_ONCE:
            yield some
            some = []
    if some:
        yield some


def stream_var_exact(spark: SparkSession, results: DataFrame, store_path: str, var_path: str,
                     checkpoint: str, confidence: float = 0.99, q: float | None = None,
                     available_now: bool = True, processing_time: str | None = None,
                     slack: float | None = None, floor: int | None = None, state_partitions: int | None = None):
    """Exact VaR per batch, kept current as scenario results stream in.

    Keyed state on RocksDB (``TailProcessor``) passes every scenario on once, ever,
    and holds the lower tail of each batch's gains.  A micro-batch

    * stores its new scenarios, one folder per batch and micro-batch (a replay
      overwrites its own folders);
    * replaces the tails of the keys it touched (``<store_path>_tails``);
    * computes the VaR of the batches it touched from their tails, and writes it
      with dynamic partition overwrite (one folder per ``BATCH``, see ``read_var``).

    No stored scenario is read again unless the wanted rank lies past a batch's
    tail (its later gains are larger than its earlier ones, ``slack`` times over):
    that batch's VaR then comes from its folders.  One checkpoint per store.
    """
    qq = q if q is not None else round(1.0 - confidence, 12)
    tails_path = f"{store_path}_tails"
    options = {k: v for k, v in (("slack", slack), ("floor", floor)) if v is not None}

    def per_batch(out: DataFrame, epoch_id: int) -> None:
        epoch = epoch_name(checkpoint, epoch_id)
        out = out.persist()      # the state's output is used three times
        try:
            (unkeyed(out).withColumn("EPOCH", F.lit(epoch)).write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic").partitionBy("BATCH", "EPOCH").parquet(store_path))
            (out.where("ROW is null").select(batch_of(F.col("KEY")).alias("BATCH"), "SHARD", "N", "CUT", "XS", "CS")
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("BATCH", "SHARD").parquet(tails_path))
            for batches in _several(out.select(batch_of(F.col("KEY"))).distinct()):
                var = _batch_var(spark, store_path, tails_path, batches, qq)
                (var.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                    .partitionBy("BATCH").parquet(var_path))
        finally:
            out.unpersist()

    processor = TailProcessor(qq, **options)
    stream = keyed(results).groupBy("KEY", "SHARD").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=OUT, outputMode="Update", timeMode="None")
    writer = stream.writeStream.foreachBatch(per_batch).outputMode("update").option("checkpointLocation", checkpoint)
    with rocksdb_state(spark, state_partitions):
        return start_stream(writer, available_now, processing_time)


def _batch_var(spark: SparkSession, store_path: str, tails_path: str, batches: list, q: float) -> DataFrame:
    """``(BATCH, n, VaR)`` of some batches, from their tails; from their folders where a tail is too short."""
    keys = spark.read.schema(_TAILS).parquet(tails_path).where(_named(batches))
    totals = keys.groupBy("BATCH").agg(F.sum("N").alias("n"), F.min("CUT").alias("cut")).where("n > 0")
    # up to the least cut of a batch's keys every gain of the batch is held
    held = keys.select("BATCH", F.explode(F.arrays_zip(F.col("XS").alias("x"), F.col("CS").alias("count"))).alias("t"))
    near = held.select("BATCH", "t.x", "t.count").alias("h").join(
        totals.alias("g"), F.col("h.BATCH").eqNullSafe(F.col("g.BATCH"))).where("g.cut is null or h.x <= g.cut")
    found = tail_quantile(near.select("h.BATCH", "h.x", "h.count"), totals, q, "BATCH")
    var = found.select("BATCH", "n", (-F.col("quantile")).alias("VaR"))
    short = [r.BATCH for r in totals.join(found.select(F.col("BATCH").alias("B")), F.col("BATCH").eqNullSafe(F.col("B")),
                                          "left_anti").select("BATCH").collect()]
    if not short:
        return var
    return var.unionByName(value_at_risk(batch_store(spark, store_path, short), by=["BATCH"], q=q))


def read_var(spark: SparkSession, var_path: str) -> DataFrame:
    """What ``stream_var_exact`` has written: ``(BATCH, n, VaR)``, batch ids as text."""
    return spark.read.schema(VAR_RESULT).parquet(var_path)
