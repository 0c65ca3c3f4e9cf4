"""Scenario results as CSV files and as an appendable table."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.schemas import SCENARIO_COLUMNS, SCENARIO_RESULT, TIMESTAMP_TEXT_FORMAT


def write_scenarios_csv(df: DataFrame, path: str, mode: str = "append",
                        replace_batches: bool = False) -> None:
    """Header + columns, one folder per batch (``BATCH=<id>/``).

    Timestamps are written with microseconds and a ``UTC`` suffix (the
    default writer would truncate to milliseconds); text with commas
    (the portfolio list) is quoted by the writer.  ``replace_batches``
    overwrites only the folders of the batches being written, so a re-run
    of a batch replaces it instead of adding a second copy.
    """
    w = df.select(*SCENARIO_COLUMNS).write.partitionBy("BATCH")
    if replace_batches:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    w.option("header", True).option("timestampFormat", TIMESTAMP_TEXT_FORMAT).csv(path)


def read_scenarios_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read scenario CSV with the explicit result schema; a malformed row
    fails the load (``FAILFAST``) instead of becoming nulls."""
    return (spark.read.schema(SCENARIO_RESULT).option("header", True).option("mode", "FAILFAST")
            .option("timestampFormat", TIMESTAMP_TEXT_FORMAT).csv(path)
            .select(*SCENARIO_COLUMNS))


def read_scenarios_csv_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(good_rows, bad_lines)``: rows that parse under the schema, and the
    raw text of the lines that do not (the load job's error list) with
    whatever fields did parse."""
    schema = SCENARIO_RESULT.add("_corrupt_record", "string")
    raw = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", "_corrupt_record")
           .option("timestampFormat", TIMESTAMP_TEXT_FORMAT).csv(path))
    # the parsed columns ride along (Spark refuses a scan of only the
    # corrupt-record column)
    bad = raw.where(F.col("_corrupt_record").isNotNull()).select(
        F.col("_corrupt_record").alias("line"), F.input_file_name().alias("file"), *SCENARIO_COLUMNS)
    good = raw.where(F.col("_corrupt_record").isNull()).select(*SCENARIO_COLUMNS)
    return good, bad


def load_scenarios(spark: SparkSession, csv_path: str, table: str, mode: str = "append",
                   as_path: bool = True, errors: str = "fail", by_batch: bool = False) -> DataFrame:
    """Load CSV into the cumulative result table (append by default) and
    return the table.  ``table`` is a storage path, or a catalog table name
    when ``as_path`` is false.  ``errors='fail'`` aborts on a malformed
    row; ``errors='report'`` loads the good rows and returns the table
    with the bad lines attached as ``.load_errors`` (a DataFrame).

    ``by_batch=True`` stores the table partitioned by ``BATCH`` and
    replaces only the batches being loaded (dynamic partition overwrite):
    re-running a load after a failure leaves each batch exactly once, and
    per-batch VaR reads only its own folder.
    """
    bad = None
    if errors == "report":
        df, bad = read_scenarios_csv_checked(spark, csv_path)
    else:
        df = read_scenarios_csv(spark, csv_path)
    if by_batch and as_path:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("BATCH").parquet(table))
        out = read_store(spark, table)
    else:
        out = _append(spark, df, table, mode, as_path)
    out.load_errors = bad
    return out


def _append(spark: SparkSession, df: DataFrame, table: str, mode: str, as_path: bool) -> DataFrame:
    if as_path:
        df.write.mode(mode).parquet(table)
        return spark.read.parquet(table)
    df.write.mode(mode).saveAsTable(table)
    return spark.table(table)


def read_store(spark: SparkSession, table: str) -> DataFrame:
    """The result table under a path or catalog name, by its declared schema.

    The schema also types a ``BATCH`` partition folder, so batch ``007`` stays
    text (partition type inference would make it the number 7)."""
    if "/" in table or table.endswith(".parquet"):
        return spark.read.schema(SCENARIO_RESULT).parquet(table).select(*SCENARIO_COLUMNS)
    return spark.table(table)


def append_scenarios(df: DataFrame, table: str) -> None:
    """Append scenario rows to a Parquet table path."""
    df.select(*SCENARIO_COLUMNS).write.mode("append").parquet(table)


LEDGER = T.StructType([T.StructField("FILE", T.StringType()), T.StructField("LENGTH", T.LongType()),
                       T.StructField("LOAD", T.StringType())])


def load_ledger(spark: SparkSession, table: str) -> DataFrame:
    """Files that ``load_new_scenarios`` has taken: ``FILE, LENGTH, LOAD`` (empty before the first load)."""
    try:
        return spark.read.schema(LEDGER).parquet(f"{table}_ledger")
    except AnalysisException:
        return spark.createDataFrame([], LEDGER)


def load_new_scenarios(spark: SparkSession, csv_path: str, table: str) -> DataFrame:
    """Append the CSV files that no earlier load has taken, each exactly once, and return the table.

    A load's rows go to a folder of their own, named by the files it takes, and
    its files into the ledger last.  A load that fails before that is not there for
    readers (``read_loaded`` reads the loads of the ledger), and the next one takes
    its files again.  A file is known by name and length: one that was replaced by
    a longer one is loaded again.  A malformed row fails the load.  One load at a time.
    """
    there = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv*").load(csv_path)
    files = there.select(F.col("path").alias("FILE"), F.col("length").alias("LENGTH"))
    new = files.join(load_ledger(spark, table), ["FILE", "LENGTH"], "left_anti").orderBy("FILE").collect()
    if new:
        load = hashlib.sha256("\n".join(f"{r.FILE}:{r.LENGTH}" for r in new).encode()).hexdigest()[:32]
        rows = (spark.read.schema(SCENARIO_RESULT).option("header", True).option("mode", "FAILFAST").option("basePath", csv_path)
                .option("timestampFormat", TIMESTAMP_TEXT_FORMAT).csv([r.FILE for r in new if r.LENGTH]))
        rows.select(*SCENARIO_COLUMNS).write.mode("overwrite").parquet(f"{table}/LOAD={load}")
        (spark.createDataFrame([(r.FILE, r.LENGTH, load) for r in new], LEDGER).coalesce(1)
            .write.mode("append").parquet(f"{table}_ledger"))
    return read_loaded(spark, table)


def read_loaded(spark: SparkSession, table: str) -> DataFrame:
    """The rows of the loads in the ledger (others failed, and are left out)."""
    schema = T.StructType([*SCENARIO_RESULT.fields, T.StructField("LOAD", T.StringType())])
    loads = load_ledger(spark, table).select("LOAD").distinct()
    try:
        rows = spark.read.schema(schema).parquet(table)
    except AnalysisException:
        return spark.createDataFrame([], SCENARIO_RESULT)
    return rows.join(loads, "LOAD", "left_semi").select(*SCENARIO_COLUMNS)
