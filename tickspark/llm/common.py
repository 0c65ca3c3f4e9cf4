"""Shared helpers: written intermediate tables, gapless numbering, text batches, word hashes."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickspark.session import shared_path

#: Characters handled together inside a task; bounds a task's memory whatever the table's size.
BATCH_CHARS = 2_000_000


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the cluster's shared folder and read back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs a re-read and not a recomputation.
    """
    spark = df.sparkSession
    path = shared_path(spark, f"llm-{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def number_within(df: DataFrame, group: list[str], order: list[str], into: str, name: str) -> DataFrame:
    """Add ``into``: a gapless 0-based number of each row within ``group``, in ``order``.

    Rows are range partitioned by group and order, so a group of any size
    spreads over as many tasks as its rows need.  Only the row counts per
    (partition, group) - at most one row per partition and group - are scanned
    in one place.  Rows that tie in ``order`` get distinct numbers.
    """
    keys = [F.col(c) for c in group + order]
    laid = written(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                   .withColumn("__at", F.monotonically_increasing_id()), name)
    part = F.shiftright(F.col("__at"), 33)
    runs = (laid.groupBy(part.alias("__part"), *group)
            .agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__rows")))
    before = (Window.partitionBy(*group).orderBy("__part")
              .rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("__base", F.coalesce(F.sum("__rows").over(before), F.lit(0))).drop("__rows")
    # one row per (partition, group): bounded by the partition count, never by the data
    return (laid.withColumn("__part", part)
            .join(F.broadcast(runs), ["__part", *group])
            .withColumn(into, F.col("__base") + F.col("__at") - F.col("__first"))
            .drop("__part", "__at", "__first", "__base"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def slices(texts: list[str], chars: int = BATCH_CHARS, rows: int = 512) -> Iterator[tuple[int, int]]:
    """Index ranges of ``texts`` of at most ``rows`` texts and about ``chars`` characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars or i - start + 1 >= rows:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def column_texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The text column as Python strings, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1, ...: Python tasks take no column whose name holds a dot."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


#: Columns of ``documents`` that a pipeline stage may name; others are passed through under names of ours.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def on_documents(stage: Callable) -> Callable:
    """A pipeline stage whose further columns may have any name: they go through it as x0, x1, ... and come out under
    their own names (a dot in a name, or a name that the stage uses inside, changes nothing)."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        inner = [c if c in DOCUMENT_COLUMNS else f"x{i}" for i, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*inner), sf_dir).select(*inner).toDF(*docs.columns)

    return run


def with_fields(schema: T.StructType, *fields: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, *fields])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply-xorshift), elementwise on uint64."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


#: Characters of which it is known without a look at Unicode whether they belong to a word: ASCII and Latin letters.
_PLAIN = re.compile("[^\\x00-\\x7f\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]")
_WORD = re.compile(r"\w+")
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*b"abcdefghijklmnopqrstuvwxyz0123456789_", *range(128, 256)]] = True
_BYTE_CODE = None


def word_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit codes of the lower-cased words - runs of \\w - of all texts in order, words per text).

    Words are found and hashed for all texts at once, on their UTF-8 bytes;
    texts beyond Latin are cut by the regular expression first.
    """
    global _BYTE_CODE
    if _BYTE_CODE is None:
        _BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64))
    lowered = [t.lower() for t in texts]
    parts = [(t if t.isascii() or not _PLAIN.search(t) else " ".join(_WORD.findall(t))).encode("utf-8", "surrogatepass")
             for t in lowered]
    flat = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    inside = _WORD_BYTE[flat]
    first = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
    size = np.flatnonzero(~inside & np.append(False, inside[:-1])) - first
    ends = np.cumsum([len(p) + 1 for p in parts])
    per_text = np.diff(np.append(0, np.searchsorted(first, ends)))
    if not len(first):
        return np.zeros(0, np.uint64), per_text
    power = np.full(int(size.max()), 0x9E3779B97F4A7C15, np.uint64)
    power[0] = 1
    power = np.cumprod(power)
    letters = flat[inside]
    begin = np.cumsum(size) - size
    place = np.arange(len(letters)) - np.repeat(begin, size)
    return mix(np.add.reduceat(_BYTE_CODE[letters] * power[place], begin) + size.astype(np.uint64)), per_text


def split_codes(texts: list[str]) -> list[np.ndarray]:
    """The word codes of each text."""
    codes, per_text = word_codes(texts)
    return np.split(codes, np.cumsum(per_text)[:-1]) if len(texts) else []


def gram_codes(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit code of each run of ``n`` consecutive word codes (order matters)."""
    if len(codes) < n:
        return np.zeros(0, np.uint64)
    total, width, done, power = None, 1, 0, codes
    # binary composition: runs of 1, 2, 4, ... words, joined where n has a bit
    while True:
        if n & width:
            piece = power[done: len(codes) - n + done + 1]
            total = mix(piece) if total is None else mix(total * np.uint64(0x9E3779B97F4A7C15) + piece)
            done += width
        if width * 2 > n:
            return total
        power = mix(power[:-width] * np.uint64(0xC2B2AE3D27D4EB4F) + power[width:])
        width *= 2


def ranges_concat(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``concatenate([arange(s, s + c) for s, c in zip(starts, counts)])`` without the loop."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)


def batches_of(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in batches if b.num_rows)


def sum_arrays(df: DataFrame, share, shape: tuple[int, ...], blocks: int = 16, kind: type = np.float64) -> np.ndarray:
    """The sum over all tasks of ``share(batches)``, an array of ``shape``.

    Tasks return their share in blocks and the blocks are added in Spark, so
    the driver receives one array however many tasks there are.  ``kind`` is the
    type in which shares are sent (float32: half the shuffle); sums are doubles.
    """
    import pandas as pd

    size = int(np.prod(shape))
    width = max(1, -(-size // blocks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.asarray(share(batches), np.float64).ravel()
        cut = [flat[lo: lo + width].astype(kind).tobytes() for lo in range(0, size, width)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cut)), pa.int64()), pa.array(cut, pa.binary())],
                                         names=["block", "v"])

    def add(key, frame):
        # sorted: the sum does not depend on the order in which the shares arrive
        total = np.sum(np.stack([np.frombuffer(v, kind) for v in sorted(frame.v)]), axis=0, dtype=np.float64)
        return pd.DataFrame({"block": [key[0]], "v": [total.tobytes()]})

    rows = df.mapInArrow(run, "block bigint, v binary").groupBy("block").applyInPandas(add, "block bigint, v binary")
    found = sorted(rows.collect(), key=lambda r: r.block)
    return np.concatenate([np.frombuffer(r.v) for r in found]).reshape(shape) if found else np.zeros(shape)
