"""Packing by power-of-two decomposition: every document is cut into binary-length pieces.

A document of n tokens becomes n // 4096 full pieces and one piece per set bit
of the rest, longest first.  Equal lengths are bucketed; a piece is a sequence
of its own, so no sequence crosses documents and, lengths being powers of two,
none is padded.

Defined results: null text packs as an empty one (its end token only); repeated
rows pack each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickspark.llm.common import column_texts, read_table, slices, written
from tickspark.llm.wordbpe import WordBpe

MAX_LENGTH = 4096
END_ID = 2


def binary_lengths(total: int, longest: int = MAX_LENGTH) -> list[int]:
    """Power-of-two lengths, longest first, that add up to ``total``."""
    rest = total % longest
    return [longest] * (total // longest) + [1 << b for b in range(longest.bit_length() - 2, -1, -1) if rest >> b & 1]


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   longest: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian uint32), doc_tokens, sequence_id, offset.

    Pieces are bucketed by length and each is a sequence: ``sequence_id`` runs
    from 0 over the buckets, longest first, without gaps.  A task counts its
    pieces per length while cutting; the counts per (task, length) - all that
    is summed up afterwards - place every task's pieces in each bucket, so the
    ids themselves are written once and never shuffled.
    """
    if longest & (longest - 1):
        raise ValueError("the longest length is a power of two")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "__nth"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, seen = WordBpe(tokenizer_path), {}
        for batch in batches:
            texts, ids = column_texts(batch), batch.column(0).to_pylist()
            for lo, hi in slices(texts):
                cols: list[list] = [[] for _ in names]
                for doc, found in zip(ids[lo:hi], tokens.encode(texts[lo:hi])):
                    data, total, start = found.tobytes() + end_id.to_bytes(4, "little"), len(found) + 1, 0
                    for n in binary_lengths(total, longest):
                        nth = seen[n] = seen.get(n, -1) + 1
                        for col, v in zip(cols, (doc, start, n, data[4 * start: 4 * (start + n)], total, nth)):
                            col.append(v)
                        start += n
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

    cut_rows = rows.mapInArrow(cut, "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
                                    "__nth bigint")
    pieces = written(cut_rows.withColumn("__task", F.spark_partition_id()), "pieces")
    runs = pieces.groupBy("length", "__task").agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.partitionBy("length").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("__base", F.coalesce(F.sum("__rows").over(before), F.lit(0)))
    sizes = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, bucket = 0, F.lit(0)
    for length in sorted(sizes, reverse=True):  # at most log2(longest) + 1 lengths
        bucket = F.when(F.col("length") == length, F.lit(first)).otherwise(bucket)
        first += sizes[length]
    # one row per (task, length): bounded by the number of scan tasks
    placed = pieces.join(F.broadcast(runs.drop("__rows")), ["length", "__task"])
    return placed.select("doc_id", "start", "length", "ids", "doc_tokens",
                         (bucket + F.col("__base") + F.col("__nth")).cast("bigint").alias("sequence_id"),
                         F.lit(0).cast("bigint").alias("offset"))


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op7_binary_pack(spark, sf_dir: str) -> DataFrame:
    packed = pack_documents(read_table(spark, sf_dir, "documents"), default_tokenizer())
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def packing_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the kept documents as unpadded token sequences."""
    return pack_documents(docs, default_tokenizer())
