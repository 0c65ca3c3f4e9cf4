"""Shards of near-equal bytes from a k-d tree over document metadata.

The unit that is placed is a group of equal texts (its copies share a shard),
cut into pieces only where a group is so large that keeping it whole would
unbalance the shards.  The tree splits every node at the weighted median of its
widest metadata dimension (normalised range: language, source, size) until the
leaves hold the target bytes.  Medians are distributed: per node, weights are
summed into ``BINS`` value bins, then the median's bin into ``BINS`` bins of a
uniform tie-breaking code, so that equal values can be split as well.

Defined results: a null text counts as an empty one (size 1); null language or
source sorts first; null ids are placed like others; repeated rows are placed
each (``slot`` differs).  An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import number_within, read_table, text_or_empty, written

BINS = 4096
#: A group of equal texts heavier than this share of a leaf is cut into pieces of about that weight.
PIECE_SHARE = 1 / 64
#: Distinct languages and sources are ranked by a 32-bit code of their name: no dictionary is collected.
CODE_SPAN = float(1 << 32)
DIMENSIONS = ("d_lang", "d_source", "d_size")


def kd_leaves(units: DataFrame, depth: int, dims: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """Split ``units`` (dims, ``tie`` in [0, 1), ``weight``) into ``2**depth`` leaves of near-equal weight.

    Returns ``units`` with ``leaf``.  The driver sees, per level, the ranges of
    the nodes' dimensions and two histograms of at most ``2**depth * BINS`` bins.
    """
    frame = units.withColumn("leaf", F.lit(0))
    ranges = [f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]
    whole = None
    for level in range(depth):
        nodes = {r["leaf"]: r for r in frame.groupBy("leaf").agg(F.sum("weight").alias("weight"), *ranges).collect()}
        if not nodes:
            return frame
        span = {leaf: [r[f"max_{d}"] - r[f"min_{d}"] for d in dims] for leaf, r in nodes.items()}
        whole = whole or span[0]
        wide = {leaf: max(range(len(dims)), key=lambda i: v[i] / whole[i] if whole[i] else 0.0)
                for leaf, v in span.items()}
        low = {leaf: float(nodes[leaf][f"min_{dims[i]}"]) for leaf, i in wide.items()}
        value = F.element_at(F.array(*dims), _of_leaf(wide) + 1) - _of_leaf(low)
        binned = frame.withColumn("__bin", F.least(F.floor(
            value / _of_leaf({leaf: max(span[leaf][i], 1e-12) for leaf, i in wide.items()}) * BINS),
            F.lit(BINS - 1)).cast("int")).withColumn("__tie", F.floor(F.col("tie") * BINS).cast("int"))
        half = {leaf: r["weight"] / 2 for leaf, r in nodes.items()}
        at, left, _ = _median_bins(binned, "__bin", half)
        inside = binned.where(F.col("__bin") == _of_leaf(at))
        rest = {leaf: half[leaf] - left[leaf] for leaf in half}
        cut, below, held = _median_bins(inside, "__tie", rest)
        # the bin that holds the median goes to the side that leaves the halves closer
        cut = {leaf: c + ((rest[leaf] - below[leaf]) * 2 >= held[leaf]) for leaf, c in cut.items()}
        right = ((F.col("__bin") > _of_leaf(at))
                 | ((F.col("__bin") == _of_leaf(at)) & (F.col("__tie") >= _of_leaf(cut))))
        frame = written(binned.withColumn("leaf", F.col("leaf") * 2 + right.cast("int")).drop("__bin", "__tie"),
                        f"kd-level-{level}")
    return frame


def _of_leaf(values: dict) -> Column:
    """The current node's entry of a small per-node table (a literal map)."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("leaf"))


def _median_bins(frame: DataFrame, bin_col: str, half: dict) -> tuple[dict, dict, dict]:
    """Per node: the bin in which the running weight reaches ``half``, the weight before it and in it."""
    at, before, held = dict.fromkeys(half, 0), dict.fromkeys(half, 0.0), dict.fromkeys(half, 0.0)
    done: set = set()
    rows = frame.groupBy("leaf", bin_col).agg(F.sum("weight").alias("w")).collect()
    for r in sorted(rows, key=lambda r: (r["leaf"], r[bin_col])):
        leaf = r["leaf"]
        if leaf not in done:
            at[leaf], before[leaf], held[leaf] = r[bin_col], before[leaf] + held[leaf], r["w"]
            if before[leaf] + r["w"] >= half[leaf]:
                done.add(leaf)
    return at, before, held


def shard_by_kd_tree(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                     lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: id, size, text_crc32, shard and slot (its gapless place in the shard).

    ``shards`` is a power of two; a target size in bytes gives it as the power
    of two that brings the leaves below the target (:func:`shards_for`).
    """
    depth = shards.bit_length() - 1
    if shards != 1 << depth:
        raise ValueError("a binary k-d tree has a power of two of leaves")
    text = text_or_empty(text_col)

    def code(column: str):
        return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) / F.lit(CODE_SPAN)

    rows = written(docs.select(
        F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h1"),
        code(lang_col).alias("d_lang"), code(source_col).alias("d_source")), "shard-rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    piece = max(1.0, total / shards * PIECE_SHARE)
    group = ["h1", "text_crc32", "size"]
    # rows of a group fall into as many pieces as its weight needs, by a code of the id
    grouped = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("d_lang").alias("g_lang"),
                                       F.min("d_source").alias("g_source"))
    groups = written(grouped.withColumn("pieces", F.greatest(
        F.lit(1), F.ceil(F.col("n") * F.col("size") / F.lit(piece)).cast("int"))), "shard-groups")
    whole = groups.where("pieces = 1").select(*group, F.lit(0).alias("piece"), (F.col("n") * F.col("size"))
                                              .alias("weight"), "g_lang", "g_source")
    # at most shards / PIECE_SHARE groups can be cut: their list has a fixed bound
    cut = F.broadcast(groups.where("pieces > 1"))
    tagged = (rows.join(cut.select(*group, "pieces"), group, "left")
              .withColumn("piece", F.coalesce(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("pieces")).cast("int"),
                                              F.lit(0))))
    split = (tagged.where("pieces is not null").groupBy(*group, "piece")
             .agg(F.sum("size").alias("weight"), F.min("d_lang").alias("g_lang"), F.min("d_source").alias("g_source")))
    units = whole.unionByName(split).select(
        *group, "piece", F.col("weight").cast("double").alias("weight"), F.col("g_lang").alias("d_lang"),
        F.col("g_source").alias("d_source"), F.log2(F.col("size")).alias("d_size"),
        (F.shiftrightunsigned(F.xxhash64(*group, "piece"), 11) / F.lit(float(1 << 53))).alias("tie"))
    leaves = kd_leaves(written(units, "shard-units"), depth).select(*group, "piece", F.col("leaf").alias("shard"))
    placed = tagged.drop("pieces", "d_lang", "d_source").join(
        written(leaves, "shard-leaves"), [*group, "piece"]).select("doc_id", "size", "text_crc32", "shard")
    return number_within(placed, ["shard"], ["doc_id", "text_crc32"], "slot", "shard-slots")


def shards_for(total_bytes: int, target_bytes: int) -> int:
    """The smallest power of two of shards whose mean is at most ``target_bytes``."""
    return 1 << max(0, -(-int(total_bytes) // max(1, int(target_bytes))) - 1).bit_length()


def op9_kd_shards(spark, sf_dir: str) -> DataFrame:
    placed = shard_by_kd_tree(read_table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                         F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"))
