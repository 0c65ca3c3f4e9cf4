"""Repeated passages by relative Lempel-Ziv parsing against indexed reference blocks.

Documents are factored against all documents with a smaller id.  The reference
is indexed by its blocks of ``WINDOW`` words, each under its earliest occurrence
(document, place).  A factor starts where the document's next ``WINDOW`` words are
an indexed block of a smaller document, and grows word by word as long as the
block that ends at the next word is indexed at the next place of the same document:
a factor is a piece of that reference.  Where it ends, the block across its end is
looked up like any other and starts the next factor, so nothing is lost at the
boundaries.  Words inside factors are duplicates.

Only blocks that can repeat are indexed: every block is anchored at the smallest
code of its 25-word runs, anchors that occur in one text only rule their blocks
out, and equal texts are compared as a whole.  Blocks are told apart by 64-bit
codes (of two texts' 50 words, equal codes with different words have a
probability of about 2**-64).

Defined results: null and empty texts have no words; a text of fewer than
``WINDOW`` words loses nothing; a null id is neither smaller nor larger than
any, so such a row loses nothing and refers nothing; rows that repeat an id do
not refer to one another; blocks repeated inside one document only are kept.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import (gram_codes, mix, on_documents, read_table,
                                   slices, text_or_empty, written)

WINDOW = 50
GRAM = WINDOW // 2
_PAIR = np.uint64(0x9FB21C651E98DF25)


class ByteWordCodes(dict):
    """word (bytes) -> 64-bit code as a signed int; emptied when full."""

    LIMIT = 400_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.LIMIT:
            self.clear()
        code = xxhash.xxh3_64_intdigest(word)
        self[word] = code = code - (1 << 64) if code >= 1 << 63 else code
        return code


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every run of ``width`` elements."""
    done = 1
    while done * 2 <= width:
        x, done = pick(x[:-done], x[done:]), done * 2
    return pick(x[: len(x) - (width - done)], x[width - done:]) if width > done else x


class Words:
    """The words of some texts, one after another, with their blocks.

    ``valid[p]``: a block starts at word p and lies in one text; ``least[p]``
    is the smallest code of its 25-word runs.
    """

    def __init__(self, texts: list[bytes], coder: ByteWordCodes):
        self.words = [t.split() for t in texts]  # bytes split at space, \t, \n, \v, \f, \r only
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        total = int(self.ends[-1]) if len(texts) else 0
        codes = np.fromiter(map(coder.__getitem__, itertools.chain.from_iterable(self.words)), np.int64, total)
        blocks = max(0, total - WINDOW + 1)
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)[:blocks]
        self.valid = np.arange(blocks) + WINDOW <= self.ends[self.doc]
        self.grams = gram_codes(codes.view(np.uint64), GRAM)
        self.least = (sliding(self.grams, WINDOW - GRAM + 1, np.minimum) if blocks else np.zeros(0, np.uint64))

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(document, code) of every run that is the smallest of some block."""
        if not len(self.least):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        width = WINDOW - GRAM + 1
        pad = np.zeros(width - 1, np.uint64)
        most = sliding(np.concatenate([pad, np.where(self.valid, self.least, np.uint64(0)), pad]), width, np.maximum)
        at = np.flatnonzero(most == self.grams)
        return np.searchsorted(self.ends, at, "right"), self.grams[at]

    def suspects(self, shared: np.ndarray) -> np.ndarray:
        """Places of the blocks whose anchor is in ``shared`` (sorted codes)."""
        if not len(shared) or not len(self.least):
            return np.zeros(0, np.int64)
        spot = np.minimum(np.searchsorted(shared, self.least), len(shared) - 1)
        return np.flatnonzero((shared[spot] == self.least) & self.valid)

    def block_codes(self, at: np.ndarray) -> np.ndarray:
        return mix(self.grams[at] * _PAIR + self.grams[at + GRAM])


def factors(place: np.ndarray, ref: np.ndarray, ref_place: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first word, length, reference, first word there) of the greedy factors, given the sorted places of the
    blocks that refer to a document, and where to."""
    goes_on = (np.diff(place) == 1) & (np.diff(ref) == 0) & (np.diff(ref_place) == 1)
    first = np.flatnonzero(np.append(True, ~goes_on)[: len(place)])
    last = np.append(first[1:] - 1, len(place) - 1)[: len(first)]
    return place[first], place[last] - place[first] + WINDOW, ref[first], ref_place[first]


def _shared_codes(column) -> np.ndarray:
    return np.unique(column.values.to_numpy(zero_copy_only=False)[
        column.offsets[0].as_py(): column.offsets[-1].as_py()].view(np.uint64))


def _scan(rows: DataFrame) -> DataFrame:
    """Per row: word count, digest of the words joined by one blank, and the text's anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteWordCodes()
        for batch in batches:
            texts = batch.column(3).to_pylist()
            for lo, hi in slices(texts):
                words = Words(texts[lo:hi], coder)
                doc, codes = words.anchors()
                offsets = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=hi - lo))]).astype(np.int32)
                digests = [hashlib.sha256(b" ".join(w)).hexdigest() for w in words.words]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).slice(lo, hi - lo) for i in range(3)], pa.array(words.sizes, pa.int64()),
                     pa.array(digests, pa.string()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.view(np.int64)))],
                    names=["doc_id", "h1", "h2", "n_words", "sha", "anchors"])

    return rows.mapInArrow(run, "doc_id bigint, h1 bigint, h2 bigint, n_words bigint, sha string, anchors array<bigint>")


def _blocks(live: DataFrame) -> DataFrame:
    """(code, u, h1, place) of every block of ``live`` (u, h1, text, shared) with a shared anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ByteWordCodes()
        for batch in batches:
            ids, h1 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            texts, shared = batch.column(2).to_pylist(), _shared_codes(batch.column(3))
            for lo, hi in slices(texts):
                words = Words(texts[lo:hi], coder)
                at = words.suspects(shared)
                doc = words.doc[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.block_codes(at).view(np.int64)), pa.array(ids[lo:hi][doc]), pa.array(h1[lo:hi][doc]),
                     pa.array((at - words.starts[doc]).astype(np.int32))], names=["code", "u", "h1", "place"])

    return live.mapInArrow(run, "code bigint, u bigint, h1 bigint, place int")


_FACTOR = pa.struct([(n, pa.int64()) for n in ("start", "length", "ref_id", "ref_start")])


def _parsed(live: DataFrame) -> DataFrame:
    """Parse ``live`` (u, h1, text, refs): factors, number of words in them, and the text that is kept.

    ``refs``: place of each block that a smaller document has, that document and the place there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, column = batch.column(2).to_pylist(), batch.column(3)
            ends = column.offsets.to_numpy()
            place, ref, ref_place = (column.values.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
            for lo, hi in slices(texts):
                removed, kept, spans = [], [], []
                for i in range(lo, hi):
                    words, own = texts[i].split(), slice(ends[i], ends[i + 1])
                    order = np.argsort(place[own], kind="stable")
                    found = factors(place[own][order], ref[own][order], ref_place[own][order])
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, found[0], 1)
                    np.add.at(change, found[0] + found[1], -1)
                    stays = np.cumsum(change[:-1]) == 0
                    removed.append(len(words) - int(stays.sum()))
                    kept.append(b" ".join(itertools.compress(words, stays.tolist())))
                    spans.append([dict(zip(("start", "length", "ref_id", "ref_start"), f)) for f in zip(*(x.tolist() for x in found))])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.binary()), pa.array(spans, pa.list_(_FACTOR))],
                    names=["doc_id", "h1", "n_removed", "kept", "factors"])

    return live.mapInArrow(run, "doc_id bigint, h1 bigint, n_removed bigint, kept binary, "
                                "factors array<struct<start: bigint, length: bigint, ref_id: bigint, ref_start: bigint>>")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, changed).

    ``rows``: doc_id, h1, h2, n_words, sha (of all words joined by one blank)
    and whole - true if a smaller id has this very text (of at least a block).
    ``changed``: doc_id, h1, n_removed, kept, factors (start, length, ref_id,
    ref_start) of the first document of each text that lost words; (doc_id, h1)
    names a row's id and text.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("h1"),
                       F.xxhash64(F.lit(1), text).alias("h2"), text.cast("binary").alias("text"))
    scanned = written(_scan(rows), "rlz-scan")
    named = scanned.where("doc_id is not null")
    firsts = written(named.where(F.col("n_words") >= WINDOW).groupBy("h1", "h2").agg(
        F.min("doc_id").alias("u"), F.first("anchors").alias("anchors")), "rlz-firsts")
    seeds = firsts.select("u", F.explode("anchors").alias("code"))
    shared = written(seeds.groupBy("code").agg(F.min("u").alias("lo"), F.max("u").alias("hi"))
                     .where("lo < hi").select("code"), "rlz-shared")
    hits = seeds.join(shared, "code", "left_semi").groupBy("u").agg(F.collect_set("code").alias("shared"))
    marked = written(firsts.select("u", "h1").join(hits, "u"), "rlz-marked")
    live = written(rows.select("doc_id", "h1", "text").join(
        marked, (F.col("doc_id") == marked.u) & (rows.h1 == marked.h1)).select("u", rows.h1, "text", "shared")
        # rows that repeat both id and text are one document
        .dropDuplicates(["u", "h1"]), "rlz-live")
    # the index: every block under its earliest document and place; each occurrence in a larger one refers there
    blocks = written(_blocks(live.select("u", "h1", "text", "shared")), "rlz-blocks")
    index = blocks.groupBy("code").agg(F.min(F.struct("u", "place")).alias("at"))
    refs = (blocks.join(index, "code").where(F.col("at.u") < F.col("u"))
            .groupBy("u", "h1").agg(F.collect_list(F.struct("place", "at.u", "at.place")).alias("refs")))
    changed = _parsed(live.select("u", "h1", "text").join(refs, ["u", "h1"]).select("u", "h1", "text", "refs"))
    whole = scanned.join(firsts.select("h1", "h2", "u"), ["h1", "h2"], "left").select(
        "doc_id", "h1", "h2", "n_words", "sha", F.coalesce(F.col("doc_id") > F.col("u"), F.lit(False)).alias("whole"))
    return whole, changed


def op8_relative_lz(spark, sf_dir: str) -> DataFrame:
    rows, changed = repeated_passages(read_table(spark, sf_dir, "documents"))
    cut = written(changed.select("doc_id", "h1", "n_removed", F.sha2("kept", 256).alias("cut_sha")), "rlz-cut")
    gone = F.col("whole")
    return rows.join(cut, ["doc_id", "h1"], "left").select(
        "doc_id", "n_words",
        F.when(gone, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.coalesce("cut_sha", "sha")).alias("kept_sha256"))


@on_documents
def substring_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages are cut out; a document that loses every word goes."""
    rows, changed = repeated_passages(docs)
    cut = changed.select("doc_id", F.col("h1").alias("__h"), F.col("kept").cast("string").alias("__kept"))
    gone = rows.where("whole").select("doc_id", F.col("h1").alias("__h"), F.lit("").alias("__kept"))
    edits = written(cut.unionByName(gone).dropDuplicates(["doc_id", "__h"]), "rlz-edits")
    edits = edits.select(F.col("doc_id").alias("__id"), F.col("__h").alias("__hash"), "__kept")
    joined = docs.join(edits, (F.col("doc_id") == F.col("__id")) & (F.xxhash64(text_or_empty()) == F.col("__hash")),
                       "left").where(F.coalesce(F.col("__kept") != "", F.lit(True)))
    text = F.coalesce("__kept", "text").alias("text")
    size = F.when(F.col("__kept").isNotNull(), F.length("__kept").cast("bigint")).otherwise(F.col("n_chars"))
    return joined.select(*[text if c == "text" else size.alias(c) if c == "n_chars" else F.col(c)
                           for c in docs.columns])
