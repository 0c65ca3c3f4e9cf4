"""Benchmark decontamination by latent semantic retrieval, then exact checks.

1. Every document becomes a sequence of 32-bit word codes; document frequencies
   of hashed terms are counted over all 64-word passages of all documents.
2. A distributed randomised SVD of the TF-IDF passages, all of the corpus' and of
   the benchmark's, gives each term a latent vector.
3. Every place of every document is searched: overlapping windows of 16, 32, 64
   and 128 words (a quarter apart) against the benchmark passages of that length,
   by cosine in the latent space.
4. A candidate leaks if the longest common subsequence of the benchmark passage
   and the words around the window covers ``COPY`` of the passage, or ``PARAPHRASE``
   of it and some stretch of the document ``ANSWER`` of the item's answer (its
   answer column or last sentence).

Items of more than ``PART`` words are searched as passages of at most 128 words
and also as passages of ``PART`` words, one every ``PART_STEP``: a copied run is
judged by its own length, not by that of the item it comes from.

Defined results: null and empty texts have no passages and leak nothing; passages
of fewer than ``SHORTEST`` words are too common to tell a leak and take no part;
each row is judged by itself, so repeated rows and ties repeat; an empty
benchmark or corpus gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.llm.common import (column_texts, on_documents, ranges_concat, read_table, slices, split_codes,
                                   sum_arrays, with_fields, written)

TERMS = 1 << 14
LATENT, OVERSAMPLE, POWERS = 96, 16, 2
PASSAGE = 64
#: Passages handled together inside a task; bounds a task's memory whatever the texts' lengths.
TOGETHER = 1 << 15
#: Characters coded together: what is made of them stays in the processor's cache.
CACHED_CHARS = 100_000
#: Passages a task of the latent fit reads, where there are more than two tasks a core.
TASK_PASSAGES = 1 << 20
WIDTHS = (16, 32, 64, 128)
SHORTEST = 8
#: Parts of long items: any run of PART - PART_STEP + 1 words, more than COPY of a part, lies within one.
PART, PART_STEP = 64, 16
COSINE, COPY, PARAPHRASE, ANSWER = 0.5, 0.7, 0.5, 0.8
#: Benchmark passages searched in one run over the documents.
BLOCK = 4096
WORD = re.compile(r"\w+")


def short_codes(texts: list[str]) -> list[np.ndarray]:
    """32-bit word codes of each text."""
    return [(c >> np.uint64(32)).astype(np.uint32) for c in split_codes(texts)]


def coded(docs: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` and the text's word codes (little-endian uint32), written once."""
    code_col = "__codes"
    schema = with_fields(docs.select(*keep).schema, T.StructField(code_col, T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column_texts(batch, "__text")
            codes = [c.tobytes() for lo, hi in slices(texts, CACHED_CHARS) for c in short_codes(texts[lo:hi])]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(keep))], pa.array(codes, pa.binary())],
                                             names=[*keep, code_col])

    texts = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    return written(texts.mapInArrow(run, schema), "leak-codes")


def _codes_of(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(c or b"", np.uint32) for c in
            batch.column(batch.schema.get_field_index("__codes")).to_pylist()]


def _groups(arrays: list[np.ndarray], words: int = 500_000) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, a in enumerate(arrays):
        size += len(a)
        if size >= words:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(arrays):
        yield start, len(arrays)


def _passages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(terms in order, passage sizes) of all passages, at most ``TOGETHER`` at a time; rows not ``__cut`` are one each."""
    for batch in batches:
        arrays = _codes_of(batch)
        cut = batch.column(batch.schema.get_field_index("__cut")).to_numpy(zero_copy_only=False)
        for lo, hi in _groups(arrays, TOGETHER * PASSAGE):
            whole = np.array([len(a) for a in arrays[lo:hi]])
            most = np.where(cut[lo:hi], PASSAGE, np.maximum(whole, 1))
            pieces = -(-whole // most)
            some = pieces > 0
            sizes = np.repeat(most, pieces)
            sizes[np.cumsum(pieces)[some] - 1] = (whole - (pieces - 1) * most)[some]
            flat, ends = np.concatenate(arrays[lo:hi]) & np.uint32(TERMS - 1), np.cumsum(sizes)
            for p in range(0, len(sizes), TOGETHER):
                part = sizes[p: p + TOGETHER]
                yield flat[ends[p] - sizes[p]: ends[p + len(part) - 1]], part


def _words(terms: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term, passage) of every word of some passages, by term and passage."""
    # (term, passage) in 32 bits: at most TOGETHER passages
    words = np.sort(terms * np.uint32(TOGETHER) + np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes))
    return words // np.uint32(TOGETHER), words % np.uint32(TOGETHER)


def _cells(term: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, passage, count) of the terms of some passages, from ``_words``."""
    first = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (row[1:] != row[:-1])))
    return term[first], row[first], np.diff(np.append(first, len(term)))


def passage_statistics(codes: DataFrame) -> tuple[np.ndarray, int]:
    """(document frequency per term, passages) over all passages of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, passages = np.zeros(TERMS, np.int64), 0
        for terms, sizes in _passages(batches):
            counts += np.bincount(_cells(*_words(terms, sizes))[0], minlength=TERMS)
            passages += len(sizes)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *used.tolist()], pa.int64()),
                                          pa.array([passages, *counts[used].tolist()], pa.int64())], names=["term", "n"])

    df, passages = np.zeros(TERMS), 0
    found = codes.select("__codes", F.lit(True).alias("__cut")).mapInArrow(run, "term bigint, n bigint")
    for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect():
        if r.term < 0:
            passages = int(r.n)
        else:
            df[r.term] = r.n
    return df, passages


def _sums(table: np.ndarray, terms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of each passage's rows of ``table``, whose last row is zero."""
    out = np.empty((len(sizes), table.shape[1]), table.dtype)
    order = np.argsort(-sizes, kind="stable")  # alike in size: little padding
    starts = np.cumsum(sizes) - sizes
    lo = 0
    while lo < len(order):  # in pieces that stay in the processor's cache
        some = order[lo: lo + max(1, 512 * PASSAGE // max(PASSAGE, int(sizes[order[lo]])))]
        lo += len(some)
        at = np.arange(int(sizes[some[0]]))[:, None]
        words = np.where(at < sizes[some], terms[np.minimum(starts[some] + at, len(terms) - 1)], len(table) - 1).astype(np.int64)
        total = np.take(table, words[0], axis=0)
        for one in words[1:]:
            total += np.take(table, one, axis=0)
        out[some] = total
    return out


def _long_sums(table: np.ndarray, at: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sum of ``table``'s rows ``at`` for groups of any size: sums of pieces, then sums of those."""
    pieces = -(-sizes // PASSAGE)
    some = np.flatnonzero(pieces)
    part = np.full(int(pieces.sum()), PASSAGE)
    part[np.cumsum(pieces)[some] - 1] = (sizes - (pieces - 1) * PASSAGE)[some]
    out = np.zeros((len(sizes), table.shape[1]), table.dtype)
    if len(some):
        sums = _sums(np.concatenate([table, np.zeros_like(table[:1])]), at, part)
        out[some] = sums if len(part) == len(some) else _long_sums(sums, np.arange(len(part)), pieces[some])
    return out


def latent_terms(rows: DataFrame, idf: np.ndarray, seed: int = 7) -> np.ndarray:
    """TERMS x LATENT: each term's IDF times its right singular vector of the TF-IDF matrix of all passages, whitened.

    A randomised range finder: each power step is one Spark job over all passages,
    in which tasks return their passages' share of ``A' (A Q)`` and shares are
    summed per block of terms.  The driver holds TERMS x (LATENT + OVERSAMPLE)
    numbers.  The last job gives the Gram matrix and the passages' mean and spread.

    Whitened: turned so that passages have mean zero and equal spread in every
    latent direction.  Without this the common words and the language of two
    passages decide their cosine.  Mean and covariance are those of all full
    passages, with a hundredth of the mean variance added in every direction.
    """
    wide = LATENT + OVERSAMPLE
    spark = rows.sparkSession

    def sums_of(sent, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(words, norms, sizes, sums of the basis times IDF) of passages."""
        table = np.concatenate([sent.value * idf[:, None].astype(np.float32), np.zeros((1, wide), np.float32)])
        for terms, sizes in _passages(batches):
            words = _words(terms, sizes)
            term, row, count = _cells(*words)
            norm = np.sqrt(np.bincount(row, weights=(count * idf[term]) ** 2, minlength=len(sizes)))
            yield words, norm, sizes, _sums(table, terms, sizes)

    def step(basis: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(basis.astype(np.float32))

        def share(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros((TERMS, wide))
            for (term, row), norm, _, sums in sums_of(sent, batches):
                sums /= (norm * norm)[:, None].astype(np.float32)
                total += _long_sums(sums, row, np.bincount(term, minlength=TERMS))
            return total * idf[:, None]

        # a basis to search in: shares in single precision do, and halve the shuffle
        return sum_arrays(rows, share, (TERMS, wide), blocks=64, kind=np.float32)

    def moments(basis: np.ndarray) -> np.ndarray:
        sent = spark.sparkContext.broadcast(basis.astype(np.float32))

        def share(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros((2 * wide + 2, wide))
            for _, norm, sizes, sums in sums_of(sent, batches):
                unit, full = sums / norm[:, None].astype(np.float32), sums[sizes == PASSAGE]
                total[:wide] += unit.T @ unit
                total[wide: 2 * wide] += full.T @ full
                total[-2] += full.sum(axis=0, dtype=np.float64)
                total[-1] += len(full)
            return total

        return sum_arrays(rows, share, (2 * wide + 2, wide))

    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((TERMS, wide)))
    for _ in range(POWERS + 1):
        q, _ = np.linalg.qr(step(q))
    total = moments(q)
    values, vectors = np.linalg.eigh(total[:wide])
    turn = vectors[:, np.argsort(-values)[:LATENT]]
    table = (q @ turn) * idf[:, None]
    n = max(total[-1, 0], 1.0)
    mean = total[-2] @ turn / n
    spread = turn.T @ total[wide: 2 * wide] @ turn / n - np.outer(mean, mean)
    spread += np.eye(LATENT) * (np.trace(spread) / LATENT * 0.01 + 1e-9)
    values, vectors = np.linalg.eigh(spread)
    return ((table - mean / PASSAGE) @ (vectors / np.sqrt(np.maximum(values, 1e-12)))).astype(np.float32)


class Pattern:
    """A word sequence, ready to be compared with many others."""

    def __init__(self, words: np.ndarray):
        self.size, self.masks = len(words), {}
        for i, w in enumerate(words.tolist()):
            self.masks[w] = self.masks.get(w, 0) | 1 << i

    def common(self, words: list[int]) -> int:
        """Length of the longest common subsequence, bit-parallel over the pattern."""
        row = full = (1 << self.size) - 1
        for m in filter(None, map(self.masks.get, words)):
            u = row & m
            row = ((row + u) | (row - u)) & full
        return self.size - row.bit_count()


def benchmark_passages(items) -> list[tuple]:
    """(item, width, codes, answer codes) of (item, text, answer) rows: passages of at most 128 words.

    Items of more than ``PART`` words also give overlapping passages of ``PART`` words, the last at their end.
    """
    out = []
    for item, text, answer in items:
        codes = short_codes([text or ""])[0]
        last = [s for s in re.split(r"[.!?\n]", text or "") if WORD.search(s)]
        answer_codes = short_codes([answer if answer else (last[-1] if last else "")])[0]
        for lo in range(0, len(codes), WIDTHS[-1]):
            part = codes[lo: lo + WIDTHS[-1]]
            if len(part) >= SHORTEST:
                out.append((item, next(w for w in WIDTHS if w >= len(part)), part, answer_codes))
        if len(codes) > PART:
            out += [(item, PART, codes[lo: lo + PART], answer_codes)
                    for lo in [*range(0, len(codes) - PART, PART_STEP), len(codes) - PART]]
    return out


def _answers(codes: np.ndarray, answer: Pattern, size: int) -> bool:
    """Whether some stretch of a document holds ``ANSWER`` of an answer.

    Stretches are ``size`` words long, or twice the answer, and half a stretch apart.
    """
    words, half = codes.tolist(), max(-(-size // 2), answer.size)
    return any(answer.common(words[lo: lo + 2 * half]) >= ANSWER * answer.size for lo in range(0, len(words), half))


def _around(first, width: int) -> tuple:
    """(first, end) of the words around a window, a quarter of its width on either side."""
    return np.maximum(0, first - width // 4), first + width + width // 4


class Search:
    """Finds the benchmark passages of one block in coded documents."""

    def __init__(self, passages: list[tuple], table: np.ndarray):
        self.passages = [(item, width, Pattern(codes), Pattern(answer)) for item, width, codes, answer in passages]
        # one zero row more: the padding between documents
        self.table = np.concatenate([table, np.zeros((1, table.shape[1]), np.float32)])
        self.sizes = np.array([len(p[2]) for p in passages])
        # one bit a term: the terms of each passage
        self.holds = np.zeros((len(passages), TERMS // 8 + 1), np.uint8)
        for i, p in enumerate(passages):
            term = p[2] & np.uint32(TERMS - 1)
            np.bitwise_or.at(self.holds[i], term >> np.uint32(3), np.uint8(1) << (term & np.uint32(7)).astype(np.uint8))
        self.by_width = {}
        for width in WIDTHS:
            own = [i for i, p in enumerate(passages) if p[1] == width]
            if own:
                v = np.stack([table[passages[i][2] & np.uint32(TERMS - 1)].sum(axis=0) for i in own])
                norm = np.linalg.norm(v, axis=1, keepdims=True)
                self.by_width[width] = (np.array(own), np.divide(v, norm, out=np.zeros_like(v), where=norm > 0).T)

    def candidates(self, arrays: list[np.ndarray], cosine: float) -> Iterator[tuple[np.ndarray, ...]]:
        """(documents, passages, first words, widths, cosines) of windows that resemble a passage, block by block.

        Only those whose surroundings have words enough in common with the passage to leak, in whatever order.
        """
        sizes = np.array([len(a) for a in arrays])
        padded = -(-sizes // 4) * 4
        starts = np.cumsum(padded) - padded
        terms = np.full(int(padded.sum()), TERMS, np.int64)
        terms[ranges_concat(starts, sizes)] = np.concatenate(arrays) & np.uint32(TERMS - 1)
        sums = np.empty((len(terms) // 4, self.table.shape[1]), np.float32)
        for lo in range(0, len(sums), 512):  # in pieces that stay in the processor's cache
            four = np.ascontiguousarray(terms[4 * lo: 4 * (lo + 512)].reshape(-1, 4).T)
            part = np.take(self.table, four[0], axis=0)
            for one in four[1:]:
                part += np.take(self.table, one, axis=0)
            sums[lo: lo + 512] = part
        for width in WIDTHS:
            if width > WIDTHS[0]:
                if len(sums) % 2:
                    sums = np.concatenate([sums, np.zeros((1, sums.shape[1]), np.float32)])
                sums = sums[0::2] + sums[1::2]
            if width not in self.by_width:
                continue
            own, vectors = self.by_width[width]
            step = 1 << 11  # in pieces that stay in the processor's cache
            for lo in range(0, len(sums), step):
                # one window more on either side: of neighbours that resemble a passage the nearest counts,
                # whose surroundings cover the others
                begin = max(0, lo - 1)
                some = sums[begin: lo + step + 4]
                over = max(0, lo + step + 4 - len(sums))
                if over:  # windows reach over the end
                    some = np.concatenate([some, np.zeros((min(over, 3), sums.shape[1]), np.float32)])
                windows = some[:-3] + some[1:-2]
                windows += some[2:-1]
                windows += some[3:]
                windows /= (np.sqrt(np.einsum("ij,ij->i", windows, windows)) + 1e-12)[:, None]
                like = windows @ vectors
                w, p = np.divmod(np.flatnonzero(like >= cosine), len(own))
                score = like[w, p]
                best = (score >= like[np.maximum(w - 1, 0), p]) & (score >= like[np.minimum(w + 1, len(like) - 1), p])
                w += begin
                best &= (w >= lo) & (w < lo + step)
                first, p, score = w[best] * (width // 4), own[p[best]], score[best]
                # a window may reach over the end of a document: it counts for each it touches
                d = np.searchsorted(starts, first, "right") - 1
                touched = np.searchsorted(starts, first + width, "left") - d
                d = ranges_concat(d, touched)
                first, p, score = (np.repeat(x, touched) for x in (first, p, score))
                keep = sizes[d] > 0
                d, p, score = d[keep], p[keep], score[keep]
                first = first[keep] - starts[d]
                keep = self._enough(terms, starts[d], sizes[d], p, first, width)
                yield d[keep], p[keep], first[keep], np.full(int(keep.sum()), width), score[keep]

    def _enough(self, terms: np.ndarray, starts: np.ndarray, sizes: np.ndarray, p: np.ndarray, first: np.ndarray,
                width: int) -> np.ndarray:
        """Whether the words around each window hold so many of the passage's terms that their common subsequence may count."""
        hits = np.empty(len(p))
        for at in range(0, len(p), 4096):
            i = slice(at, at + 4096)
            lo, hi = _around(first[i], width)
            place = lo[:, None] + np.arange(2 * width)
            word = np.where(place < np.minimum(hi, sizes[i])[:, None],
                            terms[np.minimum(starts[i, None] + place, len(terms) - 1)], TERMS)
            hits[i] = (self.holds[p[i, None], word >> 3] >> (word & 7).astype(np.uint8) & 1).sum(axis=1)
        return hits / self.sizes[p] >= min(COPY, PARAPHRASE)

    def leaks(self, arrays: list[np.ndarray], cosine: float = COSINE) -> dict[int, dict]:
        """document -> item -> (cosine, share of the passage, kind), the largest share first found."""
        found: dict[int, dict] = {}
        tried: set = set()
        answered: dict = {}
        for d, p, first, width, score in (x for block in self.candidates(arrays, cosine)
                                          for x in zip(*(column.tolist() for column in block))):
            item, _, passage, answer = self.passages[p]
            lo, hi = _around(first, width)
            if (d, p, int(lo)) in tried:
                continue
            tried.add((d, p, int(lo)))
            words = arrays[d][lo:hi].tolist()
            share = passage.common(words) / passage.size
            kind = "copy" if share >= COPY else None
            if not kind and share >= PARAPHRASE and answer.size:
                near = answer.common(words) >= ANSWER * answer.size
                if not near:
                    if (d, p) not in answered:
                        answered[d, p] = _answers(arrays[d], answer, width + width // 2)
                    near = answered[d, p]
                kind = "paraphrase" if near else None
            if kind:
                own = found.setdefault(d, {})
                if item not in own or share > own[item][1]:
                    own[item] = (round(score, 6), share, kind)
        return found


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, answer_col: str | None) -> Iterator[list[tuple]]:
    """Benchmark passages, at most BLOCK at a time on the driver."""
    block = []
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    rows = benchmark.select(F.col(item_col), F.col(text_col).cast("string"), answer)
    for row in rows.toLocalIterator():
        block += benchmark_passages([tuple(row)])
        if len(block) >= BLOCK:
            yield block
            block = []
    if block:
        yield block


def fit_tasks(passages: int, item_parts: int, cores: int) -> int:
    """Tasks of the latent fit, for so many passages of documents and partitions of the benchmark.

    A task's share is as large whatever it read, and the shares of all steps lie
    on disk together: their number follows the passages, not the files.
    """
    return max(1, min(max(2 * cores, passages // TASK_PASSAGES), -(-passages // TOGETHER) + item_parts))


def fit_latent(codes: DataFrame, benchmark: DataFrame, text_col: str = "text") -> np.ndarray:
    """TERMS x LATENT: each term's IDF times its latent vector, from all passages of the documents and the benchmark."""
    df, passages = passage_statistics(codes)
    idf = np.log((1 + passages) / (1 + df)) + 1
    items = coded(benchmark, text_col, []).withColumn("__cut", F.lit(False))
    rows = codes.select("__codes", F.lit(True).alias("__cut")).unionByName(items)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = fit_tasks(passages, items.rdd.getNumPartitions(), cores)
    return latent_terms(rows.coalesce(tasks), idf)


def find_leaks(codes: DataFrame, benchmark: DataFrame, table: np.ndarray, id_col: str = "doc_id",
               item_col: str = "item_id", text_col: str = "text", answer_col: str | None = None,
               cosine: float = COSINE) -> DataFrame:
    """(id, item, cosine, share, kind) of every leak in the coded documents."""
    spark = codes.sparkSession
    id_type, item_type = codes.schema[id_col].dataType, benchmark.schema[item_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField(item_col, item_type),
                           T.StructField("cosine", T.DoubleType()), T.StructField("share", T.DoubleType()),
                           T.StructField("kind", T.StringType())])
    found = spark.createDataFrame([], schema)
    for block in _blocks(benchmark, item_col, text_col, answer_col):
        sent = spark.sparkContext.broadcast((block, table))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            search = Search(*sent.value)
            for batch in batches:
                arrays, ids = _codes_of(batch), batch.column(0)
                for lo, hi in _groups(arrays):
                    hits = search.leaks(arrays[lo:hi], cosine)
                    rows = [(lo + d, item, *v) for d, own in sorted(hits.items()) for item, v in own.items()]
                    if rows:
                        at, items, score, share, kind = zip(*rows)
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(at)), pa.array(items), pa.array(score, pa.float64()),
                             pa.array(share, pa.float64()), pa.array(kind, pa.string())],
                            names=[id_col, item_col, "cosine", "share", "kind"])

        found = found.union(codes.select(id_col, "__codes").mapInArrow(run, schema))
    return found


def without_leaks(codes: DataFrame, benchmark: DataFrame, table: np.ndarray) -> DataFrame:
    """The coded rows that hold no benchmark passage."""
    spark, schema = codes.sparkSession, codes.schema
    for block in _blocks(benchmark, "item_id", "text", None):
        sent = spark.sparkContext.broadcast((block, table))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            search = Search(*sent.value)
            for batch in batches:
                arrays = _codes_of(batch)
                clean = np.ones(len(arrays), bool)
                for lo, hi in _groups(arrays):
                    clean[[lo + d for d in search.leaks(arrays[lo:hi])]] = False
                yield batch.filter(pa.array(clean))

        codes = codes.mapInArrow(run, schema)
    return codes


def op6_benchmark_leaks(spark, sf_dir: str) -> DataFrame:
    benchmark = read_table(spark, sf_dir, "benchmark")
    codes = coded(read_table(spark, sf_dir, "documents"), "text", ["doc_id"])
    return find_leaks(codes, benchmark, fit_latent(codes, benchmark))


@on_documents
def decontamination_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that hold a benchmark passage go."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    codes = coded(docs, "text", docs.columns)
    return without_leaks(codes, benchmark, fit_latent(codes, benchmark)).select(*docs.columns)
