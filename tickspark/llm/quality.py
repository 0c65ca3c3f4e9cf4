"""Text quality by positive-unlabelled learning.

Trusted positives are the labelled good documents; all other text is unlabelled.
With the logistic loss l and the class prior p, the unbiased risk

    p E_P[l(z)] + ( E_U[l(-z)] - p E_P[l(-z)] )

is convex in a linear model z (the positive parts add up to -p E_P[z]).  It is
minimised by Newton steps; gradient, Hessian and the bracket - the negatives'
risk, which cannot be below zero - are summed over all documents in one Spark
job per step.  Where a step would push the bracket below zero, the step is
halved until it does not (the non-negative estimator's correction).

The model sees shape statistics of the text only, each cut into quantile bins.
Two numbers fitted on the learning rows' labels turn its value into a probability.

Defined results: null counts as empty; an empty text is scored from its (zero)
statistics; repeated rows are scored alike; a document labelled several times
counts once (with its highest label); a null id is never learned from and not
held out; without any positive to learn from every score is the prior, 0.5.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import crc_mod, read_table, slices, sum_arrays, text_or_empty, written

# Byte classes of UTF-8 text.
CLASSES = ["other", "lower", "upper", "digit", "space", "newline", "stop", "pause", "symbol", "high"]
FEATURES = [*(f"share_{c}" for c in CLASSES), "log_words", "word_length", "word_spread", "distinct", "top_word",
            "repeated_next", "short_words", "long_words", "line_words", "distinct_lines", "packed", "capital_words"]
BINS = 12
STEPS, RIDGE = 14, 1e-4
KEEP_AT = 0.3


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    for name, members in (("lower", b"abcdefghijklmnopqrstuvwxyz"), ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
                          ("digit", b"0123456789"), ("space", b" \t"), ("newline", b"\n\r"), ("stop", b".!?"),
                          ("pause", b",;:'\"-()"), ("symbol", b"#$%&*+/<=>@[\\]^_`{|}~")):
        table[list(members)] = CLASSES.index(name)
    table[128:] = CLASSES.index("high")
    return table


def text_features(texts: list[bytes], table: np.ndarray) -> np.ndarray:
    """FEATURES of each text (UTF-8 bytes), from the whole text."""
    n = len(texts)
    out = np.zeros((n, len(FEATURES)))
    sizes = np.array([len(t) for t in texts])
    flat = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * len(CLASSES) + table[flat], minlength=n * len(CLASSES)).reshape(n, -1)
    out[:, : len(CLASSES)] = counts / np.maximum(sizes, 1)[:, None]
    words = [t.split() for t in texts]
    per = np.array([len(w) for w in words])
    total = int(per.sum())
    every = list(itertools.chain.from_iterable(words))
    length = np.fromiter(map(len, every), np.int64, total)
    code = np.fromiter(map(hash, every), np.int64, total)
    doc = np.repeat(np.arange(n), per)
    some = np.maximum(per, 1)

    def mean(x) -> np.ndarray:
        return np.bincount(doc, weights=x, minlength=n) / some

    put = {name: i for i, name in enumerate(FEATURES)}
    average = mean(length)
    out[:, put["log_words"]] = np.log1p(per)
    out[:, put["word_length"]] = average
    out[:, put["word_spread"]] = np.sqrt(np.maximum(mean(length.astype(float) ** 2) - average ** 2, 0))
    out[:, put["short_words"]] = mean(length <= 2)
    out[:, put["long_words"]] = mean(length >= 12)
    if total:
        same = np.append((code[1:] == code[:-1]) & (doc[1:] == doc[:-1]), False)
        out[:, put["repeated_next"]] = mean(same)
        order = np.lexsort((code, doc))
        c, d = code[order], doc[order]
        first = np.flatnonzero(np.append(True, (c[1:] != c[:-1]) | (d[1:] != d[:-1])))
        kinds = doc[order][first]
        runs = np.diff(np.append(first, total))
        out[:, put["distinct"]] = np.bincount(kinds, minlength=n) / some
        top = np.zeros(n)
        np.maximum.at(top, kinds, runs)
        out[:, put["top_word"]] = top / some
    for i, t in enumerate(texts):
        lines = [x for x in t.split(b"\n") if x]
        if lines:
            out[i, put["line_words"]] = np.log1p(per[i] / len(lines))
            out[i, put["distinct_lines"]] = len(set(lines)) / len(lines)
            parts = [t[k: k + 65536] for k in range(0, len(t), 65536)]
            out[i, put["packed"]] = np.mean([len(zlib.compress(p, 1)) / len(p) for p in parts])
    out[:, put["capital_words"]] = counts[:, CLASSES.index("upper")] / some
    return out


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, x): the statistics of every row's text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(crc_mod(id_col, 5) == 0, F.lit(False)).alias("held_out"),
                       text_or_empty(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _class_table()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for lo, hi in slices(texts):
                x = text_features(texts[lo:hi], table).astype(np.float32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                     pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))],
                    names=["doc_id", "held_out", "x"])

    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, x array<float>")


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


class Bins:
    """One-hot quantile bins of the statistics, and a constant."""

    def __init__(self, edges: list[list[float]]):
        self.edges = [np.unique(np.array(e, np.float32)) for e in edges]
        self.offsets = np.cumsum([0, *[len(e) + 1 for e in self.edges]])
        self.size = int(self.offsets[-1]) + 1

    def places(self, x: np.ndarray) -> np.ndarray:
        """Index of the bin of each statistic (the constant is the last index)."""
        cols = [self.offsets[j] + np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)]
        return np.stack([*cols, np.full(len(x), self.size - 1)], axis=1)

    def dense(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.size), np.float32)
        np.put_along_axis(out, self.places(x), 1.0, axis=1)
        return out


def class_prior(labelled: DataFrame) -> float:
    """The share of good documents: the labelled rows' own, kept off 0 and 1."""
    n, good = labelled.agg(F.count(F.lit(1)), F.sum((F.col("label") == 1).cast("bigint"))).first()
    return min(max((good or 0) / n, 0.02), 0.98) if n else 0.5


def fit(train: DataFrame, prior: float, bins: Bins) -> np.ndarray | None:
    """Weights of the non-negative PU risk over ``train`` (x, positive: every row is unlabelled text as well)."""
    size = bins.size

    def share_at(w: np.ndarray):
        def share(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            # rows: gradient, mean of positives; then Hessian; then counts and risks
            total = np.zeros((size + 3, size))
            for batch in batches:
                if not batch.num_rows:
                    continue
                positive = batch.column(batch.schema.get_field_index("positive")).to_numpy(zero_copy_only=False).astype(bool)
                x = bins.dense(_matrix(batch, "x"))
                z = x @ w.astype(np.float32)
                s = 1 / (1 + np.exp(-z))
                loss = np.logaddexp(0, z)  # l(-z)
                total[0] += x.T @ s
                total[1] += x[positive].sum(axis=0)
                total[2:-1] += x.T @ (x * (s * (1 - s))[:, None])
                total[-1, :4] += (len(x), positive.sum(), loss.sum(), loss[positive].sum())
            return total
        return sum_arrays(train, share, (size + 3, size))

    w, step = np.zeros(size), None
    best, scale = None, 1.0
    for _ in range(STEPS):
        got = share_at(w)
        n, n_pos, loss_u, loss_p = got[-1, :4]
        if not n or not n_pos:
            return None
        negative = loss_u / n - prior * loss_p / n_pos
        if negative < 0 and step is not None:  # the negatives' risk cannot be below zero: go back half-way
            scale /= 2
            w = best + scale * step
            if scale < 1e-3:
                return best
            continue
        best, scale = w, 1.0
        gradient = got[0] / n - prior * got[1] / n_pos + RIDGE * w
        hessian = got[2:-1] / n + RIDGE * np.eye(size)
        step = -np.linalg.solve(hessian, gradient)
        largest = np.abs(step).max()
        step *= min(1.0, 4.0 / max(largest, 1e-12))
        if largest < 1e-3:
            break
        w = best + step
    return best


def calibrate(labelled: DataFrame, weights: np.ndarray, bins: Bins, grid: int = 4096, reach: float = 20.0) -> tuple:
    """(slope, offset) that turn the model's value into a probability of the label.

    The learning rows' labels are counted per value and label in one job; two
    numbers are then fitted to the ``2 x grid`` counts.  Without both labels the
    values stay as they are.
    """
    def share(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        counts = np.zeros((2, grid))
        for batch in batches:
            if batch.num_rows:
                z = weights[bins.places(_matrix(batch, "x"))].sum(axis=1)
                cell = np.clip((z + reach) / (2 * reach) * grid, 0, grid - 1).astype(np.int64)
                good = batch.column(batch.schema.get_field_index("positive")).to_numpy(zero_copy_only=False).astype(np.int64)
                counts += np.bincount(good * grid + cell, minlength=2 * grid).reshape(2, grid)
        return counts

    counts = sum_arrays(labelled, share, (2, grid), blocks=1)
    if not counts.sum(axis=1).all():
        return 1.0, 0.0
    z = (np.arange(grid) + 0.5) / grid * 2 * reach - reach
    x = np.stack([z, np.ones(grid)], axis=1)
    both, w = counts.sum(axis=0), np.array([1.0, 0.0])
    for _ in range(50):
        s = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (counts[1] - both * s) - 1e-2 * (w - [1.0, 0.0])
        hessian = (x * (both * s * (1 - s))[:, None]).T @ x + 1e-2 * np.eye(2)
        move = np.linalg.solve(hessian, gradient)
        w = w + move * min(1.0, 2.0 / max(np.abs(move).max(), 1e-12))
    return float(w[0]), float(w[1])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> DataFrame:
    """(doc_id, held_out, score): probability that the document is good; learned from rows not held out."""
    table = written(features(docs, id_col, text_col), "quality-features")
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).cast("bigint").alias("__id")).agg(F.max(label_col).alias("label"))
             .where(crc_mod("__id", 5) != 0))
    train = table.where(~F.col("held_out") & F.col("doc_id").isNotNull())
    labelled = train.join(known, F.col("doc_id") == F.col("__id"), "left").select(
        "x", "label", (F.coalesce("label", F.lit(0)) == 1).alias("positive"))
    labelled = written(labelled, "quality-train")
    prior = class_prior(labelled.where("label is not null"))
    cuts = [k / BINS for k in range(1, BINS)]
    columns = labelled.select(*[F.col("x")[j].cast("double").alias(f"f{j}") for j in range(len(FEATURES))])
    edges = columns.approxQuantile(columns.columns, cuts, 0.002)
    bins = Bins(edges)
    weights = fit(labelled.select("x", "positive"), prior, bins)
    slope, offset = (1.0, 0.0) if weights is None else calibrate(
        labelled.where("label is not null").select("x", "positive"), weights, bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if weights is None:
                s = np.full(batch.num_rows, 0.5)
            else:
                z = weights[bins.places(_matrix(batch, "x"))].sum(axis=1) if batch.num_rows else np.zeros(0)
                s = np.round(1 / (1 + np.exp(-np.clip(slope * z + offset, -40, 40))), 9)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64())],
                                             names=["doc_id", "held_out", "score"])

    return table.mapInArrow(run, "doc_id bigint, held_out boolean, score double")


def op4_pu_quality(spark, sf_dir: str) -> DataFrame:
    scored = score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return scored.withColumn("predicted", (F.col("score") >= KEEP_AT).cast("int"))
