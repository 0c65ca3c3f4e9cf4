"""Embedding whitening: eigenvectors of the distributed covariance, found in float32 and refined in higher precision.

``fit_whitening`` makes three passes over the vectors: rows and a provisional
centre, sums, products of the centred vectors.  Tasks return sums of a fixed
size (the square of the dimension), which Spark adds in two steps; the driver
receives one matrix, whatever the number of rows.  Whole-number vectors (arrays
of long) are summed without rounding, so the model does not depend on how rows
are dealt to tasks.  ``refined_eigen`` starts from float32 eigenvectors and
corrects them by Ogita-Aishima steps (matrix products in extended precision);
eigenvalues closer than the error a step can tell apart form a cluster, which is
solved on its own, shifted to its mean.  ``Whitening.apply`` projects rows.

Vectors that are null, or hold null, non-finite or huge (from 2^50) entries take
no part, nor do vectors of another length than most rows have (of equally
common lengths the greater counts).  Repeated rows count each time; ties among
eigenvalues give some orthonormal basis of their space, the same for all rows.
A direction without variance (as with one row, or equal rows) is no component.
An empty table gives an empty result.  Only the named column is read, so further
columns, whatever their names, pass through ``apply`` (a column of the name it
adds is replaced).  Memory is bounded by the dimension, not by the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.llm.common import numbered, read_table, with_fields, written

#: Entries from this size on are not used: products of whole numbers above it are not exact.
HUGE = float(2**50)
#: Doubles in a block of a task's sum, and sums added in a task of the first step's group.
BLOCK = 16_384
LANES = 64
#: Refinement steps at most; each squares the error, so a handful does.
STEPS = 20
#: Rows whose products are added together in a task.
ROWS = 4096

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000


@dataclass(frozen=True)
class Whitening:
    """The fitted model: ``n`` rows, their mean as ``centre + rest / n``, eigenvalues (falling) and eigenvectors."""

    column: str
    n: int
    dim: int
    centre: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def sums(self) -> list[int]:
        """Sums per dimension (exact for whole-number vectors)."""
        return [int(c) * self.n + int(r) for c, r in zip(self.centre, self.rest)]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean, on the components, over the square root of the eigenvalue."""
        centred = ((x - self.centre) * self.n - self.rest) / self.n
        return centred @ (self.vectors / np.sqrt(self.values))

    def apply(self, df: DataFrame, into: str = "whitened", checked: bool = False) -> DataFrame:
        """``df``'s usable rows (all, where they are ``checked``) with ``into``, an array of the components' values."""
        rows = _rows(df.drop(into), self.column, checked).where(F.size(_named(self.column)) == self.dim)
        model, names, at = self, [*rows.columns, into], f"c{rows.columns.index(self.column)}"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    w = model.project(_matrix(b, at, model.dim))
                    ends = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
                    added = pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel()))
                    yield pa.RecordBatch.from_arrays([*b.columns, added], names=names)

        return numbered(rows).mapInArrow(run, with_fields(rows.schema, T.StructField(into, T.ArrayType(T.DoubleType()))))


def _named(column: str) -> Column:
    return F.col(f"`{column}`")


def usable(column: str) -> Column:
    """Whether a vector is there and each entry is a number below ``HUGE`` (NaN compares as the greatest)."""
    fit = lambda v: v.isNotNull() & (F.abs(v.cast("double")) < HUGE)
    return F.coalesce(_named(column).isNotNull() & (F.size(_named(column)) > 0) & F.forall(_named(column), fit), F.lit(False))


def _rows(df: DataFrame, column: str, checked: bool) -> DataFrame:
    return df if checked else df.where(usable(column))


def _matrix(batch: pa.RecordBatch, column: str, dim: int) -> np.ndarray:
    flat = batch.column(batch.schema.get_field_index(column)).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _slices(batches: Iterator[pa.RecordBatch], column: str, dim: int) -> Iterator[np.ndarray]:
    for b in batches:
        x = _matrix(b, column, dim)
        for lo in range(0, len(x), ROWS):
            yield x[lo: lo + ROWS]


def summed(df: DataFrame, share: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks of ``share(batches)``, ``size`` doubles.

    Shares are cut into blocks and added block by block, first in ``LANES``
    groups of tasks, then all: no task holds more than a block of each task of
    its lane, and the driver receives one array.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = np.asarray(share(batches), np.float64).ravel()
        cut = [flat[lo: lo + BLOCK].tobytes() for lo in range(0, size, BLOCK)]
        lane = [TaskContext.get().partitionId() % LANES] * len(cut)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cut)), pa.int64()), pa.array(lane, pa.int64()),
                                          pa.array(cut, pa.binary())], names=["block", "lane", "v"])

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        # sorted: the sum does not depend on the order in which the shares arrive
        total = np.zeros(len(frame.v.iloc[0]) // 8)
        for v in sorted(frame.v):
            total += np.frombuffer(v)
        return pd.DataFrame({"block": [key[0]], "v": [total.tobytes()]})

    part = df.mapInArrow(run, "block bigint, lane bigint, v binary").groupBy("block", "lane").applyInPandas(
        add, "block bigint, v binary")
    rows = sorted(part.groupBy("block").applyInPandas(add, "block bigint, v binary").collect(), key=lambda r: r.block)
    return np.concatenate([np.frombuffer(r.v) for r in rows]) if rows else np.zeros(size)


def _clusters(values: np.ndarray, gap: float) -> Iterator[np.ndarray]:
    """Index ranges of two or more consecutive (sorted) values, neighbours at most ``gap`` apart."""
    breaks = np.flatnonzero(np.abs(np.diff(values)) > gap) + 1
    for part in np.split(np.arange(len(values)), breaks):
        if len(part) > 1:
            yield part


def refined_eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of a symmetric matrix, to double precision.

    Start: float32.  Step (in extended precision): with R = I - X'X, S = X'AX and
    l = diag(S) / (1 - diag(R)), X becomes X + XE, E_ij = (S_ij + l_j R_ij) / (l_j - l_i),
    or R_ij / 2 where the two eigenvalues are no further apart than the error.
    Those pairs form clusters: X_J'AX_J, less its mean eigenvalue, is solved alone
    and turns X_J, which makes S diagonal there too.
    """
    a = np.asarray(a, np.longdouble)
    size = np.abs(a).max() if a.size else np.longdouble(0)
    if not size:
        return np.zeros(len(a)), np.eye(len(a))
    a = (a + a.T) / (2 * size)
    start = np.linalg.eigh(a.astype(np.float32))
    x = start[1][:, ::-1].astype(np.longdouble)
    one, norm = np.eye(len(a), dtype=np.longdouble), np.sqrt((a * a).sum())
    done = 4 * len(a) * np.finfo(np.longdouble).eps
    before = np.inf
    for _ in range(STEPS):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        # symmetric to the last bit: a small gap below would magnify the difference
        r, s = (r + r.T) / 2, (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        error = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + norm * np.sqrt((r * r).sum()))
        apart = values[None, :] - values[:, None]
        far = np.abs(apart) > error
        e = np.where(far, (s + values[None, :] * r) / np.where(far, apart, 1), r / 2)
        x = x + x @ e
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        for part in _clusters(values, error):
            t = x[:, part].T @ (a @ x[:, part])
            t = (t + t.T) / 2 - np.eye(len(part)) * values[part].mean()
            if np.abs(t).max():
                turn = np.linalg.eigh((t / np.abs(t).max()).astype(np.float64))[1][:, ::-1]
                x[:, part] = x[:, part] @ turn.astype(np.longdouble)
        moved = np.abs(e).max()
        if moved <= done or (moved < 1e-12 and moved >= before / 2):
            break
        before = moved
    s = np.einsum("ij,ij->j", x, a @ x) / np.einsum("ij,ij->j", x, x)
    order = np.argsort(-s, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    return (s[order] * size).astype(np.float64), x.astype(np.float64)


def fit_whitening(df: DataFrame, column: str, components: int = COMPONENTS, checked: bool = False) -> Whitening | None:
    """The whitening of all usable vectors of ``column`` (None where there is none)."""
    v = _named(column)
    rows = _rows(df, column, checked).select(v.alias("v"))
    whole = isinstance(df.schema[column].dataType.elementType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    lengths = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"))
    most = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return None
    n, dim, low = most.n, most.dim, np.array(most.low, np.float64)
    rows = rows.where(F.size("v") == dim)

    def total(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return sum(((x - low).sum(axis=0) for x in _slices(batches, "v", dim)), np.zeros(dim))

    rest = summed(rows, total, dim)
    # the centre of whole numbers is whole, so that differences and their products are exact
    step = np.rint(rest / n) if whole else rest / n
    centre, rest = low + step, (rest - step * n if whole else np.zeros(dim))

    def products(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((dim, dim))
        for x in _slices(batches, "v", dim):
            y = x - centre
            out += y.T @ y
        return out

    cov = summed(rows, products, dim * dim).reshape(dim, dim).astype(np.longdouble) / n
    off = rest.astype(np.longdouble) / n
    cov = cov - np.outer(off, off)
    values, vectors = refined_eigen(cov)
    there = values > max(values[0], 0) * dim * 2.0**-50
    keep = min(components, int(there.sum()))
    return Whitening(column, n, dim, centre, rest, values[:keep], vectors[:, :keep], float(np.trace(cov)))


def identity_error(df: DataFrame, model: Whitening, checked: bool = False) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, over all rows."""
    k = len(model.values)
    rows = _rows(df, model.column, checked).select(_named(model.column).alias("v")).where(F.size("v") == model.dim)

    def moments(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((k + 1, k))
        for x in _slices(batches, "v", model.dim):
            w = model.project(x)
            # whitened rows are centred to rounding; their own mean is taken off below
            out += np.vstack([w.T @ w, w.sum(axis=0)])
        return out

    got = summed(rows, moments, (k + 1) * k).reshape(k + 1, k) / model.n
    return float(np.abs(got[:k] - np.outer(got[k], got[k]) - np.eye(k)).max()) if k else 0.0


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable row of ``embeddings`` on up to 32 components, with its exact deviation and the measured identity error."""
    # an entry that is no usable number becomes null, and its row takes no part
    whole = lambda v: F.when(F.abs(v.cast("double")) < HUGE, F.floor(v.cast("double") * SCALE).cast("long") + SHIFT)
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", whole).alias("x"))
    # four passes follow: the whole numbers, checked, are computed once (small ones take about a byte each)
    rows = written(rows.where(usable("x")), "whitening-rows")
    schema = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    model = fit_whitening(rows, "x", checked=True)
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    n = F.lit(model.n).cast("long")
    sums = F.lit(model.sums)
    # exact, null where it is no long
    squared = F.zip_with("x", sums, lambda v, s: F.try_subtract(F.try_multiply(n, v), s))
    squared = F.transform(squared, lambda d: F.try_multiply(d, d))
    deviation = F.aggregate(squared, F.lit(0).cast("long"), lambda a, d: F.try_add(a, d))
    shares = F.lit([float(v / model.trace) for v in model.values])
    long = model.apply(rows, checked=True).select("vec_id", deviation.alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
    return long.select(
        F.col("vec_id").cast("long").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"), n.alias("n"), "deviation",
        "whitened", F.get(shares, "at").alias("explained"), F.lit(identity_error(rows, model, checked=True)).alias("identity_error"))
