"""Exact top-k inner products by the no-random-access threshold algorithm.

Vectors are packed into blocks of bounded size; a block keeps, per dimension,
its vectors sorted by that component (the lists).  A query reads all lists of a
block from the end that its own component favours, a stretch at a time.  From
what it has read it keeps, for every vector, a lower and an upper bound of the
score: unread components lie between the list's worst value and the value the
reading has reached.  It stops when no vector outside the best ``k`` lower
bounds can reach the k-th; the exact scores of the few left are then resolved.
The blocks' winners meet in one aggregation per query.

Integers: a component x counts as floor(1024 * x).  Scores are exact as long as
they fit a signed 64-bit integer.

Defined results: rows with a null id, or a null vector or one that holds a null
or non-finite component, take no part; vectors are compared with queries of the
same length only; ties go to the smaller id; repeated rows are candidates each,
but never of the query with their id.  A query without candidates has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickspark.llm.common import read_table, written

#: Vectors of a block: 8192 x 64 components and their lists are about 10 MB in a task.
BLOCK_ROWS = 8192
#: Queries sent to the blocks at a time.
QUERY_ROWS = 4096
#: Integers whose products and sums stay exact in a double.
EXACT = 2.0 ** 53


class Block:
    """A block's vectors with a list per dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        dims = vectors.shape[1]
        # per dimension: places of the vectors by rising component, and the components; and both from the other end
        rising = np.argsort(self.vectors, axis=0, kind="stable").T
        values = np.take_along_axis(self.vectors.T, rising, axis=1).astype(np.float64)
        rising = rising.astype(np.int32)
        self.places = (np.ascontiguousarray(rising[:, ::-1]), np.ascontiguousarray(rising))
        self.values = (np.ascontiguousarray(values[:, ::-1]), values)
        # where a place's dimension stands in a table of places x dimensions
        self.cells = tuple(p * np.int32(dims) + np.arange(dims, dtype=np.int32)[:, None] for p in self.places)

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the ``k`` best vectors other than the query's own rows."""
        n, dims = self.vectors.shape
        q = query.astype(np.float64)
        falling = (q >= 0)[:, None]  # the end of a list that gives this query most
        known, unread = np.zeros(n), np.ones(n * dims, np.float32)
        worst = q * np.where(q >= 0, self.values[1][:, 0], self.values[0][:, 0])
        largest = max(np.abs(self.values[0][:, [0, -1]]).max(initial=0.0), 1.0)
        slack = np.abs(q).max(initial=0.0) * largest * dims * 1e-6
        read, stretch = 0, max(k, n // 8, 1)
        left = np.flatnonzero(self.ids != query_id)
        while read < n and len(left) > k:
            part = slice(read, min(n, read + stretch))
            places = np.where(falling, self.places[0][:, part], self.places[1][:, part])
            gains = np.where(falling, self.values[0][:, part], self.values[1][:, part]) * q[:, None]
            known += np.bincount(places.ravel(), weights=gains.ravel(), minlength=n)
            unread[np.where(falling, self.cells[0][:, part], self.cells[1][:, part])] = 0
            read = part.stop
            # float32 matrix product: the bounds are widened by more than its rounding
            ends = np.stack([gains[:, -1], worst], axis=1).astype(np.float32)
            bounds = unread.reshape(n, dims) @ ends
            high = known[left] + bounds[left, 0] + slack
            low = known[left] + bounds[left, 1] - slack
            kth = np.partition(low, len(low) - k)[len(low) - k]
            left = left[high >= kth]
            stretch *= 2
        small = float(np.abs(self.vectors[left]).max(initial=0)) * float(np.abs(query).max(initial=0)) * dims < EXACT
        if small:
            scores = (self.vectors[left].astype(np.float64) @ q).astype(np.int64)
        else:
            scores = np.array([sum(int(a) * int(b) for a, b in zip(v, query)) for v in self.vectors[left]], object)
        order = np.lexsort((self.ids[left], -scores.astype(np.float64))) if small else \
            np.array(sorted(range(len(left)), key=lambda i: (-scores[i], self.ids[left][i])), np.int64)
        order = order[:k].astype(np.int64)
        return self.ids[left][order], scores[order]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v): integer vectors of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (vectors.where(F.col(id_col).isNotNull() & v.isNotNull()).select(
        F.col(id_col).cast("bigint").alias("id"), v.alias("v")).where(finite.isNotNull() & F.forall(
            "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))))
        .select("id", F.transform("v", lambda x: F.floor(x * F.lit(1024.0))).alias("v")))


#: The range of a long.
LEAST, GREATEST = -(1 << 63), (1 << 63) - 1


def top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row fulfilling ``is_query`` its k best among all rows."""
    rows = written(usable(vectors, id_col, vector_col), "topk-rows")
    spark = rows.sparkSession
    count = rows.count()
    # blocks of about block_rows vectors whatever the input's partitions; rows are dealt evenly
    blocks = rows.repartition(max(1, -(-count // block_rows)))
    blocks = written(blocks, "topk-blocks")
    # of rows that repeat a query's id the least vector asks
    queries = rows.where(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v"))
    found, last = None, None
    while True:
        # the stated queries, a bounded block of them at a time
        page = queries if last is None else queries.where(F.col("id") > last)
        some = page.orderBy("id").limit(query_rows).collect()
        if not some:
            break
        last = some[-1].id
        sent = spark.sparkContext.broadcast([(r.id, np.array(r.v, np.int64)) for r in some])
        part = blocks.mapInArrow(_search(sent, k, block_rows), "query_id bigint, vec_id bigint, score bigint")
        part = written(part, "topk-found")
        found = part if found is None else found.union(part)
        if len(some) < query_rows:
            break
    if found is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _search(sent, k: int, block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def search(ids: list, vectors: list) -> pa.RecordBatch:
            block = Block(np.concatenate(ids), np.concatenate(vectors))
            out: tuple = ([], [], [])
            for query_id, query in sent.value:
                if len(query) == block.vectors.shape[1]:
                    best, scores = block.best(query_id, query, k)
                    out[0].append(np.full(len(best), query_id))
                    out[1].append(best)
                    # exact integers of any size; one that is no long counts as the nearest
                    out[2].append(np.array([max(LEAST, min(GREATEST, int(x))) for x in scores], np.int64))
            cols = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out]
            return pa.RecordBatch.from_arrays(cols, names=["query_id", "vec_id", "score"])

        for batch in batches:
            ids = batch.column(0).to_numpy()
            column = batch.column(1)
            ends = column.offsets.to_numpy()
            flat = column.values.to_numpy(zero_copy_only=False)
            lengths = np.diff(ends)
            for length in np.unique(lengths):
                if not length:
                    continue
                own = np.flatnonzero(lengths == length)
                taken = flat[ends[own][:, None] + np.arange(length)]
                hold = held.setdefault(int(length), ([], []))
                hold[0].append(ids[own])
                hold[1].append(taken)
                if sum(map(len, hold[0])) >= block_rows:
                    yield search(*held.pop(int(length)))
        for hold in held.values():
            yield search(*hold)

    return run


def op3_nra_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), lambda c: c % 100 == 0)


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.v) + 1),
         lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
