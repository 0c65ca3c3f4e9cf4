"""Near-duplicate classes of documents with DartMinHash signatures.

Every weighted element owns the region weight x rank, into which hashed darts
are thrown: a unit-rate Poisson process over (weight, rank) that depends on the
element alone.  A dart inside a text's region belongs to a random coordinate;
each coordinate keeps its earliest dart (smallest rank).  Two texts agree in a
coordinate with the probability of their weighted Jaccard similarity.  Only
darts below the rank at which about ``k (ln k + 3)`` darts are expected are
thrown, so a long text costs one dart per element and a few per coordinate.

Signatures are banded; texts that share a band are candidates.  Candidates are
never expanded into all pairs of a bucket: two rounds test every member of a
bucket against one leader, and whatever is still in different components of a
bucket is compared exhaustively, tile by tile, on the signatures.  Pairs whose
signatures agree well enough are checked exactly on the texts' shingle sets; a
tile checks its own and gives fewer links than it has members.

Defined results: an empty, null or word-less text is in no class but its own;
equal texts (with a word) share a class; a text of fewer than ``words`` words is
one shingle; the class is the smallest id of the component; rows that repeat an
id belong to that id's class; a row with a null id has a null class.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import (column_texts, gram_codes, mix, on_documents, ranges_concat,
                                   read_table, slices, split_codes, written)
from tickspark.llm.components import components

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 6
COORDINATES = BANDS * ROWS
#: Least share of equal coordinates for an exact check: 3.7 standard errors below the threshold.
AGREE = 0.69
#: Members of a bucket compared in one tile side.
TILE = 1024
_ARRIVAL, _COORD, _COLUMN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def throw_darts(codes: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int,
                k: int = COORDINATES) -> np.ndarray:
    """Signatures (texts x k, uint64) of the weighted sets given as parallel arrays.

    ``codes`` are the elements, ``weights`` their weights (> 0), ``owner`` the
    set each belongs to.  A set without elements gets zeros.
    """
    out = np.zeros((texts, k), np.uint64)
    # weight axis in columns [0,1), [1,2), [2,4), [4,8) ...: an element spans those its weight reaches
    columns = np.where(weights > 1, np.ceil(np.log2(np.maximum(weights, 1))).astype(np.int64) + 1, 1)
    which = ranges_concat(np.zeros(len(codes), np.int64), columns)
    item = np.repeat(np.arange(len(codes)), columns)
    column_codes = mix(codes[item] + which.astype(np.uint64) * _COLUMN)
    low = np.where(which > 0, 2.0 ** (which - 1), 0.0)
    rate = np.where(which > 0, 2.0 ** (which - 1), 1.0)
    reach, sets = weights[item], owner[item]
    total = np.bincount(owner, weights=weights, minlength=texts)
    open_sets = total > 0
    darts = k * (math.log(k) + 3)
    while open_sets.any():
        limit = np.divide(darts, total, out=np.zeros(texts), where=total > 0)
        live = np.flatnonzero(open_sets[sets])
        rank = np.zeros(len(live))
        found_set, found_rank, found_hash = [], [], []
        number = 0
        while len(live):
            # as many arrivals at a time as the elements have still to expect, on average
            width = int(np.clip(np.mean((limit[sets[live]] - rank) * rate[live]), 1, 64))
            numbers = np.arange(number, number + width, dtype=np.uint64)
            hashes = mix(column_codes[live][:, None] + numbers[None, :] * _ARRIVAL)
            gaps = -np.log((hashes >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 + 2.0 ** -54)
            arrivals = rank[:, None] + np.cumsum(gaps, axis=1) / rate[live][:, None]
            inside = arrivals <= limit[sets[live]][:, None]
            r, c = np.nonzero(inside)
            h = hashes[r, c]
            place = low[live[r]] + (mix(h ^ _COLUMN) >> np.uint64(11)) * 2.0 ** -53 * rate[live[r]]
            hit = place < reach[live[r]]
            found_set.append(sets[live[r[hit]]])
            found_rank.append(arrivals[r[hit], c[hit]])
            found_hash.append(h[hit])
            more = inside[:, -1]
            live, rank = live[more], arrivals[more, -1]
            number += width
        s, ranks, h = (np.concatenate(x) for x in (found_set, found_rank, found_hash))
        coordinate = (mix(h + _COORD) % np.uint64(k)).astype(np.int64)
        cell = s * k + coordinate
        earliest = np.full(texts * k, np.inf)
        np.minimum.at(earliest, cell, ranks)
        first = ranks == earliest[cell]
        values = np.zeros(texts * k, np.uint64)
        values[cell[first]] = h[first] | np.uint64(1)
        full = values.reshape(texts, k)
        complete = open_sets & (full != 0).all(axis=1)
        out[complete] = full[complete]
        open_sets &= ~complete
        darts *= 2  # a coordinate of these sets caught no dart: look further up the rank axis
    return out


def shingles(codes: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Codes of the runs of ``n`` words (of the whole text, if it is shorter), in order."""
    return gram_codes(codes, min(n, len(codes))) if len(codes) else codes


def signatures(texts: list[str], n: int, k: int, weighted: bool) -> tuple[np.ndarray, np.ndarray]:
    """(texts x k signatures, whether the text has a word)."""
    codes, weights, sizes = [], [], np.zeros(len(texts), np.int64)
    for i, words in enumerate(split_codes(texts)):
        found = shingles(words, n)
        if weighted:
            found, count = np.unique(found, return_counts=True)
            weights.append(count.astype(np.float64))
        else:  # equal darts of a repeated shingle cannot change a minimum, but their number sets the limit
            found = np.unique(found)
            weights.append(np.ones(len(found)))
        codes.append(found)
        sizes[i] = len(found)
    owner = np.repeat(np.arange(len(texts)), sizes)
    return throw_darts(np.concatenate(codes), np.concatenate(weights), owner, len(texts), k), sizes > 0


def sketch(docs: DataFrame, n: int = WORDS, k: int = COORDINATES, bands: int = BANDS, rows: int = ROWS,
           weighted: bool = False) -> DataFrame:
    """(doc_id, h1, h2, bands, sig) per row of ``docs`` (doc_id, text); only the id, if the text has no word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        turn = np.arange(1, bands + 1, dtype=np.uint64) * _COORD
        for batch in batches:
            texts, ids = column_texts(batch), batch.column(0).to_pylist()
            for lo, hi in slices(texts):
                sig, some = signatures(texts[lo:hi], n, k, weighted)
                keep, bare = np.flatnonzero(some), np.flatnonzero(~some)
                if len(bare):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[lo + i] for i in bare], pa.int64()),
                         *(pa.nulls(len(bare), t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))],
                        names=["doc_id", "h1", "h2", "bands", "sig"])
                if not len(keep):
                    continue
                sig = sig[keep]
                key = np.repeat(turn[None, :], len(keep), axis=0)
                parts = sig[:, : bands * rows].reshape(len(keep), bands, rows)
                for r in range(rows):
                    key = mix(key * _ARRIVAL + parts[:, :, r])
                digests = [xxhash.xxh3_128_digest(texts[lo + i].encode("utf-8", "surrogatepass")) for i in keep]
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                small = (mix(sig) >> np.uint64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[lo + i] for i in keep], pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                     pa.ListArray.from_arrays(np.arange(len(keep) + 1, dtype=np.int32) * bands,
                                              pa.array(key.view(np.int64).ravel())),
                     pa.array([s.tobytes() for s in small], pa.binary())],
                    names=["doc_id", "h1", "h2", "bands", "sig"])

    return docs.mapInArrow(run, "doc_id bigint, h1 bigint, h2 bigint, bands array<bigint>, sig binary")


def _verified(pairs: DataFrame, sketches: DataFrame, texts: DataFrame, n: int, threshold: float,
              agree: float) -> DataFrame:
    """The (a, b) of ``pairs`` that are similar: signatures first, then exactly on the shingle sets."""
    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8) for i in (2, 3))
            if not batch.num_rows:
                continue
            same = (left == right).reshape(batch.num_rows, -1).mean(axis=1)
            yield batch.filter(pa.array(same >= agree)).select([0, 1])

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = column_texts(batch, "text_a"), column_texts(batch, "text_b")
            good = np.zeros(batch.num_rows, bool)
            for lo, hi in slices(a):
                own = {y: i for i, y in enumerate(dict.fromkeys(b[lo:hi]))}  # a leader's text is hashed once
                left = [np.unique(shingles(w, n)) for w in split_codes(a[lo:hi])]
                right = [np.unique(shingles(w, n)) for w in split_codes(list(own))]
                for i in range(lo, hi):
                    sx, sy = left[i - lo], right[own[b[i]]]
                    both = len(np.intersect1d(sx, sy, assume_unique=True))
                    good[i] = both >= threshold * (len(sx) + len(sy) - both) - 1e-9
            yield batch.filter(pa.array(good)).select([0, 1])

    sig = sketches.select("u", "sig")
    seen = (pairs.join(sig.select(F.col("u").alias("a"), F.col("sig").alias("sig_a")), "a")
            .join(sig.select(F.col("u").alias("b"), F.col("sig").alias("sig_b")), "b")
            .select("a", "b", "sig_a", "sig_b").mapInArrow(agreeing, "a bigint, b bigint"))
    near = written(seen, "near-candidates")
    full = (near.join(texts.select(F.col("u").alias("a"), F.col("text").alias("text_a")), "a")
            .join(texts.select(F.col("u").alias("b"), F.col("text").alias("text_b")), "b")
            .select("a", "b", "text_a", "text_b"))
    return written(full.mapInArrow(similar, "a bigint, b bigint"), "near-edges")


def _star(buckets: DataFrame, rank: list) -> DataFrame:
    """Distinct (a, b): every member of a bucket with the bucket's leader (first by ``rank``)."""
    leaders = written(buckets.groupBy("key").agg(F.min(F.struct(*rank)).alias("lead")), "near-leaders")
    pairs = buckets.join(leaders, "key").select(F.col("u").alias("a"), F.col("lead.u").alias("b"), "root",
                                                F.col("lead.root").alias("lead_root"))
    return pairs.where("root <> lead_root").select("a", "b").distinct()


def _shingle_sets(texts: DataFrame, n: int) -> DataFrame:
    """(u, codes): the sorted distinct shingle codes of each text of ``texts`` (u, text), as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = column_texts(batch)
            for lo, hi in slices(found):
                sets = [np.unique(shingles(w, n)).tobytes() for w in split_codes(found[lo:hi])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(sets, pa.binary())],
                                                 names=["u", "codes"])

    return texts.select("u", "text").mapInArrow(run, "u bigint, codes binary")


def _rest(buckets: DataFrame, sketches: DataFrame, texts: DataFrame, n: int, threshold: float, k: int, bands: int,
          agree: float) -> DataFrame:
    """(a, b), similar members of different components of a bucket: links enough to join them.

    A bucket's largest component is its body; the others are tested against
    the body and each other, in tiles of at most ``TILE`` by ``TILE`` members,
    each pair in its first shared band only.  A tile checks its pairs exactly and
    joins what is similar as it goes, so it gives fewer links than it has members
    and no table of pairs exists.
    """
    sizes = buckets.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    body = written(sizes.groupBy("key").agg(
        F.max(F.struct("n", F.col("root"))).alias("top"), F.sum("n").alias("n"))
        .select("key", F.col("top.root").alias("body"), (F.col("n") - F.col("top.n")).alias("others"),
                F.col("top.n").alias("inside")), "near-bodies")
    rowed = buckets.join(body, "key")
    is_body = F.col("root") == F.col("body")
    tiles_o = F.ceil(F.col("others") / F.lit(TILE)).cast("int")
    tiles_b = F.ceil(F.col("inside") / F.lit(TILE)).cast("int")
    own = F.pmod(F.xxhash64("u"), F.when(is_body, tiles_b).otherwise(tiles_o)).cast("int")
    # tile (i, j): others i with others j (j >= i), or others i with body part -1 - j
    spots = F.when(is_body, F.transform(F.sequence(F.lit(0), tiles_o - 1),
                                        lambda i: F.struct(i.alias("i"), (-1 - F.col("own")).alias("j")))).otherwise(
        F.concat(F.transform(F.sequence(F.lit(0), tiles_o - 1), lambda j: F.struct(
            F.least(F.col("own"), j).alias("i"), F.greatest(F.col("own"), j).alias("j"))),
            F.transform(F.sequence(F.lit(0), tiles_b - 1), lambda j: F.struct(
                F.col("own").alias("i"), (-1 - j).alias("j")))))
    placed = (rowed.withColumn("own", own).select("key", "band", "u", "root", is_body.alias("is_body"), "own",
                                                  F.explode(spots).alias("tile"))
              .select("key", "band", "u", "root", "is_body", "own", "tile.i", "tile.j")
              .join(sketches.select("u", "bands", "sig"), "u"))
    named = buckets.select("u").distinct()
    placed = placed.join(written(_shingle_sets(texts.join(named, "u", "left_semi"), n), "near-shingles"), "u")

    schema = "a bigint, b bigint"
    parts = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tiles = (placed.repartition(parts, "key", "i", "j").sortWithinPartitions("key", "i", "j", "u")
             .select("key", "i", "j", "band", "u", "root", "is_body", "own", "bands", "sig", "codes"))
    return written(tiles.mapInArrow(_tile_links(threshold, k, bands, agree), schema), "near-rest")


def _tile_links(threshold: float, k: int, bands: int, agree: float):
    """Compares the members of each tile (rows of one key, i, j stand together; a tile is bounded).

    The first shared band is found on the keys of the buckets: the signatures
    are cut to a byte per coordinate and may agree in a band without a bucket.
    Pairs that agree are checked on their shingles until their components meet.
    """
    def similar(x: bytes, y: bytes) -> bool:
        a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = len(np.intersect1d(a, b, assume_unique=True))
        return both >= threshold * (len(a) + len(b) - both) - 1e-9

    def compare(tile: dict) -> tuple[np.ndarray, np.ndarray]:
        i, j, band = int(tile["i"][0]), int(tile["j"][0]), int(tile["band"][0])
        body, own = tile["is_body"], tile["own"]
        left = np.flatnonzero(~body & (own == i))
        right = np.flatnonzero(body) if j < 0 else np.flatnonzero(~body & (own == j))
        out_a, out_b = [], []
        u, sig, keys, codes = tile["u"], tile["sig"], tile["bands"], tile["codes"]
        # components within the tile, as labels of its members; they start from those known
        part = np.unique(tile["root"], return_inverse=True)[1]
        for x in left:
            fit = (part[right] != part[x]) & ((sig[right] == sig[x]).mean(axis=1) >= agree)
            if j == i:
                fit &= u[right] > u[x]
            hits = right[fit]
            if len(hits):
                hits = hits[(keys[hits] == keys[x]).argmax(axis=1) == band]
            for y in hits:
                if part[y] != part[x] and similar(codes[x], codes[y]):
                    part[part == part[y]] = part[x]
                    out_a.append(u[x])
                    out_b.append(u[y])
        return np.array(out_a, np.int64), np.array(out_b, np.int64)

    def columns(batch: pa.RecordBatch) -> dict:
        out = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("key", "i", "j", "band", "u", "root", "is_body", "own")}
        out["is_body"] = out["is_body"].astype(bool)
        out["bands"] = batch.column("bands").flatten().to_numpy(zero_copy_only=False).reshape(-1, bands)
        out["sig"] = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint8).reshape(-1, k)
        out["codes"] = np.empty(batch.num_rows, object)
        out["codes"][:] = batch.column("codes").to_pylist()
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None

        def pairs(tiles: list[dict]) -> pa.RecordBatch:
            found = [compare(t) for t in tiles]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[n] for f in found])) for n in (0, 1)],
                                              names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            now = columns(batch)
            if held is not None:
                now = {n: np.concatenate([held[n], v]) for n, v in now.items()}
            change = np.zeros(len(now["u"]) - 1, bool)
            for n in ("key", "i", "j"):
                change |= now[n][1:] != now[n][:-1]
            cuts = [0, *(np.flatnonzero(change) + 1).tolist()]
            whole = [{n: v[lo:hi] for n, v in now.items()} for lo, hi in zip(cuts, cuts[1:])]
            held = {n: v[cuts[-1]:] for n, v in now.items()}  # the last tile may go on in the next batch
            if whole:
                yield pairs(whole)
        if held is not None:
            yield pairs([held])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WORDS,
                    threshold: float = THRESHOLD, weighted: bool = False, k: int = COORDINATES,
                    bands: int = BANDS, rows: int = ROWS, agree: float = AGREE) -> DataFrame:
    """(doc_id, class_id, text_id) per row with an id: near-duplicate class and the first id with this very text.

    ``weighted`` throws darts by shingle counts (weighted Jaccard) instead of
    sets; the exact check is on sets in either case.
    """
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text")).where("doc_id is not null")
    rows_all = written(sketch(plain, n, k, bands, rows, weighted), "near-sketch")
    sketched = rows_all.where("sig is not null")
    sketches = written(sketched.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("u"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "near-texts")
    keyed = sketches.select("u", F.posexplode("bands").alias("band", "key"))
    busy = written(keyed.groupBy("key").agg(F.min("u").alias("lo"), F.max("u").alias("hi")).where("lo < hi")
                   .select("key"), "near-busy")
    buckets = written(keyed.join(busy, "key").select("key", "band", "u"), "near-buckets")
    members = buckets.select("u").distinct()
    texts = written(plain.join(sketched.select("doc_id").join(members, F.col("doc_id") == F.col("u"), "left_semi"),
                               "doc_id", "left_semi")
                    .select(F.col("doc_id").alias("u"), "text").dropDuplicates(["u"]), "near-bodies-text")

    single = buckets.withColumn("root", F.col("u"))
    first = _verified(_star(single, [F.col("u"), F.col("root")]), sketches, texts, n, threshold, agree)
    # the second leaders are the members with the most links; members with the same first leader are linked already
    near = first.select(F.col("a").alias("u"), F.col("b").alias("root")).groupBy("u").agg(F.min("root").alias("root"))
    degree = first.select(F.explode(F.array("a", "b")).alias("u")).groupBy("u").agg(F.count(F.lit(1)).alias("d"))
    known = written(degree.join(near, "u", "left"), "near-degree")
    hubs = buckets.join(known, "u", "left").select(
        "key", "band", "u", F.coalesce("root", "u").alias("root"), (-F.coalesce("d", F.lit(0))).alias("r"))
    hubs = written(hubs, "near-hubs")
    second = _verified(_star(hubs, [F.col("r"), F.col("u"), F.col("root")]), sketches, texts, n, threshold, agree)
    roots = written(components(first.union(second)), "near-roots")
    several = written(_open(buckets, roots), "near-open")
    rest = _rest(several, sketches, texts, n, threshold, k, bands, agree)
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    roots = written(components(stars.union(rest)), "near-roots")

    own = sketches.select("h1", "h2", "u")
    rows_u = sketched.select("doc_id", "h1", "h2").join(own, ["h1", "h2"])
    classed = rows_u.join(roots, rows_u.u == roots.node, "left").select(
        "doc_id", F.coalesce("root", "u").alias("class_id"), F.col("u").alias("text_id"))
    # texts without a word have no signature: each stands alone
    bare = rows_all.where("sig is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("text_id"))
    return classed.union(bare)


def _open(buckets: DataFrame, roots: DataFrame) -> DataFrame:
    """Bucket members with their component's root, for buckets that still hold untested pairs.

    Those have several components, and more than two members: of two members
    one was the other's leader.
    """
    rooted = written(buckets.join(roots, buckets.u == roots.node, "left")
                     .select("key", "band", "u", F.coalesce("root", "u").alias("root")), "near-rooted")
    several = written(rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                                F.count(F.lit(1)).alias("n"))
                      .where("lo < hi and n > 2").select("key"), "near-several")
    return rooted.join(several, "key", "left_semi")


def op1_dart_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


@on_documents
def near_duplicate_stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: one document of each class stays (its smallest id); null ids stay."""
    found = near_duplicates(docs)
    gone = written(found.where("doc_id <> class_id").select("doc_id").distinct(), "near-gone")
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # rows that repeat an id are one document: one row stays
    named = kept.where("doc_id is not null").dropDuplicates(["doc_id"])
    return named.unionByName(kept.where("doc_id is null"))
