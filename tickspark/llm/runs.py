"""Periodic runs of words: a suffix automaton whose link tree is accessed as each word is appended.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
equal), at least ``shortest`` words and ``exponent`` periods long, which no
neighbouring word extends.  ``periodic_runs`` finds all of them.

Method: nodes of the suffix automaton's link tree stand for the substrings with
the same ends.  Appending word ``i`` accesses the path from that prefix's node to
the root of a link-cut tree, whose preferred paths hold the nodes with the same
last occurrence: every segment of the path with last end ``e`` is recoloured to
``i``, and the length ``L`` of its deepest node is that of the longest common
suffix of the prefixes ending at ``e`` and ``i``.  So where ``p = i - e <= L`` the last
``L + p`` words have the smallest period ``p``: a square, which starts where its run
does.  Where the next word breaks the period the run ends, and is reported once.

Only stretches that can hold a run go through the automaton: in a run every
phrase of ``shortest * (1 - 2 / exponent)`` words occurs again in the same text,
so a stretch is a maximal sequence of such repeated phrases (found by hashes: a
collision can lengthen a stretch, never lose one).  A run lies in one stretch.

Null, empty and blank texts have no words and no runs.  Null ids, repeated rows
and further columns pass through; columns called ``n_words``, ``runs`` or
``collapsed`` are replaced.  Ties cannot occur: a run is fixed by its start and
period.  An empty table gives no rows.  A task holds one slice of texts; the
automaton's size is linear in the longest stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.llm.common import column_texts, gram_codes, let, mix, numbered, read_table, slices, text_or_empty

SHORTEST = 24
EXPONENT = 3
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
ADDED = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
         T.StructField("collapsed", T.StringType())]
#: Words of the contract: runs of anything but ASCII white space (what ``bytes.split`` cuts at).
WORD = r"[^\x20\x09-\x0D]+"


def suffix_automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """(length, suffix link, state of each prefix) of the automaton of all substrings.

    A state's first transition is kept in two arrays, further ones (few states
    have any) in dictionaries.
    """
    size, link, word, to = [0], [-1], [-1], [0]
    more: dict[int, dict[int, int]] = {}
    last, ends = 0, []
    for c in words:
        state = len(size)
        size.append(size[last] + 1)
        link.append(0)
        word.append(-1)
        to.append(0)
        p = last
        while p != -1:
            if word[p] == c:
                break
            if word[p] == -1:
                word[p], to[p] = c, state
            else:
                others = more.setdefault(p, {})
                if c in others:
                    break
                others[c] = state
            p = link[p]
        if p != -1:
            q = to[p] if word[p] == c else more[p][c]
            if size[p] + 1 == size[q]:
                link[state] = q
            else:
                copy = len(size)
                size.append(size[p] + 1)
                link.append(link[q])
                word.append(word[q])
                to.append(to[q])
                if q in more:
                    more[copy] = dict(more[q])
                while p != -1:
                    if word[p] == c:
                        if to[p] != q:
                            break
                        to[p] = copy
                    else:
                        others = more.get(p)
                        if others is None or others.get(c) != q:
                            break
                        others[c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
        ends.append(state)
    return size, link, ends


def runs_of(words: list[int], shortest: int = SHORTEST, exponent: float = EXPONENT) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run of a list of word numbers, by start, then period."""
    size, up, ends = suffix_automaton(words)
    n, found = len(words), []
    left, right = [-1] * len(size), [-1] * len(size)
    # the last end of a preferred path, kept at the root of the path's splay tree; ``up`` leads on to the path above
    seen = [-1] * len(size)

    def rotate(x: int) -> None:
        y = up[x]
        z = up[y]
        if left[y] == x:
            inner = left[y] = right[x]
            right[x] = y
        else:
            inner = right[y] = left[x]
            left[x] = y
        if inner != -1:
            up[inner] = y
        up[y], up[x] = x, z
        if z != -1:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x

    def splay(x: int) -> None:
        while True:
            y = up[x]
            if y == -1 or (left[y] != x and right[y] != x):
                return
            z = up[y]
            if z != -1 and (left[z] == y or right[z] == y):
                rotate(y if (left[z] == y) == (left[y] == x) else x)
            rotate(x)

    for i, node in enumerate(ends):
        below = -1
        while node != -1:
            root = node
            while True:
                y = up[root]
                if y == -1 or (left[y] != root and right[y] != root):
                    break
                root = y
            end = seen[root]
            splay(node)
            seen[node] = end
            if end >= 0:
                period, common = i - end, size[node]
                length = common + period
                if (common >= period and length >= shortest and length >= exponent * period
                        and (i + 1 == n or words[i + 1] != words[i + 1 - period])):
                    found.append((i - length + 1, length, period))
            if right[node] != -1:
                seen[right[node]] = end
            right[node] = below
            below, node = node, up[node]
        seen[below] = i
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(codes: np.ndarray, text_of: np.ndarray, shortest: int, exponent: float) -> Iterator[tuple[int, int]]:
    """Ranges of words in which every phrase occurs twice in its text and which can hold a run."""
    phrase = max(1, int(shortest * (1 - 2 / exponent)))
    if len(codes) < max(shortest, phrase):
        return
    keys = gram_codes(codes, phrase) + mix(text_of[: len(codes) - phrase + 1].astype(np.uint64) + np.uint64(1))
    one_text = text_of[: len(keys)] == text_of[phrase - 1:]
    order = np.argsort(keys)
    equal = keys[order[1:]] == keys[order[:-1]]
    again = np.zeros(len(keys) + 2, bool)
    again[order[1:][equal] + 1] = True
    again[order[:-1][equal] + 1] = True
    again[1:-1] &= one_text
    edges = np.flatnonzero(again[1:] != again[:-1])
    for first, last in zip(edges[::2], edges[1::2]):
        if last - first + phrase - 1 >= shortest:
            yield int(first), int(last + phrase - 1)


def _slice_runs(texts: list[str], shortest: int, exponent: float) -> Iterator[tuple[int, list, bytes]]:
    """(words, runs, collapsed text) of each text."""
    parts = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    words = [w for p in parts for w in p]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    counts = np.fromiter(map(len, parts), np.int64, len(parts))
    begin = np.cumsum(counts) - counts
    text_of = np.repeat(np.arange(len(parts)), counts)
    by_text: dict[int, list] = {}
    # two texts' words are never in one stretch, as no phrase crosses
    for first, last in stretches(mix(ids.astype(np.uint64) + np.uint64(1)), text_of, shortest, exponent):
        t = int(text_of[first])
        by_text.setdefault(t, []).extend((first - int(begin[t]) + s, length, q) for s, length, q in runs_of(
            ids[first:last].tolist(), shortest, exponent))
    for t, part in enumerate(parts):
        runs = sorted(by_text.get(t, ()), key=lambda r: (r[0], r[2]))
        if runs:
            kept = np.ones(len(part), bool)
            for start, length, q in runs:
                kept[start + q: start + length] = False
            yield len(part), runs, b" ".join([part[j] for j in np.flatnonzero(kept)])
        else:
            yield len(part), runs, b" ".join(part)


def periodic_runs(df: DataFrame, text: str = "text", shortest: int = SHORTEST, exponent: float = EXPONENT) -> DataFrame:
    """``df`` without ``text``, with ``n_words``, ``runs`` (start, length, period, by start and period) and
    ``collapsed``: the text's words, one space between, without those after the first period of any run."""
    if exponent < 2:
        raise ValueError("a run has at least two periods")
    names = [f.name for f in ADDED]
    others = [c for c in df.columns if c not in names and c != text]
    rows = df.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = column_texts(b, f"c{len(others)}")
            for lo, hi in slices(texts):
                found = list(_slice_runs(texts[lo:hi], shortest, exponent))
                ends = np.cumsum([0] + [len(r) for _, r, _ in found]).astype(np.int32)
                flat = [x for _, r, _ in found for x in r]
                cells = pa.StructArray.from_arrays(
                    [pa.array([x[k] for x in flat], pa.int64()) for k in range(3)], names=RUN.fieldNames())
                kept = [b.column(j).slice(lo, hi - lo) for j in range(len(others))]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([n for n, _, _ in found], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), cells),
                     pa.array([c.decode("utf-8", "surrogatepass") for _, _, c in found], pa.string())],
                    names=[*others, *names])

    return numbered(rows).mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *ADDED]))


def _planted(text: Column, doc_id: Column) -> Column:
    """The contract's text: of every tenth document (by hash) the words from one place on repeat periodically."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        period = 1 + F.floor((n - a) / (3 + g % 8))
        return F.when(n == 0, text).otherwise(let(
            F.struct(a.alias("a"), period.alias("p")),
            lambda at: F.array_join(F.transform(w, lambda x, i: F.when(i < at["a"], x).otherwise(
                F.get(w, (at["a"] + (i - at["a"]) % at["p"]).cast("int")))), " ")))

    return F.when(h % 10 == 0, let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), repeated)).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text of ``documents`` (with the contract's periodic endings), the strongest run and digests."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    found = periodic_runs(docs.select("doc_id", _planted(F.col("text"), F.col("doc_id")).alias("text")))

    def stronger(a: Column, r: Column) -> Column:
        # runs come by start, then period: a later one has to be strictly stronger
        return F.when(a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a)

    best = F.aggregate("runs", F.lit(None).cast(RUN), stronger)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in RUN.fieldNames()]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"), "n_words").select(
        "doc_id", "n_runs", "b.start", "b.length", "b.period",
        F.expr("(1000 * b.length) div b.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256", "n_words")
