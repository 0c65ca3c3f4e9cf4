"""Near-duplicate classes and repeated passages against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from tickspark.llm import minhash as M
from tickspark.llm import substring as S
from tickspark.llm.common import gram_codes, word_codes
from tickspark.llm.components import components


def _classes(docs):
    """doc_id -> smallest id of its component of texts with Jaccard >= 0.8 on 5-word shingles."""
    sets, by_text = {}, {}
    for d, t in docs:
        w = re.findall(r"\w+", (t or "").lower())
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = collections.defaultdict(list)
    for d, s in sets.items():
        for g in s:
            inverted[g].append(d)
    for d, s in sets.items():
        for e, n in collections.Counter(e for g in s for e in inverted[g] if e > d).items():
            if n >= 0.8 * (len(s) + len(sets[e]) - n) - 1e-9:
                a, b = sorted((find(d), find(e)))
                parent[b] = a
    return {d: find(d) for d in sets}


def _families(seed=5, families=4, members=60, words=150):
    """Families of near copies whose pairs straddle the threshold, and texts of their own."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    docs, d = [], 0
    for _ in range(families):
        base = [word() for _ in range(words)]
        for _ in range(members):
            copy = list(base)
            for _ in range(rng.randint(0, 9)):
                copy[rng.randrange(words)] = word()
            docs.append((d, " ".join(copy)))
            d += 1
    docs += [(d + i, " ".join(word() for _ in range(rng.randint(1, 40)))) for i in range(30)]
    rng.shuffle(docs)
    return docs


def test_classes_match_brute_force(spark):
    docs = _families()
    got = {r.doc_id: r.class_id for r in M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == _classes(docs)


def test_classes_in_small_tiles_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(M, "TILE", 8)
    docs = _families(seed=6, families=2)
    got = {r.doc_id: r.class_id for r in M.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == _classes(docs)


def test_bands_that_agree_by_chance_hide_no_pair(spark):
    """Signatures are cut to a byte per coordinate: band 0 agrees there, but the common bucket is that of band 1."""
    sig = bytes(range(M.COORDINATES))
    keys = lambda u: [1000 + u, 7, *range(100 * u, 100 * u + M.BANDS - 2)]
    sketches = spark.createDataFrame([(u, keys(u), sig) for u in (1, 2, 3)], "u long, bands array<long>, sig binary")
    buckets = spark.createDataFrame([(7, 1, u, u) for u in (1, 2, 3)], "key long, band int, u long, root long")
    texts = spark.createDataFrame([(u, " ".join(f"w{i}" for i in range(60)) + f" end{u}") for u in (1, 2, 3)], "u long, text string")
    links = M._rest(buckets, sketches, texts, M.WORDS, M.THRESHOLD, M.COORDINATES, M.BANDS, M.AGREE)
    # two tiles: the others among themselves, and with the bucket's body
    assert sorted(tuple(sorted(r)) for r in links.collect()) == [(1, 2), (1, 3), (2, 3)]


def test_classes_of_the_test_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert {r.doc_id: r.class_id for r in M.near_duplicates(documents).collect()} == _classes(rows)


def test_odd_documents_have_defined_classes(odd_docs, no_docs):
    rows = M.near_duplicates(odd_docs).collect()
    got = collections.Counter((r.doc_id, r.class_id) for r in rows)
    assert got == collections.Counter([(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (6, 6), (7, 6), (8, 8), (9, 9)])
    assert M.near_duplicates(no_docs).count() == 0
    kept = M.near_duplicate_stage(odd_docs.sparkSession, odd_docs, "").collect()
    assert sorted((r.doc_id or -1) for r in kept) == [-1, -1, 1, 2, 3, 4, 5, 6, 8, 9]
    assert M.near_duplicate_stage(odd_docs.sparkSession, odd_docs, "").columns == odd_docs.columns


def test_every_document_has_one_row_whatever_counts_as_a_word(spark):
    """Joiners, variation selectors and combining marks are words to Java alone, number signs to Python alone."""
    texts = ["\u2764\ufe0f", "\U0001f468\u200d\U0001f469", "\u0301", "\u203f", "\u00bd", "x\u00b2", "\u00b2", "\u24d0", "", None, "a b"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r) for r in M.near_duplicates(docs).collect())
    assert got == [(i, i, i) for i in range(len(texts))]


@pytest.mark.parametrize("weighted", [False, True])
def test_darts_estimate_the_weighted_jaccard(weighted):
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    w = rng.integers(1, 9, 400).astype(float) if weighted else np.ones(400)
    v = w.copy()
    v[:100] = 0
    v[100:150] = np.maximum(1, v[100:150] // 2)
    both = np.concatenate([codes, codes[v > 0]])
    weights = np.concatenate([w, v[v > 0]])
    owner = np.repeat([0, 1], [400, int((v > 0).sum())])
    a, b = M.throw_darts(both, weights, owner, 2, 4096)
    want = np.minimum(w, v).sum() / np.maximum(w, v).sum()
    assert abs((a == b).mean() - want) < 4 * np.sqrt(want * (1 - want) / 4096)


def test_darts_of_tiny_and_fractional_weights_are_complete():
    sig = M.throw_darts(np.array([1, 2, 3], np.uint64), np.array([0.01, 0.3, 2.5]), np.array([0, 1, 2]), 4, 64)
    assert (sig[:3] != 0).all() and (sig[3] == 0).all()


def test_word_codes_follow_the_regular_expression():
    texts = ["Ab ab, AB_1 été ÉTÉ x²y 漢字 kana かな\u0301 ª×÷ \x85z\xa0q", "", "--", "ab", "İstanbul Straße STRASSE", "end_"]
    words = [re.findall(r"\w+", t.lower()) for t in texts]
    codes, per_text = word_codes(texts)
    assert per_text.tolist() == [len(w) for w in words]
    seen = {}
    for w, c in zip([w for ws in words for w in ws], codes.tolist()):
        assert seen.setdefault(w, c) == c
    assert len(set(seen.values())) == len(seen)


def test_gram_codes_depend_on_order_and_length():
    c, per_text = word_codes(["a b c d e f a b c d e"])
    assert per_text.tolist() == [11]
    g = gram_codes(c, 5)
    assert len(g) == 7 and g[0] == g[6] and len(set(g.tolist())) == 6
    assert len(gram_codes(c, 12)) == 0 and len(gram_codes(c, 11)) == 1


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- repeated passages ----

def _passages(docs, window=50):
    first, words = {}, {}
    for d, t in docs:
        words[d] = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    for d in sorted(words):
        for p in range(len(words[d]) - window + 1):
            first.setdefault(tuple(words[d][p:p + window]), d)
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < d:
                gone[p:p + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def _digest(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    rows, changed = S.repeated_passages(df)
    kept = {(r.doc_id, r.h1): r for r in changed.collect()}
    out = {}
    for r in rows.collect():
        c = kept.get((r.doc_id, r.h1))
        text = b"" if r.whole else bytes(c.kept) if c else None
        out[r.doc_id] = (r.n_words, r.n_words if r.whole else c.n_removed if c else 0,
                         hashlib.sha256(text).hexdigest() if text is not None else r.sha)
    return out


def _shared_texts(seed):
    """Texts that share passages of 45 to 90 words, whole copies, and passages that meet or overlap."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(3))
    pool = [[word() for _ in range(rng.randint(45, 90))] for _ in range(8)]
    docs = []
    for d in range(70):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(pool)
            lo = rng.randint(0, 10)
            parts.append(p[lo: len(p) - rng.randint(0, 8)])
            if rng.random() < 0.6:
                parts.append([word() for _ in range(rng.randint(1, 30))])
        docs.append((d, rng.choice([" ", "\n", "  \t"]).join(w for p in parts for w in p)))
    docs += [(100 + i, docs[rng.randrange(70)][1]) for i in range(8)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_passages_match_brute_force(spark, seed):
    docs = _shared_texts(seed)
    assert _digest(spark, docs) == _passages(docs)


def test_passages_of_the_test_table(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in S.op8_relative_lz(spark, "/root/testdata/sf0.001").collect()}
    assert got == _passages(docs) and sum(v[1] for v in got.values()) > 0


def test_odd_documents_lose_nothing_and_stage_cuts(spark, odd_docs, no_docs):
    rows, changed = S.repeated_passages(odd_docs)
    assert rows.count() == odd_docs.count() and changed.count() == 0 and not any(r.whole for r in rows.collect())
    assert S.repeated_passages(no_docs)[0].count() == 0
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"alpha {passage}", 5, "x"), (2, f"beta {passage} gamma", 5, "y"), (3, passage, 5, "z"),
                                  (None, passage, 5, "n"), (2, "another text of the same id", 5, "y"), (4, None, 5, "e")],
                                 "doc_id long, text string, n_chars long, __kept0 string")
    out = S.substring_stage(spark, docs, "")
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)
    assert out.columns == docs.columns
    assert got == sorted([(1, f"alpha {passage}", 5), (2, "beta gamma", 10), (None, passage, 5),
                          (2, "another text of the same id", 5), (4, None, 5)], key=str)


def test_repeated_rows_that_lose_words(spark, tmp_path):
    a = " ".join(f"w{i}" for i in range(80))
    rows = [(1, a), (2, a + " tail of b"), (2, a + " tail of b"), (3, "head " + a), (3, "another text"), (2, "a third")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in S.op8_relative_lz(spark, str(tmp_path)).collect())
    assert got == [(1, 80, 0), (2, 2, 0), (2, 83, 80), (2, 83, 80), (3, 2, 0), (3, 81, 80)]


def test_factors_follow_one_reference():
    place, ref, there = np.array([3, 4, 5, 6, 20, 70, 71]), np.array([1, 1, 1, 2, 2, 5, 5]), np.array([0, 1, 2, 9, 10, 4, 6])
    start, length, of, at = S.factors(place, ref, there)
    assert start.tolist() == [3, 6, 20, 70, 71] and length.tolist() == [52, 50, 50, 50, 50]
    assert of.tolist() == [1, 2, 2, 5, 5] and at.tolist() == [0, 9, 10, 4, 6]
    assert len(S.factors(*[np.zeros(0, np.int64)] * 3)[0]) == 0


@pytest.mark.parametrize("seed", [4, 5])
def test_factors_are_pieces_of_their_references(spark, seed):
    docs = dict(_shared_texts(seed))
    _, changed = S.repeated_passages(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    words = {d: t.split() for d, t in docs.items()}
    several = 0
    for r in changed.collect():
        covered = set()
        for f in r.factors:
            assert f.ref_id < r.doc_id and f.length >= S.WINDOW
            assert words[r.doc_id][f.start: f.start + f.length] == words[f.ref_id][f.ref_start: f.ref_start + f.length]
            covered |= set(range(f.start, f.start + f.length))
        assert len(covered) == r.n_removed
        several += len({f.ref_id for f in r.factors}) > 1
    assert several
