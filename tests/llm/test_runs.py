"""Periodic runs against the definition, digests of the query, odd inputs."""

import hashlib
import random
import re
import zlib

import pytest

from tickspark.llm import runs as R

SF001 = "/root/testdata/sf0.001"


def _runs(words, shortest=24, exponent=3):
    """Every maximal stretch with words q apart equal, whose smallest period is q."""
    n, found = len(words), {}
    for q in range(1, int(n / exponent) + 1):
        start = 0
        for j in range(q, n + 1):
            if j == n or words[j] != words[j - q]:
                length = j - start
                if length >= max(shortest, exponent * q) and (start, length) not in found:
                    found[start, length] = q
                start = j - q + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def _random_words(rng, n):
    """Words with many repetitions: random letters, and pieces repeated whole and in part."""
    out = []
    while len(out) < n:
        kind = rng.random()
        if kind < 0.3:
            out += [rng.randrange(rng.choice([2, 5, 50])) for _ in range(rng.randint(1, 12))]
        else:
            piece = [rng.randrange(rng.choice([1, 2, 9])) for _ in range(rng.randint(1, 14))]
            out += (piece * 9)[: rng.randint(1, 8) * len(piece) + rng.randrange(len(piece))]
        if out and kind > 0.9:
            back = rng.randint(1, len(out))
            out += out[-back:] * rng.randint(1, 3)
    return out[:n]


@pytest.mark.parametrize("shortest, exponent", [(24, 3), (6, 3), (2, 2), (9, 2.5)])
def test_runs_match_the_definition(shortest, exponent):
    rng = random.Random(shortest)
    for _ in range(120):
        words = _random_words(rng, rng.randint(0, 220))
        assert R.runs_of(words, shortest, exponent) == _runs(words, shortest, exponent), words


def test_fibonacci_and_uniform_words():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    assert R.runs_of(b, 2, 2) == _runs(b, 2, 2)
    assert R.runs_of([7] * 5000) == [(0, 5000, 1)]
    assert R.runs_of(list(range(300)) * 3 + [5]) == [(0, 900, 300)]


def _planted(text, doc_id):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if doc_id is None:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def _expected(text, doc_id):
    words = _planted(text, doc_id)
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = _runs([number[w] for w in words])
    kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + length for s, length, q in runs)]
    best = None
    for s, length, q in runs:
        if best is None or length * best[2] > best[1] * q:
            best = (s, length, q)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(kept)))


def _got(r):
    return r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256


def test_query_on_the_whole_table(spark, documents):
    rows = {r.doc_id: r for r in R.op11_periodic_runs(spark, SF001).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert rows.keys() == texts.keys()
    for i, text in texts.items():
        if len((text or "").split()) <= 2500:       # the definition is quadratic
            assert _got(rows[i]) == _expected(text, i), i
    assert sum(r.n_runs > 0 for r in rows.values()) > 5


def test_query_on_repeating_texts(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, rng.choice([" ", "\n", " \t "]).join(f"w{w}" for w in _random_words(rng, rng.randint(0, 150))), i) for i in range(300)]
    rows += [(5, rows[5][1], 5), (None, "x " * 40, 0), (1000, None, 0), (1001, "", 0), (1002, " \n\x0b ", 0),
             (1003, "  a b " * 30, 0), (1004, "é 🙂\x00 " * 30, 0)]
    spark.createDataFrame(rows, "doc_id long, text string, n_runs int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((repr(r.doc_id), _got(r)) for r in R.op11_periodic_runs(spark, str(tmp_path)).collect())
    assert got == sorted((repr(i), _expected(t, i)) for i, t, _ in rows)


def test_stretches_do_not_cross_texts(spark):
    texts = ["a b c d " * 3, "a b c d " * 3, "a b c d " * 6, "x", "a b c d " * 5 + "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in R.periodic_runs(df).collect()}
    assert [got[i][0] for i in range(5)] == [[], [], [(0, 24, 4)], [], []]
    assert got[2][1] == "a b c d" and got[0][1] == "a b c d a b c d a b c d"


def test_long_periodic_text_is_linear(spark):
    piece = " ".join(f"word{i}" for i in range(5000))
    df = spark.createDataFrame([(1, f"{piece} " * 12, 2)], "doc_id long, text string, runs int")
    r = R.periodic_runs(df).first()
    assert [tuple(x) for x in r.runs] == [(0, 60_000, 5000)] and r.collapsed == piece and r.n_words == 60_000


def test_odd_rows_pass_through(spark, odd_docs, no_docs):
    out = R.periodic_runs(odd_docs)
    assert out.count() == odd_docs.count() and {"doc_id", "score", "runs", "collapsed", "n_words"} <= set(out.columns)
    assert R.periodic_runs(no_docs).count() == 0
    dotted = spark.createDataFrame([("a " * 30, 1)], "`my.text` string, `n.x` int")
    assert R.periodic_runs(dotted, "my.text").first().collapsed == "a"
    with pytest.raises(ValueError):
        R.periodic_runs(odd_docs, exponent=1.5)
