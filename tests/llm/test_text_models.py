"""License rules, quality, language and benchmark leaks."""

import random
import re

import numpy as np

from pyspark.sql import functions as F

from tickspark.llm import decontam as D
from tickspark.llm import langid as L
from tickspark.llm import licenses as C
from tickspark.llm import quality as Q
from tickspark.llm.common import crc_mod

SF01 = "/root/testdata/sf0.01"
UPPER = str.maketrans(C.UPPER, C.LOWER)


def _scan(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r for r in C.scan_licenses(df).collect()}


def _base(text):
    words = re.findall(C.WORD, (text or "").translate(UPPER))
    hits = [(i, label) for phrase, label in C.BASE for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]
    return (len(words), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None),
            ",".join(sorted({label for _, label in hits})))


def test_base_phrases_match_brute_force(spark, documents):
    texts = [r.text for r in documents.collect()] + [
        "UNDER the MIT-License, under the mit license under the mit license!", "xunder the mit license", "cc by nc cc by nc",
        "apache license version 2x apache license, version 2.0", "CC-BY-NC 4.0 cc\nby\tnc", "İ under the mıt license", "x" * 50_000]
    for i, r in _scan(spark, texts).items():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == _base(texts[i]), texts[i][:60]


def test_contained_detections_are_suppressed(spark):
    got = _scan(spark, [
        "Licensed under the GNU Lesser General Public License version 3.0.",        # not also gpl-3
        "released under the Apache License, Version 2.0 and the MIT license",
        "SPDX-License-Identifier: BSD-3-Clause here, SPDX-License-Identifier: ISC license there",
        "this is general and public, open and common, with a font", "All rights reserved.",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0"])
    assert [got[i].labels for i in range(6)] == ["lgpl-3", "apache-2,mit", "bsd-3,isc", "", "proprietary", "cc-by-nc-sa"]
    assert got[3].score == 0 and 0 < got[0].score < 1
    assert got[1].n_base == 1 and got[1].base_labels == "apache-2"


def test_sql_has_the_same_gate(spark):
    import duckdb
    import pandas as pd

    texts = ["Licensed under the GPLv3", "FreeBSD license", "AGPLv3 and MIT license", "lgplv3 gpl2", "plain words", ""]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})   # noqa: F841 - read by the SQL
    want = {r[0]: (r[1], r[2]) for r in duckdb.sql(f"SELECT doc_id, labels, score FROM ({C.scan_sql()})").fetchall()}
    assert {i: (r.labels, r.score) for i, r in _scan(spark, texts).items()} == want
    assert want[0][0] == "gpl-3" and want[1][0] == "bsd-2"


def test_every_rule_finds_its_own_names(spark):
    """A text written after each family's plainest name has that family's label."""
    plain = lambda p: re.sub(r"\[(.).*?\]", r"\1", re.sub(r" \?", " ", re.sub(r"\(\?:([^|()]*)(?:\|[^()]*)?\)\??", r"\1", p))).strip()
    names = [(label, plain(plain(n))) for label, _, n in C.FAMILIES]
    names = [(label, n) for label, n in names if not re.search(r"[()?|\[\]]", n)]
    assert len(names) > 60 and len(C.rules()) > 400
    got = _scan(spark, [f"licensed under {n}" for _, n in names])
    for i, (label, n) in enumerate(names):
        assert label in got[i].labels.split(","), (label, n, got[i].labels)


def _written(pattern):
    """Every text a family's names stand for (they have no repetition but '?')."""
    from re import _parser

    def texts(parsed):
        out = [""]
        for op, value in parsed:
            kind = str(op)
            if kind == "LITERAL":
                some = [chr(value)]
            elif kind == "IN":
                some = [chr(c) for o, v in value for c in ([v] if str(o) == "LITERAL" else range(v[0], v[1] + 1))]
            elif kind == "SUBPATTERN":
                some = texts(value[3])
            elif kind == "BRANCH":
                some = [t for part in value[1] for t in texts(part)]
            else:
                assert kind == "MAX_REPEAT" and value[:2] == (0, 1)
                some = ["", *texts(value[2])]
            out = [a + b for a in out for b in some]
        return out

    return texts(_parser.parse(pattern))


def _ungated(text):
    """(labels, score) with every rule applied to every text."""
    line = " " + "  ".join(re.findall(C.WORD, text.translate(UPPER))) + " "
    words = lambda part: part.count(" ") // 2
    found = [(words(line[:m.start()]), words(line[:m.end()]) - 1, p, rule, label, base)
             for rule, p, label, _, pattern, base in C.rules() for m in re.finditer(pattern, line)]
    inside = lambda x, y: y[2] >= x[2] and y[0] <= x[0] and x[1] <= y[1] and (
        y[:2] != x[:2] or (-y[2], y[3]) < (-x[2], x[3]))
    kept = [x for x in found if x[5] or not any(inside(x, y) for y in found)]
    return ",".join(sorted({x[4] for x in kept})), 1 - 0.5 ** len(kept)


def test_gate_opens_for_all_that_rules_match(spark):
    texts = [form.format(name) for _, _, names in C.FAMILIES for name in _written(names)
             for form in ("{}", "Licensed under the {}.")]
    texts += ["Licensed under the GPLv3", "GPLv2 or the GPL, version 3; GPL", "AGPLv3 and AGPL", "FreeBSD license, BSD license",
              "gplv33 agplv xfreebsd", "LGPLv3"]
    assert len(texts) > 800
    got = _scan(spark, texts)
    assert got[texts.index("Licensed under the GPLv3")].labels == "gpl-3"
    for i, text in enumerate(texts):
        assert (got[i].labels, got[i].score) == _ungated(text), text


def test_odd_documents_have_defined_licenses(odd_docs, no_docs):
    rows = C.scan_licenses(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.n_base == 0 and r.first_word is None and r.labels == "" for r in rows)
    assert C.scan_licenses(no_docs).count() == 0


def test_license_scan_is_native(spark):
    plan = C.op2_license_scan(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_quality_separates_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = Q.score_quality(docs, labels).where("held_out").join(labels, "doc_id").collect()
    score, good = np.array([r.score for r in got]), np.array([r.quality for r in got])
    rank = np.argsort(np.argsort(score))
    auc = (rank[good == 1].mean() - (good.sum() - 1) / 2) / (good == 0).sum()
    assert len(got) > 500 and auc > 0.98
    assert ((score >= Q.KEEP_AT) == (good == 1)).mean() > 0.95
    assert ((score >= 0) & (score <= 1)).all()


def test_quality_ignores_labels_of_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(crc_mod("doc_id", 5) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, r.score) for r in Q.score_quality(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_odd_documents_have_defined_quality(spark, odd_docs, no_docs, documents):
    labels = spark.createDataFrame([(5, 1), (6, 1), (6, 0), (4, 0), (None, 1), (9, None)], "doc_id long, quality int")
    rows = Q.score_quality(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    none = Q.score_quality(odd_docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert Q.score_quality(no_docs, labels).count() == 0


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = L.op5_language_id(spark, SF01).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 200 and np.mean([r.lang_pred == r.lang for r in got]) > 0.97


def test_language_vectors_follow_the_definition():
    """bind, permute and bundle by hand for one short text."""
    letters = L.Letters(256, 3)
    got = L.text_vectors(["Ab,  c", "", "漢字漢"], letters)
    a, b, c, blank = (letters[ord(x)] for x in "abc") .__iter__().__next__(), letters[ord("b")], letters[ord("c")], letters[0]
    a = letters[ord("a")]
    bind = lambda x, y, z: np.roll(x, 2) * np.roll(y, 1) * z
    want = bind(blank, a, b) + bind(a, b, blank) + bind(blank, c, blank)
    assert np.allclose(got[0], want / np.linalg.norm(want), atol=1e-6)
    assert not got[1].any() and got[2].any()


def test_odd_documents_have_defined_languages(spark, odd_docs, no_docs):
    prototypes = L.learn_prototypes(L.training_rows(odd_docs))
    rows = L.predict_language(odd_docs, prototypes, lang_into="p", score_into="q").collect()
    by_text = {r.text: (r.p, r.q) for r in rows}
    assert by_text[None] == by_text[""] == by_text["... --- !!!"] == ("und", 0.0) and by_text["x"][0] in prototypes
    assert len(rows) == odd_docs.count() and all(0 <= r.q <= 1 for r in rows)
    assert L.learn_prototypes(no_docs) == {}
    assert {r.p for r in L.predict_language(odd_docs, {}, lang_into="p", score_into="q").collect()} == {"und"}
    kept = L.language_stage(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns
    assert None not in {r.text for r in kept.collect()} and L.language_stage(spark, no_docs, "").count() == 0


def _sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) for _ in range(n))


def test_leaks_found_and_clean_documents_left_alone(spark):
    rng = random.Random(4)
    items = [(i, _sentence(rng, rng.choice([9, 14, 20, 33, 60, 100, 150])) + ".") for i in range(60)]
    docs, want = [], set()
    for d in range(300):
        words = _sentence(rng, rng.randint(0, 400)).split()
        if d % 5 == 0:
            item, text = rng.choice(items)
            passage = text[:-1].split()
            if d % 10 == 0:  # a paraphrase: words dropped, replaced and put in
                for _ in range(max(1, len(passage) // 10)):
                    passage[rng.randrange(len(passage))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = passage
            want.add((d, item))
        elif d % 5 == 1:  # a short common phrase only
            words[0:0] = rng.choice(items)[1].split()[:6]
        docs.append((d, " ".join(words)))
    docs_df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    codes = D.coded(docs_df, "text", ["doc_id"])
    rows = D.find_leaks(codes, bench, D.fit_latent(codes, bench)).collect()
    found = {(r.doc_id, r.item_id) for r in rows}
    assert found == want
    assert all(r.share >= D.PARAPHRASE and r.kind in ("copy", "paraphrase") for r in rows)


def test_latent_terms_come_from_all_passages(spark):
    """More passages than a sample would hold: mean and spread are those of every passage, and rows are of any size."""
    rng = np.random.default_rng(5)
    words = (rng.zipf(1.3, (24_000, D.PASSAGE)) * 2654435761 % (1 << 32)).astype(np.uint32)
    # two passages to a text, some texts end in a short passage
    texts = [(words[i: i + 2].tobytes() + words[i, : i % 5].tobytes(),) for i in range(0, len(words), 2)]
    codes = spark.createDataFrame([*texts, (b"",), (None,)], "__codes binary").repartition(5)
    df, passages = D.passage_statistics(codes)
    ends = [words[i, : i % 5] for i in range(0, len(words), 2) if i % 5]
    assert passages == len(words) + len(ends)
    want = np.bincount(np.concatenate([np.unique(w & np.uint32(D.TERMS - 1)) for w in [*words, *ends]]), minlength=D.TERMS)
    assert (df == want).all()
    bench = spark.createDataFrame([("one two three four five six seven eight nine",)], "text string")
    table = D.fit_latent(codes, bench)
    y = table.astype(float)[words & np.uint32(D.TERMS - 1)].sum(axis=1)
    assert abs(y.mean(axis=0)).max() < 1e-3
    spread = np.cov(y.T, bias=True)
    assert abs(spread - np.diag(np.diag(spread))).max() < 1e-3


def test_sums_of_passages():
    rng = np.random.default_rng(6)
    sizes = np.append(rng.integers(1, D.PASSAGE + 1, 1500), 5000)  # and a long item
    terms = rng.integers(0, 50, int(sizes.sum())).astype(np.uint32)
    table = np.concatenate([rng.integers(0, 9, (50, 3)), np.zeros((1, 3), int)]).astype(np.float32)
    want = np.add.reduceat(table[terms], np.cumsum(sizes) - sizes, axis=0)
    assert (D._sums(table, terms, sizes) == want).all()


def test_sums_of_groups_of_any_size():
    rng = np.random.default_rng(8)
    sizes = np.array([0, 1, D.PASSAGE, D.PASSAGE + 1, 0, 3 * D.PASSAGE ** 2 + 5, 7, 0])
    table = rng.integers(0, 9, (50, 3)).astype(np.float32)
    at = rng.integers(0, 50, int(sizes.sum())).astype(np.uint32)
    want = [table[part].sum(axis=0) for part in np.split(at, np.cumsum(sizes)[:-1])]
    assert (D._long_sums(table, at, sizes) == np.array(want)).all()
    assert (D._long_sums(table, at[:0], np.zeros(4, int)) == 0).all()


def test_cells_count_the_terms_of_each_passage():
    terms = np.array([5, 5, 1, 5, 1, 9, 9, 9], np.uint32)
    term, row, count = D._cells(*D._words(terms, np.array([3, 1, 4])))
    assert sorted(zip(row.tolist(), term.tolist(), count.tolist())) == [(0, 1, 1), (0, 5, 2), (1, 5, 1), (2, 1, 1), (2, 9, 3)]


def test_shares_of_the_fit_follow_the_passages_not_the_files(spark, monkeypatch):
    """Many small files once gave one share of the whole basis for every four, all of them on disk."""
    assert D.fit_tasks(0, 1, 8) == 1
    assert D.fit_tasks(270_000, 1, 6) == 10
    assert D.fit_tasks(1_400_000, 1, 6) == 12  # two a core
    assert D.fit_tasks(80_000_000, 1, 6) == 76
    used = []
    real = D.latent_terms
    monkeypatch.setattr(D, "latent_terms", lambda rows, idf: used.append(rows.rdd.getNumPartitions()) or real(rows, idf))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        rows = [(i, " ".join(f"w{(i * 7 + j) % 90}" for j in range(100))) for i in range(600)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(120)
        bench = spark.createDataFrame([(1, " ".join(f"w{j}" for j in range(20)))], "item_id long, text string").coalesce(1)
        codes = D.coded(docs, "text", ["doc_id"])
        assert codes.rdd.getNumPartitions() >= 100
        D.fit_latent(codes, bench)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert used[0] <= 4


def test_candidates_keep_every_leak_and_drop_what_cannot_be_one():
    """Windows that share too few terms with a passage are no candidates: their common subsequence cannot count."""
    rng = np.random.default_rng(9)
    passage = rng.integers(0, 1 << 32, 32, dtype=np.uint32)
    other = rng.integers(0, 1 << 32, 32, dtype=np.uint32)
    half = passage.copy()
    half[::2] = other[::2]
    table = np.tile(rng.standard_normal(8), (D.TERMS, 1)).astype(np.float32)  # every window resembles every passage
    search = D.Search([(1, 32, passage, other[:0])], table)
    docs = [np.concatenate([x, other]) for x in (passage, half, other)] + [passage[:0]]
    found = {d for block in search.candidates(docs, D.COSINE) for d in block[0].tolist()}
    assert found == {0, 1}
    assert {d: v[1][2] for d, v in search.leaks(docs).items()} == {0: "copy"}


def test_candidate_recall_against_brute_force(spark):
    """Windows whose longest common subsequence with a passage says leak are candidates, in at least 0.9 of cases."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    bench = spark.read.parquet(f"{SF01}/benchmark.parquet")
    codes = D.coded(docs, "text", ["doc_id"])
    got = {(r.doc_id, r.item_id) for r in D.find_leaks(codes, bench, D.fit_latent(codes, bench)).collect()}
    items = D.benchmark_passages([(r.item_id, r.text, None) for r in bench.collect()])
    want = set()
    for r in docs.collect():
        words = D.short_codes([r.text or ""])[0]
        for item, _, passage, _ in items:
            if len(np.intersect1d(words, passage)) < 0.7 * len(np.unique(passage)):
                continue  # too few common words anywhere in the text
            n, pattern = len(passage), D.Pattern(passage)
            if any(pattern.common(words[s: s + n + n // 4].tolist()) >= D.COPY * n for s in range(0, max(1, len(words)), max(1, n // 8))):
                want.add((r.doc_id, item))
    assert want and len(want & got) >= 0.9 * len(want)
    assert len(got - want) <= 0.1 * len(want)


def test_runs_and_paraphrases_of_long_items_are_leaks(spark):
    """A quote of a long item is judged by its own length; the answer may stand anywhere in the document."""
    rng = random.Random(11)
    vocabulary = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "bdfgklmnprst"]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: some(n) + ["."] + some(8) for i, n in enumerate((120, 120, 300, 300, 400, 400))}
    say = lambda words: " ".join(words)
    half = lambda words: [w if i % 5 < 3 else rng.choice(vocabulary) for i, w in enumerate(words)]
    docs, want = [(100 + i, say(some(150))) for i in range(60)], set()
    for i, words in items.items():
        quote = 24 if i % 2 else 5
        docs.append((i, say(some(90) + words[quote: quote + 80] + some(90))))       # 80 words of the item
        docs.append((10 + i, say(some(60) + words[-8:] + some(200) + half(words[:112]) + some(60))))  # the answer far off
        docs.append((20 + i, say(some(60) + half(words[:112]) + some(200))))         # no answer
        want |= {(i, i, "copy"), (10 + i, i, "paraphrase")}
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(i, say(w)) for i, w in items.items()], "item_id long, text string")
    codes = D.coded(docs, "text", ["doc_id"])
    rows = D.find_leaks(codes, bench, D.fit_latent(codes, bench)).collect()
    assert {(r.doc_id, r.item_id, r.kind) for r in rows} == want


def test_parts_of_long_items_hold_every_run():
    words = [f"w{i}" for i in range(333)]
    codes = D.short_codes([" ".join(words)])[0]
    parts = [p.tolist() for _, width, p, _ in D.benchmark_passages([(1, " ".join(words), None)]) if width == D.PART and len(p) == D.PART]
    size = D.PART - D.PART_STEP + 1
    assert size >= D.COPY * D.PART
    for lo in range(len(codes) - size + 1):
        run = codes[lo: lo + size].tolist()
        assert any(run == p[i: i + size] for p in parts for i in range(D.PART - size + 1))
    short = D.benchmark_passages([(1, " ".join(words[:64]), None)])
    assert len(short) == 1 and len(short[0][2]) == 64


def test_common_subsequence():
    rng = np.random.default_rng(0)
    for _ in range(50):
        a, b = rng.integers(0, 6, rng.integers(1, 70)).astype(np.uint32), rng.integers(0, 6, rng.integers(0, 90)).astype(np.uint32)
        t = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                t[i + 1, j + 1] = t[i, j] + 1 if a[i] == b[j] else max(t[i, j + 1], t[i + 1, j])
        assert D.Pattern(a).common(b.tolist()) == t[-1, -1]


def test_odd_documents_and_empty_benchmarks(spark, odd_docs, no_docs):
    text = "one two three four five six seven eight nine ten eleven"
    bench = spark.createDataFrame([(1, text, "x"), (2, None, "x"), (3, "too short", "x"), (None, text, "x")],
                                  "item_id long, text string, share string")
    docs = odd_docs.unionByName(odd_docs.where("doc_id = 9").withColumn("text", F.lit(f"so {text} it is")))
    codes = D.coded(docs, "text", ["doc_id"])
    rows = D.find_leaks(codes, bench, D.fit_latent(codes, bench)).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(9, 1), (9, None)}
    none = bench.where("false")
    assert D.find_leaks(codes, none, D.fit_latent(codes, none)).count() == 0
    empty = D.coded(no_docs, "text", ["doc_id"])
    assert D.find_leaks(empty, bench, D.fit_latent(empty, bench)).count() == 0
