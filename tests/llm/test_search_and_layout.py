"""Top-k search, packing, sharding, revisits, the pipeline and the registered SQL."""

import collections
import random
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tickspark.llm import packing as P
from tickspark.llm import queries
from tickspark.llm import sharding as H
from tickspark.llm import topk as K
from tickspark.llm import warc as W
from tickspark.llm.wordbpe import WordBpe

SF001 = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels"]


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_equals_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF001)
    want = con.execute(queries.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert collections.Counter(tuple(r[c] for c in names) for r in got.collect()) == collections.Counter(want.fetchall())


def _top(rows, queries_, k):
    out = []
    for q, v in queries_:
        scored = sorted(((-int(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v)))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 64, 10_000])
def test_top_k_matches_brute_force(spark, block):
    rng = np.random.default_rng(block)
    vectors = rng.normal(0, 0.4, (400, 12)).astype(np.float32)
    vectors[100:160] = vectors[99]  # many ties
    vectors[200:210] = 0
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = K.top_k(df, lambda c: c % 20 == 0, 10, block_rows=block, query_rows=6).collect()
    ints = [(i, np.floor(np.array(v, np.float64) * 1024).astype(np.int64)) for i, v in rows]
    assert sorted(tuple(r) for r in got) == _top(ints, [x for x in ints if x[0] % 20 == 0], 10)


def test_top_k_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0], 1.0), (1, [1.0, None], 1.0), (2, None, 1.0), (3, [float("nan"), 0.0], 1.0), (4, [float("inf"), 0.0], 1.0),
            (5, [1.0, 2.0], 1.0), (5, [1.0, 2.0], 1.0), (None, [1.0, 1.0], 1.0), (100, [2.0, 2.0, 2.0], 1.0), (200, [], 1.0),
            (300, [-1.0, -2.0], 1.0), (6, [3e9, 3e9], 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score double")
    got = [tuple(r) for r in K.top_k(df, lambda c: c % 100 == 0, 3).orderBy("query_id", "rank").collect()]
    big = 3 * 10 ** 9 * 1024
    assert got == [(0, 1, 6, big * 3072), (0, 2, 5, 5 * 2 ** 20), (0, 3, 5, 5 * 2 ** 20),
                   (300, 1, 0, -5 * 2 ** 20), (300, 2, 5, -5 * 2 ** 20), (300, 3, 5, -5 * 2 ** 20)]
    assert K.top_k(df.where("false"), lambda c: c % 100 == 0).count() == 0


def test_top_k_of_huge_scores_and_repeated_queries(spark):
    rows = [(0, [1e8, 1.0]), (0, [-1e8, 0.0]), (1, [1e8, 0.0]), (2, [-1e8, 0.0]), (3, [1e300, 1.0]), (4, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r.vec_id, r.score) for r in K.top_k(df, lambda c: c == 0, 9).orderBy("rank").collect()]
    # the least of the two vectors asks: (-1e8, 0); scores beyond a long count as the nearest
    assert got == [(2, 2**63 - 1), (4, 0), (1, -2**63), (3, -2**63)]


def test_special_strings_are_the_tokenizers(spark):
    from tokenizers import Tokenizer
    fresh = Tokenizer.from_file(P.default_tokenizer())
    texts = ["a <|endoftext|> b", "<|ENDOFTEXT|>", "<|startoftext|><|endoftext|>x", "a < |endoftext| > b", "plain text",
             *(r.text or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40).collect())]
    for t, ids in zip(texts, WordBpe(P.default_tokenizer()).encode(texts)):
        assert ids.tolist() == fresh.encode(t, add_special_tokens=False).ids, t[:60]


ODD_TEXTS = ["Hello's WORLD  it'll 123 naïve ÀÉÎ ÿ ß café’s <|endoftext|> 日本 á Σας \x1c x\x7f ª º ×÷ \x85 \xa0 don't'd", "",
             "'S 'T x_y__z ¿qué?", "A\x1cB \x00 c", "it's o'reilly 'stuff ''s ,'s ' 's' we'RE l'llama 1's 1'2", "'", "it'", " 'd",
             "aaaaaaaaaaaaaaaaaaaaaaa hahahahahaha", "\n\n", "é 🙂"]


def test_batch_tokens_equal_the_tokenizer(documents):
    texts = [r.text or "" for r in documents.collect()] + ODD_TEXTS
    bpe = WordBpe(P.default_tokenizer())
    for t, ids in zip(texts, bpe.encode(texts)):
        assert ids.tolist() == bpe.tokenizer.encode(t, add_special_tokens=False).ids, t[:60]
    bpe.forget()
    assert [x.tolist() for x in bpe.encode(texts[:9])] == [x.tolist() for x in bpe.encode(texts[:9])]


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers
    bpe = WordBpe(str(public_tokenizers.path("byte_bpe_50k.json")))
    assert bpe.whole and bpe.encode(["Hello world"])[0].tolist() == bpe.tokenizer.encode("Hello world").ids


def test_packing_round_trip(spark, documents, odd_docs, no_docs):
    bpe = WordBpe(P.default_tokenizer())
    for df in (documents, odd_docs):
        rows = P.pack_documents(df, P.default_tokenizer(), longest=256).collect()
        assert all(r.length & (r.length - 1) == 0 and 1 <= r.length <= 256 and r.offset == 0 for r in rows)
        assert sorted(r.sequence_id for r in rows) == list(range(len(rows)))
        by_id = sorted(rows, key=lambda r: r.sequence_id)
        assert [r.length for r in by_id] == sorted((r.length for r in rows), reverse=True)
        docs = collections.defaultdict(list)
        for r in rows:
            docs[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        want = collections.defaultdict(list)
        for d in df.collect():
            want[d.doc_id].append(bpe.encode([d.text or ""])[0].tolist() + [2])
        for d, lists in want.items():
            total = sum(map(len, lists))
            assert sum(len(i) for _, i, _ in docs[d]) == total
            if len(lists) == 1:
                assert [x for _, i, _ in sorted(docs[d]) for x in i] == lists[0] and {t for *_, t in docs[d]} == {total}
    assert P.pack_documents(no_docs, P.default_tokenizer()).count() == 0


def test_binary_lengths():
    assert P.binary_lengths(10_000) == [4096, 4096, 1024, 512, 256, 16] and P.binary_lengths(1) == [1]
    assert P.binary_lengths(4096) == [4096] and P.binary_lengths(4095) == [2048 >> i for i in range(12)]


def test_shards_are_even_and_whole(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = H.shard_by_kd_tree(docs).collect()
    want = {d.doc_id: (len((d.text or "").encode()) + 1, zlib.crc32((d.text or "").encode())) for d in docs.collect()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == want and len(rows) == len(want)
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(size.values()) / 16
    assert sorted(size) == list(range(16)) and all(abs(v - mean) < 0.01 * mean for v in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {d.doc_id: d.text for d in docs.collect()}
    homes = collections.defaultdict(set)
    for r in rows:
        homes[texts[r.doc_id]].add(r.shard)
    weight = collections.Counter()
    for r in rows:
        weight[texts[r.doc_id]] += r.size
    small = [t for t in homes if weight[t] <= mean * H.PIECE_SHARE]
    assert len(small) > 9000 and all(len(homes[t]) == 1 for t in small)


def test_a_hot_group_is_split_and_odd_documents_placed(spark, odd_docs, no_docs):
    rows = [(i, "the very same text of a hot group", "en", "s") for i in range(3000)]
    rows += [(10_000 + i, "x" * (i % 50), "en" if i % 2 else "de", f"s{i % 7}") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    size = collections.Counter()
    for r in H.shard_by_kd_tree(df).collect():
        size[r.shard] += r.size
    mean = sum(size.values()) / 16
    assert len(size) == 16 and all(abs(v - mean) < 0.03 * mean for v in size.values())
    odd = H.shard_by_kd_tree(odd_docs, 4).collect()
    assert len(odd) == odd_docs.count() and min(r.size for r in odd) == 1
    assert H.shard_by_kd_tree(no_docs).count() == 0
    assert H.shards_for(1000, 100) == 16 and H.shards_for(10, 100) == 1
    with pytest.raises(ValueError):
        H.shard_by_kd_tree(odd_docs, 6)


def _resolve(records):
    """By hand: the latest strictly earlier full response of the same URL."""
    out = {}
    for rid, url, ts, status, _, _ in records:
        if status != 304:
            continue
        best = [r for r in records if r[3] == 200 and r[1] == url and r[2] is not None and ts is not None and r[2] < ts]
        out[rid] = max(best, key=lambda r: (r[2], r[0]))[0] if best else None
    return out


def test_revisits_match_brute_force_over_many_partitions(spark):
    rng = random.Random(2)
    records = []
    for i in range(1500):
        url = "http://hot.example/a" if rng.random() < 0.4 else f"http://e.example/{rng.randrange(60)}"
        records.append((i, url, rng.randrange(400), 200 if rng.random() < 0.15 else 304, {"ETag": '"x"'}, "d"))
    df = spark.createDataFrame(records, "record_id long, url string, ts long, status int, headers map<string,string>, digest string")
    got = {r.record_id: r.response_id for r in W.resolve_revisits(df.repartition(11)).collect()}
    assert got == _resolve(records)


def test_validators_headers_and_odd_records(spark):
    schema = "record_id long, url string, ts long, status int, headers map<string,string>, digest string, part string"
    full = {"ETag": '"a"', "Content-Type": "text/html", "Content-Length": "9", "Connection": "close", "X-Old": "1", "Date": "d1"}
    rows = [
        (1, "HTTPS://www.Site.example:443/p/?utm_source=z&b=2&a=1#f", 10, 200, full, "d1", "x"),
        (2, "http://site.example/p?a=1&b=2", 20, 304, {"etag": 'W/"a"', "DATE": "d2", "Content-Length": "0", "TE": "x"}, None, "x"),
        (3, "http://site.example/p?a=1&b=2", 20, 304, {"etag": '"b"'}, "d1", "x"),
        (4, "http://site.example/p?a=1&b=2", 20, 304, None, "d1", "x"), (5, "http://site.example/p?a=1&b=2", 20, 304, {}, None, "x"),
        (6, "http://site.example/p?a=1&b=2", 10, 304, {}, "d1", "x"), (7, None, 30, 304, {}, "d1", "x"),
        (8, "http://site.example/p?a=1&b=2", None, 304, {}, "d1", "x"), (9, "http://site.example/other", 50, 304, {}, "d1", "x"),
        (10, "http://site.example/p?a=1&b=2", 15, 404, {}, "d9", "x"), (2, "http://site.example/p?a=1&b=2", 20, 304, {"etag": 'W/"a"'}, None, "x"),
        (None, "http://site.example/p?b=2&a=1", 21, 304, {"ETag": '"a"'}, None, "x")]
    got = collections.defaultdict(list)
    df = spark.createDataFrame(rows, schema)
    for r in W.resolve_revisits(df).collect():
        got[r.record_id].append(r)
    status = {k: [r.status for r in v] for k, v in got.items()}
    assert status == {2: ["resolved"] * 2, 3: ["changed"], 4: ["resolved"], 5: ["unvalidated"], 6: ["orphan"], 7: ["orphan"],
                      8: ["orphan"], 9: ["orphan"], None: ["resolved"]}
    merged = next(r.headers for r in got[2] if "date" in r.headers and r.headers["date"] == "d2")
    assert merged == {"etag": 'W/"a"', "content-type": "text/html", "content-length": "9", "x-old": "1", "date": "d2"}
    assert got[3][0].headers is None and got[3][0].payload_digest is None and got[4][0].payload_digest == "d1"
    assert W.resolve_revisits(df.where("false")).count() == 0


def test_pipeline_stages_keep_their_contract(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "repeated_passages", "benchmark_leaks",
                                                      "packing"]
    from tickspark.llm.common import written
    sizes, now = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = written(stage(spark, now, SF001), f"test-{name}")
        assert now.columns == docs.columns and now.dtypes == docs.dtypes
        sizes.append(now.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.7 * sizes[0]
    # what the stages decide holds of what is left
    from tickspark.llm import decontam, minhash, substring
    left = now
    assert all(r.doc_id == r.class_id for r in minhash.near_duplicates(written(
        minhash.near_duplicate_stage(spark, docs, SF001), "again")).collect())
    rows, changed = substring.repeated_passages(left)
    assert changed.count() == 0 and rows.where("whole").count() == 0
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet")
    codes = decontam.coded(left, "text", ["doc_id"])
    assert decontam.find_leaks(codes, bench, decontam.fit_latent(codes, bench)).count() == 0
    packed = E.queries()["pipeline"](spark, SF001)
    assert packed.select("doc_id").distinct().count() == sizes[-1]


def test_stages_pass_columns_of_any_name(spark, tmp_path):
    """Names with a dot, and names that stages use inside."""
    names = ["__lang_pred", "__lang_score", "__id", "__hash", "__h", "__text", "__codes", "a.b", "u", "h1", "score", "__kept"]
    rows = [(i, f"the words of text number {i} are these and these only", "en", "a", 40, *range(len(names))) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                       + ", ".join(f"`{n}` int" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.columns == docs.columns
        found = out.collect()
        assert found and all(tuple(r)[5:] == tuple(range(len(names))) for r in found)


def test_pipeline_takes_odd_documents(spark, odd_docs, no_docs):
    from tickspark.llm.common import written
    for docs in (odd_docs.select("doc_id", "text", "lang", "source", "n_chars"), no_docs.select("doc_id", "text", "lang", "source", "n_chars")):
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF001), f"odd-{name}")
        assert docs.count() >= 0
