"""Personal data: base spans against the contract's own patterns, the method's spans, odd inputs."""

import hashlib
import re

import pytest

from tickspark.llm import pii as P

RAW = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def _valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and _luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def _base(text):
    spans = [(m.start(), i, kind, m.end()) for i, (kind, p) in enumerate(RAW.items())
             for m in re.finditer(p, text or "") if _valid(kind, m.group())]
    return sorted(spans)


def _rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)


def _digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in spans).encode()).hexdigest()


def _queried(spark, tmp_path, df):
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return P.op13_pii(spark, str(tmp_path)).collect()


EDGES = ["a@b.c.d_e@f.g", "x@y", "a@b..c@d.e", "..@..a@b.c", "a@b.c@d.e.f", "1.2.3.4.5.6.7.8", "256.1.1.1 1.2.3.255", "01.002.0003.4",
         "00000255.1.1.1", "4111111111111111", "4111-1111 1111-1111", "4111  1111 1111 1111", "41111111111111111111",
         "+1 (286) 555-5136", "+1-", "+12", "++1 234 567 8901)", "+1 234 567 890 12345 6", "é🙂4111 1111 1111 1111🙂a@b.cd",
         "+4111 1111 1111 1111", "4111 1111 1111 1111 4111 1111 1111 1111", "a+b@c.d-e.f,g@h.i", "1.1.1.1" * 3, "%@-.-"]


def test_base_spans_match_the_contract(spark, tmp_path, documents):
    texts = [r.text for r in documents.collect()] + EDGES + [None, "", " ".join(EDGES), "\n".join(EDGES) * 200]
    got = {r.doc_id: r for r in _queried(spark, tmp_path, _rows(spark, texts))}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want, r = _base(text), got[i]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for _, _, k, _ in want) for kind in RAW), text
        assert r.base_sha256 == _digest(want), text
        listed = {f"{k}:{s}:{e}" for s, _, k, e in want}
        assert listed <= set(filter(None, r.spans.split(","))), text
        assert len(r.spans.split(",")) == len(r.scores.split(","))


def test_random_texts_match_the_contract(spark):
    import random
    rng = random.Random(5)
    texts = ["".join(rng.choice("01259.+-@ab (é🙂)_%"[: rng.choice([9, 12, 18])]) for _ in range(rng.randint(0, 120)))
             for _ in range(1500)]
    for r in P.find_pii(_rows(spark, texts)).collect():
        got = [(s.start, s.rank, s.kind, s.end) for s in r.spans if s.base]
        assert got == _base(r.text), r.text
        assert all(r.text[s.start:s.end] == s.found for s in r.spans)


def test_the_method_adds_confirmed_spans(spark):
    texts = ["pay to DE89 3704 0044 0532 0130 00, thanks", "GB82WEST12345698765432", "DE89 3704 0044 0532 0130 01",
             "XX89 3704 0044 0532 0130 00", "my SSN: 123-45-6789", "part 123-45-6789", "123-45-6789", "ssn 000-45-6789 or 666-45-6789",
             "4465758382889437 4465758382889437", "4465758382889437 4465758382889438", "card 4111-1111-1111-1111 12 34",
             "order 4111-1111-1111-1111 12 34"]
    got = {r.doc_id: [(s.kind, s.found) for s in r.spans if not s.base] for r in P.find_pii(_rows(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == [
        [("iban", "DE89 3704 0044 0532 0130 00")], [("iban", "GB82WEST12345698765432")], [], [], [("ssn", "123-45-6789")], [], [], [],
        [("card", "4465758382889437")] * 2, [("card", "4465758382889437")], [("card", "4111-1111-1111-1111")], []]


def test_context_moves_the_score(spark):
    texts = ["host 10.0.0.1 is up", "version 10.0.0.1", "at 10.0.0.1", "x" * 60 + " host" + " " * 60 + "10.0.0.1"]
    got = {r.doc_id: r.spans[0].score for r in P.find_pii(_rows(spark, texts)).collect()}
    assert [got[i] for i in range(4)] == [0.8, 0.4, 0.6, 0.6]


def test_odd_rows_pass_through(spark, odd_docs, no_docs):
    found = P.find_pii(odd_docs)
    assert found.count() == odd_docs.count() and set(odd_docs.columns) < set(found.columns)
    assert all(r.spans == [] for r in found.where("text is null or text = ''").collect())
    assert P.find_pii(no_docs).count() == 0
    dotted = spark.createDataFrame([("a@b.cd", 1, 2)], "`my.text` string, found int, `start.x` int")
    assert P.find_pii(dotted, "my.text").first().spans[0].found == "a@b.cd"


@pytest.mark.parametrize("text, n", [("4465758382889437 " * 20_000, 20_000), ("1.2.3.4 " * 30_000, 30_000), ("a" * 300_000, 0),
                                     ("a@b.c " * 30_000, 30_000), ("1" * 200_000, 0), ("AA00 " * 30_000, 0)])
def test_very_long_texts(spark, text, n):
    spans = P.find_pii(_rows(spark, [text])).first().spans
    assert len(spans) == n
    assert all(text[s.start:s.end] == s.found for s in (spans[:3] + spans[-3:]))


def test_runs_in_the_jvm_only(spark, documents):
    plan = P.find_pii(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange|Sort", plan)
