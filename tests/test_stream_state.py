"""Running VaR from keyed state, duplicate removal in the ingest, acknowledged publishing, generation from SQL."""

import importlib
import json
import os
import sys
import time
from concurrent.futures import Future

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle

from tickspark.operators import report as G
from tickspark.operators import risk as R
from tickspark.schemas import SCENARIO_COLUMNS
from tickspark.sources.messages import keyed_messages, parse_messages, read_messages, sample_messages, write_scenario_messages
from tickspark.sources.publisher import FileTopic, publish, publish_stream, read_outcomes
from tickspark.streaming.ingest import ingest_messages, ingested, message_stream
from tickspark.streaming.tail_state import TailProcessor

cloudpickle.register_pickle_by_value(sys.modules[__name__])        # the clients below travel to the workers
Q = 0.05
V = importlib.import_module("tickspark.streaming.running_var")     # the package has a function of this name
I = importlib.import_module("tickspark.streaming.ingest")


def _scen(spark, batch="B1", n=500, mu=0.001, sigma=0.02):
    return R.scenarios(spark, mu, sigma, n, mode="lcg", batch=batch, portfolio="A,B", start_date="2004-02-05 00:00:00.123456",
                       end_date="2024-01-31")


def _rows(df):
    return sorted(tuple(repr(v) for v in r) for r in df.select(*SCENARIO_COLUMNS).collect())


class _Stream:
    """A running VaR over a growing folder of messages."""

    def __init__(self, spark, root, **options):
        self.spark, self.options = spark, options
        self.src, self.store, self.var, self.ckpt = (f"{root}/{n}" for n in ("src", "store", "var", "ckpt"))
        self.sent = []

    def deliver(self, *frames):
        for df in frames:
            write_scenario_messages(df, self.src)
            self.sent.append(df)
        V.stream_var_exact(self.spark, parse_messages(message_stream(self.spark, self.src)), self.store, self.var, self.ckpt,
                           q=Q, **self.options)

    def check(self):
        seen = {}
        for df in self.sent:
            for r in df.collect():
                seen.setdefault(r.BATCH, {})[r.SCENARIO_ID] = r.RETURN
        got = {r.BATCH: (r.n, r.VaR) for r in V.read_var(self.spark, self.var).collect()}
        want = {b: (len(x), pytest.approx(-np.percentile(list(x.values()), 100 * Q), rel=1e-12)) for b, x in seen.items()}
        assert got == want
        assert V.batch_store(self.spark, self.store).count() == sum(map(len, seen.values()))


def test_var_from_state_over_redelivered_and_late_input(spark, tmp_shared, monkeypatch):
    reads = []
    stored = V.batch_store
    monkeypatch.setattr(V, "batch_store", lambda *a: reads.append(a) or stored(*a))
    s = _Stream(spark, tmp_shared, floor=20)
    a, b = _scen(spark, "B1", 3000), _scen(spark, "007", 9000)
    s.deliver(a.where("SCENARIO_ID % 2 = 0"), b.where("SCENARIO_ID < 5000"))
    s.deliver(a.where("SCENARIO_ID % 3 < 2"), b)
    s.deliver(a, b.where("SCENARIO_ID < 100"))
    # every stored read so far is the check's own: the VaR came from the state
    assert not reads
    s.check()


def test_rank_past_the_tail_falls_back_to_the_store(spark, tmp_shared):
    """Later gains are all larger: the wanted rank leaves what was kept of the earlier ones."""
    s = _Stream(spark, tmp_shared, floor=1, slack=1.0)
    low = _scen(spark, "B1", 400, mu=-1.0)
    high = _scen(spark, "B1", 8000, mu=5.0).where("SCENARIO_ID > 400")
    s.deliver(low)
    s.check()
    s.deliver(high)
    s.check()


def test_equal_gains_and_missing_ids(spark, tmp_shared):
    s = _Stream(spark, tmp_shared, floor=5)
    s.deliver(_scen(spark, "same", 6000, sigma=0.0))
    s.check()
    without = sample_messages(spark, 40, batch="no ids")
    without.write.mode("append").text(s.src)
    without.write.mode("append").text(s.src)
    V.stream_var_exact(spark, parse_messages(message_stream(spark, s.src)), s.store, s.var, s.ckpt, q=Q, floor=5)
    got = {r.BATCH: (r.n, r.VaR) for r in V.read_var(spark, s.var).collect()}
    assert got["no ids"] == (40, pytest.approx(-np.percentile(np.arange(40), 100 * Q)))


def test_tail_is_exact_up_to_its_cut():
    rng = np.random.default_rng(4)
    p = TailProcessor(0.1, slack=1.5, floor=3)
    n, cut, xs, cs, everything = 0, None, np.zeros(0), np.zeros(0, np.int64), []
    for _ in range(40):
        x = rng.choice([rng.normal(size=17), rng.integers(-3, 3, 17).astype(float), np.r_[np.full(8, np.nan), np.inf, -np.inf, np.zeros(7)]])
        everything += x.tolist()
        n, cut, xs, cs = p._added(n, cut, xs, cs, x)
        have = sorted(v for v in everything if not np.isnan(v) and (cut is None or v <= cut))
        assert n == len(everything) and np.repeat(xs, cs).tolist() == have
        assert cut is not None or len(have) == n


def test_ingest_stores_once_and_reads_without_a_shuffle(spark, tmp_shared):
    src, table, ckpt = f"{tmp_shared}/src", f"{tmp_shared}/tbl", f"{tmp_shared}/ckpt"
    a = _scen(spark, "B1", 300)
    write_scenario_messages(a, src)
    write_scenario_messages(a.where("SCENARIO_ID % 2 = 0"), src)            # in the same micro-batch
    ingest_messages(spark, table, ckpt, path=src)
    write_scenario_messages(a.where("SCENARIO_ID % 3 = 0"), src)            # in a later one, held by the state
    ingest_messages(spark, table, ckpt, path=src)
    store = ingested(spark, table)
    assert _rows(store) == _rows(a)
    plan = store._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_copies_later_than_the_window_are_stored_once(spark, tmp_shared):
    src, table, ckpt = f"{tmp_shared}/src", f"{tmp_shared}/tbl", f"{tmp_shared}/ckpt"
    a = _scen(spark, "B1", 200).unionByName(_scen(spark, "007", 50))
    none = sample_messages(spark, 20, batch=None)
    for _ in range(3):                                                       # the state forgets at once
        write_scenario_messages(a, src)
        none.write.mode("append").text(src)
        ingest_messages(spark, table, ckpt, path=src, window="0 seconds")
    assert ingested(spark, table).count() == 270
    ingest_messages(spark, table, f"{ckpt}2", path=src)                      # another checkpoint delivers all again
    assert ingested(spark, table).count() == 270
    write_scenario_messages(_scen(spark, "B1", 210), src)                    # ten new ones among copies
    ingest_messages(spark, table, ckpt, path=src, window="0 seconds")
    assert ingested(spark, table).count() == 280


def test_replay_after_the_window_loses_nothing(spark, tmp_shared):
    src, table, ckpt = f"{tmp_shared}/src", f"{tmp_shared}/tbl", f"{tmp_shared}/ckpt"
    write_scenario_messages(_scen(spark, "B1", 100), src)
    ingest_messages(spark, table, ckpt, path=src, window="0 seconds")
    last = max(int(f) for f in os.listdir(f"{ckpt}/commits") if f.isdigit())
    for f in (f"{ckpt}/commits/{last}", f"{ckpt}/commits/.{last}.crc"):
        if os.path.exists(f):
            os.remove(f)
    ingest_messages(spark, table, ckpt, path=src, window="0 seconds")       # the micro-batch runs again
    assert ingested(spark, table).count() == 100


# ---- publishing ---------------------------------------------------------------

def test_every_message_has_an_outcome(spark, tmp_shared):
    topic, outcomes = f"{tmp_shared}/topic", f"{tmp_shared}/outcomes"
    scen = _scen(spark, n=2000).repartition(3)
    run = publish(keyed_messages(scen), lambda: FileTopic(topic), outcomes, chunk=150)
    got = read_outcomes(spark, outcomes, run).collect()
    assert sorted(r.KEY for r in got) == sorted(f"B1/{i}" for i in range(1, 2001))
    assert {r.STATUS for r in got} == {"published"} and len({r.MESSAGE_ID for r in got}) == 2000
    assert _rows(read_messages(spark, topic)) == _rows(scen)
    with open(f"{outcomes}/RUN={run}/_committed.json") as f:
        assert json.load(f) == {"parts": 3, "counts": {"published": 2000}}


class _Awkward:
    """A topic that never answers for some messages and refuses others; it logs what it was sent."""

    def __init__(self, folder):
        self.folder = folder

    def publish(self, messages):
        out = []
        for i, (key, text) in enumerate(messages):
            f = Future()
            number = int(text)
            if number % 10 == 1:
                f.set_exception(RuntimeError("refused"))
            elif number % 10 != 2:
                f.set_result(f"id-{number}")
            out.append(f)
        os.makedirs(self.folder, exist_ok=True)
        with open(f"{self.folder}/{os.getpid()}-{time.time_ns()}", "w") as log:
            log.write("\n".join(k for k, _ in messages))
        return out


def _sent(folder):
    return [k for f in os.listdir(folder) for k in open(f"{folder}/{f}").read().split("\n")]


def test_time_outs_and_errors_are_outcomes(spark, tmp_shared):
    messages = spark.range(60).selectExpr("cast(id as string) as value", "cast(id as string) as key").repartition(2)
    log, outcomes = f"{tmp_shared}/log", f"{tmp_shared}/outcomes"
    publish(messages, lambda: _Awkward(log), outcomes, run="r", timeout=0.05, chunk=7)
    got = {int(r.KEY): (r.STATUS, r.MESSAGE_ID) for r in read_outcomes(spark, outcomes, "r").collect()}
    assert len(got) == 60
    for i, (status, message_id) in got.items():
        assert (status, message_id) == {1: ("failed", None), 2: ("timed out", None)}.get(i % 10, ("published", f"id-{i}"))
    # the run again: only what was not acknowledged is sent
    publish(messages, lambda: _Awkward(log), outcomes, run="r", timeout=0.05, chunk=7)
    again = sorted(map(int, _sent(log)))
    assert sorted(set(again)) == list(range(60)) and len(again) == 60 + 12
    assert read_outcomes(spark, outcomes, "r").count() == 60


def test_equal_texts_without_keys_are_messages_of_their_own(spark, tmp_shared):
    messages = spark.createDataFrame([("same",), ("same",), (None,), ("other",)], "value string").coalesce(1)
    publish(messages, lambda: FileTopic(f"{tmp_shared}/t"), f"{tmp_shared}/o", run="x")
    assert read_outcomes(spark, f"{tmp_shared}/o", "x").count() == 3
    assert sorted(r.value for r in spark.read.text(f"{tmp_shared}/t").collect()) == ["other", "same", "same"]
    publish(messages.where("value = 'nothing'"), lambda: FileTopic(f"{tmp_shared}/t"), f"{tmp_shared}/o", run="none")
    assert read_outcomes(spark, f"{tmp_shared}/o", "none").count() == 0


def test_refused_messages_do_not_reach_the_topic(spark, tmp_shared):
    messages = spark.createDataFrame([("short",), ("x" * 50,)], "value string").coalesce(1)
    publish(messages, lambda: FileTopic(f"{tmp_shared}/t", max_bytes=20), f"{tmp_shared}/o", run="x")
    assert sorted(r.STATUS for r in read_outcomes(spark, f"{tmp_shared}/o").collect()) == ["failed", "published"]
    assert [r.value for r in spark.read.text(f"{tmp_shared}/t").collect()] == ["short"]


def test_publishing_a_stream_again_sends_nothing_twice(spark, tmp_shared):
    src, log, outcomes, ckpt = (f"{tmp_shared}/{n}" for n in ("src", "log", "o", "ckpt"))
    numbers = lambda lo, hi: spark.range(lo, hi).selectExpr("cast(id * 10 as string) as value").write.mode("append").text(src)
    run = lambda: publish_stream(spark.readStream.text(src), lambda: _Awkward(log), outcomes, "s", ckpt, chunk=9)
    numbers(0, 40)
    run()
    numbers(40, 60)
    run()
    last = max(int(f) for f in os.listdir(f"{ckpt}/commits") if f.isdigit())
    for f in (f"{ckpt}/commits/{last}", f"{ckpt}/commits/.{last}.crc"):
        if os.path.exists(f):
            os.remove(f)
    run()                                                                    # the last micro-batch runs again
    assert len(_sent(log)) == 60
    got = read_outcomes(spark, outcomes, "s").collect()
    assert len(got) == 60 and {r.RUN for r in got} == {f"s-{i}" for i in range(last + 1)}


# ---- generation as a table function ---------------------------------------------

class _Counting(G.EchoClient):
    def generate(self, prompts):
        if any(p == "boom" for p in prompts):
            raise RuntimeError("no model")
        return [r | {"safety": f"{len(prompts)}/{self.temperature}/{self.max_output_tokens}"} for r in super().generate(prompts)]


def test_table_function_equals_the_operator(spark):
    df = spark.createDataFrame([(i, f"p{i}" if i % 4 else None, 1.5) for i in range(30)], "id long, prompt string, x double")
    df.repartition(3).createOrReplaceTempView("prompts_udtf")
    G.register_generate_text(spark, G.EchoClient)
    for flat in (True, False):
        got = spark.sql(f"select * from generate_text(TABLE(prompts_udtf), flatten_json_output => {str(flat).lower()})")
        want = G.generate_text(df, G.EchoClient, flatten_json_output=flat)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert spark.sql("select count(*) from generate_text(TABLE(select * from prompts_udtf where id < 0))").first()[0] == 0


def test_table_function_options(spark):
    spark.range(20).selectExpr("concat('q', id) as question").coalesce(1).createOrReplaceTempView("questions_udtf")
    G.register_generate_text(spark, _Counting, "ask", batch_size=8)
    rows = spark.sql("""select ml_generate_text_rai_result s, count(*) n from ask(TABLE(questions_udtf), temperature => 0.7D,
                        max_output_tokens => 12, prompt_col => 'question') group by 1""").collect()
    assert {r.s: r.n for r in rows} == {"8/0.7/12": 16, "4/0.7/12": 4}
    with pytest.raises(Exception, match="no column prompt"):
        spark.sql("select * from ask(TABLE(questions_udtf))").collect()
    spark.sql("select 'boom' as prompt").createOrReplaceTempView("boom_udtf")
    r = spark.sql("select * from ask(TABLE(boom_udtf))").first()
    assert r.ml_generate_text_llm_result is None and r.ml_generate_text_status == "error: no model"


def test_stored_scenarios_carry_no_payload_of_their_own(spark, tmp_shared):
    """What only messages without an id or in quarantine need is kept for them, and for no other."""
    src, table = f"{tmp_shared}/src", f"{tmp_shared}/table"
    write_scenario_messages(_scen(spark, n=30), src)
    sample_messages(spark, 4).union(sample_messages(spark, 4)).write.mode("append").text(src)
    spark.createDataFrame([("not json",), ("not json",)], "value string").write.mode("append").text(src)
    ingest_messages(spark, table, f"{tmp_shared}/ckpt", path=src, state_partitions=2)
    stored = spark.read.option("recursiveFileLookup", "true").parquet(table)
    assert stored.where("SCENARIO_ID is not null and PAYLOAD_KEY is null").count() == 30
    assert stored.where("SCENARIO_ID is null and length(PAYLOAD_KEY) = 64").count() == 4 == stored.where("SCENARIO_ID is null").count()
    bad = I.quarantined(spark, table).collect()
    assert [r.PAYLOAD for r in bad] == ["not json"] and bad[0].SOURCE and bad[0].ARRIVAL


def test_state_partitions_grow_with_the_scenarios(spark, monkeypatch):
    from tickspark.plans import catalog

    cores = spark.sparkContext.defaultParallelism
    for n, want in ((0, cores), (10, cores), (catalog.STATE_SCENARIOS * 3 * cores + 1, 3 * cores + 1)):
        monkeypatch.setattr(catalog, "_scenario_count", lambda *_, n=n: n)
        assert catalog._state(spark, "-") == {"state_partitions": want}


def test_messages_are_parsed_once(spark):
    raw = sample_messages(spark, 3)
    raw = spark.createDataFrame(raw.collect(), "value string")
    plan = parse_messages(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert parse_messages(raw).count() == 3


class _Held:
    """A state variable of the processor in memory."""

    def __init__(self):
        self.value, self.map = None, {}
        self.containsKey, self.getValue = self.map.__contains__, self.map.get

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def updateValue(self, key, value):
        self.map[key] = value


def test_blocks_and_gains_held_change_no_result(monkeypatch):
    from tickspark.streaming import tail_state as S

    rng = np.random.default_rng(3)
    ids = [rng.integers(0, 6 * S.BLOCK, 700) for _ in range(5)]
    parts = [pd.DataFrame({"TEXT": "", "ID": i, "X": np.sin(i.astype(float)), "COUNTS": i % 7 != 0, "ROW": [str(v) for v in i]}) for i in ids]
    every = np.unique(np.concatenate(ids))
    counted = np.sort(np.sin(every[every % 7 != 0].astype(float)))
    for blocks, gains in ((1, 1), (2, 500), (1024, 100_000)):
        monkeypatch.setattr(S, "BLOCKS_HELD", blocks)
        monkeypatch.setattr(S, "GAINS_HELD", gains)
        p = TailProcessor(Q, floor=50)
        p.seen, p.texts, p.tail = _Held(), _Held(), _Held()
        out = [*p.handleInputRows(("=B", 0), iter(parts[:3]), None), *p.handleInputRows(("=B", 0), iter(parts[3:]), None)]
        assert sorted(int(v) for rows in out for v in rows["ROW"].dropna()) == every.tolist()
        last = out[-1].iloc[0]
        assert last["N"] == len(counted) and last["XS"].tolist() == counted[: len(last["XS"])].tolist()
        assert last["CUT"] == last["XS"][-1] and sum(last["CS"]) >= Q * last["N"]
