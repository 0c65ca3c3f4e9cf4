"""Job statistics and report text."""

import datetime as dt

from pyspark.sql import functions as F

from tickspark.operators.jobstats import explode_stages, job_scale_summary, job_stats, stage_inputs
from tickspark.operators.report import EchoClient, generate_text, report_prompt
from tickspark.operators.summary import daily_trade_summary, pivot_by_date
from tickspark.schemas import JOB_HISTORY
from tickspark.sources.fixtures import job_history_from_orders, ticks_from_events

SF01 = "/root/testdata/sf0.01"


def _job(i, stages, state="DONE", query="select 1", day=2):
    t = dt.datetime(2024, 1, day)
    return (i, state, query, t, t, t + dt.timedelta(milliseconds=250), 1000, 5000, stages)


def test_empty_stage_array_disappears(spark):
    rows = [_job(1, [("S00: Input", 10)]), _job(2, []), _job(3, None)]
    h = spark.createDataFrame(rows, JOB_HISTORY)
    assert [r.job_id for r in explode_stages(h).collect()] == [1]


def test_filters_and_speedup(spark):
    rows = [_job(1, [("S00: Input", 10), ("S01", 3)]),
            _job(2, [("S00: Input", 20)], state="RUNNING"),
            _job(3, [("S00: Input", 30)], query="select * from INFORMATION_SCHEMA.JOBS"),
            _job(4, [("S00: Input", 40)], day=1)]
    h = spark.createDataFrame(rows, JOB_HISTORY)
    s = stage_inputs(h, since="2024-01-02").collect()
    assert [(r.job_id, r.execution_time_ms, r.speedup, r.rows_read) for r in s] == [(1, 250, 4.0, 10)]


def test_newest_k_with_tie_break(spark):
    h = job_history_from_orders(spark, SF01)
    top = job_stats(h, "1996-01-01", k=4).collect()
    allrows = stage_inputs(h, "1996-01-01").orderBy(F.desc("creation_time"), F.desc("job_id")).limit(4).collect()
    assert [r.job_id for r in top] == [r.job_id for r in allrows]
    assert stage_inputs(h, "1996-01-01").count() == 2089
    s = job_scale_summary(job_stats(h, "1996-01-01", k=4)).collect()
    assert all(r.wall_seconds > 0 for r in s)


def test_prompt_null_when_day_missing(spark):
    daily = daily_trade_summary(ticks_from_events(spark, "/root/testdata/sf0.001"))
    p = report_prompt(pivot_by_date(daily, ["2024-01-03", "2024-01-02"]), "2024-01-02", "2024-01-03")
    rows = {r.RIC: r.prompt for r in p.collect()}
    assert rows["CCC.L"] is None            # no CCC.L trades on the first day at sf0.001
    assert rows["AAA.L"].startswith("From the following trading information")
    assert "vwap day one:" in rows["AAA.L"]


def test_generate_text_with_stub(spark):
    df = spark.createDataFrame([("a",), (None,)], "prompt string")
    out = {r.prompt: r for r in generate_text(df, EchoClient).collect()}
    assert out["a"].ml_generate_text_llm_result == "Summary: a"
    assert out[None].ml_generate_text_llm_result is None
    raw = generate_text(df, EchoClient, flatten_json_output=False).where("prompt = 'a'").first()
    assert '"content": "Summary: a"' in raw.ml_generate_text_result


def test_job_stats_from_spark_event_log(spark, tmp_path):
    """Run a bars query in a separate Spark app with event logging, then
    compute its run statistics from the log."""
    import subprocess
    import sys
    from pathlib import Path

    from tickspark.sources.event_log import read_event_log_jobs
    log_dir = tmp_path / "eventlog"
    log_dir.mkdir()
    repo = Path(__file__).resolve().parents[1]
    code = f"""
import sys
sys.path.insert(0, {str(repo)!r})
from tickspark.session import get_spark
s = get_spark("local[2]", 2, extra={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": {str(log_dir)!r}}})
import __spark_entry__ as E
s.sparkContext.setJobDescription("bid bars hour")
E.queries()["bid_bars_hour"](s, "/root/testdata/sf0.01").collect()
s.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    history = read_event_log_jobs(spark, str(log_dir))
    stats = job_stats(history, None, k=None).where("query = 'bid bars hour'").collect()
    assert len(stats) == 1
    s = stats[0]
    assert s.rows_read == 10_000                  # every quote row was read by the input stage
    assert s.execution_time_ms > 0 and s.total_slot_ms > 0
    assert s.speedup == s.total_slot_ms / s.execution_time_ms
    assert job_scale_summary(job_stats(history, None, k=4)).count() >= 1


def test_generate_text_reports_client_errors(spark):
    class Failing:
        def __init__(self, **kw):
            pass

        def generate(self, prompts):
            raise RuntimeError("quota exceeded")

    df = spark.createDataFrame([("a",), ("b",)], "prompt string")
    rows = generate_text(df, Failing).collect()
    assert all(r.ml_generate_text_llm_result is None for r in rows)
    assert all(r.ml_generate_text_status == "error: quota exceeded" for r in rows)


def test_since_today(spark):
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [_job(1, [("S00: Input", 5)]), (2, "DONE", "select 2", now, now,
                                           now + dt.timedelta(milliseconds=10), 50, 1, [("S00: Input", 7)])]
    h = spark.createDataFrame(rows, JOB_HISTORY)
    assert [r.job_id for r in stage_inputs(h, since="today").collect()] == [2]


def test_report_job_end_to_end(spark, tmp_path):
    from tickspark.plans.report_job import run_report
    ticks = ticks_from_events(spark, SF01)
    out = str(tmp_path / "report")
    run = run_report(ticks, ["AAA.L", "BBB.L", "ZZZ.L"], "2024-01-16 12:00:00", "2024-01-17 12:59:59.999999",
                     "2024-01-16", "2024-01-17", EchoClient, out=out)
    stored = spark.read.parquet(out).collect()
    assert sorted(r.RIC for r in stored) == ["AAA.L", "BBB.L"]
    assert all(r.ml_generate_text_llm_result == "Summary: " + r.prompt for r in stored)
    assert spark.sql("select count(*) from pivoted_by_ric").first()[0] == 2


def test_generate_text_calls_client_in_chunks(spark):
    class Sized(EchoClient):
        def generate(self, prompts):
            assert len(prompts) <= 3
            return [{"text": f"{len(prompts)}", "safety": "", "status": ""} for _ in prompts]

    df = spark.range(10).selectExpr("cast(id as string) as prompt").coalesce(1)
    out = generate_text(df, Sized, batch_size=3).collect()
    assert sorted(int(r.ml_generate_text_llm_result) for r in out) == [1] + [3] * 9


def test_event_logs_of_two_applications_in_one_folder(spark, tmp_path):
    """Runs are told apart by application; of a stage's attempts the last counts."""
    import json
    from tickspark.sources.event_log import read_event_log_jobs

    def log(app, start, attempts):
        acc = lambda ms, rows: [{"Name": "internal.metrics.executorRunTime", "Value": str(ms)},
                                {"Name": "internal.metrics.input.recordsRead", "Value": str(rows)}]
        events = [{"Event": "SparkListenerApplicationStart", "App ID": app},
                  {"Event": "SparkListenerJobStart", "Job ID": 0, "Submission Time": start, "Stage IDs": [0],
                   "Properties": {"spark.sql.execution.id": "1", "spark.job.description": app}}]
        events += [{"Event": "SparkListenerStageCompleted", "Stage Info": {
            "Stage ID": 0, "Stage Attempt ID": i, "Stage Name": "scan", "Accumulables": acc(ms, rows)}}
            for i, (ms, rows) in enumerate(attempts)]
        events.append({"Event": "SparkListenerJobEnd", "Job ID": 0, "Completion Time": start + 1000,
                       "Job Result": {"Result": "JobSucceeded"}})
        (tmp_path / app).write_text("\n".join(map(json.dumps, events)))

    log("app-1", 0, [(500, 10)])
    log("app-2", 900_000, [(100, 4), (700, 20)])
    rows = {r.query: r for r in read_event_log_jobs(spark, str(tmp_path)).collect()}
    assert set(rows) == {"app-1", "app-2"}
    assert (rows["app-1"].total_slot_ms, rows["app-2"].total_slot_ms) == (500, 700)
    assert rows["app-2"].job_stages[0].records_read == 20
    assert (rows["app-1"].end_time - rows["app-1"].start_time).total_seconds() == 1


def test_prompt_prints_large_prices_in_full(spark):
    from tickspark.operators.report import report_prompt
    row = ("A", 12345678.9, 5, 7, 1.5, 6, 20_000_000)
    df = spark.createDataFrame([row], "RIC string, VWAP_d1 double, NumTrades_d1 long, TotalVolume_d1 long, "
                                      "VWAP_d2 double, NumTrades_d2 long, TotalVolume_d2 long")
    text = report_prompt(df, "d1", "d2").first().prompt
    assert "vwap day one:12345678.900 vwap" in text and text.endswith("day 2:20000000")
