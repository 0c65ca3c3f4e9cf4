"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver's tables (through the fixture views of
``tickspark.sources.fixtures``) over their whole extent.  Parameters that
the reference fixes (ranges, instrument lists, dates, sizes) are restated
here for the fixture data's calendar.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.functions.filters import regular_trades
from tickspark.operators import bars as B
from tickspark.operators import closes as C
from tickspark.operators import comoments as M
from tickspark.operators import jobstats as J
from tickspark.operators import portfolios as P
from tickspark.operators import report as G
from tickspark.operators import risk as R
from tickspark.operators import summary as S
from tickspark.plans.report_job import run_report
from tickspark.plans.var_job import history_range, run_var
from tickspark.schemas import SCENARIO_COLUMNS
from tickspark.session import shared_path
from tickspark.sources import fixtures as X
from tickspark.sources.files import (append_scenarios, load_new_scenarios, load_scenarios, read_loaded, read_store,
                                     write_scenarios_csv)
from tickspark.sources.messages import (keyed_messages, parse_messages, read_messages, sample_messages,
                                        write_scenario_messages)
from tickspark.sources.publisher import FileTopic, publish, read_outcomes
from tickspark.sources.tables import (read_daily_close, read_job_history, read_l2, read_ticks, register_view,
                                      write_ticks)
from tickspark.streaming.bar_lattice import compact_lattice, lattice_bars, stream_bars
from tickspark.streaming.ingest import compact_store, ingest_messages, ingested, message_stream
from tickspark.streaming.running_var import read_var, running_var, stream_var_exact

# ---- fixed parameters of the registered queries ----------------------------
RICS = ["AAA.L", "BBB.L", "CCC.L", "DDD.L"]          # instrument list (DDD.L has no rows)
PORTFOLIO = ["AAA.L", "BBB.L", "CCC.L"]               # VaR portfolio on the events ticks
BRANDS = ["Brand#1", "Brand#2", "Brand#3"]            # gappy portfolio on lineitem closes
RANGE_HOUR = ("2024-01-15 12:00:00.000000", "2024-01-15 12:59:59.999999")
RANGE_DAYS = ("2024-1-10 12:00:00.000000", "2024-01-20 12:59:59.999999")
RANGE_6M = ("2023-7-31 12:00:00.000000", "2024-01-31 12:59:59.999999")
RANGE_FULL = ("2000-5-17 12:00:00.000000", "2024-11-17 12:59:59.999999")
PIVOT_DATES = ("2024-01-17", "2024-01-16")            # pivot order; day one = the second
BARS = {
    "bid_bars_hour_1d": ("HOUR", "2024-01-15 00:00:00", "2024-01-15 23:59:59"),
    "bid_bars_minute": ("MINUTE", "2024-01-01 00:00:00", "2024-01-31 23:59:59"),
    "bid_bars_day": ("DAY", "2023-08-01 00:00:00", "2024-01-31 23:59:59"),
    "bid_bars_hour": ("HOUR", "2020-01-01 00:00:00", "2025-01-01 00:00:00"),
}
BAR_PREVIEW = 100
JOBS_SINCE = "1996-01-01"
AS_OF = dt.datetime(2024, 1, 31)
YEARS = 20
START_DATE, END_DATE = history_range(AS_OF, YEARS)
SUPPLIERS = [f"S{i}" for i in range(1, 121)]          # wide portfolio (some may have no rows)
DAYS = 20
PORTFOLIO_VALUE = 1_000_000.0
VAR_Q = 0.01                                          # 1 - confidence, given exactly
HIST_BINS = 80
STORE_BATCHES = [("B20", 20), ("B9", 9)]              # (batch, horizon days) in the store

STATE_SCENARIOS = 1_000_000                           # of each batch, in a partition of a stream's state
LATE_BATCH = "007"                                    # a batch id that is not a number
MONEY_DIGITS = 4
MOMENT_DIGITS = 10


def _ticks(spark, d):
    return read_ticks(spark, X.ticks_from_events(spark, d))


def _scenario_count(spark, d):
    """As many scenarios as the tick table has rows: the work grows with the table."""
    return _ticks(spark, d).count()


def _portfolio_closes(spark, d):
    return C.daily_close(_ticks(spark, d), *RANGE_FULL, rics=PORTFOLIO)


def _portfolio_returns(spark, d):
    return C.log_returns(C.align_closes(_portfolio_closes(spark, d), PORTFOLIO), PORTFOLIO)


def _brand_closes(spark, d):
    return read_daily_close(spark, X.daily_close_from_lineitem(spark, d))


def _brand_returns(spark, d):
    return C.log_returns(C.align_closes(_brand_closes(spark, d), BRANDS), BRANDS)


def _moments(spark, d):
    return R.portfolio_moments(_portfolio_returns(spark, d), R.equal_weights(spark, PORTFOLIO))


def _scenarios(spark, d, batch="B20", days=DAYS, moments=None):
    mu, sigma = moments or R.moments_scalars(_moments(spark, d))
    return R.scenarios(spark, mu, sigma, _scenario_count(spark, d), 1, days, PORTFOLIO_VALUE, mode="lcg",
                       batch=batch, venue="LSE", portfolio=",".join(PORTFOLIO),
                       start_date=START_DATE, end_date=END_DATE)


def _store(spark, d):
    moments = R.moments_scalars(_moments(spark, d))       # one history pass for all batches
    out = None
    for batch, days in STORE_BATCHES:
        s = _scenarios(spark, d, batch, days, moments)
        out = s if out is None else out.unionByName(s)
    return out


def _show_scenarios(df: DataFrame) -> DataFrame:
    """Scenario rows for comparison: UTC wall-clock timestamps, money rounded."""
    return df.select(*[
        F.col(c).cast("timestamp_ntz").alias(c) if c in ("START_DATE", "END_DATE")
        else F.round(F.col(c), MONEY_DIGITS).alias(c) if c == "RETURN"
        else F.col(c) for c in SCENARIO_COLUMNS])


def _show_var(df: DataFrame, by=()) -> DataFrame:
    return df.select(*by, "n", F.round("VaR", MONEY_DIGITS).alias("VaR"))


def _round_cols(df: DataFrame, cols, digits=MOMENT_DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- queries -----------------------------------------------------------------

def q_regular_trades(spark, d):
    return regular_trades(_ticks(spark, d))


def q_trades_half_open(spark, d):
    return read_ticks(spark, X.ticks_from_events(spark, d), "2024-01-15 12:00:00", "2024-01-16 00:00:00", RICS,
                      end_open=True)


def q_vwap_summary_hour(spark, d):
    return S.trade_summary(_ticks(spark, d), *RANGE_HOUR, rics=RICS)


def q_vwap_summary_days(spark, d):
    return S.trade_summary(_ticks(spark, d), *RANGE_DAYS, rics=RICS)


def q_vwap_summary_6m(spark, d):
    return S.trade_summary(_ticks(spark, d), *RANGE_6M, rics=RICS)


def q_vwap_summary_full(spark, d):
    return S.trade_summary(_ticks(spark, d), *RANGE_FULL, rics=RICS)


def q_daily_trade_summary(spark, d):
    return S.daily_trade_summary(_ticks(spark, d), *RANGE_FULL, rics=RICS)


def q_symbol_series(spark, d):
    daily = S.daily_trade_summary(_ticks(spark, d), *RANGE_FULL, rics=RICS, date_name="Date")
    return S.symbol_series(daily, "BBB.L", date_name="Date")


def _pivot(spark, d):
    daily = S.daily_trade_summary(_ticks(spark, d), *RANGE_FULL, rics=RICS)
    return register_view(S.pivot_by_date(daily, PIVOT_DATES), "pivoted_by_ric")


def q_vwap_pivot(spark, d):
    return _pivot(spark, d)


def q_vwap_pivot_native(spark, d):
    daily = S.daily_trade_summary(_ticks(spark, d), *RANGE_FULL, rics=RICS)
    return S.pivot_by_date_native(daily, PIVOT_DATES)


def _bars(name):
    unit, start, end = BARS[name]

    def q(spark, d):
        return B.bid_bars(read_l2(spark, X.l2_from_events(spark, d)), unit, start, end)
    q.__name__ = f"q_{name}"
    return q


def _streamed_bars(name):
    """The bars of ``name`` from the minute lattice of a stream; a tenth of the quotes come in later files."""
    unit, start, end = BARS[name]

    def q(spark, d):
        src, lattice, ckpt, out = (shared_path(spark, n) for n in ("quotes", "bar-lattice", "bar-ckpt", "bar-compact"))
        quotes = read_l2(spark, X.l2_from_events(spark, d))
        late = F.pmod(F.xxhash64("date_time", "RIC", "L2_BidPrice"), F.lit(10)) == 0
        for part in (~late, late):
            quotes.where(part).write.mode("append").parquet(src)
            stream_bars(spark, spark.readStream.schema(quotes.schema).parquet(src), lattice, ckpt)
        compact_lattice(spark, lattice, out)
        return lattice_bars(spark, out if unit == "DAY" else lattice, unit, start, end)
    q.__name__ = f"q_{name}_streamed"
    return q


def q_bid_bars_preview(spark, d):
    unit, start, end = BARS["bid_bars_minute"]
    return B.bid_bars(read_l2(spark, X.l2_from_events(spark, d)), unit, start, end, preview=BAR_PREVIEW)


def q_daily_close(spark, d):
    return _portfolio_closes(spark, d)


def q_daily_close_ties(spark, d):
    return C.daily_close(X.ticks_from_lineitem(spark, d), order_cols=X.LINEITEM_TICK_ORDER)


def q_vwap_yearly(spark, d):
    t = X.ticks_from_lineitem(spark, d).withColumn("year", F.year("Date_Time"))
    return S.trade_summary(t, by=("RIC", "year"))


def q_aligned_closes(spark, d):
    return C.align_closes(_brand_closes(spark, d), BRANDS)


def q_log_returns(spark, d):
    return _round_cols(_brand_returns(spark, d), {"log_return"}, 12)


def q_aligned_closes_nulls(spark, d):
    return C.align_closes(X.gappy_close_from_lineitem(spark, d, BRANDS[0]), BRANDS)


def q_log_returns_nulls(spark, d):
    return _round_cols(C.log_returns(q_aligned_closes_nulls(spark, d), BRANDS), {"log_return"}, 12)


def q_expected_return(spark, d):
    out = R.expected_return(_brand_returns(spark, d), R.equal_weights(spark, BRANDS))
    return _round_cols(out, {"expected_return"})


def q_covariance(spark, d):
    return _round_cols(R.covariance(_brand_returns(spark, d), BRANDS), {"covariance"}, 12)


def q_covariance_wide(spark, d):
    closes = X.monthly_close_from_suppliers(spark, d)
    rets = C.gappy_log_returns(C.align_closes(closes, SUPPLIERS))
    return _round_cols(R.covariance(rets, SUPPLIERS), {"covariance"}, 9)


def q_covariance_by_load(spark, d):
    """The matrix stored year by year, one load each, then all loads as one."""
    rets = _brand_returns(spark, d)
    store, out = shared_path(spark, "comoments"), shared_path(spark, "comoments-all")
    for r in rets.select(F.year("Date").alias("y")).distinct().orderBy("y").collect():
        M.add_comoments(rets.where(F.year("Date") == r.y), BRANDS, store, str(r.y))
    M.compact_comoments(spark, store, BRANDS, out, "all")
    return _round_cols(M.covariance_of(M.stored_comoments(spark, out), BRANDS), {"covariance"}, 12)


def _nation_portfolios(spark, d):
    """One portfolio per nation: its suppliers among the listed ones, equally weighted."""
    rics = spark.createDataFrame([(t,) for t in SUPPLIERS], "RIC string")
    held = (spark.read.parquet(f"{d}/supplier.parquet")
            .select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("RIC"), "s_nationkey")
            .join(rics, "RIC").join(spark.read.parquet(f"{d}/nation.parquet"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("n_name").alias("PORTFOLIO"), "RIC"))
    size = held.groupBy("PORTFOLIO").agg((F.lit(1.0) / F.count(F.lit(1))).alias("weight"))
    return held.join(size, "PORTFOLIO")


def q_portfolio_vars(spark, d):
    """Moments and VaR of one portfolio per nation, all in one job."""
    closes = X.monthly_close_from_suppliers(spark, d)
    rets = C.gappy_log_returns(C.align_closes(closes, SUPPLIERS))
    moments = P.portfolio_moments_all(rets, _nation_portfolios(spark, d))
    out = P.portfolio_vars(moments, _scenario_count(spark, d), DAYS, PORTFOLIO_VALUE, q=VAR_Q)
    return _round_cols(_round_cols(out, {"expected_return", "portfolio_std"}), {"VaR"}, 3)


def q_portfolio_std(spark, d):
    cov = R.covariance(_brand_returns(spark, d), BRANDS)
    return _round_cols(R.portfolio_std(cov, R.equal_weights(spark, BRANDS)), {"portfolio_std"})


def q_portfolio_moments(spark, d):
    return _round_cols(_moments(spark, d), {"expected_return", "portfolio_std"})


def q_cagr(spark, d):
    return _round_cols(S.cagr(_brand_closes(spark, d)), {"cagr"})


def q_normalized_return(spark, d):
    # one IEEE division per row: bit-identical in both engines, so not rounded
    return S.normalized_return(_brand_closes(spark, d))


def q_scenarios(spark, d):
    return _show_scenarios(_scenarios(spark, d))


def q_value_at_risk(spark, d):
    return _show_var(R.value_at_risk(_scenarios(spark, d), q=VAR_Q))


def q_brand_var(spark, d):
    """Historical one-day VaR of every brand over all its closes."""
    rets = C.gappy_log_returns(_brand_closes(spark, d))
    return _round_cols(R.value_at_risk(rets, by=["RIC"], col="log_return", q=VAR_Q), {"VaR"})


def q_price_quantile(spark, d):
    """The exact lower 1 % price over every line item (one group of the whole table)."""
    ticks = X.ticks_from_lineitem(spark, d)
    return _round_cols(R.value_at_risk(ticks, col="Price", q=VAR_Q), {"VaR"})


def q_var_job(spark, d):
    """The whole job through ``run_var``: closes, moments, scenarios into a store, VaR."""
    table = shared_path(spark, "var-job")
    run = run_var(spark, _ticks(spark, d), PORTFOLIO, AS_OF, years=YEARS, days=DAYS, n=_scenario_count(spark, d),
                  portfolio_value=PORTFOLIO_VALUE, mode="lcg", batch="B20", q=VAR_Q,
                  sink=lambda df: append_scenarios(df, table))
    stored = read_store(spark, table).groupBy("BATCH").agg(F.count(F.lit(1)).alias("stored"),
                                                            F.countDistinct("SCENARIO_ID").alias("ids"))
    var = _show_var(run.var).first()
    scalars = {"n": F.lit(var.n).cast("long"), "VaR": F.lit(var.VaR).cast("double"),
               "mu": F.lit(run.mu).cast("double"), "sigma": F.lit(run.sigma).cast("double")}
    return _round_cols(stored.withColumns(scalars), {"mu", "sigma"})


def _day_store(spark, d):
    path = shared_path(spark, "tick-days")
    write_ticks(_ticks(spark, d), path)
    return read_ticks(spark, path)


def q_daily_summary_by_folder(spark, d):
    """The daily summary over day folders, of which only the range's are read."""
    return S.daily_trade_summary(_day_store(spark, d), *RANGE_DAYS, rics=RICS, trade_date_col="trade_date")


def q_report_job(spark, d):
    """The report job over day folders, generated rows stored and read back."""
    out = shared_path(spark, "report")
    run_report(_day_store(spark, d), RICS, *RANGE_DAYS, PIVOT_DATES[1], PIVOT_DATES[0], G.EchoClient, out=out,
               trade_date_col="trade_date")
    return spark.read.parquet(out)


def q_var_histogram(spark, d):
    h = R.histogram(_scenarios(spark, d), HIST_BINS)
    return h.select("bin", F.round("bin_start", MONEY_DIGITS).alias("bin_start"),
                    F.round("bin_end", MONEY_DIGITS).alias("bin_end"), "count",
                    F.round(F.col("density") * F.lit(1e6), 9).alias("density_per_million"))


def q_var_by_batch(spark, d):
    return _show_var(R.value_at_risk(_store(spark, d), by=["BATCH"], q=VAR_Q), by=["BATCH"])


def q_scenario_csv_roundtrip(spark, d):
    csv_dir, table = shared_path(spark, "scenario-csv"), shared_path(spark, "scenario-table")
    write_scenarios_csv(_store(spark, d), csv_dir)
    return _show_scenarios(load_scenarios(spark, csv_dir, table))


def q_scenario_messages(spark, d):
    path = shared_path(spark, "scenario-messages")
    write_scenario_messages(_scenarios(spark, d), path)
    return _show_scenarios(read_messages(spark, path))


def _state(spark, d):
    """Partitions of a stream's state: one per core, more where a batch has many scenarios."""
    return {"state_partitions": max(spark.sparkContext.defaultParallelism, -(-_scenario_count(spark, d) // STATE_SCENARIOS))}


def _ingested(spark, d):
    src, table, ckpt = (shared_path(spark, n) for n in ("messages", "ingest-table", "ingest-ckpt"))
    state = _state(spark, d)
    store = _store(spark, d)
    write_scenario_messages(store, src)
    write_scenario_messages(store.where(F.col("SCENARIO_ID") % 2 == 0), src)   # redelivered copies
    ingest_messages(spark, table, ckpt, path=src, **state)
    ingest_messages(spark, table, ckpt, path=src, **state)   # re-run: adds nothing
    return table


def q_message_ingest(spark, d):
    return _show_scenarios(ingested(spark, _ingested(spark, d)))


def _age_files(spark, path, hours):
    """Set the modification time of a folder's files back."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for f in fs.listStatus(folder):
        fs.setTimes(f.getPath(), f.getModificationTime() - hours * 3_600_000, -1)


def q_message_ingest_late(spark, d):
    """Two deliveries on one checkpoint: the second, of batch ``007``, in files five hours older; some text is broken."""
    src, table, ckpt = (shared_path(spark, n) for n in ("messages", "ingest-table", "ingest-ckpt"))
    state = _state(spark, d)
    moments = R.moments_scalars(_moments(spark, d))
    write_scenario_messages(_scenarios(spark, d, "B20", DAYS, moments), src)
    ingest_messages(spark, table, ckpt, path=f"{src}*", **state)
    late = f"{src}-late"
    write_scenario_messages(_scenarios(spark, d, LATE_BATCH, DAYS, moments), late)
    spark.createDataFrame([("not json",), ('{"batch": "007", "return": 1.5, "start_date": "soon"}',)],
                          "value string").write.mode("append").text(late)
    _age_files(spark, late, 5)
    ingest_messages(spark, table, ckpt, path=f"{src}*", **state)
    return _show_scenarios(ingested(spark, table))


def q_stream_var(spark, d):
    return _show_var(running_var(spark, _ingested(spark, d), q=VAR_Q), by=["BATCH"])


def q_stream_var_incremental(spark, d):
    """VaR from keyed state: a first delivery, then the rest among redelivered copies on the same checkpoint."""
    src, store, var, ckpt = (shared_path(spark, n) for n in ("messages", "var-store", "var-table", "var-ckpt"))
    state = _state(spark, d)
    st = _store(spark, d)
    run = lambda: stream_var_exact(spark, parse_messages(message_stream(spark, src)), store, var, ckpt, q=VAR_Q, **state)
    write_scenario_messages(st.where(F.col("SCENARIO_ID") % 2 == 0), src)
    run()
    write_scenario_messages(st.where(F.col("SCENARIO_ID") % 2 == 1), src)
    write_scenario_messages(st.where(F.col("SCENARIO_ID") % 3 == 0), src)       # redelivered copies
    run()
    return _show_var(read_var(spark, var), by=["BATCH"])


def q_message_ingest_redelivered(spark, d):
    """Copies that come after the stream has forgotten their scenarios, and through another checkpoint."""
    src, table, ckpt = (shared_path(spark, n) for n in ("messages", "ingest-table", "ingest-ckpt"))
    state = _state(spark, d)
    store = _store(spark, d)
    write_scenario_messages(store.where(F.col("SCENARIO_ID") % 2 == 0), src)
    ingest_messages(spark, table, ckpt, path=src, window="0 seconds", **state)
    write_scenario_messages(store, src)
    ingest_messages(spark, table, ckpt, path=src, window="0 seconds", **state)
    ingest_messages(spark, table, f"{ckpt}-other", path=src, **state)
    return _show_scenarios(ingested(spark, table))


def q_publish_outcomes(spark, d):
    """Every scenario message published to a file topic: an outcome for each, beside the message as it arrived."""
    topic, outcomes = shared_path(spark, "topic"), shared_path(spark, "outcomes")
    run = publish(keyed_messages(_scenarios(spark, d)), lambda: FileTopic(topic), outcomes)
    arrived = _show_scenarios(read_messages(spark, topic)).select(
        F.concat_ws("/", "BATCH", F.col("SCENARIO_ID").cast("string")).alias("KEY"), "RETURN")
    return read_outcomes(spark, outcomes, run).select("KEY", "STATUS").join(arrived, "KEY", "full")


def q_sample_publish(spark, d):
    """The test publisher's messages, as many as the tick table has rows, published and read back."""
    topic, outcomes = shared_path(spark, "topic"), shared_path(spark, "outcomes")
    run = publish(sample_messages(spark, _scenario_count(spark, d), batch="1234"), lambda: FileTopic(topic), outcomes)
    arrived = read_messages(spark, topic).groupBy("BATCH").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("RETURN").alias("returns"), F.max("RETURN").alias("last"))
    published = read_outcomes(spark, outcomes, run).where("STATUS = 'published'").agg(F.count(F.lit(1)).alias("published"))
    return arrived.withColumn("published", F.lit(published.first().published))


def q_scenario_load_ledger(spark, d):
    """CSV files loaded as they arrive: two batches, then a load that finds nothing new."""
    csv_dir, table = shared_path(spark, "ledger-csv"), shared_path(spark, "ledger-table")
    for batch, days in STORE_BATCHES:
        write_scenarios_csv(_scenarios(spark, d, batch, days), csv_dir)
        load_new_scenarios(spark, csv_dir, table)
    load_new_scenarios(spark, csv_dir, table)
    return _show_scenarios(read_loaded(spark, table))


def q_store_compaction(spark, d):
    table, out = shared_path(spark, "dup-store"), shared_path(spark, "compact-store")
    st = _store(spark, d)
    append_scenarios(st, table)
    append_scenarios(st.where(F.col("SCENARIO_ID") % 3 == 1), table)     # late redeliveries
    return _show_scenarios(compact_store(spark, table, out))


def _history(spark, d):
    return read_job_history(spark, X.job_history_from_orders(spark, d))


def q_job_stage_inputs(spark, d):
    return _round_cols(J.stage_inputs(_history(spark, d), JOBS_SINCE), {"speedup"})


def q_job_stats(spark, d):
    return _round_cols(J.job_stats(_history(spark, d), JOBS_SINCE, k=4), {"speedup"})


def q_job_stats_latest(spark, d):
    return _round_cols(J.job_stats(_history(spark, d), JOBS_SINCE, k=1), {"speedup"})


def q_job_scale_summary(spark, d):
    s = J.job_scale_summary(J.job_stats(_history(spark, d), JOBS_SINCE, k=4))
    return _round_cols(s, {"rows_billions", "slot_hours", "wall_seconds"}, 12)


def q_report_prompt(spark, d):
    return G.report_prompt(_pivot(spark, d), PIVOT_DATES[1], PIVOT_DATES[0])


def q_report_text(spark, d):
    prompts = G.report_prompt(_pivot(spark, d), PIVOT_DATES[1], PIVOT_DATES[0])
    return G.generate_text(prompts, G.EchoClient)


def _prompts_view(spark, d):
    prompts = G.report_prompt(_pivot(spark, d), PIVOT_DATES[1], PIVOT_DATES[0])
    prompts.createOrReplaceTempView("report_prompts")
    G.register_generate_text(spark, G.EchoClient)


def q_report_text_sql(spark, d):
    """Generation as SQL's table function."""
    _prompts_view(spark, d)
    return spark.sql("""SELECT * FROM generate_text(TABLE(SELECT * FROM report_prompts),
                        temperature => 0.2, max_output_tokens => 800, flatten_json_output => true)""")


def q_report_text_raw(spark, d):
    """The same, with the answer as one JSON column."""
    _prompts_view(spark, d)
    return spark.sql("SELECT * FROM generate_text(TABLE(report_prompts), flatten_json_output => false)")


QUERIES = {
    "regular_trades": q_regular_trades,
    "trades_half_open": q_trades_half_open,
    "vwap_summary_hour": q_vwap_summary_hour,
    "vwap_summary_days": q_vwap_summary_days,
    "vwap_summary_6m": q_vwap_summary_6m,
    "vwap_summary_full": q_vwap_summary_full,
    "daily_trade_summary": q_daily_trade_summary,
    "symbol_series": q_symbol_series,
    "vwap_pivot": q_vwap_pivot,
    "vwap_pivot_native": q_vwap_pivot_native,
    **{name: _bars(name) for name in BARS},
    **{f"{name}_streamed": _streamed_bars(name) for name in ("bid_bars_minute", "bid_bars_day", "bid_bars_hour")},
    "bid_bars_preview": q_bid_bars_preview,
    "daily_close": q_daily_close,
    "daily_close_ties": q_daily_close_ties,
    "vwap_yearly": q_vwap_yearly,
    "aligned_closes": q_aligned_closes,
    "aligned_closes_nulls": q_aligned_closes_nulls,
    "log_returns": q_log_returns,
    "log_returns_nulls": q_log_returns_nulls,
    "expected_return": q_expected_return,
    "covariance": q_covariance,
    "covariance_wide": q_covariance_wide,
    "covariance_by_load": q_covariance_by_load,
    "portfolio_vars": q_portfolio_vars,
    "portfolio_std": q_portfolio_std,
    "portfolio_moments": q_portfolio_moments,
    "cagr": q_cagr,
    "normalized_return": q_normalized_return,
    "scenarios": q_scenarios,
    "value_at_risk": q_value_at_risk,
    "brand_var": q_brand_var,
    "price_quantile": q_price_quantile,
    "var_job": q_var_job,
    "daily_summary_by_folder": q_daily_summary_by_folder,
    "report_job": q_report_job,
    "var_histogram": q_var_histogram,
    "var_by_batch": q_var_by_batch,
    "scenario_csv_roundtrip": q_scenario_csv_roundtrip,
    "scenario_messages": q_scenario_messages,
    "message_ingest": q_message_ingest,
    "message_ingest_late": q_message_ingest_late,
    "stream_var": q_stream_var,
    "stream_var_incremental": q_stream_var_incremental,
    "message_ingest_redelivered": q_message_ingest_redelivered,
    "publish_outcomes": q_publish_outcomes,
    "sample_publish": q_sample_publish,
    "scenario_load_ledger": q_scenario_load_ledger,
    "store_compaction": q_store_compaction,
    "job_stage_inputs": q_job_stage_inputs,
    "job_stats": q_job_stats,
    "job_stats_latest": q_job_stats_latest,
    "job_scale_summary": q_job_scale_summary,
    "report_prompt": q_report_prompt,
    "report_text": q_report_text,
    "report_text_sql": q_report_text_sql,
    "report_text_raw": q_report_text_raw,
}
