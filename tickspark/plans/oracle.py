"""DuckDB SQL equal to each registered query, over the driver's tables.

Used by the correctness gate: the same fixture views are written as CTEs,
then the reference's SQL shape on top (``ROW_NUMBER`` for the last trade,
``quantile_cont`` for VaR, ``PIVOT`` as conditional aggregates).
"""

from __future__ import annotations

from tickspark.functions.scalars import LCG_A1, LCG_A2, LCG_C1, LCG_C2, LCG_M1, LCG_M2
from tickspark.plans import catalog as K

TICKS = """ticks AS (
  SELECT event_id AS Seq, ts AS Date_Time,
         CASE user_id % 3 WHEN 0 THEN 'AAA.L' WHEN 1 THEN 'BBB.L' ELSE 'CCC.L' END AS RIC,
         value AS Price, event_id % 49 AS Volume,
         CASE WHEN event_type IN ('purchase','click','view') THEN 'Trade' ELSE 'Quote' END AS Type,
         CASE event_id % 5 WHEN 0 THEN 'no qualifiers'
                           WHEN 1 THEN 'U[ACT];12PPPPPPPPPPPP'
                           WHEN 2 THEN 'A[X];32------------[MMT_CLASS]'
                           ELSE 'A[X];B[Y];12-------P----[MMT_CLASS];Z[W]' END AS Qualifiers
  FROM events)"""

L2 = """l2 AS (
  SELECT ts AS date_time,
         CASE user_id % 3 WHEN 0 THEN 'AAA.L' WHEN 1 THEN 'BBB.L' ELSE 'CCC.L' END AS RIC,
         value AS L2_BidPrice
  FROM events)"""

BRAND_CLOSES = """closes AS (
  SELECT p_brand AS RIC, CAST(l_shipdate AS DATE) AS "Date", max(l_extendedprice) AS Price
  FROM lineitem JOIN part ON l_partkey = p_partkey
  GROUP BY p_brand, CAST(l_shipdate AS DATE))"""

BIG_TICKS = """ticks AS (
  SELECT l_orderkey AS Seq, l_shipdate AS Date_Time, p_brand AS RIC,
         l_extendedprice / l_quantity AS Price, CAST(l_quantity AS BIGINT) AS Volume,
         'Trade' AS Type, 'A[X];B[Y];12-------P----[MMT_CLASS];Z[W]' AS Qualifiers,
         l_linenumber, l_partkey, l_suppkey
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

HISTORY = """stages AS (
  SELECT l_orderkey,
         list({'name': CASE WHEN l_linenumber = 1 THEN 'S00: Input' ELSE 'S0' || CAST(l_linenumber AS VARCHAR) END,
               'records_read': CAST(l_quantity AS BIGINT)}) AS job_stages
  FROM lineitem GROUP BY l_orderkey),
history AS (
  SELECT o_orderkey AS job_id,
         CASE WHEN o_orderstatus = 'F' THEN 'DONE' ELSE 'RUNNING' END AS state,
         'select ' || o_orderpriority || CASE WHEN o_orderkey % 7 = 0 THEN ' from INFORMATION_SCHEMA.X' ELSE '' END AS query,
         o_orderdate AS creation_time, o_orderdate AS start_time,
         o_orderdate + to_milliseconds(CAST(o_custkey * 10 + 5 AS INTEGER)) AS end_time,
         CAST(floor(o_totalprice) AS BIGINT) AS total_slot_ms,
         CAST(floor(o_totalprice * 1000) AS BIGINT) AS total_bytes_processed,
         job_stages
  FROM orders JOIN stages ON l_orderkey = o_orderkey)"""

REGULAR = r"""Price IS NOT NULL AND Type = 'Trade' AND Volume > 0 AND Price > 0
  AND right(regexp_extract(Qualifiers, ';(.*)\[MMT_CLASS\]', 1), 14) LIKE '12%'"""


def _list(xs):
    return ", ".join(f"'{x}'" for x in xs)


def _values(xs):
    return ", ".join(f"('{x}')" for x in xs)


def _summary(rng):
    return f"""WITH {TICKS},
all_trades AS (
  SELECT Date_Time, RIC, Price, Volume FROM ticks
  WHERE {REGULAR} AND Date_Time BETWEEN '{rng[0]}' AND '{rng[1]}')
SELECT RIC, round(sum(Volume * Price) / nullif(sum(Volume), 0), 3) AS VWAP,
       round(avg(Price), 3) AS TWAP, CAST(sum(Volume) AS BIGINT) AS TotalVolume,
       count(RIC) AS NumTrades
FROM all_trades WHERE RIC IN ({_list(K.RICS)})
GROUP BY RIC ORDER BY RIC"""


def _daily(date_name="vwap_date", rng=K.RANGE_FULL):
    return f"""daily AS (
  SELECT RIC, round(sum(Volume * Price) / nullif(sum(Volume), 0), 3) AS VWAP,
         CAST(sum(Volume) AS BIGINT) AS TotalVolume, count(RIC) AS NumTrades,
         CAST(Date_Time AS DATE) AS {date_name}
  FROM ticks
  WHERE {REGULAR} AND Date_Time BETWEEN '{rng[0]}' AND '{rng[1]}'
    AND RIC IN ({_list(K.RICS)})
  GROUP BY RIC, CAST(Date_Time AS DATE))"""


def _pivot():
    cols = []
    for d in K.PIVOT_DATES:
        s = d.replace("-", "_")
        cols += [f"avg(CASE WHEN vwap_date = DATE '{d}' THEN VWAP END) AS VWAP_{s}",
                 f"CAST(sum(CASE WHEN vwap_date = DATE '{d}' THEN TotalVolume END) AS BIGINT) AS TotalVolume_{s}",
                 f"CAST(sum(CASE WHEN vwap_date = DATE '{d}' THEN NumTrades END) AS BIGINT) AS NumTrades_{s}"]
    return f"""pivoted AS (SELECT RIC, {', '.join(cols)} FROM daily GROUP BY RIC)"""


def _bars(unit, start, end, preview=None):
    tail = f" ORDER BY RIC, time_group LIMIT {preview}" if preview else ""
    return f"""WITH {L2}
SELECT RIC, date_trunc('{unit.lower()}', date_time) AS time_group,
       max(L2_BidPrice) AS max_bid, min(L2_BidPrice) AS min_bid
FROM l2 WHERE date_time BETWEEN '{start}' AND '{end}'
GROUP BY RIC, date_trunc('{unit.lower()}', date_time){tail}"""


def _last_trade(order="Date_Time, Seq", where="", rics=None):
    ric_cond = f" AND RIC IN ({_list(rics)})" if rics else ""
    return f"""last_trade AS (
  SELECT RIC, CAST(Date_Time AS DATE) AS "Date", arg_max(CAST(Price AS DOUBLE), row({order})) AS Price
  FROM ticks WHERE {REGULAR}{where}{ric_cond} GROUP BY RIC, CAST(Date_Time AS DATE))"""


def _aligned(closes_cte, tickers):
    return f"""cal AS (SELECT DISTINCT "Date" FROM {closes_cte} WHERE RIC = '{tickers[0]}'),
grid AS (SELECT "Date", unnest([{_list(tickers)}]) AS RIC FROM cal),
aligned AS (SELECT grid.RIC, grid."Date", c.Price FROM grid LEFT JOIN {closes_cte} c USING (RIC, "Date"))"""


def _returns(closes_cte, tickers):
    k = len(tickers)
    return f"""{_aligned(closes_cte, tickers)},
lr AS (SELECT RIC, "Date", ln(Price / lag(Price) OVER (PARTITION BY RIC ORDER BY "Date")) AS log_return
       FROM aligned),
full_days AS (SELECT "Date" FROM lr GROUP BY "Date" HAVING count(log_return) = {k}),
returns AS (SELECT RIC, "Date", log_return FROM lr
            WHERE log_return IS NOT NULL AND "Date" IN (SELECT "Date" FROM full_days)),
weights AS (SELECT RIC, CAST(1 AS DOUBLE) / {k} AS weight FROM (VALUES {_values(tickers)}) t(RIC))"""


_PORTFOLIO_CHAIN = f"""{TICKS},
{_last_trade(where=f" AND Date_Time BETWEEN '{K.RANGE_FULL[0]}' AND '{K.RANGE_FULL[1]}'", rics=K.PORTFOLIO)},
{_returns("last_trade", K.PORTFOLIO)},
pr AS (SELECT "Date", sum(weight * log_return) AS portfolio_return
       FROM returns JOIN weights USING (RIC) GROUP BY "Date"),
moments AS (SELECT count(portfolio_return) AS n_days, avg(portfolio_return) AS expected_return,
                   stddev_samp(portfolio_return) AS portfolio_std FROM pr)"""

_BRAND_CHAIN = f"""{BRAND_CLOSES},
{_returns("closes", K.BRANDS)}"""


def _lcg_z(i="id"):
    u1 = (f"((CAST(({i} * {LCG_A1} + {LCG_C1}) % {LCG_M1} AS DOUBLE) + 0.5) "
          f"/ CAST({LCG_M1} AS DOUBLE))")
    u2 = f"(CAST(({i} * {LCG_A2} + {LCG_C2}) % {LCG_M2} AS DOUBLE) / CAST({LCG_M2} AS DOUBLE))"
    return f"(sqrt(-2.0 * ln({u1})) * cos(2.0 * pi() * {u2}))"


def _scenario_cte(batches, name="scen"):
    parts = []
    for batch, days in batches:
        parts.append(f"""SELECT '{batch}' AS BATCH, 'LSE' AS VENUE, '{",".join(K.PORTFOLIO)}' AS PORTFOLIO,
         CAST({K.PORTFOLIO_VALUE} AS DOUBLE) AS PORTFOLIO_VALUE,
         TIMESTAMP '{K.START_DATE}' AS START_DATE, TIMESTAMP '{K.END_DATE}' AS END_DATE,
         CAST({days} AS BIGINT) AS DAYS,
         CAST({K.PORTFOLIO_VALUE} AS DOUBLE) * m.expected_return * {days}
           + CAST({K.PORTFOLIO_VALUE} AS DOUBLE) * m.portfolio_std * {_lcg_z('r.id')} * sqrt(CAST({days} AS DOUBLE)) AS RETURN,
         r.id AS SCENARIO_ID
  FROM (SELECT unnest(range(1, count(*) + 1)) AS id FROM events) r CROSS JOIN moments m""")
    return f"{name} AS (\n  " + "\n  UNION ALL\n  ".join(parts) + ")"


SCEN_COLS = ("BATCH, VENUE, PORTFOLIO, PORTFOLIO_VALUE, START_DATE, END_DATE, DAYS, "
             f"round(RETURN, {K.MONEY_DIGITS}) AS RETURN, SCENARIO_ID")


def _var(source, by=""):
    sel = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return (f"SELECT {sel}count(RETURN) AS n, round(-quantile_cont(RETURN, {K.VAR_Q}), {K.MONEY_DIGITS}) AS VaR "
            f"FROM {source}{grp}")


def _histogram():
    b = K.HIST_BINS
    edge = lambda i: f"(CASE WHEN {i} >= {b} THEN hi ELSE CAST({i} AS DOUBLE) * step + lo END)"
    return f"""WITH {_PORTFOLIO_CHAIN},
{_scenario_cte([("B20", K.DAYS)])},
st0 AS (SELECT min(RETURN) AS lo0, max(RETURN) AS hi0, count(RETURN) AS n FROM scen),
st AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
              CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi, n FROM st0),
st2 AS (SELECT lo, hi, n, (hi - lo) / {b} AS step FROM st),
f AS (SELECT RETURN AS x, lo, hi, step, CAST(floor((RETURN - lo) / (hi - lo) * {b}) AS INTEGER) AS f0
      FROM scen CROSS JOIN st2),
i1 AS (SELECT x, lo, hi, step, CASE WHEN f0 >= {b} THEN {b - 1} ELSE f0 END AS i1 FROM f),
i2 AS (SELECT x, lo, hi, step, CASE WHEN x < {edge('i1')} THEN i1 - 1 ELSE i1 END AS i2 FROM i1),
i3 AS (SELECT CASE WHEN x >= {edge('(i2 + 1)')} AND i2 <> {b - 1} THEN i2 + 1 ELSE i2 END AS bin FROM i2),
counts AS (SELECT bin, count(*) AS cnt FROM i3 GROUP BY bin),
bins AS (SELECT CAST(range AS INTEGER) AS bin, lo, hi, step, n FROM range({b}) CROSS JOIN st2),
h AS (SELECT b.bin, {edge('b.bin')} AS bin_start, {edge('(b.bin + 1)')} AS bin_end,
             CAST(coalesce(c.cnt, 0) AS BIGINT) AS count, n
      FROM bins b LEFT JOIN counts c ON c.bin = b.bin)
SELECT bin, round(bin_start, {K.MONEY_DIGITS}) AS bin_start, round(bin_end, {K.MONEY_DIGITS}) AS bin_end, count,
       round(count / (bin_end - bin_start) / n * 1e6, 9) AS density_per_million
FROM h"""


def _stage_inputs():
    return f"""WITH {HISTORY},
done AS (
  SELECT *, date_diff('millisecond', start_time, end_time) AS execution_time_ms,
         list_filter(job_stages, lambda s: s.name = 'S00: Input') AS first_stages
  FROM history WHERE state = 'DONE' AND creation_time >= TIMESTAMP '{K.JOBS_SINCE}'
                 AND NOT contains(query, 'INFORMATION_SCHEMA')),
inputs AS (
  SELECT job_id, creation_time, total_slot_ms, total_bytes_processed, execution_time_ms,
         total_slot_ms / nullif(execution_time_ms, 0) AS speedup,
         unnest(list_transform(first_stages, lambda s: s.records_read)) AS rows_read FROM done)"""


_STATS_COLS = ("job_id, creation_time, total_slot_ms, total_bytes_processed, execution_time_ms, "
               "round(speedup, 10) AS speedup, rows_read")


def _prompt_sql(extra="", rng=K.RANGE_FULL):
    d1, d2 = K.PIVOT_DATES[1].replace("-", "_"), K.PIVOT_DATES[0].replace("-", "_")
    head = ("From the following trading information, make an executive summary comparing vwap, "
            "volume and number of trades over 2 days. Always mention the company legal name based on the RIC:")
    s = lambda c: f"CAST(CAST({c} AS DECIMAL(38,{3 if c.startswith('VWAP') else 0})) AS VARCHAR)"
    prompt = (f"'{head}' || RIC || ' vwap day one:' || {s('VWAP_' + d1)} || ' vwap day 2' || {s('VWAP_' + d2)}"
              f" || ' total trades day one' || {s('NumTrades_' + d1)} || ' trades day 2:' || {s('NumTrades_' + d2)}"
              f" || 'total volume day one: ' || {s('TotalVolume_' + d1)} || ' total volume day 2:' || {s('TotalVolume_' + d2)}")
    return f"""WITH {TICKS},
{_daily(rng=rng)},
{_pivot()},
prompts AS (SELECT {prompt} AS prompt, * FROM pivoted)
SELECT *{extra} FROM prompts"""


_GENERATED = (", 'Summary: ' || prompt AS ml_generate_text_llm_result, "
              "CASE WHEN prompt IS NULL THEN NULL ELSE '{\"blocked\":false}' END AS ml_generate_text_rai_result, "
              "CASE WHEN prompt IS NULL THEN 'empty prompt' ELSE '' END AS ml_generate_text_status")

_GAPPY_CHAIN = f"""{BRAND_CLOSES.replace("closes AS", "all_closes AS", 1)},
closes AS (SELECT RIC, "Date", CASE WHEN NOT (RIC = '{K.BRANDS[0]}' AND day("Date") % 7 = 0) THEN Price END AS Price
           FROM all_closes),
{_returns("closes", K.BRANDS)}"""

_GENERATED_RAW = (""", '{"content": "Summary: ' || prompt || '", "safety": "{\\"blocked\\":false}"}' AS ml_generate_text_result, """
                  "CASE WHEN prompt IS NULL THEN 'empty prompt' ELSE '' END AS ml_generate_text_status")

_MONTHLY_CLOSES = """closes AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS RIC, CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date",
         max(l_extendedprice) AS Price FROM lineitem GROUP BY ALL)"""

_NATION_VARS = f"""WITH {_MONTHLY_CLOSES},
{_aligned("closes", K.SUPPLIERS)},
lr AS (SELECT RIC, "Date", ln(Price / lag(Price) OVER (PARTITION BY RIC ORDER BY "Date")) AS x FROM aligned),
held AS (SELECT n_name AS PORTFOLIO, 'S' || CAST(s_suppkey AS VARCHAR) AS RIC
         FROM supplier JOIN nation ON s_nationkey = n_nationkey
         WHERE 'S' || CAST(s_suppkey AS VARCHAR) IN ({_list(K.SUPPLIERS)})),
sizes AS (SELECT PORTFOLIO, count(*) AS k FROM held GROUP BY PORTFOLIO),
daily AS (SELECT PORTFOLIO, "Date", sum(x / k) AS r FROM held JOIN sizes USING (PORTFOLIO) JOIN lr USING (RIC)
          GROUP BY PORTFOLIO, "Date", k HAVING count(x) = k),
moments AS (SELECT PORTFOLIO, count(r) AS n_days, avg(r) AS mu, stddev_samp(r) AS sd
            FROM sizes LEFT JOIN daily USING (PORTFOLIO) GROUP BY PORTFOLIO),
draws AS (SELECT {_lcg_z("id")} AS z FROM (SELECT unnest(range(1, count(*) + 1)) AS id FROM events)),
gains AS (SELECT PORTFOLIO, CAST({K.PORTFOLIO_VALUE} AS DOUBLE) * mu * {K.DAYS}
            + CAST({K.PORTFOLIO_VALUE} AS DOUBLE) * sd * z * sqrt(CAST({K.DAYS} AS DOUBLE)) AS gain FROM moments CROSS JOIN draws),
vars AS (SELECT PORTFOLIO, count(*) AS n, round(-quantile_cont(gain, {K.VAR_Q}), 3) AS VaR FROM gains GROUP BY PORTFOLIO)
SELECT PORTFOLIO, n_days, round(mu, 10) AS expected_return, round(sd, 10) AS portfolio_std, n, VaR
FROM moments JOIN vars USING (PORTFOLIO)"""

ORACLE = {
    "regular_trades": f"WITH {TICKS} SELECT * FROM ticks WHERE {REGULAR}",
    "trades_half_open": f"""WITH {TICKS} SELECT * FROM ticks WHERE RIC IN ({_list(K.RICS)})
  AND Date_Time >= '2024-01-15 12:00:00' AND Date_Time < '2024-01-16 00:00:00'""",
    "vwap_summary_hour": _summary(K.RANGE_HOUR),
    "vwap_summary_days": _summary(K.RANGE_DAYS),
    "vwap_summary_6m": _summary(K.RANGE_6M),
    "vwap_summary_full": _summary(K.RANGE_FULL),
    "daily_trade_summary": f"WITH {TICKS}, {_daily()} SELECT * FROM daily",
    "symbol_series": f"""WITH {TICKS}, {_daily('"Date"')}
SELECT * FROM daily WHERE RIC = 'BBB.L' ORDER BY "Date" """,
    "vwap_pivot": f"WITH {TICKS}, {_daily()}, {_pivot()} SELECT * FROM pivoted",
    "vwap_pivot_native": f"WITH {TICKS}, {_daily()}, {_pivot()} SELECT * FROM pivoted",
    **{name: _bars(*spec) for name, spec in K.BARS.items()},
    **{f"{name}_streamed": _bars(*K.BARS[name]) for name in ("bid_bars_minute", "bid_bars_day", "bid_bars_hour")},
    "bid_bars_preview": _bars(*K.BARS["bid_bars_minute"], preview=K.BAR_PREVIEW),
    "daily_close": f"""WITH {TICKS},
{_last_trade(where=f" AND Date_Time BETWEEN '{K.RANGE_FULL[0]}' AND '{K.RANGE_FULL[1]}'", rics=K.PORTFOLIO)}
SELECT * FROM last_trade""",
    "daily_close_ties": f"""WITH {BIG_TICKS},
{_last_trade(order="Date_Time, Seq, l_linenumber, l_partkey, l_suppkey")}
SELECT * FROM last_trade""",
    "vwap_yearly": f"""WITH {BIG_TICKS}
SELECT RIC, CAST(year(Date_Time) AS INTEGER) AS year, round(sum(Volume * Price) / nullif(sum(Volume), 0), 3) AS VWAP,
       round(avg(Price), 3) AS TWAP, CAST(sum(Volume) AS BIGINT) AS TotalVolume, count(RIC) AS NumTrades
FROM ticks WHERE {REGULAR} GROUP BY RIC, CAST(year(Date_Time) AS INTEGER) ORDER BY RIC, year""",
    "aligned_closes": f"WITH {BRAND_CLOSES}, {_aligned('closes', K.BRANDS)} SELECT RIC, \"Date\", Price FROM aligned",
    "aligned_closes_nulls": f"WITH {_GAPPY_CHAIN} SELECT RIC, \"Date\", Price FROM aligned",
    "log_returns_nulls": f"WITH {_GAPPY_CHAIN} SELECT RIC, \"Date\", round(log_return, 12) AS log_return FROM returns",
    "covariance_wide": f"""WITH closes AS (
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS RIC, CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date",
         max(l_extendedprice) AS Price FROM lineitem GROUP BY ALL),
{_aligned("closes", K.SUPPLIERS)},
lr AS (SELECT RIC, "Date", ln(Price / lag(Price) OVER (PARTITION BY RIC ORDER BY "Date")) AS x FROM aligned),
p AS (SELECT a.RIC AS RIC_i, b.RIC AS RIC_j, covar_samp(a.x, b.x) AS c
      FROM lr a JOIN lr b USING ("Date") GROUP BY a.RIC, b.RIC),
k AS (SELECT unnest([{_list(K.SUPPLIERS)}]) AS RIC)
SELECT a.RIC AS RIC_i, b.RIC AS RIC_j, round(p.c, 9) AS covariance
FROM k a CROSS JOIN k b LEFT JOIN p ON p.RIC_i = a.RIC AND p.RIC_j = b.RIC""",
    "brand_var": f"""WITH {BRAND_CLOSES},
lr AS (SELECT RIC, ln(Price / lag(Price) OVER (PARTITION BY RIC ORDER BY "Date")) AS x FROM closes)
SELECT RIC, count(x) AS n, round(-quantile_cont(x, {K.VAR_Q}), 10) AS VaR FROM lr GROUP BY RIC HAVING count(x) > 0""",
    "price_quantile": f"""WITH {BIG_TICKS}
SELECT count(Price) AS n, round(-quantile_cont(Price, {K.VAR_Q}), 10) AS VaR FROM ticks""",
    "var_job": f"""WITH {_PORTFOLIO_CHAIN}, {_scenario_cte([('B20', K.DAYS)])},
v AS ({_var('scen')}),
s AS (SELECT BATCH, count(*) AS stored, count(DISTINCT SCENARIO_ID) AS ids FROM scen GROUP BY BATCH)
SELECT s.*, v.*, round(m.expected_return, 10) AS mu, round(m.portfolio_std, 10) AS sigma FROM s, v, moments m""",
    "daily_summary_by_folder": f"WITH {TICKS}, {_daily(rng=K.RANGE_DAYS)} SELECT * FROM daily",
    "report_job": _prompt_sql(_GENERATED, K.RANGE_DAYS),
    "message_ingest_late": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte([('B20', K.DAYS), (K.LATE_BATCH, K.DAYS)])} "
                           f"SELECT {SCEN_COLS} FROM scen",
    "log_returns": f"WITH {_BRAND_CHAIN} SELECT RIC, \"Date\", round(log_return, 12) AS log_return FROM returns",
    "expected_return": f"""WITH {_BRAND_CHAIN},
means AS (SELECT RIC, avg(log_return) AS mean_return FROM returns GROUP BY RIC)
SELECT round(sum(mean_return * weight), 10) AS expected_return FROM means JOIN weights USING (RIC)""",
    "covariance": f"""WITH {_BRAND_CHAIN},
p AS (SELECT a.RIC AS RIC_i, b.RIC AS RIC_j, a.log_return AS x, b.log_return AS y
      FROM returns a JOIN returns b ON a."Date" = b."Date"),
ricpairs AS (SELECT a.RIC AS RIC_i, b.RIC AS RIC_j FROM weights a CROSS JOIN weights b)
SELECT r.RIC_i, r.RIC_j, round(covar_samp(p.x, p.y), 12) AS covariance
FROM ricpairs r LEFT JOIN p ON p.RIC_i = r.RIC_i AND p.RIC_j = r.RIC_j GROUP BY r.RIC_i, r.RIC_j""",
    "portfolio_std": f"""WITH {_BRAND_CHAIN},
p AS (SELECT a.RIC AS RIC_i, b.RIC AS RIC_j, covar_samp(a.log_return, b.log_return) AS c
      FROM returns a JOIN returns b ON a."Date" = b."Date" GROUP BY a.RIC, b.RIC)
SELECT round(sqrt(sum(wi.weight * wj.weight * c)), 10) AS portfolio_std
FROM p JOIN weights wi ON wi.RIC = p.RIC_i JOIN weights wj ON wj.RIC = p.RIC_j""",
    "portfolio_moments": f"""WITH {_PORTFOLIO_CHAIN}
SELECT n_days, round(expected_return, 10) AS expected_return, round(portfolio_std, 10) AS portfolio_std
FROM moments""",
    "cagr": f"""WITH {BRAND_CLOSES},
g AS (SELECT RIC, arg_min(Price, "Date") AS first_price, arg_max(Price, "Date") AS last_price,
             min("Date") AS first_date, max("Date") AS last_date FROM closes GROUP BY RIC)
SELECT RIC, first_date, last_date,
       round(CASE WHEN last_date - first_date > 0
             THEN pow(last_price / first_price, 365.0 / (last_date - first_date)) - 1 END, 10) AS cagr
FROM g""",
    "normalized_return": f"""WITH {BRAND_CLOSES}
SELECT RIC, "Date", Price,
       Price / first_value(Price) OVER (PARTITION BY RIC ORDER BY "Date"
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS normalized
FROM closes""",
    "scenarios": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte([('B20', K.DAYS)])} SELECT {SCEN_COLS} FROM scen",
    "value_at_risk": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte([('B20', K.DAYS)])} {_var('scen')}",
    "var_histogram": _histogram(),
    "var_by_batch": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte(K.STORE_BATCHES)} {_var('scen', 'BATCH')}",
    "scenario_csv_roundtrip": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte(K.STORE_BATCHES)} SELECT {SCEN_COLS} FROM scen",
    "scenario_messages": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte([('B20', K.DAYS)])} SELECT {SCEN_COLS} FROM scen",
    "message_ingest": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte(K.STORE_BATCHES)} SELECT {SCEN_COLS} FROM scen",
    "stream_var": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte(K.STORE_BATCHES)} {_var('scen', 'BATCH')}",
    "stream_var_incremental": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte(K.STORE_BATCHES)} {_var('scen', 'BATCH')}",
    "store_compaction": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte(K.STORE_BATCHES)} SELECT {SCEN_COLS} FROM scen",
    "job_stage_inputs": f"{_stage_inputs()} SELECT {_STATS_COLS} FROM inputs",
    "job_stats": f"{_stage_inputs()} SELECT {_STATS_COLS} FROM inputs ORDER BY creation_time DESC, job_id DESC LIMIT 4",
    "job_stats_latest": f"{_stage_inputs()} SELECT {_STATS_COLS} FROM inputs ORDER BY creation_time DESC, job_id DESC LIMIT 1",
    "job_scale_summary": f"""{_stage_inputs()},
top AS (SELECT * FROM inputs ORDER BY creation_time DESC, job_id DESC LIMIT 4)
SELECT job_id, round(rows_read / 1e9, 12) AS rows_billions,
       round(total_slot_ms / 1000.0 / 3600.0, 12) AS slot_hours,
       round(execution_time_ms / 1000.0, 12) AS wall_seconds FROM top""",
    "report_prompt": _prompt_sql(),
    "report_text": _prompt_sql(_GENERATED),
    "report_text_sql": _prompt_sql(_GENERATED),
    "report_text_raw": _prompt_sql(_GENERATED_RAW),
    "portfolio_vars": _NATION_VARS,
    "message_ingest_redelivered": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte(K.STORE_BATCHES)} SELECT {SCEN_COLS} FROM scen",
    "scenario_load_ledger": f"WITH {_PORTFOLIO_CHAIN}, {_scenario_cte(K.STORE_BATCHES)} SELECT {SCEN_COLS} FROM scen",
    "publish_outcomes": f"""WITH {_PORTFOLIO_CHAIN}, {_scenario_cte([('B20', K.DAYS)])}
SELECT BATCH || '/' || SCENARIO_ID AS KEY, 'published' AS STATUS, round(RETURN, {K.MONEY_DIGITS}) AS RETURN FROM scen""",
    "sample_publish": """SELECT '1234' AS BATCH, count(*) AS messages, count(*) AS returns,
CAST(count(*) - 1 AS DOUBLE) AS last, count(*) AS published FROM events""",
}
ORACLE["covariance_by_load"] = ORACLE["covariance"]
