"""The day-over-day report job: trades -> daily summary -> pivot view ->
prompt per instrument -> generated summary -> stored rows.

Everything up to the prompt is a Spark plan over the tick table; the
generation step is ``mapInPandas`` with one client per task.  The pivot
is registered as a view so SQL users can read it too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tickspark.operators.report import generate_text, report_prompt
from tickspark.operators.summary import daily_trade_summary, pivot_by_date
from tickspark.sources.tables import register_view


@dataclass
class ReportRun:
    daily: DataFrame
    pivoted: DataFrame
    prompts: DataFrame
    generated: DataFrame


def run_report(ticks: DataFrame, rics: Sequence[str], start: str, end: str, day_one: str, day_two: str,
               client_factory: Callable[..., object], view_name: str = "pivoted_by_ric",
               temperature: float = 0.2, max_output_tokens: int = 800, out: str | None = None,
               mode: str = "append", trade_date_col: str | None = None) -> ReportRun:
    """Build the report for ``rics`` over ``[start, end]`` comparing
    ``day_one`` with ``day_two``; write the generated rows to ``out``
    (Parquet) when given.  ``trade_date_col`` names the ticks' day column,
    so only the range's day partitions are read."""
    daily = daily_trade_summary(ticks, start, end, rics=rics, trade_date_col=trade_date_col)
    pivoted = register_view(pivot_by_date(daily, [day_two, day_one]), view_name)
    prompts = report_prompt(pivoted, day_one, day_two)
    generated = generate_text(prompts, client_factory, temperature=temperature,
                              max_output_tokens=max_output_tokens)
    if out is not None:
        generated.write.mode(mode).parquet(out)
    return ReportRun(daily, pivoted, prompts, generated)
