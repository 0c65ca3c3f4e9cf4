"""Report text from the day-over-day pivot, and batch text generation.

Generation runs in ``mapInPandas``, or in a table function of SQL: one client
per task, created from an injected factory, called with batches of prompts.  No model is bundled; tests
and the registered query use the deterministic ``EchoClient``.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, udtf

# The prompt's wording and the generation result columns.
PROMPT_HEAD = ("From the following trading information, make an executive summary comparing vwap, "
               "volume and number of trades over 2 days. Always mention the company legal name based on the RIC:")
PROMPT_PARTS = [
    (" vwap day one:", "VWAP", 1),
    (" vwap day 2", "VWAP", 2),
    (" total trades day one", "NumTrades", 1),
    (" trades day 2:", "NumTrades", 2),
    ("total volume day one: ", "TotalVolume", 1),
    (" total volume day 2:", "TotalVolume", 2),
]
LLM_RESULT = "ml_generate_text_llm_result"
RAI_RESULT = "ml_generate_text_rai_result"
STATUS = "ml_generate_text_status"
RAW_RESULT = "ml_generate_text_result"


def _sfx(d) -> str:
    return str(d).replace("-", "_")


def report_prompt(pivoted: DataFrame, day_one, day_two) -> DataFrame:
    """``prompt`` column built from a pivot row; null when any part is null.

    Prices print as decimals with three digits, never in exponent form."""
    d1, d2 = _sfx(day_one), _sfx(day_two)
    number = {"VWAP": "decimal(38,3)", "NumTrades": "decimal(38,0)", "TotalVolume": "decimal(38,0)"}
    parts = [F.lit(PROMPT_HEAD), F.col("RIC")]
    for words, measure, day in PROMPT_PARTS:
        parts += [F.lit(words), F.col(f"{measure}_{d1 if day == 1 else d2}").cast(number[measure]).cast("string")]
    return pivoted.select(F.concat(*parts).alias("prompt"), *[F.col(c) for c in pivoted.columns])


class EchoClient:
    """Deterministic stand-in for a text model (no network)."""

    def __init__(self, temperature: float = 0.2, max_output_tokens: int = 800):
        self.temperature = temperature
        self.max_output_tokens = max_output_tokens

    def generate(self, prompts: list) -> list[dict]:
        out = []
        for p in prompts:
            if p is None:
                out.append({"text": None, "safety": None, "status": "empty prompt"})
            else:
                out.append({"text": "Summary: " + p, "safety": '{"blocked":false}', "status": ""})
        return out


def _added_fields(flatten_json_output: bool) -> list[T.StructField]:
    names = [LLM_RESULT, RAI_RESULT, STATUS] if flatten_json_output else [RAW_RESULT, STATUS]
    return [T.StructField(n, T.StringType()) for n in names]


def _generated(client, prompts: list, flatten_json_output: bool, batch_size: int) -> list[tuple]:
    """The added columns' values for each prompt.  A failed call gives its prompts nulls and the error as status."""
    found = []
    for i in range(0, len(prompts), batch_size):
        chunk = prompts[i:i + batch_size]
        try:
            found.extend(client.generate(chunk))
        except Exception as exc:  # noqa: BLE001 - reported per row, like a status column
            found.extend({"text": None, "safety": None, "status": f"error: {exc}"} for _ in chunk)
    if flatten_json_output:
        return [(r.get("text"), r.get("safety"), r.get("status", "")) for r in found]
    return [(None if r.get("text") is None else json.dumps({"content": r.get("text"), "safety": r.get("safety")}),
             r.get("status", "")) for r in found]


def generate_text(df: DataFrame, client_factory: Callable[..., object], prompt_col: str = "prompt",
                  temperature: float = 0.2, max_output_tokens: int = 800,
                  flatten_json_output: bool = True, batch_size: int = 64) -> DataFrame:
    """Append model output to every row.

    ``client_factory(temperature=..., max_output_tokens=...)`` must return an
    object with ``generate(list[str | None]) -> list[dict(text, safety, status)]``.
    Flattened output adds ``ml_generate_text_llm_result``,
    ``ml_generate_text_rai_result`` and ``ml_generate_text_status``; otherwise
    one JSON column ``ml_generate_text_result`` plus the status.  The
    client is called with at most ``batch_size`` prompts at a time.  A
    failed call does not fail the task: its rows get null results and the
    error text in the status column.
    """
    added = _added_fields(flatten_json_output)
    schema = T.StructType(df.schema.fields + added)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = client_factory(temperature=temperature, max_output_tokens=max_output_tokens)
        for pdf in batches:
            prompts = [None if pd.isna(p) else p for p in pdf[prompt_col].tolist()]
            rows = _generated(client, prompts, flatten_json_output, batch_size)
            out = pdf.copy()
            for i, field in enumerate(added):
                out[field.name] = [r[i] for r in rows]
            yield out

    return df.mapInPandas(run, schema)


@dataclass
class _Generation(AnalyzeResult):
    """What ``analyze`` hands to the workers besides the schema."""

    prompt: str = "prompt"
    temperature: float = 0.2
    max_output_tokens: int = 800
    flatten_json_output: bool = True


def register_generate_text(spark: SparkSession, client_factory: Callable[..., object], name: str = "generate_text",
                           batch_size: int = 64) -> None:
    """Make text generation callable from SQL, as a table function over any query:

    ``SELECT * FROM generate_text(TABLE(SELECT ...), temperature => 0.2, max_output_tokens => 800,
    flatten_json_output => true, prompt_col => 'prompt')``

    The rows' columns come first, then those of ``generate_text``; the options are constants and may be left out.
    Rows stay in their partitions; each task has one client and gathers ``batch_size`` prompts for a call.
    """
    class GenerateText:
        @staticmethod
        def analyze(rows: AnalyzeArgument, temperature: AnalyzeArgument | None = None,
                    max_output_tokens: AnalyzeArgument | None = None, flatten_json_output: AnalyzeArgument | None = None,
                    prompt_col: AnalyzeArgument | None = None) -> AnalyzeResult:
            if not rows.isTable:
                raise ValueError(f"{name}: the first argument is TABLE(...)")

            def constant(option: str, arg: AnalyzeArgument | None, default):
                if arg is None:
                    return default
                if not arg.isConstantExpression or arg.value is None:
                    raise ValueError(f"{name}: {option} has to be a constant")
                return type(default)(arg.value)

            flat = constant("flatten_json_output", flatten_json_output, True)
            prompt = constant("prompt_col", prompt_col, "prompt")
            if prompt not in rows.dataType.names:
                raise ValueError(f"{name}: the table has no column {prompt}")
            return _Generation(
                schema=T.StructType(rows.dataType.fields + _added_fields(flat)), prompt=prompt,
                temperature=constant("temperature", temperature, 0.2),
                max_output_tokens=constant("max_output_tokens", max_output_tokens, 800), flatten_json_output=flat)

        def __init__(self, plan: _Generation):
            self.plan, self.rows = plan, []
            self.client = client_factory(temperature=plan.temperature, max_output_tokens=plan.max_output_tokens)

        def eval(self, row: Row, temperature=None, max_output_tokens=None, flatten_json_output=None, prompt_col=None):
            self.rows.append(row)
            if len(self.rows) == batch_size:
                yield from self._flushed()

        def terminate(self):
            yield from self._flushed()

        def _flushed(self):
            rows, self.rows = self.rows, []
            added = _generated(self.client, [r[self.plan.prompt] for r in rows], self.plan.flatten_json_output, batch_size)
            for row, values in zip(rows, added):
                yield (*row, *values)

    spark.udtf.register(name, udtf(GenerateText, useArrow=True))
