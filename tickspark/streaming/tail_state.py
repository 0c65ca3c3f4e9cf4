"""Keyed state of the running VaR: which scenarios were seen, and the exact lower tail of their gains.

A batch's scenarios are dealt to ``SHARDS`` keys by blocks of ``BLOCK`` ids, so a
batch with most of the rows is many keys.  Per key, on RocksDB:

* ``seen``: a bitmap of ``BLOCK`` bits per block of ids - a bit per scenario where
  ids are dense (as ``scenarios`` numbers them), at worst ``BLOCK / 8`` bytes;
* ``texts``: a hash per scenario without an id (two such are the same scenario if
  all their values are);
* ``tail``: the smallest gains with their multiplicity, up to ``SLACK`` times the
  wanted rank and at least ``FLOOR`` of them; ``n``, the number of all gains; and
  ``cut``, up to which (inclusive) no gain is missing.  What lies above the cut is
  only counted: it is in the store.

So a key's state is about ``n / 8 + 16 * SLACK * q * n`` bytes, and a redelivered
scenario, however late, changes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickspark.schemas import SCENARIO_COLUMNS, SCENARIO_RESULT
from tickspark.streaming.ingest import batch_key

SHARDS = 16
BLOCK = 4096
SLACK = 2.0
FLOOR = 1000
#: Blocks a task holds, and gains it gathers, before they go to the state: fewer calls of it, bounded memory.
BLOCKS_HELD = 1024
GAINS_HELD = 100_000

#: Names of a scenario's columns in its text.
_SHORT = [f"c{i}" for i in range(len(SCENARIO_COLUMNS))]
#: A new scenario (``ROW`` set: its JSON text), or a key's summary after a micro-batch (``ROW`` null).
OUT = T.StructType([
    T.StructField("KEY", T.StringType()), T.StructField("SHARD", T.IntegerType()), T.StructField("ROW", T.StringType()),
    T.StructField("N", T.LongType()), T.StructField("CUT", T.DoubleType()),
    T.StructField("XS", T.ArrayType(T.DoubleType())), T.StructField("CS", T.ArrayType(T.LongType()))])


def batch_of(key: Column) -> Column:
    return F.when(key != "null", F.substring(key, 2, 1 << 30))


def keyed(results: DataFrame) -> DataFrame:
    """Scenario rows as the processor takes them: no nulls, exact ids, the row itself as one text (short names in it)."""
    rid = F.col("SCENARIO_ID")
    values = [F.unix_micros(c) if c in ("START_DATE", "END_DATE") else F.col(c) for c in SCENARIO_COLUMNS]
    whole = F.to_json(F.struct(*[v.alias(c) for v, c in zip(values, SCENARIO_COLUMNS)]))
    row = F.to_json(F.struct(*[v.alias(c) for v, c in zip(values, _SHORT)]))
    rows = results.select(*SCENARIO_COLUMNS, row.alias("ROW"), F.when(rid.isNull(), whole).alias("WHOLE"))
    text = F.when(rid.isNull(), F.sha2("WHOLE", 256)).otherwise(F.lit(""))
    shard = F.when(rid.isNull(), F.xxhash64("WHOLE")).otherwise(F.floor(rid / BLOCK))
    return rows.select(
        batch_key(F.col("BATCH")).alias("KEY"), F.pmod(shard, F.lit(SHARDS)).cast("int").alias("SHARD"),
        text.alias("TEXT"), F.coalesce(rid, F.lit(0)).alias("ID"), F.col("RETURN").isNotNull().alias("COUNTS"),
        F.coalesce("RETURN", F.lit(0.0)).alias("X"), "ROW")


def unkeyed(out: DataFrame) -> DataFrame:
    """The new scenarios among the processor's rows, as result-table columns."""
    types = {f.name: f.dataType for f in SCENARIO_RESULT.fields}
    schema = T.StructType([T.StructField(short, T.LongType() if isinstance(types[c], T.TimestampType) else types[c])
                           for c, short in zip(SCENARIO_COLUMNS, _SHORT)])
    m = F.from_json("ROW", schema)
    return out.where("ROW is not null").select(m.alias("m")).select(*[
        (F.timestamp_micros(F.col(f"m.{s}")) if c in ("START_DATE", "END_DATE") else F.col(f"m.{s}")).alias(c)
        for c, s in zip(SCENARIO_COLUMNS, _SHORT)])


class TailProcessor(StatefulProcessor):
    """Passes each scenario on the first time it is seen and keeps the lower tail of the gains."""

    def __init__(self, q: float, slack: float = SLACK, floor: int = FLOOR):
        self.q, self.slack, self.floor = q, slack, floor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "block bigint", "bits binary")
        self.texts = handle.getMapState("texts", "text string", "there boolean")
        self.tail = handle.getValueState("tail", "n bigint, cut double, xs binary, cs binary")

    def _unseen(self, rows: pd.DataFrame, held: dict[int, np.ndarray], changed: set[int]) -> np.ndarray:
        """Which rows are new; marks them as seen, in the blocks ``held`` (those ``changed`` are not yet in the state)."""
        text, ids = rows["TEXT"].to_numpy(object), rows["ID"].to_numpy(np.int64)
        new = np.zeros(len(rows), bool)
        by_id = np.flatnonzero(text == "")
        first = by_id[np.unique(ids[by_id], return_index=True)[1]]
        blocks = ids[first] // BLOCK
        for block in np.unique(blocks):
            at = first[blocks == block]
            places = ids[at] - block * BLOCK
            block = int(block)
            if block not in held:
                if len(held) >= BLOCKS_HELD:
                    self._keep(held, changed)
                kept = self.seen.getValue((block,)) if self.seen.containsKey((block,)) else None
                held[block] = np.unpackbits(np.frombuffer(kept[0], np.uint8)) if kept is not None else np.zeros(BLOCK, np.uint8)
            bits = held[block]
            fresh = bits[places] == 0
            if fresh.any():
                new[at[fresh]] = True
                bits[places] = 1
                changed.add(block)
        for i in np.flatnonzero(text != ""):
            key = (text[i],)
            if not self.texts.containsKey(key):
                self.texts.updateValue(key, (True,))
                new[i] = True
        return new

    def _keep(self, held: dict[int, np.ndarray], changed: set[int]) -> None:
        for block in changed:
            self.seen.updateValue((block,), (np.packbits(held[block]).tobytes(),))
        held.clear()
        changed.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        name, shard = key
        n, cut, xs, cs = 0, None, np.zeros(0), np.zeros(0, np.int64)
        if self.tail.exists():
            n, cut, held_x, held_c = self.tail.get()
            xs, cs = np.frombuffer(held_x), np.frombuffer(held_c, np.int64)
        held: dict[int, np.ndarray] = {}
        changed: set[int] = set()
        gains: list[np.ndarray] = []
        for part in rows:
            new = self._unseen(part, held, changed)
            if not new.any():
                continue
            yield self._rows(name, shard, ROW=part["ROW"].to_numpy(object)[new])
            gains.append(part["X"].to_numpy(np.float64)[new & part["COUNTS"].to_numpy(bool)])
            if sum(map(len, gains)) >= GAINS_HELD:
                n, cut, xs, cs = self._added(n, cut, xs, cs, np.concatenate(gains))
                gains = []
        if gains:
            n, cut, xs, cs = self._added(n, cut, xs, cs, np.concatenate(gains))
        self._keep(held, changed)
        self.tail.update((int(n), cut, xs.tobytes(), cs.tobytes()))
        yield self._rows(name, shard, N=[int(n)], CUT=[cut], XS=[xs], CS=[cs])

    def _added(self, n: int, cut: float | None, xs: np.ndarray, cs: np.ndarray, x: np.ndarray):
        """The tail with the gains ``x``: merged by value, cut where it is longer than wanted."""
        n += len(x)
        numbers = x[~np.isnan(x)]
        if len(numbers) < len(x) and cut is None:
            cut = math.inf                      # NaN is the largest: counted only
        if cut is not None:
            numbers = numbers[numbers <= cut]
        if len(numbers):
            all_x, at = np.unique(np.concatenate([xs, numbers]), return_inverse=True)
            all_c = np.zeros(len(all_x), np.int64)
            np.add.at(all_c, at, np.concatenate([cs, np.ones(len(numbers), np.int64)]))
            xs, cs = all_x, all_c
        # values beyond the wanted rank leave, whole values only, so that nothing up to the cut is missing
        wanted = max(self.floor, math.ceil(self.q * n * self.slack))
        keep = int(np.searchsorted(np.cumsum(cs), wanted)) + 1
        if keep < len(xs):
            xs, cs, cut = xs[:keep], cs[:keep], float(xs[keep - 1])
        return n, cut, xs, cs

    @staticmethod
    def _rows(name: str, shard: int, **columns) -> pd.DataFrame:
        size = len(next(iter(columns.values())))
        return pd.DataFrame({f.name: columns.get(f.name, [None] * size) for f in OUT.fields} |
                            {"KEY": [name] * size, "SHARD": [shard] * size})

    def close(self) -> None:
        pass
