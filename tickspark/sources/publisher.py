"""Publishing messages with a result for each: a Python data source over an injected topic client.

A client's ``publish(messages)`` takes ``(key, text)`` pairs and returns a future
per message, which resolves to the topic's message id.  Tasks publish their rows
in chunks, wait for every future up to a time-out, and write the outcomes of a
chunk as one Parquet file into the run's folder before they go on; a message
that timed out or failed is an outcome, not a failed task.  The commit stores
the run's counts (``_committed.json``); the driver sees no message and no outcome.

A retried task first reads what its earlier attempts have written and publishes
none of the acknowledged messages again.  Messages of a chunk that was published
but not yet written carry the same keys when they are sent again, so a topic that
drops repeated keys (``FileTopic`` does, by the name of the chunk's file) holds them
once.  A key is the ``key`` column, or else the text's hash and how many equal texts
the task had before.

``outcomes`` is a folder that ``pyarrow.fs`` can open from every task, on the same
shared storage as the checkpoints.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from concurrent.futures import Future
from concurrent.futures import TimeoutError as FutureTimeout
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

FORMAT = "acknowledged_topic"
PUBLISHED, TIMED_OUT, FAILED = "published", "timed out", "failed"
#: Seconds a message may take, and messages in flight in a task.
TIMEOUT = 60.0
CHUNK = 5000

_FILE = pa.schema([("PART", pa.int32()), ("ATTEMPT", pa.int32()), ("KEY", pa.string()), ("STATUS", pa.string()),
                   ("MESSAGE_ID", pa.string()), ("DETAIL", pa.string())])
OUTCOME = T.StructType([T.StructField("RUN", T.StringType()), T.StructField("PART", T.IntegerType()),
                        T.StructField("KEY", T.StringType()), T.StructField("STATUS", T.StringType()),
                        T.StructField("MESSAGE_ID", T.StringType()), T.StructField("DETAIL", T.StringType())])


def _opened(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class FileTopic:
    """A topic of text files, one message per line, as ``message_stream`` reads them.

    A chunk's file is named by its keys, so publishing the same chunk again
    replaces it.  Messages over ``max_bytes`` are refused.
    """

    def __init__(self, path: str, max_bytes: int = 10_000_000):
        self.path, self.max_bytes = path, max_bytes

    def publish(self, messages: list[tuple[str, str]]) -> list[Future]:
        fs, root = _opened(self.path)
        name = f"{hashlib.sha256(chr(10).join(k for k, _ in messages).encode()).hexdigest()[:32]}.txt"
        futures, lines = [], []
        for _, text in messages:
            f: Future = Future()
            line = text.encode()
            if len(line) > self.max_bytes or b"\n" in line:
                f.set_exception(ValueError("message refused: too long or more than a line"))
            else:
                lines.append(line)
                f.set_result(f"{name}:{len(lines)}")
            futures.append(f)
        if lines:
            fs.create_dir(root, recursive=True)
            with fs.open_output_stream(f"{root}/.{name}") as out:
                out.write(b"\n".join(lines) + b"\n")
            fs.move(f"{root}/.{name}", f"{root}/{name}")
        return futures


@dataclass
class Counted(WriterCommitMessage):
    part: int
    counts: dict[str, int]


class _Publishing:
    """What the batch and the streaming writer share."""

    def __init__(self, client_factory: Callable[[], object], options: dict):
        self.factory = client_factory
        self.outcomes, self.run = options["outcomes"].rstrip("/"), options["run"]
        self.timeout, self.chunk = float(options.get("timeout", TIMEOUT)), int(options.get("chunk", CHUNK))

    def folder(self, epoch: str | int | None) -> str:
        return f"{self.outcomes}/RUN={self.run}" + ("" if epoch is None else f"-{epoch}")

    def _before(self, fs: pafs.FileSystem, root: str, part: int) -> tuple[set[str], int]:
        """Keys that earlier attempts of this part have published, and how many messages they tell of."""
        files = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        mine = [f.path for f in files if f.base_name.startswith(f"part-{part:06d}-")]
        tables = [pq.read_table(p, columns=["KEY", "STATUS"], filesystem=fs) for p in mine]
        return {k for t in tables for k, s in zip(t["KEY"].to_pylist(), t["STATUS"].to_pylist()) if s == PUBLISHED}, len(mine)

    def published(self, batches: Iterator[pa.RecordBatch], epoch: str | None) -> Counted:
        task = TaskContext.get()
        part, attempt = task.partitionId(), task.attemptNumber()
        fs, root = _opened(self.folder(epoch))
        done, _ = self._before(fs, root, part)
        fs.create_dir(root, recursive=True)
        client, counts, seen = self.factory(), Counter(), Counter()
        for number, messages in enumerate(self._chunks(batches, seen)):
            rest = [m for m in messages if m[0] not in done]
            counts[PUBLISHED] += len(messages) - len(rest)
            if rest:
                rows = self._outcomes(client, rest)
                counts.update(status for _, status, _, _ in rows)
                columns = [[part] * len(rows), [attempt] * len(rows), *map(list, zip(*rows))]
                name = f"part-{part:06d}-{attempt:04d}-{number:08d}-{task.taskAttemptId()}.parquet"
                pq.write_table(pa.table([pa.array(c, t.type) for c, t in zip(columns, _FILE)], schema=_FILE), f"{root}/.{name}",
                               filesystem=fs)
                fs.move(f"{root}/.{name}", f"{root}/{name}")
        return Counted(part, dict(counts))

    def _chunks(self, batches: Iterator[pa.RecordBatch], seen: Counter) -> Iterator[list[tuple[str, str]]]:
        chunk: list[tuple[str, str]] = []
        for b in batches:
            texts = b.column(b.schema.get_field_index("value")).to_pylist()
            keys = b.column(b.schema.get_field_index("key")).to_pylist() if "key" in b.schema.names else [None] * len(texts)
            for key, text in zip(keys, texts):
                if text is None:
                    continue
                if key is None:
                    digest = hashlib.sha256(text.encode()).hexdigest()
                    key = f"{digest}#{seen[digest]}"
                    seen[digest] += 1
                chunk.append((key, text))
                if len(chunk) == self.chunk:
                    yield chunk
                    chunk = []
        if chunk:
            yield chunk

    def _outcomes(self, client, messages: list[tuple[str, str]]) -> list[tuple]:
        try:
            futures = client.publish(messages)
        except Exception as exc:  # noqa: BLE001 - an outcome of every message of the chunk
            return [(key, FAILED, None, str(exc)) for key, _ in messages]
        rows = []
        for (key, _), f in zip(messages, futures):
            try:
                rows.append((key, PUBLISHED, str(f.result(timeout=self.timeout)), None))
            except (FutureTimeout, TimeoutError):
                rows.append((key, TIMED_OUT, None, f"no answer in {self.timeout:g} s"))
            except Exception as exc:  # noqa: BLE001 - reported per message
                rows.append((key, FAILED, None, str(exc)))
        return rows

    def committed(self, messages: list, epoch: str | int | None) -> None:
        counts: Counter = Counter()
        for m in messages:
            counts.update(m.counts if m is not None else {})
        fs, root = _opened(self.folder(epoch))
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/_committed.json") as out:
            out.write(json.dumps({"parts": sum(m is not None for m in messages), "counts": dict(counts)}).encode())


class _Writer(DataSourceArrowWriter):
    def __init__(self, work: _Publishing):
        self.work = work

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return self.work.published(iterator, None)

    def commit(self, messages: list) -> None:
        self.work.committed(messages, None)

    def abort(self, messages: list) -> None:
        """Nothing to undo: what was published stays so, and the outcome files tell of it."""


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, work: _Publishing):
        self.work = work

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        # the micro-batch's number: when it runs again it finds its own outcomes
        return self.work.published(iterator, TaskContext.get().getLocalProperty("streaming.sql.batchId"))

    def commit(self, messages: list, batchId: int) -> None:
        self.work.committed(messages, batchId)

    def abort(self, messages: list, batchId: int) -> None:
        """Nothing to undo, as in ``_Writer``."""


def topic_source(client_factory: Callable[[], object]) -> type[DataSource]:
    """The data source (format ``acknowledged_topic``) that publishes through clients of ``client_factory``."""
    class AcknowledgedTopic(DataSource):
        @classmethod
        def name(cls) -> str:
            return FORMAT

        def writer(self, schema, overwrite: bool):
            return _Writer(_Publishing(client_factory, dict(self.options)))

        def streamWriter(self, schema, overwrite: bool):
            return _StreamWriter(_Publishing(client_factory, dict(self.options)))

    return AcknowledgedTopic


def publish(messages: DataFrame, client_factory: Callable[[], object], outcomes: str, run: str | None = None,
            timeout: float = TIMEOUT, chunk: int = CHUNK) -> str:
    """Publish ``value`` (with ``key`` where there is one) of every row and return the run's name, under which
    ``read_outcomes`` finds a row per message.  A null value is no message.  Giving the ``run`` of a publication
    that failed half-way resumes it, as far as rows are dealt to partitions as before."""
    run = run or uuid.uuid4().hex
    messages.sparkSession.dataSource.register(topic_source(client_factory))
    columns = [c for c in ("key", "value") if c in messages.columns]
    (messages.select(*columns).write.format(FORMAT).options(outcomes=outcomes, run=run, timeout=timeout, chunk=chunk)
        .mode("append").save())
    return run


def publish_stream(messages: DataFrame, client_factory: Callable[[], object], outcomes: str, run: str, checkpoint: str,
                   timeout: float = TIMEOUT, chunk: int = CHUNK, available_now: bool = True,
                   processing_time: str | None = None):
    """The same for a stream; a micro-batch is the run ``<run>-<number>``."""
    from tickspark.streaming.ingest import start_stream

    messages.sparkSession.dataSource.register(topic_source(client_factory))
    columns = [c for c in ("key", "value") if c in messages.columns]
    writer = (messages.select(*columns).writeStream.format(FORMAT).options(outcomes=outcomes, run=run, timeout=timeout, chunk=chunk)
              .option("checkpointLocation", checkpoint))
    return start_stream(writer, available_now, processing_time)


def read_outcomes(spark: SparkSession, outcomes: str, run: str | None = None) -> DataFrame:
    """``RUN, PART, KEY, STATUS, MESSAGE_ID, DETAIL``: one row per message; of several attempts the one that
    was published, else the last.  ``run`` also finds the micro-batches of a stream's run."""
    schema = T.StructType([*OUTCOME.fields, T.StructField("ATTEMPT", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(outcomes)
    if run is not None:
        rows = rows.where((F.col("RUN") == run) | F.col("RUN").rlike(f"^{run}-[0-9]+$"))
    best = F.max_by(F.struct("STATUS", "MESSAGE_ID", "DETAIL"), F.struct(F.col("STATUS") == PUBLISHED, "ATTEMPT"))
    return rows.groupBy("RUN", "PART", "KEY").agg(best.alias("b")).select(
        "RUN", "PART", "KEY", "b.STATUS", "b.MESSAGE_ID", "b.DETAIL")
