"""The message queue as a Spark data source, format "mq".

The driver's reader handles what names messages, never their bodies: it leases, gathers and makes batches, and a
partition is a part of a batch in the queue, which the task reads itself. So the queue's file is to be where all
tasks can open it. The reader runs in a process of its own and is built more than once, so nothing is opened before
the first offset is asked for, and all state that must outlive it is in the queue.

``format("mq")`` gives the columns of the options' schema mode, or of a schema given, decoded in Python. ``read_stream``
and ``read_batch`` take from it the envelope columns that their table is made of and decode downstream, where Catalyst
prunes what is not used; they are the faster way.
"""

from __future__ import annotations

import json
import logging
import sqlite3
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from datetime import UTC, datetime
from itertools import chain
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.payload import Decoder
from ..operators.admission import Limits, ReadLimit, min_positive
from ..operators.envelope import of_schema
from ..operators.metrics import as_strings
from ..sources.options import Options
from ..sources.schema import ENVELOPE, envelope_name, metadata_schema, registered_schema, table_schema
from . import memory
from .broker import Broker
from .errors import RetryPolicy
from .gather import Gather, Gathered
from .pacing import Intake, ReceiveTuner, observed
from .store import CHUNK_BYTES, Message, newest, spans_of

R = TypeVar("R")
FORMAT = "mq"
LOG = logging.getLogger(__name__)
PACKED = T.StructType([T.StructField("at", T.LongType(), False), T.StructField("rows", T.BinaryType(), False)])
#: Messages in a packed row, at most.
PACKED_ROWS = 2048
MADE_OF = {"ackid": "messageid", "publishtime": "publish_ms"}


class Slice(InputPartition):
    """Part ``part`` of ``parts`` of a reader's batches (after, to]."""

    def __init__(self, owner: str, after: int, to: int, part: int, parts: int):
        super().__init__(None)
        self.owner, self.after, self.to, self.part, self.parts = owner, after, to, part, parts


class Range(InputPartition):
    """The waiting messages with seqs in [low, high]."""

    def __init__(self, low: int, high: int):
        super().__init__(None)
        self.low, self.high = low, high


def sliced(owner: str, after: int, to: int, count: int, writers: int) -> list[Slice]:
    """min(writers, count) parts; no messages are one empty part."""
    parts = max(1, min(writers, count))
    return [Slice(owner, after, to, k, parts) for k in range(parts)]


def maps(marks: pa.Array) -> pa.Array:
    """Attributes as maps; those that are written alike are parsed once."""
    told = marks.dictionary_encode()
    return pa.array([list(json.loads(m).items()) for m in told.dictionary.to_pylist()], pa.map_(pa.string(), pa.string())).take(told.indices)


class Rows:
    """Messages of the queue as rows of a schema: envelope columns in Arrow batches; with payload columns, decoded rows."""

    def __init__(self, schema: T.StructType):
        self.fields = [(envelope_name(f.name), f.name, f.dataType) for f in schema.fields]
        payload = [(name, kind) for known, name, kind in self.fields if known is None]
        self.decoder = Decoder(payload) if payload else None

    def __call__(self, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | tuple]:
        for rows in parts:
            if self.decoder is None:
                columns = {
                    "body": lambda: rows["body"], "messageid": lambda: rows["messageid"], "ackid": lambda: rows["messageid"],  # noqa: B023
                    "publishtime": lambda: pa.array(rows["publish_ms"].to_numpy() * 1000, pa.timestamp("us", "UTC")), "orderingkey": lambda: rows["orderingkey"],  # noqa: B023
                    "attributes": lambda: maps(rows["attributes"]),  # noqa: B023
                }
                yield pa.RecordBatch.from_arrays([columns[known]() for known, _, _ in self.fields], names=[name for _, name, _ in self.fields])
                continue
            for i, body, mark, ms, key in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                row = {"body": body, "messageid": i, "publishtime": datetime.fromtimestamp(ms / 1000, UTC), "orderingkey": key, "ackid": i, "attributes": json.loads(mark)}
                decoded = iter(self.decoder(body))
                yield tuple(next(decoded) if known is None else row[known] for known, _, _ in self.fields)


class Packed:
    """Messages of the queue as they lie, some thousands a row: so the task that reads a batch handles few rows, and what it reads
    can be dealt to all cores before it is taken apart. Only what the wanted envelope columns are made of is kept."""

    def __init__(self, wanted: Sequence[str]):
        self.names = list(dict.fromkeys(MADE_OF.get(name, name) for name in wanted))

    def __call__(self, parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for rows in parts:
            kept = rows.select(self.names)
            most = max(1, min(PACKED_ROWS, CHUNK_BYTES * kept.num_rows // max(1, kept.nbytes)))
            for k in range(0, kept.num_rows, most):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, kept.schema) as out:
                    out.write_batch(kept.slice(k, most))
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], PACKED.names)
                at += 1


def unpacked(packed: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The envelope columns of packed rows, which are dealt to all cores first."""
    cores, schema = packed.sparkSession.sparkContext.defaultParallelism, T.StructType([ENVELOPE[name] for name in wanted])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch["rows"]:
                yield from Rows(schema)(pa.ipc.open_stream(one.as_buffer()))

    return packed.repartitionById(cores, (F.col("at") % cores).cast("int")).mapInArrow(rows, schema)


def started(batch: int | None, produced: int) -> bool:
    """Whether a query's start offset shows that the produced batch is consumed."""
    return batch is not None and batch >= produced


class StreamReader(DataSourceStreamReader):
    def __init__(self, options: Options, drain: bool, schema: T.StructType, packed: Sequence[str] = ()):
        self.options, self.drain, self.rows = options, drain, Packed(packed) if packed else Rows(schema)
        self.broker: Broker | None = None

    def _open(self) -> Broker:
        if self.broker is None:
            o = self.options
            self.retry, self.retried = RetryPolicy(o.max_retry_ms, warn=LOG.warning), 0
            self.broker = self._call(lambda: Broker(o.queue))
            self.broker.check(o.subscription)
            if o.seek == "snapshot":
                self.broker.seek_snapshot(o.subscription, o.seek_snapshot)
            elif o.seek != "none":
                self.broker.seek(o.subscription, o.seek_ms if o.seek == "timestamp" else 0)
            self.owner, self.stopped = uuid.uuid4().hex, False
            self.tuner = ReceiveTuner(o.receive_ms, o.gather_mode, o.processing_ms)
            self.budget = memory.Budget.start(o.batch_size, memory.total())
            self.flow = self.budget.size
            self.produced, self.consumed, self.over = self.broker.next_batch(o.subscription) - 1, None, False
            self.first, self.warned_ms = self.produced, None
            self.open_batch, self.hour, self.renewed = False, None, self.broker.clock_ms()
            LOG.info(o.summary())
        return self.broker

    def _call(self, call: Callable[[], R]) -> R:
        """A call to the queue, tried again while the queue is busy."""

        def tried() -> R:
            try:
                return call()
            except sqlite3.OperationalError as e:
                if "locked" in str(e) or "busy" in str(e):
                    raise ConnectionError(f"UNAVAILABLE: {e}") from e
                raise

        return self.retry.run(tried)

    def room(self) -> tuple[int, int]:
        """(messages, bytes) that may be leased now: twice the flow's bytes and twice batchCount may be outstanding. While
        nothing waits to become a batch one message always may, however large."""
        count, size = self.broker.outstanding(self.options.subscription, self.owner)
        least = int(not self.broker.gathering(self.options.subscription, self.owner))
        most = 2 * self.options.batch_count - count if self.options.batch_count else 10_000
        return max(most, least), max(2 * self.flow - size, least) if self.flow else 2**62

    def _renew(self, least_ms: int | None = None) -> None:
        """Extend the leases once a third of their time is over: a gather may take longer than they last."""
        lease_ms, now = self.options.lease_ms(), self.broker.clock_ms()
        if now - self.renewed >= (lease_ms // 3 if least_ms is None else least_ms):
            self._call(lambda: self.broker.extend(self.options.subscription, self.owner, lease_ms))
            self.renewed = now

    def _poll(self, wait_ms: int, count: int) -> Sequence[Message]:
        until = time.monotonic() + wait_ms / 1000
        while True:
            self._renew()
            most, size = self.room()
            found = self._call(lambda: self.broker.lease(self.options.subscription, self.owner, min(count, most, 10_000), self.options.lease_ms(), size)) if min(most, size) > 0 else []  # noqa: B023
            if found or self.stopped or time.monotonic() >= until:
                return found
            time.sleep(min(0.05, max(0.001, until - time.monotonic())))

    def _hot(self) -> bool:
        """Whether memory is at its ceiling; told once an hour."""
        why = memory.paused(memory.resident(), memory.total(), memory.available())
        if why and memory.warning_due(self.warned_ms, now := self.broker.clock_ms()):
            LOG.warning("intake pauses: %s memory is short", why)
            self.warned_ms = now
        return why is not None

    def retarget(self) -> bool:
        """Let what may be outstanding follow the memory budget once it has moved; what is held for no batch goes back first."""
        if self.budget.size == self.flow:
            return False
        self.broker.abandon(self.options.subscription, self.owner, self.produced)
        LOG.debug("outstanding bytes: %s, before %s", 2 * self.budget.size, 2 * self.flow)
        self.flow = self.budget.size
        return True

    def initialOffset(self) -> dict:
        """Batches that earlier queries made are not this one's; latestOffset may have come first."""
        self._open()
        return {"batchId": self.first}

    def latestOffset(self) -> dict:
        broker, o = self._open(), self.options
        self._renew(0)
        if o.ack_mode == "afterCheckpoint" and self.consumed is not None:
            self._call(lambda: broker.settle(o.subscription, self.consumed))
        if self.open_batch or self.over or self.stopped:  # not yet consumed, or nothing more to come
            return {"batchId": self.produced}
        if not self.drain and self.tuner.probing():
            return {"batchId": self.produced}
        self.retarget()
        limits = Limits.of(o.batch_count, o.batch_size, ReadLimit(o.max_rows, o.max_bytes, o.min_rows), o.receive_ms).with_budget(self.budget.size)
        limits = limits.until_idle() if self.drain else limits
        kept = (lambda ms: broker.ack_spans(o.subscription, self.owner, spans_of(ms))) if o.ack_mode == "early" else (lambda _: None)
        gather = Gather(self._poll, lambda ms: broker.nack_spans(o.subscription, self.owner, spans_of(ms)), lambda: time.monotonic_ns() // 1_000_000, self._hot, lambda: self.stopped, kept)
        began = time.monotonic_ns()
        wait = None if limits.wait_ms is None else limits.wait_ms * 1_000_000
        out = gather.run(limits, self.tuner.window(wait) // 1_000_000, o.gather_mode, o.limit_ms)
        self.tuner.gathered(time.monotonic_ns() - began, out.count)
        used = 100 * memory.resident() // max(1, memory.total())
        self.budget = self.budget.after(memory.Reading(used, memory.available(), out.size))
        self.over = out.limit_reached
        if self.drain:
            broker.tell_idle(o.subscription, out.ran_dry)
        if out.count:
            self.produced, self.open_batch = self._call(lambda: broker.produce(o.subscription, self.owner, chain.from_iterable(p if isinstance(p, list) else [p] for p in out.polls))), True
            self._tell(out)
        return {"batchId": self.produced}

    def _tell(self, out: Gathered) -> None:
        """Note the batch's metrics, and warn when intake falls behind."""
        now, o = self.broker.clock_ms(), self.options
        age = max(0, now - max(map(newest, out.polls)))
        values = as_strings(out.count, out.size, age, self.broker.outstanding(o.subscription)[1], self.produced, self.consumed, self.retry.attempts - self.retried, self.retry.attempts)
        self.retried = self.retry.attempts
        self.broker.note(o.subscription, self.produced, values)
        self.hour: Intake | None
        self.hour, warning = observed(self.hour, now, age, self.tuner.pace.interval // 1_000_000)
        if warning:
            LOG.warning(warning)

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        """Parts of the batches in the queue. Batches that were planned before a crash are taken over and read as they were; but
        for a query's first one, which looks like an idle start and comes again when its leases end."""
        broker, o, after, to = self._open(), self.options, int(start["batchId"]), int(end["batchId"])
        broker.resume(o.subscription, to)
        self._call(lambda: broker.take_over(o.subscription, self.owner, after, to, o.lease_ms()))
        self.open_batch, self.consumed = self.open_batch and not started(to, self.produced), to
        return sliced(self.owner, after, to, broker.count(o.subscription, self.owner, after, to), o.num_writers)

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch | tuple]:
        broker = Broker(self.options.queue, read_only=True)
        try:
            yield from self.rows(broker.tables_of_batch(self.options.subscription, partition.owner, partition.after, partition.to, partition.part, partition.parts))
        finally:
            broker.close()

    def commit(self, end: dict) -> None:
        if self.options.ack_mode == "afterCommit":
            broker = self._open()
            self._call(lambda: broker.settle(self.options.subscription, int(end["batchId"])))
        self.tuner.committed()

    def stop(self) -> None:
        """Give back what is held beyond the batches the query has consumed; a gather under way gives back its own."""
        if self.broker is not None:
            self.stopped = True
            self.broker.abandon(self.options.subscription, self.owner, self.produced - 1 if self.open_batch else self.produced)
            self.broker.close()
            self.broker = None


class BatchReader(DataSourceReader):
    """An extension: all messages a subscription has not acknowledged, without leasing them. Bounds are the queue's work,
    and each task reads a range of it."""

    def __init__(self, options: Options, schema: T.StructType):
        self.options, self.rows = options, Rows(schema)

    def _waiting(self, broker: Broker) -> tuple[list[tuple[int, int]], tuple[int, int, int]]:
        o = self.options
        return broker.waiting(o.subscription, o.seek_ms, o.limit_ms, min_positive(o.batch_count))

    def partitions(self) -> list[Range]:
        broker = Broker(self.options.queue)
        try:
            broker.check(self.options.subscription)
            return [Range(low, high) for low, high in broker.ranges(*self._waiting(broker), self.options.num_writers)] or [Range(0, -1)]
        finally:
            broker.close()

    def read(self, partition: Range) -> Iterator[pa.RecordBatch | tuple]:
        broker = Broker(self.options.queue, read_only=True)
        try:
            yield from self.rows(broker.tables_in_range(*self._waiting(broker), partition.low, partition.high))
        finally:
            broker.close()


def payload_of(options: Options) -> T.StructType | None:
    """The payload schema that the schema mode asks for."""
    if options.schema_mode not in ("dynamic", "mixed"):
        return None
    return registered_schema(options.topic or options.subscription, options.registry) if options.registry else None


class MessageSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        options = Options.of(self.options)
        if self.options.get("packed"):
            return PACKED
        if wanted := self.options.get("envelope"):
            return T.StructType([ENVELOPE[name] for name in wanted.split(",")])
        table = table_schema(options.schema_mode, payload_of(options))
        nullable = [T.StructField(f.name, f.dataType, f.nullable or envelope_name(f.name) is None) for f in table.fields]
        return T.StructType([*nullable, *metadata_schema(options.metadata_mode, table).fields])

    def streamReader(self, schema: T.StructType) -> StreamReader:
        return StreamReader(Options.of(self.options), self.options.get("drain", "false").lower() == "true", schema, [name for name in self.options.get("packed", "").split(",") if name])

    def reader(self, schema: T.StructType) -> BatchReader:
        return BatchReader(Options.of(self.options), schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(MessageSource)


def viewed(load: Callable[[str], DataFrame], options: Options, schema: T.StructType | None) -> DataFrame:
    """The table of a schema or of the schema mode over the envelope columns that it is made of: no others are read."""
    metadata = T.StructType([])
    if schema is None or not schema.fields:
        schema = table_schema(options.schema_mode, payload_of(options))
        metadata = metadata_schema(options.metadata_mode, schema)
    used = {envelope_name(f.name) or "body" for f in schema.fields} | set(metadata.names)
    return of_schema(load(",".join(name for name in ENVELOPE if name in used)), schema, tuple(metadata.names))


def read_stream(spark: SparkSession, options: dict[str, str], schema: T.StructType | None = None, spread: bool = False) -> DataFrame:
    """The queue as a streaming table of the options' schema mode, or of a schema given. With ``spread`` a batch is read by
    ``numWriters`` tasks as ever, which hand it on as it lies, and taken apart by all cores."""
    register(spark)
    if Options.of(options).emulator_host:
        LOG.warning("emulatorHost is ignored: the queue is a local file")
    load = lambda **wanted: spark.readStream.format(FORMAT).options(**options, **wanted).load()
    return viewed(lambda envelope: unpacked(load(packed=envelope), envelope.split(",")) if spread else load(envelope=envelope), Options.of(options), schema)


def read_batch(spark: SparkSession, options: dict[str, str], schema: T.StructType | None = None) -> DataFrame:
    """What is in the queue now, as a table."""
    register(spark)
    return viewed(lambda envelope: spark.read.format(FORMAT).options(**options, envelope=envelope).load(), Options.of(options), schema)


def read_metrics(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """(batch, name, value) of the batches made so far."""
    o = Options.of(options)
    broker = Broker(o.queue)
    try:
        return spark.createDataFrame(broker.noted(o.subscription), "batch long, name string, value string")
    finally:
        broker.close()
