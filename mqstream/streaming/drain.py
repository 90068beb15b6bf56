"""Recovery reads that end: drain a queue to a sink, and settle what a checkpoint shows as written."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from types import MappingProxyType

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.options import Options
from .broker import Broker
from .source import read_stream


def written_batch(spark: SparkSession, checkpoint: str, source: int = 0) -> int | None:
    """A source's batch id in the last committed entry of a query's checkpoint, read through Spark wherever it lies. Sources
    stand there in the order in which the query names them."""
    entries = lambda kind: spark.read.format("binaryFile").load(f"{checkpoint}/{kind}/[0-9]*").select("path", "content")
    try:
        done = [int(r["path"].rsplit("/", 1)[-1]) for r in entries("commits").select("path").collect()]
    except AnalysisException:
        return None
    if not done:
        return None
    offset = spark.read.format("binaryFile").load(f"{checkpoint}/offsets/{max(done)}").first()["content"].decode()
    found = offset.splitlines()[2 + source]
    return int(json.loads(found)["batchId"]) if found.strip().startswith("{") else None


def settle(spark: SparkSession, options: Options, checkpoint: str, source: int = 0) -> int | None:
    """Acknowledge every batch that the sink has: the engine commits a batch to its source only when the next one is
    planned, so the last one would come again. What the ended reader still holds goes back; other readers keep theirs."""
    batch = written_batch(spark, checkpoint, source)
    if batch is not None:
        broker = Broker(options.queue)
        broker.settle(options.subscription, batch)
        if owner := broker.owner_of(options.subscription, batch):
            broker.abandon(options.subscription, owner, batch)
        broker.close()
    return batch


def ran_dry(options: Options) -> bool:
    broker = Broker(options.queue)
    try:
        return broker.idle(options.subscription)
    finally:
        broker.close()


@contextmanager
def settings(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Settings for what is started meanwhile: a streaming query keeps those that it starts with. Then they are as before."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def drain(spark: SparkSession, options: dict[str, str] | Sequence[dict[str, str]], checkpoint: str, sink: Callable[[DataFrame, int], None], schema: T.StructType | None = None, transform: Callable[..., DataFrame] = lambda df: df, mode: str = "append", spread: bool = False, conf: Mapping[str, str] = MappingProxyType({})) -> int:
    """Read until the queue is idle or limitTime is reached; the number of runs that read something. A run with the
    available-now trigger makes one batch, so runs repeat until one has found the queue dry or reads nothing. With options of
    several subscriptions the transform takes a stream of each, and runs repeat until all are dry. ``conf`` is the queries' own."""
    given = [{**o, "drain": "true"} for o in ([options] if isinstance(options, dict) else options)]
    runs, last = 0, [written_batch(spark, checkpoint, k) for k in range(len(given))]
    while True:
        stream = transform(*(read_stream(spark, o, schema, spread) for o in given))
        with settings(spark, conf):
            query = stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        batches = [settle(spark, Options.of(o), checkpoint, k) for k, o in enumerate(given)]
        if all(batch is None or batch == before for batch, before in zip(batches, last, strict=True)):
            return runs
        runs, last = runs + 1, batches
        if all(ran_dry(Options.of(o)) for o in given):
            return runs
        for o in given:
            o.pop("seek", None)  # a seek is for the first run
