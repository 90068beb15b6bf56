"""Admission control: limits, and how a run of messages falls into batches and partitions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

UNLIMITED = 2**63 - 1


def min_positive(*values: int | None) -> int:
    """The least value above 0; what is not above 0 is absent; UNLIMITED if all are."""
    return min([v for v in values if v and v > 0], default=UNLIMITED)


@dataclass(frozen=True)
class ReadLimit:
    """One read limit of the engine; ``parts`` make it a composite."""

    max_rows: int = 0
    max_bytes: int = 0
    min_rows: int = 0
    max_delay_ms: int = 0
    parts: tuple[ReadLimit, ...] = ()

    def flat(self) -> Iterator[ReadLimit]:
        yield self
        for p in self.parts:
            yield from p.flat()


@dataclass(frozen=True)
class Limits:
    """What closes a batch."""

    max_rows: int = UNLIMITED
    max_bytes: int = UNLIMITED
    min_rows: int = 0
    wait_ms: int | None = None
    drain: bool = False

    @staticmethod
    def of(batch_count: int, batch_size: int, limit: ReadLimit | None = None, receive_ms: int | None = None) -> Limits:
        every = list(limit.flat()) if limit else []
        delay = min_positive(*(x.max_delay_ms for x in every))
        waits = [w for w in (receive_ms, delay if delay != UNLIMITED else None) if w is not None]
        return Limits(min_positive(batch_count, *(x.max_rows for x in every)), min_positive(batch_size, *(x.max_bytes for x in every)), max((x.min_rows for x in every), default=0), min(waits, default=None))

    def with_budget(self, budget: int) -> Limits:
        """A memory budget above 0 tightens the byte cap."""
        return replace(self, max_bytes=min_positive(self.max_bytes, budget))

    def until_idle(self) -> Limits:
        return replace(self, drain=True, wait_ms=None)

    def reached(self, rows: int, size: int) -> bool:
        """Asked before each message, so the one that crosses a cap is still in."""
        return rows >= self.max_rows or size >= self.max_bytes


def fits(held: int, size: int, cap: int) -> bool:
    """Whether a message may be held: one message alone always may, however large."""
    if held < 0 or size < 0:
        return False
    return held == 0 or (held < cap and size <= cap - held)


def least_positive(*columns: Column) -> Column:
    """min_positive as a column."""
    return F.coalesce(F.least(*(F.when(c > 0, c) for c in columns), F.lit(None).cast("bigint")), F.lit(UNLIMITED))


def in_order(df: DataFrame, order: str, queue: str | None = None) -> DataFrame:
    """``at``: the 0-based arrival position, within each queue if one is named. Without a queue the rows are dealt to as many
    ranges of ``order`` as there are shuffle partitions, at quantiles of it, and positions follow from the ranges' counts, so
    no task holds all messages. A row's range follows from its value alone, however often the rows are read."""
    if queue:
        return df.withColumn("at", (F.row_number().over(Window.partitionBy(queue).orderBy(order)) - 1).cast("bigint"))
    placed = ranged(df, order)
    counts = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(order)) - 1
    return after_ranges(placed, counts).withColumn("at", (F.col("_before") + within).cast("bigint")).drop("_range", "_before")


def ranged(df: DataFrame, order: str) -> DataFrame:
    """``_range``: the number of quantiles of ``order`` that are below a row's value."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marks = df.select(F.percentile_approx(order, [k / parts for k in range(1, parts)], 100 * parts)).first()[0] if parts > 1 else None
    edges = F.array(*(F.lit(m) for m in sorted(set(marks or [])))) if marks else None
    return df.withColumn("_range", F.lit(0) if edges is None else F.size(F.filter(edges, lambda m: m < F.col(order))))


def after_ranges(df: DataFrame, counts: DataFrame) -> DataFrame:
    """``_before``: what the ranges before a row's hold, by counts (_range, _n) of at most one row a shuffle partition."""
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return df.join(F.broadcast(counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))), "_range")


def batches_by_count(df: DataFrame, order: str, max_rows: int, queue: str | None = None) -> DataFrame:
    return in_order(df, order, queue).withColumn("batch", F.floor(F.col("at") / max_rows).cast("bigint"))


class Walk:
    """Where batches begin in a stream of sizes, given a run at a time: where one ends decides where the next begins, and its
    end is found by search on the running sums."""

    def __init__(self, max_bytes: int, max_rows: int):
        self.max_bytes, self.max_rows = min(max_bytes, 1 << 62), min(max_rows, 1 << 62)
        self.queue, self.batch, self.rows, self.held = None, -1, 0, 0

    def batches(self, queue: object, sizes: np.ndarray) -> np.ndarray:
        """The batch of each message of a run of one queue."""
        if self.batch < 0 or queue != self.queue:
            self.queue, self.batch, self.rows, self.held = queue, 0, 0, 0
        out, sums, k = np.empty(len(sizes), np.int64), np.cumsum(sizes), 0
        while k < len(sizes):
            if self.rows >= self.max_rows or self.held >= self.max_bytes:
                self.batch, self.rows, self.held = self.batch + 1, 0, 0
            done = int(sums[k - 1]) if k else 0
            # One behind the message that fills the batch.
            full = min(int(np.searchsorted(sums, done + self.max_bytes - self.held)) + 1, k + self.max_rows - self.rows, len(sizes))
            out[k:full] = self.batch
            self.rows, self.held, k = self.rows + full - k, self.held + int(sums[full - 1]) - done, full
        return out


def walked(rows: DataFrame, queue: str | None, max_bytes: int, max_rows: int) -> DataFrame:
    """rows (with bytes), which are in order, with their batch."""
    names = rows.columns

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(max_bytes, max_rows)
        for part in parts:
            sizes = part.column(names.index("bytes")).to_numpy()
            of = part.column(names.index(queue)).to_pylist() if queue else [0] * len(sizes)
            edges = [k for k in range(1, len(of)) if of[k] != of[k - 1]]
            runs = [walk.batches(of[low], sizes[low:high]) for low, high in zip([0, *edges], [*edges, len(of)], strict=True) if low < high]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.concatenate([np.empty(0, np.int64), *runs]))], names=[*names, "batch"])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("batch", LongType())]))


def batches_by_bytes(df: DataFrame, order: str, size: Column, max_bytes: int, max_rows: int = UNLIMITED, queue: str | None = None) -> DataFrame:
    """Batches closed by bytes, or rows, before the next message. Queues run side by side, each one ordered stream through one
    task. Without a queue only the positions and sizes of all messages are walked in one task, as two numbers each; the
    messages stay distributed and learn their batch from the number of batches begun before them."""
    sized = df.withColumn("bytes", size.cast("bigint"))
    if queue is not None:
        return walked(sized.repartition(F.col(queue)).sortWithinPartitions(queue, order), queue, max_bytes, max_rows)
    placed = in_order(sized, order)
    numbered = walked(placed.select("at", "bytes").repartitionByRange(1, "at").sortWithinPartitions("at"), None, max_bytes, max_rows)
    firsts = numbered.groupBy("batch").agg(F.min("at").alias("at")).select("at", F.lit(1).alias("_first"))
    marked = ranged(placed.join(firsts, "at", "left"), "at")
    counts = marked.groupBy("_range").agg(F.count("_first").alias("_n"))
    begun = F.col("_before") + F.count("_first").over(Window.partitionBy("_range").orderBy("at"))
    return after_ranges(marked, counts).withColumn("batch", (begun - 1).cast("bigint")).drop("_range", "_before", "_first", "at")


def slices(df: DataFrame, writers: int) -> DataFrame:
    """The partition of each message of a batch: message i of n goes to slice i modulo min(writers, n)."""
    n = F.count("*").over(Window.partitionBy("batch"))
    within = F.row_number().over(Window.partitionBy("batch").orderBy("at")) - 1
    return df.withColumn("slice", F.pmod(within, F.least(F.lit(writers), n)).cast("int"))


def seek_window(messages: DataFrame, seek_ms: int | None = None, limit_ms: int | None = None) -> DataFrame:
    """Messages published in [seek, limit)."""
    at = F.unix_millis("publishtime")
    out = messages if seek_ms is None else messages.where(at >= seek_ms)
    return out if limit_ms is None else out.where(at < limit_ms)


def limit_split(messages: DataFrame, limit_ms: int) -> DataFrame:
    """``kept``: whether a message is before the limit; the others are given back and end the read."""
    return messages.withColumn("kept", F.unix_millis("publishtime") < limit_ms)


def after_snapshot(messages: DataFrame, acked: DataFrame) -> DataFrame:
    """What a seek to a snapshot replays: all messages it did not hold as acknowledged."""
    return messages.join(acked.select("messageid"), "messageid", "left_anti")
