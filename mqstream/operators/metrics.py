"""Publish windows, message age and the source's metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMES = ("lastGatherMessageCount", "lastGatherPayloadBytes", "lastGatherNewestMessageAgeMs", "outstandingPayloadBytes", "lastProducedBatchId", "lastConsumedBatchId", "retryAttempts", "retryAttemptsTotal")


def publish_window(messages: DataFrame, by: str = "batch") -> DataFrame:
    ms = F.unix_millis("publishtime")
    return messages.groupBy(by).agg(F.min(ms).alias("oldest_ms"), F.max(ms).alias("newest_ms"), F.count("*").alias("messages"))


def newest_age(now_ms: Column | int, newest_ms: Column) -> Column:
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    return F.greatest(F.lit(0).cast("bigint"), now - newest_ms)


def batch_metrics(messages: DataFrame, now_ms: int) -> DataFrame:
    """Per batch, with what is outstanding once it and all before it but the last are acknowledged."""
    rows = messages.groupBy("batch").agg(F.count("*").alias("lastGatherMessageCount"), F.sum(F.octet_length("body")).cast("bigint").alias("lastGatherPayloadBytes"), F.max(F.unix_millis("publishtime")).alias("newest"))
    return rows.select("batch", "lastGatherMessageCount", "lastGatherPayloadBytes", newest_age(now_ms, F.col("newest")).alias("lastGatherNewestMessageAgeMs"), F.col("batch").alias("lastProducedBatchId"))


def as_strings(count: int, size: int, newest_age_ms: int | None, outstanding: int, produced: int, consumed: int | None, retries: int, retries_total: int) -> dict[str, str]:
    """The metrics of one cycle; "-" where there is nothing to tell."""
    values = (count, size, "-" if newest_age_ms is None else newest_age_ms, outstanding, produced, "-" if consumed is None else consumed, retries, retries_total)
    return dict(zip(NAMES, map(str, values), strict=True))
