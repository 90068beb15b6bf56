"""Joins and groupings in time that scale: each is an equi-join or a window over one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def seconds(at: str | Column) -> Column:
    """Whole seconds of a time, as a bucket key; its fraction does not count."""
    return F.unix_seconds(F.col(at).cast("timestamp") if isinstance(at, str) else at.cast("timestamp"))


def interval_join(left: DataFrame, right: DataFrame, key: str, at: str, ts: str, before: int) -> DataFrame:
    """Pairs with the same key and ts in [at - before, at]. Times fall into buckets as wide as the interval, so each left row
    meets two buckets: an equi-join on key and bucket, in which a hot key is spread over its buckets."""
    rows = right.withColumn("_bucket", F.floor(seconds(ts) / before))
    spans = left.withColumn("_last", F.floor(seconds(at) / before)).withColumn("_bucket", F.explode(F.array(F.col("_last") - 1, F.col("_last")))).drop("_last")
    interval = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(before))
    joined = spans.join(rows, [key, "_bucket"]).where((F.col(ts) <= F.col(at)) & (F.col(ts) >= F.col(at) - interval))
    return joined.drop("_bucket")


def asof_join(left: DataFrame, right: DataFrame, key: str, ts: str, left_values: list[str], right_values: list[str]) -> DataFrame:
    """Each left row with the last right row of its key at or before it, null if none: both sides in one window, one shuffle."""
    null = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    a = left.select(key, ts, F.lit(1).alias("_side"), *left_values, *(null(right, c) for c in right_values))
    b = right.select(key, ts, F.lit(0).alias("_side"), *(null(left, c) for c in left_values), *right_values)
    last = Window.partitionBy(key).orderBy(ts, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.union(b)
    return both.select("_side", *left_values, *(F.last(c, ignorenulls=True).over(last).alias(c) for c in right_values)).where("_side = 1").drop("_side")


def sessions(df: DataFrame, key: str, ts: str, gap: str) -> DataFrame:
    """(key, start, n) of each run of rows less than ``gap`` apart."""
    w = F.session_window(F.col(ts), gap)
    found = df.groupBy(key, w.alias("w")).agg(F.count("*").alias("n"))
    return found.select(key, F.col("w.start").alias("start"), "n")
