"""The named queries and the SQL each one answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.envelope import envelope

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: The events table as messages, for DuckDB.
MESSAGES = """msg AS (SELECT event_id, CAST(event_id AS VARCHAR) AS messageid, props AS body, date_trunc('millisecond', ts) AS publishtime,
  CAST(user_id AS VARCHAR) AS orderingkey, event_type, user_id, value, epoch_ms(date_trunc('millisecond', ts)) AS ms FROM events)"""


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = f"WITH {MESSAGES} {sql}" if " msg" in sql and not sql.lstrip().upper().startswith("WITH") else sql
        return f

    return add


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a message: its props are the payload, its user the ordering key."""
    e = events(spark, sf_dir)
    return envelope(e, F.col("event_id"), F.encode("props", "UTF-8"), F.col("ts"), F.col("user_id"), F.create_map(F.lit("event_type"), F.col("event_type")))


def plain(df: DataFrame) -> DataFrame:
    """Bodies as text and times without a zone, to compare with SQL."""
    out = df
    for f in df.schema.fields:
        if f.dataType.typeName() == "binary":
            out = out.withColumn(f.name, F.decode(f.name, "UTF-8"))
        elif f.dataType.typeName() == "timestamp":
            out = out.withColumn(f.name, F.col(f.name).cast("timestamp_ntz"))
        elif f.dataType.typeName() == "map":
            pairs = F.transform(F.map_entries(f.name), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
            out = out.withColumn(f.name, F.array_join(F.sort_array(pairs), ","))
    return out
