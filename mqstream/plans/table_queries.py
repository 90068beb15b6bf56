"""Schema modes, metadata, decoding, admission and metrics over stored messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import values
from ..functions.decode import payload_fields
from ..operators import admission, metrics
from ..operators.envelope import metadata_view, of_schema, table_view
from ..sources.avro import struct_of
from ..streaming.errors import fatal_status, retryable_message
from ..streaming.pacing import ROUND, SECOND, SNAP
from .catalog import events, messages, plain, query

PAYLOAD = struct_of('{"type": "record", "name": "event", "fields": [{"name": "k", "type": "int"}]}')

# Schema and metadata modes.


@query("schema_raw", "SELECT body FROM msg")
def schema_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(table_view(messages(spark, sf_dir), "raw"))


@query("schema_basic", "SELECT body, messageid, publishtime FROM msg")
def schema_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(table_view(messages(spark, sf_dir), "basic"))


@query("schema_slim", "SELECT body, messageid, publishtime, orderingkey FROM msg")
def schema_slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(table_view(messages(spark, sf_dir), "slim"))


@query("schema_dynamic", "SELECT CAST(json_extract(body, '$.k') AS INT) AS k FROM msg")
def schema_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_view(messages(spark, sf_dir), "dynamic", PAYLOAD)


@query("schema_mixed", "SELECT CAST(json_extract(body, '$.k') AS INT) AS k, messageid, publishtime FROM msg")
def schema_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(table_view(messages(spark, sf_dir), "mixed", PAYLOAD))


@query("user_schema_override", "SELECT CAST(json_extract(body, '$.k') AS BIGINT) AS \"K\", messageid AS \"MessageId\", body AS data, CAST(NULL AS VARCHAR) AS missing FROM msg")
def user_schema_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(of_schema(messages(spark, sf_dir), T._parse_datatype_string("K long, MessageId string, data binary, missing string")))


@query("metadata_basic", "SELECT body, messageid, publishtime FROM msg")
def metadata_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(metadata_view(messages(spark, sf_dir), "raw", "basic"))


@query("metadata_slim", "SELECT body, messageid, publishtime, orderingkey, messageid AS ackid FROM msg")
def metadata_slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(metadata_view(messages(spark, sf_dir), "basic", "slim"))


@query("metadata_full", "SELECT CAST(json_extract(body, '$.k') AS INT) AS k, messageid, publishtime, orderingkey, messageid AS ackid, 'event_type=' || event_type AS attributes FROM msg")
def metadata_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(metadata_view(messages(spark, sf_dir), "mixed", "full", PAYLOAD))


@query("column_pruned", "SELECT orderingkey, count(*) AS n FROM msg GROUP BY orderingkey")
def column_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payload is not read: nothing asks for it."""
    view = metadata_view(messages(spark, sf_dir), "mixed", "full", PAYLOAD)
    return view.groupBy("orderingkey").agg(F.count("*").alias("n"))


@query("payload_aggregate", "SELECT event_type, count(*) AS n, sum(k) AS sum_k, min(k) AS min_k, max(k) AS max_k FROM (SELECT event_type, CAST(json_extract(body, '$.k') AS BIGINT) AS k FROM msg) GROUP BY event_type")
def payload_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = metadata_view(messages(spark, sf_dir), "dynamic", "full", PAYLOAD).withColumn("event_type", F.col("attributes")["event_type"])
    k = F.col("k").cast("long")
    return view.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("sum_k"), F.min(k).alias("min_k"), F.max(k).alias("max_k"))


# Payload decoding: JSON written from the events in the same way on both sides.


def written(spark: SparkSession, sf_dir: str, *parts: str | Column) -> DataFrame:
    text = F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return events(spark, sf_dir).select("event_id", F.encode(text, "UTF-8").alias("body"))


def fields(df: DataFrame, schema: str) -> DataFrame:
    wanted = T._parse_datatype_string(schema)
    rows, found = payload_fields(df, [(f.name, f.dataType) for f in wanted.fields])
    return rows.select("event_id", *(c.alias(f.name) for f, c in zip(wanted.fields, found, strict=True)))


def event_id() -> Column:
    return F.col("event_id")


@query("decode_scalars", """SELECT event_id, 'u' || user_id AS s, event_id % 2 = 0 AS b, CAST(event_id AS INT) AS i, event_id * 1000000007 AS l, CAST(event_id + 0.5 AS FLOAT) AS f, event_id + 0.25::DOUBLE AS d FROM events""")
def decode_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(spark, sf_dir, '{"s":"u', F.col("user_id"), '","b":', F.when(event_id() % 2 == 0, "true").otherwise("false"), ',"i":', event_id(), ',"l":', event_id() * 1000000007, ',"f":', event_id(), '.5,"d":', event_id(), ".25}")
    return fields(rows, "s string, b boolean, i int, l long, f float, d double")


@query("decode_timestamp", """SELECT event_id, make_timestamp((1600000000 + event_id) * 1000000) AS seconds, make_timestamp((1600000000000 + event_id) * 1000) AS millis, make_timestamp((1705314600 + event_id % 20) * 1000000) AS iso FROM events""")
def decode_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(spark, sf_dir, '{"seconds":', event_id() + 1600000000, ',"millis":', event_id() + 1600000000000, ',"iso":"2024-01-15T10:30:', F.lpad((event_id() % 20).cast("string"), 2, "0"), 'Z"}')
    return plain(fields(rows, "seconds timestamp, millis timestamp, iso timestamp"))


@query("decode_decimal", """SELECT event_id, CAST(event_id + 0.146 AS DECIMAL(10,2))::VARCHAR AS number, '0.00' AS quoted FROM events""")
def decode_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(spark, sf_dir, '{"number":', event_id(), '.146,"quoted":"3.5"}')
    return fields(rows, "number decimal(10,2), quoted decimal(10,2)").select("event_id", F.col("number").cast("string"), F.col("quoted").cast("string"))


@query("decode_nested", """SELECT event_id, 'n' || event_id AS id, CAST(user_id AS INT) AS inner_user, CAST(NULL AS VARCHAR) AS absent FROM events""")
def decode_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(spark, sf_dir, '{"Nested":{"id":"n', event_id(), '","more":{"USER":', F.col("user_id"), "}}}")
    found = fields(rows, "nested struct<id:string,more:struct<user:int>,absent:string>")
    return found.select("event_id", F.col("nested.id").alias("id"), F.col("nested.more.user").alias("inner_user"), F.col("nested.absent").alias("absent"))


@query("decode_array_wrap", """SELECT event_id, 'a,t' || event_id AS tags, CAST(event_id AS VARCHAR) AS one FROM events""")
def decode_array_wrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(spark, sf_dir, '{"tags":["a","t', event_id(), '"],"one":', event_id(), "}")
    found = fields(rows, "tags array<string>, one array<int>")
    return found.select("event_id", F.array_join("tags", ",").alias("tags"), F.array_join(F.transform("one", lambda x: x.cast("string")), ",").alias("one"))


@query("decode_map", """SELECT event_id, 'a=' || event_id || ',b=7' AS stats, '' AS scalar FROM events""")
def decode_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(spark, sf_dir, '{"stats":{"b":7,"a":', event_id(), '},"scalar":3}')
    return plain(fields(rows, "stats map<string,int>, scalar map<string,int>"))


@query("decode_uncoercible_defaults", """SELECT event_id, 0 AS word, CAST(event_id AS INT) AS fraction, CAST(event_id AS INT) AS quoted, CAST(event_id AS BIGINT) AS quoted_long, false AS yes, true AS quoted_true, event_id % 3 <> 0 AS number, 0.0::DOUBLE AS letters, 1 AS flag, -1294967296 AS wrapped, 0 AS container FROM events""")
def decode_uncoercible_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(spark, sf_dir, '{"word":"abc","fraction":', event_id(), '.9,"quoted":"', event_id(), '","quoted_long":"', event_id(), '.7","yes":"yes","quoted_true":"true","number":', event_id() % 3, ',"letters":"x","flag":true,"wrapped":3000000000,"container":{"a":1}}')
    return fields(rows, "word int, fraction int, quoted int, quoted_long long, yes boolean, quoted_true boolean, number boolean, letters double, flag int, wrapped int, container int")


@query("decode_case_insensitive", """SELECT event_id, 'u' || user_id AS deviceid, CAST(event_id AS INT) AS exact FROM events""")
def decode_case_insensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(spark, sf_dir, '{"DeviceId":"u', F.col("user_id"), '","EXACT":-1,"exact":', event_id(), "}")
    return fields(rows, "deviceid string, exact int")


@query("decode_text", """SELECT event_id, CAST(event_id AS VARCHAR) AS whole, event_id || '.5' AS fraction, 'true' AS flag, '{"b":1,"a":' || event_id || '}' AS object, '[1,"x"]' AS list, 'raw' || event_id AS bytes FROM events""")
def decode_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written(spark, sf_dir, '{"whole":', event_id(), ',"fraction":', event_id(), '.50,"flag":true,"object":{"b":1,"a":', event_id(), '},"list":[1,"x"],"bytes":"raw', event_id(), '"}')
    return plain(fields(rows, "whole string, fraction string, flag string, object string, list string, bytes binary"))


@query("decode_missing", """SELECT event_id, CAST(NULL AS INT) AS absent, CAST(NULL AS INT) AS nothing, CASE WHEN event_id % 2 = 0 THEN 'x' END AS sometimes FROM events""")
def decode_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absent and null fields, empty bodies and bodies that are no object."""
    rows = written(spark, sf_dir, F.when(event_id() % 2 == 0, '{"nothing":null,"sometimes":"x"}').when(event_id() % 3 == 0, "").when(event_id() % 5 == 0, "[1,2]").otherwise("7"))
    return fields(rows, "absent int, nothing int, sometimes string")


# Admission.


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).withColumn("event_id", F.col("messageid").cast("long")).withColumn("queue", F.col("orderingkey").cast("long"))


@query("batch_by_count", "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 700 AS batch FROM msg")
def batch_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.batches_by_count(arrivals(spark, sf_dir), "event_id", 700).select("event_id", "batch")


GREEDY = """WITH RECURSIVE s AS (SELECT event_id, user_id, octet_length(encode(props)) + octet_length(encode(event_type)) AS bytes, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
r AS (SELECT event_id, user_id, n, 0::BIGINT AS batch, 1::BIGINT AS rows, bytes::BIGINT AS held FROM s WHERE n = 1
  UNION ALL SELECT s.event_id, s.user_id, s.n, CASE WHEN {full} THEN r.batch + 1 ELSE r.batch END, CASE WHEN {full} THEN 1 ELSE r.rows + 1 END, CASE WHEN {full} THEN s.bytes ELSE r.held + s.bytes END
  FROM r JOIN s ON s.user_id = r.user_id AND s.n = r.n + 1)
SELECT event_id, user_id AS queue, batch FROM r"""


def message_size() -> Column:
    return F.octet_length("body") + F.octet_length(F.col("attributes")["event_type"])


@query("batch_by_bytes", GREEDY.format(full="r.held >= 100"))
def batch_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = arrivals(spark, sf_dir).withColumn("size", message_size()).drop("attributes")
    return admission.batches_by_bytes(rows, "event_id", F.col("size"), 100, queue="queue").select("event_id", "queue", "batch")


@query("batch_by_count_and_bytes", GREEDY.format(full="(r.held >= 100 OR r.rows >= 5)"))
def batch_by_count_and_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = arrivals(spark, sf_dir).withColumn("size", message_size()).drop("attributes")
    return admission.batches_by_bytes(rows, "event_id", F.col("size"), 100, 5, queue="queue").select("event_id", "queue", "batch")


@query("limits_compose", """SELECT a, b, c, CASE WHEN least(nullif(greatest(a, 0), 0), nullif(greatest(b, 0), 0), nullif(greatest(c, 0), 0)) IS NULL THEN 9223372036854775807 ELSE least(nullif(greatest(a, 0), 0), nullif(greatest(b, 0), 0), nullif(greatest(c, 0), 0)) END AS lim FROM (SELECT event_id % 7 - 2 AS a, event_id % 11 - 3 AS b, event_id % 5 - 2 AS c FROM events)""")
def limits_compose(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select((event_id() % 7 - 2).alias("a"), (event_id() % 11 - 3).alias("b"), (event_id() % 5 - 2).alias("c"))
    return rows.withColumn("lim", admission.least_positive(F.col("a"), F.col("b"), F.col("c")))


@query("partition_round_robin", "SELECT event_id, batch, CAST((row_number() OVER (PARTITION BY batch ORDER BY event_id) - 1) % least(4, count(*) OVER (PARTITION BY batch)) AS INT) AS slice FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 333 AS batch FROM msg)")
def partition_round_robin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.slices(admission.batches_by_count(arrivals(spark, sf_dir), "event_id", 333), 4).select("event_id", "batch", "slice")


def middle(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """A window in the middle of the published times, from the table's own range."""
    r = messages(spark, sf_dir).select(F.min(F.unix_millis("publishtime")).alias("a"), F.max(F.unix_millis("publishtime")).alias("b")).first()
    return r["a"] + (r["b"] - r["a"]) // 4, r["a"] + (r["b"] - r["a"]) // 4 * 3


@query("limit_time_split", "SELECT messageid, ms < (SELECT min(ms) + (max(ms) - min(ms)) // 4 * 3 FROM msg) AS kept FROM msg")
def limit_time_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.limit_split(messages(spark, sf_dir), middle(spark, sf_dir)[1]).select("messageid", "kept")


@query("seek_window", "SELECT messageid FROM msg WHERE ms >= (SELECT min(ms) + (max(ms) - min(ms)) // 4 FROM msg) AND ms < (SELECT min(ms) + (max(ms) - min(ms)) // 4 * 3 FROM msg)")
def seek_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.seek_window(messages(spark, sf_dir), *middle(spark, sf_dir)).select("messageid")


@query("seek_snapshot", "SELECT messageid FROM msg WHERE event_id % 3 <> 0")
def seek_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_messages = messages(spark, sf_dir)
    acked = all_messages.where(F.col("messageid").cast("long") % 3 == 0)
    return admission.after_snapshot(all_messages, acked).select("messageid")


# Publish windows and metrics.


BATCHED = "(SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 700 AS batch FROM msg)"


def batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return admission.batches_by_count(arrivals(spark, sf_dir), "event_id", 700)


@query("publish_window_per_batch", f"SELECT batch, min(ms) AS oldest_ms, max(ms) AS newest_ms, count(*) AS messages FROM {BATCHED} GROUP BY batch")
def publish_window_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.publish_window(batched(spark, sf_dir))


NOW = 1_704_200_000_000


@query("newest_age", f"SELECT batch, greatest(0, {NOW} - max(ms)) AS age FROM {BATCHED} GROUP BY batch")
def newest_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.publish_window(batched(spark, sf_dir)).select("batch", metrics.newest_age(NOW, F.col("newest_ms")).alias("age"))


@query("source_metrics", f"""SELECT batch, count(*) AS "lastGatherMessageCount", sum(octet_length(encode(body)))::BIGINT AS "lastGatherPayloadBytes", greatest(0, {NOW} - max(ms)) AS "lastGatherNewestMessageAgeMs", batch AS "lastProducedBatchId" FROM {BATCHED} GROUP BY batch""")
def source_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.batch_metrics(batched(spark, sf_dir), NOW)


# Control scalars over the events as if they were cycles: value is a time in hundredths of a second.


def cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("event_id", "user_id", F.round(F.col("value") * 10_000_000).cast("long").alias("nanos"), F.get_json_object("props", "$.k").cast("int").alias("n"))


CYCLES = "(SELECT event_id, user_id, CAST(round(value * 10000000) AS BIGINT) AS nanos, CAST(json_extract(props, '$.k') AS INT) AS n FROM events)"


@query("whole_second", f"SELECT event_id, CASE WHEN nanos <= 0 THEN 0 WHEN (nanos + {SNAP}) // {SECOND} > nanos // {SECOND} THEN (nanos + {SNAP}) // {SECOND} * {SECOND} ELSE nanos // {SECOND} * {SECOND} END AS snapped FROM {CYCLES}")
def whole_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("nanos")
    floor = lambda x: F.floor(x / F.lit(SECOND).cast("decimal(20,0)")).cast("long")
    near = floor(c + SNAP)
    return cycles(spark, sf_dir).select("event_id", F.when(c <= 0, F.lit(0)).otherwise(F.greatest(near, floor(c)) * SECOND).cast("long").alias("snapped"))


@query("rates", f"SELECT event_id, CASE WHEN n > 0 AND nanos > 0 THEN n::BIGINT * {SECOND} // nanos ELSE 0 END AS per_second FROM {CYCLES}")
def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = F.expr(f"n * {SECOND}L div nanos")
    return cycles(spark, sf_dir).select("event_id", F.when((F.col("n") > 0) & (F.col("nanos") > 0), rate).otherwise(F.lit(0)).cast("long").alias("per_second"))


@query("tail_reserve", f"""SELECT event_id, (list_sort(l)[(len(l) + 1) // 2] + list_sort(l)[len(l) // 2 + 1]) // 2 AS median, CAST(floor(least(2000000000, round(list_stddev_pop(l))) / 1000000) AS BIGINT) AS spread_ms
FROM (SELECT event_id, list(nanos) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN {ROUND - 1} PRECEDING AND CURRENT ROW) AS l FROM {CYCLES})""")
def tail_reserve(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(1 - ROUND, 0)
    held = F.array_sort(F.collect_list("nanos").over(last))
    rows = cycles(spark, sf_dir).select("event_id", held.alias("l"), F.stddev_pop("nanos").over(last).alias("s"))
    n = F.size("l")
    low, high = F.element_at("l", F.floor((n + 1) / 2).cast("int")), F.element_at("l", F.floor(n / 2).cast("int") + 1)
    return rows.select("event_id", F.floor((low + high) / 2).cast("long").alias("median"), F.floor(F.least(F.lit(2e9), F.round("s")) / 1_000_000).cast("long").alias("spread_ms"))


@query("retryable_errors", """SELECT event_id, regexp_matches(message, '(?i)unavailable|deadline|resource_exhausted|aborted|internal|timeout|temporarily') AS retryable FROM (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'UNAVAILABLE: gone' WHEN 1 THEN 'Deadline exceeded' WHEN 2 THEN 'not found' WHEN 3 THEN 'RESOURCE_EXHAUSTED' WHEN 4 THEN 'permission denied' ELSE 'read Timeout' END AS message FROM events)""")
def retryable_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.element_at(F.array(*map(F.lit, ("UNAVAILABLE: gone", "Deadline exceeded", "not found", "RESOURCE_EXHAUSTED", "permission denied", "read Timeout"))), (event_id() % 6).cast("int") + 1)
    return events(spark, sf_dir).select("event_id", retryable_message(said).alias("retryable"))


@query("fatal_errors", """SELECT event_id, status IN ('NOT_FOUND', 'PERMISSION_DENIED', 'UNAUTHENTICATED', 'INVALID_ARGUMENT') AS fatal FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'NOT_FOUND' WHEN 1 THEN 'UNAVAILABLE' WHEN 2 THEN 'UNAUTHENTICATED' ELSE 'ABORTED' END AS status FROM events)""")
def fatal_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(F.array(*map(F.lit, ("NOT_FOUND", "UNAVAILABLE", "UNAUTHENTICATED", "ABORTED"))), (event_id() % 4).cast("int") + 1)
    return events(spark, sf_dir).select("event_id", fatal_status(status).alias("fatal"))


@query("parse_durations", "SELECT event_id, event_id * CASE event_id % 4 WHEN 0 THEN 1 WHEN 2 THEN 60000 ELSE 1000 END AS ms FROM events")
def parse_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.element_at(F.array(*map(F.lit, ("ms", "s", "m", ""))), (event_id() % 4).cast("int") + 1)
    return events(spark, sf_dir).select("event_id", values.duration_ms(F.concat(F.lit(" "), event_id().cast("string"), unit)).alias("ms"))


@query("parse_sizes", "SELECT event_id, event_id * CASE event_id % 4 WHEN 0 THEN 1024 WHEN 1 THEN 1048576 WHEN 2 THEN 1073741824 ELSE 1 END AS bytes FROM events")
def parse_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    unit = F.element_at(F.array(*map(F.lit, ("k", "M", "g", ""))), (event_id() % 4).cast("int") + 1)
    return events(spark, sf_dir).select("event_id", values.size_bytes(F.concat(event_id().cast("string"), unit)).alias("bytes"))


@query("parse_instants", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id * 1000 WHEN event_id % 3 = 0 THEN NULL ELSE 1705314600000 + event_id % 20 * 1000 - 3600000 END AS ms FROM events")
def parse_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = F.concat(F.lit("2024-01-15T10:30:"), F.lpad((event_id() % 20).cast("string"), 2, "0"))
    text = F.when(event_id() % 2 == 0, (event_id() * 1000).cast("string")).when(event_id() % 3 == 0, dated).otherwise(F.concat(dated, F.lit("+01:00")))
    return events(spark, sf_dir).select("event_id", values.instant_ms(text).alias("ms"))


@query("resource_paths", "SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'projects/p/subscriptions/s' || event_id ELSE 'projects/q/subscriptions/s' || event_id END AS path FROM events")
def resource_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.when(event_id() % 2 == 0, "s").otherwise("projects/q/subscriptions/s"), event_id().cast("string"))
    return events(spark, sf_dir).select("event_id", values.resource_path(F.lit("p"), "subscriptions", name).alias("path"))


DEFINITION = """{"type": "record", "name": "r", "fields": [{"name": "id", "type": "string"}, {"name": "at", "type": {"type": "long", "logicalType": "timestamp-millis"}},
 {"name": "label", "type": ["null", "string"]}, {"name": "tags", "type": {"type": "array", "items": "int"}}, {"name": "stats", "type": {"type": "map", "values": "double"}},
 {"name": "kind", "type": {"type": "enum", "name": "k", "symbols": ["A"]}}, {"name": "raw", "type": "bytes"}, {"name": "inner", "type": ["null", {"type": "record", "name": "i", "fields": [{"name": "x", "type": "float"}]}]}]}"""


@query("avro_schema_fields", "SELECT * FROM (VALUES ('id', 'string', false), ('at', 'bigint', false), ('label', 'string', true), ('tags', 'array<int>', false), ('stats', 'map<string,double>', false), ('kind', 'string', false), ('raw', 'binary', false), ('inner', 'struct<x:float>', true)) t(name, kind, nullable)")
def avro_schema_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(f.name, f.dataType.simpleString(), f.nullable) for f in struct_of(DEFINITION).fields], "name string, kind string, nullable boolean")


GAME_FIELDS = "eventId string, gameId string, homeTeam string, awayTeam string, scoringTeam string, eventType string, points int, period int, clockMillis long, isFastBreak boolean, shotDistanceFt double, foulCount double, playerId string, playerName string, jersey int, lineup string, rebounds int, assists int"


@query("game_events", """SELECT 'evt-' || i AS "eventId", 'game-' || (i % 4 + 1) AS "gameId", CASE WHEN i % 4 = 0 THEN 'SCORE' WHEN i % 4 = 1 THEN 'FOUL' WHEN i % 4 = 2 THEN 'TIMEOUT' ELSE 'SUBSTITUTION' END AS "eventType", CAST(CASE WHEN i % 4 = 0 THEN 1 + i % 3 ELSE 0 END AS INT) AS points, 720000 - 1000 * i AS "clockMillis", i % 5 = 0 AS "isFastBreak", 5.5::DOUBLE + i % 20 AS "shotDistanceFt", 'p-' || (i % 12) AS "playerId", CAST(10 + i % 15 AS INT) AS jersey FROM range(100) t(i)""")
def game_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A record of many types, decoded by name."""
    i = F.col("id")
    kind = F.element_at(F.array(*map(F.lit, ("SCORE", "FOUL", "TIMEOUT", "SUBSTITUTION"))), (i % 4).cast("int") + 1)
    points = F.when(i % 4 == 0, 1 + i % 3).otherwise(0)
    body = F.to_json(F.struct(F.concat(F.lit("evt-"), i).alias("eventId"), F.concat(F.lit("game-"), i % 4 + 1).alias("gameId"), kind.alias("eventType"), points.alias("points"), (720000 - 1000 * i).alias("clockMillis"), (i % 5 == 0).alias("isFastBreak"), (5.5 + i % 20).alias("shotDistanceFt"), F.concat(F.lit("p-"), i % 12).alias("playerId"), (10 + i % 15).alias("jersey")))
    rows = spark.range(100).select(F.encode(body, "UTF-8").alias("body"))
    wanted = [f for f in T._parse_datatype_string(GAME_FIELDS).fields if f.name in ("eventId", "gameId", "eventType", "points", "clockMillis", "isFastBreak", "shotDistanceFt", "playerId", "jersey")]
    rows, found = payload_fields(rows, [(f.name, f.dataType) for f in wanted])
    return rows.select(*(c.alias(f.name) for f, c in zip(wanted, found, strict=True)))
