"""What a reader of the queue composes from the engine's own operators: joins, aggregates, windows and sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.temporal import asof_join, interval_join, sessions
from .catalog import events, messages, plain, query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def k_of() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


SQL_K = "CAST(json_extract(props, '$.k') AS BIGINT)"


@query("tumbling_window", "SELECT event_type, time_bucket(INTERVAL 1 HOUR, publishtime) AS start, count(*) AS n FROM msg GROUP BY ALL")
def tumbling_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir).withColumn("event_type", F.col("attributes")["event_type"])
    return plain(rows.groupBy("event_type", F.window("publishtime", "1 hour").alias("w")).agg(F.count("*").alias("n")).select("event_type", F.col("w.start").alias("start"), "n"))


@query("sliding_window", "SELECT start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, publishtime), time_bucket(INTERVAL 30 MINUTE, publishtime) - INTERVAL 30 MINUTE]) AS start FROM msg) GROUP BY start")
def sliding_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(messages(spark, sf_dir).groupBy(F.window("publishtime", "1 hour", "30 minutes").alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n"))


@query("session_window", """SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s""")
def session_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(events(spark, sf_dir), "user_id", "ts", "30 minutes")


@query("deduplicate", "SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY ALL")
def deduplicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("user_id", "event_type").agg(F.min("event_id").alias("first"))


@query("distinct_counts", f"SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT {SQL_K}) AS ks FROM events GROUP BY event_type")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumn("k", k_of()).groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("k").alias("ks"))


@query("approximate_quantiles", "SELECT event_type, quantile_disc(value, 0.5) AS median, quantile_disc(value, 0.9) AS high FROM events GROUP BY event_type")
def approximate_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantiles in bounded memory, whose rank may be off by a ten-thousandth of the rows."""
    return events(spark, sf_dir).groupBy("event_type").agg(F.percentile_approx("value", 0.5, 10_000).alias("median"), F.percentile_approx("value", 0.9, 10_000).alias("high"))


@query("interval_join", "SELECT p.event_id AS purchase, c.event_id AS click FROM events p JOIN events c ON p.user_id = c.user_id AND p.event_type = 'purchase' AND c.event_type = 'click' AND c.ts >= p.ts - INTERVAL 2 HOUR AND c.ts <= p.ts")
def interval_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    purchases = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase"), F.col("ts").alias("at"))
    clicks = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("click"), F.col("ts").alias("ts"))
    return interval_join(purchases, clicks, "user_id", "at", "ts", 2 * 3600).select("purchase", "click")


@query("asof_join", "SELECT p.event_id AS purchase, c.event_id AS click FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'click' GROUP BY ALL) c ON p.user_id = c.user_id AND p.ts >= c.ts")
def asof_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    left = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("purchase"))
    right = e.where("event_type = 'click'").groupBy("user_id", "ts").agg(F.max("event_id").alias("click"))
    return asof_join(left, right, "user_id", "ts", ["purchase"], ["click"])


@query("rollup", "SELECT event_type, user_id % 10 AS bucket, count(*) AS n FROM events GROUP BY ROLLUP (event_type, bucket)")
def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumn("bucket", F.col("user_id") % 10).rollup("event_type", "bucket").agg(F.count("*").alias("n"))


@query("cube", "SELECT event_type, user_id % 10 AS bucket, count(*) AS n FROM events GROUP BY CUBE (event_type, bucket)")
def cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumn("bucket", F.col("user_id") % 10).cube("event_type", "bucket").agg(F.count("*").alias("n"))


@query("ranking", "SELECT event_id, row_number() OVER w AS n, rank() OVER w AS r, dense_rank() OVER w AS d FROM (SELECT event_id, user_id, " + SQL_K + " AS k FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY k, event_id)")
def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("k", "event_id")
    rows = events(spark, sf_dir).withColumn("k", k_of())
    return rows.select("event_id", F.row_number().over(w).cast("long").alias("n"), F.rank().over(w).cast("long").alias("r"), F.dense_rank().over(w).cast("long").alias("d"))


@query("running_totals", "SELECT event_id, sum(k) OVER w AS total, lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM (SELECT event_id, user_id, " + SQL_K + " AS k FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")
def running_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    return events(spark, sf_dir).withColumn("k", k_of()).select("event_id", F.sum("k").over(w.rowsBetween(-4, 0)).alias("total"), F.lag("event_id").over(w).alias("before"))


@query("top_k", "SELECT event_type, event_id FROM (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS n FROM events) WHERE n <= 5")
def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("event_type").orderBy(F.desc("value"), "event_id")
    return events(spark, sf_dir).withColumn("n", F.row_number().over(w)).where("n <= 5").select("event_type", "event_id")


@query("set_operations", "SELECT 'both' AS op, user_id FROM (SELECT user_id FROM events WHERE event_type = 'click' INTERSECT SELECT user_id FROM events WHERE event_type = 'purchase') UNION ALL SELECT 'only', user_id FROM (SELECT user_id FROM events WHERE event_type = 'click' EXCEPT SELECT user_id FROM events WHERE event_type = 'error' AND value > 50) UNION ALL SELECT 'any', user_id FROM (SELECT user_id FROM events WHERE event_type = 'view' UNION SELECT user_id FROM events WHERE event_type = 'signup')")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda condition: events(spark, sf_dir).where(condition).select("user_id")
    both = of("event_type = 'click'").intersect(of("event_type = 'purchase'"))
    only = of("event_type = 'click'").subtract(of("event_type = 'error' AND value > 50"))
    either = of("event_type = 'view'").union(of("event_type = 'signup'")).distinct()
    return both.select(F.lit("both").alias("op"), "user_id").union(only.select(F.lit("only"), "user_id")).union(either.select(F.lit("any"), "user_id"))


@query("semi_anti", "SELECT c_custkey, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS ordered FROM customer")
def semi_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return customers.join(orders, "c_custkey", "left_semi").withColumn("ordered", F.lit(True)).union(customers.join(orders, "c_custkey", "left_anti").withColumn("ordered", F.lit(False)))


@query("stream_enrichment", "SELECT n_name, event_type, count(*) AS n FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def stream_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages joined to stored tables."""
    rows = messages(spark, sf_dir).select(F.col("orderingkey").cast("long").alias("c_custkey"), F.col("attributes")["event_type"].alias("event_type"))
    joined = rows.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_custkey").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name", "event_type").agg(F.count("*").alias("n"))


@query("pricing_summary", "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").where("l_shipdate <= TIMESTAMP_NTZ '1998-09-02'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("regional_revenue", "SELECT r_name, n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def regional_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    j = t("lineitem").select("l_orderkey", "l_extendedprice", "l_discount").join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    j = j.join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy("r_name", "n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
