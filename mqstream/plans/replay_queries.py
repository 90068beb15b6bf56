"""Control algorithms replayed over stored traces, one queue at a time and in order."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.admission import Limits, ReadLimit, fits
from ..streaming import memory
from ..streaming.pacing import SECOND, Cycle, Pace, Phase, finished, observed, probed
from .catalog import events, query


def replay(traces: DataFrame, queue: str, order: str, fold, schema: str) -> DataFrame:  # noqa: ANN001
    """``fold(state, row) -> (state, output)`` over each queue's rows in order. Rows stream through sorted partitions, so a
    task holds one queue's state and never its rows."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, None
        for pdf in parts:
            out = []
            for row in pdf.itertuples(index=False):
                if (q := getattr(row, queue)) != at:
                    at, state = q, None
                state, values = fold(state, row)
                out.append(values)
            yield pd.DataFrame(out, columns=names)

    return traces.repartition(F.col(queue)).sortWithinPartitions(queue, order).mapInPandas(run, schema)


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings of their user's queue: k is a percentage, value an age or a size."""
    return events(spark, sf_dir).select("user_id", "event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), F.get_json_object("props", "$.k").cast("int").alias("k"), F.round(F.col("value") * 1000).cast("long").alias("amount"))


#: The traces for DuckDB, each queue's readings numbered.
READINGS = """WITH RECURSIVE e AS (SELECT user_id, event_id, epoch_ms(ts) AS ms, CAST(json_extract(props, '$.k') AS INT) AS k, CAST(round(value * 1000) AS BIGINT) AS amount,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM (SELECT *, date_trunc('millisecond', ts) AS at FROM events))"""


@query("intake_pace", READINGS + """,
r AS (SELECT user_id, event_id, n, ms AS since, amount AS age, greatest(0, amount - 60000) AS excess, '' AS warning FROM e WHERE n = 1
  UNION ALL SELECT e.user_id, e.event_id, e.n, CASE WHEN full_hour THEN e.ms ELSE since END, CASE WHEN full_hour THEN amount ELSE age END,
    CASE WHEN full_hour THEN greatest(0, amount - 60000) ELSE least(excess, greatest(0, amount - 60000)) END,
    CASE WHEN NOT full_hour THEN '' WHEN amount > age THEN 'falling behind: the newest message is ' || amount || ' ms old, ' || (amount - age) || ' ms more than an hour ago'
      WHEN least(excess, amount - 60000) > 0 THEN 'lagging: for an hour the newest message was never less than ' || least(excess, amount - 60000) || ' ms older than the trigger interval' ELSE '' END
  FROM (SELECT e.*, r.since, r.age, r.excess, e.ms - r.since >= 3600000 AS full_hour FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1) e)
SELECT user_id, event_id, warning FROM r""")
def intake_pace(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fold(state, row):  # noqa: ANN001, ANN202
        hour, warning = observed(state, row.ms, row.amount, 60_000)
        return hour, (row.user_id, row.event_id, warning or "")

    return replay(traces(spark, sf_dir), "user_id", "event_id", fold, "user_id long, event_id long, warning string")


@query("budget_walk_trace", READINGS + """,
s AS (SELECT 0 AS zero, 4294967296 // 64 AS first, 1048576::BIGINT AS mib),
r AS (SELECT user_id, event_id, n - 1 AS n, first AS size, first // 8 AS move, 0 AS calm, 0 AS hot, 0 AS near, false AS shrank FROM e, s WHERE n = 1
  UNION ALL SELECT user_id, event_id, n, new_size, CASE WHEN new_size = size THEN move ELSE greatest(abs(new_size - size), mib) END,
    CASE WHEN k >= 50 OR new_size > size THEN 0 ELSE cool END, CASE WHEN k >= 50 AND hot + 1 < 2 THEN hot + 1 ELSE 0 END,
    CASE WHEN k >= 40 OR new_size > size THEN 0 ELSE closer END, CASE WHEN new_size < size THEN true WHEN new_size > size THEN false ELSE shrank END
  FROM (SELECT *, CASE WHEN k >= 50 AND hot + 1 >= 2 AND size > 4 * mib THEN greatest(size - greatest(move // 2, mib), 4 * mib)
      WHEN k < 50 AND cool >= 8 AND 10 * 64 * mib >= 9 * size AND size < 2 * first
        THEN least(size + CASE WHEN shrank OR closer >= 2 OR 2 * first - size <= 2 * move THEN greatest(move // 2, mib) WHEN k < 30 AND move < first // 8 THEN least(greatest(2 * move, mib), first // 8) ELSE move END, 2 * first)
      ELSE size END AS new_size
    FROM (SELECT e.*, r.size, r.move, r.hot, r.shrank, s.first, s.mib, CASE WHEN e.k < 40 THEN r.calm + 1 ELSE 0 END AS cool, CASE WHEN e.k >= 35 THEN r.near + 1 ELSE r.near END AS closer
      FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1, s)))
SELECT user_id, event_id, size AS budget, move, calm, hot FROM r WHERE n > 0""")
def budget_walk_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A process of 4 GiB on a host with 2 GiB free, whose gathers are of 64 MiB and use k percent of the memory."""

    def fold(state, row):  # noqa: ANN001, ANN202
        budget = (state or memory.Budget.start(0, 4 << 30)).after(memory.Reading(int(row.k), 2 << 30, 64 << 20))
        return budget, (row.user_id, row.event_id, budget.size, budget.move, budget.streaks.calm, budget.streaks.hot)

    return replay(traces(spark, sf_dir), "user_id", "event_id", fold, "user_id long, event_id long, budget long, move long, calm int, hot int")


#: The rules of ``pacing`` for these cycles, in nanoseconds: the interval stays 60 s, as no eight cycles in a row are of one other length.
AUTO_RECEIVE = READINGS + """,
c AS (SELECT 60000000000::BIGINT AS i, 1000000000::BIGINT AS s, 1800000000::BIGINT AS step),
r AS (SELECT user_id, event_id, n, 0::BIGINT AS receive, 0::BIGINT AS reserve, []::BIGINT[] AS tails FROM e WHERE n = 1
  UNION ALL SELECT user_id, event_id, n, CASE WHEN n = 2 THEN 0 WHEN n = 3 THEN 30000000000 ELSE greatest(CASE WHEN room < receive THEN room ELSE least(room, receive + greatest(0, rise)) END, s, i // 4) END,
    CASE WHEN n = 2 THEN 0 WHEN n = 3 THEN 29000000000 ELSE set_aside END, CASE WHEN n < 4 THEN [] ELSE seen_tails END
  FROM (SELECT *, greatest(0, i - set_aside) AS room, CASE WHEN known THEN CASE WHEN fresh OR calm THEN step ELSE 0 END WHEN calm AND spare THEN climb ELSE 0 END AS rise
  FROM (SELECT *, CASE WHEN known AND calm AND spare THEN greatest(s, reserve - step) WHEN known AND fresh THEN stepped WHEN known AND calm THEN least(reserve, stepped)
      WHEN NOT known AND late AND NOT high THEN reserve + over_by WHEN NOT known AND calm AND spare AND climb > 0 AND climb < unused THEN greatest(s, reserve - climb) ELSE reserve END AS set_aside
  FROM (SELECT *, reserve + greatest(-step, least(step, tail - reserve)) AS stepped
  FROM (SELECT *, CASE WHEN m = 0 THEN 0 ELSE (sorted[(m - 1) // 2 + 1] + sorted[m // 2 + 1]) // 2 + CASE WHEN m > 1 THEN least(floor(sqrt(list_sum(list_transform(seen_tails, lambda t: (t - mean) * (t - mean))) / m))::BIGINT, 2 * s) ELSE 0 END END AS tail
  FROM (SELECT *, len(seen_tails) AS m, len(seen_tails) > 0 AS known, seen OR len(seen_tails) >= 8 AS fresh, list_sort(seen_tails) AS sorted, list_sum(seen_tails)::DOUBLE / greatest(1, len(seen_tails)) AS mean,
      waited AND unused > i // 8 AND over_by <= s // 10 AS spare, CASE WHEN high THEN step ELSE unused // 4 END AS climb
  FROM (SELECT *, CASE WHEN seen THEN list_append(tails, took)[-8:] ELSE tails END AS seen_tails, greatest(0, length - receive - took) AS unused
  FROM (SELECT *, late AND (high OR (len(tails) > 0 AND receive >= i // 2)) AS seen
  FROM (SELECT *, CASE WHEN calm THEN s ELSE greatest(s, length - receive) END AS took, NOT waited AND over_by > s AS late, receive >= i - i // 4 AS high
  FROM (SELECT *, waited OR over_by = 0 AS calm
  FROM (SELECT *, length - i AS over_by, length - receive - s <= greatest(0, i - receive - s) + s OR least(abs(length - i), abs(length - i - s)) <= s // 10 AS waited
  FROM (SELECT e.user_id, e.event_id, e.n, c.*, r.receive, r.reserve, r.tails, greatest(c.i, r.receive + e.k::BIGINT * c.s // 2) AS length FROM r JOIN e ON e.user_id = r.user_id AND e.n = r.n + 1, c))))))))))))
SELECT user_id, event_id, CASE WHEN n < 3 THEN 'probe' WHEN n = 3 THEN 'warmup' ELSE 'cruise' END AS phase, CASE WHEN n < 3 THEN 0 ELSE 60000000000 END AS budget, receive, reserve AS write FROM r"""


@query("auto_receive_trace", AUTO_RECEIVE)
def auto_receive_trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cycles of a minute that commit a second after receiving and then work on, k/2 seconds in all: some end before the
    trigger, others are late."""

    def fold(state, row):  # noqa: ANN001, ANN202
        pace, begun = state or (Pace.start(None, "batch"), 0)
        if pace.phase is Phase.PROBE:
            pace, begun = (pace if begun == 0 else probed(pace, 60 * SECOND)), begun + 1
        else:
            work = row.k * SECOND // 2
            pace = finished(pace, Cycle(max(60 * SECOND, pace.window() + work), pace.window(), SECOND, 100))
        return (pace, begun), (row.user_id, row.event_id, pace.phase.value, pace.interval, pace.receive, pace.reserve)

    return replay(traces(spark, sf_dir), "user_id", "event_id", fold, "user_id long, event_id long, phase string, budget long, receive long, write long")


@query("limits_composite", "SELECT * FROM (VALUES (5::BIGINT, 1000::BIGINT, 3::BIGINT, 250::BIGINT, true, false)) t(max_rows, max_bytes, min_rows, wait_ms, alone, over)")
def limits_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    limit = ReadLimit(parts=(ReadLimit(max_rows=5, min_rows=2), ReadLimit(parts=(ReadLimit(max_bytes=4096, min_rows=3, max_delay_ms=250),))))
    x = Limits.of(10, 0, limit, 500).with_budget(1000)
    return spark.createDataFrame([(x.max_rows, x.max_bytes, x.min_rows, x.wait_ms, fits(0, 10**9, 5), fits(4, 2, 5))], "max_rows long, max_bytes long, min_rows long, wait_ms long, alone boolean, over boolean")
