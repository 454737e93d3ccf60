"""Window functions, and event-time windows over the finished events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.operators import shapes
from sparkloom.streaming import windows as tw

from .registry import Tables, query, sql

sql("win_rank", """SELECT o_orderkey, cast(row_number() OVER w AS INT) AS rn, cast(rank() OVER p AS INT) AS rk, cast(dense_rank() OVER p AS INT) AS dr, round(percent_rank() OVER p, 6) AS pr, round(cume_dist() OVER p, 6) AS cd, cast(ntile(4) OVER w AS INT) AS q
FROM orders WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey), p AS (PARTITION BY o_orderpriority ORDER BY o_orderstatus)""")
sql("win_lag_lead", """SELECT event_id, lag(value) OVER w AS prev, lead(value, 2) OVER w AS next2, first_value(event_id) OVER w AS f, nth_value(event_id, 3) OVER w AS n3
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
sql("win_last_ignore_nulls", """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END) IGNORE NULLS OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l FROM events""",
    """SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS l FROM events""")  # fmt: skip
sql("win_running", """SELECT o_orderkey, sum(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS s,
 count(*) OVER (PARTITION BY o_custkey) AS n FROM orders""", """SELECT o_orderkey, (sum(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))::BIGINT AS s,
 count(*) OVER (PARTITION BY o_custkey) AS n FROM orders""")  # fmt: skip
sql("win_range_frame", "SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '1' DAY PRECEDING AND CURRENT ROW) AS n FROM events")

BUCKET = "SELECT time_bucket(INTERVAL '{0}', ts, TIMESTAMP '1970-01-01') AS window_start, time_bucket(INTERVAL '{0}', ts, TIMESTAMP '1970-01-01') + INTERVAL '{0}' AS window_end, event_type, count(*) AS n FROM events GROUP BY ALL"


def plain_times(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@query("tumbling", BUCKET.format("1 hour"))
def tumbling(t: Tables) -> DataFrame:
    return plain_times(tw.windowed(t.events, "ts", "1 hour", None, [F.count("*").alias("n")], ("event_type",)), "window_start", "window_end")


@query("sliding", """SELECT w AS window_start, w + INTERVAL '1 hour' AS window_end, count(*) AS n
FROM (SELECT ts, unnest([time_bucket(INTERVAL '30 minutes', ts, TIMESTAMP '1970-01-01'), time_bucket(INTERVAL '30 minutes', ts, TIMESTAMP '1970-01-01') - INTERVAL '30 minutes']) AS w FROM events) GROUP BY w""")  # fmt: skip
def sliding(t: Tables) -> DataFrame:
    return plain_times(tw.windowed(t.events, "ts", "1 hour", "30 minutes", [F.count("*").alias("n")]), "window_start", "window_end")


@query("session", """SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL '2 hours' AS session_end, count(*) AS n FROM (
SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (
SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '2 hours' THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")  # fmt: skip
def session(t: Tables) -> DataFrame:
    return plain_times(tw.sessions(t.events, "ts", "2 hours", [F.count("*").alias("n")], ("user_id",)), "session_start", "session_end")


@query("series_gap_fill", """SELECT event_type, user_id, day, coalesce(n, 0) AS n FROM
(SELECT event_type, user_id, unnest(generate_series(a, b, INTERVAL '1 day'))::DATE AS day FROM (SELECT event_type, user_id, min(ts)::DATE AS a, max(ts)::DATE AS b FROM events GROUP BY ALL))
LEFT JOIN (SELECT event_type, user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL) USING (event_type, user_id, day)""")  # fmt: skip
def series_gap_fill(t: Tables) -> DataFrame:
    d = t.events.groupBy("event_type", "user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return shapes.days_filled(d, "day", "n", ["event_type", "user_id"])


@query("win_qualify", "SELECT event_id, user_id FROM events QUALIFY sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= 1000")
def win_qualify(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy(*shapes.ordered("ts", "event_id")).rowsBetween(Window.unboundedPreceding, 0)
    return shapes.qualify(t.events, F.sum("value").over(w), lambda x: x <= 1000).select("event_id", "user_id")


@query("tumbling_time", "SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 day' - INTERVAL '1 microsecond' AS at, count(*) AS n FROM events GROUP BY 1")
def tumbling_time(t: Tables) -> DataFrame:
    """The time of a window, by which windows may be grouped again."""
    d = t.events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day").alias("w")).agg(F.count("*").alias("n"))
    return d.select(F.window_time("w").cast("timestamp_ntz").alias("at"), "n")
