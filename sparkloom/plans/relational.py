"""Scans, filters, joins, aggregates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.operators import joins, shapes
from sparkloom.sources import files

from .registry import Tables, query, sql

MONEY = "decimal(18,4)"


def total(x: str):  # noqa: ANN201
    """An exact sum of a double column of money, whatever the order of rows."""
    return F.sum(F.col(x).cast(MONEY)).cast("double")


@query("pricing_summary", """
SELECT l_returnflag, l_linestatus, sum(l_quantity::DECIMAL(18,4))::DOUBLE AS sum_qty, sum(l_extendedprice::DECIMAL(18,4))::DOUBLE AS sum_base_price,
       round(avg(l_discount), 6) AS avg_disc, count(*)::BIGINT AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")  # fmt: skip
def pricing_summary(t: Tables) -> DataFrame:
    d = t.lineitem.where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return d.groupBy("l_returnflag", "l_linestatus").agg(
        total("l_quantity").alias("sum_qty"), total("l_extendedprice").alias("sum_base_price"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("count_order")
    )


sql("revenue_filter", """SELECT cast(sum(cast(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS revenue, count(*) AS n FROM lineitem
WHERE l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01' AND l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24""")


@query("scan_project_exclude", "SELECT * EXCLUDE (p_name, p_retailprice), p_size AS a, p_size AS b FROM part")
def scan_project_exclude(t: Tables) -> DataFrame:
    return t.part.drop("p_name", "p_retailprice").withColumns({"a": F.col("p_size"), "b": F.col("p_size")})


sql("scan_from_first", "FROM nation")
sql("scan_values", "SELECT * FROM (VALUES (1, 'a'), (2, 'b'), (3, NULL)) AS v(x, y)")


@query("scan_series", "SELECT generate_series FROM generate_series(1, 500) UNION ALL SELECT * FROM range(100, 200, 7)")
def scan_series(t: Tables) -> DataFrame:
    return files.series(t.spark, 1, 500).union(t.spark.range(100, 200, 7))


@query("scan_arrow", "SELECT n_regionkey, count(*) AS n, sum(n_nationkey)::BIGINT AS s, max(upper(n_name)) AS m FROM nation WHERE n_nationkey % 2 = 0 GROUP BY n_regionkey")
def scan_arrow(t: Tables) -> DataFrame:
    """In-memory Arrow data under a view's name, filtered and aggregated; another table may take over the name."""
    files.arrow(t.spark, t.region.toArrow(), "arrow_rows")
    files.arrow(t.spark, t.nation.toArrow(), "arrow_rows")
    return t.spark.sql("SELECT n_regionkey, count(*) AS n, sum(n_nationkey) AS s, max(upper(n_name)) AS m FROM arrow_rows WHERE n_nationkey % 2 = 0 GROUP BY n_regionkey")


@query("scan_all_types", """SELECT * FROM (VALUES (1, false, (-128)::TINYINT, (-32768)::SMALLINT, (-2147483648)::INT, (-9223372036854775808)::BIGINT, (-1e300)::DOUBLE, (-99999999999999999.99)::DECIMAL(19,2), '', DATE '0001-01-01', TIMESTAMP '1900-01-01 00:00:00', 0),
(2, true, 127::TINYINT, 32767::SMALLINT, 2147483647::INT, 9223372036854775807::BIGINT, 1e300::DOUBLE, 99999999999999999.99::DECIMAL(19,2), '🦆 é', DATE '9999-12-31', TIMESTAMP '2999-12-31 23:59:59.999999', 3),
(3, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL)) v(k, bool, tiny, small, int, big, double, dec, text, day, moment, items)""")  # fmt: skip
def scan_all_types(t: Tables) -> DataFrame:
    return files.all_types(t.spark).withColumn("items", F.when(F.col("list").isNotNull(), F.size("list"))).drop("list", "blob", "float", "record", "mapping", "zoned")


@query("scan_rowid", "SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1)::BIGINT AS rowid FROM orders")
def scan_rowid(t: Tables) -> DataFrame:
    return files.with_ordinal(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


sql("filter_forms", """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_totalprice > 100000 THEN 'big' ELSE 'small' END AS size_class,
 -o_orderkey AS neg, coalesce(nullif(o_orderstatus, 'O'), 'open') AS status FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AND o_orderstatus IS NOT NULL AND (o_orderkey <> 5 OR NOT o_totalprice < 10) AND o_orderpriority LIKE '%-%'""")
sql("filter_false", "SELECT n_name FROM nation WHERE false")
sql("filter_exists", "SELECT c_custkey FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)")
sql("filter_subquery", "SELECT p_partkey, p_size FROM part WHERE p_size > (SELECT avg(p_size) FROM part)")

sql("join_inner_3way", """SELECT c_mktsegment, count(*) AS n, cast(sum(cast(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS revenue
FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey GROUP BY c_mktsegment""")


@query("join_semi", "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)")
def join_semi(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem.where("l_quantity > 45"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@query("join_anti", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def join_anti(t: Tables) -> DataFrame:
    return t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


sql("null_tests_outer", """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders o ON c_custkey = o_custkey AND o_orderpriority = '1-URGENT'
WHERE o_orderkey IS NULL OR o_orderkey % 2 = 0""")
sql("join_full_outer", """SELECT coalesce(s.k, c.k) AS nation, ns, nc FROM (SELECT s_nationkey + 3 AS k, count(*) AS ns FROM supplier GROUP BY s_nationkey) s
FULL JOIN (SELECT c_nationkey AS k, count(*) AS nc FROM customer GROUP BY c_nationkey) c ON s.k = c.k""")
sql("join_right", "SELECT n_name, r_name FROM nation RIGHT JOIN region ON n_nationkey = r_regionkey * 7")
sql("join_theta", "SELECT a.n_name AS x, b.n_name AS y FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey <> b.n_regionkey")
sql("join_natural", "SELECT a.r_name AS x, b.r_name AS y FROM region a NATURAL JOIN region b")
sql("filter_not_in_nulls", "SELECT n_name FROM nation WHERE n_regionkey NOT IN (SELECT nullif(r_regionkey, 3) FROM region)")


@query("join_strategies", "SELECT r_name, n_name, 4 AS times FROM nation JOIN region ON n_regionkey = r_regionkey")
def join_strategies(t: Tables) -> DataFrame:
    on = F.col("n_regionkey") == F.col("r_regionkey")
    out = [joins.hinted(t.nation, t.region, on, s).select("r_name", "n_name") for s in joins.STRATEGIES]
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3]).groupBy("r_name", "n_name").agg(F.count("*").cast("int").alias("times"))


sql("join_cross", "SELECT r_name, n_name FROM region, nation")
sql("join_self_using", "SELECT a.n_name AS a_name, b.n_name AS b_name, n_regionkey FROM nation a JOIN nation b USING (n_regionkey) WHERE a.n_nationkey < b.n_nationkey")
sql("join_lateral", "SELECT r_name, x.n_name FROM region, LATERAL (SELECT n_name FROM nation WHERE n_regionkey = r_regionkey ORDER BY n_name LIMIT 2) x")


@query("join_range", """SELECT a.event_id, b.event_id AS near_id FROM events a JOIN events b
ON epoch(b.ts) BETWEEN epoch(a.ts) AND epoch(a.ts) + 600 AND a.user_id = b.user_id AND a.event_id <> b.event_id WHERE a.event_type = 'purchase'""")  # fmt: skip
def join_range(t: Tables) -> DataFrame:
    at = lambda c: F.expr(f"unix_micros(cast({c} AS timestamp)) / 1e6")
    a = t.events.where("event_type = 'purchase'").select(F.col("event_id").alias("event_id"), F.col("ts").alias("t0"), F.col("user_id").alias("u"))
    b = t.events.select(F.col("event_id").alias("near_id"), "ts", "user_id")
    out = joins.in_range(b, at("ts"), a, at("t0"), at("t0") + 600, 600.0, [("user_id", "u")])
    return out.where("event_id <> near_id").select("event_id", "near_id")


@query("join_asof", """SELECT p.event_id, v.event_id AS event_id_asof, v.value AS value_asof FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""")  # fmt: skip
def join_asof(t: Tables) -> DataFrame:
    p, v = t.events.where("event_type = 'purchase'"), t.events.where("event_type = 'view'")
    return joins.as_of(p, v, "user_id", "ts", "ts", ["event_id", "value"], "event_id").select("event_id", "event_id_asof", "value_asof")


GROUPS = "SELECT l_returnflag, l_linestatus, grouping(l_returnflag) AS g1, grouping(l_linestatus) AS g2, count(*) AS n FROM lineitem GROUP BY "
for kind, by in {"rollup": "ROLLUP (l_returnflag, l_linestatus)", "cube": "CUBE (l_returnflag, l_linestatus)", "grouping_sets": "GROUPING SETS ((l_returnflag), (l_linestatus), ())"}.items():
    as_long = GROUPS.replace("grouping(l_returnflag)", "cast(grouping(l_returnflag) AS INT)").replace("grouping(l_linestatus)", "cast(grouping(l_linestatus) AS INT)")
    sql(f"agg_{kind}", as_long + by)
sql("agg_global", "SELECT sum(o_orderkey) AS s, count(*) AS n, count(o_custkey) AS c, count(DISTINCT o_custkey) AS d, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders", "SELECT sum(o_orderkey)::BIGINT AS s, count(*) AS n, count(o_custkey) AS c, count(DISTINCT o_custkey) AS d, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders")
sql("agg_distinct", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS custs, count(DISTINCT o_orderpriority) AS prios FROM orders GROUP BY o_orderstatus")
sql("agg_filter_having", "SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count_if(o_totalprice > 200000) AS big FROM orders GROUP BY ALL HAVING count(*) > 10")
sql("agg_stats", """SELECT l_returnflag, round(stddev_samp(l_quantity), 4) AS sd, round(var_pop(l_quantity), 4) AS vp, round(corr(l_quantity, l_extendedprice), 4) AS c, round(covar_pop(l_quantity, l_discount), 6) AS cp,
 round(regr_slope(l_extendedprice, l_quantity), 2) AS slope, median(l_quantity) AS med, bool_or(l_tax > 0.07) AS any_tax, bit_xor(l_orderkey) AS bx, max_by(l_orderkey, l_orderkey) AS mb FROM lineitem GROUP BY l_returnflag""")
sql("agg_lists", "SELECT n_regionkey, array_join(sort_array(collect_list(n_name)), '|') AS names, listagg(n_name, ',') WITHIN GROUP (ORDER BY n_name) AS l FROM nation GROUP BY n_regionkey",
    "SELECT n_regionkey, string_agg(n_name, '|' ORDER BY n_name) AS names, string_agg(n_name, ',' ORDER BY n_name) AS l FROM nation GROUP BY n_regionkey")
sql("agg_quantiles", "SELECT event_type, percentile(value, 0.25) AS q1, percentile(value, 0.9) AS q9, mode() WITHIN GROUP (ORDER BY user_id % 3) AS m FROM events GROUP BY event_type",
    "SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.9) AS q9, mode(user_id % 3 ORDER BY user_id % 3) AS m FROM events GROUP BY event_type")


@query("agg_distinct_on", "SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey FROM orders ORDER BY o_custkey, o_totalprice DESC, o_orderkey")
def agg_distinct_on(t: Tables) -> DataFrame:
    return shapes.distinct_on(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], shapes.ordered("-o_totalprice", "o_orderkey")).drop("o_totalprice")


@query("pivot_status", """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F, count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
count(*) FILTER (WHERE o_orderstatus = 'P') AS P FROM orders GROUP BY o_orderpriority""")  # fmt: skip
def pivot_status(t: Tables) -> DataFrame:
    return shapes.pivot(t.orders, "o_orderstatus", F.count(F.lit(1)), ["o_orderpriority"], ["F", "O", "P"]).na.fill(0)


@query("pivot_inferred", """SELECT l_linestatus, sum(l_quantity::DECIMAL(18,4)) FILTER (WHERE l_returnflag = 'A')::DOUBLE AS A, sum(l_quantity::DECIMAL(18,4)) FILTER (WHERE l_returnflag = 'N')::DOUBLE AS N,
sum(l_quantity::DECIMAL(18,4)) FILTER (WHERE l_returnflag = 'R')::DOUBLE AS R FROM lineitem GROUP BY l_linestatus""")  # fmt: skip
def pivot_inferred(t: Tables) -> DataFrame:
    return shapes.pivot(t.lineitem, "l_returnflag", total("l_quantity"), ["l_linestatus"])


@query("unpivot_measures", """SELECT l_linestatus, 'n' AS name, count(*)::DOUBLE AS value FROM lineitem GROUP BY l_linestatus
UNION ALL SELECT l_linestatus, 'q', sum(l_quantity::DECIMAL(18,4))::DOUBLE FROM lineitem GROUP BY l_linestatus""")  # fmt: skip
def unpivot_measures(t: Tables) -> DataFrame:
    a = t.lineitem.groupBy("l_linestatus").agg(F.count("*").cast("double").alias("n"), total("l_quantity").alias("q"))
    return shapes.unpivot(a, ["l_linestatus"], ["n", "q"])


@query("topk_per_group", """SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) <= 3""")  # fmt: skip
def topk_per_group(t: Tables) -> DataFrame:
    d = t.orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return shapes.top_k(d, ["o_orderpriority"], shapes.ordered("-o_totalprice", "o_orderkey"), 3)


@query("sort_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 5")
def sort_limit(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(*shapes.ordered("-o_totalprice", "o_orderkey")).offset(5).limit(20)


@query("sample_hash", "SELECT o_orderkey FROM orders WHERE ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 8))::BIGINT < 429496729")
def sample_hash(t: Tables) -> DataFrame:
    return shapes.sampled(t.orders, 10, "o_orderkey").select("o_orderkey")


@query("limit_percent", "SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT (SELECT (count(*) * 0.15)::BIGINT FROM part)")
def limit_percent(t: Tables) -> DataFrame:
    return shapes.first_percent(t.part.select("p_partkey", "p_retailprice"), shapes.ordered("-p_retailprice", "p_partkey"), 15).select("p_partkey")


@query("sort_nulls_last", "SELECT x, (row_number() OVER (ORDER BY x NULLS LAST))::INT AS place FROM (VALUES ('a'), ('b'), (NULL), ('c')) v(x)")
def sort_nulls_last(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    d = t.spark.createDataFrame([("a",), ("b",), (None,), ("c",)], "x string")
    return d.withColumn("place", F.row_number().over(Window.orderBy(*shapes.ordered("x"))))


EVEN, LOW = "SELECT n_nationkey AS k FROM nation WHERE n_nationkey % 2 = 0", "SELECT n_nationkey AS k FROM nation WHERE n_nationkey < 12"
for kind in ("UNION ALL", "UNION", "INTERSECT", "EXCEPT", "INTERSECT ALL", "EXCEPT ALL"):
    sql(f"set_{kind.lower().replace(' ', '_')}", f"{EVEN} {kind} {LOW}")


@query("set_union_by_name", "SELECT 1 AS a, 2 AS b, NULL AS c UNION ALL BY NAME SELECT 3 AS c, 4 AS a")
def set_union_by_name(t: Tables) -> DataFrame:
    return t.spark.range(1).selectExpr("1 AS a", "2 AS b").unionByName(t.spark.range(1).selectExpr("3 AS c", "4 AS a"), allowMissingColumns=True)


sql("cte_recursive", "WITH RECURSIVE r(n, f) AS (SELECT 1, cast(1 AS BIGINT) UNION ALL SELECT n + 1, f * (n + 1) FROM r WHERE n < 15) SELECT n, f FROM r")
