"""Scalar functions by family. Where both engines share the text, one text serves as query and check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import values

from .registry import Tables, query, sql

sql("str_basic", """SELECT p_partkey, upper(p_name) AS u, lower(p_brand) AS l, length(p_name) AS n, trim(concat('  ', p_type, ' ')) AS t, substring(p_name, 2, 4) AS s, replace(p_type, ' ', '_') AS r,
 lpad(p_brand, 12, '*') AS lp, rpad(p_brand, 12, '-') AS rp, reverse(p_brand) AS rv, repeat(left(p_brand, 2), 2) AS rep, right(p_brand, 2) AS rt, instr(p_name, 'a') AS i, translate(p_brand, 'abc', 'xyz') AS tr,
 concat_ws('/', p_brand, p_type) AS cw, ascii(p_name) AS a, chr(65 + p_size % 26) AS c, split_part(p_type, ' ', 1) AS sp, contains(p_name, 'e') AS ct FROM part""")
#: Both engines' capitals differ for these letters only, which are mapped first.
sql("str_unicode", "SELECT doc_id, length(text) AS n, md5(upper(translate(text, 'ß', 'ẞ'))) AS u, md5(lower(text)) AS l, octet_length(encode(text, 'utf-8')) AS b, md5(text) AS m FROM documents",
    "SELECT doc_id, length(text) AS n, md5(upper(text)) AS u, md5(lower(text)) AS l, octet_length(encode(text)) AS b, md5(text) AS m FROM documents")
sql("str_regex", "SELECT p_partkey, regexp_extract(p_type, '([A-Za-z]+)', 1) AS a, regexp_replace(p_name, '[aeiou]', '') AS b, p_name RLIKE '^[a-m]' AS c, p_name ILIKE '%E%' AS d FROM part",
    "SELECT p_partkey, regexp_extract(p_type, '([A-Za-z]+)', 1) AS a, regexp_replace(p_name, '[aeiou]', '', 'g') AS b, regexp_matches(p_name, '^[a-m]') AS c, p_name ILIKE '%E%' AS d FROM part")
sql("str_similar", "SELECT a.n_name AS x, b.n_name AS y, levenshtein(a.n_name, b.n_name) AS d FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey")
sql("hash_encode", "SELECT n_nationkey, md5(n_name) AS m, sha2(n_name, 256) AS s, sha1(n_name) AS s1, base64(encode(n_name, 'utf-8')) AS b, hex(n_name) AS h FROM nation",
    "SELECT n_nationkey, md5(n_name) AS m, sha256(n_name) AS s, sha1(n_name) AS s1, base64(encode(n_name)) AS b, hex(n_name) AS h FROM nation")
sql("date_parts", """SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m, day(o_orderdate) AS d, dayofyear(o_orderdate) AS dy, weekofyear(o_orderdate) AS w,
 cast(date_trunc('month', o_orderdate) AS DATE) AS mon, last_day(cast(o_orderdate AS DATE)) AS ld, extract(hour FROM o_orderdate) AS h FROM orders""")
sql("date_math", """SELECT o_orderkey, cast(o_orderdate AS DATE) + INTERVAL '3' MONTH AS m3, datediff(DATE '2002-01-01', cast(o_orderdate AS DATE)) AS dd, date_add(cast(o_orderdate AS DATE), 10) AS d10, make_date(year(o_orderdate), 2, 1) AS md FROM orders""",
    """SELECT o_orderkey, (o_orderdate::DATE + INTERVAL '3' MONTH)::DATE AS m3, date_diff('day', o_orderdate::DATE, DATE '2002-01-01') AS dd, o_orderdate::DATE + 10 AS d10, make_date(year(o_orderdate), 2, 1) AS md FROM orders""")  # fmt: skip
sql("math_basic", """SELECT l_orderkey, l_linenumber, l_partkey, abs(-l_quantity) AS a, ceil(l_discount * 10) AS c, floor(l_tax * 100) AS f, round(sqrt(l_quantity), 6) AS s, round(ln(l_extendedprice), 6) AS ln, round(power(l_quantity, 2), 4) AS p,
 l_orderkey % 7 AS m, greatest(l_quantity, 25.0) AS g, least(l_quantity, 25.0) AS le, sign(l_discount - 0.05) AS sg, round(atan2(l_tax, l_discount), 6) AS at, round(exp(l_tax), 6) AS e, bit_count(l_orderkey) AS bc FROM lineitem""",
    """SELECT l_orderkey, l_linenumber, l_partkey, abs(-l_quantity) AS a, ceil(l_discount * 10)::BIGINT AS c, floor(l_tax * 100)::BIGINT AS f, round(sqrt(l_quantity), 6) AS s, round(ln(l_extendedprice), 6) AS ln, round(power(l_quantity, 2), 4) AS p,
 l_orderkey % 7 AS m, greatest(l_quantity, 25.0) AS g, least(l_quantity, 25.0) AS le, sign(l_discount - 0.05)::DOUBLE AS sg, round(atan2(l_tax, l_discount), 6) AS at, round(exp(l_tax), 6) AS e, bit_count(l_orderkey)::INT AS bc FROM lineitem""")  # fmt: skip
sql("cond_null", "SELECT o_orderkey, nullif(o_orderstatus, 'F') AS a, coalesce(nullif(o_orderstatus, 'F'), 'x') AS b, CASE WHEN o_totalprice > 1000 THEN 1 ELSE 0 END AS c, nullif(o_orderstatus, 'O') IS NOT DISTINCT FROM NULL AS d FROM orders")


@query("cast_rounding", "SELECT i, CASE WHEN x < 0 THEN ceil(x - 0.5) ELSE floor(x + 0.5) END::BIGINT AS r FROM (VALUES (1, 0.5), (2, 1.5), (3, 2.5), (4, -0.5), (5, -1.5), (6, -2.5), (7, 2.4), (8, NULL)) v(i, x)")
def cast_rounding(t: Tables) -> DataFrame:
    d = t.spark.sql("SELECT * FROM (VALUES (1, 0.5), (2, 1.5), (3, 2.5), (4, -0.5), (5, -1.5), (6, -2.5), (7, 2.4), (8, NULL)) v(i, x)")
    return d.select("i", values.to_integer(F.col("x")).alias("r"))


@query("cast_unsigned", "SELECT 18446744073709551615::UBIGINT::VARCHAR AS a, 255::UTINYINT::VARCHAR AS b, 4294967295::UINTEGER::VARCHAR AS c, 65535::USMALLINT::VARCHAR AS d")
def cast_unsigned(t: Tables) -> DataFrame:
    big = {"a": ("18446744073709551615", "ubigint"), "b": ("255", "utinyint"), "c": ("4294967295", "uinteger"), "d": ("65535", "usmallint")}
    return t.spark.range(1).select(*[values.unsigned(F.lit(v), k).cast("string").alias(n) for n, (v, k) in big.items()])


@query("split_plain", "SELECT p_partkey, len(string_split(p_type || '|x', '|'))::INT AS n, string_split(trim(p_type), ' ')[1] AS first, string_split(p_type, ' ')[9] AS none FROM part")
def split_plain(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.size(values.split(F.concat("p_type", F.lit("|x")), "|")).alias("n"), values.item(values.split(F.trim("p_type"), " "), 1).alias("first"), values.item(values.split(F.col("p_type"), " "), 9).alias("none"))


@query("strftime", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS s FROM orders")
def strftime(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", values.strftime(F.col("o_orderdate"), "%Y-%m-%d %H:%M:%S").alias("s"))


@query("interval_struct", "SELECT o_orderkey, o_orderdate + INTERVAL '1' MONTH + INTERVAL '2' DAY + INTERVAL '3 seconds' AS later, 1 AS months, 2 AS days FROM orders")
def interval_struct(t: Tables) -> DataFrame:
    d = t.orders.withColumn("iv", values.interval(F.lit(1), F.lit(2), F.lit(3_000_000)))
    return d.select("o_orderkey", values.plus_interval(F.col("o_orderdate"), F.col("iv")).cast("timestamp_ntz").alias("later"), "iv.months", "iv.days")


@query("array_funcs", """SELECT vec_id, round(list_sum([x::DOUBLE * x::DOUBLE FOR x IN embedding]), 4) AS norm2, len(embedding)::INT AS n, embedding[1] AS first, round(list_max(embedding)::DOUBLE, 5) AS mx,
len([x FOR x IN embedding IF x > 0])::INT AS pos, list_contains([1, 2, 3], label) AS has FROM embeddings""")  # fmt: skip
def array_funcs(t: Tables) -> DataFrame:
    e = F.col("embedding")
    sq = F.aggregate(F.transform(e, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return t.embeddings.select("vec_id", F.round(sq, 4).alias("norm2"), F.size(e).alias("n"), values.item(e, 1).alias("first"), F.round(F.array_max(e).cast("double"), 5).alias("mx"),
        F.size(F.filter(e, lambda x: x > 0)).alias("pos"), F.array_contains(F.array(F.lit(1), F.lit(2), F.lit(3)), F.col("label")).alias("has"))


sql("array_more", """SELECT n_nationkey, array_join(array_distinct(array(n_regionkey, 1, n_regionkey)), ',') AS d, array_join(slice(sequence(1, 5), 2, 2), ',') AS s, array_position(array(4, 3, 2, 1, 0), n_regionkey) AS p, size(array_intersect(array(0, 1), array(n_regionkey))) AS i, array_join(sort_array(array_union(array(n_regionkey), array(2))), ',') AS u FROM nation""",
    """SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN '1' ELSE n_regionkey || ',1' END AS d, '2,3' AS s, list_position([4, 3, 2, 1, 0], n_regionkey) AS p, len(list_intersect([0, 1], [n_regionkey]))::INT AS i, array_to_string(list_sort(list_distinct([n_regionkey, 2])), ',') AS u FROM nation""")  # fmt: skip
sql("explode_rows", "SELECT n_nationkey, x FROM nation LATERAL VIEW explode(sequence(0, n_regionkey)) v AS x", "SELECT n_nationkey, unnest(range(0, n_regionkey + 1))::INT AS x FROM nation")
sql("map_struct_funcs", "SELECT event_id, map_from_arrays(array('a', 'b'), array(user_id, event_id))['b'] AS mb, named_struct('x', value, 'y', event_type).y AS y, size(map_keys(map('k', 1, 'l', 2))) AS n FROM events",
    "SELECT event_id, MAP(['a', 'b'], [user_id, event_id])['b'] AS mb, struct_pack(x := value, y := event_type).y AS y, 2 AS n FROM events")
sql("json_props", """SELECT event_id, cast(get_json_object(props, '$.k') AS INT) AS k, json_array_length(concat('[', user_id, ', null, "', event_type, '", [1, 2]]')) AS n, variant_get(parse_json(props), '$.k', 'int') AS v, from_json(props, 'k INT').k AS f FROM events""",
    """SELECT event_id, (props->>'$.k')::INT AS k, json_array_length('[' || user_id || ', null, "' || event_type || '", [1, 2]]')::INT AS n, (props->>'$.k')::INT AS v, (props->>'$.k')::INT AS f FROM events""")  # fmt: skip
