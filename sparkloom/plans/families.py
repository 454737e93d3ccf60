"""Scalar and aggregate functions, one query for each family, with most of its names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import values

from .registry import Tables, query, sql

sql("fam_string", """SELECT p_partkey, char_length(p_name) AS a, concat(p_brand, '-', p_size) AS b, ltrim(concat('  ', p_name)) AS c, rtrim(concat(p_name, '  ')) AS d, initcap(p_name) AS e, locate('e', p_name) AS f,
 position('w' IN p_name) AS g, startswith(p_name, 'c') AS h, endswith(p_name, 't') AS i, overlay(p_brand PLACING '##' FROM 2 FOR 3) AS j, char(65 + p_size % 26) AS k, format_string('%s/%05d', p_type, p_size) AS l,
 left(p_name, 3) AS m, right(p_name, 3) AS n, substring(p_name, 2) AS o, reverse(p_name) AS q FROM part""",
    """SELECT p_partkey, length(p_name)::INT AS a, concat(p_brand, '-', p_size) AS b, p_name AS c, p_name AS d, array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN string_split(p_name, ' ')], ' ') AS e, instr(p_name, 'e')::INT AS f,
 instr(p_name, 'w')::INT AS g, starts_with(p_name, 'c') AS h, ends_with(p_name, 't') AS i, left(p_brand, 1) || '##' || substr(p_brand, 5) AS j, chr(65 + p_size % 26) AS k, printf('%s/%05d', p_type, p_size) AS l,
 left(p_name, 3) AS m, right(p_name, 3) AS n, substr(p_name, 2) AS o, reverse(p_name) AS q FROM part""")  # fmt: skip
sql("fam_regex", """SELECT p_partkey, p_name LIKE '%e%' AS a, p_name ILIKE '%E_%' AS b, p_name RLIKE '^[a-m]' AS c, regexp_like(p_type, 'O$') AS d, regexp_replace(p_name, '[aeiou]', '_') AS e, regexp_extract(p_type, '([A-Z])([A-Z]+)', 2) AS f,
 array_join(regexp_extract_all(p_brand, '([0-9])', 1), '.') AS g, regexp_count(p_name, '[aeiou]') AS h, regexp_instr(p_name, '[aeiou]') AS i, size(split(p_name, '[ e]')) AS j FROM part""",
    """SELECT p_partkey, p_name LIKE '%e%' AS a, p_name ILIKE '%E_%' AS b, regexp_matches(p_name, '^[a-m]') AS c, regexp_matches(p_type, 'O$') AS d, regexp_replace(p_name, '[aeiou]', '_', 'g') AS e, regexp_extract(p_type, '([A-Z])([A-Z]+)', 2) AS f,
 array_to_string(regexp_extract_all(p_brand, '([0-9])', 1), '.') AS g, len(regexp_extract_all(p_name, '[aeiou]'))::INT AS h, CASE WHEN regexp_matches(p_name, '[aeiou]') THEN (length(regexp_extract(p_name, '^[^aeiou]*')) + 1)::INT ELSE 0 END AS i, len(regexp_split_to_array(p_name, '[ e]'))::INT AS j FROM part""")  # fmt: skip
sql("fam_hash", """SELECT n_nationkey, md5(n_name) AS a, sha(n_name) AS b, sha1(n_name) AS c, sha2(n_name, 256) AS d, base64(encode(n_name, 'utf-8')) AS e, decode(unbase64(base64(encode(n_name, 'utf-8'))), 'utf-8') AS f, hex(n_name) AS g,
 decode(unhex(hex(n_name)), 'utf-8') AS h, url_encode(concat(n_name, '/&=é')) AS i, url_decode(url_encode(concat(n_name, '/&=é'))) AS j FROM nation""",
    """SELECT n_nationkey, md5(n_name) AS a, sha1(n_name) AS b, sha1(n_name) AS c, sha256(n_name) AS d, base64(encode(n_name)) AS e, decode(from_base64(base64(encode(n_name)))) AS f, hex(n_name) AS g,
 decode(unhex(hex(n_name))) AS h, url_encode(n_name || '/&=é') AS i, url_decode(url_encode(n_name || '/&=é')) AS j FROM nation""")  # fmt: skip
sql("fam_date_parts", """SELECT event_id, year(ts) AS a, quarter(ts) AS b, month(ts) AS c, day(ts) AS d, dayofmonth(ts) AS e, dayofweek(ts) AS f, dayofyear(ts) AS g, weekofyear(ts) AS h, hour(ts) AS i, minute(ts) AS j, second(ts) AS k,
 extract(DAY FROM ts) AS l, date_part('HOUR', ts) AS m, cast(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ) AS n, trunc(ts, 'MM') AS o, last_day(ts) AS p, next_day(ts, 'MON') AS q FROM events""",
    """SELECT event_id, year(ts)::INT AS a, quarter(ts)::INT AS b, month(ts)::INT AS c, day(ts)::INT AS d, day(ts)::INT AS e, (dayofweek(ts) + 1)::INT AS f, dayofyear(ts)::INT AS g, weekofyear(ts)::INT AS h, hour(ts)::INT AS i, minute(ts)::INT AS j, second(ts)::INT AS k,
 day(ts)::INT AS l, hour(ts)::INT AS m, date_trunc('hour', ts) AS n, date_trunc('month', ts)::DATE AS o, last_day(ts)::DATE AS p, (ts::DATE + (8 - isodow(ts))::INT)::DATE AS q FROM events""")  # fmt: skip
sql("fam_date_math", """SELECT o_orderkey, date_add(d, 10) AS a, date_sub(d, 10) AS b, date_diff(DATE '2002-01-01', d) AS c, datediff(DATE '2002-01-01', d) AS c2, add_months(d, 5) AS e, months_between(trunc(d, 'MM'), DATE '1995-01-01') AS f,
 make_date(2000, month(d), 1) AS g, make_timestamp_ntz(2000, month(d), 2, 3, 4, 5.5) AS h, cast(make_timestamp(2000, month(d), 2, 3, 4, 5.5) AS TIMESTAMP_NTZ) AS i, timestampdiff(HOUR, TIMESTAMP_NTZ '1995-01-01 00:00:00', t) AS j, timestampadd(DAY, 3, t) AS k,
 t + make_interval(0, 1, 0, 2, 3, 0, 0) AS l, t + make_dt_interval(1, 2, 3, 4) AS m, t + make_ym_interval(1, 2) AS n, unix_timestamp(cast(t AS TIMESTAMP)) AS o, trim(LEADING '+' FROM from_unixtime(86400 * o_orderkey)) AS p, to_date(date_format(t, 'yyyy/MM/dd'), 'yyyy/MM/dd') AS q,
 cast(to_timestamp(cast(t AS STRING)) AS TIMESTAMP_NTZ) AS r, to_timestamp_ntz(cast(t AS STRING)) AS s, cast(from_utc_timestamp(cast(t AS TIMESTAMP), '+02:00') AS TIMESTAMP_NTZ) AS u, cast(to_utc_timestamp(cast(t AS TIMESTAMP), '+02:00') AS TIMESTAMP_NTZ) AS v,
 convert_timezone('UTC', '+01:00', t) AS w FROM (SELECT o_orderkey, o_orderdate AS t, cast(o_orderdate AS DATE) AS d FROM orders)""",
    """SELECT o_orderkey, d + 10 AS a, d - 10 AS b, date_diff('day', d, DATE '2002-01-01')::INT AS c, date_diff('day', d, DATE '2002-01-01')::INT AS c2, (d + INTERVAL '5' MONTH)::DATE AS e, date_diff('month', DATE '1995-01-01', d)::DOUBLE AS f,
 make_date(2000, month(d), 1) AS g, make_timestamp(2000, month(d), 2, 3, 4, 5.5) AS h, make_timestamp(2000, month(d), 2, 3, 4, 5.5) AS i, date_diff('hour', TIMESTAMP '1995-01-01 00:00:00', t) AS j, t + INTERVAL '3' DAY AS k,
 t + INTERVAL '1' MONTH + INTERVAL '2' DAY + INTERVAL '3' HOUR AS l, t + INTERVAL '1' DAY + INTERVAL '2' HOUR + INTERVAL '3' MINUTE + INTERVAL '4' SECOND AS m, t + INTERVAL '14' MONTH AS n, epoch(t)::BIGINT AS o, strftime(make_timestamp(o_orderkey * 86400 * 1000000), '%Y-%m-%d %H:%M:%S') AS p, d AS q,
 t AS r, t AS s, t + INTERVAL '2' HOUR AS u, t - INTERVAL '2' HOUR AS v, t + INTERVAL '1' HOUR AS w FROM (SELECT o_orderkey, o_orderdate AS t, o_orderdate::DATE AS d FROM orders)""")  # fmt: skip
sql("fam_math", """SELECT n_nationkey, abs(-k) AS a, sign(x - 10) AS b, ceil(x / 3) AS c, floor(x / 3) AS d, round(x / 3, 2) AS e, bround(x / 2) AS f, round(cbrt(x), 6) AS g, round(pow(x, 1.5), 4) AS h, round(exp(x / 10), 6) AS i, round(ln(x + 1), 6) AS j, round(log(x + 1), 6) AS k1,
 round(log2(x + 1), 6) AS l, round(log10(x + 1), 6) AS m, round(sin(x), 6) AS n, round(cos(x), 6) AS o, round(tan(x), 6) AS p, round(asin(x / 30), 6) AS q, round(acos(x / 30), 6) AS r, round(atan(x), 6) AS s, round(atan2(x, 3), 6) AS t, round(degrees(x), 4) AS u, round(radians(x), 6) AS v,
 pmod(k - 12, 7) AS w, greatest(k, 5) AS y, least(k, 5) AS z, factorial(k % 15) AS aa, bit_count(k) AS bb, shiftleft(k, 3) AS cc, shiftright(k, 1) AS dd, width_bucket(x, 0, 20, 4) AS ee, round(pi(), 6) AS ff, round(e(), 6) AS gg, rand(1) < 1 AND randn(1) < 100 AS hh, round(sqrt(x), 6) AS ii
 FROM (SELECT n_nationkey, n_nationkey AS k, cast(n_nationkey AS DOUBLE) AS x FROM nation)""",
    """SELECT n_nationkey, abs(-k) AS a, sign(x - 10)::DOUBLE AS b, ceil(x / 3)::BIGINT AS c, floor(x / 3)::BIGINT AS d, round(x / 3, 2) AS e, round_even(x / 2, 0) AS f, round(cbrt(x), 6) AS g, round(pow(x, 1.5), 4) AS h, round(exp(x / 10), 6) AS i, round(ln(x + 1), 6) AS j, round(ln(x + 1), 6) AS k1,
 round(log2(x + 1), 6) AS l, round(log10(x + 1), 6) AS m, round(sin(x), 6) AS n, round(cos(x), 6) AS o, round(tan(x), 6) AS p, round(asin(x / 30), 6) AS q, round(acos(x / 30), 6) AS r, round(atan(x), 6) AS s, round(atan2(x, 3), 6) AS t, round(degrees(x), 4) AS u, round(radians(x), 6) AS v,
 ((k - 12) % 7 + 7) % 7 AS w, greatest(k, 5) AS y, least(k, 5) AS z, factorial(k % 15)::BIGINT AS aa, bit_count(k)::INT AS bb, (k << 3)::INT AS cc, (k >> 1)::INT AS dd, CASE WHEN x >= 20 THEN 5 ELSE floor(x / 5)::BIGINT + 1 END AS ee, round(pi(), 6) AS ff, round(exp(1), 6) AS gg, true AS hh, round(sqrt(x), 6) AS ii
 FROM (SELECT n_nationkey, n_nationkey AS k, n_nationkey::DOUBLE AS x FROM nation)""")  # fmt: skip
sql("fam_null", """SELECT n_nationkey, ifnull(r, -1) AS a, nvl(r, -2) AS b, nvl2(r, 'some', 'none') AS c, isnan(x) AS d, nanvl(x, 0.0D) AS e, equal_null(r, 2) AS f, coalesce(r, n_nationkey) AS g, if(r > 2, 1, 0) AS h
 FROM (SELECT n_nationkey, nullif(n_regionkey, 1) AS r, if(n_nationkey % 2 = 0, cast('NaN' AS DOUBLE), 1.5D) AS x FROM nation)""",
    """SELECT n_nationkey, ifnull(r, -1) AS a, coalesce(r, -2) AS b, CASE WHEN r IS NOT NULL THEN 'some' ELSE 'none' END AS c, isnan(x) AS d, CASE WHEN isnan(x) THEN 0.0::DOUBLE ELSE x END AS e, r IS NOT DISTINCT FROM 2 AS f, coalesce(r, n_nationkey) AS g, CASE WHEN r > 2 THEN 1 ELSE 0 END AS h
 FROM (SELECT n_nationkey, nullif(n_regionkey, 1) AS r, CASE WHEN n_nationkey % 2 = 0 THEN 'NaN'::DOUBLE ELSE 1.5::DOUBLE END AS x FROM nation)""")  # fmt: skip
sql("fam_array", """SELECT n_nationkey, array_join(array_append(a, 9), ',') AS c1, array_join(array_prepend(a, 9), ',') AS c2, array_join(array_insert(a, 2, 7), ',') AS c3, array_join(array_remove(a, 2), ',') AS c4, array_join(sort_array(array_distinct(a)), ',') AS c5,
 array_join(sort_array(array_union(a, array(100))), ',') AS c6, array_join(sort_array(array_intersect(a, array(0, 1, 2))), ',') AS c7, array_join(sort_array(array_except(a, array(0, 1))), ',') AS c8, arrays_overlap(a, array(0)) AS c9, array_max(a) AS d1, array_min(a) AS d2,
 array_join(array_sort(a), ',') AS d3, array_join(slice(a, 2, 2), ',') AS d4, array_join(flatten(array(a, array(1))), ',') AS d5, array_join(reverse(a), ',') AS d6, array_join(sequence(1, n_regionkey + 1), ',') AS d7, element_at(a, -1) AS d8, try_element_at(a, 9) AS d9, get(a, 0) AS e1,
 array_join(transform(a, x -> x * 2), ',') AS e2, array_join(filter(a, x -> x > 2), ',') AS e3, exists(a, x -> x > 20) AS e4, forall(a, x -> x < 20) AS e5, aggregate(a, 0, (s, x) -> s + x) AS e6, array_join(zip_with(a, a, (x, y) -> x + y), ',') AS e7, size(arrays_zip(a, array(1))) AS e8,
 array_join(array_repeat('x', 3), ',') AS e9, array_join(array_compact(array(1, NULL, n_regionkey)), ',') AS f1, size(shuffle(a)) AS f2, array_position(a, 2) AS f3, array_contains(a, 3) AS f4 FROM (SELECT n_nationkey, n_regionkey, array(n_regionkey, 2, n_nationkey, 2) AS a FROM nation)""",
    """SELECT n_nationkey, array_to_string(list_append(a, 9), ',') AS c1, array_to_string(list_prepend(9, a), ',') AS c2, array_to_string(a[1:1] || [7] || a[2:], ',') AS c3, array_to_string([x FOR x IN a IF x <> 2], ',') AS c4, array_to_string(list_sort(list_distinct(a)), ',') AS c5,
 array_to_string(list_sort(list_distinct(a || [100])), ',') AS c6, array_to_string(list_sort(list_distinct([x FOR x IN a IF x IN (0, 1, 2)])), ',') AS c7, array_to_string(list_sort(list_distinct([x FOR x IN a IF x NOT IN (0, 1)])), ',') AS c8, list_has_any(a, [0]) AS c9, list_max(a) AS d1, list_min(a) AS d2,
 array_to_string(list_sort(a), ',') AS d3, array_to_string(a[2:3], ',') AS d4, array_to_string(a || [1], ',') AS d5, array_to_string(list_reverse(a), ',') AS d6, array_to_string(range(1, n_regionkey + 2), ',') AS d7, a[-1] AS d8, a[9] AS d9, a[1] AS e1,
 array_to_string([x * 2 FOR x IN a], ',') AS e2, array_to_string([x FOR x IN a IF x > 2], ',') AS e3, list_max(a) > 20 AS e4, list_max(a) < 20 AS e5, list_sum(a)::INT AS e6, array_to_string([x + x FOR x IN a], ',') AS e7, 4 AS e8,
 'x,x,x' AS e9, '1,' || n_regionkey AS f1, len(a)::INT AS f2, list_position(a, 2)::BIGINT AS f3, list_contains(a, 3) AS f4 FROM (SELECT n_nationkey, n_regionkey, [n_regionkey, 2, n_nationkey, 2] AS a FROM nation)""")  # fmt: skip
sql("fam_explode", """SELECT n_nationkey, p, x, o, q FROM nation LATERAL VIEW posexplode(array(n_regionkey, 7)) v AS p, x LATERAL VIEW OUTER explode(filter(array(n_regionkey), y -> y > 2)) w AS o LATERAL VIEW OUTER posexplode(filter(array(n_regionkey), y -> y > 2)) z AS q, r""",
    """SELECT n_nationkey, p::INT AS p, CASE WHEN p = 0 THEN n_regionkey ELSE 7 END AS x, CASE WHEN n_regionkey > 2 THEN n_regionkey END AS o, CASE WHEN n_regionkey > 2 THEN 0 END AS q FROM nation, range(2) r(p)""")  # fmt: skip
sql("fam_map", """SELECT n_nationkey, m['a'] AS a, array_join(map_keys(m), ',') AS b, array_join(map_values(m), ',') AS c, map_entries(m)[1].value AS d, map_concat(m, map('c', 9))['c'] AS e, map_contains_key(m, 'b') AS f, size(map_filter(m, (k, v) -> v > 2)) AS g, transform_keys(m, (k, v) -> upper(k))['B'] AS h,
 transform_values(m, (k, v) -> v * 10)['b'] AS i, map_zip_with(m, m, (k, x, y) -> x + y)['a'] AS j, map_from_entries(array(struct('z', n_nationkey)))['z'] AS k, map_from_arrays(array('p', 'q'), array(1, n_regionkey))['q'] AS l FROM (SELECT *, map('a', n_nationkey, 'b', n_regionkey) AS m FROM nation)""",
    """SELECT n_nationkey, n_nationkey AS a, 'a,b' AS b, n_nationkey || ',' || n_regionkey AS c, n_regionkey AS d, 9 AS e, map_contains(m, 'b') AS f, len([v FOR v IN map_values(m) IF v > 2])::INT AS g, n_regionkey AS h, n_regionkey * 10 AS i, n_nationkey + n_nationkey AS j, n_nationkey AS k, n_regionkey AS l
 FROM (SELECT *, MAP(['a', 'b'], [n_nationkey, n_regionkey]) AS m FROM nation)""")  # fmt: skip
sql("fam_struct", "SELECT n_nationkey, inline(array(struct(1 AS a, n_name AS b), struct(n_regionkey AS a, 'x' AS b))) FROM nation", "SELECT n_nationkey, CASE WHEN i = 0 THEN 1 ELSE n_regionkey END AS a, CASE WHEN i = 0 THEN n_name ELSE 'x' END AS b FROM nation, range(2) r(i)")
sql("fam_struct_outer", "SELECT n_nationkey, a FROM nation LATERAL VIEW OUTER inline(filter(array(named_struct('a', n_regionkey)), s -> s.a > 1)) v AS a", "SELECT n_nationkey, CASE WHEN n_regionkey > 1 THEN n_regionkey END AS a FROM nation")
sql("fam_json", """SELECT event_id, to_json(named_struct('k', user_id, 't', event_type)) AS a, get_json_object(props, '$.k') AS b, json_tuple(props, 'k') AS c FROM events""",
    """SELECT event_id, '{"k":' || user_id || ',"t":"' || event_type || '"}' AS a, props->>'$.k' AS b, props->>'$.k' AS c FROM events""")  # fmt: skip
sql("fam_variant", """SELECT event_id, array_join(json_object_keys(props), ',') AS a, schema_of_json('{"k": 1, "l": [1.5]}') AS b, try_parse_json(concat('{', props)) IS NULL AS c, try_variant_get(parse_json(concat('{"t":', if(user_id % 2 = 0, '"x"', cast(user_id AS STRING)), '}')), '$.t', 'bigint') AS d, schema_of_variant(parse_json(props)) AS e,
 is_variant_null(parse_json('null')) AS f, variant_get(to_variant_object(named_struct('u', user_id)), '$.u', 'bigint') AS g, from_json(props, 'k INT').k AS h FROM events""",
    """SELECT event_id, array_to_string(json_keys(props), ',') AS a, 'STRUCT<k: BIGINT, l: ARRAY<DOUBLE>>' AS b, true AS c, CASE WHEN user_id % 2 = 1 THEN user_id END AS d, 'OBJECT<k: BIGINT>' AS e, true AS f, user_id AS g, (props->>'$.k')::INT AS h FROM events""")  # fmt: skip
sql("fam_aggregates", """SELECT event_type, sum(DISTINCT user_id) AS a, round(stddev(value), 4) AS b, round(stddev_pop(value), 4) AS c, round(stddev_samp(value), 4) AS c2, round(variance(value), 2) AS d, round(var_samp(value), 2) AS d2, round(covar_samp(value, user_id), 3) AS e, round(skewness(value), 6) AS f, round(kurtosis(value), 6) AS g,
 min_by(event_id, ts) AS h, max_by(event_id, ts) AS h2, bool_and(value >= 0) AS i, bit_and(event_id) AS j, bit_or(event_id) AS k, size(collect_set(user_id)) AS l, size(array_agg(user_id)) AS m, round(regr_intercept(value, user_id), 4) AS n, round(regr_r2(value, user_id), 6) AS o, regr_count(value, user_id) AS p, any_value(event_type) AS q,
 first(event_type) AS r, last(event_type) AS s, min(ts) AS t, round(avg(value), 4) AS u, count(DISTINCT user_id) AS v, round(median(value), 4) AS w FROM events GROUP BY event_type""",
    """SELECT event_type, sum(DISTINCT user_id)::BIGINT AS a, round(stddev(value), 4) AS b, round(stddev_pop(value), 4) AS c, round(stddev_samp(value), 4) AS c2, round(variance(value), 2) AS d, round(var_samp(value), 2) AS d2, round(covar_samp(value, user_id), 3) AS e, round(avg(pow(value - mu, 3)) / pow(avg(pow(value - mu, 2)), 1.5), 6) AS f,
 round(avg(pow(value - mu, 4)) / pow(avg(pow(value - mu, 2)), 2) - 3, 6) AS g, arg_min(event_id, ts) AS h, arg_max(event_id, ts) AS h2, bool_and(value >= 0) AS i, bit_and(event_id) AS j, bit_or(event_id) AS k, count(DISTINCT user_id)::INT AS l, count(*)::INT AS m, round(regr_intercept(value, user_id), 4) AS n,
 round(regr_r2(value, user_id), 6) AS o, regr_count(value, user_id)::BIGINT AS p, event_type AS q, event_type AS r, event_type AS s, min(ts) AS t, round(avg(value), 4) AS u, count(DISTINCT user_id) AS v, round(median(value), 4) AS w FROM (SELECT *, avg(value) OVER (PARTITION BY event_type) AS mu FROM events) GROUP BY event_type""")  # fmt: skip
sql("fam_aggregate_lists", """SELECT n_regionkey, string_agg(n_name, ';') WITHIN GROUP (ORDER BY n_name) AS a, listagg(DISTINCT left(n_name, 8), ';') WITHIN GROUP (ORDER BY left(n_name, 8)) AS b, count_if(n_nationkey > 9) AS c, array_join(array_sort(collect_list(n_nationkey)), ',') AS d FROM nation GROUP BY n_regionkey""",
    """SELECT n_regionkey, string_agg(n_name, ';' ORDER BY n_name) AS a, string_agg(DISTINCT left(n_name, 8), ';' ORDER BY left(n_name, 8)) AS b, count_if(n_nationkey > 9)::BIGINT AS c, string_agg(n_nationkey, ',' ORDER BY n_nationkey) AS d FROM nation GROUP BY n_regionkey""")  # fmt: skip
sql("fam_grouping_id", "SELECT o_orderstatus, o_orderpriority, grouping_id(o_orderstatus, o_orderpriority) AS g, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)",
    "SELECT o_orderstatus, o_orderpriority, grouping_id(o_orderstatus, o_orderpriority)::BIGINT AS g, count(*) AS n FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
sql("fam_literals", "SELECT n_nationkey, DATE '2020-02-29' AS a, TIMESTAMP_NTZ '2020-02-29 01:02:03.5' AS b, cast(TIME '12:34:56' AS STRING) AS c, cast(cast(n_regionkey AS STRING) AS INT) AS d, try_cast(n_name AS INT) AS e, cast(n_nationkey AS DECIMAL(10,2)) AS f FROM nation",
    "SELECT n_nationkey, DATE '2020-02-29' AS a, TIMESTAMP '2020-02-29 01:02:03.5' AS b, (TIME '12:34:56')::VARCHAR AS c, n_regionkey::VARCHAR::INT AS d, TRY_CAST(n_name AS INT) AS e, n_nationkey::DECIMAL(10,2) AS f FROM nation")
sql("fam_now", "SELECT o_orderkey, o_orderdate < now() - INTERVAL '1' DAY AS a, cast(o_orderdate AS DATE) <= current_date() AS b, o_orderdate < localtimestamp() AS c, length(cast(current_time() AS STRING)) > 7 AS d, length(uuid()) AS e, cast(now() AS DATE) = current_date() AS f FROM orders",
    "SELECT o_orderkey, o_orderdate < now() - INTERVAL '1' DAY AS a, o_orderdate::DATE <= current_date AS b, o_orderdate < localtimestamp AS c, length(current_time::VARCHAR) > 7 AS d, length(gen_random_uuid()::VARCHAR)::INT AS e, now()::DATE = current_date AS f FROM orders")
sql("fam_collation", "SELECT n_name, n_name COLLATE UNICODE_CI = lower(n_name) AS same, contains(n_name COLLATE UTF8_LCASE, 'ion_1') AS has FROM nation", "SELECT n_name, true AS same, contains(lower(n_name), 'ion_1') AS has FROM nation")


@query("fam_typeof", "SELECT typeof(o_orderkey) AS a, typeof(o_totalprice) AS b, typeof(o_orderstatus) AS c, typeof(o_orderdate) AS d, typeof(o_orderdate::DATE) AS e, typeof([o_orderkey]) AS f, typeof(o_orderkey > 1) AS g, count(*) AS n FROM orders GROUP BY ALL")
def fam_typeof(t: Tables) -> DataFrame:
    d = t.orders.withColumns({"day": F.to_date("o_orderdate"), "list": F.array("o_orderkey"), "big": F.col("o_orderkey") > 1})
    names = dict(zip("abcdefg", ("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderdate", "day", "list", "big"), strict=True))
    return d.groupBy(*[values.type_name(F.col(c)).alias(a) for a, c in names.items()]).agg(F.count("*").alias("n"))


@query("fam_uuid", "SELECT n_nationkey, (md5(n_name)::UUID)::VARCHAR AS u, md5(n_name)::UUID > '80000000-0000-0000-0000-000000000000'::UUID AS high FROM nation")
def fam_uuid(t: Tables) -> DataFrame:
    u = values.to_uuid(F.md5("n_name"))
    return t.nation.select("n_nationkey", u.alias("u"), (u > "80000000-0000-0000-0000-000000000000").alias("high"))


@query("fam_enum", "SELECT o_orderkey, (list_position(['F', 'O', 'P'], o_orderstatus) - 1)::INT AS code, list_position(['F', 'O', 'P'], o_orderstatus) > 1 AS later FROM orders")
def fam_enum(t: Tables) -> DataFrame:
    code = values.enum_code(F.col("o_orderstatus"), ["F", "O", "P"])
    return t.orders.select("o_orderkey", code.alias("code"), (code > 0).alias("later"))


@query("fam_blob", "SELECT n_nationkey, octet_length(encode(n_name)) AS n, hex(encode(n_name)) AS h, decode(encode(n_name)) AS back FROM nation")
def fam_blob(t: Tables) -> DataFrame:
    b = F.encode("n_name", "utf-8")
    return t.nation.select("n_nationkey", F.octet_length(b).cast("long").alias("n"), F.hex(b).alias("h"), F.decode(b, "utf-8").alias("back"))


@query("agg_histogram", "SELECT o_orderpriority, string_agg(o_orderstatus || '=' || n, ',' ORDER BY o_orderstatus) AS h FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_orderpriority")
def agg_histogram(t: Tables) -> DataFrame:
    """Counts of each value as a map, from counts and not from collected rows."""
    n = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n"))
    d = n.groupBy("o_orderpriority").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("o_orderstatus", "n")))).alias("m"))
    return d.select("o_orderpriority", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("h"))


#: These have no counterpart in the checking SQL; the tests hold them against Python.
@query("fam_spark_only")
def fam_spark_only(t: Tables) -> DataFrame:
    n = t.nation
    return n.select(
        "n_nationkey", "n_name", F.soundex("n_name").alias("sound"), F.crc32(F.encode("n_name", "utf-8")).alias("crc"), F.hash("n_name").alias("h"), F.xxhash64("n_name").alias("x"),
        (F.input_file_name() != "").alias("file"), (F.spark_partition_id() >= 0).alias("part"), (F.monotonically_increasing_id() >= 0).alias("mono"), F.current_timezone().alias("zone"), F.version().alias("version"),
        F.assert_true(F.col("n_nationkey") >= 0).isNull().alias("ok"),
    )


@query("agg_approx")
def agg_approx(t: Tables) -> DataFrame:
    """Estimates beside the exact numbers, which the tests hold within their bounds.

    The exact count of distinct ids is grouped by itself: beside it, every id would have sketches and histograms of its own.
    """
    exact = t.events.groupBy(F.col("event_type").alias("of")).agg(F.count_distinct("event_id").alias("n"))
    near = t.events.groupBy("event_type").agg(
        F.approx_count_distinct("event_id", 0.02).alias("n_near"), F.hll_sketch_estimate(F.hll_sketch_agg("event_id")).alias("n_hll"),
        F.percentile("value", 0.9).alias("q"), F.approx_percentile("value", 0.9, 1000).alias("q_near"), F.size(F.histogram_numeric("value", F.lit(8))).alias("bins"), F.product(F.lit(1.0)).alias("one"),
    )
    return near.join(exact, F.col("event_type").eqNullSafe(F.col("of"))).select("event_type", "n", "n_near", "n_hll", "q", "q_near", "bins", "one")
