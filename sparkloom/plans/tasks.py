"""User-defined functions, ingest, table changes and streams, each ending in rows that SQL can check."""

from __future__ import annotations

import uuid

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.client import Constraints, ConstraintError, Engine
from sparkloom.functions import udf
from sparkloom.sources import files, parts
from sparkloom.streaming import windows as tw
from sparkloom.work import shared_folder

from .registry import Tables, query


def scratch(t: Tables, what: str) -> str:
    """A fresh folder in the one that driver and executors share."""
    return f"{shared_folder(t.spark)}/sparkloom/{what}-{uuid.uuid4().hex}"


@query("udf_scalar", "SELECT p_partkey, p_size + 1 AS x FROM part")
def udf_scalar(t: Tables) -> DataFrame:
    f = udf.scalar(t.spark, "plus_one", lambda x: x + 1, "int")
    return t.part.select("p_partkey", f("p_size").alias("x"))


@query("udf_arrow", "SELECT p_partkey, upper(p_brand) AS b FROM part")
def udf_arrow(t: Tables) -> DataFrame:
    def up(x):  # noqa: ANN001, ANN202
        return pc.utf8_upper(x)

    up.__annotations__ = {"x": pa.Array, "return": pa.Array}
    return t.part.select("p_partkey", udf.arrow_scalar(t.spark, "arrow_upper", up, "string")("p_brand").alias("b"))


@query("udaf_grouped", "SELECT n_regionkey, max(length(n_name))::DOUBLE AS longest FROM nation GROUP BY n_regionkey")
def udaf_grouped(t: Tables) -> DataFrame:
    def longest(x: pd.Series) -> float:
        return float(x.str.len().max())

    return t.nation.groupBy("n_regionkey").agg(udf.aggregate(longest, "double")("n_name").alias("longest"))


@query("udtf_chunks", """SELECT p_partkey, i::INT AS chunk, i * 7 AS first, least(7, p_size - i * 7) AS size FROM part, range(8) r(i) WHERE i * 7 < p_size""")
def udtf_chunks(t: Tables) -> DataFrame:
    """A table function with named arguments for each row of a table: as parallel as the table is."""
    udf.register(t.spark)
    t.part.createOrReplaceTempView("part")
    return t.spark.sql("SELECT p_partkey, chunk, first, size FROM part, LATERAL chunks(n => p_size, size => 7)")


@query("udf_overloads", "SELECT o_orderkey, o_orderkey * 2 AS a, o_orderstatus || o_orderstatus AS b FROM orders")
def udf_overloads(t: Tables) -> DataFrame:
    twice = udf.overloads({"bigint": lambda c: F.col(c) * 2, "string": lambda c: F.concat(c, c)})
    return t.orders.select("o_orderkey", twice(t.orders, "o_orderkey").alias("a"), twice(t.orders, "o_orderstatus").alias("b"))


@query("udf_variadic", "SELECT n_nationkey, n_nationkey + n_regionkey + 5 AS s FROM nation")
def udf_variadic(t: Tables) -> DataFrame:
    """Any number of arguments, and state that each worker has a copy of."""
    state = {"add": 5}

    def total(*xs: pd.Series) -> pd.Series:
        return sum(xs[1:], xs[0]) + state["add"]

    f = udf.scalar(t.spark, "total_of", total, "int")
    return t.nation.select("n_nationkey", f("n_nationkey", "n_regionkey").alias("s"))


@query("table_macro", "SELECT n_name FROM nation WHERE n_regionkey = 2")
def table_macro(t: Tables) -> DataFrame:
    t.nation.createOrReplaceTempView("nation")
    t.spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION nations_of(r INT) RETURNS TABLE (n_name STRING) RETURN SELECT n_name FROM nation WHERE n_regionkey = r")
    return t.spark.sql("SELECT * FROM nations_of(2)")


@query("param_query", "SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN 10 AND 99 AND o_orderstatus = 'F'")
def param_query(t: Tables) -> DataFrame:
    t.orders.createOrReplaceTempView("orders")
    return Engine(t.spark).sql("SELECT 1; SELECT o_orderkey FROM orders WHERE o_orderkey BETWEEN $lo AND $hi AND o_orderstatus = $s", {"$lo": 10, "$hi": 99, "$s": "F"})


@query("ingest_append", """SELECT n_nationkey AS id, n_name AS label, 'open' AS state FROM nation UNION ALL SELECT r_regionkey + 100, NULL, 'shut' FROM region UNION ALL SELECT -1, r_name, 'open' FROM region""")
def ingest_append(t: Tables) -> DataFrame:
    """Appends of all and of some columns, with defaults; a row that breaks a constraint is refused at its flush."""
    name = f"append_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE TABLE {name} (id INT, label STRING, state STRING) USING parquet")
    e = Engine(t.spark)
    e.constraints[name] = Constraints(checks=("id < 1000",), defaults={"id": "-1", "state": "'open'"})
    with e.appender(name) as a:
        a.set_columns(["id", "label"])
        a.append_record_batch(t.nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("label")).toArrow().combine_chunks().to_batches()[0])
        a.clear_columns()
        a.append_rows((r.r_regionkey + 100, None, "shut") for r in t.region.collect())
        a.add_column("label")
        a.append_rows((r.r_name,) for r in t.region.collect())
    bad = e.appender(name)
    bad.append_row(1000, "x", "open")
    try:
        bad.flush()
        raise AssertionError("a broken constraint was not noticed")
    except ConstraintError:
        return t.spark.table(name)


@query("ingest_generated", "SELECT p_partkey AS k, p_name AS name, string_split(p_name, ' ') AS words FROM part")
def ingest_generated(t: Tables) -> DataFrame:
    """A generated column is computed as rows are written, and can't be given."""
    name = f"generated_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE TABLE {name} (k BIGINT, name STRING, words ARRAY<STRING>) USING parquet")
    e = Engine(t.spark)
    e.constraints[name] = Constraints(generated={"words": "split(trim(name), ' ')"})
    e.insert(name, e.appender(name).completed(t.part.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))))
    return t.spark.table(name)


@query("ingest_counts", """SELECT * FROM (VALUES ('insert', (SELECT count(*) FROM orders)), ('update', (SELECT count(*) FROM orders WHERE o_orderstatus = 'F')), ('delete', (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 0)),
('default', 1), ('left', (SELECT count(*) + 1 FROM orders WHERE o_orderkey % 3 <> 0)), ('closed', (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0))) v(step, n)""")  # fmt: skip
def ingest_counts(t: Tables) -> DataFrame:
    """Rows that INSERT, UPDATE and DELETE statements change, with bound parameters, and what is left."""
    name = f"counts_{uuid.uuid4().hex}"
    t.orders.createOrReplaceTempView("orders")
    e = Engine(t.spark)
    e.execute(f"CREATE TABLE {name} (k BIGINT, s STRING) USING parquet")
    e.constraints[name] = Constraints(defaults={"k": "1"})
    n = {
        "insert": e.execute(f"INSERT INTO {name} SELECT o_orderkey, o_orderstatus FROM orders"),
        "update": e.execute(f"UPDATE {name} SET s = concat(?, lower(s)) WHERE s = ?", ("shut, ", "F")),
        "delete": e.execute(f"DELETE FROM {name} WHERE k % $by = 0", {"by": 3}),
        "default": e.execute(f"INSERT INTO {name} DEFAULT VALUES"),
        "left": t.spark.table(name).count(),
        "closed": t.spark.table(name).where("s = 'shut, f'").count(),
    }
    return t.spark.createDataFrame(list(n.items()), "step string, n long")


@query("ingest_returning", "SELECT n_nationkey + 1000 AS k, upper(n_name) AS v FROM nation")
def ingest_returning(t: Tables) -> DataFrame:
    name = f"returning_{uuid.uuid4().hex}"
    t.nation.createOrReplaceTempView("nation")
    e = Engine(t.spark)
    e.execute(f"CREATE TABLE {name} (k INT, v STRING, w STRING) USING parquet")
    return e.returning(f"INSERT INTO {name} (v, k) SELECT upper(n_name), n_nationkey + 1000 FROM nation RETURNING k, v")


@query("ingest_merge", """SELECT coalesce(c.c_custkey, s.k) AS k, CASE WHEN s.k IS NULL THEN c.c_name WHEN c.c_custkey IS NULL THEN 'new ' || s.n ELSE c.c_name || '/' || s.n END AS v
FROM customer c FULL JOIN (SELECT o_custkey + 50 AS k, count(*) AS n FROM orders GROUP BY o_custkey) s ON c.c_custkey = s.k WHERE c.c_custkey IS NULL OR s.k IS NULL OR s.n < 15""")  # fmt: skip
def ingest_merge(t: Tables) -> DataFrame:
    """Upserts and deletes by key: orders counted by customer, some of whom aren't in the table."""
    name = f"merge_{uuid.uuid4().hex}"
    t.customer.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v")).write.saveAsTable(name)
    source = t.orders.groupBy((F.col("o_custkey") + 50).alias("k")).agg(F.count("*").alias("n"))
    Engine(t.spark).merge(name, source, ["k"], matched={"v": "concat(t.v, '/', s.n)"}, insert={"k": "s.k", "v": "concat('new ', s.n)"}, delete="s.n >= 15")
    return t.spark.table(name)


@query("ingest_query_appender", "SELECT r_regionkey AS k, r_name || '!' AS v FROM region WHERE r_regionkey > 0")
def ingest_query_appender(t: Tables) -> DataFrame:
    name = f"staged_{uuid.uuid4().hex}"
    e = Engine(t.spark)
    e.execute(f"CREATE TABLE {name} (k INT, v STRING) USING parquet")
    e.query_appender(name, f"INSERT INTO {name} SELECT r_regionkey, concat(r_name, '!') FROM appended WHERE r_regionkey > 0", t.region)
    return t.spark.table(name)


@query("ingest_ddl", "SELECT n_nationkey AS id, n_name, NULL::VARCHAR AS note FROM nation")
def ingest_ddl(t: Tables) -> DataFrame:
    """Create a schema and a table in it, fill it by its qualified name, rename it and add a column."""
    e, schema = Engine(t.spark), f"s_{uuid.uuid4().hex}"
    e.execute_batch(f"CREATE SCHEMA {schema}; CREATE TABLE {schema}.a (id INT, n_name STRING) USING parquet")
    with e.appender("a", schema=schema, catalog="spark_catalog") as a:
        a.append_rows((r.n_nationkey, r.n_name) for r in t.nation.collect())
    e.execute_batch(f"ALTER TABLE {schema}.a RENAME TO {schema}.b; ALTER TABLE {schema}.b ADD COLUMN note STRING; CREATE TABLE {schema}.gone (x INT) USING parquet; DROP TABLE {schema}.gone")
    return t.spark.table(f"{schema}.b")


@query("client_catalog", "SELECT * FROM (VALUES ('nation', 0, 'n_nationkey', 'int'), ('nation', 1, 'n_name', 'string'), ('nation', 2, 'n_regionkey', 'int'), ('region', 0, 'r_regionkey', 'int'), ('region', 1, 'r_name', 'string')) v(name, place, field, type)")
def client_catalog(t: Tables) -> DataFrame:
    """Tables and views of the catalog, and the columns of each."""
    t.nation.createOrReplaceTempView("nation")
    t.region.createOrReplaceTempView("region")
    e = Engine(t.spark)
    names = [r["name"] for r in e.tables().where("name IN ('nation', 'region')").collect()]
    return t.spark.createDataFrame([(n, c.index, c.name, c.type) for n in names for c in e.table_columns(n)], "name string, place int, field string, type string")


@query("source_custom", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def source_custom(t: Tables) -> DataFrame:
    """A data source of our own: written by many tasks, committed by a manifest, read with two columns less than it has."""
    parts.register(t.spark)
    path = scratch(t, "parts")
    path = path if "://" in path else f"file://{path.removeprefix('file:')}"
    t.customer.repartition(3).write.format("arrow_parts").mode("append").option("path", path).save()
    return t.spark.read.format("arrow_parts").option("path", path).schema("c_custkey long, c_name string, c_mktsegment string").load()


@query("ingest_change", "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN upper(n_name) || '!' ELSE n_name END AS n_name FROM nation WHERE n_regionkey <> 3")
def ingest_change(t: Tables) -> DataFrame:
    name = f"change_{uuid.uuid4().hex}"
    t.nation.write.saveAsTable(name)
    e = Engine(t.spark)
    e.update(name, {"n_name": "concat(upper(n_name), '!')"}, "n_regionkey = 1")
    e.delete(name, "n_regionkey = 3")
    return t.spark.table(name).select("n_nationkey", "n_name")


@query("files_roundtrip", "SELECT n_nationkey, n_name, 3 AS copies FROM nation")
def files_roundtrip(t: Tables) -> DataFrame:
    base, out = scratch(t, "files"), None
    for kind in ("parquet", "csv", "json"):
        files.write(t.nation, f"{base}/{kind}", kind)
        schema = t.nation.schema
        df = {"parquet": lambda p: files.parquet(t.spark, p), "csv": lambda p: files.csv(t.spark, p, schema), "json": lambda p: files.json(t.spark, p, schema)}[kind](f"{base}/{kind}")
        df = df.select("n_nationkey", "n_name")
        out = df if out is None else out.union(df)
    return out.groupBy("n_nationkey", "n_name").agg(F.count("*").cast("int").alias("copies"))


def closed_stream(t: Tables, what: str, shape) -> DataFrame:  # noqa: ANN001
    """All events as a stream through ``shape``, run to its end twice: the second run reads a row far in the future, whose
    only effect is that the watermark passes every event, so that all windows close."""
    base = scratch(t, what)
    end, schema = f"{base}/end", t.events.schema
    t.spark.createDataFrame([], schema).write.parquet(end)
    stream = tw.read(t.spark, f"{t.sf_dir}/events.parque[t]", schema).unionByName(tw.read(t.spark, end, schema))
    tw.run(shape(stream), f"{base}/out", f"{base}/checkpoint")
    last = t.spark.range(1).select(*[(F.lit("2999-01-01").cast(f.dataType) if f.name == "ts" else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])
    last.write.mode("append").parquet(end)
    return tw.run(shape(stream), f"{base}/out", f"{base}/checkpoint")


@query("stream_tumbling", """SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS day, event_type, count(*) AS n FROM events GROUP BY ALL""")
def stream_tumbling(t: Tables) -> DataFrame:
    out = closed_stream(t, "tumbling", lambda s: tw.windowed(s, "ts", "1 day", None, [F.count("*").alias("n")], ("event_type",), "10 minutes"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("day"), "event_type", "n")


@query("stream_sliding", """SELECT w AS start, count(*) AS n FROM (SELECT unnest([time_bucket(INTERVAL '12 hours', ts, TIMESTAMP '1970-01-01'), time_bucket(INTERVAL '12 hours', ts, TIMESTAMP '1970-01-01') - INTERVAL '12 hours']) AS w FROM events) GROUP BY w""")
def stream_sliding(t: Tables) -> DataFrame:
    out = closed_stream(t, "sliding", lambda s: tw.windowed(s, "ts", "1 day", "12 hours", [F.count("*").alias("n")], (), "10 minutes"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("start"), "n")


@query("stream_sessions", """SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (
SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL '6 hours' THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""")  # fmt: skip
def stream_sessions(t: Tables) -> DataFrame:
    out = closed_stream(t, "sessions", lambda s: tw.sessions(s, "ts", "6 hours", [F.count("*").alias("n")], ("user_id",), "10 minutes"))
    return out.where("user_id IS NOT NULL").select("user_id", F.col("session_start").cast("timestamp_ntz").alias("start"), "n")
