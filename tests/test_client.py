"""The client facade: scripts, parameters, rows, appends and table changes."""

import uuid

import pyarrow as pa
import pytest

from sparkloom.client import Column, column_index, columns, Constraints, ConstraintError, Engine, kind, MoreThanOneRow, NoRows, NotOneChange, Pool, Row, shell, split_statements
from sparkloom.client.engine import bind, ParameterError, split_commas, split_where


def fresh(spark, columns):
    name = f"t_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet")
    return name


def test_split_statements_ignores_quotes_and_comments():
    assert split_statements("SELECT ';'; -- a; b\nSELECT 2 /* ; */;;") == ["SELECT ';'", "-- a; b\nSELECT 2 /* ; */"]


def test_statements_with_comments_and_escapes():
    assert split_statements("SELECT 1; -- done") == ["SELECT 1"]
    assert split_statements(r"SELECT 'a\';b'; SELECT 2") == [r"SELECT 'a\';b'", "SELECT 2"]
    assert kind("/* x */ -- y\n insert into t") == "INSERT" and kind("") == ""
    assert split_where("a = (SELECT 1 WHERE true), b = 'x where' WHERE c = 1") == ("a = (SELECT 1 WHERE true), b = 'x where'", "c = 1")
    assert split_commas("a = f(1, 2), b = 'x,y'") == ["a = f(1, 2)", "b = 'x,y'"]


def test_bind_forms():
    assert bind("SELECT ?, ?", (1, 2)) == ("SELECT :p_1, :p_2", {"p_1": 1, "p_2": 2})
    assert bind("SELECT ?2, $1", (1, 2))[1] == {"p_1": 1, "p_2": 2}
    assert bind("SELECT '?', $x", {"$x": 3}) == ("SELECT '?', :p_x", {"p_x": 3})


@pytest.mark.parametrize(("text", "params"), [("SELECT ?", ()), ("SELECT 1", (1,)), ("SELECT $a", {"a": 1, "$a": 2}), ("SELECT $a", {"b": 1}), ("SELECT ?", {"a": 1}), ("SELECT $a", (1,)), ("SELECT ?", ([1],))])
def test_bind_refuses(text, params):
    with pytest.raises(ParameterError):
        bind(text, params)


def test_rows(spark):
    e = Engine(spark)
    assert [r["I"] for r in e.query("SELECT id AS i FROM range(?)", (3,))] == [0, 1, 2]
    assert e.query_row("SELECT 1 AS a, 2 AS A")["a"] == 1
    assert e.optional("SELECT 1 WHERE false") is None
    assert e.exists("SELECT 1") and not e.exists("SELECT 1 WHERE false")
    with pytest.raises(NoRows):
        e.query_row("SELECT 1 WHERE false")
    with pytest.raises(MoreThanOneRow):
        e.query_one("SELECT id FROM range(2)")
    assert e.arrow("SELECT 1 AS a").to_pydict() == {"a": [1]}


def test_integer_ranges():
    from decimal import Decimal

    r = Row([300, Decimal("2.5"), Decimal("-2.5"), True], ["a", "b", "c", "d"])
    assert [r.integer("b"), r.integer("c"), r.integer("d")] == [3, -3, 1]
    with pytest.raises(OverflowError):
        r.integer("a", 8)


def test_constraints(spark):
    parent, child = fresh(spark, "id INT"), fresh(spark, "id INT, p INT, s STRING")
    e = Engine(spark)
    e.constraints[child] = Constraints(not_null=["s"], unique=[["id"]], foreign=[(["p"], parent, ["id"])], generated={})
    with e.appender(parent) as a:
        a.append_rows([(1,), (2,)])
    with e.appender(child) as a:
        a.append_row(1, 2, "x")
    for bad in ((1, 2, "y"), (2, 9, "y"), (2, 2, None)):
        a = e.appender(child)
        a.append_row(*bad)
        with pytest.raises(ConstraintError):
            a.flush()
    assert [tuple(r) for r in spark.table(child).collect()] == [(1, 2, "x")]
    with pytest.raises(ValueError, match="values for"):
        e.appender(child).append_row(1)


def test_arrow_append_update_delete(spark):
    t = fresh(spark, "a INT, b STRING")
    e = Engine(spark)
    with e.appender(t) as a:
        a.append_record_batch(pa.record_batch({"a": pa.array([1, 2, None], pa.int32()), "b": ["x", "y", "z"]}))
    assert e.update(t, {"b": "upper(b)"}, "a > 1") == 1
    assert e.delete(t, "a = 1") == 1
    assert sorted((r.a or 0, r.b) for r in spark.table(t).collect()) == [(0, "z"), (2, "Y")]
    assert e.insert(t, spark.sql("SELECT 'q' AS b, 7 AS a")) == 1
    assert spark.table(t).where("a = 7").first().b == "q"


def test_typed_values():
    import datetime as dt
    from decimal import Decimal

    u = uuid.uuid4()
    r = Row([str(u), u.bytes, "2024-02-03", '{"a": [1]}', Decimal("1.5"), None, b"\x01", 7], list("abcdefgh"))
    assert r.get("a", uuid.UUID) == r.get("b", uuid.UUID) == u
    assert r.get("c", dt.date) == dt.date(2024, 2, 3) and r.get("d", dict) == {"a": [1]} and r.get("e", float) == 1.5 and r.get("f", int) is None and r.get("g", bytes) == b"\x01"
    assert r.tuple(str, uuid.UUID, str, dict, Decimal, str, bytes, int)[-1] == 7
    for name, of in (("g", str), ("h", dt.date), ("a", bool)):
        with pytest.raises(TypeError):
            r.get(name, of)
    with pytest.raises(ValueError, match="8 columns"):
        r.tuple(int)


def test_execute_counts_and_returning(spark):
    t, e = fresh(spark, "a INT, b STRING"), Engine(spark)
    e.constraints[t] = Constraints(defaults={"b": "'none'"})
    assert e.execute(f"INSERT INTO {t} VALUES (1, 'x'), (2, 'y')") == 2
    assert e.execute(f"INSERT INTO {t} (a) VALUES (?)", (3,)) == 1
    assert [tuple(r) for r in e.returning(f"INSERT INTO {t} (a) VALUES (4) RETURNING b, a").collect()] == [("none", 4)]
    assert e.execute(f"UPDATE {t} SET b = concat(b, ', ', $s), a = a + 10 WHERE a IN (1, 2)", {"s": "z"}) == 2
    assert e.execute(f"DELETE FROM {t} WHERE a = 3") == 1 and e.execute(f"DELETE FROM {t} WHERE a = 99") == 0
    assert e.execute(f"INSERT INTO {t} DEFAULT VALUES") == 1
    assert sorted((r.a or 0, r.b) for r in spark.table(t).collect()) == [(0, "none"), (4, "none"), (11, "x, z"), (12, "y, z")]
    e.execute_one(f"DELETE FROM {t} WHERE a = 4")
    with pytest.raises(NotOneChange):
        e.execute_one(f"UPDATE {t} SET b = 'q' WHERE a > 10")
    assert e.execute(f"CREATE TABLE {t}_x (a INT) USING parquet; DROP TABLE {t}_x") == 0
    assert e.execute(f"UPDATE {t} SET b = 'w'") == 3


def test_merge_refuses_and_checks(spark):
    t, e = fresh(spark, "k INT, v STRING"), Engine(spark)
    e.execute(f"INSERT INTO {t} VALUES (1, 'a'), (2, 'b')")
    with pytest.raises(ValueError, match="several rows"):
        e.merge(t, spark.sql("SELECT explode(array(1, 1)) AS k"), ["k"], matched={"v": "'x'"})
    assert e.merge(t, spark.sql("SELECT 1 AS k UNION ALL SELECT 3"), ["k"], matched={"v": "upper(t.v)"}) == 1
    assert sorted(map(tuple, spark.table(t).collect())) == [(1, "A"), (2, "b")]
    e.constraints[t] = Constraints(unique=[["v"]])
    with pytest.raises(ConstraintError):
        e.update(t, {"v": "'same'"})
    assert sorted(map(tuple, spark.table(t).collect())) == [(1, "A"), (2, "b")]


def test_appender_columns(spark):
    t, e = fresh(spark, "a INT, b INT, c INT"), Engine(spark)
    e.constraints[t] = Constraints(generated={"c": "a + b"})
    with e.appender(t) as a:
        a.append_row(1, 2)
        a.add_column("a")
        a.append_row(5)
        a.add_column("b")
        a.append_row(6, 7)
        a.clear_columns()
        a.append_row(8, 9)
        with pytest.raises(ValueError, match="no column"):
            a.set_columns(["z"])
    assert sorted(map(tuple, spark.table(t).select("a", "c").collect()), key=repr) == [(1, 3), (5, None), (6, 13), (8, 17)]


def test_metadata_settings_and_shell(spark):
    e = Engine(spark)
    d = e.sql("SELECT 1 AS a, cast(NULL AS STRING) AS A2, array(1.5) AS c")
    assert columns(d)[0] == Column(0, "a", "int", False) and column_index(d, "C") == 2
    with pytest.raises(KeyError):
        column_index(d, "zz")
    old = e.setting("spark.sql.shuffle.partitions")
    assert e.set_setting("spark.sql.shuffle.partitions", 3, check=True) == "3"
    e.set_setting("spark.sql.shuffle.partitions", old)
    assert "HashAggregate" in e.explain("SELECT count(*) FROM range(?)", (9,)) and e.version() == spark.version
    t = fresh(spark, "a INT")
    assert t in shell.answer(e, ".tables") and shell.answer(e, f".schema {t}") == "a int" and "7" in shell.answer(e, "SELECT 7 AS x; -- so")
    assert e.tables().where(f"name = '{t}'").count() == 1


def test_pool_and_progress(spark):
    pool = Pool(spark, lambda e: e.spark.sql("CREATE TEMPORARY VIEW mine AS SELECT 1 AS a"))
    assert pool.get() is pool.get() and pool.get().query_one("SELECT a FROM mine")["a"] == 1
    assert not spark.catalog.tableExists("mine")
    spark.sparkContext.setJobGroup("counted", "")
    spark.range(100).repartition(4).count()
    done, known = Engine(spark).progress("counted")
    assert 0 < done <= known
    spark.sparkContext.setJobGroup("", "")


def test_fetch_error_is_raised(spark):
    it = Engine(spark).query("SELECT if(id < 3, id, raise_error('bad')) AS x FROM range(0, 5, 1, 5)")
    with pytest.raises(Exception, match="bad"):
        list(it)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        Engine(spark).query_row("SELECT CAST('x' AS INT)")
