"""Operators on small rows: nulls, ties, empty tables."""

import datetime as dt

from pyspark.sql import functions as F

from sparkloom.functions import values
from sparkloom.operators import joins, shapes
from sparkloom.sources import files
from sparkloom.streaming import windows


def test_as_of_brute(spark):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    left = [(k, at(s)) for k in (1, 2, None) for s in (0, 50, 100_000, 300_000)]
    right = [(1, at(50), 1, 5.0), (1, at(50), 2, 6.0), (1, at(90_000), 3, 7.0), (2, at(299_999), 4, 8.0), (None, at(0), 5, 9.0)]
    l_df = spark.createDataFrame(left, "k int, t timestamp")
    r_df = spark.createDataFrame(right, "k int, rt timestamp, id int, v double")
    got = {(r.k, r.t): r.v_asof for r in joins.as_of(l_df, r_df, "k", "t", "rt", ["v"], "id").collect()}
    for k, t in left:
        hits = sorted((rt, i, v) for rk, rt, i, v in right if k is not None and rk == k and rt <= t)
        assert got[k, t] == (hits[-1][2] if hits else None)
    assert joins.as_of(l_df, r_df.limit(0), "k", "t", "rt", ["v"], "id").count() == len(left)


def test_in_range_brute(spark):
    pts, spans = [0.0, 1.5, 9.9, 10.0, -3.0], [(0.0, 1.5), (9.0, 25.0), (-4.0, -3.0)]
    p = spark.createDataFrame([(x,) for x in pts], "x double")
    s = spark.createDataFrame(spans, "a double, b double")
    got = sorted((r.x, r.a) for r in joins.in_range(p, F.col("x"), s, F.col("a"), F.col("b"), 5.0).collect())
    assert got == sorted((x, a) for x in pts for a, b in spans if a <= x <= b)


def test_ordinal_and_series(spark):
    d = files.with_ordinal(spark.createDataFrame([(x,) for x in (5, 3, None, 9)], "x int"), "x")
    assert [r.x for r in d.orderBy("rowid").collect()] == [None, 3, 5, 9]
    many = spark.range(0, 1_000_000, 1, 16).select(F.xxhash64("id").alias("k"))
    r = files.with_ordinal(many, "k").agg(F.count("*"), F.count_distinct("rowid"), F.min("rowid"), F.max("rowid")).first()
    assert tuple(r) == (1_000_000, 1_000_000, 0, 999_999)
    assert [r[0] for r in files.series(spark, 1, 5, 2).collect()] == [1, 3, 5]


def test_values(spark):
    d = spark.sql("SELECT CAST(2.5 AS DECIMAL(4,1)) AS a, 'a.b.c' AS s, array(7, 8) AS l, timestamp'2024-03-09 01:02:03' AS t")
    r = d.select(values.to_integer(F.col("a")).alias("a"), values.split(F.col("s"), ".").alias("s"), values.item(F.col("l"), 3).alias("i"), values.strftime(F.col("t"), "%Y/%m at %H").alias("t")).first()
    assert (r.a, r.s, r.i, r.t) == (3, ["a", "b", "c"], None, "2024/03 at 01")


def test_top_k_nulls_last(spark):
    d = spark.createDataFrame([(1, None), (1, 2), (1, 5)], "g int, x int")
    assert [r.x for r in shapes.top_k(d, ["g"], shapes.ordered("-x"), 2).orderBy("x").collect()] == [2, 5]


def test_sessions_and_stream_distinct(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 1, 0, m)) for m in (0, 3, 20)]
    d = spark.createDataFrame(rows, "u int, t timestamp")
    assert windows.sessions(d, "t", "5 minutes", [F.count("*").alias("n")], ("u",)).count() == 2
    spark.createDataFrame(rows * 2, "u int, t timestamp").write.parquet(str(tmp_path / "in"))
    s = windows.read(spark, str(tmp_path / "in"), d.schema)
    assert windows.run(windows.distinct(s, ["u", "t"], "t", "1 hour"), str(tmp_path / "out"), str(tmp_path / "cp")).count() == 3


def test_late_rows_are_dropped(spark, tmp_path):
    """A row behind the watermark of a batch before it isn't counted any more."""
    day = lambda d, h=0: dt.datetime(2024, 1, d, h)
    for i, rows in enumerate(([day(1), day(1, 5)], [day(3)], [day(1, 6)], [day(9)])):
        spark.createDataFrame([(t,) for t in rows], "t timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        s = windows.windowed(windows.read(spark, str(tmp_path / "in"), spark.createDataFrame([], "t timestamp").schema), "t", "1 day", None, [F.count("*").alias("n")], (), "1 hour")
        out = windows.run(s, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert [(r.window_start.day, r.n) for r in out.orderBy("window_start").collect()] == [(1, 2), (3, 1)]


def test_udf_failure_leaves_the_session(spark):
    import pandas as pd
    import pytest

    from sparkloom.functions import udf

    def fails(x: pd.Series) -> pd.Series:
        raise ValueError("no good")

    f = udf.scalar(spark, "fails", fails, "long")
    with pytest.raises(Exception, match="no good"):
        spark.range(3).select(f("id")).collect()
    assert spark.range(3).count() == 3
    udf.register(spark)
    assert spark.sql("SELECT digit_sum(1905L) AS s").first().s == 15
    assert spark.sql("SELECT sum(size) AS s FROM chunks(size => 4, n => 10)").first().s == 10


def test_raising_conversions(spark):
    import pytest

    for bad in (values.to_uuid(F.lit("xyz")), values.enum_code(F.lit("Q"), ["A"]), values.unsigned(F.lit("256"), "utinyint")):
        with pytest.raises(Exception, match="no UUID|no such label|out of range"):
            spark.range(1).select(bad).collect()
