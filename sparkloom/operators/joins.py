"""Joins that Spark has no operator for: as-of and range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str], tie: str, seconds: int = 86_400) -> DataFrame:
    """Each row of ``left`` with ``values`` of the last row of ``right`` of its key at or before its time; nulls if none.

    Of equal times the row with the largest ``tie`` counts. Rows are dealt by key and time slice, so that a key with very
    many rows is many tasks: the last row of each slice is found by an aggregate and carried over later slices.
    """
    slice_of = lambda c: F.floor(F.unix_timestamp(F.col(c).cast("timestamp")) / seconds)
    facts = F.struct(F.col(right_time).alias("t"), F.col(tie).alias("tie"), F.struct(*values).alias("v"))
    r = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(F.col(key).alias("_k"), slice_of(right_time).alias("_s"), facts.alias("_r"))
    ends = r.groupBy("_k", "_s").agg(F.max("_r").alias("_end"))
    own = left.withColumn("_s", slice_of(left_time))
    slices = own.select(F.col(key).alias("_k"), "_s").distinct().withColumn("_end", F.lit(None).cast(ends.schema["_end"].dataType)).withColumn("_ask", F.lit(True))
    both = ends.withColumn("_ask", F.lit(False)).unionByName(slices).groupBy("_k", "_s").agg(F.max("_end").alias("_end"), F.max("_ask").alias("_ask"))
    before = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    carried = both.withColumn("_before", F.last("_end", ignorenulls=True).over(before)).where("_ask").select("_k", "_s", "_before")
    side = lambda df, mine: df.withColumn("_mine", F.lit(mine))
    l_rows = side(own.select(F.col(key).alias("_k"), "_s", F.col(left_time).alias("_t"), F.struct(*left.columns).alias("_l")), 1)
    r_rows = side(r.select("_k", "_s", F.col("_r.t").alias("_t"), "_r"), 0)
    rows = l_rows.unionByName(r_rows, allowMissingColumns=True)
    w = Window.partitionBy("_k", "_s").orderBy("_t", "_mine", F.col("_r.tie")).rowsBetween(Window.unboundedPreceding, 0)
    got = rows.withColumn("_within", F.last("_r", ignorenulls=True).over(w)).where("_mine = 1")
    got = got.join(carried, got["_k"].eqNullSafe(carried["_k"]) & got["_s"].eqNullSafe(carried["_s"]), "left")
    hit = F.coalesce("_within", "_before")
    return got.select("_l.*", *[hit["v"][v].alias(f"{v}_asof") for v in values])


def in_range(points: DataFrame, at: Column, spans: DataFrame, start: Column, end: Column, width: float, on: list[tuple[str, str]] = ()) -> DataFrame:
    """Rows of ``points`` with rows of ``spans`` for which start <= at <= end: an equi-join on buckets of ``width``, then
    the exact condition. Each span is copied to the buckets that it touches; choose ``width`` near the usual span."""
    p = points.withColumn("_at", at.cast("double")).withColumn("_b", F.floor(F.col("_at") / width))
    s = spans.withColumn("_from", start.cast("double")).withColumn("_to", end.cast("double"))
    s = s.withColumn("_sb", F.explode(F.sequence(F.floor(F.col("_from") / width), F.floor(F.col("_to") / width))))
    cond = (F.col("_b") == F.col("_sb")) & F.col("_at").between(F.col("_from"), F.col("_to"))
    for a, b in on:
        cond &= p[a] == s[b]
    return p.join(s, cond).drop("_at", "_b", "_from", "_to", "_sb")


#: Strategies by the name of Spark's hint.
STRATEGIES = ("broadcast", "merge", "shuffle_hash", "shuffle_replicate_nl")


def hinted(left: DataFrame, right: DataFrame, on: list[str] | Column, strategy: str, how: str = "inner") -> DataFrame:
    """A join whose right side carries a strategy hint; without one, sizes at run time decide, which is the better default."""
    if strategy not in STRATEGIES:
        raise ValueError(f"no such strategy: {strategy}")
    return left.join(right.hint(strategy), on, how)
