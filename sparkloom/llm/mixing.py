"""Mixing sources to target weights, with DataFrame operations only.

Documents get hash-random keys. Within each source they are put in key order, running sums of their sizes
come from sums of key ranges plus running sums within a range, and the source is cut at its exact budget; a
source whose budget exceeds its size is repeated in whole epochs first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, small, written

#: Mean rows of one key range of one source, over which one task keeps a running sum.
RANGE_ROWS = 4096
#: Ranges in a block of the prefix sums.
BLOCK_RANGES = 4096
#: Bits of a key: 15 hex digits of a digest.
KEY_BITS = 60


def sized(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", row: str | None = None) -> DataFrame:
    """(id, source, size, rnd, and row if given): word counts and hash-random keys of all rows."""
    rnd = F.conv(F.substring(F.md5(F.concat_ws("|", F.coalesce(F.col(key).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))), 1, KEY_BITS // 4), 16, 10)
    return docs.select(
        F.col(key).alias("id"), F.col(source).alias("source"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        rnd.cast("long").alias("rnd"),
        *([F.col(row).alias("row")] if row else []),
    )


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size, n_rows, target) from rows of (source, size).

    Sources in code-point order, null last, weigh ``weights``, repeated. Targets are in proportion to the weights,
    but at most ``most`` times the source's size; what is cut off goes to the others by weight. That level is found
    in closed form: with sources by size over weight, the first k at their caps, the rest share what remains.
    The windows here run over one row for each source, after aggregation.
    """
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = s.withColumn("weight", w.cast("long"))
    by_ratio = Window.orderBy((F.col("source_size") / F.col("weight")), F.col("source").asc_nulls_last())
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(F.lit(0))
    s = (
        s.withColumn("total", F.sum("source_size").over(whole))
        .withColumn("left", F.col("total") - most * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
        .withColumn("share", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        # The source is at its cap if its part of what is left, shared by it and all later ones, reaches the cap.
        .withColumn("capped", F.col("weight") * F.col("left") >= most * F.col("source_size") * F.col("share"))
    )
    free = F.struct("left", "share")
    s = s.withColumn("level", F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), free.alias("free")))).over(whole))
    target = F.when(F.col("capped"), (most * F.col("source_size")).cast("double")).otherwise(
        (F.col("weight") * F.col("level.free.left")).cast("double") / F.col("level.free.share").cast("double")
    )
    return s.select("source", "source_size", "n_rows", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), most: int = 3, key: str = "doc_id", source: str = "source", text: str = "text", row: str | None = None) -> DataFrame:
    """(key, size, source_size, target, taken, and row if given), one row for each row of ``docs``.

    ``taken`` is the number of words the mix takes of the document, repeats counted: whole epochs, and the part of
    the last epoch that lies before the source's budget (its target, rounded). Null texts and texts without words
    have size 0 and nothing taken. A null source is a source of its own, last in order. Equal keys are ordered by
    id and size; equal rows share a place in the order, one before the other. ``row`` names a column of unique row keys,
    by which the result can be joined to ``docs``: ``key`` need not be unique. An empty table gives an empty result.
    Other columns aren't read. Ranges of keys, not sources, are the unit of work: a source with a third of all rows
    is as many ranges as its rows need.
    """
    d = written(sized(docs, key, source, text, row), "sizes")
    t = written(targets(d, weights, most), "targets")
    n_sources = t.count()
    t = t.withColumn("ranges", F.greatest(F.lit(1), F.ceil(F.col("n_rows") / RANGE_ROWS)).cast("long"))
    d = d.join(small(t, n_sources), d["source"].eqNullSafe(t["source"])).select(d["*"], "source_size", "n_rows", "target", "ranges")
    # Key order is range order: a range is an equal part of the key space.
    d = d.withColumn("part", F.floor(F.col("rnd").cast("double") / F.lit(float(1 << KEY_BITS)) * F.col("ranges")).cast("long"))
    sums = d.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    # Prefix sums in two levels: over blocks of ranges, then over the ranges of a block, so that no task has all of a source's.
    sums = written(sums.withColumn("block", F.floor(F.col("part") / BLOCK_RANGES)), "ranges")
    earlier = Window.unboundedPreceding, -1
    blocks = sums.groupBy("source", "block").agg(F.sum("part_size").alias("block_size"))
    over_blocks = Window.partitionBy("source").orderBy("block").rowsBetween(*earlier)
    blocks = blocks.select(F.col("source").alias("bs"), F.col("block").alias("b"), F.coalesce(F.sum("block_size").over(over_blocks), F.lit(0)).alias("blocks_ahead"))
    over_ranges = Window.partitionBy("source", "block").orderBy("part").rowsBetween(*earlier)
    sums = sums.withColumn("ahead", F.coalesce(F.sum("part_size").over(over_ranges), F.lit(0))).join(blocks, F.col("source").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("b")))
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), (F.col("ahead") + F.col("blocks_ahead")).alias("ahead"))
    within = Window.partitionBy("source", "part").orderBy("rnd", "id", "size", *(["row"] if row else [])).rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0)))
    d = d.join(sums, d["source"].eqNullSafe(sums["s"]) & (d["part"] == sums["p"]))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("ahead") - F.col("within")))
    return d.select(F.col("id").alias(key), "size", "source_size", "target", (epochs * F.col("size") + part).cast("long").alias("taken"), *([F.col("row").alias(row)] if row else []))
