"""URL filters: rules on hosts and path prefixes, matched by hashed expressions.

A URL is expanded into expressions, each a suffix of its host joined to a prefix of its path. Expressions
meet the rules in an equi-join on a short prefix of their digest; the full digest then confirms the match,
and the longest rule wins (of equally long ones that with the longer host, then blocking).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES

#: Hex digits of the digest that the join compares first: 32 bits, as lists of unsafe URLs do.
SHORT = 8
#: Bytes of a rule in a broadcast.
RULE_BYTES = 512


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or where ``://`` is missing."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(u, instr(u, '://') + 3)"))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rules as a table with digests."""
    df = spark.createDataFrame([(v, h.lower(), p) for v, h, p in rules], "verdict string, rule_host string, rule_path string")
    return with_digest(df.withColumn("rule", F.concat("rule_host", "rule_path")), "rule")


def with_digest(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("digest", F.sha2(column, 256)).withColumn("short", F.substring("digest", 1, SHORT))


def by_short(rules: DataFrame) -> DataFrame:
    """(r_short, rules): one row for each short prefix, with all rules that have it, as their full digests may differ."""
    rule = F.struct(F.length("rule").alias("n"), F.length("rule_host").alias("n_host"), "verdict", "rule", "digest")
    return rules.groupBy(F.col("short").alias("r_short")).agg(F.collect_set(rule).alias("rules"))


def confirmed(rules: Column, expression: Column) -> Column:
    """Of the rules that an expression's short prefix has met, the first by precedence whose full digest is its own."""
    return F.array_max(F.filter(rules, lambda r: r["digest"] == F.sha2(expression, 256)))


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow", shapes_in_place: int = 32) -> DataFrame:
    """(key, url, host, path, rule, verdict), one row for each row of ``pages``.

    ``rules`` comes from ``rule_table``. Only shapes (a suffix depth and a prefix length) that some rule has are
    expanded, so a very long URL makes no more expressions than a short one. The join key is the short prefix alone;
    full digests are compared after the join. With few shapes and rules that may be broadcast, each shape is a join
    of its own and every row is judged in place, without a shuffle; otherwise the expressions are exploded and the best
    rule of each distinct row is found by an aggregate. Null URLs, and those without ``://``, have an empty host and path,
    match no rule and get ``default``. Repeated rows come back as often as they came; null keys are kept; an empty
    table gives an empty result. Other columns of ``pages`` aren't read, so their names can't clash.
    """
    shapes = rules.select(F.size(F.split("rule_host", r"\.")).alias("d"), F.length("rule_path").alias("n")).distinct()
    # One row for each pair of a depth and a length that the rules have: as small as the rules are varied.
    shapes = sorted((r.d, r.n) for r in shapes.collect())
    n_rules = rules.count()
    listed = by_short(rules)
    base = pages.select(F.col(key).alias("k"), F.col(url).alias("u"))
    in_place = len(shapes) <= shapes_in_place and n_rules * RULE_BYTES <= BROADCAST_BYTES
    if not in_place:
        base = base.groupBy("k", "u").agg(F.count("*").alias("copies"))
    host, path = split_url(F.col("u"))
    base = base.withColumn("host", host).withColumn("path", path).withColumn("labels", F.split("host", r"\."))

    def expression(d: int, n: int) -> Column:
        """The suffix of so many labels with the prefix of so many code points, null where the URL is shorter."""
        fits = (F.size("labels") >= d) & (F.length("path") >= n)
        return F.when(fits, F.concat(F.array_join(F.slice("labels", -d, d), "."), F.substring(F.col("path"), 1, n)))

    if in_place:
        best = []
        for i, (d, n) in enumerate(shapes):
            meets = F.broadcast(listed.select(F.col("r_short").alias(f"s{i}"), F.col("rules").alias(f"r{i}")))
            short = F.substring(F.sha2(expression(d, n), 256), 1, SHORT)
            base = base.join(meets, short == F.col(f"s{i}"), "left")
            best.append(confirmed(F.col(f"r{i}"), expression(d, n)))
        top = F.greatest(*best) if len(best) > 1 else best[0] if best else F.lit(None).cast(listed.schema["rules"].dataType.elementType)
        out = base.select("k", "u", "host", "path", top.alias("best"), F.lit(1).alias("copies"))
    else:
        exploded = base.withColumn("expression", F.explode_outer(F.array_compact(F.array(*[expression(d, n) for d, n in shapes]))))
        hit = exploded.join(listed, F.substring(F.sha2("expression", 256), 1, SHORT) == F.col("r_short"), "left")
        hit = hit.withColumn("found", confirmed(F.col("rules"), F.col("expression")))
        out = hit.groupBy("k", "u", "host", "path", "copies").agg(F.max("found").alias("best"))
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return out.select(F.col("k").alias(key), F.col("u").alias(url), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
