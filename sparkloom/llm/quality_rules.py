"""Quality rules: text statistics and a hashed n-gram log-likelihood ratio, with DataFrame operations only.

The ratio compares two multinomials over hashed word n-grams, one of trusted documents and one of the whole raw
corpus, both counted over all their documents. A document's score is the mean log ratio of its n-grams; the
verdict is a fixed threshold on that score, so equal documents of one corpus always get equal verdicts.

Each distinct n-gram (by its 64-bit hash) has its own count, so the table grows with the corpus: its most frequent
n-grams are broadcast, ``TABLE_ROWS`` at most, and all others are joined by a shuffle. A caller may ask for ``buckets``
instead, in which a corpus with no more distinct n-grams is counted; the queries and the pipeline don't (``EACH``), so
that their scores follow one formula whatever the size of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, small, written

#: Buckets of n-grams of a small corpus; one with more distinct n-grams has a count for each of them.
BUCKETS = 1 << 14
#: As number of buckets: a count for each distinct n-gram, however few there are.
EACH = 0
#: Distinct n-grams of which the weights may be broadcast; a row is two longs.
TABLE_ROWS = 1 << 20
#: Unit of the weights of distinct n-grams, which are summed as whole numbers: sums then don't depend on the order.
UNIT = 1e-6
#: Words in an n-gram. Held-out figures are in the README.
ORDER = 1
#: Added to each count.
SMOOTHING = 1.0
#: Mean log ratio below which a document is rejected: its n-grams are, on average, this much rarer in trusted text.
MIN_SCORE = -0.25
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5


def words(text: Column) -> Column:
    """The words of a text, none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def grams(words: Column, order: int) -> Column:
    """n-grams of an array of words, as strings."""
    out, n = words, F.size(words)
    for k in range(1, order):
        left = F.greatest(n - k, F.lit(0))
        out = F.zip_with(F.slice(out, F.lit(1), left), F.slice(words, F.lit(k + 1), left), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def hash_of(gram: Column) -> Column:
    return F.xxhash64(gram)


def bucket_of(gram: Column, buckets: int) -> Column:
    return F.pmod(hash_of(gram), F.lit(buckets)).cast("int")


def gram_counts(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """(gram, raw, good): how often each distinct n-gram, as its hash, is in all and in trusted documents.

    ``trusted`` holds keys of trusted documents in its column ``key``, and is broadcast only after a count.
    """
    ids = trusted.select(F.col(key).alias("_q_id")).where("_q_id IS NOT NULL").distinct()
    ids = small(ids.withColumn("_q_trusted", F.lit(1)), trusted.count())
    d = docs.select(F.col(key).alias("_q_key"), F.col(text).alias("_q_raw")).join(ids, F.col("_q_key") == F.col("_q_id"), "left")
    d = occurrences(d, "_q_trusted", "_q_raw", order)
    c = d.groupBy("gram").agg(F.count("*").alias("raw"), F.count("_q_trusted").alias("good"))
    return written(c, "grams")  # the totals and the weights each use the counts: the corpus is counted once


def occurrences(d: DataFrame, keep: str, text: str, order: int) -> DataFrame:
    """(keep, gram): a row for each n-gram of each text."""
    d = d.select(keep, F.transform(grams(words(F.col(text)), order), hash_of).alias("_q_grams"))
    # explode_outer: a plain explode adds a filter below it that computes the array once more
    return d.select(keep, F.explode_outer("_q_grams").alias("gram")).where("gram IS NOT NULL")


def log_ratios(counts: DataFrame, raw: int, good: int, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, weight): log of the trusted over the raw probability of each bucket, from counts and their totals.

    Without any trusted document all weights come from smoothing alone.
    """
    c = counts.groupBy(F.pmod("gram", F.lit(buckets)).cast("int").alias("bucket")).agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
    every = counts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    c = every.join(c, "bucket", "left").na.fill(0)
    a, ab = F.lit(SMOOTHING), F.lit(SMOOTHING * buckets)
    return c.select("bucket", (F.log((F.col("good") + a) / (good + ab)) - F.log((F.col("raw") + a) / (raw + ab))).alias("weight"))


def gram_weights(counts: DataFrame, raw: int, good: int) -> DataFrame:
    """(gram, n, weight): log ratio of each distinct n-gram, in whole ``UNIT``s, and its count.

    The smoothing is in proportion to the totals: the trusted count is compared with the one to expect at the raw
    share, and SMOOTHING is added to both. An n-gram's weight doesn't depend on how many others there are, and rare
    ones weigh little. Without any trusted document all weights are 0.
    """
    ratio = F.log((F.col("good") + SMOOTHING) / (F.col("raw") * F.lit(good / max(raw, 1)) + SMOOTHING))
    return counts.select("gram", F.col("raw").alias("n"), F.round(ratio / UNIT).cast("long").alias("weight"))


def digest(text: str) -> Column:
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def mean_weights(docs: DataFrame, weights: DataFrame, n_weights: int, text: str, order: int, table_rows: int) -> DataFrame:
    """(_q_digest, _q_mean): the mean weight of the n-grams of each distinct text that has any.

    The most frequent n-grams are broadcast: all that occur 2^k times or more, with the least k at which they are at
    most ``table_rows``. The others are joined by a shuffle, in which no n-gram has 2^k rows.
    """
    occ = occurrences(docs.select(digest(text).alias("_q_digest"), F.col(text).alias("_q_raw")), "_q_digest", "_q_raw", order)
    least, rest = 1, n_weights
    if n_weights > table_rows:
        for k, n in sorted(weights.groupBy(F.floor(F.log2("n")).cast("int").alias("k")).count().collect()):
            if rest <= table_rows:
                break
            least, rest = 1 << (k + 1), rest - n
    known = F.broadcast(weights.where(F.col("n") >= least).select("gram", "weight"))
    sums = [F.sum("weight").alias("total"), F.count("*").alias("n")]
    out = occ.join(known, "gram").groupBy("_q_digest").agg(*sums)
    if least > 1:
        rare = weights.where(F.col("n") < least).select("gram", "weight")
        others = occ.join(known, "gram", "left_anti").join(rare, "gram").groupBy("_q_digest").agg(*sums)
        out = out.union(others).groupBy("_q_digest").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return out.select("_q_digest", (F.col("total") * F.lit(UNIT) / F.col("n")).alias("_q_mean"))


def as_literal(weights: DataFrame, buckets: int) -> Column:
    """A small corpus's model as a constant array; it comes to the driver because its size is ``buckets``.

    Split and cast are folded to one literal before execution, so that no row carries the array.
    """
    w = ["0"] * buckets
    for r in weights.collect():
        w[r.bucket] = f"{r.weight:.6g}"
    return F.split(F.lit(",".join(w)), ",").cast("array<double>")


def repeated_words(d: DataFrame) -> DataFrame:
    """Adds _q_repeat: words inside 5-word windows that occur twice or more in the text, each word once.

    Windows are compared by 64-bit hashes, built from pairs, pairs of pairs and the fifth word.
    """
    m = lambda k: F.greatest(F.size("_q_hashes") - k, F.lit(0))
    both = lambda a, i, b, j, k: F.zip_with(F.slice(a, F.lit(i), m(k)), F.slice(b, F.lit(j), m(k)), lambda x, y: F.xxhash64(x, y))
    d = d.withColumn("_q_pairs", both("_q_hashes", 1, "_q_hashes", 2, 1))
    d = d.withColumn("_q_fours", both("_q_pairs", 1, "_q_pairs", 3, 3)).drop("_q_pairs")
    d = d.withColumn("_q_windows", both("_q_fours", 1, "_q_hashes", 5, 4)).drop("_q_fours")
    again = F.size(F.array_distinct("_q_windows")) < F.size("_q_windows")
    d = d.withColumn("_q_sorted", F.when(again, F.sort_array(F.transform("_q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s, m = F.col("_q_sorted"), F.size("_q_sorted")
    twin = lambda x, j: F.get(s, j - 1)["h"].eqNullSafe(x["h"]) | F.get(s, j + 1)["h"].eqNullSafe(x["h"])
    at = F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))
    d = d.withColumn("_q_at", F.when(m > 0, at))
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    step = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last"))
    return d.withColumn("_q_repeat", F.coalesce(F.aggregate("_q_at", start, step, lambda acc: acc["n"]), F.lit(0)).cast("long"))


def judge(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS, order: int = ORDER, min_score: float = MIN_SCORE, table_rows: int = TABLE_ROWS) -> DataFrame:
    """All columns of ``docs``, then ``quality``: a struct of n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, score and kept.

    Null and empty texts have no words and fail the base rules. A document without n-grams has score 0. Repeated rows
    get equal verdicts. An empty table gives an empty result. Columns may have any names but those that start with
    _q_, and an existing column called ``quality`` is replaced. With at most ``buckets`` distinct n-grams each row is judged
    in place; with more, and always with ``EACH``, scores are computed for each distinct text and joined to the rows by its digest.
    """
    counts = gram_counts(docs, trusted, key, text, order)
    n_counts, raw, good = counts.agg(F.count("*"), F.coalesce(F.sum("raw"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    hashed = buckets != EACH and n_counts <= buckets
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("_q_lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD)))
    d = d.withColumn("_q_dup_lines", (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long")).drop("_q_lines")
    d = d.withColumn("_q_chars", F.length(F.translate(t, SPACES, "")).cast("long"))
    d = d.withColumn("_q_symbols", (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"))
    d = d.withColumn("_q_words", words(F.col(text)))
    if hashed:
        model = as_literal(log_ratios(counts, raw, good, buckets), buckets)
        gain = lambda acc, g: acc + F.element_at(model, bucket_of(g, buckets) + 1)
        n_grams = F.size("_q_words") - (order - 1)
        d = d.withColumn("_q_score", F.when(n_grams > 0, F.aggregate(grams(F.col("_q_words"), order), F.lit(0.0), gain) / n_grams).otherwise(F.lit(0.0)))
    d = repeated_words(d.withColumn("_q_hashes", F.transform("_q_words", lambda w: F.xxhash64(w))).drop("_q_words"))
    d = d.withColumn("_q_n", F.size("_q_hashes")).drop("_q_hashes", "_q_windows", "_q_sorted", "_q_at")
    n = F.col("_q_n")
    failed = (n < 10) | (100 * F.col("_q_repeat") > 20 * n)
    d = d.withColumn("_q_failed", failed)
    if not hashed:  # joined last: a text that isn't asked for is not shuffled
        means = mean_weights(docs, gram_weights(counts, raw, good), n_counts, text, order, table_rows)
        d = d.withColumn("_q_key", digest(text)).join(means, F.col("_q_key") == F.col("_q_digest"), "left").withColumn("_q_score", F.coalesce("_q_mean", F.lit(0.0)))
    fields = {
        "n_words": n.cast("long"),
        "word_chars": F.col("_q_chars"),
        "n_symbols": F.col("_q_symbols"),
        "n_dup_lines": F.col("_q_dup_lines"),
        "n_repeat_words": F.col("_q_repeat"),
        "base_failed": F.col("_q_failed"),
        "score": F.col("_q_score"),
        "kept": ~F.col("_q_failed") & (F.col("_q_score") >= min_score),
    }
    # The fence is always true, but not deterministic to the optimiser: a filter on ``kept`` would otherwise be pushed
    # down through all projections, with every array computed anew for each of its uses.
    fence = F.monotonically_increasing_id() >= 0
    fields["kept"] = fields["kept"] & fence
    d = d.withColumn("quality", F.struct(*[c.alias(k) for k, c in fields.items()]))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns if c != "quality"], "quality")
