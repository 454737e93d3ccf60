"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades, and ordered thresholds cut its score:
P(grade <= j) = 1 / (1 + exp(score - threshold_j)). A document gets its expected grade and the probability of the
top grade, on which it is selected. Features are the distinct words of a text, plain and in lower
case, and coarse bins of its length, repetition, symbols and capitals.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import batches, map_arrow, mix, NOT_WORD, text_bytes, word_hashes

#: Features are hashed to this many bits: the model is 2^BITS numbers whatever the corpus.
BITS = 18
#: Labelled documents that are fitted at most: those whose ids have the smallest hashes.
SAMPLE = 15_000
#: A feature is fitted if so many documents of the sample have it, and their mean grade is this many standard errors
#: from the sample's: among many thousand words, the others would only fit noise.
LEAST_DOCS, LEAST_Z = 5, 3.0
#: Steps of the fit, its first step size and its penalty on weights.
STEPS, RATE, PENALTY = 300, 0.1, 3e-4
#: Probability of the top grade from which a document is kept.
MIN_TOP = 0.5
SYMBOL = np.array([chr(b) in "#*$%&|<>!" for b in range(256)])
UPPER = np.array([65 <= b <= 90 for b in range(256)])


def bins(raw: np.ndarray, offs: np.ndarray, n: np.ndarray, distinct: np.ndarray) -> list[np.ndarray]:
    """Coarse shares of each text: words (binary logarithm), distinct words, symbols and capitals by the byte."""
    total = np.maximum(1, np.diff(offs))

    def share(of: np.ndarray) -> np.ndarray:
        seen = np.append(0, np.cumsum(of[raw]))
        return (seen[offs[1:]] - seen[offs[:-1]]) / total

    return [
        np.log2(n + 1).astype(np.int64),
        np.floor(10 * distinct / np.maximum(1, n)).astype(np.int64),
        np.minimum(20, 100 * share(SYMBOL)).astype(np.int64),
        np.minimum(20, 40 * share(UPPER)).astype(np.int64),
    ]


def features(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of many texts in one array, and n + 1 offsets."""
    n = len(offs) - 1
    h, at = word_hashes(raw, offs, True, NOT_WORD)
    doc = np.repeat(np.arange(n), np.diff(at))
    key = np.unique(doc.astype(np.uint64) << np.uint64(BITS) | h >> np.uint64(64 - BITS))
    owner, number = [(key >> np.uint64(BITS)).astype(np.int64)], [(key & np.uint64((1 << BITS) - 1)).astype(np.int64)]
    for k, b in enumerate(bins(raw, offs, np.diff(at), np.bincount(owner[0], minlength=n))):
        owner.append(np.arange(n))
        number.append((mix((b + 1000 * (k + 7)).astype(np.uint64)) >> np.uint64(64 - BITS)).astype(np.int64))
    owner, number = np.concatenate(owner), np.concatenate(number)
    order = np.argsort(owner, kind="stable")
    return number[order], np.append(0, np.cumsum(np.bincount(owner, minlength=n)))


@dataclass
class Model:
    """Weights of all features, ordered thresholds between grades, and the grades."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > j) for each text and threshold j."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -50, 50)))

    def score(self, number: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Sum of each text's weights, in the order of its own features: equal texts score equally in any batch."""
        return np.bincount(np.repeat(np.arange(len(at) - 1), np.diff(at)), self.weights[number], len(at) - 1)

    def expected(self, tails: np.ndarray) -> np.ndarray:
        return self.grades[0] + tails @ np.diff(self.grades)


def fit_arrays(number: np.ndarray, at: np.ndarray, grade: np.ndarray) -> Model:
    """Maximum likelihood with a penalty on weights, by full-batch steps with adapted sizes. Deterministic."""
    grades = np.unique(grade).astype(float)
    weights = np.zeros(1 << BITS)
    if len(grades) < 2:  # nothing to tell apart: every document is of the one grade
        return Model(weights, np.zeros(0), grades if len(grades) else np.zeros(1))
    y = np.searchsorted(grades, grade)
    docs = np.bincount(number, minlength=1 << BITS)
    sums = np.bincount(number, np.repeat(y - y.mean(), np.diff(at)), 1 << BITS)
    z = sums / np.sqrt(np.maximum(1, docs) * y.var())
    live = ((docs >= LEAST_DOCS) & (np.abs(z) >= LEAST_Z))[number]
    lens = np.diff(np.append(0, np.cumsum(live))[at])
    number = number[live]
    at = np.append(0, np.cumsum(lens))
    names, place = np.unique(number, return_inverse=True)
    n, j = len(y), len(grades) - 1
    share = np.cumsum(np.bincount(y, minlength=j + 1))[:-1] / n
    gaps = np.log(share / (1 - share))
    gaps[1:] = np.log(np.maximum(1e-3, np.diff(gaps)))  # thresholds stay ordered: each is the last plus exp(gap)
    theta = np.concatenate([np.zeros(len(names)), gaps])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(n)
    for step in range(1, STEPS + 1):
        w, g = theta[: len(names)], theta[len(names) :]
        cut = np.cumsum(np.append(g[0], np.exp(g[1:])))
        sums = np.append(0.0, np.cumsum(w[place]))
        s = sums[at[1:]] - sums[at[:-1]]
        below = 1 / (1 + np.exp(np.clip(s[:, None] - cut[None, :], -50, 50)))  # P(y <= j)
        edge = np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))])
        slope = edge * (1 - edge)
        p = np.maximum(1e-12, edge[rows, y + 1] - edge[rows, y])
        ds = (slope[rows, y + 1] - slope[rows, y]) / p  # of the negative log likelihood by the score
        dcut = np.array([-(slope[y == k, k + 1] / p[y == k]).sum() + (slope[y == k + 1, k + 1] / p[y == k + 1]).sum() for k in range(j)])
        dg = np.append(dcut.sum(), [np.exp(g[k]) * dcut[k:].sum() for k in range(1, j)])
        grad = np.concatenate([np.bincount(place, np.repeat(ds, lens), len(names)) / n + PENALTY * w, dg / n])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - RATE / (1 + step / 40) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights[names] = theta[: len(names)]
    g = theta[len(names) :]
    return Model(weights, np.cumsum(np.append(g[0], np.exp(g[1:]))), grades)


def fit(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "grade", sample: int = SAMPLE) -> Model:
    """Fits a model on at most ``sample`` rated documents: those whose ids have the smallest hashes.

    ``ratings`` has columns ``key`` and ``grade`` (whole numbers); null keys and grades are left out, and of several
    grades of a key the least counts. Without ratings every document has the top grade, of which there is one.
    What comes to the driver is the features of the sample, about a hundred numbers to a few thousand for each document.
    """
    ids = ratings.where(F.col(key).isNotNull() & F.col(grade).isNotNull()).groupBy(F.col(key).alias("r_id")).agg(F.min(grade).cast("double").alias("r_grade"))
    ids = F.broadcast(ids.orderBy(F.xxhash64("r_id"), "r_id").limit(sample))  # bounded by ``sample``
    d = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(ids, F.col("k") == F.col("r_id")).select(F.col("k").cast("long").alias("k"), "r_grade", "t")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "t"):
            number, at = features(*text_bytes(b.column("t")))
            yield pa.RecordBatch.from_arrays([b.column("k"), b.column("r_grade"), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(number.astype(np.int32)))], names=["k", "grade", "x"])

    got = d.mapInArrow(run, "k long, grade double, x array<int>").toArrow().combine_chunks()
    if not got.num_rows:
        return fit_arrays(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0))
    got = got.sort_by([("k", "ascending"), ("grade", "ascending")])
    x = got["x"].combine_chunks()
    lens = np.diff(x.offsets.to_numpy())
    return fit_arrays(x.flatten().to_numpy().astype(np.int64), np.append(0, np.cumsum(lens)), got["grade"].to_numpy())


def judge(docs: DataFrame, model: Model, text: str = "text", min_top: float = MIN_TOP, name: str = "rating") -> DataFrame:
    """``docs`` with a struct ``rating``: expected_grade, top_probability and kept.

    Null and empty texts are rated by their (empty) features. Every row, repeated or not, gives a row; an empty table an
    empty result; an existing column of that name is replaced, others are kept. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != name]
    kind = T.StructType([T.StructField("expected_grade", T.DoubleType()), T.StructField("top_probability", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(name, kind)])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, text):
            m = shared.value
            tails = m.tails(m.score(*features(*text_bytes(b.column(text)))))
            top = tails[:, -1] if tails.shape[1] else np.ones(len(tails))
            rating = pa.StructArray.from_arrays([pa.array(m.expected(tails)), pa.array(top), pa.array(top >= min_top)], names=[f.name for f in kind])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), rating], names=[*kept, name])

    return map_arrow(docs, run, schema)
