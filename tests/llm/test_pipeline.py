"""The pipeline's stages, each on what the one before kept."""

import hashlib
from collections import Counter, defaultdict

import corpus_pipeline
from sparkloom.llm import quality_model, quality_rules, queries
from sparkloom.llm.common import written

from .test_operators import PROSE, brute_components, words


def test_stages(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, sf_dir), "stage")
        seen[name] = (docs, out)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    before, after = seen["quality classifier"]
    model = quality_model.fit(before, queries.ratings(spark, sf_dir))
    assert after.count() == quality_model.judge(before, model).where("rating.kept").count() > 0
    before, after = seen["quality rules"]
    assert after.count() == quality_rules.judge(before, queries.trusted_labels(spark, sf_dir)).where("quality.kept").count() > 0
    before, after = seen["n-gram Jaccard join"]
    want = {k for k, _, c in brute_components([(r.doc_id, r.text) for r in before.collect()]) if k == c}
    assert {r.doc_id for r in after.collect()} == want
    before, after = seen["mixing sources to target weights"]
    times = {r.doc_id: r["count"] for r in after.groupBy("doc_id").count().collect()}
    assert max(times.values()) <= 3
    total = sum(len(words(r.text)) for r in before.collect())
    assert abs(sum(len(words(r.text)) for r in after.collect()) - total) < 0.2 * total
    before, after = seen["BPE encoding and decoding"]
    assert after.count() == before.count() and after.where("size(ids) <> n_tokens").isEmpty()


def test_empty(spark, sf_dir):
    docs = queries.table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
        assert docs.isEmpty()


def test_near_copies_of_any_id(spark):
    """Repeated rows, texts that share an id and null ids: one row of each group, against brute force."""
    far, other = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    near = " ".join(f"c{i}" for i in range(60))
    rows = [(1, PROSE), (1, PROSE), (None, PROSE), (2, far), (2, other), (None, "quite alone here"), (None, None), (3, far), (None, near), (None, near + " x"), (4, None), (5, "z"), (5, "z")]
    groups = defaultdict(list)
    for k, _, c in brute_components(list(enumerate(t for _, t in rows))):
        groups[c].append(rows[k])
    want = Counter(min(g, key=lambda r: (r[0] is None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())) for g in groups.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert Counter(map(tuple, corpus_pipeline.drop_near_copies(spark, docs, "").collect())) == want


def test_mixed_copies_of_any_id(spark):
    """Copies of each row with repeated and null ids: a small source comes in three epochs, a large one is cut at its budget."""
    few = [(1, "u v", "a"), (1, "u v", "a"), (None, "w x y", "a"), (2, "p", "a"), (2, "q r", "a")]
    many = [(k, " ".join(f"t{i}" for i in range(i % 7 + 1)), "b") for i in range(200) for k in (None if i % 3 == 0 else i // 4,)]
    docs = spark.createDataFrame([*few, *many, (None, None, "a"), (7, "", "b")], "doc_id long, text string, source string").repartition(3)
    out = list(map(tuple, corpus_pipeline.mix_sources(spark, docs, "").collect()))
    assert Counter(r for r in out if r[2] == "a") == Counter(few * 3)
    place = lambda r: (hashlib.md5(f"{'' if r[0] is None else r[0]}|{r[1]}".encode()).hexdigest()[:15], r[0] is not None, r[0] or 0)
    size = {s: sum(len(words(r[1])) for r in rows) for s, rows in (("a", few), ("b", many))}
    budget, want = size["b"] - 2 * size["a"], Counter()
    for r in sorted(many, key=place):
        if budget > 0:
            want[r] += 1
        budget -= len(words(r[1]))
    assert Counter(r for r in out if r[2] == "b") == want
