"""The operators against brute force, the tokenizers library and exact round trips, on small and odd tables."""

import hashlib
import itertools
import json
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from tokenizers import Tokenizer

from sparkloom.llm import bpe, chat, codes, common, fingerprint, mixing, ngram_join, quality_model, quality_rules, queries, url_rules, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = tokenizer_path("word_bpe_49k.json")
PROSE = "the quick brown fox jumps over the lazy dog and runs far away from all of the other animals in that old wood"
#: Null, empty and blank texts, equal rows, ties, accents, special tokens, a word and a text that are very long.
TEXTS = [
    None, "", " \n\t", PROSE, PROSE, PROSE.upper(), PROSE + " x", "one two", "One TWO", "Ein Straßenfest, ΟΔΟΣ und Überfluß 1234 o'clock!", "a" * 9000,
    "<|endoftext|> hi <s> </s> <unk>", "e\u0301 \u00a0x\u2003y\u0085z \U0001f600\U0001f600", "### $$$ ||| <<>> %%", "it's we've\nit's we've\n\nit's we've", PROSE.replace("fox", "cat"),
    (PROSE + " ") * 60, "l\rm\x0bn\x0co", " ".join(f"w{i % 977} W{i % 31}" for i in range(20_000)), "".join(chr(97 + i * i % 26) for i in range(30_000)),
]
EXTRA = "doc_id long, text string, source string, ids string, k long, t string, node long, quality string, size int, `odd.name` int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, [None, "a", "b", "Z"][i % 4], "x", 1, "y", 2, "q", 3, 4) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[3], (None, PROSE, "a", "x", 1, "y", 2, "q", 3, 4)], EXTRA).repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def words(t):
    return WORD.findall(t or "")


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_bpe(docs, empty):
    tok = Tokenizer.from_file(VOCAB)
    tok.no_padding(), tok.no_truncation()
    want = []
    for k, t in texts(docs):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        want.append((k, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tok.decode(ids, skip_special_tokens=False).encode())))
    assert sorted(map(tuple, bpe.round_trip(docs, VOCAB).collect()), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip(empty, VOCAB).collect() == []
    got = bpe.decode(bpe.encode(docs, VOCAB), VOCAB)
    assert sorted(sha(r.decoded.encode()) for r in got.collect()) == sorted(w[3] for w in want)
    assert set(docs.columns) <= set(got.columns)


def test_bpe_refuses_other_files():
    spec = json.loads(open(VOCAB, encoding="utf-8").read())
    for change in ({"decoder": {"type": "BPEDecoder"}}, {"normalizer": {"type": "NFKC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": spec["model"] | {"byte_fallback": True}}):
        with pytest.raises(ValueError, match="tokenizer file"):
            bpe.Vocabulary(json.dumps(spec | change))


@pytest.mark.parametrize(("letters", "n"), [("a", 2048), ("ab", 5000), ("abcdefghijklmnopqrstuvwxyz", 20_000), ("aabb\u00e9\u00fc", 4000), ("#$%&", 3000)])
def test_bpe_long_pieces(letters, n):
    """Pieces of one word, whose rounds go over blocks, against the library."""
    word = "".join(np.random.default_rng(n).choice(list(letters), n))
    tok = Tokenizer.from_file(VOCAB)
    with open(VOCAB, encoding="utf-8") as f:
        assert bpe.vocabulary(f.read()).chunks([word.encode()])[0].tolist() == tok.encode(word, add_special_tokens=False).ids


def test_codes(docs, empty):
    tok = Tokenizer.from_file(VOCAB)
    at, want = 0, []
    every = []
    for k, t in sorted(texts(docs), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest())):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((k, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
        every += ids
    blocks = codes.write(docs, VOCAB)
    assert sorted(map(tuple, codes.read(blocks).collect()), key=lambda r: r[1]) == want
    # Single tokens, at both ends of every block and shard among them
    ends = {r.s + r["first"] + d for r in blocks.join(codes.starts(blocks), "shard").selectExpr("shard_start AS s", "first").collect() for d in (-1, 0, 1)}
    places = [None, -1, len(every), 5, 5, len(every) - 1, *range(0, len(every), 997), *ends]
    asked = docs.sparkSession.createDataFrame([(p, "x") for p in places], "position long, payload string")
    assert Counter(map(tuple, codes.tokens_at(blocks, asked).collect())) == Counter((p, every[p]) for p in places if p is not None and 0 <= p < len(every))
    assert codes.read(codes.write(empty, VOCAB)).collect() == []


def test_codes_random_access():
    ids = np.random.default_rng(5).integers(0, 2**32 - 1, 3000, dtype=np.uint32)
    ids[::3] %= 700
    block = codes.Block(codes.encode_block(ids))
    assert block.all().tolist() == ids.tolist()
    assert [block[i] for i in (0, 1, 511, 512, 513, 2999)] == [int(ids[i]) for i in (0, 1, 511, 512, 513, 2999)]


def brute_warc(rows):
    """(page_id, bytes, digest, type, owner) of (page_id, html) rows, sorted."""
    largest = {}
    for k, h in rows:
        if k is not None:
            largest[h or ""] = max(k, largest.get(h or "", k))
    out = []
    for k, h in rows:
        b = (h or "").encode()
        revisit = len(b) >= 1000 and k != largest.get(h or "")
        out.append((k, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", largest[h] if revisit else None))
    return sorted(out, key=repr)


def test_warc(spark):
    big = "<p>" + "äx" * 600
    rows = [(i, f"http://h/{i}\nx\r%0A", h) for i, h in enumerate([None, "", big, big, "small", "small", big + "y", big * 2000])] + [(None, None, big), (3, "http://h/3\nx\r%0A", big)]
    pages = spark.createDataFrame([(*r, "clash", 1, b"x") for r in rows], "page_id long, url string, html string, digest string, payload_bytes int, packed binary")
    got = warc.read(warc.records(*warc.write(pages))).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == brute_warc([(k, h) for k, _, h in rows])
    assert Counter((r.page_id, r.url) for r in got) == Counter((k, u or "") for k, u, _ in rows)
    assert warc.read(warc.records(*warc.write(pages.limit(0)))).collect() == []


def naive_signature(t):
    """Order MinHash by the letter: number the k-mers, take the least of each order, hash them in text order."""
    m = 2**64 - 1

    def scramble(x):
        x ^= x >> 30
        x = x * 0xBF58476D1CE4E5B9 & m
        x ^= x >> 27
        x = x * 0x94D049BB133111EB & m
        return x ^ x >> 31

    points, k = [ord(c) + 1 for c in t], min(fingerprint.K, len(t))
    hashes, seen, numbered = [], Counter(), []
    for i in range(len(t) - k + 1 if t else 0):
        h = 0
        for p in points[i : i + k]:
            h = (h * int(common.BASE) + p) & m
        hashes.append(scramble((h + k) & m))
        n = seen[hashes[-1]]
        seen[hashes[-1]] += 1
        numbered.append(scramble((hashes[-1] + n * 0xD1B54A32D192ED03) & m) if n else hashes[-1])
    out = []
    for order in map(int, fingerprint.ORDERS):
        least = sorted(sorted(range(len(numbered)), key=lambda i: numbered[i] * order & m)[: fingerprint.L])
        e = 0
        for i in least:
            e = scramble((e * 0x9E3779B97F4A7C15 + hashes[i]) & m)
        out.append(e >> 64 - 4 * fingerprint.DIGITS)
    return out


def brute_fingerprints(rows):
    """All columns of op3 for (doc_id, text) rows, by the naive signature; sorted."""
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.md5(r[1].encode()).hexdigest()))
    hexed = lambda s: "".join(f"{e:0{fingerprint.DIGITS}x}" for e in s)
    like = lambda a, b: sum(x == y for x, y in zip(a, b, strict=True)) / fingerprint.M
    sigs = {t: naive_signature(t) for _, t in rows}
    out = []
    for i, (k, t) in enumerate(rows):
        n = rows[(i + 1) % len(rows)][1]
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        e = sigs.get(edited) or naive_signature(edited)
        out.append((k, len(t), sha(edited.encode()), hexed(sigs[t]), hexed(e), like(sigs[t], e), like(sigs[t], sigs[n])))
    return sorted(out, key=repr)


def test_fingerprint(docs, empty):
    few = docs.where("text IS NULL OR length(text) < 3000")
    for d in (few, few.repartition(1), few.where("doc_id = 5").limit(1)):
        assert sorted(map(tuple, fingerprint.with_next(d).collect()), key=repr) == brute_fingerprints(texts(d))
    out = fingerprint.with_next(docs)
    assert out.count() == docs.count()
    again = out.select("near_next", fingerprint.likeness(fingerprint.F.col("fingerprint"), fingerprint.F.col("edited_fingerprint")).alias("l"), "near_edited").collect()
    assert all(r.l == r.near_edited and 0 <= r.near_next <= 1 for r in again)
    by_text = {}
    for r in fingerprint.with_fingerprint(docs).collect():
        assert by_text.setdefault(r.text or "", r.fingerprint) == r.fingerprint
    assert fingerprint.with_next(empty).collect() == []


def test_fingerprint_orders():
    a = fingerprint.signature(PROSE)
    near, moved = fingerprint.signature(PROSE.replace("lazy", "lady")), fingerprint.signature(PROSE[55:] + PROSE[:55])
    far = fingerprint.signature("wholly different words, with nothing that the other text has in it at all, and longer than it too")
    like = lambda b: float((a == b).mean())
    assert like(near) > like(far) and like(moved) < 1 and like(far) < 0.1


def shingles(t):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(t)]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * len(sets[i] | sets[j]) and group[i] != group[j]:
            old = group[j]
            group = [group[i] if g == old else g for g in group]
    least = {}
    for (k, _), g in zip(rows, group, strict=True):
        if k is not None:
            least[g] = min(k, least.get(g, k))
    return sorted(((k, len(s), least.get(g)) for (k, _), s, g in zip(rows, sets, group, strict=True)), key=repr)


def test_ngram_join_bound(spark):
    """Pairs of a group whose tokens are mostly frequent: those that link may meet, those with few shared tokens may not."""
    rng = np.random.default_rng(7)
    tokens = rng.integers(-(2**62), 2**62, 400).tolist()
    df = {t: 5000 if i % 10 else 7 for i, t in enumerate(tokens)}
    sets = {}
    for k in range(40):
        lost = rng.choice(60, int(rng.integers(0, 50)), replace=False).tolist()
        sets[k] = {t for i, t in enumerate(tokens[:60]) if i not in lost} | set(rng.choice(tokens[60:], len(lost), replace=False).tolist())
    rows = [(k, len(x) + 1, [(df[t], t) for t in sorted(x)]) for k, x in sets.items()]  # and a token that no other has
    nodes = spark.createDataFrame(rows, "node long, n long, tokens array<struct<df: long, token: long>>")
    c = ngram_join.combinations(nodes).drop("combo").dropDuplicates(["node"])
    other = c.toDF(*[f"p_{x}" for x in c.columns])
    both = c.join(other, c.node < other.p_node)
    may = ngram_join.plausible({x: both[x] for x in c.columns}, {x: both[f"p_{x}"] for x in c.columns})
    got = {(r.node, r.p_node): r.may for r in both.select("node", "p_node", may.alias("may")).collect()}
    assert len(got) == 40 * 39 // 2
    linked = {(a, b) for a, b in got if 100 * len(sets[a] & sets[b]) >= 75 * (len(sets[a] | sets[b]) + 2)}
    far = {(a, b) for a, b in got if len(sets[a] & sets[b]) < 25}
    assert linked and all(got[x] for x in linked)
    assert far and not any(got[x] for x in far)


def test_ngram_join(docs, empty):
    got = sorted((tuple(r) for r in ngram_join.join(docs).collect()), key=repr)
    assert got == brute_components(texts(docs))
    assert ngram_join.join(empty).collect() == []


def test_ngram_join_near_the_bound(spark):
    """Texts at and around the threshold, chains of copies, and one passage that most documents share."""
    rng, rows = np.random.default_rng(3), []
    for g in range(12):
        base = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(5, 90)))]
        for _ in range(9):
            w = list(base)
            for _ in range(int(rng.integers(0, 4))):
                w[int(rng.integers(0, len(w)))] = f"z{rng.integers(0, 5)}"
            if rng.random() < 0.5:
                w += PROSE.split()
            rows.append((len(rows) * 7 % 1009, " ".join(w)))
            base = w if rng.random() < 0.3 else base
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_components(rows)


def test_ngram_join_of_hot_keys(spark, monkeypatch):
    """With every key called hot and small chunks, groups are the same: copies, near copies and a passage in most texts."""
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    monkeypatch.setattr(common, "HOT_KEYS", 20)
    monkeypatch.setattr(ngram_join, "CHUNK", 3)
    rng, rows = np.random.default_rng(8), []
    for g in range(6):
        base = [f"w{x}" for x in rng.integers(0, 90, 40)]
        for i in range(25):
            w = list(base)
            if i % 3:
                w[int(rng.integers(0, 40))] = f"z{i % 7}"
            rows.append((len(rows), " ".join(w + PROSE.split() * (i % 2))))
    got = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute_components(rows)


def brute_mix(rows):
    """(doc_id, size, source_size, target, taken) of (doc_id, source, text) rows, sorted; targets by cutting at the caps in turn."""
    size, docs = Counter(), defaultdict(list)
    for k, s, t in rows:
        n = len(words(t))
        size[s] += n
        rnd = int(hashlib.md5(f"{'' if k is None else k}|{t or ''}".encode()).hexdigest()[:15], 16)
        docs[s].append((rnd, k is not None, k or 0, n, k))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, target, free, total = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, {}, set(order), sum(size.values())
    left = total
    while True:
        share = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] >= 3 * size[s] * share}
        if not over:
            break
        target |= {s: 3.0 * size[s] for s in over}
        left, free = total - sum(3 * size[s] for s in target), free - over
    target |= {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
    out = []
    for s, mine in docs.items():
        budget, before = math.floor(target[s] + 0.5), 0
        epochs = budget // size[s] if size[s] else 0
        for *_, n, k in sorted(mine, key=lambda r: r[:4]):
            out.append((k, n, size[s], round(target[s], 6), epochs * n + max(0, min(n, budget - epochs * size[s] - before))))
            before += n
    return sorted(out, key=repr)


def test_mixing(spark, docs, empty, data, sf_dir):
    tidy = lambda out: sorted(((k, n, s, round(t, 6), x) for k, n, s, t, x in out), key=repr)
    out = mixing.mix(docs).collect()
    assert tidy(out) == brute_mix([(r.doc_id, r.source, r.text) for r in docs.collect()])
    assert all(0 <= r.taken <= 3 * r.size for r in out)
    assert sorted(map(repr, mixing.mix(docs).collect())) == sorted(map(repr, out))
    assert mixing.mix(empty).collect() == []
    assert tidy(queries.op5_mixing(spark, sf_dir).collect()) == brute_mix([(r["doc_id"], r["source"], r["text"]) for r in data.documents])


def test_mixing_in_small_ranges(docs, monkeypatch):
    want = sorted(map(repr, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "RANGE_ROWS", 1)
    monkeypatch.setattr(mixing, "BLOCK_RANGES", 2)
    assert sorted(map(repr, mixing.mix(docs).collect())) == want


def test_quality_model(spark, docs, empty):
    sf_dir = "/root/testdata/sf0.01"  # the smallest tables have too few labels to hold some out
    d, r = queries.table(spark, sf_dir, "documents"), queries.ratings(spark, sf_dir)
    train, held = r.where("doc_id % 3 > 0"), r.where("doc_id % 3 = 0")
    model = quality_model.fit(d, train)
    assert (np.diff(model.thresholds) > 0).all()
    got = quality_model.judge(d, model).join(held, "doc_id").select("grade", "rating.kept").collect()
    assert np.mean([x.kept == (x.grade == 2) for x in got]) > 0.9
    out = quality_model.judge(docs, model)
    assert out.count() == docs.count() and out.columns == [*docs.columns, "rating"]
    assert quality_model.judge(empty, model).collect() == []
    nothing = quality_model.fit(empty, train.limit(0))
    assert all(x.rating.kept for x in quality_model.judge(docs, nothing).collect())


def test_quality_model_likelihood():
    """The fitted point is where the penalised likelihood, written out for each document, has no slope; tails are ordered."""
    rng = np.random.default_rng(2)
    grade = rng.integers(0, 3, 240)
    number = np.concatenate([np.array([(g if rng.random() < 0.6 else int(rng.integers(0, 3))) * 40 + x for x in rng.choice(30, 12, False)] + [200 + int(x) for x in rng.choice(9, 4, False)]) for g in grade])
    at = np.arange(0, len(number) + 1, 16)
    model = quality_model.fit_arrays(number, at, grade)

    def loss(weights, cuts):
        total = 0.0
        for i, g in enumerate(grade):
            score = sum(weights[j] for j in number[at[i] : at[i + 1]])
            below = [0.0, *(1 / (1 + math.exp(score - c)) for c in cuts), 1.0]
            total -= math.log(max(1e-12, below[g + 1] - below[g]))
        return total / len(grade) + quality_model.PENALTY / 2 * float((weights**2).sum())

    best = loss(model.weights, model.thresholds)
    for j in np.flatnonzero(model.weights)[::7]:
        for step in (-0.05, 0.05):
            moved = model.weights.copy()
            moved[j] += step
            assert loss(moved, model.thresholds) > best - 3e-4
    for step in (-0.1, 0.1):
        assert loss(model.weights, model.thresholds + step) > best - 3e-4
    tails = model.tails(model.score(number, at))
    assert (np.diff(model.thresholds) > 0).all() and (np.diff(tails, axis=1) <= 0).all()
    for i in range(5):
        score = sum(model.weights[j] for j in number[at[i] : at[i + 1]])
        want = [1 / (1 + math.exp(c - score)) for c in model.thresholds]
        assert tails[i] == pytest.approx(want) and model.expected(tails)[i] == pytest.approx(sum(want))


def test_quality_model_scores_equal_texts_equally(spark, docs):
    model = quality_model.fit(docs, docs.where("doc_id IS NOT NULL").selectExpr("doc_id", "doc_id % 3 AS grade"))
    by_text = defaultdict(set)
    for n in (1, 2, 7):
        for r in quality_model.judge(docs.repartition(n), model).collect():
            by_text[r.text].add(tuple(r.rating))
    assert all(len(x) == 1 for x in by_text.values())


def brute_base(t):
    t = t or ""
    w = words(t)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice = {x for x, n in Counter(windows).items() if n > 1}
    hit = {i + j for i, x in enumerate(windows) if x in twice for j in range(5)}
    lines = [x for x in t.split("\n") if words(x)]
    fail = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), fail


def test_quality_rules(spark, docs, empty, sf_dir):
    for d, trusted in ((docs, docs.select("doc_id").limit(3)), (queries.table(spark, sf_dir, "documents"), queries.trusted_labels(spark, sf_dir)), (docs, docs.select("doc_id").limit(0))):
        out = quality_rules.judge(d, trusted).collect()
        for r in out:
            assert tuple(r.quality)[:6] == brute_base(r.text), r.doc_id
            assert not (r.quality.base_failed and r.quality.kept)
        assert len(out) == d.count()
    assert quality_rules.judge(empty, docs.select("doc_id")).collect() == []


def test_quality_rules_scores(docs):
    """Scores against counts of the same hashed words."""
    trusted, n = docs.where("doc_id IN (3, 9)").select("doc_id"), quality_rules.BUCKETS
    good, raw = np.zeros(n), np.zeros(n)
    hashes = {w: h for w, h in docs.sparkSession.createDataFrame([(w,) for w in {w for _, t in texts(docs) for w in words(t)}], "w string").select("w", quality_rules.bucket_of(quality_rules.F.col("w"), n)).collect()}
    ids = {3, 9}
    for k, t in texts(docs):
        for w in words(t):
            raw[hashes[w]] += 1
            good[hashes[w]] += k in ids
    ratio = np.log((good + 1) / (good.sum() + n)) - np.log((raw + 1) / (raw.sum() + n))
    for r in quality_rules.judge(docs, trusted).collect():
        w = words(r.text)
        assert r.quality.score == pytest.approx(np.mean([ratio[hashes[x]] for x in w]) if w else 0, abs=1e-4)


@pytest.mark.parametrize("order", [1, 2])
def test_quality_rules_grow(spark, sf_dir, order):
    """With more distinct n-grams than buckets each has its own count, whichever of them are broadcast."""
    d = queries.table(spark, sf_dir, "documents").where("doc_id % 2 = 0")
    d = d.union(d.limit(3)).union(d.limit(2).withColumn("text", quality_rules.F.lit(None).cast("string")))
    trusted = queries.trusted_labels(spark, sf_dir)
    ids = {r.doc_id for r in trusted.collect()}
    grams_of = lambda t: [" ".join(x) for x in zip(*(words(t)[k:] for k in range(order)), strict=False)]
    good, raw = Counter(), Counter()
    for r in d.collect():
        raw.update(grams_of(r.text))
        if r.doc_id in ids:
            good.update(grams_of(r.text))
    share = sum(good.values()) / sum(raw.values())
    assert share > 0 and len(raw) > 1000
    for table_rows in (quality_rules.TABLE_ROWS, 200, 0):
        out = quality_rules.judge(d, trusted, buckets=1000, order=order, table_rows=table_rows).collect()
        assert len(out) == d.count()
        for r in out:
            g = grams_of(r.text)
            want = np.mean([math.log((good[x] + 1) / (raw[x] * share + 1)) for x in g]) if g else 0
            assert r.quality.score == pytest.approx(want, abs=2e-6)
            assert r.quality.kept == (not r.quality.base_failed and r.quality.score >= quality_rules.MIN_SCORE)


def test_quality_rules_of_one_formula(spark, docs, tmp_path):
    """The query and the pipeline score a small corpus as they do a large one: by a count for each n-gram."""
    import corpus_pipeline

    spark.createDataFrame([(3, 1, 0), (9, 1, 0), (11, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, d in (("some", docs), ("none", docs.limit(0))):
        d.select("doc_id", "text").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    raw, good = Counter(), Counter()
    for k, t in texts(docs):
        raw.update(words(t))
        good.update(words(t) if k in {3, 9} else [])
    share = sum(good.values()) / sum(raw.values())
    assert 0 < share and len(raw) < quality_rules.BUCKETS
    score = {(k, t): np.mean([math.log((good[x] + 1) / (raw[x] * share + 1)) for x in words(t)]) if words(t) else 0 for k, t in texts(docs)}
    kept = {k: not brute_base(k[1])[5] and x >= quality_rules.MIN_SCORE for k, x in score.items()}
    got = queries.op8_quality_rules(spark, f"{tmp_path}/some").select("doc_id", "score", "kept").collect()
    by_id = {k: {(round(float(score[k, t]), 5), kept[k, t]) for i, t in score if i == k} for k, _ in score}
    assert len(got) == docs.count() and all((round(r.score, 5), r.kept) in by_id[r.doc_id] for r in got)
    stage = corpus_pipeline.apply_rules(spark, docs.select("doc_id", "text"), f"{tmp_path}/some").collect()
    assert Counter((r.doc_id, r.text) for r in stage) == Counter(x for x in texts(docs) if kept[x])
    assert queries.op8_quality_rules(spark, f"{tmp_path}/none").isEmpty()


def brute_urls(rows):
    """(page_id, host, path, rule, verdict) of (page_id, url) rows, sorted."""
    out = []
    for k, u in rows:
        rest = (u or "").partition("://")[2]
        host, path = re.match(r"[^/?#]*", rest)[0], re.match(r"[^/?#]*([^?#]*)", rest)[1]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if f".{host}".endswith(f".{h}") and path.startswith(p)]
        out.append((k, host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "allow"))
    return sorted(out, key=repr)


def test_url_rules(spark, data, sf_dir):
    got = lambda out: sorted((tuple(r) for r in out.select("page_id", "host", "path", "rule", "verdict").collect()), key=repr)
    assert got(queries.op9_url_rules(spark, sf_dir)) == brute_urls([(r["page_id"], r["url"]) for r in data.pages])
    urls = [None, "", "no scheme", "http://A.Example.COM/en/7x?q", "http://example.com/en/1", "https://x.net/de/8#a", "https://b.example.net/de/81", "http://com/en/", "http://notexample.com", "http://org?/es/", "a://b.org/es/\u00e9", "://com/en/", "http://" + "a." * 3000 + "net/de/" + "x" * 9000] * 2
    rows = [*enumerate(urls), (None, urls[3]), (None, urls[3])]
    pages = spark.createDataFrame([(*r, "h", "r", 1) for r in rows], "page_id long, url string, host string, rule string, copies int")
    rules = url_rules.rule_table(spark, queries.URL_RULES)
    for in_place in (32, 0):
        assert got(url_rules.judge(pages, rules, shapes_in_place=in_place)) == brute_urls(rows)
        assert url_rules.judge(pages.limit(0), rules, shapes_in_place=in_place).collect() == []
    assert url_rules.judge(pages, url_rules.rule_table(spark, []).limit(0)).count() == len(rows)


def test_url_rules_with_clashing_short_digests(spark, monkeypatch):
    """With a short prefix of one digit most rules meet most expressions, and only the full digest tells them apart."""
    monkeypatch.setattr(url_rules, "SHORT", 1)
    rows = [(i, f"http://{h}.example.{d}/{p}/{i}") for i, (h, d, p) in enumerate(itertools.product("ab", ("com", "net", "org"), ("en", "de", "es")))]
    rules = url_rules.rule_table(spark, queries.URL_RULES + [("block", f"h{i}.com", "/x") for i in range(60)])
    plan = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string"), rules)
    assert sorted((tuple(r) for r in plan.drop("url").collect()), key=repr) == brute_urls(rows)


def brute_chat(rows):
    """(conv, turn, kind, order_turn, order_step, linked) of (conv, turn, role, text) rows of queries.as_tool_use, sorted."""
    sides, messages = defaultdict(lambda: ([], [])), []
    for conv, turn, role, _ in sorted(rows, key=lambda r: (r[0], r[1])):
        kind = {"user": "call", "assistant": "result"}.get(role, "text")
        messages.append([conv, turn, kind, turn, int(kind == "result"), None if kind == "text" else False])
        if kind != "text":
            sides[conv, (turn - (kind == "result")) // 2 % 4][kind == "result"].append(messages[-1])
    for calls, results in sides.values():
        for call, result in zip(calls, results, strict=False):
            call[5] = result[5] = True
            result[3] = max(result[3], call[1])
    return sorted(map(tuple, messages), key=repr)


def test_chat_of_all_turns(spark, data, sf_dir):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in data.conversations]
    got = queries.op10_chat(spark, sf_dir).collect()
    assert sorted(((r.conv_id, r.turn, r.kind, r.order_turn, r.order_step, r.linked) for r in got), key=repr) == brute_chat(rows)
    text = {(c, n): t for c, n, _, t in rows}
    for r in got:
        x = json.loads(r.json)
        assert r.json == json.dumps(x, sort_keys=True, ensure_ascii=False, separators=(",", ":"))
        if r.kind == "call":
            args = x["tool_calls"][0]["arguments"]
            assert args == {"limit": r.turn, "query": text[r.conv_id, r.turn]}
            bad = ["$.limit: below minimum"] * (r.turn < 1) + ["$.query: too long"] * (len(args["query"]) > 2000)
            assert sorted(r.call_errors) == sorted(f"{x['tool_calls'][0]['id']}: {b}" for b in bad)
        else:
            assert x["content"] == text[r.conv_id, r.turn]


def test_chat_numbers_reused_identifiers(spark, monkeypatch):
    """The n-th call of an identifier has the n-th result, in whatever block of turns they are."""
    monkeypatch.setattr(chat, "BLOCK_TURNS", 4)
    rng, rows = np.random.default_rng(4), []
    for conv, turn in itertools.product(range(3), range(40)):
        rows.append((conv, turn, str(rng.choice(["user", "assistant", "system"], p=[0.45, 0.45, 0.1])), "x"))
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = chat.format_messages(queries.as_tool_use(d), queries.TOOLS).collect()
    assert sorted(((r.conv_id, r.turn, r.kind, r.order_turn, r.order_step, r.linked) for r in got), key=repr) == brute_chat(rows)


def test_chat(spark):
    call = '{"tool_calls": [{"id": "c1", "name": "search", "arguments": "{\\"query\\": \\"x\\", \\"limit\\": 0}"}]}'
    rows = [
        (1, 1, "user", "hi"), (1, 3, "assistant", call), (1, 2, "tool", '{"tool_call_id": "c1", "content": {"b": 1, "a": 2.0}}'), (1, 4, "tool", '{"tool_call_id": "zz", "content": "?"}'),
        (2, 1, None, None), (2, 1, None, None), (None, None, "user", "{broken"), (2, 5, "assistant", call), (2, 5, "assistant", call), (2, 9, "tool", '{"tool_call_id": "c1", "content": ""}'),
    ]
    m = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, json string, row int")
    got = chat.format_messages(m, queries.TOOLS).collect()
    assert len(got) == len(rows)
    one = sorted((r for r in got if r.conv_id == 1), key=lambda r: (r.order_turn, r.order_step, r.turn))
    assert [(r.turn, r.kind, r.linked) for r in one] == [(1, "text", None), (3, "call", True), (2, "result", True), (4, "result", False)]
    assert one[1].call_errors == ["c1: $.limit: below minimum"]
    assert one[2].json == '{"content":{"a":2,"b":1},"role":"tool","tool_call_id":"c1"}'
    assert sorted(r.linked for r in got if r.conv_id == 2 and r.kind == "call") == [False, True]  # one result for two equal calls
    assert chat.format_messages(m.limit(0), queries.TOOLS).collect() == []


def test_chat_of_odd_json(spark):
    """Lone surrogates, deep nesting, huge numbers and long texts give messages, not errors."""
    deep, nested = '{"a":' * 3000 + "1" + "}" * 3000, '{"tool_calls":[{"id":"d","name":"search","arguments":"' + "[" * 5000 + '"}]}'
    odd = ['{"tool_call_id":"c1","content":"\\ud800"}', '{"tool_call_id":"\\udfff","content":1}', deep, nested, '{"tool_call_id":"n","content":' + "9" * 5000 + "}", "x" * 2_000_000, '{"tool_call_id":"f","content":[NaN,1e999,-0.0]}', '{"tool_calls":[]}', "{}"]
    m = spark.createDataFrame([(1, i, "tool", t) for i, t in enumerate(odd)], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in chat.format_messages(m, queries.TOOLS).collect()}
    assert [got[i].kind for i in range(len(odd))] == ["result", "result", "text", "call", "text", "text", "result", "call", "text"]
    assert json.loads(got[0].json)["content"] == "\ud800" and "\\udfff" in got[1].json
    assert got[3].call_errors == ["d: arguments are no object"] and len(got[5].json) > 2_000_000 and json.loads(got[6].json)["content"] == [None, None, 0]


def test_written_tables_are_dropped(spark, docs):
    before = spark.sql(f"SHOW TABLES IN {common.work_schema(spark)}").count()
    t = common.written(docs, "dropped")
    assert t.count() == docs.count() and t.columns == docs.columns
    common.discard(t, docs)
    assert spark.sql(f"SHOW TABLES IN {common.work_schema(spark)}").count() == before


def test_registered_queries(spark, sf_dir, data):
    """Every query without a test of its own above, over its whole table, against brute force."""
    got = lambda name: sorted(map(tuple, queries.QUERIES[name](spark, sf_dir).collect()), key=repr)
    rows = [(r["doc_id"], r["text"]) for r in data.documents]
    tok, at, coded, encoded = Tokenizer.from_file(VOCAB), 0, [], []
    for k, t in sorted(rows):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        coded.append((k, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(tok.decode(ids, skip_special_tokens=False).encode())))
        encoded.append((k, at, len(ids) + 1, zlib.crc32(np.array([*ids, 1], "<u4").tobytes())))
        at += len(ids) + 1
    assert got("op1_bpe") == sorted(coded, key=repr)
    assert got("op6_token_codes") == sorted(encoded, key=repr)
    assert got("op2_warc") == brute_warc([(r["page_id"], r["html"]) for r in data.pages])
    assert got("op4_ngram_join") == brute_components(rows)
    some = {k for k, t in rows if len(t or "") < 1500}
    assert [r for r in got("op3_order_minhash") if r[0] in some and r[1] < 1500] == [r for r in brute_fingerprints(rows) if r[0] in some]
    out = queries.op7_quality_model(spark, sf_dir).collect()
    model = quality_model.fit(queries.table(spark, sf_dir, "documents"), queries.ratings(spark, sf_dir))
    text = dict(rows)
    for r in out:
        raw = np.frombuffer((text[r.doc_id] or "").encode(), np.uint8)
        number, _ = quality_model.features(raw, np.array([0, len(raw)]))
        tails = [1 / (1 + math.exp(c - sum(model.weights[j] for j in number))) for c in model.thresholds]
        assert r.top_probability == pytest.approx(tails[-1]) and r.expected_grade == pytest.approx(model.grades[0] + sum(tails)) and r.kept == (r.top_probability >= quality_model.MIN_TOP)
    assert len(out) == len(rows)
