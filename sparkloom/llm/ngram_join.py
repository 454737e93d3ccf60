"""N-gram Jaccard self-join by token-combination prefixes, and the groups that its links make.

A document is the set of its word shingles. Equal sets are one node. Tokens (shingle hashes) are ordered twice:

1. By hash, which costs nothing. Two sets that link share K tokens of their first E + K, where E is the number of
   tokens that a set may lack in its partner. Only these tokens are counted over the corpus.
   A node that shares fewer than K with others has no partner and is dropped before any full set is moved.
2. By document frequency among the nodes that remain, rarest first, over their full sets. A node with more than E
   tokens that no other has is dropped too. Those tokens use up errors, so the others take only the shortest prefix
   that must share a token combination with every partner: rare tokens are indexed alone, frequent ones in pairs
   within classes; each class of pairs extends the prefix by one token.

Nodes that share a combination are compared with a few pivots of that combination at a time, and only while they
are in different groups, so a group of thousands of near copies costs a few comparisons a member. Rounds go on
until no combination holds two nodes of different groups that weren't compared. Comparisons use the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BASE, batches, discard, mix, salted_join, small, text_bytes, word_hashes, written

WORDS = 5
#: Documents of a token from which it is indexed in pairs.
FREQUENT = 128
#: One more token in the first order for each so many of the set.
SLACK = 8
#: Longs of each of two bitmaps of a node's shared tokens: of those that are not frequent, and of those that are.
MAP = 4
#: Of a node's combinations so many, its smallest, stand beside each of them.
LEAST = 4
#: Members of a combination up to which all its pairs are compared from the second round on.
FEW = 12
#: Growth of the pivots' number after the first round, and of that growth after each further one.
GROWTH = 8
#: Members of a combination that one task compares with its pivots.
CHUNK = 1024
SET = "doc_id long, n long, sig binary, tokens array<long>"


def needed(n):  # noqa: ANN001, ANN201
    """Tokens of a set of n that a partner must hold: the least overlap at a similarity of 0.75."""
    return (3 * n + 3) // 4


def extra(n):  # noqa: ANN001, ANN201
    """K: tokens that two linked sets share among their first E + K by hash."""
    return np.maximum(2, n // SLACK)


def classes(n):  # noqa: ANN001, ANN201
    """Classes of frequent tokens for partners whose smaller set has n tokens; the same for all n of a power of two."""
    return max(1, (1 << max(0, int(n).bit_length() - 1)) // 16)


def shingle_sets(docs: DataFrame, whole: bool, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, sig, tokens): set size, digest of the set, and its tokens in hash order: all, or the first E + K."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(it, "t"):
            h, at = word_hashes(*text_bytes(b.column("t")))
            s = np.zeros(0, np.uint64)
            if len(h) >= WORDS:
                m = len(h) - WORDS + 1
                s = h[:m].copy()
                for k in range(1, WORDS):
                    s = s * BASE + h[k : m + k]
                s = mix(s)
            sizes, sigs, tokens = [], [], []
            for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if j - i >= WORDS:
                    x = np.sort(s[i : j - WORDS + 1])
                    x = x[np.append(True, x[1:] != x[:-1])]
                else:  # fewer words: the whole sequence is one shingle
                    x = mix(np.array([int.from_bytes(hashlib.blake2b(h[i:j].tobytes(), digest_size=8).digest(), "little")], np.uint64)) if j > i else s[:0]
                n = len(x)
                sizes.append(n)
                sigs.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
                tokens.append(x if whole else x[: n - needed(n) + int(extra(n))] if n > 1 else x[:0])
            flat = np.concatenate(tokens).view(np.int64)
            bounds = np.append(0, np.cumsum([len(x) for x in tokens]))
            yield pa.RecordBatch.from_arrays(
                [b.column("k"), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat))],
                names=["doc_id", "n", "sig", "tokens"],
            )

    d = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    return d.mapInArrow(run, SET)


def node_key(doc: Column, sig: Column) -> Column:
    """A node's smallest document, or a number below all usual ids where all its documents have none."""
    return F.coalesce(doc, F.lit(-(1 << 62)) - F.pmod(F.xxhash64(sig), F.lit(1 << 61)))


def least_shared(n: Column) -> Column:
    """K of the smallest possible partner: tokens that any partner shares of the first E + K."""
    return F.greatest(F.lit(2), F.floor(F.floor((3 * n + 3) / 4) / SLACK)).cast("long")


def all_shared(n: Column) -> Column:
    """The same for full sets."""
    return F.floor((3 * n + 3) / 4).cast("long")


def shared_tokens(nodes: DataFrame, name: str, least: Callable[[Column], Column]) -> DataFrame:
    """(node, n, sig, doc_id, tokens): nodes that may have a partner, with those of their tokens that other nodes have too.

    ``tokens`` becomes an array of (df, token). Counting combines within each task first; the join back spreads the
    rows of tokens that very many nodes have.
    """
    t = nodes.select("node", F.explode_outer("tokens").alias("token")).where("token IS NOT NULL")
    df = written(t.groupBy("token").agg(F.count("*").alias("df")).where("df > 1").select(F.col("token").alias("d_token"), "df"), "df")
    counts = df.select(F.col("d_token").alias("token"), F.col("df").alias("m"))
    hits = salted_join(t, df, "token", "d_token", counts, "node").groupBy("node").agg(F.collect_list(F.struct("df", "token")).alias("tokens"))
    sizes = nodes.select(F.col("node").alias("id"), "n", "sig", "doc_id")
    out = hits.join(sizes, F.col("node") == F.col("id")).where(F.size("tokens") >= least(F.col("n")))
    out = written(out.select("node", "n", "sig", "doc_id", "tokens"), name)
    discard(df)
    return out


def plain(nodes: DataFrame) -> DataFrame:
    """Nodes with tokens alone, without their frequencies."""
    return nodes.withColumn("tokens", F.transform("tokens", lambda x: x["token"]))


def combinations(nodes: DataFrame) -> DataFrame:
    """(combo, node, n, own, m0, ..., k0, ...): the token combinations of each node's prefix, with its smallest ones.

    ``own``: tokens that no other node has. The bitmaps have a bit for each shared token, the first one's longs for those
    that are not frequent, the second one's for those that are; a bit that the other node of a pair lacks is a token
    that it lacks.
    """
    maps, least_of = [f"m{k}" for k in range(2 * MAP)], [f"k{k}" for k in range(LEAST)]

    def of(n: int, df: np.ndarray, token: np.ndarray) -> np.ndarray:
        order = np.lexsort((token, df))
        df, token = df[order], token[order].view(np.uint64)
        rare = int(np.searchsorted(df, FREQUENT, "right"))
        out = []
        # Errors that a partner may make among the shared tokens, and one more.
        goal = len(token) - needed(n) + 1
        least = max(1, int(needed(n)))
        for low in {1 << (least.bit_length() - 1), 1 << (n.bit_length() - 1)}:  # sizes of the smaller set of a pair
            if rare >= goal:
                out.append(mix(token[:goal]))
                continue
            g = classes(low)
            of_class = token[rare:] % np.uint64(g)
            # Each class's first token adds nothing, each further one breaks one error.
            again = np.ones(len(of_class), bool)
            again[np.unique(of_class, return_index=True)[1]] = False
            end = int(np.searchsorted(np.cumsum(again), goal - rare)) + 1
            out.append(mix(token[:rare]))
            for c in range(g):
                x = token[rare : rare + end][of_class[:end] == c]
                a, b = np.triu_indices(len(x), 1)
                out.append(mix(x[a] * BASE + x[b] + np.uint64(low)))
        return np.unique(np.concatenate(out)).view(np.int64)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            lists = b.column("tokens")
            offs, vals = lists.offsets.to_numpy(), lists.values
            df, token = vals.field("df").to_numpy(), vals.field("token").to_numpy()
            node, n, owns = b.column("node").to_numpy(), b.column("n").to_numpy(), b.column("own").to_numpy()
            for i in range(b.num_rows):
                d, t = df[offs[i] : offs[i + 1]], token[offs[i] : offs[i + 1]]
                x = of(int(n[i]), d, t)
                bits = np.zeros(2 * 64 * MAP, np.uint8)
                bits[(t.view(np.uint64) >> np.uint64(7)) % np.uint64(64 * MAP) + np.uint64(64 * MAP) * (d > FREQUENT).astype(np.uint64)] = 1
                bitmap = np.packbits(bits).view(np.int64)
                smallest = np.append(np.sort(x)[:LEAST], np.full(max(0, LEAST - len(x)), np.iinfo(np.int64).max))
                yield pa.RecordBatch.from_arrays([pa.array(x), *(pa.array(np.full(len(x), v)) for v in (node[i], n[i], owns[i], *bitmap, *smallest))], names=["combo", "node", "n", "own", *maps, *least_of])

    d = nodes.select("node", "n", (F.col("n") - F.size("tokens")).cast("long").alias("own"), "tokens")
    return d.mapInArrow(run, "combo long, node long, n long, own long, " + ", ".join(f"{m} long" for m in [*maps, *least_of]))


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable from each id of ``links`` (a, b). Labels spread and then jump.

    Ids with very many links, and roots with very many ids, are spread over tasks.
    """
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    degrees = written(both.groupBy(F.col("b")).agg(F.count("*").alias("m")), "degrees")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = salted_join(both, labels, "b", "id", degrees, "a").groupBy("a").agg(F.min("root").alias("m"))
        step = labels.join(near, F.col("id") == F.col("a")).select("id", F.col("root").alias("was"), F.least("root", "m").alias("root"))
        step = written(step, "labels")
        # Jump: a root that has a smaller root itself hands it on. Only such roots take part.
        sizes = step.groupBy("root").agg(F.count("*").alias("m"))
        up = step.where("root < id").select(F.col("id").alias("up"), F.col("root").alias("up_root"))
        sizes = written(sizes.join(up, F.col("root") == F.col("up")).select("root", "m", "up_root"), "roots")
        up = sizes.select(F.col("root").alias("up"), "up_root")
        jumped = salted_join(step, up, "root", "up", sizes, "id", "left").select("id", "was", F.least("root", F.coalesce("up_root", "root")).alias("root"))
        jumped = written(jumped, "labels")
        discard(step, sizes, labels)
        labels = jumped.select("id", "root")
        if jumped.where("root <> was").isEmpty():
            discard(both, degrees)
            return labels


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets link."""
    left = sets.select(F.col("node").alias("ida"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("idb"), F.col("tokens").alias("tb"))
    d = salted_join(pairs, left, "a", "ida", pairs.groupBy("a").agg(F.count("*").alias("m")), "b")
    d = salted_join(d, right, "b", "idb", pairs.groupBy("b").agg(F.count("*").alias("m")), "a")
    both = F.size(F.array_intersect("ta", "tb"))
    d = d.select("a", "b", both.alias("i"), (F.size("ta") + F.size("tb")).alias("total"))
    return d.where("100 * i >= 75 * (total - i)").select("a", "b")


def plausible(x: dict[str, Column], y: dict[str, Column]) -> Column:
    """Whether the overlap can reach 3/7 of both sizes together, the least at a similarity of 0.75. An exact bound:
    tokens that only one node has, or whose bit the other lacks, aren't in the overlap."""
    fits = F.lit(True)
    for a, b in ((x, y), (y, x)):
        lacks = sum((F.bit_count(a[f"m{k}"].bitwiseAND(F.bitwise_not(b[f"m{k}"]))) for k in range(2 * MAP)), F.lit(0))
        fits &= 7 * (a["n"] - a["own"] - lacks) >= 3 * (a["n"] + b["n"])
    return fits


def met_before(combo: Column, x: dict[str, Column], y: dict[str, Column]) -> Column:
    """Whether two nodes share a smaller combination than this one, as far as their smallest ones tell.

    Such a pair is left to the smaller combination: it meets in the least that both have among their smallest, so it is
    never lost, and two nodes that share hundreds of combinations don't meet in each of them.
    """
    shared = F.lit(False)
    for i in range(LEAST):
        shared |= (x[f"k{i}"] < combo) & x[f"k{i}"].isin(*[y[f"k{j}"] for j in range(LEAST)])
    return shared


def linked_groups(combos: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, root) for every node that has a link: groups of nodes, by rounds of comparisons with pivots.

    The members of a combination that very many nodes have are dealt in chunks, to each of which its pivots are copied.
    """
    spark = combos.sparkSession
    facts = ["node", "n", "own", *(f"m{k}" for k in range(2 * MAP)), *(f"k{k}" for k in range(LEAST))]
    members = combos.withColumn("root", F.col("node"))
    roots = spark.createDataFrame([], "id long, root long")
    checked = spark.createDataFrame([], "a long, b long")
    was, pivots, growth = combos, 1, GROWTH
    while True:
        # What is open: combinations with members of different groups. One row for each combination.
        state = members.groupBy("combo").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m")).where("lo < hi")
        state = written(state.select(F.col("combo").alias("c"), "m"), "open")
        new = salted_join(members, state, "combo", "c", state.select(F.col("c").alias("combo"), "m"), "node").drop("c")
        members = written(new.withColumn("chunk", F.pmod(F.xxhash64(F.lit(2), "node"), F.ceil(F.col("m") / CHUNK)).cast("int")), "members")
        discard(was, state)
        was = members
        if members.isEmpty():
            discard(members, checked)
            return roots
        # Combinations with no more members than pivots are compared in full, which ends them.
        most = max(FEW, pivots) if pivots > 1 else 0
        few, many = members.where(F.col("m") <= most), members.where(F.col("m") > most)
        # Pivots: in each combination, the smallest node of each of so many parts.
        part = F.pmod(F.xxhash64("node", F.lit(pivots)), F.lit(pivots))
        chosen = many.groupBy("combo", part.alias("part")).agg(F.min(F.struct(*facts, "root")).alias("p"), F.first("m").alias("m"))
        chosen = chosen.select("combo", "p", "m", F.lit(False).alias("full")).union(few.select("combo", F.struct(*facts, "root"), "m", F.lit(True)))
        p = chosen.select(F.col("combo").alias("c"), "full", F.explode(F.sequence(F.lit(0), F.ceil(F.col("m") / CHUNK).cast("int") - 1)).alias("k"), *(F.col(f"p.{f}").alias(f"p_{f}") for f in [*facts, "root"]))
        mine, theirs = {f: F.col(f) for f in facts}, {f: F.col(f"p_{f}") for f in facts}
        may = plausible(mine, theirs) & ~met_before(F.col("combo"), mine, theirs)
        may &= ~F.col("full") | (F.col("node") < F.col("p_node"))  # where all are pivots, a pair meets once
        pairs = members.join(p, (F.col("combo") == F.col("c")) & (F.col("chunk") == F.col("k")) & (F.col("root") != F.col("p_root")) & may)
        # Each pair once, without those compared before: one aggregate, in which repeats meet before they are moved.
        pairs = pairs.select(F.least("node", "p_node").alias("a"), F.greatest("node", "p_node").alias("b"), F.lit(0).alias("old"))
        pairs = pairs.union(checked.withColumn("old", F.lit(1))).groupBy("a", "b").agg(F.max("old").alias("old"))
        pairs = written(pairs.where("old = 0").select("a", "b"), "pairs")
        links = verified(pairs, sets)
        # Links between groups, as links of their roots
        for end in ("a", "b"):
            r = roots.select(F.col("id").alias("r_id"), F.col("root").alias("r_root"))
            links = links.join(r, F.col(end) == F.col("r_id"), "left").withColumn(end, F.coalesce("r_root", end)).drop("r_id", "r_root")
        links = written(links.where("a <> b").distinct(), "links")
        now = written(checked.union(pairs), "checked")
        discard(checked, pairs)
        checked = now
        if not links.isEmpty():
            new = components(links)
            sizes = roots.groupBy("root").agg(F.count("*").alias("m"))
            merged = salted_join(roots, new.select(F.col("id").alias("o"), F.col("root").alias("to")), "root", "o", sizes, "id", "left")
            merged = merged.select("id", F.coalesce("to", "root").alias("root"))
            now = written(merged.union(new.join(roots.select(F.col("id").alias("o")), F.col("id") == F.col("o"), "left_anti").select("id", "root")), "roots")
            discard(roots, new)
            roots = now
        discard(links)
        # Pivots, and all of the combinations that were compared in full, are done.
        done = chosen.where("NOT full").select(F.col("combo").alias("c"), F.col("p.node").alias("p_node"))
        members = many.join(done, (F.col("combo") == F.col("c")) & (F.col("node") == F.col("p_node")), "left_anti").drop("m", "root", "chunk")
        r = roots.select(F.col("id").alias("r_id"), F.col("root").alias("r_root"))
        members = members.join(r, F.col("node") == F.col("r_id"), "left").select("combo", *facts, F.coalesce("r_root", "node").alias("root"))
        pivots, growth = pivots * growth, growth * GROWTH


def join(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id), one row for each row of ``docs``.

    ``component_id`` is the smallest key reachable by links, the row's own included. Null and empty texts, and texts
    of white space, have no shingles and are linked with nothing: each keeps its own key. Rows with equal sets are
    linked, repeated rows too. Rows with a null key take part; their component is the smallest key of their group, null
    if it has none. An empty table gives an empty result. Other columns aren't read. Sets are compared by 64-bit shingle
    hashes; no document, token or combination is capped.
    """
    d = written(shingle_sets(docs, False, key, text), "sets")
    nodes = d.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.count("*").alias("copies"), F.first("tokens").alias("tokens"))
    nodes = nodes.withColumn("node", node_key(F.col("doc_id"), F.col("sig")))
    nodes = written(nodes, "nodes")
    once = shared_tokens(nodes, "shared", least_shared)
    alive = shared_tokens(plain(once), "shared", least_shared)
    discard(once)
    n_alive = alive.count()
    wanted = alive.select(F.col("doc_id").alias("w")).distinct()
    candidates = docs.join(small(wanted, n_alive), F.col(key).cast("long").eqNullSafe(F.col("w")), "left_semi")
    full = shingle_sets(candidates, True, key, text).select(F.col("sig").alias("s"), F.col("tokens").alias("all"))
    full = full.join(small(alive.select("sig", "node", "n", "doc_id"), n_alive, 128), F.col("s") == F.col("sig"))
    full = full.groupBy("node", "n", "sig", "doc_id").agg(F.first("all").alias("tokens"))
    full = written(full, "full")
    discard(alive)
    alive = shared_tokens(full, "shared", all_shared)
    left = alive.count()
    while True:  # each node that goes may leave others with too few shared tokens
        once, alive = alive, shared_tokens(plain(alive), "shared", all_shared)
        discard(once)
        before, left = left, alive.count()
        if left >= 0.9 * before:
            break
    sets = full.join(alive.select(F.col("node").alias("o")), F.col("node") == F.col("o"), "left_semi").select("node", "tokens")
    sets = written(sets, "sets")
    discard(full)
    combos = written(combinations(alive), "combos")
    discard(alive)
    roots = linked_groups(combos, sets)
    discard(sets)
    # From nodes to documents: the smallest key of each group
    ids = nodes.select("node", "sig", "copies", F.col("doc_id").alias("first"))
    r = roots.select(F.col("id").alias("r_id"), "root")
    ids = written(ids.join(r, F.col("node") == F.col("r_id"), "left").select("node", "sig", "copies", "first", F.coalesce("root", "node").alias("root")), "groups")
    least = written(ids.groupBy("root").agg(F.min("first").alias("component"), F.count("*").alias("m")), "least")
    ids = salted_join(ids, least.select(F.col("root").alias("l"), "component"), "root", "l", least, "node")
    ids = written(ids.select(F.col("sig").alias("s"), "copies", "component"), "components")
    discard(nodes, least)
    # A document without shingles has no node
    ids = ids.select("s", "copies", F.struct("component").alias("of"))
    out = salted_join(d.select("doc_id", "n", "sig"), ids, "sig", "s", ids.select(F.col("s").alias("sig"), F.col("copies").alias("m")), "doc_id", "left")
    component = F.when(F.col("of").isNotNull(), F.col("of.component")).otherwise(F.col("doc_id"))
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))
