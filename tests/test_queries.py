"""Every registered query runs; many of them against plain Python over the same rows."""

import datetime as dt
import zlib
from collections import Counter, defaultdict
from statistics import quantiles

import pytest

from sparkloom.plans.catalogue import ORACLES, QUERIES

from .conftest import in_order

EMPTY = {"filter_false", "filter_not_in_nulls"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs(name, spark, sf_dir):
    out = QUERIES[name](spark, sf_dir)
    assert len(set(out.columns)) == len(out.columns)
    assert out.isEmpty() == (name in EMPTY)


def test_entry_needs_no_pipeline():
    """The contract module imports and offers the library's own queries, whatever else is there."""
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert set(QUERIES) - set(ORACLES) == {"fam_spark_only", "agg_approx"}


@pytest.fixture
def got(spark, sf_dir):
    return lambda name, *columns: in_order(QUERIES[name](spark, sf_dir).select(*columns).collect())


def test_scans(got, data):
    ordered = sorted(data.orders, key=lambda r: (r["o_totalprice"], r["o_orderkey"]))
    assert got("scan_rowid", "o_orderkey", "rowid") == in_order((r["o_orderkey"], i) for i, r in enumerate(ordered))
    assert got("scan_project_exclude", "p_partkey", "a", "b") == in_order((r["p_partkey"], r["p_size"], r["p_size"]) for r in data.part)
    assert got("scan_all_types", "k", "tiny", "big", "items") == in_order([(1, -128, -(2**63), 0), (2, 127, 2**63 - 1, 3), (3, None, None, None)])
    assert got("source_custom", "c_custkey", "c_name") == in_order((r["c_custkey"], r["c_name"]) for r in data.customer)


def test_filters_and_joins(got, data):
    big = {r["l_orderkey"] for r in data.lineitem if r["l_quantity"] > 45}
    known = {r["l_orderkey"] for r in data.lineitem}
    assert got("join_semi", "o_orderkey") == in_order((r["o_orderkey"],) for r in data.orders if r["o_orderkey"] in big)
    assert got("join_anti", "o_orderkey") == in_order((r["o_orderkey"],) for r in data.orders if r["o_orderkey"] not in known)
    segment, of = {r["c_custkey"]: r["c_mktsegment"] for r in data.customer}, {r["o_orderkey"]: r["o_custkey"] for r in data.orders}
    assert got("join_inner_3way", "c_mktsegment", "n") == in_order(Counter(segment[of[r["l_orderkey"]]] for r in data.lineitem).items())
    views = defaultdict(list)
    for r in data.events:
        if r["event_type"] == "view":
            views[r["user_id"]].append((r["ts"], r["event_id"]))
    want = [(r["event_id"], max((v for v in views[r["user_id"]] if v[0] <= r["ts"]), default=(None, None))[1]) for r in data.events if r["event_type"] == "purchase"]
    assert got("join_asof", "event_id", "event_id_asof") == in_order(want)
    near = [(a["event_id"], b["event_id"]) for a in data.events if a["event_type"] == "purchase" for b in data.events if a["user_id"] == b["user_id"] and a is not b and dt.timedelta() <= b["ts"] - a["ts"] <= dt.timedelta(minutes=10)]
    assert got("join_range", "event_id", "near_id") == in_order(near)
    pairs = [(a["n_name"], b["n_name"]) for a in data.nation for b in data.nation if a["n_nationkey"] < b["n_nationkey"] and a["n_regionkey"] != b["n_regionkey"]]
    assert got("join_theta", "x", "y") == in_order(pairs)


def test_aggregates(got, data):
    groups = defaultdict(list)
    for r in data.lineitem:
        if r["l_shipdate"] <= dt.datetime(1998, 9, 2):
            groups[r["l_returnflag"], r["l_linestatus"]].append(r)
    assert got("pricing_summary", "l_returnflag", "l_linestatus", "sum_qty", "count_order") == in_order((*k, sum(r["l_quantity"] for r in v), len(v)) for k, v in groups.items())
    status = Counter((r["l_linestatus"], r["l_returnflag"]) for r in data.lineitem)
    assert {(s, f) for s, f in status} == {(s, f) for s, *have in got("pivot_inferred", "l_linestatus", "A", "N", "R") for f, x in zip("ANR", have, strict=True) if x}
    sizes = Counter((r["o_orderpriority"], r["o_orderstatus"]) for r in data.orders)
    want = [(p, ",".join(f"{s}={n}" for (q, s), n in sorted(sizes.items()) if q == p)) for p in {p for p, _ in sizes}]
    assert got("agg_histogram", "o_orderpriority", "h") == in_order(want)
    best = {}
    for r in data.orders:
        best[r["o_custkey"]] = min(best.get(r["o_custkey"], (1e99,)), (-r["o_totalprice"], r["o_orderkey"]))
    assert got("agg_distinct_on", "o_custkey", "o_orderkey") == in_order((k, v[1]) for k, v in best.items())


def test_approximations_keep_their_bounds(spark, sf_dir, data):
    values = defaultdict(list)
    for r in data.events:
        values[r["event_type"]].append(r["value"])
    for r in QUERIES["agg_approx"](spark, sf_dir).collect():
        x = sorted(values[r.event_type])
        assert r.n == len(x) and abs(r.n_near - r.n) <= 0.1 * r.n and abs(r.n_hll - r.n) <= 0.1 * r.n
        assert x[int(0.9 * len(x)) - 3] <= r.q_near <= x[int(0.9 * len(x)) + 2] and r.bins == 8
        assert r.q == pytest.approx(quantiles(x, n=10, method="inclusive")[8])


def test_approximations_of_repeated_ids(spark, tmp_path, data):
    """Repeated and null ids and types; no aggregate beside the count of distinct ids is kept for each id."""
    rows = [r | {"event_id": r["event_id"] // 3 if i % 5 else None, "event_type": r["event_type"] if i % 7 else None} for i, r in enumerate(data.events)]
    spark.createDataFrame(rows).write.parquet(f"{tmp_path}/events.parquet")
    out = QUERIES["agg_approx"](spark, str(tmp_path))
    ids = defaultdict(set)
    for r in rows:
        ids[r["event_type"]].add(r["event_id"])
    assert {r.event_type: r.n for r in out.collect()} == {k: len(v - {None}) for k, v in ids.items()}
    keyed_by_id = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "ObjectHashAggregate(keys=" in x and "event_id#" in x.split("]")[0]]
    assert not keyed_by_id


def test_running_sums_count_nulls_last(spark, tmp_path, sf_dir, data):
    """Events without a time come after a user's others, as in the query's SQL."""
    rows = [r | {"ts": r["ts"] if i % 4 else None} for i, r in enumerate(data.events)]
    spark.createDataFrame(rows, spark.read.parquet(f"{sf_dir}/events.parquet").schema).write.parquet(f"{tmp_path}/events.parquet")
    want, sums = [], Counter()
    for r in sorted(rows, key=lambda r: (r["ts"] is None, r["ts"] or dt.datetime.min, r["event_id"])):
        sums[r["user_id"]] += r["value"]
        if sums[r["user_id"]] <= 1000:
            want.append((r["event_id"], r["user_id"]))
    assert in_order(QUERIES["win_qualify"](spark, str(tmp_path)).collect()) == in_order(want)


def test_functions_without_counterpart(spark, sf_dir):
    for r in QUERIES["fam_spark_only"](spark, sf_dir).collect():
        assert r.crc == zlib.crc32(r.n_name.encode()) and r.sound == "N350" and r.zone == "UTC"
        assert r.file and r.part and r.mono and r.ok


def test_dates_after_year_9999(spark, sf_dir, tmp_path, data):
    """Large order keys make times whose years have five digits: they come without a plus sign."""
    days = {0: "1970-01-01", 2_932_896: "9999-12-31", 2_932_897: "10000-01-01", 8_999_999: "26611-03-01"}
    rows = [r | {"o_orderkey": k} for k, r in zip(days, data.orders, strict=False)]
    spark.createDataFrame(rows, spark.read.parquet(f"{sf_dir}/orders.parquet").schema).write.parquet(f"{tmp_path}/orders.parquet")
    assert {r.o_orderkey: r.p for r in QUERIES["fam_date_math"](spark, str(tmp_path)).collect()} == {k: f"{d} 00:00:00" for k, d in days.items()}


def test_windows_and_streams(got, data):
    days = Counter((r["ts"].replace(hour=0, minute=0, second=0, microsecond=0), r["event_type"]) for r in data.events)
    assert got("stream_tumbling", "day", "event_type", "n") == in_order((*k, n) for k, n in days.items())
    seen = defaultdict(list)
    for r in sorted(data.events, key=lambda r: r["ts"]):
        mine = seen[r["user_id"]]
        if mine and r["ts"] - mine[-1][-1] < dt.timedelta(hours=6):
            mine[-1].append(r["ts"])
        else:
            mine.append([r["ts"]])
    assert got("stream_sessions", "user_id", "start", "n") == in_order((u, s[0], len(s)) for u, all_of in seen.items() for s in all_of)
    counts = defaultdict(Counter)
    for r in data.events:
        counts[r["event_type"], r["user_id"]][r["ts"].date()] += 1
    want = [(*k, d, c[d]) for k, c in counts.items() for i in range((max(c) - min(c)).days + 1) for d in (min(c) + dt.timedelta(days=i),)]
    assert got("series_gap_fill", "event_type", "user_id", "day", "n") == in_order(want)


def test_changes(got, data):
    shut = sum(r["o_orderstatus"] == "F" for r in data.orders)
    left = [r for r in data.orders if r["o_orderkey"] % 3]
    want = {"insert": len(data.orders), "update": shut, "delete": len(data.orders) - len(left), "default": 1, "left": len(left) + 1, "closed": sum(r["o_orderstatus"] == "F" for r in left)}
    assert got("ingest_counts", "step", "n") == in_order(want.items())
    rows, source = {r["c_custkey"]: r["c_name"] for r in data.customer}, Counter(r["o_custkey"] + 50 for r in data.orders)
    merged = {k: v for k, v in rows.items() if k not in source}
    merged |= {k: f"{rows[k]}/{n}" if k in rows else f"new {n}" for k, n in source.items() if k not in rows or n < 15}
    assert got("ingest_merge", "k", "v") == in_order(merged.items())
    assert got("udtf_chunks", "p_partkey", "first", "size") == in_order((r["p_partkey"], i, min(7, r["p_size"] - i)) for r in data.part for i in range(0, r["p_size"], 7))
