"""Operators that must not gather a group, against plain versions of them."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL


# ------------------------------------------------------------------ SVD

def sparse_rows(spark, n, k, seed):
    rng = np.random.default_rng(seed)
    rows, dense = [], np.zeros((n, k))
    for i in range(n):
        terms = rng.choice(k, size=min(k, int(rng.integers(1, 6))), replace=False)
        w = rng.random(len(terms)) + 0.1
        dense[i, terms] = w
        rows.append((i, [int(t) for t in terms], [float(x) for x in w]))
    return spark.createDataFrame(rows, "seq long, ii array<int>, ww array<double>").repartition(5), dense


@pytest.mark.parametrize("case", ["array", "table", "narrow"])
def test_svd_equals_numpy(spark, monkeypatch, case):
    from hirelens.ml import svd as S
    if case == "table":
        monkeypatch.setattr(S, "FACTOR_TERMS", 3)
        monkeypatch.setattr(S, "TOLERANCE", 1e-6)
    n, k = (80, 40) if case != "narrow" else (50, 3)
    rows, x = sparse_rows(spark, n, k, 3)
    comps, vals, shares = S.truncated_svd(rows.cache(), k, dim=5)
    want = np.linalg.svd(x, compute_uv=False) ** 2
    top = min(5, k)
    near = 1e-6 if case != "table" else 1e-3
    assert np.allclose(vals, want[:top], rtol=near) and np.allclose(shares, want[:top] / want.sum(), atol=near)
    p = np.zeros((n, top))
    for r in S.multiply(rows, comps).collect():
        p[r["seq"]] = r["p"]
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    if case != "table":  # sign-free: each coordinate is the singular vector's, up to its sign
        assert np.allclose(np.abs(p), np.abs(u[:, :top] * s[:top]), atol=1e-4)
    rows.unpersist()


def test_svd_of_nothing_and_of_one_row(spark):
    from hirelens.ml.svd import truncated_svd
    none = spark.createDataFrame([], "seq long, ii array<int>, ww array<double>")
    assert truncated_svd(none, 4)[1].size == 0
    one = spark.createDataFrame([(1, [0, 2], [3.0, 4.0])], "seq long, ii array<int>, ww array<double>")
    comps, vals, shares = truncated_svd(one, 3)
    assert np.allclose(vals, [25.0]) and np.allclose(shares, [1.0]) and comps.array.shape == (3, 1)


def test_svd_of_tags_equals_the_gram(spark):
    from hirelens.ml.svd import truncated_svd
    from hirelens.ml.tfidf import gram, svd_components
    from hirelens.plans import q_ml
    w = q_ml._weights(spark, SF_SMALL).cache()
    k = q_ml._width(w)
    _, vals, shares = truncated_svd(w, k)
    _, gvals, gshares = svd_components(gram(w, k).collect(), k)
    assert np.allclose(vals, gvals, rtol=1e-6) and np.allclose(shares, gshares, atol=1e-6)
    w.unpersist()


# ------------------------------------------------------------ quantiles

@pytest.mark.parametrize("buckets", [50, 1024])
def test_quantiles_of_odd_values(spark, monkeypatch, buckets):
    from hirelens.operators import quantiles as Q
    monkeypatch.setattr(Q, "BUCKETS", buckets)
    rng = random.Random(5)
    pool = [0.0, -0.5, 1e-300, 1e300, -1e300, 1.7e308, -1.7e308, math.inf, -math.inf, 5e-324, 3.25, 3.25, 1e9 + 0.1]
    rows = [(rng.choice(["a", None]), rng.choice([rng.choice(pool), rng.gauss(0, 1), float(rng.randrange(5)), None])) for _ in range(400)]
    rows += [("one", 7.5), ("same", 2.0), ("same", 2.0), ("none", None), ("inf", math.inf), ("inf", -math.inf), ("inf", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: (r["p"], r["q"], r["r"]) for r in Q.quantiles(df, ["g"], {"p": ("x", 0.5), "q": ("x", 0.01), "r": ("x", 1.0)}).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        v = sorted(x for k, x in rows if k == g and x is not None)
        if v:
            def at(p, v=v):
                place = (len(v) - 1) * p
                lo, hi = math.floor(place), math.ceil(place)
                return v[lo] if lo == hi else (hi - place) * v[lo] + (place - lo) * v[hi]
            want[g] = (at(0.5), at(0.01), at(1.0))
    assert got.keys() == want.keys()
    for g in want:
        assert all(a == b or math.isclose(a, b, rel_tol=1e-12) for a, b in zip(got[g], want[g])), g


def test_quantiles_of_a_hot_group_have_no_window(spark):
    from hirelens.operators.quantiles import quantiles
    df = spark.range(0, 1_000_000, 1, 8).select(F.lit("hot").alias("g"), (F.col("id") * 0.5).alias("x"))
    q = quantiles(df, ["g"], {"p": ("x", 0.5), "q": ("x", 0.333)})
    assert "Window" not in q._jdf.queryExecution().executedPlan().toString()
    r = q.first()
    assert r["p"] == 249999.75 and math.isclose(r["q"], 999_999 * 0.333 / 2)


# -------------------------------------------------------- interval join

def brute_bins(values, bins):
    out = []
    for i, x in values:
        hit = [lab for lo, hi, lab in bins if x is not None and lo is not None and hi is not None and lo <= x < hi]
        out += [(i, lab) for lab in hit] or [(i, None)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [True, False])
def test_bins_overlap_and_edges(spark, monkeypatch, small):
    from hirelens import session
    from hirelens.operators.bins import assign_bins
    if not small:
        monkeypatch.setattr(session, "checked_broadcast", lambda df, most_rows=0: df)
    rng = random.Random(2)
    bins = [(0.0, 1.0, "a"), (1.0, 3.0, "b"), (0.5, 2.5, "over"), (2.0, 2.0, "empty"), (5.0, 4.0, "turned"), (10.0, math.inf, "open"),
            (-math.inf, -5.0, "low"), (None, 3.0, "no"), (-1e6, 1e6, "wide"), (3.0, 3.0000001, "thin"), (1.0, 3.0, "b again")]
    bins += [(x, x + rng.choice([0.001, 0.5, 30.0]), f"r{i}") for i, x in enumerate(rng.uniform(-100, 100) for _ in range(150))]
    values = [(i, rng.choice([rng.uniform(-120, 120), float(rng.randrange(-6, 12)), b[0] or 0.0, b[1] or 0.0])) for i, b in enumerate(bins * 3)]
    values = [(i, None if x is not None and math.isinf(x) and x > 0 else x) for i, x in values] + [(9000, None), (9001, -math.inf), (9002, 1e5)]
    v = spark.createDataFrame(values, "id long, x double")
    b = spark.createDataFrame(bins, "lo double, hi double, label string")
    got = sorted(((r["id"], r["bin"]) for r in assign_bins(v, "x", b).collect()), key=repr)
    assert got == brute_bins(values, bins)


def test_many_bins_without_a_nested_loop(spark):
    from hirelens.operators.bins import assign_bins
    n = 200_001
    b = spark.range(n).select(F.col("id").cast("double").alias("lo"), (F.col("id") + 1.0).alias("hi"), F.col("id").cast("string").alias("label"))
    v = spark.range(3000).select((F.col("id") * 67.25).alias("x"))
    out = assign_bins(v, "x", b)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert out.where("bin = cast(cast(floor(x) as bigint) as string)").count() == sum(i * 67.25 < n for i in range(3000))
    assert out.count() == 3000
    none = assign_bins(v, "x", b.limit(0))
    assert none.columns == ["x", "bin"] and none.where("bin IS NULL").count() == 3000


# ---------------------------------------------------------------- Lloyd

def test_lloyd_batches_equal_single_runs(spark):
    from hirelens.ml.cluster import _silhouettes, first_centers, kmeans_scan, lloyd, silhouette
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.4, (60, 2)) for c in ((0, 0), (5, 1), (2, 6))])
    df = spark.createDataFrame([(i, [float(a) for a in p]) for i, p in enumerate(x)], "seq long, features array<double>").repartition(4).cache()
    starts = [x[:2], x[[0, 70, 150]], x[[3, 4, 5, 6]]]
    fits, passes = lloyd(df, starts)
    assert passes < 60 and all(f.still for f in fits)
    for f, s in zip(fits, starts):
        c = np.array(s)
        for _ in range(100):
            own = ((x[:, None] - c) ** 2).sum(-1).argmin(1)
            c = np.array([x[own == i].mean(0) if (own == i).any() else c[i] for i in range(len(c))])
        assert np.allclose(f.centers, c, atol=1e-3) and f.sizes.sum() == len(x)
        assert math.isclose(f.cost, ((x - f.centers[((x[:, None] - f.centers) ** 2).sum(-1).argmin(1)]) ** 2).sum(), rel_tol=1e-9)
    own = ((x[:, None] - fits[1].centers) ** 2).sum(-1).argmin(1)
    labelled = spark.createDataFrame([(i, [float(a) for a in p], int(c)) for i, (p, c) in enumerate(zip(x, own))], "id long, v array<double>, cluster int")
    assert math.isclose(_silhouettes(df, [fits[1]])[0], silhouette(labelled, "v").agg(F.avg("silhouette")).first()[0], rel_tol=1e-9)
    a, b = (first_centers(df, "seq", 2, 3, 1) for _ in range(2))
    assert all((p == q).all() for p, q in zip(a, b)) and all(3 <= len(p) < 120 for p in a)
    scan = kmeans_scan(df, k_values=[2, 3, 4], starts=4)
    assert scan.chosen == 3 and scan.passes < 100 and [r[3] for r in scan.rows] == [False, True, False]
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], "seq long, features array<double>")
    assert [f.k for f in kmeans_scan(same, k_values=[2, 3], starts=2).fits.values()] == [1, 1]
    df.unpersist()


def test_nearest_centres_by_a_product_equal_the_differences():
    from hirelens.ml.cluster import _distances, _Layout
    rng = np.random.default_rng(5)
    # points on a grid and far from the origin: many ties and little left of a difference
    x = np.concatenate([rng.integers(0, 3, (400, 3)).astype(float), 1e6 + rng.normal(0, 1e-3, (200, 3)), np.zeros((1, 3))])
    fits = [x[:1], x[[5, 5, 9]], np.array([[0.5, 0, 0], [0, 0.5, 0], [1e6] * 3, [1, 1, 1]]), x[400:402], x[rng.choice(600, 40)]]
    ends = np.cumsum([0, *map(len, fits)])
    layout = _Layout.of(np.concatenate(fits), ends)
    own, sums = layout.nearest(x), layout.sums(x)
    for i, f in enumerate(layout.fits):
        d = _distances(x, fits[f])
        assert (own[i] == d.argmin(axis=1)).all()
        for j in range(len(fits[f])):
            mine, row = x[own[i] == j], sums[ends[f] + j]
            assert row[0] == len(mine) and np.allclose(row[3:], mine.sum(axis=0), rtol=1e-12)
            assert math.isclose(row[1], (mine * mine).sum(), rel_tol=1e-12, abs_tol=1e-300) and math.isclose(row[2], d[own[i] == j, j].sum(), rel_tol=1e-8, abs_tol=1e-300)


def test_boxes_give_the_sums_of_their_points(spark):
    """Packed points: same sums as point by point, few boxes looked into, and
    the same first centres whatever the partitions."""
    from hirelens.ml import cluster as C
    rng = np.random.default_rng(9)
    x = np.concatenate([c + rng.normal(0, s, (700, 3)) for c, s in zip(rng.normal(0, 4, (4, 3)), (0.2, 0.5, 0.0, 1.5))])
    df = spark.createDataFrame([(i, [float(a) for a in p]) for i, p in enumerate(x)], "seq long, features array<double>").repartition(3).cache()
    boxes = C.boxed(df, "seq")
    got = [C._Boxes.of(b, 3) for b in boxes.toArrow().to_batches() if b.num_rows]
    assert sorted(map(tuple, np.concatenate([b.x for b in got]))) == sorted(map(tuple, x)) and sum(len(b.n) for b in got) < len(x) / 20
    near = [x[[0, 700, 1400, 2100]], x[[5, 1400, 1401]]]  # two equal centres: the lower gets all
    far = [x[rng.choice(len(x), 9)] for _ in range(5)]
    for fits in (near, far, near + far):
        for a, b in zip(C._pass(boxes, fits), C._pass(df, fits)):
            assert np.allclose(a, b, rtol=1e-9, atol=1e-9)
    looked = [len(b.inside(np.flatnonzero(~b.sure(near[0], b.near(near[0]).argmin(axis=1))))) for b in got]
    assert sum(looked) < len(x) / 2
    a, b = (C.first_centers(d, "seq", 2, 3, 1) for d in (df, df.repartition(1)))
    assert all(p.shape == q.shape and (p == q).all() for p, q in zip(a, b))
    order, ends = C._leaves(np.repeat(x[:1], 10_000, axis=0))
    assert sorted(order) == list(range(10_000)) and ends[-1] == 10_000 and len(ends) < 10
    df.unpersist()


# ------------------------------------------------------------ numbering

def test_numbering_of_rows_equal_in_all_order_columns(spark):
    from hirelens.operators.crawl import global_sequence
    df = spark.range(0, 4000, 1, 4).select(F.lit("x").alias("a"), F.lit(None).cast("string").alias("b"), (F.col("id") % 1000).alias("v"))
    out = global_sequence(df, ["a", "b"])
    got = out.collect()
    assert sorted(r["seq_no"] for r in got) == list(range(1, 4001))
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 2000
    again = global_sequence(df.repartition(3), ["a", "b"])
    assert {(r["v"], r["seq_no"]) for r in got} == {(r["v"], r["seq_no"]) for r in again.collect()}
    assert global_sequence(df.limit(0), ["a"]).collect() == []
    words = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("c", 4)], "w string, v int")
    assert [r["v"] for r in global_sequence(words, ["w"]).orderBy("seq_no").collect()] == [3, 2, 1, 4]


# ------------------------------------------------------- breaker, stops

def events(rows):
    t0 = dt.datetime(2026, 1, 1)
    return [(i, t0 + dt.timedelta(seconds=s), u, "error" if f else "view") for i, (s, u, f) in enumerate(rows)]


def test_breaker_with_events_out_of_order(spark, tmp_path):
    from hirelens.operators.crawl import failure_streaks, streak_summary
    from hirelens.streaming.jobs import stream_breaker
    rng = random.Random(3)
    rows = events([(rng.randrange(0, 40000), rng.randrange(9), rng.random() < (0.9 if rng.random() < 0.5 else 0.4)) for _ in range(900)])
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    drops = str(tmp_path / "drops")
    for part in range(5):  # any event may come in any drop
        df.where(F.pmod(F.xxhash64("event_id"), F.lit(5)) == part).coalesce(1).write.mode("append").parquet(drops)
    got = stream_breaker(spark, drops, df.schema, str(tmp_path / "w"), 1, pool=F.col("user_id") % 3)
    twin = streak_summary(failure_streaks(df))
    key = lambda r: r["user_id"]
    a, b = sorted(got.collect(), key=key), sorted(twin.collect(), key=key)
    assert [tuple(r[c] for c in twin.columns) for r in a] == [tuple(r) for r in b]
    open_ = {}
    for i, ts, u, kind in sorted(rows, key=lambda r: (r[1], r[0])):
        open_[u] = open_.get(u, 0) + 1 if kind == "error" else 0
    assert {r["user_id"]: r["open_streak"] for r in a} == open_
    for r in a:
        healthy = sum(n < 2 for u, n in open_.items() if u % 3 == r["user_id"] % 3)
        assert r["degraded"] == (healthy < 3)
    assert len({r["degraded"] for r in a}) >= 1


def test_a_source_stops_at_its_eighth_failure(spark):
    from hirelens.operators.crawl import failure_streaks, stopped
    rows = events([(i, 1, i not in (3, 20)) for i in range(40)] + [(i, 2, i % 3 != 0) for i in range(30)])
    df = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string")
    got = {r["user_id"]: (r["stop_event"], r["n_processed"], r["n_skipped"]) for r in stopped(failure_streaks(df)).collect()}
    assert got == {1: (11, 12, 28), 2: (None, 30, 0)}


def test_bounded_dedup_forgets(spark, tmp_path):
    from hirelens.streaming.jobs import stream_dedup_within
    day = lambda d: dt.datetime(2026, 1, 1) + dt.timedelta(days=d)
    schema = "k string, ts timestamp"
    drops, work = str(tmp_path / "drops"), str(tmp_path / "work")
    for d in range(14):
        spark.createDataFrame([("often", day(d)), (f"only {d}", day(d))] + ([("twice", day(d))] if d in (0, 1, 12) else []), schema) \
            .coalesce(1).write.mode("append").parquet(drops)
    out = stream_dedup_within(spark, drops, spark.createDataFrame([], schema).schema, work, 1, ["k"], "ts", "2 days")
    got = sorted((r["k"], (r["ts"] - day(0)).days) for r in out.collect())
    assert ("twice", 0) in got and ("twice", 1) not in got and ("twice", 12) in got  # inside the horizon, beyond it
    assert sum(k.startswith("only") for k, _ in got) == 14
    assert 2 <= sum(k == "often" for k, _ in got) <= 5


# ------------------------------------------------- stores, keys, sketches

def test_keyed_table_rewrites_what_it_touches(spark, tmp_path, monkeypatch):
    import os
    import time

    from hirelens.sinks import store as S
    monkeypatch.setattr(S, "PARTITION_ROWS", 20)
    path, schema = str(tmp_path / "t"), "k string, _batch int, seq long, v string"
    assert S.table_rows(spark, path) is None
    rows = [(f"k{i}", 0, i, "old") for i in range(200)] + [(None, 0, 1, "old")]
    S.upsert_table(spark, path, spark.createDataFrame(rows, schema), "k")

    def files():
        return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}
    before = files()
    assert len(before) > 5
    time.sleep(0.01)
    new = spark.createDataFrame([("k7", 1, 0, "new"), ("k7", 1, 5, "newer"), ("x", 1, 1, "new")], schema)
    for _ in range(2):  # repeating a batch changes nothing
        S.upsert_table(spark, path, new, "k")
        got = {r["k"]: r["v"] for r in S.table_rows(spark, path).collect()}
        assert len(got) == 202 and got["k7"] == "newer" and got["x"] == "new" and got["k8"] == "old" and got[None] == "old"
    assert len(before.keys() - files().keys()) <= 2  # two keys: at most two partitions
    held = files()
    S.insert_table(spark, path, spark.createDataFrame([("k7", 2, 0, "ignored"), (None, 2, 0, "ignored"), ("y", 2, 3, "second"), ("y", 2, 2, "first")], schema), "k")
    got = {r["k"]: r["v"] for r in S.table_rows(spark, path).collect()}
    assert got["k7"] == "newer" and got["y"] == "first" and got[None] == "old" and len(got) == 203 and held.keys() <= files().keys()


def test_constraints_and_cascade(spark, tmp_path):
    from hirelens.operators.keys import delete_cascade, duplicate_keys, missing_values, orphans, write_placed
    jobs = spark.createDataFrame([(i, f"u{i % 7}" if i else None, None if i == 3 else "t") for i in range(12)], "id long, url string, title string")
    assert {r["url"]: r["n"] for r in duplicate_keys(jobs, "url").collect()} == {f"u{k}": 2 for k in range(1, 5)}
    assert [tuple(r) for r in missing_values(jobs, "id", "title", "url").orderBy("column").collect()] == [("title", 1), ("url", 1)]
    skills = spark.createDataFrame([(i % 15, f"s{i}") for i in range(60)] + [(None, "none")], "job long, skill string")
    assert {r["job"] for r in orphans(skills, "job", jobs, "id").collect()} == {12, 13, 14}
    a, b = str(tmp_path / "jobs"), str(tmp_path / "skills")
    write_placed(jobs, a, "id", 4)
    write_placed(skills, b, "job", 4)
    delete_cascade(spark, a, "id", {b: "job"}, spark.createDataFrame([(i,) for i in (0, 1, 2, 99)], "id long"), 4)
    assert sorted(r["id"] for r in spark.read.parquet(a).collect()) == list(range(3, 12))
    left = spark.read.parquet(b).collect()
    assert {r["job"] for r in left} == {None, *range(3, 15)} and len(left) == 61 - 12
    delete_cascade(spark, a, "id", {b: "job"}, spark.read.parquet(a).select("id").where("id < 11"), 4)  # partitions that go whole
    assert [r["id"] for r in spark.read.parquet(a).collect()] == [11]


def test_sketches_merge_within_two_percent(spark):
    from hirelens.operators.quality import distinct_sketches, merged_sketches
    df = spark.range(300_000).select((F.col("id") % 4).cast("string").alias("part"), F.concat(F.lit("c"), F.col("id") % 120_000).alias("name"),
                                     F.when(F.col("id") % 3 > 0, F.col("id") % 50).cast("string").alias("few"))
    s = distinct_sketches(df, "part", {"names": "name", "few": "few"})
    one = merged_sketches(s, ["names", "few"]).first()
    assert one["n"] == 300_000 and abs(one["names"] - 120_000) <= 0.02 * 120_000 and one["few"] == 50
    for r in merged_sketches(s, ["names"], "part").collect():
        assert abs(r["names"] - 30_000) <= 600


# ------------------------------------------------------ cards, dictionary

def test_cards_follow_the_tag_tree():
    from hirelens.sources.html import page_cards
    page = """<div class=list><div class="job-card"><div class="job-info"><div class="jname"><div>A</div> <br/>&amp; <b>B</b></div><img src='a>b'></div>
      <p class="com"><span>Co<p>unclosed</div><div class="area">not in a card</div>
      <DIV CLASS='x job-card'><div class="name"> <!-- <div class="name">no</div> --></div><i class="title">T</i><div class="job-card"><u class="sal">1-2K</u></div>
      <div class="area">Z</div></DIV><div class="job-card"><span class="sal">never closed<div class="job-card"><b class="title">last</b>"""
    got = page_cards(page, "job-card")
    assert [c["job_title"] for c in got] == ["A & B", "T", "", "last"]
    assert [c["salary_text"] for c in got] == ["", "1-2K", "never closed", ""]
    assert [c["city"] for c in got] == ["", "Z", "", ""] and got[0]["company_name"] == "Co unclosed"
    assert page_cards("", "job-card") == [] and page_cards("<a><", "job-card") == [] and page_cards("<!-- <div class='job-card'>", "job-card") == []


def test_dictionary_of_ten_thousand_words(spark):
    from hirelens.functions.skills import GramIndex, with_dictionary_hits
    rng = random.Random(6)
    words = list({"".join(rng.choice("abcdeXé数据") for _ in range(rng.randrange(2, 7))) for _ in range(12_000)})[:10_000]
    texts = ["".join(rng.choice("abcdexé数据 ") for _ in range(rng.randrange(0, 300))) for _ in range(40)] + ["", "a"]
    index = GramIndex(words)
    for t in texts:
        assert index.find(t) == [w for w in words if w.lower() in t]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "id long, low string")
    got = {r["id"]: r["hits"] for r in with_dictionary_hits(df, "low", "hits", words[:500]).collect()}
    assert got[99] is None and all(got[i] == [w for w in words[:500] if w.lower() in t] for i, t in enumerate(texts))
