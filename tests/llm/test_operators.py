"""Each operator against a brute-force version, on small tables."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import edge

WORDS = [f"w{i}" for i in range(30)]


def text_rows(seed, n=40, passages=4):
    """Documents with shared passages, copies and near copies."""
    rng = random.Random(seed)
    shared = [[rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(35)] for _ in range(passages)]
    rows = []
    for i in range(n):
        words = [rng.choice(WORDS) + str(rng.randrange(300)) for _ in range(rng.randrange(3, 120))]
        if rng.random() < 0.5:
            at = rng.randrange(len(words))
            words[at:at] = rng.choice(shared)[rng.randrange(6):]
        rows.append((i * 3, " ".join(words), rng.choice("abc")))
    rows += [(1000 + i, rows[i][1], "a") for i in range(5)]
    rows += [(2000 + i, rows[i][1].replace(" ", "\n", 3) + " more", "a") for i in range(5)]
    rng.shuffle(rows)
    return rows


# ------------------------------------------------------------------ 2

def brute_windows(rows, k):
    seen, out = set(), []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for r in order:
        words = (r[1] or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - k + 1):
            key = tuple(words[i:i + k])
            if key in seen:
                gone[i:i + k] = [True] * k
            seen.add(key)
        out.append((r[0], len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("case", ["shared", "edge", "empty", "tight"])
def test_substrings(spark, case):
    from hirelens.llm.substrings import dedup_windows
    rows = {"shared": text_rows(1), "edge": [r for r in edge.nasty() if r[0] != 10 or True], "empty": [], "tight": text_rows(2)}[case]
    options = {"cells": 1, "depth": 1, "block_bytes": 2000} if case == "tight" else {}
    got = [tuple(r) for r in dedup_windows(edge.docs(spark, rows), words=20, **options).collect()]
    assert sorted(got, key=repr) == brute_windows(rows, 20)


def test_sorted_lists_survive_coding():
    from hirelens.llm.substrings import pack_sorted, unpack_sorted
    rng = np.random.default_rng(1)
    for top in (2, 300, 1 << 20, 1 << 62):
        x = np.unique(rng.integers(0, top, 500).astype(np.uint64))
        assert unpack_sorted(pack_sorted(x)).tolist() == x.tolist()
    assert len(unpack_sorted(pack_sorted(np.zeros(0, np.uint64)))) == 0


# ------------------------------------------------------------------ 3

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id long, v string, component string")


def brute_links(rows, cosine):
    ok = {}
    for r in rows:
        e = r[1]
        if r[0] is not None and e and len(e) == 8 and all(x is not None and np.isfinite(x) for x in e) and any(e):
            v = np.array(e, np.float32).astype(float)
            ok[r[0]] = v / np.linalg.norm(v)
    ids = sorted(ok)
    x = np.array([ok[i] for i in ids])
    hit = x @ x.T >= cosine if len(ids) else np.zeros((0, 0), bool)
    root = {i: i for i in ids}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i in range(len(ids)):
        for j in range(i):
            if hit[i, j]:
                a, b = find(ids[i]), find(ids[j])
                root[max(a, b)] = min(a, b)
    n = {i: int(hit[k].sum()) - 1 for k, i in enumerate(ids)}
    return {r[0]: (n.get(r[0], 0), find(r[0]) if r[0] in root else r[0]) for r in rows}


def test_embeddings(spark):
    from hirelens.llm.embeddings import near_duplicates
    rng = np.random.default_rng(4)
    rows = []
    for g in range(12):  # groups of near copies, some loose, so that balls are split and pairs are decided one by one
        centre = rng.standard_normal(8)
        for _ in range(int(rng.integers(1, 40))):
            e = centre + rng.standard_normal(8) * rng.choice([0.0, 0.05, 0.13]) * np.linalg.norm(centre) / 2.8
            rows.append((len(rows) * 2 + 1, [float(v) for v in e], g, 5, "x", "y"))
    rows += [(9001, None, 0, 1, "", ""), (9002, [0.0] * 8, 0, 1, "", ""), (9003, [float("nan")] * 8, 0, 1, "", ""),
             (9004, [1.0] * 7 + [None], 0, 1, "", ""), (9005, [1.0, 2.0], 0, 1, "", ""), (9006, [], 0, 1, "", ""),
             (None, [1.0] * 8, 0, 1, "", ""), rows[0], (9007, [3.0 * v for v in rows[0][1]], 0, 1, "", "")]
    want = brute_links(rows, 0.95)
    got = near_duplicates(vectors(spark, rows)).collect()
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got)
    assert found <= sum(want[r["vec_id"]][0] for r in got)  # none below the threshold
    assert found >= 0.9 * sum(want[r["vec_id"]][0] for r in got)
    for r in got:
        assert r["n_links"] <= want[r["vec_id"]][0]
        assert r["kept"] == (r["vec_id"] == r["component_id"])
    assert sum(r["component_id"] != want[r["vec_id"]][1] for r in got) <= 0.05 * len(got)


def test_embeddings_equal_directions_are_one_node(spark):
    """Copies and scaled copies, more groups in a bucket than there are rounds."""
    from hirelens.llm import embeddings as E
    rng = np.random.default_rng(5)
    base = rng.standard_normal((10, 16))
    rows = [(10 * k + g, [float(v) for v in base[g] * (1 + k)]) for k in range(6) for g in range(10)]
    units = E._units(vectors(spark, [(*r, 0, 1, "", "") for r in rows]), "vec_id", "embedding")
    members, nodes = E._balls(units, math.acos(0.95), 11)
    assert sorted((r["id"], r["size"]) for r in nodes.collect()) == [(g, 6) for g in range(10)]
    assert members.count() == 50


def test_embeddings_empty(spark):
    from hirelens.llm.embeddings import near_duplicates
    assert near_duplicates(vectors(spark, [])).collect() == []
    lone = near_duplicates(vectors(spark, [(3, None, 1, 1, "", ""), (4, [1.0], 1, 1, "", "")])).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in lone) == [(3, 0, 3, True), (4, 0, 4, True)]


def test_embeddings_audit_sees_lost_pairs(spark):
    """A huge group of copies and rare links do not hide what is not found."""
    from hirelens.llm import embeddings as E
    rng = np.random.default_rng(8)
    rows = [(i, [1.0] * 16) for i in range(600)]
    for i in range(150):  # pairs beyond half the angle, so that no ball joins them
        e = rng.standard_normal(16)
        o = rng.standard_normal(16)
        o -= e * (o @ e) / (e @ e)
        a = 0.25
        rows += [(1000 + 2 * i, e.tolist()), (1001 + 2 * i, (e * np.cos(a) + o * np.sin(a) * np.linalg.norm(e) / np.linalg.norm(o)).tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = {r["vec_id"]: r["n_links"] for r in E.near_duplicates(table).collect()}
    assert all(out[i] == 599 for i in range(600))
    assert sum(out[1000 + i] >= 1 for i in range(300)) >= 0.95 * 300

    units = E._units(table, "vec_id", "embedding")
    members, nodes = E._balls(units, np.arccos(0.95), 11)
    free = nodes.select("id", "size").join(members.groupBy("center").count(), F.col("id") == F.col("center"), "left") \
        .select("id", F.coalesce("count", F.lit(0)).alias("n"))
    recall, enough = E._audit(nodes, units, free, 0.95)
    assert recall < 0.05 and enough


def test_embeddings_of_two_lengths(spark):
    from hirelens.llm.embeddings import near_duplicates
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for length, many in ((8, 40), (12, 25), (1, 2)):
        for _ in range(many):  # a copy, a scaled copy and a near copy
            e = rng.standard_normal(length) if length > 1 else np.array([1.0])
            group = range(len(rows), len(rows) + 4)
            rows += [(i, v.tolist()) for i, v in zip(group, (e, e, 3 * e, e + 0.02 * rng.standard_normal(length)))]
    unit = {i: np.array(e) / np.linalg.norm(e) for i, e in rows}
    for i, x in unit.items():
        want[i] = sum(j != i and len(y) == len(x) and x @ y >= 0.95 for j, y in unit.items())
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == want
    assert all(r["component_id"] // 4 == r["vec_id"] // 4 or r["vec_id"] >= 260 for r in got) and min(want.values()) >= 3


def test_embeddings_of_one_id(spark):
    """Rows with one id and different vectors are vectors of their own."""
    from hirelens.llm.embeddings import near_duplicates
    x, y, z = ([float(i == k) for i in range(8)] for k in range(3))
    rows = [(1, x), (1, y), (2, x), (3, y), (3, y), (4, z), (None, x)]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), cosine=0.95).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, 0, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (3, 1, 1, False), (4, 0, 4, True)]


def test_embeddings_fail_below_the_goal(spark, monkeypatch):
    from hirelens.llm import embeddings as E
    monkeypatch.setattr(E, "_audit", lambda *a: (0.5, True))
    monkeypatch.setattr(E, "ATTEMPTS", 2)
    with pytest.raises(RuntimeError, match="recall 0.500"):
        E.near_duplicates(vectors(spark, [(i, [float(i), 1.0], 0, 1, "", "") for i in range(6)])).collect()


# ------------------------------------------------------------------ 4

def brute_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    trios = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = set()
    for i, t in enumerate(trios):
        if trios.count(t) > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


def test_quality_stats_and_verdict(spark):
    from hirelens.llm.quality import judge
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(240):
        words = [rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(rng.randrange(55, 90))]
        bad = i % 3 == 0
        if bad:
            words = [w + "###" for w in words]
        rows.append((i, "\n".join([" ".join(words), "same line\nsame line"])))
        labels.append((i, 0 if bad else 1, 0))
    rows += [(1000 + k, t) for k, (_, t, *_) in enumerate(r for r in edge.nasty() if r[1] is None or len(r[1]) < 10000)]
    labels += [(None, 1, 0), (3, None, 0), (5, 0, 1), (5, 1, 1)]
    out = judge(edge.docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    text = dict(rows)
    assert len(out) == len(rows)
    for r in out:
        stats = brute_stats(text[r["id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == stats
        assert r["base_failed"] == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        if r["id"] < 1000:
            assert r["kept"] == (r["id"] % 3 != 0)
        assert r["kept"] or r["base_failed"] or r["rule"] is not None


def test_quality_without_labels(spark):
    from hirelens.llm.quality import judge, keep_good
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = edge.docs(spark, text_rows(3, 10))
    out = judge(docs, none).collect()
    assert all(r["kept"] == (not r["base_failed"]) for r in out)
    kept = keep_good(docs, none)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["id"] for r in out if r["kept"])
    assert judge(edge.docs(spark, []), none).collect() == [] and keep_good(edge.docs(spark, []), none).collect() == []


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_rules_of_the_given_labels(spark, sf):
    """The list is not empty, its CASE says what its conditions say, and it
    catches bad documents that the base lets through without the good ones."""
    from hirelens.llm import quality as Q
    folder = f"/root/testdata/{sf}"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    stats = Q.text_stats(spark.read.parquet(f"{folder}/documents.parquet")).cache()
    marks = Q.labelled_sample(labels, 20_000)
    rules = Q.fit(stats, marks)
    assert rules and all(r.covered >= 5 for r in rules)
    names = list(Q.FEATURES)
    got = stats.join(marks, stats["id"] == marks["doc_id"]).select(
        "quality", Q.base_failed().alias("base"), Q.verdict(rules).alias("keep"), Q.rule_number(rules).alias("rule"),
        *[Q.feature(f).alias(f) for f in names]).toPandas()
    x, rest, number = got[names].to_numpy(float), np.ones(len(got), bool), np.zeros(len(got))
    for i, r in enumerate(rules, 1):
        hit = Q._holds(x, names, r.conditions) & rest
        number[hit] = i
        rest &= ~hit
    assert (got["keep"].to_numpy() == rest).all() and (got["rule"].fillna(0).to_numpy() == number).all()
    bad, passes = got["quality"].to_numpy() == 0, ~got["base"].to_numpy()
    assert (bad & passes & ~rest).sum() >= 0.9 * (bad & passes).sum() and (~bad & passes & ~rest).sum() <= 0.01 * (~bad).sum()
    stats.unpersist()


def test_a_missed_rule_does_not_end_the_list():
    from hirelens.llm.quality import learn_rules
    rng = np.random.default_rng(3)
    x = rng.random((400, 3))
    y = (x[:, 0] > 0.95) | (x[:, 1] > 0.55) & (rng.random(400) < 0.5)  # the second kind is never precise enough
    rules = learn_rules(x, y, ["words", "chars_per_word", "symbols_per_word"])
    assert any(c[0] == "words" for r in rules for c in r.conditions) and all(r.wrong <= 0.02 * r.covered for r in rules)


def test_rules_are_ordered_conditions():
    from hirelens.llm.quality import learn_rules
    rng = np.random.default_rng(1)
    x = rng.random((900, 2))
    y = ((x[:, 0] > 0.7) & (x[:, 1] <= 0.5)) | (x[:, 0] <= 0.1)
    rules = learn_rules(x, y, ["words", "chars_per_word"])
    assert 2 <= len(rules) <= 12 and all(r.covered >= 10 for r in rules)
    said = " ".join(map(str, rules))
    assert "words >" in said and "words <=" in said


# ------------------------------------------------------------------ 5

def brute_fingerprint(text):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    votes = [0] * 64
    for i in range(n):
        h = xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if votes[b] * 2 > n)


@pytest.mark.parametrize("case", ["shared", "edge", "empty"])
def test_simhash(spark, case):
    from hirelens.llm.simhash import keep_first, near_duplicates
    rows = {"shared": text_rows(5), "edge": edge.nasty(), "empty": []}[case]
    docs = edge.docs(spark, rows)
    fps = [(r[0], brute_fingerprint(r[1])) for r in rows]
    nodes = sorted({f for _, f in fps})
    root = {f: f for f in nodes}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for i, f in fps:
        if i is not None:
            least[find(f)] = min(i, least.get(find(f), i))
    want = sorted(((i, f, least.get(find(f))) for i, f in fps), key=repr)
    got = sorted(((r["id"], r["fp"] % (1 << 64), r["component"]) for r in near_duplicates(docs).collect()), key=repr)
    assert got == want
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({i for i, _, c in want if i is not None and i == c})
    # a row without an id stays only where its group has no other
    assert ids.count(None) == len({find(f) for _, f in fps if find(f) not in least})


def test_keep_first_decides_by_row(spark):
    from hirelens.llm.simhash import keep_first
    a, b, c = (" ".join(f"{k}{i * i % 89}" for i in range(200)) for k in "abc")
    # 5 loses to 1 with text a; with text b it is the first of its group; 9 has two texts that both stay
    rows = [(1, a), (5, a), (5, b), (6, b), (8, b), (9, c), (9, "quite another text, " + c[::-1]), (9, c)]
    got = keep_first(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted([(1, a), (5, b), (9, c), (9, "quite another text, " + c[::-1])])


def test_multi_index_finds_every_pair(spark):
    from hirelens.llm.simhash import linked
    rng = random.Random(9)
    base = [rng.getrandbits(64) for _ in range(15)]
    fps = set(base)
    for f in base:
        for _ in range(12):
            fps.add(f ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    for most in (0, 1, 3, 5):
        got = {(r["a"], r["b"]) for r in linked(spark.createDataFrame([((f + (1 << 63)) % (1 << 64) - (1 << 63),) for f in fps], "fp long"), most).collect()}
        signed = sorted((f + (1 << 63)) % (1 << 64) - (1 << 63) for f in fps)
        want = {(a, b) for i, b in enumerate(signed) for a in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= most}
        assert got == want


# ------------------------------------------------------------------ 6

def test_urls(spark):
    from hirelens.llm.urls import judge
    rng = random.Random(3)
    labels = ["com", "net", "example", "www", "a", "b", "co", "Ex"]
    rules = {(".".join(rng.choice(labels) for _ in range(rng.randrange(1, 4))), rng.choice(["/", "/x/", "/x/y", "/y", ""])): rng.choice(["allow", "block"])
             for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()] + [(None, "/", "block"), ("", "/", "block"), ("net", "/", "block"), ("net", "/", "allow")]
    urls = [f"http{rng.choice(['', 's'])}://{'.'.join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))}"
            f"{rng.choice(['', '/', '/x/', '/x/y?q=1', '/y#z', '?x', '#f', '/é/'])}" for _ in range(400)]
    urls += [None, "", "no scheme/x", "http://", "://com/x", "http://com:80/x", "http://a.com." , "http://com/" + "x/" * 5000] + ["http://net/"] * 50
    rows = [(i if i % 50 else None, u, "h", "x", "y") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string, key string").repartition(4)
    got = judge(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()

    def one(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group().translate({i: i + 32 for i in range(65, 91)})
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        best = None
        for h, p, v in rules:
            h = (h or "").translate({i: i + 32 for i in range(65, 91)})
            if h and (host == h or host.endswith("." + h)) and path.startswith(p):
                k = (len(h) + len(p), len(h), v == "block", h + p, v)
                best = max(best, k) if best else k
        return host, path, best and best[3], best[4] if best else "allow"
    want = sorted(((i, *one(u)) for i, u, *_ in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want
    assert judge(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string")).collect() == []


# ------------------------------------------------------------------ 7

def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    left = total
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        free -= over
    return target


@pytest.mark.parametrize("case", ["shared", "edge", "empty"])
def test_mixing(spark, case):
    from hirelens.llm.mixing import mix, mixed
    rows = {"shared": text_rows(7, 60) + [(5000, "one two", None)], "edge": edge.nasty(), "empty": []}[case]
    docs = edge.docs(spark, rows)
    out = mix(docs).collect()
    assert len(out) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len((r[1] or "").encode().split())
    target = brute_targets(sizes)
    taken = {}
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for s, t in taken.items():
        assert abs(t - target[s]) <= 3  # words cut off where rows share one id
    again = mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, out), key=repr)
    whole = mixed(docs)
    assert whole.columns == docs.columns
    got = {}
    for r in whole.collect():
        got[r["source"]] = got.get(r["source"], 0) + len((r["text"] or "").encode().split())
    for s, t in target.items():
        largest = max(len((r[1] or "").encode().split()) for r in rows if r[2] == s)
        assert abs(got.get(s, 0) - t) <= 2 * largest + 1


# ------------------------------------------------------------------ 8

@pytest.mark.parametrize("case", ["shared", "edge", "empty", "one"])
def test_packing(spark, case):
    from hirelens.llm.packing import pack
    from hirelens.llm.queries import END_ID, tokenizer_path
    from tokenizers import Tokenizer
    path = tokenizer_path("word_bpe_49k.json")
    special = [(70, "a <|endoftext|> b<|startoftext|>", "s"), (71, "<|endoftext|>", "s")]
    rows = {"shared": text_rows(8, 80), "edge": edge.nasty() + special, "empty": [], "one": [(1, "a b c d e", "s")]}[case]
    packed = pack(edge.docs(spark, rows), path, END_ID)
    placed = packed.placed.collect()
    enc = Tokenizer.from_file(path)
    want = sorted((repr(r[0]), np.array([*enc.encode(r[1] or "", add_special_tokens=False).ids, END_ID], "<u4").tobytes()) for r in rows)
    sequences = {r["sequence_id"]: r for r in packed.sequences().collect()}
    by_seq, by_doc = {}, {}
    for r in placed:
        by_seq.setdefault(r["sequence_id"], []).append(r)
        ids = bytes(sequences[r["sequence_id"]]["ids"])[4 * r["offset"]:4 * (r["offset"] + r["length"])]
        import zlib
        assert zlib.crc32(ids) == r["ids_crc32"]
        by_doc.setdefault((repr(r["doc_id"]), r["doc_tokens"]), []).append((r["start"], ids))
    padding = tokens = 0
    for s, pieces in by_seq.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at == sequences[s]["n_tokens"] <= 4096
        tokens += at
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    assert tokens == sum(len(b) for _, b in want) // 4
    got = []
    for (doc, n), parts in by_doc.items():
        copies = sum(1 for s, _ in parts if s == 0)
        by_start = {}
        for s, ids in parts:
            by_start.setdefault(s, []).append(ids)
        if copies == 1:
            got.append((doc, b"".join(ids[0] for _, ids in sorted(by_start.items()))))
            assert sum(len(x) for _, x in parts) == 4 * n
    singles = [w for w in want if sum(w[0] == x[0] and len(w[1]) == len(x[1]) for x in want) == 1]
    assert sorted(got) == singles
    if case == "shared":
        assert padding <= 0.1 * tokens
    if case == "one":
        assert padding == 0  # cut at powers of two


def test_column_generation_beats_first_fit():
    from hirelens.llm.packing import whole_patterns
    rng = np.random.default_rng(2)
    lengths = np.minimum(rng.lognormal(4, 1, 20000).astype(int) + 1, 512)
    size, need = np.unique(lengths, return_counts=True)
    patterns = whole_patterns(size, need, 512)
    used = {}
    for often, copies in patterns:
        assert sum(c * n for c, n in copies.items()) <= 512
        for c, n in copies.items():
            used[c] = used.get(c, 0) + often * n
    assert used == dict(zip(size.tolist(), need.tolist()))
    assert sum(o for o, _ in patterns) <= 1.01 * lengths.sum() / 512 + 3


# ------------------------------------------------------------------ 9

def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i:] == b[i + 1:]


def brute_lines(rows):
    order = sorted({r[0]: r for r in rows}.values(), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = {}, {}
    for r in order:
        if r[1] is None:
            out[r[0]] = None
            continue
        kept = []
        for line in r[1].split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                gone = line in seen or len(line) >= 20 and any(len(x) >= 20 and within_one(x, line) for x in seen)
                seen[line] = True
                if gone:
                    continue
            kept.append(line)
        out[r[0]] = "\n".join(kept)
    return out


def line_rows(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(5, 45))) + "x" for _ in range(40)]

    def edit(x):
        i = rng.randrange(len(x))
        return rng.choice([x[:i] + x[i + 1:], x[:i] + "z" + x[i:], x[:i] + "y" + x[i + 1:]])
    rows = []
    for i in range(50):
        lines = []
        for _ in range(rng.randrange(1, 9)):
            line = rng.choice(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                line = edit(line)
            lines.append(line)
        rows.append((rng.randrange(10000) * 50 + i, "\n".join(lines + rng.choice([[], [""], [" "]]))))
    return rows


@pytest.mark.parametrize("case", ["lines", "more", "edge", "empty"])
def test_lines(spark, case):
    from hirelens.llm.lines import dedup_lines
    rows = {"lines": line_rows(1), "more": line_rows(2), "empty": [],
            "edge": [r for r in edge.nasty() if r[0] is not None] + [(None, "a line that is long enough, too")]}[case]
    docs = edge.docs(spark, rows)
    out = dedup_lines(docs)
    assert out.columns == docs.columns + ["__n_lines", "__n_removed"]
    want, text = brute_lines(rows), dict((r[0], r[1]) for r in rows)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == want[r["doc_id"]], r["doc_id"]
        n = 0 if text[r["doc_id"]] is None else text[r["doc_id"]].count("\n") + 1
        assert r["__n_lines"] == n


def test_lines_of_repeated_and_null_ids(spark):
    from hirelens.llm.lines import dedup_lines
    same = "the very same line in two rows"
    rows = [(None, same + "\nonly the first row has this one"), (None, same + "\nnothing like it stands anywhere else"),
            (None, "a line without a second, of its own\n" + same), (7, "short\n" + same + "!"), (7, "short\nthe other text of seven, alone"),
            (8, "the other text of seven, alonf\nlast"), (8, "the other text of seven, alonf\nlast"), (8, "last\nand not least, eight again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hashed = {r["text"]: r["h"] for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]]))
    want = brute_lines([(i, r[1]) for i, r in enumerate(order)])
    got = sorted(((r["doc_id"], r["text"]) for r in dedup_lines(docs).collect()), key=repr)
    assert got == sorted(((r[0], want[order.index(r)]) for r in rows), key=repr)


@pytest.mark.parametrize("spelled", [0, 24, 30])
def test_long_lines_are_spelled_alike(spark, spelled, monkeypatch):
    """Variants put together from hashes find what spelled ones find, on both
    sides of the length where one takes over from the other."""
    from hirelens.llm import lines as L
    monkeypatch.setattr(L, "SPELLED_CHARS", spelled)
    monkeypatch.setattr(L, "PIECE", 7)
    rows = line_rows(5)
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(edge.docs(spark, rows)).collect()}
    assert got == brute_lines(rows)


def test_a_very_long_line(spark):
    import time

    from hirelens.llm.lines import dedup_lines
    rng = random.Random(1)
    line = "".join(rng.choice("abcdefgh ") for _ in range(150_000))
    rows = [(1, line), (2, line[:90_000] + line[90_001:]), (3, line[:5] + "z" + line[6:]), (4, line[:20_000] + "zz" + line[20_002:])]
    t = time.time()
    got = {r["doc_id"]: len(r["text"]) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 150_000, 2: 0, 3: 0, 4: 150_000} and time.time() - t < 60


def test_shorter_lines_on_request(spark):
    from hirelens.llm.lines import dedup_lines
    docs = spark.createDataFrame([(1, "Share this page\nChapter 1"), (2, "Share this page!\nChapter 2\nChapter 1")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in dedup_lines(docs).collect()}[2] == "Share this page!\nChapter 2"
    assert {r["doc_id"]: r["text"] for r in dedup_lines(docs, near_chars=12).collect()}[2] == "Chapter 2"


# ------------------------------------------------------------------ 1

def test_licence_rows_are_judged_by_their_text(spark):
    from hirelens.llm.license_texts import KNOWN
    from hirelens.llm.licenses import scan
    mit = KNOWN[0][1]
    rows = [(None, "hello"), (None, "Released under the MIT License"), (7, "other"), (7, "Released under the MIT License\nx"), (7, None), (7, "other"),
            (8, "a b\nc"), (8, "Copyright Jane Doe\n" + mit)]
    got = sorted((r["doc_id"] or 0, r["line_licenses"], r["license"] or "") for r in scan(edge.docs(spark, rows)).collect())
    assert [g for g in got if g[0] < 8] == [(0, "", ""), (0, "MIT", "MIT"), (7, "", ""), (7, "", ""), (7, "", ""), (7, "MIT", "")]
    known = spark.createDataFrame([("MIT", mit), ("words", "Released\nunder the MIT License")], "license string, text string")
    loose = {r["digest"]: r["license"] for r in scan(edge.docs(spark, rows), known, any_holder=True).where("doc_id = 8").collect()}
    assert "MIT" in loose.values()


def test_licenses(spark):
    from hirelens.llm.license_texts import KNOWN
    from hirelens.llm.licenses import known_licenses, scan
    mit, bsd = KNOWN[0][1], KNOWN[5][1]
    rows = [
        (1, mit), (2, mit.upper().replace("\n", "  \r\n")), (3, "Copyright (c) 2019 A. Person\n" + mit + "\nAll rights reserved."),
        (4, bsd.replace("holder", "owner").replace("1.", "(1)")), (5, mit + " and more"), (6, None), (7, ""), (8, "#$%\n..."),
        (9, "Some prose.\nLicenced under the Apache Licence, Version 2.0!\nRELEASED UNDER THE MIT LICENSE"), (9, None),
        (None, mit), (10, "word " * 50000), (11, "© 2020 B\n(c) C\n" + bsd)]
    got = scan(edge.docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    one = lambda k: by[k][0]
    assert [one(k)["license"] for k in (1, 2, 3, 4, 5, None, 11)] == ["MIT", "MIT", "MIT", "BSD-3-Clause", None, "MIT", "BSD-3-Clause"]
    assert one(6)["digest"] is None and one(7)["digest"] == one(8)["digest"] == hashlib.sha256(b"").hexdigest()
    assert one(8)["license"] is None and sorted(r["line_licenses"] for r in by[9]) == ["", "Apache-2.0,MIT"]  # the other row of 9 has no text
    assert scan(edge.docs(spark, [])).collect() == []
    assert scan(edge.docs(spark, rows), known_licenses(spark).limit(0)).where("license IS NOT NULL").count() == 0
    plan = scan(edge.docs(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_whole_licences_and_notices(spark):
    from pathlib import Path

    from hirelens.llm.licenses import scan
    whole = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    texts = {k: (Path("/usr/share/common-licenses") / k).read_text() for k in whole}
    apache = texts["Apache-2.0"]
    notices = {"Licensed under CC BY-SA 4.0.": "CC-BY-SA-4.0", "Released under the Mozilla Public License, Version 2.0.": "MPL-2.0",
               "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
               "Licensed under the GNU Lesser General Public Licence, version 3.": "LGPL-3.0", "Licensed under the BSD 3-Clause License.": "BSD-3-Clause"}
    rows = [(i, t) for i, t in enumerate([*texts.values(), apache[:apache.index("APPENDIX")], *notices])]
    got = {r["doc_id"]: r for r in scan(edge.docs(spark, rows)).collect()}
    assert [got[i]["license"] for i in range(len(rows))] == [*whole.values(), "Apache-2.0", *notices.values()]


# ----------------------------------------------------------------- pipeline

def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as C
    from conftest import SF_SMALL
    from hirelens.llm.common import written
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for name, stage in C.STAGES:
        out = written(stage(spark, docs, SF_SMALL), name)
        after = out.collect()
        if name == "packing":
            assert {r["doc_id"] for r in after} == {r[0] for r in rows}
            break
        assert out.columns == columns
        kept = [(r["doc_id"], r["text"]) for r in after]
        if name == "quality_rules":
            for i, text in set(rows) - set(kept):
                s = brute_stats(text)
                assert s[0] < 50 or 2 * s[4] > s[0] or s[2] > 0 or s[3] > 0, i
            assert set(kept) <= set(rows) and len(kept) > 0.7 * len(rows)
        elif name == "line_dedup":
            assert dict(kept) == brute_lines(rows)
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "simhash_dedup":
            fp = {i: brute_fingerprint(t) for i, t in rows}
            left = {i for i, _ in kept}
            for i, f in fp.items():
                assert i in left or any((f ^ fp[j]).bit_count() <= 3 for j in fp if j < i)
        elif name == "source_mix":
            assert set(kept) <= set(rows) and max(kept.count(k) for k in set(kept)) <= 3
        docs, rows = out, kept
    assert C.run(spark, SF_SMALL).columns == C.PACK_COLUMNS


def test_pipeline_of_nasty_rows(spark):
    """Nulls, empty and long texts, repeats, ids that are missing or shared, and
    columns with names that the stages use go through all stages."""
    import corpus_pipeline as C
    from hirelens.llm.common import written
    rows = edge.nasty() + [(None, " ".join(f"n{i * i % 401}" for i in range(120)), "d")] * 2 + [(None, " ".join(f"m{i * 7 % 311}" for i in range(90)), "d")]
    docs = edge.docs(spark, rows)
    for c in ("__id", "__h", "__n_lines", "__n_removed", "__copy", "root", "first", "own", "lost", "hit_id"):
        docs = docs.withColumn(c, F.lit("kept"))
    columns = docs.columns
    for name, stage in C.STAGES:
        out = written(stage(spark, docs, "/root/testdata/sf0.001"), name)
        got = out.collect()
        if name == "packing":
            assert {r["doc_id"] for r in got} == {r["doc_id"] for r in docs.collect()} and None in {r["doc_id"] for r in got}
            break
        assert out.columns == columns and got and all(r["__h"] == "kept" and r["__n_lines"] == "kept" for r in got)
        if name == "simhash_dedup":
            assert sum(r["doc_id"] is None for r in got) == 2  # of two equal rows one is left
            assert len(got) == len({(r["doc_id"], r["text"]) for r in got})
        docs = out


def test_pipeline_of_an_empty_table(spark, tmp_path):
    import corpus_pipeline as C
    for t in ("documents", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert C.run(spark, str(tmp_path)).collect() == []


def test_mix_draws_rows_without_an_id_apart(spark):
    from hirelens.llm.mixing import mixed
    rows = [(None, f"one two three {i}", "a") for i in range(100)] + [(None, f"four five six {i}", "b") for i in range(100)]
    got = [r["source"] for r in mixed(edge.docs(spark, rows)).collect()]
    assert 60 <= got.count("a") <= 74 and 126 <= got.count("b") <= 140  # a third and two thirds of all


def test_embeddings_dense_regions_are_decided_without_lists(spark, monkeypatch):
    """Groups of vectors that all link, larger than any list: some tight (balls),
    some at the limit, with neighbours outside the group."""
    from hirelens.llm import embeddings as E
    rng = np.random.default_rng(6)
    wide, tight = rng.normal(0, 1, (2, 12))
    x = np.concatenate([rng.normal(0, 1, (60, 12)), wide + rng.normal(0, 0.22, (70, 12)), tight + rng.normal(0, 0.13, (60, 12)),
                        tight + rng.normal(0, 0.02, (12, 12)), wide + rng.normal(0, 0.4, (20, 12)), 3 * (wide + np.zeros((5, 12)))])
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    seen = {}

    def kept(df, name, inner=E.written):
        out = inner(df, name)
        if name in ("nn-k", "nn-dense-links"):
            seen.setdefault(name, []).append(out.collect())
        return out

    monkeypatch.setattr(E, "written", kept)
    for name, value in (("LIST_MOST", 8), ("REGION", 16), ("PIVOTS", 3)):
        monkeypatch.setattr(E, name, value)
    got = E.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.95).orderBy("vec_id").collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = u @ u.T >= 0.95
    np.fill_diagonal(hit, False)
    root = np.arange(len(x))
    while not ((now := np.minimum(root, np.where(hit, root[None, :], len(x)).min(axis=1))) == root).all():
        root = now
    assert [r["n_links"] for r in got] == hit.sum(axis=1).tolist() and [r["component_id"] for r in got] == root.tolist()
    assert max(r["k"] for rows in seen["nn-k"] for r in rows) == 8
    kinds = {r["kind"] for rows in seen["nn-dense-links"] for r in rows}
    dense = {r["a"] for rows in seen["nn-dense-links"] for r in rows if r["kind"] == 0}
    assert kinds >= {0, 1} and len(dense) > 40


def test_embeddings_dense_pairs_equal_all_pairs(spark, monkeypatch):
    """Balls and single nodes, dense and not, against all pairs."""
    from hirelens.llm import embeddings as E
    for name, value in (("REGION", 16), ("PIVOTS", 3)):
        monkeypatch.setattr(E, name, value)
    rng, angle = np.random.default_rng(8), float(np.arccos(0.95))
    x = np.concatenate([c + rng.normal(0, 0.2, (70, 8)) for c in rng.normal(0, 1, (3, 8))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = len(x)
    size = np.where(np.arange(n) % 5 == 0, 3, 1)
    radius = np.where(size > 1, rng.uniform(0, angle / 2, n), 0.0)
    dense = np.arange(n) % 70 < 40
    ids = [int(i) * 7 + 1 for i in range(n)]
    nodes = spark.createDataFrame([(i, v.tobytes(), float(r), int(s)) for i, v, r, s in zip(ids, x, radius, size)], "id long, v binary, radius double, size long")
    said = E._dense(nodes, spark.createDataFrame([(i,) for i, d in zip(ids, dense) if d], "id long"), angle, 0.95, 5).collect()
    cos = x @ x.T
    apart, wide = np.arccos(np.clip(cos, -1, 1)), radius[:, None] + radius[None, :]
    asked = (dense[:, None] | dense[None, :]) & ~np.eye(n, dtype=bool)
    alone = (size == 1)[:, None] & (size == 1)[None, :]
    hit = asked & np.where(alone, cos >= 0.95, apart + wide <= angle - 1e-9)
    unsure = asked & ~alone & ~hit & (apart <= angle + wide + 1e-9)
    links = dict.fromkeys(ids, 0)
    for r in said:
        if r["kind"] == 0:
            links[r["a"]] += r["na"]
    assert [links[i] for i in ids] == (hit @ size).tolist()
    pairs = [tuple(sorted((r["a"], r["b"]))) for r in said if r["kind"] == 2]
    assert len(pairs) == len(set(pairs)) and set(pairs) == {(ids[i], ids[j]) for i, j in zip(*np.nonzero(np.triu(unsure)))} and len(pairs) > 20

    def roots(edges):
        root = np.arange(n)
        while not ((now := np.minimum(root, np.where(edges, root[None, :], n).min(axis=1))) == root).all():
            root = now
        return root.tolist()
    joined, at = np.zeros((n, n), bool), {v: i for i, v in enumerate(ids)}
    for r in said:
        if r["kind"] == 1:
            joined[at[r["a"]], at[r["b"]]] = joined[at[r["b"]], at[r["a"]]] = True
    assert not (joined & ~np.eye(n, dtype=bool) & (np.array(roots(hit))[:, None] != np.array(roots(hit))[None, :])).any() and roots(joined) == roots(hit)
