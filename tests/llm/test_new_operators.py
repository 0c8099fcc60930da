"""Spelling variants, resampling and decontamination against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

import edge

UPPER = {i: i + 32 for i in range(65, 91)}


# ------------------------------------------------------------------ 11

def brute_words(rows, damage, chars, count):
    n = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate(UPPER)):
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= chars:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= count}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(n):
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def spelled_rows(seed):
    """Words with many variants: edits of a few stems, and anagrams."""
    rng = random.Random(seed)
    letters = "abcdeßéÿ×"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 12))) for _ in range(25)]
    words = []
    for s in stems:
        for _ in range(20):
            w = s
            for _ in range(rng.randrange(0, 3)):
                i = rng.randrange(len(w) + 1)
                w = rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i + 1:]]) or "a"
            words += [w] * rng.choice([1, 1, 2, 3, 9])
        words += ["".join(rng.sample(s, len(s)))] * 3
    words += ["a" * 3000] * 4 + ["a" * 2999 + "b"] * 8 + ["UPPERÉ", "upperÉ", "upperé"] * 3
    rng.shuffle(words)
    return [(i if i % 7 else None, rng.choice([" ", "1", "\n", "-"]).join(words[i * 20:(i + 1) * 20])) for i in range(len(words) // 20 + 1)]


@pytest.mark.parametrize("case", ["few", "crowded", "parts", "edge", "empty"])
def test_spelling(spark, case):
    from hirelens.llm.spelling import variant_groups
    rows = {"edge": edge.nasty() * 3, "empty": [], "crowded": spelled_rows(2)}.get(case, spelled_rows(1))
    options = {"few": {}, "crowded": {"hot_words": 3}, "parts": {"first": 2, "second": 3, "damage": 5}}.get(case, {})
    got = sorted(tuple(r) for r in variant_groups(edge.docs(spark, rows), **options).collect())
    assert got == brute_groups(brute_words(rows, options.get("damage", 97), 5, 3))
    assert case in ("empty", "edge") or sum(r[1] is not None for r in got) > 20


def test_signatures_are_shared_by_all_near_multisets():
    from hirelens.llm.spelling import signatures
    rng = random.Random(3)
    for first, second in ((1, 3), (1, 4), (1, 6), (2, 3), (3, 1)):
        for _ in range(200):
            w = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 9)))
            i = rng.randrange(len(w))
            o = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice("abcxyz") + w[i + 1:], w[::-1]])
            points = np.array([ord(c) for c in w + o], np.uint64)
            a, b = signatures(points, np.array([0, len(w), len(w) + len(o)]), first, second)
            assert (a == b).any()


def test_spelling_rejects_circles(spark):
    from hirelens.llm.spelling import variant_groups
    with pytest.raises(ValueError, match="circles"):
        variant_groups(edge.docs(spark, []), times=1)


# ------------------------------------------------------------------ 12

def words_of(text):
    return re.findall("[0-9a-z\u0080-\U0010FFFF]+", (text or "").translate(UPPER))


def brute_resample(rows, target, percent, least, runs=1, buckets=10000):
    def features(text):
        w = words_of(text)
        return [crc32(" ".join(w[i:i + n]).encode()) % buckets for n in range(1, runs + 1) for i in range(len(w) - n + 1)]
    s, t = Counter(), Counter()
    for r in rows:
        s.update(features(r[1]))
    for x in target:
        t.update(features(x))
    sa, ta = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (sa + buckets) / ((s[b] + 1) * (ta + buckets))))
    out = []
    for r in rows:
        f = features(r[1])
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(r[1]))])
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    n = len(fit) * percent // 100
    return out, fit[:n]


@pytest.mark.parametrize("case", ["plain", "runs", "edge", "ties", "empty"])
def test_resampling(spark, case, monkeypatch):
    from hirelens.llm import resampling as R
    monkeypatch.setattr(R, "RANGE_ROWS", 7)
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["Über", "straße", "X1"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60))), "s") for i in range(150)]
    if case == "edge":
        rows = edge.nasty()
    if case == "ties":  # a third of the rows are one row, and ids repeat with other texts
        rows = rows[:60] + [(None, rows[3][1], "s")] * 30 + [(7, "a b c " * 9, "s")] * 5 + [(7, "a b d " * 9, "s")] * 5
    if case == "empty":
        rows = []
    goal = ["w1 w2 w3 w4 w5", "über X1", None, ""]
    percent, least, runs = (35, 1, 3) if case == "runs" else (10, 20, 1) if case == "plain" else (40, 1, 1)
    target = spark.createDataFrame([(i, t, 1) for i, t in enumerate(goal)], "item_id long, text string, n_words int")
    got = [tuple(r) for r in R.resample(edge.docs(spark, rows), target, percent, least, runs=runs).collect()]
    every, drawn = brute_resample(rows, goal, percent, least, runs)
    assert sorted([r[:4] for r in got], key=repr) == sorted([tuple(r[:4]) for r in every], key=repr)
    ranked = sorted((r for r in got if r[4] is not None), key=lambda r: r[4])
    assert [r[4] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r[0], r[3]) for r in ranked] == [(r[0], r[3]) for r in drawn]


def test_resampling_without_a_target(spark):
    from hirelens.llm.resampling import resample
    none = spark.createDataFrame([], "item_id long, text string")
    rows = [(i, f"a b c d{i}") for i in range(20)]
    got = resample(edge.docs(spark, rows), none, percent=50, least_words=1).collect()
    assert sum(r["rank"] is not None for r in got) == 10
    assert sorted((r["doc_id"], r["weight"]) for r in got) == sorted((r[0], r[2]) for r in brute_resample(rows, [], 50, 1)[0])


def test_boundary_takes_exactly_the_first_rows(spark):
    from hirelens.llm.resampling import boundary
    rng = random.Random(1)
    rows = [(rng.choice([-3, 0, 5]), rng.choice([-2 ** 62, 0, 7, 2 ** 62]), i) for i in range(200)]
    table = spark.createDataFrame(rows, "a long, b long, c long").cache()
    for n in (1, 2, 77, 150, 199, 200):
        bounds = boundary(table, n, ["a", "b", "c"])
        assert sum(r[:len(bounds)] <= tuple(bounds) for r in rows) == n
    table.unpersist()


# ------------------------------------------------------------------ 13

def brute_leaks(rows, items, k):
    wins = defaultdict(set)
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - k + 1) if w else 0):
            wins[tuple(w[i:i + k])].add(item)
    out = []
    for i, text, *_ in rows:
        w = words_of(text)
        hit, met = set(), set()
        for n in {len(x) for x in wins}:
            for at in range(len(w) - n + 1):
                found = wins.get(tuple(w[at:at + n]))
                if found:
                    hit.update(range(at, at + n))
                    met |= found
        met = sorted(str(m) for m in met if m is not None)
        out.append((i, len(w), len(hit), len(met), hashlib.sha256(",".join(met).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def leaky(seed, one_word=True):
    """Items over a small vocabulary, some short, some sharing a passage, some
    repeated; documents with whole, partial and edged passages of them."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(25)]
    common = [rng.choice(vocabulary) for _ in range(14)]
    items = []
    for i in range(40):
        w = [rng.choice(vocabulary) for _ in range(rng.choice([2, 3, 5, 9, 10, 11, 25, 60]))]
        if i % 3 == 0:
            w[1:1] = common
        items.append((i * 7 if i % 9 else None, rng.choice([" ", ", ", "\n"]).join(w).title()))
    items += [items[3], (items[3][0], "another text of the same item " * 3), (900, None), (901, ""), (902, " .,! "), (903, "Éa ß")]
    if one_word:
        items.append((904, "Solo"))
    rows = []
    for i in range(60):
        w = [rng.choice(vocabulary) + rng.choice(["", "", "x"]) for _ in range(rng.randrange(5, 80))]
        for _ in range(rng.randrange(3)):
            item = words_of(rng.choice(items)[1])
            a = rng.randrange(len(item) + 1)
            at = rng.randrange(len(w))
            w[at:at] = item[a:a + rng.choice([9, 10, 12, 99])]
        rows.append((i if i % 11 else None, "-".join(w) if i % 2 else "  ".join(w).upper()))
    rows += [(500, "so SOLO it is"), (501, "éa ß Éa ß"), rows[3], (3, rows[5][1])]
    return rows, items


def item_table(spark, items):
    return spark.createDataFrame([(a, b, "x", "y") for a, b in items], "item_id long, text string, block string, part string").repartition(3)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


@pytest.mark.parametrize("case", ["one block", "blocks", "long windows", "edge", "empty"])
def test_leaks(spark, case):
    from hirelens.llm.decontamination import find_leaks
    rows, items = leaky(1, one_word=case != "long windows")
    options = {"blocks": {"block_words": 40}}.get(case, {})
    if case == "edge":
        rows, items = edge.nasty(), items + [(77, edge.nasty()[0][1]), (78, "q" * 70000), (79, "x " * 30)]
    if case == "empty":
        rows = []
    got = find_leaks(edge.docs(spark, rows), item_table(spark, items), words=10, **options)
    assert sorted((tuple(r) for r in got.select(*COLUMNS).collect()), key=repr) == brute_leaks(rows, items, 10)


def test_leaks_without_items(spark):
    from hirelens.llm.decontamination import find_leaks
    rows, _ = leaky(2)
    got = find_leaks(edge.docs(spark, rows), item_table(spark, [(1, None)])).collect()
    assert len(got) == len(rows) and not any(r["contaminated"] or r["longest"] for r in got)


def test_longest_run_and_removal(spark):
    from hirelens.llm.decontamination import find_leaks, remove_leaks
    item = " ".join(f"k{i}" for i in range(30))
    passage = " ".join(f"K{i}," for i in range(4, 21))  # 17 words
    rows = [(1, f"Before it. {passage} «after» " + "z " * 40), (2, passage), (3, None), (4, "nothing here"), (1, "another row of one id"),
            (5, " ".join(f"k{i}" for i in range(9)) + " z z z z z z z z z z z")]
    docs = edge.docs(spark, rows)
    found = find_leaks(docs, item_table(spark, [(1, item)]))
    got = {(r["doc_id"], r["n_words"]): (r["n_hit"], r["longest"]) for r in found.collect()}
    assert got == {(1, 60): (17, 17), (2, 17): (17, 17), (3, 0): (0, 0), (4, 2): (0, 0), (1, 5): (0, 0), (5, 20): (0, 0)}
    kept = remove_leaks(docs, found)
    assert kept.columns == docs.columns
    text = sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["text"])
    assert text == sorted([(1, "Before it. , «after» " + "z " * 40), (4, "nothing here"), (1, "another row of one id"), rows[5]])
    assert kept.count() == 5  # 2 is all passage


def test_automaton_against_every_substring():
    from hirelens.llm.decontamination import Automaton
    rng = random.Random(7)
    for _ in range(60):
        items = [(str(i), [rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(1, 9))]) for i in range(rng.randrange(1, 5))]
        made = Automaton.unpacked(Automaton(items, 3).packed())
        words = [rng.choice([b"a", b"b", b"c", b"z"]) for _ in range(rng.randrange(0, 30))]
        runs = {tuple(w[i:j]) for _, w in items for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        best = max((j - i for i in range(len(words)) for j in range(i + 1, len(words) + 1) if tuple(words[i:j]) in runs), default=0)
        least = min([3, *(len(w) for _, w in items)])
        spans, met, longest = made.stream(words)
        assert longest == (best if best >= least else 0)
        assert len(made.length) <= 2 * sum(len(w) for _, w in items) + 1
