"""Spelling variants of the corpus's words by PartEnum signatures.

A word is the multiset of its letters, as a binary vector: one dimension for
each (letter, how manieth). One inserted, deleted or replaced code point changes
at most two dimensions. PartEnum: the dimensions are dealt to ``first`` parts, of
which one differs in at most floor(2 / first) dimensions; each of these is dealt
to ``second`` parts, of which at least ``second - floor(2 / first)`` agree. So two
near words share the digest of one such choice of parts, their signature, and
an equi-join on the signatures misses no pair.

Among the words of one signature, near words are found without comparing all
pairs: a word less the code point at i is spelled as a hash (prefix and suffix
sums, linear in the word's length). Replacements share it with i, a longer word
has the shorter one among its own. What agrees is verified on the words.

A signature that more than HOT_WORDS words share is not gathered in one task:
its words are dealt on by those hashes, which at most a few hundred words share
(an alphabet of 90 code points at each place).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import drop, mix, powers, shuffle_width, written
from hirelens.session import checked_broadcast

LETTERS = r"[A-Za-zÀ-ÿ]+"
#: code points that differ at most between near words' multisets
APART = 2
#: rows of signatures in one task, and words of one signature that one task takes
BUCKET_ROWS = 150_000
HOT_WORDS = 50_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame, damage: int = 97, least_chars: int = 5, least_count: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words with at least ``least_chars`` code points and
    ``least_count`` occurrences. A run of letters (A-Z lower-cased) whose crc32
    with its document's id is divisible by ``damage`` loses one code point."""
    runs = docs.select(docs[id_col].cast("string").alias("id"),
                       F.explode(F.regexp_extract_all(F.translate(docs[text_col], _UPPER, _UPPER.lower()), F.lit(LETTERS), F.lit(0))).alias("run"))
    h = F.crc32(F.concat(F.coalesce("id", F.lit("")), F.lit(":"), "run").cast("binary"))
    run, at = F.col("run"), (F.col("h") % F.length("run")).cast("int")
    kept = F.when(F.col("h") % damage == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))).otherwise(run)
    return runs.withColumn("h", h).select(kept.alias("word")).where(F.length("word") >= least_chars) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


# ------------------------------------------------------------- in a task

def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all words, offsets)."""
    text = words.to_pylist()
    off = np.zeros(len(text) + 1, np.int64)
    np.cumsum([len(w) for w in text], out=off[1:])
    return np.frombuffer("".join(text).encode("utf-32-le"), np.uint32).astype(np.uint64), off


def _spread(x: np.ndarray) -> np.ndarray:
    return mix(x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xD1B54A32D192ED03))


def signatures(points: np.ndarray, off: np.ndarray, first: int, second: int) -> np.ndarray:
    """(words, signatures) array: PartEnum of the words' letter multisets."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(off))
    order = np.lexsort((points, row))
    r, c = row[order], points[order]
    new = np.ones(len(c), bool)
    new[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
    start = np.maximum.accumulate(np.where(new, np.arange(len(c)), 0))
    element = _spread((c << np.uint64(32)) | (np.arange(len(c)) - start).astype(np.uint64))
    part = (_spread(element) % np.uint64(first * second)).astype(np.int64)
    digest = np.zeros((n, first * second), np.uint64)
    np.add.at(digest, (r, part), element)
    agree = second - APART // first
    out = []
    for f in range(first):
        for chosen in combinations(range(f * second, (f + 1) * second), agree):
            key = np.full(n, len(out) + 1, np.uint64)
            for p in chosen:
                key = _spread(key ^ digest[:, p])
            out.append(key)
    return np.stack(out, axis=1) if out else np.zeros((n, 0), np.uint64)


def deletions(points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, hash of each word less each of its code points)."""
    size = np.diff(off)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(points)) - off[row]
    up = powers(0, int(size.max(initial=0)) + 1)
    value = (_spread(points) | np.uint64(1)) * up[at]
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(value, out=total[1:])
    whole = total[off[1:]] - total[off[:-1]]
    before = total[:-1] - total[off[row]]
    after = total[off[row + 1]] - total[1:]
    # the code points after the gap move one place down
    down = powers(0, 2, inverse=True)[1]
    less = before + after * down
    spell = lambda x, n: mix(x + n.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return spell(whole, size), spell(less, size[row] - 1)


def _equal_runs(*keys: np.ndarray):
    """(order, bounds) of rows sorted by the keys, cut where a key changes."""
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] &= s[1:] == s[:-1]
    # new now marks rows equal to the one before; the first is no such row
    new = ~new
    if len(new):
        new[0] = True
    return order, np.append(np.flatnonzero(new), len(order))


def near_pairs(group: np.ndarray, points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of one group whose words agree in a deletion: by hashes, so
    to be verified. Each pair once a group, a < b by row."""
    whole, less = deletions(points, off)
    size = np.diff(off)
    row = np.repeat(np.arange(len(size)), size)
    at = (np.arange(len(points)) - off[row]).astype(np.uint64)
    left, right = [], []
    # replaced: same group, same rest, same place
    order, cut = _equal_runs(group[row], less, at)
    many = np.flatnonzero(np.diff(cut) > 1)
    # pairs at distance 1, 2, ... inside each run of equal keys
    lo, hi = cut[many], cut[many + 1]
    gap = 1
    while len(lo):
        runs = hi - lo - gap
        base = np.repeat(lo - np.cumsum(runs) + runs, runs) + np.arange(runs.sum())
        left.append(row[order[base]])
        right.append(row[order[base + gap]])
        gap += 1
        more = hi - lo > gap
        lo, hi = lo[more], hi[more]
    # inserted: a whole word among a longer one's rests
    key = lambda g, h: mix(g ^ mix(h + np.uint64(0x632BE59BD9B4E019)))
    own = key(group, whole)
    by = np.argsort(own, kind="stable")
    wanted = key(group[row], less)
    a, b = np.searchsorted(own[by], wanted, "left"), np.searchsorted(own[by], wanted, "right")
    for k in range(int((b - a).max(initial=0))):
        has = b - a > k
        left.append(by[a[has] + k])
        right.append(row[has])
    x = np.concatenate(left) if left else np.zeros(0, np.int64)
    y = np.concatenate(right) if right else np.zeros(0, np.int64)
    apart = x != y
    pairs = np.unique(np.stack([np.minimum(x, y)[apart], np.maximum(x, y)[apart]], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


# ---------------------------------------------------------------- in Spark

def _signed(words: DataFrame, first: int, second: int) -> DataFrame:
    """(sig, word, n): each word once for each of its signatures."""
    def sign(batches):
        for batch in batches:
            points, off = code_points(batch.column("word"))
            sigs = signatures(points, off, first, second)
            for k in range(sigs.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(sigs[:, k].view(np.int64)), batch.column("word"), batch.column("n")],
                                                 names=["sig", "word", "n"])
    return words.mapInArrow(sign, "sig long, word string, n long")


def _paired(table: pa.Table) -> pa.Table:
    """Pairs of near words of the signatures in ``table``."""
    table = table.combine_chunks()
    words = table.column("word").combine_chunks()
    group = np.asarray(table.column("sig")).view(np.uint64)
    points, off = code_points(words)
    a, b = near_pairs(group, points, off)
    n = table.column("n")
    return pa.table([words.take(pa.array(a)), n.take(pa.array(a)), words.take(pa.array(b)), n.take(pa.array(b))], names=["a", "na", "b", "nb"])


def _dealt_on(hot: DataFrame) -> DataFrame:
    """Pairs (a, b: hashes of words) of the signatures with many words, by a
    join on signature and spelled rest."""
    def spell(batches):
        for batch in batches:
            points, off = code_points(batch.column("word"))
            whole, less = deletions(points, off)
            sig = np.asarray(batch.column("sig")).view(np.uint64)
            me = np.asarray(batch.column("me"))
            size = np.diff(off)
            row = np.repeat(np.arange(len(size)), size)
            key = mix(np.concatenate([sig, sig[row]]) ^ mix(np.concatenate([whole, less])))
            place = np.concatenate([np.full(len(size), -1), np.arange(len(points)) - off[row]])
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(place, pa.int64()), pa.array(np.concatenate([me, me[row]]))],
                                             names=["key", "place", "me"])
    rests = written(hot.select("sig", "word", F.xxhash64("word").alias("me")).mapInArrow(spell, "key long, place long, me long"), "spelling-rests")
    other = rests.select("key", "place", F.col("me").alias("you"))
    replaced = rests.where("place >= 0").join(other, ["key", "place"]).where("me < you").select("me", "you")
    inserted = rests.where("place >= 0").drop("place").join(other.where("place < 0").drop("place"), "key").where("me <> you").select("me", "you")
    out = written(replaced.unionByName(inserted).select(F.least("me", "you").alias("a"), F.greatest("me", "you").alias("b")).distinct(), "spelling-hot")
    drop(rests)
    return out


def near_words(words: DataFrame, first: int = 1, second: int = 4, hot_words: int = HOT_WORDS) -> DataFrame:
    """(word, other, n, other_n) of the (word, n) rows of ``words``, both ways,
    whose words differ by exactly one inserted, deleted or replaced code point."""
    spark = words.sparkSession
    signed = written(_signed(words, first, second), "spelling-signed")
    sizes = signed.groupBy("sig").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > hot_words).select("sig")
    hot = written(sizes, "spelling-crowded")
    crowded = hot.count()
    rest = signed.join(checked_broadcast(hot), "sig", "left_anti") if crowded else signed
    buckets = max(shuffle_width(spark), signed.count() // BUCKET_ROWS + 1)
    pairs = rest.withColumn("bucket", F.pmod(F.xxhash64("sig"), F.lit(buckets))).groupBy("bucket") \
        .applyInArrow(lambda t: _paired(t.drop_columns(["bucket"])), "a string, na long, b string, nb long")
    if crowded:
        named = words.select(F.xxhash64("word").alias("id"), "word", "n")
        more = _dealt_on(signed.join(checked_broadcast(hot), "sig", "left_semi"))
        pairs = pairs.unionByName(
            more.join(named.select(F.col("id").alias("a"), F.col("word").alias("wa"), F.col("n").alias("na")), "a")
            .join(named.select(F.col("id").alias("b"), F.col("word").alias("wb"), F.col("n").alias("nb")), "b")
            .select(F.col("wa").alias("a"), "na", F.col("wb").alias("b"), "nb"))
    swap = F.col("a") > F.col("b")

    def ordered(x: str, y: str) -> Column:
        return F.when(swap, F.col(y)).otherwise(F.col(x))
    sure = written(pairs.where(F.levenshtein("a", "b", 1) == 1)
                   .select(ordered("a", "b").alias("a"), ordered("na", "nb").alias("na"), ordered("b", "a").alias("b"), ordered("nb", "na").alias("nb"))
                   .distinct(), "spelling-near")
    drop(signed)
    return sure.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("na").alias("n"), F.col("nb").alias("other_n")) \
        .unionByName(sure.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("nb").alias("n"), F.col("na").alias("other_n")))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the last of the forms that lead on from each word. A
    form occurs at least twice as often, so there are no circles; each round
    doubles the steps taken."""
    now = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("mid"), F.col("root").alias("far"))
        after = written(now.join(on, F.col("root") == F.col("mid"), "left")
                        .select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling-roots")
        drop(now)
        now = after
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")


def variant_groups(docs: DataFrame, damage: int = 97, least_chars: int = 5, least_count: int = 3, times: int = 2,
                   first: int = 1, second: int = 4, hot_words: int = HOT_WORDS, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, some of
    them damaged (see :func:`word_counts`). The form of a word is the word of
    largest n (ties: smallest in code-point order) that differs by one inserted,
    deleted or replaced code point, if its n is at least ``times`` (2 or more)
    the word's; the root is where the forms lead. Null and empty texts have no
    words; a null id is hashed as an empty one; repeated rows count again. No
    words, or an empty table, give no rows. Other columns are ignored; a word
    of any length is one word.
    """
    if times < 2:
        raise ValueError("times has to be 2 or more, or forms may lead in circles")
    words = written(word_counts(docs, damage, least_chars, least_count, id_col, text_col), "spelling-words")
    near = near_words(words, first, second, hot_words)
    # the smallest of (-n, word) is the largest n, then the smallest word
    best = written(near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("n").alias("n"),
                                            F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
                   .select("word", "n_near", F.when(-F.col("best.less") >= F.lit(times) * F.col("n"), F.col("best.other")).alias("form"),
                           (-F.col("best.less")).alias("best_n")), "spelling-best")
    roots = _roots(best.where("form IS NOT NULL"))
    return words.join(best, "word", "left").join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"))
