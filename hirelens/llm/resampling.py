"""Importance resampling towards a target distribution of hashed features.

A text's features are its word runs, hashed into ``buckets``; a bucket's gain
is the logarithm of how much more often target texts have it than the corpus.

* Texts are read once: each row's buckets are written as an array, from which
  both the corpus counts and, with the gains as one array of ``buckets``
  numbers, the rows' weights come. No text and no feature is shuffled.
* A row's score is its weight plus Gumbel noise from a hash of its id, so the
  highest scores are a sample without replacement by weight.
* The cutoff is found by bisection of the numbers: jobs that count the rows
  of the written scores below some probes, first over the score, then, only
  where a tie straddles the cutoff, over the id, the text's hash and the row's
  number. Nothing is sorted for it and no key gathers rows.
* Only the rows drawn are range-partitioned, by all of these, so that ties
  spread too; a row's rank is its place in its range after the rows of the
  ranges before.
"""

from __future__ import annotations

import math
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.bytewords import each_text, folded_words
from hirelens.llm.common import drop, written

#: numbers that one counting job probes
PROBES = 32
#: rows drawn in one range of the ranking
RANGE_ROWS = 500_000

_BUCKETED = "doc_id long, h long, n_words long, buckets array<int>"
_WEIGHED = "doc_id long, h long, n_words long, n_features long, weight long"


def _bucketed(texts: DataFrame, buckets: int, runs: int) -> DataFrame:
    """(doc_id, h, n_words, buckets: one number for each feature) of (doc_id, h, text) rows."""
    def hashed(batches):
        for batch in batches:
            sizes, words_of, parts = [], [], []
            for text in each_text(batch.column("text")):
                words = folded_words(text)
                found = list(map(crc32, words))
                for n in range(2, runs + 1):
                    found += [crc32(b" ".join(words[i:i + n])) for i in range(len(words) - n + 1)]
                sizes.append(len(found))
                words_of.append(len(words))
                parts.append((np.array(found, np.uint32) % np.uint32(buckets)).astype(np.int32))
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.concatenate(parts) if parts else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(words_of, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], names=["doc_id", "h", "n_words", "buckets"])
    return texts.mapInArrow(hashed, _BUCKETED)


def _counts(bucketed: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket has: ``buckets`` numbers."""
    rows = bucketed.select(F.explode("buckets").alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["b"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share of a bucket among the target's
    features over its share among the corpus's."""
    k, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k))))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weighed(bucketed: DataFrame, gains: np.ndarray) -> DataFrame:
    """The floored mean of its buckets' gains for each row."""
    def weigh(batches):
        for batch in batches:
            lists = batch.column("buckets")
            ends = np.asarray(lists.offsets).astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(gains[np.asarray(lists.values)[ends[0]:ends[-1]]])])
            ends = ends - ends[0]
            n = np.diff(ends)
            weight = (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), batch.column("n_words"), pa.array(n), pa.array(weight)],
                names=["doc_id", "h", "n_words", "n_features", "weight"])
    return bucketed.mapInArrow(weigh, _WEIGHED)


def _noise(doc_id: Column, seed: int) -> Column:
    """floor(1000 Gumbel) from the first 32 bits of a hash of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def boundary(table: DataFrame, n: int, keys: list[str]) -> list[int]:
    """Values v of the first keys such that exactly the ``n`` first rows in
    ascending order of ``keys`` are at or before (v, ...); surplus rows, equal
    on all keys, may be too. ``n`` is from 1 to the table's rows. Each round
    is one counting job over the written table."""
    bounds: list[int] = []
    tied = table
    for key in keys:
        lo, hi = tied.agg(F.min(key), F.max(key)).first()
        while lo < hi:
            probes = sorted({lo + (hi - lo) * i // (PROBES + 1) for i in range(1, PROBES + 1)})
            below = tied.agg(*[F.count(F.when(F.col(key) <= F.lit(p), 1)) for p in probes]).first()
            reached = [p for p, c in zip(probes, below) if c >= n]
            missed = [p for p, c in zip(probes, below) if c < n]
            hi = reached[0] if reached else hi
            lo = missed[-1] + 1 if missed else lo
        bounds.append(lo)
        before, ties = tied.agg(F.count(F.when(F.col(key) < F.lit(lo), 1)), F.count(F.when(F.col(key) == F.lit(lo), 1))).first()
        n -= before
        if n >= ties:
            break
        tied = tied.where(F.col(key) == F.lit(lo))
    return bounds


def _at_or_before(keys: list[str], bounds: list[int]) -> Column:
    last = F.col(keys[len(bounds) - 1]) <= F.lit(bounds[-1])
    return reduce(lambda rest, kb: (F.col(kb[0]) < F.lit(kb[1])) | ((F.col(kb[0]) == F.lit(kb[1])) & rest),
                  list(zip(keys, bounds))[-2::-1], last)


def _ranked(drawn: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """``drawn`` with rank 1, 2, ... in ascending order of ``keys``."""
    ranges = -(-n // RANGE_ROWS)
    placed = written(drawn.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
                     .withColumn("place", F.monotonically_increasing_id()), "resample-ranges")
    part = F.shiftright("place", 33)
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    base, bases = 0, []
    for p in sorted(sizes):
        bases.append((p, base))
        base += sizes[p]
    first = placed.sparkSession.createDataFrame(bases, "part int, base long")
    return placed.withColumn("part", part.cast("int")).join(F.broadcast(first), "part") \
        .withColumn("rank", F.col("base") + F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) + 1)


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, buckets: int = 10000,
             runs: int = 1, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) for every row of ``docs``.

    Words are runs of digits, letters a-z (A-Z lower-cased) and characters from
    U+0080 on. Features are all runs of 1 to ``runs`` words. Of the N rows with
    at least ``least_words`` words, floor(percent * N / 100) with the highest
    scores are drawn and have rank 1, 2, ...; the others have none. Ties go to
    the smaller id (none last), then the smaller hash of the text; rows equal
    in both are interchangeable. Null and empty texts have no features and
    weight 0; a null id hashes like an empty one. No target, or one without
    words, leaves the smoothing alone. An empty table gives no rows. Other
    columns are ignored. A very long text is one row's array.
    """
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.xxhash64(docs[text_col]).alias("h"), docs[text_col].alias("text"))
    goal = target.select(F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("h"), target[target_text_col].alias("text"))
    features = written(_bucketed(texts, buckets, runs), "resample-features")
    gains = bucket_gains(_counts(features, buckets), _counts(_bucketed(goal, buckets, runs), buckets))
    scored = written(
        _weighed(features, gains).withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed))
        .withColumn("worse", -F.col("score")).withColumn("lost", F.col("doc_id").isNull().cast("int"))
        .withColumn("id", F.coalesce("doc_id", F.lit(0).cast("long"))).withColumn("row", F.monotonically_increasing_id()),
        "resample-scores")
    drop(features)

    keys = ["worse", "lost", "id", "h", "row"]
    fit = scored.where(F.col("n_words") >= least_words)
    n = fit.count() * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if n == 0:
        return scored.select(*out, none)
    chosen = (F.col("n_words") >= least_words) & _at_or_before(keys, boundary(fit, n, keys))
    ranked = _ranked(scored.where(chosen), n, keys)
    return scored.where(~chosen).select(*out, none).unionByName(ranked.select(*out, "rank"))
