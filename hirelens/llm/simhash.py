"""SimHash near-dedup by multi-index hashing.

A document's fingerprint has 64 bits: a bit is 1 if it is set in more than
half of the 64-bit hashes of the document's word shingles. Two fingerprints
that differ in at most k bits differ in at most k // m bits of one of their m
segments. So every distinct fingerprint is put into m tables under the values
of its segments, the Hamming ball of radius k // m around each segment is
looked up there, and what is found is verified on all 64 bits.

Equal fingerprints are one row from the start, so a group of copies costs one
probe. Joins of tables with a row a document shuffle: none is built on the
driver. Of two segments that differ in some bits, the ball of one contains the
other either way; a probe flips at most one 1-bit fewer than 0-bits (see
``_ball``), so that each pair meets once per segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import components, drop, shuffled, start_task, steps, text_bytes, word_spans, written

BITS = 64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[9:14] = 32  # any white space between words counts as one space


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int, seed: int = 42):
    """(XXH64 of every shingle, shingles per row); rows with fewer words have
    one shingle, rows without words none."""
    import xxhash
    rows = len(offsets) - 1
    start, end, row = word_spans(data, offsets)
    n_words = np.bincount(row, minlength=rows)
    if not len(start):
        return np.zeros(0, np.uint64), n_words
    keep = np.zeros(len(data) + 1, bool)
    size = np.zeros(len(data) + 1, np.int64)
    size[start] += 1
    size[end] -= 1
    keep[:-1] = np.cumsum(size[:-1]) > 0
    edge = end < len(data)
    keep[end[edge]] = True  # one byte after each word
    keep = keep[:-1]
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=place[1:])
    text = _LOWER[data[keep]].tobytes()
    first = np.cumsum(n_words) - n_words
    count = np.where(n_words > 0, np.maximum(n_words - words + 1, 1), 0)
    begin = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
    last = np.minimum(begin + words, np.repeat(first + n_words, count)) - 1
    digest = xxhash.xxh64_intdigest
    out = [digest(text[a:b], seed) for a, b in zip(place[start[begin]].tolist(), place[end[last]].tolist())]
    return np.array(out, np.uint64), count


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, words: int) -> np.ndarray:
    hashes, count = shingle_hashes(data, offsets, words)
    out = np.zeros(len(count), np.int64)
    some = np.flatnonzero(count)
    if len(some):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = (np.cumsum(count) - count)[some]
        votes = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        major = votes * 2 > count[some][:, None]
        out[some] = np.packbits(major, axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)
    return out


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h: the hash of the text, fp) per row: A-Z lower-cased, shingles of ``words`` words with
    repeats; fp is a signed long with the fingerprint's bits. Texts without
    words (null too) have 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_task("hash")
        for batch in batches:
            data, offsets = text_bytes(batch["text"])
            parts = [fingerprints_of(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], words)
                     for lo, hi in steps(offsets)]
            fp = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["h"], pa.array(fp)], names=["id", "h", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("h"), docs[text_col].alias("text")) \
        .mapInArrow(run, f"id {kind}, h long, fp long")


def _segments(most: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of two segments, or of more when the ball of half
    the bits would have a radius over 1."""
    m = max(2, (most + 2) // 2)
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(fp: Column, low: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _ball(value: Column, width: int, radius: int) -> Column:
    """The values within ``radius`` bits of ``value``. Only those reached by
    setting at least as many 0-bits as it clears 1-bits are listed: of two
    values that differ in d bits, one reaches the other so."""
    flips = [0]
    for r in range(1, radius + 1):
        flips += [sum(1 << b for b in bits) for bits in combinations(range(width), r)]
    masks = F.array(*[F.lit(f).cast("long") for f in flips])
    wanted = F.filter(masks, lambda f: F.bit_count(value.bitwiseAND(f)) * 2 <= F.bit_count(f))
    return F.transform(wanted, lambda f: value.bitwiseXOR(f))


def linked(fps: DataFrame, most: int = 3) -> DataFrame:
    """Edges (a, b), a < b, between distinct fingerprints (column fp) that
    differ in at most ``most`` bits."""
    parts = _segments(most)
    radius = most // len(parts)
    table = fps.select("fp", F.posexplode(F.array(*[_segment(F.col("fp"), *p) for p in parts])).alias("seg", "value"))
    probe = fps.select("fp", F.posexplode(F.array(*[_ball(_segment(F.col("fp"), *p), p[1], radius) for p in parts]))
                       .alias("seg", "values")).select("fp", "seg", F.explode("values").alias("value"))
    met = shuffled(table.alias("t")).join(probe.alias("p"), ["seg", "value"])
    near = F.bit_count(F.col("t.fp").bitwiseXOR(F.col("p.fp")))
    return (met.where((near > 0) & (near <= most))
            .select(F.least("t.fp", "p.fp").alias("a"), F.greatest("t.fp", "p.fp").alias("b")).distinct())


def _labelled(docs: DataFrame, words: int, most: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, h, fp, root (a fingerprint that names the component) and
    component."""
    rows = written(fingerprints(docs, words, id_col, text_col), "simhash")
    classes = written(rows.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-classes")
    edges = linked(classes, most)
    of = written(components(edges, "simhash-links"), "simhash-components")
    root = classes.join(shuffled(of), classes["fp"] == of["node"], "left") \
        .select("fp", "rep", F.coalesce("component", "fp").alias("root"))
    root = written(root, "simhash-roots")
    least = written(root.groupBy("root").agg(F.min("rep").alias("component")), "simhash-least")
    label = written(root.join(shuffled(least), "root").select("fp", "root", "component"), "simhash-labels")
    drop(classes, of, root, least)
    return rows.join(shuffled(label), "fp").select("id", "h", "fp", "root", "component")


def near_duplicates(docs: DataFrame, words: int = 3, most: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: id, fp, component (the smallest id reachable by
    links; a null id is never the smallest unless all are null).

    Rows with equal fingerprints are linked; so are those within ``most``
    bits. Empty and null texts have fingerprint 0 and are linked like others.
    An empty table gives no rows; other columns are ignored; repeated rows
    each come back.
    """
    return _labelled(docs, words, most, id_col, text_col).select("id", "fp", "component")


def keep_first(docs: DataFrame, words: int = 3, most: int = 3,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near duplicates: of each component the row with the
    smallest id stays (null ids after all others; of equal ids that with the
    smallest hash of its text), once if it is repeated. Rows with the same id,
    or none, and different texts are decided each in its own component.
    Columns and their order stay, whatever their names."""
    label = written(_labelled(docs, words, most, id_col, text_col), "simhash-label")
    row = F.struct(F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0).cast("long")).alias("id"), "h")
    first = written(label.groupBy("root").agg(F.min(row).alias("first")), "simhash-first")
    losers = label.join(shuffled(first), "root").where(row != F.col("first")).select(row.alias("lost")).distinct()
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    key, text = (F.col(f"c{docs.columns.index(c)}") for c in (id_col, text_col))
    own = F.struct(key.isNull().alias("none"), F.coalesce(key.cast("long"), F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("h"))
    kept = named.join(shuffled(losers), own == F.col("lost"), "left_anti")
    if label.groupBy(row.alias("row")).count().where("count > 1").limit(1).count():
        kept = kept.withColumn("own", own).dropDuplicates(["own"]).drop("own")
    return kept.toDF(*docs.columns)
