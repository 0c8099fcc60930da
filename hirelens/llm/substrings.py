"""Substring dedup with a count-min prefilter.

A window is a run of consecutive words of one document; its key is 128 bits
(two independent 64-bit hashes of its words). Documents are dealt to blocks by
a hash of their id and text, windows to shards by a hash of their key.

First pass: each block sketches its windows. A count-min sketch has ``depth``
rows of cells; the cells that a block's windows hit travel, sorted and
delta-coded, to the shard that holds them, where the blocks' sketches are
merged: a cell's count is the sum over the blocks. The cells that were hit
once in all go back as bits. A window whose smallest count is one occurs once
(a sketch never underestimates), so it needs no exact look; the others are
windows estimated repeated.

Second pass: only the keys of windows estimated repeated travel, once per
block and key. The shard groups them exactly and tells each block which of
them belong to an earlier document elsewhere. In its block a window is
repeated if its key came earlier in the block or belongs elsewhere.

The sketch has ``cells`` cells per window and row and is spread over all
shards, so its precision and the memory of a task are the same at any size,
and no task or broadcast holds it whole. A key held by a third of all
documents is one row per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import (drop, mix, range_hashes, run_hashes, shuffle_width, steps, text_bytes, word_spans,
                                 written)

#: bytes of text in a block, and windows of which a shard holds the cells
BLOCK_BYTES = 6 << 20
DEPTH = 2
CELLS_PER_WINDOW = 4
_SALTS = (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F), np.uint64(0x2545F4914F6CDD1D))


# ------------------------------------------------------------ coded lists

def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as differences of 7-bit groups."""
    step = np.diff(values, prepend=values.dtype.type(0))
    if not len(step):
        return b""
    size = np.ones(len(step), np.int64)
    for k in range(1, 10):
        size += step >= np.uint64(1) << np.uint64(7 * k)
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]), np.uint8)
    at, rest = end - size, step.copy()
    todo = np.arange(len(step))
    while len(todo):
        more = rest[todo] >= 128
        out[at[todo]] = (rest[todo] & np.uint64(127)).astype(np.uint8) | (more * 128).astype(np.uint8)
        todo = todo[more]
        rest[todo] >>= np.uint64(7)
        at[todo] += 1
    return out.tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    last = raw < 128
    group = np.zeros(len(raw), np.int64)
    group[1:] = np.cumsum(last[:-1])
    first = np.zeros(int(group[-1]) + 1, np.int64)
    first[1:] = np.flatnonzero(last)[:-1] + 1
    shift = (np.arange(len(raw)) - first[group]).astype(np.uint64) * np.uint64(7)
    step = np.add.reduceat((raw & 127).astype(np.uint64) << shift, first)
    return np.cumsum(step, dtype=np.uint64)


# ---------------------------------------------------------------- windows

class Block:
    """The words and windows of a block's documents, in order of document."""

    def __init__(self, table: pa.Table, words: int):
        table = table.combine_chunks()
        ids = table.column("doc_id")
        order = np.lexsort((np.asarray(table.column("h").combine_chunks()), np.asarray(ids.fill_null(0).combine_chunks()),
                            ~np.asarray(ids.is_null().combine_chunks())))
        table = table.take(pa.array(order))
        self.ids = table.column("doc_id")
        self.h = np.asarray(table.column("h").combine_chunks())
        self.data, self.offsets = text_bytes(table.column("text"))
        spans, keys = [], [[], []]
        for lo, hi in steps(self.offsets):
            base = self.offsets[lo]
            data = self.data[base:self.offsets[hi]]
            start, end, row = word_spans(data, self.offsets[lo:hi + 1] - base)
            whole = row[words - 1:] == row[:len(row) - words + 1] if len(row) >= words else np.zeros(0, bool)
            spans.append((start + base, end + base, row + lo, np.append(whole, np.zeros(len(row) - len(whole), bool))))
            for lane in (0, 1):
                keys[lane].append(run_hashes(range_hashes(data, start, end, lane), words, lane)[whole])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.start = join([s[0] for s in spans], np.int64)
        self.end = join([s[1] for s in spans], np.int64)
        self.row = join([s[2] for s in spans], np.int64)
        #: word at which each window starts; rows of one window have it once
        self.at = np.flatnonzero(join([s[3] for s in spans], bool))
        self.hi, self.lo = join(keys[0], np.uint64), join(keys[1], np.uint64)
        self.words = words


def cells_of(hi: np.ndarray, depth: int, bits: int) -> list[np.ndarray]:
    """Per sketch row the cell of each key; a row's cells are apart from
    another's."""
    return [(mix(hi + _SALTS[d]) >> np.uint64(64 - bits)) | (np.uint64(d) << np.uint64(bits)) for d in range(depth)]


def _sketch(block: Block, depth: int, bits: int):
    """(cells ascending, whether the block hits each once, order: the hits in
    order of cell, place: which cell each of these hits)."""
    cells = np.concatenate(cells_of(block.hi, depth, bits)) if len(block.hi) else np.zeros(0, np.uint64)
    order = np.argsort(cells)
    cells = cells[order]
    new = np.ones(len(cells), bool)
    new[1:] = cells[1:] != cells[:-1]
    place = np.cumsum(new) - 1
    return cells[new], np.bincount(place) == 1, order, place


def _cut(values: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Where each shard's part of ascending cells or keys begins and ends."""
    edge = np.array([(i << bits) // shards for i in range(1, shards)], np.uint64)
    return np.concatenate([[0], np.searchsorted(values, edge), [len(values)]])


def _shard_slices(values: np.ndarray, depth: int, bits: int, shards: int):
    """(shard, lo, hi) of ascending cells of all rows of the sketch."""
    for d in range(depth):
        a, b = np.searchsorted(values, [np.uint64(d) << np.uint64(bits), np.uint64(d + 1) << np.uint64(bits)])
        part = values[a:b] - (np.uint64(d) << np.uint64(bits))
        cut = _cut(part, bits, shards)
        for s in range(shards):
            if cut[s + 1] > cut[s]:
                yield d * shards + s, a + cut[s], a + cut[s + 1]


def _rows(rows: list[tuple], names: list[str], kinds: list) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)


_CELLS = (["shard", "block", "once", "cells"], [pa.int32(), pa.int32(), pa.binary(), pa.binary()])
_BACK = (["block", "shard", "bits"], [pa.int32(), pa.int32(), pa.binary()])
_KEYS = (["shard", "block", "hi", "lo", "owner"], [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()])


def dedup_windows(docs: DataFrame, words: int = 20, depth: int = DEPTH, cells: int = CELLS_PER_WINDOW,
                  block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_text (the words
    kept, joined by one space).

    Words are runs of bytes other than ASCII white space, compared unchanged.
    A word is removed if a window covers it whose words also start earlier: in
    a document with a smaller id (null first) or earlier in the same one.
    Windows are judged on the input. Rows with the same id count as one
    document after another, in order of a hash of their text, so of repeated
    rows one keeps its text. Texts with fewer words than a window lose
    nothing; null and empty texts have no words. An empty table gives no rows;
    other columns are ignored. A single text larger than a block is a block's
    whole content.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(docs[text_col]))).first()[0] or 0
    blocks = max(shuffle_width(spark), -(-total // block_bytes))
    shards = blocks
    # a word has at least one byte and a separator
    bits = max(16, int(max(1, total // 4) * cells).bit_length())
    source = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"),
                         F.xxhash64(docs[text_col]).alias("h")) \
        .withColumn("block", F.pmod(F.xxhash64("doc_id", "h"), F.lit(blocks)).cast("int")) \
        .repartition(blocks, "block")

    def sketch(key, table):
        block = Block(table, words)
        values, once, _, _ = _sketch(block, depth, bits)
        out = [(s, key[0].as_py(), np.packbits(once[a:b]).tobytes(), pack_sorted(values[a:b]))
               for s, a, b in _shard_slices(values, depth, bits, shards)]
        return _rows(out, *_CELLS)

    def merge(key, table):
        """The merged counts of a shard's cells; per block a bit for each cell
        it named: whether the count is over one."""
        parts = [(b, unpack_sorted(c), o) for b, c, o in zip(*(table.column(n).to_pylist() for n in ("block", "cells", "once")))]
        every = np.concatenate([c for _, c, _ in parts])
        alone = np.concatenate([np.unpackbits(np.frombuffer(o, np.uint8), count=len(c)) for _, c, o in parts]).astype(bool)
        order = np.argsort(every, kind="stable")
        e = every[order]
        same = np.zeros(len(e) + 1, bool)
        same[1:-1] = e[1:] == e[:-1]
        over = np.empty(len(e), bool)
        over[order] = same[1:] | same[:-1]
        over |= ~alone
        out, lo = [], 0
        for b, c, _ in parts:
            out.append((b, key[0].as_py(), np.packbits(over[lo:lo + len(c)]).tobytes()))
            lo += len(c)
        return _rows(out, *_BACK)

    def repeated(block: Block, back: pa.Table) -> np.ndarray:
        """Windows whose count is over one in every row of the sketch."""
        values, _, order, place = _sketch(block, depth, bits)
        over = np.zeros(len(values), bool)
        got = dict(zip(back.column("shard").to_pylist(), back.column("bits").to_pylist()))
        for s, a, b in _shard_slices(values, depth, bits, shards):
            over[a:b] = np.unpackbits(np.frombuffer(got[s], np.uint8), count=b - a).astype(bool)
        hit = np.empty(len(order), bool)
        hit[order] = over[place]
        return hit.reshape(depth, -1).all(axis=0)

    def candidates(block: Block, back: pa.Table):
        """(window numbers estimated repeated in order of key, where each key
        first is among them, the document that has it first)."""
        at = np.flatnonzero(repeated(block, back))
        order = np.lexsort((at, block.lo[at], block.hi[at]))
        at = at[order]
        hi, lo = block.hi[at], block.lo[at]
        new = np.ones(len(at), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        return at, new

    def name_keys(key, left, right):
        if not left.num_rows:
            return _rows([], *_KEYS)
        block = Block(left, words)
        at, new = candidates(block, right)
        at = at[new]
        hi, lo = block.hi[at], block.lo[at]
        owner = _doc_order(block)[block.row[block.at[at]]]
        cut = _cut(hi, 64, shards)
        return _rows([(s, key[0].as_py(), hi[a:b].tobytes(), lo[a:b].tobytes(), owner[a:b].tobytes())
                      for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a], *_KEYS)

    def own(key, table):
        """Exact grouping of a shard's keys: per block a bit for each key it
        named, whether an earlier document of another block has it."""
        get = lambda n, kind: [np.frombuffer(x, kind) for x in table.column(n).to_pylist()]
        his, los, docs_ = get("hi", np.uint64), get("lo", np.uint64), get("owner", np.uint64)
        hi, lo, doc = np.concatenate(his), np.concatenate(los), np.concatenate(docs_).reshape(-1, 2)
        order = np.lexsort((doc[:, 1], doc[:, 0], lo, hi))
        later = np.zeros(len(hi), bool)
        h, l_ = hi[order], lo[order]
        later[order[1:]] = (h[1:] == h[:-1]) & (l_[1:] == l_[:-1])
        out, at = [], 0
        for b, k in zip(table.column("block").to_pylist(), his):
            out.append((b, key[0].as_py(), np.packbits(later[at:at + len(k)]).tobytes()))
            at += len(k)
        return _rows(out, *_BACK)

    def remove(key, left, right):
        names = ["doc_id", "n_words", "n_removed", "kept_text"]
        if not left.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.string())], names=names)
        block = Block(left, words)
        first = right.column("pass").to_numpy() == 1
        at, new = candidates(block, right.filter(pa.array(first)))
        hi = block.hi[at[new]]
        elsewhere = np.zeros(len(hi), bool)
        theirs = right.filter(pa.array(~first))
        got = dict(zip(theirs.column("shard").to_pylist(), theirs.column("bits").to_pylist()))
        cut = _cut(hi, 64, shards)
        for s, (a, b) in enumerate(zip(cut[:-1], cut[1:])):
            if b > a:
                elsewhere[a:b] = np.unpackbits(np.frombuffer(got[s], np.uint8), count=b - a).astype(bool)
        gone = ~new | elsewhere[np.cumsum(new) - 1] if len(at) else np.zeros(0, bool)
        mark = np.zeros(len(block.start) + 1, np.int64)
        where = block.at[at[gone]]
        np.add.at(mark, where, 1)
        np.add.at(mark, where + words, -1)
        kept = np.cumsum(mark[:-1]) == 0
        rows = left.num_rows
        n_words = np.bincount(block.row, minlength=rows)
        n_kept = np.bincount(block.row[kept], minlength=rows)
        return pa.table([block.ids, pa.array(n_words), pa.array(n_words - n_kept), _joined(block, kept)], names=names)

    def first_pass():
        return source.groupBy("block").applyInArrow(sketch, "shard int, block int, once binary, cells binary") \
            .groupBy("shard").applyInArrow(merge, "block int, shard int, bits binary")

    back = first_pass()
    named = source.groupBy("block").cogroup(back.groupBy("block")) \
        .applyInArrow(name_keys, "shard int, block int, hi binary, lo binary, owner binary")
    owned = named.groupBy("shard").applyInArrow(own, "block int, shard int, bits binary")
    both = back.withColumn("pass", F.lit(1)).unionByName(owned.withColumn("pass", F.lit(2)))
    return source.groupBy("block").cogroup(both.groupBy("block")) \
        .applyInArrow(remove, "doc_id long, n_words long, n_removed long, kept_text string")


def _doc_order(block: Block) -> np.ndarray:
    """The rows' (id, hash of the text) as two unsigned integers each, in their
    order, null ids lowest. Rows equal in both are in one block."""
    ids = block.ids.combine_chunks() if isinstance(block.ids, pa.ChunkedArray) else block.ids
    top = np.uint64(1 << 63)
    value = np.asarray(ids.fill_null(0)).astype(np.int64).view(np.uint64) ^ top
    first = np.where(np.asarray(ids.is_null()), np.uint64(0), np.maximum(value, np.uint64(1)))
    return np.stack([first, block.h.astype(np.int64).view(np.uint64) ^ top], axis=1)


def _joined(block: Block, kept: np.ndarray) -> pa.Array:
    """The kept words of every row, joined by one space."""
    start, end, row = block.start[kept], block.end[kept], block.row[kept]
    size = np.zeros(len(block.data) + 1, np.int64)
    size[start] += 1
    size[end] -= 1
    keep = np.cumsum(size[:-1]) > 0
    last = np.ones(len(row), bool)
    last[:-1] = row[1:] != row[:-1]
    space = end[~last]  # the byte after a word that is not its row's last
    keep[space] = True
    data = block.data.copy()
    data[space] = 32
    total = np.zeros(len(keep) + 1, np.int64)
    np.cumsum(keep, out=total[1:])
    offsets = total[block.offsets]
    raw = data[keep].tobytes()
    if len(raw) < 1 << 31:
        return pa.Array.from_buffers(pa.string(), len(offsets) - 1,
                                     [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(raw)])
    return pa.Array.from_buffers(pa.large_string(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw)])
