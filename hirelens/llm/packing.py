"""Packing documents into sequences by cutting-stock column generation.

A document's ids are cut into pieces of at most ``capacity``; only documents
longer than that are cut. Piece lengths are counted in classes of ``grid``
ids, a histogram of at most capacity / grid numbers, which is all that the
driver sees. There a linear program chooses how often to use which pattern
(so many pieces of these classes in one sequence): its columns are priced by a
knapsack dynamic program over the duals and enter a revised simplex until the
bound shows that little is left to gain. The patterns are used as often as
their rounded-down share says, what is left is filled greedily, and the pieces
of a class, ranked over all partitions by prefix sums, take the places of that
class one after another.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import small_batches, written
from hirelens.llm.tokens import encoder, shipped, some_rows

CAPACITY = 4096
GRID = 8
#: texts that are handed to a worker at once
TEXTS = 1_000
#: rows of cut pieces up to which they are broadcast
BROADCAST_ROWS = 200_000

PIECE = "part int, rank long, class int, doc_id {id}, start long, length int, doc_tokens long, ids binary"


# --------------------------------------------------------- linear program

def best_pattern(value: np.ndarray, size: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Knapsack with repetition: the copies of each class (sizes ascending)
    that fit into ``room`` with the largest value."""
    best = np.zeros(room + 1)
    took = np.full(room + 1, -1)
    fits = np.searchsorted(size, np.arange(room + 1), side="right")
    for w in range(1, room + 1):
        best[w] = best[w - 1]
        if n := fits[w]:
            got = value[:n] + best[w - size[:n]]
            k = int(got.argmax())
            if got[k] > best[w] + 1e-12:
                best[w], took[w] = got[k], k
    copies = np.zeros(len(size), np.int64)
    w = room
    while w > 0:
        if took[w] < 0:
            w -= 1
        else:
            copies[took[w]] += 1
            w -= size[took[w]]
    return float(best[room]), copies


def column_generation(size: np.ndarray, need: np.ndarray, room: int, gap: float = 2e-3,
                      rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as rows, how often each is used) of the relaxed cutting-stock
    problem: as few sequences as possible with at least ``need`` pieces of
    each class (sizes ascending). A basis has a column per class: a pattern, or
    the surplus of a class, which costs nothing and makes prices nonnegative.
    Any basis is feasible, so stopping early costs only padding; the same holds
    for what rounding adds up to, since whole patterns are counted against the
    need itself (``whole_patterns``)."""
    m = len(size)
    basis = np.diag(room // size).astype(float)  # a row per column of the program
    cost = np.ones(m)
    inverse = np.diag(1.0 / (room // size))
    used = need / (room // size)
    for k in range(rounds):
        price = cost @ inverse
        low = int(price.argmin())
        if price[low] < -1e-9:
            column, c = np.zeros(m), 0.0
            column[low] = -1
        else:
            worth, copies = best_pattern(price, size, room)
            now = cost @ used
            if worth <= 1 + 1e-7 or now - price @ need / worth <= gap * now:
                break
            column, c = copies.astype(float), 1.0
        step = inverse @ column
        up = step > 1e-9
        if not up.any():
            break
        ratio = np.full(m, np.inf)
        ratio[up] = used[up] / step[up]
        r = int(ratio.argmin())
        t = ratio[r]
        used = np.maximum(used - t * step, 0)
        used[r] = t
        basis[r], cost[r] = column, c
        row = inverse[r] / step[r]
        inverse -= np.outer(step, row)
        inverse[r] = row
    real = cost > 0
    return basis[real].astype(np.int64), used[real]


def whole_patterns(size: np.ndarray, need: np.ndarray, room: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {class: copies}) that use up ``need`` exactly."""
    order = np.argsort(size)
    size, need = size[order], need[order].astype(np.int64)
    out, left = [], need.copy()
    patterns, used = column_generation(size, need.astype(float), room)
    for copies, often in zip(patterns, np.floor(used + 1e-6).astype(np.int64)):
        some = copies > 0
        often = min(int(often), int((left[some] // copies[some]).min())) if some.any() else 0
        if often:
            out.append((often, {int(size[j]): int(copies[j]) for j in np.flatnonzero(some)}))
            left -= often * copies
    while left.any():
        rest, one = room, {}
        for j in range(len(size) - 1, -1, -1):
            if n := int(min(left[j], rest // size[j])):
                one[int(size[j])] = n
                rest -= n * int(size[j])
                left[j] -= n
        out.append((1, one))
    return out


def places(patterns: list[tuple[int, dict[int, int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """Rows (class, from rank, to rank, copies, first sequence, first slot):
    rank r of the class goes to sequence first + (r - from) // copies."""
    out, taken, sequence = [], {}, 0
    for often, copies in patterns:
        slot = 0
        for c in sorted(copies, reverse=True):
            n, lo = copies[c], taken.get(c, 0)
            out.append((c, lo, lo + often * n, n, sequence, slot))
            taken[c] = lo + often * n
            slot += n
        sequence += often
    return out


# ------------------------------------------------------------------ spark

@dataclass
class Packing:
    """``pieces``: part, rank, class (together the key), doc_id, start, length,
    doc_tokens, ids (little-endian unsigned 32-bit). ``placed``: a row per
    placed piece with its key, ``skip`` (ids of the piece before it, if the
    piece was cut again), sequence_id, offset and ids_crc32."""
    pieces: DataFrame
    placed: DataFrame

    def sequences(self) -> DataFrame:
        """(sequence_id, n_tokens, ids): every sequence with its ids in order,
        not padded. A sequence has at most ``capacity`` ids."""
        key = ["part", "class", "rank"]
        own = self.pieces.select(*key, "ids").join(
            self.placed.select(*key, "skip", "sequence_id", "offset", F.col("length").alias("n")), key)
        part = F.substring("ids", F.col("skip") * 4 + 1, F.col("n") * 4)
        every = own.groupBy("sequence_id").agg(
            F.sum("n").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("offset", part.alias("ids")))).alias("p"))
        return every.select("sequence_id", "n_tokens",
                            F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, grid: int = GRID,
         id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = False,
         remembered: int | None = None) -> Packing:
    """Pack all rows of ``docs``; a null or empty text has just its end id.
    ``tokenizer``: the path of a ``tokenizers`` file where the job is planned;
    a special token's string in a text is that token unless ``special_as_text``.
    ``remembered``: chunks of text whose ids a worker keeps, twice (some 200
    bytes each; more are faster), for executors with less memory to spare.

    Sequences hold at most ``capacity`` ids, pieces follow one another without
    gaps, every id of every row lies in exactly one piece. Where a sequence
    would be padded by half or more, its content is cut at powers of two
    instead, which need no padding. Repeated rows are packed each; an empty
    table gives no rows; other columns are ignored; null ids are carried.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    file = shipped(spark, tokenizer)

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc = encoder(file, special_as_text, remembered)
        end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        count = np.zeros(capacity // grid + 2, np.int64)
        for batch in batches:
            for lo, texts in some_rows(batch.column(1)):
                raw = [t + end for t in enc.encode(texts)]
                size = np.fromiter(map(len, raw), np.int64, len(raw)) // width
                n = -(-size // capacity)
                row = np.repeat(np.arange(len(raw)), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * capacity
                length = np.minimum(size[row] - start, capacity)
                cls = -(-length // grid)
                order = np.argsort(cls, kind="stable")
                in_class = np.bincount(cls, minlength=len(count))
                rank = np.empty(len(cls), np.int64)
                rank[order] = np.arange(len(cls)) - np.repeat(np.cumsum(in_class) - in_class, in_class)
                rank += count[cls]
                count += in_class
                wide = np.frombuffer(b"".join(raw), enc.dtype).astype("<u4").tobytes()
                at = np.append(0, np.cumsum(length)) * 4
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(row), part, np.int32)), pa.array(rank), pa.array(cls.astype(np.int32)),
                    batch.column(0).slice(lo, len(texts)).take(pa.array(row)), pa.array(start),
                    pa.array(length.astype(np.int32)), pa.array(size[row]),
                    pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(at.astype(np.int32).tobytes()),
                                                                  pa.py_buffer(wide)])],
                    names=["part", "rank", "class", "doc_id", "start", "length", "doc_tokens", "ids"])

    with small_batches(spark, TEXTS):
        pieces = written(docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
                         .mapInArrow(tokenize, PIECE.format(id=kind)), "pack-pieces")
    counts = written(pieces.groupBy("part", "class").agg(F.count(F.lit(1)).alias("n")), "pack-counts")
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    size = np.array(sorted(histogram), np.int64)
    rows = places(whole_patterns(size, np.array([histogram[c] for c in size]), capacity // grid)) if len(size) else []
    plan = spark.createDataFrame(rows, "class int, lo long, hi long, copies long, sequence long, slot long")

    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = written(counts.select("part", "class", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")), "pack-base")
    place = F.col("rank") + F.col("base")
    within = place - F.col("lo")
    # the plan has a few rows per class of the histogram
    seated = (pieces.select("part", "rank", "class", "doc_id", "start", "length", "doc_tokens", F.crc32("ids").alias("ids_crc32"))
              .join(base, ["part", "class"])
              .join(F.broadcast(plan), (pieces["class"] == plan["class"]) & (place >= F.col("lo")) & (place < F.col("hi")))
              .select("part", "rank", pieces["class"], "doc_id", "start", "length", "doc_tokens", "ids_crc32",
                      (F.col("sequence") + F.floor(within / F.col("copies"))).alias("sequence"),
                      (F.col("slot") + F.pmod(within, F.col("copies"))).alias("slot")))
    run = Window.partitionBy("sequence").orderBy("slot")
    seated = written(
        seated.withColumn("offset", F.sum("length").over(run) - F.col("length"))
        .withColumn("total", F.sum("length").over(Window.partitionBy("sequence"))), "pack-seated")

    cut = (F.col("total") * 2 <= capacity) & (F.bit_count("total") > 1)
    names = ["part", "rank", "class", "doc_id", "start", "length", "doc_tokens"]
    plain = seated.where(~cut).select(*names, "ids_crc32", F.lit(0).cast("long").alias("skip"),
                                      (F.col("sequence") * 64).alias("sequence_id"), F.col("offset").cast("long"))
    bit = F.col("bit")
    lo = F.expr("shiftleft(shiftright(total, bit + 1), bit + 1)")  # the higher powers come first
    begin = F.greatest("offset", lo)
    stop = F.least(F.col("offset") + F.col("length"), lo + F.expr("shiftleft(1L, bit)"))
    parts = written(
        seated.where(cut).select("*", F.explode(F.sequence(F.lit(0), F.lit(capacity.bit_length()))).alias("bit"))
        .where("shiftright(total, bit) & 1 = 1")
        .select("*", lo.alias("lo"), begin.alias("begin"), stop.alias("stop")).where("begin < stop")
        .select(*names, (F.col("begin") - F.col("offset")).alias("skip"), (F.col("stop") - F.col("begin")).alias("n"),
                (F.col("sequence") * 64 + 1 + bit).alias("sequence_id"), (F.col("begin") - F.col("lo")).alias("at")),
        "pack-cut")
    small = F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts
    key = ["part", "class", "rank"]
    again = (pieces.select(*key, "ids").join(small, key)
             .select(*names[:4], (F.col("start") + F.col("skip")).alias("start"), F.col("n").cast("int").alias("length"),
                     "doc_tokens",
                     F.crc32(F.substring("ids", (F.col("skip") * 4 + 1).cast("int"), (F.col("n") * 4).cast("int"))).alias("ids_crc32"),
                     "skip", "sequence_id", F.col("at").cast("long").alias("offset")))
    return Packing(pieces, plain.unionByName(again))
