"""Embedding near-dedup by NN-descent.

1. Vectors are scaled to length one. Angles obey the triangle inequality, so
   all vectors within half the link angle of one vector (a ball) are linked
   with one another. Equal directions are a ball each, whatever their number;
   then rounds over random-hyperplane buckets gather balls around
   each bucket's first vector; a ball is one node from then on, whatever its
   number of copies, and the rest are nodes of their own.
2. A neighbour graph over the nodes starts from buckets and is refined by
   joining neighbours of neighbours: at each node all pairs of its neighbours
   (forward and reverse) are compared where one of the two is new, and what
   improves a list enters it, until hardly anything does. A node whose list is
   full of neighbours that could still link is saturated: its list is doubled,
   up to LIST_MOST. Nodes that are saturated then are dense: lists of all their
   neighbours would take the cube of a group's size, so they are compared with
   all nodes of their region instead, block by block, counted and not listed.
3. Node pairs that may hold a link are decided exactly in double precision:
   all members at once where the triangle inequality settles it, else member by
   member in blocks, counted and not listed.
4. Recall is audited against brute force, query by query, on nodes drawn until
   enough of them have links outside their ball; where links are too rare for
   that, a further search has to agree. Each length of vectors has its own
   buckets and its own audit. Below the goal the search is repeated
   with more buckets and longer lists, and the links of all searches count; if
   it stays below, the operator fails.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import components, drop, shuffle_width, written

#: neighbours per list at first, bucket tables, vectors per bucket and block
LIST = 8
#: neighbours per list at most (more in a repeated search), nodes of a region
#: compared at once, and pivots that are drawn for regions at once
LIST_MOST = 64
REGION = 1024
PIVOTS = 4096
TABLES = 6
BUCKET = 64
BLOCK = 512
BALL_ROUNDS = 3
#: queries of the audit: in its first and its largest pass (their vectors travel
#: with the task), those with links that it wants, and those it asks at most
AUDIT_QUERIES = 400
AUDIT_STEP = 3200
AUDIT_LINKED = 100
AUDIT_MOST = 16_000
#: the goal, and searches (each with twice the tables and lists) to reach it
AUDIT_RECALL = 0.95
ATTEMPTS = 5
#: rounds of one search, after which it fails
MOST_ROUNDS = 200

_LOG = logging.getLogger(__name__)


# ---------------------------------------------------------------- batches

def _matrix(column, kind) -> np.ndarray:
    raw = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(raw)
    if not n:
        return np.zeros((0, 0), kind)
    off = np.frombuffer(raw.buffers()[1], np.int32, n + 1, raw.offset * 4)
    return np.frombuffer(raw.buffers()[2], np.uint8)[off[0]:off[-1]].view(kind).reshape(n, -1)


def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    n, width = len(rows), rows.shape[1] * rows.itemsize if rows.ndim == 2 else 0
    return pa.Array.from_buffers(pa.binary(), n, [
        None, pa.py_buffer((np.arange(n + 1, dtype=np.int64) * width).astype(np.int32).tobytes()),
        pa.py_buffer(rows.tobytes())])


def _planes(dim: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, max(bits, 1)))


def _by_length(batch, column: str = "v"):
    """The rows of a batch or table, cut by the length of their vectors (lists
    or bytes); the order within a length stays."""
    col = batch[column]
    size = np.asarray(pc.list_value_length(col) if pa.types.is_list(col.type) else pc.binary_length(col))
    lengths = np.unique(size)
    if len(lengths) == 1:
        yield batch
        return
    for n in lengths:
        yield batch.filter(pa.array(size == n))


def _counts(vectors: DataFrame) -> dict[int, int]:
    """Vectors of each length."""
    rows = vectors.groupBy((F.octet_length("v") / 8).cast("int").alias("d")).count().collect()
    return {r["d"]: r["count"] for r in rows}


def _bits(vectors: DataFrame) -> dict[int, int]:
    """Hyperplanes for each length, for some BUCKET vectors a bucket."""
    return {d: max(0, math.ceil(math.log2(n / BUCKET))) for d, n in _counts(vectors).items()}


def _sorted_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Whole groups of consecutive equal keys, several to a table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.asarray(batch[key])
        cut = int(np.searchsorted(k, k[-1]))
        if cut == 0 and held and held[-1][key][-1].as_py() == k[-1]:
            held.append(batch)
            continue
        head = held + ([batch.slice(0, cut)] if cut else [])
        if head:
            yield pa.Table.from_batches(head)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


# ------------------------------------------------------------ preparation

def _units(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec_id, h, v: the unit vector's doubles) of the different vectors
    that can link. ``id`` is the vector's own id; where an id has several
    vectors, all but the one of smallest hash get a hash of both as theirs."""
    e = df[vec_col].cast("array<double>")
    every = df.where(df[id_col].isNotNull()).select(df[id_col].cast("long").alias("vec_id"), e.alias("e"), F.xxhash64(e).alias("h")) \
        .groupBy("vec_id", "h").agg(F.first("e").alias("e"))
    several = written(every.groupBy("vec_id").agg(F.count(F.lit(1)).alias("k"), F.min("h").alias("first")).where("k > 1"), "nn-several")
    if several.limit(1).count():
        every = every.join(several.select("vec_id", "first"), "vec_id", "left") \
            .withColumn("id", F.when(F.col("first").isNull() | (F.col("h") == F.col("first")), F.col("vec_id")).otherwise(F.xxhash64("vec_id", "h")))
    else:
        every = every.withColumn("id", F.col("vec_id"))

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_length(whole, "e") if whole.num_rows else ():
                flat = np.asarray(batch["e"].flatten().fill_null(math.nan), float).reshape(batch.num_rows, -1)
                top = np.abs(flat).max(axis=1, keepdims=True)
                ok = np.isfinite(flat).all(axis=1) & (top[:, 0] > 0)
                x = flat[ok] / top[ok]
                x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
                if len(x):
                    keep = pa.array(ok)
                    yield pa.RecordBatch.from_arrays([batch["id"].filter(keep), batch["vec_id"].filter(keep), batch["h"].filter(keep), _binary(x)],
                                                     names=["id", "vec_id", "h", "v"])

    out = written(every.where("e IS NOT NULL AND size(e) > 0").select("id", "vec_id", "h", "e")
                  .mapInArrow(unit, "id long, vec_id long, h long, v binary"), "nn-units")
    drop(several)
    return out


def _bucketed(vectors: DataFrame, bits: dict[int, int], seeds: list[int]) -> DataFrame:
    """(id, v, bucket) once per seed; a bucket is the length of the vector and
    the signs of that length's projections."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = {}
        for whole in batches:
            for batch in _by_length(whole):
                x = _matrix(batch["v"], np.float64)
                if not len(x):
                    continue
                dim = x.shape[1]
                b = bits[dim]
                if dim not in planes:
                    planes[dim] = [_planes(dim, b, s) for s in seeds]
                power = (1 << np.arange(max(b, 1), dtype=np.int64)) if b else np.zeros(1, np.int64)
                for t, p in enumerate(planes[dim]):
                    key = (((x @ p > 0) @ power).astype(np.int64) * len(seeds) + t << 28) + dim
                    yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(key)], names=["id", "v", "bucket"])

    return vectors.mapInArrow(run, "id long, v binary, bucket long")


def _directions(vectors: DataFrame) -> DataFrame:
    """(id, v, bucket): a bucket is a direction, to about a millionth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_length(whole) if whole.num_rows else ():
                near = np.round(_matrix(batch["v"], np.float64) * 2 ** 20).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], _binary(near)], names=["id", "v", "near"])

    return vectors.mapInArrow(run, "id long, v binary, near binary").select("id", "v", F.xxhash64("near").alias("bucket"))


# ------------------------------------------------------------------ balls

def _balls(units: DataFrame, angle: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """(members: id, center, angle), (nodes: id, v, radius, size)."""
    half = angle / 2 - 1e-9
    bits = _bits(units)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_length(whole):
                dot = np.einsum("ij,ij->i", _matrix(batch["v"], np.float64), _matrix(batch["cv"], np.float64)) \
                    if batch.num_rows else np.zeros(0)
                a = np.arccos(np.clip(dot, -1, 1))
                ok = pa.array(a <= half)
                yield pa.RecordBatch.from_arrays([batch["id"].filter(ok), batch["center"].filter(ok), pa.array(a).filter(ok)],
                                                 names=["id", "center", "angle"])

    pool, found, stale = units, [], []
    for r in range(-1, BALL_ROUNDS):
        keyed = written(_directions(pool.select("id", "v")) if r < 0 else _bucketed(pool, bits, [seed + r]), "nn-pool")
        first = keyed.groupBy("bucket").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("k")).where("k > 1")
        lead = written(first.join(keyed.select(F.col("id").alias("center"), F.col("v").alias("cv")), "center")
                       .select("bucket", "center", "cv"), "nn-centers")
        got = written(keyed.join(lead, "bucket").where("id <> center").select("id", "v", "center", "cv")
                      .mapInArrow(near, "id long, center long, angle double"), "nn-members")
        gone = got.select("id").unionByName(got.select(F.col("center").alias("id")).distinct())
        pool = written(keyed.select("id", "v").join(gone, "id", "left_anti"), "nn-rest")
        found.append(got)
        stale += [keyed, lead, pool]
    members = found[0]
    for more in found[1:]:
        members = members.unionByName(more)
    members = written(members, "nn-ball-members")
    balls = members.groupBy(F.col("center").alias("id")).agg(F.max("angle").alias("radius"), (F.count(F.lit(1)) + 1).alias("size"))
    nodes = written(
        units.join(members.select("id"), "id", "left_anti").join(balls, "id", "left")
        .select("id", "v", F.coalesce("radius", F.lit(0.0)).alias("radius"), F.coalesce("size", F.lit(1)).cast("long").alias("size")),
        "nn-nodes")
    drop(*found, *stale)
    return members, nodes


# ------------------------------------------------------------- NN-descent

def _top(edges: DataFrame, k: DataFrame) -> DataFrame:
    """The best k neighbours of each node; a pair is new only if it was not in
    the graph before."""
    best = edges.groupBy("a", "b").agg(F.max("cos").alias("cos"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("cos"), "b"))
    return best.withColumn("r", rank).join(k, best["a"] == k["id"]).where("r <= k").select("a", "b", "cos", "fresh")


def _start(nodes: DataFrame, tables: int, keep: int, seed: int) -> DataFrame:
    """First lists: the nearest of each bucket, over several bucketings. Large
    buckets are cut into chunks at random."""
    bits = _bits(nodes)
    keyed = _bucketed(nodes.select("id", "v"), bits, [seed + 100 + t for t in range(tables)])
    size = written(_bucketed(nodes.select("id", "v"), bits, [seed + 100 + t for t in range(tables)])
                   .groupBy("bucket").count().where(F.col("count") > BLOCK), "nn-large")
    cut = keyed.join(size, "bucket", "left").withColumn(
        "chunk", F.pmod(F.xxhash64("id", "bucket"), F.coalesce(F.ceil(F.col("count") / BLOCK), F.lit(1)))) \
        .select("id", "v", "bucket", "chunk")

    def nearest(key, table):
        x = _matrix(table["v"], np.float64)
        ids = table["id"].to_numpy()
        s = x @ x.T
        np.fill_diagonal(s, -2)
        k = min(keep, len(ids) - 1)
        if k < 1:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "cos": pa.array([], pa.float64())})
        best = np.argpartition(-s, k - 1, axis=1)[:, :k]
        return pa.table({"a": np.repeat(ids, k), "b": ids[best].ravel(), "cos": np.take_along_axis(s, best, 1).ravel()})

    return cut.groupBy("bucket", "chunk").applyInArrow(nearest, "a long, b long, cos double")


def _refine(graph: DataFrame, nodes: DataFrame, k: DataFrame, parts: int) -> DataFrame:
    """One round of neighbours of neighbours: (a, b, cos) that may enter a's
    list."""
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("cos"), "a"))
    back = graph.select(F.col("b").alias("u"), "a", "cos", "fresh").withColumn("r", rank)
    back = back.join(k, back["u"] == k["id"]).where("r <= k").select("u", "a", "fresh")
    lists = graph.select(F.col("a").alias("u"), F.col("b").alias("a"), "fresh").unionByName(back) \
        .groupBy("u", "a").agg(F.max("fresh").alias("fresh"))
    busy = lists.groupBy("u").agg(F.max("fresh").alias("any")).where("any").select("u")
    worst = graph.groupBy("a").agg(F.min("cos").alias("worst"), F.count(F.lit(1)).alias("n"))
    floor = worst.join(k, worst["a"] == k["id"]).select("a", F.when(F.col("n") < F.col("k"), F.lit(-2.0)).otherwise(F.col("worst")).alias("floor"))
    known = nodes.select(F.col("id").alias("a"), "v").join(floor, "a", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0)))
    rows = lists.join(busy, "u").join(known, "a").select("u", "a", "fresh", "floor", "v") \
        .repartition(parts, "u").sortWithinPartitions("u")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in (part for whole in _sorted_groups(batches, "u") for part in _by_length(whole)):
            u, a = table["u"].to_numpy(), table["a"].to_numpy()
            fresh, floor = table["fresh"].to_numpy(), table["floor"].to_numpy()
            x = _matrix(table["v"], np.float64)
            edge = np.flatnonzero(np.append(True, u[1:] != u[:-1]))
            out = []
            for lo, hi in zip(edge, np.append(edge[1:], len(u))):
                if hi - lo < 2:
                    continue
                s = x[lo:hi] @ x[lo:hi].T
                s[~(fresh[lo:hi, None] | fresh[None, lo:hi])] = -2
                np.fill_diagonal(s, -2)
                i, j = np.nonzero(s > floor[lo:hi, None])
                if len(i):
                    out.append((a[lo:hi][i], a[lo:hi][j], s[i, j]))
                if sum(len(c[0]) for c in out[-BLOCK:]) > BLOCK * BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b", "cos"])
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b", "cos"])

    return rows.mapInArrow(pairs, "a long, b long, cos double")


def _graph(nodes: DataFrame, angle: float, tables: int, keep: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """((a, b, cos): the neighbour lists after NN-descent, (id): the dense
    nodes, whose longest list does not hold all that could link)."""
    spark = nodes.sparkSession
    parts = shuffle_width(spark)
    sizes = _counts(nodes)
    n = sum(sizes.values())
    k = written(nodes.select("id", F.lit(keep).cast("long").alias("k")), "nn-k")
    most = max(LIST_MOST, keep)
    fresh = F.lit(True)
    graph = written(_top(_start(nodes, tables, keep, seed).withColumn("fresh", fresh), k), "nn-graph")
    widest = nodes.agg(F.max("radius")).first()[0] or 0.0
    for round_ in range(1, MOST_ROUNDS + 1):
        found = _refine(graph, nodes, k, parts).withColumn("fresh", fresh)
        new = written(_top(graph.withColumn("fresh", F.lit(False)).unionByName(found), k), "nn-graph")
        drop(graph)
        graph = new
        full = written(graph.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("cos").alias("worst"), F.count_if("fresh").alias("entered"))
                       .join(nodes, F.col("a") == nodes["id"]).select("id", "n", "worst", "entered", "radius", F.octet_length("v").alias("bytes")), "nn-full")
        entered = {r["bytes"] // 8: r["entered"] for r in full.groupBy("bytes").agg(F.sum("entered").alias("entered")).collect()}
        can = F.cos(F.least(F.lit(math.pi), F.lit(angle) + F.col("radius") + F.lit(widest)))
        saturated = written(full.join(k, "id").where((F.col("n") >= F.col("k")) & (F.col("worst") >= can) & (F.col("n") < n - 1))
                            .select("id", "k"), "nn-saturated")
        drop(full)
        if saturated.where(F.col("k") < most).limit(1).count():
            short = saturated.where(F.col("k") < most).select("id")
            wider = written(k.join(short.withColumn("s", F.lit(True)), "id", "left")
                            .select("id", F.when(F.col("s"), F.col("k") * 2).otherwise(F.col("k")).alias("k")), "nn-k")
            # a longer list looks at all its neighbours' neighbours again
            again = written(graph.join(short.withColumnRenamed("id", "a").withColumn("s", F.lit(True)), "a", "left")
                            .select("a", "b", "cos", (F.col("fresh") | F.coalesce("s", F.lit(False))).alias("fresh")), "nn-graph")
            drop(k, graph, saturated)
            k, graph = wider, again
        elif all(entered.get(d, 0) <= 0.002 * m * keep for d, m in sizes.items()):
            _LOG.info("nn-descent: %d nodes, %d tables, lists from %d: %d rounds", n, tables, keep, round_)
            drop(k)
            return graph, saturated.select("id")
        else:
            drop(saturated)
    raise RuntimeError(f"near_duplicates: the neighbour graph of {n} nodes does not settle in {MOST_ROUNDS} rounds")


# ---------------------------------------------------------- dense regions

def _leaders(drawn: pa.Table, within: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, vectors), one entry a length of vectors: of the drawn nodes, in
    their order, those without an earlier one ``within`` that angle."""
    out = []
    for part in _by_length(drawn):
        x, ids = _matrix(part["v"], np.float64), part["id"].to_numpy()
        free, kept = np.ones(len(ids), bool), []
        for i in range(len(ids)):
            if free[i]:
                kept.append(i)
                free &= x @ x[i] < math.cos(within)
        out.append((ids[kept], x[kept]))
    return out


def _regions(own: DataFrame, angle: float, widest: float, seed: int):
    """(id, pivot, apart: the angle between them) of the dense nodes, each with
    one pivot, and the pivots by length as in :func:`_leaders`. A dense node has
    many neighbours within ``angle + widest``, so few pivots serve all."""
    within = min(angle + widest, math.pi / 2)
    rest, parts, every, round_ = own, [], [], 0
    while True:
        drawn = rest.select("id", "v").orderBy(F.xxhash64("id", F.lit(seed + round_)), "id").limit(PIVOTS).toArrow()
        if not drawn.num_rows:
            return parts, every
        found = _leaders(drawn, within)
        near_of = {x.shape[1]: (ids, x) for ids, x in found}

        def near(batches: Iterator[pa.RecordBatch], near_of=near_of) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in _by_length(whole) if whole.num_rows else ():
                    x = _matrix(batch["v"], np.float64)
                    if x.shape[1] not in near_of:
                        continue
                    ids, lead = near_of[x.shape[1]]
                    for lo in range(0, len(x), step := max(1, BLOCK * BLOCK // len(ids))):
                        s = x[lo:lo + step] @ lead.T
                        best = s.argmax(axis=1)
                        a = np.arccos(np.clip(s[np.arange(len(s)), best], -1, 1))
                        ok = a <= within + 1e-6
                        yield pa.RecordBatch.from_arrays([batch["id"].slice(lo, step).filter(pa.array(ok)), pa.array(ids[best[ok]]), pa.array(a[ok])],
                                                         names=["id", "pivot", "apart"])

        got = written(rest.select("id", "v").mapInArrow(near, "id long, pivot long, apart double"), "nn-regions")
        left = written(rest.join(got.select("id"), "id", "left_anti"), "nn-outside")
        if rest is not own:
            drop(rest)
        rest, round_ = left, round_ + 1
        parts.append(got)
        every += found


def _joined(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Components of a block's links: for each row and each column the smallest
    row in its component (the number of rows where it has none)."""
    none = np.int32(len(hit))
    row, col = np.arange(len(hit), dtype=np.int32), None
    while True:
        col = np.where(hit, row[:, None], none).min(axis=0, initial=none)
        now = np.minimum(row, np.where(hit, col[None, :], none).min(axis=1, initial=none))
        if (now == row).all():
            return row, col
        row = now


def _dense(nodes: DataFrame, dense: DataFrame, angle: float, cosine: float, seed: int) -> DataFrame:
    """Decides all pairs of nodes of which one is dense at least: (kind, a, b,
    na, nb), where kind 0 is a's number of links (na) with whole nodes, 1 an
    edge of the graph's components and 2 a pair that its members have to decide.

    A dense node a meets in its pivot's region all nodes that are as near to the
    pivot as a link with any of the region's allows (triangle inequality). A
    region's dense nodes are cut into blocks, the rest of a region streams past
    each block.
    """
    parts = shuffle_width(nodes.sparkSession)
    own = written(nodes.join(dense, "id"), "nn-dense")
    widest = nodes.agg(F.max("radius")).first()[0] or 0.0
    frames, pivots = _regions(own, angle, widest, seed)
    home = frames[0]
    for more in frames[1:]:
        home = home.unionByName(more)
    home = written(home.join(own, "id"), "nn-home")
    sizes = written(home.groupBy("pivot").agg(F.count(F.lit(1)).alias("m"), (F.max(F.col("apart") + F.col("radius")) + angle + 1e-6).alias("reach"))
                    .withColumn("blocks", F.ceil(F.col("m") / REGION).cast("long")), "nn-reach")
    reach = {r["pivot"]: r["reach"] for r in sizes.select("pivot", "reach").toLocalIterator()}
    lead: dict[int, list] = {}
    for ids, x in pivots:
        some = np.array([i in reach for i in ids.tolist()], bool)
        if some.any():
            lead.setdefault(x.shape[1], []).append((ids[some], x[some], np.array([reach[i] for i in ids[some].tolist()])))
    table = {d: [np.concatenate(c) for c in zip(*some)] for d, some in lead.items()}

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_length(whole) if whole.num_rows else ():
                x, radius = _matrix(batch["v"], np.float64), batch["radius"].to_numpy()
                if x.shape[1] not in table:
                    continue
                ids, at, far = table[x.shape[1]]
                for lo in range(0, len(x), step := max(1, BLOCK * BLOCK // len(ids))):
                    apart = np.arccos(np.clip(x[lo:lo + step] @ at.T, -1, 1))
                    i, p = np.nonzero(apart <= far + radius[lo:lo + step, None])
                    for c in range(0, len(i), 8 * BLOCK):
                        some = batch.slice(lo, step).take(pa.array(i[c:c + 8 * BLOCK]))
                        yield pa.RecordBatch.from_arrays([pa.array(ids[p[c:c + 8 * BLOCK]]), *[some[n] for n in ("id", "v", "radius", "size")]],
                                                         names=["pivot", "id", "v", "radius", "size"])

    cols = ["pivot", "i", "side", "id", "v", "radius", "size", "dense"]
    blocks = sizes.select("pivot", "blocks")
    left = home.join(blocks, "pivot").withColumn("i", F.pmod(F.xxhash64("id"), F.col("blocks"))).withColumn("side", F.lit(0)).withColumn("dense", F.lit(True))
    right = nodes.select("id", "v", "radius", "size").mapInArrow(around, "pivot long, id long, v binary, radius double, size long") \
        .join(dense.withColumn("d", F.lit(True)), "id", "left").join(blocks, "pivot") \
        .withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("side", F.lit(1)).withColumn("dense", F.coalesce("d", F.lit(False)))
    rows = left.select(*cols).unionByName(right.select(*cols)).repartition(parts, "pivot", "i").sortWithinPartitions("pivot", "i", "side")

    def said(kind, a, b=None, na=None, nb=None):
        zero = np.zeros(len(a), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), *[pa.array(zero if c is None else c.astype(np.int64)) for c in (a, b, na, nb)]],
                                          names=["kind", "a", "b", "na", "nb"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, n = None, [], None
        for batch in batches:
            pivot, i, side = (batch[c].to_numpy() for c in ("pivot", "i", "side"))
            cut = np.flatnonzero((pivot[1:] != pivot[:-1]) | (i[1:] != i[:-1]) | (side[1:] != side[:-1])) + 1
            for lo, hi in zip(np.append(0, cut), np.append(cut, batch.num_rows)):
                if lo == hi:
                    continue
                if key != (pivot[lo], i[lo]):
                    if n is not None:
                        yield said(0, held[0], na=n)
                    key, held, n = (pivot[lo], i[lo]), [], None
                for at in range(lo, hi, REGION):
                    part = batch.slice(at, min(REGION, hi - at))
                    new = [part["id"].to_numpy(), _matrix(part["v"], np.float64), part["radius"].to_numpy(), part["size"].to_numpy()]
                    if side[lo] == 0:
                        held.append(new)
                        continue
                    if n is None:
                        held = [np.concatenate(c) for c in zip(*held)]
                        n = np.zeros(len(held[0]), np.int64)
                    (a, x, ra, na), (b, y, rb, nb) = held, new
                    dense_b = part["dense"].to_numpy(zero_copy_only=False)
                    other, cos = a[:, None] != b[None, :], x @ y.T
                    hit = other & (cos >= cosine)
                    if (na > 1).any() or (nb > 1).any():
                        apart, wide = np.arccos(np.clip(cos, -1, 1)), ra[:, None] + rb[None, :]
                        balls = (na > 1)[:, None] | (nb > 1)[None, :]
                        hit = np.where(balls, other & (apart + wide <= angle - 1e-9), hit)
                        unsure = other & balls & ~hit & (apart <= angle + wide + 1e-9) & (~dense_b[None, :] | (a[:, None] < b[None, :]))
                        u, v = np.nonzero(unsure)
                        if len(u):
                            yield said(2, a[u], b[v], na[u], nb[v])
                    if not hit.any():
                        continue
                    n += hit @ nb
                    back = np.where(dense_b, 0, na @ hit)
                    if (back > 0).any():
                        yield said(0, b[back > 0], na=back[back > 0])
                    row, col = _joined(hit)
                    r, c = np.flatnonzero(row != np.arange(len(row))), np.flatnonzero(col < len(row))
                    yield said(1, np.concatenate([a[r], b[c]]), np.concatenate([a[row[r]], a[col[c]]]))
        if n is not None:
            yield said(0, held[0], na=n)

    out = written(rows.mapInArrow(compare, "kind int, a long, b long, na long, nb long"), "nn-dense-links")
    drop(own, home, sizes, *frames)
    return out


# ------------------------------------------------------------------ links

def _links(graph: DataFrame, nodes: DataFrame, members: DataFrame, units: DataFrame, cosine: float, dense: DataFrame, seed: int = 0):
    """(counts: id, n), (edges between nodes: a, b) of the pairs of nodes that
    the graph names, and of all pairs with a dense node."""
    angle = math.acos(cosine)
    ball = nodes.select("id", "radius", "size")
    pair = graph.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "cos").dropDuplicates(["a", "b"])
    some = dense.limit(1).count() > 0
    if some:
        pair = pair.join(dense.toDF("a"), "a", "left_anti").join(dense.toDF("b"), "b", "left_anti")
    pair = pair.join(ball.toDF("a", "ra", "na"), "a").join(ball.toDF("b", "rb", "nb"), "b") \
        .withColumn("apart", F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("cos")))))
    pair = written(pair.where(F.col("apart") <= angle + F.col("ra") + F.col("rb") + 1e-9), "nn-pairs")
    sure = F.col("apart") + F.col("ra") + F.col("rb") <= angle - 1e-9
    alone = (F.col("na") == 1) & (F.col("nb") == 1)
    linked = pair.where(F.when(alone, F.col("cos") >= cosine).otherwise(sure))
    open_ = pair.where(~alone & ~sure).select("a", "b", "na", "nb")
    if some:
        region = _dense(nodes, dense, angle, cosine, seed)
        open_ = open_.unionByName(region.where("kind = 2").select("a", "b", "na", "nb"))

    inside = members.select(F.col("center").alias("node"), "id").unionByName(nodes.select(F.col("id").alias("node"), "id"))
    held = units.join(inside, "id").select("node", "id", "v")
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("long")
    spot = lambda n: F.pmod(F.xxhash64("id"), blocks(n))
    left = open_.join(held, open_["a"] == held["node"]).select(
        "a", "b", spot("na").alias("i"), F.explode(F.sequence(F.lit(0).cast("long"), blocks("nb") - 1)).alias("j"), "id", "v", F.lit(0).alias("side"))
    right = open_.join(held, open_["b"] == held["node"]).select(
        "a", "b", F.explode(F.sequence(F.lit(0).cast("long"), blocks("na") - 1)).alias("i"), spot("nb").alias("j"), "id", "v", F.lit(1).alias("side"))

    def compare(key, table):
        side = table["side"].to_numpy()
        x, ids = _matrix(table["v"], np.float64), table["id"].to_numpy()
        hit = x[side == 0] @ x[side == 1].T >= cosine
        n = np.concatenate([hit.sum(axis=1), hit.sum(axis=0)])
        who = np.concatenate([ids[side == 0], ids[side == 1]])
        some = n > 0
        return pa.table({"a": np.full(some.sum(), key[0].as_py()), "b": np.full(some.sum(), key[1].as_py()),
                         "id": who[some], "n": n[some].astype(np.int64)})

    exact = written(left.unionByName(right).groupBy("a", "b", "i", "j").applyInArrow(compare, "a long, b long, id long, n long"),
                    "nn-exact")
    whole = linked.select(F.col("a").alias("node"), F.col("nb").alias("n")).unionByName(linked.select(F.col("b").alias("node"), F.col("na").alias("n")))
    if some:
        whole = whole.unionByName(region.where("kind = 0").select(F.col("a").alias("node"), F.col("na").alias("n")))
    whole = whole.groupBy("node").agg(F.sum("n").alias("n"))
    own = inside.join(ball.select(F.col("id").alias("node"), (F.col("size") - 1).alias("own")), "node") \
        .join(whole, "node", "left").select("id", (F.col("own") + F.coalesce("n", F.lit(0))).alias("n"))
    counts = own.unionByName(exact.select("id", "n")).groupBy("id").agg(F.sum("n").alias("n"))
    edges = linked.select("a", "b").unionByName(exact.select("a", "b").distinct())
    if some:
        edges = edges.unionByName(region.where("kind = 1").select("a", "b"))
    return counts, edges, inside


def _outer(n: str):
    """Links of a node's vector that its own ball does not give for free."""
    return F.greatest(F.lit(0), F.coalesce(F.col(n), F.lit(0)) - (F.col("size") - 1))


def _audit(nodes: DataFrame, units: DataFrame, counts: DataFrame, cosine: float) -> tuple[float, bool]:
    """(mean over queries of the share of a query's links that was found,
    whether the queries suffice).

    A query is a node: a ball asks once, whatever its number of copies, and
    only links that leave the ball count. Nodes are drawn by the hash of their
    id until AUDIT_LINKED of them have such links; fewer suffice only if all
    nodes were asked. All vectors are compared with them, in blocks.
    """
    order = nodes.select("id", "v", F.xxhash64("id").alias("h"))
    share, linked, asked, step, last = 0.0, 0, 0, AUDIT_QUERIES, None
    while linked < AUDIT_LINKED and asked < AUDIT_MOST:
        rest = order if last is None else order.where((F.col("h") > last[0]) | (F.col("h") == last[0]) & (F.col("id") > last[1]))
        drawn = rest.orderBy("h", "id").limit(step).toArrow()
        if not drawn.num_rows:
            return (share / linked if linked else 1.0), True
        last = drawn["h"][-1].as_py(), drawn["id"][-1].as_py()
        q, who = _matrix(drawn["v"], np.float64), drawn["id"].to_numpy()

        def brute(batches: Iterator[pa.RecordBatch], q=q, who=who) -> Iterator[pa.RecordBatch]:
            n = np.zeros(len(who), np.int64)
            for batch in batches:
                for lo in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(lo, BLOCK)
                    hit = _matrix(part["v"], np.float64) @ q.T >= cosine
                    n += (hit & (part["id"].to_numpy()[:, None] != who[None, :])).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(n)], names=["id", "true"])

        true = units.mapInArrow(brute, "id long, true long").groupBy("id").agg(F.sum("true").alias("true"))
        got = true.join(nodes.select("id", "size"), "id").join(counts, "id", "left").where(_outer("true") > 0) \
            .agg(F.count(F.lit(1)).alias("k"), F.sum(F.least(_outer("true"), _outer("n")) / _outer("true")).alias("share")).first()
        share, linked, asked = share + (got["share"] or 0.0), linked + got["k"], asked + drawn.num_rows
        step = min(2 * step, AUDIT_STEP)
    return (share / linked if linked else 1.0), linked >= AUDIT_LINKED


def _agreement(nodes: DataFrame, before: DataFrame, now: DataFrame) -> float:
    """Mean over the nodes with links by now of the share that was found
    before."""
    both = nodes.select("id", "size").join(now, "id").join(before.withColumnRenamed("n", "old"), "id", "left").where(_outer("n") > 0)
    share = both.agg(F.avg(F.least(_outer("old"), _outer("n")) / _outer("n"))).first()[0]
    return 1.0 if share is None else share


def _likely(nodes: DataFrame, graph: DataFrame) -> DataFrame:
    """The nodes whose best neighbour is nearest: where links are rare, these
    are the ones to ask."""
    best = graph.groupBy("a").agg(F.max("cos").alias("best"))
    return nodes.join(best, nodes["id"] == best["a"]).orderBy(F.desc("best"), "id").limit(AUDIT_STEP).select(*nodes.columns)


def near_duplicates(vectors: DataFrame, cosine: float = 0.95, id_col: str = "vec_id", vec_col: str = "embedding",
                    seed: int = 11) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    Two vectors are linked if found with a cosine of at least ``cosine`` in
    double precision. Null and zero vectors and those with null or
    non-finite components link with nothing: no links, a component of their
    own. Vectors of different lengths do not link. Equal rows count as one
    vector; rows with the same id and different vectors are vectors of their
    own. A null id has no links and no component. The recall that the audit
    finds is logged.
    An empty table gives no rows; other columns are ignored.
    """
    angle = math.acos(cosine)
    units = _units(vectors, id_col, vec_col)
    members, nodes = _balls(units, angle, seed)
    tables, keep = TABLES, LIST
    lengths = _counts(nodes)
    graph = before = dense = None
    for attempt in range(ATTEMPTS):
        more, full = _graph(nodes, angle, tables, keep, seed + 1000 * attempt)
        if graph is None:
            graph, dense = more, full
        else:
            dense = written(dense.unionByName(full).distinct(), "nn-dense-ids")
            both = written(graph.select("a", "b", "cos").unionByName(more.select("a", "b", "cos"))
                           .groupBy("a", "b").agg(F.max("cos").alias("cos")), "nn-graphs")
            drop(graph, more)
            graph = both
        counts, edges, inside = _links(graph, nodes, members, units, cosine, dense, seed)
        counts = written(counts, "nn-counts")
        recall = 1.0
        for length in sorted(lengths):
            of_length = F.octet_length("v") == 8 * length
            own = nodes.where(of_length)
            found, enough = _audit(own, units.where(of_length), counts, cosine)
            if not enough and found >= AUDIT_RECALL:
                # links too rare to draw: those nodes are asked that have the nearest
                # neighbours, and a further search has to find no others
                likely = written(_likely(own, graph), "nn-likely")
                found = min(_audit(likely, units.where(of_length), counts, cosine)[0], 0.0 if before is None else _agreement(own, before, counts))
                drop(likely)
            _LOG.info("nn-descent: recall %.4f of the vectors of %d numbers after %d searches", found, length, attempt + 1)
            recall = min(recall, found)
            if recall < AUDIT_RECALL:
                break
        if recall >= AUDIT_RECALL:
            break
        before, tables, keep = counts, tables * 2, keep * 2
    else:
        raise RuntimeError(f"near_duplicates: recall {recall:.3f} after {ATTEMPTS} searches, the goal is {AUDIT_RECALL}")
    of = components(edges, "nn-components")
    label = written(inside.join(of, "node", "left").select("id", F.coalesce("component", "node").alias("root"))
                    .join(units.select("id", "vec_id", "h"), "id"), "nn-labels")
    least = written(label.groupBy("root").agg(F.min("vec_id").alias("component")), "nn-least")
    known = written(label.join(least, "root").join(counts, "id", "left").select("vec_id", "h", "component", "n").withColumnRenamed("vec_id", "own"), "nn-known")
    every = vectors.select(vectors[id_col].cast("long").alias("vec_id"), F.xxhash64(vectors[vec_col].cast("array<double>")).alias("row_h"))
    out = every.join(known, (every["vec_id"] == known["own"]) & (every["row_h"] == known["h"]), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
