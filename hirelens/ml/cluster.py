"""Clustering (ML-10..ML-12): nearest-center assignment, squared-Euclidean
silhouette in linear time, and the K scan by batched Lloyd rounds.

Centers and per-cluster sums are bounded by k x dim, so they are the only
values inlined into the plan. The scan fits every start of every K at the same
time: a round is one pass over the points, in which each batch is compared
with the centres of all fits that still move, and a task sends one row of sums
a centre. For that the points are packed once into boxes of near ones: where all
points of a box have the same nearest centre (no other is nearer at any corner),
the box's sums stand for them, and only the other boxes are looked into.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens import dims


def _vec_lit(v) -> "F.Column":
    return F.array(*[F.lit(float(x)) for x in v])


def _sqdist(a, b) -> "F.Column":
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, z: acc + z)


def _dot(a, b) -> "F.Column":
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, z: acc + z)


def assign_nearest(df: DataFrame, vec: str, centers: list) -> DataFrame:
    """Label each row with its nearest center (squared Euclidean; ties go to
    the lower center index) and that distance."""
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    d = df.withColumn("_v", v)
    dists = F.array(*[F.struct(_sqdist(F.col("_v"), _vec_lit(c)).alias("d"), F.lit(i).alias("c"))
                      for i, c in enumerate(centers)])
    best = F.array_min(dists)
    return d.withColumn("_best", best).withColumn("cluster", F.col("_best.c")) \
            .withColumn("dist", F.col("_best.d")).drop("_best", "_v")


def first_k_centers(df: DataFrame, key: str, vec: str, k: int) -> list:
    """The k rows with the smallest key as fixed centers (k vectors, bounded)."""
    return [[float(x) for x in r[vec]] for r in df.orderBy(key).select(vec).limit(k).collect()]


def silhouette(df: DataFrame, vec: str, label: str = "cluster") -> DataFrame:
    """Per-row silhouette with squared Euclidean distance, exact, linear in n:
    sum_{y in C} |x - y|^2 = n_C |x|^2 - 2 x.S_C + Q_C, with n_C, S_C (vector
    sum) and Q_C (sum of squared norms) per cluster. a excludes the point
    itself (n_C - 1), b is the smallest mean distance to another cluster;
    singleton clusters score 0."""
    v = F.transform(F.col(vec), lambda x: x.cast("double"))
    d = df.withColumn("_v", v).withColumn("_q", _dot(F.col("_v"), F.col("_v")))
    dim = len(d.select("_v").first()["_v"])
    stats = (d.groupBy(label)
              .agg(F.count(F.lit(1)).alias("n"), F.sum("_q").alias("q"),
                   *[F.sum(F.col("_v")[i]).alias(f"s{i}") for i in range(dim)])
              .orderBy(label).collect())  # k rows x (dim + 2) numbers
    terms = []
    for s in stats:
        svec = _vec_lit([s[f"s{i}"] for i in range(dim)])
        total = F.lit(float(s["n"])) * F.col("_q") - 2 * _dot(F.col("_v"), svec) + F.lit(float(s["q"]))
        terms.append(F.struct(F.lit(s[label]).alias("c"), F.lit(int(s["n"])).alias("n"), total.alias("t")))
    d = d.withColumn("_terms", F.array(*terms))
    own = F.filter("_terms", lambda t: t["c"] == F.col(label))[0]
    others = F.transform(F.filter("_terms", lambda t: t["c"] != F.col(label)), lambda t: t["t"] / t["n"])
    a = F.when(own["n"] > 1, own["t"] / (own["n"] - 1))
    b = F.array_min(others)
    s = F.when(own["n"] <= 1, F.lit(0.0)).otherwise((b - a) / F.greatest(a, b))
    return d.withColumn("silhouette", s).drop("_v", "_q", "_terms")


# ---------------------------------------------------------- batched Lloyd

#: points compared with all centres at once
_STEP = 4096
#: points times centres of a pass that are looked at together (2 MB of doubles)
_CELLS = 1 << 18
#: rounds of k-means|| and points drawn in each, in expectation, per cluster wanted
SEED_ROUNDS = 4
SEED_FACTOR = 2


@dataclass
class Fit:
    """One start of one K: its centres, sizes and cost, and whether it stands still."""
    centers: np.ndarray
    sizes: np.ndarray
    cost: float = float("inf")
    still: bool = False

    @property
    def k(self) -> int:
        return len(self.centers)


def _points(batch) -> np.ndarray:
    vectors = batch.column("features")
    off = np.asarray(vectors.offsets)
    return np.asarray(vectors.values)[off[0]:off[-1]].astype(float).reshape(batch.num_rows, -1)


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, as sums of squared differences."""
    out = np.zeros((len(x), len(centers)))
    for i in range(x.shape[1]):
        out += (x[:, i, None] - centers[None, :, i]) ** 2
    return out


@dataclass
class _Layout:
    """The centres of all fits in one table, the first of each fit, then the
    second of each that has one and so on, fits with many centres first:
    ``fits`` that order, ``rows`` the centres' places before, ``blocks`` the
    rows (lo, hi) of the j-th centres."""
    centers: np.ndarray
    fits: np.ndarray
    rows: np.ndarray
    blocks: list[tuple[int, int]]
    ends: np.ndarray

    @classmethod
    def of(cls, every: np.ndarray, ends: np.ndarray) -> _Layout:
        size = np.diff(ends)
        fits = np.argsort(-size, kind="stable")
        rows, blocks, lo = [], [], 0
        for j in range(size.max(initial=0)):
            some = ends[:-1][fits][size[fits] > j] + j
            rows.append(some)
            blocks.append((lo, lo + len(some)))
            lo += len(some)
        return cls(every, fits, np.concatenate(rows), blocks, ends)

    def nearest(self, x: np.ndarray) -> np.ndarray:
        """For each fit, in the order of ``fits``, the nearest centre of each
        point. One product compares all; where it leaves two centres within its
        rounding, sums of squared differences decide (ties: the lower)."""
        c = self.centers[self.rows]
        square = (c * c).sum(axis=1)
        score = np.column_stack([-2 * c, square]) @ np.vstack([x.T, np.ones(len(x))])
        best = score[slice(*self.blocks[0])].copy()
        second, own = np.full_like(best, np.inf), np.zeros(best.shape, np.int32)
        for j, (lo, hi) in enumerate(self.blocks[1:], 1):
            s, b, m = score[lo:hi], best[:hi - lo], hi - lo
            np.copyto(own[:m], j, where=s < b)
            np.minimum(second[:m], np.maximum(s, b), out=second[:m])
            np.minimum(b, s, out=b)
        unsure = 16 * (x.shape[1] + 4) * np.finfo(float).eps * ((x * x).sum(axis=1) + 2 * square.max())
        close = ~(second - best > unsure)
        for i in np.flatnonzero(close.any(axis=1)):
            f, at = self.fits[i], np.flatnonzero(close[i])
            own[i, at] = _distances(x[at], self.centers[self.ends[f]:self.ends[f + 1]]).argmin(axis=1)
        return own

    def sums(self, x: np.ndarray) -> np.ndarray:
        """A row a centre of all fits: points, their squared norms, their squared
        distances, the points' sum."""
        own = self.nearest(x)
        hot = np.empty((len(self.rows), len(x)))
        for j, (lo, hi) in enumerate(self.blocks):
            np.equal(own[:hi - lo], j, out=hot[lo:hi])
        norm = (x * x).sum(axis=1)
        got = hot @ np.column_stack([np.ones(len(x)), norm, x])
        c = self.centers[self.rows]
        whole = got[:, 1] + got[:, 0] * (c * c).sum(axis=1)
        cost = whole - 2 * (c * got[:, 2:]).sum(axis=1)
        # what is left of such a difference is rounding: the points themselves
        for i in np.flatnonzero((got[:, 0] > 0) & ~(cost > 1e-6 * whole)):
            cost[i] = _distances(x[hot[i] > 0], c[i:i + 1]).sum()
        out = np.empty((len(got), got.shape[1] + 1))
        out[self.rows] = np.column_stack([got[:, :2], cost, got[:, 2:]])
        return out


#: points of a box, and points that are dealt to boxes together
_LEAF = 64
_CHUNK = 1 << 18
#: what a point's distance to one fit's centre takes, as times of that to one of all at once
_PRODUCT = 2


def _leaves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order of the points, ends of boxes in it): halves of the widest side
    down to _LEAF points; equal points share a box of up to 64 times as many."""
    order, ends, stack = np.arange(len(x)), [], [(0, len(x))]
    while stack:
        lo, hi = stack.pop()
        part = x[order[lo:hi]]
        side = np.ptp(part, axis=0)
        if hi - lo <= _LEAF or side.max() == 0 and hi - lo <= 64 * _LEAF:
            ends.append(hi)
            continue
        mid = (hi - lo) // 2
        order[lo:hi] = order[lo:hi][np.argpartition(part[:, side.argmax()], mid)]
        stack += [(lo + mid, hi), (lo, lo + mid)]
    return order, np.array(ends)


def boxed(points: DataFrame, key: str) -> DataFrame:
    """(head, x, h) of ``points``, written: a row is a box with its figures (size,
    least and largest coordinates, mean, squared distances to the mean), its
    points and the hashes of their keys. The points come sorted, so that boxes
    of a chunk are small."""
    from hirelens.session import materialize
    dim = len(points.select("features").first()[0])
    near = [F.col("features")[i] for i in range(min(dim, 4))]
    rows = points.select("features", F.xxhash64(key).alias("h"))
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, *near, "h").sortWithinPartitions(*near)

    def packed(x, h):
        order, ends = _leaves(x)
        x, h = x[order], h[order]
        starts = np.append(0, ends[:-1])
        n = (ends - starts).astype(float)
        lo, hi = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
        mean = np.clip(np.add.reduceat(x, starts) / n[:, None], lo, hi)
        q = np.add.reduceat(((x - np.repeat(mean, ends - starts, axis=0)) ** 2).sum(axis=1), starts)
        head = np.column_stack([n, lo, hi, mean, q])

        def column(data, width, ends):
            at = np.append(0, ends).astype(np.int64) * width
            return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())])

        yield pa.RecordBatch.from_arrays([column(head, head.shape[1] * 8, np.arange(1, len(ends) + 1)), column(x, dim * 8, ends), column(h, 8, ends)], names=["head", "x", "h"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((_points(batch), np.asarray(batch.column("h"))))
            size += batch.num_rows
            if size >= _CHUNK:
                yield from packed(*map(np.concatenate, zip(*held)))
                held, size = [], 0
        if held:
            yield from packed(*map(np.concatenate, zip(*held)))

    return materialize(rows.mapInArrow(run, "head binary, x binary, h binary"), "kmeans-boxes")


@dataclass
class _Boxes:
    """The boxes of an Arrow batch; the points of box i are ``x[at[i]:at[i + 1]]``."""
    n: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    mean: np.ndarray
    q: np.ndarray
    x: np.ndarray
    h: np.ndarray
    at: np.ndarray

    @classmethod
    def of(cls, batch, dim: int) -> _Boxes:
        def flat(name, kind):
            column = batch.column(name)
            off = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4)
            return np.frombuffer(column.buffers()[2], np.uint8)[off[0]:off[-1]].view(kind)

        head = flat("head", np.float64).reshape(batch.num_rows, -1)
        n = np.rint(head[:, 0]).astype(np.int64)
        parts = [head[:, 1 + i * dim:1 + (i + 1) * dim] for i in range(3)]
        return cls(n, *parts, head[:, -1], flat("x", np.float64).reshape(-1, dim), flat("h", np.int64), np.append(0, np.cumsum(n)))

    def inside(self, some: np.ndarray) -> np.ndarray:
        """The places of the points of some boxes."""
        n = self.n[some]
        return np.repeat(self.at[:-1][some] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())

    def sure(self, centers: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Whether the centre guessed for a box is the nearest of a fit's for all
        of its points, as no other is as near at any corner."""
        dim = centers.shape[1]
        square = (centers * centers).sum(axis=1)
        middle, half = (self.lo + self.hi) / 2, (self.hi - self.lo) / 2
        out = np.zeros(len(own), bool)
        most = (np.abs(self.lo) + np.abs(self.hi)).max(initial=0) + np.abs(centers).max()
        rounding = 64 * dim * np.finfo(float).eps * most * most * dim
        for j in range(len(centers)):
            if len(mine := np.flatnonzero(own == j)):
                u = centers - centers[j]
                reach = 2 * (middle[mine] @ u.T + half[mine] @ np.abs(u).T) - (square - square[j])
                reach[:, j] = -np.inf
                out[mine] = (reach < -rounding).all(axis=1)
        return out

    def sums(self, layout: _Layout, every: np.ndarray, step: int) -> np.ndarray:
        """As ``_Layout.sums`` of all points. A box that few fits have to look
        into is looked into for these, one that many have to for all at once."""
        dim, ends = every.shape[1], layout.ends
        out, d = np.zeros((len(every), dim + 3)), self.near(every)
        fits = list(zip(ends[:-1], ends[1:]))
        own = [d[:, a:b].argmin(axis=1) for a, b in fits]
        sure = np.array([self.sure(every[a:b], o) for (a, b), o in zip(fits, own)])
        whole = _PRODUCT * (np.diff(ends) @ ~sure) > len(every)
        norm = (self.mean * self.mean).sum(axis=1)
        for (a, b), o, ok in zip(fits, own, sure):
            for j in range(b - a):
                mine = np.flatnonzero((o == j) & ok & ~whole)
                n, mean, q = self.n[mine], self.mean[mine], self.q[mine].sum()
                out[a + j, 0] += n.sum()
                out[a + j, 1] += q + n @ norm[mine]
                out[a + j, 2] += q + n @ ((mean - every[a + j]) ** 2).sum(axis=1)
                out[a + j, 3:] += n @ mean
            if len(open_ := np.flatnonzero(~ok & ~whole)):
                x, one = self.x[self.inside(open_)], _Layout.of(every[a:b], np.array([0, b - a]))
                for lo in range(0, len(x), _STEP):
                    out[a:b] += one.sums(x[lo:lo + _STEP])
        if whole.any():
            x = self.x[self.inside(np.flatnonzero(whole))]
            for lo in range(0, len(x), step):
                out += layout.sums(x[lo:lo + step])
        return out

    def near(self, centers: np.ndarray) -> np.ndarray:
        """Squared distances of the boxes' means, by a product."""
        return (self.mean * self.mean).sum(axis=1)[:, None] - 2 * self.mean @ centers.T + (centers * centers).sum(axis=1)


def _pass(points: DataFrame, fits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One pass with the centres of all fits: per centre (points, sum of the
    points, sum of their squared norms, sum of their squared distances).
    ``points`` may be packed (see ``boxed``)."""
    every = np.concatenate(fits)
    ends = np.cumsum([0, *map(len, fits)])
    boxes = "head" in points.columns
    layout = _Layout.of(every, ends)
    dim, step = every.shape[1], max(64, _CELLS // len(every))

    def run(batches):
        got = np.zeros((len(every), dim + 3))
        for batch in batches:
            if boxes:
                for lo in range(0, batch.num_rows, 4 * step):
                    got += _Boxes.of(batch.slice(lo, 4 * step), dim).sums(layout, every, step)
                continue
            whole = _points(batch)
            for lo in range(0, len(whole), step):
                got += layout.sums(whole[lo:lo + step])
        n = np.rint(got[:, 0]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(every))), pa.array(n), *[pa.array(np.ascontiguousarray(got[:, i])) for i in range(1, dim + 3)]],
                                         names=["c", "n", "q", "d", *[f"s{i}" for i in range(dim)]])

    cols = ["n", "q", "d", *[f"s{i}" for i in range(dim)]]
    schema = "c long, n long, " + ", ".join(f"{c} double" for c in cols[1:])
    got = points.select(*(["head", "x", "h"] if boxes else ["features"])).mapInArrow(run, schema).groupBy("c").agg(*[F.sum(c).alias(c) for c in cols]).toArrow()
    at = got["c"].to_numpy()
    out = []
    for c in cols:
        full = np.zeros(len(every), np.int64 if c == "n" else float)
        full[at] = got[c].to_numpy()
        out.append(full)
    return out[0], np.stack(out[3:], axis=1), out[1], out[2]


def lloyd(points: DataFrame, starts: list, max_iter: int = dims.KMEANS_MAX_ITER, tol: float = 1e-8) -> tuple[list[Fit], int]:
    """(a fit for each list of first centres, passes over the points). All move
    in the same passes; a fit whose centres move by ``tol`` at most, squared,
    leaves. A centre without points stays where it is. Ties go to the lower
    centre. A fit's sizes and cost belong to its last assignment."""
    fits = [Fit(np.array(s, float), np.zeros(len(s), np.int64)) for s in starts]
    passes = 0
    while passes <= max_iter:
        moving = [f for f in fits if not f.still]
        if not moving:
            break
        n, total, _, cost = _pass(points, [f.centers for f in moving])
        passes += 1
        lo = 0
        for f in moving:
            part = slice(lo, lo + f.k)
            lo += f.k
            f.sizes, f.cost = n[part], float(cost[part].sum())
            after = np.where(n[part, None] > 0, total[part] / np.maximum(n[part, None], 1), f.centers)
            shift = ((after - f.centers) ** 2).sum(axis=1).max()
            if shift <= tol or passes > max_iter:
                f.still = True
            else:
                f.centers = after
    return fits, passes


def _scrambled(h: np.ndarray, salt: int) -> np.ndarray:
    """Numbers from 0 to 1 from 64-bit hashes and a salt."""
    x = (h.astype(np.int64).view(np.uint64) + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(11)) / float(1 << 53)


def first_centers(points: DataFrame, key: str, starts: int, most: int, seed: int, boxes: DataFrame | None = None) -> list[np.ndarray]:
    """k-means||: for each start the candidates from which its centres are
    chosen, drawn by hashes of ``key`` in passes that serve all starts: about
    SEED_FACTOR * ``most`` a round in expectation, whatever the size of the data.
    ``boxes``: the points, packed."""
    boxes = boxed(points, key) if boxes is None else boxes
    hashed = points.select("features", F.xxhash64(key).alias("h"))
    heads = hashed.agg(*[F.min_by("features", F.xxhash64("h", F.lit(seed + s))).alias(f"f{s}") for s in range(starts)]).first()
    found = [np.array([heads[f"f{s}"]], float) for s in range(starts)]
    for r in range(SEED_ROUNDS):
        cost = _pass(boxes, found)[3]
        ends = np.cumsum([0, *map(len, found)])
        share = [SEED_FACTOR * most / max(cost[a:b].sum(), 1e-300) for a, b in zip(ends[:-1], ends[1:])]
        now = list(found)

        def draw(batches, now=now, share=share, r=r):
            for batch in batches:
                some = _Boxes.of(batch, now[0].shape[1])
                far = np.sqrt((np.maximum(some.mean - some.lo, some.hi - some.mean) ** 2).sum(axis=1))
                for s, centers in enumerate(now):
                    u = _scrambled(some.h, (seed + s) * 1000 + r)
                    # a box's points are no farther than its mean and its corner; few boxes can have one drawn
                    d = np.concatenate([_distances(some.mean[lo:lo + _STEP], centers).min(axis=1) for lo in range(0, len(far), _STEP)] or [far])
                    can = np.repeat(share[s] * (np.sqrt(d) + far) ** 2 * (1 + 1e-9) + 1e-300, some.n)
                    at = np.flatnonzero(u < can)
                    x = some.x[at]
                    x = x[u[at] < share[s] * _distances(x, centers).min(axis=1)]
                    if len(x):
                        ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1])
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), s)), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))],
                                                         names=["s", "features"])
        for row in boxes.mapInArrow(draw, "s long, features array<double>").orderBy("s", "features").collect():
            found[row["s"]] = np.vstack([found[row["s"]], row["features"]])
    return [np.unique(f, axis=0) for f in found]


def _chosen(candidates: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ over weighted candidates; fewer than k if there are fewer."""
    out = [candidates[rng.choice(len(candidates), p=weight / weight.sum())]]
    while len(out) < k:
        p = weight * _distances(candidates, np.array(out)).min(axis=1)
        if p.sum() <= 0:
            break
        out.append(candidates[rng.choice(len(candidates), p=p / p.sum())])
    return np.array(out)


def _silhouettes(points: DataFrame, fits: list[Fit]) -> list[float]:
    """Mean squared-Euclidean silhouette of each fit's assignment, two passes
    for all (see :func:`silhouette`)."""
    n, total, q, _ = _pass(points, [f.centers for f in fits])
    every, ends = np.concatenate([f.centers for f in fits]), np.cumsum([0, *(f.k for f in fits)])

    def run(batches):
        out, rows = np.zeros(len(fits)), 0
        for batch in batches:
            whole = _points(batch)
            rows += len(whole)
            for lo in range(0, len(whole), _STEP):
                x = whole[lo:lo + _STEP]
                d, norm = _distances(x, every), (x * x).sum(axis=1)
                for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                    own, pick = d[:, a:b].argmin(axis=1), np.arange(len(x))
                    t = n[a:b] * norm[:, None] - 2 * x @ total[a:b].T + q[a:b]
                    size = n[a:b][own]
                    near = t[pick, own] / np.maximum(size - 1, 1)
                    with np.errstate(divide="ignore", invalid="ignore"):
                        others = np.where(n[a:b] > 0, t / n[a:b], np.inf)
                    others[pick, own] = np.inf
                    far = others.min(axis=1)
                    top = np.maximum(near, far)
                    s = np.where((size > 1) & np.isfinite(far) & (top > 0), (far - near) / np.where(top > 0, top, 1), 0.0)
                    out[i] += s.sum()
        yield pa.RecordBatch.from_arrays([pa.array([rows]), *[pa.array([v]) for v in out]], names=["n", *[f"f{i}" for i in range(len(fits))]])

    cols = ["n", *[f"f{i}" for i in range(len(fits))]]
    got = points.select("features").mapInArrow(run, "n long, " + ", ".join(f"{c} double" for c in cols[1:])).agg(*[F.sum(c) for c in cols]).first()
    return [v / got[0] for v in got[1:]]


@dataclass
class Scan:
    """The K scan: (k, inertia, silhouette, chosen) rows, the best fit of each
    K, the chosen K and the passes over the points that the fits took."""
    rows: list[tuple]
    fits: dict[int, Fit]
    chosen: int
    passes: int


def kmeans_scan(points: DataFrame, key: str = "seq", k_values=None, seed: int = dims.SEED, starts: int = dims.KMEANS_STARTS) -> Scan:
    """ML-11: for each K the cheapest of ``starts`` fits; inertia and
    squared-Euclidean silhouette; K chosen as the best silhouette among K >= 3,
    or 4 when no K reaches 0.2 (the documented rule). ``points`` has ``key``
    and features (array<double>); it is packed into boxes, which each round reads. A K of which the points have fewer distinct ones gets as
    many clusters as there are."""
    k_values = k_values or dims.KMEANS_K_RANGE
    boxes = boxed(points, key)
    candidates = first_centers(points, key, starts, max(k_values), seed, boxes)
    weight = np.split(_pass(boxes, candidates)[0], np.cumsum([len(c) for c in candidates])[:-1])
    plan = [(k, s) for k in k_values for s in range(starts)]
    fits, passes = lloyd(boxes, [_chosen(candidates[s], weight[s].astype(float), k, np.random.default_rng([seed, s, k])) for k, s in plan])
    best: dict[int, Fit] = {}
    for (k, _), f in zip(plan, fits):
        if k not in best or f.cost < best[k].cost:
            best[k] = f
    silhouettes = dict(zip(best, _silhouettes(points, list(best.values()))))
    among = [k for k in best if k >= 3] or list(best)
    top = max(among, key=lambda k: (silhouettes[k], -k))
    chosen = top if max(silhouettes.values()) >= dims.SILHOUETTE_FLOOR else dims.KMEANS_FALLBACK_K
    return Scan([(k, best[k].cost, silhouettes[k], k == chosen) for k in best], best, chosen, passes)
