"""Forest and boosting over cells (ML-4, ML-5, ML-7).

A tree learner that cuts each feature at a few thresholds sees of a row only its
cell, the bins that its values fall into, and squared error needs of a cell only
the sum of weights and of weighted targets. So the rows are added up to cells by
Spark, and trees are grown from those sums, with the rules of Spark ML (its
thresholds, gain, stops and importances) but without several jobs a tree. There
are at most as many cells as the thresholds leave combinations: 245,760 for the
six features of a posting (3 tiers, 5 educations, 2 x 32 bins, 2 and 8 codes).

* Boosting changes a cell's target by its prediction: one task grows all trees.
* A forest's tree counts each row Poisson(1) times. n equal rows count
  Poisson(n) times together, which has the same distribution; the draw comes
  from a hash of the row and the tree, so a repeated task draws the same. Tasks
  draw for all trees over a part of the rows and send sums by cell; then each
  task grows a few trees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: trees of a forest that a task grows at once, rows that draw at once
_BLOCK = 8
_STEP = 2048
#: cells times trees that are walked through at once
_WALK = 1 << 20
#: a gain below this share of all that the cells differ by is rounding
_LEAST = 1e-12
_GOLD = 0x9E3779B97F4A7C15


# ------------------------------------------------------------------- bins

def _cuts(values: np.ndarray, weight: np.ndarray, bins: int) -> list[float]:
    """Spark's thresholds of a feature from its values in order: the middles
    between all, or of strides of equal weight where there are too many."""
    if len(values) <= bins:
        return [float(x) for x in (values[:-1] + values[1:]) / 2]
    stride = weight.sum() / bins
    out, target, now = [], stride, weight[0]
    for i in range(1, len(values)):
        before, now = now, now + weight[i]
        if abs(before - target) < abs(now - target):
            out.append(float((values[i - 1] + values[i]) / 2))
            target += stride
    return out


@dataclass
class Bins:
    """Thresholds by feature; a value up to the first is in bin 0."""
    cols: list[str]
    cuts: list[list[float]]

    @classmethod
    def of(cls, rows: DataFrame, cols: list[str], bins: int) -> Bins:
        got = rows.select(F.posexplode(F.array(*cols)).alias("f", "x"), "n").groupBy("f", "x").agg(F.sum("n").alias("n")).orderBy("f", "x").toArrow()
        f, x, n = (got[c].to_numpy() for c in ("f", "x", "n"))
        if not len(f):
            raise ValueError("no rows to learn from")
        return cls(list(cols), [_cuts(x[f == i], n[f == i], bins) for i in range(len(cols))])

    @property
    def sizes(self) -> list[int]:
        return [len(c) + 1 for c in self.cuts]

    def column(self) -> "F.Column":
        """A row's cell as one number."""
        out = F.lit(0).cast("long")
        for c, cuts in zip(self.cols, self.cuts):
            at = F.lit(0).cast("long")
            for t in cuts:
                at = at + (F.col(c) > t).cast("long")
            out = out * (len(cuts) + 1) + at
        return out

    def codes(self, batch) -> np.ndarray:
        """The same of an Arrow batch."""
        out = np.zeros(batch.num_rows, np.int64)
        for c, cuts in zip(self.cols, self.cuts):
            out = out * (len(cuts) + 1) + np.searchsorted(np.array(cuts, float), np.asarray(batch[c], float), side="left")
        return out

    def split(self, codes: np.ndarray) -> np.ndarray:
        """Bins by feature and cell."""
        return np.stack(np.unravel_index(codes, self.sizes)).astype(np.int16)


# ------------------------------------------------------------------ trees

@dataclass
class Trees:
    """Nodes of several trees in one table: the roots come first, a right child
    follows its left one. ``gain`` is what a node's split takes off the squared
    error, ``feature`` -1 where there is none."""
    n: int
    tree: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    SCHEMA = "n int, tree array<int>, feature array<int>, cut array<int>, left array<int>, value array<double>, gain array<double>"
    KINDS = {"tree": np.int32, "feature": np.int32, "cut": np.int32, "left": np.int32, "value": np.float64, "gain": np.float64}

    def table(self) -> pa.Table:
        return pa.table({"n": pa.array([self.n], pa.int32()), **{c: pa.array([getattr(self, c).astype(k)], pa.list_(pa.from_numpy_dtype(k))) for c, k in self.KINDS.items()}})

    @classmethod
    def tables(cls, rows: pa.Table) -> list[Trees]:
        return [cls(rows["n"][i].as_py(), *[rows[c][i].values.to_numpy(zero_copy_only=False) for c in cls.KINDS]) for i in range(rows.num_rows)]

    def sums(self, bins: np.ndarray) -> np.ndarray:
        """Each cell's predictions, added up over the trees."""
        out, step = np.zeros(bins.shape[1]), max(1, _WALK // self.n)
        for lo in range(0, len(out), step):
            part = bins[:, lo:lo + step]
            cell = np.arange(part.shape[1])
            at = np.repeat(np.arange(self.n)[:, None], len(cell), axis=1)
            while (f := self.feature[at]).max(initial=-1) >= 0:
                at = np.where(f < 0, at, self.left[at] + (part[f, cell] > self.cut[at]))
            out[lo:lo + step] = self.value[at].sum(axis=0)
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salt(*numbers: int) -> np.uint64:
    x = 0
    for n in numbers:
        x = (x * _GOLD + n + 1) % (1 << 64)
    return np.uint64(x)


def grow(bins: np.ndarray, sizes: list[int], w: np.ndarray, s: np.ndarray, depth: int, least: float,
         some: int | None = None, seed: int = 0, first: int = 0) -> Trees:
    """Trees (one a row of ``w``, the weights of the cells, and ``s``, their
    weighted targets) by Spark ML's rules: of all splits that leave ``least``
    weight on both sides the one with the largest gain, the first of equal ones.
    ``some``: features that a node may look at, drawn by a hash of the node and
    the tree's number, the first of which is ``first``."""
    count, features = len(w), len(sizes)
    mean = s.sum(axis=1) / np.maximum(w.sum(axis=1), 1e-300)
    s = s - w * mean[:, None]
    floor = _LEAST * np.divide(s * s, w, out=np.zeros_like(s), where=w > 0).sum(axis=1)
    node, cell = np.nonzero(w > 0)
    ww, ss = w[node, cell], s[node, cell]
    tree, path = np.arange(count), np.ones(count, np.uint64)
    done, base = [], 0
    for level in range(depth + 1):
        m = len(tree)
        total, held = np.bincount(node, ss, m), np.bincount(node, ww, m)
        best, what, where = np.zeros(m), np.full(m, -1), np.zeros(m, np.int64)
        if level < depth:
            may = np.ones((m, features), bool)
            if some is not None and some < features:
                x = (((tree + first).astype(np.uint64) << np.uint64(32)) + path)[:, None] * np.uint64(features) + np.arange(features, dtype=np.uint64)
                key = _mixed(_mixed(x + _salt(seed, 1)) * np.uint64(_GOLD))
                may = key <= np.partition(key, some - 1, axis=1)[:, some - 1:some]
            whole = np.divide(total * total, held, out=np.zeros(m), where=held > 0)
            best[:] = floor[tree]
            for f in range(features):
                b = sizes[f]
                if b < 2:
                    continue
                mine = np.flatnonzero(may[:, f])
                rank = np.full(m, -1)
                rank[mine] = np.arange(len(mine))
                at = rank[node]
                keep = slice(None) if len(mine) == m else np.flatnonzero(at >= 0)
                at = at[keep] * b + bins[f][cell[keep]]
                wl = np.bincount(at, ww[keep], len(mine) * b).reshape(-1, b).cumsum(axis=1)[:, :-1]
                sl = np.bincount(at, ss[keep], len(mine) * b).reshape(-1, b).cumsum(axis=1)[:, :-1]
                wr, sr = held[mine, None] - wl, total[mine, None] - sl
                ok = (wl >= least) & (wr >= least) & (wl > 0) & (wr > 0)
                gain = np.full(wl.shape, -np.inf)
                np.copyto(gain, sl * sl / np.where(ok, wl, 1) + sr * sr / np.where(ok, wr, 1) - whole[mine, None], where=ok)
                top = gain.argmax(axis=1)
                got = gain[np.arange(len(mine)), top]
                better = got > best[mine]
                at = mine[better]
                best[at], what[at], where[at] = got[better], f, top[better]
        cuts = what >= 0
        rank = np.cumsum(cuts) - 1
        done.append((tree, what, where, np.where(cuts, base + m + 2 * rank, 0), np.divide(total, held, out=np.zeros(m), where=held > 0) + mean[tree], np.where(cuts, best, 0.0)))
        if not cuts.any():
            break
        base += m
        keep = np.flatnonzero(cuts[node])
        node, cell, ww, ss = node[keep], cell[keep], ww[keep], ss[keep]
        node = 2 * rank[node] + (bins[what[node], cell] > where[node])
        tree = np.repeat(tree[cuts], 2)
        path = np.repeat(path[cuts] * np.uint64(2), 2) + np.tile(np.array([0, 1], np.uint64), int(cuts.sum()))
    return Trees(count, *[np.concatenate(c) for c in zip(*done)])


class CellModel:
    """Trees with their weights; predicts like a Spark ML model."""

    def __init__(self, bins: Bins, blocks: list[Trees], weights: list[float], by_tree: bool):
        self.bins, self.blocks, self.weights, self.by_tree = bins, blocks, weights, by_tree

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 (Spark ML's name)
        """Spark ML's: what a feature's splits take off the error; by tree in a
        forest, the shares of each tree added up."""
        width, out = len(self.bins.cols), np.zeros(len(self.bins.cols))
        for b in self.blocks:
            own = np.bincount(b.tree * width + np.maximum(b.feature, 0), b.gain, b.n * width).reshape(b.n, width)
            if self.by_tree:
                own = own / np.where((all_ := own.sum(axis=1, keepdims=True)) > 0, all_, 1)
            out += own.sum(axis=0)
        return Vectors.dense(out / out.sum() if out.sum() > 0 else out)

    def predicted(self, codes: np.ndarray) -> np.ndarray:
        bins, out = self.bins.split(codes), np.zeros(len(codes))
        for b, w in zip(self.blocks, self.weights):
            out += w * b.sums(bins)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` without its vectors, with ``prediction``. A task looks each cell
        up in the trees once."""
        plain = df.select(*[f.name for f in df.schema.fields if f.dataType.typeName() != "udt"])
        names = plain.columns
        model = self

        def run(batches):
            known, said = np.zeros(0, np.int64), np.zeros(0)
            for batch in batches:
                codes, back = np.unique(model.bins.codes(batch), return_inverse=True)
                if len(new := np.setdiff1d(codes, known, assume_unique=True)):
                    known, said = np.append(known, new), np.append(said, model.predicted(new))
                    order = np.argsort(known)
                    known, said = known[order], said[order]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(said[np.searchsorted(known, codes)][back])], names=[*names, "prediction"])

        return plain.mapInArrow(run, plain.withColumn("prediction", F.lit(0.0)).schema)


# --------------------------------------------------------------- learners

def _boosted(est: GBTRegressor, bins: Bins, rows: DataFrame) -> CellModel:
    rounds, depth, rate, least = est.getMaxIter(), est.getMaxDepth(), est.getStepSize(), float(est.getMinInstancesPerNode())
    cells = rows.groupBy(bins.column().alias("code")).agg(F.sum("n").alias("w"), F.sum(F.col("n") * F.col("salary_log")).alias("s"))

    def run(batches):
        got = pa.Table.from_batches(list(batches)).sort_by("code")
        parts, w, s = bins.split(got["code"].to_numpy()), got["w"].to_numpy(), got["s"].to_numpy()
        said = np.zeros(len(w))
        for r in range(rounds):
            # Spark's residual is the loss's gradient: twice what is missing
            one = grow(parts, bins.sizes, w[None], (2 * (s - w * said) if r else s)[None], depth, least)
            said += (rate if r else 1.0) * one.sums(parts)
            yield from one.table().to_batches()

    blocks = Trees.tables(cells.repartition(1).mapInArrow(run, Trees.SCHEMA).toArrow())
    return CellModel(bins, blocks, [1.0] + [rate] * (rounds - 1), False)


def _poisson(n: np.ndarray, u: np.ndarray, known: dict) -> np.ndarray:
    """Poisson numbers of mean n (a whole number a row) where the distribution
    reaches u (a row for each n, a column for each draw)."""
    out = np.empty(u.shape)
    for m in np.unique(n):
        if m not in known:
            k = np.arange(max(0, int(m - 10 * math.sqrt(m)) - 10), int(m + 12 * math.sqrt(m)) + 40)
            p = np.exp(k * math.log(m) - m - np.array([math.lgamma(x + 1.0) for x in k]))
            known[m] = k[0], np.cumsum(p)[:-1]
        low, upto = known[m]
        at = n == m
        out[at] = low + np.searchsorted(upto, u[at], side="right")
    return out


def _forest(est, bins: Bins, rows: DataFrame) -> CellModel:
    count, depth, least, seed = est.getNumTrees(), est.getMaxDepth(), float(est.getMinInstancesPerNode()), est.getSeed()
    some = {"auto": math.ceil(len(bins.cols) / 3) if count > 1 else None, "onethird": math.ceil(len(bins.cols) / 3), "all": None}[est.getFeatureSubsetStrategy()]
    bootstrap, width = est.getBootstrap(), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = rows.select(bins.column().alias("code"), F.xxhash64(*bins.cols, "salary_log", *[c for c in rows.columns if c == "_fold"]).alias("h"), "n", "salary_log")

    def draw(batches):
        known, salt = {}, _mixed(np.array([_salt(seed, t) for t in range(count)], np.uint64))
        for batch in batches:
            for lo in range(0, batch.num_rows, _STEP):
                part = batch.slice(lo, _STEP)
                code, n, y = (part[c].to_numpy() for c in ("code", "n", "salary_log"))
                if bootstrap:
                    u = (_mixed(_mixed(part["h"].to_numpy().view(np.uint64)[:, None] ^ salt) * np.uint64(_GOLD)) >> np.uint64(11)) / float(1 << 53)
                    times = _poisson(n, u, known)
                else:
                    times = np.repeat(n[:, None], count, axis=1)
                starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
                w, s = np.add.reduceat(times, starts, axis=0), np.add.reduceat(times * y[:, None], starts, axis=0)
                for b, at in enumerate(range(0, count, _BLOCK)):
                    own = [np.ascontiguousarray(x[:, at:at + _BLOCK]) for x in (w, s)]
                    ends = pa.array(np.arange(len(starts) + 1, dtype=np.int32) * own[0].shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), b, np.int32)), pa.array(code[starts]), *[pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in own]],
                                                     names=["block", "code", "w", "s"])

    def trees(key, got):
        code, at = np.unique(got["code"].to_numpy(), return_inverse=True)
        b = key[0].as_py()
        w, s = (np.zeros((min(_BLOCK, count - b * _BLOCK), len(code))) for _ in range(2))
        order = np.argsort(at, kind="stable")
        starts = np.searchsorted(at[order], np.arange(len(code)))
        for x, c in ((w, "w"), (s, "s")):
            x[:] = np.add.reduceat(got[c].combine_chunks().flatten().to_numpy().reshape(len(at), -1)[order], starts, axis=0).T
        return grow(bins.split(code), bins.sizes, w, s, depth, least, some, seed, b * _BLOCK).table()

    sums = keyed.repartitionByRange(width, "code", "h").sortWithinPartitions("code", "h").mapInArrow(draw, "block int, code long, w array<double>, s array<double>")
    blocks = Trees.tables(sums.groupBy("block").applyInArrow(trees, Trees.SCHEMA).toArrow())
    return CellModel(bins, blocks, [1.0 / count] * len(blocks), True)


def fit(est, rows: DataFrame, cols: list[str]) -> CellModel:
    """``rows`` (``cols``, salary_log, n: how many rows are so) fitted with the
    settings of a Spark ML forest or boosting estimator."""
    bins = Bins.of(rows, cols, est.getMaxBins())
    return _boosted(est, bins, rows) if isinstance(est, GBTRegressor) else _forest(est, bins, rows)
