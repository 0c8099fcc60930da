"""Truncated SVD of sparse rows by subspace iteration (ML-9).

The documents' weights are a sparse matrix X, a row each. A factor of ``dim``
and some more columns, one row a term, is multiplied by XᵀX round by round and
made orthonormal again, until the wanted singular values stand still. No block
of terms times terms exists anywhere.

* A product XᵀXQ is two sums: each document's p = xQ, and each term's sum of
  weight times p. A factor of at most FACTOR_TERMS rows travels to the tasks,
  where whole batches of sparse rows are multiplied, and a task sends one row a
  term; a larger one is a table that the documents' terms are joined to.
* Columns are made orthonormal by their small Gram matrix (a sum over the
  terms), twice, so no factor has to be in one place for it; columns that
  the others span are dropped.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.session import materialize

#: terms up to which a factor is an array on the driver and in the tasks
#: (15 doubles a term: 24 MB)
FACTOR_TERMS = 200_000
OVERSAMPLE = 10
ROUNDS = 300
TOLERANCE = 1e-12


@dataclass
class Factor:
    """One row of ``width`` numbers a term: an array, or a table (idx, q)."""
    width: int
    array: np.ndarray | None = None
    table: DataFrame | None = None


def _rows(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, terms, weights) of a batch of sparse rows."""
    ii, ww = batch.column("ii"), batch.column("ww")
    off = np.asarray(ii.offsets).astype(np.int64)
    terms = np.asarray(ii.values)[off[0]:off[-1]].astype(np.int64)
    woff = np.asarray(ww.offsets).astype(np.int64)
    return off - off[0], terms, np.asarray(ww.values)[woff[0]:woff[-1]].astype(float)


def _times(off, terms, weights, q: np.ndarray) -> np.ndarray:
    """A row of numbers for each sparse row: x Q."""
    total = np.zeros((len(terms) + 1, q.shape[1]))
    np.cumsum(weights[:, None] * q[terms], axis=0, out=total[1:])
    return total[off[1:]] - total[off[:-1]]


def _vector(width: int, expr: str) -> str:
    return ", ".join(f"sum({expr.format(i=i)}) AS y{i}" for i in range(width))


def multiply(weights: DataFrame, factor: Factor) -> DataFrame:
    """(seq, p array<double>): each document's row times the factor."""
    if factor.array is not None:
        q = factor.array

        def run(batches):
            for batch in batches:
                p = _times(*_rows(batch), q)
                width = p.shape[1]
                flat = pa.array(np.ascontiguousarray(p).ravel())
                ends = pa.array(np.arange(len(p) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays([batch.column("seq"), pa.ListArray.from_arrays(ends, flat)], names=["seq", "p"])
        return weights.select("seq", "ii", "ww").mapInArrow(run, f"seq {weights.schema['seq'].dataType.simpleString()}, p array<double>")
    terms = weights.select("seq", F.explode(F.arrays_zip("ii", "ww")).alias("z")).select("seq", F.col("z.ii").cast("long").alias("idx"), F.col("z.ww").alias("w"))
    sums = terms.join(factor.table, "idx").groupBy("seq").agg(*[F.sum(F.col("w") * F.col("q")[i]).alias(f"y{i}") for i in range(factor.width)])
    return sums.select("seq", F.array(*[f"y{i}" for i in range(factor.width)]).alias("p"))


def _gram_times(weights: DataFrame, factor: Factor, k: int) -> Factor:
    """XᵀX times the factor."""
    width = factor.width
    if factor.array is not None:
        q = factor.array

        def run(batches):
            y = np.zeros((k, width))
            for batch in batches:
                off, terms, w = _rows(batch)
                p = _times(off, terms, w, q)
                np.add.at(y, terms, w[:, None] * p[np.repeat(np.arange(len(p)), np.diff(off))])
            at = np.flatnonzero(y.any(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(y[at, i]) for i in range(width)]], names=["idx", *[f"y{i}" for i in range(width)]])
        parts = weights.select("ii", "ww").mapInArrow(run, "idx long, " + ", ".join(f"y{i} double" for i in range(width)))
        got = parts.groupBy("idx").agg(*[F.sum(f"y{i}").alias(f"y{i}") for i in range(width)]).toArrow()
        out = np.zeros((k, width))
        out[got["idx"].to_numpy()] = np.stack([got[f"y{i}"].to_numpy() for i in range(width)], axis=1)
        return Factor(width, array=out)
    p = materialize(multiply(weights, factor), "svd-rows")
    terms = weights.select("seq", F.explode(F.arrays_zip("ii", "ww")).alias("z")).select("seq", F.col("z.ii").cast("long").alias("idx"), F.col("z.ww").alias("w"))
    sums = terms.join(p, "seq").groupBy("idx").agg(*[F.sum(F.col("w") * F.col("p")[i]).alias(f"y{i}") for i in range(width)])
    return Factor(width, table=materialize(sums.select("idx", F.array(*[f"y{i}" for i in range(width)]).alias("q")), "svd-factor"))


def _inner(a: Factor, b: Factor) -> np.ndarray:
    """AᵀB, width times width."""
    if a.array is not None:
        return a.array.T @ b.array
    both = a.table.join(b.table.select("idx", F.col("q").alias("r")), "idx")
    sums = [F.sum(F.col("q")[i] * F.col("r")[j]) for i in range(a.width) for j in range(b.width)]
    return np.array([x or 0.0 for x in both.agg(*sums).first()]).reshape(a.width, b.width)


def _turned(a: Factor, m: np.ndarray) -> Factor:
    """A times a small matrix."""
    width = m.shape[1]
    if a.array is not None:
        return Factor(width, array=a.array @ m)
    cols = [sum((F.col("q")[i] * F.lit(float(m[i, j])) for i in range(1, a.width)), F.col("q")[0] * F.lit(float(m[0, j]))) for j in range(width)]
    return Factor(width, table=materialize(a.table.select("idx", F.array(*cols).alias("q")), "svd-factor"))


def _orthonormal(a: Factor) -> Factor:
    for _ in range(2):
        values, vectors = np.linalg.eigh(_inner(a, a))
        keep = values > max(values.max(initial=0.0), 1e-300) * 1e-13
        a = _turned(a, vectors[:, keep] / np.sqrt(values[keep]))
    return a


def _start(k: int, width: int, terms: DataFrame) -> Factor:
    """A factor of signs from hashes of the terms' numbers."""
    if k <= FACTOR_TERMS:
        return Factor(width, array=np.random.default_rng(dims.SEED).choice([-1.0, 1.0], (k, width)))
    signs = [F.when(F.xxhash64("idx", F.lit(j)) % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0)) for j in range(width)]
    return Factor(width, table=materialize(terms.select("idx", F.array(*signs).alias("q")), "svd-factor"))


def truncated_svd(weights: DataFrame, k: int, dim: int = dims.SVD_DIM) -> tuple[Factor, np.ndarray, np.ndarray]:
    """(components: a column each, squared singular values, share of the total
    that each explains) of the (seq, ii, ww) rows over ``k`` terms.

    Fewer than ``dim`` components come back if the rows span fewer. No rows, or
    no terms, give none. ``weights`` is read once a round, so it should be a
    written table.
    """
    square = F.aggregate("ww", F.lit(0.0), lambda a, x: a + x * x)
    total = weights.agg(F.sum(square)).first()[0] or 0.0
    if not total:
        return Factor(0, array=np.zeros((k, 0))), np.zeros(0), np.zeros(0)
    terms = weights.select(F.explode("ii").alias("idx")).select(F.col("idx").cast("long").alias("idx")).distinct()
    q = _orthonormal(_start(k, min(k, dim + OVERSAMPLE), terms))
    before = None
    for _ in range(ROUNDS):
        y = _gram_times(weights, q, k)
        values, vectors = np.linalg.eigh(_inner(q, y))
        order = np.argsort(values)[::-1][:dim]
        top = values[order]
        if before is not None and len(before) == len(top) and np.abs(top - before).max() <= TOLERANCE * total:
            break
        before, q = top, _orthonormal(y)
    keep = top > 1e-12 * total
    return _turned(q, vectors[:, order][:, keep]), top[keep], top[keep] / total
