"""Exact quantiles by value-range histograms, refined around the wanted ranks
(WIN-2, AGG-1, AGG-2).

``percentile`` holds all distinct values of a group in one buffer, and a window
sorts them in one task. Here each group keeps, for every rank that it wants, a
range of values that holds the rank and the number of values below it. A level
cuts the ranges into BUCKETS buckets and counts them (a hash aggregate, partial
in the map tasks, so a group with a third of all rows is a few rows a task);
the bucket that holds the rank is the next range. A range of one value ends it.
The new range runs from the least to the greatest value found in the bucket, so
every level takes values away and gaps are skipped.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: buckets of a range at each level
BUCKETS = 1024


def _bucket(v: Column, lo: Column, hi: Column) -> Column:
    """The place of a value in its range, ascending with the value; values that
    are not finite have places of their own at the ends."""
    wide = F.abs(hi - lo) == F.lit(float("inf"))
    share = F.when(wide, (v / 2 - lo / 2) / (hi / 2 - lo / 2)).otherwise((v - lo) / (hi - lo))
    inside = F.least(F.floor(share * BUCKETS).cast("int"), F.lit(BUCKETS - 1))
    return F.when(F.isnan(v), BUCKETS + 1).when(v == float("inf"), BUCKETS).when(v == float("-inf"), -1) \
        .when(hi > lo, inside).otherwise(0)


def _finite(v: Column) -> Column:
    return F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)


def quantiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """``keys`` and a column per entry name -> (column, p): the p-quantile of
    the group's non-null values with linear interpolation, as ``percentile``
    gives it. Groups without a value of a column get null for it; groups
    without any value are left out; null keys are a group. Without keys, one
    row (none if there is no value). NaN is the largest value. The values are
    written once and read at each level."""
    from hirelens.session import checked_broadcast, materialize
    cols = sorted({c for c, _ in wanted.values()})
    long = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("v")) for c in cols])).alias("_x")) \
        .select(*[f"_k{i}" for i in range(len(keys))], F.col("_x.c").alias("_c"), F.col("_x.v").alias("_v")).where("_v IS NOT NULL")
    values = materialize(long, "quantile-values")
    group = [f"_k{i}" for i in range(len(keys))] + ["_c"]

    # ranks from 0 that each column wants: both ends of the interpolation
    shares = {c: sorted({p for at, p in wanted.values() if at == c}) for c in cols}
    n = F.col("_n")
    ranks = functools.reduce(lambda rest, c: F.when(F.col("_c") == c, F.array_distinct(F.flatten(F.array(*[
        F.array(F.floor((n - 1) * F.lit(float(p))), F.ceil((n - 1) * F.lit(float(p)))) for p in shares[c]])))).otherwise(rest),
        cols, F.lit(None).cast("array<bigint>"))
    v = F.col("_v")
    first = values.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), F.min(_finite(v)).alias("_lo"), F.max(_finite(v)).alias("_hi"),
        F.min(v).alias("_min"), F.max(v).alias("_max")) \
        .select(*group, "_n", F.explode(ranks).alias("_rank"), F.lit(0).cast("long").alias("_below"),
                F.coalesce("_lo", F.lit(0.0)).alias("_lo"), F.coalesce("_hi", F.lit(0.0)).alias("_hi"),
                F.when(F.col("_min") == F.col("_max"), F.col("_min")).alias("_value"))
    now = materialize(first, "quantile-ranges")
    done = [now.where("_value IS NOT NULL")]
    now = now.where("_value IS NULL")
    while now.limit(1).count():
        # the ranges of a group are apart or equal, so a value is in one at most
        ranges = checked_broadcast(materialize(
            now.groupBy(*group).agg(F.collect_set(F.struct(F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))).alias("_ranges")), "quantile-groups"))
        same = functools.reduce(lambda a, b: a & b, [values[k].eqNullSafe(ranges[k]) for k in group])
        outside = F.isnan(v) | (F.abs(v) == float("inf"))
        top = len(done) == 1  # only at the first level are values that are not finite in a range
        own = F.filter("_ranges", lambda r: ((v >= r["lo"]) & (v <= r["hi"]) & ~outside) | (outside if top else F.lit(False)))
        placed = values.join(ranges, same).select(*[values[k] for k in group], "_v", F.get(own, F.lit(0)).alias("_r")).where("_r IS NOT NULL")
        counted = placed.withColumn("_b", _bucket(v, F.col("_r.lo"), F.col("_r.hi"))) \
            .groupBy(*group, "_r", "_b").agg(F.count(F.lit(1)).alias("k"), F.min("_v").alias("least"), F.max("_v").alias("most"))
        # at most BUCKETS and three rows a range
        hist = counted.groupBy(*group, "_r").agg(F.array_sort(F.collect_list(F.struct("_b", "k", "least", "most"))).alias("_hist")) \
            .withColumn("_hist", F.expr("""aggregate(_hist, named_struct('n', 0L, 'out', cast(array() as array<struct<below:bigint,k:bigint,least:double,most:double>>)),
                (a, x) -> named_struct('n', a.n + x.k, 'out', concat(a.out, array(named_struct('below', a.n, 'k', x.k, 'least', x.least, 'most', x.most))))).out"""))
        hist = hist.select(*[F.col(k).alias(f"h{k}") for k in group], F.col("_r.lo").alias("h_lo"), F.col("_r.hi").alias("h_hi"), "_hist")
        on = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"h{k}")) for k in [*group, "_lo", "_hi"]])
        hit = F.get(F.filter("_hist", lambda h: (F.col("_below") + h["below"] <= F.col("_rank")) & (F.col("_rank") < F.col("_below") + h["below"] + h["k"])), F.lit(0))
        step = now.join(hist, on).withColumn("_hit", hit).select(
            *group, "_n", "_rank", (F.col("_below") + F.col("_hit.below")).alias("_below"), F.col("_hit.least").alias("_lo"), F.col("_hit.most").alias("_hi"),
            F.when(F.col("_hit.least") == F.col("_hit.most"), F.col("_hit.least")).alias("_value"))
        after = materialize(step, "quantile-ranges")
        done.append(after.where("_value IS NOT NULL"))
        now = after.where("_value IS NULL")

    found = functools.reduce(DataFrame.unionByName, done)
    names = [f"_k{i}" for i in range(len(keys))]
    aggs = []
    for name, (c, p) in wanted.items():
        place = (n - 1) * F.lit(float(p))
        own = F.col("_c") == c
        for end, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            aggs.append(F.max(F.when(own & (F.col("_rank") == at), F.col("_value"))).alias(f"_{end}_{name}"))
        aggs.append(F.max(F.when(own, place)).alias(f"_at_{name}"))
    ends = found.groupBy(*names).agg(*aggs)

    def between(name):
        lo, hi, at = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_at_{name}")
        return F.when(F.ceil(at) == F.floor(at), lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi)

    out = ends.select(*[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)], *[between(x).alias(x) for x in wanted])
    return out if keys else out.where(F.coalesce(*[F.col(x) for x in wanted]).isNotNull())
