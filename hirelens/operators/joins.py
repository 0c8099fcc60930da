"""Join-shaped operators (JON-1, JON-3..6, SET-1, SET-5, WIN-7).

Sizes: dimension tables built from the fixed dictionaries are bounded by
those dictionaries and are broadcast explicitly; every data-dependent side
is left to AQE, which broadcasts only after measuring it at runtime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.session import checked_broadcast


def city_dimension(spark: SparkSession) -> DataFrame:
    """City -> (tier, province) dimension from the fixed dictionaries
    (bounded: the union of their keys, under 60 rows)."""
    cities = sorted(set(dims.CITY_TIER) | set(dims.CITY_TO_PROVINCE))
    rows = [(c, dims.CITY_TIER.get(c), dims.CITY_TO_PROVINCE.get(c)) for c in cities]
    return spark.createDataFrame(rows, "city string, tier string, province string")


def enrich_city(df: DataFrame, dim: DataFrame) -> DataFrame:
    """JON-1: broadcast left equi-join on a dimension + defaults
    (tier -> 其他, province -> the city itself)."""
    j = df.join(checked_broadcast(dim), "city", "left")
    return j.withColumns({
        "tier": F.coalesce(F.col("tier"), F.lit(dims.TIER_OTHER)),
        "province": F.coalesce(F.col("province"), F.col("city")),
    })


def enrich_from_detail(base: DataFrame, detail: DataFrame, key: str, fields: list[str],
                       needs: "F.Column") -> DataFrame:
    """JON-3: rows matching ``needs`` take each non-empty detail field by key;
    other rows are left untouched."""
    d = detail.select(F.col(key).alias("_dk"), *[F.col(f).alias(f"_d_{f}") for f in fields])
    j = base.join(d, base[key] == d["_dk"], "left")
    upd = {f: F.when(needs & F.col(f"_d_{f}").isNotNull() & (F.col(f"_d_{f}") != ""), F.col(f"_d_{f}"))
              .otherwise(F.col(f)) for f in fields}
    return j.withColumns(upd).drop("_dk", *[f"_d_{f}" for f in fields])


def skip_done(df: DataFrame, done: DataFrame, key: str, bounded: bool = False) -> DataFrame:
    """JON-4 / JON-5: drop rows whose key is already in the done-set.

    ``bounded`` marks a done-set that is probably small (e.g. the finished
    keywords of a crawl plan): its size is checked and, if it is, it is
    broadcast; a data-sized set (seen URLs) is left to the planner."""
    d = done.select(key).distinct()
    return df.join(checked_broadcast(d) if bounded else d, key, "left_anti")


def first_n_per_group(df: DataFrame, group: str, order_cols: list, n: int | None = None) -> DataFrame:
    """WIN-7: first ``n`` rows per group in the given order; all without ``n``.

    ``row_number() <= n`` with small ``n`` is planned with a partial
    WindowGroupLimit before the shuffle, so a group holding a third of the
    data ships at most ``n`` rows per map task.
    """
    if n is None:
        return df
    w = Window.partitionBy(group).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def contains_any(col, words) -> "F.Column":
    """FLT-2: substring-any-of over a literal list."""
    c = F.col(col) if isinstance(col, str) else col
    arr = F.array(*[F.lit(w) for w in words])
    return F.coalesce(F.exists(arr, lambda w: c.contains(w)), F.lit(False))


def skill_bridge(df: DataFrame) -> DataFrame:
    """JON-6: the (job_id, skill_name) bridge table from the tag arrays."""
    from hirelens.functions.text import split_tags
    return df.select(F.col("seq").alias("job_id"), F.explode(split_tags("skill_tags")).alias("skill_name"))
