"""The cleaning pipeline (§3.1) as chained DataFrame stages.

Order matters and is kept: salary -> city -> education -> experience ->
tags -> company -> dedup -> fill -> outliers. Each stage is a plain
``DataFrame -> DataFrame`` function usable with ``df.transform``.

Shuffles: one aggregate for dedup (partial aggregation absorbs hot keys),
one per-city aggregate (ratio + three medians, joined back; AQE turns the
join into a broadcast once it has measured the small side), and one
single-row global median consumed as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.functions.salary import is_negotiable, py_strip, with_salary
from hirelens.functions.skills import clean_tags, is_blank_tags, tags_text, with_extracted_skills
from hirelens.functions.text import (city_tier, clean_experience, normalize_date,
                                     normalize_education, with_city)
from hirelens.operators.quantiles import quantiles

SALARY_COLS = ["salary_min", "salary_max", "salary_avg"]

CLEAN_COLUMNS = [
    "seq", "keyword", "job_title", "salary_text", "salary_min", "salary_max",
    "salary_avg", "city", "district", "city_tier", "education", "experience",
    "exp_min", "exp_max", "company_name", "company_size", "industry",
    "skill_tags", "publish_date", "job_url",
]


def clean_salary(df: DataFrame) -> DataFrame:
    """Parse salary text where no numbers are present yet (FLT-5, PRJ-5), then
    swap a reversed min/max without recomputing the average (MTH-5, T9)."""
    has_nums = all(c in df.columns for c in SALARY_COLS)
    if has_nums:
        df = df.withColumnsRenamed({c: f"_given_{c}" for c in SALARY_COLS})
    df = with_salary(df, "salary_text")
    if has_nums:
        reparse = ((F.col("_given_salary_min").isNull() | (F.col("_given_salary_min") == 0))
                   & F.col("salary_text").isNotNull() & (F.col("salary_text") != "")
                   & (F.col("salary_text") != dims.NEGOTIABLE_MARK) & F.col("salary_min").isNotNull())
        df = df.withColumns({c: F.when(reparse, F.col(c)).otherwise(F.col(f"_given_{c}"))
                             for c in SALARY_COLS}).drop(*[f"_given_{c}" for c in SALARY_COLS])
    swap = (F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull()
            & (F.col("salary_min") > F.col("salary_max")))
    return df.withColumns({
        "salary_min": F.when(swap, F.col("salary_max")).otherwise(F.col("salary_min")),
        "salary_max": F.when(swap, F.col("salary_min")).otherwise(F.col("salary_max")),
    })


def clean_city(df: DataFrame) -> DataFrame:
    """STR-2 plus the tier (JON-1 on a literal map; unknown -> 其他)."""
    df = with_city(df, "city")
    return df.withColumn("city_tier", city_tier("city"))


def clean_education(df: DataFrame) -> DataFrame:
    return df.withColumn("education", normalize_education("education"))


def clean_exp(df: DataFrame) -> DataFrame:
    return clean_experience(df, "experience")


def clean_skill_tags(df: DataFrame) -> DataFrame:
    """STR-10: cleaned tag array ``skill_arr`` and its text ``skill_tags``.
    Missing tags with nothing extractable keep their original value."""
    df = with_extracted_skills(df, "job_title", "industry", "keyword", "_extracted",
                               only_when=is_blank_tags(F.col("skill_tags")))
    df = df.withColumn("skill_arr", clean_tags("skill_tags", "_extracted")).drop("_extracted")
    return df.withColumn("skill_tags", F.when(F.col("skill_arr").isNull(), F.col("skill_tags"))
                         .otherwise(tags_text("skill_arr")))


def clean_company(df: DataFrame) -> DataFrame:
    """STR-12: fill 未知 and strip company and industry."""
    return df.withColumns({
        "company_name": py_strip(F.coalesce(F.col("company_name"), F.lit(dims.UNKNOWN))),
        "industry": py_strip(F.coalesce(F.col("industry"), F.lit(dims.UNKNOWN))),
    })


def dedup_key_cols():
    """STR-13: (company, title, avg or -1) as three grouping columns."""
    return [py_strip(F.coalesce(F.col("company_name"), F.lit(""))).alias("_k_company"),
            py_strip(F.coalesce(F.col("job_title"), F.lit(""))).alias("_k_title"),
            F.coalesce(F.col("salary_avg"), F.lit(-1.0)).alias("_k_salary")]


def first_per_key(df: DataFrame, keys, order_col: str = "seq", keep: str = "first") -> DataFrame:
    """WIN-1 / WIN-8 / SET-5: keep one whole row per key, the one with the
    smallest (``first``) or largest (``last``) ``order_col``, a number that is
    unique within a key.

    The order's minimum or maximum per key is a hash aggregate with partial
    aggregation (a key with a third of all rows collapses inside each map
    task); whole rows are then kept by a semi-join on (key, order), which
    spreads a hot key over its orders. Null keys are a key.
    """
    names = [f"_key{i}" for i in range(len(keys))]
    keyed = df.withColumns({n: F.col(k) if isinstance(k, str) else k for n, k in zip(names, keys)})
    pick = F.min(order_col) if keep == "first" else F.max(order_col)
    best = keyed.groupBy(*names).agg(pick.alias("_best")).select(*[F.col(n).alias(f"_b{n}") for n in names], "_best")
    same = F.col(order_col).eqNullSafe(F.col("_best"))
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"_b{n}"))
    return keyed.join(best, same, "left_semi").select(*df.columns)


def deduplicate(df: DataFrame) -> DataFrame:
    """WIN-1: first row (smallest seq) per (company, title, avg-or--1).

    ``min(seq)`` per key is a hash aggregate with partial aggregation (a key
    with a third of all rows collapses inside each map task); the rows are
    then kept by a semi-join on (key, seq), which is hash-partitioned on the
    row's own seq as well, so a hot key spreads over all tasks. This is
    cheaper than carrying whole rows through a sort-based struct aggregate."""
    keys = dedup_key_cols()
    names = ["_k_company", "_k_title", "_k_salary"]
    keyed = df.select("*", *keys)
    firsts = keyed.groupBy(*names).agg(F.min("seq").alias("seq"))
    return keyed.join(firsts, names + ["seq"], "left_semi").select(*df.columns)


def city_salary_stats(df: DataFrame) -> DataFrame:
    """AGG-8 + WIN-2/JON-9 inputs per city: negotiable ratio and exact medians
    (linear interpolation) of the three salary columns."""
    neg = F.coalesce(F.col("salary_text").contains(dims.NEGOTIABLE_MARK), F.lit(False))
    named = df.where(F.col("city").isNotNull())
    ratio = named.groupBy("city").agg(F.avg(neg.cast("double")).alias("neg_ratio"))
    return ratio.join(quantiles(named, ["city"], {f"med_{c}": (c, 0.5) for c in SALARY_COLS}), "city", "left")


def fill_missing(df: DataFrame, approx_global: bool = False, keep_flag: bool = False) -> DataFrame:
    """T10/T11: city median fill -> x1.1 for negotiable rows of cities whose
    negotiable ratio (on the deduplicated rows) exceeds 0.3 -> global median
    of the adjusted column; then city -> 未知, exp -> 0. ``keep_flag`` keeps
    a ``bumped`` column marking the rows that got the x1.1 factor."""
    from hirelens.session import checked_broadcast, materialize
    # written first, so that its true size decides: a broadcast, or a join in
    # which a city's rows are dealt by a salt to as many copies of its figures
    stats = materialize(city_salary_stats(df), "city-stats")
    small = checked_broadcast(stats)
    if small is not stats:
        j = df.join(small, on="city", how="left")
    else:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salted = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        j = df.withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(n)).cast("int")).join(salted, ["city", "_salt"], "left").drop("_salt")
    high = F.coalesce(F.col("neg_ratio") > dims.NEGOTIABLE_RATIO_LIMIT, F.lit(False))
    bump = high & F.coalesce(F.col("salary_text").contains(dims.NEGOTIABLE_MARK), F.lit(False))
    staged = j.withColumn("bumped", bump).withColumns({
        c: F.when(F.col("bumped"), F.coalesce(F.col(c), F.col(f"med_{c}")) * dims.NEGOTIABLE_FACTOR)
            .otherwise(F.coalesce(F.col(c), F.col(f"med_{c}")))
        for c in SALARY_COLS
    }).drop("neg_ratio", *[f"med_{c}" for c in SALARY_COLS])
    if not keep_flag:
        staged = staged.drop("bumped")
    if approx_global:
        one = staged.agg(*[F.percentile_approx(F.col(c), 0.5, 10000).alias(c) for c in SALARY_COLS])
    else:
        one = quantiles(staged, [], {c: (c, 0.5) for c in SALARY_COLS})
    # one row, evaluated once as a scalar subquery into one column
    glob = one.select(F.struct(*SALARY_COLS).alias("g")).scalar()
    filled = staged.withColumn("_g", glob)
    filled = filled.withColumns({c: F.coalesce(F.col(c), F.col("_g")[c]) for c in SALARY_COLS}).drop("_g")
    return filled.withColumns({
        "exp_min": F.coalesce(F.col("exp_min"), F.lit(0.0)),
        "exp_max": F.coalesce(F.col("exp_max"), F.lit(0.0)),
        "city": F.coalesce(F.col("city"), F.lit(dims.UNKNOWN_CITY)),
    })


def remove_outliers(df: DataFrame) -> DataFrame:
    """FLT-3: salary null or within [0, 1e6] (0 is kept, T12), title present."""
    return df.where(not_outlier())


def not_outlier():
    ok_salary = F.col("salary_avg").isNull() | F.col("salary_avg").between(0, dims.OUTLIER_SALARY_MAX)
    ok_title = F.col("job_title").isNotNull() & (F.col("job_title") != "")
    return ok_salary & ok_title


def parse_dates(df: DataFrame) -> DataFrame:
    """DAT-1 at ingest: a DATE column; the raw text stays in publish_date_raw."""
    return (df.withColumn("publish_date_raw", F.col("publish_date"))
              .withColumn("publish_date", normalize_date("publish_date")))


def standardize(raw: DataFrame) -> DataFrame:
    """Column cleaning only (no row removal): stages 3a..3f."""
    return (raw.transform(parse_dates)
               .transform(clean_salary)
               .transform(clean_city)
               .transform(clean_education)
               .transform(clean_exp)
               .transform(clean_skill_tags)
               .transform(clean_company))


def clean_postings(raw: DataFrame, approx_global: bool = False) -> DataFrame:
    """Full §3.1 pipeline: standardize -> dedup -> fill -> outliers.

    The standardized rows are both sides of the dedup join and the
    deduplicated rows feed three consumers (the row side of the city join,
    the per-city aggregate and the global median), so each is written once to
    the shared folder and read back (see ``session.materialize``): every text
    is parsed once.
    """
    from hirelens.session import materialize
    df = materialize(deduplicate(materialize(standardize(raw), "standardized")), "dedup-postings")
    df = fill_missing(df, approx_global=approx_global)
    return remove_outliers(df)

