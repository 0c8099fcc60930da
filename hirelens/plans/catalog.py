"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus DuckDB oracles.

Every query reads the driver tables (or frames Spark derives from them)
in full; limits appear only where Top-n is the feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.plans.oracle_base import with_clean, with_parsed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- shared frames
def raw(spark, sf_dir) -> DataFrame:
    from hirelens.sources.fixtures import raw_postings
    return raw_postings(spark, sf_dir)


_WRITTEN: dict = {}


def _version(spark, sf_dir) -> tuple:
    """The postings' input files with their times and sizes: what is written
    for one state of them is not used for another."""
    files = spark.read.format("binaryFile").load([f"{sf_dir.rstrip('/')}/{t}.parquet" for t in ("orders", "customer")])
    rows = files.select("path", "modificationTime", "length").collect()
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), tuple(sorted((r[0], str(r[1]), r[2]) for r in rows)))


def _once(spark, sf_dir, name, make):
    """``make()``'s result, made once per session and state of the input."""
    key = (name, _version(spark, sf_dir))
    if key not in _WRITTEN:
        _WRITTEN[key] = make()
    return _WRITTEN[key]


def standardized(spark, sf_dir) -> DataFrame:
    """The standardized postings, parsed and written once per session."""
    from hirelens.operators.clean import standardize
    from hirelens.session import materialize
    return _once(spark, sf_dir, "standardized", lambda: materialize(standardize(raw(spark, sf_dir)), "standardized"))


def deduplicated(spark, sf_dir) -> DataFrame:
    from hirelens.operators.clean import deduplicate
    from hirelens.session import materialize
    return _once(spark, sf_dir, "deduplicated", lambda: materialize(deduplicate(standardized(spark, sf_dir)), "dedup-postings"))


def cleaned(spark, sf_dir) -> DataFrame:
    """The cleaned postings table (SNK-2), written once per session and input.

    Like the clean -> analyze split of the original tool, the cleaning job
    runs once and writes Parquet (partitioned by keyword, the dashboard's
    most common filter) to the cluster's shared checkpoint folder; every
    analysis then scans that table with pruning and pushdown. The write also
    cuts the long lineage, so a lost executor re-reads Parquet instead of
    recomputing the whole cleaning plan.
    """
    from hirelens.operators.clean import fill_missing, remove_outliers
    from hirelens.session import unique_dir

    def make():
        path = unique_dir(spark, "cleaned-postings")
        remove_outliers(fill_missing(deduplicated(spark, sf_dir))).write.mode("overwrite").partitionBy("keyword").parquet(path)
        return path
    return spark.read.parquet(_once(spark, sf_dir, "cleaned", make))


def cleaned_sketches(spark, sf_dir) -> DataFrame:
    """(keyword, n, companies, industries: sketches) stored beside the cleaned table."""
    from hirelens.operators.quality import distinct_sketches
    from hirelens.session import materialize
    return _once(spark, sf_dir, "sketches", lambda: materialize(
        distinct_sketches(cleaned(spark, sf_dir), "keyword", {"companies": "company_name", "industries": "industry"}), "cleaned-sketches"))


# ------------------------------------------------------------- text parsers
@register("salary_parse", with_parsed(
    "SELECT seq, salary_min, salary_max, salary_avg FROM parsed"))
def q_salary_parse(spark, sf_dir):
    from hirelens.functions.salary import with_salary
    return with_salary(raw(spark, sf_dir)).select("seq", "salary_min", "salary_max", "salary_avg")


@register("city_normalize", with_parsed("""
    SELECT seq, city, district, city_tier,
      CASE city WHEN '北京' THEN '北京' WHEN '上海' THEN '上海' WHEN '深圳' THEN '广东' WHEN '广州' THEN '广东'
        WHEN '珠海' THEN '广东' WHEN '杭州' THEN '浙江' WHEN '成都' THEN '四川' WHEN '苏州' THEN '江苏' END AS province
    FROM parsed"""))
def q_city_normalize(spark, sf_dir):
    from hirelens.functions.text import city_tier, province, with_city
    df = with_city(raw(spark, sf_dir), "city")
    return df.select("seq", "city", "district", city_tier("city").alias("city_tier"),
                     province("city").alias("province"))


@register("education_normalize", with_parsed("SELECT seq, education FROM parsed"))
def q_education_normalize(spark, sf_dir):
    from hirelens.functions.text import normalize_education
    return raw(spark, sf_dir).select("seq", normalize_education("education").alias("education"))


@register("experience_parse", with_parsed("SELECT seq, experience, exp_min, exp_max FROM parsed"))
def q_experience_parse(spark, sf_dir):
    from hirelens.functions.text import clean_experience
    return clean_experience(raw(spark, sf_dir), "experience").select("seq", "experience", "exp_min", "exp_max")


@register("date_normalize", with_parsed("""
    SELECT seq, publish_date,
      publish_date IS NOT NULL AND (year(publish_date) < 2000 OR year(publish_date) > 2030) AS year_out_of_range
    FROM parsed"""))
def q_date_normalize(spark, sf_dir):
    from hirelens.functions.text import normalize_date
    d = normalize_date("publish_date")
    return raw(spark, sf_dir).select(
        "seq", d.alias("publish_date"),
        (d.isNotNull() & ~F.year(d).between(2000, 2030)).alias("year_out_of_range"))


@register("skill_tags_clean", with_parsed("SELECT seq, skill_tags FROM parsed"))
def q_skill_tags_clean(spark, sf_dir):
    from hirelens.operators.clean import clean_skill_tags
    return clean_skill_tags(raw(spark, sf_dir)).select("seq", "skill_tags")


# ------------------------------------------------------------- cleaning stages
@register("dedup_first", with_clean("SELECT seq, company_name, job_title, salary_avg FROM ("
                                    "SELECT seq, company_name, job_title, salary_avg FROM dedup)"))
def q_dedup_first(spark, sf_dir):
    return deduplicated(spark, sf_dir).select("seq", "company_name", "job_title", "salary_avg")


@register("negotiable_ratio", with_clean("""
    SELECT city, count(*) AS total, CAST(sum(CASE WHEN neg THEN 1 ELSE 0 END) AS BIGINT) AS negotiable,
           round_even(avg(CASE WHEN neg THEN 1.0 ELSE 0.0 END), 6) AS ratio,
           avg(CASE WHEN neg THEN 1.0 ELSE 0.0 END) > 0.3 AS above_limit
    FROM dedup WHERE city IS NOT NULL GROUP BY city"""))
def q_negotiable_ratio(spark, sf_dir):
    from hirelens.operators.quality import negotiable_ratio
    return negotiable_ratio(deduplicated(spark, sf_dir))


@register("impute_salary", with_clean("""
    SELECT seq, city, round_even(f_min, 4) AS salary_min, round_even(f_max, 4) AS salary_max,
           round_even(f_avg, 4) AS salary_avg, bump AS bumped FROM filled"""))
def q_impute_salary(spark, sf_dir):
    from hirelens.operators.clean import fill_missing
    f = fill_missing(deduplicated(spark, sf_dir), keep_flag=True)
    return f.select("seq", F.when(F.col("city") == "未知", None).otherwise(F.col("city")).alias("city"),
                    F.bround("salary_min", 4).alias("salary_min"), F.bround("salary_max", 4).alias("salary_max"),
                    F.bround("salary_avg", 4).alias("salary_avg"), "bumped")


CLEAN_SELECT = """SELECT seq, keyword, job_title, round_even(salary_min, 4) AS salary_min,
    round_even(salary_max, 4) AS salary_max, round_even(salary_avg, 4) AS salary_avg, city, district, city_tier,
    education, experience, exp_min, exp_max, company_name, company_size, industry, skill_tags, publish_date, job_url
    FROM clean"""


@register("clean_pipeline", with_clean(CLEAN_SELECT))
def q_clean_pipeline(spark, sf_dir):
    from hirelens.operators.clean import clean_postings
    c = clean_postings(raw(spark, sf_dir))
    return c.select("seq", "keyword", "job_title", *[F.bround(x, 4).alias(x) for x in
                                                      ("salary_min", "salary_max", "salary_avg")],
                    "city", "district", "city_tier", "education", "experience", "exp_min", "exp_max",
                    "company_name", "company_size", "industry", "skill_tags", "publish_date", "job_url")


@register("clean_counters", with_clean("""
    SELECT (SELECT count(*) FROM parsed) AS raw_count,
           (SELECT count(*) FROM parsed) - (SELECT count(*) FROM dedup) AS dedup_removed,
           (SELECT count(*) FROM filled) - (SELECT count(*) FROM clean) AS outliers_removed,
           (SELECT count(*) FROM clean) AS cleaned_count,
           round_even(100.0 * (SELECT count(*) FROM clean) / (SELECT count(*) FROM parsed), 1) AS retention_pct,
           (SELECT count(DISTINCT company_name) FROM clean) AS companies,
           (SELECT count(DISTINCT industry) FROM clean) AS industries"""))
def q_clean_counters(spark, sf_dir):
    from hirelens.operators.quality import pipeline_counters
    return pipeline_counters(raw(spark, sf_dir))


@register("clean_sketches", with_clean("""
    SELECT coalesce(keyword, '_all') AS part, count(*) AS n, count(DISTINCT company_name) AS companies, count(DISTINCT industry) AS industries
    FROM clean GROUP BY ROLLUP (keyword)"""))
def q_clean_sketches(spark, sf_dir):
    """AGG-17 by sketches: distinct companies and industries of each partition
    of the cleaned table, and of all by merging; no row is read again. Up to
    some 16,000 values a sketch holds them one by one, so it is exact here."""
    from hirelens.operators.quality import merged_sketches
    s = cleaned_sketches(spark, sf_dir)
    each = merged_sketches(s, ["companies", "industries"], "keyword").withColumnRenamed("keyword", "part")
    return each.unionByName(merged_sketches(s, ["companies", "industries"]).withColumn("part", F.lit("_all")))
