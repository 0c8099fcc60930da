"""Cluster profiles and rule-based names (AGG-21, WIN-4, CAT-1, AGG-18)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.functions.text import row_mean, split_tags


def _top_n(df: DataFrame, label: str, key: str, n: int, out: str, with_counts: bool) -> DataFrame:
    """WIN-4: the n most frequent values per cluster (count desc, value asc),
    joined as text. ``row_number() <= n`` plans a partial group limit before
    the shuffle, so a hot cluster ships at most n rows per map task."""
    counts = df.where(F.col(key).isNotNull()).groupBy(label, key).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(label).orderBy(F.desc("_c"), key)
    top = counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    item = F.concat(F.col(key), F.lit(":"), F.col("_c").cast("string")) if with_counts else F.col(key)
    return (top.groupBy(label)
               .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", item.alias("v")))),
                                             lambda x: x["v"]), ", ").alias(out)))


def segment_name(salary, exp, edu, industries) -> "F.Column":
    """CAT-1: ordered naming rules on the rounded mean salary and experience,
    the education mode and the top industries."""
    names = dims.SEGMENT_NAMES
    high_edu = edu.isin(*dims.HIGH_EDUCATION)
    ai = F.lit(False)
    for w in dims.AI_INDUSTRY_WORDS:
        ai = ai | F.coalesce(industries.contains(w), F.lit(False))
    mid_name = F.concat(F.lit(names["mid_senior_tpl"].split("{}")[0]), F.when(high_edu, edu).otherwise(F.lit("")),
                        F.lit(names["mid_senior_tpl"].split("{}")[1]))
    return (F.when(salary > 30000, F.when(exp >= 4, F.lit(names["senior_high_pay"])).otherwise(F.lit(names["very_high_pay"])))
             .when((salary > 20000) & high_edu, F.lit(names["high_edu_high_pay"]))
             .when((salary > 20000) & ai, F.lit(names["high_pay_tech"]))
             .when(salary > 20000, F.lit(names["senior_tech"]))
             .when(salary > 16000, mid_name)
             .when((salary >= 12000) & (exp < 2), F.lit(names["entry_analyst"]))
             .when((salary >= 8000) & (exp < 1.5), F.lit(names["junior_entry"]))
             .when(salary >= 8000, F.lit(names["mid_tech"]))
             .otherwise(F.lit(names["junior_general"])))


def cluster_profiles(df: DataFrame, label: str = "cluster") -> DataFrame:
    """AGG-21: per cluster count, share %, mean salary, mean experience
    (row mean of min/max), education mode (smallest on ties), top-5 skills,
    top-3 industries and cities with counts, and the segment name."""
    total = df.agg(F.count(F.lit(1))).scalar()
    base = (df.groupBy(label)
              .agg(F.count(F.lit(1)).alias("count"),
                   F.bround(F.avg("salary_avg"), 0).alias("avg_salary"),
                   F.bround(F.avg(row_mean("exp_min", "exp_max")), 1).alias("avg_experience"),
                   F.mode("education", deterministic=True).alias("education_mode")))
    base = base.withColumn("percentage", F.bround(F.col("count") * 100.0 / total, 1))
    tags = df.select(label, F.explode(split_tags("skill_tags")).alias("skill"))
    skills = _top_n(tags, label, "skill", 5, "top5_skills", False)
    inds = _top_n(df, label, "industry", 3, "top3_industries", True)
    cities = _top_n(df, label, "city", 3, "top3_cities", True)
    out = base.join(skills, label, "left").join(inds, label, "left").join(cities, label, "left")
    name = segment_name(F.col("avg_salary"), F.col("avg_experience"), F.col("education_mode"),
                        F.coalesce(F.col("top3_industries"), F.lit("")))
    return out.withColumn("cluster_name", name)
