"""Model features (ML-1, ML-2, ML-10, FLT-4, MTH-2, MTH-3, AGG-23)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.functions.text import map_or_default, row_mean, tag_count

FEATURES = ["city_tier_enc", "education_enc", "exp_avg", "skill_count", "is_face", "company_size_enc"]


def valid_salary(df: DataFrame) -> DataFrame:
    """FLT-4: rows with a positive salary."""
    return df.where(F.col("salary_avg").isNotNull() & (F.col("salary_avg") > 0))


def regression_features(df: DataFrame) -> DataFrame:
    """ML-1: the six ordinal/count features and the log1p target."""
    d = valid_salary(df)
    face = F.coalesce(F.col("salary_text").contains(dims.NEGOTIABLE_MARK), F.lit(False)) \
        if "salary_text" in d.columns else F.lit(False)
    return d.select(
        "seq", "salary_avg",
        F.log1p("salary_avg").alias("salary_log"),
        map_or_default(F.coalesce(F.col("city_tier"), F.lit("其他")), dims.CITY_TIER_ORDER, 0)
        .cast("double").alias("city_tier_enc"),
        map_or_default(F.coalesce(F.col("education"), F.lit("不限")), dims.EDUCATION_ORDER, 0)
        .cast("double").alias("education_enc"),
        F.coalesce(row_mean("exp_min", "exp_max"), F.lit(0.0)).alias("exp_avg"),
        tag_count("skill_tags").cast("double").alias("skill_count"),
        face.cast("double").alias("is_face"),
        map_or_default("company_size", dims.COMPANY_SIZE_CODE, dims.COMPANY_SIZE_DEFAULT)
        .cast("double").alias("company_size_enc"),
    )


def split_flag(seq_col: str = "seq", hashed: bool = False) -> "F.Column":
    """ML-2: deterministic 80/20 split on the key, repeatable across
    partitionings (unlike ``randomSplit``). ``hashed`` first scrambles a key
    whose low digits carry meaning."""
    k = F.xxhash64(F.col(seq_col)) if hashed else F.col(seq_col)
    return F.pmod(k, F.lit(10)) < dims.TRAIN_SHARE_TENTHS


def target_summary(feats: DataFrame) -> DataFrame:
    """AGG-23: min, max, mean and population std of the target."""
    y = F.col("salary_log")
    return feats.agg(F.count(y).alias("n"), F.bround(F.min("salary_avg"), 2).alias("salary_min"),
                     F.bround(F.max("salary_avg"), 2).alias("salary_max"),
                     F.bround(F.avg(y), 6).alias("log_mean"), F.bround(F.stddev_pop(y), 6).alias("log_std"))


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """ML-10: (x - mean) / population std per column, from one aggregate
    consumed as a scalar subquery (sklearn's scaler uses the population std;
    Spark's StandardScaler uses the sample std)."""
    stats = df.agg(F.struct(*[F.avg(c).alias(f"m_{c}") for c in cols],
                            *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).alias("s")).scalar()
    out = df
    for c in cols:
        sd = stats[f"s_{c}"]
        out = out.withColumn(f"{c}_z", F.when(sd > 0, (F.col(c) - stats[f"m_{c}"]) / sd).otherwise(F.lit(0.0)))
    return out
