"""Dashboard queries (FLT-1, AGG-9..15, TOP-3/4, JON-7, PRJ-9/10, SET-4).

``dashboard(df, city=..., education=..., keyword=..., exp_range=...)``
returns a dict of lazy DataFrames that share one filtered parent; the
filters are plain predicates, so on a Parquet table they reach the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.functions.text import bin_label, bin_order, province
from hirelens.operators.stats import exploded_tags


def _r(c, d=0):
    return F.bround(c, d)


def with_dash_columns(df: DataFrame) -> DataFrame:
    """Derived columns of the dashboard frame: province, exp_bin, skill_count."""
    from hirelens.functions.text import tag_count
    return df.withColumns({
        "province": province("city"),
        "exp_bin": bin_label("exp_min", dims.DASH_EXP_BINS),
        "exp_bin_order": bin_order("exp_min", dims.DASH_EXP_BINS),
        "skill_count": tag_count("skill_tags"),
    })


def apply_filters(df: DataFrame, city: str = "", education: str = "", keyword: str = "",
                  exp_range: str = "") -> DataFrame:
    """FLT-1: blank parameter = no filter; ``lo-hi`` on exp_min, bad range ignored."""
    city, education, keyword, exp_range = (x.strip() if x else "" for x in (city, education, keyword, exp_range))
    if city:
        df = df.where(F.col("city") == city)
    if education:
        df = df.where(F.col("education") == education)
    if keyword:
        df = df.where(F.col("keyword") == keyword)
    if exp_range:
        try:
            lo_s, hi_s = exp_range.split("-")[:2]
            lo, hi = float(lo_s), float(hi_s)
            df = df.where((F.col("exp_min") >= lo) & (F.col("exp_min") < hi))
        except ValueError:
            pass
    return df


def chart_bar_city(df: DataFrame, n: int = 12) -> DataFrame:
    """AGG-10: city mean salary and count, Top-n by mean."""
    s = F.col("salary_avg")
    return (df.groupBy("city").agg(_r(F.avg(s)).alias("avg_salary"), F.count(s).alias("count"))
              .orderBy(F.desc_nulls_last("avg_salary"), "city").limit(n))


def chart_pie_edu(df: DataFrame) -> DataFrame:
    """AGG-11: rows per education with the mean salary (0 when none)."""
    s = F.col("salary_avg")
    return (df.where(F.col("education").isNotNull()).groupBy("education")
              .agg(F.count(F.lit(1)).alias("value"),
                   F.coalesce(_r(F.avg(s)), F.lit(0.0)).cast("long").alias("avg_salary"))
              .orderBy(F.desc("value"), "education"))


def chart_map(df: DataFrame) -> DataFrame:
    """AGG-12 + PRJ-10: rows per city under its map display name."""
    name = F.coalesce(F.try_element_at(F.create_map(*[x for k, v in dims.CITY_TO_GEONAME.items()
                                                      for x in (F.lit(k), F.lit(v))]), F.col("city")),
                      F.col("city"))
    return (df.where(F.col("city").isNotNull()).groupBy("city").agg(F.count(F.lit(1)).alias("value"))
              .select(F.col("city"), name.alias("name"), "value").orderBy("city"))


def blocklisted_tags(df: DataFrame) -> DataFrame:
    """FLT-6 / SET-4: exploded tags minus the non-skill blocklist."""
    t = exploded_tags(df, cols=("salary_avg",))
    return t.where(~F.col("tag").isin(*dims.SKILL_BLOCKLIST))


def chart_wordcloud(df: DataFrame, n: int = 50) -> DataFrame:
    """AGG-13: Top-n tags outside the blocklist."""
    return (blocklisted_tags(df).groupBy("tag").agg(F.count(F.lit(1)).alias("value"))
              .select(F.col("tag").alias("name"), "value")
              .orderBy(F.desc("value"), "name").limit(n))


def chart_line_exp(df: DataFrame) -> DataFrame:
    """AGG-14 + JON-7: mean/count per experience bin, overall (series 全部) and
    per keyword, aligned to the overall bins (missing -> null mean, 0 count).

    One ``GROUPING SETS ((bin), (bin, keyword))`` aggregate; the spine is the
    overall result (bins x keywords, both tiny), so the alignment join is
    between small frames.
    """
    s = F.col("salary_avg")
    d = with_dash_columns(df).where(F.col("exp_bin").isNotNull())
    g = (d.groupingSets([["exp_bin", "exp_bin_order"], ["exp_bin", "exp_bin_order", "keyword"]],
                        "exp_bin", "exp_bin_order", "keyword")
          .agg(_r(F.avg(s)).alias("avg_salary"), F.count(s).alias("count"),
               F.grouping("keyword").alias("_overall")))
    overall = g.where("_overall = 1").where(F.col("avg_salary").isNotNull()) \
               .select("exp_bin", "exp_bin_order", "avg_salary", "count")
    per_kw = g.where("_overall = 0 AND keyword IS NOT NULL").where(F.col("avg_salary").isNotNull()) \
              .select("exp_bin", "keyword", F.col("avg_salary").alias("kw_avg"), F.col("count").alias("kw_count"))
    # spine = keywords x overall bins; the bin list is bounded by the fixed bin spec
    bins = overall.agg(F.collect_list(F.struct("exp_bin", "exp_bin_order")).alias("b")).scalar()
    spine = (d.where(F.col("keyword").isNotNull()).select("keyword").distinct()
              .select("keyword", F.explode(bins).alias("_b"))
              .select("keyword", "_b.exp_bin", "_b.exp_bin_order"))
    aligned = (spine.join(per_kw, ["exp_bin", "keyword"], "left")
                    .select(F.col("keyword").alias("series"), "exp_bin", "exp_bin_order",
                            F.col("kw_avg").alias("avg_salary"),
                            F.coalesce(F.col("kw_count"), F.lit(0)).alias("count")))
    whole = overall.select(F.lit("全部").alias("series"), "exp_bin", "exp_bin_order", "avg_salary", "count")
    return whole.unionByName(aligned).orderBy("series", "exp_bin_order")


def chart_industry(df: DataFrame, n: int = 10) -> DataFrame:
    """AGG-15: industries by mean salary, Top-n."""
    s = F.col("salary_avg")
    return (df.groupBy("industry").agg(_r(F.avg(s)).alias("avg_salary"), F.count(s).alias("count"))
              .orderBy(F.desc_nulls_last("avg_salary"), "industry").limit(n))


def chart_scatter(df: DataFrame, n: int = 10, jitter_seed: int | None = None) -> DataFrame:
    """TOP-4: salary points of the Top-n cities by row count; x = city rank
    (plus +-0.4 jitter when a seed is given; compared output has none)."""
    top = (df.where(F.col("city").isNotNull()).groupBy("city").agg(F.count(F.lit(1)).alias("n"))
             .orderBy(F.desc("n"), "city").limit(n)
             .withColumn("city_idx", F.row_number().over(Window.orderBy(F.desc("n"), "city")) - 1))
    pts = df.where(F.col("salary_avg").isNotNull()).join(F.broadcast(top), "city")  # top has <= n rows
    x = F.col("city_idx").cast("double")
    if jitter_seed is not None:
        x = _r(x + (F.rand(jitter_seed) * 0.8 - 0.4), 2)
    return pts.select("city", F.col("city_idx").cast("long").alias("city_idx"), x.alias("x"),
                      _r(F.col("salary_avg")).alias("y"), "seq")


def kpi(df: DataFrame) -> DataFrame:
    """AGG-9 + TOP-3: total, mean salary, best city by mean (ties -> smallest
    name) and its mean, and the most frequent non-blocklisted tag.

    The two argmax values are single-row aggregates consumed as scalar
    subqueries, so no row-pairing join is needed.
    """
    s = F.col("salary_avg")
    per_city = (df.where(F.col("city").isNotNull()).groupBy("city").agg(F.avg(s).alias("m"))
                  .where(F.col("m").isNotNull()))
    best = per_city.agg(F.min_by(F.struct("city", "m"), F.struct(-F.col("m"), F.col("city"))).alias("b"))
    tags = blocklisted_tags(df).groupBy("tag").agg(F.count(F.lit(1)).alias("c"))
    top = tags.agg(F.min_by(F.col("tag"), F.struct(-F.col("c"), F.col("tag"))).alias("t"))
    totals = df.agg(F.count(F.lit(1)).alias("total_jobs"), _r(F.avg(s)).cast("long").alias("avg_salary"))
    # each single-row aggregate is consumed once (one subquery execution each)
    return totals.withColumns({"_b": best.scalar(), "_t": top.scalar()}).select(
        "total_jobs", "avg_salary", F.col("_b.city").alias("top_city"),
        _r(F.col("_b.m")).cast("long").alias("top_city_salary"),
        F.coalesce(F.col("_t"), F.lit("--")).alias("top_skill"))


def dashboard(df: DataFrame, city: str = "", education: str = "", keyword: str = "",
              exp_range: str = "") -> dict:
    """All seven charts plus the row count over one filtered parent frame."""
    f = apply_filters(with_dash_columns(df), city, education, keyword, exp_range)
    return {
        "count": f.agg(F.count(F.lit(1)).alias("count")),
        "chart_bar_city": chart_bar_city(f),
        "chart_pie_edu": chart_pie_edu(f),
        "chart_scatter_exp": chart_scatter(f),
        "chart_map_province": chart_map(f),
        "chart_wordcloud": chart_wordcloud(f),
        "chart_line_exp": chart_line_exp(f),
        "chart_industry": chart_industry(f),
    }
