"""Statistics and dashboard queries over the cleaned postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens.plans.catalog import cleaned, register
from hirelens.plans.oracle_base import with_clean


@register("city_salary", with_clean("""
    SELECT city, count(salary_avg) AS count, round_even(avg(salary_avg), 0) AS avg_salary,
      round_even(quantile_cont(salary_avg, 0.5), 0) AS median_salary,
      round_even(min(salary_avg), 0) AS min_salary, round_even(max(salary_avg), 0) AS max_salary
    FROM clean GROUP BY city"""))
def q_city_salary(spark, sf_dir):
    from hirelens.operators.stats import city_salary
    return city_salary(cleaned(spark, sf_dir))


@register("education_quartiles", with_clean("""
    SELECT education, CASE education WHEN '不限' THEN 0 WHEN '大专' THEN 1 WHEN '本科' THEN 2 WHEN '硕士' THEN 3
             WHEN '博士' THEN 4 END AS edu_order,
      count(salary_avg) AS count, round_even(avg(salary_avg), 0) AS avg_salary,
      round_even(quantile_cont(salary_avg, 0.25), 0) AS q1, round_even(quantile_cont(salary_avg, 0.5), 0) AS median,
      round_even(quantile_cont(salary_avg, 0.75), 0) AS q3
    FROM clean WHERE education IN ('不限', '大专', '本科', '硕士', '博士') AND salary_avg IS NOT NULL
    GROUP BY education"""))
def q_education_quartiles(spark, sf_dir):
    from hirelens.operators.stats import education_quartiles
    return education_quartiles(cleaned(spark, sf_dir))


STATS_BIN_SQL = """CASE WHEN exp_min >= 0 AND exp_min < 1 THEN '0-1年' WHEN exp_min >= 1 AND exp_min < 2 THEN '1-2年'
  WHEN exp_min >= 2 AND exp_min < 3 THEN '2-3年' WHEN exp_min >= 3 AND exp_min < 5 THEN '3-5年'
  WHEN exp_min >= 5 AND exp_min < 7 THEN '5-7年' WHEN exp_min >= 7 AND exp_min < 10 THEN '7-10年'
  WHEN exp_min >= 10 AND exp_min < 15 THEN '10-15年' WHEN exp_min >= 15 AND exp_min < 100 THEN '15年+' END"""
STATS_BIN_ORDER = """CASE WHEN exp_min >= 0 AND exp_min < 1 THEN 0 WHEN exp_min >= 1 AND exp_min < 2 THEN 1
  WHEN exp_min >= 2 AND exp_min < 3 THEN 2 WHEN exp_min >= 3 AND exp_min < 5 THEN 3
  WHEN exp_min >= 5 AND exp_min < 7 THEN 4 WHEN exp_min >= 7 AND exp_min < 10 THEN 5
  WHEN exp_min >= 10 AND exp_min < 15 THEN 6 WHEN exp_min >= 15 AND exp_min < 100 THEN 7 END"""


@register("experience_bins", with_clean(f"""
    SELECT exp_bin, bin_order, count(salary_avg) AS count, round_even(avg(salary_avg), 0) AS avg_salary
    FROM (SELECT *, {STATS_BIN_SQL} AS exp_bin, {STATS_BIN_ORDER} AS bin_order FROM clean)
    WHERE exp_bin IS NOT NULL GROUP BY exp_bin, bin_order HAVING avg(salary_avg) IS NOT NULL"""))
def q_experience_bins(spark, sf_dir):
    from hirelens.operators.stats import experience_bins
    return experience_bins(cleaned(spark, sf_dir))


TAGS_SQL = """tags AS (
  SELECT salary_avg, city, keyword, education, exp_min, trim(t) AS tag
  FROM clean, unnest(string_split(coalesce(skill_tags, ''), ',')) AS u(t)
  WHERE skill_tags IS NOT NULL AND skill_tags <> 'nan' AND trim(t) <> ''
)"""


@register("skill_top20", with_clean(f""", {TAGS_SQL}
    SELECT tag AS skill, count(*) AS count,
      round_even(coalesce(sum(CASE WHEN salary_avg > 0 THEN salary_avg END), 0.0)
                 / greatest(count(CASE WHEN salary_avg > 0 THEN salary_avg END), 1), 0) AS avg_salary
    FROM tags GROUP BY tag ORDER BY count DESC, skill LIMIT 20""".replace("SELECT", "SELECT", 1)))
def q_skill_top20(spark, sf_dir):
    from hirelens.operators.stats import skill_top
    return skill_top(cleaned(spark, sf_dir), 20)


@register("industry_top15", with_clean("""
    SELECT industry, count(salary_avg) AS count, round_even(avg(salary_avg), 0) AS avg_salary
    FROM clean GROUP BY industry ORDER BY avg_salary DESC, industry LIMIT 15"""))
def q_industry_top15(spark, sf_dir):
    from hirelens.operators.stats import industry_top
    return industry_top(cleaned(spark, sf_dir), 15)


@register("weekly_trend", with_clean("""
    SELECT strftime(CAST(date_trunc('week', publish_date) AS DATE), '%Y-%m-%d') || '/' ||
           strftime(CAST(date_trunc('week', publish_date) AS DATE) + 6, '%Y-%m-%d') AS week,
           CAST(date_trunc('week', publish_date) AS DATE) AS week_start, count(*) AS count
    FROM clean WHERE publish_date IS NOT NULL GROUP BY 2, 1"""))
def q_weekly_trend(spark, sf_dir):
    from hirelens.operators.stats import weekly_trend
    return weekly_trend(cleaned(spark, sf_dir))


@register("sql_counts", with_clean("""
    SELECT 'city' AS dim, city AS label, count(*) AS count, round_even(avg(salary_avg), 2) AS avg_salary
      FROM clean WHERE city IS NOT NULL AND city <> '未知' GROUP BY city
    UNION ALL
    SELECT 'education', education, count(*), round_even(avg(salary_avg), 2)
      FROM clean WHERE education IS NOT NULL GROUP BY education
    UNION ALL
    SELECT 'keyword', keyword, count(*), round_even(avg(salary_avg), 2) FROM clean GROUP BY keyword"""))
def q_sql_counts(spark, sf_dir):
    from hirelens.operators.stats import sql_counts
    return sql_counts(spark, cleaned(spark, sf_dir))


BLOCK_SQL = "(" + ", ".join("'" + w + "'" for w in __import__("hirelens.dims", fromlist=["x"]).SKILL_BLOCKLIST) + ")"


@register("kpi", with_clean(f""", {TAGS_SQL},
    pc AS (SELECT city, avg(salary_avg) AS m FROM clean GROUP BY city HAVING avg(salary_avg) IS NOT NULL),
    best AS (SELECT city, m FROM pc ORDER BY m DESC, city LIMIT 1),
    ts AS (SELECT tag, count(*) AS c FROM tags WHERE tag NOT IN {BLOCK_SQL} GROUP BY tag ORDER BY c DESC, tag LIMIT 1)
    SELECT (SELECT count(*) FROM clean) AS total_jobs,
           CAST(round_even((SELECT avg(salary_avg) FROM clean), 0) AS BIGINT) AS avg_salary,
           (SELECT city FROM best) AS top_city,
           CAST(round_even((SELECT m FROM best), 0) AS BIGINT) AS top_city_salary,
           coalesce((SELECT tag FROM ts), '--') AS top_skill"""))
def q_kpi(spark, sf_dir):
    from hirelens.operators.dashboard import kpi
    return kpi(cleaned(spark, sf_dir))


DASH_BIN_SQL = """CASE WHEN exp_min >= 0 AND exp_min < 1 THEN '0-1年' WHEN exp_min >= 1 AND exp_min < 3 THEN '1-3年'
  WHEN exp_min >= 3 AND exp_min < 5 THEN '3-5年' WHEN exp_min >= 5 AND exp_min < 7 THEN '5-7年'
  WHEN exp_min >= 7 AND exp_min < 10 THEN '7-10年' WHEN exp_min >= 10 AND exp_min < 100 THEN '10年+' END"""
DASH_BIN_ORDER = """CASE WHEN exp_min >= 0 AND exp_min < 1 THEN 0 WHEN exp_min >= 1 AND exp_min < 3 THEN 1
  WHEN exp_min >= 3 AND exp_min < 5 THEN 2 WHEN exp_min >= 5 AND exp_min < 7 THEN 3
  WHEN exp_min >= 7 AND exp_min < 10 THEN 4 WHEN exp_min >= 10 AND exp_min < 100 THEN 5 END"""


def _dash(spark, sf_dir, **filters):
    from hirelens.operators.dashboard import apply_filters, with_dash_columns
    return apply_filters(with_dash_columns(cleaned(spark, sf_dir)), **filters)


@register("dash_city_bar", with_clean("""
    SELECT city, round_even(avg(salary_avg), 0) AS avg_salary, count(salary_avg) AS count
    FROM clean GROUP BY city ORDER BY avg_salary DESC, city LIMIT 12"""))
def q_dash_city_bar(spark, sf_dir):
    from hirelens.operators.dashboard import chart_bar_city
    return chart_bar_city(_dash(spark, sf_dir))


@register("dash_edu_pie", with_clean("""
    SELECT education, count(*) AS value, CAST(coalesce(round_even(avg(salary_avg), 0), 0) AS BIGINT) AS avg_salary
    FROM clean WHERE keyword = 'AI算法' AND education IS NOT NULL GROUP BY education"""))
def q_dash_edu_pie(spark, sf_dir):
    from hirelens.operators.dashboard import chart_pie_edu
    return chart_pie_edu(_dash(spark, sf_dir, keyword="AI算法"))


@register("dash_map", with_clean("""
    SELECT city, CASE city WHEN '广州' THEN '广州市' WHEN '深圳' THEN '深圳市' WHEN '珠海' THEN '珠海市' ELSE city END AS name,
      count(*) AS value
    FROM clean WHERE education = '本科' GROUP BY city"""))
def q_dash_map(spark, sf_dir):
    from hirelens.operators.dashboard import chart_map
    return chart_map(_dash(spark, sf_dir, education="本科"))


@register("dash_cloud", with_clean(f""", {TAGS_SQL}
    SELECT tag AS name, count(*) AS value FROM tags
    WHERE exp_min >= 1 AND exp_min < 5 AND tag NOT IN {BLOCK_SQL}
    GROUP BY tag ORDER BY value DESC, name LIMIT 50"""))
def q_dash_cloud(spark, sf_dir):
    from hirelens.operators.dashboard import chart_wordcloud
    return chart_wordcloud(_dash(spark, sf_dir, exp_range="1-5"))


@register("dash_line", with_clean(f""",
    b AS (SELECT *, {DASH_BIN_SQL} AS exp_bin, {DASH_BIN_ORDER} AS exp_bin_order FROM clean),
    overall AS (SELECT exp_bin, exp_bin_order, round_even(avg(salary_avg), 0) AS avg_salary, count(salary_avg) AS count
                FROM b WHERE exp_bin IS NOT NULL GROUP BY 1, 2 HAVING avg(salary_avg) IS NOT NULL),
    kw AS (SELECT keyword, exp_bin, round_even(avg(salary_avg), 0) AS avg_salary, count(salary_avg) AS count
           FROM b WHERE exp_bin IS NOT NULL AND keyword IS NOT NULL GROUP BY 1, 2 HAVING avg(salary_avg) IS NOT NULL),
    kws AS (SELECT DISTINCT keyword FROM b WHERE exp_bin IS NOT NULL AND keyword IS NOT NULL)
    SELECT '全部' AS series, exp_bin, exp_bin_order, avg_salary, count FROM overall
    UNION ALL
    SELECT k.keyword, o.exp_bin, o.exp_bin_order, kw.avg_salary, coalesce(kw.count, 0)
    FROM kws k CROSS JOIN overall o LEFT JOIN kw ON kw.keyword = k.keyword AND kw.exp_bin = o.exp_bin"""))
def q_dash_line(spark, sf_dir):
    from hirelens.operators.dashboard import chart_line_exp
    return chart_line_exp(cleaned(spark, sf_dir))


@register("dash_industry", with_clean("""
    SELECT industry, round_even(avg(salary_avg), 0) AS avg_salary, count(salary_avg) AS count
    FROM clean WHERE city = '北京' GROUP BY industry ORDER BY avg_salary DESC, industry LIMIT 10"""))
def q_dash_industry(spark, sf_dir):
    from hirelens.operators.dashboard import chart_industry
    return chart_industry(_dash(spark, sf_dir, city="北京"))


@register("dash_scatter", with_clean("""
    , f AS (SELECT * FROM clean WHERE keyword = 'Python开发'),
    top AS (SELECT city, count(*) AS n FROM f GROUP BY city ORDER BY n DESC, city LIMIT 10),
    ranked AS (SELECT city, row_number() OVER (ORDER BY n DESC, city) - 1 AS city_idx FROM top)
    SELECT f.city, r.city_idx, CAST(r.city_idx AS DOUBLE) AS x, round_even(f.salary_avg, 0) AS y, f.seq
    FROM f JOIN ranked r ON f.city = r.city WHERE f.salary_avg IS NOT NULL"""))
def q_dash_scatter(spark, sf_dir):
    from hirelens.operators.dashboard import chart_scatter
    return chart_scatter(_dash(spark, sf_dir, keyword="Python开发"))


@register("filter_options", with_clean("""
    SELECT DISTINCT 'cities' AS kind, city AS value FROM clean WHERE city IS NOT NULL
    UNION ALL SELECT DISTINCT 'educations', education FROM clean WHERE education IS NOT NULL
    UNION ALL SELECT DISTINCT 'keywords', keyword FROM clean WHERE keyword IS NOT NULL
    UNION ALL SELECT 'exp_ranges', x FROM (VALUES ('0-1年'), ('1-3年'), ('3-5年'), ('5-7年'), ('7-10年')) v(x)"""))
def q_filter_options(spark, sf_dir):
    from hirelens.operators.stats import filter_options
    return filter_options(cleaned(spark, sf_dir))


@register("dash_count", with_clean("""
    SELECT count(*) AS count FROM clean WHERE keyword = '数据分析' AND exp_min >= 0 AND exp_min < 3"""))
def q_dash_count(spark, sf_dir):
    return _dash(spark, sf_dir, keyword="数据分析", exp_range="0-3").agg(F.count(F.lit(1)).alias("count"))
