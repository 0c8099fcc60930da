"""DuckDB oracle building blocks for the posting queries.

The oracle does not parse text: it re-derives every expected field in
closed form from the integers that generated the raw posting
(``o_orderkey``, ``o_custkey``, ``c_nationkey``), branch by branch of the
fixture SQL. Agreement therefore checks the Spark text parsers, not a
second copy of them.
"""

from __future__ import annotations

# --- closed-form parsed postings (one row per raw posting) -------------------
PARSED_CTE = """
gen AS (
  SELECT o.o_orderkey AS seq, o.o_custkey AS ck, c.c_nationkey AS nk,
         CAST(o.o_orderdate AS DATE) AS odate, c.c_name AS cname, c.c_mktsegment AS industry,
         (c.c_nationkey % 9 = 4 AND o.o_orderkey % 10 < 4) OR o.o_orderkey % 10 = 0 AS neg
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
sal0 AS (
  SELECT *, CASE WHEN neg THEN NULL ELSE CASE seq % 10
      WHEN 1 THEN (10 + ck % 20) * 1000.0
      WHEN 2 THEN 8000.0
      WHEN 3 THEN round_even((200 + ck % 300) * 21.75, 0)
      WHEN 4 THEN round_even((12 + ck % 12) * 10000.0 / 12, 0)
      WHEN 5 THEN 10000.0 + (ck % 9) * 1000.0
      WHEN 6 THEN (3 + ck % 6) * 1000.0
      WHEN 7 THEN (40 + ck % 60) * 174.0
      WHEN 8 THEN 5000.0 + ck % 3000
      ELSE round_even((10 + ck % 5) * 10000.0 / 13, 0) END END AS smin,
    CASE WHEN neg THEN NULL ELSE CASE seq % 10
      WHEN 1 THEN (31 + seq % 10) * 1000.0
      WHEN 2 THEN 11000.0 + (ck % 9) * 1000.0
      WHEN 3 THEN round_even((200 + ck % 300) * 21.75, 0)
      WHEN 4 THEN round_even((25 + seq % 30) * 10000.0 / 12, 0)
      WHEN 5 THEN 20000.0
      WHEN 6 THEN (3 + ck % 6) * 1000.0
      WHEN 7 THEN (40 + ck % 60) * 174.0
      WHEN 8 THEN 9000.0 + seq % 3000
      ELSE round_even((16 + seq % 9) * 10000.0 / 13, 0) END END AS smax
  FROM gen
),
parsed AS (
  SELECT seq, ck, nk, neg, industry AS industry_raw,
    CAST(smin AS DOUBLE) AS salary_min, CAST(smax AS DOUBLE) AS salary_max,
    CAST(round_even((smin + smax) / 2, 0) AS DOUBLE) AS salary_avg,
    CASE seq % 4 WHEN 0 THEN '数据分析' WHEN 1 THEN 'Python开发' WHEN 2 THEN 'AI算法' ELSE '大数据开发' END AS keyword,
    CASE WHEN seq % 97 = 0 THEN '' ELSE
      CASE seq % 4 WHEN 0 THEN '数据分析' WHEN 1 THEN 'Python开发' WHEN 2 THEN 'AI算法' ELSE '大数据开发' END
      || CASE ck % 3 WHEN 0 THEN '工程师' WHEN 1 THEN '专家' ELSE '经理' END END AS job_title,
    CASE nk % 9 WHEN 0 THEN '北京' WHEN 1 THEN '上海' WHEN 2 THEN '深圳' WHEN 3 THEN '广州'
      WHEN 4 THEN '珠海' WHEN 5 THEN '杭州' WHEN 6 THEN '成都' WHEN 7 THEN '苏州' ELSE NULL END AS city,
    CASE nk % 9 WHEN 0 THEN '朝阳区' WHEN 2 THEN '南山区' WHEN 3 THEN '天河区' WHEN 5 THEN '西湖区' ELSE NULL END AS district,
    CASE WHEN nk % 9 IN (0, 1, 2, 3) THEN '一线' WHEN nk % 9 IN (5, 6) THEN '新一线' ELSE '其他' END AS city_tier,
    CASE ck % 8 WHEN 0 THEN '不限' WHEN 1 THEN '大专' WHEN 2 THEN '本科' WHEN 3 THEN '硕士'
      WHEN 4 THEN '博士' WHEN 5 THEN '大专' WHEN 6 THEN 'MBA' ELSE '不限' END AS education,
    CAST(CASE seq % 7 WHEN 1 THEN 1 WHEN 2 THEN 3 WHEN 3 THEN 5 WHEN 4 THEN 1 ELSE 0 END AS DOUBLE) AS exp_min,
    CAST(CASE seq % 7 WHEN 1 THEN 3 WHEN 2 THEN 5 WHEN 3 THEN 5 WHEN 4 THEN 1 ELSE 0 END AS DOUBLE) AS exp_max,
    CASE seq % 7 WHEN 0 THEN '经验不限' WHEN 1 THEN '1-3年' WHEN 2 THEN '3-5年经验' WHEN 3 THEN '5年及以上'
      WHEN 4 THEN '1年以下' WHEN 5 THEN '在校/应届' ELSE NULL END AS experience,
    trim(cname) AS company_name,
    CASE ck % 8 WHEN 0 THEN '少于50人' WHEN 1 THEN '50-150人' WHEN 2 THEN '150-500人' WHEN 3 THEN '500-1000人'
      WHEN 4 THEN '1000-5000人' WHEN 5 THEN '5000-10000人' WHEN 6 THEN '10000人以上' ELSE NULL END AS company_size,
    industry,
    CASE WHEN seq % 11 = 0 THEN
        CASE seq % 4 WHEN 0 THEN 'Excel, Pandas, Python, SQL, 数据分析' WHEN 1 THEN 'Python'
          WHEN 2 THEN 'Machine Learning, Python, TensorFlow' ELSE 'Hadoop, Hive, SQL, Spark' END
      WHEN ck % 2 = 0 THEN CASE WHEN seq % 3 = 0 THEN 'Kubernetes, Python, Spark, spark, sql, 五险一金'
                                ELSE 'Kubernetes, Python, sql, 五险一金' END
      ELSE CASE WHEN seq % 3 = 0 THEN 'Go, Kubernetes, Python, Spark, spark' ELSE 'Go, Kubernetes, Python' END
    END AS skill_tags,
    CASE WHEN seq % 23 = 0 THEN NULL ELSE odate END AS publish_date,
    'https://jobs.example.org/all/' || CAST(seq - seq % 13 % 2 AS VARCHAR) || '.html' AS job_url,
    CASE WHEN neg THEN '面议' ELSE 'x' END AS salary_text_mark
  FROM sal0
)"""

# --- cleaning stages over ``parsed`` ----------------------------------------
CLEAN_CTE = PARSED_CTE + """,
dedup AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY company_name, job_title, coalesce(salary_avg, -1.0) ORDER BY seq) AS rn
    FROM parsed) WHERE rn = 1
),
city_stats AS (
  SELECT city, avg(CASE WHEN neg THEN 1.0 ELSE 0.0 END) AS neg_ratio,
         quantile_cont(salary_min, 0.5) AS med_min, quantile_cont(salary_max, 0.5) AS med_max,
         quantile_cont(salary_avg, 0.5) AS med_avg
  FROM dedup WHERE city IS NOT NULL GROUP BY city
),
staged AS (
  SELECT d.*, coalesce(s.neg_ratio > 0.3, false) AND d.neg AS bump,
    coalesce(d.salary_min, s.med_min) * CASE WHEN coalesce(s.neg_ratio > 0.3, false) AND d.neg THEN 1.1 ELSE 1 END AS s_min,
    coalesce(d.salary_max, s.med_max) * CASE WHEN coalesce(s.neg_ratio > 0.3, false) AND d.neg THEN 1.1 ELSE 1 END AS s_max,
    coalesce(d.salary_avg, s.med_avg) * CASE WHEN coalesce(s.neg_ratio > 0.3, false) AND d.neg THEN 1.1 ELSE 1 END AS s_avg
  FROM dedup d LEFT JOIN city_stats s ON d.city = s.city
),
gmed AS (
  SELECT quantile_cont(s_min, 0.5) AS g_min, quantile_cont(s_max, 0.5) AS g_max, quantile_cont(s_avg, 0.5) AS g_avg
  FROM staged
),
filled AS (
  SELECT st.*, CAST(coalesce(s_min, g_min) AS DOUBLE) AS f_min, CAST(coalesce(s_max, g_max) AS DOUBLE) AS f_max,
         CAST(coalesce(s_avg, g_avg) AS DOUBLE) AS f_avg
  FROM staged st, gmed
),
clean AS (
  SELECT seq, keyword, job_title, f_min AS salary_min, f_max AS salary_max, f_avg AS salary_avg,
         coalesce(city, '未知') AS city, district, city_tier, education, experience, exp_min, exp_max,
         company_name, company_size, industry, skill_tags, publish_date, job_url, neg
  FROM filled
  WHERE (f_avg IS NULL OR (f_avg >= 0 AND f_avg <= 1000000)) AND job_title IS NOT NULL AND job_title <> ''
)"""


def with_clean(select_sql: str) -> str:
    return "WITH " + CLEAN_CTE + "\n" + select_sql


def with_parsed(select_sql: str) -> str:
    return "WITH " + PARSED_CTE + "\n" + select_sql
