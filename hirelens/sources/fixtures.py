"""Messy job postings derived from the driver tables.

``RAW_POSTINGS_SQL`` is one SQL text that runs unchanged on Spark SQL and on
DuckDB over the ``orders`` and ``customer`` views, so the Spark pipeline and
the DuckDB oracle start from identical rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_POSTINGS_SQL = """
SELECT o.o_orderkey AS seq,
  CASE o.o_orderkey % 4 WHEN 0 THEN '数据分析' WHEN 1 THEN 'Python开发' WHEN 2 THEN 'AI算法' ELSE '大数据开发' END AS keyword,
  CASE WHEN o.o_orderkey % 97 = 0 THEN '' ELSE
    CASE o.o_orderkey % 4 WHEN 0 THEN '数据分析' WHEN 1 THEN 'Python开发' WHEN 2 THEN 'AI算法' ELSE '大数据开发' END
    || CASE o.o_custkey % 3 WHEN 0 THEN '工程师' WHEN 1 THEN '专家' ELSE '经理' END END AS job_title,
  CASE WHEN c.c_nationkey % 9 = 4 AND o.o_orderkey % 10 < 4 THEN '面议' ELSE CASE o.o_orderkey % 10
    WHEN 0 THEN '面议'
    WHEN 1 THEN CAST(10 + o.o_custkey % 20 AS STRING) || '-' || CAST(31 + o.o_orderkey % 10 AS STRING) || 'K·14薪'
    WHEN 2 THEN '8千-1.' || CAST(1 + o.o_custkey % 9 AS STRING) || '万'
    WHEN 3 THEN CAST(200 + o.o_custkey % 300 AS STRING) || '元/天'
    WHEN 4 THEN CAST(12 + o.o_custkey % 12 AS STRING) || '-' || CAST(25 + o.o_orderkey % 30 AS STRING) || '万/年'
    WHEN 5 THEN '1.' || CAST(o.o_custkey % 9 AS STRING) || '-2万·13薪'
    WHEN 6 THEN CAST(3 + o.o_custkey % 6 AS STRING) || '千及以下'
    WHEN 7 THEN CAST(40 + o.o_custkey % 60 AS STRING) || '元/小时'
    WHEN 8 THEN CAST(5000 + o.o_custkey % 3000 AS STRING) || '-' || CAST(9000 + o.o_orderkey % 3000 AS STRING) || '元/月'
    ELSE CAST(10 + o.o_custkey % 5 AS STRING) || '-' || CAST(16 + o.o_orderkey % 9 AS STRING) || '万·13薪' END END AS salary_text,
  CASE c.c_nationkey % 9 WHEN 0 THEN '北京朝阳区' WHEN 1 THEN '上海市' WHEN 2 THEN '深圳-南山区' WHEN 3 THEN '广州·天河区'
    WHEN 4 THEN '珠海' WHEN 5 THEN ' 杭州市西湖区 ' WHEN 6 THEN '成都' WHEN 7 THEN '苏州市' ELSE NULL END AS city,
  CASE o.o_custkey % 8 WHEN 0 THEN '学历不限' WHEN 1 THEN '大专及以上' WHEN 2 THEN '本科' WHEN 3 THEN '硕士及以上' WHEN 4 THEN '博士' WHEN 5 THEN '中专' WHEN 6 THEN 'MBA ' ELSE NULL END AS education,
  CASE o.o_orderkey % 7 WHEN 0 THEN '经验不限' WHEN 1 THEN '1-3年' WHEN 2 THEN '3-5年经验' WHEN 3 THEN '5年及以上' WHEN 4 THEN '1年以下' WHEN 5 THEN '在校/应届' ELSE NULL END AS experience,
  '  ' || c.c_name || ' ' AS company_name,
  CASE o.o_custkey % 8 WHEN 0 THEN '少于50人' WHEN 1 THEN '50-150人' WHEN 2 THEN '150-500人' WHEN 3 THEN '500-1000人' WHEN 4 THEN '1000-5000人' WHEN 5 THEN '5000-10000人' WHEN 6 THEN '10000人以上' ELSE NULL END AS company_size,
  c.c_mktsegment AS industry,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE 'K8s, Python' || CASE WHEN o.o_custkey % 2 = 0 THEN ', sql, 五险一金' ELSE ',Golang , Python3' END || CASE WHEN o.o_orderkey % 3 = 0 THEN ', Spark, spark' ELSE '' END END AS skill_tags,
  CASE WHEN o.o_orderkey % 23 = 0 THEN 'bad-date' WHEN o.o_orderkey % 5 = 0 THEN replace(CAST(CAST(o.o_orderdate AS DATE) AS STRING), '-', '/') ELSE CAST(CAST(o.o_orderdate AS DATE) AS STRING) || ' 08:00:00' END AS publish_date,
  'https://jobs.example.org/all/' || CAST(o.o_orderkey - o.o_orderkey % 13 % 2 AS STRING) || '.html' AS job_url
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

RAW_COLUMNS = [
    "seq", "keyword", "job_title", "salary_text", "city", "education",
    "experience", "company_name", "company_size", "industry", "skill_tags",
    "publish_date", "job_url",
]


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan orders + customer and derive the raw posting rows. The tables are
    bound to this one statement; no view of the caller is touched."""
    base = sf_dir.rstrip("/")
    sql = RAW_POSTINGS_SQL.replace("FROM orders o JOIN customer c", "FROM {orders} o JOIN {customer} c")
    return spark.sql(sql, orders=spark.read.parquet(f"{base}/orders.parquet"),
                     customer=spark.read.parquet(f"{base}/customer.parquet"))
