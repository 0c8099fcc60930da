"""Remaining inventory items: recursive payload search, table DDL and
truncate, result cache, value-count report, area split, count text,
range-join bins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hirelens import dims
from hirelens.plans.catalog import cleaned, raw, register
from hirelens.plans.oracle_base import with_clean
from hirelens.session import table, unique_dir
from hirelens.sources.fixtures import RAW_POSTINGS_SQL


@register("payload_search", """
    SELECT CAST(o_orderkey AS STRING) AS job_id, o_orderkey // 50 AS page,
           row_number() OVER (PARTITION BY o_orderkey // 50 ORDER BY o_orderkey) - 1 AS pos
    FROM orders""")
def q_payload_search(spark, sf_dir):
    """SRC-5: job lists at varying depths (up to 4 keys down) found by the
    bounded depth-first search, then exploded in the JVM."""
    from hirelens.plans.q_ingest import search_payload_pages
    from hirelens.sources.payload import find_job_list
    pages = search_payload_pages(spark, sf_dir)
    lst = F.get_json_object("payload", "$.engine_search_result")
    lst = F.coalesce(F.when(F.col("page") % 4 == 0, lst), F.get_json_object("payload", "$.resultbody.job.items"),
                     F.get_json_object("payload", "$.resultbody.items"), F.get_json_object("payload", "$.data"))
    # re-nest every page at a depth that depends on the page
    deep = (F.when(F.col("page") % 3 == 0, F.concat(F.lit('{"data":{"result":{"jobList":'), lst, F.lit("}}}")))
             .when(F.col("page") % 3 == 1, F.concat(F.lit('{"resultbody":{"items":'), lst, F.lit("}}")))
             .otherwise(F.concat(F.lit('{"meta":{"list":[1,2]},"result":{"data":{"list":{"items":'), lst,
                                 F.lit("}}}}"))))
    found = find_job_list(pages.select("page", deep.alias("payload")))
    items = found.select("page", F.posexplode(F.from_json("list_json", "array<string>")).alias("pos", "item"))
    return items.select(F.get_json_object("item", "$.jobId").alias("job_id"), "page",
                        F.col("pos").cast("long").alias("pos"))


@register("table_store", with_clean("""
    SELECT keyword, count(*) AS n, round_even(sum(salary_avg), 2) AS salary_sum FROM clean GROUP BY keyword"""))
def q_table_store(spark, sf_dir):
    """SNK-6 / SNK-7: a partitioned Parquet table by DDL, filled, emptied
    (INSERT OVERWRITE with no rows: the truncate of an external table) and
    filled again; then dropped from the catalog and read back by its folder."""
    c = cleaned(spark, sf_dir)
    loc = unique_dir(spark, "job-listing")
    name = f"job_listing_{uuid.uuid4().hex[:8]}"
    spark.sql(f"""CREATE TABLE {name} (seq BIGINT, job_title STRING, salary_avg DOUBLE, city STRING,
                  keyword STRING) USING parquet PARTITIONED BY (keyword) LOCATION '{loc}'""")
    rows = c.select("seq", "job_title", "salary_avg", "city", "keyword")
    rows.write.insertInto(name)
    spark.createDataFrame([], rows.schema).write.insertInto(name, overwrite=True)
    rows.write.insertInto(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    stored = spark.read.parquet(loc)
    return stored.groupBy("keyword").agg(F.count(F.lit(1)).alias("n"), F.bround(F.sum("salary_avg"), 2).alias("salary_sum"))


@register("result_cache", with_clean("""
    SELECT 'city_salary' AS result_name, 2 AS version, city AS item, count(salary_avg) AS n FROM clean GROUP BY city
    UNION ALL SELECT 'experience_bins', 1, CASE WHEN exp_min < 1 THEN '0-1年' WHEN exp_min < 3 THEN '1-3年' WHEN exp_min < 5 THEN '3-5年'
        WHEN exp_min < 7 THEN '5-7年' WHEN exp_min < 10 THEN '7-10年' ELSE '10年+' END, count(*) FROM clean
        WHERE exp_min >= 0 AND exp_min < 100 GROUP BY 3"""))
def q_result_cache(spark, sf_dir):
    """SNK-8 / SNK-9: named analysis results as keyed rows of JSON text; a
    re-run of one analysis replaces its rows only. A row per result row, so
    no result is gathered into one cell."""
    from hirelens.functions.text import bin_label
    from hirelens.sinks.store import replace_partitions
    c = cleaned(spark, sf_dir)

    def entry(name, df, version):
        row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        return df.select(F.lit(name).alias("result_name"), F.lit(version).alias("version"), row.alias("json"))

    city = c.groupBy(F.col("city").alias("item")).agg(F.count("salary_avg").alias("n"))
    bins = c.withColumn("item", bin_label("exp_min", dims.DASH_EXP_BINS)).where("item IS NOT NULL").groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    path = unique_dir(spark, "result-cache")
    replace_partitions(entry("city_salary", city, 1).unionByName(entry("experience_bins", bins, 1)), path, "result_name")
    replace_partitions(entry("city_salary", city, 2), path, "result_name")  # the other result's files are not touched
    cache = spark.read.parquet(path).withColumn("r", F.from_json("json", "item STRING, n BIGINT"))
    return cache.select("result_name", "version", F.col("r.item").alias("item"), F.col("r.n").alias("n"))


@register("value_counts_report", with_clean("""
    SELECT 'city_tier' AS dim, city_tier AS value, count(*) AS count FROM clean GROUP BY city_tier
    UNION ALL SELECT 'education', education, count(*) FROM clean GROUP BY education
    UNION ALL SELECT 'keyword', keyword, count(*) FROM clean GROUP BY keyword
    UNION ALL SELECT * FROM (SELECT 'city', city, count(*) AS c FROM clean GROUP BY city ORDER BY c DESC, city LIMIT 10)"""))
def q_value_counts_report(spark, sf_dir):
    """AGG-16: value counts of tier, education, keyword, and the Top-10 cities."""
    from hirelens.operators.stats import value_counts
    c = cleaned(spark, sf_dir)
    parts = [value_counts(c, col, n).select(F.lit(dim).alias("dim"), F.col(col).alias("value"), "count")
             for dim, col, n in (("city_tier", "city_tier", None), ("education", "education", None),
                                 ("keyword", "keyword", None), ("city", "city", 10))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("area_split", f"""
    WITH r AS ({RAW_POSTINGS_SQL})
    SELECT seq, trim(string_split(replace(coalesce(city, ''), '·', '-'), '-')[1]) AS area_city,
           coalesce(trim(string_split(replace(coalesce(city, ''), '·', '-'), '-')[2]), '') AS area_district
    FROM r""")
def q_area_split(spark, sf_dir):
    """STR-6 on the raw area text."""
    from hirelens.functions.text import split_area
    s = split_area("city")
    return raw(spark, sf_dir).select("seq", s["city"].alias("area_city"), s["district"].alias("area_district"))


COUNT_TEXT_SQL = """CASE WHEN value >= 50 THEN CAST(round_even(value / 10, 1) AS STRING) || '万'
                         ELSE CAST(CAST(round_even(value * 100, 0) AS BIGINT) AS STRING) END"""


@register("count_text", f"""
    SELECT event_id, {COUNT_TEXT_SQL} AS play_text,
      CASE WHEN value >= 50 THEN round_even(round_even(value / 10, 1) * 10000, 0)
           ELSE CAST(round_even(value * 100, 0) AS DOUBLE) END AS plays
    FROM events""")
def q_count_text(spark, sf_dir):
    """STR-15: play counts shown as text (``12.3万`` or a plain number) back to numbers."""
    from hirelens.functions.text import count_text_value
    e = table(spark, sf_dir, "events")
    v = F.col("value")
    txt = F.when(v >= 50, F.concat(F.bround(v / 10, 1).cast("string"), F.lit("万"))).otherwise(
        F.bround(v * 100, 0).cast("long").cast("string"))
    return e.select("event_id", txt.alias("play_text")).withColumn("plays", count_text_value("play_text"))


@register("bin_range_join", with_clean("""
    SELECT exp_bin, bin_order, count(salary_avg) AS count, round_even(avg(salary_avg), 0) AS avg_salary FROM (
      SELECT *, CASE WHEN exp_min >= 0 AND exp_min < 1 THEN '0-1年' WHEN exp_min >= 1 AND exp_min < 3 THEN '1-3年'
        WHEN exp_min >= 3 AND exp_min < 5 THEN '3-5年' WHEN exp_min >= 5 AND exp_min < 7 THEN '5-7年'
        WHEN exp_min >= 7 AND exp_min < 10 THEN '7-10年' WHEN exp_min >= 10 AND exp_min < 100 THEN '10年+' END AS exp_bin,
      CASE WHEN exp_min >= 0 AND exp_min < 1 THEN 0 WHEN exp_min >= 1 AND exp_min < 3 THEN 1
        WHEN exp_min >= 3 AND exp_min < 5 THEN 2 WHEN exp_min >= 5 AND exp_min < 7 THEN 3
        WHEN exp_min >= 7 AND exp_min < 10 THEN 4 WHEN exp_min >= 10 AND exp_min < 100 THEN 5 END AS bin_order
      FROM clean) WHERE exp_bin IS NOT NULL GROUP BY exp_bin, bin_order"""))
def q_bin_range_join(spark, sf_dir):
    """JON-8: the dashboard's experience bins as a range join to a bins table."""
    from hirelens.operators.bins import assign_bins, bins_table
    c = cleaned(spark, sf_dir)
    j = assign_bins(c, "exp_min", bins_table(spark, dims.DASH_EXP_BINS), "exp_bin")
    s = F.col("salary_avg")
    return (j.where(F.col("exp_bin").isNotNull()).groupBy("exp_bin", "bin_order")
             .agg(F.count(s).alias("count"), F.bround(F.avg(s), 0).alias("avg_salary")))
