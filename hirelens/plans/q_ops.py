"""Validation, cleaning-step, join and storage queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens import dims
from hirelens.plans.catalog import cleaned, raw, register, standardized
from hirelens.plans.oracle_base import with_clean, with_parsed
from hirelens.sources.fixtures import RAW_COLUMNS, RAW_POSTINGS_SQL


# ------------------------------------------------------------------ validation
VALIDATE_ORACLE = """
    SELECT seq, CAST(len(issues) AS INTEGER) AS n_issues,
      array_to_string(list_transform(issues, lambda x: x[1]), ',') AS issue_codes,
      array_to_string(list_transform(issues, lambda x: x[2]), '; ') AS issue_details
    FROM (SELECT seq, list_filter([
        CASE WHEN seq % 97 = 0 THEN ['title_empty', 'no title'] END,
        CASE WHEN smin > smax THEN ['salary_min_gt_max', 'minimum ' || CAST(smin AS VARCHAR) || ' above maximum ' || CAST(smax AS VARCHAR)] END,
        CASE WHEN smin <= 0 AND smax IS NOT NULL THEN ['salary_min_nonpositive', 'minimum not positive: ' || CAST(smin AS VARCHAR)] END,
        CASE WHEN smax > 1000000 AND smin IS NOT NULL THEN ['salary_too_high', 'maximum too high: ' || CAST(smax AS VARCHAR)] END,
        CASE WHEN city = '珠海' THEN ['city_unknown', 'city not known: 珠海'] END,
        CASE WHEN seq % 23 = 0 THEN ['date_format', 'not a date: bad-date'] END,
        CASE WHEN year(publish_date) < 2000 OR year(publish_date) > 2030
             THEN ['date_year', 'year out of range: ' || strftime(publish_date, '%Y-%m-%d')] END,
        CASE WHEN ck % 8 = 6 THEN ['education_domain', 'education not known: MBA'] END,
        CASE WHEN seq % 43 = 4 THEN ['url_empty', 'no url'] END], lambda x: x IS NOT NULL) AS issues
      FROM (SELECT *, CASE WHEN seq % 31 = 1 THEN salary_max + 1 WHEN seq % 37 = 2 THEN 0.0 ELSE salary_min END AS smin,
              CASE WHEN seq % 41 = 3 THEN 12000000.0 ELSE salary_max END AS smax FROM parsed))"""


def _flawed(spark, sf_dir):
    """The parsed postings with the flaws that the raw texts never have; the
    numbers arrive as text, as from a file."""
    from hirelens.operators.quality import parsed_postings
    p = parsed_postings(raw(spark, sf_dir))
    low = F.when(F.col("seq") % 31 == 1, F.col("salary_max") + 1).when(F.col("seq") % 37 == 2, F.lit(0.0)).otherwise(F.col("salary_min"))
    high = F.when(F.col("seq") % 41 == 3, F.lit(12000000.0)).otherwise(F.col("salary_max"))
    return p.withColumns({"salary_min": low.cast("string"), "salary_max": high.cast("string"),
                          "job_url": F.when(F.col("seq") % 43 == 4, F.lit("")).otherwise(F.col("job_url"))})


@register("validate_rows", with_parsed(VALIDATE_ORACLE))
def q_validate_rows(spark, sf_dir):
    from hirelens.operators.quality import validate
    v = validate(_flawed(spark, sf_dir))
    return v.select("seq", F.col("n_issues").cast("int").alias("n_issues"), "issue_codes", "issue_details")


@register("validate_summary", with_parsed(f""", v AS ({VALIDATE_ORACLE})
    SELECT code, count(*) AS n FROM (SELECT unnest(string_split(issue_codes, ',')) AS code FROM v
                                      WHERE issue_codes <> '') GROUP BY code
    UNION ALL SELECT '_total', count(*) FROM v
    UNION ALL SELECT '_clean', count(*) FILTER (WHERE n_issues = 0) FROM v
    UNION ALL SELECT '_issues', count(*) FILTER (WHERE n_issues > 0) FROM v"""))
def q_validate_summary(spark, sf_dir):
    from hirelens.operators.quality import validate, validation_summary
    return validation_summary(validate(_flawed(spark, sf_dir)))


# --------------------------------------------------- swap, reparse, outliers
SWAP_BASE_SQL = """
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 7 THEN NULL
         ELSE l_extendedprice * CASE WHEN l_tax > 0.07 THEN 20 ELSE 1 END END AS salary_min,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity * 1000 END AS salary_max,
    CASE WHEN l_linenumber = 7 THEN
      CAST(CAST(l_quantity AS INT) AS STRING) || '-' || CAST(CAST(l_quantity AS INT) + 5 AS STRING) || 'K'
      ELSE 'given' END AS salary_text,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '' ELSE 'job' END AS job_title,
    l_quantity
  FROM lineitem"""


@register("swap_and_outliers", f"""
    WITH b AS ({SWAP_BASE_SQL}),
    p AS (SELECT l_orderkey, l_linenumber, job_title,
      CASE WHEN salary_min IS NULL THEN CAST(l_quantity AS INT) * 1000.0 ELSE least(salary_min, salary_max) END AS mn,
      CASE WHEN salary_min IS NULL THEN (CAST(l_quantity AS INT) + 5) * 1000.0 ELSE greatest(salary_min, salary_max) END AS mx,
      CASE WHEN salary_min IS NULL THEN (2 * CAST(l_quantity AS INT) + 5) * 500.0
           ELSE round_even((salary_min + salary_max) / 2, 0) END AS av
      FROM b)
    SELECT l_orderkey, l_linenumber, round_even(mn, 2) AS salary_min, round_even(mx, 2) AS salary_max,
           round_even(av, 2) AS salary_avg
    FROM p WHERE (av IS NULL OR (av >= 0 AND av <= 1000000)) AND job_title IS NOT NULL AND job_title <> ''""")
def q_swap_and_outliers(spark, sf_dir):
    from hirelens.operators.clean import clean_salary, remove_outliers
    from hirelens.session import table
    sql = SWAP_BASE_SQL.replace("FROM lineitem", "FROM {lineitem}")
    base = spark.sql(sql, lineitem=table(spark, sf_dir, "lineitem")).withColumn(
        "salary_avg", F.bround((F.col("salary_min") + F.col("salary_max")) / 2, 0))
    out = remove_outliers(clean_salary(base))
    return out.select("l_orderkey", "l_linenumber", *[F.bround(c, 2).alias(c) for c in
                                                      ("salary_min", "salary_max", "salary_avg")])


@register("null_census", f"""
    WITH r AS ({RAW_POSTINGS_SQL}),
    n AS ({" UNION ALL ".join(f"SELECT '{c}' AS col_name, count(*) - count({c}) AS missing FROM r" for c in RAW_COLUMNS)})
    SELECT col_name, CAST(missing AS BIGINT) AS missing FROM n
    UNION ALL SELECT '_total', CAST(sum(missing) AS BIGINT) FROM n""")
def q_null_census(spark, sf_dir):
    from hirelens.operators.quality import null_census
    return null_census(raw(spark, sf_dir).select(*RAW_COLUMNS))


# ------------------------------------------------------------------- joins
@register("tier_province_join", with_clean("""
    SELECT seq, city, CASE WHEN city IN ('北京', '上海', '广州', '深圳') THEN '一线'
                           WHEN city IN ('杭州', '成都') THEN '新一线' ELSE '其他' END AS tier,
      CASE city WHEN '北京' THEN '北京' WHEN '上海' THEN '上海' WHEN '深圳' THEN '广东' WHEN '广州' THEN '广东'
        WHEN '珠海' THEN '广东' WHEN '杭州' THEN '浙江' WHEN '成都' THEN '四川' WHEN '苏州' THEN '江苏' ELSE city END AS province
    FROM clean"""))
def q_tier_province_join(spark, sf_dir):
    from hirelens.operators.joins import city_dimension, enrich_city
    c = cleaned(spark, sf_dir).select("seq", "city")
    return enrich_city(c, city_dimension(spark)).select("seq", "city", "tier", "province")


DETAIL_SQL = """
  SELECT l.l_orderkey AS job_id,
    array_to_string(list_sort(list_distinct(list(p.p_type))), ', ') AS skill_tags,
    CASE WHEN sum(l.l_quantity) > 100 THEN '硕士' ELSE '' END AS education,
    CASE max(l.l_linenumber) % 4 WHEN 0 THEN '少于50人' WHEN 1 THEN '500-1000人' WHEN 2 THEN '' ELSE '10000人以上' END
      AS company_size
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey"""


@register("detail_enrich", f"""
    WITH r AS ({RAW_POSTINGS_SQL}), d AS ({DETAIL_SQL})
    SELECT r.seq,
      CASE WHEN (r.skill_tags IS NULL OR r.skill_tags IN ('', 'nan', '无')) AND d.skill_tags <> '' THEN d.skill_tags
           ELSE r.skill_tags END AS skill_tags,
      CASE WHEN (r.skill_tags IS NULL OR r.skill_tags IN ('', 'nan', '无')) AND d.education <> '' THEN d.education
           ELSE r.education END AS education,
      CASE WHEN (r.skill_tags IS NULL OR r.skill_tags IN ('', 'nan', '无')) AND d.company_size <> '' THEN d.company_size
           ELSE r.company_size END AS company_size
    FROM r LEFT JOIN d ON r.seq = d.job_id""")
def q_detail_enrich(spark, sf_dir):
    from hirelens.functions.skills import is_blank_tags
    from hirelens.operators.joins import enrich_from_detail
    from hirelens.session import table
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    # one detail row per job; the tag set is bounded by the 6 part types
    detail = (li.join(part, li.l_partkey == part.p_partkey)
                .groupBy(F.col("l_orderkey").alias("seq"))
                .agg(F.array_join(F.array_sort(F.collect_set("p_type")), ", ").alias("skill_tags"),
                     F.when(F.sum("l_quantity") > 100, "硕士").otherwise("").alias("education"),
                     F.element_at(F.array(F.lit("少于50人"), F.lit("500-1000人"), F.lit(""), F.lit("10000人以上")),
                                  (F.max("l_linenumber") % 4 + 1).cast("int")).alias("company_size")))
    base = raw(spark, sf_dir).select("seq", "skill_tags", "education", "company_size")
    out = enrich_from_detail(base, detail, "seq", ["skill_tags", "education", "company_size"],
                             is_blank_tags(F.col("skill_tags")))
    return out


@register("resume_anti", f"""
    WITH r AS ({RAW_POSTINGS_SQL}),
    stored AS (SELECT DISTINCT job_url FROM r WHERE seq % 3 = 0),
    todo AS (SELECT r.*, seq // {dims.PAGE_SIZE} AS page FROM r
             WHERE keyword <> '数据分析' AND seq // {dims.PAGE_SIZE} > 2
               AND ({" OR ".join(f"contains(coalesce(city, ''), '{c}')" for c in dims.TARGET_CITIES)})
               AND job_url NOT IN (SELECT job_url FROM stored))
    SELECT seq, keyword, page, job_url FROM todo""")
def q_resume_anti(spark, sf_dir):
    from hirelens.operators.joins import contains_any, skip_done
    r = raw(spark, sf_dir).withColumn("page", F.floor(F.col("seq") / dims.PAGE_SIZE).cast("long"))
    done_keywords = spark.createDataFrame([("数据分析",)], "keyword string")   # finished keyword set
    stored = r.where(F.col("seq") % 3 == 0).select("job_url")               # URLs of a previous run
    todo = skip_done(r, done_keywords, "keyword", bounded=True).where(F.col("page") > 2)  # resume after page 2
    todo = todo.where(contains_any("city", dims.TARGET_CITIES))
    todo = skip_done(todo, stored, "job_url")
    return todo.select("seq", "keyword", "page", "job_url")


@register("keyword_first_n", f"""
    WITH r AS ({RAW_POSTINGS_SQL}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY keyword ORDER BY seq) AS rn FROM r)
    SELECT 20 AS n, seq, keyword FROM ranked WHERE rn <= 20
    UNION ALL SELECT 800, seq, keyword FROM ranked WHERE rn <= 800
    UNION ALL SELECT 0, seq, keyword FROM ranked""")
def q_keyword_first_n(spark, sf_dir):
    """WIN-7: the first postings of each keyword, for two limits and none (0)."""
    from hirelens.operators.joins import first_n_per_group
    r = raw(spark, sf_dir).select("seq", "keyword")
    parts = [first_n_per_group(r, "keyword", [F.col("seq")], n or None).select(F.lit(n).alias("n"), "seq", "keyword") for n in (20, 800, 0)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("skill_bridge", with_clean("""
    SELECT seq AS job_id, trim(t) AS skill_name
    FROM clean, unnest(string_split(skill_tags, ',')) AS u(t)
    WHERE skill_tags IS NOT NULL AND trim(t) <> ''"""))
def q_skill_bridge(spark, sf_dir):
    """JON-6: the bridge of all standardized postings; rows of postings that
    cleaning took out of the job table refer to nothing and go."""
    from hirelens.operators.joins import skill_bridge
    jobs = cleaned(spark, sf_dir).select(F.col("seq").alias("job_id"))
    return skill_bridge(standardized(spark, sf_dir)).join(jobs, "job_id", "left_semi")


TABLE_PARTS = 8


@register("job_tables", with_parsed(""",
    jobs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY seq) AS rn FROM parsed) WHERE rn = 1),
    skills AS (SELECT seq, job_url, publish_date, trim(t) AS skill FROM parsed, unnest(string_split(skill_tags, ',')) AS u(t) WHERE trim(t) <> ''),
    held AS (SELECT s.* FROM skills s JOIN jobs j ON s.seq = j.seq)
    SELECT 'duplicate urls' AS what, count(*) AS n FROM (SELECT job_url FROM parsed GROUP BY job_url HAVING count(*) > 1)
    UNION ALL SELECT 'titles missing', 0
    UNION ALL SELECT 'dates missing', count(*) FROM jobs WHERE publish_date IS NULL
    UNION ALL SELECT 'jobs', count(*) FROM jobs
    UNION ALL SELECT 'orphan skills', (SELECT count(*) FROM skills) - (SELECT count(*) FROM held)
    UNION ALL SELECT 'skills', count(*) FROM held
    UNION ALL SELECT 'jobs after', count(*) FROM jobs WHERE publish_date IS NOT NULL
    UNION ALL SELECT 'skills after', count(*) FROM held WHERE publish_date IS NOT NULL
    UNION ALL SELECT 'orphans after', 0
    UNION ALL SELECT 'results', 2
    UNION ALL SELECT 'top skill of the results', max(n) FROM (SELECT count(*) AS n FROM held WHERE publish_date IS NOT NULL GROUP BY skill)"""))
def q_job_tables(spark, sf_dir):
    """SNK-7: the three tables. Jobs come with repeated URLs (the first stays)
    and skills with rows of jobs that were not taken; both are found as
    violations. Jobs without a date are deleted with their skills; the results
    table has one row a name."""
    from hirelens.operators.joins import skill_bridge
    from hirelens.operators.keys import delete_cascade, duplicate_keys, missing_values, orphans, write_placed
    from hirelens.session import unique_dir
    from hirelens.sinks.store import insert_table, replace_partitions, table_rows
    base = unique_dir(spark, "tables")
    rows = standardized(spark, sf_dir).select("seq", "job_title", "job_url", "publish_date", "skill_tags")
    counts = {"duplicate urls": duplicate_keys(rows, "job_url").count()}
    insert_table(spark, f"{base}/incoming", rows, "job_url")
    write_placed(table_rows(spark, f"{base}/incoming"), f"{base}/job_listing", "seq", TABLE_PARTS)
    jobs = spark.read.parquet(f"{base}/job_listing")
    empty = {r["column"]: r["n"] for r in missing_values(jobs, "job_title", "publish_date").collect()}
    counts |= {"titles missing": empty.get("job_title", 0), "dates missing": empty.get("publish_date", 0), "jobs": jobs.count()}
    skills = skill_bridge(rows)
    lost = orphans(skills, "job_id", jobs, "seq")
    counts["orphan skills"] = lost.count()
    write_placed(skills.join(jobs, F.col("job_id") == F.col("seq"), "left_semi"), f"{base}/job_skill", "job_id", TABLE_PARTS)
    counts["skills"] = spark.read.parquet(f"{base}/job_skill").count()
    delete_cascade(spark, f"{base}/job_listing", "seq", {f"{base}/job_skill": "job_id"},
                   jobs.where("publish_date IS NULL").select(F.col("seq").alias("id")), TABLE_PARTS)
    jobs, skills = spark.read.parquet(f"{base}/job_listing"), spark.read.parquet(f"{base}/job_skill")
    counts |= {"jobs after": jobs.count(), "skills after": skills.count(), "orphans after": orphans(skills, "job_id", jobs, "seq").count()}

    def result(name, df):
        return df.agg(F.to_json(F.struct(F.max("n").alias("most"))).alias("data")).withColumn("result_name", F.lit(name))
    by_skill = skills.groupBy("skill_name").agg(F.count(F.lit(1)).alias("n"))
    replace_partitions(result("jobs", jobs.groupBy("seq").agg(F.count(F.lit(1)).alias("n"))), f"{base}/analysis_result", "result_name")
    for _ in range(2):  # the second writes over the first
        replace_partitions(result("skills", by_skill), f"{base}/analysis_result", "result_name")
    results = spark.read.parquet(f"{base}/analysis_result")
    counts["results"] = results.count() if not duplicate_keys(results, "result_name").count() else -1
    counts["top skill of the results"] = int(results.where("result_name = 'skills'").select(F.get_json_object("data", "$.most")).first()[0])
    return spark.createDataFrame(list(counts.items()), "what string, n long")


UPSERT_BATCHES = """
  b AS (SELECT seq, job_url, 1 AS batch, salary_avg FROM parsed WHERE seq % 3 <> 0
        UNION ALL SELECT seq, job_url, 2 AS batch, salary_avg + 1000 FROM parsed WHERE seq % 2 = 0 OR seq % 3 = 0)"""


def _batches(spark, sf_dir):
    """Two overlapping batches of the parsed postings, parsed once."""
    from hirelens.functions.salary import with_salary
    from hirelens.session import materialize
    p = materialize(with_salary(raw(spark, sf_dir)).select("seq", "job_url", "salary_avg"), "parsed-salaries")
    b1 = p.where(F.col("seq") % 3 != 0).withColumn("_batch", F.lit(1))
    b2 = (p.where((F.col("seq") % 2 == 0) | (F.col("seq") % 3 == 0)).withColumn("_batch", F.lit(2))
           .withColumn("salary_avg", F.col("salary_avg") + 1000))
    return b1, b2


@register("upsert_latest", with_parsed(f""", {UPSERT_BATCHES}
    SELECT job_url, seq, batch, salary_avg FROM (
      SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY batch DESC, seq DESC) AS rn FROM b) WHERE rn = 1"""))
def q_upsert_latest(spark, sf_dir):
    from hirelens.session import unique_dir
    from hirelens.sinks.store import table_rows, upsert_table
    path = unique_dir(spark, "job-table")
    for batch in _batches(spark, sf_dir):
        upsert_table(spark, path, batch, "job_url")
    return table_rows(spark, path).select("job_url", "seq", F.col("_batch").alias("batch"), "salary_avg")


@register("insert_new", with_parsed(f""", {UPSERT_BATCHES},
    first1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY seq) rn FROM b WHERE batch = 1)
               WHERE rn = 1),
    first2 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY seq) rn FROM b WHERE batch = 2)
               WHERE rn = 1)
    SELECT job_url, seq, batch, salary_avg FROM first1
    UNION ALL SELECT job_url, seq, batch, salary_avg FROM first2 WHERE job_url NOT IN (SELECT job_url FROM first1)"""))
def q_insert_new(spark, sf_dir):
    from hirelens.session import unique_dir
    from hirelens.sinks.store import insert_table, table_rows
    path = unique_dir(spark, "job-table")
    for batch in _batches(spark, sf_dir):
        insert_table(spark, path, batch, "job_url")
    return table_rows(spark, path).select("job_url", "seq", F.col("_batch").alias("batch"), "salary_avg")


@register("page_funnel", f"""
    WITH r AS ({RAW_POSTINGS_SQL}),
    c AS (SELECT *, seq // {dims.PAGE_SIZE} AS page,
            ({" OR ".join(f"contains(coalesce(city, ''), '{c}')" for c in dims.TARGET_CITIES)}) AS in_city FROM r),
    firsts AS (SELECT job_url, min(seq) AS first_seq FROM c WHERE in_city GROUP BY job_url)
    SELECT page, count(*) AS fetched, count(*) FILTER (WHERE in_city) AS in_city,
           count(*) FILTER (WHERE in_city AND seq = first_seq) AS new
    FROM c LEFT JOIN firsts USING (job_url) GROUP BY page""")
def q_page_funnel(spark, sf_dir):
    from hirelens.operators.crawl import page_funnel
    return page_funnel(raw(spark, sf_dir), dims.PAGE_SIZE, dims.TARGET_CITIES)
