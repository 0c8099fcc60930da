"""Ingest queries: nested JSON payloads, video lists, HTML pages, page
classification, document skill/token extraction, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens import dims
from hirelens.plans.catalog import register
from hirelens.session import table

# ------------------------------------------------------------ search payloads
PAYLOAD_ORACLE = """
WITH g AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderkey // 50 AS page,
         CAST(o.o_orderdate AS DATE) AS d, o.o_orderpriority AS prio, c.c_name, c.c_mktsegment,
         row_number() OVER (PARTITION BY o.o_orderkey // 50 ORDER BY o.o_orderkey) - 1 AS pos
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
s AS (
  SELECT *,
    CASE k % 3 WHEN 0 THEN (10 + ck % 20) * 1000.0 WHEN 1 THEN (8 + ck % 5) * 1000.0 END AS a,
    CASE k % 3 WHEN 0 THEN (20 + k % 10) * 1000.0 WHEN 1 THEN 10000.0 + (1 + k % 9) * 1000.0 END AS b
  FROM g WHERE k % 53 <> 0)
SELECT CAST(k AS STRING) AS job_id, page, pos, 'Job-' || prio AS job_title,
  CAST(least(a, b) AS DOUBLE) AS salary_min, CAST(greatest(a, b) AS DOUBLE) AS salary_max,
  CAST(round_even((a + b) / 2, 0) AS DOUBLE) AS salary_avg,
  CASE ck % 3 WHEN 0 THEN '北京' WHEN 1 THEN '上海' ELSE '未知' END AS city,
  CASE ck % 3 WHEN 0 THEN '海淀区' WHEN 1 THEN '浦东' ELSE '' END AS district,
  CASE k % 4 WHEN 0 THEN '本科' WHEN 1 THEN '硕士' WHEN 2 THEN '不限' ELSE '大专' END AS education,
  CASE k % 3 WHEN 0 THEN '3-5年' WHEN 1 THEN '经验不限' ELSE '0.0年' END AS experience,
  CAST(CASE k % 3 WHEN 0 THEN 3 ELSE 0 END AS DOUBLE) AS exp_min,
  CAST(CASE k % 3 WHEN 0 THEN 5 ELSE 0 END AS DOUBLE) AS exp_max,
  c_name AS company_name, c_mktsegment AS industry,
  CASE WHEN k % 2 = 0 THEN 'Python, SQL' ELSE 'Java, Go' END AS skill_tags,
  strftime(d, '%Y-%m-%d') AS publish_date,
  'https://jobs.example.com/all/' || CAST(k AS STRING) || '.html' AS job_url
FROM s"""


def search_payload_pages(spark, sf_dir):
    """One search-API payload per page of 50 orders, in four container
    shapes and with alternating key names (what a crawler would store)."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    page = F.floor(k / 50).cast("long")
    s = lambda x: x.cast("string")
    salary = (F.when(k % 3 == 0, F.concat(s(10 + ck % 20), F.lit("-"), s(20 + k % 10), F.lit("K")))
               .when(k % 3 == 1, F.concat(s(8 + ck % 5), F.lit("千-1."), s(1 + k % 9), F.lit("万")))
               .otherwise(F.lit("面议")))
    title = F.when(k % 53 == 0, F.lit("")).otherwise(F.concat(F.lit("Job-"), F.col("o_orderpriority")))
    d = F.to_date("o_orderdate")
    item = F.to_json(F.struct(
        k.alias("jobId"),
        F.when(page % 2 == 0, title).alias("jobName"), F.when(page % 2 == 1, title).alias("job_name"),
        F.when(page % 3 == 0, salary).alias("providesalary"),
        F.when(page % 3 == 1, salary).alias("providesalary_text"),
        F.when(page % 3 == 2, salary).alias("salary"),
        F.element_at(F.array(F.lit("北京市海淀区"), F.lit("上海-浦东"), F.lit("")), (ck % 3 + 1).cast("int")).alias("workarea"),
        F.element_at(F.array(F.lit("本科"), F.lit("硕士及以上"), F.lit(""), F.lit("大专")), (k % 4 + 1).cast("int"))
        .alias("degreefrom"),
        F.element_at(F.array(F.lit("3-5年"), F.lit("经验不限"), F.lit("")), (k % 3 + 1).cast("int")).alias("workyear"),
        F.col("c_name").alias("companyName"),
        F.col("c_mktsegment").alias("companyind_text"),
        F.when(k % 2 == 0, F.array(F.lit("Python"), F.lit("SQL"))).alias("attr_arr"),
        F.when(k % 2 == 1, F.lit("Java, Go")).alias("attr_str"),
        F.when(k % 7 == 0, F.date_format(d, "yyyy/MM/dd")).otherwise(F.date_format(d, "yyyy-MM-dd")).alias("issuedate"),
    ))
    item = F.regexp_replace(item, '"attr_(arr|str)":', '"attribute":')
    rows = o.join(c, o.o_custkey == c.c_custkey).select(page.alias("page"), k.alias("k"), item.alias("item"))
    # a page holds at most 50 orders (bounded by construction)
    pages = rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("k", "item"))).alias("its"))
    arr = F.concat(F.lit("["), F.array_join(F.transform("its", lambda x: x["item"]), ","), F.lit("]"))
    p4 = F.col("page") % 4
    payload = (F.when(p4 == 0, F.concat(F.lit('{"engine_search_result":'), arr, F.lit("}")))
                .when(p4 == 1, F.concat(F.lit('{"resultbody":{"job":{"items":'), arr, F.lit("}}}")))
                .when(p4 == 2, F.concat(F.lit('{"resultbody":{"items":'), arr, F.lit("}}")))
                .otherwise(F.concat(F.lit('{"engine_search_result":[],"data":'), arr, F.lit("}"))))
    return pages.select("page", payload.alias("payload"))


@register("payload_explode", PAYLOAD_ORACLE)
def q_payload_explode(spark, sf_dir):
    from hirelens.functions.text import experience_text
    from hirelens.sources.payload import explode_items, project_list_items
    items = explode_items(search_payload_pages(spark, sf_dir))
    p = project_list_items(items)
    exp_txt = F.when(F.col("experience") != "", F.col("experience")).otherwise(experience_text("exp_min", "exp_max"))
    return p.select("job_id", "page", F.col("pos").cast("long").alias("pos"), "job_title", "salary_min", "salary_max",
                    "salary_avg", "city", "district", "education", exp_txt.alias("experience"), "exp_min", "exp_max",
                    "company_name", "industry", "skill_tags", "publish_date", "job_url")


# ------------------------------------------------------------ detail payloads
@register("detail_payload", """
    SELECT o_orderkey AS job_id,
      CASE WHEN o_orderkey % 2 = 0 THEN 'Spark, Kafka' ELSE 'Flink' END AS skill_tags,
      CASE o_orderkey % 3 WHEN 0 THEN '硕士' WHEN 1 THEN '本科' ELSE NULL END AS education,
      CASE WHEN o_orderkey % 3 = 2 THEN NULL ELSE CAST(1 + o_orderkey % 5 AS DOUBLE) END AS exp_min,
      CASE WHEN o_orderkey % 3 = 2 THEN NULL WHEN o_orderkey % 7 = 0 THEN 999.0 ELSE CAST(3 + o_orderkey % 5 AS DOUBLE) END AS exp_max,
      CASE WHEN o_orderkey % 3 = 2 THEN NULL WHEN o_orderkey % 7 = 0 THEN CAST(1 + o_orderkey % 5 AS VARCHAR) || '.0年以上'
           ELSE CAST(1 + o_orderkey % 5 AS VARCHAR) || '.0-' || CAST(3 + o_orderkey % 5 AS VARCHAR) || '.0年' END AS experience,
      CASE WHEN o_orderkey % 4 = 0 THEN '500-1000人' ELSE NULL END AS company_size
    FROM orders""")
def q_detail_payload(spark, sf_dir):
    """PRJ-4: detail payloads in three nestings (jobDetail / detail / data)."""
    from hirelens.sources.payload import project_detail
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    tags = F.when(k % 2 == 0, F.to_json(F.array(F.lit("Spark"), F.lit("Kafka")))).otherwise(F.lit('"Flink"'))
    edu = F.when(k % 3 == 0, F.lit('"degreeName":"硕士及以上",')).when(k % 3 == 1, F.lit('"degree":"本科",')).otherwise(F.lit(""))
    exp = F.when(k % 3 != 2, F.concat(F.lit('"workingYears":"'), (1 + k % 5).cast("string"), F.lit("-"),
                                      F.when(k % 7 == 0, F.lit("999")).otherwise((3 + k % 5).cast("string")),
                                      F.lit('年",'))).otherwise(F.lit(""))
    inner = F.concat(F.lit("{"), edu, exp, F.lit('"jobTags":'), tags, F.lit("}"))
    wrap = F.element_at(F.array(F.lit("jobDetail"), F.lit("detail"), F.lit("data")), (k % 3 + 1).cast("int"))
    company = F.when(k % 4 == 0, F.lit(',"companyInfo":{"companySize":" 500-1000人 "}')).otherwise(F.lit(""))
    payload = F.concat(F.lit('{"'), wrap, F.lit('":'), inner, company, F.lit("}"))
    d = project_detail(o.select(k.alias("job_id"), payload.alias("payload")))
    return d.select("job_id", "skill_tags", "education", "exp_min", "exp_max", "experience",
                    F.nullif(F.col("company_size"), F.lit("")).alias("company_size"))


# ------------------------------------------------------------ video lists
VIDEO_ORACLE = """
SELECT row_number() OVER (ORDER BY event_id) AS seq_no, event_id // 20 AS page,
  CAST(event_id % 20 AS BIGINT) AS pos,
  CASE WHEN event_type = 'view' THEN '无标题' ELSE 'video-' || CAST(event_id AS STRING) END AS title,
  CASE WHEN event_type = 'signup' THEN '' ELSE 'BV' || lpad(CAST(event_id AS STRING), 8, '0') END AS bvid,
  CASE WHEN event_type = 'signup' THEN '' ELSE 'https://video.example.com/video/BV' || lpad(CAST(event_id AS STRING), 8, '0') END AS link,
  CASE WHEN event_type = 'error' THEN '未知作者' ELSE 'up' || CAST(user_id AS STRING) END AS author,
  CASE WHEN event_type = 'purchase' THEN '未知分区' ELSE event_type END AS category,
  CASE WHEN event_type = 'click' THEN 0 ELSE CAST(round(value * 100) AS BIGINT) END AS views,
  CASE WHEN event_type = 'click' THEN 0 ELSE user_id % 50 END AS danmaku,
  CASE WHEN event_type = 'click' THEN 0 ELSE event_id % 97 END AS likes,
  CASE WHEN event_id % 10 = 0 THEN '未知' ELSE strftime(CAST(ts AS DATE), '%Y-%m-%d') END AS publish_date
FROM events"""


def video_payload_pages(spark, sf_dir):
    """Popular-list payloads: 20 events per page, optional nested fields."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    et = F.col("event_type")
    item = F.struct(
        F.when(et != "view", F.concat(F.lit("video-"), eid.cast("string"))).alias("title"),
        F.when(et != "signup", F.concat(F.lit("BV"), F.lpad(eid.cast("string"), 8, "0"))).alias("bvid"),
        F.when(et != "error", F.struct(F.concat(F.lit("up"), F.col("user_id").cast("string")).alias("name"))).alias("owner"),
        F.when(et != "click", F.struct(F.round(F.col("value") * 100).cast("long").alias("view"),
                                       (F.col("user_id") % 50).alias("danmaku"), (eid % 97).alias("like"))).alias("stat"),
        F.when(et != "purchase", et).alias("tname"),
        F.when(eid % 10 != 0, F.unix_seconds(F.col("ts").cast("timestamp"))).alias("pubdate"),
    )
    rows = e.select(F.floor(eid / 20).cast("long").alias("page"), eid, item.alias("item"))
    # 20 events per page at most: a bounded group
    pages = rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("event_id", "item"))).alias("its"),
                                     F.count(F.lit(1)).alias("n"))
    payload = F.to_json(F.struct(F.lit(0).alias("code"), F.struct(
        F.transform("its", lambda x: x["item"]).alias("list"), (F.col("n") < 20).alias("no_more")).alias("data")))
    return pages.select("page", payload.alias("payload"))


@register("video_stats", VIDEO_ORACLE)
def q_video_stats(spark, sf_dir):
    from hirelens.operators.crawl import global_sequence
    from hirelens.sources.payload import parse_video_pages
    v = parse_video_pages(video_payload_pages(spark, sf_dir))
    v = global_sequence(v, ["page", "pos"], "seq_no")
    return v.select(F.col("seq_no").cast("long").alias("seq_no"), "page", F.col("pos").cast("long").alias("pos"),
                    "title", "bvid", "link", "author", "category", "views", "danmaku", "likes", "publish_date")


@register("event_props", """
    SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k,
           coalesce(CAST(json_extract(props, '$.missing') AS BIGINT), 0) AS missing FROM events""")
def q_event_props(spark, sf_dir):
    """JSN-1: nested get with defaults on a JSON text column."""
    e = table(spark, sf_dir, "events")
    p = F.from_json("props", "k BIGINT, missing BIGINT")
    return e.select("event_id", F.coalesce(p["k"], F.lit(0)).alias("k"), F.coalesce(p["missing"], F.lit(0)).alias("missing"))


@register("page_sequence", """
    SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice)
             AS seq_no, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice
    FROM lineitem""")
def q_page_sequence(spark, sf_dir):
    from hirelens.operators.crawl import global_sequence
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                  "l_quantity", "l_extendedprice")
    out = global_sequence(li, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return out.select(F.col("seq_no").cast("long").alias("seq_no"), *li.columns)


# ------------------------------------------------------------ HTML pages
STRIP = "trim(regexp_replace(regexp_replace({x}, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"


@register("html_cards", f"""
    SELECT page_id, url, regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang,
      coalesce(nullif(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), ''),
               nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '')) AS title,
      {STRIP.format(x="regexp_extract(html, '(?s)<article>.*?<p>(.*?)</p>', 1)")} AS first_paragraph,
      len(regexp_extract_all(html, '<a href=')) AS n_links,
      len(regexp_extract_all(html, '<p>')) AS n_paragraphs,
      contains(html, 'class="ad"') AS has_ad,
      {STRIP.format(x="regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1)")} AS footer,
      length(html) AS n_chars
    FROM pages""")
def q_html_cards(spark, sf_dir):
    from hirelens.sources.html import parse_pages
    out = parse_pages(table(spark, sf_dir, "pages"))
    return out.withColumns({"n_links": F.col("n_links").cast("long"), "n_paragraphs": F.col("n_paragraphs").cast("long"),
                            "n_chars": F.col("n_chars").cast("long")})


#: error members of a JSON body; the first that is not empty counts
API_CODES = ['"code": 403', '"code": 0, "status": 500', '"code": false, "errno": "0"', '"code": "", "status": null, "errno": -1', '"code": 200']
#: what each gives as a reason
API_REASONS = ["api_code:403", "api_code:500", None, "api_code:-1", None]


@register("html_job_cards", """
    SELECT o_orderkey // 50 AS page, row_number() OVER (PARTITION BY o_orderkey // 50 ORDER BY o_orderkey) - 1 AS pos,
      CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'Job ' || o_orderpriority END AS job_title,
      CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_orderkey % 9 + 8 AS VARCHAR) || '-' || CAST(o_orderkey % 9 + 20 AS VARCHAR) || 'K' END AS salary_text,
      'Company ' || CAST(o_custkey AS VARCHAR) AS company_name, CASE WHEN o_orderkey % 2 = 0 THEN '广州·天河区' ELSE '' END AS city,
      CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_orderkey % 9 + 8) * 1000.0 END::DOUBLE AS salary_min,
      CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_orderkey % 9 + 20) * 1000.0 END::DOUBLE AS salary_max
    FROM orders""")
def q_html_job_cards(spark, sf_dir):
    """SRC-6: list pages of up to 50 job cards, with missing fields, nested
    markup and fields in another order."""
    from hirelens.sources.html import card_rows
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    s = lambda x: x.cast("string")
    # nested elements of one name, void and unclosed tags, and a first choice that
    # is empty or comes later than a second one
    job = F.concat(F.lit('<em>Job</em><br> <div><div>'), F.col("o_orderpriority"), F.lit("</div></div>"))
    title = F.when(k % 9 == 0, F.lit('<div class="jname"><div> </div></div>')).otherwise(F.concat(
        F.lit('<div class="job-info"><img src="x.png"><p>'),
        F.when(k % 5 == 0, F.concat(F.lit('<div class="jname"> &nbsp;</div><div class="job-title">'), job, F.lit("</div>")))
         .when(k % 5 == 1, F.concat(F.lit('<div class="sub-title">not this</div><div class="jname at">'), job, F.lit("</div>")))
         .otherwise(F.concat(F.lit('<div class="jname at"><!-- <div> -->'), job, F.lit("</div>"))), F.lit("</div>")))
    salary = F.when(k % 7 != 0, F.concat(F.lit('<span class="sal shrink-0"><span>'), s(k % 9 + 8), F.lit("</span>-"), s(k % 9 + 20), F.lit("K</span>"))).otherwise(F.lit(""))
    company = F.concat(F.lit('<p class="com-box">\n Company  '), s(F.col("o_custkey")), F.lit("</p>"))
    area = F.when(k % 2 == 0, F.lit('<div class="area">广州·天河区</div>')).otherwise(F.lit('<div class="zone">x</div>'))
    body = F.when(k % 3 == 0, F.concat(salary, title, area, company)).otherwise(F.concat(title, salary, company, area))
    # what follows a card is not part of it
    card = F.concat(F.lit('<div class="list job-card top">'), body, F.lit('</div><div class="area ad">elsewhere</div>'))
    # 50 cards per page at most: a bounded group
    pages = o.select(F.floor(k / 50).cast("long").alias("page"), k.alias("k"), card.alias("card")).groupBy("page") \
        .agg(F.array_sort(F.collect_list(F.struct("k", "card"))).alias("c"))
    html = F.concat(F.lit("<html><h1 class='title'>jobs</h1>"), F.array_join(F.transform("c", lambda x: x["card"]), "\n"), F.lit("</html>"))
    rows = card_rows(pages.select("page", html.alias("html")))
    return rows.select("page", F.col("pos").cast("long").alias("pos"), "job_title", "salary_text", "company_name", "city", "salary_min", "salary_max")


@register("video_card_counts", """
    SELECT event_id, CASE event_id % 4 WHEN 3 THEN '' WHEN 2 THEN CAST(user_id AS VARCHAR) ELSE CAST(user_id AS VARCHAR) || '.5万' END AS plays,
      CASE WHEN event_id % 4 < 2 THEN CAST(event_id % 97 AS VARCHAR) ELSE '' END AS comments,
      CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN CAST(user_id AS DOUBLE) ELSE user_id * 10000.0 + 5000 END::DOUBLE AS plays_number
    FROM events""")
def q_video_card_counts(spark, sf_dir):
    """STR-15: the last two lines of a video card that are neither title nor
    author nor label are plays and comments."""
    from hirelens.functions.text import count_text_value, last_counts
    e = table(spark, sf_dir, "events")
    i, user = F.col("event_id"), F.col("user_id").cast("string")
    two = F.concat(user, F.lit(".5万\n  \n"), (i % 97).cast("string"), F.lit(" \n"))
    tail = F.when(i % 4 == 3, F.lit("")).when(i % 4 == 2, user).otherwise(two)
    text = F.concat(F.lit("A title\n label \n"), F.col("event_type"), F.lit("\n\n"), tail)
    c = last_counts(text, F.lit("A title"), F.col("event_type"), F.lit("label"))
    return e.select("event_id", c["plays"].alias("plays"), c["comments"].alias("comments")) \
        .withColumn("plays_number", count_text_value("plays"))


def _fetched(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    status = (F.when(pid % 11 == 0, 403).when(pid % 11 == 1, 429).when(pid % 11 == 2, 503)
               .when(pid % 19 == 0, None).otherwise(200))
    url = F.when(pid % 17 == 0, F.concat("url", F.lit("?verify=1"))).otherwise(F.col("url"))
    body = (F.when(pid % 19 == 0, F.lit(None)).when(pid % 13 == 0, F.substring("html", 1, 60))
             .when(pid % 23 == 0, F.element_at(F.array(*[F.lit('{' + c + ', "message": "denied", "pad": "' + "x" * 120 + '"}') for c in API_CODES]),
                                               (F.floor(pid / 23) % len(API_CODES) + 1).cast("int")))
             .when(pid % 29 == 1, F.concat(F.lit("<p>请稍后再试</p>"), F.col("html")))
             .otherwise(F.col("html")))
    html = (F.when(pid % 7 == 0, F.concat(F.col("html"), F.lit("<p>15K-20K</p><p>8千</p>")))
             .when(pid % 7 == 1, F.concat(F.col("html"), F.lit("<p>Python 30K</p>")))
             .when(pid % 7 == 2, F.concat(F.lit("<p>滑块</p>"), F.col("html"), F.lit("<p>15K 20K</p>")))
             .when(pid % 7 == 3, F.concat(F.col("html"), F.lit("<p>Python 搜索发现</p>")))
             .when(pid % 7 == 4, F.concat(F.col("html"), F.repeat(F.lit('<div class="job-card"><b class="name">a job</b></div>'), 2)))
             .when(pid % 7 == 5, F.concat(F.col("html"), F.lit('<div class="job-card"><b class="name">a job</b></div>'))).otherwise(F.col("html")))
    return p.select("page_id", status.alias("status"), url.alias("url"), body.alias("body"), html.alias("html"))


@register("page_quality", f"""
    WITH f AS (
      SELECT page_id,
        CASE WHEN page_id % 11 = 0 THEN 403 WHEN page_id % 11 = 1 THEN 429 WHEN page_id % 11 = 2 THEN 503
             WHEN page_id % 19 = 0 THEN NULL ELSE 200 END AS status,
        CASE WHEN page_id % 17 = 0 THEN url || '?verify=1' ELSE url END AS url,
        CASE WHEN page_id % 19 = 0 THEN NULL WHEN page_id % 13 = 0 THEN substr(html, 1, 60)
             WHEN page_id % 23 = 0 THEN repeat('x', 200) WHEN page_id % 29 = 1 THEN '<p>请稍后再试</p>' || html ELSE html END AS body,
        CASE page_id % 7 WHEN 0 THEN html || '<p>15K-20K</p><p>8千</p>' WHEN 1 THEN html || '<p>Python 30K</p>'
             WHEN 2 THEN '<p>滑块</p>' || html || '<p>15K 20K</p>' WHEN 3 THEN html || '<p>Python 搜索发现</p>'
             WHEN 4 THEN html || repeat('<div class="job-card"><b class="name">a job</b></div>', 2)
             WHEN 5 THEN html || '<div class="job-card"><b class="name">a job</b></div>' ELSE html END AS html
      FROM pages),
    c AS (SELECT *, lower(substr(body, 1, 500)) AS low,
            CASE WHEN page_id % 23 = 0 AND page_id % 13 <> 0 AND page_id % 19 <> 0 THEN
              [{", ".join("NULL" if r is None else "'" + r + "'" for r in API_REASONS)}][page_id // 23 % {len(API_CODES)} + 1] END AS api
          FROM f)
    SELECT page_id, status,
      CASE WHEN status IS NULL AND body IS NULL THEN 'no_response'
           WHEN status IN (403, 429, 503, 504) THEN 'http_' || CAST(status AS STRING)
           WHEN contains(lower(url), 'verify') OR contains(lower(url), 'captcha') THEN 'redirect_verify'
           WHEN length(body) < 100 THEN 'too_short'
           {" ".join(f"WHEN contains(low, '{w}') THEN 'block_word:{w}'" for w in dims.BLOCK_BODY_WORDS)}
           ELSE api END AS reason,
      CASE WHEN contains(substr(html, 1, 2000), '滑块') OR contains(lower(substr(html, 1, 2000)), 'aliyun_waf') THEN false
           ELSE len(regexp_extract_all(html, '{dims.SALARY_TOKEN_PATTERN}')) >= 2
                OR page_id % 7 = 4
                OR (length(html) > 2000 AND contains(html, 'Python') AND NOT contains(html, '搜索发现')) END AS has_jobs
    FROM c""")
def q_page_quality(spark, sf_dir):
    """FLT-10, FLT-11: two job cards make a page of jobs too; their number comes
    from the card rows."""
    from hirelens.operators.quality import classify_response, page_has_jobs
    from hirelens.sources.html import card_rows
    f = _fetched(spark, sf_dir)
    cards = card_rows(f.select(F.col("page_id").alias("card_page"), "html")).groupBy("card_page").agg(F.count(F.lit(1)).alias("cards"))
    return f.join(cards, F.col("page_id") == F.col("card_page"), "left").select(
        "page_id", "status", classify_response(F.col("status"), F.col("url"), F.col("body")).alias("reason"),
        page_has_jobs(F.col("html"), cards=F.col("cards")).alias("has_jobs"))


# ------------------------------------------------------------ documents
def _oracle_skill_pattern():
    words = [w.replace("<END>", "(?:[^\\p{L}\\p{N}_]|$)") for w in dims.SKILL_REGEX_WORDS]
    return "(?i)(" + "|".join(words) + ")"


@register("skill_extract_documents", f"""
    WITH m AS (
      SELECT doc_id, trim(CASE WHEN length(x) = 2 AND regexp_matches(x, '^[rR][^\\p{{L}}\\p{{N}}_]$')
                               THEN substr(x, 1, 1) ELSE x END) AS skill
      FROM documents, unnest(regexp_extract_all(text, '{_oracle_skill_pattern()}', 1)) AS u(x)),
    d AS (SELECT doc_id, w AS skill FROM documents,
            (VALUES {", ".join("('" + w.replace("'", "''") + "')" for w in dims.SKILL_DICT if len(w) > 1)}) v(w)
          WHERE contains(lower(text), lower(w)))
    SELECT doc_id, 'regex' AS source, skill, count(*) AS n FROM m GROUP BY doc_id, skill
    UNION ALL SELECT doc_id, 'dict', skill, 1 FROM d""")
def q_skill_extract_documents(spark, sf_dir):
    """STR-7, STR-8: both matches in one scan of the texts."""
    from hirelens.functions.skills import regex_skills, with_dictionary_hits
    docs = table(spark, sf_dir, "documents").select("doc_id", regex_skills("text").alias("rx"), F.lower("text").alias("low"))
    both = with_dictionary_hits(docs, "low", "dx").drop("low")
    named = lambda c, source: F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.struct(F.lit(source).alias("source"), x.alias("skill")))
    hits = both.select("doc_id", F.explode(F.concat(named(F.col("rx"), "regex"), named(F.col("dx"), "dict"))).alias("h"))
    return hits.select("doc_id", "h.*").groupBy("doc_id", "source", "skill").agg(F.count(F.lit(1)).alias("n"))


IP_PORT = "([0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}:[0-9]{2,5})"


@register("token_extract_documents", f"""
    SELECT doc_id, t AS token, count(*) AS n
    FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text || ' via 10.0.' || CAST(doc_id % 256 AS VARCHAR) || '.7:80' || CAST(doc_id % 90 + 10 AS VARCHAR)
            || ', 10.0.1.1:8080 and 10.0.1.1:8080.' ELSE text END AS text FROM documents),
         unnest(regexp_extract_all(text, '{IP_PORT}', 1)) AS u(t) GROUP BY doc_id, t""")
def q_token_extract_documents(spark, sf_dir):
    """STR-14: ip:port tokens in free text (every third text names some)."""
    docs = table(spark, sf_dir, "documents")
    i = F.col("doc_id")
    docs = docs.withColumn("text", F.when(i % 3 == 0, F.concat(
        "text", F.lit(" via 10.0."), (i % 256).cast("string"), F.lit(".7:80"), (i % 90 + 10).cast("string"),
        F.lit(", 10.0.1.1:8080 and 10.0.1.1:8080."))).otherwise(F.col("text")))
    return (docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(IP_PORT), 1)).alias("token"))
                .groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n")))


@register("payload_new_api", """
    SELECT CAST(o_orderkey AS STRING) AS job_id,
      CASE WHEN o_orderkey % 53 = 0 THEN '' ELSE 'Job-' || o_orderpriority END AS job_title,
      CAST(10 + o_custkey % 20 AS STRING) || '-' || CAST(20 + o_orderkey % 10 AS STRING) || 'K' AS salary_text,
      CASE o_orderkey % 3 WHEN 0 THEN '广州' WHEN 1 THEN '深圳' ELSE '' END AS city,
      CASE o_orderkey % 3 WHEN 0 THEN '天河区' WHEN 1 THEN '南山区' ELSE '' END AS district,
      CASE WHEN o_orderkey % 3 < 2 THEN '一线' ELSE '其他' END AS city_tier,
      CASE o_orderkey % 3 WHEN 0 THEN '3-5年' WHEN 1 THEN '1年以下' ELSE '' END AS experience,
      CAST(CASE o_orderkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS DOUBLE) AS exp_min,
      CAST(CASE o_orderkey % 3 WHEN 0 THEN 5 WHEN 1 THEN 1 ELSE 0 END AS DOUBLE) AS exp_max,
      CASE o_orderkey % 4 WHEN 0 THEN '本科' WHEN 1 THEN '硕士' WHEN 2 THEN '' ELSE '大专' END AS education,
      c_name AS company_name, '' AS company_size, c_mktsegment AS industry,
      CASE WHEN o_orderkey % 2 = 0 THEN 'Python, Spark' ELSE '' END AS skill_tags,
      strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS publish_date,
      'https://jobs.example.com/all/' || CAST(o_orderkey AS STRING) || '.html' AS job_url
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def q_payload_new_api(spark, sf_dir):
    """PRJ-3: newer search-API items (area strings, tag arrays) to postings."""
    from hirelens.sources.payload import explode_items, project_new_api_items
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    s = lambda x: x.cast("string")
    item = F.to_json(F.struct(
        k.alias("jobId"),
        F.when(k % 53 == 0, F.lit("")).otherwise(F.concat(F.lit("Job-"), F.col("o_orderpriority"))).alias("jobName"),
        F.concat(s(10 + ck % 20), F.lit("-"), s(20 + k % 10), F.lit("K")).alias("provideSalaryString"),
        F.when(k % 3 == 0, F.lit("广州·天河区")).alias("jobAreaString"),
        F.when(k % 3 == 1, F.lit("深圳-南山区")).alias("workAreaString"),
        F.when(k % 3 == 0, F.lit("3-5年")).when(k % 3 == 1, F.lit("1年以下")).alias("workYearString"),
        F.when(k % 4 == 0, F.lit("本科")).when(k % 4 == 1, F.lit("硕士")).when(k % 4 == 3, F.lit("大专"))
        .alias("degreeString"),
        F.col("c_name").alias("companyName"), F.col("c_mktsegment").alias("industryType1Str"),
        F.when(k % 2 == 0, F.array(F.lit("Python"), F.lit("Spark"))).alias("tags_arr"),
        F.when(k % 2 == 1, F.lit("SQL")).alias("tags_str"),
        F.date_format(F.to_date("o_orderdate"), "yyyy-MM-dd").alias("issueDateString"),
    ))
    item = F.regexp_replace(item, '"tags_(arr|str)":', '"jobTags":')
    rows = o.join(c, o.o_custkey == c.c_custkey).select(F.floor(k / 50).cast("long").alias("page"), k.alias("k"),
                                                        item.alias("item"))
    pages = rows.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("k", "item"))).alias("its"))  # <= 50
    payload = F.concat(F.lit('{"engine_search_result":['), F.array_join(F.transform("its", lambda x: x["item"]), ","),
                       F.lit("]}"))
    p = project_new_api_items(explode_items(pages.select("page", payload.alias("payload"))))
    return p.select("job_id", "job_title", "salary_text", "city", "district", "city_tier", "experience", "exp_min",
                    "exp_max", "education", "company_name", "company_size", "industry", "skill_tags", "publish_date",
                    "job_url")
