"""Data-quality operators: row validation with reason codes (FLT-7..9, JON-10),
negotiable ratio (AGG-8), null census (AGG-19), pipeline counters (AGG-20),
fetched-page classification (FLT-10, FLT-11, JSN-2).

Validation never removes a row: it adds ``issues: array<struct<code, detail>>``.
Aggregation is on ``code`` only (the detail embeds values and has unbounded
cardinality).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.functions.salary import is_negotiable, py_strip, with_salary
from hirelens.functions.text import normalize_date, normalize_education, with_city


def _fmt_num(c):
    # plain decimal notation of any size, as "5000.0" or "12000000.5"
    text = F.regexp_replace(c.cast("double").cast("decimal(30,6)").cast("string"), r"0+$", "")
    return F.when(text.endswith("."), F.concat(text, F.lit("0"))).otherwise(text)


def parsed_postings(raw: DataFrame) -> DataFrame:
    """What a crawler run stores per posting: parsed salary numbers, the
    normalized city (blank -> 未知), education and a normalized date text
    (unparseable text kept as is)."""
    df = with_salary(raw, "salary_text")
    df = with_city(df, "city").withColumn("city", F.coalesce(F.col("city"), F.lit(dims.UNKNOWN_CITY)))
    d = normalize_date("publish_date")
    return df.withColumns({
        "education": normalize_education("education"),
        "publish_date": F.when(d.isNotNull(), F.date_format(d, "yyyy-MM-dd")).otherwise(F.col("publish_date")),
    })


def validate(df: DataFrame) -> DataFrame:
    """FLT-7: add ``issues`` (array of (code, detail)), ``n_issues``, ``issue_codes``.

    Numbers are read with ``try_cast`` (FLT-9: unparseable -> null, never an
    error); dates must parse as y-M-d and fall in 2000..2030 (DAT-4)."""
    title = F.col("job_title")
    smin = F.col("salary_min").try_cast("double")
    smax = F.col("salary_max").try_cast("double")
    both = smin.isNotNull() & smax.isNotNull()
    city = F.col("city")
    valid_cities = F.array(*[F.lit(c) for c in dims.VALID_CITIES])
    fuzzy = F.exists(valid_cities, lambda v: city.contains(v) | v.contains(city))
    pub = F.col("publish_date").cast("string")
    pub_d = F.try_to_date(F.substring(pub, 1, 10), "yyyy-M-d")
    edu = F.col("education")
    url = F.col("job_url")

    def issue(cond, code, detail):
        return F.when(cond, F.struct(F.lit(code).alias("code"), detail.alias("detail")))

    checks = [
        issue(title.isNull() | (py_strip(title) == ""), "title_empty", F.lit("no title")),
        issue(both & (smin > smax), "salary_min_gt_max",
              F.concat_ws(" ", F.lit("minimum"), _fmt_num(smin), F.lit("above maximum"), _fmt_num(smax))),
        issue(both & (smin <= 0), "salary_min_nonpositive", F.concat(F.lit("minimum not positive: "), _fmt_num(smin))),
        issue(both & (smax > dims.OUTLIER_SALARY_MAX), "salary_too_high", F.concat(F.lit("maximum too high: "), _fmt_num(smax))),
        issue(city.isNotNull() & (city != "") & (city != dims.UNKNOWN_CITY) & ~fuzzy,
              "city_unknown", F.concat(F.lit("city not known: "), city)),
        issue(pub.isNotNull() & (pub != "") & pub_d.isNull(), "date_format", F.concat(F.lit("not a date: "), pub)),
        issue(pub_d.isNotNull() & ~F.year(pub_d).between(2000, 2030), "date_year",
              F.concat(F.lit("year out of range: "), pub)),
        issue(edu.isNotNull() & (edu != "") & ~edu.isin(*dims.VALID_EDUCATION), "education_domain",
              F.concat(F.lit("education not known: "), edu)),
        issue(url.isNull() | (url == ""), "url_empty", F.lit("no url")),
    ]
    arr = F.filter(F.array(*checks), lambda x: x.isNotNull())
    df = df.withColumn("issues", arr)
    # codes as a plain string array: aggregations explode this, never the structs
    return (df.withColumn("codes", F.transform("issues", lambda x: x["code"]))
              .withColumn("n_issues", F.size("codes"))
              .withColumn("issue_codes", F.array_join("codes", ","))
              .withColumn("issue_details", F.array_join(F.transform("issues", lambda x: x["detail"]), "; ")))


RULE_CODES = ["title_empty", "salary_min_gt_max", "salary_min_nonpositive", "salary_too_high", "city_unknown",
              "date_format", "date_year", "education_domain", "url_empty"]


def validation_summary(validated: DataFrame) -> DataFrame:
    """FLT-8: totals and per-code breakdown as (code, n) rows; the special
    codes ``_total``, ``_clean`` and ``_issues`` hold the totals.

    One pass: ``posexplode_outer`` gives each row's codes (a row without
    issues yields one null code), and a single aggregate counts every rule
    code (the set is fixed) and the totals; the one-row result is turned
    into rows. Codes that never occur are left out, like the original's
    breakdown. (``explode_outer`` also keeps Catalyst from pushing an
    inferred ``size(codes) > 0`` filter into the parse.)"""
    e = validated.select(F.posexplode_outer("codes").alias("pos", "code"))
    pos, code = F.col("pos"), F.col("code")
    agg = e.agg(*[F.count(F.when(code == c, 1)).alias(c) for c in RULE_CODES],
                F.count(F.when(pos.isNull() | (pos == 0), 1)).alias("_total"),
                F.count(F.when(pos.isNull(), 1)).alias("_clean"),
                F.count(F.when(pos == 0, 1)).alias("_issues"))
    rows = F.array(*[F.struct(F.lit(c).alias("code"), F.col(c).alias("n"))
                     for c in RULE_CODES + ["_total", "_clean", "_issues"]])
    out = agg.select(F.explode(rows).alias("r")).select("r.code", "r.n")
    return out.where(F.col("code").startswith("_") | (F.col("n") > 0)).orderBy("code")


def negotiable_ratio(df: DataFrame) -> DataFrame:
    """AGG-8: negotiable share per city (rows with a city), flag above 0.3."""
    neg = F.coalesce(F.col("salary_text").contains(dims.NEGOTIABLE_MARK), F.lit(False))
    return (df.where(F.col("city").isNotNull()).groupBy("city")
              .agg(F.count(F.lit(1)).alias("total"), F.sum(neg.cast("long")).alias("negotiable"),
                   F.avg(neg.cast("double")).alias("_r"))
              .select("city", "total", "negotiable", F.bround("_r", 6).alias("ratio"),
                      (F.col("_r") > dims.NEGOTIABLE_RATIO_LIMIT).alias("above_limit"))
              .orderBy(F.desc("ratio"), "city"))


def null_census(df: DataFrame) -> DataFrame:
    """AGG-19: missing cells per column and in total, one aggregate pass."""
    aggs = [F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns]
    wide = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("col_name"), F.col(c).alias("missing")) for c in df.columns])
    long = wide.select(F.explode(pairs).alias("p")).select("p.col_name", "p.missing")
    total = long.agg(F.lit("_total").alias("col_name"), F.sum("missing").alias("missing"))
    return long.unionByName(total)


def pipeline_counters(raw: DataFrame) -> DataFrame:
    """AGG-20: raw, dedup removed, outliers removed, cleaned, retention %,
    plus distinct companies and industries (AGG-17), as one row. The counters
    are observed while the stages are written: no pass is made for them. The
    distinct counts are exact, of the written table's two columns; see
    :func:`distinct_sketches` for mergeable ones."""
    from pyspark.sql import Observation

    from hirelens.operators.clean import deduplicate, fill_missing, not_outlier, standardize
    from hirelens.session import materialize
    seen, kept, done = Observation(), Observation(), Observation()
    every = F.count(F.lit(1)).alias("n")
    std = materialize(standardize(raw).observe(seen, every), "standardized")
    dedup = materialize(deduplicate(std).observe(kept, every), "dedup-postings")
    good = fill_missing(dedup).where(not_outlier()).select("company_name", "industry")
    table = materialize(good.observe(done, every), "cleaned-names")
    n_raw, n_dedup, n = (o.get["n"] for o in (seen, kept, done))
    names = [table.groupBy(c).agg(F.lit(1)).where(F.col(c).isNotNull()).agg(F.count(F.lit(1)).alias(a)).scalar()
             for c, a in (("company_name", "companies"), ("industry", "industries"))]
    one = raw.sparkSession.createDataFrame([(n_raw, n_raw - n_dedup, n_dedup - n, n)], "raw_count long, dedup_removed long, outliers_removed long, cleaned_count long")
    return one.select("*", F.bround(F.col("cleaned_count") * 100.0 / F.col("raw_count"), 1).alias("retention_pct"),
                      names[0].alias("companies"), names[1].alias("industries"))


#: a sketch of 2^17 registers: exact to some 16,000 values, 0.3 % beyond, 128 kB at most
SKETCH_BITS = 17


def distinct_sketches(df: DataFrame, by: str, named: dict[str, str]) -> DataFrame:
    """AGG-17 at scale: per partition ``by`` its rows and a HyperLogLog sketch
    of each column (result name -> column). Nulls are not counted. Sketches of
    parts merge to that of the whole, so new parts need no old rows."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[F.hll_sketch_agg(c, F.lit(SKETCH_BITS)).alias(n) for n, c in named.items()])


def merged_sketches(sketches: DataFrame, names: list[str], *keys: str) -> DataFrame:
    """``keys``, n and the distinct counts of the merged sketches."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.hll_sketch_estimate(F.hll_union_agg(n)).alias(n) for n in names])


# ------------------------------------------------------------- fetched pages
def api_error_code(body, keys=("code", "status", "errno")):
    """JSN-2: the first of ``keys`` whose value is not empty: null, 0, false and
    "" are passed over, the text "0" is not. Null for other than JSON objects."""
    doc = F.try_parse_json(body)
    out = None
    for k in keys:
        value = F.try_variant_get(doc, f"$.{k}", "string")
        kind = F.schema_of_variant(F.try_variant_get(doc, f"$.{k}", "variant"))
        empty = (value.isNull() | (value == "") | ((kind == "BOOLEAN") & (value == "false"))
                 | (~kind.isin("STRING", "BOOLEAN") & (value.try_cast("double") == 0)))
        one = F.when(~F.coalesce(empty, F.lit(True)), value)
        out = one if out is None else F.coalesce(out, one)
    return out


def classify_response(status, url, body, json_body=None, body_prefix: int = 500, least_length: int = 100):
    """FLT-10 + JSN-2: block reason of a fetched response (null = fine).

    Ordered checks: missing response, blocking HTTP status, redirect to a
    verify/captcha page, body shorter than ``least_length``, block words in the
    first ``body_prefix`` characters (lower-cased; an article may mention
    them further down), error code of a JSON body not 0/200.
    """
    body_low = F.lower(F.substring(body, 1, body_prefix))
    url_low = F.lower(url)
    word = None
    for w in dims.BLOCK_BODY_WORDS:
        cond = body_low.contains(w)
        word = F.when(cond, F.lit(w)) if word is None else word.when(cond, F.lit(w))
    code = api_error_code(json_body if json_body is not None else body)
    redirect = F.lit(False)
    for w in dims.BLOCK_REDIRECT_WORDS:
        redirect = redirect | url_low.contains(w)
    return (F.when(status.isNull() & body.isNull(), F.lit("no_response"))
             .when(status.isin(*dims.BLOCK_STATUS), F.concat(F.lit("http_"), status.cast("string")))
             .when(redirect, F.lit("redirect_verify"))
             .when(F.length(body) < least_length, F.lit("too_short"))
             .when(word.isNotNull(), F.concat(F.lit("block_word:"), word))
             .when(code.isNotNull() & ~code.isin(*dims.JSON_OK_CODES), F.concat(F.lit("api_code:"), code)))


def page_has_jobs(text, waf_prefix: int = 2000, long_text: int = 2000, least_cards: int = 2, cards=None) -> "F.Column":
    """FLT-11: >= ``least_cards`` salary-like tokens (or job cards, if their
    number is given), or a text of over ``long_text`` characters with the marker
    (and no search-suggestion banner); WAF markers in the first ``waf_prefix``
    characters mean no."""
    head = F.substring(text, 1, waf_prefix)
    waf = head.contains(dims.WAF_MARKERS[0]) | F.lower(head).contains(dims.WAF_MARKERS[1])
    tokens = F.size(F.regexp_extract_all(text, F.lit(dims.SALARY_TOKEN_PATTERN), 0))
    long_ok = (F.length(text) > long_text) & text.contains(dims.JOB_PAGE_MARKER) & ~text.contains(dims.JOB_PAGE_SUGGEST)
    some = (tokens >= least_cards) | long_ok
    if cards is not None:
        some = some | F.coalesce(cards >= least_cards, F.lit(False))
    return F.when(waf, F.lit(False)).otherwise(some)


__all__ = ["parsed_postings", "validate", "validation_summary", "negotiable_ratio", "null_census",
           "pipeline_counters", "distinct_sketches", "merged_sketches", "api_error_code", "classify_response", "page_has_jobs", "is_negotiable"]
