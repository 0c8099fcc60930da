"""File round trips."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from hirelens.plans.catalog import cleaned, register
from hirelens.plans.oracle_base import with_clean
from hirelens.session import table, unique_dir

CSV_SCHEMA = StructType([StructField("seq", StringType()), StructField("job_title", StringType()),
                         StructField("salary_avg", DoubleType()), StructField("city", StringType()),
                         StructField("district", StringType()), StructField("skill_tags", StringType())])
JSON_SCHEMA = StructType([StructField("job_title", StringType()), StructField("salary_avg", DoubleType()),
                          StructField("city", StringType()), StructField("company_size", StringType()),
                          StructField("skill_tags", StringType())])


@register("io_roundtrip", with_clean("""
    SELECT 'csv' AS fmt, count(*) AS n_rows, round_even(sum(salary_avg), 2) AS salary_sum,
           count(*) - count(district) AS null_values, count(DISTINCT city) AS cities FROM clean
    UNION ALL
    SELECT 'json', count(*), round_even(sum(salary_avg), 2), count(*) - count(company_size), count(DISTINCT city) FROM clean
    UNION ALL
    SELECT 'parquet', count(*), round_even(sum(salary_avg), 2), count(*) - count(district), count(DISTINCT city) FROM clean"""))
def q_io_roundtrip(spark, sf_dir):
    """SRC-1/2/3, SNK-1/2/3: cleaned postings through CSV, JSON and Parquet."""
    from hirelens.sinks.files import read_csv, read_json, write_csv, write_json_records
    c = cleaned(spark, sf_dir)
    base = unique_dir(spark, "io-roundtrip")
    write_csv(c.select(F.col("seq").cast("string").alias("seq"), "job_title", "salary_avg", "city", "district",
                       "skill_tags", "keyword"), f"{base}/csv", fieldnames=[f.name for f in CSV_SCHEMA.fields])
    write_json_records(c, f"{base}/json")
    c.write.mode("overwrite").parquet(f"{base}/parquet")
    csv = read_csv(spark, f"{base}/csv", CSV_SCHEMA)
    js = read_json(spark, f"{base}/json", JSON_SCHEMA)
    pq = spark.read.parquet(f"{base}/parquet")

    def summary(df, fmt, null_col):
        return df.agg(F.lit(fmt).alias("fmt"), F.count(F.lit(1)).alias("n_rows"),
                      F.bround(F.sum("salary_avg"), 2).alias("salary_sum"),
                      F.sum(F.col(null_col).isNull().cast("long")).alias("null_values"),
                      F.count_distinct("city").alias("cities"))
    return summary(csv, "csv", "district").unionByName(summary(js, "json", "company_size")) \
                                          .unionByName(summary(pq, "parquet", "district"))


NASTY_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS id, CASE c_custkey % 6
        WHEN 0 THEN 'say "' || c_name || '", twice ""' WHEN 1 THEN 'two' || chr(10) || 'lines, and "' || chr(10) || '" a third'
        WHEN 2 THEN c_name || ',' || c_mktsegment WHEN 3 THEN '"' WHEN 4 THEN '王' || chr(92) || c_name ELSE c_name END AS note,
      c_acctbal AS number FROM {customer}"""


@register("csv_rows", NASTY_SQL.replace("{customer}", "customer"))
def q_csv_rows(spark, sf_dir):
    """SRC-1 / SNK-1: fields with quotes, commas, line feeds and backslashes
    through CSV and back, in two appended writes."""
    from hirelens.sinks.files import read_csv, write_csv
    rows = spark.sql(NASTY_SQL.replace("AS VARCHAR", "AS STRING"), customer=table(spark, sf_dir, "customer"))
    path = f"{unique_dir(spark, 'csv-rows')}/csv"
    half = F.col("id").cast("long") % 2 == 0
    write_csv(rows.where(half).withColumn("extra", F.lit(1)), path, ["id", "note", "number"])
    write_csv(rows.where(~half), path, ["id", "note", "number"], append=True)
    return read_csv(spark, path, StructType([StructField("id", StringType()), StructField("note", StringType()), StructField("number", DoubleType())]))


@register("result_documents", with_clean("""
    SELECT 'education' AS name, education AS label, count(*) AS n FROM clean GROUP BY education
    UNION ALL SELECT 'keyword', keyword, count(*) FROM clean GROUP BY keyword
    UNION ALL SELECT 'tier', city_tier, count(*) FROM clean GROUP BY city_tier"""))
def q_result_documents(spark, sf_dir):
    """SNK-9 / SRC-3: analysis results merged into one JSON folder and read
    back, and one (four city tiers at most) as a whole-file document over many
    lines; a missing folder or file gives no rows."""
    from hirelens.sinks.files import read_json, read_result_documents, write_result_documents, write_whole_document
    c = cleaned(spark, sf_dir)
    base = unique_dir(spark, "results")
    write_result_documents({k: c.groupBy(F.col(k).alias("label")).agg(F.count(F.lit(1)).alias("n")) for k in ("education", "keyword")}, f"{base}/merged")
    rows = read_result_documents(spark, f"{base}/merged").unionByName(read_result_documents(spark, f"{base}/missing"))
    r = F.from_json("row", "label STRING, n BIGINT")
    rows = rows.select("name", r["label"].alias("label"), r["n"].alias("n"))
    write_whole_document(c.groupBy(F.col("city_tier").alias("label")).agg(F.count(F.lit(1)).alias("n")), f"{base}/tiers")
    schema = StructType([StructField("label", StringType()), StructField("n", LongType())])
    for path in (f"{base}/tiers", f"{base}/no-tiers"):
        rows = rows.unionByName(read_json(spark, path, schema, multiline=True).withColumn("name", F.lit("tier")))
    return rows
