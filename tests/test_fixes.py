"""Cases that once gave wrong answers, and behaviour that no query compares."""

import csv

import pytest
from pyspark.sql import functions as F


def test_zero_bonus_months_give_no_salary(spark):
    from hirelens.functions.salary import with_salary
    rows = [("10-15万·0薪",), ("10-15万·13薪",), ("1-2万",)]
    got = [tuple(r) for r in with_salary(spark.createDataFrame(rows, "salary_text string")).select("salary_min", "salary_avg").collect()]
    assert got[0] == (None, None) and got[1][0] == 7692.0 and got[2][0] == 10000.0


def test_falsy_error_codes_are_passed_over(spark):
    from hirelens.operators.quality import api_error_code
    cases = {'{"code":0,"status":500}': "500", '{"code":"0","status":500}': "0", '{"code":false,"errno":7}': "7",
             '{"code":"","status":null,"errno":-1}': "-1", '{"code":0.0,"status":403}': "403", '{"a":1}': None, "no json": None, '{"code":"E1"}': "E1"}
    df = spark.createDataFrame([(k,) for k in cases], "body string")
    assert {r["body"]: r["c"] for r in df.select("body", api_error_code(F.col("body")).alias("c")).collect()} == cases


def test_csv_of_python_comes_back(spark, tmp_path):
    from hirelens.sinks.files import read_csv
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    rows = [("a", 'say "hi", twice', 1.5), ("b", "two\nlines\r\nand more", 2.0), ("c", "plain\\", 3.0)]
    with open(tmp_path / "x.csv", "w", newline="", encoding="utf-8-sig") as f:
        w = csv.writer(f)
        w.writerow(["id", "note", "n"])
        w.writerows(rows)
    schema = StructType([StructField("id", StringType()), StructField("note", StringType()), StructField("n", DoubleType())])
    got = sorted(tuple(r) for r in read_csv(spark, str(tmp_path / "x.csv"), schema).collect())
    assert [(a, b.replace("\r\n", "\n"), c) for a, b, c in got] == [(a, b.replace("\r\n", "\n"), c) for a, b, c in rows]


def test_numbers_in_details_are_plain(spark):
    from hirelens.operators.quality import _fmt_num
    df = spark.createDataFrame([(12000000.0,), (5000.0,), (0.5,), (-3.25,)], "x double")
    assert [r[0] for r in df.select(_fmt_num(F.col("x"))).collect()] == ["12000000.0", "5000.0", "0.5", "-3.25"]


def test_open_experience_ranges(spark):
    from hirelens.functions.text import open_experience_text
    df = spark.createDataFrame([(5.0, 999.0), (1.0, 3.0), (2.0, 0.0), (2.0, None)], "a double, b double")
    assert [r[0] for r in df.select(open_experience_text("a", "b")).collect()] == ["5.0年以上", "1.0-3.0年", "2.0年以上", "2.0年以上"]


def test_job_lists_are_found_by_path_order_and_depth(spark):
    from hirelens.sources.payload import find_job_list
    job = '[{"jobName":"x"}]'
    cases = [
        (f'{{"data":{job}}}', 5, job),
        (f'{{"data":{{"items":{job}}},"result":[1]}}', 5, job),
        (f'{{"data":[{{"jobTitle":"late"}}],"result":{{"list":{job}}}}}', 5, job),   # result comes before data
        ('{"data":[{"other":1}]}', 5, None), ('{"data":[]}', 5, None), ("[1,2]", 5, None), ("broken", 5, None), (None, 5, None),
        (job, 5, job),
        ('{"data":{"data":{"data":{"data":{"data":' + job + "}}}}}", 5, job),
        ('{"data":{"data":{"data":{"data":{"data":{"data":' + job + "}}}}}}", 5, None),
        ('{"data":{"data":' + job + "}}", 1, None),
    ]
    for doc, depth, want in cases:
        got = find_job_list(spark.createDataFrame([(doc,)], "payload string"), max_depth=depth).first()["list_json"]
        assert got == want, doc


def test_submitted_settings_win():
    import subprocess
    import sys
    code = ("from hirelens.session import get_spark; s = get_spark(); "
            "print('WIDTH', s.conf.get('spark.sql.shuffle.partitions'), s.sparkContext.master)")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=__file__.rsplit("/tests/", 1)[0],
                         env={**__import__("os").environ, "PYSPARK_SUBMIT_ARGS": "--conf spark.sql.shuffle.partitions=777 --master local[2] pyspark-shell"})
    assert "WIDTH 777 local[2]" in out.stdout, out.stderr[-500:]


def test_first_per_key_is_a_hash_aggregate(spark):
    from hirelens.sinks.store import upsert
    df = spark.createDataFrame([("a", 1, 0, "x"), ("a", 2, 0, "y"), (None, 1, 1, "z"), (None, 1, 3, "w")], "k string, _batch int, seq long, v string")
    out = upsert(None, df, "k")
    assert sorted((r["k"] or "", r["v"]) for r in out.collect()) == [("", "w"), ("a", "y")]
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- streams

def _commits(work):
    import os
    return len([x for x in os.listdir(f"{work}/checkpoint/commits") if x.isdigit()])


def test_streams_run_in_batches_and_resume(spark, tmp_path):
    from hirelens.plans.q_stream import stage_slices
    from hirelens.streaming.jobs import stream_dedup, stream_upsert
    rows = [(i, f"u{i % 37}" if i % 5 else None, f"t{i}") for i in range(400)] + [(None, "late", "n")]
    df = spark.createDataFrame(rows, "seq long, job_url string, salary_text string")
    whole, part = str(tmp_path / "whole"), str(tmp_path / "part")
    stage_slices(df, "seq", 4, f"{whole}/drops", 2)
    assert spark.read.parquet(f"{whole}/drops").count() == 401  # null places too
    full = stream_upsert(spark, f"{whole}/drops", df.schema, f"{whole}/work", 2)
    assert _commits(f"{whole}/work") >= 3
    want = sorted(map(str, full.collect()))
    stage_slices(df, "seq", 4, f"{part}/drops", 2, only=range(1))
    stream_upsert(spark, f"{part}/drops", df.schema, f"{part}/work", 2)  # ends after the first drop
    stage_slices(df, "seq", 4, f"{part}/drops", 2, only=range(1, 4))
    again = stream_upsert(spark, f"{part}/drops", df.schema, f"{part}/work", 2)  # a new start goes on there
    assert sorted(map(str, again.collect())) == want
    once = stream_dedup(spark, f"{whole}/drops", df.schema, f"{whole}/dedup", 2)
    assert _commits(f"{whole}/dedup") >= 3 and once.count() == 39


def test_late_events(spark, tmp_path):
    from hirelens.plans.q_stream import stage_slices
    from hirelens.streaming.jobs import stream_breaker, stream_weekly
    import datetime as dt
    t = lambda day, s=0: dt.datetime(2026, 1, 1) + dt.timedelta(days=day, seconds=s)
    rows = [(i, t(i // 10, i), 7, "error" if i % 10 < 4 else "view") for i in range(120)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string")
    drops, work = str(tmp_path / "drops"), str(tmp_path / "work")
    stage_slices(df, "ts", 3, drops, 1)
    stream_breaker(spark, drops, df.schema, f"{work}/b", 1)
    stream_weekly(spark, drops, df.schema, f"{work}/w", 1)
    late = spark.createDataFrame([(500, t(0, 3), 7, "error")], df.schema)
    late.write.mode("append").parquet(drops)
    b = stream_breaker(spark, drops, df.schema, f"{work}/b", 1).first()
    assert (b["n_events"], b["n_failures"], b["max_streak"], b["breaker_trips"]) == (121, 49, 5, 12)  # it takes its place in its run
    weeks = {r["week_start"]: r["count"] for r in stream_weekly(spark, drops, df.schema, f"{work}/w", 1).collect()}
    assert sum(weeks.values()) == 120  # and the watermark drops it


@pytest.mark.parametrize("cap", [None, 3])
def test_tfidf_vocabulary_is_all_terms_unless_capped(spark, cap):
    from hirelens.ml.tfidf import tfidf, weight_rows
    docs = spark.createDataFrame([(i, " ".join(["aa", "bb" if i % 2 else "cc", f"dd{i % 3}", "ee" if i % 4 == 0 else "ff"])) for i in range(12)],
                                 "seq long, text string")
    w = weight_rows(tfidf(docs, max_features=cap)).collect()
    assert len({r["idx"] for r in w}) == (3 if cap else max(r["idx"] for r in w) + 1)
    norm = {}
    for r in w:
        norm[r["seq"]] = norm.get(r["seq"], 0) + r["weight"] ** 2
    assert all(abs(v - 1) < 1e-9 for v in norm.values())


def test_terms_are_counted_and_looked_up_by_batches(spark):
    from hirelens.ml.tfidf import term_counts, tfidf
    docs = spark.createDataFrame([(1, "Ab cd ab cd x"), (2, ""), (3, None), (4, "cd")], "seq long, text string")
    tf = {r["seq"]: r["tf"] and [tuple(t) for t in r["tf"]] for r in term_counts(docs).collect()}
    assert tf == {1: [("ab", 2), ("cd", 2), ("ab cd", 2), ("cd ab", 1)], 2: [], 3: None, 4: [("cd", 1)]}
    plan = tfidf(docs)._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "element_at" not in plan  # which walks through the map's keys


def test_quantiles_equal_percentile(spark):
    from hirelens.operators.quantiles import quantiles
    import random
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *(float(x) for x in range(9))])) for _ in range(300)] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    want = {r["g"]: (r["p"], r["q"]) for r in df.groupBy("g").agg(F.percentile("x", F.lit(0.5)).alias("p"), F.percentile("x", F.lit(0.27)).alias("q")).collect()}
    got = {r["g"]: (r["p"], r["q"]) for r in quantiles(df, ["g"], {"p": ("x", 0.5), "q": ("x", 0.27)}).collect()}
    assert got == {g: v for g, v in want.items() if v[0] is not None}
