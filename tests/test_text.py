"""City / education / experience / date / tag normalizers against hand-made tables."""

import datetime

import pytest
from pyspark.sql import functions as F


def _one(spark, values, fn, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_city(spark):
    from hirelens.functions.text import with_city
    rows = [("北京朝阳区", "北京", "朝阳区"), ("上海市", "上海", None), ("深圳-南山区", "深圳", "南山区"),
            ("广州·天河区", "广州", "天河区"), ("珠海", "珠海", None), (" 杭州市西湖区 ", "杭州", "西湖区"),
            ("石家庄长安区", "石家庄", "长安区"), ("广东省广州市", "广州", "广东省"), (None, None, None), ("", None, None)]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, city string")
    got = {r.i: (r.city, r.district) for r in with_city(df).collect()}
    for i, (_raw, c, d) in enumerate(rows):
        assert got[i] == (c, d), rows[i]


def test_education_first_match(spark):
    from hirelens.functions.text import normalize_education
    vals = ["学历不限", "大专及以上", "本科", "硕士及以上", "博士", "中专", "高中", "初中及以下", "MBA ", None, ""]
    exp = ["不限", "大专", "本科", "硕士", "博士", "大专", "大专", "不限", "MBA", "不限", "不限"]
    assert _one(spark, vals, normalize_education) == exp


def test_experience_and_cap(spark):
    from hirelens.functions.text import clean_experience
    vals = ["经验不限", "1-3年", "3-5年经验", "5年及以上", "1年以下", "在校/应届", None, "10年以上", "无需经验"]
    exp = [(0, 0), (1, 3), (3, 5), (5, 5), (1, 1), (0, 0), (0, 0), (10, 10), (0, 0)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, experience string")
    got = {r.i: (r.exp_min, r.exp_max) for r in clean_experience(df).collect()}
    assert [got[i] for i in range(len(vals))] == [(float(a), float(b)) for a, b in exp]


def test_dates(spark):
    from hirelens.functions.text import normalize_date
    vals = ["2024-01-05", "2024/01/05", "2024-01-05 08:00:00", "bad-date", None, "2024-1-5"]
    exp = [datetime.date(2024, 1, 5)] * 3 + [None, None, datetime.date(2024, 1, 5)]
    assert _one(spark, vals, normalize_date) == exp


def test_week_label_monday(spark):
    from hirelens.functions.text import week_label
    df = spark.createDataFrame([(datetime.date(2024, 1, 7),)], "d date")  # a Sunday
    assert df.select(week_label("d")).first()[0] == "2024-01-01/2024-01-07"


def test_tags_alias_case_sensitive(spark):
    from hirelens.functions.skills import normalize_tag_array
    from hirelens.functions.text import split_tags
    got = _one(spark, ["K8s, Python, sql, 五险一金, Spark, spark, Golang , Python3"],
               lambda c: F.array_join(normalize_tag_array(split_tags(c)), ", "))
    assert got == ["Go, Kubernetes, Python, Spark, spark, sql, 五险一金"]


def test_skill_regex_traps(spark):
    from hirelens.functions.skills import regex_skills
    got = _one(spark, ["Senior Developer", "Django dev", "JavaScript", "R语言", "R, SQL"],
               lambda c: F.array_join(regex_skills(c), "|"))
    # trailing r of Senior and of Developer match R; Go inside Django; Java wins over JavaScript;
    # R followed by a CJK letter is not a word end; R before a comma is
    assert got == ["r|r", "go", "Java", "", "R|SQL"]


def test_split_area_and_count_text(spark):
    from hirelens.functions.text import count_text_value, split_area
    df = spark.createDataFrame([("广州·天河区", "12.3万"), ("深圳", "456"), (None, "x")], "a string, t string")
    rows = df.select(split_area("a").alias("s"), count_text_value("t").alias("v")).collect()
    assert [(r.s.city, r.s.district, r.v) for r in rows] == [("广州", "天河区", 123000.0), ("深圳", "", 456.0),
                                                            ("", "", None)]


@pytest.mark.parametrize("text,ok", [("15k-20k 8千-1万 something", True), ("nothing here", False),
                                     ("滑块 15k 20k", False)])
def test_page_has_jobs(spark, text, ok):
    from hirelens.operators.quality import page_has_jobs
    assert _one(spark, [text], page_has_jobs) == [ok]
