"""Column -> Column normalizers for posting fields (STR-2..6, STR-10..15, DAT-*, MTH-*, ARR-*).

All of them are built-in expressions (CASE, regexp, higher-order array
functions) so they run inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.functions.salary import py_strip


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lit_map(d: dict) -> Column:
    """A literal ``map<string,string>`` (folded to a constant by Catalyst)."""
    kv = []
    for k, v in d.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def map_or_default(col, d: dict, default=None) -> Column:
    """MAP-1 / JON-1 for a small literal dictionary: lookup with default."""
    c = _c(col)
    hit = F.try_element_at(lit_map(d), c)
    if default is None:
        return hit
    if isinstance(default, Column):
        return F.coalesce(hit, default)
    return F.coalesce(hit, F.lit(default))


# ----------------------------------------------------------------- STR-2, STR-6
def with_city(df: DataFrame, city_col: str = "city", out_city: str = "city",
              out_district: str = "district") -> DataFrame:
    """Normalize city text into (city, district) (STR-2).

    Full names (``X市``) match anywhere in alias order and the district is
    the rest of the text; otherwise short names match as a prefix (longest
    first) and the district is the remainder without leading ``-``/``·``;
    unknown cities pass through stripped with an empty district.
    Blank input gives a null city (filled with 未知 later by the cleaner).
    """
    t = F.col("_city_t")
    df = df.withColumn("_city_t", py_strip(F.col(city_col)))
    order = {s: i for i, (_, s) in enumerate(dims.CITY_ALIAS)}
    shorts = sorted({s for _, s in dims.CITY_ALIAS}, key=lambda s: (-len(s), order[s]))
    # first matching entry found by a codegen'd CASE returning only its index
    full_idx = None
    for i, (f, _s) in enumerate(dims.CITY_ALIAS):
        full_idx = F.when(t.contains(f), F.lit(i + 1)) if full_idx is None else full_idx.when(t.contains(f), F.lit(i + 1))
    short_idx = None
    for i, sh in enumerate(shorts):
        short_idx = (F.when(t.startswith(sh), F.lit(i + 1)) if short_idx is None
                     else short_idx.when(t.startswith(sh), F.lit(i + 1)))
    fulls = F.array(*[F.struct(F.lit(f).alias("full"), F.lit(s).alias("short")) for f, s in dims.CITY_ALIAS])
    short_arr = F.array(*[F.lit(s) for s in shorts])
    df = df.withColumns({
        "_city_full": F.try_element_at(fulls, full_idx),
        "_city_short": F.try_element_at(short_arr, short_idx)})
    full, short = F.col("_city_full"), F.col("_city_short")
    rest = F.substring(t, F.length(short) + 1, F.length(t))
    rest = F.regexp_replace(F.regexp_replace(py_strip(rest), "^-+", ""), "^·+", "")
    city = F.when(full.isNotNull(), full["short"]).when(short.isNotNull(), short).otherwise(t)
    district = (F.when(full.isNotNull(), py_strip(F.replace(t, full["full"], F.lit(""))))
                 .when(short.isNotNull(), rest).otherwise(F.lit("")))
    blank = F.col(city_col).isNull() | (F.col(city_col) == "")
    out = F.struct(F.when(blank, F.lit(None)).otherwise(city).alias(out_city),
                   F.when(blank, F.lit(None)).otherwise(F.nullif(district, F.lit(""))).alias(out_district))
    keep = [c for c in df.columns if c not in ("_city_t", "_city_full", "_city_short", out_city, out_district)]
    # results leave through a one-row generator so later filters on the city
    # are not pushed down and expanded into the matching expressions
    return df.select(*keep, F.inline_outer(F.array(out)))


def split_area(col) -> Column:
    """STR-6: ``广州·天河区`` -> struct(city, district) on ``·`` or ``-``;
    blank input -> ('', ''), no separator -> district ''."""
    c = _c(col)
    parts = F.split(F.regexp_replace(F.coalesce(c, F.lit("")), "·", "-"), "-")
    return F.struct(py_strip(F.try_element_at(parts, F.lit(1))).alias("city"),
                    F.coalesce(py_strip(F.try_element_at(parts, F.lit(2))), F.lit("")).alias("district"))


def city_tier(col) -> Column:
    return map_or_default(col, dims.CITY_TIER, dims.TIER_OTHER)


def province(col) -> Column:
    c = _c(col)
    return map_or_default(c, dims.CITY_TO_PROVINCE, c)


# ----------------------------------------------------------------------- STR-3
def normalize_education(col) -> Column:
    """First dictionary key contained in the text wins; else strip; blank -> 不限."""
    c = _c(col)
    out = None
    for key, val in dims.EDUCATION_MAP:
        out = F.when(c.contains(key), F.lit(val)) if out is None else out.when(c.contains(key), F.lit(val))
    out = out.otherwise(py_strip(c))
    return F.when(c.isNull() | (c == ""), F.lit("不限")).otherwise(out)


# ----------------------------------------------------------------- STR-4, STR-5
NUM_RE = r"([0-9]+(?:\.[0-9]+)?)"


def parse_experience(col) -> Column:
    """struct(exp_min, exp_max): 不限/应届/在校/无需 -> 0,0; N以上 -> N,999;
    two numbers -> both; one -> twice; none -> 0,0."""
    c = _c(col)
    t = py_strip(c)
    nums = F.regexp_extract_all(t, F.lit(NUM_RE), 1)
    n1 = F.try_element_at(nums, F.lit(1)).cast("double")
    n2 = F.try_element_at(nums, F.lit(2)).cast("double")
    none = F.lit(False)
    for w in dims.EXP_NONE_WORDS:
        none = none | t.contains(w)
    zero = F.lit(0.0)
    blank = c.isNull() | (t == "")
    lo = (F.when(blank | none, zero).when(n1.isNotNull(), n1).otherwise(zero))
    hi = (F.when(blank | none, zero)
          .when(t.contains(dims.EXP_OPEN_WORD) & n1.isNotNull(), F.lit(dims.EXP_OPEN_MAX))
          .when(n2.isNotNull(), n2).when(n1.isNotNull(), n1).otherwise(zero))
    return F.struct(lo.alias("exp_min"), hi.alias("exp_max"))


def clean_experience(df: DataFrame, text_col: str = "experience") -> DataFrame:
    """STR-5: keep given (exp_min, exp_max) when both set and (min > 0 or the
    text is 经验不限), else parse the text (blank -> 0,0); then a max above 30
    (the open-ended 999 marker) collapses to the min.

    The stripped text and its numbers are staged as columns so each is
    computed once per row."""
    raw = F.col(text_col)
    df = df.withColumn("_exp_t", py_strip(raw))
    t = F.col("_exp_t")
    df = df.withColumn("_exp_n", F.regexp_extract_all(t, F.lit(NUM_RE), 1))
    n1 = F.try_element_at(F.col("_exp_n"), F.lit(1)).cast("double")
    n2 = F.try_element_at(F.col("_exp_n"), F.lit(2)).cast("double")
    none = F.lit(False)
    for w in dims.EXP_NONE_WORDS:
        none = none | t.contains(w)
    zero = F.lit(0.0)
    blank = raw.isNull() | (raw == "") | (t == "")
    p_lo = F.when(blank | none, zero).when(n1.isNotNull(), n1).otherwise(zero)
    p_hi = (F.when(blank | none, zero)
            .when(t.contains(dims.EXP_OPEN_WORD) & n1.isNotNull(), F.lit(dims.EXP_OPEN_MAX))
            .when(n2.isNotNull(), n2).when(n1.isNotNull(), n1).otherwise(zero))
    if "exp_min" in df.columns and "exp_max" in df.columns:
        keep = (F.col("exp_min").isNotNull() & F.col("exp_max").isNotNull()
                & ((F.col("exp_min") > 0) | (F.coalesce(raw, F.lit("")) == "经验不限")))
        p_lo = F.when(keep, F.col("exp_min")).otherwise(p_lo)
        p_hi = F.when(keep, F.col("exp_max")).otherwise(p_hi)
    df = df.withColumns({"exp_min": p_lo.cast("double"), "exp_max": p_hi.cast("double")})
    return df.withColumn("exp_max", F.when(F.col("exp_max") > dims.EXP_CAP, F.col("exp_min"))
                         .otherwise(F.col("exp_max"))).drop("_exp_t", "_exp_n")


def experience_text(emin, emax) -> Column:
    """PRJ-7: ``min-max年`` when max is set, else ``min年``."""
    lo, hi = _c(emin), _c(emax)
    fmt = lambda x: F.format_string("%.1f", x)  # noqa: E731  (Python prints floats as 3.0)
    return F.when(hi.isNotNull() & (hi != 0),
                  F.concat(fmt(lo), F.lit("-"), fmt(hi), F.lit("年"))).otherwise(F.concat(fmt(lo), F.lit("年")))


def open_experience_text(emin, emax, open_from: int = 999) -> Column:
    """PRJ-4: ``min-max年``, or ``min年以上`` without a maximum or with one of
    ``open_from`` or more (which stands for no upper end)."""
    lo, hi = _c(emin), _c(emax)
    fmt = lambda x: F.format_string("%.1f", x)
    closed = hi.isNotNull() & (hi != 0) & (hi < open_from)
    return F.when(closed, F.concat(fmt(lo), F.lit("-"), fmt(hi), F.lit("年"))).otherwise(F.concat(fmt(lo), F.lit("年以上")))


# ----------------------------------------------------------------- DAT-1..DAT-5
def normalize_date(col) -> Column:
    """DAT-1: first 10 characters as ``y-M-d`` or ``y/M/d``; null when neither parses."""
    head = F.substring(_c(col), 1, 10)
    return F.coalesce(F.try_to_date(head, "yyyy-M-d"),
                      F.try_to_date(head, "yyyy/M/d"))


def week_label(date_col) -> Column:
    """DAT-2: Monday..Sunday week as ``start/end``."""
    start = F.to_date(F.date_trunc("week", _c(date_col)))
    return F.concat_ws("/", start.cast("string"), F.date_add(start, 6).cast("string"))


# ------------------------------------------------------------------ ARR-1, MTH-2
def split_tags(col) -> Column:
    """``a, b ,c`` -> array of stripped non-empty items."""
    return F.filter(F.transform(F.split(F.coalesce(_c(col), F.lit("")), ","), py_strip),
                    lambda x: x != "")


def tag_count(col) -> Column:
    """ARR-1: number of non-blank comma items (null / 'nan' -> 0)."""
    c = _c(col)
    return F.when(c.isNull() | (c == "nan"), F.lit(0)).otherwise(F.size(split_tags(c)))


def row_mean(*cols) -> Column:
    """MTH-2: mean of the non-null arguments (null when all are null)."""
    s = F.lit(0.0)
    n = F.lit(0)
    for c in cols:
        c = _c(c)
        s = s + F.coalesce(c, F.lit(0.0))
        n = n + F.when(c.isNotNull(), 1).otherwise(0)
    return F.when(n > 0, s / n)


def bin_label(col, bins) -> Column:
    """MTH-7 / JON-8: left-closed [lo, hi) bins; outside -> null."""
    c = _c(col)
    out = None
    for lo, hi, label in bins:
        cond = (c >= lo) & (c < hi)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def bin_order(col, bins) -> Column:
    c = _c(col)
    out = None
    for i, (lo, hi, _label) in enumerate(bins):
        cond = (c >= lo) & (c < hi)
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


# ------------------------------------------------------------------------ STR-15
def count_text_value(col) -> Column:
    """``12.3万`` -> 123000, ``456`` -> 456; other text -> null."""
    c = py_strip(_c(col))
    num = F.regexp_extract(c, r"^([0-9]+(?:\.[0-9]+)?)(万?)$", 1)
    wan = F.regexp_extract(c, r"^([0-9]+(?:\.[0-9]+)?)(万?)$", 2)
    v = F.when(num != "", num.try_cast("double"))
    return F.when(wan == "万", F.bround(v * 10000, 0)).otherwise(v)


def last_counts(text, *known) -> Column:
    """STR-15: (plays, comments) of a video card's text: its last two lines that
    are not blank and are none of ``known`` (title, author, label); with one such
    line comments are empty, with none both."""
    lines = F.filter(F.transform(F.split(F.coalesce(_c(text), F.lit("")), "\n"), py_strip), lambda x: x != "")
    if known:
        others = F.array(*[_c(k) for k in known])
        lines = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(others, x), F.lit(False)))
    n = F.size(lines)
    last = F.try_element_at(lines, F.lit(-1))
    return F.struct(F.coalesce(F.when(n >= 2, F.try_element_at(lines, F.lit(-2))).otherwise(last), F.lit("")).alias("plays"),
                    F.coalesce(F.when(n >= 2, last), F.lit("")).alias("comments"))
