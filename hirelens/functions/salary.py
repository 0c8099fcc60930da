"""Salary text -> monthly (min, max, avg) as native column expressions.

The grammar (one pass, no Python per row):

1. strip; blank or negotiable text gives nulls;
2. every ``number [unit]`` token, unit one of 万 千 k K 元 /;
3. a token whose *first* occurrence of ``number+unit`` in the text has 薪
   within two characters on either side is a bonus count and is dropped;
4. a token without unit borrows the next unit to its right, else the
   nearest one to its left;
5. 万 x10000, 千/k x1000, 元 x1; otherwise guess from the whole text
   (contains 万 and n < 100 -> x10000, contains 千 and n < 100 -> x1000);
6. min/max of the first two values;
7. period: 天/日 -> x21.75, 时 -> x8x21.75, 年 (without 经验/工作 and
   without N薪) -> /12, N薪 with max > 80000 and no 千/k unit -> /N;
8. half-to-even rounding (``bround``, MTH-4) everywhere a rounding happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import dims

TOKEN_RE = r"([0-9]+(?:\.[0-9]+)?)\s*([万千kK元/]?)"
BONUS_RE = r"([0-9]+)\s*薪"


# Characters Python's str.strip() removes (whitespace incl. the common Unicode spaces).
PY_WHITESPACE = (" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003"
                 "\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def py_strip(c: Column) -> Column:
    """Strip leading/trailing whitespace like ``str.strip`` (no regex)."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def _contains_any(text: Column, words) -> Column:
    cond = F.lit(False)
    for w in words:
        cond = cond | text.contains(w)
    return cond


def _to_monthly(num: Column, unit: Column, text: Column) -> Column:
    u = F.lower(unit)
    return (F.when(u == "万", num * 10000)
            .when((u == "千") | (u == "k"), num * 1000)
            .when(u == "元", num)
            .when(text.contains("万") & (num < 100), num * 10000)
            .when(text.contains("千") & (num < 100), num * 1000)
            .otherwise(num))


def with_salary(df: DataFrame, text_col: str = "salary_text") -> DataFrame:
    """Add ``salary_min``, ``salary_max``, ``salary_avg`` parsed from ``text_col``.

    Staged projections keep every intermediate (token array, kept tokens,
    monthly values) an attribute, so nothing is recomputed inside the
    per-element lambdas and the whole chain stays in one codegen stage.
    """
    text = F.col("_sal_text")
    df = df.withColumn("_sal_text", py_strip(F.col(text_col)))
    pairs = F.zip_with(F.regexp_extract_all(text, F.lit(TOKEN_RE), 1),
                       F.regexp_extract_all(text, F.lit(TOKEN_RE), 2),
                       lambda n, u: F.struct(n.alias("n"), u.alias("u")))

    def near_bonus(p):
        token = F.concat(p["n"], p["u"])
        pos0 = F.instr(text, token) - 1          # 0-based, -1 when absent
        start0 = F.greatest(pos0 - 2, F.lit(0))
        end0 = pos0 + F.length(token) + 2
        window = F.substring(text, start0 + 1, end0 - start0)
        return (pos0 >= 0) & window.contains("薪")

    df = df.withColumn("_sal_kept", F.filter(pairs, lambda p: ~near_bonus(p)))
    kept = F.col("_sal_kept")
    # units with blanks as null, and the numbers: two linear passes
    df = df.withColumns({"_sal_u": F.transform(kept, lambda p: F.nullif(p["u"], F.lit(""))),
                         "_sal_n": F.transform(kept, lambda p: p["n"].cast("double"))})
    u, n = F.col("_sal_u"), F.col("_sal_n")

    def first_unit(start):
        # first non-blank unit at positions >= start (1-based), via array_compact: no lambda
        return F.try_element_at(F.array_compact(F.slice(u, start, F.greatest(F.size(u) - start + 1, F.lit(0)))),
                                F.lit(1))

    # only the first two values matter: unit = own, else next to the right, else previous
    u1 = F.coalesce(F.try_element_at(u, F.lit(1)), first_unit(2), F.lit(""))
    u2 = F.coalesce(F.try_element_at(u, F.lit(2)), first_unit(3), F.try_element_at(u, F.lit(1)), F.lit(""))
    m1 = _to_monthly(F.try_element_at(n, F.lit(1)), u1, text)
    m2 = _to_monthly(F.try_element_at(n, F.lit(2)), u2, text)
    df = df.withColumn("_sal_vals", F.array_compact(F.array(m1, m2)))
    vals = F.col("_sal_vals")
    df = df.withColumns({
        "_sal_lo": F.array_min(vals),
        "_sal_hi": F.array_max(vals),
        "_sal_mu": F.arrays_overlap(F.array_compact(u), F.array(F.lit("千"), F.lit("k"), F.lit("K"))),
        "_sal_bonus": F.regexp_extract(text, BONUS_RE, 1),
        "_sal_invalid": (F.col(text_col).isNull() | (text == "")
                         | _contains_any(text, dims.SALARY_NEGOTIABLE_WORDS) | (F.size(kept) == 0)),
    })
    # Period conversion as one multiplier/divisor pair (null divisor = monthly
    # already): x*21.75/1 == x*21.75, x*174/1 == x*8*21.75 (x*8 is exact),
    # x*1/12 == x/12, x*1/N == x/N, so results equal the step-by-step form.
    daily = text.contains("天") | text.contains("日")
    hourly = text.contains("时")
    annual = text.contains("年") & ~text.contains("经验") & ~text.contains("工作")
    has_bonus = F.col("_sal_bonus") != ""
    bonus_annual = has_bonus & (F.col("_sal_hi") > dims.BONUS_ANNUAL_THRESHOLD) & ~F.col("_sal_mu")
    day = dims.WORKDAYS_PER_MONTH
    # a yearly amount over zero months has no monthly value: the row yields null
    no_months = bonus_annual & ~(daily | hourly) & (F.col("_sal_bonus").try_cast("double") == 0)
    df = df.withColumns({
        "_sal_invalid": F.col("_sal_invalid") | F.coalesce(no_months, F.lit(False)),
        "_sal_m": F.when(daily, F.lit(day)).when(hourly, F.lit(day * dims.HOURS_PER_DAY)).otherwise(F.lit(1.0)),
        "_sal_d": (F.when(daily | hourly, F.lit(1.0)).when(annual & ~has_bonus, F.lit(12.0))
                   .when(bonus_annual, F.nullif(F.col("_sal_bonus").try_cast("double"), F.lit(0.0)))),
    })

    def period(x):
        return F.when(F.col("_sal_d").isNull(), x).otherwise(
            F.bround(x * F.col("_sal_m") / F.col("_sal_d"), 0))

    null = F.lit(None).cast("double")
    ok = ~F.col("_sal_invalid")
    df = df.withColumns({"_sal_plo": F.when(ok, period(F.col("_sal_lo"))).otherwise(null),
                         "_sal_phi": F.when(ok, period(F.col("_sal_hi"))).otherwise(null)})
    lo, hi = F.col("_sal_plo"), F.col("_sal_phi")
    tmp = ["_sal_text", "_sal_kept", "_sal_u", "_sal_n", "_sal_vals", "_sal_lo", "_sal_hi", "_sal_mu", "_sal_bonus",
           "_sal_invalid", "_sal_m", "_sal_d", "_sal_plo", "_sal_phi"]
    out = F.struct(F.bround(lo, 0).alias("salary_min"), F.bround(hi, 0).alias("salary_max"),
                   F.bround((lo + hi) / 2, 0).alias("salary_avg"))
    keep = [c for c in df.columns if c not in tmp and c not in ("salary_min", "salary_max", "salary_avg")]
    # The results leave through a one-row generator: Catalyst can neither push
    # a later filter on them below it nor collapse later projections into the
    # parse, so the parse expressions are evaluated exactly once per row.
    return df.select(*keep, F.inline_outer(F.array(out)))


def is_negotiable(col) -> Column:
    """FLT-12: the text marks a negotiable salary."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.contains(dims.NEGOTIABLE_MARK) | c.contains("open"), F.lit(False))
