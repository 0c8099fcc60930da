"""Skill tag extraction and normalization (STR-7..STR-11, JON-2, SET-2, SET-3).

Tags live as ``array<string>`` inside the pipeline and are joined with
``", "`` only at the sink, matching the stored text form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens import dims
from hirelens.functions.text import _c, lit_map

# Java regex: "R" must not be followed by a Unicode word character
# (Python's \b semantics on str, which treats CJK as word characters).
_R_END = r"(?![\p{L}\p{N}_])"
# A lookahead on the possible first characters lets the matcher skip every
# position where no alternative can start (same matches, fewer attempts).
_FIRST = sorted({w[0].lower() for w in dims.SKILL_REGEX_WORDS})
SKILL_REGEX = ("(?i)(?=[" + "".join(_FIRST) + "])("
               + "|".join(w.replace("<END>", _R_END) for w in dims.SKILL_REGEX_WORDS) + ")")


def regex_skills(text) -> Column:
    """STR-7: every leftmost-first match of the skill pattern, as written."""
    return F.transform(F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(SKILL_REGEX), 1),
                       lambda m: F.trim(m))


def dict_skills(low) -> Column:
    """STR-8: dictionary entries (length > 1) contained case-insensitively in
    an already lower-cased text column.

    One ``CASE`` per word inside an array (codegen'd) with nulls dropped; the
    lower-casing happens once, in its own column, not once per word."""
    low = _c(low)
    words = [w for w in dims.SKILL_DICT if len(w) > 1]
    return F.array_compact(F.array(*[F.when(low.contains(w.lower()), F.lit(w)) for w in words]))


class GramIndex:
    """A dictionary indexed by character n-grams: each word under the one of its
    grams that fewest words have. A text's grams are looked up and only the
    words found so are searched in it, so the cost is the text's length,
    whatever the size of the dictionary."""

    def __init__(self, words: list[str]):
        self.words = [w for w in dict.fromkeys(words) if w]
        low = [w.lower() for w in self.words]
        self.n = min((len(w) for w in low), default=1)
        grams = [{w[i:i + self.n] for i in range(len(w) - self.n + 1)} for w in low]
        held: dict[str, int] = {}
        for g in grams:
            for x in g:
                held[x] = held.get(x, 0) + 1
        self.index: dict[str, list[tuple[int, str]]] = {}
        for at, (w, g) in enumerate(zip(low, grams)):
            self.index.setdefault(min(g, key=lambda x: (held[x], x)), []).append((at, w))

    def find(self, low: str) -> list[str]:
        """The words (as written in the dictionary, in its order) that a
        lower-cased text contains."""
        index, n = self.index, self.n
        grams = {low[i:i + n] for i in range(len(low) - n + 1)}
        return [self.words[at] for at in sorted(at for g in grams if g in index for at, w in index[g] if w in low)]


def with_dictionary_hits(df: DataFrame, low: str, out: str, words: list[str] | None = None) -> DataFrame:
    """STR-8 / JON-10 on long texts and large dictionaries: ``df`` with the
    array ``out`` of dictionary words (length > 1) that the lower-cased text
    column ``low`` contains; null for a null text. One pass, no shuffle."""
    import pyarrow as pa
    index = GramIndex([w for w in (dims.SKILL_DICT if words is None else words) if len(w) > 1])
    at = df.columns.index(low)

    def find(batches):
        for batch in batches:
            hits = [None if not t.is_valid else index.find(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, pa.list_(pa.string()))], names=[*batch.schema.names, out])
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType
    return df.mapInArrow(find, StructType([*df.schema.fields, StructField(out, ArrayType(StringType()))]))


def keyword_skills(keyword) -> Column:
    """STR-9: core skills implied by the search keyword."""
    k = F.coalesce(_c(keyword), F.lit(""))
    out = F.array().cast("array<string>")
    for word, skills in dims.KEYWORD_SKILLS:
        out = F.array_union(out, F.when(k.contains(word), F.array(*[F.lit(s) for s in skills]))
                            .otherwise(F.array().cast("array<string>")))
    return out


def with_extracted_skills(df: DataFrame, title: str, industry: str, keyword: str,
                          out: str = "extracted", only_when=None) -> DataFrame:
    """SET-3: regex hits + dictionary hits + keyword rules over
    ``title industry keyword`` as a new array column ``out``.

    ``only_when`` (a boolean column) limits the work to the rows that need it.
    """
    text = F.concat_ws(" ", F.coalesce(F.col(title), F.lit("")), F.coalesce(F.col(industry), F.lit("")),
                       F.coalesce(F.col(keyword), F.lit("")))
    cond = only_when if only_when is not None else F.lit(True)
    df = df.withColumn("_sk_text", F.when(cond, text))
    df = df.withColumn("_sk_low", F.lower("_sk_text"))
    arr = F.array_distinct(F.concat(regex_skills("_sk_text"), dict_skills("_sk_low"), keyword_skills(keyword)))
    return df.withColumn(out, F.when(cond, arr)).drop("_sk_text", "_sk_low")


def alias_tags(tags) -> Column:
    """JON-2: exact, case-sensitive alias lookup per element."""
    m = lit_map(dims.SKILL_ALIAS)
    return F.transform(_c(tags), lambda t: F.coalesce(F.try_element_at(m, t), t))


def normalize_tag_array(tags) -> Column:
    """SET-2: alias, strip, drop blanks, distinct, sort (binary order)."""
    aliased = F.filter(F.transform(alias_tags(tags), F.trim), lambda x: x != "")
    return F.sort_array(F.array_distinct(aliased))


def normalize_tag_text(text) -> Column:
    """STR-10 for a comma-separated tag string in two array passes: split,
    strip + alias per item, drop blanks; then distinct and sort. (Alias
    values have no surrounding blanks or commas, so the original's second
    split/strip pass is the identity.)"""
    from hirelens.functions.salary import py_strip
    m = lit_map(dims.SKILL_ALIAS)

    def one(x):
        t = py_strip(x)
        return F.coalesce(F.try_element_at(m, t), t)
    items = F.filter(F.transform(F.split(F.coalesce(_c(text), F.lit("")), ","), one), lambda x: x != "")
    return F.sort_array(F.array_distinct(items))


def is_blank_tags(col) -> Column:
    c = _c(col)
    return c.isNull() | c.isin(*dims.BLANK_TAG_MARKERS)


def clean_tags(tags, extracted) -> Column:
    """STR-10: the cleaned tag array.

    Given tags (not null / '' / 'nan' / '无') are split, aliased, de-duplicated
    and sorted. Blank tags are replaced by the extracted skills; when nothing
    is extracted the value stays missing (null array).
    """
    given = normalize_tag_text(tags)
    ext = normalize_tag_array(_c(extracted))
    return F.when(~is_blank_tags(tags), given).when(F.size(ext) > 0, ext)


def tags_text(arr) -> Column:
    """Array -> stored text form ``a, b, c``."""
    return F.array_join(_c(arr), ", ")

