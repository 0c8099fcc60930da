r"""License scans by canonical digests, in DataFrame operations only.

A text is brought to a canonical form: lower case, without copyright lines,
every run of characters other than letters and digits as one space, equivalent
spellings as one word. Its digest is then looked up among those of the known
licences by a hash join, for the entire text and for every line of it.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm.common import written
from hirelens.llm.license_texts import EQUIVALENT, KNOWN

#: known digests are broadcast up to this many rows (about 100 bytes each)
BROADCAST_ROWS = 200_000

#: a line that opens with a copyright mark and names a year or repeats the
#: mark, and a line that only reserves all rights
COPYRIGHT_LINE = (r"(?m)^[^\p{L}\p{N}\n]*(?:(?:copyright|©)[^\n]*(?:(?:19|20)[0-9]{2}|©|\(c\))[^\n]*"
                  r"|(?:\(c\)|©)[^\n]*|all rights reserved[^\p{L}\p{N}\n]*)$")
#: with ``any_holder``: also a short line that names a holder and no year
HOLDER_LINE = r"(?m)^[^\p{L}\p{N}\n]*copyright[^\n]{0,80}$"
OTHER = r"[^\p{L}\p{N}\n]+"


def canonical_lines(text: Column, any_holder: bool = False) -> Column:
    """The canonical form of every line that has a letter or digit left, as
    an array; null texts give null."""
    low = F.lower(text)
    marked = F.contains(low, F.lit("copyright")) | F.contains(low, F.lit("(c)")) | F.contains(low, F.lit("©")) \
        | F.contains(low, F.lit("all rights reserved"))
    bare = F.regexp_replace(low, COPYRIGHT_LINE, "")
    if any_holder:
        bare = F.regexp_replace(bare, HOLDER_LINE, "")
    bare = F.when(marked, bare).otherwise(low)
    lines = F.split(F.regexp_replace(bare, OTHER, " "), "\n")
    same = F.create_map(*[F.lit(x) for pair in EQUIVALENT.items() for x in pair])

    def word(w: Column) -> Column:
        return F.when(w.isin(*EQUIVALENT), same[w]).otherwise(w)

    def line(x: Column) -> Column:
        return F.array_join(F.transform(F.split(F.trim(x), " "), word), " ")

    return F.filter(F.transform(lines, line), lambda x: x != "")


def known_licenses(spark: SparkSession) -> DataFrame:
    """(license, text) of the built-in list."""
    names, texts = zip(*KNOWN)
    return spark.createDataFrame(pa.table({"license": names, "text": texts}))


def scan(docs: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
         any_holder: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, digest (SHA-256 of the canonical text, null
    for a null text), license (that of the known text with this digest, else
    null) and line_licenses (the licences that single lines equal, in order,
    joined by commas; empty if none).

    ``known``: (license, text) rows, of any number; of several licences with
    the same canonical text the first by name counts; texts without a letter
    or digit are not looked up. ``any_holder``: lines of up to some 90 characters
    that open with "copyright" and name no year are no part of a text either,
    which takes a licence's own sentences of that kind out too, of both sides.
    Rows are judged by their text, whatever their id. An empty table gives no
    rows; other columns are ignored.
    """
    known = known_licenses(docs.sparkSession) if known is None else known
    digest = F.sha2(F.array_join("lines", " ").cast("binary"), 256)
    digests = (known.select("license", canonical_lines(F.col("text"), any_holder).alias("lines")).where(F.size("lines") > 0)
               .select(digest.alias("known"), "license").groupBy("known").agg(F.min("license").alias("license")))
    digests = written(digests, "licenses")
    table = F.broadcast(digests) if digests.count() <= BROADCAST_ROWS else digests

    # rows of equal lines have equal line licences, so they are looked up once
    rows = docs.select(docs[id_col].alias("doc_id"), canonical_lines(docs[text_col], any_holder).alias("lines"))
    rows = written(rows.select("doc_id", digest.alias("digest"), F.sha2(F.array_join("lines", "\n").cast("binary"), 256).alias("as_lines"),
                               F.transform("lines", lambda x: F.unhex(F.sha2(x.cast("binary"), 256))).alias("lines")), "license-digests")
    lines = rows.select("as_lines", F.explode("lines").alias("line")).select("as_lines", F.lower(F.hex("line")).alias("known"))
    found = written(lines.join(table, "known").groupBy("as_lines").agg(F.array_sort(F.collect_set("license")).alias("names")), "license-lines")
    # a hot digest stays where it is: the known side is small or AQE splits the other
    whole = rows.select("doc_id", "digest", "as_lines").join(table.withColumnRenamed("known", "digest"), "digest", "left")
    return whole.join(found, "as_lines", "left") \
        .select("doc_id", "digest", "license", F.coalesce(F.array_join("names", ","), F.lit("")).alias("line_licenses"))
