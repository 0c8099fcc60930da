r"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

Lines are the ``\n``-separated pieces of a text that hold a word. A line goes
if an equal line, or one within one character edit, starts earlier in the
corpus (smaller document id, then, where ids repeat or are null, smaller hash
of the text, then smaller position); the earliest stays.

* Equal lines are one class (a 128-bit key and the place of the first).
* Two lines within one edit agree on the half before or the half after the
  edit. Classes that share such a half with another class are candidates; no
  pair is lost, and only candidates are spelled out.
* A candidate of n characters has n variants, each with one character deleted.
  Lines that differ by a substitution at position i share variant and i; a line
  with one character more has the shorter line among its variants. So the
  earliest line of every (variant, position) is a witness against all others
  there, and a line that is itself a variant is one against, or for, the lines
  that yield it: what is joined grows with the lines, not with their pairs.
* Line and witness are verified to be one edit apart on their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import drop, written

#: lines of fewer characters are compared for equality only, unless asked for
NEAR_CHARS = 20
#: lines of up to so many characters spell their variants as texts; of longer
#: ones a variant is put together from hashes of what is before and behind it
SPELLED_CHARS = 512
#: characters in a piece of a longer line
PIECE = 128
#: bytes up to which a written table is broadcast; a larger one is joined by
#: shuffles
BROADCAST_BYTES = 48 << 20

_HAS_WORD = r"[^\x20\x09-\x0D]"


def _checked(df: DataFrame, numbers: str | None = None) -> DataFrame:
    """``df`` (a key of some 64 bytes and, in ``numbers``, an array of numbers a
    row) for broadcast if it is small."""
    own = F.lit(96) + (F.size(numbers) * 8 if numbers else F.lit(0))
    size = df.agg(F.sum(own.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def _row(doc_id: Column, text: Column) -> list[Column]:
    """What tells documents apart, in their order: null ids first, then the id,
    then the hash of the text."""
    return [doc_id.isNotNull().alias("has"), F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")).alias("id"), F.xxhash64(text).alias("text")]


def _long_hash(line: Column, lo: Column | None = None, hi: Column | None = None) -> Column:
    """The hash of a long line, or the hashes of it less the character at each
    position from lo to hi: the exclusive or of the hashes of its characters
    with their places. What is behind a gap is one place further on. Ends of
    pieces hold the hashes up to them, so a variant looks at two pieces, not at
    the whole line."""
    chars = F.split(line, "")
    xor = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))
    at = F.transform(chars, lambda c, j: F.xxhash64(c, j))
    if lo is None:
        return xor(at)
    moved = F.transform(chars, lambda c, j: F.xxhash64(c, j - 1))
    pieces = lambda a: F.transform(F.sequence(F.lit(0), F.floor(F.size(a) / PIECE).cast("int")), lambda k: xor(F.slice(a, k * PIECE + 1, PIECE)))
    upto = lambda p: F.transform(p, lambda _, k: xor(F.slice(p, F.lit(1), k)))
    s = F.struct(at.alias("at"), moved.alias("moved"), xor(moved).alias("all"))
    s = F.transform(F.array(s), lambda x: F.struct(x["at"].alias("at"), x["moved"].alias("moved"), x["all"].alias("all"),
                                                   pieces(x["at"]).alias("p"), pieces(x["moved"]).alias("q")))
    s = F.transform(s, lambda x: F.struct(x["at"].alias("at"), x["moved"].alias("moved"), x["all"].alias("all"),
                                          upto(x["p"]).alias("p"), upto(x["q"]).alias("q")))

    def first(x: Column, whole: str, ends: str, n: Column) -> Column:
        """The hash of the first n characters."""
        piece = F.floor(n / PIECE).cast("int")
        return F.element_at(x[ends], piece + 1).bitwiseXOR(xor(F.slice(x[whole], piece * PIECE + 1, n % PIECE)))

    out = F.transform(s, lambda x: F.transform(F.sequence(lo, hi), lambda i: first(x, "at", "p", i - 1).bitwiseXOR(
        x["all"].bitwiseXOR(first(x, "moved", "q", i)))))
    return F.element_at(out, 1)


def _whole_hash(line: Column) -> Column:
    return F.when(F.length(line) < SPELLED_CHARS, F.xxhash64(line)).otherwise(_long_hash(line))


def _variant_hashes(line: Column, lo: Column, hi: Column) -> Column:
    """Hashes of the line less the character at each position from lo to hi; a
    line one character shorter has the same one (see ``_whole_hash``)."""
    spelled = F.transform(F.sequence(lo, hi), lambda i: F.xxhash64(F.concat(F.substring(line, F.lit(1), i - 1), F.substring(line, i + 1, F.length(line)))))
    return F.when(F.length(line) <= SPELLED_CHARS, spelled).otherwise(_long_hash(line, lo, hi))


def _half_keys(line: Column, n: Column, near_chars: int) -> list[Column]:
    """Hashes k0..k3 of the halves that a line within one edit must share: the
    first and the last half of the line as the shorter of the two (base n),
    then as the longer (base n - 1)."""
    def halves(m: Column) -> list[Column]:
        cut = F.floor(m / 2).cast("int")
        return [F.xxhash64(m, F.lit(0), F.substring(line, F.lit(1), cut)),
                F.xxhash64(m, F.lit(1), F.right(line, (m - cut)))]
    own, less = halves(n), halves(n - 1)
    return [F.when(n >= near_chars + (q > 1), h).alias(f"k{q}") for q, h in enumerate(own + less)]


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_chars: int = NEAR_CHARS) -> DataFrame:
    """(has, id, text: see ``_row``, gone: positions from 0 of the lines to
    remove) for the documents that lose lines."""
    text = docs.select(F.struct(*_row(docs[id_col], docs[text_col])).alias("row"), docs[text_col].alias("text"))
    pieces = text.select("row", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    worded = pieces.where(F.col("line").rlike(_HAS_WORD))
    n = F.char_length("line")
    lines = written(worded.select(
        F.struct("row.has", "row.id", "row.text", "pos").alias("place"), F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"), n.alias("n"), *_half_keys(F.col("line"), n, near_chars)), "lines")
    # every row of a class has the same length and halves
    classes = written(lines.groupBy("h1", "h2").agg(
        F.min("place").alias("place"), F.max("place").alias("last"), F.first("n").alias("n"),
        *[F.first(k).alias(k) for k in ("k0", "k1", "k2", "k3")]), "line-classes")

    # candidates: classes that share a half with another class, and the
    # positions at which an edit leaves that half alone
    keyed = classes.where("k0 IS NOT NULL").select("place", "n", F.posexplode(F.array("k0", "k1", "k2", "k3")).alias("q", "half")) \
        .where("half IS NOT NULL")
    shared = written(keyed.groupBy("half").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("half"), "line-halves")
    middle = F.floor((F.col("n") - F.when(F.col("q") > 1, 1).otherwise(0)) / 2).cast("int")
    front = F.col("q") % 2 == 0
    wanted = written(keyed.join(shared, "half").groupBy("place").agg(
        F.min(F.when(front, middle + 1).otherwise(1)).alias("lo"),
        F.max(F.when(front, F.col("n")).otherwise(middle + 1)).alias("hi")), "line-wanted")
    where = wanted.select("place", "lo", "hi", F.struct("place.has", "place.id", "place.text").alias("at"))
    # repeated rows (same id, same text) have the same places
    spelled = written(
        text.where("text IS NOT NULL")
        .join(_checked(where), F.col("row") == F.col("at"))
        .select("place", "lo", "hi", F.element_at(F.split("text", "\n"), F.col("place.pos") + 1).alias("line"))
        .dropDuplicates(["place"]), "line-candidates")

    # their variants, and the earliest line at each
    without = _variant_hashes(F.col("line"), F.col("lo"), F.col("hi"))
    variants = written(spelled.select("place", "lo", F.posexplode(without).alias("i", "v"))
                       .select("place", (F.col("i") + F.col("lo")).alias("i"), "v"), "line-variants")
    first = written(variants.groupBy("v", "i").agg(F.min("place").alias("witness"), F.count(F.lit(1)).alias("k"))
                    .where("k > 1").select("v", "i", "witness"), "line-buckets")
    swapped = variants.join(first, ["v", "i"]).where("place > witness").select("place", "witness", "i")
    whole = written(spelled.select(_whole_hash(F.col("line")).alias("v"), F.col("place").alias("own")), "line-whole")
    longer = variants.join(whole, "v").where("place <> own").select(
        F.greatest("place", "own").alias("place"), F.least("place", "own").alias("witness"), "i")
    claims = written(swapped.unionByName(longer).groupBy("place", "witness").agg(F.min("i").alias("i")), "line-claims")

    # verified on the texts, at the position that the claim names: one edit, or
    # none, is left if the longer line (or both) less that character are equal
    other = spelled.select(F.col("place").alias("witness"), F.col("line").alias("theirs"))
    less = lambda c: F.concat(F.substring(c, F.lit(1), F.col("i") - 1), F.substring(c, F.col("i") + 1, F.length(c)))
    n, m = F.length("line"), F.length("theirs")
    near = F.when(n == m, less(F.col("line")) == less(F.col("theirs"))).when(n == m + 1, less(F.col("line")) == F.col("theirs")) \
        .when(m == n + 1, less(F.col("theirs")) == F.col("line")).otherwise(False)
    sure = claims.join(spelled.select("place", "line"), "place").join(other, "witness").where(near).select("place").distinct()
    near_classes = written(sure.withColumn("near", F.lit(True)), "line-near")

    # a class goes whole if it has an earlier near line, else all but its first place
    bad = written(classes.join(near_classes, "place", "left")
                  .where("near OR last > place").select("h1", "h2", F.col("place").alias("first"), "near"), "line-bad")
    gone = lines.select("place", "h1", "h2").join(bad, ["h1", "h2"]) \
        .where("near OR place > first").select("place.*") \
        .groupBy("has", "id", "text").agg(F.collect_set("pos").alias("gone"))
    out = written(gone, "line-gone")
    drop(lines, classes, shared, wanted, spelled, variants, first, whole, claims, near_classes, bad)
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near_chars: int = NEAR_CHARS) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, all columns kept in
    order, plus ``__n_lines`` and ``__n_removed``.

    Lines without a word stay. A null text stays null and has no lines; an
    empty text has one, which stays. Rows with the same id and text count as one
    document, so repeated rows lose the same lines; rows with the same id (or
    none) and different texts are documents in the order of the texts' hashes.
    The edit bound is one character. Lines of fewer than ``near_chars``
    characters go only if an equal line is earlier (in a short line one
    character may be all that it says: "Chapter 1", "Chapter 2"). An empty
    table gives no rows.
    """
    gone = repeated_lines(docs, id_col, text_col, near_chars).toDF("gone_has", "gone_id", "gone_text", "gone")
    named = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = docs.columns.index(text_col)
    own, key = F.col(f"c{at}"), F.col(f"c{docs.columns.index(id_col)}")
    has, number, digest = _row(key, own)
    joined = named.join(_checked(gone, "gone"), (has == F.col("gone_has")) & (number == F.col("gone_id")) & (digest == F.col("gone_text")), "left")
    parts = F.split(own, "\n")
    kept = F.filter(parts, lambda line, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNull(), own).otherwise(F.array_join(kept, "\n"))
    none = F.lit(0).cast("long")
    return joined.select(
        *[(text if i == at else F.col(f"c{i}")).alias(c) for i, c in enumerate(docs.columns)],
        F.when(own.isNull(), none).otherwise(F.size(parts).cast("long")).alias("__n_lines"),
        F.when(own.isNull() | F.col("gone").isNull(), none).otherwise(F.size("gone").cast("long")).alias("__n_removed"))
