"""Mixing sources to target weights by hash-threshold histograms.

Sizes are words. Every document has a fixed 60-bit hash of its id. Per source,
the words are summed by the top bits of the hash; the running sum finds the
bucket in which the source's budget ends; only that bucket is summed again by
the next bits, and so on until it holds one hash value. What lies below that
value is taken, what lies above is not, so nothing is sorted and a rerun takes
the same documents. A budget above the source's size takes everything once or
more and a part of a further pass, so the passes are nested.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelens.llm.common import WORD, drop, written

HASH_BITS = 60
LEVEL_BITS = 10
#: tables of one row per source are broadcast up to this many rows (about 100
#: bytes each); beyond it the join is left to Spark
BROADCAST_ROWS = 100_000


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def doc_hash(doc_id: Column, text: Column | None = None) -> Column:
    """The first 60 bits of the MD5 of the id, or of id and text, which deals
    apart rows that share an id or have none; a null id has one too."""
    name = F.coalesce(doc_id.cast("string"), F.lit(""))
    text = name if text is None else F.concat(name, F.lit(":"), F.xxhash64(text).cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def source_targets(totals: DataFrame, weights: list[float], most: int) -> DataFrame:
    """(key, source_size, target) for ``totals`` (key, source, source_size).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    the sum of all sizes; a target stops at ``most`` times its source's size
    and the excess goes to the others by weight. In order of most * size /
    weight the stopped sources come first, so prefix sums find the level of the
    rest. One row per source passes through the one window partition.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(by_name) - 1, F.lit(n)) + 1).cast("int"))
    t = totals.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(most))
    level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), "source")
    upto = level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    t = (t.withColumn("all", F.sum("source_size").over(every)).withColumn("all_w", F.sum("w").over(every))
         .withColumn("cap_before", F.coalesce(F.sum("cap").over(upto), F.lit(0)))
         .withColumn("w_before", F.coalesce(F.sum("w").over(upto), F.lit(0.0)))
         .withColumn("at", F.row_number().over(level))
         .withColumn("lambda", (F.col("all") - F.col("cap_before")) / (F.col("all_w") - F.col("w_before")))
         .withColumn("free", F.col("lambda") * F.col("w") <= F.col("cap")))
    first = F.min(F.when(F.col("free"), F.struct("at", "lambda"))).over(every)
    t = t.withColumn("f", first)
    target = F.when(F.col("f").isNull() | (F.col("at") < F.col("f.at")), F.col("cap").cast("double")) \
        .otherwise(F.col("f.lambda") * F.col("w"))
    return t.select("key", "source_size", target.alias("target"))


@dataclass
class Mix:
    """What each source gives: ``plan`` has a row per source with how often it
    is taken whole and the hash up to which a further pass goes."""
    plan: DataFrame
    most: int
    cut: bool

    def taken(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with key, h and size) with source_size, target and taken."""
        left = F.col("rest") - F.col("before")
        here = (F.floor(F.col("size") * left / F.col("words")) if self.cut
                else F.when(2 * left >= F.col("words"), F.col("size")).otherwise(0))
        part = (F.when(F.col("h") < F.col("at"), F.col("size"))
                .when((F.col("h") == F.col("at")) & (F.col("words") > 0), here).otherwise(0))
        plan = _small(self.plan.select("key", "source_size", "target", "full", "rest", "before", "words", "at"))
        most = (F.lit(self.most) - F.col("full")) * F.col("size")
        return rows.join(plan, "key").withColumn(
            "taken", (F.col("full") * F.col("size") + F.least(part.cast("long"), most)).cast("long")) \
            .drop("full", "rest", "before", "words", "at")


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, by_text: bool = False) -> list[Column]:
    source = docs[source_col].cast("string")
    return [source.alias("source"), words_in(docs[text_col]).alias("size"),
            F.coalesce(F.concat(F.lit("s"), source), F.lit("n")).alias("key"),
            doc_hash(docs[id_col], docs[text_col] if by_text else None).alias("h")]


def budgets(rows: DataFrame, weights: list[float], most: int, cut: bool) -> Mix:
    """The mix of ``rows`` (key, source, size, h), read once per level."""
    totals = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    plan = written(
        source_targets(totals, weights, most)
        .withColumn("full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
        .withColumn("rest", F.round(F.col("target") - F.col("full") * F.col("source_size")).cast("long"))
        .withColumn("prefix", F.lit(0).cast("long")).withColumn("before", F.lit(0).cast("long")),
        "mix-plan")

    bits = 0
    while bits < HASH_BITS:
        bits += LEVEL_BITS
        shift = HASH_BITS - bits
        inside = F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix")
        hist = (rows.join(_small(plan.select("key", "prefix")), "key").where(inside)
                .groupBy("key", F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("words"), F.min("h").alias("lo"), F.max("h").alias("hi")))
        run = Window.partitionBy("key").orderBy("bucket")
        ends = (hist.withColumn("upto", F.sum("words").over(run))
                .join(_small(plan.select("key", "rest", "before")), "key").where(F.col("before") + F.col("upto") >= F.col("rest"))
                .groupBy("key").agg(F.min_by(F.struct("bucket", "upto", "words", "lo", "hi"), "bucket").alias("b"))
                .select("key", F.col("b.bucket").alias("bucket"), F.col("b.words").alias("words"),
                        (F.col("b.upto") - F.col("b.words")).alias("more"),
                        (F.col("b.lo") < F.col("b.hi")).alias("several"), F.col("b.lo").alias("at")))
        new = written(
            plan.select("key", "source_size", "target", "full", "rest", "before").join(ends, "key")
            .select("key", "source_size", "target", "full", "rest",
                    F.col("bucket").alias("prefix"), (F.col("before") + F.col("more")).alias("before"),
                    "words", "several", "at"),
            "mix-plan")
        drop(plan)
        plan = new
        if not plan.where("several").limit(1).count():
            break

    return Mix(plan, most, cut)


def mix(docs: DataFrame, weights: list[float] = (1, 2, 3), most: int = 3, cut: bool = True,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: doc_id, source, size, source_size, target, taken.

    ``cut``: the document in which the budget ends gives just the words that
    are left (rows of one id share them in proportion); otherwise it is taken
    whole if that comes nearer to the target, or not at all. Empty and null
    texts have size 0 and are taken as 0. A null source is a source. An empty
    table gives no rows. Extra columns are ignored. No document is taken more
    than ``most`` times.
    """
    rows = written(docs.select(docs[id_col].alias("doc_id"), *_keyed(docs, id_col, text_col, source_col)), "mix-sizes")
    out = budgets(rows, list(weights), most, cut).taken(rows)
    return out.select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed(docs: DataFrame, weights: list[float] = (1, 2, 3), most: int = 3,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: whole documents, each as often as it is
    taken; documents without words, which count for nothing, are not taken.
    Rows of one id (or none) are drawn apart by their texts; equal rows are
    taken alike. Columns and their order stay; texts are not shuffled."""
    keyed = _keyed(docs, id_col, text_col, source_col, by_text=True)
    sizes = written(docs.select(*keyed), "mix-sizes")
    plan = budgets(sizes, list(weights), most, cut=False)
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*[docs[c].alias(n) for c, n in zip(docs.columns, names)], *keyed)
    copies = plan.taken(rows).where("taken > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.floor(F.col("taken") / F.col("size")))))
    return copies.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names)])
