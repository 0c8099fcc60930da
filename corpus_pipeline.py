"""The corpus pipeline: five stages, each on all that the one before kept.

1. quality rules (4): documents that the base or the learned list rejects go;
2. line dedup (9): repeated lines go from the texts, the earliest stays;
3. SimHash near-dedup (5): one document of each group stays;
4. mixing (7): whole documents of each source up to its target, some repeated;
5. packing (8): the pieces of all documents in sequences of 4096 ids.

Every stage but the last returns the columns of ``documents``; ``n_chars``
follows the text. Stages are written as Parquet in the shared folder and read
again, so a lost executor repeats part of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import lines, mixing, packing, quality, simhash
from hirelens.llm.common import drop, written
from hirelens.llm.queries import END_ID, PACK_COLUMNS, tokenizer_path


#: chunks that a tokenizing worker keeps, twice; fewer than where packing is all
#: that an executor does, as the stages before it leave their share of memory
REMEMBERED = 40_000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(docs)  # the columns of docs, then two counts
    out = out.toDF(*[f"c{i}" for i in range(len(out.columns))])
    size = F.char_length(f"c{docs.columns.index('text')}")
    return out.select(*[(size.cast(t) if c == "n_chars" else F.col(f"c{i}")).alias(c) for i, (c, t) in enumerate(docs.dtypes)])


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, words=3, most=3)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, weights=[1, 2, 3], most=3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path("word_bpe_49k.json"), END_ID, remembered=REMEMBERED).placed.select(*PACK_COLUMNS)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("source_mix", source_mix),
    ("packing", pack),
]

#: the learned rules and the packing can't be expressed in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces.

    Null and empty texts fail the quality rules; a null id is carried through
    and counts after all others where one row of a group stays; equal rows are
    judged alike, and one of them is left after the near-dedup; other columns of
    any name pass through unchanged; an empty table gives no pieces.
    """
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        after = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        drop(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)
