"""Keyed storage on Parquet (SNK-4..8, WIN-8, PRJ-8).

No table format with MERGE is available offline. A keyed table is a plain
partitioned Parquet folder: its partitions are hash ranges of the key, and a
batch rewrites only those that its keys fall into, by Spark's dynamic partition
overwrite. The number of partitions comes from the size of the first batch and
stands in the table's own partition columns, so any reader finds it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.operators.clean import first_per_key
from hirelens.session import checked_broadcast, materialize

#: rows of the first batch for which the table gets one partition
PARTITION_ROWS = 250_000


def upsert(current: DataFrame | None, batch: DataFrame, key: str, order_cols=("_batch", "seq")) -> DataFrame:
    """SNK-5 / SNK-8 / WIN-8: last write wins per key (largest batch, then
    largest seq inside a batch; the pair is unique within a key). The pair is
    compared as one number."""
    frames = batch if current is None else current.unionByName(batch, allowMissingColumns=True)
    major, minor = F.col(order_cols[0]).cast("decimal(18,0)"), F.col(order_cols[1]).cast("decimal(19,0)")
    step = F.lit("10000000000000000000").cast("decimal(20,0)")  # over any long
    tmp = frames.withColumn("_ord", (major * step + minor).cast("decimal(38,0)"))
    return first_per_key(tmp, [key], "_ord", keep="last").drop("_ord")


def insert_ignore(current: DataFrame | None, batch: DataFrame, key: str, order_col: str = "seq") -> DataFrame:
    """SNK-4: the rows of ``batch`` whose key is new; the first row per key in
    the batch is the one inserted, existing rows are never changed."""
    first = first_per_key(batch, [key], order_col, keep="first")
    if current is None:
        return first
    held = current.select(F.col(key).alias("_held"))
    return first.join(held, F.col(key).eqNullSafe(F.col("_held")), "left_anti")


def replace_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Write ``df`` over those partitions of the table that its rows fall into;
    the others stay (SNK-5, SNK-8)."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if nothing was written there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _dealt(spark: SparkSession, path: str, batch: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """(the written batch with the table's partition columns, the rows of the
    partitions that it touches; None without a table)."""
    now = stored(spark, path)
    batch = materialize(batch, "keyed-batch")
    parts = now.select("_of").first()["_of"] if now is not None else batch.count() // PARTITION_ROWS + 1
    place = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    dealt = batch.withColumns({"_of": F.lit(parts).cast("int"), "_part": place})
    if now is None:
        return dealt, None
    touched = dealt.select("_part").distinct()
    return dealt, now.join(checked_broadcast(touched), "_part", "left_semi")


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, key: str, order_cols=("_batch", "seq")) -> None:
    """Last write wins per key in the table at ``path``. The batch is written
    and read once; partitions without a key of it are not read. Repeating a
    batch changes nothing."""
    dealt, held = _dealt(spark, path, batch, key)
    merged = upsert(held, dealt, key, order_cols)
    # staged, as a table can't be read while its partitions are replaced
    replace_partitions(materialize(merged.repartition("_part"), "keyed-merge"), path, "_of", "_part")


def insert_table(spark: SparkSession, path: str, batch: DataFrame, key: str, order_col: str = "seq") -> None:
    """Rows with new keys are appended to their partitions; no stored row is
    rewritten. Repeating a batch adds nothing."""
    dealt, held = _dealt(spark, path, batch, key)
    new = insert_ignore(held, dealt, key, order_col)
    materialize(new.repartition("_part"), "keyed-new").write.mode("append").partitionBy("_of", "_part").parquet(path)


def table_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a keyed table without its partition columns."""
    now = stored(spark, path)
    return None if now is None else now.drop("_of", "_part")
