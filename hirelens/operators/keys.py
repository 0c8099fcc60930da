"""Keys as constraints on Parquet tables (SNK-7, JON-6).

Parquet knows no unique or foreign keys. Here a constraint is a query whose
rows are its violations, and deleting with cascade is an anti-join over those
partitions of the child table that hold rows of the deleted parents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.session import checked_broadcast, materialize
from hirelens.sinks.store import replace_partitions


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Unique key: the keys with more than one row and their number of rows
    (``n``). A key with a null is no duplicate, as in SQL. A hash aggregate, so
    a key with a third of all rows collapses in the map tasks."""
    return df.dropna(subset=list(key)).groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign key: the child rows whose key no parent has; a null key refers to
    nothing and is none."""
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return child.where(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_parent"), "left_anti")


def missing_values(df: DataFrame, *columns: str) -> DataFrame:
    """Not null: (column, n) of the columns with nulls; one pass."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n")) for c in columns])).alias("v")) \
        .select("v.*").where("n > 0")


def place_of(key: str, parts: int):
    """The partition of a key, alike in a parent and its children."""
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(parts)).cast("int")


def write_placed(df: DataFrame, path: str, key: str, parts: int) -> None:
    """``df`` as a table in ``parts`` partitions by ``key``."""
    df.withColumn("_part", place_of(key, parts)).repartition(parts, "_part").write.mode("overwrite").partitionBy("_part").parquet(path)


def _drop_partitions(spark: SparkSession, path: str, numbers: list[int]) -> None:
    jvm = spark._jvm
    for n in numbers:
        where = jvm.org.apache.hadoop.fs.Path(f"{path}/_part={n}")
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def delete_rows(spark: SparkSession, path: str, key: str, gone: DataFrame, parts: int) -> None:
    """Deletes the rows of the table at ``path`` whose ``key`` is in the column
    ``id`` of ``gone``. Partitions without such keys are neither read nor
    written; one that loses all its rows goes (of ``parts`` at most)."""
    ids = materialize(gone.select("id").distinct().withColumn("_part", place_of("id", parts)), "deleted-keys")
    touched = [r["_part"] for r in ids.select("_part").distinct().collect()]
    if not touched:
        return
    held = spark.read.parquet(path).where(F.col("_part").isin(touched))
    left = materialize(held.join(checked_broadcast(ids.select(F.col("id").alias("_gone"))), F.col(key) == F.col("_gone"), "left_anti"), "rows-left")
    kept = {r["_part"] for r in left.select("_part").distinct().collect()}
    if kept:
        replace_partitions(left, path, "_part")
    _drop_partitions(spark, path, sorted(set(touched) - kept))


def delete_cascade(spark: SparkSession, parent: str, parent_key: str, children: dict[str, str], gone: DataFrame, parts: int) -> None:
    """Deletes the ids of ``gone`` from the children (path -> key column), then
    from the parent: a stop in between leaves no orphan."""
    ids = materialize(gone.select("id").distinct(), "deleted-parents")
    for path, key in children.items():
        delete_rows(spark, path, key, ids, parts)
    delete_rows(spark, parent, parent_key, ids, parts)
