"""File sources and sinks (SRC-1..3, SRC-10, SNK-1..3, SNK-9, SNK-10, JSN-3).

Schemas are always declared on read (never inferred). Writes go to a fresh
folder under the shared checkpoint directory.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# fixed values: the 15 columns of the JSON export (SNK-3)
JSON_EXPORT_COLUMNS = [
    "job_title", "salary_min", "salary_max", "salary_avg", "city", "city_tier", "education",
    "exp_min", "exp_max", "company_name", "company_size", "industry", "skill_tags", "publish_date", "keyword",
]


def write_csv(df: DataFrame, path: str, fieldnames=None, append: bool = False) -> None:
    """SNK-1: header CSV as Python's csv module writes it (quotes doubled
    inside a quoted field, line feeds kept); only ``fieldnames`` (extra
    columns ignored)."""
    cols = [c for c in (fieldnames or df.columns) if c in df.columns]
    df.select(*cols).write.mode("append" if append else "overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """SRC-1 / SRC-2: header CSV with a declared schema (a UTF-8 BOM is
    stripped by the reader); fields may hold doubled quotes and line feeds;
    numeric columns that fail to parse become null. A file with quoted line
    feeds can't be split, so a folder is read a file per task."""
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("quote", '"').option("escape", '"').option("multiLine", True).option("encoding", "UTF-8").csv(path))


def write_json_records(df: DataFrame, path: str, columns=None) -> None:
    """SNK-3 / JSN-3: JSON records of the chosen columns, nulls kept as null."""
    cols = [c for c in (columns or JSON_EXPORT_COLUMNS) if c in df.columns]
    df.select(*cols).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_json(spark: SparkSession, path: str, schema: StructType, multiline: bool = False) -> DataFrame:
    """SRC-3: JSON records or whole-file documents (``multiline``: an object or
    an array of them a file); a missing document gives no rows."""
    try:
        return spark.read.schema(schema).option("multiLine", multiline).json(path)
    except AnalysisException as e:
        if not multiline or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_whole_document(df: DataFrame, path: str) -> None:
    """SNK-9: a small result (it is one cell of one file) as a whole-file JSON
    array, a record a line."""
    one = df.agg(F.collect_list(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).alias("rows"))
    one.select(F.concat(F.lit("[\n  "), F.array_join("rows", ",\n  "), F.lit("\n]")).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_result_documents(results: dict[str, DataFrame], path: str) -> None:
    """SNK-9: named analysis results merged into one folder of JSON lines,
    ``{"name": ..., "row": {...}}`` with the row's place: however many rows a
    result has, none is gathered into one cell or task."""
    for i, (name, df) in enumerate(results.items()):
        row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
        df.select(F.lit(name).alias("name"), row.alias("row")).write.mode("overwrite" if i == 0 else "append").json(path)


def read_result_documents(spark: SparkSession, path: str) -> DataFrame:
    """(name, row) of merged results; a missing folder gives no rows."""
    try:
        return spark.read.schema("name string, row string").json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "name string, row string")
