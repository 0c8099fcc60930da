"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


def _given_settings() -> dict[str, str]:
    """What is set before a session exists: by ``spark-submit`` (its JVM runs
    already), else by ``PYSPARK_SUBMIT_ARGS`` and ``spark-defaults.conf``, which
    are read here because the JVM's memory is fixed when it starts."""
    import shlex

    from pyspark import SparkConf, SparkContext
    if "PYSPARK_GATEWAY_PORT" in os.environ:
        SparkContext._ensure_initialized()
        return dict(SparkConf().getAll())
    out = {}
    home = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    defaults = os.path.join(home, "spark-defaults.conf")
    if os.path.isfile(defaults):
        with open(defaults, encoding="utf-8") as f:
            pairs = [line.split(None, 1) for line in f if line.strip() and not line.lstrip().startswith("#")]
        out.update({p[0]: p[1].strip() for p in pairs if len(p) == 2})
    words = shlex.split(os.environ.get("PYSPARK_SUBMIT_ARGS", ""))
    for name, value in zip(words, words[1:]):
        if name == "--conf" and "=" in value:
            out.update([value.split("=", 1)])
        elif name in ("--master", "--driver-memory"):
            out["spark." + name[2:].replace("-", ".")] = value
    return out


def get_spark(master: str | None = None, app: str = "hirelens",
              shuffle_partitions: int | None = None) -> SparkSession:
    """The session of a program. Settings that ``spark-submit`` or the
    environment gave win; only what is unset gets a value here, and without a
    submitted master the session runs on ``local[$BENCH_CPUS]``."""
    given = _given_settings()
    active = SparkSession.getActiveSession()
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.appName(app)
    local = given.get("spark.master", "local").startswith("local")
    wanted = {
        "spark.master": master or os.environ.get("SPARK_MASTER") or f"local[{cpus}]",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cpus) if local else None,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g" if local else None,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if active is None:
        for key, value in wanted.items():
            if value is not None and key not in given:
                b = b.config(key, value)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_BASE: str | None = None


def shared_base(spark: SparkSession) -> str:
    """The cluster's shared folder named by ``spark.checkpoint.dir``.

    Only on a local master without that setting (tests) is a scratch folder
    made, once per process, and installed as the checkpoint directory; on a
    cluster a folder of one machine would lose data, so there it is an error.
    """
    global _LOCAL_BASE
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if base:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(base)
        return base
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if _LOCAL_BASE is None:
        _LOCAL_BASE = tempfile.mkdtemp(prefix="hirelens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(_LOCAL_BASE)
    return _LOCAL_BASE


def shared_dir(spark: SparkSession, name: str) -> str:
    base = shared_base(spark)
    return f"{base.rstrip('/')}/{name}"


def unique_dir(spark: SparkSession, prefix: str) -> str:
    """A never-reused folder name below the shared directory."""
    import uuid
    return shared_dir(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a frame reading it back.

    Used where one intermediate feeds several consumers (a join with its own
    aggregate, scalar subqueries): Spark does not reuse exchanges whose plans
    carry lambda expressions, so without this the producer runs once per
    consumer. It also cuts lineage: a lost executor re-reads Parquet instead
    of recomputing the upstream plan.
    """
    spark = df.sparkSession
    path = unique_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def once(df, **columns):
    """``df`` with columns, new or in the place of those of the same name, that
    are evaluated once per row. They leave through a one-row generator: else
    Catalyst puts the whole expression in the place of each later use, a parse
    runs once per use, and the code generated for a row grows beyond what the
    JVM compiles."""
    from pyspark.sql import functions as F
    made = {n: f"_once_{n}" for n in columns}
    out = df.select("*", F.inline(F.array(F.struct(*[c.alias(made[n]) for n, c in columns.items()]))))
    names = [*df.columns, *[n for n in columns if n not in df.columns]]
    return out.select(*[F.col(made[n]).alias(n) if n in made else F.col(n) for n in names])


def checked_broadcast(df, most_rows: int = 100_000):
    """``df`` marked for broadcast if it has at most ``most_rows`` rows, else
    as it is, so that Spark picks a join with shuffles."""
    from pyspark.sql import functions as F
    few = df.limit(most_rows + 1).count() <= most_rows
    return F.broadcast(df) if few else df
