"""Structured Streaming jobs (STM-1..STM-6).

The original tool polls pages in a loop and keeps its position, seen URLs
and failure counters in memory. Here the same work is a file-source stream:
new files in a folder are the new pages, the checkpoint is the saved
position (resume after a crash or a lost executor), state stores hold the
seen URLs, and ``foreachBatch`` keeps the breaker's run summaries and upserts into
a partitioned Parquet table. ``trigger(availableNow=True)`` drains what is there
and stops, which is also how the tests drive it.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep large keyed state (all seen URLs) off the JVM heap, unless the
    session was given a provider."""
    key = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(key, ""):
        spark.conf.set(key, ROCKSDB)


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format("parquet")
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.load(path)


@contextmanager
def state_partitions(spark: SparkSession, n: int | None):
    """Streams started inside keep their state in ``n`` partitions (None: as
    many as a shuffle has). A batch opens and commits a store per partition,
    however few rows it has; a stream keeps the number it started with."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n or before))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_to_parquet(df: DataFrame, mode: str, work: str, partitions: int | None = None) -> str:
    """Drain a streaming frame into ``work``/out with its position and state in
    ``work``/checkpoint: called again with the same ``work``, it goes on where
    it ended. In update mode each batch writes a folder of its own."""
    out, ckpt = f"{work}/out", f"{work}/checkpoint"
    if mode == "append":
        with state_partitions(df.sparkSession, partitions):
            q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
                   .outputMode("append").trigger(availableNow=True).start())
    else:
        def sink(batch: DataFrame, batch_id: int) -> None:
            # idempotent per batch id: a retried batch rewrites its own folder
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        with state_partitions(df.sparkSession, partitions):
            q = (df.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
                   .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def latest_rows(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """The last emitted row of each key of an update-mode output."""
    from hirelens.operators.clean import first_per_key
    return first_per_key(spark.read.parquet(out), keys, "batch", keep="last").drop("batch")


# ----------------------------------------------------------- STM-1 / STM-2
def stream_dedup(spark: SparkSession, drops: str, schema, work: str, files_per_trigger: int) -> DataFrame:
    """Process each URL once across all file drops (exact: state keeps every
    URL of the run; see :func:`stream_dedup_within` for the bounded form)."""
    use_rocksdb_state(spark)
    s = read_stream(spark, drops, schema, files_per_trigger)
    return spark.read.parquet(run_to_parquet(s.dropDuplicates(["job_url"]), "append", work))


def stream_dedup_within(spark: SparkSession, drops: str, schema, work: str, files_per_trigger: int, keys: list[str], ts: str,
                        horizon: str, partitions: int | None = None) -> DataFrame:
    """STM-2 with bounded state: a row goes if one with the same keys stayed and
    is not forgotten. A key is forgotten when the watermark, which is
    ``horizon`` behind the newest event of the earlier batches, has passed its
    row by ``horizon``: never within one horizon, surely after two and a batch;
    the state holds no older keys. A row more than a horizon behind the newest
    one seen is late and goes too. ``partitions``: of the state, as few as hold
    it well."""
    use_rocksdb_state(spark)
    s = read_stream(spark, drops, schema, files_per_trigger)
    s = s.withColumn("_ets", F.col(ts).cast("timestamp")).withWatermark("_ets", horizon)
    return spark.read.parquet(run_to_parquet(s.dropDuplicatesWithinWatermark(keys), "append", work, partitions)).drop("_ets")


# ------------------------------------------------------------------ STM-3
def stream_weekly(spark: SparkSession, drops: str, schema, work: str, files_per_trigger: int,
                  delay: str = "1 day") -> DataFrame:
    """Monday-based weekly counts: 7-day tumbling windows shifted by 4 days
    (the epoch was a Thursday). A window's state goes once event time has
    passed its end by ``delay``; rows that come later than that are dropped."""
    s = read_stream(spark, drops, schema, files_per_trigger)
    s = s.withColumn("ets", F.col("ts").cast("timestamp")).withWatermark("ets", delay)
    agg = s.groupBy(F.window("ets", "7 days", "7 days", "4 days").alias("w")).agg(F.count(F.lit(1)).alias("count"))
    flat = agg.select(F.to_date(F.col("w.start")).alias("week_start"), "count")
    return latest_rows(spark, run_to_parquet(flat, "update", work), ["week_start"])


# ------------------------------------------------------------------ STM-4
def run_summaries(events: DataFrame, key: str, chunk: str, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """One row per (key, chunk) of ``events`` (with a boolean ``fail``): events,
    failures, whether any succeeded, the run of failures before the first
    success (``lead``; all of them if none), after the last (``trail``), and of
    the runs behind a success the longest and how many reached 2, 3 and 5.
    Summaries of chunks in order merge to what the events in order give."""
    w = Window.partitionBy(key, chunk).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    runs = events.withColumn("run", F.sum((~F.col("fail")).cast("long")).over(w)) \
        .groupBy(key, chunk, "run").agg(F.count(F.lit(1)).alias("n"), F.count_if("fail").alias("f"))
    behind = F.when(F.col("run") > 0, F.col("f"))
    return runs.groupBy(key, chunk).agg(
        F.sum("n").alias("n"), F.sum("f").alias("nf"), (F.max("run") > 0).alias("has_ok"),
        F.coalesce(F.sum(F.when(F.col("run") == 0, F.col("f"))), F.lit(0)).cast("long").alias("lead"),
        F.coalesce(F.max_by("f", "run"), F.lit(0)).alias("trail"), F.coalesce(F.max(behind), F.lit(0)).alias("longest"),
        *[F.count_if(behind >= k).alias(f"runs{k}") for k in (2, 3, 5)])


def merged_runs(summaries: DataFrame, key: str, chunk: str, pool: Column, trip: int = 2, least_healthy: int = 3) -> DataFrame:
    """The breaker per key: chunks merged in order, each with the open run that
    the chunks before leave. A key is healthy while its open run is shorter
    than ``trip``; a pool of keys with fewer than ``least_healthy`` healthy ones
    works in degraded mode. A key has one row a chunk here, not its events."""
    w = Window.partitionBy(key).orderBy(chunk)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    own = F.when(F.col("has_ok"), F.col("trail")).otherwise(F.col("lead"))
    s = summaries.withColumn("_since", F.sum(F.col("has_ok").cast("int")).over(upto))
    s = s.withColumn("_open", F.sum(own).over(Window.partitionBy(key, "_since").orderBy(chunk).rowsBetween(Window.unboundedPreceding, 0)))
    s = s.withColumn("_carry", F.coalesce(F.lag("_open").over(w), F.lit(0)))
    first = F.col("_carry") + F.col("lead")  # the run that the chunk's first failures go on with
    reached = lambda k: F.sum(F.col(f"runs{k}") + ((F.col("_carry") < k) & (first >= k)).cast("int"))
    per = s.groupBy(key).agg(
        F.sum("n").alias("n_events"), F.sum("nf").alias("n_failures"),
        F.max(F.greatest("longest", F.when(F.col("lead") > 0, first).otherwise(0))).alias("max_streak"),
        reached(2).alias("breaker_trips"), reached(3).alias("cooldowns"), reached(5).alias("give_ups"),
        F.max_by("_open", chunk).alias("open_streak"))
    per = per.withColumn("_pool", pool)
    low = per.groupBy("_pool").agg((F.count_if(F.col("open_streak") < trip) < least_healthy).alias("degraded"))
    return per.join(low, "_pool").drop("_pool")


def stream_breaker(spark: SparkSession, drops: str, schema, work: str, files_per_trigger: int, chunk: str = "hour",
                   pool: Column | None = None) -> DataFrame:
    """Failure breaker per source over the event stream. A micro-batch appends
    its events and summarizes anew the (source, time chunk) pairs that it
    touches: a late event takes its place in its chunk, and no task sees more
    than one chunk of a source. The state is these summaries, the latest one
    of each pair, merged in order when they are read. Each batch writes folders
    of its own, so a repeated batch changes nothing."""
    from hirelens.operators.clean import first_per_key
    from hirelens.session import checked_broadcast
    s = read_stream(spark, drops, schema, files_per_trigger)

    def sink(batch: DataFrame, batch_id: int) -> None:
        e = batch.select("event_id", "ts", "user_id", (F.col("event_type") == "error").alias("fail")) \
            .withColumn("chunk", F.date_trunc(chunk, F.col("ts").cast("timestamp"))).withColumn("day", F.to_date("chunk"))
        e.write.mode("overwrite").partitionBy("day").parquet(f"{work}/events/batch={batch_id}")
        every = spark.read.parquet(f"{work}/events").where(F.col("batch") <= batch_id)
        touched = every.where(F.col("batch") == batch_id).select("day", "user_id", "chunk").distinct()
        run_summaries(every.join(checked_broadcast(touched), ["day", "user_id", "chunk"], "left_semi"), "user_id", "chunk") \
            .write.mode("overwrite").parquet(f"{work}/summaries/batch={batch_id}")

    q = (s.writeStream.foreachBatch(sink).option("checkpointLocation", f"{work}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    latest = first_per_key(spark.read.parquet(f"{work}/summaries"), ["user_id", "chunk"], "batch", keep="last")
    return merged_runs(latest, "user_id", "chunk", F.lit(0) if pool is None else pool)


# ------------------------------------------------------------------ STM-5
def stream_upsert(spark: SparkSession, drops: str, schema, work: str, files_per_trigger: int) -> DataFrame:
    """Each micro-batch is upserted into a partitioned table keyed by job_url
    (last write wins: later batch, then larger seq); a batch rewrites the
    partitions it touches. A restart finds the table in its files."""
    from hirelens.sinks.store import table_rows, upsert_table
    path = f"{work}/table"
    s = read_stream(spark, drops, schema, files_per_trigger)

    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert_table(spark, path, batch.withColumn("_batch", F.lit(batch_id)), "job_url")

    q = (s.writeStream.foreachBatch(sink).option("checkpointLocation", f"{work}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return table_rows(spark, path).drop("_batch")


# ------------------------------------------------------------------ STM-6
def stream_funnel(spark: SparkSession, drops: str, schema, work: str, files_per_trigger: int, page_size: int,
                  cities) -> DataFrame:
    """Per-page counters of streaming aggregates: fetched, in city, and new
    (URLs of the city whose first posting is on the page)."""
    from hirelens.operators.joins import contains_any
    s = read_stream(spark, drops, schema, files_per_trigger)
    page = F.floor(F.col("seq") / page_size).cast("long")
    s = s.withColumn("page", page).withColumn("in_city", contains_any("city", cities))
    agg = s.groupBy("page").agg(F.count(F.lit(1)).alias("fetched"), F.count(F.when(F.col("in_city"), 1)).alias("in_city"))
    pages = latest_rows(spark, run_to_parquet(agg, "update", f"{work}/pages"), ["page"])
    use_rocksdb_state(spark)
    firsts = s.where("in_city").groupBy("job_url").agg(F.min("seq").alias("seq"))
    urls = latest_rows(spark, run_to_parquet(firsts, "update", f"{work}/urls"), ["job_url"])
    new = urls.groupBy(page.alias("page")).agg(F.count(F.lit(1)).alias("new"))
    return pages.join(new, "page", "left").select("page", "fetched", "in_city", F.coalesce("new", F.lit(0)).alias("new"))
