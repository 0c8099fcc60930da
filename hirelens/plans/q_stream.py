"""Streaming queries: each drains a file-drop stream with availableNow and
returns the sink's contents."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens import dims
from hirelens.plans.catalog import raw, register
from hirelens.plans.q_crawl import BREAKER_ORACLE
from hirelens.session import materialize, table, unique_dir
from hirelens.sources.fixtures import RAW_POSTINGS_SQL

FILES = 4   # of a drop, and so of a micro-batch
DROPS = 4


def stage_slices(df, slice_col: str, n_slices: int, path: str, files_per_drop: int = 4, only: range | None = None, late: int = 0) -> None:
    """Write ``df`` to ``path`` as ``n_slices`` successive drops of
    ``files_per_drop`` files each, in the order of ``slice_col`` (a number or a
    time). Rows with a null ``slice_col`` come with the last drop; ``late``: one
    row in so many comes a drop after its own. ``only``: the drops to write now."""
    key = F.col(slice_col)
    if df.schema[slice_col].dataType.simpleString().startswith("timestamp"):
        key = key.cast("timestamp")
    key = key.cast("double")
    lo, hi = df.agg(F.min(key), F.max(key)).first()
    span = (hi - lo) / n_slices if lo is not None and hi > lo else 1
    place = F.least(F.lit(n_slices - 1), F.floor((key - F.lit(lo)) / F.lit(span))) if lo is not None else F.lit(None)
    if late:
        place = F.least(F.lit(n_slices - 1), place + (F.pmod(F.xxhash64(*df.columns), F.lit(late)) == 0).cast("int"))
    numbered = materialize(df.withColumn("_drop", F.coalesce(place.cast("int"), F.lit(n_slices - 1))), "drops")
    for i in only if only is not None else range(n_slices):
        numbered.where(F.col("_drop") == i).drop("_drop").repartition(files_per_drop).write.mode("append").parquet(path)


def _dropped(df, by, late=0):
    """(folder of drops, schema, work folder, files a trigger): ``df`` as
    successive file drops."""
    base = unique_dir(df.sparkSession, "stream")
    stage_slices(df, by, DROPS, f"{base}/drops", FILES, late=late)
    return f"{base}/drops", df.schema, f"{base}/work", FILES


@register("stream_dedup", f"WITH r AS ({RAW_POSTINGS_SQL}) SELECT DISTINCT job_url FROM r")
def q_stream_dedup(spark, sf_dir):
    from hirelens.streaming.jobs import stream_dedup
    return stream_dedup(spark, *_dropped(raw(spark, sf_dir), "seq")).select("job_url")


HORIZON_DAYS = 2
STATE_ROWS = 500_000  # of a state partition, about


@register("stream_dedup_within", f"""
    WITH RECURSIVE e AS (SELECT user_id, event_type, date_trunc('day', ts) AS day FROM events GROUP BY ALL),
    n AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY day) AS k FROM e),
    r AS (SELECT user_id, event_type, day, k, day AS kept FROM n WHERE k = 1
          UNION ALL SELECT n.user_id, n.event_type, n.day, n.k,
            CASE WHEN n.day - r.kept > INTERVAL {2 * HORIZON_DAYS + 1} DAY THEN n.day ELSE r.kept END
          FROM r JOIN n ON n.user_id = r.user_id AND n.event_type = r.event_type AND n.k = r.k + 1)
    SELECT user_id, event_type, CAST(kept AS DATE) AS day FROM r WHERE day = kept""")
def q_stream_dedup_within(spark, sf_dir):
    """STM-2, bounded: the days on which a user does a kind of thing again after
    the horizon of two days; a drop a day. The watermark is a horizon and a drop
    behind, so a key is forgotten two horizons and a drop after its row: a copy
    up to then goes and one beyond stays."""
    from hirelens.streaming.jobs import stream_dedup_within
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")).distinct()
    e = materialize(e, "stream-days")  # counted, then dealt out
    days, rows = e.agg(F.count_distinct("day"), F.count(F.lit(1))).first()
    base = unique_dir(spark, "stream")
    stage_slices(e, "day", days, f"{base}/drops", 1)
    held = rows * (2 * HORIZON_DAYS + 1) // max(days, 1)  # rows of the days that the state holds
    parts = max(spark.sparkContext.defaultParallelism, -(-held // STATE_ROWS))
    out = stream_dedup_within(spark, f"{base}/drops", e.schema, f"{base}/work", 1, ["user_id", "event_type"], "day", f"{HORIZON_DAYS} days", parts)
    return out.select("user_id", "event_type", F.to_date("day").alias("day"))


@register("stream_weekly", """
    SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, count(*) AS count FROM events GROUP BY 1""")
def q_stream_weekly(spark, sf_dir):
    from hirelens.streaming.jobs import stream_weekly
    return stream_weekly(spark, *_dropped(table(spark, sf_dir, "events"), "ts"))


@register("stream_breaker", BREAKER_ORACLE)
def q_stream_breaker(spark, sf_dir):
    """STM-4: one event in seven comes a drop late; pools of four sources."""
    from hirelens.streaming.jobs import stream_breaker
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return stream_breaker(spark, *_dropped(events, "ts", late=7), pool=F.floor(F.col("user_id") / 4))


@register("stream_upsert", f"""
    WITH r AS ({RAW_POSTINGS_SQL})
    SELECT job_url, seq FROM (SELECT *, row_number() OVER (PARTITION BY job_url ORDER BY seq DESC) AS rn FROM r)
    WHERE rn = 1""")
def q_stream_upsert(spark, sf_dir):
    from hirelens.streaming.jobs import stream_upsert
    postings = raw(spark, sf_dir).select("seq", "job_url", "salary_text")
    return stream_upsert(spark, *_dropped(postings, "seq")).select("job_url", "seq")


IN_CITY = " OR ".join(f"contains(coalesce(city, ''), '{c}')" for c in dims.TARGET_CITIES)


@register("stream_funnel", f"""
    WITH r AS (SELECT *, ({IN_CITY}) AS inside FROM ({RAW_POSTINGS_SQL})),
    f AS (SELECT min(seq) // {dims.PAGE_SIZE} AS page FROM r WHERE inside GROUP BY job_url),
    n AS (SELECT page, count(*) AS new FROM f GROUP BY page),
    p AS (SELECT seq // {dims.PAGE_SIZE} AS page, count(*) AS fetched, count(*) FILTER (WHERE inside) AS in_city FROM r GROUP BY 1)
    SELECT p.page, fetched, in_city, coalesce(new, 0) AS new FROM p LEFT JOIN n ON p.page = n.page""")
def q_stream_funnel(spark, sf_dir):
    from hirelens.streaming.jobs import stream_funnel
    return stream_funnel(spark, *_dropped(raw(spark, sf_dir).select("seq", "city", "job_url"), "seq"), dims.PAGE_SIZE, dims.TARGET_CITIES)
