"""Crawl-log operators (AGG-24, WIN-3, WIN-5, WIN-6) re-aimed at tables.

The reference keeps these as counters inside its polling loop; here they
are aggregates and windows over a log of fetched rows or events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelens.operators.joins import contains_any


def page_funnel(rows: DataFrame, page_size: int, cities) -> DataFrame:
    """AGG-24 + FLT-2 + JON-5: per page, rows fetched, rows in a target city,
    and in-city rows whose URL was not seen on any earlier in-city row."""
    r = rows.withColumn("page", F.floor(F.col("seq") / page_size).cast("long")) \
            .withColumn("in_city", contains_any("city", cities))
    firsts = r.where("in_city").groupBy("job_url").agg(F.min("seq").alias("first_seq"))
    j = r.join(firsts, "job_url", "left")
    return (j.groupBy("page")
             .agg(F.count(F.lit(1)).alias("fetched"),
                  F.count(F.when(F.col("in_city"), 1)).alias("in_city"),
                  F.count(F.when(F.col("in_city") & (F.col("seq") == F.col("first_seq")), 1)).alias("new"))
             .orderBy("page"))


def global_sequence(df: DataFrame, order_cols: list[str], out: str = "seq_no") -> DataFrame:
    """WIN-3: a gap-free 1..N number in ``order_cols`` order without a
    single-partition sort.

    Rows are dealt to ranges of the whole order key (Spark samples the rows and
    compares them as tuples), followed by a hash of the row and its place in
    the written input: neither a hot leading value nor rows equal in every
    order column, or in all columns, gather in one range. A row's number is its
    place in its range after the rows of the ranges before; only the size of
    each range leaves the tasks. Columns of any sortable type may order; nulls
    come first. Rows equal in the order columns are numbered by their hash.
    """
    from hirelens.session import materialize
    spark = df.sparkSession
    keyed = materialize(df.withColumn("_tie", F.xxhash64(*df.columns)).withColumn("_row", F.monotonically_increasing_id()), "sequence-input")
    order = [*order_cols, "_tie", "_row"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the id after the sort is (number of the range, place in it)
    placed = materialize(keyed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
                         .withColumn("_place", F.monotonically_increasing_id()).drop("_tie", "_row"), "sequence-ranges")
    part = F.shiftright("_place", 33).cast("int")
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # one row a range
    before = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return placed.withColumn("_part", part).join(F.broadcast(before), "_part") \
        .withColumn(out, F.col("_off") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1).select(*df.columns, out)


def failure_streaks(events: DataFrame, key: str = "user_id", ts: str = "ts", tie: str = "event_id",
                    is_fail=None, chunk: str = "hour") -> DataFrame:
    """WIN-5 / WIN-6: length of the run of consecutive failures ending at each
    failed event (reset by any success), per key in (ts, tie) order.

    Two levels so a key holding a third of all events is never one window
    partition: (1) windows per (key, time chunk) number failures since the
    last success inside the chunk and summarize the chunk (trailing failures,
    any success); (2) a window over the small chunk table per key carries
    the open run into the next chunk; failures before the first success of a
    chunk add that carry.
    """
    fail = is_fail if is_fail is not None else (F.col("event_type") == "error")
    e = events.withColumn("_fail", fail).withColumn("_chunk", F.date_trunc(chunk, F.col(ts).cast("timestamp")))
    w = Window.partitionBy(key, "_chunk").orderBy(ts, tie)
    e = e.withColumn("_run", F.sum(F.when(~F.col("_fail"), 1).otherwise(0)).over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    wr = Window.partitionBy(key, "_chunk", "_run").orderBy(ts, tie)
    # inside a run the success (if any) comes first, then failures only
    e = e.withColumn("_local", F.when(F.col("_fail"), F.row_number().over(wr)
                                      - F.when(F.col("_run") > 0, 1).otherwise(0)))
    chunks = (e.groupBy(key, "_chunk")
               .agg(F.max(F.when(~F.col("_fail"), 1).otherwise(0)).alias("_has_ok"),
                    F.max("_run").alias("_last_run"),
                    F.count(F.when(F.col("_fail"), 1)).alias("_nfail"))
               )
    trailing = (e.where(F.col("_fail")).groupBy(key, "_chunk", "_run").agg(F.count(F.lit(1)).alias("_t")))
    chunks = (chunks.join(trailing.withColumnRenamed("_run", "_last_run"), [key, "_chunk", "_last_run"], "left")
                    .withColumn("_trail", F.coalesce(F.col("_t"), F.lit(0))).drop("_t"))
    # carry into chunk c = failures at the end of earlier chunks since the last chunk with a success
    wc = Window.partitionBy(key).orderBy("_chunk")
    chunks = chunks.withColumn("_grp", F.sum("_has_ok").over(wc.rowsBetween(Window.unboundedPreceding, 0)))
    wg = Window.partitionBy(key, "_grp").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, 0)
    chunks = chunks.withColumn("_open", F.sum("_trail").over(wg))     # open run after this chunk
    chunks = chunks.withColumn("_carry", F.coalesce(F.lag("_open").over(wc), F.lit(0)))
    out = e.join(chunks.select(key, "_chunk", "_carry"), [key, "_chunk"])
    streak = F.when(F.col("_fail"), F.col("_local") + F.when(F.col("_run") == 0, F.col("_carry")).otherwise(0))
    return out.withColumn("streak", streak).drop("_fail", "_chunk", "_run", "_local", "_carry")


def streak_summary(streaks: DataFrame, key: str = "user_id", trip: int = 2, cool: int = 3,
                   give_up: int = 5) -> DataFrame:
    """Breaker counts per key: opens (streak reaches ``trip``), cool-downs
    (``cool``), give-ups (``give_up``), and the longest streak."""
    s = F.col("streak")
    return streaks.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_events"), F.count(s).alias("n_failures"),
        F.coalesce(F.max(s), F.lit(0)).alias("max_streak"),
        F.count(F.when(s == trip, 1)).alias("breaker_trips"),
        F.count(F.when(s == cool, 1)).alias("cooldowns"),
        F.count(F.when(s == give_up, 1)).alias("give_ups"))


def stopped(streaks: DataFrame, after: int = 8, key: str = "user_id", ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """WIN-6: per key the event at which its run of failures first reaches
    ``after``, at which it stops (null: never), and the events up to it and
    behind it. The first such event per key is a hash aggregate, and every
    event is compared with it without a window."""
    from hirelens.session import checked_broadcast, materialize
    place = F.struct(ts, tie)
    stops = materialize(streaks.where(F.col("streak") == after).groupBy(F.col(key).alias("_key")).agg(F.min(place).alias("_stop")), "stops")
    joined = streaks.join(checked_broadcast(stops), streaks[key].eqNullSafe(F.col("_key")), "left")
    behind = F.coalesce(place > F.col("_stop"), F.lit(False))
    return joined.groupBy(key).agg(F.max(f"_stop.{tie}").alias("stop_event"), F.count_if(~behind).alias("n_processed"), F.count_if(behind).alias("n_skipped"))
