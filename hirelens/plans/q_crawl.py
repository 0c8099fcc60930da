"""Event-log queries: failure streaks and breaker counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelens.plans.catalog import register
from hirelens.session import table

_STREAKS = """
WITH e AS (SELECT *, sum(CASE WHEN NOT (@fail) THEN 1 ELSE 0 END)
                   OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM events),
s AS (SELECT *, CASE WHEN @fail THEN row_number() OVER (PARTITION BY user_id, run ORDER BY ts, event_id)
                     - CASE WHEN run > 0 THEN 1 ELSE 0 END END AS streak FROM e)"""
_COUNTS = """user_id, count(*) AS n_events, count(streak) AS n_failures, coalesce(max(streak), 0) AS max_streak,
       count(*) FILTER (WHERE streak = 2) AS breaker_trips, count(*) FILTER (WHERE streak = 3) AS cooldowns,
       count(*) FILTER (WHERE streak = 5) AS give_ups"""

STREAK_ORACLE = _STREAKS.replace("@fail", "event_type = 'error'") + f"SELECT {_COUNTS} FROM s GROUP BY user_id"

#: the same with the run that is open at the end, and pools of four sources of
#: which fewer than three are healthy
BREAKER_ORACLE = _STREAKS.replace("@fail", "event_type = 'error'") + f""",
p AS (SELECT {_COUNTS}, coalesce(arg_max(coalesce(streak, 0), (ts, event_id)), 0) AS open_streak FROM s GROUP BY user_id)
SELECT *, count(*) FILTER (WHERE open_streak < 2) OVER (PARTITION BY user_id // 4) < 3 AS degraded FROM p"""


@register("fail_streaks", STREAK_ORACLE)
def q_fail_streaks(spark, sf_dir):
    from hirelens.operators.crawl import failure_streaks, streak_summary
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return streak_summary(failure_streaks(e))


STOP_AFTER = 8


@register("fail_stops", _STREAKS.replace("@fail", "event_type <> 'click'") + f""",
f AS (SELECT user_id, min((ts, event_id)) AS stop FROM s WHERE streak = {STOP_AFTER} GROUP BY user_id)
SELECT s.user_id, any_value(stop[2]) AS stop_event, count(*) FILTER (stop IS NULL OR (ts, event_id) <= stop) AS n_processed,
       count(*) FILTER ((ts, event_id) > stop) AS n_skipped
FROM s LEFT JOIN f ON s.user_id = f.user_id GROUP BY s.user_id""")
def q_fail_stops(spark, sf_dir):
    """WIN-6: a source stops for good at its eighth failure in a row; an event
    that is no click counts as a failure here, so that runs get that long."""
    from hirelens.operators.crawl import failure_streaks, stopped
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return stopped(failure_streaks(e, is_fail=F.col("event_type") != "click"), STOP_AFTER)
