"""Registration of queries and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under a name, with its SQL if there is one."""

    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A respondent of the events table is one user on one day.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per user and day: which event types occurred, and each type's first event."""
    events = table(spark, sf_dir, "events")
    first = [
        F.min(F.when(F.col("event_type") == kind, F.col("event_id"))).alias(f"first_{kind}")
        for kind in EVENT_TYPES
    ]
    return events.groupBy("user_id", F.to_date("ts").alias("day")).agg(*first)


def visit_flags() -> dict:
    return {kind: F.col(f"first_{kind}").isNotNull() for kind in EVENT_TYPES}


VISITS_SQL = """
visits AS (
    SELECT user_id, CAST(ts AS DATE) AS day,
           min(event_id) FILTER (event_type = 'click') AS first_click,
           min(event_id) FILTER (event_type = 'error') AS first_error,
           min(event_id) FILTER (event_type = 'signup') AS first_signup,
           min(event_id) FILTER (event_type = 'purchase') AS first_purchase,
           min(event_id) FILTER (event_type = 'view') AS first_view
    FROM events GROUP BY 1, 2
)"""

# Picks of the visits, one row per visit and event type, in choice order.
PICKS_SQL = VISITS_SQL + """,
choices(choice_pos, choice) AS (
    VALUES (0, 'click'), (1, 'error'), (2, 'purchase'), (3, 'signup'), (4, 'view')
),
picks AS (
    SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type AS choice FROM events
),
pick_counts AS (
    SELECT c.choice_pos, c.choice AS label, count(p.choice) AS n,
           (SELECT count(*) FROM visits) AS total
    FROM choices c LEFT JOIN picks p ON p.choice = c.choice
    GROUP BY 1, 2
)"""


def tenths(value: str) -> str:
    """SQL for one decimal, half-to-even on the stored double."""
    low = f"floor(({value}) * 10.0)"
    side = f"((({value}) * 16.0 - ({low} * 2.0 + 1.0)) + ({value}) * 4.0)"
    return (
        f"(({low} + CASE WHEN {side} > 0 OR ({side} = 0 AND {low} % 2 = 1)"
        f" THEN 1.0 ELSE 0.0 END) / 10.0)"
    )
