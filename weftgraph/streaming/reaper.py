"""Idle detection over a stream of accesses: a session window per key that ends after ``idle`` without access."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def idle_sessions(accesses: DataFrame, key: str, time: str, idle: str = "10 minutes", late: str = "1 minute") -> DataFrame:
    """key, begin, last_touch + idle (``idle_at``), accesses of each ended session; batch or streaming input."""
    windowed = accesses.withWatermark(time, late).groupBy(F.session_window(time, idle).alias("w"), key)
    return windowed.agg(F.count("*").alias("accesses")).select(key, F.col("w.start").alias("begin"), F.col("w.end").alias("idle_at"), "accesses")


def idle_now(accesses: DataFrame, key: str, time: str, now, idle_seconds: int = 600) -> DataFrame:
    """The batch twin: keys whose last access is longer ago than ``idle_seconds``."""
    last = accesses.groupBy(key).agg(F.max(time).alias("last_touch"))
    return last.where(F.col("last_touch") < now - F.make_dt_interval(secs=F.lit(idle_seconds)))
