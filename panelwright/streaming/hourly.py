"""Hourly totals of an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_totals(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """(wh_id, sku, ts_hour, cnt, amt) of events (ts, user_id, event_type, value), streaming or not.

    Events later than `late` behind the latest one are dropped, and an hour's state goes with them.
    """
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    e = e.withWatermark("ts", late) if events.isStreaming else e
    by = e.groupBy((F.col("user_id") % 5).alias("wh_id"), F.col("event_type").alias("sku"), F.window("ts", "1 hour").alias("w"))
    out = by.agg(F.count("*").cast("double").alias("cnt"), F.sum("value").alias("amt"))
    return out.select("wh_id", "sku", F.col("w.start").alias("ts_hour"), "cnt", "amt")
