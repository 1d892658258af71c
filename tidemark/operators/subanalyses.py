"""Change around the index, and gaps of entities without an earlier value."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.elapsed import elapsed
from .temporal import around


def pre_post_change(index: DataFrame, events: DataFrame, key: str, index_time: str,
                    event_time: str, value: str, max_gap_hours: float = 100.0) -> DataFrame:
    """Index rows with the last value before, the first value after, and the change."""
    near = around(index, events, key, index_time, event_time, value, max_gap_hours)
    return (index.join(near, key, "left")
            .withColumn("pre_hours_before", elapsed("before_time", index_time))
            .withColumn("post_hours_after", elapsed(index_time, "after_time"))
            .withColumn("pre_to_post_hours", elapsed("before_time", "after_time"))
            .withColumn("change", F.col("after_value") - F.col("before_value")))


def gap_for_excluded(index: DataFrame, events: DataFrame, key: str, index_time: str,
                     event_time: str, value: str, history: DataFrame) -> DataFrame:
    """Days and change from the last value strictly before the index, of the entity or of
    its owner's history, to the first value after it. Only entities with both appear."""
    near = around(index, events, key, index_time, event_time, value, strictly_before=True)
    own = near.select(key, F.col("before_time").alias("t"), F.col("before_value").alias("v"))
    old = history.select(key, F.col("before_time").alias("t"), F.col("before_value").alias("v"))
    pre = (own.unionByName(old).where(F.col("t").isNotNull())
           .groupBy(key).agg(F.max(F.struct("t", "v")).alias("p")))
    return (pre.join(near.where(F.col("after_time").isNotNull()), key)
            .select(key, F.col("p.t").alias("pre_time"), F.col("p.v").alias("pre_value"),
                    F.col("after_time").alias("post_time"),
                    F.col("after_value").alias("post_value"))
            .withColumn("gap_days", elapsed("pre_time", "post_time", "day"))
            .withColumn("change", F.col("post_value") - F.col("pre_value")))
