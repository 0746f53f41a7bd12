"""Streaming: feed monitor, subscription state and incremental day append."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..sources.storage import month_of


def stream(spark: SparkSession, folder: str, pattern: str, like: DataFrame, per_trigger: int = 4) -> DataFrame:
    """A file stream over ``folder`` with the schema of ``like``."""
    return spark.readStream.schema(like.schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def monitor(feed: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events, greatest latency and late arrivals of each feed and window."""
    lag = F.unix_timestamp("received_at") - F.unix_timestamp("event_at")
    return (
        feed.withWatermark("event_at", late)
        .groupBy(F.window("event_at", width).alias("w"), "feed")
        .agg(F.count("*").alias("events"), F.max(lag).alias("max_latency"), F.count_if(lag > 60).alias("late_events"))
        .select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "feed", "events", "max_latency", "late_events")
    )


def drain(updates: DataFrame, keys: list[str], out_path: str, checkpoint: str) -> DataFrame:
    """Runs a streaming aggregate in update mode over all that is available; the last row of each key.

    A micro-batch overwrites the folder of its own number, so one that is
    repeated after a failure changes nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    q = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()
    q.awaitTermination()
    rest = [c for c in updates.columns if c not in keys]
    last = F.max_by(F.struct(*rest), "batch").alias("last")
    return updates.sparkSession.read.parquet(out_path).groupBy(*keys).agg(last).select(*keys, "last.*")


STATES = ("STARTED", "ACTIVE", "UNSUBSCRIBED")


def _step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """A feed's new rows against its state: positions of the first start and stop among them, then counts between these."""
    status, events, late, orphan = state.get if state.exists else ("NEW", 0, 0, 0)
    kind = pd.concat(list(frames)).sort_values("seq", kind="stable")["kind"].to_numpy()
    at = np.arange(len(kind))
    first = lambda k: int(np.argmax(kind == k)) if (kind == k).any() else len(kind)
    start, stop = first("START") if status == "NEW" else -1, first("STOP") if status != "UNSUBSCRIBED" else -1
    is_event = kind == "EVENT"
    active = int((is_event & (at > start) & (at < stop)).sum())
    orphan += int((is_event & (at < min(start, stop))).sum())
    late += int((is_event & (at > stop)).sum())
    events += active
    status = "UNSUBSCRIBED" if stop < len(kind) else "ACTIVE" if active else "STARTED" if status == "NEW" and start < len(kind) else status
    state.update((status, events, late, orphan))
    yield pd.DataFrame({"feed": [key[0]], "status": [status], "events": [events], "late": [late], "orphan": [orphan]})


def subscriptions(feed: DataFrame) -> DataFrame:
    """State of each feed: started, active at its first event, unsubscribed for good.

    Events after the end are late, events before any signal orphans. State is a
    status and three counters for each feed; it doesn't expire, as an idle timeout keeps a run over all available data from ending. Rows of
    a micro-batch are taken in order of ``seq``; micro-batches come in order.
    """
    return feed.groupBy("feed").applyInPandasWithState(
        _step, "feed long, status string, events long, late long, orphan long", "status string, events long, late long, orphan long", "update", GroupStateTimeout.NoTimeout
    )


def subscriptions_batch(feed: DataFrame) -> DataFrame:
    """The same result from a whole table: bounds of each feed, then counts between them."""
    ends = feed.groupBy("feed").agg(
        F.min(F.when(F.col("kind") == "START", F.col("seq"))).alias("start"), F.min(F.when(F.col("kind") == "STOP", F.col("seq"))).alias("stop")
    )
    first = F.least("start", "stop")  # the one that is there, if one only
    event = F.col("kind") == "EVENT"
    late = F.coalesce(F.col("seq") > F.col("stop"), F.lit(False))
    orphan = F.coalesce(F.col("seq") < first, F.lit(True))
    out = feed.join(ends, "feed").groupBy("feed").agg(
        F.count_if(event & ~late & ~orphan).alias("events"), F.count_if(event & late).alias("late"),
        F.count_if(event & orphan).alias("orphan"), F.max("start").alias("start"), F.max("stop").alias("stop"),
    )
    status = F.when(F.col("stop").isNotNull(), "UNSUBSCRIBED").when(F.col("events") > 0, "ACTIVE").when(F.col("start").isNotNull(), "STARTED").otherwise("NEW")
    return out.select("feed", status.alias("status"), "events", "late", "orphan")


def append_days(days: DataFrame, target: str, checkpoint: str, closed_before: int) -> None:
    """Appends a stream of bars to a month-partitioned table; months before ``closed_before`` stay as they are.

    Each micro-batch writes to a folder of its own number and overwrites it when
    it is run again, so a batch that is repeated after a failure changes nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("month", month_of(F.col("trade_date"))).where(F.col("month") >= closed_before)
        rows.write.mode("overwrite").partitionBy("month").parquet(f"{target}/batch={number}")

    q = days.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
