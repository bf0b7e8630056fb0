"""Streaming forms of the batch operators; an extension, as the batch steps have no streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.history import RunState


def first_seen(stream: DataFrame, keys: Sequence[str], time: str, late: str = "3 days") -> DataFrame:
    """The first row of each key within the watermark. A batch keeps the latest instead: a stream
    can't know it before the watermark has passed."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, by: str, time: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    return stream.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("n"))


def into_history(stream: DataFrame, state: RunState, keys: Sequence[str], checkpoint: str):
    """Each micro-batch's new pairs are appended to history and cache, under the batch's number: what is
    written is what is new, and a batch that is repeated finds itself committed and does nothing."""

    def commit(batch: DataFrame, number: int) -> None:
        done, known = state.latest_tag(), state.read("history")
        if done is not None and number <= done:
            return
        new = batch.dropDuplicates(list(keys))
        if known is not None:
            new = new.join(known.select(*keys), list(keys), "left_anti")
        new = new.persist()
        try:
            state.append(new.select(*keys), new, number)
        finally:
            new.unpersist()

    return stream.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
