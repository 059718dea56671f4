"""Tracking events as streams (T1-T3): the operators take streaming and batch tables alike; (obj_id, row_id, state, changed)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _changed_first(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """An object's first time so far, kept as state; rows say that it counts in a window, or no more in another."""
    seen = min(int(f["at"].min()) for f in frames)
    known = state.get[0] if state.exists else None
    if known is not None and known <= seen:
        return
    state.update((seen,))
    yield pd.DataFrame({"at": [seen] + ([known] if known is not None else []), "n": [1] + ([-1] if known is not None else [])})


def new_items_per_window(events: DataFrame, window: str = "7 days") -> DataFrame:
    """How many objects are first seen in each tumbling window.

    A stream gives changes of these numbers, in append mode: 1 in the window of an object's first event so far, and -1 in the window that it counted in if an earlier
    event comes later. Added up by window (`added_up`), they are what the batch form gives for all events so far, however long an object was away and in whatever order events come.
    The state is one time for each object, touched only by its own events.
    """
    if not events.isStreaming:
        first = events.groupBy("obj_id").agg(F.min("changed").alias("changed"))
        return first.groupBy(F.window("changed", window).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), "n")
    some = events.select("obj_id", F.unix_micros("changed").alias("at")).where("at IS NOT NULL")
    moved = some.groupBy("obj_id").applyInPandasWithState(_changed_first, "at long, n long", "first long", "append", GroupStateTimeout.NoTimeout)
    return moved.select(F.window(F.timestamp_micros("at"), window)["start"].alias("window_start"), "n")


def added_up(changes: DataFrame) -> DataFrame:
    """Windows with their numbers, from all changes that a stream has written."""
    return changes.groupBy("window_start").agg(F.sum("n").alias("n")).where("n <> 0")


def latest_state(events: DataFrame) -> DataFrame:
    """The newest state of each object; a stream keeps one row of state for each object and runs in update or complete mode."""
    return events.groupBy("obj_id").agg(F.max(F.struct("changed", "row_id", "state")).alias("v")).select("obj_id", F.col("v.state").alias("state"), F.col("v.changed").alias("changed"))


def state_changes(events: DataFrame, previous: DataFrame) -> DataFrame:
    """Objects whose newest state among some events differs from the one that they had (obj_id, state, changed), with both; null before the first."""
    now = latest_state(events)
    old = previous.select("obj_id", F.col("state").alias("before"), F.col("changed").alias("_old"))
    joined = now.join(old, "obj_id", "left").where(F.col("_old").isNull() | (F.col("changed") >= F.col("_old")))
    return joined.where(~F.col("before").eqNullSafe(F.col("state"))).select("obj_id", "before", "state", "changed")


def _changed_state(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """An object's newest version so far (time, row, value), kept as state; a row if its value is another now."""
    versions = ((int(at), int(row), None if pd.isna(value) else value) for f in frames for at, row, value in zip(f["at"], f["row_id"], f["state"], strict=True))
    newest = max(versions, key=lambda x: (x[0], x[1], str(x[2])))
    known = state.get if state.exists else None
    if known is not None and known[:2] >= newest[:2]:
        return
    state.update(newest)
    if known is None or known[2] != newest[2]:
        yield pd.DataFrame({"obj_id": [key[0]], "before": [known[2] if known is not None else None], "state": [newest[2]], "at": [newest[0]]})


def stream_changes(stream: DataFrame) -> DataFrame:
    """A stream's status changes (obj_id, before, state, changed), in append mode: of each micro-batch the objects whose newest value differs from the one that
    they had. Each object's newest version is keyed state: a micro-batch reads and writes that of its own objects only."""
    some = stream.select("obj_id", "row_id", "state", F.unix_micros("changed").alias("at")).where("at IS NOT NULL AND row_id IS NOT NULL")
    out = some.groupBy("obj_id").applyInPandasWithState(_changed_state, "obj_id long, before string, state string, at long", "at long, row_id long, state string", "append", GroupStateTimeout.NoTimeout)
    return out.select("obj_id", "before", "state", F.timestamp_micros("at").alias("changed"))


def emit_changes(stream: DataFrame, folder: str, checkpoint: str):
    """A writer of a stream's status changes to Parquet files under folder, each once, whatever is run again. What a micro-batch writes, state included, follows its size."""
    return stream_changes(stream).writeStream.format("parquet").outputMode("append").option("path", folder).option("checkpointLocation", checkpoint)


def activity_sessions(events: DataFrame, gap: str = "1 hour", late: str = "1 day") -> DataFrame:
    """An object's events with gaps of less than `gap` between them are a session."""
    marked = events.withWatermark("changed", late) if events.isStreaming else events
    sessions = marked.groupBy("obj_id", F.session_window("changed", gap).alias("w")).agg(F.count("*").alias("n"))
    return sessions.select("obj_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
