"""Versioned tables (M1-M8, J13, W7, W8, T2's batch form): rows (row_id, obj_id, state, processed, changed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

VERSION = ("changed", "row_id")


def _newest(df: DataFrame) -> DataFrame:
    """The newest row of each object: a maximum, taken before the shuffle too, so that long histories aren't gathered."""
    rest = [c for c in df.columns if c not in ("obj_id", *VERSION)]
    return df.groupBy("obj_id").agg(F.max(F.struct(*VERSION, *rest)).alias("v")).select("obj_id", "v.*").select(*df.columns)


def latest(hist: DataFrame) -> DataFrame:
    """M1: the newest version of each object."""
    return _newest(hist)


def as_of(hist: DataFrame, when: Column) -> DataFrame:
    """The newest version of each object from strictly before a time."""
    return _newest(hist.where(F.col("changed") < when))


def by_row_id(hist: DataFrame, row_id: int) -> DataFrame:
    """M2: the version that a row id names."""
    return hist.where(F.col("row_id") == row_id)


def most_recent(hist: DataFrame) -> DataFrame:
    """M2: the newest row of each object of a table with `latest`, also where that isn't set any more (deleted objects)."""
    return _newest(hist)


def current(hist: DataFrame) -> DataFrame:
    """M2: the rows of a table with `latest` for which it is set: no row of a deleted object."""
    return hist.where("latest")


def first_seen(hist: DataFrame, since: Column | None = None, until: Column | None = None) -> DataFrame:
    """The first change of each object; with an interval, only of objects first seen in it (from since on, before until)."""
    first = hist.groupBy("obj_id").agg(F.min("changed").alias("first_seen"))
    first = first.where(F.col("first_seen") >= since) if since is not None else first
    return first.where(F.col("first_seen") < until) if until is not None else first


def versions(hist: DataFrame) -> DataFrame:
    """M4: versions numbered in order."""
    return hist.withColumn("version", F.row_number().over(Window.partitionBy("obj_id").orderBy(*VERSION)))


def state_change(hist: DataFrame, field: str = "state") -> DataFrame:
    """For each object, its current value and when it last had another one."""
    now = _newest(hist).select("obj_id", F.col(field).alias("current"))
    return hist.join(now, "obj_id").groupBy("obj_id", "current").agg(F.max(F.when(~F.col(field).eqNullSafe(F.col("current")), F.col("changed"))).alias("last_other"))


def was_processed(hist: DataFrame, mask: int) -> DataFrame:
    """Objects whose newest version has the flag, and when its latest run of versions with the flag began."""
    on = F.col("processed").bitwiseAND(F.lit(mask)) != 0
    off = hist.groupBy("obj_id").agg(F.max(F.when(~on, F.struct(*VERSION))).alias("off"))
    later = hist.join(off, "obj_id").where(F.col("off").isNull() | (F.struct(*VERSION) > F.col("off")))
    return later.groupBy("obj_id").agg(F.min("changed").alias("since"))


def append_versions(hist: DataFrame, updates: DataFrame) -> DataFrame:
    """M3: history (with `latest`, whether a row is its object's newest) with updates (obj_id, based_on, state, row_id, changed) added whose based_on is the newest
    row_id and whose state is new; what was the newest row of such an object is so no more. Of several such updates of an object the first by (changed, row_id) is added:
    it makes a newer row, on which the others aren't based."""
    now = _newest(hist).select("obj_id", F.col("row_id").alias("_row"), F.col("state").alias("_state"), "processed", "value")
    valid = updates.join(now, "obj_id").where((F.col("based_on") == F.col("_row")) & ~F.col("state").eqNullSafe(F.col("_state")))
    rest = [c for c in hist.columns if c not in ("obj_id", "latest", *VERSION)]
    fresh = valid.groupBy("obj_id").agg(F.min(F.struct(*VERSION, *rest)).alias("v")).select("obj_id", "v.*").withColumn("latest", F.lit(True))
    old = hist.join(fresh.select("obj_id", F.lit(True).alias("_fresh")), "obj_id", "left").withColumn("latest", F.col("latest") & F.col("_fresh").isNull())
    return old.select(*hist.columns).unionByName(fresh.select(*hist.columns))


def with_latest(hist: DataFrame) -> DataFrame:
    """M1: the history with `latest`, whether a row is its object's newest."""
    top = hist.groupBy("obj_id").agg(F.max(F.struct(*VERSION)).alias("_top"))
    return hist.join(top, "obj_id").withColumn("latest", F.struct(*VERSION) == F.col("_top")).drop("_top")


#: The QC states that a row may have.
QC_STATES = ("no_qc", "pending", "passed", "failed", "gt_pending", "investigate")


def flagged(hist: DataFrame, mask: int, positive: bool = True, qc: list[str] | None = None) -> DataFrame:
    """M8: newest versions that have all bits of a mask, or none; with `qc`, only in these QC states (column qc_status), which must be known ones."""
    if unknown := sorted(set(qc or ()) - set(QC_STATES)):
        raise ValueError(f"no QC states: {', '.join(unknown)}")
    bits = F.col("processed").bitwiseAND(F.lit(mask))
    found = _newest(hist).where(bits == (mask if positive else 0))
    return found.where(F.col("qc_status").isin(qc)) if qc else found


def changed_since(hist: DataFrame, when: Column) -> DataFrame:
    """M5: objects whose state at a time differs from the newest one, with both (null before the first version)."""
    before = as_of(hist, when).select("obj_id", F.col("state").alias("before"))
    now = _newest(hist).select("obj_id", F.col("state").alias("now"))
    return now.join(before, "obj_id", "left").where(~F.col("before").eqNullSafe(F.col("now")))


def ambiguous_values(df: DataFrame, field: str, key: str) -> DataFrame:
    """M7: values that belong to more than one key."""
    return df.groupBy(field).agg(F.count_distinct(key).alias("n_keys")).where("n_keys > 1")


def lookup_unique(df: DataFrame, field: str, value: object, key: str) -> DataFrame:
    """M7: the key that a value belongs to; an error when the table is computed if there are several, no row if there is none."""
    one = df.where(F.col(field) == value).agg(F.min(key).alias(key), F.count_distinct(key).alias("_n")).where("_n > 0")
    return one.select(F.when(F.col("_n") == 1, F.col(key)).otherwise(F.raise_error(F.lit(f"{value} belongs to several keys"))).alias(key))
