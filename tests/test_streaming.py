"""Streams of versions against the batch forms, batch by batch."""

from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from strandframe.streaming import tracking

SCHEMA = "row_id long, obj_id long, state string, changed timestamp"


def at(day, hour=0):
    return datetime(2024, 1, 1) + timedelta(days=day, hours=hour)


def feed(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def run(writer):
    query = writer.trigger(availableNow=True).start()
    assert query.awaitTermination(100)


def test_changes(spark, tmp_path):
    batches = [[(1, 1, "a", 1), (2, 1, "x", 1)], [(3, 1, "b", 2), (4, 2, "x", 2)], [(5, 1, "b", 3), (6, 3, "n", 3), (7, 2, "old", 0), (8, 3, None, 4)]]
    wanted = [[(1, None, "x")], [(1, "x", "b"), (2, None, "x")], [(3, None, None)]]
    for k, rows in enumerate(batches):
        feed(spark, tmp_path / "in", [(i, o, s, at(d)) for i, o, s, d in rows])
        run(tracking.emit_changes(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")))
        found = spark.read.parquet(str(tmp_path / "out"))
        assert sorted(((r.obj_id, r.before, r.state) for r in found.collect()), key=repr) == sorted((x for some in wanted[: k + 1] for x in some), key=repr)
    last = found.groupBy("obj_id").agg(F.max_by("state", "changed").alias("state"), F.max("changed").alias("changed"))
    assert {(r.obj_id, r.state) for r in last.collect()} == {(1, "b"), (2, "x"), (3, None)}


def test_written_state_follows_the_batch(spark, tmp_path):
    deltas = lambda: sum(p.stat().st_size for p in Path(tmp_path / "cp/state").rglob("*.delta"))
    sizes = []
    for rows in ([(i, i, "a", at(0)) for i in range(20_000)], [(30_000, 5, "b", at(1)), (30_001, 6, "a", at(1))]):
        before = deltas()
        feed(spark, tmp_path / "in", rows)
        run(tracking.emit_changes(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp")))
        sizes.append(deltas() - before)
    assert sizes[1] < sizes[0] / 20
    assert spark.read.parquet(str(tmp_path / "out")).where("before IS NOT NULL").count() == 1


def test_new_items_equal_the_batch(spark, tmp_path):
    """An object that comes again after 30 days counts once; an earlier event that comes later moves it."""
    batches = [[(1, 1, "a", at(3)), (2, 2, "a", at(20)), (3, 1, "b", at(4))], [(4, 1, "a", at(40)), (5, 3, "a", at(41))], [(6, 2, "a", at(1, 5)), (7, 3, "c", at(41)), (8, 4, "c", None)]]
    seen = []
    for rows in batches:
        seen += [r for r in rows if r[3]]
        feed(spark, tmp_path / "in", rows)
        changes = tracking.new_items_per_window(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))
        run(changes.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")))
        found = tracking.added_up(spark.read.parquet(str(tmp_path / "out")))
        want = tracking.new_items_per_window(spark.createDataFrame(seen, SCHEMA))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
