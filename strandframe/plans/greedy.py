"""Greedy filling of chunks by jump pointers: where each chunk begins follows from where the one before began, yet no task sees all records."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .prefix import running
from .shared import written

#: Sizes of a chunk that a block of records spans, and nodes that are put together at once.
SPAN, FAN = 16, 64
#: A table's rows: from a mark `lo` on, up to the next row's, a chunk that the next record beyond the mark begins leads to the mark `to` after `n` chunks. to = PASS: no record lies
#: beyond the mark, which stays.
TABLE = "node long, lo long, to long, n long"
PASS, FIRST = -1, -(1 << 62)


def _jumps(before: np.ndarray, end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each record that begins a chunk, the mark that the chunk's records may reach, and the record that begins the next one (the number of records: none here)."""
    mark = np.maximum(before + size, end)
    return mark, np.searchsorted(end, mark, "right")


def _exits(size: int):
    def of(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        before, end = block["before"].to_numpy(), block["end"].to_numpy()
        mark, jump = _jumps(before, end, size)
        m = len(end)
        jump, last, n = np.append(jump, m), np.arange(m + 1), np.append(np.ones(m, np.int64), 0)
        while (jump[:m] < m).any():  # each round doubles the jumps taken
            on = jump < m
            last, n = np.where(on, last[np.minimum(jump, m)], last), n + np.where(on, n[jump], 0)
            jump = jump[jump]
        # a chunk that began before the block reaches one size into it at most, or, if it is one long record, to where the block's first record begins
        most = int(np.searchsorted(end, max(int(block["node"].iloc[0]) * size * SPAN + size, int(before[0])), "right"))
        k = np.arange(min(most, m - 1) + 1)
        lo, to, count = np.append(FIRST, end)[k], mark[last[k]], n[k]
        if most >= m - 1:
            lo, to, count = np.append(lo, end[-1]), np.append(to, PASS), np.append(count, 0)
        return pd.DataFrame({"node": int(block["node"].iloc[0]), "lo": lo, "to": to, "n": count})

    return of


def _then(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """The table of two neighbours as one."""
    lo, to, n = (b[c].to_numpy() for c in ("lo", "to", "n"))
    real = a[a["to"] != PASS]
    at = np.searchsorted(lo, real["to"].to_numpy(), "right") - 1
    rows = [pd.DataFrame({"lo": real["lo"].to_numpy(), "to": np.where(to[at] == PASS, real["to"].to_numpy(), to[at]), "n": real["n"].to_numpy() + n[at]})]
    if len(real) < len(a):
        mark = int(a["lo"].iloc[-1])
        first = int(np.searchsorted(lo, mark, "right")) - 1
        rows.append(pd.DataFrame({"lo": np.maximum(lo[first:], mark), "to": to[first:], "n": n[first:]}))
    return pd.concat(rows)


def _children(tables: pd.DataFrame) -> list[tuple[int, pd.DataFrame]]:
    return [(int(node), t.sort_values("lo")[["lo", "to", "n"]]) for node, t in tables.groupby("node", sort=True)]


def _merged(fan: int):
    def of(tables: pd.DataFrame) -> pd.DataFrame:
        parts = _children(tables)
        out = parts[0][1]
        for _, table in parts[1:]:
            out = _then(out, table)
        return out.assign(node=parts[0][0] // fan)[["node", "lo", "to", "n"]]

    return of


def _handed_down(tables: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
    """Each child's entry: the mark that it is entered with and the chunks begun before."""
    mark, chunk, out = int(entry["mark"].iloc[0]), int(entry["chunk"].iloc[0]), []
    for node, table in _children(tables):
        out.append((node, mark, chunk))
        row = table.iloc[int(np.searchsorted(table["lo"].to_numpy(), mark, "right")) - 1]
        mark, chunk = mark if row["to"] == PASS else int(row["to"]), chunk + int(row["n"])
    return pd.DataFrame(out, columns=["node", "mark", "chunk"])


def _numbered(size: int):
    def of(block: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("place")
        end = block["end"].to_numpy()
        _, jump = _jumps(block["before"].to_numpy(), end, size)
        starts, at = [], int(np.searchsorted(end, int(entry["mark"].iloc[0]), "right"))
        while at < len(end):
            starts.append(at)
            at = int(jump[at])
        chunk = int(entry["chunk"].iloc[0]) + np.searchsorted(starts, np.arange(len(end)), "right") - 1
        return pd.DataFrame({"place": block["place"].to_numpy(), "chunk": chunk})

    return of


def filled_chunks(records: DataFrame, place: str, length: str, size: int, fan: int = FAN) -> DataFrame:
    """place and chunk (from 0) of records in the order of `place` (whole numbers, unique): a chunk takes records as long as its length stays within `size`; one record that is longer is a
    chunk of its own. Records of length 0 stay in the chunk before them.

    Records are dealt into blocks by the length before them. For each record that may come first in a block, jump pointers, doubled, tell after how many chunks the block is
    left and how far the last one reaches; these tables, of about one chunk's records each, are put together `fan` at a time, up to one, and then tell, on the way down, how each
    block is entered. Steps follow the logarithm of the number of blocks; a task holds a block, or the tables of `fan` neighbours.
    """
    spark = records.sparkSession
    some = records.select(F.col(place).cast("long").alias("place"), F.coalesce(F.col(length), F.lit(0)).cast("long").alias("len"))
    run = running(some, [], "place", ["place"], F.col("len"), "before", "sum", inclusive=False).withColumn("before", F.coalesce("before", F.lit(0)))
    blocks = written(run.select(F.floor(F.col("before") / (size * SPAN)).cast("long").alias("node"), "place", "before", (F.col("before") + F.col("len")).alias("end")), "blocks")
    levels = [written(blocks.groupBy("node").applyInPandas(_exits(size), TABLE), "exits")]
    top = blocks.agg(F.max("node")).first()[0] or 0
    while top > 0:
        levels.append(written(levels[-1].groupBy(F.floor(F.col("node") / fan)).applyInPandas(_merged(fan), TABLE), "exits"))
        top //= fan
    entries = spark.createDataFrame([(0, -1, 0)], "node long, mark long, chunk long")
    for table in reversed(levels[:-1]):
        parents = table.groupBy(F.floor(F.col("node") / fan).cast("long"))
        entries = parents.cogroup(entries.groupBy("node")).applyInPandas(_handed_down, "node long, mark long, chunk long")
    return blocks.groupBy("node").cogroup(entries.groupBy("node")).applyInPandas(_numbered(size), "place long, chunk long")
