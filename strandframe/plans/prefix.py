"""Running values along chromosomes in two levels, so that no task gets a whole chromosome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Positions in a block, the unit in which window functions run.
BLOCK = 1 << 14


def block_of(pos: Column, size: int = BLOCK) -> Column:
    return F.floor(pos / size).cast("long")


def running(df: DataFrame, keys: list[str], pos: str, order: list, value: Column, name: str, how: str, inclusive: bool = True, block: int = BLOCK) -> DataFrame:
    """Adds `name`: the running sum, max, min or count of `value` over rows of equal keys in `order` (which begins with pos).

    Values run within blocks of positions; the blocks' totals, few, are added up before rows meet, run along the keys, and the two are put together. Without
    `inclusive`, the row itself doesn't count. Rows that tie in `order` are taken one after another, so order should be total.
    """
    add = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}[how]
    both = {"sum": lambda a, b: F.coalesce(a + b, a, b), "count": lambda a, b: F.coalesce(a + b, a, b), "max": lambda a, b: F.greatest(a, b), "min": lambda a, b: F.least(a, b)}[how]
    marked = df.withColumns({"_block": block_of(F.col(pos), block), "_value": value})
    inside = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    along = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum if how == "count" else add
    before = marked.groupBy(*keys, "_block").agg(add("_value").alias("_total")).select(*keys, "_block", total("_total").over(along).alias("_before"))
    return marked.withColumn("_inside", add("_value").over(inside)).join(before, [*keys, "_block"]).withColumn(name, both(F.col("_before"), F.col("_inside"))).drop("_block", "_value", "_inside", "_before")


def neighbour(df: DataFrame, keys: list[str], pos: str, order: list, value: Column, name: str, ahead: bool = False, block: int = BLOCK) -> DataFrame:
    """Adds `name`: the value of the row before (or ahead) in `order` (which begins with pos) among rows of equal keys; null for the first (last). Rows look within
    their block; a block's outermost row takes it from the nearest block that has any, of which there is one row each. Values must not be null."""
    marked = df.withColumns({"_block": block_of(F.col(pos), block), "_value": value})
    inside, along = Window.partitionBy(*keys, "_block").orderBy(*order), Window.partitionBy(*keys).orderBy("_block")
    step = F.lead if ahead else F.lag
    key = F.struct(*order)
    outer = (F.min_by if ahead else F.max_by)("_value", key)
    edges = marked.groupBy(*keys, "_block").agg(outer.alias("_edge")).select(*keys, "_block", step("_edge").over(along).alias("_far"))
    return marked.withColumn("_near", step("_value").over(inside)).join(edges, [*keys, "_block"]).withColumn(name, F.coalesce("_near", "_far")).drop("_block", "_value", "_near", "_far")


def with_halo(df: DataFrame, pos: str, width: int, block: int = BLOCK) -> DataFrame:
    """Each row in its block (`block_no`, with `home` true), and again in the next or previous block if it lies within `width` of it: windows
    of that width may then run block by block, and rows that aren't at home are dropped afterwards."""
    if width > block:
        raise ValueError("width must not exceed the block")
    first, last = block_of(F.col(pos) - width, block), block_of(F.col(pos) + width, block)
    spread = df.withColumn("block_no", F.explode(F.sequence(first, last)))
    return spread.withColumn("home", F.col("block_no") == block_of(F.col(pos), block))
