"""Closures over parent-child tables and paths by a template (M6, M9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import written

NODE = ["level", "id"]


def edges_of(rows: DataFrame, levels: list[tuple[str, str]]) -> DataFrame:
    """The distinct edges (parent_level, parent, level, id) of a table that has a column for each level, outermost first: (level, column)."""
    both = list(zip(levels, levels[1:], strict=False))
    text = lambda c: F.col(c).cast("string")
    steps = F.array(*(F.struct(F.lit(a).alias("parent_level"), text(x).alias("parent"), F.lit(b).alias("level"), text(y).alias("id")) for (a, x), (b, y) in both))
    return rows.select(F.explode(steps).alias("e")).select("e.*").where("parent IS NOT NULL AND id IS NOT NULL").distinct()


def descendants(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """M6: level, id and depth (steps from the nearest root) of all that lies below `roots` (level, id) by edges (parent_level, parent, level, id), of any number of levels.

    One step of the closure is a join of the last step's finds, written in between, with the edges; each node carries one way down to it. A node that lies below itself is an error, as
    the tables then are no hierarchy: ways get longer until one of them meets itself. The number of steps is the depth of the hierarchy.
    """
    spark = roots.sparkSession
    step = written(roots.select(*(F.col(c).cast("string").alias(c) for c in NODE)).distinct().withColumn("above", F.array(F.concat_ws("\n", *NODE))), "descendants")
    found = spark.createDataFrame([], "level string, id string, depth int")
    depth = 0
    while True:
        depth += 1
        name = F.concat_ws("\n", *NODE)
        below = written(step.withColumnsRenamed({"level": "parent_level", "id": "parent"}).join(edges, ["parent_level", "parent"]).select(*NODE, "above"), "descendants")
        looped = below.where(F.array_contains("above", name)).select(*NODE).first()
        if looped:
            raise ValueError(f"below itself: {looped['level']} {looped['id']}")
        step = written(below.withColumn("above", F.array_append("above", name)).dropDuplicates(NODE), "descendants")
        if step.isEmpty():
            return found.groupBy(*NODE).agg(F.min("depth").alias("depth"))
        found = found.unionByName(step.select(*NODE, F.lit(depth).alias("depth")))


# What a term of a path makes of its column, if not just its text.
def _genus(species: Column) -> Column:
    return F.substring_index(species, " ", 1)


def _species(species: Column) -> Column:
    return F.regexp_replace(F.when(F.contains(species, F.lit(" ")), F.regexp_replace(species, "^[^ ]* ", "")).otherwise(""), "[^A-Za-z0-9_]|_+", "_")


TERMS = {"genus": _genus, "species-subspecies": lambda c: F.regexp_replace(_species(c), "_+", "_")}
TEMPLATE = "project:sample:technology:library:lane"


def path_of(rows: DataFrame, level: str, columns: dict[str, str], template: str = TEMPLATE) -> Column:
    """M9: the path of each row, which stands for an entity of a level: the template's terms, separated by colons, up to the one of that level, joined by slashes. `columns` has the column of each
    term; genus and species-subspecies are the first word and the rest of theirs, with _ for what is no letter or digit. Another term stands for itself. The path is null if
    a value is missing."""
    out = []
    for term in template.split(":"):
        if term in columns:
            value = F.col(columns[term])
            out.append(TERMS[term](value) if term in TERMS else value.cast("string"))
        else:
            out.append(F.lit(term))
        if term == level:
            break
    missing = [rows[c].isNull() for t, c in columns.items() if t in template.split(":")[: len(out)]]
    path = F.concat_ws("/", *out)
    return F.when(~F.array_contains(F.array(*missing), True), path) if missing else path
