"""Exact duplicates: rows grouped by a 128-bit hash of their normalised text, texts compared inside each group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, write_table

#: What normalising deletes: U+0020 and U+0009 to U+000D.
BLANKS = r"[\x20\x09-\x0D]+"
#: A class of equal texts that holds over one row in so many is broadcast, so there can't be more than so many of them.
HOT_CLASSES = 1000
#: Colliding hashes up to which they are broadcast.
FEW_HASHES = 10_000
#: A row's order is one number: ids take 65 bits, the length comes above them.
ID_SPAN, ID_TOP = 1 << 65, 1 << 63
ADDED = ["keep_id", "group_size", "kept", "text_sha256"]


def normalised(text: Column) -> Column:
    """The text without white space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def _exact(value: int | Column) -> Column:
    return (F.lit(str(value)) if isinstance(value, int) else value).cast("decimal(38,0)")


def _order(length: Column, doc_id: Column) -> Column:
    """One number that grows with the length and, at equal length, falls with the id; a null id comes last."""
    return (_exact(length) * _exact(ID_SPAN) + F.coalesce(_exact(ID_TOP) - _exact(doc_id), _exact(0))).cast("decimal(38,0)")


def _classes(rows: DataFrame) -> DataFrame:
    """One row for each distinct content: its hash, the order of the row that stays and the number of rows. Copies meet in their own partition first."""
    return rows.groupBy("hash", "content").agg(F.max("order").alias("best"), F.count(F.lit(1)).alias("size"))


def _joined(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows with their class by hash alone, in one pass over rows. Classes that hold many of the rows are broadcast; their rows have keys of their own, longer than
    any hash, in the shuffle that looks up the others."""
    bound = (classes.agg(F.sum("size")).first()[0] or 0) // HOT_CLASSES
    hot = F.broadcast(classes.where(F.col("size") > bound).withColumnsRenamed({"best": "hot_best", "size": "hot_size"}))
    own = F.concat("hash", F.unhex(F.md5(F.col("order").cast("string"))))
    keyed = rows.join(hot, "hash", "left").withColumn("key", F.when(F.col("hot_size").isNull(), F.col("hash")).otherwise(own)).drop("hash")
    found = keyed.join(classes.where(F.col("size") <= bound).withColumnRenamed("hash", "key"), "key", "left").drop("key")
    return found.withColumns({n: F.coalesce(f"hot_{n}", n) for n in ("best", "size")}).drop("hot_best", "hot_size")


def mark_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content_hash: Callable[[Column], Column] = F.md5) -> DataFrame:
    """All rows and columns of docs with keep_id (the id of the row that stays of those with equal text), group_size, kept and text_sha256 (of the
    normalised text); input columns of these names, in either case of letters, give way.

    Texts are equal when they are identical without their white space (U+0020, U+0009 to U+000D); a null text counts as empty. The row with the
    most code points in its own text stays, then the one with the smallest id; a null id comes after all others. Rows that repeat the
    staying row's id and length of text are that row again and are all marked kept: ids are the only thing that tells rows apart. An
    empty table gives no rows. Texts of any length are compared whole. Ids are whole numbers.

    Rows are grouped by (hash, text): the hash deals them out, the text itself is compared, so texts that collide are classes of their own. A
    partition sends a text once, however many copies it holds. Classes are written without their texts, and rows join them by hash
    alone; only rows whose hash stands for several classes, if there are any, join by the text as well. `content_hash` gives hexadecimal digits.
    """
    columns = docs.columns
    df = docs.toDF(*(f"c{k}" for k in range(len(columns))))
    doc_id, text = (F.col(f"c{columns.index(c)}") for c in (id_col, text_col))
    rows = df.withColumn("content", normalised(text)).withColumns(
        {"hash": F.unhex(content_hash(F.col("content"))), "order": _order(F.length(F.coalesce(text, F.lit(""))), doc_id), "text_sha256": F.sha2("content", 256)}
    )
    classes = write_table(_classes(rows).drop("content"), "texts")
    clashing = write_table(classes.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash"), "clashes")
    n_clashing = clashing.count()
    if n_clashing:
        few = F.broadcast(clashing) if n_clashing <= FEW_HASHES else clashing
        odd = rows.join(few, "hash", "left_semi")
        found = _joined(rows.join(few, "hash", "left_anti").drop("content"), classes.join(few, "hash", "left_anti"))
        found = found.unionByName(odd.join(_classes(odd), ["hash", "content"]).drop("hash", "content"))
    else:
        found = _joined(rows.drop("content"), classes)
    best_id = _exact(ID_TOP) - F.col("best") % _exact(ID_SPAN)
    marks = {
        "keep_id": F.when(F.col("best") % _exact(ID_SPAN) > 0, best_id.cast("long")),
        "group_size": F.col("size"),
        "kept": F.col("order") == F.col("best"),
        "text_sha256": F.col("text_sha256"),
    }
    left = [(k, c) for k, c in enumerate(columns) if c.lower() not in ADDED]
    return found.select(*(F.col(f"c{k}").alias(c) for k, c in left), *(v.alias(n) for n, v in marks.items()))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with the columns of docs: of equal texts the longest as written, then the smallest id (see mark_duplicates)."""
    columns = docs.columns
    renamed = docs.toDF(*(f"in{k}" for k in range(len(columns))))
    marked = mark_duplicates(renamed, *(f"in{columns.index(c)}" for c in (id_col, text_col)))
    return marked.where("kept").select(*(named(f"in{k}").alias(c) for k, c in enumerate(columns)))
