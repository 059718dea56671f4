"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the input folder, read by Spark (the folder may be in any store that Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, spark.checkpoint.dir. Where it is unset, a session on this machine alone (tests) gets a
    new local folder; on a cluster such a folder would lose the rows that other machines write, so there it is a ValueError."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to a new folder of the shared folder and reads it back: a cut of the lineage that lost executors can't undo."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def crc32_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def input_partitions(df: DataFrame) -> int:
    """Partitions that a scan of df has: a measure of its size that needs no job."""
    return max(1, df.rdd.getNumPartitions())


def named(column: str) -> Column:
    """A column by its whole name, which may hold dots and backticks."""
    return F.col(f"`{column.replace('`', '``')}`")


def free_name(name: str, taken: Iterable[str]) -> str:
    """name, or name with underscores before it, such that no column in `taken` has it (in either case of letters)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def shielded(df: DataFrame, *kept: str) -> tuple[DataFrame, dict[str, str]]:
    """df with all columns but `kept` under names that no operator here uses, and the names that they had before: for operators that
    add columns of their own."""
    names = {free_name(f"column_{k}_of_input", kept): c for k, c in enumerate(df.columns) if c not in kept}
    back = {c: n for n, c in names.items()}
    return df.toDF(*(back.get(c, c) for c in df.columns)), names


def unshielded(df: DataFrame, names: dict[str, str], columns: list[str]) -> DataFrame:
    """The columns that shielded() got, as they were."""
    back = {c: n for n, c in names.items()}
    return df.select(*(named(back.get(c, c)).alias(c) for c in columns))
