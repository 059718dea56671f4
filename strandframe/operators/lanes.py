"""Lanes against a sequence index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_against_index(lanes: DataFrame, known: DataFrame, fields: list[str]) -> DataFrame:
    """A row of each discrepancy between given lanes (lane and fields) and the known ones (lane, fields, withdrawn): 'not in db', 'withdrawn'
    (then nothing else is told), '<field> swap', and 'missing' for known lanes of the given lanes' samples that aren't listed."""
    renamed = known.select("lane", *(F.col(c).alias(f"_{c}") for c in fields), F.coalesce("withdrawn", F.lit(False)).alias("_gone"), F.lit(True).alias("_known"))
    x = lanes.select("lane", *fields).join(renamed, "lane", "left")
    there = F.coalesce("_known", F.lit(False)) & ~F.coalesce("_gone", F.lit(False))
    swaps = [F.when(there & ~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(f"{c} swap")) for c in fields]
    problems = F.array_compact(F.array(F.when(F.col("_known").isNull(), "not in db"), F.when(F.col("_gone"), "withdrawn"), *swaps))
    told = x.select("lane", F.explode(problems).alias("problem"))
    samples = x.where(there).select(F.col("_sample").alias("sample")).distinct()
    missing = known.where(~F.coalesce("withdrawn", F.lit(False))).join(samples, "sample", "left_semi").join(lanes, "lane", "left_anti")
    return told.union(missing.select("lane", F.lit("missing").alias("problem")))


def new_samples_to_map(study: DataFrame, current: DataFrame) -> DataFrame:
    """Samples (sample, individual) of a study that current (the same columns) lacks, and whether their individual is a new one."""
    known = current.select("individual").distinct().withColumn("_known", F.lit(True))
    fresh = study.select("sample", "individual").distinct().join(current.select("sample").distinct(), "sample", "left_anti")
    return fresh.join(known, "individual", "left").select("sample", "individual", F.when(F.col("_known"), "existing individual").otherwise("new individual").alias("status"))


def sync_lanes(index: DataFrame, lanes: DataFrame, major: bool) -> DataFrame:
    """Changes that a new sequence index (lane, file, withdrawn, mate_file) asks of the newest lanes (lane, withdrawn, paired). A lane is withdrawn if any file is, and
    paired if two files at least name a mate. Reversals, and flagging lanes that the index lacks as deleted, happen only with `major`; without it they are told as
    'ignored'."""
    want = index.groupBy("lane").agg(F.max("withdrawn").alias("new_withdrawn"), (F.count_if(F.coalesce("mate_file", F.lit("")) != "") > 1).alias("new_paired"))
    x = want.withColumn("_in", F.lit(True)).join(lanes.select("lane", F.coalesce("withdrawn", F.lit(False)).alias("withdrawn"), F.coalesce("paired", F.lit(False)).alias("paired"), F.lit(True).alias("_have")), "lane", "full")
    turn = lambda old, new, on, off: F.when(~F.col(old) & F.col(new), on).when(F.col(old) & ~F.col(new), off)
    both = F.col("_in") & F.col("_have")
    changes = F.array(F.when(F.col("_have").isNull(), "add"), F.when(F.col("_in").isNull(), "delete"), F.when(both, turn("withdrawn", "new_withdrawn", "withdraw", "unwithdraw")), F.when(both, turn("paired", "new_paired", "pair", "unpair")))
    told = x.select("lane", F.explode(F.array_compact(changes)).alias("change"))
    return told.withColumn("applied", ~F.col("change").isin("delete", "unwithdraw", "unpair") | F.lit(major))


def replaced_lanes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Lanes whose files (lane, line_no, value) differ in some line, and in how many."""
    a = old.select("lane", "line_no", F.col("value").alias("_old"), F.lit(True).alias("_in_old"))
    b = new.select("lane", "line_no", F.col("value").alias("_new"), F.lit(True).alias("_in_new"))
    differs = F.col("_in_old").isNull() | F.col("_in_new").isNull() | ~F.col("_old").eqNullSafe(F.col("_new"))
    return a.join(b, ["lane", "line_no"], "full").where(differs).groupBy("lane").agg(F.count("*").alias("n_lines"))


def index_rows(hierarchy: DataFrame, columns: list[str]) -> DataFrame:
    """K8: rows of a sequence index: its columns in order, as text, absent ones empty; lanes in order within each file that is written."""
    text = [(F.coalesce(F.col(c).cast("string"), F.lit("")) if c in hierarchy.columns else F.lit("")).alias(c) for c in columns]
    return hierarchy.select(*text)
