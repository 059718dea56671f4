"""Quality classifier by importance resampling: hashed n-gram models of target and raw text, and Gumbel top-k."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import free_name, named, shielded, unshielded, write_table

BUCKETS = 1 << 16
#: Added to each bucket's count.
SMOOTHING = 1.0
SEED = 7
#: Labelled rows of good quality that are taken as target text: half to fit the model, half to set its bound.
TARGET_ROWS = 40_000
#: Share of the target rows that may weigh less than what counts as target text.
MISSED = 0.002
#: Words that a worker remembers the hash of, and the letters up to which it does.
REMEMBERED, SHORT = 500_000, 64
#: Runs of letters and digits, and runs of marks.
_tokens = re.compile(r"\w+|[^\w\s]+")


class Features(dict):
    """Buckets of a text's words and word pairs; case and marks count. A word right after itself is one pair, whichever word it is."""

    def __init__(self, buckets: int):
        if buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.mask = np.uint64(buckets - 1)

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh32_intdigest(word, SEED)
        if len(word) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found

    def __call__(self, text: str | None) -> np.ndarray:
        words = _tokens.findall(text) if text else []
        h = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        first, second = h[:-1], h[1:]
        pairs = (first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)
        pairs[first == second] = 0
        return (np.concatenate([h, pairs]) & self.mask).astype(np.int64)


def _counts(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, target, raw): how often each bucket occurs in rows of the target and in all rows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, target, raw = Features(buckets), np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        nothing = np.zeros(0, np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                some = batch.slice(start, 200)
                found = [features(x.as_py()) for x in some["text"]]
                chosen = [x for x, is_target in zip(found, some["is_target"].to_pylist(), strict=True) if is_target]
                raw += np.bincount(np.concatenate([nothing, *found]), minlength=buckets)
                target += np.bincount(np.concatenate([nothing, *chosen]), minlength=buckets)
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(target[some], pa.int64()), pa.array(raw[some], pa.int64())], ["bucket", "target", "raw"])

    made = texts.mapInArrow(rows, "bucket long, target long, raw long")
    return made.groupBy("bucket").agg(F.sum("target").alias("target"), F.sum("raw").alias("raw"))


def fit(docs: DataFrame, is_target: Column, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """log10 of target probability over raw probability of each bucket. All rows are raw text, those where is_target holds the target;
    the driver gets one count of each bucket. Without any text, or without any in the target, all ratios are 0."""
    texts = docs.select(named(text_col).alias("text"), F.coalesce(is_target, F.lit(False)).alias("is_target"))
    target, raw = np.zeros(buckets), np.zeros(buckets)
    for r in _counts(texts, buckets).collect():
        target[r["bucket"]], raw[r["bucket"]] = r["target"], r["raw"]
    if not target.sum():
        return np.zeros(buckets)
    share = lambda c: (c + SMOOTHING) / (c.sum() + SMOOTHING * buckets)
    return np.log10(share(target)) - np.log10(share(raw))


def importance(docs: DataFrame, ratios: np.ndarray, text_col: str = "text") -> DataFrame:
    """docs with two more columns: log_weight, the sum of the ratios of a text's words and word pairs, and n_features, their number.
    A null text, or one without words, has weight 0. Repeated rows and other columns stay (log_weight and n_features are replaced)."""
    base = docs.drop("log_weight", "n_features")
    model = docs.sparkSession.sparkContext.broadcast(ratios)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, ratio = Features(len(model.value)), model.value
        for batch in batches:
            found = [features(x.as_py()) for x in batch[text_col]]
            weights = pa.array([float(ratio[x].sum()) for x in found], pa.float64())
            yield batch.append_column("log_weight", weights).append_column("n_features", pa.array([len(x) for x in found], pa.int64()))

    schema = StructType([*base.schema.fields, StructField("log_weight", DoubleType()), StructField("n_features", LongType())])
    return base.mapInArrow(rows, schema)


def gumbel_key(weight: Column, *identity: Column, seed: int = SEED) -> Column:
    """weight plus Gumbel noise that the row's identity determines, so that a task run again gives the same key."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 11) + F.lit(0.5)) * F.lit(2.0**-53)
    return weight - F.log(-F.log(uniform))


def kth_largest(keys: DataFrame, column: str, k: int) -> float | None:
    """The k-th largest number of a column, exactly, or None if it has fewer. The range that holds it is cut into 4096 cells, counted, and
    narrowed to one cell, again and again: each pass brings 4096 counts to the driver, and nothing is sorted or gathered."""
    values = keys.select(F.col(column).alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    low, high, n = values.agg(F.min("x"), F.max("x"), F.count("*")).first()
    if k < 1 or n < k:
        return None
    above = 0
    while low < high:
        width = (high - low) / 4096
        fine = low + width == low or high - width == high  # doubles lie this close: each is a cell of its own
        cell = F.col("x") if fine else F.least(F.lit(4095.0), F.floor((F.col("x") - low) / width))
        cells = values.where(F.col("x").between(low, high)).groupBy(cell.cast("double").alias("cell")).agg(F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        for r in sorted(cells.collect(), key=lambda r: -r["cell"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return high


def target_sample(labels: DataFrame, rows: int = TARGET_ROWS) -> DataFrame:
    """target_id: at most `rows` ids of labelled rows of good quality, chosen by the id's hash. Null ids and repeats are left out."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("target_id")).distinct()
    return good.orderBy(F.xxhash64("target_id"), "target_id").limit(rows)


def mark_target(docs: DataFrame, labels: DataFrame, part_col: str = "target_part", id_col: str = "doc_id") -> DataFrame:
    """docs and a column part_col (a name that docs doesn't have): 1 for rows of the sample that the model is fitted to, 2 for those that
    its bound is set by, else 0. The sample is broadcast: it has at most TARGET_ROWS ids."""
    target_id, sample_part = free_name("target_id", docs.columns), free_name("sample_part", docs.columns)
    part = (1 + F.pmod(F.xxhash64(F.lit(SEED), "target_id"), F.lit(2))).cast("int")
    sample = F.broadcast(target_sample(labels).select(F.col("target_id").alias(target_id), part.alias(sample_part)))
    joined = docs.join(sample, named(id_col) == F.col(target_id), "left")
    return joined.withColumn(part_col, F.coalesce(sample_part, F.lit(0))).drop(target_id, sample_part)


def keep_selected(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """The rows of docs that select_target() selects, with their own columns only, whatever these are called."""
    plain, names = shielded(docs, id_col, text_col)
    return unshielded(select_target(plain, labels, text_col, id_col, seed).where("selected"), names, docs.columns)


def select_target(docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """docs with log_weight, n_features, gumbel_key and selected: a sample without replacement, in proportion to importance weights, of as
    many rows as look like target text.

    Those are the rows with at least the weight that all but MISSED of the labelled target rows reach (0 if that is more, or if there
    are none); these rows are not among those that the target model is fitted to, so they weigh what unlabelled ones do. Rows without words
    have weight 0 and look like the target. Noise follows id and text, so that equal rows tie, and rows that tie with the last one
    selected are selected too. Null texts count as empty; null ids are no target; repeated rows and other columns stay, but columns of the
    input that are called as the four added ones are replaced (see keep_selected). An empty table stays so; without labels all ratios
    are 0 and all rows selected. Two passes over the texts; weights are written to the shared folder.
    """
    docs = docs.drop("log_weight", "n_features", "gumbel_key", "selected")
    part = free_name("target_part", docs.columns)
    marked = mark_target(docs, labels, part, id_col)
    ratios = fit(marked, F.col(part) == 1, text_col)
    weighted = importance(marked, ratios, text_col)
    ln10 = 2.302585092994046
    keyed = write_table(weighted.withColumn("gumbel_key", gumbel_key(F.col("log_weight") * ln10, named(id_col), named(text_col), seed=seed)), "weighted")
    target = keyed.where(F.col(part) == 2).select("log_weight")
    least = kth_largest(target, "log_weight", math.ceil(target.count() * (1 - MISSED)))
    enough = keyed.where(F.col("log_weight") >= min(0.0, least if least is not None else 0.0)).count()
    bound = kth_largest(keyed, "gumbel_key", enough)
    return keyed.withColumn("selected", F.col("gumbel_key") >= F.lit(bound) if bound is not None else F.lit(False)).drop(part)
