"""Overlap joins by bins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BIN = 1 << 12


def overlap_join(left: DataFrame, right: DataFrame, key: str = "chrom", left_span: tuple[str, str] = ("start_pos", "end_pos"), right_span: tuple[str, str] = ("r_start", "r_end"), bin_size: int = BIN) -> DataFrame:
    """Pairs of rows with equal key whose spans (inclusive) share a position; right's other columns must not clash with left's.

    Both sides are posted to each bin that they touch and joined on key and bin, which also splits hot chromosomes. A pair comes from one
    bin only, the one that holds the later start, so nothing is deduplicated. Rows with a null or reversed span match nothing.
    """

    def posted(df: DataFrame, span: tuple[str, str], name: str) -> DataFrame:
        start, end = F.floor(F.col(span[0]) / bin_size), F.floor(F.col(span[1]) / bin_size)
        return df.where(F.col(span[0]) <= F.col(span[1])).withColumn(name, F.explode(F.sequence(start, end)))

    a, b = posted(left, left_span, "_bin"), posted(right.withColumnRenamed(key, "_key"), right_span, "_rbin")
    later = F.floor(F.greatest(left_span[0], right_span[0]) / bin_size)
    meet = (F.col(key) == F.col("_key")) & (F.col("_bin") == F.col("_rbin")) & (F.col(left_span[0]) <= F.col(right_span[1])) & (F.col(left_span[1]) >= F.col(right_span[0]))
    return a.join(b, meet & (F.col("_bin") == later)).drop("_bin", "_rbin", "_key")
