"""Joining of phased chunks by likelihood, with qualities, breaks and phase sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.prefix import running

KEY = ["chunk_no", "sample"]


def _pairs(gt: DataFrame) -> DataFrame:
    """Genotypes that a chunk and the one before it both have, the latter as b1, b2."""
    before = gt.select((F.col("chunk_no") + 1).alias("chunk_no"), "sample", "site", F.col("a1").alias("b1"), F.col("a2").alias("b2"), F.col("phased").alias("_phased"))
    return gt.join(before, [*KEY, "site"])


def phase_joins(gt: DataFrame) -> DataFrame:
    """For each chunk and sample (chunk_no, sample, site, a1, a2, phased) how the chunk fits to the one before: n_sites compared, log10 likelihoods of a match and of a swap, the quality (how
    far apart they are), `flip` (a swap is likelier) and `swapped`, whether the chunk is to be turned, all flips so far taken together.

    At a site that both chunks have, p is the share of samples whose two genotypes differ (kept from 0 and 1 by one sample's share, by a quarter if there is but one). A sample that is
    heterozygous and phased in both, with the same two alleles, speaks for a match or a swap with p p + (1 - p)(1 - p), against it with 2 p (1 - p). Chunks without such a site, and
    first chunks, have quality 0 and don't flip. A missing allele equals another missing one.
    """
    same = lambda x, y: F.col(x).eqNullSafe(F.col(y))
    straight, crossed = same("a1", "b1") & same("a2", "b2"), same("a1", "b2") & same("a2", "b1")
    both = _pairs(gt).withColumns({"_straight": straight, "_crossed": crossed})
    sites = both.groupBy("chunk_no", "site").agg(F.count("*").alias("_n"), F.count_if(~F.col("_straight") & ~F.col("_crossed")).alias("_errors"))
    least = F.when(F.col("_n") == 1, 0.25).otherwise(1 / F.col("_n"))
    p = F.greatest(F.least(F.col("_errors") / F.col("_n"), 1 - least), least)
    rates = sites.select("chunk_no", "site", F.log(p * p + (1 - p) * (1 - p)).alias("_for"), F.log(2 * p * (1 - p)).alias("_against"))
    tells = F.col("phased") & F.col("_phased") & (F.col("a1") != F.col("a2")) & (F.col("_straight") | F.col("_crossed"))
    lk = lambda yes: F.sum(F.when(F.col("_straight") if yes else ~F.col("_straight"), F.col("_for")).otherwise(F.col("_against")))
    told = both.where(tells).join(rates, ["chunk_no", "site"]).groupBy(*KEY).agg(F.count("*").alias("n_sites"), lk(True).alias("_match"), lk(False).alias("_swap"))
    chunks = gt.select(*KEY).distinct().join(told, KEY, "left")
    even = F.coalesce(F.round(F.col("_swap") - F.col("_match"), 9), F.lit(0.0))
    flip = even > 0
    turns = F.sum(F.when(flip, 1).otherwise(0)).over(Window.partitionBy("sample").orderBy("chunk_no"))
    log10 = lambda c: F.col(c) / F.log(F.lit(10.0))
    return chunks.select(*KEY, F.coalesce("n_sites", F.lit(0)).alias("n_sites"), log10("_match").alias("match"), log10("_swap").alias("swap"), (F.abs(even) / F.log(F.lit(10.0))).alias("quality"), flip.alias("flip"), (turns % 2 == 1).alias("swapped"))


def joined_phases(gt: DataFrame, joins: DataFrame, min_quality: float = 0.0, min_pq: Column | None = None) -> DataFrame:
    """One record of each sample and site out of all chunks, its alleles turned as `joins` (phase_joins) says, with ps, the first site of its phase set.

    Of a site's records in a chunk and the one before, the earlier chunk's stays while the site is farther from the end of what they share than from its beginning. A phase set begins with a
    sample's first record, with the first record taken from a chunk whose join has a quality below `min_quality` or shares no site with the chunk before, and, outside
    shared stretches, where the condition `min_pq` (its phasing quality is too low) holds. Sets run along blocks of sites; no task holds a chromosome.
    """
    shared = gt.select("chunk_no", "site").distinct()
    spans = shared.join(shared.select((F.col("chunk_no") + 1).alias("chunk_no"), "site"), ["chunk_no", "site"]).groupBy("chunk_no").agg(F.min("site").alias("_from"), F.max("site").alias("_to"))
    after = spans.select((F.col("chunk_no") - 1).alias("chunk_no"), F.col("_from").alias("_next_from"), F.col("_to").alias("_next_to"))
    rows = gt.join(spans, "chunk_no", "left").join(after, "chunk_no", "left")
    early = lambda a, b: F.col(b) - F.col("site") > F.col("site") - F.col(a)
    in_last, in_next = F.col("site").between(F.col("_from"), F.col("_to")), F.col("site").between(F.col("_next_from"), F.col("_next_to"))
    rank = F.when(F.coalesce(in_last & early("_from", "_to"), F.lit(False)) | F.coalesce(in_next & ~early("_next_from", "_next_to"), F.lit(False)), 1).otherwise(0)
    low = (min_pq if min_pq is not None else F.lit(False)) & ~F.coalesce(in_last | in_next, F.lit(False))
    turned = rows.withColumns({"_rank": rank, "_low": F.coalesce(low, F.lit(False)), "_alone": F.col("_from").isNull()}).join(joins.select(*KEY, "swapped", "quality"), KEY)
    x, y = F.when(F.col("swapped"), F.col("a2")).otherwise(F.col("a1")), F.when(F.col("swapped"), F.col("a1")).otherwise(F.col("a2"))
    weak = F.col("_alone") | (F.col("quality") < min_quality)
    record = F.struct("chunk_no", x.alias("a1"), y.alias("a2"), "_low", weak.alias("_weak"))
    kept = turned.groupBy("sample", "site").agg(F.min_by(record, F.struct("_rank", "chunk_no")).alias("r")).select("sample", "site", "r.*")
    begins = kept.groupBy("sample", "chunk_no").agg(F.min("site").alias("_first"))
    marked = kept.join(begins, ["sample", "chunk_no"]).withColumn("_start", F.when(F.col("_low") | (F.col("_weak") & (F.col("site") == F.col("_first"))), F.col("site")))
    first = kept.groupBy("sample").agg(F.min("site").alias("_low_site"))
    sets = running(marked, ["sample"], "site", ["site"], F.col("_start"), "ps", "max").join(first, "sample")
    return sets.select("sample", "site", "chunk_no", "a1", "a2", F.coalesce("ps", "_low_site").alias("ps"))
