"""Interval algebra (I1-I7, J2, J3) on tables chrom, start_pos, end_pos, 1-based and inclusive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.prefix import neighbour, running
from ..plans.ranges import BIN, overlap_join


def merge_intervals(iv: DataFrame, expand: int = 0) -> DataFrame:
    """Overlapping or adjacent intervals become one; both sides are widened by `expand` first, starts down to 0 at least."""
    wide = iv.select("chrom", F.greatest(F.lit(0), F.col("start_pos") - expand).alias("start_pos"), (F.col("end_pos") + expand).alias("end_pos")).distinct()
    order = ["start_pos", "end_pos"]
    ends = running(wide, ["chrom"], "start_pos", order, F.col("end_pos"), "reached", "max", inclusive=False)
    fresh = F.when(F.col("reached").isNull() | (F.col("reached") < F.col("start_pos") - 1), 1).otherwise(0)
    grouped = running(ends, ["chrom"], "start_pos", order, fresh, "grp", "sum")
    return grouped.groupBy("chrom", "grp").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("grp")


def complement_intervals(features: DataFrame, lengths: DataFrame, margin: int = 50, min_size: int = 10) -> DataFrame:
    """What lies between merged features, `margin` away from each; kept if larger than min_size. lengths(chrom, length) gives the tail."""
    merged = merge_intervals(features)
    behind = neighbour(merged, ["chrom"], "start_pos", ["start_pos"], F.col("end_pos"), "last_end")
    inner = behind.select("chrom", (F.coalesce(F.col("last_end") + margin, F.lit(0)) + 1).alias("s"), (F.col("start_pos") - margin - 1).alias("e"))
    last = merged.groupBy("chrom").agg(F.max("end_pos").alias("last_end"))
    tail = lengths.join(last, "chrom", "left").select("chrom", (F.coalesce(F.col("last_end") + margin, F.lit(0)) + 1).alias("s"), F.col("length").alias("e"))
    both = inner.union(tail).where(F.col("e") - F.col("s") + 1 > min_size)
    return both.select("chrom", F.col("s").cast("long").alias("start_pos"), F.col("e").cast("long").alias("end_pos"))


def mask_from_sites(sites: DataFrame, size: int) -> DataFrame:
    """Sites (chrom, pos) widened by `size` on both sides and merged."""
    return merge_intervals(sites.select("chrom", F.col("pos").alias("start_pos"), F.col("pos").alias("end_pos")), size)


def exclude_around_indels(sites: DataFrame, margin: int = 20) -> DataFrame:
    """What lies between insertions and deletions (chrom, pos): from `margin` behind one (or the chromosome's start) to `margin` before the next, if that is more than a base."""
    places = sites.select("chrom", "pos").distinct()
    behind = neighbour(places, ["chrom"], "pos", ["pos"], F.col("pos"), "_last")
    spans = behind.select("chrom", F.coalesce(F.col("_last") + margin, F.lit(1)).cast("long").alias("start_pos"), (F.col("pos") - margin).alias("end_pos"))
    return spans.where("end_pos > start_pos")


def disjoin(segments: DataFrame) -> DataFrame:
    """I4: all pieces between breakpoints of a chromosome that some segment covers, with how many cover each: a sweep that adds up starts less ends, in blocks; no
    piece is joined with the segments over it."""
    ends = segments.select("chrom", F.explode(F.array(F.struct(F.col("start_pos").alias("p"), F.lit(1).alias("d")), F.struct((F.col("end_pos") + 1).alias("p"), F.lit(-1).alias("d")))).alias("e"))
    points = ends.groupBy("chrom", F.col("e.p").alias("p")).agg(F.sum("e.d").alias("_d"))
    swept = running(points, ["chrom"], "p", ["p"], F.col("_d"), "n", "sum")
    ahead = neighbour(swept, ["chrom"], "p", ["p"], F.col("p"), "_next", ahead=True)
    return ahead.where("n > 0").select("chrom", F.col("p").alias("start_pos"), (F.col("_next") - 1).alias("end_pos"), "n")


def disjoin_samples(segments: DataFrame) -> DataFrame:
    """I4: each sample's segments (chrom, sample, start_pos, end_pos, others), disjoint within the sample, cut at the breakpoints of all samples, with what they hold; a sample's first
    segment of a chromosome begins where any sample's does. A row is a piece of one segment, so as many rows are made as the result has."""
    key = ["chrom", "sample"]
    lows = segments.groupBy(*key).agg(F.min("start_pos").alias("_first")).join(segments.groupBy("chrom").agg(F.min("start_pos").alias("_low")), "chrom")
    whole = segments.join(lows, key).withColumn("start_pos", F.when(F.col("start_pos") == F.col("_first"), F.col("_low")).otherwise(F.col("start_pos")))
    span = ["chrom", "start_pos", "end_pos"]
    pieces = disjoin(whole.select(*span).unionByName(segments.select(*span))).drop("n")
    rest = [c for c in segments.columns if c not in ("chrom", "start_pos", "end_pos")]
    return overlap_join(pieces, whole.select("chrom", *rest, F.col("start_pos").alias("r_start"), F.col("end_pos").alias("r_end"))).select("chrom", "start_pos", "end_pos", *rest)


def chunk_contigs(contigs: DataFrame, size: int) -> DataFrame:
    """Regions of `size` of each contig (chrom, length); a rest of a tenth of a region or less is added to the last one."""
    n = F.greatest(F.lit(1), F.ceil((F.col("length") - 0.1 * size) / size)).cast("long")
    pieces = contigs.withColumn("n", n).withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    end = F.when(F.col("k") == F.col("n") - 1, F.col("length")).otherwise((F.col("k") + 1) * size)
    return pieces.select("chrom", (F.col("k") * size + 1).alias("start_pos"), end.cast("long").alias("end_pos"))


def reads_in_intervals(reads: DataFrame, iv: DataFrame) -> DataFrame:
    """Reads that share a base with an interval, each row once, repeated rows too. Merged intervals are posted to the bins that they touch and to
    those in which a read that meets them may end; a bin has fewer intervals than bases, as they are disjoint. A read looks in the bin of
    its end only, so nothing is deduplicated, and hot chromosomes are split."""
    longest = F.broadcast(reads.agg(F.coalesce(F.max("seq_len"), F.lit(0)).alias("_longest")))
    bins = F.sequence(F.floor(F.col("start_pos") / BIN), F.floor((F.col("end_pos") + F.col("_longest")) / BIN))
    posted = merge_intervals(iv).join(longest).select(F.col("chrom").alias("_chrom"), F.explode(bins).alias("_bin"), F.struct(F.col("start_pos").alias("s"), F.col("end_pos").alias("e")).alias("_span"))
    lists = posted.groupBy("_chrom", "_bin").agg(F.collect_list("_span").alias("_spans"))
    end = F.col("pos") + F.col("seq_len") - 1
    hit = reads.join(lists, (F.col("chrom") == F.col("_chrom")) & (F.floor(end / BIN) == F.col("_bin")))
    return hit.where(F.exists("_spans", lambda x: (x["s"] <= end) & (x["e"] >= F.col("pos")))).select(*reads.columns)


def positions_in_intervals(df: DataFrame, iv: DataFrame) -> DataFrame:
    """Each position (chrom, pos) with each interval that holds it. Positions are looked up once, however many rows are at one; rows then meet their position's
    intervals by an equal join. Its number of partitions is fixed, as they would be merged by what they read, while pairs may be far more."""
    other = iv.select("chrom", *(c for c in iv.columns if c not in ("chrom", "start_pos", "end_pos")), F.col("start_pos").alias("r_start"), F.col("end_pos").alias("r_end"))
    pairs = overlap_join(df.select("chrom", "pos").distinct(), other, left_span=("pos", "pos"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(parts, "chrom", "pos").join(df.repartition(parts, "chrom", "pos"), ["chrom", "pos"]).select(*df.columns, *(c for c in other.columns if c != "chrom"))
