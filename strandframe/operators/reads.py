"""Statistics, filters and coverage of alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.prefix import block_of, running
from ..plans.ranges import overlap_join
from ..plans.shared import written
from .intervals import merge_intervals, reads_in_intervals
from .stats import histogram_stats

# Bits of a record's flag, fixed by the alignment format.
PAIRED, PROPER, UNMAPPED, MATE_UNMAPPED, REVERSE, MATE_REVERSE, READ1, READ2, SECONDARY, FAILED, DUPLICATE = 1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024


def has(mask: int) -> Column:
    return F.col("flag").bitwiseAND(F.lit(mask)) != 0


def total(condition: Column, value: Column | None = None) -> Column:
    return F.sum(F.when(condition, F.lit(1) if value is None else value).otherwise(0)).cast("long")


def flag_filter(reads: DataFrame, require: int = 0, exclude: int = 0) -> DataFrame:
    """Rows with all bits of `require` and none of `exclude`."""
    if not require | exclude:
        return reads
    return reads.where(F.col("flag").bitwiseAND(F.lit(require | exclude)) == require)


def unmapped_reads(reads: DataFrame, skip_mate_mapped: bool = False) -> DataFrame:
    """Unmapped rows; with skip_mate_mapped, not those of pairs whose other mate is mapped."""
    gone = has(UNMAPPED)
    return reads.where(gone & (~has(PAIRED) | has(MATE_UNMAPPED)) if skip_mate_mapped else gone)


def readgroup_filter(reads: DataFrame, groups: DataFrame, include: Column | None = None, exclude: Column | None = None) -> DataFrame:
    """Rows whose read group (rg) has attributes that `include` allows and `exclude` doesn't. The groups kept, as many as headers
    list, are broadcast, so reads aren't shuffled by the few groups that they have."""
    kept = groups.where(include) if include is not None else groups
    kept = kept.where(~F.coalesce(exclude, F.lit(False))) if exclude is not None else kept
    return reads.join(F.broadcast(kept.select("rg").distinct()), "rg", "left_semi")


def fix_flags(reads: DataFrame, protocol: str = "strand_specific") -> DataFrame:
    """Flags as a protocol of RNA reads has them: the duplicate bit is cleared and, if strand-specific, the strand of proper second mates
    turned. The other protocols are standard and tradis."""
    if protocol not in ("standard", "strand_specific", "tradis"):
        raise ValueError(f"no protocol {protocol}")
    clear = F.col("flag").bitwiseAND(F.lit(~DUPLICATE))
    turn = F.col("flag").bitwiseAND(F.lit(PROPER | READ2)) == (PROPER | READ2)
    return reads.withColumn("flag", F.when(turn, clear.bitwiseXOR(F.lit(REVERSE))).otherwise(clear) if protocol == "strand_specific" else clear)


def insert_histogram(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Insert sizes of proper pairs with mapping quality and positive size."""
    good = reads.where(has(PROPER) & (F.col("mapq") > 0) & (F.col("isize") > 0))
    return good.groupBy(*keys, F.col("isize").alias("bin")).agg(F.count("*").alias("freq"))


def readgroup_stats(reads: DataFrame) -> DataFrame:
    """A1: totals, mapped, proper and duplicate reads, mismatch percentage, mean base quality of mapped reads (qual_sum over seq_len), and
    insert-size mean, sd, median and median absolute deviation of each read group. Medians come from histograms: no group is gathered. Reads are read once, summed by read group and insert
    size, and the numbers are told from these sums, which are written."""
    mapped = ~has(UNMAPPED)
    size = F.when(has(PROPER) & (F.col("mapq") > 0) & (F.col("isize") > 0), F.col("isize")).alias("bin")
    sums = {
        "total_reads": F.count("*"), "total_bases": F.sum("seq_len"), "mapped_reads": total(mapped), "mapped_bases": total(mapped, F.col("seq_len")), "paired_reads": total(mapped & has(PAIRED)),
        "proper_reads": total(mapped & has(PROPER)), "dup_reads": total(has(DUPLICATE)), "_mismatches": total(mapped, F.col("nm")), "_quality": total(mapped, F.col("qual_sum")),
    }
    cells = written(reads.groupBy("rg", size).agg(*(c.alias(n) for n, c in sums.items())), "readgroups")
    base = cells.groupBy("rg").agg(*(F.sum(n).alias(n) for n in sums)).withColumns({"pct_mismatch": F.try_divide(100 * F.col("_mismatches"), F.col("mapped_bases")), "avg_quality": F.try_divide("_quality", "mapped_bases")}).drop("_mismatches", "_quality")
    hist = cells.where("bin IS NOT NULL").select("rg", "bin", F.col("total_reads").alias("freq"))
    stats = histogram_stats(hist, ["rg"])
    spread = hist.join(stats.select("rg", "median"), "rg").groupBy("rg", F.abs(F.col("bin") - F.col("median")).alias("bin")).agg(F.sum("freq").alias("freq"))
    mad = histogram_stats(spread, ["rg"]).select("rg", F.col("median").alias("isize_mad"))
    inserts = stats.select("rg", F.col("mean").alias("mean_isize"), F.col("sd").alias("isize_sd"), F.col("median").alias("median_isize"))
    return base.join(inserts, "rg", "left").join(mad, "rg", "left")


def alignment_summary(reads: DataFrame, require: int = 0, exclude: int = 0, cap: int = 8000, bulk: float = 0.99) -> DataFrame:
    """A2: the summary numbers of reads with all bits of `require` and none of `exclude`; `filtered` counts the others. One row. Reads are read once, summed by flag and, if they are
    of a pair, by its insert size and orientation; all numbers are told from these sums, which are written. Needs qual_sum, trimmed (bases), cigar_mapped (bases of M and I),
    mate_chrom and mate_pos."""
    keys = ["flag", (F.col("mapq") == 0).alias("mq0"), F.coalesce(F.col("chrom") != F.col("mate_chrom"), F.lit(False)).alias("apart")]
    sums = [F.sum(c).alias(c) for c in ("seq_len", "cigar_mapped", "trimmed", "nm", "qual_sum")]
    size, kind = _pair_cell(cap)
    by_flag = written(reads.groupBy(*keys, F.when(kind.isNotNull(), size).alias("bin"), kind.alias("kind")).agg(F.count("*").alias("n"), F.max("seq_len").alias("longest"), *sums), "flags")
    mapped, kept = ~has(UNMAPPED), (F.col("flag").bitwiseAND(F.lit(require)) == require) & (F.col("flag").bitwiseAND(F.lit(exclude)) == 0)
    n = lambda c, value="n": F.sum(F.when(kept & c, F.col(value)).otherwise(0)).cast("long")
    one, last = F.lit(True), has(READ2)
    numbers = {
        "raw_total": F.sum("n"), "filtered": F.sum(F.when(~kept, F.col("n")).otherwise(0)).cast("long"), "sequences": n(one), "first_fragments": n(~last), "last_fragments": n(last), "reads_mapped": n(mapped), "reads_unmapped": n(~mapped),
        "reads_unpaired": n(mapped & ~has(PAIRED)), "reads_paired": n(mapped & has(PAIRED)), "reads_duplicated": n(has(DUPLICATE)), "reads_mq0": n(mapped & F.col("mq0")), "reads_qc_failed": n(has(FAILED)),
        "non_primary": n(has(SECONDARY)), "total_length": n(one, "seq_len"), "bases_mapped": n(mapped, "seq_len"), "bases_mapped_cigar": n(mapped, "cigar_mapped"), "bases_trimmed": n(one, "trimmed"),
        "bases_duplicated": n(has(DUPLICATE), "seq_len"), "mismatches": n(mapped, "nm"), "maximum_length": F.max(F.when(kept, F.col("longest"))), "quality_sum": n(one, "qual_sum"),
        "different_chromosomes": F.floor(n(mapped & has(PAIRED) & F.col("apart")) / 2),
    }
    pairs = bulk_stats(_by_orientation(by_flag.where(kept).groupBy("bin", "kind").agg(F.sum("n").alias("n"))), bulk)
    out = by_flag.agg(*(c.alias(name) for name, c in numbers.items())).join(F.broadcast(pairs))
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return out.withColumns(
        {
            "is_paired": (F.col("first_fragments") > 0) & (F.col("last_fragments") > 0), "error_rate": ratio("mismatches", "bases_mapped_cigar"), "average_length": ratio("total_length", "sequences"),
            "average_quality": ratio("quality_sum", "total_length"),
        }
    ).drop("quality_sum")


def flagstat(reads: DataFrame) -> DataFrame:
    """Counts by flag. mate_other_chrom are pairs mapped on both sides but to different sequences, mate_other_chrom_mq5 those with mapping
    quality 5 or more."""
    mapped = ~has(UNMAPPED)
    both = mapped & has(PAIRED) & ~has(MATE_UNMAPPED)
    apart = both & (F.col("chrom") != F.col("mate_chrom"))
    return reads.agg(
        F.count("*").alias("total"), total(has(FAILED)).alias("qc_failed"), total(has(DUPLICATE)).alias("duplicates"), total(mapped).alias("mapped"), total(has(PAIRED)).alias("paired"),
        total(has(READ1)).alias("read1"), total(has(READ2)).alias("read2"), total(has(PROPER) & mapped).alias("properly_paired"), total(both).alias("both_mapped"),
        total(mapped & has(PAIRED) & has(MATE_UNMAPPED)).alias("singletons"), total(apart).alias("mate_other_chrom"), total(apart & (F.col("mapq") >= 5)).alias("mate_other_chrom_mq5"),
    )


def _pair_cell(cap: int) -> tuple[Column, Column]:
    """A read's insert size up to cap - 1, and its pair's orientation: 0 other, 1 inward, 2 outward, 3 none; null if it is of no pair that counts."""
    side = (F.col("mate_pos") - F.col("pos")) * F.when(has(REVERSE), -1).otherwise(1)
    other = has(REVERSE) == has(MATE_REVERSE)
    used = (F.col("flag").bitwiseAND(F.lit(UNMAPPED | PAIRED)) == PAIRED) & ((F.col("isize") != 0) | (F.col("chrom") == F.col("mate_chrom")))
    return F.least(F.abs("isize"), F.lit(cap - 1)), F.when(used, F.when(other, 0).when(side > 0, 1).when(side < 0, 2).otherwise(3))


def _by_orientation(cells: DataFrame) -> DataFrame:
    """Pairs of each insert size by orientation, of reads (n) by bin and kind."""
    half = lambda k: F.floor(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)) / 2)
    out = cells.where("kind IS NOT NULL").groupBy("bin").agg(half(1).alias("inward"), half(2).alias("outward"), half(0).alias("other"))
    return out.withColumn("pairs", F.col("inward") + F.col("outward") + F.col("other"))


def pair_histogram(reads: DataFrame, cap: int) -> DataFrame:
    """Pairs of each insert size (bin, up to cap - 1) by orientation. Both mates of a pair count, so counts are halved, downwards. Mates on the
    same strand are `other`; else inward if the forward one comes first. Mates at the same place have no orientation."""
    size, kind = _pair_cell(cap)
    return _by_orientation(reads.select(size.alias("bin"), kind.alias("kind")).groupBy("bin", "kind").agg(F.count("*").alias("n")))


def bulk_stats(hist: DataFrame, bulk: float) -> DataFrame:
    """Pairs of each orientation, and mean_isize and isize_sd of the main bulk: the bins up to the first at which more than `bulk` of all pairs are reached (the sd
    from bin 1 on). One row, one pass."""
    run = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)  # a histogram: cap rows at most
    x = hist.withColumns({"before": F.coalesce(F.sum("pairs").over(run), F.lit(0)), "all_pairs": F.sum("pairs").over(Window.partitionBy())})
    main = F.try_divide(F.col("before"), F.col("all_pairs")) <= bulk
    of = lambda value: F.sum(F.when(main, value).otherwise(0))
    sums = x.agg(
        of(F.col("pairs")).alias("s0"), of(F.when(F.col("bin") > 0, F.col("pairs")).otherwise(0)).alias("p0"), of(F.col("bin") * F.col("pairs")).alias("s1"), of(F.col("bin") ** 2 * F.col("pairs")).alias("s2"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(f"pairs_{c}") for c in ("inward", "outward", "other")),
    )
    mean = F.try_divide(F.col("s1"), F.col("s0"))
    square = F.try_divide(F.col("s2") - 2 * mean * F.col("s1") + mean * mean * F.col("p0"), F.col("s0"))
    return sums.select("pairs_inward", "pairs_outward", "pairs_other", mean.alias("mean_isize"), F.sqrt(F.greatest(F.lit(0.0), square)).alias("isize_sd"))


def insert_size_histogram(reads: DataFrame, cap: int = 8000, bulk: float = 0.99) -> DataFrame:
    """A3: pairs of each insert size by orientation, with mean and sd of the main bulk."""
    hist = pair_histogram(reads, cap)
    return hist.join(F.broadcast(bulk_stats(hist, bulk).select("mean_isize", "isize_sd")))


def depth_segments(reads: DataFrame) -> DataFrame:
    """Stretches of equal depth (chrom, start_pos, end_pos, depth > 0) of mapped reads, by a running sum of starts and ends in blocks
    of positions; blocks' sums and first positions, few, run along the chromosome. Steps of the depth are written, as both need them."""
    mapped = reads.where(~has(UNMAPPED))
    ends = F.array(F.struct(F.col("pos").alias("p"), F.lit(1).alias("d")), F.struct((F.col("pos") + F.col("seq_len")).alias("p"), F.lit(-1).alias("d")))
    events = mapped.select("chrom", F.explode(ends).alias("e")).select("chrom", "e.p", "e.d")
    steps = written(events.groupBy("chrom", "p").agg(F.sum("d").alias("d")).withColumn("_block", block_of(F.col("p"))), "steps")
    along = Window.partitionBy("chrom").orderBy("_block")
    blocks = steps.groupBy("chrom", "_block").agg(F.sum("d").alias("_sum"), F.min("p").alias("_first"))
    blocks = blocks.select("chrom", "_block", F.coalesce(F.sum("_sum").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.lead("_first").over(along).alias("_next"))
    inside = Window.partitionBy("chrom", "_block").orderBy("p")
    depth = steps.withColumns({"_depth": F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0)), "_lead": F.lead("p").over(inside)}).join(blocks, ["chrom", "_block"])
    segments = depth.select("chrom", F.col("p").alias("start_pos"), (F.coalesce("_lead", "_next") - 1).alias("end_pos"), (F.col("_before") + F.col("_depth")).alias("depth"))
    return segments.where("depth > 0")


def coverage_histogram(segments: DataFrame, low: int, high: int, step: int) -> DataFrame:
    """Bases in each depth bin from low to high by step, with one bin below (low - 1) and one above (high + 1)."""
    d = F.col("depth")
    cell = F.when(d < low, low - 1).when(d > high, high + 1).otherwise(low + F.floor((d - low) / step) * step)
    return segments.groupBy(cell.cast("long").alias("depth_bin")).agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("bases"))


def bases_at_depth(segments: DataFrame, thresholds: list[int]) -> DataFrame:
    """Bases with at least each depth, in one pass."""
    size = F.col("end_pos") - F.col("start_pos") + 1
    sums = segments.agg(*(total(F.col("depth") >= t, size).alias(f"t{t}") for t in thresholds))
    rows = F.array(*(F.struct(F.lit(t).cast("long").alias("threshold"), F.col(f"t{t}").alias("bases")) for t in thresholds))
    return sums.select(F.explode(rows).alias("r")).select("r.*")


def coverage_depth(segments: DataFrame, ref_size: int) -> DataFrame:
    """Covered bases, and mean and sd of the depth over the whole reference, uncovered bases counting as zero."""
    size, d = F.col("end_pos") - F.col("start_pos") + 1, F.col("depth")
    mean = F.sum(size * d) / ref_size
    return segments.agg(F.sum(size).alias("covered"), mean.alias("mean_depth"), F.sqrt(F.sum(size * d * d) / ref_size - mean * mean).alias("sd_depth"))


def chromosome_distribution(reads: DataFrame, lengths: DataFrame) -> DataFrame:
    """Mapped reads of each read group and chromosome, and of each chromosome in all (rg null), with how many these are for each base of the
    chromosome (chrom, length); null where no length is known."""
    mapped = reads.where(~has(UNMAPPED))
    counts = mapped.groupingSets([["rg", "chrom"], ["chrom"]], "rg", "chrom").agg(F.count("*").alias("n"))
    return counts.join(lengths.select("chrom", "length"), "chrom", "left").select("rg", "chrom", "n", F.try_divide(F.col("n"), F.col("length")).alias("per_base"))


def library_insert_config(reads: DataFrame, least: int = 100, most_cv: float = 1.0) -> DataFrame:
    """Mean insert size of each read group after cutting above mean + 10 sd, and sd above and below it. Groups with fewer than `least` pairs, or
    whose sd is over `most_cv` of their mean, are left out."""
    hist = insert_histogram(reads, ["rg"])
    s = histogram_stats(hist, ["rg"]).select("rg", "mean", "sd")
    cut = hist.join(s, "rg").where(F.col("bin") <= F.col("mean") + 10 * F.col("sd"))
    m = cut.groupBy("rg").agg((F.sum(F.col("bin") * F.col("freq")) / F.sum("freq")).alias("mean_isize"), F.sum("freq").alias("pairs"))
    off = cut.select("rg", "bin", "freq").join(m, "rg").withColumn("off", F.col("bin") - F.col("mean_isize"))
    sd = lambda side: F.sqrt(F.sum(F.when(side, F.col("off") ** 2 * F.col("freq"))) / F.sum(F.when(side, F.col("freq"))))
    out = off.groupBy("rg", "mean_isize", "pairs").agg(sd(F.col("off") > 0).alias("upper_sd"), sd(F.col("off") <= 0).alias("lower_sd"), (sd(F.lit(True)) / F.col("mean_isize")).alias("cv"))
    return out.where((F.col("pairs") >= least) & (F.col("cv") <= most_cv))


def gene_expression(reads: DataFrame, features: DataFrame, exons: DataFrame, min_mapq: int = 0, mask: int | None = None, protocol: str = "standard") -> DataFrame:
    """Reads of each feature (iv_id, strand), sense and antisense, and RPKM by the length of its exons (iv_id, chrom, start_pos, end_pos) and
    all mapped reads. Used are mapped reads with mapping quality above min_mapq, a bit of `mask` if there is one, and a base in an exon; a
    read counts once for a feature. Flags are read as the protocol has them (fix_flags). A window around the features is not needed.

    Reads are counted, not joined: those of a length that meet an exon and none before it begin within a range of positions, and how many do is
    the difference of two running counts. So work follows reads and exons times distinct lengths of reads (which are broadcast), not hits."""
    mapped = fix_flags(reads.where(~has(UNMAPPED)), protocol)
    good = (F.col("mapq") > min_mapq) & (has(mask) if mask else F.lit(True))
    key = ["chrom", "seq_len", "r_strand"]
    kept = mapped.where(good & (F.col("seq_len") > 0) & F.col("pos").isNotNull()).groupBy("chrom", "seq_len", F.when(has(REVERSE), -1).otherwise(1).alias("r_strand"), F.col("pos").alias("at")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("iv_id").orderBy("start_pos", "end_pos").rowsBetween(Window.unboundedPreceding, -1)  # over a feature's exons
    own = exons.select("iv_id", "chrom", "start_pos", "end_pos").where("start_pos <= end_pos").withColumn("_reached", F.max("end_pos").over(before))
    ranges = own.join(F.broadcast(kept.select(*key).distinct()), "chrom").withColumn("_low", F.greatest("_reached", F.col("start_pos") - F.col("seq_len"))).where("_low < end_pos")
    ends = F.array(F.struct(F.col("end_pos").alias("at"), F.lit(1).alias("sign")), F.struct(F.col("_low").alias("at"), F.lit(-1).alias("sign")))
    asked = ranges.select(*key, "iv_id", F.explode(ends).alias("p")).select(*key, "p.at", F.lit(0).cast("long").alias("n"), "iv_id", "p.sign")
    begun = running(asked.unionByName(kept, allowMissingColumns=True), key, "at", ["at", F.col("sign").asc_nulls_first()], F.col("n"), "begun", "sum").where("sign IS NOT NULL")
    hits = begun.groupBy("iv_id", "r_strand").agg(F.sum(F.col("sign") * F.col("begun")).alias("n"))
    n = hits.join(features.select("iv_id", "strand"), "iv_id").groupBy("iv_id").agg(total(F.col("r_strand") == F.col("strand"), F.col("n")).alias("sense"), total(F.col("r_strand") != F.col("strand"), F.col("n")).alias("antisense"))
    sizes = exons.groupBy("iv_id").agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("exon_length"))
    out = features.select("iv_id").join(sizes, "iv_id").join(n, "iv_id", "left").join(F.broadcast(mapped.agg(F.count("*").alias("all_mapped")))).fillna(0, ["sense", "antisense"])
    rpkm = lambda c: F.col(c) / F.col("exon_length") * 1e9 / F.col("all_mapped")
    return out.select("iv_id", "exon_length", "sense", "antisense", rpkm("sense").alias("rpkm_sense"), rpkm("antisense").alias("rpkm_antisense"))


def insert_sites(reads: DataFrame) -> DataFrame:
    """Reads that begin at each position and strand; a reverse read begins at its end."""
    at = F.when(has(REVERSE), F.col("pos") + F.col("seq_len") - 1).otherwise(F.col("pos"))
    return reads.where(~has(UNMAPPED)).groupBy("chrom", at.alias("pos"), F.when(has(REVERSE), -1).otherwise(1).cast("long").alias("strand")).agg(F.count("*").alias("n"))


def feature_inserts(sites: DataFrame, features: DataFrame) -> DataFrame:
    """Insert sites and their reads (both strands) within each feature (iv_id, chrom, start_pos, end_pos, strand), under the feature's own strand
    (pos, neg or zero), and sites by its length."""
    hits = overlap_join(features, sites.select("chrom", F.col("pos").alias("r_start"), F.col("pos").alias("r_end"), "n"))
    counts = hits.groupBy("iv_id").agg(F.count("*").alias("sites"), F.sum("n").alias("reads"))
    out = features.join(counts, "iv_id", "left").fillna(0, ["sites", "reads"])
    made = {}
    for name, strand in (("pos", 1), ("neg", -1), ("zero", 0)):
        mine = F.col("strand") == strand
        made |= {f"{name}_sites": F.when(mine, F.col("sites")).otherwise(0), f"{name}_reads": F.when(mine, F.col("reads")).otherwise(0)}
        made[f"{name}_by_length"] = F.when(mine, F.col("sites")).otherwise(0) / (F.col("end_pos") - F.col("start_pos") + 1)
    return out.select("iv_id", *(c.alias(name) for name, c in made.items()))


def target_coverage(segments: DataFrame, targets: DataFrame) -> DataFrame:
    """Bases and mean coverage of each merged target (chrom, start_pos, end_pos)."""
    depth = segments.select("chrom", F.col("start_pos").alias("r_start"), F.col("end_pos").alias("r_end"), "depth")
    hit = overlap_join(targets, depth).withColumn("size", F.least("end_pos", "r_end") - F.greatest("start_pos", "r_start") + 1)
    sums = hit.groupBy("chrom", "start_pos", "end_pos").agg(F.sum("size").alias("covered"), F.sum(F.col("size") * F.col("depth")).alias("bases"))
    out = targets.join(sums, ["chrom", "start_pos", "end_pos"], "left")
    return out.select("chrom", "start_pos", "end_pos", F.coalesce("covered", F.lit(0)).alias("covered"), (F.coalesce("bases", F.lit(0)) / (F.col("end_pos") - F.col("start_pos") + 1)).alias("mean_coverage"))


DEPTHS = (1, 2, 5, 10, 20, 50, 100)


def _within(segments: DataFrame, regions: DataFrame) -> DataFrame:
    """(depth, size): how many bases of disjoint regions have each depth above 0."""
    depth = segments.select("chrom", F.col("start_pos").alias("r_start"), F.col("end_pos").alias("r_end"), "depth")
    hit = overlap_join(regions, depth)
    return hit.groupBy("depth").agg(F.sum(F.least("end_pos", "r_end") - F.greatest("start_pos", "r_start") + 1).alias("size"))


def capture_stats(reads: DataFrame, baits: DataFrame, targets: DataFrame, near: int = 100, low: float = 2) -> DataFrame:
    """One row for baits and one for targets, both merged: their bases; mapped bases on, near (within `near`, but not on) and off them, of reads
    that aren't duplicates; reads on and near them; mean and sd of the coverage and the shares of bases covered at least so many times; how many
    of them have a mean coverage below `low`; and, for baits, the share of target bases in bait bases."""
    kept = reads.where(~has(UNMAPPED) & ~has(DUPLICATE))
    segments, spans = depth_segments(kept), kept.select("chrom", "pos", "seq_len")
    mapped = kept.agg(F.sum("seq_len").alias("mapped_bases"))
    rows = []
    for kind, raw in (("bait", baits), ("target", targets)):
        on, wide = merge_intervals(raw), merge_intervals(raw, near)
        size = on.agg(F.sum(F.col("end_pos") - F.col("start_pos") + 1).alias("bases"), F.count("*").alias("n_regions"))
        d, n = F.col("depth"), F.col("size")
        cover = _within(segments, on).agg(F.sum(n * d).alias("on_bases"), F.sum(n * d * d).alias("_square"), *(F.sum(F.when(d >= t, n).otherwise(0)).alias(f"_x{t}") for t in DEPTHS))
        around = _within(segments, wide).agg(F.sum(n * d).alias("_wide"))
        counts = [reads_in_intervals(spans, x).agg(F.count("*").alias(name)) for x, name in ((on, "reads_on"), (wide, "_reads_wide"))]
        poor = target_coverage(segments, on).agg(F.count_if(F.col("mean_coverage") < low).alias("low_regions"))
        one = size.withColumn("kind", F.lit(kind))
        for x in (cover, around, *counts, poor, mapped):
            one = one.join(F.broadcast(x))
        rows.append(one.fillna(0))
    x = rows[0].union(rows[1])
    bases = F.col("bases")
    mean = F.col("on_bases") / bases
    targets_in_all = F.max(F.when(F.col("kind") == "target", bases)).over(Window.partitionBy())  # two rows
    return x.select(
        "kind", "bases", "n_regions", "on_bases", (F.col("_wide") - F.col("on_bases")).alias("near_bases"), (F.col("mapped_bases") - F.col("_wide")).alias("off_bases"), "reads_on", (F.col("_reads_wide") - F.col("reads_on")).alias("reads_near"),
        mean.alias("mean_coverage"), F.sqrt(F.greatest(F.lit(0.0), F.col("_square") / bases - mean * mean)).alias("sd_coverage"), *((F.col(f"_x{t}") / bases).alias(f"share_{t}x") for t in DEPTHS), "low_regions",
        F.when(F.col("kind") == "bait", targets_in_all / bases).alias("design_efficiency"),
    )


def previous_row_fill(reads: DataFrame, order: str, column: str, block: int = 1 << 20, first: str = "unknown_readgroup") -> DataFrame:
    """A null takes the last value before it in order; nulls in front get `first`. Runs block by block of `order`, blocks' last values
    then run over the few blocks."""
    known = F.when(F.col(column).isNotNull(), F.struct(F.col(order).alias("at"), F.col(column).alias("v")))
    out = running(reads, [], order, [order], known, "_last", "max", block=block)
    return out.withColumn(column, F.coalesce("_last.v", F.lit(first))).drop("_last")


def single_hits(reads: DataFrame, name: str = "qname") -> DataFrame:
    """Rows whose name has one row only. Counting and the row itself are one aggregate, so names with many rows aren't gathered."""
    rest = [c for c in reads.columns if c != name]
    one = reads.groupBy(name).agg(F.count("*").alias("_n"), F.min(F.struct(*rest)).alias("_r")).where("_n = 1")
    return one.select(name, "_r.*").select(*reads.columns)


def unaligned(fastq: DataFrame, reads: DataFrame) -> DataFrame:
    """Records whose read no alignment has, as unmapped reads (qname, flag, seq_len). A record's mate number is its name's ending /1 or /2, an
    alignment's its first or second flag (1 if neither is set, or if its name has such an ending, that)."""
    mate = lambda name, other: F.coalesce(F.nullif(F.regexp_extract(name, "/([12])$", 1), F.lit("")).cast("int"), other)
    bare = lambda name: F.regexp_replace(name, "/[12]?$", "")
    have = reads.select(bare(F.col("qname")).alias("qname"), mate(F.col("qname"), F.when(has(READ2) & ~has(READ1), 2).otherwise(1)).alias("mate")).distinct()
    records = fastq.select(bare(F.col("name")).alias("qname"), mate(F.col("name"), F.lit(1)).alias("mate"), F.regexp_like("name", F.lit("/[12]$")).alias("_paired"), F.length("seq").cast("long").alias("seq_len"))
    flag = F.lit(UNMAPPED) + F.when(F.col("_paired"), PAIRED + F.when(F.col("mate") == 1, READ1).otherwise(READ2)).otherwise(0)
    return records.join(have, ["qname", "mate"], "left_anti").select("qname", flag.cast("long").alias("flag"), "seq_len")


def with_unaligned(reads: DataFrame, fastq: DataFrame) -> DataFrame:
    """The alignments with the records that they lack appended as unmapped rows, whose other columns are null."""
    return reads.unionByName(unaligned(fastq, reads), allowMissingColumns=True)


def similar_alignments(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either set, by name, reference and position among those with mapping quality, that the other lacks."""
    key = ["qname", "chrom", "pos"]
    x, y = a.where("mapq > 0").select(*key), b.where("mapq > 0").select(*key)
    return x.exceptAll(y).withColumn("side", F.lit("a")).unionAll(y.exceptAll(x).withColumn("side", F.lit("b")))


def merge_up(reads: DataFrame, levels: list[str], chrom: str | None = None) -> DataFrame:
    """C11: reads and bases without flagged duplicates at each level of a hierarchy of columns, from the last one up, and of all; of one sequence if
    it is given."""
    kept = reads.where(~has(DUPLICATE))
    return (kept.where(F.col("chrom") == chrom) if chrom else kept).rollup(*levels).agg(F.count("*").alias("n"), F.sum("seq_len").alias("bases"))
