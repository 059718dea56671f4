"""Genotype likelihoods, ploidy, phase and copy-number comparisons."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.prefix import running
from .intervals import merge_intervals
from .records import forward_in_region


def likely_genotype(pl: Column, n_alleles: Column) -> Column:
    """X5: 'j/i' of the smallest likelihood score (the first on ties), whose index is i * (i + 1) / 2 + j; a list as long as the alleles is haploid."""
    k = F.array_position(pl, F.array_min(pl)) - 1
    i = F.floor((F.sqrt(8 * k + 1) - 1) / 2).cast("long")
    return F.when(F.size(pl) == n_alleles, F.concat_ws("/", k, k)).otherwise(F.concat_ws("/", k - (i * (i + 1) / 2).cast("long"), i))


def hwe_p(hom1: int, het: int, hom2: int) -> float | None:
    """The exact probability of heterozygote counts no likelier than this one, given the allele counts; null if there is no genotype. Logarithms of all counts' likelihoods are one
    running sum: from h to h + 2 heterozygotes the likelihood grows by 4 x y / ((h + 1) (h + 2)), x and y homozygotes of either kind."""
    n, a = hom1 + het + hom2, 2 * hom1 + het
    if not n:
        return None
    h = np.arange(a % 2, min(a, 2 * n - a) + 1, 2, dtype=np.float64)
    steps = np.log(a - h[:-1]) + np.log(2 * n - a - h[:-1]) - np.log(h[:-1] + 1) - np.log(h[:-1] + 2)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    p = np.exp(logs - logs.max())
    return float(p[logs - logs[(het - a % 2) // 2] <= 1e-9].sum() / p.sum())


def hwe_exact(counts: DataFrame) -> DataFrame:
    """Adds p to rows (hom1, het, hom2). Each distinct triple is computed once; rows with a null count get null."""

    def compute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["p"] = [hwe_p(int(x), int(y), int(z)) for x, y, z in zip(b.hom1, b.het, b.hom2)]
            yield b

    key = ["hom1", "het", "hom2"]
    triples = counts.select(*(F.col(c).cast("long").alias(c) for c in key)).dropna().distinct()
    return counts.join(triples.mapInPandas(compute, "hom1 long, het long, hom2 long, p double"), key, "left")


def dp4_ratios(df: DataFrame) -> DataFrame:
    """X11: strand depths of a text 'ref forward, ref reverse, alt forward, alt reverse' and shares of the alternative on either strand and of heterozygosity;
    0 where undefined."""
    parts = F.split("dp4", ",")
    d = [F.get(parts, F.lit(i)).cast("long") for i in range(4)]
    share = lambda a, b: F.coalesce(F.try_divide(a, a + b), F.lit(0.0))
    return df.withColumns({"ref_depth": d[0] + d[1], "alt_depth": d[2] + d[3], "ratio_forward": share(d[2], d[0]), "ratio_reverse": share(d[3], d[1])})


def reploid(values: Column, n_alleles: int, diploid: bool) -> tuple[Column, Column]:
    """Likelihood scores (smaller is likelier, null unknown) of one ploidy from the other, and the allele of the smallest (0 if all are unknown).
    To diploid, only equal pairs are known; to haploid, only equal pairs are used."""
    equal = [i * (i + 3) // 2 for i in range(n_alleles)]
    if diploid:
        order = [(i, i == j) for i in range(n_alleles) for j in range(i + 1)]
        out = F.array(*(F.get(values, F.lit(i)) if same else F.lit(None) for i, same in order))
        known = F.array(*(F.get(values, F.lit(i)) for i in range(n_alleles)))
    else:
        out = known = F.array(*(F.get(values, F.lit(k)) for k in equal))
    best = F.coalesce(F.array_position(known, F.array_min(known)) - 1, F.lit(0))
    return out, best


# Strand names of allele pairs that tell the strand by themselves.
PAIR_STRAND = {"AC": "TOP", "AG": "TOP", "CT": "BOT", "GT": "BOT"}


def top_strand(a: Column, b: Column, left: Column, right: Column) -> Column:
    """TOP or BOT of an allele pair. A/T and C/G are told by the nearest bases outwards, `left` and `right` of the site, that are not such
    a pair themselves: TOP if the left one is A or T. Null if none is."""
    pair = F.concat(F.least(a, b), F.greatest(a, b))
    plain = F.coalesce(*(F.when(pair == p, s) for p, s in PAIR_STRAND.items()))
    outward = F.arrays_zip(F.split(F.reverse(left), "").alias("l"), F.split(right, "").alias("r"))
    weak = lambda c: c.isin("A", "T")
    tells = F.filter(outward, lambda x: x["l"].isin("A", "C", "G", "T") & x["r"].isin("A", "C", "G", "T") & (weak(x["l"]) != weak(x["r"])))
    walked = F.when(weak(F.get(tells, F.lit(0))["l"]), "TOP").when(F.size(tells) > 0, "BOT")
    return F.coalesce(plain, F.when(pair.isin("AT", "CG"), walked))


def phased_join(gt: DataFrame) -> DataFrame:
    """Overlapping phased chunks (chunk_no, sample, site, a1, a2) put together. Of a sample's heterozygous sites in the overlap of a chunk and
    the one before, those with equal and with exchanged alleles are counted; a chunk is turned if most are exchanged, relative to
    the chunk before as it was turned. Of a site's two records, the one farther from the end of its chunk stays."""
    ends = gt.groupBy("chunk_no").agg(F.min("site").alias("_from"), F.max("site").alias("_to"))
    before = gt.select((F.col("chunk_no") + 1).alias("chunk_no"), "sample", "site", F.col("a1").alias("b1"), F.col("a2").alias("b2"))
    het = (F.col("a1") != F.col("a2")) & (F.col("b1") != F.col("b2"))
    same = F.count_if(het & (F.col("a1") == F.col("b1")) & (F.col("a2") == F.col("b2")))
    turned = F.count_if(het & (F.col("a1") == F.col("b2")) & (F.col("a2") == F.col("b1")))
    pairs = gt.join(before, ["chunk_no", "sample", "site"]).groupBy("chunk_no", "sample").agg(same.alias("n_same"), turned.alias("n_turned"))
    chunks = gt.select("chunk_no", "sample").distinct().join(pairs, ["chunk_no", "sample"], "left")
    flips = F.sum(F.when(F.col("n_turned") > F.col("n_same"), 1).otherwise(0)).over(Window.partitionBy("sample").orderBy("chunk_no"))
    turns = chunks.select("chunk_no", "sample", (flips % 2 == 1).alias("_turn"))
    rows = gt.join(turns, ["chunk_no", "sample"]).join(ends, "chunk_no")
    far = F.least(F.col("site") - F.col("_from"), F.col("_to") - F.col("site"))
    out = F.struct("chunk_no", F.when(F.col("_turn"), F.col("a2")).otherwise(F.col("a1")).alias("a1"), F.when(F.col("_turn"), F.col("a1")).otherwise(F.col("a2")).alias("a2"))
    return rows.groupBy("sample", "site").agg(F.max_by(out, F.struct(far, -F.col("chunk_no"))).alias("r")).select("sample", "site", "r.*")


def fix_ploidy(gt: DataFrame, sexes: DataFrame, regions: DataFrame, order: str) -> DataFrame:
    """Genotypes (chrom, pos, sample, a1, a2) given the ploidy of their sample's sex (sample, sex) in their region (region_id, chrom, start_pos, end_pos, male,
    female; 2 elsewhere): 0 makes both alleles missing, 1 drops the second. `changed` tells which rows were. Ploidies travel within the region's id."""
    ploidies = regions.select("chrom", "start_pos", "end_pos", F.struct("region_id", "male", "female").alias("region_id"))
    held = forward_in_region(gt, ploidies, order).join(sexes, "sample", "left")
    n = F.coalesce(F.when(F.col("sex") == "M", F.col("region_id.male")).when(F.col("sex") == "F", F.col("region_id.female")), F.lit(2))
    changed = F.when(n == 0, F.col("a1").isNotNull() | F.col("a2").isNotNull()).when(n == 1, F.col("a2").isNotNull()).otherwise(False)
    return held.withColumns({"changed": changed, "a1": F.when(n > 0, F.col("a1")), "a2": F.when(n > 1, F.col("a2"))}).drop("region_id", "sex")


def segment_diff(segments: DataFrame, least: float) -> DataFrame:
    """For each sample, how much and how often its copy number differs from the control's, and how much of it another sample has just so. Segments
    (sample, chrom, start_pos, end_pos, control, copies, qual) have common breakpoints and half-open ends; a difference of a quality below
    `least` counts as none. A run of touching segments with equal values is one difference."""
    x = segments.withColumn("copies", F.when(F.col("qual") < least, F.col("control")).otherwise(F.col("copies")))
    differs = F.col("copies") != F.col("control")
    # A segment continues the one that ends where it starts; a join finds it without ordering a chromosome's segments.
    last = x.select("sample", "chrom", F.col("end_pos").alias("start_pos"), F.col("control").alias("_control"), F.col("copies").alias("_copies")).distinct()
    goes_on = F.coalesce((F.col("_control") == F.col("control")) & (F.col("_copies") == F.col("copies")), F.lit(False))
    others = x.where(differs).groupBy("chrom", "start_pos", "end_pos", "control", "copies").agg(F.count_distinct("sample").alias("_samples"))
    y = x.join(last, ["sample", "chrom", "start_pos"], "left").join(others, ["chrom", "start_pos", "end_pos", "control", "copies"], "left")
    size = F.col("end_pos") - F.col("start_pos")
    total = lambda c: F.coalesce(F.sum(F.when(c, size)), F.lit(0))
    return y.groupBy("sample").agg(F.count_if(differs & ~goes_on).alias("n_different"), total(differs).alias("length_different"), total(differs & (F.col("_samples") > 1)).alias("length_shared"))


def genotype_lookup(sites: DataFrame, ped: DataFrame) -> DataFrame:
    """Genotypes (two letters) of candidate samples at called sites (chrom, pos, reverse), complemented where the site is on the reverse strand."""
    return ped.join(sites.select("chrom", "pos", "reverse").distinct(), ["chrom", "pos"]).select("chrom", "pos", "sample", F.when(F.col("reverse"), F.translate("gt", "ACGT", "TGCA")).otherwise(F.col("gt")).alias("gt"))


def loh_blocks(gt: DataFrame, sizes: list[int], flexes: list[int]) -> DataFrame:
    """Stretches in which a sample's genotypes differ from the control's. Sites (sample, chrom, idx gapless within both, pos, differs) are looked at in windows
    of each size; one counts if at least size - int(size * flex / 100) of its sites, and two, differ. Overlapping windows are one block,
    trimmed to sites that differ. For each sample, the setting (size, flex) whose blocks hold the most sites is kept, the smallest on ties.

    A window's count is the difference of two running counts, joined on the index, so no chromosome is ordered in one task."""
    keys = ["sample", "chrom"]
    cum = running(gt, keys, "idx", ["idx"], F.col("differs").cast("long"), "_cum", "sum").select(*keys, "idx", "differs", "_cum")
    head = cum.select(*keys, "idx", (F.col("_cum") - F.col("differs").cast("long")).alias("_before")).withColumn("size", F.explode(F.array(*map(F.lit, sizes))))
    tail = cum.select(*keys, F.col("idx").alias("_end"), F.col("_cum").alias("_upto"))
    windows = head.withColumn("_end", F.col("idx") + F.col("size") - 1).join(tail, [*keys, "_end"]).withColumn("n", F.col("_upto") - F.col("_before"))
    tried = windows.withColumn("flex", F.explode(F.array(*map(F.lit, flexes)))).where((F.col("n") >= F.col("size") - F.floor(F.col("size") * F.col("flex") / 100)) & (F.col("n") >= 2))
    # Settings run side by side: sample, chromosome, size and flex make up one key of merge_intervals, a JSON text.
    one = F.to_json(F.struct(*keys, "size", "flex"))
    # merge_intervals also joins what merely touches; doubling the scale leaves a gap between windows that don't overlap.
    spans = tried.select(one.alias("chrom"), (2 * F.col("idx")).alias("start_pos"), (2 * F.col("_end")).alias("end_pos"))
    blocks = merge_intervals(spans).select(F.from_json("chrom", "sample string, chrom string, size int, flex int").alias("k"), "start_pos", "end_pos").select("k.*", (F.col("start_pos") / 2).cast("long").alias("_s"), (F.col("end_pos") / 2).cast("long").alias("_e"))
    inside = blocks.withColumn("idx", F.explode(F.sequence("_s", "_e"))).join(gt.where("differs").select(*keys, "idx", "pos"), [*keys, "idx"])
    trimmed = inside.groupBy(*keys, "size", "flex", "_s").agg(F.min("idx").alias("_i"), F.max("idx").alias("_j"), F.min("pos").alias("start_pos"), F.max("pos").alias("end_pos"), F.count("*").alias("n_different"))
    held = trimmed.withColumn("n_sites", F.col("_j") - F.col("_i") + 1)
    best = held.groupBy("sample", "size", "flex").agg(F.sum("n_sites").alias("_n")).groupBy("sample").agg(F.max_by(F.struct("size", "flex"), F.struct("_n", -F.col("size"), -F.col("flex"))).alias("_b"))
    return held.join(best, "sample").where((F.col("size") == F.col("_b.size")) & (F.col("flex") == F.col("_b.flex"))).select("sample", "chrom", "size", "flex", "start_pos", "end_pos", "n_different", "n_sites")


def gen_table(gt: DataFrame, sites: DataFrame, samples: list[str], min_ac: int) -> DataFrame:
    """K5: a line of each site of two single-base alleles, no missing genotype and at least min_ac alternative alleles: three probabilities for each sample, in
    the order of the list, and beside it the alleles of each as haplotypes. Of sites at one position the first counts."""
    plain = sites.where(F.col("ref").rlike("^[ACGT]$") & F.col("alt").rlike("^[ACGT]$") & (F.col("ref") != F.col("alt")))
    first = plain.groupBy("chrom", "pos").agg(F.min_by(F.struct("site", "ref", "alt"), "site").alias("r")).select("chrom", "pos", "r.*")
    cell = F.when(F.col("a1") + F.col("a2") == 0, "1 0 0").when(F.col("a1") + F.col("a2") == 1, "0 1 0").otherwise("0 0 1")
    used = gt.where(F.col("sample").isin(samples) & F.col("a1").isNotNull() & F.col("a2").isNotNull())
    of = lambda s, c: F.max(F.when(F.col("sample") == s, c))
    wide = used.groupBy("site").agg(F.count("*").alias("_n"), F.sum(F.col("a1") + F.col("a2")).alias("ac"), *(of(s, cell).alias(f"_g{i}") for i, s in enumerate(samples)), *(of(s, F.concat_ws(" ", "a1", "a2")).alias(f"_h{i}") for i, s in enumerate(samples)))
    full = first.join(wide.where((F.col("_n") == len(samples)) & (F.col("ac") >= min_ac)), "site")
    join = lambda c: F.concat_ws(" ", *(f"_{c}{i}" for i in range(len(samples))))
    return full.select("site", F.concat_ws(" ", "chrom", "pos", "ref", "alt").alias("legend"), join("g").alias("gen"), join("h").alias("hap"))


def gen_haps(gt: DataFrame, sites: DataFrame, samples: list[str], min_count: int = 1) -> dict[str, DataFrame]:
    """K5: the four tables of an imputation program's input: gen (site's id, pos, alleles and three shares of each sample) and hap (two alleles of each sample), each a text
    line by site, legend (id, pos, a0, a1) and samples. Sites are those of gen_table."""
    made = gen_table(gt, sites, samples, min_count)
    fields = F.split("legend", " ")
    name = F.concat_ws(":", F.get(fields, F.lit(0)), F.get(fields, F.lit(1)))
    at = lambda k: F.get(fields, F.lit(k))
    people = gt.where(F.col("sample").isin(samples)).select("sample").distinct()
    return {
        "gen": made.select("site", F.concat_ws(" ", at(0), name, at(1), at(2), at(3), "gen").alias("line")), "hap": made.select("site", F.col("hap").alias("line")),
        "legend": made.select("site", F.concat_ws(" ", name, at(1), at(2), at(3)).alias("line")), "sample": people.select("sample", F.concat_ws(" ", "sample", "sample", F.lit("0")).alias("line")),
    }
