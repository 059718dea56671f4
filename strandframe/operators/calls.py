"""Several call sets and genotypes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .variants import cluster_by_distance


def combinations(calls: DataFrame, win: int = 0) -> DataFrame:
    """Groups of calls (src, chrom, pos) within `win` of one another, with the list of sets in each and how many there are."""
    return cluster_by_distance(calls, win).groupBy("chrom", "grp").agg(F.array_join(F.array_sort(F.collect_set("src")), ",").alias("combination"), F.count_distinct("src").alias("n_src"), F.count("*").alias("n_calls"), F.min("pos").alias("pos"))


def venn_counts(calls: DataFrame, win: int = 0) -> DataFrame:
    """Sites of each exact combination of call sets, and calls lost to grouping."""
    return combinations(calls, win).groupBy("combination").agg(F.count("*").alias("sites"), F.sum(F.col("n_calls") - F.col("n_src")).alias("lost"))


def venn_shares(calls: DataFrame, win: int = 0) -> DataFrame:
    """For each combination and call set in it, the sites and what percentage of the set's sites they are."""
    each = venn_counts(calls, win).withColumn("src", F.explode(F.split("combination", ","))).select("combination", "src", "sites")
    totals = each.groupBy("src").agg(F.sum("sites").alias("_all"))
    return each.join(F.broadcast(totals), "src").select("combination", "src", "sites", (100 * F.col("sites") / F.col("_all")).alias("percent"))


def allele_matches(a: DataFrame, b: DataFrame) -> DataFrame:
    """Positions that both sets have, and at how many of them ref and alt agree."""
    x = a.groupBy("chrom", "pos").agg(F.min(F.struct("ref", "alt")).alias("x")).join(b.groupBy("chrom", "pos").agg(F.min(F.struct("ref", "alt")).alias("y")), ["chrom", "pos"])
    same = lambda c: F.col(f"x.{c}") == F.col(f"y.{c}")
    return x.agg(F.count("*").alias("shared"), F.count_if(same("ref")).alias("ref_match"), F.count_if(~same("ref")).alias("ref_mismatch"), F.count_if(same("alt")).alias("alt_match"), F.count_if(~same("alt")).alias("alt_mismatch"))


def isec(calls: DataFrame, n: int, op: str = "=", win: int = 0) -> DataFrame:
    """Groups in exactly (=), at least (+) or at most (-) n sets."""
    have = F.col("n_src")
    return combinations(calls, win).where({"=": have == n, "+": have >= n, "-": have <= n}[op]).select("chrom", "pos", "combination")


def isec_records(calls: DataFrame, n: int, op: str = "=", win: int = 0, one_file_only: bool = False) -> DataFrame:
    """The records of such groups, each with sf: the sets that its group has, in order, with an f after those all of whose records there failed (column
    failed). At one position only the record of the first set stays; with one_file_only, only records of the first set that the group has."""
    grouped = cluster_by_distance(calls, win)
    by_src = grouped.groupBy("chrom", "grp", "src").agg(F.bool_and("failed").alias("_f"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("src", "_f"))), lambda x: F.concat(x["src"].cast("string"), F.when(x["_f"], "f").otherwise("")))
    groups = by_src.groupBy("chrom", "grp").agg(F.array_join(names, ",").alias("sf"), F.count("*").alias("n_src"), F.min("src").alias("_first"))
    have = F.col("n_src")
    hit = grouped.join(groups.where({"=": have == n, "+": have >= n, "-": have <= n}[op]), ["chrom", "grp"])
    hit = hit.where(F.col("src") == F.col("_first")) if one_file_only else hit
    rest = [c for c in calls.columns if c not in ("chrom", "pos", "src")]
    return hit.groupBy("chrom", "pos", "sf").agg(F.min(F.struct("src", *rest)).alias("r")).select("chrom", "pos", "sf", "r.*")


def complement(calls: DataFrame, src: int, win: int = 0) -> DataFrame:
    """Groups that only one given set has."""
    return combinations(calls, win).where(F.col("combination") == str(src)).select("chrom", "pos")


def merge_sets(calls: DataFrame, weights: dict[int, int]) -> DataFrame:
    """U4: one row of each (chrom, pos, allele): the sets that have it, and quality averaged by the sets' weights where it is positive."""
    w: Column = F.lit(1)
    for src, k in weights.items():
        w = F.when(F.col("src") == src, k).otherwise(w)
    good = F.col("qual") > 0
    mean = F.sum(F.when(good, F.col("qual") * w)) / F.sum(F.when(good, w))
    return calls.groupBy("chrom", "pos", "allele").agg(F.array_join(F.array_sort(F.collect_set("src")), ",").alias("sf"), mean.alias("qual"))


def matched_records(records: DataFrame, collapse: str | None = None) -> DataFrame:
    """Records of several sets with _longest, the longest ref of their position, _alts, their alternatives with the bases that theirs lacks, and _kind, equal for those
    that merge (see merge_records)."""
    long = F.col("_longest")
    grown = F.transform("alts", lambda a: F.when(a.startswith("<"), a).otherwise(F.concat(a, F.substring(long, F.length("ref") + 1, F.length(long)))))
    top = records.groupBy("chrom", "pos").agg(F.max_by("ref", F.struct(F.length("ref"), F.col("ref"))).alias("_longest"))
    x = records.join(top, ["chrom", "pos"]).withColumn("_alts", grown)
    if collapse == "any":
        x = x.withColumn("_kind", F.lit("any"))
    elif collapse in ("snps", "indels"):
        x = x.withColumn("_kind", F.when(F.forall("_alts", lambda a: F.length(a) == F.length(long)), "snps").otherwise("indels"))
    else:
        first = x.groupBy("chrom", "pos").agg(F.min_by("_alts", "src").alias("_of_first"))
        x = x.join(first, ["chrom", "pos"]).withColumn("_kind", F.when(F.arrays_overlap("_alts", "_of_first"), "first").otherwise(F.concat_ws(",", F.array_sort("_alts"))))
    return x


def merge_records(records: DataFrame, info: dict[str, Column] | None = None, collapse: str | None = None) -> DataFrame:
    """U4: one record of each site out of several sets' records (src, chrom, pos, id, ref, alts, qual, filter array, info map, n_samples): ref is the longest, alts,
    with the bases that theirs lacks, are all of them in the order of sets (symbolic ones stay); id and other INFO keys are the first there are; qual the mean
    of positive ones weighted by samples (1 at least); filter all names, PASS only if alone; sf the sets; an and ac added up over sets by alternative;
    `info` has aggregates of other INFO keys. Records of one position merge if they share an alternative with the site's first record, or all of
    them (collapse any), those of substitutions and those of length changes apart (snps, indels)."""
    x = matched_records(records, collapse)
    good, w = F.col("qual") > 0, F.greatest(F.col("n_samples"), F.lit(1))
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(F.struct(F.col("src").alias("s"), F.col(c).alias("v")))), lambda v: v["v"])
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("src")))
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_list("filter"))))
    counted = F.map_from_arrays(F.col("_alts"), F.transform(F.split(F.coalesce(F.try_element_at("info", F.lit("AC")), F.lit("")), ","), lambda v: F.coalesce(v.try_cast("long"), F.lit(0))))
    x = x.withColumn("_ac", F.when(F.try_element_at("info", F.lit("AC")).isNotNull(), counted))
    made = x.groupBy("chrom", "pos", F.col("_longest").alias("ref"), "_kind").agg(
        first("id").alias("id"), F.array_distinct(F.flatten(in_order("_alts"))).alias("alts"), (F.sum(F.when(good, F.col("qual") * w)) / F.sum(F.when(good, w))).alias("qual"), names.alias("_filter"),
        F.array_join(F.array_sort(F.collect_set("src")).cast("array<string>"), ",").alias("sf"), F.sum(F.try_element_at("info", F.lit("AN")).try_cast("long")).alias("an"), F.collect_list("_ac").alias("_acs"),
        *(c.alias(name) for name, c in (info or {}).items()),
    )
    others = F.filter("_filter", lambda f: f != "PASS")
    ac = F.transform("alts", lambda a: F.aggregate("_acs", F.lit(0).cast("long"), lambda total, m: total + F.coalesce(F.try_element_at(m, a), F.lit(0))))
    filters = F.when(F.size(others) > 0, F.array_join(others, ";")).when(F.size("_filter") > 0, "PASS").otherwise(".")
    return made.select("chrom", "pos", "id", "ref", F.array_join("alts", ",").alias("alt"), "qual", filters.alias("filter"), "sf", "an", F.array_join(ac.cast("array<string>"), ",").alias("ac"), *(info or {}))


def remap_genotypes(gt: DataFrame, merged_alts: str = "merged_alts", own_alts: str = "alts") -> DataFrame:
    """U4: allele indexes a1 and a2 of one set's alternatives as those of the merged site's (0 stays, null stays)."""
    to = lambda c: F.when(F.col(c) == 0, F.lit(0).cast("long")).otherwise(F.array_position(F.col(merged_alts), F.get(F.col(own_alts), (F.col(c) - 1).cast("int"))).cast("long"))
    return gt.withColumns({c: F.when(F.col(c).isNotNull(), to(c)) for c in ("a1", "a2")})


def list_status(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """UNIQ1, UNIQ2 or ISECT for each key of two lists, with its count on either side."""
    x, y = a.groupBy(key).agg(F.count("*").alias("n1")), b.groupBy(key).agg(F.count("*").alias("n2"))
    status = F.when(F.col("n2").isNull(), "UNIQ1").when(F.col("n1").isNull(), "UNIQ2").otherwise("ISECT")
    return x.join(y, key, "full").select(key, F.coalesce("n1", F.lit(0)).alias("n1"), F.coalesce("n2", F.lit(0)).alias("n2"), status.alias("status"))


def allele_counts(gt: DataFrame, n_alts: int = 1) -> DataFrame:
    """Alleles called (an) and how often each alternative is (ac, joined with ','; 0 for absent ones) at each site. Missing alleles don't count; a haploid
    genotype has one allele, a1."""
    of = lambda c, k: F.count_if(F.col(c) == k)
    ac = F.array_join(F.array(*((of("a1", k) + of("a2", k)).cast("string") for k in range(1, n_alts + 1))), ",")
    return gt.groupBy("site").agg((F.count("a1") + F.count("a2")).alias("an"), ac.alias("ac"))


def inbreeding(gt: DataFrame) -> DataFrame:
    """Alleles n and heterozygotes het of each site's diploid calls, the inbreeding coefficient (null where all alleles are equal), and the genotype counts hom1 (without the
    alternative) and hom2, from which hwe_exact tells the exact probability. Sites where a call has a second alternative are left out."""
    both = F.col("a1") + F.col("a2")
    c = gt.where("a1 IS NOT NULL AND a2 IS NOT NULL").groupBy("site").agg((2 * F.count("*")).alias("n"), F.count_if(both == 0).alias("hom1"), F.count_if(both == 1).alias("het"), F.count_if(both == 2).alias("hom2"), F.max(F.greatest("a1", "a2")).alias("_most")).where("_most < 2")
    p = (F.col("het") + 2 * F.col("hom2")) / F.col("n")
    icf = F.when((p > 0) & (p < 1), 1 - (2 * F.col("het") / F.col("n")) / (2 * p * (1 - p)))
    return c.select("site", "n", "hom1", "het", "hom2", icf.alias("icf"))


def cohort_summary(gt: DataFrame, n_alts: int = 1) -> DataFrame:
    """For each site and cohort, and for each site in all (cohort null): alleles called, count of each alternative and the smallest of these, genotype
    counts (of alleles i <= j at j (j + 1) / 2 + i; a single allele counts as a pair of it), inbreeding coefficient (of biallelic sites, null
    where all alleles are equal), mean depth, and which cohorts have an alternative and how many these are. A row is a genotype (site, sample, cohort,
    a1, a2, dp, haploid); the exact Hardy-Weinberg probability is hwe_exact of the genotype counts."""
    a1, a2 = F.col("a1"), F.when(F.col("haploid"), F.col("a1")).otherwise(F.col("a2"))
    pairs = [(i, j) for j in range(n_alts + 1) for i in range(j + 1)]
    count = lambda k: F.count_if(F.col("a1") == k) + F.count_if(~F.col("haploid") & (F.col("a2") == k))
    has_alt = (F.col("a1") > 0) | (~F.col("haploid") & (F.col("a2") > 0))
    x = gt.withColumn("_of", F.col("cohort"))
    x = x if "haploid" in gt.columns else x.withColumn("haploid", F.lit(False))
    made = x.groupingSets([["site", "cohort"], ["site"]], "site", "cohort").agg(
        (F.count("a1") + F.count(F.when(~F.col("haploid"), F.col("a2")))).alias("an"), F.array(*map(count, range(1, n_alts + 1))).alias("ac"),
        F.array(*(F.count_if((F.least(a1, a2) == i) & (F.greatest(a1, a2) == j) & a1.isNotNull() & a2.isNotNull()) for i, j in pairs)).alias("gc"), F.avg("dp").alias("mean_dp"),
        F.array_sort(F.collect_set(F.when(has_alt, F.col("_of")))).alias("cohorts"),
    )
    hom1, het, hom2 = (F.get("gc", F.lit(k)) for k in range(3))
    n, p = hom1 + het + hom2, (2 * hom2 + het) / F.nullif(2 * (hom1 + het + hom2), F.lit(0))
    icf = F.when((p > 0) & (p < 1), 1 - (het / n) / (2 * p * (1 - p))) if n_alts == 1 else F.lit(None).cast("double")
    text = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    return made.select("site", "cohort", "an", text("ac").alias("ac"), F.array_min("ac").alias("mac"), text("gc").alias("gc"), icf.alias("icf"), "mean_dp", F.size("cohorts").alias("n_cohorts"), text("cohorts").alias("cohorts"))


def genotype_type(a1: Column, a2: Column) -> Column:
    """hom_RR, het_RA, hom_AA or het_AA by allele indexes, 0 being the reference; null if one is missing."""
    both = a1.isNotNull() & a2.isNotNull()
    return F.when(both & (a1 == 0) & (a2 == 0), "hom_RR").when(both & (a1 == a2), "hom_AA").when(both & ((a1 == 0) | (a2 == 0)), "het_RA").when(both, "het_AA")


def sample_stats(gt: DataFrame) -> DataFrame:
    """Genotypes of each sample by type and by the site's kind (column kind: snp or indel), phased and unphased ones, and alternative calls that no
    other sample has."""
    alt = F.col("a1") + F.col("a2") > 0
    sharing = gt.groupBy("site").agg(F.count_if(alt).alias("n_alt"))
    x = gt.join(sharing, "site").withColumn("type", genotype_type(F.col("a1"), F.col("a2")))
    called = F.col("type").isNotNull()
    return x.groupBy("sample").agg(
        *(F.count_if(F.col("type") == t).alias(t.lower()) for t in ("hom_RR", "het_RA", "hom_AA", "het_AA")), F.count_if(~called).alias("missing"), F.count_if(called & (F.col("phased") == 1)).alias("phased"),
        F.count_if(called & (F.col("phased") == 0)).alias("unphased"), F.count_if(alt & (F.col("kind") == "snp")).alias("snps"), F.count_if(alt & (F.col("kind") == "indel")).alias("indels"), F.count_if(alt & (F.col("n_alt") == 1)).alias("private"),
    )


def shared_spectrum(gt: DataFrame) -> DataFrame:
    """Sites by the number of samples that have an alternative allele there."""
    return gt.groupBy("site").agg(F.count_if(F.col("a1") + F.col("a2") > 0).alias("n_samples")).groupBy("n_samples").agg(F.count("*").alias("sites"))


def compared_genotypes(a: DataFrame, b: DataFrame, *bins: str) -> DataFrame:
    """The genotypes of two sets (site, sample, a1, a2, phased) side by side, with type (of the first set, or of the second where only that has one), type2,
    outcome (match, mismatch, lost, gained) and phase (match, mismatch, lost, gained or null). Of b also the columns `bins` are kept."""
    side = lambda df, k, *more: df.select("site", "sample", F.col("a1").alias(f"x{k}"), F.col("a2").alias(f"y{k}"), (F.col("phased") == 1).alias(f"p{k}"), *more)
    x = side(a, 1).join(side(b, 2, *bins), ["site", "sample"], "full")
    t1, t2 = genotype_type(F.col("x1"), F.col("y1")), genotype_type(F.col("x2"), F.col("y2"))
    same = (F.least("x1", "y1") == F.least("x2", "y2")) & (F.greatest("x1", "y1") == F.greatest("x2", "y2"))
    outcome = F.when(t1.isNull() & t2.isNull(), None).when(t1.isNull(), "gained").when(t2.isNull(), "lost").when(same, "match").otherwise("mismatch")
    ordered = (F.col("x1") == F.col("x2")) & (F.col("y1") == F.col("y2"))
    both = F.col("outcome").isin("match", "mismatch")
    agree = F.when(F.col("p1") & F.col("p2") & (F.col("outcome") == "match"), F.when(ordered, "match").otherwise("mismatch"))
    phase = F.when(both & F.col("p1") & ~F.col("p2"), "lost").when(both & ~F.col("p1") & F.col("p2"), "gained").otherwise(agree)
    return x.withColumns({"type": F.coalesce(t1, t2), "type2": t2, "outcome": outcome}).withColumn("phase", phase).where("outcome IS NOT NULL")


def concordance(a: DataFrame, b: DataFrame, *keys: str) -> DataFrame:
    """For each sample and genotype type (or other keys: sample, type, type2, and columns of b such as bins of depth, frequency or likelihood), how many
    genotypes of two sets match, differ, or are in one set only, and how the phase of those in both does."""
    keys = keys or ("sample", "type")
    x = compared_genotypes(a, b, *(k for k in keys if k not in ("site", "sample", "type", "type2")))
    counts = [F.count_if(F.col("outcome") == o).alias(o) for o in ("match", "mismatch", "lost", "gained")]
    return x.groupBy(*keys).agg(*counts, *(F.count_if(F.col("phase") == o).alias(f"phase_{o}") for o in ("match", "mismatch", "lost", "gained")))


def discordance(found: DataFrame) -> DataFrame:
    """Percentage of mismatches of each type, and in all (type null) that of genotypes where one set at least has an alternative: reference matches
    don't count."""
    by_type = found.groupBy("type").agg(F.sum("match").alias("match"), F.sum("mismatch").alias("mismatch"))
    alts = F.when(F.col("type") != "hom_RR", F.col("match")).otherwise(0)
    in_all = found.agg(F.lit(None).cast("string").alias("type"), F.sum(alts).alias("match"), F.sum("mismatch").alias("mismatch"))
    return by_type.union(in_all).withColumn("discordance", F.try_divide(100 * F.col("mismatch"), F.col("match") + F.col("mismatch")))


def genotype_identity(calls: DataFrame, candidates: DataFrame) -> DataFrame:
    """Sites compared and matching of each pair of sample and candidate, their share, and the candidate's rank for the sample (best first, then by
    name). Both sides are keyed by site; a site has a row for each sample, and samples of one site are compared with its candidates only."""
    mine = calls.where("a1 IS NOT NULL").select("site", F.col("sample"), (F.col("a1") + F.col("a2")).alias("g"))
    theirs = candidates.where("a1 IS NOT NULL").select("site", F.col("sample").alias("candidate"), (F.col("a1") + F.col("a2")).alias("cg"))
    pairs = mine.join(theirs, "site").groupBy("sample", "candidate").agg(F.count("*").alias("compared"), F.count_if(F.col("g") == F.col("cg")).alias("matching"))
    share = F.col("matching") / F.col("compared")
    return pairs.withColumn("share", share).withColumn("place", F.row_number().over(Window.partitionBy("sample").orderBy(F.desc("share"), "candidate")))


def best_two(identity: DataFrame) -> DataFrame:
    """The best and the second best candidate of each sample and their shares."""
    pick = lambda k, c: F.max(F.when(F.col("place") == k, F.col(c)))
    return identity.where("place <= 2").groupBy("sample").agg(pick(1, "candidate").alias("best"), pick(1, "share").alias("best_share"), pick(2, "candidate").alias("second"), pick(2, "share").alias("second_share"))


def sample_contrast(gt: DataFrame, case: str, background: list[str], min_dp: int, by_likelihood: bool = False) -> DataFrame:
    """Sites where the case has an allele that no background sample has, which must be called with min_dp at least, and a score: the smallest distance of a
    background sample from the case's genotype. By genotypes it is how many alleles differ (a haploid genotype, a2 null, is one away from any diploid one at least);
    by_likelihood it is the sample's likelihood score (array pl) of the case's genotype."""
    own = F.greatest(F.coalesce("a1", F.lit(0)), F.coalesce("a2", F.lit(0)))
    mine = gt.where(F.col("sample") == case).where(own > 0).select("site", F.col("a1").alias("_x"), F.col("a2").alias("_y"))
    x = gt.where(F.col("sample").isin(background)).join(mine, "site")
    ok = (F.col("dp") >= min_dp) & F.col("a1").isNotNull()
    has = lambda allele: (F.col("a1") == allele) | (F.col("a2") == allele)
    shares = lambda c: F.coalesce((F.col(c) > 0) & has(F.col(c)), F.lit(False))
    if by_likelihood:
        low, high = F.least("_x", F.coalesce("_y", "_x")), F.greatest("_x", F.coalesce("_y", "_x"))
        distance = F.get("pl", (high * (high + 1) / 2 + low).cast("int"))
    else:
        off = lambda a, b: (F.col(a) != F.col(b)).cast("long")
        same_ploidy = F.col("a2").isNull() == F.col("_y").isNull()
        paired = F.least(off("a1", "_x") + F.coalesce(off("a2", "_y"), F.lit(0)), F.coalesce(off("a1", "_y") + off("a2", "_x"), F.lit(2)))
        distance = F.when(same_ploidy, paired).otherwise(1 + F.when(has(F.col("_x")) | F.coalesce(has(F.col("_y")), F.lit(False)), 0).otherwise(1))
    alleles = {f"_shared{c}": F.max(shares(c)) for c in ("_x", "_y")}
    made = x.groupBy("site", "_x", "_y").agg(*(c.alias(name) for name, c in alleles.items()), F.count_if(ok).alias("n_background"), F.min("dp").alias("min_background_dp"), F.min(F.when(ok, distance)).alias("score"))
    novel = ((F.col("_x") > 0) & ~F.col("_shared_x")) | (F.coalesce(F.col("_y") > 0, F.lit(False)) & ~F.col("_shared_y"))
    return made.where(novel & (F.col("n_background") >= 1)).select("site", "n_background", "min_background_dp", F.col("score").cast("long").alias("score"))


def variant_subset(
    gt: DataFrame, samples: list[str], private: bool = False, exclude_ref: bool = True, keep_uncalled: bool = False, sites: DataFrame | None = None, types: list[str] | None = None, replace_with_ref: bool = False
) -> DataFrame:
    """Sites by the genotypes (site, sample, a1, a2) of chosen samples: how many of these have an alternative (inside), how many others (outside), and which
    alternatives are left (alts, the indexes that trimming keeps). exclude_ref drops sites where no chosen sample has an alternative, unless
    keep_uncalled and none of them is called; private drops those where another sample has one. With `types`, sites (site, kind) of other kinds
    are dropped or, with replace_with_ref, kept with their alternatives counted as reference."""
    x, mine = gt, F.col("sample").isin(samples)
    wanted = F.lit(True)
    if types is not None:
        x, wanted = gt.join(sites.select("site", "kind"), "site"), F.coalesce(F.col("kind").isin(types), F.lit(False))
        x = x if replace_with_ref else x.where(wanted)
    a1, a2 = (F.when(wanted | (F.col(c) == 0), F.col(c)).when(F.col(c).isNotNull(), 0) for c in ("a1", "a2"))
    alt = (F.coalesce(a1, F.lit(0)) > 0) | (F.coalesce(a2, F.lit(0)) > 0)
    called = F.col("a1").isNotNull() | F.col("a2").isNotNull()
    seen = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.when(mine & alt, F.filter(F.array(a1, a2), lambda v: v > 0))))))
    out = x.groupBy("site").agg(F.count_if(alt & mine).alias("inside"), F.count_if(alt & ~mine).alias("outside"), F.count_if(called & mine).alias("n_called"), seen.alias("_alts"))
    keep = (F.col("inside") > 0) | (F.lit(keep_uncalled) & (F.col("n_called") == 0)) if exclude_ref else F.lit(True)
    out = out.where(keep & ((F.col("outside") == 0) if private else F.lit(True)))
    return out.withColumn("alts", F.array_join(F.col("_alts").cast("array<string>"), ",")).drop("_alts")


def recurrence(gt: DataFrame) -> DataFrame:
    """Samples with an alternative allele at each site."""
    return gt.where(F.col("a1") + F.col("a2") > 0).groupBy("site").agg(F.count_distinct("sample").alias("n_samples"))


def decode_genotypes(gt: DataFrame) -> DataFrame:
    """Genotypes as text: indexes with / or | between, ./. where missing."""
    return gt.withColumn("gt", F.when(F.col("a1").isNull() | F.col("a2").isNull(), "./.").otherwise(F.concat("a1", F.when(F.col("phased") == 1, "|").otherwise("/"), "a2")))


def split_genotype(gt: Column) -> dict[str, Column]:
    """A genotype's text as columns: allele indexes (null for a dot), whether it is phased, and whether an allele is missing."""
    alleles = F.transform(F.split(gt, "[/|]"), lambda x: x.try_cast("int"))
    return {"alleles": alleles, "phased": F.contains(gt, F.lit("|")), "missing": F.exists(alleles, lambda x: x.isNull())}


def genotype_bases(gt: Column, ref: Column, alts: Column) -> Column:
    """A genotype's text with the bases of its alleles for their indexes, a dot for missing ones; its separators stay."""
    every = F.concat(F.array(ref), alts)
    text = F.transform(F.split(gt, "[/|]"), lambda x: F.coalesce(F.try_element_at(every, x.try_cast("int") + 1), F.lit(".")))
    return F.when(F.contains(gt, F.lit("|")), F.array_join(text, "|")).otherwise(F.array_join(text, "/"))


def sample_subset(gt: DataFrame, samples: list[str], exclude: bool = False) -> DataFrame:
    """Genotypes of given samples, or of all others."""
    mine = F.col("sample").isin(samples)
    return gt.where(~mine if exclude else mine)


def wide_genotypes(gt: DataFrame, samples: list[str]) -> DataFrame:
    """K6: one row of each site with a column for each sample, NN where it has none. The samples are given, so the pivot needs no extra job."""
    text = F.when(F.col("a1").isNull() | F.col("a2").isNull(), "NN").otherwise(F.concat(F.col("a1").cast("string"), F.col("a2").cast("string")))
    return gt.withColumn("g", text).groupBy("site").pivot("sample", samples).agg(F.max("g")).fillna("NN")


def genotype_status(identity: DataFrame, expected: DataFrame, min_ratio: float) -> DataFrame:
    """The status of each sample given who it is expected to be (sample, expected; null or absent: nobody; so too if the expected one was not
    compared). confirmed if the best two tie and one of them is expected; else, where the best share is less than min_ratio times the second,
    unconfirmed, or unknown if nobody is expected; else candidate if nobody is expected, confirmed if the best is, and wrong."""
    known = identity.select("sample", F.col("candidate").alias("expected"))
    two = best_two(identity).join(expected.join(known, ["sample", "expected"], "left_semi").dropDuplicates(["sample"]), "sample", "left")
    ratio = F.when(F.col("second_share") != 0, F.col("best_share") / F.col("second_share")).otherwise(F.col("best_share") / 1e-6)
    tie = (F.col("best_share") == F.col("second_share")) & F.col("expected").isin(F.col("best"), F.col("second"))
    nobody, near = F.col("expected").isNull(), F.coalesce(ratio < min_ratio, F.lit(False))
    status = F.when(F.coalesce(tie, F.lit(False)), "confirmed").when(near & nobody, "unknown").when(near, "unconfirmed").when(nobody, "candidate").when(F.col("expected") == F.col("best"), "confirmed").otherwise("wrong")
    return two.select("sample", "expected", "best", "best_share", "second_share", status.alias("status"))


def matrix_rows(wide: DataFrame, key: list[str], samples: list[str]) -> DataFrame:
    """A 0/1 matrix with a column for each sample as a row of each site and sample that has it, with `recurrence`, the number of samples that do. The number is a sum over the row's own
    columns, so nothing is shuffled."""
    has = [F.coalesce(F.col(f"`{s}`"), F.lit(0)) > 0 for s in samples]
    n = sum((F.when(h, 1).otherwise(0) for h in has), F.lit(0))
    mine = F.array_compact(F.array(*(F.when(h, F.lit(s)) for s, h in zip(samples, has, strict=True))))
    return wide.select(*key, F.explode(mine).alias("sample"), n.alias("recurrence"))


def tab_variants(rows: DataFrame, samples: list[str]) -> DataFrame:
    """K6: tab rows of several samples (sample, chrom, pos, ref, snp) as one table: chrom, pos, ref, alts (sorted letters that aren't ref) and a column of each sample's genotype. snp is a
    letter, two letters with a slash, or a single letter for both (A is A/A); NN stands for a sample without a row. Of several rows of a sample at a position the first in order of snp counts."""
    pair = F.when(F.contains("snp", F.lit("/")), F.col("snp")).otherwise(F.concat_ws("/", "snp", "snp"))
    cell = lambda s: F.coalesce(F.min(F.when(F.col("sample") == s, F.col("_gt"))), F.lit("NN")).alias(s)
    letters = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.split("_gt", "/")))))
    made = rows.withColumn("_gt", F.upper(pair)).groupBy("chrom", "pos").agg(F.upper(F.min("ref")).alias("ref"), letters.alias("_all"), *(cell(s) for s in samples))
    return made.select("chrom", "pos", "ref", F.filter("_all", lambda a: (a != F.col("ref")) & (a != "N")).alias("alts"), *(F.col(f"`{s}`") for s in samples))
