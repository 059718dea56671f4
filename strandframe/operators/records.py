"""Projections and tags of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.prefix import running
from .calls import combinations
from .sequences import reverse_complement
from .stats import rank_average
from .variants import Rule, dedupe_by_depth, indel_gap_filter, rule_filter, snp_gap_filter


def dot(c: Column) -> Column:
    """Null as a dot."""
    return F.coalesce(c.cast("string"), F.lit("."))


def genotype_text(a1: Column, a2: Column) -> Column:
    return F.concat_ws("/", dot(a1), dot(a2))


def query_fields(sites: DataFrame, gt: DataFrame, key: str, fields: list[Column], samples: list[str]) -> DataFrame:
    """One line of each site: the given columns, then the genotype of each named sample, joined by tabs, missing values as dots.
    Genotypes are pivoted by the list of samples, so no gathering of a site's rows is needed."""
    cell = genotype_text(F.col("a1"), F.col("a2"))
    cells = gt.where(F.col("sample").isin(samples)).groupBy(F.col("site").alias(key)).agg(*(F.max(F.when(F.col("sample") == s, cell)).alias(f"_{i}") for i, s in enumerate(samples)))
    return sites.join(cells, key, "left").select(key, F.concat_ws("\t", *(dot(c) for c in [*fields, *(F.col(f"_{i}") for i in range(len(samples)))])).alias("line"))


# Default thresholds of the annotation filters.
THRESHOLDS = {"Qual": 10, "MinDP": 2, "MaxDP": 10000000, "MinMQ": 10, "MinAB": 2, "StrandBias": 1e-4, "BaseQualBias": 0, "MapQualBias": 0, "EndDistBias": 1e-4, "VDB": 0}


def threshold_filters(df: DataFrame, limits: dict[str, float] | None = None) -> DataFrame:
    """Adds `filters`, the names of the fixed annotation filters that a row fails. Needs ref, qual and the typed annotations dp, mq, ab
    (alternative bases), vdb and pv4 (array of four p-values); those absent from the table are not tested, and null passes. Where dp is missing, dp4 (text of four depths) is summed. The HWE filters
    have no default: HWE (p) and HWE_G3 (hwe_g3), both only where the inbreeding coefficient icf is negative, apply if a limit is given."""
    if "dp4" in df.columns:  # the depth, where it isn't given, is the sum of the four strand depths
        parts = F.transform(F.split("dp4", ","), lambda x: x.try_cast("long"))
        depth = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + x)
        df = df.withColumn("dp", F.coalesce(F.col("dp"), depth) if "dp" in df.columns else depth)
    limit = THRESHOLDS | (limits or {})
    pv4 = ["StrandBias", "BaseQualBias", "MapQualBias", "EndDistBias"]
    least = {"Qual": "qual", "MinDP": "dp", "MinMQ": "mq", "MinAB": "ab", "VDB": "vdb"}
    rules = [Rule("RefN", "all", F.upper("ref") != "N")]
    rules += [Rule(tag, "all", F.col(c) >= limit[tag]) for tag, c in least.items() if c in df.columns]
    if "dp" in df.columns:
        rules.append(Rule("MaxDP", "all", F.col("dp") <= limit["MaxDP"]))
    if "pv4" in df.columns:
        rules += [Rule(tag, "all", F.get("pv4", F.lit(i)) >= limit[tag]) for i, tag in enumerate(pv4)]
    rules += [Rule(tag, "all", (F.col(c) >= limit[tag]) | (F.col("icf") >= 0)) for tag, c in {"HWE": "hwe", "HWE_G3": "hwe_g3"}.items() if tag in limit and c in df.columns]
    return rule_filter(df, rules)


def set_info(info: Column, values: dict[str, str | None]) -> Column:
    """A map with keys replaced or added; None removes a key, the empty text makes a flag."""
    names = list(values)
    kept = F.map_filter(info, lambda k, _: ~k.isin(names))
    new = {k: v for k, v in values.items() if v is not None}
    return F.map_concat(kept, F.create_map(*(F.lit(x) for kv in new.items() for x in kv))) if new else kept


def drop_tags(df: DataFrame, info: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """P10: INFO tags (of a map column `info`) removed, and whole columns such as id, filter or qual emptied."""
    out = df.withColumn("info", set_info(F.col("info"), dict.fromkeys(info))) if info else df
    return out.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in columns or []})


def drop_format_tags(cells: DataFrame, tags: list[str]) -> DataFrame:
    """P10: FORMAT tags (of the map column `tags`) removed from samples' cells; the genotype stays."""
    gone = [t for t in tags if t != "GT"]
    return cells.withColumn("tags", F.map_filter("tags", lambda k, _: ~k.isin(gone))) if gone else cells


def info_text(info: Column) -> Column:
    """A map as KEY=VALUE;FLAG, keys in order; a dot if it is empty."""
    parts = F.transform(F.array_sort(F.map_keys(info)), lambda k: F.when(info[k] == "", k).otherwise(F.concat(k, F.lit("="), info[k])))
    return F.when(F.size(parts) > 0, F.array_join(parts, ";")).otherwise(".")


def reorder_columns(df: DataFrame, template: list[tuple[str, str]]) -> DataFrame:
    """The columns (name, type) of a template in its order, null where the table lacks one; others go."""
    return df.select(*((F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in template))


def rename_from_map(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """Values of a column replaced through names (old, new), one new name for each old one; values that aren't listed stay."""
    return df.join(names.select(F.col("old").alias(column), F.col("new").alias("_new")), column, "left").withColumn(column, F.coalesce("_new", column)).drop("_new").select(*df.columns)


def strip_tags(df: DataFrame, tags: list[str]) -> DataFrame:
    """Reads without the given optional tags."""
    return df.withColumn("tags", set_info(F.col("tags"), dict.fromkeys(tags)))


def replace_readgroup(df: DataFrame, name: str) -> DataFrame:
    """Reads with one read group."""
    return df.withColumn("tags", set_info(F.col("tags"), {"RG": name}))


def reads_to_fastq(reads: DataFrame) -> DataFrame:
    """Primary reads on the strand that was sequenced: name, mate (1, 2 or 0 for unpaired ones), seq, qual. Split by mate with write_split."""
    flag = lambda bit: F.col("flag").bitwiseAND(F.lit(bit)) != 0
    turned = lambda c, back: F.when(flag(16), back).otherwise(F.col(c)).alias(c)
    mate = F.when(flag(64), 1).when(flag(128), 2).otherwise(0)
    return reads.where(~flag(256)).select(F.col("qname").alias("name"), mate.alias("mate"), turned("seq", reverse_complement(F.col("seq"))), turned("qual", F.reverse("qual")))


def fastq_to_fasta(fastq: DataFrame) -> DataFrame:
    """Two lines of each record as one text."""
    return fastq.select(F.concat(F.lit(">"), "name", F.lit("\n"), "seq").alias("value"))


def split_paired(fastq: DataFrame, first: int) -> DataFrame:
    """Each record as two mates, cut after `first` bases."""
    cut = lambda c, a, b: F.substring(F.col(c), a, b).alias(c)
    rest = F.lit(1 << 30)
    return fastq.select("name", F.lit(1).alias("mate"), cut("seq", F.lit(1), F.lit(first)), cut("qual", F.lit(1), F.lit(first))).union(
        fastq.select("name", F.lit(2).alias("mate"), cut("seq", F.lit(first + 1), rest), cut("qual", F.lit(first + 1), rest))
    )


def concatenate_mates(first: DataFrame, second: DataFrame) -> DataFrame:
    """P25: the n-th records of two files as one: sequences joined by NN, qualities by !!. A record without a partner is an error of the files and goes."""
    b = second.select("rec_no", F.col("seq").alias("seq2"), F.col("qual").alias("qual2"))
    return first.join(b, "rec_no").select("rec_no", "name", F.concat("seq", F.lit("NN"), "seq2").alias("seq"), F.concat("qual", F.lit("!!"), "qual2").alias("qual"))


def variant_filter_chain(df: DataFrame, min_qual: int, min_dp: int, max_dp: int, gap: int, window: int, alt_depth: str) -> DataFrame:
    """Adds `letter`, the first rule that a row fails: Q quality, d or D depth too low or high, G near an indel, g an indel that loses
    to its neighbour, p another row at its position is deeper; null if it passes. Scores of indels are 100 * quality + alternative depth. Rows that fail a
    threshold don't take part in the later rules."""
    letter = F.when(F.col("qual") < min_qual, "Q").when(F.col("dp") < min_dp, "d").when(F.col("dp") > max_dp, "D")
    static = df.withColumn("letter", letter)
    good = static.where("letter IS NULL").drop("letter")
    snps = snp_gap_filter(good, gap).where("near_indel").select("var_id", F.lit("G").alias("_later"))
    scored = good.withColumn("_score", 100 * F.col("qual") + F.col(alt_depth))
    indels = indel_gap_filter(scored, window, "_score").where("loses").select("var_id", F.lit("g").alias("_later"))
    gone = snps.unionByName(indels)
    left = good.join(gone, "var_id", "left_anti")
    best = dedupe_by_depth(left.select("chrom", "pos", "var_id", "dp"), "dp", "var_id").select("var_id")
    twice = left.join(best, "var_id", "left_anti").select("var_id", F.lit("p").alias("_later"))
    return static.join(gone.unionByName(twice), "var_id", "left").withColumn("letter", F.coalesce("letter", "_later")).drop("_later")


def forward_in_region(df: DataFrame, regions: DataFrame, order: str) -> DataFrame:
    """Adds region_id, the region that holds a position, or null; regions (region_id, chrom, start_pos, end_pos) of a chromosome don't
    overlap. An as-of step over both tables in blocks: the last region that began is carried on."""
    marks = regions.select("chrom", F.col("start_pos").alias("pos"), F.struct("start_pos", "end_pos", "region_id").alias("_region"), F.lit(None).cast("struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in df.schema) + ">").alias("_row"), F.lit(0).alias("_kind"), F.lit(None).cast("string").alias("_tie"))
    rows = df.select("chrom", "pos", F.lit(None).cast(marks.schema["_region"].dataType).alias("_region"), F.struct(*df.columns).alias("_row"), F.lit(1).alias("_kind"), F.col(order).cast("string").alias("_tie"))
    seen = running(marks.unionByName(rows), ["chrom"], "pos", ["pos", "_kind", "_tie"], F.col("_region"), "_last", "max")
    return seen.where("_kind = 1").select("_row.*", F.when(F.col("_last.end_pos") >= F.col("pos"), F.col("_last.region_id")).alias("region_id"))


def consequence_join(variants: DataFrame, consequences: DataFrame, matrix: DataFrame, scores: DataFrame, key: list[str]) -> DataFrame:
    """Consequences (key, gene, consequence, aa_from, aa_to) of each variant as one text joined by '+', in order and without repeats, the largest substitution score
    by a matrix (aa_from, aa_to, score: 20 by 20 at most, so it is broadcast) and the score of its position (chrom, start_pos, end_pos, value)."""
    scored = consequences.join(F.broadcast(matrix), ["aa_from", "aa_to"], "left")
    grouped = scored.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set(F.concat_ws(":", "gene", "consequence"))), "+").alias("consequences"), F.max("score").alias("substitution"))
    held = forward_in_region(variants, scores.withColumnRenamed("value", "region_id"), "var_id").withColumnRenamed("region_id", "position_score")
    return held.join(grouped, key, "left")


def locus_query(variants: DataFrame, gt: DataFrame, chrom: str, start: int, end: int, samples: list[str], types: list[str], min_dp: int) -> DataFrame:
    """Variants of a region whose csq text ('gene|type' joined by commas) has one of the types: one row of each variant, gene and type, with each
    strain's alleles and whether its depth suffices; rows in which no strain differs from the reference go."""
    here = variants.where((F.col("chrom") == chrom) & F.col("pos").between(start, end))
    hits = here.withColumn("_c", F.explode(F.split("csq", ","))).select("var_id", "pos", "ref", "alt", F.substring_index("_c", "|", 1).alias("gene"), F.substring_index("_c", "|", -1).alias("type")).where(F.col("type").isin(types))
    cell = F.concat(genotype_text(F.col("a1"), F.col("a2")), F.when(F.col("dp") >= min_dp, "+").otherwise("-"))
    cells = gt.where(F.col("sample").isin(samples)).groupBy(F.col("site").alias("var_id")).agg(*(F.max(F.when(F.col("sample") == s, cell)).alias(s) for s in samples), F.max(F.greatest("a1", "a2")).alias("_most"))
    return hits.join(cells.where("_most > 0").drop("_most"), "var_id")


def largest_first(segments: DataFrame) -> DataFrame:
    """Segments with their length, longest first, ties by place."""
    return segments.withColumn("length", F.col("end_pos") - F.col("start_pos") + 1).orderBy(F.desc("length"), "chrom", "start_pos", "end_pos")


def venn_partition(calls: DataFrame, win: int = 0) -> DataFrame:
    """One row of each site with the combination of sets that have it, for writing a folder of each combination (write_split)."""
    return combinations(calls, win).select("combination", "chrom", "pos", "n_calls")


def concat_sets(parts: list[DataFrame], depth: str, order: str) -> DataFrame:
    """Tables one after another, absent columns null; of rows at one position, as overlapping chunks have them, the deepest stays."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return dedupe_by_depth(out, depth, order)


def pileup_bases(bases: Column) -> Column:
    """The read bases of a pileup column without marks of read starts and ends and without the text of insertions and deletions."""
    plain = F.translate(F.regexp_replace(bases, "\\^.", ""), "$", "")
    parts = F.split(plain, "[+-](?=[0-9])")
    size = lambda p: F.regexp_extract(p, "^([0-9]+)", 1)
    rest = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: F.substring(p, F.length(size(p)) + size(p).cast("int") + 1, F.length(p)))
    return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))


def pileup_strand_depth(pileup: DataFrame) -> DataFrame:
    """Bases on the forward (upper case and '.') and reverse strand (lower case and ',') at each position."""
    b = pileup_bases(F.col("bases"))
    return pileup.select("chrom", "pos", F.regexp_count(b, F.lit("[.ACGTN]")).alias("forward"), F.regexp_count(b, F.lit("[,acgtn]")).alias("reverse"))


def annotation_quantiles(df: DataFrame, columns: list[str], low: float, high: float, accuracy: int = 10000) -> DataFrame:
    """Approximate quantiles of each column in one pass, a row of each column."""
    made = df.agg(*(F.percentile_approx(c, [low, high], accuracy).alias(c) for c in columns))
    rows = F.array(*(F.struct(F.lit(c).alias("annotation"), F.get(c, F.lit(0)).cast("double").alias("low"), F.get(c, F.lit(1)).cast("double").alias("high")) for c in columns))
    return made.select(F.explode(rows).alias("r")).select("r.*")


def balanced_sample(df: DataFrame, label: str, share: Column, bins: int, most: int, key: str, seed: str = "0") -> DataFrame:
    """At most `most` rows, chosen by a hash of their key, of each class and bin of allele frequency. Spark keeps the first `most` rows
    in each task before the shuffle, so a hot class doesn't gather in one task."""
    binned = df.withColumn("bin", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("long"))
    by = Window.partitionBy(label, "bin").orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key)
    return binned.withColumn("_place", F.row_number().over(by)).where(F.col("_place") <= most).drop("_place")


def sample_counts(df: DataFrame, sample: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of each class and bin before and after."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_before")).join(sample.groupBy(*keys).agg(F.count("*").alias("n_after")), keys, "left").fillna(0, ["n_after"])


def feature_usefulness(runs: DataFrame, features: list[str], level: float = 1.96) -> DataFrame:
    """For each annotation, whether runs (accuracy, annotations array) that used it are better: the Mann-Whitney statistic in normal form, and yes, no or
    unsure at p = 0.05. Ranks come from counts of equal accuracies."""
    long = runs.withColumn("annotation", F.explode(F.array(*map(F.lit, features)))).select("annotation", "accuracy", F.array_contains("annotations", F.col("annotation")).alias("used"))
    ranked = rank_average(long, "accuracy", ["annotation"])
    s = ranked.groupBy("annotation").agg(F.count_if("used").alias("n_with"), F.count_if(~F.col("used")).alias("n_without"), F.sum(F.when(F.col("used"), F.col("rank_avg")).otherwise(0)).alias("ranks"))
    n1, n2 = F.col("n_with"), F.col("n_without")
    z = F.try_divide(F.col("ranks") - n1 * (n1 + 1) / 2 - n1 * n2 / 2, F.sqrt(n1 * n2 * (n1 + n2 + 1) / 12))
    return s.select("annotation", "n_with", "n_without", z.alias("z")).withColumn("useful", F.when(F.col("z") > level, "yes").when(F.col("z") < -level, "no").otherwise("unsure"))
