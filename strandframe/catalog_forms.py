"""Queries of further forms of small operators, and of header declarations; catalog.py reads this module."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import _NOON, B, Views, _when, query
from .operators import calls, declarations, history, intervals, reads, records, reference, variants


@query("P2_region_list", "SELECT * FROM br_variants WHERE chrom = 'chr1' OR (chrom = 'chr2' AND pos BETWEEN 1000 AND 3000) OR (chrom = 'chr2' AND pos >= 2500) OR (chrom = 'chr4' AND pos <= 700)")
def _(v: Views) -> DataFrame:
    return variants.region_filters(v("br_variants"), [("chr1", None, None), ("chr2", 1000, 3000), ("chr2", 2500, None), ("chr4", None, 700)])


_RANGES = "EXISTS (SELECT 1 FROM br_intervals i WHERE i.chrom = v.chrom AND v.pos BETWEEN start_pos - 900 AND start_pos + 600)"


@query("P12_subset_ranges", f"SELECT * FROM br_variants v WHERE {_RANGES}")
def _(v: Views) -> DataFrame:
    ranges = v("br_intervals").selectExpr("chrom", "start_pos - 900 AS start_pos", "start_pos + 600 AS end_pos")
    return variants.subset_ranges(v("br_variants"), ranges).select(*v("br_variants").columns)


@query("P12_subset_ranges_complement", f"SELECT * FROM br_variants v WHERE NOT {_RANGES}")
def _(v: Views) -> DataFrame:
    ranges = v("br_intervals").selectExpr("chrom", "start_pos - 900 AS start_pos", "start_pos + 600 AS end_pos")
    return variants.subset_ranges(v("br_variants"), ranges, complement=True).select(*v("br_variants").columns)


@query("P22_unmapped_pairs", "SELECT read_id, flag FROM br_pairs WHERE flag & 4 <> 0 AND (flag & 1 = 0 OR flag & 8 <> 0)")
def _(v: Views) -> DataFrame:
    return reads.unmapped_reads(v("br_pairs"), skip_mate_mapped=True).select("read_id", "flag")


@query("W8_first_seen_in_interval", f"SELECT obj_id, min(changed) AS first_seen FROM br_history GROUP BY obj_id HAVING min(changed) >= {_NOON} - INTERVAL 212 HOUR AND min(changed) < {_NOON}")
def _(v: Views) -> DataFrame:
    return history.first_seen(v("br_history"), _when() - F.expr("INTERVAL 212 HOURS"), _when())


# Every fifth object is deleted: none of its rows is the latest.
_FLAGGED = "x AS (SELECT *, obj_id % 5 > 0 AND row_number() OVER (PARTITION BY obj_id ORDER BY changed DESC, row_id DESC) = 1 AS latest, row_number() OVER (PARTITION BY obj_id ORDER BY changed DESC, row_id DESC) AS n FROM br_history)"


@query("M2_forms", f"WITH {_FLAGGED} SELECT 'row' AS form, obj_id, row_id, state FROM x WHERE row_id = 7 UNION ALL SELECT 'recent', obj_id, row_id, state FROM x WHERE n = 1 UNION ALL SELECT 'current', obj_id, row_id, state FROM x WHERE latest")
def _(v: Views) -> DataFrame:
    flagged = history.with_latest(v("br_history")).withColumn("latest", F.col("latest") & (F.col("obj_id") % 5 > 0))
    forms = {"row": history.by_row_id(flagged, 7), "recent": history.most_recent(flagged), "current": history.current(flagged)}
    parts = [df.select(F.lit(name).alias("form"), "obj_id", "row_id", "state") for name, df in forms.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query("A48_matrix_rows", f"WITH g AS (SELECT site, sample, count(*) OVER (PARTITION BY site) AS n FROM br_genotypes WHERE a1 + a2 > 0) SELECT site, sample, {B('n')} AS recurrence FROM g")
def _(v: Views) -> DataFrame:
    samples = [f"S{i}" for i in range(12)]
    wide = v("br_genotypes").groupBy("site").agg(*(F.max(F.when(F.col("sample") == s, (F.coalesce(F.col("a1") + F.col("a2"), F.lit(0)) > 0).cast("int"))).alias(s) for s in samples))
    return calls.matrix_rows(wide, ["site"], samples)


@query(
    "K6_tab_variants",
    """WITH t AS (SELECT concat('S', src) AS sample, chrom, pos, 'A' AS ref, CASE WHEN allele = 0 THEN 'G/G' WHEN allele = 1 THEN 'A/T' ELSE concat(substr('ACGT', CAST(allele + 1 AS INTEGER), 1), '/', substr('ACGT', CAST(allele + 1 AS INTEGER), 1)) END AS gt, CASE WHEN allele = 0 THEN 'G' WHEN allele = 1 THEN 'A/T' ELSE substr('ACGT', CAST(allele + 1 AS INTEGER), 1) END AS snp FROM br_calls),
m AS (SELECT chrom, pos, min(ref) AS ref, min(gt) FILTER (sample = 'S0') AS s0, min(gt) FILTER (sample = 'S1') AS s1, min(gt) FILTER (sample = 'S2') AS s2, list_sort(list_distinct(flatten(list(string_split(gt, '/'))))) AS letters FROM t GROUP BY chrom, pos)
SELECT chrom, pos, ref, array_to_string(list_filter(letters, lambda a: a <> 'A'), ',') AS alts, coalesce(s0, 'NN') AS S0, coalesce(s1, 'NN') AS S1, coalesce(s2, 'NN') AS S2 FROM m""",
)
def _(v: Views) -> DataFrame:
    rows = v("br_calls").selectExpr("concat('S', src) AS sample", "chrom", "pos", "'a' AS ref", "CASE WHEN allele = 0 THEN 'g' WHEN allele = 1 THEN 'A/T' ELSE substr('ACGT', int(allele) + 1, 1) END AS snp")
    return calls.tab_variants(rows, ["S0", "S1", "S2"]).withColumn("alts", F.array_join("alts", ","))


# Cells of two samples a site with one or two alternatives; every few have a fault.
_CELLS = """c AS (SELECT site, sample, 1 + site % 2 AS n_alts, concat(CASE WHEN dp = 3 THEN '7' ELSE '0' END, CASE WHEN dp = 4 THEN ':' ELSE '/' END, site % 2) AS gt, CASE WHEN dp % 7 = 1 THEN 'x' ELSE CAST(dp AS VARCHAR) END AS dps,
 CASE WHEN dp % 5 = 0 THEN '1,2' WHEN site % 2 = 0 THEN '1,.,3' ELSE '1,2,3,4,5,6' END AS pl, CASE WHEN dp % 11 = 2 THEN '.' WHEN dp % 3 = 0 THEN '1.5' ELSE '1e-3,.5' END AS af, dp FROM br_genotypes WHERE sample IN ('S1', 'S2'))"""


@query(
    "X14_format_problems",
    f"""WITH {_CELLS}, p AS (SELECT site, sample, unnest(['GT', 'GT', 'DP', 'PL', 'AF', 'AF', 'ZZ']) AS tag, unnest([CASE WHEN dp = 4 THEN 'genotype_form' END, CASE WHEN dp = 3 THEN 'allele_range' END, CASE WHEN dp % 7 = 1 THEN 'type' END,
 CASE WHEN dp % 5 = 0 OR (dp % 5 > 0 AND dp = 4 AND false) THEN 'number' END, CASE WHEN false THEN 'type' END, CASE WHEN dp % 11 <> 2 AND (CASE WHEN dp % 3 = 0 THEN 1 ELSE 2 END) <> n_alts THEN 'number' END, CASE WHEN dp % 13 = 5 THEN 'undeclared' END]) AS problem FROM c)
SELECT site, sample, tag, problem FROM p WHERE problem IS NOT NULL""",
)
def _(v: Views) -> DataFrame:
    cells = v("br_genotypes").where("sample IN ('S1', 'S2')").selectExpr(
        "site", "sample", "int(1 + site % 2) AS n_alts",
        """map_filter(map('GT', concat(IF(dp = 3, '7', '0'), IF(dp = 4, ':', '/'), site % 2), 'DP', IF(dp % 7 = 1, 'x', string(dp)), 'PL', CASE WHEN dp % 5 = 0 THEN '1,2' WHEN site % 2 = 0 THEN '1,.,3' ELSE '1,2,3,4,5,6' END,
        'AF', CASE WHEN dp % 11 = 2 THEN '.' WHEN dp % 3 = 0 THEN '1.5' ELSE '1e-3,.5' END, 'ZZ', IF(dp % 13 = 5, '1', NULL)), (k, x) -> x IS NOT NULL) AS tags""",
    )
    rows = [("FORMAT", "GT", "1", "String"), ("FORMAT", "DP", "1", "Integer"), ("FORMAT", "PL", "G", "Integer"), ("FORMAT", "AF", "A", "Float"), ("INFO", "ZZ", "1", "Integer")]
    declared = cells.sparkSession.createDataFrame(rows, "kind string, id string, number string, type string")
    return declarations.format_problems(cells, declared).select("site", "sample", "tag", "problem")


_FIRST = "CASE WHEN var_id % 4 = 0 THEN [alt, 'T'] WHEN var_id % 9 = 1 THEN ['<DEL>'] ELSE [alt] END"
_KINDS = "length(ref) = 1 AND regexp_full_match(alts[1], '[ACGT]') AND ref <> alts[1]"


@query(
    "A17_first_alternative",
    f"""WITH x AS (SELECT ref, {_FIRST} AS alts, qual // 25 AS bin FROM br_variants), k AS (SELECT *, {_KINDS} AS snp, concat(ref, alts[1]) IN ('AG', 'GA', 'CT', 'TC') AS ts FROM x)
SELECT bin, {B('count(*)')} AS total, {B('count(*) FILTER (snp AND ts)')} AS ts, {B('count(*) FILTER (snp AND NOT ts)')} AS tv, {B('count(*) FILTER (NOT snp)')} AS skipped, {B('count(*) FILTER (len(alts) > 1)')} AS multiallelic, round(count(*) FILTER (snp AND ts) / CAST(nullif(count(*) FILTER (snp AND NOT ts), 0) AS DOUBLE), 6) AS ratio FROM k GROUP BY bin""",
)
def _(v: Views) -> DataFrame:
    rows = v("br_variants").selectExpr("ref", "CASE WHEN var_id % 4 = 0 THEN array(alt, 'T') WHEN var_id % 9 = 1 THEN array('<DEL>') ELSE array(alt) END AS alts", "qual div 25 AS bin")
    return variants.ts_tv_first(rows, "bin")


@query("I3_exclude_around_indels", "WITH p AS (SELECT DISTINCT chrom, pos FROM br_variants WHERE length(ref) <> length(alt)), g AS (SELECT chrom, coalesce(lag(pos) OVER (PARTITION BY chrom ORDER BY pos) + 20, 1) AS start_pos, pos - 20 AS end_pos FROM p) SELECT * FROM g WHERE end_pos > start_pos")
def _(v: Views) -> DataFrame:
    return intervals.exclude_around_indels(v("br_variants").where("length(ref) <> length(alt)"))


@query("W10_pileup", "SELECT chrom, pos, var_id, depth FROM (SELECT chrom, pos, var_id, dp % 4 AS depth, CASE WHEN var_id % 6 = 0 THEN '*' ELSE ref END AS r FROM br_variants) WHERE r <> '*' QUALIFY row_number() OVER (PARTITION BY chrom, pos ORDER BY depth DESC, var_id DESC) = 1")
def _(v: Views) -> DataFrame:
    rows = v("br_variants").selectExpr("chrom", "pos", "var_id", "dp % 4 AS depth", "CASE WHEN var_id % 6 = 0 THEN '*' ELSE ref END AS ref")
    return variants.dedupe_pileup(rows, "var_id", last=True).select("chrom", "pos", "var_id", "depth")


@query("W3_allele_score", "SELECT var_id, CASE WHEN dp % 3 = 0 THEN qual / 100.0 WHEN dp % 3 = 1 AND var_id % 2 = 0 THEN 0.5 WHEN dp % 3 = 1 THEN 7 ELSE 0 END::DOUBLE AS score FROM br_variants")
def _(v: Views) -> DataFrame:
    tags = "CASE WHEN dp % 3 = 0 THEN map('AF', concat(qual / 100D, ',0.9'), 'AC', '3') WHEN dp % 3 = 1 AND var_id % 2 = 0 THEN map('AF1', '0.5', 'AC', '9') WHEN dp % 3 = 1 THEN map('AC', '7,2') ELSE map('AF', '.') END"
    return v("br_variants").select("var_id", variants.allele_score(F.expr(tags)).alias("score"))


@query("P10_drop_format_tags", "SELECT site, sample, CASE WHEN dp % 2 = 0 THEN 'GT=x' ELSE concat('GQ=', dp, ';GT=x') END AS tags FROM br_genotypes")
def _(v: Views) -> DataFrame:
    cells = v("br_genotypes").selectExpr("site", "sample", "CASE WHEN dp % 2 = 0 THEN map('GT', 'x', 'DP', string(dp)) ELSE map('GT', 'x', 'PL', '1', 'GQ', string(dp)) END AS tags")
    return records.drop_format_tags(cells, ["DP", "PL", "GT"]).select("site", "sample", records.info_text(F.col("tags")).alias("tags"))


# One substitution on each long document, with two alternatives; sample S1's second haplotype is applied.
@query(
    "C4_haplotype",
    """WITH g AS (SELECT site, CASE WHEN site % 3 = 0 THEN a2 * 2 ELSE a2 END AS a FROM br_genotypes WHERE sample = 'S1'), s AS (SELECT name, CASE a WHEN 1 THEN 'GG' WHEN 2 THEN 'T' END AS alt FROM br_fastq JOIN g ON rec_no = site WHERE length(seq) > 40 AND a > 0)
SELECT b.name AS chrom, md5(CASE WHEN alt IS NULL THEN seq ELSE concat(substr(seq, 1, 19), alt, substr(seq, 22)) END) AS digest FROM br_fastq b LEFT JOIN s ON s.name = b.name""",
)
def _(v: Views) -> DataFrame:
    sites = v("br_fastq").where("length(seq) > 40").selectExpr("rec_no AS site", "name AS chrom", "20L AS pos", "substr(seq, 20, 2) AS ref", "array('GG', 'T') AS alts")
    gt = v("br_genotypes").withColumn("a2", F.expr("CASE WHEN site % 3 = 0 THEN a2 * 2 ELSE a2 END"))
    chunks = reference.chunked(v("br_fastq").select(F.col("name").alias("chrom"), "seq"), 500)
    made = reference.consensus_sequence(chunks, reference.haplotype_variants(sites, gt, "site", "S1", 2), 500, "site")
    return made.groupBy("chrom").agg(F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "seq"))), lambda x: x["seq"]), "")).alias("digest"))
