"""Queries of alignments, genotype comparisons and ranks, over the bridge views (see catalog)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import _EVENTS, _INDEL, _INSERT, B, Views, _median, query
from .operators import calls, intervals, reads, stats, variants

_AVG = "CAST(sum({}) FILTER (flag & 4 = 0) AS DOUBLE) / sum(seq_len) FILTER (flag & 4 = 0)".format


@query(
    "A1_readgroup_stats",
    f"""WITH hist AS ({_INSERT}), med AS ({_median("hist", "m")}),
dev AS (SELECT h.rg, abs(bin - m) AS bin, sum(freq) AS freq FROM hist h JOIN med USING (rg) GROUP BY h.rg, abs(bin - m)), mad AS ({_median("dev", "d")}),
ins AS (SELECT rg, sum(bin * freq) / sum(freq) AS mean, sqrt(sum(bin * bin * freq) / sum(freq) - (sum(bin * freq) / sum(freq)) * (sum(bin * freq) / sum(freq))) AS sd FROM hist GROUP BY rg),
base AS (SELECT rg, count(*) AS total_reads, sum(seq_len) AS total_bases, count(*) FILTER (flag & 4 = 0) AS mapped_reads, sum(seq_len) FILTER (flag & 4 = 0) AS mapped_bases,
  count(*) FILTER (flag & 4 = 0 AND flag & 1 <> 0) AS paired_reads, count(*) FILTER (flag & 4 = 0 AND flag & 2 <> 0) AS proper_reads, count(*) FILTER (flag & 1024 <> 0) AS dup_reads,
  100 * {_AVG("nm")} AS pct, {_AVG("qual_sum")} AS q FROM br_pairs GROUP BY rg)
SELECT rg, {B("total_reads")} AS total_reads, {B("total_bases")} AS total_bases, {B("mapped_reads")} AS mapped_reads, {B("mapped_bases")} AS mapped_bases, {B("paired_reads")} AS paired_reads,
  {B("proper_reads")} AS proper_reads, {B("dup_reads")} AS dup_reads, round(pct, 6) AS pct_mismatch, round(q, 6) AS avg_quality, round(mean, 6) AS mean_isize, round(sd, 6) AS isize_sd, {B("m")} AS median_isize, {B("d")} AS isize_mad
FROM base LEFT JOIN ins USING (rg) LEFT JOIN med USING (rg) LEFT JOIN mad USING (rg)""",
)
def _(v: Views) -> DataFrame:
    return reads.readgroup_stats(v("br_pairs"))


def _pairs(cap: int, where: str) -> str:
    return f"""p AS (SELECT least(abs(isize), {cap - 1}) AS bin, CASE WHEN (flag & 16 <> 0) = (flag & 32 <> 0) THEN 'other' WHEN (mate_pos - pos) * (CASE WHEN flag & 16 <> 0 THEN -1 ELSE 1 END) > 0 THEN 'inward'
  WHEN mate_pos <> pos THEN 'outward' END AS side FROM br_pairs WHERE flag & 5 = 1 AND (isize <> 0 OR chrom = mate_chrom) AND {where}),
h AS (SELECT bin, count(*) FILTER (side = 'inward') // 2 AS inward, count(*) FILTER (side = 'outward') // 2 AS outward, count(*) FILTER (side = 'other') // 2 AS other FROM p GROUP BY bin),
x AS (SELECT *, inward + outward + other AS pairs, sum(inward + outward + other) OVER (ORDER BY bin) - (inward + outward + other) AS before, sum(inward + outward + other) OVER () AS total FROM h),
m AS (SELECT sum(bin * pairs) / CAST(sum(pairs) AS DOUBLE) AS mean, sum(pairs) AS n FROM x WHERE CAST(before AS DOUBLE) / total <= 0.99),
sd AS (SELECT sqrt(sum(pairs * (bin - mean) * (bin - mean) / n)) AS sd FROM x CROSS JOIN m WHERE CAST(before AS DOUBLE) / total <= 0.99 AND bin > 0)"""


@query(
    "A3_insert_size_histogram",
    f"""WITH {_pairs(400, "true")} SELECT bin, {B("inward")} AS inward, {B("outward")} AS outward, {B("other")} AS other, {B("pairs")} AS pairs, round(mean, 6) AS mean_isize, round(sd, 6) AS isize_sd FROM x CROSS JOIN m CROSS JOIN sd""",
)
def _(v: Views) -> DataFrame:
    return reads.insert_size_histogram(v("br_pairs"), 400)


_SUMMARY = {
    "sequences": "count(*)", "first_fragments": "count(*) FILTER (flag & 128 = 0)", "last_fragments": "count(*) FILTER (flag & 128 <> 0)", "reads_mapped": "count(*) FILTER (flag & 4 = 0)", "reads_unmapped": "count(*) FILTER (flag & 4 <> 0)",
    "reads_unpaired": "count(*) FILTER (flag & 5 = 0)", "reads_paired": "count(*) FILTER (flag & 5 = 1)", "reads_duplicated": "count(*) FILTER (flag & 1024 <> 0)", "reads_mq0": "count(*) FILTER (flag & 4 = 0 AND mapq = 0)",
    "reads_qc_failed": "count(*) FILTER (flag & 512 <> 0)", "non_primary": "count(*) FILTER (flag & 256 <> 0)", "total_length": "sum(seq_len)", "bases_mapped": "sum(seq_len) FILTER (flag & 4 = 0)",
    "bases_mapped_cigar": "sum(cigar_mapped) FILTER (flag & 4 = 0)", "bases_trimmed": "sum(trimmed)", "bases_duplicated": "sum(seq_len) FILTER (flag & 1024 <> 0)", "mismatches": "sum(nm) FILTER (flag & 4 = 0)", "maximum_length": "max(seq_len)",
    "different_chromosomes": "count(*) FILTER (flag & 5 = 1 AND chrom <> mate_chrom) // 2",
}


@query(
    "A2_alignment_summary",
    f"""WITH {_pairs(8000, "flag & 256 = 0")}, s AS (SELECT {", ".join(f"{B(f'coalesce({sql}, 0)')} AS {name}" for name, sql in _SUMMARY.items())}, {B("sum(qual_sum)")} AS q FROM br_pairs WHERE flag & 256 = 0),
o AS (SELECT {B("sum(inward)")} AS pairs_inward, {B("sum(outward)")} AS pairs_outward, {B("sum(other)")} AS pairs_other FROM h), r AS (SELECT {B("count(*)")} AS raw_total, {B("count(*) FILTER (flag & 256 <> 0)")} AS filtered FROM br_pairs)
SELECT * EXCLUDE (q, mean, n, sd), round(mean, 6) AS mean_isize, round(sd, 6) AS isize_sd, first_fragments > 0 AND last_fragments > 0 AS is_paired, round(mismatches / CAST(bases_mapped_cigar AS DOUBLE), 6) AS error_rate,
 round(total_length / CAST(sequences AS DOUBLE), 6) AS average_length, round(q / CAST(total_length AS DOUBLE), 6) AS average_quality FROM s CROSS JOIN o CROSS JOIN r CROSS JOIN m CROSS JOIN sd""",
)
def _(v: Views) -> DataFrame:
    return reads.alignment_summary(v("br_pairs"), exclude=256)


@query(
    "A51_flagstat",
    f"""SELECT {B("count(*)")} AS total, {B("count(*) FILTER (flag & 512 <> 0)")} AS qc_failed, {B("count(*) FILTER (flag & 1024 <> 0)")} AS duplicates, {B("count(*) FILTER (flag & 4 = 0)")} AS mapped,
 {B("count(*) FILTER (flag & 1 <> 0)")} AS paired, {B("count(*) FILTER (flag & 64 <> 0)")} AS read1, {B("count(*) FILTER (flag & 128 <> 0)")} AS read2, {B("count(*) FILTER (flag & 6 = 2)")} AS properly_paired,
 {B("count(*) FILTER (flag & 13 = 1)")} AS both_mapped, {B("count(*) FILTER (flag & 13 = 9)")} AS singletons, {B("count(*) FILTER (flag & 13 = 1 AND chrom <> mate_chrom)")} AS mate_other_chrom,
 {B("count(*) FILTER (flag & 13 = 1 AND chrom <> mate_chrom AND mapq >= 5)")} AS mate_other_chrom_mq5 FROM br_pairs""",
)
def _(v: Views) -> DataFrame:
    return reads.flagstat(v("br_pairs"))


@query(
    "A52_chromosome_distribution",
    f"""WITH l AS (SELECT chrom, max(pos) AS length FROM br_reads GROUP BY chrom), c AS (SELECT rg, chrom, count(*) AS n FROM br_reads WHERE flag & 4 = 0 GROUP BY GROUPING SETS ((rg, chrom), (chrom)))
SELECT rg, chrom, {B("n")} AS n, round(n / CAST(length AS DOUBLE), 6) AS per_base FROM c JOIN l USING (chrom)""",
)
def _(v: Views) -> DataFrame:
    return reads.chromosome_distribution(v("br_reads"), v("br_reads").groupBy("chrom").agg(F.max("pos").alias("length")))


@query(
    "A46_library_insert_config",
    f"""WITH hist AS ({_INSERT}), s AS (SELECT rg, sum(bin * freq) / sum(freq) AS mean, sqrt(sum(bin * bin * freq) / sum(freq) - (sum(bin * freq) / sum(freq)) * (sum(bin * freq) / sum(freq))) AS sd FROM hist GROUP BY rg),
cut AS (SELECT hist.* FROM hist JOIN s USING (rg) WHERE bin <= mean + 10 * sd), m AS (SELECT rg, sum(bin * freq) / sum(freq) AS mean, sum(freq) AS pairs FROM cut GROUP BY rg),
o AS (SELECT rg, mean, pairs, sqrt(sum((bin - mean) * (bin - mean) * freq) FILTER (bin > mean) / sum(freq) FILTER (bin > mean)) AS up, sqrt(sum((bin - mean) * (bin - mean) * freq) FILTER (bin <= mean) / sum(freq) FILTER (bin <= mean)) AS low,
  sqrt(sum((bin - mean) * (bin - mean) * freq) / sum(freq)) / mean AS cv FROM cut JOIN m USING (rg) GROUP BY rg, mean, pairs)
SELECT rg, round(mean, 6) AS mean_isize, {B("pairs")} AS pairs, round(up, 6) AS upper_sd, round(low, 6) AS lower_sd, round(cv, 6) AS cv FROM o WHERE pairs >= 100 AND cv <= 0.6""",
)
def _(v: Views) -> DataFrame:
    return reads.library_insert_config(v("br_reads"), 100, 0.6)


@query("P23_fix_flags", "SELECT * REPLACE (CASE WHEN flag & 130 = 130 THEN xor(flag & ~1024, 16) ELSE flag & ~1024 END AS flag) FROM br_reads")
def _(v: Views) -> DataFrame:
    return reads.fix_flags(v("br_reads"))


@query("P23_fix_flags_standard", "SELECT * REPLACE (flag & ~1024 AS flag) FROM br_reads")
def _(v: Views) -> DataFrame:
    return reads.fix_flags(v("br_reads"), "standard")


@query(
    "A27_gene_expression",
    f"""WITH m AS (SELECT *, CASE WHEN (CASE WHEN flag & 130 = 130 THEN xor(flag, 16) ELSE flag END) & 16 <> 0 THEN -1 ELSE 1 END AS rs FROM br_reads WHERE flag & 4 = 0), n AS (SELECT count(*) AS n FROM m),
ex AS (SELECT iv_id, chrom, start_pos AS s, start_pos + 400 AS e FROM br_intervals UNION ALL SELECT iv_id, chrom, end_pos - 600, end_pos FROM br_intervals), l AS (SELECT iv_id, sum(e - s + 1) AS len FROM ex GROUP BY iv_id),
h AS (SELECT i.iv_id, count(*) FILTER (rs = strand) AS s, count(*) FILTER (rs <> strand) AS a FROM br_intervals i JOIN m ON i.chrom = m.chrom
  WHERE mapq > 10 AND flag & 2 <> 0 AND EXISTS (SELECT 1 FROM ex WHERE ex.iv_id = i.iv_id AND m.pos <= ex.e AND m.pos + m.seq_len - 1 >= ex.s) GROUP BY i.iv_id)
SELECT i.iv_id, {B("len")} AS exon_length, {B("coalesce(s, 0)")} AS sense, {B("coalesce(a, 0)")} AS antisense, round(coalesce(s, 0) / CAST(len AS DOUBLE) * 1e9 / n, 6) AS rpkm_sense,
 round(coalesce(a, 0) / CAST(len AS DOUBLE) * 1e9 / n, 6) AS rpkm_antisense FROM br_intervals i JOIN l USING (iv_id) LEFT JOIN h USING (iv_id) CROSS JOIN n""",
)
def _(v: Views) -> DataFrame:
    iv = v("br_intervals")
    ends = F.array(F.struct(F.col("start_pos").alias("s"), (F.col("start_pos") + 400).alias("e")), F.struct((F.col("end_pos") - 600).alias("s"), F.col("end_pos").alias("e")))
    exons = iv.select("iv_id", "chrom", F.explode(ends).alias("x")).select("iv_id", "chrom", F.col("x.s").alias("start_pos"), F.col("x.e").alias("end_pos"))
    return reads.gene_expression(v("br_reads"), iv, exons, 10, reads.PROPER, "strand_specific")


_SITES = "s AS (SELECT chrom, CASE WHEN flag & 16 <> 0 THEN pos + seq_len - 1 ELSE pos END AS pos, CASE WHEN flag & 16 <> 0 THEN -1 ELSE 1 END AS strand, count(*) AS n FROM br_reads WHERE flag & 4 = 0 GROUP BY 1, 2, 3)"


@query("A28_insert_sites", f"WITH {_SITES} SELECT chrom, pos, {B('strand')} AS strand, {B('n')} AS n FROM s")
def _(v: Views) -> DataFrame:
    return reads.insert_sites(v("br_reads"))


@query(
    "A28_feature_inserts",
    f"WITH {_SITES}, c AS (SELECT i.*, count(s.pos) AS k, coalesce(sum(n), 0) AS r FROM br_intervals i LEFT JOIN s ON i.chrom = s.chrom AND s.pos BETWEEN start_pos AND end_pos GROUP BY ALL) SELECT iv_id, "
    + ", ".join(f"{B(f'CASE WHEN strand = {k} THEN k ELSE 0 END')} AS {n}_sites, {B(f'CASE WHEN strand = {k} THEN r ELSE 0 END')} AS {n}_reads, round(CASE WHEN strand = {k} THEN k ELSE 0 END / CAST(end_pos - start_pos + 1 AS DOUBLE), 6) AS {n}_by_length" for n, k in (("pos", 1), ("neg", -1), ("zero", 0)))
    + " FROM c",
)
def _(v: Views) -> DataFrame:
    return reads.feature_inserts(reads.insert_sites(v("br_reads")), v("br_intervals"))


def _merged(name: str, source: str) -> str:
    return f"""{name}0 AS (SELECT DISTINCT chrom, s, e FROM ({source})), {name}1 AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM {name}0),
{name}2 AS (SELECT *, sum(CASE WHEN r IS NULL OR r < s - 1 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e) AS g FROM {name}1), {name} AS (SELECT chrom, min(s) AS s, max(e) AS e FROM {name}2 GROUP BY chrom, g)"""


def _capture(kind: str, raw: str, efficiency: str) -> str:
    """One kind's part of A14, in a query of its own."""
    events = _EVENTS.replace("flag & 4 = 0", "flag & 1028 = 0")
    shares = ", ".join(f"round(coalesce((SELECT sum(size) FILTER (depth >= {t}) FROM dp), 0) / CAST(bases AS DOUBLE), 6) AS share_{t}x" for t in reads.DEPTHS)
    touched = "(SELECT count(*) FROM k WHERE EXISTS (SELECT 1 FROM {} r WHERE r.chrom = k.chrom AND r.s <= k.pos + k.seq_len - 1 AND r.e >= k.pos))".format
    within = "SELECT r.chrom, r.s, r.e, depth, least(r.e, seg.end_pos) - greatest(r.s, seg.start_pos) + 1 AS size FROM {} r JOIN seg ON r.chrom = seg.chrom AND r.s <= seg.end_pos AND r.e >= seg.start_pos".format
    return f"""(WITH {events}, k AS (SELECT * FROM br_reads WHERE flag & 1028 = 0), {_merged("o", f"SELECT chrom, start_pos AS s, end_pos AS e FROM ({raw})")}, {_merged("w", f"SELECT chrom, greatest(0, start_pos - 100) AS s, end_pos + 100 AS e FROM ({raw})")},
dp AS ({within("o")}), wide AS ({within("w")}), z AS (SELECT sum(e - s + 1) AS bases, count(*) AS n FROM o), y AS (SELECT coalesce(sum(size * depth), 0) AS ob, coalesce(sum(size * depth * depth), 0) AS sq FROM dp),
low AS (SELECT count(*) AS n FROM o LEFT JOIN (SELECT chrom, s, sum(size * depth) AS b FROM dp GROUP BY 1, 2) q USING (chrom, s) WHERE coalesce(b, 0) / CAST(e - s + 1 AS DOUBLE) < 2), wb AS (SELECT coalesce(sum(size * depth), 0) AS wb FROM wide)
SELECT '{kind}' AS kind, {B("bases")} AS bases, {B("z.n")} AS n_regions, {B("ob")} AS on_bases, {B("wb - ob")} AS near_bases, {B("(SELECT sum(seq_len) FROM k) - wb")} AS off_bases, {B(touched("o"))} AS reads_on, {B(touched("w") + " - " + touched("o"))} AS reads_near,
 round(ob / CAST(bases AS DOUBLE), 6) AS mean_coverage, round(sqrt(sq / CAST(bases AS DOUBLE) - (ob / CAST(bases AS DOUBLE)) * (ob / CAST(bases AS DOUBLE))), 6) AS sd_coverage, {shares}, {B("low.n")} AS low_regions, {efficiency} AS design_efficiency
FROM z CROSS JOIN y CROSS JOIN low CROSS JOIN wb)"""


_T = "SELECT * FROM br_intervals WHERE iv_id % 3 <> 0"
_SUM = "(WITH {} SELECT sum(e - s + 1) FROM t)".format


@query(
    "A14_capture_stats",
    f"SELECT * FROM {_capture('bait', 'SELECT * FROM br_intervals', 'round(' + _SUM(_merged('t', f'SELECT chrom, start_pos AS s, end_pos AS e FROM ({_T})')) + ' / CAST(bases AS DOUBLE), 6)')} UNION ALL SELECT * FROM {_capture('target', _T, 'NULL')}",
)
def _(v: Views) -> DataFrame:
    return reads.capture_stats(v("br_reads"), v("br_intervals"), v("br_intervals").where("iv_id % 3 <> 0"))


@query(
    "A14_target_coverage",
    f"""WITH {_EVENTS}, {_merged("m", "SELECT chrom, start_pos AS s, end_pos AS e FROM br_intervals")}
SELECT m.chrom, m.s AS start_pos, m.e AS end_pos, {B("coalesce(sum(least(m.e, g.end_pos) - greatest(m.s, g.start_pos) + 1), 0)")} AS covered,
 round(coalesce(sum((least(m.e, g.end_pos) - greatest(m.s, g.start_pos) + 1) * depth), 0) / CAST(m.e - m.s + 1 AS DOUBLE), 6) AS mean_coverage
FROM m LEFT JOIN seg g ON m.chrom = g.chrom AND m.s <= g.end_pos AND m.e >= g.start_pos GROUP BY m.chrom, m.s, m.e""",
)
def _(v: Views) -> DataFrame:
    return reads.target_coverage(reads.depth_segments(v("br_reads")), intervals.merge_intervals(v("br_intervals")))


@query(
    "J2_repeated_reads",
    "WITH r AS (SELECT qname, chrom, pos, seq_len FROM br_reads UNION ALL SELECT qname, chrom, pos, seq_len FROM br_reads WHERE nm = 0) SELECT r.* FROM r WHERE EXISTS (SELECT 1 FROM br_intervals i WHERE i.chrom = r.chrom AND r.pos <= i.end_pos AND r.pos + r.seq_len - 1 >= i.start_pos)",
)
def _(v: Views) -> DataFrame:
    some = v("br_reads").select("qname", "chrom", "pos", "seq_len", "nm")
    return intervals.reads_in_intervals(some.union(some.where("nm = 0")).drop("nm"), v("br_intervals"))


_MATES = """f AS (SELECT concat('q', rec_no // 2) AS qname, rec_no % 2 + 1 AS mate, length(seq) AS n FROM br_fastq),
u AS (SELECT f.qname, 4 + 1 + CASE WHEN mate = 1 THEN 64 ELSE 128 END AS flag, n FROM f WHERE NOT EXISTS (SELECT 1 FROM br_reads r WHERE r.qname = f.qname AND (CASE WHEN r.flag & 192 = 128 THEN 2 ELSE 1 END) = f.mate))"""


def _mates(v: Views) -> DataFrame:
    return v("br_fastq").select(F.concat(F.lit("q"), F.floor(F.col("rec_no") / 2), F.lit("/"), F.col("rec_no") % 2 + 1).alias("name"), "seq")


@query("J15_unaligned", f"WITH {_MATES} SELECT qname, {B('flag')} AS flag, {B('n')} AS seq_len FROM u")
def _(v: Views) -> DataFrame:
    return reads.unaligned(_mates(v), v("br_reads"))


@query("J15_with_unaligned", f"WITH {_MATES} SELECT qname, {B('flag')} AS flag, {B('n')} AS seq_len, CAST(NULL AS VARCHAR) AS chrom FROM u UNION ALL SELECT qname, flag, seq_len, chrom FROM br_reads")
def _(v: Views) -> DataFrame:
    return reads.with_unaligned(v("br_reads"), _mates(v)).select("qname", "flag", "seq_len", "chrom")


@query("C11_merge_up", f"SELECT chrom, rg, {B('count(*)')} AS n, {B('sum(seq_len)')} AS bases FROM br_reads WHERE flag & 1024 = 0 AND chrom = 'chr2' GROUP BY ROLLUP (chrom, rg)")
def _(v: Views) -> DataFrame:
    return reads.merge_up(v("br_reads"), ["chrom", "rg"], "chr2")


# Genotypes and ranks

_IDENTITY = """i AS (SELECT a.sample, b.sample AS candidate, count(*) AS compared, count(*) FILTER (a.a1 + a.a2 = b.a1 + b.a2) AS matching, CAST(count(*) FILTER (a.a1 + a.a2 = b.a1 + b.a2) AS DOUBLE) / count(*) AS share
  FROM br_genotypes a JOIN br_genotypes b ON a.site = b.site AND b.sample <> 'S3' WHERE a.a1 IS NOT NULL AND b.a1 IS NOT NULL AND (a.sample <> b.sample OR a.sample IN ('S1', 'S2')) GROUP BY a.sample, b.sample),
p AS (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY share DESC, candidate) AS place FROM i)"""


def _identity(v: Views) -> DataFrame:
    g = v("br_genotypes")
    return calls.genotype_identity(g, g.where("sample <> 'S3'")).where("sample <> candidate OR sample IN ('S1', 'S2')").drop("place").withColumn("place", F.row_number().over(calls.Window.partitionBy("sample").orderBy(F.desc("share"), "candidate")))


@query("A25_genotype_identity", f"WITH {_IDENTITY} SELECT sample, candidate, {B('compared')} AS compared, {B('matching')} AS matching, round(share, 6) AS share, {B('place')} AS place FROM p")
def _(v: Views) -> DataFrame:
    return _identity(v)


@query("A25_best_two", f"WITH {_IDENTITY} SELECT a.sample, a.candidate AS best, round(a.share, 6) AS best_share, b.candidate AS second, round(b.share, 6) AS second_share FROM p a LEFT JOIN p b ON a.sample = b.sample AND b.place = 2 WHERE a.place = 1")
def _(v: Views) -> DataFrame:
    return calls.best_two(_identity(v))


#: Expected: S1 and S4 themselves (S4 isn't among its candidates), S3 (not compared) for S2, S6 for S5, nobody for the others.
@query(
    "A26_genotype_status",
    f"""WITH {_IDENTITY}, e AS (SELECT * FROM (VALUES ('S1', 'S1'), ('S2', 'S3'), ('S4', 'S4'), ('S5', 'S6'), ('S7', 'S8'), ('S8', 'S9')) t(sample, expected)),
x AS (SELECT a.sample, a.candidate AS best, a.share AS s1, b.candidate AS second, b.share AS s2, k.candidate AS expected FROM p a LEFT JOIN p b ON a.sample = b.sample AND b.place = 2 LEFT JOIN e ON e.sample = a.sample LEFT JOIN p k ON k.sample = a.sample AND k.candidate = e.expected WHERE a.place = 1)
SELECT sample, expected, best, round(s1, 6) AS best_share, round(s2, 6) AS second_share, CASE WHEN s1 = s2 AND (expected = best OR expected = second) THEN 'confirmed'
 WHEN s1 < 1.1 * s2 AND expected IS NOT NULL THEN 'unconfirmed' WHEN s1 < 1.1 * s2 THEN 'unknown' WHEN expected IS NULL THEN 'candidate' WHEN expected = best THEN 'confirmed' ELSE 'wrong' END AS status FROM x""",
)
def _(v: Views) -> DataFrame:
    who = {"S1": "S1", "S2": "S3", "S4": "S4", "S5": "S6", "S7": "S8", "S8": "S9"}
    expected = v("br_genotypes").select("sample").distinct().withColumn("expected", F.create_map(*(F.lit(x) for kv in who.items() for x in kv))[F.col("sample")])
    return calls.genotype_status(_identity(v), expected, 1.1)


_GC = ", ".join(f"count(*) FILTER (least(a1, a2) = {i} AND greatest(a1, a2) = {j})" for i, j in ((0, 0), (0, 1), (1, 1)))


@query(
    "A22_cohort_summary",
    f"""WITH g AS (SELECT *, cohort AS c FROM br_genotypes), s AS (SELECT site, cohort, count(a1) + count(a2) AS an, coalesce(sum(a1), 0) + coalesce(sum(a2), 0) AS ac, count(*) FILTER (a1 + a2 = 0) AS h0, count(*) FILTER (a1 + a2 = 1) AS h1, count(*) FILTER (a1 + a2 = 2) AS h2,
 avg(dp) AS mean_dp, coalesce(string_agg(DISTINCT c, ',' ORDER BY c) FILTER (a1 > 0 OR a2 > 0), '') AS cohorts, count(DISTINCT c) FILTER (a1 > 0 OR a2 > 0) AS nc FROM g GROUP BY GROUPING SETS ((site, cohort), (site))),
p AS (SELECT *, (2 * h2 + h1) / CAST(nullif(2 * (h0 + h1 + h2), 0) AS DOUBLE) AS p FROM s)
SELECT site, cohort, {B("an")} AS an, CAST(CAST(ac AS BIGINT) AS VARCHAR) AS ac, {B("ac")} AS mac, concat_ws(',', h0, h1, h2) AS gc, round(CASE WHEN p > 0 AND p < 1 THEN 1 - (h1 / CAST(h0 + h1 + h2 AS DOUBLE)) / (2 * p * (1 - p)) END, 6) AS icf, round(mean_dp, 6) AS mean_dp, {B("nc")} AS n_cohorts, cohorts FROM p""",
)
def _(v: Views) -> DataFrame:
    return calls.cohort_summary(v("br_genotypes"))


_TYPE = "CASE WHEN {0} IS NULL OR {1} IS NULL THEN NULL WHEN {0} = 0 AND {1} = 0 THEN 'hom_RR' WHEN {0} = {1} THEN 'hom_AA' WHEN {0} = 0 OR {1} = 0 THEN 'het_RA' ELSE 'het_AA' END".format
_COMPARED = f"""a AS (SELECT site, sample, a1 AS x1, a2 AS y1, phased = 1 AS p1, {_TYPE("a1", "a2")} AS t1 FROM br_genotypes WHERE dp < 40),
b0 AS (SELECT site, sample, CASE WHEN dp % 5 = 0 THEN 1 - a1 WHEN dp % 7 = 0 THEN NULL ELSE a1 END AS x2, CASE WHEN dp % 7 = 0 AND dp % 5 <> 0 THEN NULL WHEN dp % 3 = 0 THEN 2 * a2 ELSE a2 END AS y2, dp % 4 <> 0 AS p2, dp // 10 AS dp_bin FROM br_genotypes WHERE dp > 10),
b AS (SELECT *, {_TYPE("x2", "y2")} AS t2 FROM b0),
c0 AS (SELECT *, coalesce(t1, t2) AS type, CASE WHEN t1 IS NULL THEN 'gained' WHEN t2 IS NULL THEN 'lost' WHEN least(x1, y1) = least(x2, y2) AND greatest(x1, y1) = greatest(x2, y2) THEN 'match' ELSE 'mismatch' END AS o FROM a FULL JOIN b USING (site, sample) WHERE coalesce(t1, t2) IS NOT NULL),
c AS (SELECT *, CASE WHEN o NOT IN ('match', 'mismatch') THEN NULL WHEN p1 AND NOT p2 THEN 'lost' WHEN NOT p1 AND p2 THEN 'gained' WHEN p1 AND p2 AND o = 'match' THEN CASE WHEN x1 = x2 AND y1 = y2 THEN 'match' ELSE 'mismatch' END END AS ph FROM c0)"""
_OUTCOMES = ", ".join(f"{B(f'''count(*) FILTER (o = '{x}')''')} AS {x}" for x in ("match", "mismatch", "lost", "gained")) + ", " + ", ".join(f"{B(f'''count(*) FILTER (ph = '{x}')''')} AS phase_{x}" for x in ("match", "mismatch", "lost", "gained"))


def _two_sets(v: Views) -> tuple[DataFrame, DataFrame]:
    g, dp = v("br_genotypes"), F.col("dp")
    x = F.when(dp % 5 == 0, 1 - F.col("a1")).when(dp % 7 != 0, F.col("a1"))
    y = F.when((dp % 7 == 0) & (dp % 5 != 0), None).when(dp % 3 == 0, 2 * F.col("a2")).otherwise(F.col("a2"))
    return g.where("dp < 40"), g.where("dp > 10").select("site", "sample", x.alias("a1"), y.alias("a2"), (dp % 4 != 0).cast("int").alias("phased"), F.floor(dp / 10).alias("dp_bin"))


@query("A23_concordance", f"WITH {_COMPARED} SELECT sample, type, {_OUTCOMES} FROM c GROUP BY sample, type")
def _(v: Views) -> DataFrame:
    return calls.concordance(*_two_sets(v))


@query("A23_concordance_by_depth", f"WITH {_COMPARED} SELECT {B('dp_bin')} AS dp_bin, type, t2 AS type2, {_OUTCOMES} FROM c GROUP BY dp_bin, type, t2")
def _(v: Views) -> DataFrame:
    return calls.concordance(*_two_sets(v), "dp_bin", "type", "type2")


@query(
    "A23_discordance",
    f"""WITH {_COMPARED}, t AS (SELECT type, count(*) FILTER (o = 'match') AS m, count(*) FILTER (o = 'mismatch') AS x FROM c GROUP BY type), u AS (SELECT * FROM t UNION ALL SELECT NULL, sum(m) FILTER (type <> 'hom_RR'), sum(x) FROM t)
SELECT type, {B("m")} AS match, {B("x")} AS mismatch, round(100.0 * x / nullif(m + x, 0), 6) AS discordance FROM u""",
)
def _(v: Views) -> DataFrame:
    return calls.discordance(calls.concordance(*_two_sets(v)))


@query(
    "A16_sample_stats",
    f"""WITH s AS (SELECT site, count(*) FILTER (a1 + a2 > 0) AS n_alt FROM br_genotypes GROUP BY site), x AS (SELECT g.*, n_alt, {_TYPE("a1", "a2")} AS t, CASE WHEN g.site % 3 = 0 THEN 'indel' ELSE 'snp' END AS kind FROM br_genotypes g JOIN s USING (site))
SELECT sample, {", ".join(f"{B(f'''count(*) FILTER (t = '{t}')''')} AS {t.lower()}" for t in ("hom_RR", "het_RA", "hom_AA", "het_AA"))}, {B("count(*) FILTER (t IS NULL)")} AS missing, {B("count(*) FILTER (t IS NOT NULL AND phased = 1)")} AS phased, {B("count(*) FILTER (t IS NOT NULL AND phased = 0)")} AS unphased,
 {B("count(*) FILTER (a1 + a2 > 0 AND kind = 'snp')")} AS snps, {B("count(*) FILTER (a1 + a2 > 0 AND kind = 'indel')")} AS indels, {B("count(*) FILTER (a1 + a2 > 0 AND n_alt = 1)")} AS private FROM x GROUP BY sample""",
)
def _(v: Views) -> DataFrame:
    return calls.sample_stats(v("br_genotypes").withColumn("kind", F.when(F.col("site") % 3 == 0, "indel").otherwise("snp")))


@query("A16_shared_spectrum", f"WITH s AS (SELECT site, count(*) FILTER (a1 + a2 > 0) AS n_samples FROM br_genotypes GROUP BY site) SELECT {B('n_samples')} AS n_samples, {B('count(*)')} AS sites FROM s GROUP BY 1")
def _(v: Views) -> DataFrame:
    return calls.shared_spectrum(v("br_genotypes"))


_MINE, _ALT = "sample IN ('S1', 'S4')", "(coalesce(a1, 0) > 0 OR coalesce(a2, 0) > 0)"


def _subset_sql(source: str, where: str) -> str:
    return f"""WITH g AS ({source}), x AS (SELECT site, count(*) FILTER ({_ALT} AND {_MINE}) AS inside, count(*) FILTER ({_ALT} AND NOT {_MINE}) AS outside, count(*) FILTER ({_MINE} AND (a1 IS NOT NULL OR a2 IS NOT NULL)) AS n_called FROM g GROUP BY site)
SELECT site, {B("inside")} AS inside, {B("outside")} AS outside, {B("n_called")} AS n_called, CASE WHEN inside > 0 THEN '1' ELSE '' END AS alts FROM x WHERE {where}"""


@query("P11_variant_subset", _subset_sql("SELECT * FROM br_genotypes", "inside > 0"))
def _(v: Views) -> DataFrame:
    return calls.variant_subset(v("br_genotypes"), ["S1", "S4"])


@query("P11_variant_subset_types", _subset_sql("SELECT site, sample, CASE WHEN site % 3 = 0 THEN a1 ELSE a1 * 0 END AS a1, CASE WHEN site % 3 = 0 THEN a2 ELSE a2 * 0 END AS a2 FROM br_genotypes", "inside > 0 OR n_called = 0"))
def _(v: Views) -> DataFrame:
    sites = v("br_genotypes").select("site").distinct().withColumn("kind", F.when(F.col("site") % 3 == 0, "indel").otherwise("snp"))
    return calls.variant_subset(v("br_genotypes"), ["S1", "S4"], keep_uncalled=True, sites=sites, types=["indel"], replace_with_ref=True)


_U = f"""r AS (SELECT {_INDEL} AS a, rank() OVER (ORDER BY qual) + (count(*) OVER (PARTITION BY qual) - 1) / 2.0 AS r FROM br_variants), s AS (SELECT count(*) FILTER (a) AS na, count(*) FILTER (NOT a) AS nb, sum(r) FILTER (a) AS ra FROM r),
u AS (SELECT na, nb, ra - na * (na + 1) / 2.0 AS u FROM s), z AS (SELECT *, (least(u, na * nb - u) - na * nb / 2.0) / sqrt(na * nb * (na + nb + 1) / 12.0) AS z FROM u)"""


@query("A50_mann_whitney", f"WITH {_U} SELECT {B('na')} AS n_a, {B('nb')} AS n_b, round(u, 6) AS u_a, round(na * nb - u, 6) AS u_b, round(z, 6) AS z FROM z")
def _(v: Views) -> DataFrame:
    return stats.mann_whitney(v("br_variants").withColumn("a", variants.is_indel()), "qual", "a").drop("p")


@query(
    "W6_peak_window",
    f"""WITH h AS (SELECT mapq AS bin, count(*) AS freq FROM br_reads GROUP BY mapq), m AS (SELECT bin AS mode FROM h ORDER BY freq DESC, bin LIMIT 1), o AS (SELECT abs(bin - mode) AS off, sum(freq) AS n FROM h CROSS JOIN m GROUP BY 1), c AS (SELECT off, sum(n) OVER (ORDER BY off) AS cum, sum(n) OVER () AS total FROM o)
SELECT mode, {B("sum(freq)")} AS total, round(coalesce(sum(freq) FILTER (bin >= mode * 0.75 AND bin <= mode * 1.25), 0) / CAST(sum(freq) AS DOUBLE), 6) AS share, round((SELECT min(off) FROM c WHERE cum >= 0.8 * total) / CAST(mode AS DOUBLE), 6) AS half_width FROM h CROSS JOIN m GROUP BY mode""",
)
def _(v: Views) -> DataFrame:
    return stats.peak_window(v("br_reads").groupBy(F.col("mapq").alias("bin")).agg(F.count("*").alias("freq")), 0.25)
