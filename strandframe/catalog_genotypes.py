"""Queries of the operators on genotypes and lanes; catalog.py reads this module."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import B, Views, query
from .operators import genotypes, lanes
from .plans.prefix import running


@query("X5_likely_genotype", "SELECT var_id, CASE k WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' WHEN 2 THEN '1/1' WHEN 3 THEN '0/2' WHEN 4 THEN '1/2' ELSE '2/2' END AS gt FROM (SELECT var_id, list_position(l, list_min(l)) - 1 AS k FROM (SELECT var_id, [qual % 7, dp % 7, qual % 5, dp % 5, qual % 6, dp % 4] AS l FROM br_variants))")
def _(v: Views) -> DataFrame:
    pl = F.expr("array(qual % 7, dp % 7, qual % 5, dp % 5, qual % 6, dp % 4)")
    return v("br_variants").select("var_id", genotypes.likely_genotype(pl, F.lit(3)).alias("gt"))


@query(
    "X10_hwe_exact",
    """WITH t AS (SELECT var_id, dp AS hom1, qual AS het, var_id % 37 AS hom2 FROM br_variants), d AS (SELECT DISTINCT hom1, het, hom2, hom1 + het + hom2 AS n, 2 * hom1 + het AS a FROM t), e AS (SELECT *, unnest(range(a % 2, least(a, 2 * n - a) + 1, 2)) AS h FROM d),
l AS (SELECT *, h * ln(2) - lgamma((a - h) // 2 + 1) - lgamma(h + 1) - lgamma((2 * n - a - h) // 2 + 1) AS w, het * ln(2) - lgamma((a - het) // 2 + 1) - lgamma(het + 1) - lgamma((2 * n - a - het) // 2 + 1) AS seen FROM e),
m AS (SELECT hom1, het, hom2, max(w - seen) AS top FROM l GROUP BY ALL), p AS (SELECT hom1, het, hom2, sum(exp(w - seen - top)) FILTER (w - seen <= 1e-9) / sum(exp(w - seen - top)) AS p FROM l JOIN m USING (hom1, het, hom2) GROUP BY ALL)
SELECT var_id, round(p, 6) AS p FROM t LEFT JOIN p USING (hom1, het, hom2)""",
)
def _(v: Views) -> DataFrame:
    return genotypes.hwe_exact(v("br_variants").selectExpr("var_id", "dp AS hom1", "qual AS het", "var_id % 37 AS hom2")).select("var_id", "p")


@query("X11_dp4_ratios", f"SELECT var_id, {B('dp + qual')} AS ref_depth, {B('qual % 3 + dp % 2')} AS alt_depth, round(coalesce((qual % 3) / nullif(CAST(dp + qual % 3 AS DOUBLE), 0), 0), 6) AS ratio_forward, round(coalesce((dp % 2) / nullif(CAST(qual + dp % 2 AS DOUBLE), 0), 0), 6) AS ratio_reverse FROM br_variants")
def _(v: Views) -> DataFrame:
    made = v("br_variants").withColumn("dp4", F.expr("concat_ws(',', dp, qual, qual % 3, dp % 2)"))
    return genotypes.dp4_ratios(made).select("var_id", "ref_depth", "alt_depth", "ratio_forward", "ratio_reverse")


@query("X12_reploid", f"SELECT var_id, concat_ws(',', qual % 7, qual % 5, dp % 4) AS haploid, {B('list_position([qual % 7, qual % 5, dp % 4], least(qual % 7, qual % 5, dp % 4)) - 1')} AS allele, concat_ws(',', dp % 3, '.', qual % 3) AS diploid, {B('CASE WHEN qual % 3 < dp % 3 THEN 1 ELSE 0 END')} AS pair FROM br_variants")
def _(v: Views) -> DataFrame:
    down, allele = genotypes.reploid(F.expr("array(qual % 7, dp % 7, qual % 5, dp % 5, qual % 6, dp % 4)"), 3, diploid=False)
    up, pair = genotypes.reploid(F.expr("array(dp % 3, qual % 3)"), 2, diploid=True)
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",", ".")
    return v("br_variants").select("var_id", text(down).alias("haploid"), allele.alias("allele"), text(up).alias("diploid"), pair.alias("pair"))


_PAIR = "concat(least(ref, substr(alt, 1, 1)), greatest(ref, substr(alt, 1, 1)))"


@query("X13_top_strand", f"SELECT var_id, CASE {_PAIR} WHEN 'AC' THEN 'TOP' WHEN 'AG' THEN 'TOP' WHEN 'CT' THEN 'BOT' WHEN 'GT' THEN 'BOT' WHEN 'AT' THEN w WHEN 'CG' THEN w END AS strand FROM (SELECT *, CASE WHEN dp % 2 = 0 THEN 'TOP' WHEN dp % 3 = 0 THEN 'BOT' END AS w FROM br_variants)")
def _(v: Views) -> DataFrame:
    made = v("br_variants").withColumns({"left": F.expr("CASE WHEN dp % 2 = 0 THEN 'CAT' WHEN dp % 3 = 0 THEN 'TGA' ELSE 'ATA' END"), "right": F.expr("CASE WHEN dp % 2 = 0 THEN 'TCA' WHEN dp % 3 = 0 THEN 'TTA' ELSE 'TAN' END")})
    return made.select("var_id", genotypes.top_strand(F.col("ref"), F.substring("alt", 1, 1), F.col("left"), F.col("right")).alias("strand"))


_CHUNKS = "ch AS (SELECT sample, site, c AS chunk_no, CASE WHEN c % 2 = 1 THEN a2 ELSE a1 END AS a1, CASE WHEN c % 2 = 1 THEN a1 ELSE a2 END AS a2 FROM br_genotypes, (SELECT unnest(range(0, 5)) AS c) WHERE site BETWEEN c * 40 AND c * 40 + 59)"


@query(
    "C2_phased_join",
    f"""WITH {_CHUNKS}, e AS (SELECT chunk_no, min(site) AS f, max(site) AS t FROM ch GROUP BY chunk_no),
p AS (SELECT a.chunk_no, a.sample, count(*) FILTER (a.a1 <> a.a2 AND a.a1 = b.a1 AND a.a2 = b.a2) AS n1, count(*) FILTER (a.a1 <> a.a2 AND a.a1 = b.a2 AND a.a2 = b.a1) AS n2 FROM ch a JOIN ch b ON b.chunk_no = a.chunk_no - 1 AND a.sample = b.sample AND a.site = b.site GROUP BY a.chunk_no, a.sample),
s AS (SELECT chunk_no, sample, sum(CASE WHEN n2 > n1 THEN 1 ELSE 0 END) OVER (PARTITION BY sample ORDER BY chunk_no) % 2 AS turn FROM (SELECT DISTINCT chunk_no, sample FROM ch) LEFT JOIN p USING (chunk_no, sample))
SELECT sample, site, {B('chunk_no')} AS chunk_no, CASE WHEN turn = 1 THEN a2 ELSE a1 END AS a1, CASE WHEN turn = 1 THEN a1 ELSE a2 END AS a2 FROM ch JOIN s USING (chunk_no, sample) JOIN e USING (chunk_no) QUALIFY row_number() OVER (PARTITION BY sample, site ORDER BY least(site - f, t - site) DESC, chunk_no) = 1""",
)
def _(v: Views) -> DataFrame:
    spread = v("br_genotypes").withColumn("chunk_no", F.explode(F.sequence(F.lit(0), F.lit(4)))).where("site BETWEEN chunk_no * 40 AND chunk_no * 40 + 59")
    turned = spread.selectExpr("sample", "site", "bigint(chunk_no) AS chunk_no", "CASE WHEN chunk_no % 2 = 1 THEN a2 ELSE a1 END AS a1", "CASE WHEN chunk_no % 2 = 1 THEN a1 ELSE a2 END AS a2")
    return genotypes.phased_join(turned)


@query("C3_fix_ploidy", "SELECT site AS pos, sample, CASE WHEN n > 0 THEN a1 END AS a1, CASE WHEN n > 1 THEN a2 END AS a2, CASE n WHEN 0 THEN a1 IS NOT NULL OR a2 IS NOT NULL WHEN 1 THEN a2 IS NOT NULL ELSE false END AS changed FROM (SELECT *, CASE WHEN site BETWEEN 20 AND 59 THEN CASE WHEN sample < 'S5' THEN 1 ELSE 2 END WHEN site BETWEEN 100 AND 149 THEN CASE WHEN sample < 'S5' THEN 1 ELSE 0 END ELSE 2 END AS n FROM br_genotypes)")
def _(v: Views) -> DataFrame:
    gt = v("br_genotypes").selectExpr("'X' AS chrom", "site AS pos", "sample", "a1", "a2")
    sexes = v("br_genotypes").selectExpr("sample", "CASE WHEN sample < 'S5' THEN 'M' ELSE 'F' END AS sex").distinct()
    regions = v("region").where("r_regionkey < 2").selectExpr("r_regionkey AS region_id", "'X' AS chrom", "r_regionkey * 80 + 20 AS start_pos", "r_regionkey * 90 + 59 AS end_pos", "1 AS male", "CASE r_regionkey WHEN 0 THEN 2 ELSE 0 END AS female")
    return genotypes.fix_ploidy(gt, sexes, regions, "sample").drop("chrom")


@query(
    "I5_segment_diff",
    """WITH s0 AS (SELECT sample, site * 10 AS s, site * 10 + 10 AS e, site // 20 % 2 AS control, CASE WHEN dp < 10 THEN site // 20 % 2 ELSE coalesce(a1 + a2, 0) END AS copies FROM br_genotypes),
o AS (SELECT s, e, control, copies, count(DISTINCT sample) AS n FROM s0 WHERE control <> copies GROUP BY ALL)
SELECT a.sample, CAST(count(*) FILTER (a.control <> a.copies AND p.s IS NULL) AS BIGINT) AS n_different, CAST(coalesce(sum(a.e - a.s) FILTER (a.control <> a.copies), 0) AS BIGINT) AS length_different, CAST(coalesce(sum(a.e - a.s) FILTER (a.control <> a.copies AND n > 1), 0) AS BIGINT) AS length_shared
FROM s0 a LEFT JOIN s0 p ON p.sample = a.sample AND p.e = a.s AND p.control = a.control AND p.copies = a.copies LEFT JOIN o ON o.s = a.s AND o.e = a.e AND o.control = a.control AND o.copies = a.copies GROUP BY a.sample""",
)
def _(v: Views) -> DataFrame:
    made = v("br_genotypes").selectExpr("sample", "'c' AS chrom", "site * 10 AS start_pos", "site * 10 + 10 AS end_pos", "site div 20 % 2 AS control", "coalesce(a1 + a2, 0) AS copies", "dp AS qual")
    return genotypes.segment_diff(made, 10)


@query("J7_genotype_lookup", "SELECT chrom, pos, concat('S', var_id % 9) AS sample, CASE WHEN pos % 2 = 0 THEN translate(concat(ref, substr(alt, 1, 1)), 'ACGT', 'TGCA') ELSE concat(ref, substr(alt, 1, 1)) END AS gt FROM br_variants WHERE (chrom, pos) IN (SELECT (chrom, pos) FROM br_calls WHERE src = 1)")
def _(v: Views) -> DataFrame:
    sites = v("br_calls").where("src = 1").selectExpr("chrom", "pos", "pos % 2 = 0 AS reverse")
    return genotypes.genotype_lookup(sites, v("br_variants").selectExpr("chrom", "pos", "concat('S', var_id % 9) AS sample", "concat(ref, substr(alt, 1, 1)) AS gt"))


@query("K5_gen_table", """WITH f AS (SELECT var_id AS site, chrom, pos, ref, alt FROM br_variants WHERE length(ref) = 1 AND length(alt) = 1 AND ref <> alt QUALIFY row_number() OVER (PARTITION BY chrom, pos ORDER BY var_id) = 1),
g AS (SELECT site, string_agg(CASE a1 + a2 WHEN 0 THEN '1 0 0' WHEN 1 THEN '0 1 0' ELSE '0 0 1' END, ' ' ORDER BY sample) AS gen, string_agg(concat(a1, ' ', a2), ' ' ORDER BY sample) AS hap FROM br_genotypes WHERE sample IN ('S1', 'S3', 'S5') AND a1 IS NOT NULL AND a2 IS NOT NULL GROUP BY site HAVING count(*) = 3 AND sum(a1 + a2) >= 1)
SELECT site, concat_ws(' ', chrom, pos, ref, alt) AS legend, gen, hap FROM f JOIN g USING (site)""")
def _(v: Views) -> DataFrame:
    return genotypes.gen_table(v("br_genotypes"), v("br_variants").withColumnRenamed("var_id", "site"), ["S1", "S3", "S5"], 1)


@query(
    "W14_loh_blocks",
    """WITH s AS (SELECT DISTINCT sample, site AS idx, coalesce(a1 <> a2, false) AS d FROM br_genotypes), gt AS (SELECT sample, row_number() OVER (PARTITION BY sample ORDER BY idx) AS idx, idx AS pos, d FROM s),
w AS (SELECT a.sample, a.idx AS i, a.idx + z - 1 AS j, z, fl, count(*) AS have, count(*) FILTER (b.d) AS n FROM gt a, (SELECT unnest([2, 3, 5]) AS z), (SELECT unnest([10, 40]) AS fl), gt b WHERE b.sample = a.sample AND b.idx BETWEEN a.idx AND a.idx + z - 1 GROUP BY ALL),
k AS (SELECT * FROM w WHERE have = z AND n >= z - floor(z * fl / 100.0) AND n >= 2), f AS (SELECT *, CASE WHEN max(j) OVER (PARTITION BY sample, z, fl ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= i THEN 0 ELSE 1 END AS fresh FROM k),
b AS (SELECT *, sum(fresh) OVER (PARTITION BY sample, z, fl ORDER BY i ROWS UNBOUNDED PRECEDING) AS g FROM f), bl AS (SELECT sample, z, fl, g, min(i) AS i, max(j) AS j FROM b GROUP BY ALL),
t AS (SELECT bl.sample, z, fl, g, min(idx) AS a, max(idx) AS c, min(pos) AS start_pos, max(pos) AS end_pos, count(*) AS n_different FROM bl JOIN gt ON gt.sample = bl.sample AND d AND idx BETWEEN i AND j GROUP BY ALL),
tot AS (SELECT sample, z, fl, sum(c - a + 1) AS held FROM t GROUP BY sample, z, fl), best AS (SELECT sample, z, fl FROM tot QUALIFY row_number() OVER (PARTITION BY sample ORDER BY held DESC, z, fl) = 1)
SELECT sample, 'c' AS chrom, CAST(z AS BIGINT) AS size, CAST(fl AS BIGINT) AS flex, start_pos, end_pos, n_different, c - a + 1 AS n_sites FROM t JOIN best USING (sample, z, fl)""",
)
def _(v: Views) -> DataFrame:
    made = v("br_genotypes").selectExpr("sample", "'c' AS chrom", "site AS pos", "coalesce(a1 <> a2, false) AS differs")
    return genotypes.loh_blocks(running(made, ["sample", "chrom"], "pos", ["pos"], F.lit(1), "idx", "count").withColumn("idx", F.col("idx").cast("long")), [2, 3, 5], [10, 40])


_LANES = "SELECT lane_id AS lane, project AS study, sample, library_id AS library, lane_id % 11 = 0 AS withdrawn FROM br_lanes"


def _lanes(v: Views) -> DataFrame:
    return v("br_lanes").selectExpr("lane_id AS lane", "project AS study", "sample", "library_id AS library", "lane_id % 11 = 0 AS withdrawn")


@query(
    "J12_check_against_index",
    f"""WITH k AS ({_LANES}), g AS (SELECT CASE WHEN lane % 17 = 0 THEN -lane ELSE lane END AS lane, CASE WHEN lane % 5 = 0 THEN 'X' ELSE study END AS study, CASE WHEN lane % 7 = 0 THEN 'Y' ELSE sample END AS sample, library FROM k WHERE lane % 3 <> 0),
x AS (SELECT g.lane, g.study, g.sample, k.study AS s2, k.sample AS p2, k.lane IS NULL AS u, withdrawn AS w FROM g LEFT JOIN k USING (lane))
SELECT lane, 'not in db' AS problem FROM x WHERE u UNION ALL SELECT lane, 'withdrawn' FROM x WHERE w UNION ALL SELECT lane, 'study swap' FROM x WHERE NOT u AND NOT w AND study <> s2 UNION ALL SELECT lane, 'sample swap' FROM x WHERE NOT u AND NOT w AND sample <> p2
UNION ALL SELECT lane, 'missing' FROM k WHERE NOT withdrawn AND sample IN (SELECT p2 FROM x WHERE NOT u AND NOT w) AND lane NOT IN (SELECT lane FROM g)""",
)
def _(v: Views) -> DataFrame:
    given = _lanes(v).where("lane % 3 <> 0").selectExpr("CASE WHEN lane % 17 = 0 THEN -lane ELSE lane END AS lane", "CASE WHEN lane % 5 = 0 THEN 'X' ELSE study END AS study", "CASE WHEN lane % 7 = 0 THEN 'Y' ELSE sample END AS sample", "library")
    return lanes.check_against_index(given, _lanes(v), ["study", "sample", "library"])


@query("J17_new_samples_to_map", "SELECT DISTINCT library_id AS sample, sample AS individual, CASE WHEN sample IN (SELECT sample FROM br_lanes WHERE library_id % 3 = 0) THEN 'existing individual' ELSE 'new individual' END AS status FROM br_lanes WHERE library_id % 3 <> 0")
def _(v: Views) -> DataFrame:
    study = v("br_lanes").selectExpr("library_id AS sample", "sample AS individual")
    return lanes.new_samples_to_map(study, study.where("sample % 3 = 0"))


@query(
    "M10_sync_lanes",
    """WITH i AS (SELECT l_suppkey AS lane, bool_or(l_tax > 0.075) AS w, count(*) FILTER (l_returnflag = 'R') > 1 AS p FROM lineitem WHERE l_suppkey % 5 <> 0 GROUP BY l_suppkey), d AS (SELECT s_suppkey AS lane, s_suppkey % 2 = 0 AS w, s_suppkey % 3 = 0 AS p FROM supplier WHERE s_suppkey % 7 <> 0),
x AS (SELECT lane, i.w AS nw, i.p AS np, d.w, d.p, i.lane IS NULL AS gone, d.lane IS NULL AS fresh FROM i FULL JOIN d USING (lane))
SELECT lane, 'add' AS change, true AS applied FROM x WHERE fresh UNION ALL SELECT lane, 'delete', false FROM x WHERE gone UNION ALL SELECT lane, CASE WHEN nw THEN 'withdraw' ELSE 'unwithdraw' END, nw FROM x WHERE nw <> w UNION ALL SELECT lane, CASE WHEN np THEN 'pair' ELSE 'unpair' END, np FROM x WHERE np <> p""",
)
def _(v: Views) -> DataFrame:
    index = v("lineitem").where("l_suppkey % 5 <> 0").selectExpr("l_suppkey AS lane", "concat(l_orderkey, '_', l_linenumber) AS file", "l_tax > 0.075 AS withdrawn", "CASE WHEN l_returnflag = 'R' THEN 'mate' ELSE '' END AS mate_file")
    known = v("supplier").where("s_suppkey % 7 <> 0").selectExpr("s_suppkey AS lane", "s_suppkey % 2 = 0 AS withdrawn", "s_suppkey % 3 = 0 AS paired")
    return lanes.sync_lanes(index, known, major=False)


@query("C10_replaced_lanes", f"SELECT state AS lane, {B('count(*)')} AS n_lines FROM br_history WHERE (state < 'd' AND processed % 3 = 0) OR (state > 'p' AND row_id % 100 = 5) GROUP BY state")
def _(v: Views) -> DataFrame:
    old = v("br_history").selectExpr("state AS lane", "row_id AS line_no", "processed", "string(value) AS value")
    new = old.where("NOT (lane > 'p' AND line_no % 100 = 5)").withColumn("value", F.expr("CASE WHEN lane < 'd' AND processed % 3 = 0 THEN 'x' ELSE value END"))
    return lanes.replaced_lanes(old, new)


@query("K8_index_rows", "SELECT '' AS fastq_file, CAST(lane_id AS VARCHAR) AS lane_id, project, sample, CAST(raw_reads AS VARCHAR) AS raw_reads, '' AS withdrawn FROM br_lanes")
def _(v: Views) -> DataFrame:
    return lanes.index_rows(v("br_lanes"), ["fastq_file", "lane_id", "project", "sample", "raw_reads", "withdrawn"])
