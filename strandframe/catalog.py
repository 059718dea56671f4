"""All queries of the library's own operators over the bridge views, with equivalent SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from pyspark.sql.types import DoubleType, FloatType, IntegerType, ShortType

from .bridge import view, with_views
from .functions import alignments
from .operators import calls, genotypes, history, intervals, reads, reports, sequences, stats, variants
from .streaming import tracking

Views = Callable[[str], DataFrame]
CATALOG: dict[str, tuple[Callable[[Views], DataFrame], str]] = {}


def tidy(df: DataFrame) -> DataFrame:
    """Doubles rounded to six places and integers as longs, as the SQL has them."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (DoubleType, FloatType)):
            c = F.round(c, 6)
        elif isinstance(f.dataType, (IntegerType, ShortType)):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str):
    def put(f: Callable[[Views], DataFrame]):
        CATALOG[name] = (f, sql)
        return f

    return put


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, f=f: tidy(f(lambda v: view(spark, sf_dir, v)))) for name, (f, _) in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_views(sql) for name, (_, sql) in CATALOG.items() if sql}


B = "CAST({} AS BIGINT)".format

# Reads

_INSERT = "SELECT rg, isize AS bin, count(*) AS freq FROM br_reads WHERE flag & 2 <> 0 AND mapq > 0 AND isize > 0 GROUP BY rg, isize"


def _median(hist: str, name: str) -> str:
    return f"""SELECT rg, min(CASE WHEN cum >= round_even(total / 2.0, 0) THEN bin END) AS {name} FROM (
      SELECT rg, bin, sum(freq) OVER (PARTITION BY rg ORDER BY bin) AS cum, sum(freq) OVER (PARTITION BY rg) AS total FROM {hist}) GROUP BY rg"""


@query(
    "A4_histogram_stats",
    f"""WITH h AS (SELECT mate, qual AS bin, count(*) AS freq FROM br_quality GROUP BY mate, qual),
x AS (SELECT *, sum(freq) OVER (PARTITION BY mate ORDER BY bin) AS cum, sum(freq) OVER (PARTITION BY mate) AS total FROM h)
SELECT mate, {B("max(total)")} AS total, round(sum(bin * freq) / sum(freq), 6) AS mean, round(sqrt(sum(bin * bin * freq) / sum(freq) - (sum(bin * freq) / sum(freq)) * (sum(bin * freq) / sum(freq))), 6) AS sd,
 min(bin) FILTER (cum >= round_even(total / 2.0, 0)) AS median, min(bin) FILTER (cum >= total * 0.25) AS q1, min(bin) FILTER (cum >= total * 0.75) AS q3 FROM x GROUP BY mate""",
)
def _(v: Views) -> DataFrame:
    return stats.histogram_stats(v("br_quality").groupBy("mate", F.col("qual").alias("bin")).agg(F.count("*").alias("freq")), ["mate"])


_EVENTS = """ev AS (SELECT chrom, p, sum(d) AS d FROM (SELECT chrom, pos AS p, 1 AS d FROM br_reads WHERE flag & 4 = 0
  UNION ALL SELECT chrom, pos + seq_len, -1 FROM br_reads WHERE flag & 4 = 0) GROUP BY chrom, p),
seg AS (SELECT * FROM (SELECT chrom, p AS start_pos, lead(p) OVER (PARTITION BY chrom ORDER BY p) - 1 AS end_pos, sum(d) OVER (PARTITION BY chrom ORDER BY p) AS depth FROM ev) WHERE depth > 0)"""


@query("W5_depth_segments", f"WITH {_EVENTS} SELECT chrom, start_pos, end_pos, {B('depth')} AS depth FROM seg")
def _(v: Views) -> DataFrame:
    return reads.depth_segments(v("br_reads"))


@query(
    "A11_coverage_histogram",
    f"WITH {_EVENTS} SELECT {B('CASE WHEN depth < 2 THEN 1 WHEN depth > 30 THEN 31 ELSE 2 + floor((depth - 2) / 4.0) * 4 END')} AS depth_bin, {B('sum(end_pos - start_pos + 1)')} AS bases FROM seg GROUP BY 1",
)
def _(v: Views) -> DataFrame:
    return reads.coverage_histogram(reads.depth_segments(v("br_reads")), 2, 30, 4)


@query(
    "A12_bases_at_depth",
    f"WITH {_EVENTS} SELECT {B('t')} AS threshold, {B('coalesce(sum(end_pos - start_pos + 1) FILTER (depth >= t), 0)')} AS bases FROM seg CROSS JOIN (VALUES (1), (5), (10), (3)) x(t) GROUP BY t",
)
def _(v: Views) -> DataFrame:
    return reads.bases_at_depth(reads.depth_segments(v("br_reads")), [1, 5, 10, 3])


@query(
    "A13_coverage_depth",
    f"""WITH {_EVENTS}, s AS (SELECT sum(end_pos - start_pos + 1) AS c, sum((end_pos - start_pos + 1) * depth) AS d, sum((end_pos - start_pos + 1) * depth * depth) AS q FROM seg)
SELECT {B("c")} AS covered, round(d / 1000000.0, 6) AS mean_depth, round(sqrt(q / 1000000.0 - (d / 1000000.0) * (d / 1000000.0)), 6) AS sd_depth FROM s""",
)
def _(v: Views) -> DataFrame:
    return reads.coverage_depth(reads.depth_segments(v("br_reads")), 1_000_000)


_MERGED = """iv0 AS (SELECT DISTINCT chrom, start_pos, end_pos FROM br_intervals),
iv1 AS (SELECT *, max(end_pos) OVER (PARTITION BY chrom ORDER BY start_pos, end_pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM iv0),
iv2 AS (SELECT *, sum(CASE WHEN reached IS NULL OR reached < start_pos - 1 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start_pos, end_pos) AS grp FROM iv1),
merged AS (SELECT chrom, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM iv2 GROUP BY chrom, grp)"""


@query(
    "A45_chromosome_deviation",
    "WITH c AS (SELECT chrom, count(*) AS n FROM br_reads WHERE flag & 4 = 0 GROUP BY chrom) SELECT round(sqrt(avg(power((n - t) / CAST(t AS DOUBLE), 2))), 6) AS deviation FROM c CROSS JOIN (SELECT max(n) AS t FROM c)",
)
def _(v: Views) -> DataFrame:
    return stats.chromosome_deviation(reads.flag_filter(v("br_reads"), exclude=reads.UNMAPPED).groupBy("chrom").agg(F.count("*").alias("n")))


@query("P13_readgroup_filter", "SELECT * FROM br_reads WHERE rg IN ('rg1', 'rg2', 'rg3') AND rg <> 'rg2'")
def _(v: Views) -> DataFrame:
    groups = v("br_reads").select("rg").distinct()
    return reads.readgroup_filter(v("br_reads"), groups, F.col("rg").isin("rg1", "rg2", "rg3"), F.col("rg") == "rg2").select(*v("br_reads").columns)


@query("P14_flag_filter", "SELECT * FROM br_reads WHERE flag & 3 = 3 AND flag & 1040 = 0")
def _(v: Views) -> DataFrame:
    return reads.flag_filter(v("br_reads"), 3, 1040)


@query("P22_unmapped_reads", "SELECT * FROM br_reads WHERE flag & 4 <> 0")
def _(v: Views) -> DataFrame:
    return reads.unmapped_reads(v("br_reads"))


@query(
    "W12_previous_row_fill",
    "WITH x AS (SELECT read_id, min(CASE WHEN read_id % 3 = 0 THEN rg END) AS rg FROM br_reads GROUP BY read_id) SELECT read_id, coalesce(last_value(rg IGNORE NULLS) OVER (ORDER BY read_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 'unknown_readgroup') AS rg FROM x",
)
def _(v: Views) -> DataFrame:
    some = v("br_reads").groupBy("read_id").agg(F.min(F.when(F.col("read_id") % 3 == 0, F.col("rg"))).alias("rg"))
    return reads.previous_row_fill(some, "read_id", "rg", block=1 << 14)


@query("X7_explain_flags", "SELECT read_id, concat_ws(',', 'paired', CASE WHEN flag & 2 <> 0 THEN 'proper' END, CASE WHEN flag & 4 <> 0 THEN 'unmapped' END, CASE WHEN flag & 16 <> 0 THEN 'reverse' END, CASE WHEN flag & 64 <> 0 THEN 'first' END, CASE WHEN flag & 128 <> 0 THEN 'second' END, CASE WHEN flag & 1024 <> 0 THEN 'duplicate' END) AS names FROM br_reads")
def _(v: Views) -> DataFrame:
    return v("br_reads").select("read_id", alignments.explain_flags(F.col("flag")).alias("names"))


@query(
    "X6_cigar_stats",
    "SELECT read_id, seq_len AS read_span, CASE WHEN nm > 0 THEN seq_len - 10 + nm ELSE seq_len END AS ref_span FROM br_reads",
)
def _(v: Views) -> DataFrame:
    cigar = F.when(F.col("nm") > 0, F.concat(F.col("seq_len") - 10, F.lit("M"), F.col("nm"), F.lit("D10S"))).otherwise(F.concat("seq_len", F.lit("M")))
    return v("br_reads").select("read_id", alignments.cigar_span(cigar, "MIS=X").alias("read_span"), alignments.cigar_span(cigar, "MDN").alias("ref_span"))


# Intervals


@query("I1_merge_intervals", f"WITH {_MERGED} SELECT * FROM merged")
def _(v: Views) -> DataFrame:
    return intervals.merge_intervals(v("br_intervals"))


@query(
    "I2_complement_intervals",
    f"""WITH {_MERGED}, inner_gaps AS (SELECT chrom, coalesce(lag(end_pos) OVER (PARTITION BY chrom ORDER BY start_pos) + 50, 0) + 1 AS s, start_pos - 51 AS e FROM merged),
tail AS (SELECT chrom, max(end_pos) + 51 AS s, 60000 AS e FROM merged GROUP BY chrom)
SELECT chrom, {B("s")} AS start_pos, {B("e")} AS end_pos FROM (SELECT * FROM inner_gaps UNION ALL SELECT * FROM tail) WHERE e - s + 1 > 10""",
)
def _(v: Views) -> DataFrame:
    lengths = v("br_intervals").select("chrom").distinct().withColumn("length", F.lit(60_000).cast("long"))
    return intervals.complement_intervals(v("br_intervals"), lengths)


@query(
    "I3_mask_from_sites",
    """WITH w AS (SELECT DISTINCT chrom, greatest(0, pos - 5) AS s, pos + 5 AS e FROM br_variants), a AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM w),
b AS (SELECT *, sum(CASE WHEN r IS NULL OR r < s - 1 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, e) AS g FROM a) SELECT chrom, min(s) AS start_pos, max(e) AS end_pos FROM b GROUP BY chrom, g""",
)
def _(v: Views) -> DataFrame:
    return intervals.mask_from_sites(v("br_variants"), 5)


@query(
    "I4_disjoin",
    f"""WITH p AS (SELECT chrom, start_pos AS p FROM br_intervals UNION SELECT chrom, end_pos + 1 FROM br_intervals), s AS (SELECT chrom, p AS start_pos, lead(p) OVER (PARTITION BY chrom ORDER BY p) - 1 AS end_pos FROM p)
SELECT s.chrom, s.start_pos, s.end_pos, {B("count(*)")} AS n FROM s JOIN br_intervals i ON s.chrom = i.chrom AND s.start_pos <= i.end_pos AND s.end_pos >= i.start_pos GROUP BY ALL""",
)
def _(v: Views) -> DataFrame:
    return intervals.disjoin(v("br_intervals"))


@query(
    "I4_disjoin_samples",
    """WITH m AS (SELECT chrom, strand AS sample, start_pos, max(end_pos) AS end_pos FROM br_intervals GROUP BY ALL), n AS (SELECT *, lead(start_pos) OVER (PARTITION BY chrom, sample ORDER BY start_pos) AS nx, min(start_pos) OVER (PARTITION BY chrom, sample) AS f, min(start_pos) OVER (PARTITION BY chrom) AS low FROM m),
s AS (SELECT chrom, sample, CASE WHEN start_pos = f THEN low ELSE start_pos END AS start_pos, least(end_pos, coalesce(nx - 1, end_pos)) AS end_pos, start_pos % 10 AS copies FROM n),
p AS (SELECT chrom, start_pos AS p FROM s UNION SELECT chrom, start_pos FROM n UNION SELECT chrom, end_pos + 1 FROM s), q AS (SELECT chrom, p AS start_pos, lead(p) OVER (PARTITION BY chrom ORDER BY p) - 1 AS end_pos FROM p)
SELECT q.chrom, q.start_pos, q.end_pos, sample, copies FROM q JOIN s ON q.chrom = s.chrom AND q.start_pos BETWEEN s.start_pos AND s.end_pos WHERE q.end_pos IS NOT NULL""",
)
def _(v: Views) -> DataFrame:
    spans = v("br_intervals").groupBy("chrom", F.col("strand").alias("sample"), "start_pos").agg(F.max("end_pos").alias("end_pos"))
    ahead = F.lead("start_pos").over(Window.partitionBy("chrom", "sample").orderBy("start_pos"))
    cut = spans.withColumn("end_pos", F.least(F.col("end_pos"), F.coalesce(ahead - 1, F.col("end_pos")))).withColumn("copies", F.col("start_pos") % 10)
    return intervals.disjoin_samples(cut)


@query(
    "I6_chunk_contigs",
    f"""WITH c AS (SELECT chrom, max(pos) AS length FROM br_reads GROUP BY chrom), n AS (SELECT *, greatest(1, CAST(ceil((length - 700.0) / 7000) AS BIGINT)) AS n FROM c), k AS (SELECT *, unnest(range(n)) AS k FROM n)
SELECT chrom, {B("k * 7000 + 1")} AS start_pos, {B("CASE WHEN k = n - 1 THEN length ELSE (k + 1) * 7000 END")} AS end_pos FROM k""",
)
def _(v: Views) -> DataFrame:
    return intervals.chunk_contigs(v("br_reads").groupBy("chrom").agg(F.max("pos").alias("length")), 7000)


@query("J2_reads_in_intervals", "SELECT r.* FROM br_reads r WHERE EXISTS (SELECT 1 FROM br_intervals i WHERE i.chrom = r.chrom AND r.pos <= i.end_pos AND r.pos + r.seq_len - 1 >= i.start_pos)")
def _(v: Views) -> DataFrame:
    return intervals.reads_in_intervals(v("br_reads"), v("br_intervals"))


@query("J3_positions_in_intervals", "SELECT var_id, iv_id FROM br_variants v JOIN br_intervals i ON v.chrom = i.chrom AND v.pos BETWEEN i.start_pos AND i.end_pos")
def _(v: Views) -> DataFrame:
    return intervals.positions_in_intervals(v("br_variants"), v("br_intervals")).select("var_id", "iv_id")


# Variants

_INDEL = "length(ref) <> length(alt)"
_TS = "concat(ref, alt) IN ('AG', 'GA', 'CT', 'TC')"


@query("P2_region_filter", "SELECT * FROM br_variants WHERE chrom = 'chr2' AND pos >= 1000 AND pos <= 3000")
def _(v: Views) -> DataFrame:
    return variants.region_filter(v("br_variants"), "chr2", 1000, 3000)


@query("P4_pass_filter", "SELECT * FROM (SELECT * REPLACE (CASE WHEN filt = 'Brand#1' THEN 'PASS' ELSE filt END AS filt) FROM br_variants) WHERE filt IN ('PASS', '.') OR filt IS NULL")
def _(v: Views) -> DataFrame:
    return variants.pass_filter(v("br_variants").withColumn("filt", F.when(F.col("filt") == "Brand#1", "PASS").otherwise(F.col("filt"))))


@query("P8_set_filter", "SELECT var_id, CASE WHEN filt = 'Brand#11' THEN 'Checked' WHEN filt < 'Checked' THEN filt || ';Checked' ELSE 'Checked;' || filt END AS filters FROM br_variants")
def _(v: Views) -> DataFrame:
    return v("br_variants").select("var_id", variants.set_filter(F.col("filt"), ["Checked"], ["Brand#11"]).alias("filters"))


@query("P12_subset_positions", "SELECT * FROM br_variants WHERE (chrom, pos) IN (SELECT (chrom, pos) FROM br_calls WHERE src = 2)")
def _(v: Views) -> DataFrame:
    return variants.subset_positions(v("br_variants"), v("br_calls").where("src = 2")).select(*v("br_variants").columns)


@query("P12_subset_positions_complement", "SELECT * FROM br_variants WHERE (chrom, pos) NOT IN (SELECT (chrom, pos) FROM br_calls WHERE src = 2)")
def _(v: Views) -> DataFrame:
    return variants.subset_positions(v("br_variants"), v("br_calls").where("src = 2"), complement=True).select(*v("br_variants").columns)


_GROUPS = """pl AS (SELECT DISTINCT chrom, pos FROM br_calls), g0 AS (SELECT *, CASE WHEN pos - lag(pos) OVER (PARTITION BY chrom ORDER BY pos) <= 2 THEN 0 ELSE 1 END AS f FROM pl),
g1 AS (SELECT chrom, pos, CAST(sum(f) OVER (PARTITION BY chrom ORDER BY pos) AS BIGINT) AS grp FROM g0),
comb AS (SELECT chrom, grp, string_agg(DISTINCT CAST(src AS VARCHAR), ',' ORDER BY CAST(src AS VARCHAR)) AS combination, count(DISTINCT src) AS n_src, count(*) AS n_calls, min(pos) AS pos FROM br_calls JOIN g1 USING (chrom, pos) GROUP BY chrom, grp)"""


@query("W1_cluster_by_distance", f"WITH {_GROUPS} SELECT c.*, grp FROM br_calls c JOIN g1 USING (chrom, pos)")
def _(v: Views) -> DataFrame:
    return variants.cluster_by_distance(v("br_calls"), 2)


@query(
    "W2_snp_gap_filter",
    f"""SELECT s.var_id, EXISTS (SELECT 1 FROM br_variants i WHERE length(i.ref) <> length(i.alt) AND length(s.ref) = length(s.alt) AND i.chrom = s.chrom AND s.pos BETWEEN i.pos + 1 - 10 AND i.pos + length(i.ref) + 9) AS near_indel FROM br_variants s""",
)
def _(v: Views) -> DataFrame:
    return variants.snp_gap_filter(v("br_variants"), 10).select("var_id", "near_indel")


@query(
    "W3_indel_gap_filter",
    f"""WITH i AS (SELECT *, pos + 1 AS s, pos + abs(length(alt) - length(ref)) AS e FROM br_variants WHERE {_INDEL}),
a AS (SELECT *, max(e) OVER (PARTITION BY chrom ORDER BY s, var_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM i),
b AS (SELECT *, sum(CASE WHEN r IS NULL OR r < s - 40 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY s, var_id) AS g FROM a)
SELECT var_id, row_number() OVER (PARTITION BY chrom, g ORDER BY dp DESC, pos, var_id) > 1 AS loses FROM b""",
)
def _(v: Views) -> DataFrame:
    return variants.indel_gap_filter(v("br_variants"), 40, "dp").select("var_id", "loses")


@query(
    "W4_snp_cluster_filter",
    f"""WITH s AS (SELECT * FROM br_variants WHERE NOT {_INDEL}), c AS (SELECT *, count(*) OVER (PARTITION BY chrom ORDER BY pos RANGE BETWEEN CURRENT ROW AND 49 FOLLOWING) AS n FROM s)
SELECT var_id, max(CASE WHEN n >= 5 THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY pos RANGE BETWEEN 49 PRECEDING AND CURRENT ROW) = 1 AS clustered FROM c""",
)
def _(v: Views) -> DataFrame:
    return variants.snp_cluster_filter(v("br_variants").where(~variants.is_indel()), 5, 50).select("var_id", "clustered")


@query("W10_dedupe_by_depth", "SELECT chrom, pos, var_id, dp FROM br_variants QUALIFY row_number() OVER (PARTITION BY chrom, pos ORDER BY CASE WHEN dp > 0 THEN dp ELSE 0 END DESC, var_id) = 1")
def _(v: Views) -> DataFrame:
    return variants.dedupe_by_depth(v("br_variants"), "dp", "var_id").select("chrom", "pos", "var_id", "dp")


@query(
    "W16_consistency",
    f"""WITH r AS (SELECT chrom, pos, max(pos) OVER (PARTITION BY chrom ORDER BY var_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM br_variants)
SELECT 'duplicate' AS problem, chrom, pos, {B('count(*)')} AS n FROM br_variants GROUP BY chrom, pos HAVING count(*) > 1 UNION ALL SELECT 'unsorted', chrom, pos, count(*) FROM r WHERE pos < reach GROUP BY chrom, pos""",
)
def _(v: Views) -> DataFrame:
    return variants.consistency(v("br_variants"), "var_id")


@query("J8_liftover", "SELECT var_id, 'new' || chrom AS chrom, pos + 100 AS pos FROM br_variants WHERE pos % 7 <> 0")
def _(v: Views) -> DataFrame:
    mapping = v("br_variants").select("chrom", "pos").distinct().withColumns({"new_chrom": F.when(F.col("pos") % 7 == 0, "skip").otherwise(F.concat(F.lit("new"), "chrom")), "new_pos": F.col("pos") + 100})
    return variants.liftover(v("br_variants"), mapping).select("var_id", "chrom", "pos")


@query(
    "A15_variant_counts",
    f"""WITH x AS (SELECT *, 'all' AS grp, '' AS val FROM br_variants UNION ALL SELECT *, 'filter', filt FROM br_variants UNION ALL SELECT *, 'qual', CAST({B("floor(qual / 20.0)")} * 20 AS VARCHAR) FROM br_variants)
SELECT grp, val, {B("count(*)")} AS n, {B(f"count(*) FILTER (NOT {_INDEL})")} AS snps, {B(f"count(*) FILTER ({_INDEL})")} AS indels, {B(f"count(*) FILTER ({_TS})")} AS transitions FROM x GROUP BY grp, val""",
)
def _(v: Views) -> DataFrame:
    return variants.variant_counts(v("br_variants"), "filt", 20)


@query(
    "A41_neighbour_intervals",
    f"""WITH p AS (SELECT chrom, pos, max(qual) AS v FROM br_variants GROUP BY chrom, pos), b AS (SELECT *, pos - lag(pos) OVER (PARTITION BY chrom ORDER BY pos) AS gap FROM p)
SELECT {B("count(*)")} AS n, {B("count(*) FILTER (v > 50)")} AS n_high, {B("sum(gap) FILTER (v > 50)")} AS length_high FROM b WHERE gap IS NOT NULL""",
)
def _(v: Views) -> DataFrame:
    return variants.neighbour_intervals(v("br_variants"), 50, "qual")


# Call sets and genotypes


@query("A24_venn_counts", f"WITH {_GROUPS} SELECT combination, {B('count(*)')} AS sites, {B('sum(n_calls - n_src)')} AS lost FROM comb GROUP BY combination")
def _(v: Views) -> DataFrame:
    return calls.venn_counts(v("br_calls"), 2)


@query("U1_isec_at_least_two", f"WITH {_GROUPS} SELECT chrom, pos, combination FROM comb WHERE n_src >= 2")
def _(v: Views) -> DataFrame:
    return calls.isec(v("br_calls"), 2, "+", 2)


@query("U1_complement", f"WITH {_GROUPS} SELECT chrom, pos FROM comb WHERE combination = '0'")
def _(v: Views) -> DataFrame:
    return calls.complement(v("br_calls"), 0, 2)


@query(
    "U4_merge_sets",
    """WITH w AS (SELECT *, CASE src WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END AS w FROM br_calls)
SELECT chrom, pos, allele, string_agg(DISTINCT CAST(src AS VARCHAR), ',' ORDER BY CAST(src AS VARCHAR)) AS sf, round(sum(qual * w) FILTER (qual > 0) / sum(w) FILTER (qual > 0), 6) AS qual FROM w GROUP BY chrom, pos, allele""",
)
def _(v: Views) -> DataFrame:
    return calls.merge_sets(v("br_calls"), {0: 3, 1: 2})


@query(
    "U5_list_status",
    f"""WITH a AS (SELECT concat(chrom, ':', pos) AS k, count(*) AS n FROM br_calls WHERE src = 0 GROUP BY 1), b AS (SELECT concat(chrom, ':', pos) AS k, count(*) AS n FROM br_calls WHERE src = 1 GROUP BY 1)
SELECT k, {B("coalesce(a.n, 0)")} AS n1, {B("coalesce(b.n, 0)")} AS n2, CASE WHEN b.n IS NULL THEN 'UNIQ1' WHEN a.n IS NULL THEN 'UNIQ2' ELSE 'ISECT' END AS status FROM a FULL JOIN b USING (k)""",
)
def _(v: Views) -> DataFrame:
    keyed = v("br_calls").withColumn("k", F.concat("chrom", F.lit(":"), "pos"))
    return calls.list_status(keyed.where("src = 0"), keyed.where("src = 1"), "k")


@query(
    "A21_inbreeding",
    f"""WITH g AS (SELECT site, CASE WHEN site % 40 = 3 AND a1 = 1 THEN 2 ELSE a1 END AS a1, a2 FROM br_genotypes), c AS (SELECT site, 2 * count(*) AS n, count(*) FILTER (a1 + a2 = 0) AS hom1, count(*) FILTER (a1 <> a2) AS het, count(*) FILTER (a1 + a2 = 2) AS hom2 FROM g
 WHERE a1 IS NOT NULL AND a2 IS NOT NULL GROUP BY site HAVING max(greatest(a1, a2)) < 2), p AS (SELECT *, (het + 2.0 * hom2) / n AS p FROM c),
f AS (SELECT *, (het + 2 * hom2) AS a FROM p), h AS (SELECT site, het, unnest(range(a % 2, least(a, n - a) + 1, 2)) AS k, n, a FROM f),
w AS (SELECT *, k * ln(2) - lgamma((a - k) / 2 + 1) - lgamma(k + 1) - lgamma((n - a - k) / 2 + 1) AS l FROM h), o AS (SELECT site, max(l) FILTER (k = het) AS seen, max(l) AS top FROM w GROUP BY site),
q AS (SELECT site, sum(exp(l - top)) FILTER (l - seen <= 1e-9) / sum(exp(l - top)) AS p FROM w JOIN o USING (site) GROUP BY site)
SELECT site, {B("n")} AS n, {B("hom1")} AS hom1, {B("het")} AS het, {B("hom2")} AS hom2, round(CASE WHEN f.p > 0 AND f.p < 1 THEN 1 - (2.0 * het / n) / (2 * f.p * (1 - f.p)) END, 6) AS icf, round(q.p, 6) AS p FROM f JOIN q USING (site)""",
)
def _(v: Views) -> DataFrame:
    gt = v("br_genotypes").withColumn("a1", F.when((F.col("site") % 40 == 3) & (F.col("a1") == 1), F.lit(2).cast("long")).otherwise(F.col("a1")))
    return genotypes.hwe_exact(calls.inbreeding(gt))


@query("A48_recurrence", f"SELECT site, {B('count(DISTINCT sample)')} AS n_samples FROM br_genotypes WHERE a1 + a2 > 0 GROUP BY site")
def _(v: Views) -> DataFrame:
    return calls.recurrence(v("br_genotypes"))


@query("X4_decode_genotypes", "SELECT site, sample, CASE WHEN a1 IS NULL OR a2 IS NULL THEN './.' ELSE concat(a1, CASE WHEN phased = 1 THEN '|' ELSE '/' END, a2) END AS gt FROM br_genotypes")
def _(v: Views) -> DataFrame:
    return calls.decode_genotypes(v("br_genotypes")).select("site", "sample", "gt")


# Versioned tables

_LATEST = "latest AS (SELECT * FROM br_history QUALIFY row_number() OVER (PARTITION BY obj_id ORDER BY changed DESC, row_id DESC) = 1)"
_NOON = "TIMESTAMP '2024-01-10 00:00:00'"


def _when():
    return F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")


@query("M1_latest", f"WITH {_LATEST} SELECT obj_id, row_id, state, processed FROM latest")
def _(v: Views) -> DataFrame:
    return history.latest(v("br_history")).select("obj_id", "row_id", "state", "processed")


@query("M2_as_of", f"SELECT obj_id, row_id, state FROM br_history WHERE changed < {_NOON} QUALIFY row_number() OVER (PARTITION BY obj_id ORDER BY changed DESC, row_id DESC) = 1")
def _(v: Views) -> DataFrame:
    return history.as_of(v("br_history"), _when()).select("obj_id", "row_id", "state")


@query("M4_versions", f"SELECT obj_id, row_id, {B('row_number() OVER (PARTITION BY obj_id ORDER BY changed, row_id)')} AS version FROM br_history")
def _(v: Views) -> DataFrame:
    return history.versions(v("br_history")).select("obj_id", "row_id", "version")


@query("M5_changed_since", f"WITH {_LATEST}, old AS (SELECT obj_id, state FROM br_history WHERE changed < {_NOON} QUALIFY row_number() OVER (PARTITION BY obj_id ORDER BY changed DESC, row_id DESC) = 1) SELECT obj_id, latest.state AS now, old.state AS before FROM latest LEFT JOIN old USING (obj_id) WHERE latest.state IS DISTINCT FROM old.state")
def _(v: Views) -> DataFrame:
    return history.changed_since(v("br_history"), _when())


@query("M7_ambiguous_values", f"SELECT state, {B('count(DISTINCT obj_id)')} AS n_keys FROM br_history GROUP BY state HAVING count(DISTINCT obj_id) > 1")
def _(v: Views) -> DataFrame:
    return history.ambiguous_values(v("br_history"), "state", "obj_id")


@query("W7_state_change", f"WITH {_LATEST} SELECT obj_id, l.state AS current, max(h.changed) FILTER (h.state IS DISTINCT FROM l.state) AS last_other FROM br_history h JOIN latest l USING (obj_id) GROUP BY obj_id, l.state")
def _(v: Views) -> DataFrame:
    return history.state_change(v("br_history"))


@query("W7_was_processed", "WITH o AS (SELECT obj_id, max({'changed': changed, 'row_id': row_id}) FILTER (processed & 4 = 0) AS f FROM br_history GROUP BY obj_id) SELECT obj_id, min(changed) AS since FROM br_history JOIN o USING (obj_id) WHERE f IS NULL OR {'changed': changed, 'row_id': row_id} > f GROUP BY obj_id")
def _(v: Views) -> DataFrame:
    return history.was_processed(v("br_history"), 4)


@query("W8_first_seen", "SELECT obj_id, min(changed) AS first_seen FROM br_history GROUP BY obj_id")
def _(v: Views) -> DataFrame:
    return history.first_seen(v("br_history"))


# Hierarchy and reports


@query("J10_missing_children", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(v: Views) -> DataFrame:
    return reports.missing_children(v("customer").select("c_custkey"), v("orders"), "c_custkey", "o_custkey")


@query("A47_most_common_value", f"SELECT sample, {B('n')} AS n, qc_status FROM (SELECT sample, qc_status, count(*) AS n FROM br_lanes GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY sample ORDER BY n DESC, qc_status) = 1")
def _(v: Views) -> DataFrame:
    return reports.most_common_value(v("br_lanes"), "sample", "qc_status")


@query("M6_descendants", "SELECT 'sample' AS level, sample AS id FROM br_lanes WHERE project = 'ASIA' UNION SELECT 'library', CAST(library_id AS VARCHAR) FROM br_lanes WHERE project = 'ASIA' UNION SELECT 'lane', CAST(lane_id AS VARCHAR) FROM br_lanes WHERE project = 'ASIA'")
def _(v: Views) -> DataFrame:
    return reports.descendants(v("br_lanes"), "ASIA")


@query("M9_paths", "SELECT lane_id, concat_ws('/', project, translate(sample, ' ', '_'), library_id, lane_id) AS path FROM br_lanes")
def _(v: Views) -> DataFrame:
    return reports.paths(v("br_lanes"))


@query("U6_sync_tables", "SELECT o_custkey AS k, 'insert' AS action FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0) GROUP BY 1 UNION ALL SELECT c_custkey, 'delete' FROM customer WHERE c_custkey % 4 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)")
def _(v: Views) -> DataFrame:
    return reports.sync_tables(v("orders").select(F.col("o_custkey").alias("k")), v("customer").where("c_custkey % 4 <> 0").select(F.col("c_custkey").alias("k")), "k")


@query("J19_imported_counts", f"WITH a AS (SELECT rg, count(*) AS n, sum(seq_len) AS b FROM br_reads GROUP BY rg), c AS (SELECT rg, count(*) AS n, sum(seq_len) AS b FROM br_reads WHERE rg <> 'rg3' OR flag & 4 = 0 GROUP BY rg) SELECT rg, {B('a.n')} AS n_reads, {B('a.b')} AS n_bases, {B('c.n')} AS new_reads, {B('c.b')} AS new_bases, a.n IS NOT DISTINCT FROM c.n AND a.b IS NOT DISTINCT FROM c.b AS agree FROM a FULL JOIN c USING (rg)")
def _(v: Views) -> DataFrame:
    r = v("br_reads")
    count = lambda df, n, b: df.groupBy("rg").agg(F.count("*").alias(n), F.sum("seq_len").alias(b))
    return reports.imported_counts(count(r, "n_reads", "n_bases"), count(r.where("rg <> 'rg3' OR flag & 4 = 0"), "new_reads", "new_bases"), "rg")


@query("O6_page", "SELECT var_id, chrom, pos FROM br_variants WHERE chrom = 'chr3' ORDER BY pos, var_id LIMIT 25 OFFSET 50")
def _(v: Views) -> DataFrame:
    return reports.page(v("br_variants").where("chrom = 'chr3'").select("var_id", "chrom", "pos"), ["pos", "var_id"], 50, 25)


@query("O1_natural_order", "SELECT * FROM br_variants")
def _(v: Views) -> DataFrame:
    return reports.natural_order(v("br_variants"))


# Sequences, qualities, ranks

_COUNT = "length(seq) - length(translate(seq, '{}', ''))"


@query("A7_gc_histogram", f"SELECT {B(_COUNT.format('GC'))} AS gc, {B('count(*)')} AS n FROM br_fastq GROUP BY 1")
def _(v: Views) -> DataFrame:
    return sequences.gc_histogram(v("br_fastq"))


@query("P15_length_filter", "SELECT rec_no, name FROM br_fastq WHERE length(seq) >= 1000")
def _(v: Views) -> DataFrame:
    return sequences.length_filter(v("br_fastq"), 1000).select("rec_no", "name")


@query("P16_id_list_filter", "SELECT rec_no, name FROM br_fastq WHERE name NOT IN (SELECT concat('d', l_orderkey) FROM lineitem WHERE l_quantity > 25)")
def _(v: Views) -> DataFrame:
    ids = v("lineitem").where("l_quantity > 25").select(F.concat(F.lit("d"), "l_orderkey").alias("name"))
    return sequences.id_list_filter(v("br_fastq"), ids, keep=False).select("rec_no", "name")


@query(
    "A31_assembly_stats",
    f"""WITH o AS (SELECT length(seq) AS len, row_number() OVER (ORDER BY length(seq) DESC, rec_no) AS l, sum(length(seq)) OVER (ORDER BY length(seq) DESC, rec_no) AS cum, sum(length(seq)) OVER () AS total FROM br_fastq)
SELECT {B("p")} AS percent, {B("max(len) FILTER (cum * 100 >= total * p)")} AS n_len, {B("min(l) FILTER (cum * 100 >= total * p)")} AS l_count FROM o CROSS JOIN (VALUES (50), (75), (90)) x(p) GROUP BY p""",
)
def _(v: Views) -> DataFrame:
    return sequences.assembly_stats(v("br_fastq"), [50, 75, 90])


@query("A32_gc_windows", f"WITH w AS (SELECT substr(seq, k * 60 + 1, 60) AS seq FROM (SELECT seq, unnest(range(CAST(floor(length(seq) / 60.0) AS BIGINT))) AS k FROM br_fastq)) SELECT {B(_COUNT.format('GC'))} AS gc, {B('count(*)')} AS n FROM w GROUP BY 1")
def _(v: Views) -> DataFrame:
    return sequences.gc_windows(v("br_fastq"), 60)


@query(
    "A44_clip_point",
    """WITH s AS (SELECT regexp_replace(seq, '[^ACGT]', 'N', 'gs') AS s FROM br_fastq), f AS (SELECT s, strpos(s, 'N') AS a FROM s), p AS (SELECT CASE WHEN a > 0 AND strpos(substr(s, a + 1), 'N') > 0 THEN a + strpos(substr(s, a + 1), 'N') ELSE 0 END AS p FROM f),
c AS (SELECT p, count(*) AS n FROM p GROUP BY p), r AS (SELECT p, sum(n) OVER (ORDER BY p) AS cum FROM c WHERE p > 0) SELECT CAST(coalesce(min(p) - 1, -1) AS BIGINT) AS clip FROM r WHERE cum > 0.9 * (SELECT sum(n) FROM c)""",
)
def _(v: Views) -> DataFrame:
    return sequences.clip_point(v("br_fastq"))


@query("P18_evenly_spaced", "WITH n AS (SELECT greatest(1, count(*) // 100) AS k FROM br_fastq) SELECT rec_no, name FROM br_fastq CROSS JOIN n WHERE rec_no % k = 0 AND rec_no > 0")
def _(v: Views) -> DataFrame:
    return variants.evenly_spaced(v("br_fastq"), "rec_no", 100).select("rec_no", "name")


@query("W9_rank_average", "SELECT var_id, qual, round(rank() OVER (ORDER BY qual) + (count(*) OVER (PARTITION BY qual) - 1) / 2.0, 6) AS rank_avg FROM br_variants")
def _(v: Views) -> DataFrame:
    return stats.rank_average(v("br_variants").select("var_id", "qual"), "qual").select("var_id", "qual", "rank_avg")


# Streams, in their batch form (tests run them as streams)


def _changes(v: Views) -> DataFrame:
    return v("br_history").withColumn("changed", F.col("changed").cast("timestamp"))


@query("T1_new_items_per_window", f"WITH f AS (SELECT obj_id, min(changed) AS c FROM br_history GROUP BY obj_id) SELECT CAST(time_bucket(INTERVAL 7 DAY, c, TIMESTAMP '1970-01-01') AS TIMESTAMP) AS window_start, {B('count(*)')} AS n FROM f GROUP BY 1")
def _(v: Views) -> DataFrame:
    return tracking.new_items_per_window(_changes(v)).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("T2_latest_state", f"WITH {_LATEST} SELECT obj_id, state, changed FROM latest")
def _(v: Views) -> DataFrame:
    return tracking.latest_state(_changes(v)).withColumn("changed", F.col("changed").cast("timestamp_ntz"))


@query(
    "T3_activity_sessions",
    f"""WITH a AS (SELECT obj_id, changed, CASE WHEN changed - lag(changed) OVER (PARTITION BY obj_id ORDER BY changed) < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS f FROM br_history), b AS (SELECT *, sum(f) OVER (PARTITION BY obj_id ORDER BY changed ROWS UNBOUNDED PRECEDING) AS g FROM a)
SELECT obj_id, min(changed) AS session_start, max(changed) + INTERVAL 12 HOUR AS session_end, {B("count(*)")} AS n FROM b GROUP BY obj_id, g""",
)
def _(v: Views) -> DataFrame:
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
    return tracking.activity_sessions(_changes(v), "12 hours").withColumns(ntz)


# Further operators


@query("O4_top_rows", f"SELECT var_id, chrom, qual, {B('place')} AS place FROM (SELECT *, row_number() OVER (PARTITION BY chrom ORDER BY qual DESC, var_id) AS place FROM br_variants) WHERE place <= 10")
def _(v: Views) -> DataFrame:
    return variants.top_rows(v("br_variants"), "chrom", [F.desc("qual"), "var_id"], 10).select("var_id", "chrom", "qual", "place")


@query("W11_top_hits_per_read", f"SELECT qname, read_id, {B('place')} AS place FROM (SELECT *, row_number() OVER (PARTITION BY qname ORDER BY read_id, pos, chrom) AS place FROM br_reads) WHERE place <= 2")
def _(v: Views) -> DataFrame:
    return variants.top_rows(v("br_reads"), "qname", ["read_id", "pos", "chrom"], 2).select("qname", "read_id", "place")


@query("A57_tstv_by_bin", f"SELECT filt, {B('floor(qual / 25.0) * 25')} AS bin, {B(f'count(*) FILTER (NOT {_INDEL} AND ref <> alt AND {_TS})')} AS ts, {B(f'count(*) FILTER (NOT {_INDEL} AND ref <> alt AND NOT {_TS})')} AS tv FROM br_variants GROUP BY 1, 2")
def _(v: Views) -> DataFrame:
    return variants.tstv_by_bin(v("br_variants"), "filt", "qual", 25)


@query("P3_sample_subset", "SELECT * FROM br_genotypes WHERE sample NOT IN ('S1', 'S2')")
def _(v: Views) -> DataFrame:
    return calls.sample_subset(v("br_genotypes"), ["S1", "S2"], exclude=True)


_CELL = "coalesce(max(CASE WHEN sample = '{0}' THEN CASE WHEN a1 IS NULL OR a2 IS NULL THEN 'NN' ELSE concat(a1, a2) END END), 'NN') AS {0}"


@query("K6_wide_genotypes", "SELECT site, " + ", ".join(_CELL.format(f"S{i}") for i in range(12)) + " FROM br_genotypes GROUP BY site")
def _(v: Views) -> DataFrame:
    return calls.wide_genotypes(v("br_genotypes"), [f"S{i}" for i in range(12)])


@query("W18_single_hits", "SELECT * FROM br_reads WHERE qname IN (SELECT qname FROM br_reads GROUP BY qname HAVING count(*) = 1)")
def _(v: Views) -> DataFrame:
    return reads.single_hits(v("br_reads"))


@query("J16_similar_alignments", "WITH a AS (SELECT qname, chrom, pos FROM br_reads WHERE mapq > 0), b AS (SELECT qname, chrom, CASE WHEN nm = 0 THEN pos + 1 ELSE pos END AS pos FROM br_reads WHERE mapq > 0) SELECT *, 'a' AS side FROM (FROM a EXCEPT ALL FROM b) UNION ALL SELECT *, 'b' FROM (FROM b EXCEPT ALL FROM a)")
def _(v: Views) -> DataFrame:
    moved = v("br_reads").withColumn("pos", F.when(F.col("nm") == 0, F.col("pos") + 1).otherwise(F.col("pos")))
    return reads.similar_alignments(v("br_reads"), moved)


@query("U7_distinct_ids", "SELECT DISTINCT obj_id FROM br_history")
def _(v: Views) -> DataFrame:
    return reports.distinct_ids(v("br_history"), "obj_id")


from . import catalog_forms, catalog_genotypes, catalog_merging, catalog_reads, catalog_records, catalog_reference, catalog_reports, catalog_sources, catalog_variants  # noqa: E402, F401  (they add their queries)
