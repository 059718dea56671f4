"""Queries of the operators on records and tags; catalog.py reads this module."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import B, Views, query
from .operators import records

_GT = "concat(coalesce(CAST(a1 AS VARCHAR), '.'), '/', coalesce(CAST(a2 AS VARCHAR), '.'))"


def _tagged(v: Views) -> DataFrame:
    return v("br_variants").withColumn("info", F.expr("map('DP', string(dp), 'QS', string(qual), 'DB', '')"))


def _tagged_reads(v: Views) -> DataFrame:
    return v("br_reads").select("read_id", F.expr("map('RG', rg, 'NM', string(nm), 'MQ', string(mapq)) AS tags"))


def _whole_reads(v: Views) -> DataFrame:
    return v("br_fastq").selectExpr("name AS qname", "int(CASE WHEN rec_no % 3 = 0 THEN 81 WHEN rec_no % 3 = 1 THEN 129 ELSE 0 END) AS flag", "seq", "translate(seq, 'ACGT', 'IHGF') AS qual")


@query("P1_query_fields", "WITH c AS (SELECT site, " + ", ".join(f"max(CASE WHEN sample = 'S{i}' THEN {_GT} END) AS s{i}" for i in (0, 1, 2)) + " FROM br_genotypes GROUP BY site) SELECT var_id, concat_ws(chr(9), chrom, pos, ref, alt, dp, coalesce(s0, '.'), coalesce(s1, '.'), coalesce(s2, '.')) AS line FROM br_variants LEFT JOIN c ON site = var_id")
def _(v: Views) -> DataFrame:
    return records.query_fields(v("br_variants"), v("br_genotypes"), "var_id", [F.col(c) for c in ("chrom", "pos", "ref", "alt", "dp")], ["S0", "S1", "S2"])


@query(
    "P6_threshold_filters",
    """SELECT var_id, CASE WHEN f = '' THEN 'PASS' ELSE f END AS filters FROM (SELECT var_id, concat_ws(';', CASE WHEN qual < 10 THEN 'Qual' END, CASE WHEN dp < 2 THEN 'MinDP' END, CASE WHEN qual % 20 < 10 THEN 'MinMQ' END,
 CASE WHEN dp > 40 THEN 'MaxDP' END, CASE WHEN dp * 3 < 15 THEN 'StrandBias' END, CASE WHEN var_id % 7 = 0 THEN 'EndDistBias' END) AS f FROM br_variants)""",
)
def _(v: Views) -> DataFrame:
    typed = v("br_variants").withColumns({"mq": F.expr("qual % 20"), "pv4": F.expr("array(dp * 3 / 100D, 0D, 0D, CASE WHEN var_id % 7 = 0 THEN 0.00001D ELSE 1D END)")})
    return records.threshold_filters(typed, {"MaxDP": 40, "StrandBias": 0.15}).select("var_id", "filters")


@query("P9_set_info", "SELECT var_id, concat('AC=2;DB;DP=', dp) AS info FROM br_variants")
def _(v: Views) -> DataFrame:
    return _tagged(v).select("var_id", records.info_text(records.set_info(F.col("info"), {"QS": None, "AC": "2", "DB": ""})).alias("info"))


@query("P10_drop_tags", "SELECT var_id, NULL::BIGINT AS qual, concat('DP=', dp) AS info FROM br_variants")
def _(v: Views) -> DataFrame:
    return records.drop_tags(_tagged(v), ["QS", "DB"], ["qual"]).select("var_id", "qual", records.info_text(F.col("info")).alias("info"))


@query("P17_reorder_columns", "SELECT pos, chrom, NULL::VARCHAR AS id, ref, dp FROM br_variants")
def _(v: Views) -> DataFrame:
    return records.reorder_columns(v("br_variants"), [("pos", "long"), ("chrom", "string"), ("id", "string"), ("ref", "string"), ("dp", "long")])


@query("P19_rename_from_map", "SELECT src, coalesce(r_name, chrom) AS chrom, pos, allele, qual FROM br_calls LEFT JOIN region ON chrom = concat('chr', r_regionkey)")
def _(v: Views) -> DataFrame:
    return records.rename_from_map(v("br_calls"), "chrom", v("region").selectExpr("concat('chr', r_regionkey) AS old", "r_name AS new"))


@query("P21_tags_of_reads", "SELECT read_id, concat('MQ=', mapq, ';RG=all') AS tags FROM br_reads")
def _(v: Views) -> DataFrame:
    return records.replace_readgroup(records.strip_tags(_tagged_reads(v), ["NM"]), "all").select("read_id", records.info_text(F.col("tags")).alias("tags"))


@query("P24_reads_to_fastq", f"SELECT name, {B('CASE rec_no % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END')} AS mate, CASE WHEN rec_no % 3 = 0 THEN reverse(translate(seq, 'ACGT', 'TGCA')) ELSE seq END AS seq, CASE WHEN rec_no % 3 = 0 THEN reverse(translate(seq, 'ACGT', 'IHGF')) ELSE translate(seq, 'ACGT', 'IHGF') END AS qual FROM br_fastq")
def _(v: Views) -> DataFrame:
    return records.reads_to_fastq(_whole_reads(v))


@query("P24_split_paired", f"SELECT name, {B('1')} AS mate, substr(seq, 1, 40) AS seq, substr(seq, 1, 40) AS qual FROM br_fastq UNION ALL SELECT name, {B('2')}, substr(seq, 41), substr(seq, 41) FROM br_fastq")
def _(v: Views) -> DataFrame:
    return records.split_paired(v("br_fastq").withColumn("qual", F.col("seq")), 40)


@query("P25_concatenate_mates", "SELECT a.rec_no, a.name, concat(a.seq, 'NN', b.seq) AS seq, concat(a.seq, '!!', b.seq) AS qual FROM br_fastq a JOIN br_fastq b ON b.rec_no = a.rec_no + 1")
def _(v: Views) -> DataFrame:
    q = v("br_fastq").withColumn("qual", F.col("seq"))
    return records.concatenate_mates(q, q.withColumn("rec_no", F.col("rec_no") - 1))


_REGIONS = "regions AS (SELECT DISTINCT chrom, pos // 100 * 100 + 1 AS start_pos, pos // 100 * 100 + 60 AS end_pos, pos // 100 AS region_id FROM br_calls WHERE src = 0)"


def _regions(v: Views) -> DataFrame:
    return v("br_calls").where("src = 0").selectExpr("chrom", "pos div 100 * 100 + 1 AS start_pos", "pos div 100 * 100 + 60 AS end_pos", "pos div 100 AS region_id").distinct()


@query("W15_forward_in_region", f"WITH {_REGIONS} SELECT var_id, v.chrom, pos, region_id FROM br_variants v LEFT JOIN regions r ON r.chrom = v.chrom AND pos BETWEEN start_pos AND end_pos")
def _(v: Views) -> DataFrame:
    return records.forward_in_region(v("br_variants"), _regions(v), "var_id").select("var_id", "chrom", "pos", "region_id")


@query(
    "J9_consequence_join",
    f"""WITH {_REGIONS}, m AS (SELECT n_nationkey % 5 AS f, n_nationkey // 5 AS t, n_nationkey AS score FROM nation),
c AS (SELECT p_partkey * 2 AS var_id, concat('G', p_size % 9) AS gene, p_type AS consequence, p_size % 5 AS f, p_size % 7 AS t FROM part),
g AS (SELECT var_id, string_agg(DISTINCT concat(gene, ':', consequence), '+' ORDER BY concat(gene, ':', consequence)) AS consequences, max(score) AS substitution FROM c LEFT JOIN m USING (f, t) GROUP BY var_id)
SELECT var_id, consequences, {B('substitution')} AS substitution, region_id AS position_score FROM br_variants v LEFT JOIN g USING (var_id) LEFT JOIN regions r ON r.chrom = v.chrom AND pos BETWEEN start_pos AND end_pos""",
)
def _(v: Views) -> DataFrame:
    matrix = v("nation").selectExpr("n_nationkey % 5 AS aa_from", "n_nationkey div 5 AS aa_to", "n_nationkey AS score")
    found = v("part").selectExpr("p_partkey * 2 AS var_id", "concat('G', p_size % 9) AS gene", "p_type AS consequence", "p_size % 5 AS aa_from", "p_size % 7 AS aa_to")
    joined = records.consequence_join(v("br_variants"), found, matrix, _regions(v).withColumnRenamed("region_id", "value"), ["var_id"])
    return joined.select("var_id", "consequences", "substitution", "position_score")


@query(
    "C7_locus_query",
    f"""WITH h AS (SELECT var_id, pos, ref, alt, concat('G', dp % 9) AS gene, CASE WHEN dp % 2 = 0 THEN 'stop' ELSE 'missense' END AS type FROM br_variants WHERE chrom = 'chr2' AND pos BETWEEN 1 AND 4000
 UNION ALL SELECT var_id, pos, ref, alt, 'H', 'intron' FROM br_variants WHERE chrom = 'chr2' AND pos BETWEEN 1 AND 4000),
c AS (SELECT site, max(greatest(a1, a2)) AS most, {", ".join(f"max(CASE WHEN sample = '{s}' THEN concat({_GT}, CASE WHEN dp >= 20 THEN '+' ELSE '-' END) END) AS {s}" for s in ("S1", "S5"))} FROM br_genotypes WHERE sample IN ('S1', 'S5') GROUP BY site)
SELECT var_id, pos, ref, alt, gene, type, S1, S5 FROM h JOIN c ON site = var_id WHERE most > 0 AND type IN ('stop', 'intron')""",
)
def _(v: Views) -> DataFrame:
    made = v("br_variants").withColumn("csq", F.expr("concat('G', dp % 9, '|', CASE WHEN dp % 2 = 0 THEN 'stop' ELSE 'missense' END, ',H|intron')"))
    return records.locus_query(made, v("br_genotypes"), "chr2", 1, 4000, ["S1", "S5"], ["stop", "intron"], 20)


@query("O5_largest_first", "SELECT iv_id, chrom, start_pos, end_pos, strand, end_pos - start_pos + 1 AS length FROM br_intervals")
def _(v: Views) -> DataFrame:
    return records.largest_first(v("br_intervals"))


@query("U2_venn_partition", f"SELECT string_agg(DISTINCT src, ',' ORDER BY src) AS combination, chrom, pos, {B('count(*)')} AS n_calls FROM (SELECT CAST(src AS VARCHAR) AS src, chrom, pos FROM br_calls) GROUP BY chrom, pos")
def _(v: Views) -> DataFrame:
    return records.venn_partition(v("br_calls"))


@query("U3_concat_sets", "WITH x AS (SELECT var_id, chrom, pos, dp, alt FROM br_variants UNION ALL SELECT var_id + 1000000, chrom, pos, dp + 5, NULL FROM br_variants WHERE pos % 3 = 0) SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY chrom, pos ORDER BY dp DESC, var_id) = 1")
def _(v: Views) -> DataFrame:
    first = v("br_variants").select("var_id", "chrom", "pos", "dp", "alt")
    second = v("br_variants").where("pos % 3 = 0").selectExpr("var_id + 1000000 AS var_id", "chrom", "pos", "dp + 5 AS dp")
    return records.concat_sets([first, second], "dp", "var_id")


@query("A30_pileup_strand_depth", f"SELECT chrom, pos, {B('dp + 2')} AS forward, {B('qual + 1')} AS reverse FROM br_variants")
def _(v: Views) -> DataFrame:
    bases = "concat('^,A', repeat('.', int(dp)), '+', int(dp), repeat('a', int(dp)), '^+.$', repeat(',', int(qual)), '-2GTt*') AS bases"
    return records.pileup_strand_depth(v("br_variants").selectExpr("chrom", "pos", bases))


@query("A49_annotation_quantiles", "SELECT a AS annotation, round(CAST(quantile_disc(x, 0.1) AS DOUBLE), 6) AS low, round(CAST(quantile_disc(x, 0.9) AS DOUBLE), 6) AS high FROM (SELECT 'qual' AS a, qual AS x FROM br_variants UNION ALL SELECT 'dp', dp FROM br_variants) GROUP BY a")
def _(v: Views) -> DataFrame:
    return records.annotation_quantiles(v("br_variants"), ["qual", "dp"], 0.1, 0.9, 1000000)


@query("A59_balanced_sample", f"SELECT var_id, filt, {B('least(floor(qual / 100.0 * 5), 4)')} AS bin FROM br_variants QUALIFY row_number() OVER (PARTITION BY filt, least(floor(qual / 100.0 * 5), 4) ORDER BY md5(concat('0', var_id)), var_id) <= 4")
def _(v: Views) -> DataFrame:
    return records.balanced_sample(v("br_variants"), "filt", F.col("qual") / 100, 5, 4, "var_id").select("var_id", "filt", "bin")


_USED = "SELECT site, qual, 'dp' AS annotation, dp % 3 = 0 AS used FROM (SELECT var_id AS site, * FROM br_variants) UNION ALL SELECT var_id, qual, 'vdb', dp % 5 = 0 FROM br_variants"


@query(
    "A60_feature_usefulness",
    f"""WITH x AS ({_USED}), r AS (SELECT *, rank() OVER (PARTITION BY annotation ORDER BY qual) + (count(*) OVER (PARTITION BY annotation, qual) - 1) / 2.0 AS k FROM x),
s AS (SELECT annotation, count(*) FILTER (used) AS n1, count(*) FILTER (NOT used) AS n2, sum(k) FILTER (used) AS ranks FROM r GROUP BY annotation), z AS (SELECT *, (ranks - n1 * (n1 + 1) / 2.0 - n1 * n2 / 2.0) / sqrt(n1 * n2 * (n1 + n2 + 1) / 12.0) AS z FROM s)
SELECT annotation, {B('n1')} AS n_with, {B('n2')} AS n_without, round(CAST(z AS DOUBLE), 6) AS z, CASE WHEN z > 1.96 THEN 'yes' WHEN z < -1.96 THEN 'no' ELSE 'unsure' END AS useful FROM z""",
)
def _(v: Views) -> DataFrame:
    runs = v("br_variants").selectExpr("qual AS accuracy", "array_compact(array(CASE WHEN dp % 3 = 0 THEN 'dp' END, CASE WHEN dp % 5 = 0 THEN 'vdb' END)) AS annotations")
    return records.feature_usefulness(runs, ["dp", "vdb"])


@query(
    "W13_variant_filter_chain",
    """WITH st AS (SELECT *, CASE WHEN qual < 20 THEN 'Q' WHEN dp < 3 THEN 'd' WHEN dp > 45 THEN 'D' END AS l FROM br_variants), good AS (SELECT * FROM st WHERE l IS NULL),
near AS (SELECT DISTINCT s.var_id FROM good s JOIN good i ON length(s.ref) = length(s.alt) AND length(i.ref) <> length(i.alt) AND s.chrom = i.chrom AND s.pos BETWEEN i.pos + 1 - 10 AND i.pos + length(i.ref) + 9),
ind AS (SELECT *, pos + 1 AS s, pos + abs(length(alt) - length(ref)) AS e, 100 * qual + dp AS score FROM good WHERE length(ref) <> length(alt)),
c0 AS (SELECT *, CASE WHEN max(e) OVER (PARTITION BY chrom ORDER BY s, var_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) >= s - 30 THEN 0 ELSE 1 END AS f FROM ind), c1 AS (SELECT *, sum(f) OVER (PARTITION BY chrom ORDER BY s, var_id ROWS UNBOUNDED PRECEDING) AS ch FROM c0),
lose AS (SELECT var_id FROM c1 QUALIFY row_number() OVER (PARTITION BY chrom, ch ORDER BY score DESC, pos, var_id) > 1),
rest AS (SELECT * FROM good WHERE var_id NOT IN (SELECT var_id FROM near) AND var_id NOT IN (SELECT var_id FROM lose)), twice AS (SELECT var_id FROM rest QUALIFY row_number() OVER (PARTITION BY chrom, pos ORDER BY dp DESC, var_id) > 1)
SELECT var_id, coalesce(l, CASE WHEN var_id IN (SELECT var_id FROM near) THEN 'G' WHEN var_id IN (SELECT var_id FROM lose) THEN 'g' WHEN var_id IN (SELECT var_id FROM twice) THEN 'p' END) AS letter FROM st""",
)
def _(v: Views) -> DataFrame:
    return records.variant_filter_chain(v("br_variants"), 20, 3, 45, 10, 30, "dp").select("var_id", "letter")
