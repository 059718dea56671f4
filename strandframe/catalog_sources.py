"""Queries of readers and writers: texts made of the bridge views are written to the shared folder and read back (see catalog)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import _GROUPS, B, Views, query
from .operators import calls, sequences
from .plans.shared import scratch
from .sources import sinks, tables, text

_N = "CASE WHEN qual % 10 = 0 THEN NULL ELSE qual END"
_VCF = f"""v AS (SELECT var_id, chrom, pos + 5000 * (var_id // 5000) AS pos, CASE WHEN var_id % 3 = 0 THEN concat('rs', var_id) END AS id, ref, alt, {_N} AS qual, filt, dp FROM br_variants)"""


def _written(v: Views) -> str:
    """A folder of two VCFs with different samples: even variants with S1 and S2, odd ones with S3."""
    spark = v("br_variants").sparkSession
    one = v("br_variants").withColumn("pos", F.expr("pos + 5000 * (var_id div 5000)"))  # a place for each variant
    info = F.create_map(F.lit("DP"), F.col("dp").cast("string"), F.lit("DB"), F.lit(""))
    rows = one.withColumns({"id": F.when(F.col("var_id") % 3 == 0, F.concat(F.lit("rs"), "var_id")), "alt": F.array("alt"), "qual": F.when(F.col("qual") % 10 != 0, F.col("qual").cast("double")), "filter": F.array("filt"), "info": info})
    folder = scratch(spark, "vcf")
    for part, samples in ((0, ["S1", "S2"]), (1, ["S3"])):
        mine = rows.where(F.col("var_id") % 2 == part)
        cells = mine.withColumn("sample", F.explode(F.array(*map(F.lit, samples)))).where("sample <> 'S2' OR var_id % 7 <> 0")
        cells = cells.select("chrom", "pos", "ref", "alt", "sample", F.create_map(F.lit("DP"), F.col("dp").cast("string"), F.lit("GT"), F.when(F.col("var_id") % 5 == 0, "1/1").otherwise("0|1")).alias("fields"))
        sinks.write_vcf(mine, f"{folder}/{part}", cells, samples, ["##fileformat=VCFv4.1", '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth, all">'])
    return f"{folder}/*"


@query("S1_read_vcf", f"WITH {_VCF} SELECT chrom, pos, id, ref, alt, qual, filt AS filter, concat('DB=;DP=', dp) AS info FROM v WHERE chrom IN ('chr1', 'chr2') OR (chrom = 'chr3' AND pos BETWEEN 1000 AND 2000)")
def _(v: Views) -> DataFrame:
    found, _ = text.read_vcf(v("br_variants").sparkSession, _written(v), [("chr1", None, None), ("chr2", None, None), ("chr3", 1000, 2000)])
    info = F.array_join(F.transform(F.array_sort(F.map_entries("info")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return found.select("chrom", "pos", "id", "ref", F.array_join("alt", ",").alias("alt"), F.col("qual").cast("long").alias("qual"), F.array_join("filter", ";").alias("filter"), info.alias("info"))


@query(
    "K1_vcf_round_trip",
    f"""WITH {_VCF}, s AS (SELECT *, CASE WHEN var_id % 2 = 0 THEN ['S1', 'S2'] ELSE ['S3'] END AS names FROM v), g AS (SELECT *, unnest(names) AS sample FROM s)
SELECT chrom, pos, sample, CASE WHEN sample = 'S2' AND var_id % 7 = 0 THEN '.' WHEN var_id % 5 = 0 THEN '1/1' ELSE '0|1' END AS gt, CASE WHEN sample = 'S2' AND var_id % 7 = 0 THEN NULL ELSE CAST(dp AS VARCHAR) END AS dp FROM g WHERE sample <> 'S1'""",
)
def _(v: Views) -> DataFrame:
    _, cells = text.read_vcf(v("br_variants").sparkSession, _written(v), samples=["S2", "S3"])
    return cells.select("chrom", "pos", "sample", "gt", F.try_element_at("fields", F.lit("DP")).alias("dp"))


@query("S2_read_sam", "SELECT concat(qname, '_', read_id) AS qname, flag, chrom AS rname, pos, mapq, concat(seq_len, 'M') AS cigar, isize, concat(rg, ',', nm) AS tags FROM br_reads")
def _(v: Views) -> DataFrame:
    path = scratch(v("br_reads").sparkSession, "sam")
    columns = [F.concat("qname", F.lit("_"), "read_id"), "flag", "chrom", "pos", "mapq", F.concat("seq_len", F.lit("M")), F.lit("="), F.lit(0), "isize", F.lit("*"), F.lit("*"), F.concat(F.lit("RG:Z:"), "rg"), F.concat(F.lit("NM:i:"), "nm")]
    v("br_reads").select(F.concat_ws("\t", *columns).alias("value")).write.text(path)
    found = text.read_sam(v("br_reads").sparkSession, path)
    return found.select("qname", "flag", "rname", "pos", "mapq", "cigar", "isize", F.concat_ws(",", F.col("tags")["RG"], F.col("tags")["NM"]).alias("tags"))


_CLEAN = "regexp_replace(seq, '[^ACGT]', 'N', 'gs')"


def _clean(v: Views) -> DataFrame:
    return v("br_fastq").select("name", sequences.clean_base(F.col("seq")).alias("seq"))


@query("S3_read_fastq", f"SELECT name, {_CLEAN} AS seq, {B('length(seq)')} AS n_qual FROM br_fastq")
def _(v: Views) -> DataFrame:
    path = scratch(v("br_fastq").sparkSession, "fastq")
    _clean(v).select(F.concat(F.lit("@"), "name", F.lit(" note\n"), "seq", F.lit("\n+\n"), F.repeat(F.lit("@"), F.length("seq"))).alias("value")).write.text(path)
    return text.read_fastq(v("br_fastq").sparkSession, path).select("name", "seq", F.length("qual").alias("n_qual"))


@query("S4_read_fasta", f"WITH s AS (SELECT name, {_CLEAN} AS seq FROM br_fastq), k AS (SELECT *, unnest(range(greatest(1, CAST(ceil(length(seq) / 500.0) AS BIGINT)))) AS k FROM s) SELECT name AS chrom, {B('k')} AS chunk_no, substr(seq, k * 500 + 1, 500) AS seq FROM k")
def _(v: Views) -> DataFrame:
    path = scratch(v("br_fastq").sparkSession, "fasta")
    _clean(v).select(F.concat(F.lit(">"), "name", F.lit(" note\n"), F.regexp_replace("seq", "(.{70})", "$1\n")).alias("value")).write.text(path)
    return text.read_fasta(v("br_fastq").sparkSession, path, 500)


@query(
    "S5_read_gff",
    f"""WITH e AS (SELECT concat('g', iv_id // 3) AS gene_id, chrom, start_pos AS s, end_pos AS e, strand FROM br_intervals), l AS (SELECT gene_id, chrom AS seq_id, strand, min(s) AS gene_start, max(e) AS gene_end, sum(e - s + 1) AS exon_length, count(*) AS n FROM e GROUP BY ALL)
SELECT gene_id, seq_id, strand, gene_start, gene_end, {B("exon_length")} AS exon_length, {B("n")} AS n_exons FROM l""",
)
def _(v: Views) -> DataFrame:
    path = scratch(v("br_intervals").sparkSession, "gff")
    tag = F.concat(F.when(F.col("iv_id") % 2 == 0, "locus_tag=g").otherwise("ID=g"), F.floor(F.col("iv_id") / 3))
    v("br_intervals").select(F.concat_ws("\t", "chrom", F.lit("x"), F.lit("CDS"), "start_pos", "end_pos", F.lit("."), F.when(F.col("strand") == 1, "+").otherwise("-"), F.lit("0"), tag).alias("value")).write.text(path)
    found = text.read_gff(v("br_intervals").sparkSession, path)
    return found.select("gene_id", "seq_id", F.col("strand").cast("long").alias("strand"), "gene_start", "gene_end", "exon_length", F.size("exons").alias("n_exons"))


@query("S6_read_intervals", "SELECT chrom, start_pos, end_pos FROM br_intervals")
def _(v: Views) -> DataFrame:
    path = scratch(v("br_intervals").sparkSession, "intervals")
    v("br_intervals").select(F.concat_ws("\t", "chrom", "start_pos", "end_pos", F.lit("+")).alias("value")).write.text(path)
    return text.read_intervals(v("br_intervals").sparkSession, path)


@query("S7_read_pileup", "SELECT chrom, pos, ref, dp AS depth, concat(repeat('.', CAST(dp % 5 AS INTEGER)), '\"') AS bases, alt AS quals FROM br_variants")
def _(v: Views) -> DataFrame:
    path = scratch(v("br_variants").sparkSession, "pileup")
    v("br_variants").select(F.concat_ws("\t", "chrom", "pos", "ref", "dp", F.concat(F.repeat(F.lit("."), (F.col("dp") % 5).cast("int")), F.lit('"')), "alt").alias("value")).write.text(path)
    return text.read_pileup(v("br_variants").sparkSession, path)


@query("S8_read_ped_map", "SELECT 'c1' AS chrom, site * 10 AS pos, sample, CASE WHEN a1 IS NULL THEN 'NN' ELSE concat(CASE a1 WHEN 0 THEN 'A' ELSE 'G' END, CASE a2 WHEN 0 THEN 'A' ELSE 'G' END) END AS gt FROM (SELECT DISTINCT site FROM br_genotypes) CROSS JOIN (SELECT DISTINCT sample FROM br_genotypes) LEFT JOIN br_genotypes USING (site, sample)")
def _(v: Views) -> DataFrame:
    spark, some = v("br_genotypes").sparkSession, v("br_genotypes")
    ped, sites = scratch(spark, "ped"), scratch(spark, "map")
    letter = lambda c: F.when(F.col(c).isNull(), "0").when(F.col(c) == 0, "A").otherwise("G")
    places = some.select("site").distinct()
    places.orderBy("site").coalesce(1).select(F.concat_ws(" ", F.lit("c1"), F.concat(F.lit("s"), "site"), F.lit("0"), F.col("site") * 10).alias("value")).write.text(sites)
    every = places.join(v("br_genotypes").select("sample").distinct()).join(some, ["site", "sample"], "left")
    cells = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("site", F.concat_ws(" ", letter("a1"), letter("a2")).alias("c")))), lambda x: x["c"]), " ")
    every.groupBy("sample").agg(cells.alias("c")).select(F.concat_ws(" ", F.lit("f"), "sample", F.lit("0 0 0 0"), "c").alias("value")).write.text(ped)
    return tables.read_ped_map(spark, ped, sites)[0]


@query("S9_read_sequence_index", "SELECT concat('f', lane_id) AS fastq_file, sample AS sample_name, raw_reads AS read_count, raw_bases AS base_count, lane_id % 5 = 0 AS withdrawn FROM br_lanes")
def _(v: Views) -> DataFrame:
    path = scratch(v("br_lanes").sparkSession, "index")
    values = {"fastq_file": F.concat(F.lit("f"), "lane_id"), "sample_name": F.col("sample"), "read_count": F.col("raw_reads"), "base_count": F.col("raw_bases"), "withdrawn": (F.col("lane_id") % 5 == 0).cast("int")}
    v("br_lanes").select(F.concat_ws("\t", *(values.get(c, F.lit("x")).cast("string") for c in tables.INDEX_COLUMNS)).alias("value")).write.text(path)
    return tables.read_sequence_index(v("br_lanes").sparkSession, path).select("fastq_file", "sample_name", "read_count", "base_count", "withdrawn")


@query("S10_read_bas", f"SELECT rg AS readgroup, {B('count(*)')} AS total_reads, {B('sum(seq_len)')} AS total_bases, CASE WHEN rg < 'rg3' THEN {B('count(*) FILTER (flag & 1024 <> 0)')} END AS dup_reads FROM br_reads GROUP BY rg")
def _(v: Views) -> DataFrame:
    path = scratch(v("br_reads").sparkSession, "bas")
    sums = v("br_reads").groupBy("rg").agg(F.count("*").alias("total_reads"), F.sum("seq_len").alias("total_bases"), F.count_if(F.col("flag").bitwiseAND(F.lit(1024)) != 0).alias("dup_reads"))
    values = {"readgroup": F.col("rg"), "total_reads": F.col("total_reads"), "total_bases": F.col("total_bases"), "dup_reads": F.col("dup_reads")}
    line = lambda names: F.concat_ws("\t", *(values.get(c, F.lit("1")).cast("string") for c in names))
    sums.select(F.when(F.col("rg") < "rg3", line(tables.BAS_COLUMNS)).otherwise(line(tables.BAS_COLUMNS[:-1])).alias("value")).write.text(path)
    return tables.read_bas(v("br_reads").sparkSession, path).select("readgroup", "total_reads", "total_bases", "dup_reads")


@query("K2_write_report", "SELECT 'SN' AS section, rg AS k1, NULL AS k2, CAST(count(*) AS VARCHAR) AS value FROM br_reads GROUP BY rg UNION ALL SELECT 'RL', chrom, CAST(seq_len AS VARCHAR), CAST(count(*) AS VARCHAR) FROM br_reads GROUP BY 2, 3")
def _(v: Views) -> DataFrame:
    r = v("br_reads")
    path = scratch(r.sparkSession, "report")
    sinks.write_report({"SN": (r.groupBy("rg").agg(F.count("*").alias("n")), ["rg"], "n"), "RL": (r.groupBy("chrom", "seq_len").agg(F.count("*").alias("n")), ["chrom", "seq_len"], "n")}, path)
    return r.sparkSession.read.option("sep", "\t").schema("k1 string, k2 string, value string, section string").csv(path).select("section", "k1", "k2", "value")


@query("K3_write_by_combination", f"WITH {_GROUPS} SELECT chrom, pos, combination FROM comb WHERE n_src >= 1")
def _(v: Views) -> DataFrame:
    path = scratch(v("br_calls").sparkSession, "combinations")
    sinks.write_split(calls.isec(v("br_calls"), 1, "+", 2), "combination", path)
    return v("br_calls").sparkSession.read.schema("chrom string, pos long, combination string").parquet(path)


@query("K4_write_by_sample", "SELECT site, sample, dp FROM br_genotypes")
def _(v: Views) -> DataFrame:
    path = scratch(v("br_genotypes").sparkSession, "samples")
    sinks.write_split(v("br_genotypes").select("site", "sample", "dp"), "sample", path)
    return v("br_genotypes").sparkSession.read.schema("site long, dp long, sample string").parquet(path)


@query("K9_split_by_sequence", "SELECT read_id, CASE WHEN flag & 4 = 0 THEN chrom ELSE 'unmapped' END AS rname, pos FROM br_reads")
def _(v: Views) -> DataFrame:
    path = scratch(v("br_reads").sparkSession, "sequences")
    sinks.write_split(v("br_reads").select("read_id", F.when(F.col("flag").bitwiseAND(F.lit(4)) == 0, F.col("chrom")).otherwise("unmapped").alias("rname"), "pos"), "rname", path)
    return v("br_reads").sparkSession.read.schema("read_id long, pos long, rname string").parquet(path)
