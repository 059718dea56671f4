"""Readers of tables in text form and of relational tables (S8-S13), and checksums of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import numbered_lines

# Columns of a sequence index in order, of which the last one may be absent.
INDEX_COLUMNS = (
    "fastq_file md5 run_id study_id study_name center_name submission_id submission_date sample_id sample_name population experiment_id instrument_platform "
    "instrument_model library_name run_name run_block_name insert_size library_layout paired_fastq withdrawn withdrawn_date comment read_count base_count analysis_group"
).split()

# Columns of the statistics of read groups in order; older files lack the md5 or the last ones.
BAS_COLUMNS = (
    "bam_filename md5 study sample platform library readgroup total_bases mapped_bases total_reads mapped_reads mapped_reads_paired mapped_reads_proper "
    "pct_mismatch avg_qual mean_isize isize_sd median_isize isize_mad dup_reads"
).split()


def _split(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    return spark.read.text(path).where(F.col("value") != "").select(F.split("value", sep).alias("f"))


def _at(k: int) -> Column:
    return F.nullif(F.get("f", F.lit(k)), F.lit(""))


def read_ped_map(spark: SparkSession, ped: str, sites: str) -> tuple[DataFrame, DataFrame]:
    """Genotypes (chrom, pos, sample, gt) and alleles of each site, from a file of samples (six columns, then two letters a site) and one of sites (chrom, id,
    distance, pos) in the same order. A missing letter, 0, is N. Sites are numbered by their line; a file of sites is one table of a fixed panel."""
    place = numbered_lines(spark, sites).where(F.col("value") != "").withColumnRenamed("n", "k")
    f = F.split("value", "\\s+")
    panel = place.select("k", F.get(f, F.lit(0)).alias("chrom"), F.get(f, F.lit(3)).cast("long").alias("pos"))
    rows = _split(spark, ped, "\\s+")
    n = F.floor((F.size("f") - 6) / 2).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.translate(F.concat(F.get("f", i * 2 + 6), F.get("f", i * 2 + 7)), "0", "N"))
    long = rows.where(n > 0).select(F.get("f", F.lit(1)).alias("sample"), F.posexplode(pairs).alias("k", "gt"))
    gt = long.join(panel, "k").select("chrom", "pos", "sample", "gt")
    letters = gt.withColumn("_a", F.explode(F.split("gt", ""))).where("_a NOT IN ('N', '')")
    return gt, letters.groupBy("chrom", "pos").agg(F.array_sort(F.collect_set("_a")).alias("alleles"))


def read_sequence_index(spark: SparkSession, path: str) -> DataFrame:
    """Files of a sequence index; a header line and comments go, empty fields are null, numbers are longs and `withdrawn` is a flag."""
    rows = _split(spark, path).where((F.size("f") >= 25) & ~F.upper(_at(0)).startswith("FASTQ_FILE") & ~_at(0).startswith("#"))
    kinds = {"read_count": "long", "base_count": "long", "insert_size": "long"}
    out = rows.select(*(_at(i).cast(kinds.get(c, "string")).alias(c) for i, c in enumerate(INDEX_COLUMNS)))
    return out.withColumn("withdrawn", F.coalesce(F.col("withdrawn") == "1", F.lit(False)))


def read_bas(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of read groups. Rows of 20 columns are whole, of 19 lack the duplicates, of 18 the md5 too, and of 17 the file's name as
    well; what is lacking is null, and header lines go."""
    lacking = {20: [], 19: ["dup_reads"], 18: ["dup_reads", "md5"], 17: ["dup_reads", "md5", "bam_filename"]}
    rows = _split(spark, path).where((F.size("f") >= 17) & ~F.array_contains("f", "insert_size_median_absolute_deviation"))
    size = F.least(F.size("f"), F.lit(20))
    kinds = dict.fromkeys(BAS_COLUMNS[7:13] + ["dup_reads", "median_isize", "isize_mad"], "long") | dict.fromkeys(["pct_mismatch", "avg_qual", "mean_isize", "isize_sd"], "double")

    def value(c: str) -> Column:
        cases = [F.when(size == n, _at([x for x in BAS_COLUMNS if x not in gone].index(c))) for n, gone in lacking.items() if c not in gone]
        return F.coalesce(*cases).cast(kinds.get(c, "string")).alias(c)

    return rows.select(*map(value, BAS_COLUMNS))


def read_job_logs(spark: SparkSession, path: str) -> DataFrame:
    """One row of each attempt of a batch job: host, start and end as written, processor seconds and megabytes. A report begins with a line 'Job was executed on host(s)'; each
    file, a log of one job, is read whole."""
    whole = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    attempts = whole.select("file", F.posexplode(F.slice(F.split("value", "Job was executed on host\\(s\\) "), 2, 1 << 30)).alias("attempt", "_t"))
    find = lambda pattern: F.nullif(F.regexp_extract("_t", pattern, 1), F.lit(""))
    return attempts.select(
        "file", "attempt", find("^<([^>]*)>").alias("host"), find("Started at (.*)").alias("started"), find("Results reported (?:at|on) (.*)").alias("ended"),
        find("CPU time\\s*:\\s*([0-9.]+)").cast("double").alias("cpu_seconds"), find("Max Memory\\s*:\\s*([0-9.]+)").cast("double").alias("memory_mb"), find("Exited with exit code ([0-9]+)").cast("long").alias("exit_code"),
    )


def read_array_report(spark: SparkSession, report: str, panel: DataFrame) -> DataFrame:
    """Genotypes of a genotyping array's long report (name, sample, two alleles, allele frequency and log ratio; tab-separated after a line [Data] and
    its header), at the places of a panel (name, chrom, pos, flip), complemented where flip holds."""
    rows = _split(spark, report).where((F.size("f") >= 6) & _at(4).try_cast("double").isNotNull())
    x = rows.select(_at(0).alias("name"), _at(1).alias("sample"), F.translate(F.concat(_at(2), _at(3)), "-", "N").alias("gt"), _at(4).try_cast("double").alias("baf"), _at(5).try_cast("double").alias("lrr"))
    return x.join(panel, "name").withColumn("gt", F.when(F.col("flip"), F.translate("gt", "ACGT", "TGCA")).otherwise(F.col("gt"))).drop("flip")


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, parts: int = 1, **options: str) -> DataFrame:
    """A table of a relational database; with a numeric column and its bounds it is read in `parts` ranges side by side."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if column and bounds:
        reader = reader.options(partitionColumn=column, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts))
    return reader.load()


def md5_check(spark: SparkSession, path: str, recorded: DataFrame) -> DataFrame:
    """Files of a folder against recorded (name, md5): ok, differs, not recorded or no file. A file is hashed by one task, whole."""
    found = spark.read.format("binaryFile").load(path).select(F.substring_index("path", "/", -1).alias("name"), F.md5("content").alias("_found"))
    status = F.when(F.col("md5").isNull(), "not recorded").when(F.col("_found").isNull(), "no file").when(F.lower("md5") == F.col("_found"), "ok").otherwise("differs")
    return found.join(recorded.select("name", "md5"), "name", "full").select("name", status.alias("status"))
