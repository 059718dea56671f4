"""Readers of text formats (S1-S7, S9); lines are parsed by Spark's own functions, and files split wherever Spark splits them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.prefix import running

#: Lines in a block, the unit in which values run along a file.
LINES = 1 << 16


def _fields(lines: DataFrame) -> DataFrame:
    return lines.select(F.split("value", "\t").alias("f"))


def _field(k: int) -> Column:
    return F.get("f", F.lit(k))


def _or_null(c: Column) -> Column:
    """A missing value, written as a dot, as null."""
    return F.when(c != ".", c)


def _info_map(c: Column) -> Column:
    """Semicolon-separated KEY=VALUE as a map; a key without a value has the empty text, a dot is an empty map, and of equal keys the first counts."""
    pairs = F.transform(F.filter(F.split(c, ";"), lambda x: (x != "") & (x != ".")), lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.when(F.contains(x, F.lit("=")), F.substring(x, F.length(F.substring_index(x, "=", 1)) + 2, F.length(x))).otherwise("").alias("v")))
    firsts = F.array_distinct(F.transform(pairs, lambda p: p["k"]))
    return F.map_from_arrays(firsts, F.transform(firsts, lambda k: F.element_at(F.filter(pairs, lambda p: p["k"] == k), 1)["v"]))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, n and value of each line, n from 0 within its file. A file's splits are counted where they lie, and lines numbered from their splits' sums: no row goes
    through Python or another task."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"), F.monotonically_increasing_id().alias("_id"))
    sums = lines.groupBy("file", "_split").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))  # ids rise within a split
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select("file", "_split", "_first", before.alias("_before"))
    return lines.join(starts, ["file", "_split"]).select("file", (F.col("_before") + F.col("_id") - F.col("_first")).alias("n"), "value")


def vcf_samples(spark: SparkSession, path: str) -> DataFrame:
    """file and samples: the sample names of each file, from its line that begins with #CHROM."""
    head = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.col("value").startswith("#CHROM"))
    fields = F.split("value", "\t")
    return head.select("file", F.slice(fields, 10, F.greatest(F.size(fields) - 9, F.lit(0))).alias("samples"))


def vcf_header(spark: SparkSession, path: str) -> DataFrame:
    """The header lines (file, key, attributes) of each file: of ##KEY=<ID=..,..> a map of its attributes, of ##KEY=text a map of the text under value."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.col("value").startswith("##"))
    text = F.regexp_extract("value", "^##[^=]*=(.*)$", 1)
    found = F.regexp_extract_all(F.regexp_extract(text, "^<(.*)>$", 1), F.lit('([A-Za-z0-9_]+=(?:"[^"]*"|[^,]*))'), F.lit(1))
    pairs = F.transform(found, lambda x: F.struct(F.substring_index(x, "=", 1).alias("k"), F.regexp_replace(F.substring(x, F.length(F.substring_index(x, "=", 1)) + 2, F.length(x)), '^"|"$', "").alias("v")))
    return lines.select("file", F.regexp_extract("value", "^##([^=]*)", 1).alias("key"), F.when(text.startswith("<"), F.map_from_entries(pairs)).otherwise(F.create_map(F.lit("value"), text)).alias("attributes"))


def read_vcf(spark: SparkSession, path: str, regions: list[tuple[str, int | None, int | None]] | None = None, samples: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Variants (chrom, pos, id, ref, alt array, qual, filter array, info map) and genotypes, one row of each variant and sample with
    a map of FORMAT tags. Header lines and empty lines go; gzip is told by the file's ending. Each file's own header names its samples. Only
    variants in one of the regions (chrom, from, to; None is open) and genotypes of the given samples are read, if there are any."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(~F.col("value").startswith("#") & (F.col("value") != ""))
    f = lines.select(F.split("value", "\t").alias("f"), "file")
    pos = _field(1).cast("long")
    if regions is not None:
        within = [(_field(0) == c) & ((pos >= a) if a is not None else F.lit(True)) & ((pos <= b) if b is not None else F.lit(True)) for c, a, b in regions]
        f = f.where(reduce(lambda x, y: x | y, within, F.lit(False)))
    key = [_field(0).alias("chrom"), pos.alias("pos"), _or_null(_field(2)).alias("id"), _field(3).alias("ref"), F.when(_field(4) != ".", F.split(_field(4), ",")).alias("alt")]
    variants = f.select(*key, _or_null(_field(5)).cast("double").alias("qual"), F.when(_field(6) != ".", F.split(_field(6), ";")).alias("filter"), _info_map(_field(7)).alias("info"))
    cells = f.where(F.size("f") > 9).select("file", *key, F.split(_field(8), ":").alias("tags"), F.posexplode(F.slice("f", 10, F.size("f"))).alias("k", "cell"))
    long = cells.join(vcf_samples(spark, path), "file").withColumn("sample", F.get("samples", F.col("k")))
    long = long.where(F.col("sample").isin(samples)) if samples is not None else long
    values = F.split("cell", ":")
    fields = F.map_from_arrays(F.slice("tags", 1, F.least(F.size("tags"), F.size(values))), F.slice(values, 1, F.least(F.size("tags"), F.size(values))))
    return variants, long.select("chrom", "pos", "ref", "alt", "sample", fields.alias("fields")).withColumn("gt", F.col("fields")["GT"])


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments with a map of optional tags; header lines go."""
    f = _fields(spark.read.text(path).where(~F.col("value").startswith("@") & (F.col("value") != "")))
    names = ["qname", "flag", "rname", "pos", "mapq", "cigar", "mrnm", "mpos", "isize", "seq", "qual"]
    kinds = {"flag": "int", "pos": "long", "mapq": "int", "mpos": "long", "isize": "int"}
    optional = F.filter(F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))), lambda x: F.length(x) > 5)
    tags = F.map_from_entries(F.transform(optional, lambda x: F.struct(F.substring(x, 1, 2), F.substring(x, F.lit(6), F.length(x)))))
    return f.select(*(_field(k).cast(kinds.get(n, "string")).alias(n) for k, n in enumerate(names)), tags.alias("tags"))


def read_sam_header(spark: SparkSession, path: str) -> DataFrame:
    """The header's lines (file, kind such as SQ or RG, map of tags)."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.col("value").rlike("^@[A-Z][A-Z](\t|$)"))
    tags = F.filter(F.split("value", "\t"), lambda x: x.rlike("^[A-Za-z][A-Za-z0-9]:"))
    entries = F.transform(tags, lambda x: F.struct(F.substring(x, 1, 2), F.substring(x, F.lit(4), F.length(x))))
    return lines.select("file", F.substring("value", 2, 2).alias("kind"), F.map_from_entries(entries).alias("tags"))


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """S3: file, rec_no, name, seq, qual. Lines are numbered within each file, as a quality may begin with @; an incomplete or ill-formed
    record raises an error when the table is computed."""
    lines = numbered_lines(spark, path)
    part = lambda k: F.max(F.when(F.col("n") % 4 == k, F.col("value")))
    rows = lines.groupBy("file", F.floor(F.col("n") / 4).alias("rec_no")).agg(part(0).alias("name"), part(1).alias("seq"), part(2).alias("plus"), part(3).alias("qual"))
    good = F.coalesce(F.col("name").startswith("@") & F.col("plus").startswith("+") & (F.length("seq") == F.length("qual")), F.lit(False))
    checked = F.when(good, F.col("seq")).otherwise(F.raise_error(F.concat(F.lit("broken record "), F.col("rec_no").cast("string"))))
    return rows.select("file", "rec_no", F.substring_index(F.substring("name", 2, 1 << 30), " ", 1).alias("name"), checked.alias("seq"), "qual")


def read_fasta(spark: SparkSession, path: str, chunk: int = 10_000) -> DataFrame:
    """Chrom, chunk_no, seq: each contig in chunks of a fixed size. Lines are told their contig and place by running values over blocks of lines, and each
    gives its pieces to the chunks that it touches: no contig is in one row or task. A contig without letters has one empty chunk."""
    lines = numbered_lines(spark, path).withColumn("head", F.col("value").startswith(">"))
    sized = lines.withColumn("seq", F.when(F.col("head"), "").otherwise(F.regexp_replace("value", "\\s", "")))
    run = running(sized, ["file"], "n", ["n"], F.length("seq").cast("long"), "_cum", "sum", inclusive=False, block=LINES)
    run = run.withColumn("_cum", F.coalesce("_cum", F.lit(0)))
    header = F.when(F.col("head"), F.struct("n", F.regexp_extract("value", "^>\\s*(\\S*)", 1).alias("chrom"), "_cum"))
    placed = running(run, ["file"], "n", ["n"], header, "_of", "max", block=LINES).where("_of IS NOT NULL")
    at = placed.select(F.col("_of.chrom").alias("chrom"), (F.col("_cum") - F.col("_of._cum")).alias("at"), "seq").where((F.length("seq") > 0) | (F.col("at") == 0))
    touched = at.withColumn("chunk_no", F.explode(F.sequence(F.floor(F.col("at") / chunk), F.floor((F.col("at") + F.greatest(F.length("seq") - 1, F.lit(0))) / chunk))))
    begin = F.greatest(F.lit(0), F.col("chunk_no") * chunk - F.col("at"))
    piece = F.substring(F.col("seq"), (begin + 1).cast("int"), (F.least(F.length("seq").cast("long"), (F.col("chunk_no") + 1) * chunk - F.col("at")) - begin).cast("int"))
    parts = touched.select("chrom", F.col("chunk_no").cast("int").alias("chunk_no"), F.struct("at", piece.alias("piece")).alias("p"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["piece"]), "")
    return parts.groupBy("chrom", "chunk_no").agg(joined.alias("seq"))


def read_gff(spark: SparkSession, path: str) -> DataFrame:
    """One row of each gene with its exons: coding features of one id (locus_tag, else ID, else place) are one gene."""
    f = _fields(spark.read.text(path).where(~F.col("value").startswith("#"))).where((F.size("f") >= 9) & _field(2).isin("CDS", "polypeptide"))
    attribute = lambda n: F.nullif(F.regexp_extract(_field(8), f"(?:^|;){n}=([^;]*)", 1), F.lit(""))
    gene = F.coalesce(attribute("locus_tag"), attribute("ID"), F.concat_ws("_", _field(0), _field(3), _field(4)))
    x = f.select(gene.alias("gene_id"), _field(0).alias("seq_id"), _field(3).cast("long").alias("s"), _field(4).cast("long").alias("e"), F.when(_field(6) == "-", -1).otherwise(1).alias("strand"))
    exons = F.array_sort(F.collect_list(F.struct(F.col("s").alias("start_pos"), F.col("e").alias("end_pos"))))
    return x.groupBy("gene_id", "seq_id", "strand").agg(F.min("s").alias("gene_start"), F.max("e").alias("gene_end"), F.sum(F.col("e") - F.col("s") + 1).alias("exon_length"), exons.alias("exons"))


def read_intervals(spark: SparkSession, path: str) -> DataFrame:
    """Chrom, start_pos, end_pos of a tab-separated list; lines that begin with @ or # go."""
    f = _fields(spark.read.text(path).where(~F.col("value").rlike("^[@#]") & (F.col("value") != "")))
    return f.select(_field(0).alias("chrom"), _field(1).cast("long").alias("start_pos"), _field(2).cast("long").alias("end_pos"))


def read_pileup(spark: SparkSession, path: str) -> DataFrame:
    """The six columns of a pileup."""
    return spark.read.option("sep", "\t").option("quote", "").schema("chrom string, pos long, ref string, depth int, bases string, quals string").csv(path)
