"""Writers (K1-K4, K9)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _dot(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("."))


def vcf_lines(variants: DataFrame, genotypes: DataFrame | None = None, samples: list[str] | None = None) -> DataFrame:
    """K1: a line of each variant (as read_vcf gives them) with its chrom and pos, columns joined by tabs, null as a dot, INFO keys in order. With genotypes, also FORMAT
    (GT first, then the others in order) and a cell for each of the samples; a dot where a value or cell is missing. A site's cells meet in one
    row: as many as there are samples."""
    keys = F.array_sort(F.map_keys("info"))
    info = F.array_join(F.transform(keys, lambda k: F.when(F.col("info")[k] == "", k).otherwise(F.concat(k, F.lit("="), F.col("info")[k]))), ";")
    lists = lambda c, sep: _dot(F.when(F.size(c) > 0, F.array_join(c, sep)))
    number = F.regexp_replace(F.col("qual").cast("string"), "\\.0$", "")
    columns = [_dot(F.col("chrom")), _dot(F.col("pos")), _dot(F.col("id")), _dot(F.col("ref")), lists("alt", ","), _dot(number), lists("filter", ";"), F.when(F.length(info) > 0, info).otherwise(".")]
    if genotypes is None:
        return variants.select("chrom", "pos", F.concat_ws("\t", *columns).alias("value"))
    site = ["chrom", "pos", "ref", "alt"]
    cells = genotypes.groupBy(*site).agg(F.map_from_entries(F.collect_list(F.struct("sample", "fields"))).alias("_cells"))
    joined = variants.alias("v").join(cells.alias("c"), [F.col(f"v.{c}").eqNullSafe(F.col(f"c.{c}")) for c in site], "left").select("v.*", "_cells")
    tags = F.array_sort(F.array_distinct(F.flatten(F.transform(F.map_values("_cells"), lambda m: F.map_keys(m)))))
    form = F.concat(F.filter(tags, lambda t: t == "GT"), F.filter(tags, lambda t: t != "GT"))
    joined = joined.withColumn("_form", F.coalesce(form, F.array().cast("array<string>")))

    def cell(sample: str) -> Column:
        fields = F.try_element_at(F.col("_cells"), F.lit(sample))
        text = F.array_join(F.transform("_form", lambda t: F.coalesce(F.try_element_at(fields, t), F.lit("."))), ":")
        return F.when(fields.isNull() | (F.size("_form") == 0), ".").otherwise(text)

    return joined.select("chrom", "pos", F.concat_ws("\t", *columns, F.when(F.size("_form") > 0, F.array_join("_form", ":")).otherwise("."), *map(cell, samples)).alias("value"))


def write_vcf(variants: DataFrame, path: str, genotypes: DataFrame | None = None, samples: list[str] | None = None, header: list[str] | None = None) -> None:
    """K1: sorted text files, each in the order of chromosome and position and of a range of its own. With a header (## lines; that of the column names is added),
    each file begins with it and so is whole by itself; without variants there is one file, of the header. Samples are those given, in that order."""
    ordered = vcf_lines(variants, genotypes, samples).repartitionByRange("chrom", "pos").sortWithinPartitions("chrom", "pos", "value")
    line = F.col("value")
    if header is not None:
        names = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", *(["FORMAT", *samples] if genotypes is not None else [])]
        if variants.isEmpty():
            variants.sparkSession.createDataFrame([("\n".join([*header, "\t".join(names)]),)], "value string").coalesce(1).write.mode("overwrite").text(path)
            return
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0  # of a file
        line = F.when(first, F.concat(F.lit("\n".join([*header, "\t".join(names)]) + "\n"), line)).otherwise(line)
    ordered.select(line.alias("value")).write.mode("overwrite").text(path)


def report_table(sections: dict[str, tuple[DataFrame, list[str], str]]) -> DataFrame:
    """K2: several tables (each with its key columns and value column, by section) as one long one: section, k1 to kn (as many as the most keys; null beyond a
    section's own) and value, all as text."""
    most = max(len(keys) for _, keys, _ in sections.values())
    parts = []
    for name, (df, keys, value) in sections.items():
        own = [F.col(c).cast("string").alias(f"k{i + 1}") for i, c in enumerate(keys)] + [F.lit(None).cast("string").alias(f"k{i + 1}") for i in range(len(keys), most)]
        parts.append(df.select(F.lit(name).alias("section"), *own, F.col(value).cast("string").alias("value")))
    return reduce(DataFrame.unionByName, parts)


def write_report(sections: dict[str, tuple[DataFrame, list[str], str]], path: str) -> None:
    """K2: report_table as tab-separated text, a folder for each section."""
    report_table(sections).write.mode("overwrite").partitionBy("section").option("sep", "\t").csv(path)


def write_split(df: DataFrame, column: str, path: str) -> None:
    """K3, K4, K9: a folder of each value of a column (combination, sample or sequence)."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)
