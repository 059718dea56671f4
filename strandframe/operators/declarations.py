"""Header declarations as a table (kind, id, number, type) against the tags that they declare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Forms of the declared types.
FORMS = {"Integer": r"^[+-]?[0-9]+$", "Float": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$", "Character": r"(?s)^.$"}
# Tags with a value for each genotype, and for each alternative, that older versions can't declare as such.
BY_GENOTYPE, BY_ALTERNATIVE = ("GL", "PL"), ("AC", "AF")


def declarations(header: DataFrame) -> DataFrame:
    """file, kind, id, number, type of the declarations in a header as vcf_header gives it (file, key, attributes)."""
    of = lambda c: F.try_element_at("attributes", F.lit(c))
    return header.where(of("ID").isNotNull()).select("file", F.col("key").alias("kind"), of("ID").alias("id"), of("Number").alias("number"), of("Type").alias("type"))


def values_expected(number: Column, n_alts: Column, ploidy: Column) -> Column:
    """How many values a declared number asks for: n itself, A one for each alternative, R one more, G one for each genotype of so many alleles; null where any number will do."""
    alleles = n_alts + 1
    genotypes = F.when(ploidy == 1, alleles).when(ploidy == 2, (alleles * (alleles + 1) / 2).cast("int"))
    return F.when(number == "A", n_alts).when(number == "R", alleles).when(number == "G", genotypes).otherwise(number.try_cast("int"))


def format_problems(cells: DataFrame, declared: DataFrame) -> DataFrame:
    """A row of each problem of a sample's tags: all columns of cells but tags (map), tag and problem: undeclared (FORMAT doesn't have it), type (a value that isn't a dot has another form than the
    declared type), number (another number of values than declared for the site's alternatives, n_alts, and the genotype's alleles); for the genotype (tag GT) genotype_form and
    allele_range. A tag that is a dot as a whole is missing and no problem.

    Cells are exploded by tag and meet the declarations, a row each, in a join; nothing of the header is in the plan, so headers of any size and number of types will do.
    """
    kept = [c for c in cells.columns if c != "tags"]
    gt = F.try_element_at("tags", F.lit("GT"))
    numbers = F.regexp_extract_all(gt, F.lit("([0-9]+|[.])"), F.lit(1))
    each = cells.withColumns({"_ploidy": F.size(numbers), "_top": F.array_max(F.transform(numbers, lambda x: x.try_cast("int")))})
    long = each.select(*kept, "_ploidy", "_top", F.explode("tags").alias("tag", "_value"))
    some = declared.where("kind = 'FORMAT'").groupBy("id").agg(F.min(F.struct("number", "type")).alias("d")).select(F.col("id").alias("tag"), F.lit(True).alias("_known"), "d.*")
    x = long.join(some, "tag", "left")
    parts = F.filter(F.split("_value", ","), lambda v: v != ".")
    form = F.coalesce(*(F.when(F.col("type") == t, F.lit(f)) for t, f in FORMS.items()), F.lit(".*"))
    there = F.col("_value") != "."
    wanted = values_expected(F.col("number"), F.col("n_alts"), F.col("_ploidy"))
    genotype = F.col("tag") == "GT"
    checks = {
        "undeclared": F.col("_known").isNull(), "type": there & F.col("_known") & ~genotype & F.exists(parts, lambda v: ~F.rlike(v, form)), "number": there & F.col("_known") & (F.size(F.split("_value", ",")) != wanted),
        "genotype_form": genotype & ~F.col("_value").rlike(r"^([0-9]+|[.])([/|]([0-9]+|[.]))*$"), "allele_range": genotype & (F.col("_top") > F.col("n_alts")),
    }
    found = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in checks.items())))
    return x.select(*kept, "tag", F.explode(found).alias("problem"))


def upgrade_declarations(declared: DataFrame, version: float) -> DataFrame:
    """Declarations (kind, id, number, type) as a version of the format writes them: from 4.0 on an unknown number is a dot, not -1; from 4.1 on tags by genotype and by
    alternative say so (G, A), which 4.0 can't: there theirs is a dot; R came with 4.2."""
    tag = F.col("kind").isin("INFO", "FORMAT")
    g, a = tag & F.col("id").isin(*BY_GENOTYPE), tag & F.col("id").isin(*BY_ALTERNATIVE)
    if version < 4.0:
        number = F.when(F.col("number").isin("A", "G", "R", "."), "-1").otherwise(F.col("number"))
    elif version < 4.1:
        number = F.when(F.col("number").isin("A", "G", "R", "-1"), ".").otherwise(F.col("number"))
    else:
        new = F.when(g, "G").when(a, "A").when(F.col("number") == "-1", ".").otherwise(F.col("number"))
        number = F.when(new == "R", ".").otherwise(new) if version < 4.2 else new
    return declared.withColumn("number", number)
