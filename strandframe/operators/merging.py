"""Merging of call sets with their samples (U4): alleles, genotypes and arrays by allele, tags and absent samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calls import matched_records

SITE = ["chrom", "pos", "ref", "_kind"]
# INFO tags whose values are added up over sets, and those that are added up place by place.
SUMS = {"DP": "sum", "MQ0": "sum", "DP4": "sum_each", "I16": "sum_each"}


def allele_map(own: Column, merged: Column) -> Column:
    """For each allele of a merged site (0 is the reference) the index that it has in a set of its own alternatives; null where that set lacks it."""
    at = F.transform(merged, lambda a: F.array_position(own, a).cast("int"))
    return F.concat(F.array(F.lit(0)), F.transform(at, lambda i: F.when(i > 0, i)))


def by_allele(values: Column, back: Column, whole: bool) -> Column:
    """Values by alternative (or with `whole` by allele, Number=R) in the merged site's order; a dot for alleles that the set lacks. `back` is an allele_map."""
    every = back if whole else F.slice(back, 2, F.size(back))
    return F.transform(every, lambda i: F.when(i.isNull(), ".").otherwise(F.coalesce(F.get(values, i if whole else i - 1), F.lit("."))))


def by_genotype(values: Column, back: Column, n_own: Column) -> Column:
    """Values by genotype (Number=G) in the merged site's order, where that of alleles i <= j is at j (j + 1) / 2 + i, on both sides. As many values as alleles are those of haploid
    genotypes; any other number but that of diploid ones is an error."""
    pairs = F.flatten(F.transform(back, lambda b, j: F.transform(F.slice(back, F.lit(1), j + 1), lambda a: F.struct(F.least(a, b).alias("i"), F.greatest(a, b).alias("j"), (a.isNull() | b.isNull()).alias("none")))))
    at = lambda p: (p["j"] * (p["j"] + 1) / 2).cast("int") + p["i"]
    diploid = F.transform(pairs, lambda p: F.when(p["none"], ".").otherwise(F.coalesce(F.get(values, at(p)), F.lit("."))))
    wrong = F.raise_error(F.concat(F.size(values).cast("string"), F.lit(" values by genotype for "), n_own.cast("string"), F.lit(" alleles")))
    fits = F.size(values) == (n_own * (n_own + 1) / 2).cast("int")
    return F.when(fits, diploid).when(F.size(values) == n_own, by_allele(values, back, True)).otherwise(wrong.cast("array<string>"))


def moved_genotype(gt: Column, back: Column) -> Column:
    """A genotype's text with its allele indexes in the merged site's order; a dot for alleles that are missing or that the merged site lacks. Separators stay."""
    to = lambda x: F.when(x.try_cast("int").isNotNull(), F.array_position(back, x.try_cast("int")))
    alleles = F.transform(F.regexp_extract_all(gt, F.lit("([^/|]+)"), F.lit(1)), lambda x: F.coalesce(F.when(to(x) > 0, to(x) - 1).cast("string"), F.lit(".")))
    marks = F.concat(F.regexp_extract_all(gt, F.lit("([/|])"), F.lit(1)), F.array(F.lit("")))
    return F.array_join(F.zip_with(alleles, marks, lambda a, m: F.concat(F.coalesce(a, F.lit("")), F.coalesce(m, F.lit("")))), "")


def joined_info(infos: Column, joiners: dict[str, str]) -> Column:
    """INFO maps in the order of sets as one: of a key that several have the first value, or for a key of `joiners` their sum (`sum`), the sum at each place of a list
    (`sum_each`; lists of unlike length are an error), or the least or greatest number (`min`, `max`)."""
    values = lambda k: F.filter(F.transform(infos, lambda m: F.try_element_at(m, k)), lambda x: x.isNotNull())

    def number(x: Column) -> Column:
        return F.coalesce(x.try_cast("decimal(38,6)"), F.lit(0).cast("decimal(38,6)"))

    def text(x: Column) -> Column:
        return F.regexp_replace(F.regexp_replace(x.cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")

    def total(found: Column) -> Column:
        return text(F.aggregate(found, F.lit(0).cast("decimal(38,6)"), lambda a, x: (a + number(x)).cast("decimal(38,6)")))

    def places(found: Column) -> Column:
        lists = F.transform(found, lambda x: F.split(x, ","))
        first = F.get(lists, F.lit(0))
        same = F.forall(lists, lambda x: F.size(x) == F.size(first))
        summed = F.array_join(F.transform(first, lambda _, i: total(F.transform(lists, lambda x: F.get(x, i)))), ",")
        return F.when(same, summed).otherwise(F.raise_error(F.lit("lists of unlike length can't be added up")))

    def extreme(found: Column, pick) -> Column:
        return text(pick(F.transform(found, lambda x: x.try_cast("decimal(38,6)"))))

    how = {"sum": total, "sum_each": places, "min": lambda x: extreme(x, F.array_min), "max": lambda x: extreme(x, F.array_max)}

    def one(k: Column) -> Column:
        found = values(k)
        out = F.get(found, F.lit(0))
        for tag, name in joiners.items():
            out = F.when((k == tag) & (F.size(found) > 1), how[name](found)).otherwise(out)
        return out

    keys = F.array_sort(F.array_distinct(F.flatten(F.transform(infos, F.map_keys))))
    return F.map_from_arrays(keys, F.transform(keys, one))


def merge_calls(
    records: DataFrame, cells: DataFrame, samples: list[str], numbers: dict[str, str] | None = None, absent: str = ".", joiners: dict[str, str] | None = None, collapse: str | None = None, trim: bool = False,
) -> DataFrame:
    """U4: sets of calls merged site by site with all their samples: chrom, pos, id, ref, alts, qual, filter, info (map), format (array) and samples (array of texts in the
    order of `samples`).

    records: rec (unique), src, chrom, pos, id, ref, alts, qual, filter, info, n_samples, of which merge_records says how they meet and what becomes of id, qual and filter; cells: rec,
    sample, gt, tags (map of the other FORMAT tags). Genotypes and the arrays of tags that `numbers` calls A (by alternative), R (by allele) or G (by
    genotype) are put in the order of the merged alleles, with dots for those that the set lacks; other tags stay. A sample without a cell at a site has the genotype
    `absent` ("." or, say, "0/0") and dots. INFO is joined as joined_info says (DP, MQ0, DP4 and I16 added up unless `joiners` is given); SF lists the sets of the site, with an f
    after those whose filter isn't passed; AN and AC are counted anew from the genotypes. With `trim`, alternatives that no genotype has go. Of several cells
    of a sample at a site that of the first set, then record, counts. What is gathered for a site is a row of the merged table: its sets and its samples.
    """
    numbers, joiners = numbers or {}, SUMS if joiners is None else joiners
    x = matched_records(records, collapse).withColumn("ref", F.col("_longest"))
    failed = F.exists(F.coalesce("filter", F.array().cast("array<string>")), lambda f: ~f.isin("PASS", "."))
    good, w = F.col("qual") > 0, F.greatest(F.col("n_samples"), F.lit(1))
    named = F.concat(F.col("src").cast("string"), F.when(failed, "f").otherwise(""))
    line = F.struct("src", "rec", F.col("_alts").alias("alts"), F.map_entries("info").alias("info"), "id", named.alias("name"))
    sites = x.groupBy(*SITE).agg(
        F.array_sort(F.collect_list(line)).alias("_lines"), (F.sum(F.when(good, F.col("qual") * w)) / F.sum(F.when(good, w))).alias("qual"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("filter")))).alias("_filter")
    )
    others = F.filter("_filter", lambda f: ~f.isin("PASS", "."))
    info = F.map_filter(joined_info(F.transform("_lines", lambda r: F.map_from_entries(F.coalesce(r["info"], F.array().cast("array<struct<key:string,value:string>>")))), joiners), lambda k, _: ~k.isin("AN", "AC", "SF"))
    sites = sites.select(
        *SITE, "qual", F.array_distinct(F.flatten(F.transform("_lines", lambda r: r["alts"]))).alias("_all"), info.alias("info"), F.array_join(F.transform("_lines", lambda r: r["name"]), ",").alias("_sf"),
        F.get(F.filter(F.transform("_lines", lambda r: r["id"]), lambda i: i.isNotNull()), F.lit(0)).alias("id"), F.when(F.size(others) > 0, others).when(F.size("_filter") > 0, F.array(F.lit("PASS"))).alias("filter"),
    )
    placed = cells.join(x.select("rec", "src", *SITE, F.col("_alts").alias("_own")), "rec")
    if trim:
        index = F.explode(F.regexp_extract_all("gt", F.lit("([0-9]+)"), F.lit(1)))
        used = placed.select(*SITE, "_own", index.alias("_i")).withColumn("_a", F.get("_own", F.col("_i").cast("int") - 1)).groupBy(*SITE).agg(F.collect_set("_a").alias("_used"))
        sites = sites.join(used, SITE, "left").withColumn("_all", F.filter("_all", lambda a: F.array_contains(F.coalesce("_used", F.array().cast("array<string>")), a))).drop("_used")
    back = placed.join(sites.select(*SITE, F.col("_all").alias("alts")), SITE).withColumn("_back", allele_map(F.col("_own"), F.col("alts")))
    moved = {
        "A": lambda v: by_allele(v, F.col("_back"), False),
        "R": lambda v: by_allele(v, F.col("_back"), True),
        "G": lambda v: by_genotype(v, F.col("_back"), F.size("_own") + 1),
    }

    def tag(k: Column, v: Column) -> Column:
        out = v
        for name, number in numbers.items():
            if number in moved:
                out = F.when((k == name) & (v != "."), F.array_join(moved[number](F.split(v, ",")), ",")).otherwise(out)
        return out

    back = back.withColumns({"_gt": moved_genotype(F.col("gt"), F.col("_back")), "_tags": F.transform_values("tags", tag)})
    one = back.groupBy(*SITE, "sample").agg(F.min_by(F.struct(F.col("_gt").alias("gt"), F.map_entries("_tags").alias("tags")), F.struct("src", "rec")).alias("cell"))
    gathered = one.groupBy(*SITE).agg(F.map_from_entries(F.collect_list(F.struct("sample", "cell"))).alias("_cells"))
    keys = F.array_sort(F.array_distinct(F.flatten(F.transform(F.map_values("_cells"), lambda c: F.transform(c["tags"], lambda e: e["key"])))))
    out = sites.join(gathered, SITE, "left").withColumn("format", F.concat(F.array(F.lit("GT")), F.filter(F.coalesce(keys, F.array().cast("array<string>")), lambda k: k != "GT")))

    def cell(s: Column) -> Column:
        found = F.try_element_at("_cells", s)
        value = lambda k: F.coalesce(F.get(F.filter(found["tags"], lambda e: e["key"] == k), F.lit(0))["value"], F.lit("."))
        return F.array_join(F.transform("format", lambda k: F.when(k == "GT", F.coalesce(found["gt"], F.lit(absent))).otherwise(value(k))), ":")

    roster = F.array(*map(F.lit, samples)) if samples else F.array().cast("array<string>")
    out = out.withColumn("samples", F.transform(roster, cell))
    called = F.flatten(F.transform("samples", lambda c: F.regexp_extract_all(F.substring_index(c, ":", 1), F.lit("([0-9]+)"), F.lit(1))))
    counts = F.array_join(F.transform("_all", lambda _, i: F.size(F.filter("_called", lambda a: a == (i + 1).cast("string"))).cast("string")), ",")
    extra = F.map_from_arrays(F.array(*map(F.lit, ("AN", "AC", "SF"))), F.array(F.size("_called").cast("string"), counts, F.col("_sf")))
    return out.withColumn("_called", called).select("chrom", "pos", "id", "ref", F.col("_all").alias("alts"), "qual", "filter", F.map_concat("info", extra).alias("info"), "format", "samples")
