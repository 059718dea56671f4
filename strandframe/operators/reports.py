"""Hierarchy joins and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def current(df: DataFrame) -> DataFrame:
    """The rows that are the latest versions, where a table has such a column."""
    return df.where("latest").drop("latest") if "latest" in df.columns else df


def hierarchy_join(levels: list[tuple[DataFrame, str, str | None]]) -> DataFrame:
    """One row of each item of the lowest level with all levels above it. Levels come from the lowest up, each as a table, its own key and the column that
    names the next level's key (None for the top one); columns of all tables differ but for these. Only latest versions are joined; Spark
    broadcasts the upper tables where they are small."""
    out, _, above = levels[0]
    out = current(out)
    for table, key, parent in levels[1:]:
        out, above = out.join(current(table), F.col(above) == F.col(key)), parent
    return out


def missing_children(parents: DataFrame, children: DataFrame, key: str, child_key: str) -> DataFrame:
    """Parents that no child names."""
    return parents.join(children.select(F.col(child_key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_anti")


def coverage_by_level(lanes: DataFrame, genome_size: int, levels: list[str], qc: list[str] | None = None, gt: list[str] | None = None, mapped: bool = False) -> DataFrame:
    """Raw bases over genome size at each level of a hierarchy, and of all, in one pass (null: all of that level), of lanes that aren't withdrawn and have one
    of the given QC and genotype statuses. With `mapped`, bases are scaled by the share that duplicates leave (rmdup_bases of mapped_raw_bases) where a
    genotype ratio is known, else they are the mapped ones, else nine tenths of the raw ones."""
    kept = lanes.where(~F.coalesce("withdrawn", F.lit(False)))
    kept = kept.where(F.col("qc_status").isin(qc)) if qc else kept
    kept = kept.where(F.col("gt_status").isin(gt)) if gt else kept
    scaled = F.when(F.col("gt_ratio").isNotNull(), F.try_divide(F.col("raw_bases") * F.col("rmdup_bases"), F.col("mapped_raw_bases")))
    bases = F.coalesce(scaled, F.col("bases_mapped"), F.col("raw_bases") * 0.9) if mapped else F.col("raw_bases")
    return kept.rollup(*levels).agg(F.sum(bases).cast("double").alias("bases"), (F.sum(bases) / genome_size).alias("coverage"))


def status_matrix(lanes: DataFrame, keys: list[str], genome_size: int) -> DataFrame:
    """Lanes and bases of each group (project, population, individual) by QC and by genotype status, and the coverage of what passed."""
    of = lambda c, s: F.col(c) == s
    made = []
    for column, values in (("qc_status", ("passed", "failed", "pending", "no_qc")), ("gt_status", ("confirmed", "wrong", "unchecked"))):
        made += [F.count_if(of(column, s)).alias(f"n_{s}") for s in values] + [F.sum(F.when(of(column, s), F.col("raw_bases")).otherwise(0)).alias(f"bases_{s}") for s in values]
    return lanes.groupBy(*keys).agg(*made).withColumn("pass_coverage", F.col("bases_passed") / genome_size)


def yield_by_month(lanes: DataFrame) -> DataFrame:
    """Lanes, bases and mean quality (weighted by bases) of each month of run dates and read length, with totals of each month and of all (null)."""
    x = lanes.withColumn("month", (F.year("run_date") * 100 + F.month("run_date")).cast("long"))
    quality = F.try_divide(F.sum(F.col("mean_quality") * F.col("raw_bases")), F.sum("raw_bases"))
    return x.rollup("month", "read_len").agg(F.count("*").alias("n_lanes"), F.sum("raw_bases").alias("bases"), quality.alias("mean_quality"))


def finished_samples(lanes: DataFrame, since: Column, bases: int) -> DataFrame:
    """Samples whose lanes have so many bases now and had not before a date, with both sums; one aggregate gives both."""
    before = F.sum(F.when(F.col("run_date") < since, F.col("raw_bases")).otherwise(0))
    return lanes.groupBy("sample").agg(F.sum("raw_bases").alias("bases"), before.alias("before")).where((F.col("bases") >= bases) & (F.col("before") < bases))


def auto_qc(stats: DataFrame, limits: dict[str, float], genotypes: list[str]) -> DataFrame:
    """A row of each test of each lane (lane_id, test, value, passed; value null where it can't be had, which fails). Tests: empty (sequences), genotype (status
    among those given), mapped (% of bases after trimming; at least), error_rate (at most), indel_ratio (insertions by deletions; at most, and some
    deletions), and of paired lanes peak_amount (% of inserts near the peak; at least) and peak_range (% around it that holds the bulk; at most). Tests
    of mapping and inserts are left out for empty lanes."""
    number = lambda c: c.cast("double")
    some, paired = F.col("sequences") > 0, F.col("is_paired")
    mapped = F.try_divide(100 * F.col("bases_mapped_cigar"), F.col("total_length") - F.col("bases_trimmed"))
    ratio = F.try_divide(F.col("insertions"), F.col("deletions"))
    tests = [
        ("empty", F.lit(True), number(F.col("sequences")), some), ("genotype", F.lit(True), F.lit(None).cast("double"), F.col("gt_status").isin(genotypes)), ("mapped", some, number(mapped), mapped >= limits["mapped"]),
        ("error_rate", F.lit(True), number(F.col("error_rate")), F.col("error_rate") <= limits["error_rate"]), ("indel_ratio", F.lit(True), number(ratio), ratio <= limits["indel_ratio"]),
        ("peak_amount", some & paired, number(F.col("peak_amount")), F.col("peak_amount") >= limits["peak_amount"]), ("peak_range", some & paired, number(F.col("peak_range")), F.col("peak_range") <= limits["peak_range"]),
    ]
    rows = F.array(*(F.when(applies, F.struct(F.lit(name).alias("test"), value.alias("value"), F.coalesce(passed, F.lit(False)).alias("passed"))) for name, applies, value, passed in tests))
    return stats.select("lane_id", F.explode(F.array_compact(rows)).alias("t")).select("lane_id", "t.*")


def qc_verdict(tests: DataFrame) -> DataFrame:
    """Each lane's verdict, that all tests pass but those of inserts, and that of its library, which those decide (null without such tests)."""
    insert = F.col("test").isin("peak_amount", "peak_range")
    return tests.groupBy("lane_id").agg(F.coalesce(F.bool_and(F.when(~insert, F.col("passed"))), F.lit(True)).alias("lane_passed"), F.bool_and(F.when(insert, F.col("passed"))).alias("library_passed"))


def mapping_report(reads: DataFrame, genome_size: int, qc: Column | None = None) -> DataFrame:
    """Percentages of mapped, proper and duplicate reads and of mapped bases of each read group, its error rate, depths with and without duplicates, and share
    of the genome's bases; rows where `qc` holds come from a part of the reads, so their depths are null."""
    bit = lambda mask: F.col("flag").bitwiseAND(F.lit(mask)) != 0
    share = lambda c: 100 * F.count_if(c) / F.count("*")
    bases = lambda c: F.sum(F.when(c, F.col("seq_len")).otherwise(0))
    out = reads.groupBy("rg").agg(
        F.count("*").alias("n"), share(~bit(4)).alias("pct_mapped"), share(bit(2)).alias("pct_proper"), share(bit(1024)).alias("pct_dup"), (100 * bases(~bit(4)) / F.sum("seq_len")).alias("pct_bases_mapped"),
        F.try_divide(F.sum(F.when(~bit(4), F.col("nm")).otherwise(0)), bases(~bit(4))).alias("error_rate"), (bases(~bit(4)) / genome_size).alias("depth"), (bases(~bit(4) & ~bit(1024)) / genome_size).alias("rmdup_depth"),
    )
    part = F.coalesce(qc, F.lit(False)) if qc is not None else F.lit(False)
    return out.withColumns({"row_type": F.when(part, "QC").otherwise("Mapping"), **{c: F.when(~part, F.col(c)) for c in ("depth", "rmdup_depth")}})


def usage_rollup(files: DataFrame, levels: list[str], size: str, limits: DataFrame | None = None) -> DataFrame:
    """Size and number by levels (root, type), with totals, the share of all and, given limits (first level, limit), the percentage of these; largest first."""
    x = files.rollup(*levels).agg(F.sum(size).alias("bytes"), F.count("*").alias("n"))
    x = x.withColumn("share", F.col("bytes") / F.max("bytes").over(Window.partitionBy()))  # a row for each group
    if limits is not None:
        x = x.join(F.broadcast(limits.select(levels[0], "limit")), levels[0], "left").withColumn("pct_of_limit", F.try_divide(100 * F.col("bytes"), F.col("limit"))).drop("limit")
    return x.orderBy(F.desc("bytes"))


def most_common_value(df: DataFrame, key: str, field: str) -> DataFrame:
    """The most frequent value of each key, the smallest on ties."""
    counts = df.groupBy(key, field).agg(F.count("*").alias("n"))
    top = counts.groupBy(key).agg(F.max("n").alias("n"))
    return counts.join(top, [key, "n"]).groupBy(key, "n").agg(F.min(field).alias(field))


def common_values(df: DataFrame, key: str, field: str, k: int = 100) -> DataFrame:
    """A47, list form: the k most frequent distinct values of each key, with their counts and places, most frequent first and the smallest first on ties."""
    counts = df.groupBy(key, field).agg(F.count("*").alias("n"))
    return counts.withColumn("place", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("n"), field))).where(F.col("place") <= k)


def release_selection(lanes: DataFrame, conditions: dict[str, Column], strict: bool = False) -> DataFrame:
    """Lanes for which all conditions hold (mapped, improved, genotype and so on) and whose QC passed: by hand (manual_qc) where that was done, else
    automatically (auto_qc). With `strict`, a sample one of whose lanes fails is left out as a whole; that is one aggregate by sample, joined back."""
    ok = F.coalesce(F.col("manual_qc") == "passed", F.col("auto_qc") == "passed", F.lit(False))
    for c in conditions.values():
        ok = ok & F.coalesce(c, F.lit(False))
    x = lanes.withColumn("_ok", ok)
    good = x.where("_ok").drop("_ok")
    return good.join(x.where("NOT _ok").select("project", "sample").distinct(), ["project", "sample"], "left_anti") if strict else good


def paths(lanes: DataFrame) -> DataFrame:
    """M9: each lane's path: project, sample, library and lane, joined with /."""
    return lanes.select("lane_id", F.concat_ws("/", "project", F.translate("sample", " ", "_"), "library_id", "lane_id").alias("path"))


def descendants(lanes: DataFrame, project: str) -> DataFrame:
    """M6: all samples, libraries and lanes below a project, by level."""
    mine = lanes.where(F.col("project") == project)
    levels = F.array(*(F.struct(F.lit(n).alias("level"), F.col(c).cast("string").alias("id")) for n, c in (("sample", "sample"), ("library", "library_id"), ("lane", "lane_id"))))
    return mine.select(F.explode(levels).alias("x")).select("x.*").distinct()


def cascade_delete(tables: dict[str, DataFrame], keys: dict[str, str], gone: DataFrame) -> dict[str, DataFrame]:
    """M6: tables of several levels without the rows whose key (by level) is among the deleted ones (level, id, as descendants() gives them)."""
    left = {}
    for level, table in tables.items():
        ids = gone.where(F.col("level") == level).select(F.col("id").alias("_id"))
        left[level] = table.join(ids, F.col(keys[level]).cast("string") == F.col("_id"), "left_anti")
    return left


def sync_tables(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Keys to insert (only in source) and to delete (only in target)."""
    s, t = source.select(key).distinct(), target.select(key).distinct()
    return s.join(t, key, "left_anti").withColumn("action", F.lit("insert")).union(t.join(s, key, "left_anti").withColumn("action", F.lit("delete")))


def imported_counts(orig: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys with their counts and bases on both sides and whether these agree."""
    both = orig.join(new, key, "full")
    same = F.col("n_reads").eqNullSafe(F.col("new_reads")) & F.col("n_bases").eqNullSafe(F.col("new_bases"))
    return both.withColumn("agree", same)


def natural_order(df: DataFrame) -> DataFrame:
    """O1: rows by chromosome (numbers first, in numeric order) and position."""
    number = F.expr("try_cast(regexp_extract(chrom, '([0-9]+)$', 1) AS INT)")
    return df.orderBy(number.isNull(), number, "chrom", "pos")


def mixed_order(c: Column) -> list[Column]:
    """O2: sort keys by which names that are numbers come first, in numeric order, and the others after them as texts; with a position, chr:pos order."""
    number = F.when(c.rlike("^[0-9]+$"), c.try_cast("decimal(38,0)"))
    return [number.isNull(), number, c]


def gene_order(c: Column) -> list[Column]:
    """O3: sort keys of gene ids: the text before the first dot, then the number that what follows begins with (0 if none)."""
    rest = F.regexp_extract(c, "^[^.]*[.]([0-9]+)", 1)
    return [F.substring_index(c, ".", 1), F.coalesce(rest.try_cast("long"), F.lit(0))]


def first_places(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows in an order and their places: a limit that each partition takes before rows meet."""
    first = df.orderBy(*order).limit(n)
    return first.withColumn("place", F.row_number().over(Window.orderBy(*order)))  # n rows


def page(df: DataFrame, order: list, offset: int, limit: int) -> DataFrame:
    """One page of an ordered result."""
    return df.orderBy(*order).offset(offset).limit(limit)


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column."""
    return df.select(column).distinct()


def pending(requests: DataFrame, states: list[str], *by: str) -> DataFrame:
    """Requests in given states, by state and further columns such as type and study."""
    return requests.where(F.col("state").isin(states)).groupBy("state", *by).agg(F.count("*").alias("n"))


def runtime_stats(logs: DataFrame, *by: str) -> DataFrame:
    """Of each job's last attempt (job, attempt, host, started, wall, cpu, memory): jobs, least, largest and mean memory, wall and CPU seconds and idle factor (CPU by
    wall seconds, each at least 1), the span from the first start to the last end in seconds (starts rounded to whole ones, halves to even ones), and hosts; in all, or by columns."""
    rest = [c for c in logs.columns if c not in ("job", "attempt")]
    last = logs.groupBy("job").agg(F.max_by(F.struct(*rest), F.struct("attempt", "started")).alias("v")).select("v.*")
    x = last.withColumns({"idle": F.greatest(F.col("cpu"), F.lit(1)) / F.greatest(F.col("wall"), F.lit(1)), "_begin": F.rint(F.unix_micros(F.col("started").cast("timestamp")) / 1e6).cast("long")})
    made = [F.count("*").alias("jobs"), (F.max(F.col("_begin") + F.col("wall")) - F.min("_begin")).alias("span"), F.count_distinct("host").alias("hosts")]
    for c in ("memory", "wall", "cpu", "idle"):
        made += [F.min(c).alias(f"least_{c}"), F.max(c).alias(f"most_{c}"), F.avg(c).alias(f"mean_{c}")]
    return x.groupBy(*by).agg(*made) if by else x.agg(*made)


def merge_reports(reports: list[DataFrame], keys: list[str]) -> DataFrame:
    """Counts of several histograms added by key, and each key's share of the total."""
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out.groupBy(*keys).agg(F.sum("n").alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def merge_percentages(reports: list[tuple[DataFrame, int]], keys: list[str], value: str) -> DataFrame:
    """Percentages of several reports by key, weighted by the reports' totals; a key that a report lacks counts as 0 there."""
    total = sum(n for _, n in reports)
    parts = [r.select(*keys, (F.col(value) * n).alias("_v")) for r, n in reports]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy(*keys).agg((F.sum("_v") / total).alias(value))


def merged_averages(reports: list[DataFrame], bin_col: str = "bin", n: str = "n") -> DataFrame:
    """Total, mean and population sd recomputed from histograms (of lengths, qualities, inserts) added up."""
    x = merge_reports([r.select(F.col(bin_col).alias("bin"), F.col(n).alias("n")) for r in reports], ["bin"])
    mean = F.sum(F.col("bin") * F.col("n")) / F.sum("n")
    return x.agg(F.sum("n").alias("total"), mean.alias("mean"), F.sqrt(F.greatest(F.lit(0.0), F.sum(F.col("bin") ** 2 * F.col("n")) / F.sum("n") - mean * mean)).alias("sd"))


def rebin(hist: DataFrame, size: int, bin_col: str = "bin", n: str = "n") -> DataFrame:
    """A histogram (of coverage) in bins of another size, each named by its lowest value."""
    return hist.groupBy((F.floor(F.col(bin_col) / size) * size).cast("long").alias(bin_col)).agg(F.sum(n).alias(n))


def sample_names(df: DataFrame, names: list[str]) -> DataFrame:
    """Distinct combinations of names (supplier, sample, accession), N/A where one is missing."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("N/A")).alias(c) for c in names)).distinct()
