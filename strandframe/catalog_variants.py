"""Queries of variant tables, over the bridge views (see catalog)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import _INDEL, _TS, B, Views, query
from .operators import intervals, reports, variants

# Variants with two alternatives in every fifth row, and with equal alleles in every ninth.
_WIDE = """w AS (SELECT * REPLACE (CASE WHEN var_id % 9 = 0 THEN ref ELSE alt END AS alt), CASE WHEN var_id % 5 = 0 THEN [CASE WHEN var_id % 9 = 0 THEN ref ELSE alt END, 'ATG'] ELSE [CASE WHEN var_id % 9 = 0 THEN ref ELSE alt END] END AS alts FROM br_variants)"""


def _wide(v: Views) -> DataFrame:
    x = v("br_variants").withColumn("alt", F.when(F.col("var_id") % 9 == 0, F.col("ref")).otherwise(F.col("alt")))
    return x.withColumn("alts", F.when(F.col("var_id") % 5 == 0, F.array("alt", F.lit("ATG"))).otherwise(F.array("alt")))


@query(
    "P5_soft_filter",
    f"""WITH {_WIDE} SELECT var_id, coalesce(nullif(concat_ws(';', CASE WHEN NOT {_INDEL} AND qual < 30 THEN 'LowQual' END, CASE WHEN {_INDEL} AND qual <= 50 THEN 'LowIndel' END, CASE WHEN dp < 5 THEN 'MinDP' END, CASE WHEN dp % 7 > 4 AND dp % 2 = 0 THEN 'GT' END), ''), 'PASS') AS filters FROM w WHERE ref <> alt""",
)
def _(v: Views) -> DataFrame:
    rules = variants.table_rules([("snp", "QUAL", "<", 30, "LowQual"), ("indel", "QUAL", "<=", 50, "LowIndel"), ("all", "DP", "<", 5, "MinDP"), ("all", "GENOTYPE/GQ", ">", 4, "GT")])
    genotype = F.when(F.col("dp") % 2 == 0, F.create_map(F.lit("GQ"), (F.col("dp") % 7).cast("string"))).otherwise(F.create_map(F.lit("GT"), F.lit("0/1")))
    return variants.soft_filter(_wide(v).withColumns({"info": F.create_map(F.lit("DP"), F.col("dp").cast("string")), "genotype": genotype}), rules).select("var_id", "filters")


@query(
    "P7_custom_filters",
    f"""SELECT var_id, coalesce(nullif(concat_ws(';', CASE WHEN NOT {_INDEL} AND qual < 30 THEN 'LowQual' END, CASE WHEN {_INDEL} AND qual < 50 THEN 'LowIndel' END, CASE WHEN dp < 5 THEN 'MinDP' END, CASE WHEN dp > 45 THEN 'MaxDP' END), ''), 'PASS') AS filters FROM br_variants""",
)
def _(v: Views) -> DataFrame:
    rules = [variants.Rule("LowQual", "snp", F.col("qual") >= 30), variants.Rule("LowIndel", "indel", F.col("qual") >= 50), variants.Rule("MinDP", "all", F.col("dp") >= 5), variants.Rule("MaxDP", "all", F.col("dp") <= 45)]
    return variants.rule_filter(v("br_variants"), rules).select("var_id", "filters")


_SNP = "length(ref) = 1 AND length(alt) = 1 AND ref <> alt"
_TSTV = f"{B('count(*)')} AS total, {B(f'count(*) FILTER ({_SNP} AND {_TS})')} AS ts, {B(f'count(*) FILTER ({_SNP} AND NOT {_TS})')} AS tv, {B(f'count(*) FILTER (NOT ({_SNP}))')} AS skipped, round(count(*) FILTER ({_SNP} AND {_TS}) / CAST(nullif(count(*) FILTER ({_SNP} AND NOT {_TS}), 0) AS DOUBLE), 6) AS ratio"


@query("A17_ts_tv", f"SELECT {_TSTV} FROM br_variants")
def _(v: Views) -> DataFrame:
    return variants.ts_tv(v("br_variants"))


@query("A17_ts_tv_by_qual", f"SELECT {B('floor(qual / 10.0) * 10')} AS qual_bin, {_TSTV} FROM br_variants GROUP BY 1")
def _(v: Views) -> DataFrame:
    return variants.ts_tv(v("br_variants").withColumn("qual_bin", F.floor(F.col("qual") / 10) * 10), "qual_bin")


@query(
    "A15_variant_spectra",
    f"""WITH {_WIDE}, k AS (SELECT *, 'all' AS grp, '' AS val FROM w UNION ALL SELECT *, 'filter', filt FROM w UNION ALL SELECT *, 'depth', CASE WHEN dp // 10 * 10 > 30 THEN '>30' ELSE CAST(dp // 10 * 10 AS VARCHAR) END FROM w WHERE dp % 6 <> 0 UNION ALL SELECT *, 'depth', '.' FROM w WHERE dp % 6 = 0),
e AS (SELECT grp, val, ref, unnest(alts) AS alt FROM k),
t AS (SELECT *, length(alt) - length(ref) AS d FROM e),
s AS (SELECT grp, val, 'n_alts' AS stat, CAST(len(alts) AS VARCHAR) AS key FROM k
 UNION ALL SELECT grp, val, 'type', CASE WHEN ref = alt THEN 'ref' WHEN d = 0 THEN 'snp' WHEN starts_with(alt, ref) OR suffix(alt, ref) THEN 'ins' ELSE 'complex' END FROM t
 UNION ALL SELECT grp, val, 'indel', CAST(d AS VARCHAR) FROM t WHERE d > 0 AND (starts_with(alt, ref) OR suffix(alt, ref)) UNION ALL SELECT grp, val, 'substitution', ref || '>' || alt FROM t WHERE d = 0 AND ref <> alt)
SELECT grp, val, stat, key, {B("count(*)")} AS n FROM s GROUP BY ALL""",
)
def _(v: Views) -> DataFrame:
    depth = F.when(F.col("dp") % 6 != 0, F.col("dp"))
    return variants.variant_spectra(_wide(v), {"all": F.lit(""), "filter": F.col("filt"), "depth": variants.binned(depth, 10, 30)})


@query(
    "A18_qual_tstv_curve",
    f"""WITH k AS (SELECT DISTINCT chrom, pos FROM br_calls), s AS (SELECT v.*, ref <> alt AS snp, k.pos IS NOT NULL AS hit FROM br_variants v LEFT JOIN k USING (chrom, pos) WHERE length(ref) = 1 AND length(alt) = 1),
q AS (SELECT qual, count(*) AS n, count(*) FILTER (snp) AS snps, count(*) FILTER (snp AND {_TS}) AS ts, count(*) FILTER (hit) AS joint FROM s GROUP BY qual),
c AS (SELECT qual, sum(n) OVER w AS n, sum(n) OVER w - n AS before, sum(snps) OVER w AS snps, sum(ts) OVER w AS ts, sum(joint) OVER w AS joint, sum(n) OVER () AS total, min(qual) OVER () AS lowest FROM q WINDOW w AS (ORDER BY qual DESC)),
r AS (SELECT * FROM c WHERE floor(round(CAST(n AS DOUBLE) / total / 0.1, 9)) > floor(round(CAST(before AS DOUBLE) / total / 0.1, 9)) OR qual = lowest),
m AS (SELECT *, ts - coalesce(lag(ts) OVER (ORDER BY qual DESC), 0) AS dts, snps - coalesce(lag(snps) OVER (ORDER BY qual DESC), 0) AS ds FROM r)
SELECT qual, {B("n")} AS cum_n, {B("snps")} AS cum_snps, {B("ts")} AS cum_ts, {B("joint")} AS cum_joint, round(ts / CAST(nullif(snps - ts, 0) AS DOUBLE), 6) AS ts_tv, round(joint / CAST((SELECT count(*) FROM k) AS DOUBLE), 6) AS share_of_known,
 round(joint / CAST(nullif(snps, 0) AS DOUBLE), 6) AS share_of_snps, round(dts / CAST(nullif(ds - dts, 0) AS DOUBLE), 6) AS marginal_ts_tv FROM m""",
)
def _(v: Views) -> DataFrame:
    return variants.qual_tstv_curve(v("br_variants"), v("br_calls"), 0.1)


@query(
    "A19_indel_spectrum",
    f"""WITH {_WIDE}, e AS (SELECT ref, unnest(alts) AS a, 1.0 / len(alts) AS w FROM w WHERE NOT (length(ref) = 1 AND len(list_filter(alts, lambda x: length(x) <> 1)) = 0)), s AS (SELECT length(a) - length(ref) AS size, sum(w) AS weight FROM e GROUP BY 1)
SELECT {B("size")} AS size, round(weight, 6) AS weight, size % 3 = 0 AS inframe, round(sum(CASE WHEN size % 3 = 0 THEN weight ELSE 0 END) OVER () / CAST(sum(weight) OVER () AS DOUBLE), 6) AS share3 FROM s""",
)
def _(v: Views) -> DataFrame:
    return variants.indel_spectrum(_wide(v))


_LONG = "l AS (SELECT var_id, chrom, pos, CASE WHEN var_id % 3 = 0 THEN repeat('A', CAST(var_id % 40 + 2 AS INTEGER)) ELSE 'A' END AS ref, CASE WHEN var_id % 3 = 1 THEN repeat('A', CAST(var_id % 7 + 2 AS INTEGER)) ELSE 'A' END AS alt FROM br_variants)"


def _long(v: Views) -> DataFrame:
    run = lambda n: F.repeat(F.lit("A"), (F.col("var_id") % n + 2).cast("int"))
    return v("br_variants").select("var_id", "chrom", "pos", F.when(F.col("var_id") % 3 == 0, run(40)).otherwise("A").alias("ref"), F.when(F.col("var_id") % 3 == 1, run(7)).otherwise("A").alias("alt"))


_CHANGE = "(length(alt) - length(ref))"


@query(
    "A19_inframe_ratio",
    f"""WITH {_LONG}, e AS (SELECT chrom, k * 60 + 1 AS s, k * 60 + 31 AS e FROM (SELECT DISTINCT chrom FROM br_intervals) CROSS JOIN (SELECT unnest(range(90)) AS k)),
h AS (SELECT CASE WHEN {_CHANGE} > 0 THEN {_CHANGE} ELSE least(pos - {_CHANGE}, e) - greatest(pos + 1, s) + 1 END AS size FROM l JOIN e USING (chrom) WHERE {_CHANGE} <> 0 AND pos + 1 <= e AND CASE WHEN {_CHANGE} > 0 THEN pos + 1 ELSE pos - {_CHANGE} END >= s)
SELECT {B("count(*)")} AS n, {B("count(*) FILTER (size % 3 = 0)")} AS inframe, round(count(*) FILTER (size % 3 = 0) / CAST(count(*) AS DOUBLE), 6) AS ratio FROM h""",
)
def _(v: Views) -> DataFrame:
    starts = v("br_intervals").select("chrom").distinct().withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(89).cast("long"))))
    return variants.inframe_ratio(_long(v), starts.select("chrom", (F.col("k") * 60 + 1).alias("start_pos"), (F.col("k") * 60 + 31).alias("end_pos")))


_SHARE = "floor(round(CAST({} AS DOUBLE) / total / 0.05, 9))".format


@query(
    "A55_annotation_distribution",
    f"""WITH c AS (SELECT CAST(qual AS DOUBLE) AS value, count(*) AS n FROM br_variants GROUP BY qual), r AS (SELECT value, n, sum(n) OVER (ORDER BY value) AS cum, sum(n) OVER () AS total, max(value) OVER () AS top FROM c)
SELECT value, {B("n")} AS n, round(CAST(cum AS DOUBLE) / total, 6) AS cum_share FROM r WHERE {_SHARE("cum")} > {_SHARE("cum - n")} OR value = top""",
)
def _(v: Views) -> DataFrame:
    return variants.annotation_distribution(v("br_variants"), "qual", 0.05)


_DP4 = "d AS (SELECT dp + qual AS x FROM br_variants WHERE dp % 8 <> 0)"


@query(
    "A55_annotation_histogram",
    f"""WITH {_DP4}, o AS (SELECT x, row_number() OVER (ORDER BY x) AS k, count(*) OVER () AS n FROM d), m AS (SELECT min(x) FILTER (k >= 0.01 * n) AS lo, min(x) FILTER (k >= 0.99 * n) AS hi FROM o)
SELECT {B("least(69, greatest(0, floor((x - lo) * 70 / CAST(hi - lo AS DOUBLE))))")} AS bin, CAST(lo AS DOUBLE) AS low, CAST(hi AS DOUBLE) AS high, {B("count(*)")} AS n FROM d CROSS JOIN m GROUP BY 1, 2, 3""",
)
def _(v: Views) -> DataFrame:
    text = F.when(F.col("dp") % 8 != 0, F.concat_ws(",", F.lit(1), F.lit(2), "dp", "qual"))
    return variants.annotation_histogram(v("br_variants").select(variants.annotation_value(text, strand_depths=True).alias("x")), "x")


@query(
    "A56_joint_distribution",
    f"""WITH x AS (SELECT CASE WHEN qual % 10 = 0 THEN 50 ELSE qual END AS a, dp AS b FROM br_variants WHERE dp % 7 <> 0),
c AS (SELECT least(9, {B("floor((greatest(5, least(95, a)) - 5) * 10 / 90.0)")}) AS i, least(9, {B("floor((greatest(2, least(48, b)) - 2) * 10 / 46.0)")}) AS j, a NOT BETWEEN 5 AND 95 OR b NOT BETWEEN 2 AND 48 AS o FROM x)
SELECT {B("i")} AS i, {B("j")} AS j, {B("count(*)")} AS n, round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share, round(sum(count(*) FILTER (o)) OVER () / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS clipped_share FROM c GROUP BY 1, 2""",
)
def _(v: Views) -> DataFrame:
    some = v("br_variants").select(F.when(F.col("qual") % 10 != 0, F.col("qual")).alias("a"), F.when(F.col("dp") % 7 != 0, F.col("dp")).alias("b"))
    return variants.joint_distribution(some, "a", "b", 10, (5, 2), (95, 48), (50, None))


@query("A58_scale_features", "SELECT var_id, round((greatest(10, least(90, qual)) - 10) / 80.0, 6) AS qual, round((greatest(5, least(45, dp)) - 5) / 40.0, 6) AS dp FROM br_variants")
def _(v: Views) -> DataFrame:
    return variants.scale_features(v("br_variants").select("var_id", "qual", "dp"), {"qual": (10.0, 90.0), "dp": (5.0, 45.0)})


@query(
    "A58_feature_margins",
    """WITH x AS (SELECT 'qual' AS feature, CAST(qual AS DOUBLE) AS value FROM br_variants UNION ALL SELECT 'dp', CAST(dp AS DOUBLE) FROM br_variants WHERE dp % 3 <> 0), o AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY value) AS k, count(*) OVER (PARTITION BY feature) AS n FROM x),
m AS (SELECT feature, min(value) AS least, max(value) AS largest, min(value) FILTER (k >= 0.05 * n) AS low, min(value) FILTER (k >= 0.95 * n) AS high FROM o GROUP BY feature)
SELECT feature, m.least, largest, low, high, round(count(*) FILTER (value NOT BETWEEN low AND high) / CAST(count(*) AS DOUBLE), 6) AS clipped_share FROM x JOIN m USING (feature) GROUP BY ALL""",
)
def _(v: Views) -> DataFrame:
    return variants.feature_margins(v("br_variants").select("qual", F.when(F.col("dp") % 3 != 0, F.col("dp")).alias("dp")), ["qual", "dp"], 0.05, 0.95)


_MIXED = """x AS (SELECT var_id, ref, CASE WHEN var_id % 11 = 0 THEN '<DEL>' WHEN var_id % 11 = 1 THEN 'A]2:321]' WHEN var_id % 11 = 2 THEN ref WHEN var_id % 11 = 3 THEN '.' ELSE alt END AS alt FROM br_variants)"""


@query(
    "X1_classify_variants",
    f"""WITH {_MIXED}, k AS (SELECT *, CASE WHEN contains(alt, ']') THEN 'b' WHEN alt = '<DEL>' THEN 'u' WHEN ref = alt OR alt = '.' THEN 'r' WHEN NOT {_INDEL} THEN 's' ELSE 'i' END AS kind FROM x)
SELECT var_id, kind, {B("CASE kind WHEN 's' THEN 1 WHEN 'i' THEN length(alt) - length(ref) ELSE 0 END")} AS size, CASE kind WHEN 'b' THEN 'break' WHEN 'u' THEN 'other' WHEN 'r' THEN 'ref' WHEN 's' THEN 'snp' ELSE 'ins' END AS type FROM k""",
)
def _(v: Views) -> DataFrame:
    k = F.col("var_id") % 11
    alt = F.when(k == 0, "<DEL>").when(k == 1, "A]2:321]").when(k == 2, F.col("ref")).when(k == 3, ".").otherwise(F.col("alt"))
    return variants.classify(v("br_variants").withColumn("alt", alt)).select("var_id", "kind", "size", "type")


@query("X2_compact_alleles", "SELECT var_id, ref, alt FROM br_variants")
def _(v: Views) -> DataFrame:
    longer = v("br_variants").withColumns({"ref": F.concat("ref", F.lit("GA")), "alt": F.concat("alt", F.lit("GA"))})
    return variants.compact_alleles(longer).select("var_id", "ref", "alt")


@query("X2_shifted_alleles", f"SELECT var_id, {B('''pos + CASE WHEN ref = 'T' THEN 1 ELSE 2 END''')} AS pos, CASE WHEN ref = 'T' THEN 'G' ELSE ref END AS ref, CASE WHEN ref = 'T' THEN 'GTT' ELSE alt END AS alt FROM br_variants WHERE {_INDEL}")
def _(v: Views) -> DataFrame:
    longer = v("br_variants").where(variants.is_indel()).withColumns({"ref": F.concat(F.lit("CG"), "ref", F.lit("G")), "alt": F.concat(F.lit("CG"), "alt", F.lit("G"))})
    return variants.compact_alleles(longer, shift=True).select("var_id", "pos", "ref", "alt")


@query(
    "X3_unify_ref",
    """WITH x AS (SELECT *, CASE WHEN var_id % 4 = 0 THEN 'ACGT' WHEN var_id % 4 = 1 THEN 'AG' ELSE 'AC' END AS r, CASE WHEN var_id % 3 = 0 THEN '<DEL>' ELSE alt END AS a FROM br_variants), m AS (SELECT chrom, pos, max({'n': length(r), 'r': r}).r AS l FROM x GROUP BY chrom, pos)
SELECT var_id, CASE WHEN starts_with(l, r) THEN l ELSE r END AS ref, CASE WHEN a = '<DEL>' OR NOT starts_with(l, r) THEN a ELSE concat(a, substr(l, length(r) + 1)) END AS alt, starts_with(l, r) AS agrees FROM x JOIN m USING (chrom, pos)""",
)
def _(v: Views) -> DataFrame:
    k = F.col("var_id") % 4
    made = v("br_variants").withColumn("ref", F.when(k == 0, "ACGT").when(k == 1, "AG").otherwise("AC")).withColumn("alt", F.when(F.col("var_id") % 3 == 0, "<DEL>").otherwise(F.col("alt")))
    return variants.unify_ref(made).select("var_id", "ref", "alt", "agrees")


_CHECKED = """x AS (SELECT *, var_id % 7 AS k, count(*) OVER (PARTITION BY chrom, pos) AS used, max(pos) OVER (PARTITION BY chrom ORDER BY var_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS back FROM br_variants)"""


@query(
    "X14_validate",
    f"""WITH {_CHECKED}, p AS (SELECT var_id, unnest([CASE WHEN used > 1 THEN 'repeated_position' END, CASE WHEN pos < back THEN 'order' END, CASE WHEN k = 0 THEN 'equal_alleles' END, CASE WHEN k = 1 THEN 'repeated_alternative' END, CASE WHEN k = 2 THEN 'alt_letters' END,
  CASE WHEN qual % 10 = 3 THEN 'quality' END, CASE WHEN filt = 'Brand#11' THEN 'undeclared_filter' END, CASE WHEN k = 3 THEN 'undeclared_info' END, CASE WHEN dp % 9 = 0 THEN 'type_of_DP' END, CASE WHEN k = 1 THEN 'number_of_AC' END,
  CASE WHEN k = 4 THEN 'number_of_DB' END, CASE WHEN dp % 5 = 4 THEN 'allele_range' END, CASE WHEN dp % 2 = 1 THEN 'wrong_an' END, CASE WHEN k = 1 OR dp % 5 <> 1 THEN 'wrong_ac' END]) AS problem FROM x)
SELECT var_id, problem FROM p WHERE problem IS NOT NULL""",
)
def _(v: Views) -> DataFrame:
    k, dp = F.col("var_id") % 7, F.col("dp")
    alts = F.when(k == 0, F.array("ref", "alt")).when(k == 1, F.array("alt", "alt")).when(k == 2, F.array(F.lit("X"))).otherwise(F.array("alt"))
    info = F.map_concat(
        F.create_map(F.lit("DP"), F.when(dp % 9 == 0, "many").otherwise("12"), F.lit("AC"), F.when(k == 0, "1,0").otherwise("1"), F.lit("AN"), F.when(dp % 2 == 1, "3").otherwise("2")),
        F.when(k == 3, F.create_map(F.lit("XX"), F.lit("1"))).when(k == 4, F.create_map(F.lit("DB"), F.lit("yes"))).otherwise(F.create_map().cast("map<string,string>")),
    )
    rows = v("br_variants").withColumns(
        {"alts": alts, "line_no": F.col("var_id"), "filter": F.array("filt"), "info": info, "qual": F.when(F.col("qual") % 10 == 3, -5).otherwise(30), "gt": F.array(F.lit(0), F.when(dp % 5 == 1, 1).when(dp % 5 == 4, 7).otherwise(0))}
    )
    filters = v("br_variants").where("filt <> 'Brand#11'").select("filt").distinct().select(F.lit("FILTER").alias("kind"), F.col("filt").alias("id"), F.lit("").alias("number"), F.lit("").alias("type"))
    kinds = F.array(*(F.struct(F.lit("INFO").alias("kind"), *(F.lit(x).alias(c) for x, c in zip(r, ("id", "number", "type"), strict=True))) for r in (("DP", "1", "Integer"), ("AC", "A", "Integer"), ("AN", "1", "Integer"), ("DB", "0", "Flag"))))
    header = filters.union(filters.limit(1).select(F.explode(kinds).alias("x")).select("x.*"))
    return variants.validate(rows, header)


@query("X14_validation_summary", f"WITH x AS (SELECT *, count(*) OVER (PARTITION BY chrom, pos) AS n FROM (SELECT var_id, chrom, pos // 4 AS pos, CASE WHEN var_id % 9 = 0 THEN alt ELSE ref END AS ref, alt FROM br_variants)), p AS (SELECT var_id, 'repeated_position' AS problem FROM x WHERE n > 1 UNION ALL SELECT var_id, 'position' FROM x WHERE pos < 1 UNION ALL SELECT var_id, 'equal_alleles' FROM x WHERE ref = alt) SELECT problem, {B('count(*)')} AS n, min(var_id) AS example FROM p GROUP BY problem")
def _(v: Views) -> DataFrame:
    rows = v("br_variants").withColumns({"pos": F.floor(F.col("pos") / 4), "ref": F.when(F.col("var_id") % 9 == 0, F.col("alt")).otherwise(F.col("ref"))})
    return variants.validation_summary(variants.validate(rows))


@query(
    "X15_class_label",
    f"""WITH i AS (SELECT DISTINCT var_id FROM br_variants v JOIN br_intervals i ON v.chrom = i.chrom AND v.pos BETWEEN start_pos AND end_pos WHERE iv_id % 4 = 0)
SELECT v.var_id, CASE WHEN v.var_id % 50 = 0 THEN 'good' WHEN i.var_id IS NOT NULL THEN 'unclassified' WHEN qual >= 70 AND dp >= 20 THEN 'good' WHEN qual < 20 THEN 'bad' ELSE 'unclassified' END AS label, NOT {_INDEL} AND {_TS} AS is_ts, {B("dp")} AS af_percent FROM br_variants v LEFT JOIN i ON v.var_id = i.var_id""",
)
def _(v: Views) -> DataFrame:
    mask = intervals.merge_intervals(v("br_intervals").where("iv_id % 4 = 0 AND start_pos <= end_pos")).withColumn("line_no", F.col("start_pos"))  # one at most holds a position
    masked = variants.annotate(v("br_variants"), mask, "start_pos").withColumn("af", (F.col("dp") + 0.5) / 100)
    good, bad = (F.col("qual") >= 70) & (F.col("dp") >= 20), F.col("qual") < 20
    return variants.class_label(masked, good, bad, F.col("annotation").isNotNull(), F.when(F.col("var_id") % 50 == 0, "good")).select("var_id", "label", "is_ts", "af_percent")


_ON = "br_variants v JOIN br_intervals i ON v.chrom = i.chrom AND v.pos BETWEEN start_pos AND end_pos"


@query("J4_annotate", f"SELECT v.var_id, annotation FROM br_variants v LEFT JOIN (SELECT v.var_id, string_agg(CAST(iv_id % 10 AS VARCHAR), '|' ORDER BY iv_id) AS annotation FROM {_ON} GROUP BY v.var_id) a USING (var_id)")
def _(v: Views) -> DataFrame:
    named = v("br_intervals").withColumns({"line_no": F.col("iv_id"), "iv_id": (F.col("iv_id") % 10).cast("string")})
    return variants.annotate(v("br_variants"), named, "iv_id", separator="|").select("var_id", "annotation")


@query("J4_annotate_alleles", "SELECT v.var_id, string_agg(k.var_id, ',' ORDER BY k.var_id) AS annotation FROM br_variants v LEFT JOIN br_variants k ON v.chrom = k.chrom AND v.pos = k.pos AND v.ref = k.ref AND v.alt = k.alt AND k.var_id % 2 = 0 GROUP BY v.var_id")
def _(v: Views) -> DataFrame:
    known = v("br_variants").where("var_id % 2 = 0").select("chrom", F.col("pos").alias("start_pos"), F.col("pos").alias("end_pos"), F.col("var_id").alias("line_no"), F.col("var_id").alias("v"), F.concat("ref", F.lit("GT")).alias("ref"), F.concat("alt", F.lit("GT")).alias("alt"))
    return variants.annotate(v("br_variants"), known, "v", match_alleles=True).select("var_id", "annotation")


@query(
    "J4_annotate_columns",
    f"""WITH h AS (SELECT v.var_id, string_agg(DISTINCT concat('iv', iv_id % 3), ';' ORDER BY concat('iv', iv_id % 3)) AS ids, arg_max(iv_id * 2, iv_id) FILTER (iv_id % 5 <> 0) AS q, bool_or(strand = 1) AS f FROM {_ON} GROUP BY v.var_id)
SELECT v.var_id, nullif(concat_ws(';', CASE WHEN v.var_id % 2 = 0 THEN concat('v', v.var_id) END, ids), '') AS id, {B("coalesce(q, qual)")} AS qual, coalesce(f, false) AS forward FROM br_variants v LEFT JOIN h USING (var_id)""",
)
def _(v: Views) -> DataFrame:
    mine = v("br_variants").withColumn("id", F.when(F.col("var_id") % 2 == 0, F.concat(F.lit("v"), "var_id")).otherwise("."))
    lines = v("br_intervals").withColumns({"line_no": F.col("iv_id"), "id": F.concat(F.lit("iv"), F.col("iv_id") % 3), "qual": F.when(F.col("iv_id") % 5 != 0, F.col("iv_id") * 2), "forward": F.col("strand") == 1})
    return variants.annotate_columns(mine, lines, "id", ["qual"], ["forward"]).select("var_id", "id", "qual", "forward")


_FILLED = """k AS (SELECT chrom, pos, min({'known_id': 'rs' || lpad(CAST(var_id AS VARCHAR), 9, '0'), 'known_ref': ref, 'known_alt': alt}) AS k FROM br_variants WHERE var_id % 3 = 0 GROUP BY chrom, pos),
f AS (SELECT v.*, CASE var_id % 4 WHEN 0 THEN '.' WHEN 1 THEN 'rs5' WHEN 2 THEN 'mine' END AS id, k.known_id AS known_id, k.known_ref = ref AS ref_match, k.known_alt = alt AS alt_match FROM br_variants v LEFT JOIN k USING (chrom, pos))"""


def _filled(v: Views) -> DataFrame:
    known = v("br_variants").where("var_id % 3 = 0").select("chrom", "pos", F.concat(F.lit("rs"), F.lpad(F.col("var_id").cast("string"), 9, "0")).alias("known_id"), F.col("ref").alias("known_ref"), F.col("alt").alias("known_alt"))
    k = F.col("var_id") % 4
    return variants.fill_ids(v("br_variants").withColumn("id", F.when(k == 0, ".").when(k == 1, "rs5").when(k == 2, "mine")), known)


@query("J5_fill_ids", f"WITH {_FILLED} SELECT var_id, known_id, ref_match, alt_match, CASE WHEN known_id IS NOT NULL AND (id IS NULL OR id <> 'mine') THEN known_id ELSE id END AS new_id FROM f")
def _(v: Views) -> DataFrame:
    return _filled(v).select("var_id", "known_id", "ref_match", "alt_match", "new_id")


@query("J5_fill_id_counts", f"WITH {_FILLED} SELECT {B('count(*)')} AS n, {B('count(known_id)')} AS known, {B('count(*) FILTER (ref_match)')} AS ref_match, {B('count(*) FILTER (NOT ref_match)')} AS ref_mismatch, {B('count(*) FILTER (alt_match)')} AS alt_match, {B('count(*) FILTER (NOT alt_match)')} AS alt_mismatch FROM f")
def _(v: Views) -> DataFrame:
    return variants.fill_id_counts(_filled(v))


_GRID = f"""g AS (SELECT {B("t")} AS threshold, count(*) FILTER (qual >= t) / CAST(count(*) AS DOUBLE) AS share,
  count(*) FILTER (qual >= t AND NOT {_INDEL} AND {_TS}) / CAST(nullif(count(*) FILTER (qual >= t AND NOT {_INDEL} AND NOT {_TS}), 0) AS DOUBLE) AS ratio FROM br_variants CROSS JOIN (VALUES (0), (20), (40), (60), (80)) x(t) GROUP BY t)"""


@query("C8_parameter_grid", f"WITH {_GRID} SELECT threshold, round(share, 6) AS share, round(ratio, 6) AS ratio, threshold = (SELECT threshold FROM g WHERE share >= 0.3 ORDER BY ratio DESC NULLS LAST, threshold LIMIT 1) AS best FROM g")
def _(v: Views) -> DataFrame:
    return variants.parameter_grid(v("br_variants"), "qual", [0, 20, 40, 60, 80], 0.3)


@query("C8_target_band", f"WITH {_GRID} SELECT threshold, round(share, 6) AS share, round(ratio, 6) AS ratio, coalesce(threshold = (SELECT threshold FROM g WHERE share >= 0.1 AND abs(share - 0.5) <= 0.25 ORDER BY ratio DESC NULLS LAST, threshold LIMIT 1), false) AS best FROM g")
def _(v: Views) -> DataFrame:
    return variants.parameter_grid(v("br_variants"), "qual", [0, 20, 40, 60, 80], 0.1, 0.5, 0.25)


@query("P20_dbsnp_export", f"SELECT *, {B(f'CASE WHEN {_INDEL} THEN 2 ELSE 1 END')} AS vrt, 'LAB' AS handle, 'b1' AS batch FROM br_variants WHERE length(ref) <= 50 AND length(alt) <= 50")
def _(v: Views) -> DataFrame:
    return variants.dbsnp_export(v("br_variants"), constants={"handle": "LAB", "batch": "b1"})


_HITS = "a AS (SELECT qname, read_id, chrom, pos AS s, pos + seq_len - 1 AS e FROM br_reads WHERE flag & 64 <> 0), b AS (SELECT qname, read_id, chrom, pos AS s, pos + seq_len - 1 AS e FROM br_reads WHERE flag & 128 <> 0)"


@query(
    "W11_pair_hits",
    f"""WITH {_HITS}, p AS (SELECT a.qname, a.read_id AS h1, b.read_id AS h2, CASE WHEN a.chrom = b.chrom THEN greatest(a.e, b.e) - least(a.s, b.s) + 1 END AS size FROM a JOIN b USING (qname))
SELECT qname, h1 AS hit_id1, h2 AS hit_id2, {B("size")} AS insert_size FROM p QUALIFY row_number() OVER (PARTITION BY qname ORDER BY coalesce(abs(size - 300), 4611686018427387904), h1, h2) = 1""",
)
def _(v: Views) -> DataFrame:
    hits = v("br_reads").select("qname", F.col("read_id").alias("hit_id"), "chrom", F.col("pos").alias("start_pos"), (F.col("pos") + F.col("seq_len") - 1).alias("end_pos"), "flag")
    return variants.pair_hits(hits.where("flag & 64 <> 0"), hits.where("flag & 128 <> 0"), 300)


_ORDERED = "o AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN concat('gene.', c_custkey) WHEN 2 THEN concat('X', c_custkey % 5) ELSE concat('locus.', c_custkey % 50, 'b') END AS id FROM customer)"


def _ids(v: Views) -> DataFrame:
    k = F.col("c_custkey")
    return v("customer").select("c_custkey", F.when(k % 4 == 0, k.cast("string")).when(k % 4 == 1, F.concat(F.lit("gene."), k)).when(k % 4 == 2, F.concat(F.lit("X"), k % 5)).otherwise(F.concat(F.lit("locus."), k % 50, F.lit("b"))).alias("id"))


@query("O2_mixed_order", f"WITH {_ORDERED} SELECT c_custkey, id, {B('''row_number() OVER (ORDER BY NOT regexp_full_match(id, '[0-9]+'), CASE WHEN regexp_full_match(id, '[0-9]+') THEN CAST(id AS BIGINT) END, id, c_custkey)''')} AS place FROM o ORDER BY place LIMIT 200")
def _(v: Views) -> DataFrame:
    return reports.first_places(_ids(v), [*reports.mixed_order(F.col("id")), "c_custkey"], 200)


@query("O3_gene_order", f"WITH {_ORDERED} SELECT c_custkey, id, {B('''row_number() OVER (ORDER BY split_part(id, '.', 1), coalesce(TRY_CAST(regexp_extract(substr(id, strpos(id || '.', '.') + 1), '^[0-9]+', 0) AS BIGINT), 0), id, c_custkey)''')} AS place FROM o ORDER BY place LIMIT 200")
def _(v: Views) -> DataFrame:
    return reports.first_places(_ids(v), [*reports.gene_order(F.col("id")), "id", "c_custkey"], 200)


_AXES = {"qual": range(0, 100, 10), "dp": range(1, 51, 5), "pos": range(1, 5001, 500)}


@query(
    "C8_parameter_grids",
    f"""WITH t AS (SELECT CAST(q AS BIGINT) AS tq, CAST(d AS BIGINT) AS td, CAST(p AS BIGINT) AS tp FROM range(0, 100, 10) a(q) CROSS JOIN range(1, 51, 5) b(d) CROSS JOIN range(1, 5001, 500) c(p)),
g AS (SELECT tq, td, tp, count(*) FILTER (ok) / CAST(count(*) AS DOUBLE) AS share, count(*) FILTER (ok AND NOT {_INDEL} AND {_TS}) / CAST(nullif(count(*) FILTER (ok AND NOT {_INDEL} AND NOT {_TS}), 0) AS DOUBLE) AS ratio
 FROM (SELECT *, qual >= tq AND dp >= td AND pos >= tp AS ok FROM br_variants CROSS JOIN t) GROUP BY tq, td, tp)
SELECT tq AS qual, td AS dp, tp AS pos, round(share, 6) AS share, round(ratio, 6) AS ratio, row_number() OVER (ORDER BY CASE WHEN share >= 0.05 AND abs(share - 0.2) <= 0.1 THEN 0 ELSE 1 END, ratio DESC NULLS LAST, tq, td, tp) = 1 AS best FROM g""",
)
def _(v: Views) -> DataFrame:
    return variants.parameter_grids(v("br_variants"), {c: list(t) for c, t in _AXES.items()}, 0.05, 0.2)
