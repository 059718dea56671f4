"""Queries of merged call sets, haplotype comparison and formatted records; catalog.py reads this module."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import Views, query
from .functions.line_format import format_line
from .operators import hierarchy, merging, phasing

# Three sets over br_calls with one, two and one or two alternatives, of which G is common; two samples each, one of them haploid.
_NUMBERS = {"PL": "G", "AD": "R", "AF": "A"}
_ROSTER = [f"{x}{src}" for src in range(3) for x in "AB"]


def _sets(v: Views) -> tuple[DataFrame, DataFrame]:
    one = v("br_calls").groupBy("src", "chrom", "pos").agg(F.min(F.struct("allele", "qual")).alias("r")).select("src", "chrom", "pos", "r.*")
    records = one.selectExpr(
        "concat_ws(':', src, chrom, pos) AS rec", "src", "chrom", "pos", "CASE WHEN src < 2 AND allele % 2 = 0 THEN concat('id', src) END AS id", "CASE WHEN src = 1 THEN 'AC' ELSE 'A' END AS ref",
        "CASE WHEN src = 0 THEN array('G') WHEN src = 1 THEN array('TC', 'GC') WHEN pos % 2 = 0 THEN array('C', 'G') ELSE array('G') END AS alts", "CASE WHEN src = 2 THEN 0 ELSE qual END AS qual",
        "array(CASE WHEN allele = 3 THEN 'q3' ELSE 'PASS' END) AS filter", "map('DP', string(qual % 10), 'NS', string(src), 'DP4', concat_ws(',', src, pos % 3), 'AN', '7') AS info", "2 AS n_samples",
    )
    long = records.withColumns({"k": F.explode(F.array(F.lit(0), F.lit(1))), "n": F.size("alts")})
    cells = long.selectExpr(
        "rec", "concat(CASE k WHEN 0 THEN 'A' ELSE 'B' END, src) AS sample", "src = 2 AND k = 1 AS haploid", "n", "pos",
        "CASE WHEN src = 2 AND k = 1 THEN string((pos + src + k) % (n + 1)) WHEN pos % 11 = 0 AND k = 0 THEN './.' ELSE concat((pos + src + k) % (n + 1), CASE WHEN pos % 3 = 0 THEN '|' ELSE '/' END, (pos * 3 + k) % (n + 1)) END AS gt",
    )
    listed = lambda n, first: f"array_join(transform(sequence(0, {n} - 1), i -> string(i + {first})), ',')"
    tags = f"map('PL', {listed('IF(haploid, n + 1, (n + 1) * (n + 2) div 2)', 'pos % 7 * 10')}, 'AD', {listed('(n + 1)', 'pos % 5')}, 'AF', {listed('n', '1')}, 'DP', string(pos % 50)) AS tags"
    return records, cells.selectExpr("rec", "sample", "gt", tags)


_MERGED = """WITH s AS (SELECT src, chrom, pos, CASE WHEN src < 2 AND allele % 2 = 0 THEN concat('id', src) END AS id, CASE WHEN src = 1 THEN 'AC' ELSE 'A' END AS ref,
 CASE WHEN src = 0 THEN ['G'] WHEN src = 1 THEN ['TC', 'GC'] WHEN pos % 2 = 0 THEN ['C', 'G'] ELSE ['G'] END AS alts, CASE WHEN src = 2 THEN 0 ELSE qual END AS q, allele = 3 AS bad, qual % 10 AS dp FROM br_calls QUALIFY row_number() OVER (PARTITION BY src, chrom, pos ORDER BY allele, qual) = 1),
w AS (SELECT *, max(ref) OVER (PARTITION BY chrom, pos) AS long FROM s),
o AS (SELECT * REPLACE (list_transform(alts, lambda a: concat(a, substr(long, length(ref) + 1)))  AS alts) FROM w),
a AS (SELECT chrom, pos, allele, min(src * 10 + i) AS place FROM (SELECT chrom, pos, src, unnest(alts) AS allele, generate_subscripts(alts, 1) AS i FROM o) GROUP BY ALL),
m AS (SELECT chrom, pos, list(allele ORDER BY place) AS malts FROM a GROUP BY ALL),
l AS (SELECT o.*, malts, list_concat([long], alts) AS own, list_concat([long], malts) AS merged, len(alts) AS n, k FROM o JOIN m USING (chrom, pos) CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1) t),
g AS (SELECT *, src = 2 AND k = 1 AS haploid, (pos + src + k) % (n + 1) AS x, (pos * 3 + k) % (n + 1) AS y,
  flatten([[concat(least(own[i + 1], own[j + 1]), '/', greatest(own[i + 1], own[j + 1])) for i in range(j + 1)] for j in range(len(own))]) AS own_pairs,
  flatten([[concat(least(merged[i + 1], merged[j + 1]), '/', greatest(merged[i + 1], merged[j + 1])) for i in range(j + 1)] for j in range(len(merged))]) AS pairs FROM l),
c AS (SELECT chrom, pos, concat(CASE k WHEN 0 THEN 'A' ELSE 'B' END, src) AS sample,
  CASE WHEN haploid THEN CAST(list_position(merged, own[x + 1]) - 1 AS VARCHAR) WHEN pos % 11 = 0 AND k = 0 THEN './.'
    ELSE concat(list_position(merged, own[x + 1]) - 1, CASE WHEN pos % 3 = 0 THEN '|' ELSE '/' END, list_position(merged, own[y + 1]) - 1) END AS gt,
  array_to_string([coalesce(CAST(list_position(own, z) - 1 + pos % 5 AS VARCHAR), '.') for z in merged], ',') AS ad,
  array_to_string([coalesce(CAST(list_position(alts, z) AS VARCHAR), '.') for z in malts], ',') AS af,
  array_to_string([coalesce(CAST(list_position(CASE WHEN haploid THEN own ELSE own_pairs END, z) - 1 + pos % 7 * 10 AS VARCHAR), '.') for z in CASE WHEN haploid THEN merged ELSE pairs END], ',') AS pl FROM g),
r AS (SELECT chrom, pos, sample, coalesce(gt, '0/0') AS gt, concat_ws(':', coalesce(gt, '0/0'), coalesce(ad, '.'), coalesce(af, '.'), CASE WHEN gt IS NULL THEN '.' ELSE CAST(pos % 50 AS VARCHAR) END, coalesce(pl, '.')) AS cell
  FROM m CROSS JOIN (SELECT unnest(['A0', 'B0', 'A1', 'B1', 'A2', 'B2']) AS sample) t LEFT JOIN c USING (chrom, pos, sample)),
cells AS (SELECT chrom, pos, string_agg(cell, chr(9) ORDER BY substr(sample, 2), sample) AS cells, flatten(list(regexp_extract_all(gt, '[0-9]+'))) AS called FROM r GROUP BY chrom, pos),
f AS (SELECT chrom, pos, max(long) AS ref, arg_min(id, src) FILTER (id IS NOT NULL) AS id, avg(q) FILTER (q > 0) AS qual, CASE WHEN bool_or(bad) THEN 'q3' ELSE 'PASS' END AS filter, sum(dp) AS dp, min(src) AS ns, sum(src) AS d, count(*) * (pos % 3) AS e,
  string_agg(concat(src, CASE WHEN bad THEN 'f' ELSE '' END), ',' ORDER BY src) AS sf FROM o GROUP BY chrom, pos)
SELECT chrom, pos, id, ref, array_to_string(malts, ',') AS alt, round(qual, 6) AS qual, filter, concat('AC=', array_to_string([len(list_filter(called, lambda t: t = CAST(i AS VARCHAR))) for i in range(1, len(malts) + 1)], ','), ';AN=', len(called), ';DP=', dp, ';DP4=', d, ',', e, ';NS=', ns, ';SF=', sf) AS info, cells
FROM f JOIN m USING (chrom, pos) JOIN cells USING (chrom, pos)"""


def _lines(merged: DataFrame) -> DataFrame:
    info = F.array_join(F.transform(F.array_sort(F.map_entries("info")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return merged.select("chrom", "pos", "id", "ref", F.array_join("alts", ",").alias("alt"), "qual", F.array_join("filter", ";").alias("filter"), info.alias("info"), F.array_join("samples", "\t").alias("cells"))


@query("U4_merge_calls", _MERGED)
def _(v: Views) -> DataFrame:
    return _lines(merging.merge_calls(*_sets(v), _ROSTER, _NUMBERS, absent="0/0"))



_CELL = "CASE WHEN a1 IS NULL THEN './.' ELSE concat(a1, CASE WHEN phased = 1 THEN '|' ELSE '/' END, a2) END"
_PICK = [f"S{i}" for i in (7, 0, 3)]
_LOOP = ", ".join(
    f"""'{s}=', coalesce(CASE WHEN {s}.site IS NULL THEN '.' WHEN {s}.a1 IS NULL THEN './.' ELSE concat(CASE {s}.a1 WHEN 0 THEN ref ELSE alt END, CASE WHEN {s}.phased = 1 THEN '|' ELSE '/' END, CASE {s}.a2 WHEN 0 THEN ref ELSE alt END) END, '.'),
 '(', coalesce({s}.cell, '.'), ' ', CASE WHEN {s}.site IS NULL THEN 'GT:.' ELSE concat('GT:', {s}.cell, ';DP:', {s}.dp) END, ' .)'""" for s in _PICK
)


@query(
    "P1_format_lines",
    f"""WITH g AS (SELECT site, sample, a1, a2, phased, dp, {_CELL} AS cell FROM br_genotypes)
SELECT var_id, concat(chrom, ':', pos, chr(9), '.', ' ', ref, '>', alt, ' DP=', v.dp, ' DB=', CASE WHEN var_id % 2 = 0 THEN '1' ELSE '.' END, ' % [', CASE WHEN qual < 20 THEN 'q20;s50' ELSE '.' END, '] ', {_LOOP}, chr(10)) AS line
FROM br_variants v {' '.join(f"LEFT JOIN g {s} ON {s}.site = var_id AND {s}.sample = '{s}'" for s in _PICK)}""",
)
def _(v: Views) -> DataFrame:
    roster = [f"S{i}" for i in range(12)]
    cells = v("br_genotypes").selectExpr("site AS var_id", "sample", f"concat({_CELL}, ':', dp) AS cell").groupBy("var_id").agg(*(F.max(F.when(F.col("sample") == s, F.col("cell"))).alias(f"_{s}") for s in roster))
    records = v("br_variants").join(cells, "var_id", "left").selectExpr(
        "var_id", "chrom", "pos", "CAST(NULL AS string) AS id", "ref", "array(alt) AS alts", "qual", "CASE WHEN qual < 20 THEN array('q20', 's50') END AS filter",
        "CASE WHEN var_id % 2 = 0 THEN map('DP', string(dp), 'DB', '') ELSE map('DP', string(dp)) END AS info", "array('GT', 'DP') AS format", f"array({', '.join('_' + s for s in roster)}) AS samples",
    )
    text = "%CHROM:%POS\\t%ID %REF>%ALT DP=%INFO/DP DB=%INFO/DB \\% \\[%FILTER\\] [%SAMPLE=%GT(%GTR %*:; %PL)]\\n"
    return records.select("var_id", format_line(text, records.columns, roster, _PICK).alias("line"))


_LEVELS = [("project", "project"), ("sample", "sample"), ("library", "library_id"), ("lane", "lane_id")]


@query(
    "M6_closure",
    """WITH RECURSIVE e AS (SELECT DISTINCT concat('project:', project) AS parent, concat('sample:', sample) AS child FROM br_lanes UNION SELECT concat('sample:', sample), concat('library:', library_id) FROM br_lanes
 UNION SELECT concat('library:', library_id), concat('lane:', lane_id) FROM br_lanes), d AS (SELECT child, 1 AS depth FROM e WHERE parent IN ('project:ASIA', 'sample:FRANCE') UNION SELECT e.child, d.depth + 1 FROM d JOIN e ON e.parent = d.child)
SELECT split_part(child, ':', 1) AS level, split_part(child, ':', 2) AS id, CAST(min(depth) AS BIGINT) AS depth FROM d GROUP BY child""",
)
def _(v: Views) -> DataFrame:
    roots = v("br_lanes").sparkSession.createDataFrame([("project", "ASIA"), ("sample", "FRANCE")], "level string, id string")
    return hierarchy.descendants(hierarchy.edges_of(v("br_lanes"), _LEVELS), roots)


@query(
    "M9_path_by_template",
    """SELECT lane_id, concat_ws('/', split_part(project, ' ', 1), CASE WHEN strpos(project, ' ') > 0 THEN regexp_replace(substr(project, strpos(project, ' ') + 1), '[^A-Za-z0-9]+', '_', 'g') ELSE '' END, 'TRACKING', sample, library_id, lane_id) AS path,
 CASE WHEN lane_id % 3 > 0 THEN concat_ws('/', project, CASE lane_id % 3 WHEN 1 THEN 'SLX' ELSE '454' END, library_id) END AS library_path FROM br_lanes""",
)
def _(v: Views) -> DataFrame:
    columns = {"genus": "project", "species-subspecies": "project", "project": "project", "sample": "sample", "technology": "tech", "library": "library_id", "lane": "lane_id"}
    lanes = v("br_lanes").withColumn("tech", F.expr("CASE lane_id % 3 WHEN 1 THEN 'SLX' WHEN 2 THEN '454' END"))
    long, short = "genus:species-subspecies:TRACKING:sample:library:lane", "project:technology:library:lane"
    return lanes.select("lane_id", hierarchy.path_of(lanes, "lane", columns, long).alias("path"), hierarchy.path_of(lanes, "library", columns, short).alias("library_path"))


# Five chunks of 60 sites, 20 of which the next one has too; odd ones are turned, chunk 2 has some errors and chunk 4 is turned for one sample only by half of its sites.
_PHASED = """ch AS (SELECT sample, site, c AS chunk_no, CASE WHEN turn THEN a2 ELSE a1 END AS a1, CASE WHEN c = 2 AND site % 5 = 0 AND sample < 'S4' THEN 1 WHEN turn THEN a1 ELSE a2 END AS a2, site % 4 > 0 AS phased, dp
  FROM (SELECT *, (c % 2 = 1) <> (c = 4 AND sample = 'S7' AND site % 2 = 0) AS turn, CASE WHEN site % 3 = 0 THEN 1 - b1 ELSE b1 END AS a1, b2 AS a2 FROM (SELECT sample, site, a1 AS b1, a2 AS b2, dp, unnest(range(0, 5)) AS c FROM br_genotypes)) WHERE site BETWEEN c * 40 AND c * 40 + 59 AND NOT (c = 3 AND site < 140)),
b AS (SELECT x.chunk_no, x.sample, x.site, x.phased AND y.phased AS ok, x.a1 <> x.a2 AS het, x.a1 IS NOT DISTINCT FROM y.a1 AND x.a2 IS NOT DISTINCT FROM y.a2 AS m, x.a1 IS NOT DISTINCT FROM y.a2 AND x.a2 IS NOT DISTINCT FROM y.a1 AS w
  FROM ch x JOIN ch y ON y.chunk_no = x.chunk_no - 1 AND x.sample = y.sample AND x.site = y.site),
q AS (SELECT chunk_no, site, count(*) AS n, count(*) FILTER (NOT m AND NOT w) AS e FROM b GROUP BY ALL), p AS (SELECT chunk_no, site, greatest(least(e / n, 1 - l), l) AS p FROM (SELECT *, CASE WHEN n = 1 THEN 0.25 ELSE 1.0 / n END::DOUBLE AS l FROM q)),
t AS (SELECT chunk_no, sample, count(*) AS n_sites, sum(ln(CASE WHEN m THEN p * p + (1 - p) * (1 - p) ELSE 2 * p * (1 - p) END)) AS match, sum(ln(CASE WHEN m THEN 2 * p * (1 - p) ELSE p * p + (1 - p) * (1 - p) END)) AS swap FROM b JOIN p USING (chunk_no, site) WHERE ok AND het AND (m OR w) GROUP BY ALL),
j AS (SELECT chunk_no, sample, coalesce(n_sites, 0) AS n_sites, match / ln(10) AS match, swap / ln(10) AS swap, abs(coalesce(round(swap - match, 9), 0)) / ln(10) AS quality, coalesce(round(swap - match, 9), 0) > 0 AS flip,
  sum(CASE WHEN coalesce(round(swap - match, 9), 0) > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY sample ORDER BY chunk_no) % 2 = 1 AS swapped FROM (SELECT DISTINCT chunk_no, sample FROM ch) LEFT JOIN t USING (chunk_no, sample))"""


def _phased(v: Views) -> DataFrame:
    spread = v("br_genotypes").withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(4)))).where("site BETWEEN c * 40 AND c * 40 + 59 AND NOT (c = 3 AND site < 140)")
    turned = spread.selectExpr("*", "(c % 2 = 1) <> (c = 4 AND sample = 'S7' AND site % 2 = 0) AS turn", "CASE WHEN site % 3 = 0 THEN 1 - a1 ELSE a1 END AS b1")
    return turned.selectExpr("sample", "site", "bigint(c) AS chunk_no", "CASE WHEN turn THEN a2 ELSE b1 END AS a1", "CASE WHEN c = 2 AND site % 5 = 0 AND sample < 'S4' THEN 1 WHEN turn THEN b1 ELSE a2 END AS a2", "site % 4 > 0 AS phased", "dp")


@query("C2_phase_joins", f"WITH {_PHASED} SELECT sample, CAST(chunk_no AS BIGINT) AS chunk_no, n_sites, round(match, 6) AS match, round(swap, 6) AS swap, round(quality, 6) AS quality, flip, swapped FROM j")
def _(v: Views) -> DataFrame:
    return phasing.phase_joins(_phased(v))


@query(
    "C2_phase_sets",
    f"""WITH {_PHASED}, s AS (SELECT x.chunk_no, min(x.site) AS f, max(x.site) AS t FROM ch x JOIN (SELECT DISTINCT chunk_no, site FROM ch) y ON y.chunk_no = x.chunk_no - 1 AND x.site = y.site GROUP BY x.chunk_no),
r AS (SELECT ch.*, s.f, s.t, n.f AS nf, n.t AS nt FROM ch LEFT JOIN s USING (chunk_no) LEFT JOIN s n ON n.chunk_no = ch.chunk_no + 1),
k AS (SELECT *, f IS NULL AS alone, coalesce(site BETWEEN f AND t, false) OR coalesce(site BETWEEN nf AND nt, false) AS sharing FROM r
  QUALIFY row_number() OVER (PARTITION BY sample, site ORDER BY CASE WHEN coalesce(site BETWEEN f AND t AND t - site > site - f, false) OR coalesce(site BETWEEN nf AND nt AND nt - site <= site - nf, false) THEN 1 ELSE 0 END, chunk_no) = 1),
z AS (SELECT k.sample, site, k.chunk_no, CASE WHEN swapped THEN a2 ELSE a1 END AS a1, CASE WHEN swapped THEN a1 ELSE a2 END AS a2, (dp < 3 AND NOT sharing) OR ((alone OR quality < 0.5) AND site = min(site) OVER (PARTITION BY k.sample, k.chunk_no)) OR site = min(site) OVER (PARTITION BY k.sample) AS start FROM k JOIN j USING (chunk_no, sample))
SELECT sample, site, CAST(chunk_no AS BIGINT) AS chunk_no, a1, a2, max(CASE WHEN start THEN site END) OVER (PARTITION BY sample ORDER BY site) AS ps FROM z""",
)
def _(v: Views) -> DataFrame:
    gt = _phased(v)
    return phasing.joined_phases(gt, phasing.phase_joins(gt), 0.5, F.col("dp") < 3)
