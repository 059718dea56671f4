"""Queries of the hierarchy, versioned tables, sequences and call sets, over the bridge views (see catalog)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import _GROUPS, _LATEST, _NOON, B, Views, _when, query
from .functions import alignments
from .operators import calls, genotypes, history, records, reports, sequences
from .streaming import tracking

# Lanes with what else a tracking database has of them.
_LANES = """fl AS (SELECT *, lane_id % 11 = 0 AS withdrawn, concat('pop', library_id % 4) AS population, concat('i', library_id % 7) AS individual, CAST(36 + lane_id % 3 * 10 AS BIGINT) AS read_len, CAST(lane_id % 40 AS BIGINT) AS mean_quality,
 CASE lane_id % 3 WHEN 0 THEN 'confirmed' WHEN 1 THEN 'wrong' ELSE 'unchecked' END AS gt_status, CASE WHEN lane_id % 4 = 0 THEN 1.2 END AS gt_ratio, raw_bases - lane_id % 100 AS mapped_raw_bases, raw_bases - lane_id % 300 AS rmdup_bases,
 CASE WHEN lane_id % 5 <> 0 THEN raw_bases - lane_id % 70 END AS bases_mapped FROM br_lanes)"""


def _lanes(v: Views) -> DataFrame:
    k, lib, raw = F.col("lane_id"), F.col("library_id"), F.col("raw_bases")
    more = {
        "withdrawn": k % 11 == 0, "population": F.concat(F.lit("pop"), lib % 4), "individual": F.concat(F.lit("i"), lib % 7), "read_len": 36 + k % 3 * 10, "mean_quality": k % 40,
        "gt_status": F.when(k % 3 == 0, "confirmed").when(k % 3 == 1, "wrong").otherwise("unchecked"), "gt_ratio": F.when(k % 4 == 0, 1.2), "mapped_raw_bases": raw - k % 100, "rmdup_bases": raw - k % 300, "bases_mapped": F.when(k % 5 != 0, raw - k % 70),
    }
    return v("br_lanes").withColumns(more)


@query("J1_hierarchy_join", "SELECT lane_id, library_id, sample, project, raw_reads, raw_bases FROM br_lanes")
def _(v: Views) -> DataFrame:
    lanes = v("lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("raw_reads"), F.sum(F.floor("l_quantity")).alias("raw_bases")).withColumn("lane_id", F.col("l_suppkey") * 10 + F.col("l_linenumber"))
    libraries = v("supplier").select(F.col("s_suppkey").alias("library_id"), "s_nationkey", F.lit(True).alias("latest"))
    older = v("supplier").select(F.col("s_suppkey").alias("library_id"), ((F.col("s_nationkey") + 1) % 25).alias("s_nationkey"), F.lit(False).alias("latest"))
    levels = [(lanes, "lane_id", "l_suppkey"), (libraries.union(older), "library_id", "s_nationkey"), (v("nation").select("n_nationkey", F.col("n_name").alias("sample"), "n_regionkey"), "n_nationkey", "n_regionkey")]
    return reports.hierarchy_join([*levels, (v("region").select("r_regionkey", F.col("r_name").alias("project")), "r_regionkey", None)]).select("lane_id", "library_id", "sample", "project", "raw_reads", "raw_bases")


@query("J18_sample_names", "SELECT DISTINCT r_name, coalesce(n_name, 'N/A') AS n_name, coalesce(CAST(c_nationkey AS VARCHAR), 'N/A') AS c_nationkey FROM region LEFT JOIN nation ON r_regionkey = n_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey")
def _(v: Views) -> DataFrame:
    joined = v("region").join(v("nation"), F.col("r_regionkey") == F.col("n_regionkey"), "left").join(v("customer").select("c_nationkey").distinct(), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return reports.sample_names(joined, ["r_name", "n_name", "c_nationkey"])


@query("A33_coverage_by_level", f"WITH {_LANES} SELECT project, sample, library_id, CAST(sum(raw_bases) AS DOUBLE) AS bases, round(sum(raw_bases) / 100000.0, 6) AS coverage FROM fl WHERE NOT withdrawn AND qc_status IN ('passed', 'pending') AND gt_status <> 'wrong' GROUP BY ROLLUP (project, sample, library_id)")
def _(v: Views) -> DataFrame:
    return reports.coverage_by_level(_lanes(v), 100_000, ["project", "sample", "library_id"], ["passed", "pending"], ["confirmed", "unchecked"])


@query(
    "A33_mapped_coverage",
    f"WITH {_LANES}, x AS (SELECT *, coalesce(CASE WHEN gt_ratio IS NOT NULL THEN CAST(raw_bases * rmdup_bases AS DOUBLE) / nullif(mapped_raw_bases, 0) END, bases_mapped, raw_bases * 0.9) AS b FROM fl WHERE NOT withdrawn) SELECT project, sample, round(CAST(sum(b) AS DOUBLE), 6) AS bases, round(sum(b) / 100000.0, 6) AS coverage FROM x GROUP BY ROLLUP (project, sample)",
)
def _(v: Views) -> DataFrame:
    return reports.coverage_by_level(_lanes(v), 100_000, ["project", "sample"], mapped=True)


_STATES = [("qc_status", s) for s in ("passed", "failed", "pending", "no_qc")] + [("gt_status", s) for s in ("confirmed", "wrong", "unchecked")]


@query(
    "A34_status_matrix",
    f"WITH {_LANES} SELECT project, population, individual, " + ", ".join(f"CAST(count(*) FILTER ({c} = '{s}') AS BIGINT) AS n_{s}, CAST(coalesce(sum(raw_bases) FILTER ({c} = '{s}'), 0) AS BIGINT) AS bases_{s}" for c, s in _STATES) + ", round(coalesce(sum(raw_bases) FILTER (qc_status = 'passed'), 0) / 100000.0, 6) AS pass_coverage FROM fl GROUP BY ALL",
)
def _(v: Views) -> DataFrame:
    return reports.status_matrix(_lanes(v), ["project", "population", "individual"], 100_000)


@query("A35_yield_by_month", f"WITH {_LANES}, m AS (SELECT *, {B('year(run_date) * 100 + month(run_date)')} AS month FROM fl) SELECT month, read_len, {B('count(*)')} AS n_lanes, {B('sum(raw_bases)')} AS bases, round(sum(mean_quality * raw_bases) / CAST(sum(raw_bases) AS DOUBLE), 6) AS mean_quality FROM m GROUP BY ROLLUP (month, read_len)")
def _(v: Views) -> DataFrame:
    return reports.yield_by_month(_lanes(v))


_SINCE = "(SELECT min(run_date) + INTERVAL 5 DAY FROM br_lanes)"


@query("A36_finished_samples", f"WITH s AS (SELECT sample, sum(raw_bases) AS b, coalesce(sum(raw_bases) FILTER (run_date < {_SINCE}), 0) AS o FROM br_lanes GROUP BY sample), t AS (SELECT avg(b) AS t FROM s) SELECT sample, {B('b')} AS bases, {B('o')} AS before FROM s WHERE b >= 3000 AND o < 3000")
def _(v: Views) -> DataFrame:
    lanes = v("br_lanes").join(F.broadcast(v("br_lanes").agg((F.min("run_date") + F.expr("INTERVAL 5 DAY")).alias("_since"))))
    return reports.finished_samples(lanes, F.col("_since"), 3000)


_STATS = """st AS (SELECT rg AS lane_id, CASE WHEN rg = 'rg6' THEN 0 ELSE count(*) END AS sequences, sum(seq_len) AS total_length, sum(trimmed) AS bases_trimmed, sum(cigar_mapped) FILTER (flag & 4 = 0) AS bases_mapped_cigar,
 CAST(sum(nm) AS DOUBLE) / sum(seq_len) AS error_rate, sum(nm % 2) AS insertions, CASE WHEN rg = 'rg5' THEN 0 ELSE sum(nm % 3) END AS deletions, CASE WHEN rg < 'rg4' THEN 'confirmed' ELSE 'unknown' END AS gt_status, rg <> 'rg1' AS is_paired,
 100.0 * count(*) FILTER (isize BETWEEN 100 AND 500) / count(*) AS peak_amount, max(isize) % 50 AS peak_range FROM br_pairs GROUP BY rg),
t AS (SELECT lane_id, 'empty' AS test, CAST(sequences AS DOUBLE) AS value, sequences > 0 AS passed FROM st UNION ALL SELECT lane_id, 'genotype', NULL, gt_status = 'confirmed' FROM st
 UNION ALL SELECT lane_id, 'mapped', 100.0 * bases_mapped_cigar / (total_length - bases_trimmed), 100.0 * bases_mapped_cigar / (total_length - bases_trimmed) >= 85 FROM st WHERE sequences > 0
 UNION ALL SELECT lane_id, 'error_rate', error_rate, error_rate <= 0.05 FROM st UNION ALL SELECT lane_id, 'indel_ratio', insertions / CAST(nullif(deletions, 0) AS DOUBLE), coalesce(insertions / CAST(nullif(deletions, 0) AS DOUBLE) <= 0.55, false) FROM st
 UNION ALL SELECT lane_id, 'peak_amount', peak_amount, peak_amount >= 60 FROM st WHERE sequences > 0 AND is_paired UNION ALL SELECT lane_id, 'peak_range', peak_range, peak_range <= 48 FROM st WHERE sequences > 0 AND is_paired)"""
_LIMITS = {"mapped": 85, "error_rate": 0.05, "indel_ratio": 0.55, "peak_amount": 60, "peak_range": 48}


def _tests(v: Views) -> DataFrame:
    rg = F.col("lane_id")
    made = v("br_pairs").groupBy(F.col("rg").alias("lane_id")).agg(
        F.count("*").alias("sequences"), F.sum("seq_len").alias("total_length"), F.sum("trimmed").alias("bases_trimmed"), F.sum(F.when(F.col("flag").bitwiseAND(F.lit(4)) == 0, F.col("cigar_mapped"))).alias("bases_mapped_cigar"),
        (F.sum("nm") / F.sum("seq_len")).alias("error_rate"), F.sum(F.col("nm") % 2).alias("insertions"), F.sum(F.col("nm") % 3).alias("deletions"), (100 * F.count_if(F.col("isize").between(100, 500)) / F.count("*")).alias("peak_amount"), (F.max("isize") % 50).alias("peak_range"),
    )
    made = made.withColumns({"sequences": F.when(rg == "rg6", 0).otherwise(F.col("sequences")), "deletions": F.when(rg == "rg5", 0).otherwise(F.col("deletions")), "gt_status": F.when(rg < "rg4", "confirmed").otherwise("unknown"), "is_paired": rg != "rg1"})
    return reports.auto_qc(made, _LIMITS, ["confirmed"])


@query("A37_auto_qc", f"WITH {_STATS} SELECT lane_id, test, round(value, 6) AS value, passed FROM t")
def _(v: Views) -> DataFrame:
    return _tests(v)


@query("A37_qc_verdict", f"WITH {_STATS} SELECT lane_id, bool_and(passed) FILTER (test NOT LIKE 'peak%') AS lane_passed, bool_and(passed) FILTER (test LIKE 'peak%') AS library_passed FROM t GROUP BY lane_id")
def _(v: Views) -> DataFrame:
    return reports.qc_verdict(_tests(v))


_SHARE = "round(100.0 * count(*) FILTER ({}) / count(*), 6)".format
_BASES = "coalesce(sum(seq_len) FILTER ({}), 0)".format


@query(
    "A38_mapping_report",
    f"""SELECT rg, {B("count(*)")} AS n, {_SHARE("flag & 4 = 0")} AS pct_mapped, {_SHARE("flag & 2 <> 0")} AS pct_proper, {_SHARE("flag & 1024 <> 0")} AS pct_dup, round(100.0 * {_BASES("flag & 4 = 0")} / sum(seq_len), 6) AS pct_bases_mapped,
 round(sum(nm) FILTER (flag & 4 = 0) / CAST({_BASES("flag & 4 = 0")} AS DOUBLE), 6) AS error_rate, CASE WHEN rg <> 'rg2' THEN round({_BASES("flag & 4 = 0")} / 500000.0, 6) END AS depth, CASE WHEN rg <> 'rg2' THEN round({_BASES("flag & 1028 = 0")} / 500000.0, 6) END AS rmdup_depth,
 CASE WHEN rg = 'rg2' THEN 'QC' ELSE 'Mapping' END AS row_type FROM br_reads GROUP BY rg""",
)
def _(v: Views) -> DataFrame:
    return reports.mapping_report(v("br_reads"), 500_000, F.col("rg") == "rg2")


_JOBS = "j AS (SELECT obj_id AS job, row_id % 5 AS attempt, concat('h', row_id % 9) AS host, changed AS started, row_id % 100 AS wall, row_id % 37 AS cpu, row_id % 50 AS memory FROM br_history), l AS (SELECT * FROM j QUALIFY row_number() OVER (PARTITION BY job ORDER BY attempt DESC, started DESC) = 1)"


@query(
    "A39_runtime_stats",
    f"WITH {_JOBS}, x AS (SELECT *, greatest(cpu, 1) / CAST(greatest(wall, 1) AS DOUBLE) AS idle, {B('epoch(started)')} AS b FROM l) SELECT {B('count(*)')} AS jobs, {B('max(b + wall) - min(b)')} AS span, {B('count(DISTINCT host)')} AS hosts, "
    + ", ".join(f"{f'round(min({c}), 6)' if c == 'idle' else f'min({c})'} AS least_{c}, {f'round(max({c}), 6)' if c == 'idle' else f'max({c})'} AS most_{c}, round(avg({c}), 6) AS mean_{c}" for c in ("memory", "wall", "cpu", "idle")) + " FROM x",
)
def _(v: Views) -> DataFrame:
    k = F.col("row_id")
    return reports.runtime_stats(v("br_history").select(F.col("obj_id").alias("job"), (k % 5).alias("attempt"), F.concat(F.lit("h"), k % 9).alias("host"), F.col("changed").alias("started"), (k % 100).alias("wall"), (k % 37).alias("cpu"), (k % 50).alias("memory")))


@query(
    "A40_usage_rollup",
    f"""WITH x AS (SELECT project, qc_status, sum(raw_bases) AS bytes, count(*) AS n FROM br_lanes GROUP BY ROLLUP (project, qc_status)), m AS (SELECT project, max(raw_bases) * 100 AS lim FROM br_lanes WHERE project <> 'ASIA' GROUP BY project)
SELECT project, qc_status, {B("bytes")} AS bytes, {B("n")} AS n, round(bytes / CAST(max(bytes) OVER () AS DOUBLE), 6) AS share, round(100.0 * bytes / lim, 6) AS pct_of_limit FROM x LEFT JOIN m USING (project)""",
)
def _(v: Views) -> DataFrame:
    limits = v("br_lanes").where("project <> 'ASIA'").groupBy("project").agg((F.max("raw_bases") * 100).alias("limit"))
    return reports.usage_rollup(v("br_lanes"), ["project", "qc_status"], "raw_bases", limits)


@query("A47_common_values", f"SELECT sample, qc_status, {B('n')} AS n, {B('place')} AS place FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY n DESC, qc_status) AS place FROM (SELECT sample, qc_status, count(*) AS n FROM br_lanes GROUP BY ALL)) WHERE place <= 3")
def _(v: Views) -> DataFrame:
    return reports.common_values(v("br_lanes"), "sample", "qc_status", 3)


@query("A54_pending", f"SELECT state, {B('processed % 3')} AS type, {B('obj_id % 4')} AS study, {B('count(*)')} AS n FROM br_history WHERE state IN ('click', 'view') GROUP BY 1, 2, 3")
def _(v: Views) -> DataFrame:
    return reports.pending(v("br_history").withColumns({"type": F.col("processed") % 3, "study": F.col("obj_id") % 4}), ["click", "view"], "type", "study")


_QUAL = "h AS (SELECT qual, count(*) AS n FROM br_quality GROUP BY qual)"


def _parts(v: Views) -> list[DataFrame]:
    return [v("br_quality").where(F.col("mate") == m).groupBy("qual").agg(F.count("*").alias("n")) for m in (1, 2)]


@query("A61_merge_reports", f"WITH {_QUAL} SELECT qual, {B('n')} AS n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS share FROM h")
def _(v: Views) -> DataFrame:
    return reports.merge_reports(_parts(v), ["qual"])


@query("A61_merged_averages", f"WITH {_QUAL} SELECT {B('sum(n)')} AS total, round(sum(qual * n) / CAST(sum(n) AS DOUBLE), 6) AS mean, round(sqrt(sum(qual * qual * n) / CAST(sum(n) AS DOUBLE) - (sum(qual * n) / CAST(sum(n) AS DOUBLE)) * (sum(qual * n) / CAST(sum(n) AS DOUBLE))), 6) AS sd FROM h")
def _(v: Views) -> DataFrame:
    return reports.merged_averages([p.withColumnRenamed("qual", "bin") for p in _parts(v)])


@query("A61_merge_percentages", "WITH p AS (SELECT mate, cycle, avg(CASE WHEN qual < 20 THEN 100.0 ELSE 0 END) AS pct FROM br_quality GROUP BY 1, 2) SELECT cycle, round(sum(pct * CASE mate WHEN 1 THEN 300 ELSE 700 END) / 1000, 6) AS pct FROM p GROUP BY cycle")
def _(v: Views) -> DataFrame:
    pct = [v("br_quality").where(F.col("mate") == m).groupBy("cycle").agg(F.avg(F.when(F.col("qual") < 20, 100.0).otherwise(0.0)).alias("pct")) for m in (1, 2)]
    return reports.merge_percentages([(pct[0], 300), (pct[1], 700)], ["cycle"], "pct")


@query("A61_rebin", f"SELECT {B('qual // 5 * 5')} AS qual, {B('count(*)')} AS n FROM br_quality GROUP BY 1")
def _(v: Views) -> DataFrame:
    return reports.rebin(reports.merge_reports(_parts(v), ["qual"]), 5, "qual")


_RELEASE = f"""{_LANES}, r AS (SELECT *, CASE WHEN qc_status IN ('passed', 'failed') THEN qc_status ELSE 'passed' END AS auto_qc, CASE WHEN lane_id % 6 = 0 THEN 'passed' WHEN lane_id % 19 = 0 THEN 'failed' END AS manual_qc FROM fl),
k AS (SELECT *, coalesce(manual_qc, auto_qc) = 'passed' AND raw_bases > 1500 AND gt_status <> 'wrong' AS ok FROM r)"""


def _release(v: Views) -> tuple[DataFrame, dict]:
    k = F.col("lane_id")
    lanes = _lanes(v).withColumns({"auto_qc": F.when(F.col("qc_status").isin("passed", "failed"), F.col("qc_status")).otherwise("passed"), "manual_qc": F.when(k % 6 == 0, "passed").when(k % 19 == 0, "failed")})
    return lanes, {"mapped": F.col("raw_bases") > 1500, "genotype": F.col("gt_status") != "wrong"}


@query("C9_release_selection", f"WITH {_RELEASE} SELECT lane_id, sample FROM k WHERE ok")
def _(v: Views) -> DataFrame:
    return reports.release_selection(*_release(v)).select("lane_id", "sample")


@query("C9_strict_selection", f"WITH {_RELEASE} SELECT lane_id, population FROM k WHERE ok AND lane_id % 499 NOT IN (SELECT lane_id % 499 FROM k WHERE NOT ok)")
def _(v: Views) -> DataFrame:
    lanes, conditions = _release(v)
    groups = lanes.withColumns({"project": F.lit("p"), "sample": (F.col("lane_id") % 499).cast("string")})
    return reports.release_selection(groups, conditions, strict=True).select("lane_id", "population")


@query("M6_cascade_delete", "SELECT lane_id FROM br_lanes WHERE project <> 'ASIA'")
def _(v: Views) -> DataFrame:
    gone = reports.descendants(v("br_lanes"), "ASIA")
    return reports.cascade_delete({"lane": v("br_lanes").select("lane_id")}, {"lane": "lane_id"}, gone)["lane"]


# Versioned tables


@query(
    "M3_append_versions",
    f"""WITH {_LATEST}, n AS (SELECT obj_id FROM latest WHERE obj_id % 2 = 0 AND state IS DISTINCT FROM 'click'),
u AS (SELECT obj_id, row_id + 10000000 AS row_id FROM latest JOIN n USING (obj_id) WHERE obj_id % 3 <> 0 UNION ALL SELECT obj_id, row_id + 20000000 FROM latest JOIN n USING (obj_id) WHERE obj_id % 3 = 0)
SELECT h.obj_id, h.row_id, h.state, l.row_id IS NOT NULL AND n.obj_id IS NULL AS latest FROM br_history h LEFT JOIN latest l ON l.obj_id = h.obj_id AND l.row_id = h.row_id LEFT JOIN n ON n.obj_id = h.obj_id UNION ALL SELECT obj_id, row_id, 'click', true FROM u""",
)
def _(v: Views) -> DataFrame:
    now = history.latest(v("br_history"))
    updates = now.select("obj_id", F.when(F.col("obj_id") % 2 == 0, F.col("row_id")).otherwise(-1).alias("based_on"), F.lit("click").alias("state"), (F.col("row_id") + 10_000_000).alias("row_id"), "changed")
    again = updates.withColumns({"row_id": F.col("row_id") + 10_000_000, "changed": F.col("changed") - F.expr("CASE WHEN obj_id % 3 = 0 THEN INTERVAL 1 SECOND ELSE INTERVAL -1 SECOND END")})
    same = again.withColumns({"row_id": F.lit(0).cast("long"), "state": F.lit(None).cast("string"), "changed": F.col("changed") - F.expr("INTERVAL 1 DAY"), "based_on": F.lit(-1).cast("long")})
    return history.append_versions(history.with_latest(v("br_history")), updates.union(again).union(same)).select("obj_id", "row_id", "state", "latest")


@query("M8_flagged", f"WITH {_LATEST} SELECT obj_id, row_id, processed FROM latest WHERE processed & 5 = 5")
def _(v: Views) -> DataFrame:
    return history.flagged(v("br_history"), 5).select("obj_id", "row_id", "processed")


@query("M8_flagged_by_state", f"WITH {_LATEST} SELECT obj_id, row_id FROM latest WHERE processed & 6 = 0 AND obj_id % 3 <> 2")
def _(v: Views) -> DataFrame:
    k = F.col("obj_id") % 3
    return history.flagged(v("br_history").withColumn("qc_status", F.when(k == 0, "passed").when(k == 1, "pending").otherwise("failed")), 6, False, ["passed", "pending"]).select("obj_id", "row_id")


@query("M7_lookup_unique", "SELECT min(c_custkey) AS c_custkey FROM customer WHERE c_custkey = 7")
def _(v: Views) -> DataFrame:
    return history.lookup_unique(v("customer").withColumn("name", F.concat(F.lit("name"), "c_custkey")), "name", "name7", "c_custkey")


@query("J13_as_of_join", f"WITH o AS (SELECT obj_id, row_id, state FROM br_history WHERE changed < {_NOON} QUALIFY row_number() OVER (PARTITION BY obj_id ORDER BY changed DESC, row_id DESC) = 1) SELECT c_custkey, row_id, state FROM customer LEFT JOIN o ON obj_id = c_custkey")
def _(v: Views) -> DataFrame:
    old = history.as_of(v("br_history"), _when()).select(F.col("obj_id").alias("c_custkey"), "row_id", "state")
    return v("customer").select("c_custkey").join(old, "c_custkey", "left")


@query("J11_reconcile", f"WITH a AS (SELECT rg, count(*) AS n FROM br_reads WHERE flag & 16 = 0 AND rg <> 'rg1' GROUP BY rg), b AS (SELECT rg, count(*) AS n FROM br_reads WHERE flag & 16 <> 0 AND rg <> 'rg2' GROUP BY rg) SELECT rg, {B('coalesce(a.n, 0)')} AS n1, {B('coalesce(b.n, 0)')} AS n2, CASE WHEN b.n IS NULL THEN 'UNIQ1' WHEN a.n IS NULL THEN 'UNIQ2' ELSE 'ISECT' END AS status FROM a FULL JOIN b USING (rg)")
def _(v: Views) -> DataFrame:
    r = v("br_reads")
    return calls.list_status(r.where("flag & 16 = 0 AND rg <> 'rg1'"), r.where("flag & 16 <> 0 AND rg <> 'rg2'"), "rg")


# Sequences and qualities

_QUALS = "q AS (SELECT flag, seq_len, mapq, unnest(range(1, seq_len + 1)) AS i FROM br_reads)"


def _quals(v: Views) -> DataFrame:
    return v("br_reads").withColumn("quals", F.transform(F.sequence(F.lit(1).cast("long"), F.col("seq_len")), lambda i: (i * 7 + F.col("mapq")) % 41))


@query("A5_quality_by_cycle", f"WITH {_QUALS} SELECT {B('CASE WHEN flag & 128 <> 0 THEN 2 ELSE 1 END')} AS fragment, {B('CASE WHEN flag & 16 <> 0 THEN seq_len - i + 1 ELSE i END')} AS cycle, (i * 7 + mapq) % 41 AS quality, {B('count(*)')} AS n FROM q GROUP BY 1, 2, 3")
def _(v: Views) -> DataFrame:
    return sequences.quality_by_cycle(_quals(v))


_BASE = "b AS (SELECT i AS cycle, CASE WHEN regexp_matches(substr(seq, i, 1), '[ACGT]') THEN substr(seq, i, 1) ELSE 'N' END AS base FROM (SELECT seq, unnest(range(1, length(seq) + 1)) AS i FROM br_fastq))"


@query(
    "A6_base_content",
    f"WITH {_BASE} SELECT cycle, " + ", ".join(f"{B(f'''count(*) FILTER (base = '{x}')''')} AS n_{x.lower()}" for x in "ACGTN") + ", " + ", ".join(f"round(100.0 * count(*) FILTER (base = '{x}') / nullif(count(*) FILTER (base <> 'N'), 0), 6) AS pct_{x.lower()}" for x in "ACGT") + " FROM b GROUP BY cycle",
)
def _(v: Views) -> DataFrame:
    return sequences.base_content(v("br_fastq"))


@query("A42_position_quality", f"SELECT cycle, qual, {B('count(*)')} AS n, round(sum(sum(qual)) OVER (PARTITION BY cycle) / CAST(sum(count(*)) OVER (PARTITION BY cycle) AS DOUBLE), 6) AS mean_qual, round(sum(sum(qual)) OVER () / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS overall_mean FROM br_quality GROUP BY cycle, qual")
def _(v: Views) -> DataFrame:
    return sequences.position_quality(v("br_quality"))


_MAPS = "m AS (SELECT mate AS file, cycle AS pos, qual AS old_q, (qual * 3 + cycle) // 4 AS new_q, count(*) AS n FROM br_quality GROUP BY ALL)"


@query("A43_recalibration_summary", f"WITH {_MAPS} SELECT file, pos, round(sum(old_q * n) / CAST(sum(n) AS DOUBLE), 6) AS mean_before, round(sum(new_q * n) / CAST(sum(n) AS DOUBLE), 6) AS mean_after, {B('sum(n)')} AS n FROM m GROUP BY file, pos")
def _(v: Views) -> DataFrame:
    maps = v("br_quality").groupBy(F.col("mate").alias("file"), F.col("cycle").alias("pos"), F.col("qual").alias("old_q")).agg(F.count("*").alias("n"))
    return sequences.recalibration_summary(maps.withColumn("new_q", F.floor((F.col("old_q") * 3 + F.col("pos")) / 4)))


@query("A53_merge_quality_maps", f"WITH x AS (SELECT cycle, qual, count(*) AS n, count(*) * pow(10.0, -qual / 10.0) AS errors FROM br_quality GROUP BY cycle, qual) SELECT cycle, qual, {B('n')} AS n, round(errors, 6) AS errors, {B('floor(-10 * log10(errors / n) + 0.5)')} AS new_qual FROM x")
def _(v: Views) -> DataFrame:
    return sequences.merge_quality_maps([sequences.quality_map(v("br_quality").where(F.col("mate") == m)) for m in (1, 2)], ["cycle", "qual"])


@query("A29_tag_fraction", "SELECT tag, round(100.0 * n / total, 6) AS percent FROM (SELECT substr(seq, 1, 3) AS tag, count(*) AS n, sum(count(*)) OVER () AS total FROM br_fastq GROUP BY 1) ORDER BY n DESC, tag LIMIT 1")
def _(v: Views) -> DataFrame:
    return sequences.tag_fraction(v("br_fastq"), 3)


@query("A29_tag_of_first", "WITH t AS (SELECT substr(seq, 1, 3) AS tag, count(*) AS n FROM (FROM br_fastq ORDER BY rec_no LIMIT 100) GROUP BY 1 ORDER BY n DESC, tag LIMIT 1) SELECT tag, round(100.0 * count(*) FILTER (starts_with(seq, tag)) / count(*), 6) AS percent FROM br_fastq CROSS JOIN t GROUP BY tag")
def _(v: Views) -> DataFrame:
    return sequences.tag_fraction(v("br_fastq"), 3, first=100)


@query("A29_given_tag", "SELECT 'TA' AS tag, round(100.0 * count(*) FILTER (starts_with(seq, 'TA')) / count(*), 6) AS percent FROM br_fastq")
def _(v: Views) -> DataFrame:
    return sequences.tag_fraction(v("br_fastq"), 2, tag="TA")


@query(
    "A31_genome_stats",
    f"""WITH o AS (SELECT length(seq) AS len, row_number() OVER (ORDER BY length(seq) DESC, rec_no) AS l, sum(length(seq)) OVER (ORDER BY length(seq) DESC, rec_no) AS cum FROM br_fastq)
SELECT {B("p")} AS percent, {B("max(len) FILTER (cum * 100 >= 500000 * p)")} AS n_len, {B("min(l) FILTER (cum * 100 >= 500000 * p)")} AS l_count FROM o CROSS JOIN (VALUES (10), (50), (100)) x(p) GROUP BY p""",
)
def _(v: Views) -> DataFrame:
    return sequences.assembly_stats(v("br_fastq"), [10, 50, 100], 500_000)


_OF = "sum(length(seq) - length(replace(seq, '{}', '')))".format


@query("A31_base_composition", f"WITH s AS (SELECT sum(length(seq)) AS total, {', '.join(f'{_OF(b)} AS n{b}' for b in 'ACGT')} FROM br_fastq), r AS (SELECT total, unnest(['A', 'C', 'G', 'T', 'N']) AS base, unnest([nA, nC, nG, nT, total - nA - nC - nG - nT]) AS n FROM s) SELECT base, {B('n')} AS n, round(100.0 * n / total, 6) AS percent FROM r")
def _(v: Views) -> DataFrame:
    return sequences.base_composition(v("br_fastq"))


@query("A31_split_at_gaps", f"WITH c AS (SELECT name, regexp_split_to_array(regexp_replace(seq, '[^ACGT]', 'N', 'gs'), 'N{{2,}}') AS parts FROM br_fastq), p AS (SELECT name, generate_subscripts(parts, 1) - 1 AS part, unnest(parts) AS seq FROM c) SELECT name, {B('part')} AS part, seq FROM p WHERE length(seq) > 0")
def _(v: Views) -> DataFrame:
    return sequences.split_at_gaps(v("br_fastq").select("name", sequences.clean_base(F.col("seq")).alias("seq")), 2)


# Chunks are filled one record after another.
_FILLED = """f AS (SELECT i, CASE WHEN i = 1 THEN 0 ELSE NULL END AS chunk, n AS held FROM u WHERE i = 1 UNION ALL
 SELECT u.i, CASE WHEN n > 0 AND f.held + n > 30000 THEN f.chunk + 1 ELSE f.chunk END, CASE WHEN n > 0 AND f.held + n > 30000 THEN n ELSE f.held + n END FROM f JOIN u ON u.i = f.i + 1)"""


@query("W17_chunk_by_bases", f"WITH RECURSIVE u AS (SELECT row_number() OVER (ORDER BY rec_no) AS i, rec_no, length(seq) AS n FROM br_fastq), {_FILLED} SELECT rec_no, {B('chunk')} AS chunk FROM f JOIN u USING (i)")
def _(v: Views) -> DataFrame:
    return sequences.chunk_by_bases(v("br_fastq"), 30_000).select("rec_no", "chunk")


@query("W17_chunks_of_pairs", f"WITH RECURSIVE u AS (SELECT rec_no // 2 AS pair, row_number() OVER (ORDER BY min(rec_no)) AS i, sum(length(seq)) AS n FROM br_fastq GROUP BY 1), {_FILLED} SELECT rec_no, {B('chunk')} AS chunk FROM f JOIN u USING (i) JOIN br_fastq ON pair = rec_no // 2")
def _(v: Views) -> DataFrame:
    return sequences.chunk_by_bases(v("br_fastq").withColumn("pair", F.floor(F.col("rec_no") / 2)), 30_000, "pair").select("rec_no", "chunk")


@query("X8_reverse_complement", "SELECT rec_no, reverse(translate(seq, 'ACGTRYKMBVDHacgtrykmbvdh', 'TGCAYRMKVBHDtgcayrmkvbhd')) AS rc, round(100.0 * (length(seq) - length(translate(upper(seq), 'GC', ''))) / nullif(length(seq), 0), 6) AS gc FROM br_fastq")
def _(v: Views) -> DataFrame:
    return v("br_fastq").select("rec_no", sequences.reverse_complement(F.col("seq")).alias("rc"), sequences.gc_percent(F.col("seq")).alias("gc"))


@query("X8_pair_code", "WITH x AS (SELECT var_id, ref, substr(alt, length(alt)) AS b FROM br_variants) SELECT var_id, CASE WHEN ref = b THEN ref ELSE CASE concat(least(ref, b), greatest(ref, b)) WHEN 'AC' THEN 'M' WHEN 'AG' THEN 'R' WHEN 'AT' THEN 'W' WHEN 'CG' THEN 'S' WHEN 'CT' THEN 'Y' WHEN 'GT' THEN 'K' END END AS code FROM x")
def _(v: Views) -> DataFrame:
    return v("br_variants").select("var_id", sequences.pair_code(F.col("ref"), F.substring("alt", -1, 1)).alias("code"))


@query("X9_trimmed_bases", "SELECT read_id, CAST(CASE WHEN seq_len < 35 THEN 0 ELSE least(greatest(0, mapq), seq_len - 35) END AS BIGINT) AS trimmed FROM br_reads")
def _(v: Views) -> DataFrame:
    quals = F.transform(F.sequence(F.lit(1).cast("long"), F.col("seq_len")), lambda i: F.when(i > F.col("seq_len") - F.col("mapq"), 2).otherwise(40))
    return v("br_reads").select("read_id", "seq_len", "mapq").repartition("read_id").withColumn("quals", quals).select("read_id", sequences.trimmed_bases(F.col("quals"), 20).cast("long").alias("trimmed"))


@query("X7_compose_flag", "SELECT read_id, CAST(CASE WHEN pos % 3 = 0 THEN 0 ELSE 1 + CASE WHEN flag & 6 = 2 THEN 2 ELSE 0 END + CASE WHEN pos % 5 = 0 THEN 32 ELSE 0 END + (flag & 192) END + (flag & 4) + (flag & 16) + (flag & 1024) AS BIGINT) AS flag FROM br_reads")
def _(v: Views) -> DataFrame:
    bit = lambda mask: F.col("flag").bitwiseAND(F.lit(mask)) != 0
    made = alignments.compose_flag(paired=F.col("pos") % 3 != 0, proper=bit(2), unmapped=bit(4), reverse=bit(16), mate_reverse=F.col("pos") % 5 == 0, first=bit(64), second=bit(128), duplicate=bit(1024))
    return v("br_reads").select("read_id", made.alias("flag"))


# Call sets


@query("A20_allele_counts", f"WITH g AS (SELECT site, CASE WHEN dp % 9 = 0 THEN 2 ELSE a1 END AS a1, CASE WHEN dp % 4 <> 0 THEN a2 END AS a2 FROM br_genotypes) SELECT site, {B('count(a1) + count(a2)')} AS an, concat(count(*) FILTER (a1 = 1) + count(*) FILTER (a2 = 1), ',', count(*) FILTER (a1 = 2) + count(*) FILTER (a2 = 2)) AS ac FROM g GROUP BY site")
def _(v: Views) -> DataFrame:
    haploid = {"a1": F.when(F.col("dp") % 9 == 0, 2).otherwise(F.col("a1")), "a2": F.when(F.col("dp") % 4 != 0, F.col("a2"))}
    return calls.allele_counts(v("br_genotypes").withColumns(haploid), 2)


@query("A24_venn_shares", f"WITH {_GROUPS}, c AS (SELECT combination, count(*) AS sites FROM comb GROUP BY combination), e AS (SELECT combination, unnest(string_split(combination, ',')) AS src, sites FROM c) SELECT combination, src, {B('sites')} AS sites, round(100.0 * sites / sum(sites) OVER (PARTITION BY src), 6) AS percent FROM e")
def _(v: Views) -> DataFrame:
    return calls.venn_shares(v("br_calls"), 2)


@query(
    "A24_allele_matches",
    f"""WITH a AS (SELECT chrom, pos, min({{'r': ref, 'a': alt}}) AS x FROM br_variants WHERE var_id % 3 <> 0 GROUP BY 1, 2), b AS (SELECT chrom, pos, min({{'r': ref, 'a': CASE WHEN var_id % 5 = 0 THEN 'G' ELSE alt END}}) AS y FROM br_variants WHERE var_id % 3 <> 1 GROUP BY 1, 2)
SELECT {B("count(*)")} AS shared, {B("count(*) FILTER (x.r = y.r)")} AS ref_match, {B("count(*) FILTER (x.r <> y.r)")} AS ref_mismatch, {B("count(*) FILTER (x.a = y.a)")} AS alt_match, {B("count(*) FILTER (x.a <> y.a)")} AS alt_mismatch FROM a JOIN b USING (chrom, pos)""",
)
def _(v: Views) -> DataFrame:
    x = v("br_variants")
    return calls.allele_matches(x.where("var_id % 3 <> 0"), x.where("var_id % 3 <> 1").withColumn("alt", F.when(F.col("var_id") % 5 == 0, "G").otherwise(F.col("alt"))))


_SF = f"""{_GROUPS}, s AS (SELECT chrom, grp, src, bool_and(qual < 30) AS f FROM br_calls JOIN g1 USING (chrom, pos) GROUP BY 1, 2, 3),
sf AS (SELECT chrom, grp, string_agg(concat(src, CASE WHEN f THEN 'f' ELSE '' END), ',' ORDER BY src) AS sf, count(*) AS n, min(src) AS first FROM s GROUP BY 1, 2)"""


def _failed(v: Views) -> DataFrame:
    return v("br_calls").withColumn("failed", F.col("qual") < 30)


@query("U1_isec_records", f"WITH {_SF} SELECT chrom, pos, sf, src, allele, qual FROM br_calls JOIN g1 USING (chrom, pos) JOIN sf USING (chrom, grp) WHERE n >= 2 QUALIFY row_number() OVER (PARTITION BY chrom, pos, sf ORDER BY src, allele, qual) = 1")
def _(v: Views) -> DataFrame:
    return calls.isec_records(_failed(v), 2, "+", 2).select("chrom", "pos", "sf", "src", "allele", "qual")


@query("U1_one_file_only", f"WITH {_SF} SELECT chrom, pos, sf, src, allele, qual FROM br_calls JOIN g1 USING (chrom, pos) JOIN sf USING (chrom, grp) WHERE n >= 2 AND src = first QUALIFY row_number() OVER (PARTITION BY chrom, pos, sf ORDER BY src, allele, qual) = 1")
def _(v: Views) -> DataFrame:
    return calls.isec_records(_failed(v), 2, "+", 2, one_file_only=True).select("chrom", "pos", "sf", "src", "allele", "qual")


@query(
    "U4_merge_records",
    f"""WITH s AS (SELECT src, chrom, pos, CASE WHEN src = 2 THEN NULL WHEN allele % 2 = 0 THEN concat('id', src) END AS id, CASE WHEN src = 1 THEN 'AC' ELSE 'A' END AS ref, CASE WHEN src = 1 THEN 'GC' ELSE 'G' END AS alt, CASE WHEN src = 2 THEN 0 ELSE qual END AS qual, allele, src + 1 AS w, qual % 10 AS an FROM br_calls QUALIFY row_number() OVER (PARTITION BY src, chrom, pos ORDER BY allele, qual) = 1),
g AS (SELECT chrom, pos, max(ref) AS ref, arg_min(id, src) FILTER (id IS NOT NULL) AS id, sum(qual * w) FILTER (qual > 0) / CAST(sum(w) FILTER (qual > 0) AS DOUBLE) AS q, bool_or(allele = 3) AS bad, string_agg(CAST(src AS VARCHAR), ',' ORDER BY src) AS sf, sum(an) AS an, sum(src) AS ac, min(qual) AS lowest FROM s GROUP BY chrom, pos)
SELECT chrom, pos, id, ref, CASE WHEN ref = 'AC' THEN 'GC' ELSE 'G' END AS alt, round(q, 6) AS qual, CASE WHEN bad THEN 'q3' ELSE 'PASS' END AS filter, sf, {B("an")} AS an, CAST(CAST(ac AS BIGINT) AS VARCHAR) AS ac, lowest FROM g""",
)
def _(v: Views) -> DataFrame:
    one = v("br_calls").groupBy("src", "chrom", "pos").agg(F.min(F.struct("allele", "qual")).alias("r")).select("src", "chrom", "pos", "r.*")
    src = F.col("src")
    made = {
        "id": F.when((src != 2) & (F.col("allele") % 2 == 0), F.concat(F.lit("id"), src)), "ref": F.when(src == 1, "AC").otherwise("A"), "alts": F.array(F.when(src == 1, "GC").otherwise("G")), "filter": F.array(F.when(F.col("allele") == 3, "q3").otherwise("PASS")),
        "info": F.create_map(F.lit("AN"), (F.col("qual") % 10).cast("string"), F.lit("AC"), src.cast("string")), "n_samples": src + 1, "qual": F.when(src == 2, 0).otherwise(F.col("qual")),
    }
    return calls.merge_records(one.withColumns(made), {"lowest": F.min("qual")})


@query("X4_genotype_bases", "SELECT site, sample, CASE WHEN a1 IS NULL THEN './.' ELSE concat(CASE a1 WHEN 0 THEN 'AT' ELSE 'C' END, CASE WHEN phased = 1 THEN '|' ELSE '/' END, CASE a2 WHEN 0 THEN 'AT' ELSE 'C' END) END AS bases, a1 IS NOT NULL AND phased = 1 AS phased, a1 IS NULL AS missing, coalesce(a1 + a2, 0) AS total FROM br_genotypes")
def _(v: Views) -> DataFrame:
    gt = calls.decode_genotypes(v("br_genotypes"))
    parts = calls.split_genotype(F.col("gt"))
    total = F.aggregate(parts["alleles"], F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))
    return gt.select("site", "sample", calls.genotype_bases(F.col("gt"), F.lit("AT"), F.array(F.lit("C"))).alias("bases"), parts["phased"].alias("phased"), parts["missing"].alias("missing"), total.alias("total"))


_BACKGROUND = """g AS (SELECT * REPLACE (CASE WHEN sample = 'S1' THEN 1 - a1 ELSE a1 END AS a1) FROM br_genotypes), m AS (SELECT site, a1 AS x, a2 AS y FROM g WHERE sample = 'S1' AND greatest(coalesce(a1, 0), coalesce(a2, 0)) > 0),
b AS (SELECT *, dp >= 5 AND a1 IS NOT NULL AS ok FROM g JOIN m USING (site) WHERE sample IN ('S2', 'S3'))"""
_NOVEL = "((x > 0 AND NOT coalesce(bool_or(x > 0 AND (a1 = x OR a2 = x)), false)) OR (y > 0 AND NOT coalesce(bool_or(y > 0 AND (a1 = y OR a2 = y)), false))) AND count(*) FILTER (ok) >= 1"


def _unlike(v: Views) -> DataFrame:
    """Genotypes of which S1's first allele is turned, as those of a site are alike."""
    return v("br_genotypes").withColumn("a1", F.when(F.col("sample") == "S1", 1 - F.col("a1")).otherwise(F.col("a1")))


@query(
    "C1_sample_contrast",
    f"""WITH {_BACKGROUND} SELECT site, {B("count(*) FILTER (ok)")} AS n_background, {B("min(dp)")} AS min_background_dp,
 {B("min(least(CAST(a1 <> x AS INTEGER) + CAST(a2 <> y AS INTEGER), CAST(a1 <> y AS INTEGER) + CAST(a2 <> x AS INTEGER))) FILTER (ok)")} AS score FROM b GROUP BY site, x, y HAVING {_NOVEL}""",
)
def _(v: Views) -> DataFrame:
    return calls.sample_contrast(_unlike(v), "S1", ["S2", "S3"], 5)


@query(
    "C1_by_likelihood",
    f"WITH {_BACKGROUND} SELECT site, {B('count(*) FILTER (ok)')} AS n_background, {B('min(dp)')} AS min_background_dp, {B('min(CASE x + y WHEN 1 THEN dp ELSE dp * 2 END) FILTER (ok)')} AS score FROM b GROUP BY site, x, y HAVING {_NOVEL}",
)
def _(v: Views) -> DataFrame:
    return calls.sample_contrast(_unlike(v).withColumn("pl", F.array(F.lit(0), F.col("dp"), F.col("dp") * 2)), "S1", ["S2", "S3"], 5, by_likelihood=True)


@query("K5_gen_haps", """WITH f AS (SELECT var_id AS site, chrom, pos, ref, alt FROM br_variants WHERE length(ref) = 1 AND length(alt) = 1 AND ref <> alt QUALIFY row_number() OVER (PARTITION BY chrom, pos ORDER BY var_id) = 1),
g AS (SELECT site, string_agg(CASE a1 + a2 WHEN 0 THEN '1 0 0' WHEN 1 THEN '0 1 0' ELSE '0 0 1' END, ' ' ORDER BY sample) AS gen, string_agg(concat(a1, ' ', a2), ' ' ORDER BY sample) AS hap FROM br_genotypes WHERE sample IN ('S1', 'S3', 'S5') AND a1 IS NOT NULL AND a2 IS NOT NULL GROUP BY site HAVING count(*) = 3 AND sum(a1 + a2) >= 1)
SELECT 'gen' AS part, concat_ws(' ', chrom, concat(chrom, ':', pos), pos, ref, alt, gen) AS line FROM f JOIN g USING (site) UNION ALL SELECT 'hap', hap FROM f JOIN g USING (site) UNION ALL SELECT 'legend', concat_ws(' ', concat(chrom, ':', pos), pos, ref, alt) FROM f JOIN g USING (site)
UNION ALL SELECT DISTINCT 'sample', concat_ws(' ', sample, sample, '0') FROM br_genotypes WHERE sample IN ('S1', 'S3', 'S5')""")  # fmt: skip
def _(v: Views) -> DataFrame:
    made = genotypes.gen_haps(v("br_genotypes"), v("br_variants").withColumnRenamed("var_id", "site"), ["S1", "S3", "S5"], 1)
    parts = [t.select(F.lit(name).alias("part"), "line") for name, t in made.items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


@query("P6_depth_of_strands", "SELECT var_id, CASE WHEN f = '' THEN 'PASS' ELSE f END AS filters FROM (SELECT var_id, concat_ws(';', CASE WHEN qual < 10 THEN 'Qual' END, CASE WHEN (CASE WHEN dp % 2 = 0 THEN dp ELSE dp * 2 + 1 END) < 8 THEN 'MinDP' END, CASE WHEN (CASE WHEN dp % 2 = 0 THEN dp ELSE dp * 2 + 1 END) > 60 THEN 'MaxDP' END) AS f FROM br_variants)")
def _(v: Views) -> DataFrame:
    typed = v("br_variants").withColumns({"dp4": F.concat_ws(",", "dp", F.lit(0), "dp", F.lit(1)), "dp": F.when(F.col("dp") % 2 == 0, F.col("dp"))})
    return records.threshold_filters(typed, {"MinDP": 8, "MaxDP": 60}).select("var_id", "filters")


@query("T2_state_changes", f"WITH {_LATEST}, old AS (SELECT obj_id, state FROM br_history WHERE changed < {_NOON} QUALIFY row_number() OVER (PARTITION BY obj_id ORDER BY changed DESC, row_id DESC) = 1), new AS (SELECT obj_id, state FROM br_history WHERE changed >= {_NOON} QUALIFY row_number() OVER (PARTITION BY obj_id ORDER BY changed DESC, row_id DESC) = 1) SELECT obj_id, old.state AS before, new.state AS state FROM new LEFT JOIN old USING (obj_id) WHERE old.state IS DISTINCT FROM new.state")
def _(v: Views) -> DataFrame:
    events = v("br_history").withColumn("changed", F.col("changed").cast("timestamp"))
    noon = F.lit("2024-01-10 00:00:00").cast("timestamp")
    return tracking.state_changes(events.where(F.col("changed") >= noon), tracking.latest_state(events.where(F.col("changed") < noon))).select("obj_id", "before", "state")
