"""Views that give the driver's tables the shape of sequencing data; the same SQL runs in Spark and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents".split()

BRIDGE = {
    "br_reads": """SELECT CAST(l_orderkey*10+l_linenumber AS BIGINT) AS read_id, concat('q', l_orderkey) AS qname,
  CAST(1 + CASE WHEN l_linestatus='O' THEN 2 ELSE 0 END + CASE WHEN floor(l_tax*100+0.5)=8 THEN 4 ELSE 0 END
   + CASE WHEN l_returnflag='R' THEN 16 ELSE 0 END + CASE WHEN l_linenumber%2=1 THEN 64 ELSE 128 END
   + CASE WHEN floor(l_discount*100+0.5)=10 THEN 1024 ELSE 0 END AS BIGINT) AS flag,
  concat('chr', l_suppkey%5+1) AS chrom, CAST((l_partkey*37+l_orderkey)%100000+1 AS BIGINT) AS pos,
  CAST(floor(l_quantity) AS BIGINT) AS mapq, CAST(50+l_linenumber*10 AS BIGINT) AS seq_len,
  CAST(floor(l_extendedprice) AS BIGINT)%600 AS isize, CAST(floor(l_tax*100+0.5) AS BIGINT) AS nm,
  concat('rg', l_suppkey%7) AS rg
FROM {lineitem}""",
    "br_variants": """SELECT CAST(p_partkey AS BIGINT) AS var_id, concat('chr', p_partkey%5+1) AS chrom,
  CAST((p_partkey*13)%5000+1 AS BIGINT) AS pos, substr('ACGT', p_size%4+1, 1) AS ref,
  CASE WHEN p_size%11=0 THEN concat(substr('ACGT', p_size%4+1, 1), 'TT')
       ELSE substr('CGTA', (p_size%4 + CASE WHEN p_brand<'Brand#3' THEN 0 ELSE 1 END)%4+1, 1) END AS alt,
  CAST(floor(p_retailprice) AS BIGINT)%100 AS qual, CAST(p_size AS BIGINT) AS dp, p_brand AS filt
FROM {part}""",
    "br_calls": """SELECT CAST(s.src AS BIGINT) AS src, concat('chr', p_partkey%5+1) AS chrom,
  CAST((p_partkey*13)%5000+1 + CASE WHEN s.src=1 AND p_partkey%7=0 THEN 1 ELSE 0 END AS BIGINT) AS pos,
  CAST(p_size%4 AS BIGINT) AS allele, CAST(floor(p_retailprice) AS BIGINT)%100 AS qual
FROM {part} CROSS JOIN (SELECT 0 AS src UNION ALL SELECT 1 UNION ALL SELECT 2) s
WHERE p_partkey % (s.src+2) <> 0""",
    "br_genotypes": """SELECT CAST(site AS BIGINT) AS site, sample, CASE WHEN k%17=0 THEN NULL ELSE CAST(k%2 AS BIGINT) END AS a1,
  CASE WHEN k%17=0 THEN NULL ELSE CAST(floor(k/2) AS BIGINT)%2 END AS a2,
  CAST(CASE WHEN k%3=0 THEN 1 ELSE 0 END AS BIGINT) AS phased, CAST(k%50 AS BIGINT) AS dp, concat('C', k%3) AS cohort
FROM (SELECT o_orderkey%200 AS site, concat('S', o_custkey%12) AS sample, max(o_orderkey) AS k
      FROM {orders} GROUP BY o_orderkey%200, concat('S', o_custkey%12)) g""",
    "br_intervals": """SELECT CAST(s_suppkey AS BIGINT) AS iv_id, concat('chr', s_suppkey%5+1) AS chrom,
  CAST((s_suppkey*977)%40000+1 AS BIGINT) AS start_pos,
  CAST((s_suppkey*977)%40000+1501+(s_suppkey%7)*900 AS BIGINT) AS end_pos,
  CAST(CASE WHEN s_nationkey%2=0 THEN 1 ELSE -1 END AS BIGINT) AS strand
FROM {supplier}""",
    "br_history": """SELECT CAST(event_id AS BIGINT) AS row_id, CAST(user_id AS BIGINT) AS obj_id, event_type AS state,
  CAST(event_id%1024 AS BIGINT) AS processed, value, ts AS changed
FROM {events}""",
    "br_lanes": """SELECT CAST(l_suppkey*10+l_linenumber AS BIGINT) AS lane_id, CAST(l_suppkey AS BIGINT) AS library_id,
  n_name AS sample, r_name AS project, CAST(count(*) AS BIGINT) AS raw_reads,
  CAST(sum(CAST(floor(l_quantity) AS BIGINT)) AS BIGINT) AS raw_bases, min(l_shipdate) AS run_date,
  CASE l_linenumber%4 WHEN 0 THEN 'no_qc' WHEN 1 THEN 'passed' WHEN 2 THEN 'failed' ELSE 'pending' END AS qc_status
FROM {lineitem} JOIN {supplier} ON l_suppkey=s_suppkey JOIN {nation} ON s_nationkey=n_nationkey JOIN {region} ON n_regionkey=r_regionkey
GROUP BY l_suppkey, l_linenumber, n_name, r_name""",
    "br_fastq": """SELECT CAST(doc_id AS BIGINT) AS rec_no, concat('d', doc_id) AS name,
  translate(lower(substr(text, 1, 100)), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq
FROM {documents}""",
    "br_quality": """SELECT CAST(l_linenumber AS BIGINT) AS cycle, CAST(floor(l_quantity) AS BIGINT) AS qual,
  CAST(CASE WHEN l_returnflag='R' THEN 1 ELSE 2 END AS BIGINT) AS mate
FROM {lineitem}""",
}
#: br_reads with what else pairs have: mates, base qualities (summed) and bases by CIGAR and trimming.
BRIDGE["br_pairs"] = f"""SELECT read_id, qname, CAST(flag + CASE WHEN pos % 2 = 0 THEN 32 ELSE 0 END + CASE WHEN read_id % 19 = 0 THEN 256 ELSE 0 END + CASE WHEN read_id % 23 = 0 THEN 512 ELSE 0 END
   + CASE WHEN mapq % 7 = 0 THEN 8 ELSE 0 END AS BIGINT) AS flag, chrom, pos, mapq, seq_len, isize, nm, rg, CASE WHEN isize % 5 = 0 THEN concat('chr', read_id % 5 + 1) ELSE chrom END AS mate_chrom,
  CAST(pos + isize - 300 AS BIGINT) AS mate_pos, CAST(seq_len - nm AS BIGINT) AS cigar_mapped, CAST(seq_len * (10 + mapq % 25) AS BIGINT) AS qual_sum, CAST(nm * 2 AS BIGINT) AS trimmed
FROM ({BRIDGE["br_reads"]}) r"""
#: br_fastq takes whole texts as reads, not the first letters only.
BRIDGE["br_fastq"] = BRIDGE["br_fastq"].replace("substr(text, 1, 100)", "text")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A bridge view, or a table of the folder."""
    if name not in BRIDGE:
        return table(spark, sf_dir, name)
    sql = BRIDGE[name]
    return spark.sql(sql, **{t: table(spark, sf_dir, t) for t in re.findall(r"\{(\w+)\}", sql)})


def with_views(sql: str) -> str:
    """The SQL with the bridge views that it names in front."""
    used = [v for v in BRIDGE if re.search(rf"\b{v}\b", sql)]
    heads = ", ".join(f"{v} AS ({BRIDGE[v].format(**{t: t for t in TABLES})})" for v in used)
    if not used:
        return sql
    if sql.strip().upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {heads}, {sql.strip()[15:]}"
    return f"WITH {heads}, {sql.strip()[5:]}" if sql.strip()[:5].upper() == "WITH " else f"WITH {heads} {sql}"
