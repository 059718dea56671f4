"""Cases in which operators gave wrong answers once."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strandframe.operators import calls, declarations, hierarchy, history, intervals, reads, reference, reports, sequences, variants
from strandframe.sources import sinks, text


def test_two_updates_of_one_object(spark):
    hist = spark.createDataFrame([(1, 7, "a", 0, 1.0, 10)], "row_id long, obj_id long, state string, processed long, value double, changed long")
    updates = spark.createDataFrame([(7, 1, "b", 3, 30), (7, 1, "c", 2, 20), (7, 1, "a", 4, 15), (7, 9, "d", 5, 11)], "obj_id long, based_on long, state string, row_id long, changed long")
    found = history.append_versions(history.with_latest(hist), updates).collect()
    assert sorted((r.row_id, r.state, r.latest) for r in found) == [(1, "a", False), (2, "c", True)]


def test_unsorted_rows(spark):
    rows = spark.createDataFrame([("1", 5, 1), ("1", 3, 2), ("1", 7, 3), ("2", 1, 4), ("1", 7, 5), ("1", 6, 20_000)], "chrom string, pos long, line_no long")
    assert sorted(map(tuple, variants.consistency(rows, "line_no").collect())) == [("duplicate", "1", 7, 2), ("unsorted", "1", 3, 1), ("unsorted", "1", 6, 1)]


def test_liftover_by_a_wrong_map(spark):
    rows = spark.createDataFrame([("1", 5), ("1", 6)], "chrom string, pos long")
    mapping = spark.createDataFrame([("1", 5, "x", 50), ("1", 6, "skip", None)], "chrom string, pos long, new_chrom string, new_pos long")
    assert [tuple(r) for r in variants.liftover(rows, mapping).collect()] == [("x", 50)]
    with pytest.raises(Exception, match="no row for 1:6"):
        variants.liftover(rows, mapping.where("pos = 5")).collect()


def test_second_alternative_is_no_second_count(spark):
    gt = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (2, 0, 2), (2, 1, 1), (3, None, 2)], "site long, a1 long, a2 long")
    assert [tuple(r) for r in calls.inbreeding(gt).select("site", "n", "hom1", "het", "hom2").collect()] == [(1, 4, 1, 1, 0)]


def test_nested_segments(spark):
    """As many pieces as breakpoints, by sums only."""
    rows = spark.range(300).select(F.lit("1").alias("chrom"), (F.col("id") + 1).alias("start_pos"), (10_000 - F.col("id")).alias("end_pos"))
    found = sorted(tuple(r) for r in intervals.disjoin(rows).select("start_pos", "end_pos", "n").collect())
    assert len(found) == 599 and found[299] == (300, 9701, 300) and found[-1] == (10_000, 10_000, 1)
    assert "Generate explode(sequence" not in intervals.disjoin(rows)._jdf.queryExecution().toString()


def test_first_segments_reach_back(spark):
    rows = spark.createDataFrame([("1", "a", 1, 10, 2), ("1", "a", 11, 20, 3), ("1", "b", 5, 20, 1)], "chrom string, sample string, start_pos long, end_pos long, copies int")
    found = sorted((r.sample, r.start_pos, r.end_pos, r.copies) for r in intervals.disjoin_samples(rows).collect())
    assert found == [("a", 1, 4, 2), ("a", 5, 10, 2), ("a", 11, 20, 3), ("b", 1, 4, 1), ("b", 5, 10, 1), ("b", 11, 20, 1)]


def test_hierarchies(spark):
    edges = spark.createDataFrame([("a", "1", "b", "1"), ("b", "1", "c", "1"), ("b", "1", "c", "2"), ("a", "1", "c", "2"), ("c", "2", "d", "9"), ("a", "2", "b", "5")], "parent_level string, parent string, level string, id string")
    roots = spark.createDataFrame([("a", 1)], "level string, id int")
    assert sorted(map(tuple, hierarchy.descendants(edges, roots).collect())) == [("b", "1", 1), ("c", "1", 2), ("c", "2", 1), ("d", "9", 2)]
    assert hierarchy.descendants(edges, roots.limit(0)).count() == 0
    loop = edges.union(spark.createDataFrame([("d", "9", "b", "1")], edges.schema))
    with pytest.raises(Exception, match="below itself: (b 1|c 2|d 9)"):
        hierarchy.descendants(loop, roots)


def test_pseudo_reference_is_linear(spark):
    calls = spark.createDataFrame([("1", 1, "A"), ("1", 4, "c"), ("1", 5, "N"), ("1", 9, "T"), ("1", 30, "G"), ("3", 2, "A")], "chrom string, pos long, base string")
    contigs = spark.createDataFrame([("1", 10), ("2", 3), ("3", 1)], "chrom string, length long")
    assert sorted(map(tuple, reference.pseudo_reference(calls, contigs, 4).collect())) == [("1", 0, "ANNc"), ("1", 1, "NNNN"), ("1", 2, "TN"), ("2", 0, "NNN"), ("3", 0, "N")]
    big = spark.range(1, 200_001).select(F.lit("1").alias("chrom"), F.col("id").alias("pos"), F.lit("A").alias("base"))
    seq = reference.pseudo_reference(big, spark.createDataFrame([("1", 200_003)], "chrom string, length long"), 1_000_000).first().seq
    assert seq == "A" * 200_000 + "NNN"


def test_declarations_by_version(spark):
    rows = [("FORMAT", "PL", "-1", "Integer"), ("INFO", "AC", ".", "Integer"), ("FORMAT", "XX", "R", "Float"), ("FORMAT", "DP", "1", "Integer"), ("FILTER", "AC", None, None)]
    table = spark.createDataFrame(rows, "kind string, id string, number string, type string")
    of = lambda version: [r.number for r in declarations.upgrade_declarations(table, version).collect()]
    assert of(4.2) == ["G", "A", "R", "1", None] and of(4.1) == ["G", "A", ".", "1", None]
    assert of(4.0) == [".", ".", ".", "1", None] and of(3.3) == ["-1", "-1", "-1", "1", None]
    header = spark.createDataFrame([("f", "FORMAT", {"ID": "PL", "Number": "G", "Type": "Integer"}), ("f", "source", {"value": "x"})], "file string, key string, attributes map<string,string>")
    assert [tuple(r) for r in declarations.declarations(header).collect()] == [("f", "FORMAT", "PL", "G", "Integer")]


def test_vcf_without_variants(spark, tmp_path):
    none = spark.createDataFrame([], "chrom string, pos long, id string, ref string, alt array<string>, qual double, filter array<string>, info map<string,string>")
    sinks.write_vcf(none, str(tmp_path / "none"), header=["##fileformat=VCFv4.1"])
    lines = [r.value for r in spark.read.text(str(tmp_path / "none")).collect()]
    assert lines == ["##fileformat=VCFv4.1", "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO"])]
    assert text.read_vcf(spark, str(tmp_path / "none"))[0].count() == 0


def test_span_of_starts_within_seconds(spark):
    logs = spark.sql("SELECT * FROM VALUES (1, 0, 'h', timestamp_ntz'2024-01-01 00:00:10.6', 5, 1, 1), (2, 0, 'h', timestamp_ntz'2024-01-01 00:00:20.2', 5, 1, 1), (3, 0, 'h', timestamp_ntz'2024-01-01 00:00:11.5', 5, 1, 1) AS t(job, attempt, host, started, wall, cpu, memory)")
    assert reports.runtime_stats(logs).head().span == 14  # from 11 to 20 + 5, not from 10


def test_pair_of_late_hits(spark):
    hits = lambda start: spark.range(12).select(F.lit("q").alias("qname"), F.col("id").alias("hit_id"), F.lit("1").alias("chrom"), (start - 1000 * F.col("id")).alias("start_pos"), (start - 1000 * F.col("id") + 99).alias("end_pos"))
    found = variants.pair_hits(hits(F.lit(50_000)), hits(F.lit(39_200)), 300)
    assert [tuple(r) for r in found.collect()] == [("q", 11, 0, 300)]  # only the twelfth hit lies near
    assert [tuple(r) for r in variants.pair_hits(hits(F.lit(50_000)), hits(F.lit(39_200)), 300, 10).collect()] == [("q", 9, 0, 1900)]


def _crowd(spark):
    """Rows at one position, of which every third is an insertion, and intervals over it."""
    rows = spark.range(60).selectExpr("id AS var_id", "'1' AS chrom", "100L AS pos", "'A' AS ref", "IF(id % 3 = 0, 'ATT', 'C') AS alt", "50 AS qual")
    iv = spark.range(40).selectExpr("id AS line_no", "id AS iv_id", "'1' AS chrom", "90 - id AS start_pos", "101 + id AS end_pos", "IF(id = 39, 7, NULL) AS q", "id = 3 AS f")
    return rows, iv


def _most_rows(df):
    """The most rows that any step of the run plan made."""
    df.write.format("noop").mode("overwrite").save()
    plan, most = df._jdf.queryExecution().executedPlan(), 0
    df.collect()
    todo = [plan]
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
            continue
        if p.nodeName().endswith("QueryStage"):
            todo.append(p.plan())
            continue
        if p.metrics().contains("numOutputRows"):
            most = max(most, p.metrics().apply("numOutputRows").value())
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return most


def test_many_rows_at_one_position(spark):
    """Each position is looked up once: no step makes a row for each pair but the one whose result that is."""
    rows, iv = _crowd(spark)
    texts = variants.annotate(rows, iv, "iv_id", separator="|")
    assert [r.annotation for r in texts.select("annotation").distinct().collect()] == ["|".join(map(str, range(40)))]
    assert _most_rows(texts) <= 100
    known = rows.selectExpr("var_id AS line_no", "chrom", "pos AS start_pos", "pos AS end_pos", "ref", "alt", "var_id AS v")
    by_allele = variants.annotate(rows, known, "v", match_alleles=True)
    assert {(r.alt, len(r.annotation.split(","))) for r in by_allele.collect()} == {("ATT", 20), ("C", 40)} and by_allele.count() == 60
    assert _most_rows(by_allele) <= 200
    columns = variants.annotate_columns(rows.withColumn("id", F.lit(".")), iv.withColumn("id", F.concat(F.lit("x"), F.col("iv_id") % 2)).withColumn("qual", F.col("q")), "id", ["qual"], ["f"])
    assert {(r.id, r.qual, r.f) for r in columns.collect()} == {("x0;x1", 7, True)} and _most_rows(columns) <= 100
    near = variants.snp_gap_filter(rows, 10)
    assert sum(r.near_indel for r in near.collect()) == 40 and _most_rows(near) <= 100
    moved = variants.snp_gap_filter(rows.withColumn("pos", F.when(F.col("var_id") % 3 == 0, 98).otherwise(F.col("pos"))), 10)
    assert {(len(r.alt) == 1, r.near_indel) for r in moved.collect()} == {(True, True), (False, False)} and _most_rows(moved) <= 100
    assert intervals.positions_in_intervals(rows, iv.drop("q", "f")).count() == 2400
    assert intervals.positions_in_intervals(rows, iv.drop("q", "f")).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_expression_without_pairs(spark):
    """Reads of several lengths over exons that overlap, nest or lie closer than a read is long; no step makes a row for each hit."""
    reads_of = spark.range(4000).selectExpr("IF(id % 7 = 0, 'x', '1') AS chrom", "id % 290 + 1 AS pos", "50 + id % 3 * 40 AS seq_len", "IF(id % 2 = 0, 2, 18) AS flag", "IF(id % 11 = 0, 5, 30) AS mapq")
    spans = {1: [(20, 60), (100, 120), (130, 140)], 2: [(50, 200), (60, 90), (150, 260)], 3: [(400, 500)], 4: [(5, 5), (9, 3), (1, 2)]}
    exons = spark.createDataFrame([(k, "1", s, e) for k, v in spans.items() for s, e in v], "iv_id long, chrom string, start_pos long, end_pos long")
    features = spark.createDataFrame([(k, "1", -1 if k % 2 else 1) for k in spans], "iv_id long, chrom string, strand long")
    found = reads.gene_expression(reads_of, features, exons, 10, reads.PROPER)
    want = {}
    for k, v in spans.items():
        hit = [r for r in reads_of.where("chrom = '1' AND mapq > 10").collect() if any(s <= e and r.pos <= e and r.pos + r.seq_len - 1 >= s for s, e in v)]
        same = sum((r.flag == 18) == (k % 2 == 1) for r in hit)
        want[k] = (same, len(hit) - same)
    assert {r.iv_id: (r.sense, r.antisense) for r in found.collect()} == want and want[2][0] > 100
    assert "r_start" not in found._jdf.queryExecution().toString()


def test_reads_stay_where_they_are(spark):
    rows = spark.range(100).selectExpr("concat('rg', id % 3) AS rg", "id AS read_id")
    found = reads.readgroup_filter(rows, rows.select("rg").distinct(), F.col("rg") != "rg0", F.col("rg") == "rg2")
    assert sorted(r.read_id for r in found.collect()) == list(range(1, 100, 3))
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_trimming_of_unlike_lengths(spark):
    """Reads of very unlike lengths in blocks of few; the reads of a batch are summed at once, without a function for each quality."""
    rows = [(1, [30] * 40 + [2] * 3), (2, None), (3, []), (4, [2] * 20_000), (5, [30] * 50), (6, [30] * 36 + [2, 3, 40, 2])]
    df = spark.createDataFrame(rows, "id int, q array<int>").select("id", sequences.trimmed_bases(F.col("q"), 20).alias("n"))
    assert {r.id: r.n for r in df.collect()} == {1: 3, 2: None, 3: 0, 4: 19_965, 5: 0, 6: 1}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "aggregate(" not in plan


def test_mismatches_without_a_row_for_each_base(spark, monkeypatch):
    """Reads at random against plain Python: blocks over several chunks and pieces, bases before the contig and behind its end, letters of several bytes, missing chunks and qualities."""
    rng = random.Random(3)
    contigs = {c: "".join(rng.choice("ACGTNé😀") for _ in range(n)) for c, n in (("1", 90), ("2", 7), ("3", 40))}
    rows, want = [], Counter()
    for k in range(300):
        cigar, n_read, aligned, pos = "", 0, [], rng.randint(-3, 80)
        at = pos
        for op in rng.choices("MIDNSHP=X", k=rng.randint(1, 6)):
            n = rng.randint(1, 40)
            cigar += f"{n}{op}"
            if op in "M=X":
                aligned += [(n_read + i, at + i) for i in range(n)]
            n_read += n * (op in "MIS=X")
            at += n * (op in "MDN=X")
        n_read = max(0, n_read - rng.choice([0, 0, 5]))  # now and then the CIGAR is longer than the read
        seq, qual = "".join(rng.choice("ACGTaNé😀") for _ in range(n_read)), "".join(rng.choice("#I~") for _ in range(n_read + rng.choice([0, 0, -3, 4])))
        chrom, flag = rng.choice("1234"), rng.choice([0, 16, 83])
        rows.append((k, chrom, pos, cigar, flag, seq, None if k % 50 == 0 else qual))
        for i, p in aligned:
            if k % 50 and i < n_read and 1 <= p <= len(contigs.get(chrom, "")) and not (chrom == "3" and 17 <= p <= 24):
                known = seq[i] in "ACGT"
                if not known or seq[i] != contigs[chrom][p - 1]:
                    want[n_read - i if flag & 16 else i + 1, ord(qual[i]) - 33 if i < len(qual) else None, known] += 1
    reads_of = spark.createDataFrame([*rows, (900, "1", 5, None, 0, "A", "I"), (901, "1", 5, "0M", 0, "", ""), (902, "1", None, "1M", 0, "A", "I")], "k long, chrom string, pos long, cigar string, flag int, seq string, qual string")
    chunks = reference.chunked(spark.createDataFrame(list(contigs.items()), "chrom string, seq string"), 8).where("chrom <> '3' OR chunk_no <> 2")
    for piece in (reference.PIECE, 3):
        monkeypatch.setattr(reference, "PIECE", piece)
        found = reference.mismatch_by_cycle(reads_of, chunks, 8, "k").collect()
        assert len(found) == len({x[:2] for x in want}) and {(r.cycle, r.qual): (r.mismatches, r.n_bases) for r in found} == {x[:2]: (want[*x[:2], True], want[*x[:2], False]) for x in want}
    monkeypatch.undo()
    many = spark.range(300).selectExpr("id AS k", "'1' AS chrom", "1L AS pos", "'90M' AS cigar", "0 AS flag", "repeat('C', 90) AS seq", "repeat('I', 90) AS qual")
    whole = reference.chunked(spark.createDataFrame(list(contigs.items()), "chrom string, seq string"), 90)
    made = reference.mismatch_by_cycle(many, whole, 90, "k")
    assert made.count() == 90 - contigs["1"].count("C") and _most_rows(made) <= 1000  # there are 27,000 bases


def test_chunks_of_contigs(spark):
    contigs = spark.createDataFrame([("1", "AC\nGé😀T"), ("2", ""), ("3", None), ("4", "ACGT")], "chrom string, seq string")
    found = sorted(((r.chrom, r.chunk_no, r.seq) for r in reference.chunked(contigs, 2).collect()), key=lambda x: x[:2])
    assert found == [("1", 0, "AC"), ("1", 1, "\nG"), ("1", 2, "é😀"), ("1", 3, "T"), ("2", 0, ""), ("3", 0, None), ("4", 0, "AC"), ("4", 1, "GT")]
    assert "explode(sequence" not in reference.chunked(contigs, 2)._jdf.queryExecution().toString()
