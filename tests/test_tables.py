"""Table readers and operators on a reference against brute force on small texts of our own."""

import hashlib
import math
import random

from strandframe.operators import genotypes, records, reference
from strandframe.sources import tables


def file(tmp_path, name, content):
    (tmp_path / name).write_text(content)
    return str(tmp_path / name)


def test_ped_map(spark, tmp_path):
    ped = file(tmp_path, "a.ped", "f s1 0 0 1 0 A A C T\nf s2 0 0 2 0 A G 0 0\n")
    gt, alleles = tables.read_ped_map(spark, ped, file(tmp_path, "a.map", "1 rs1 0 100\n2 rs2 0 50\n"))
    assert sorted(map(tuple, gt.collect())) == [("1", 100, "s1", "AA"), ("1", 100, "s2", "AG"), ("2", 50, "s1", "CT"), ("2", 50, "s2", "NN")]
    assert {(r.chrom, r.pos): r.alleles for r in alleles.collect()} == {("1", 100): ["A", "G"], ("2", 50): ["C", "T"]}


def test_index_and_bas(spark, tmp_path):
    row = [f"v{i}" for i in range(26)]
    row[20], row[17], row[23], row[24], row[19] = "1", "300", "10", "1000", ""
    index = tables.read_sequence_index(spark, file(tmp_path, "a.si", "FASTQ_FILE\t" + "\t".join("X" * 25) + "\n" + "\t".join(row) + "\n" + "\t".join(row[:20] + ["0"] + row[21:25]) + "\n"))
    found = sorted(index.collect(), key=lambda r: r.withdrawn)
    assert [(r.withdrawn, r.analysis_group, r.read_count, r.insert_size, r.paired_fastq) for r in found] == [(False, None, 10, 300, None), (True, "v25", 10, 300, None)]
    full = ["f.bam", "abc", "st", "sa", "pl", "li", "rg", "100", "90", "10", "9", "8", "7", "2.5", "30.1", "286", "70.5", "280", "40", "3"]
    cut = lambda k, gone: "\t".join([f"{k}"] + full[1:] if not gone else [x for i, x in enumerate(full) if i not in gone])
    header = "\t".join(["h"] * 18 + ["insert_size_median_absolute_deviation", "h"])
    bas = tables.read_bas(spark, file(tmp_path, "a.bas", "\n".join([header, cut("whole", []), cut("", [19]), cut("", [1, 19]), cut("", [0, 1, 19])]) + "\n"))
    got = sorted(((r.bam_filename or "", r.md5 or "", r.dup_reads or 0, r.study, r.total_bases, r.isize_sd, r.isize_mad) for r in bas.collect()))
    same = ("st", 100, 70.5, 40)
    assert got == [("", "", 0, *same), ("f.bam", "", 0, *same), ("f.bam", "abc", 0, *same), ("whole", "abc", 3, *same)]


def test_logs_array_and_md5(spark, tmp_path):
    one = "Job was executed on host(s) <h{0}>, in queue <q>\nStarted at Wed Feb 17 09:34:14 2010\nResults reported at Wed Feb 17 11:46:19 2010\nExited with exit code {0}.\n    CPU time   :  12.5 sec.\n    Max Memory :      1935 MB\n"
    logs = tables.read_job_logs(spark, file(tmp_path, "a.o", one.format(1) + "\n" + one.format(2))).orderBy("attempt").collect()
    assert [(r.attempt, r.host, r.cpu_seconds, r.memory_mb, r.exit_code, r.started) for r in logs] == [(i, f"h{i + 1}", 12.5, 1935.0, i + 1, "Wed Feb 17 09:34:14 2010") for i in (0, 1)]
    panel = spark.createDataFrame([("rs1", "1", 5, False), ("rs2", "1", 9, True)], "name string, chrom string, pos long, flip boolean")
    report = "[Header]\nx\ty\n[Data]\nSNP Name\tSample ID\tAllele1\tAllele2\tB\tL\nrs1\ts\tA\tC\t0.5\t0.1\nrs2\ts\tA\t-\t0.0\t-0.2\nrs3\ts\tA\tA\t0\t0\n"
    found = tables.read_array_report(spark, file(tmp_path, "r.txt", report), panel).orderBy("pos").collect()
    assert [(r.pos, r["sample"], r.gt, r.baf, r.lrr) for r in found] == [(5, "s", "AC", 0.5, 0.1), (9, "s", "TN", 0.0, -0.2)]
    folder = tmp_path / "m"
    folder.mkdir()
    (folder / "a").write_text("one"), (folder / "b").write_text("two"), (folder / "d").write_text("x")
    recorded = spark.createDataFrame([("a", hashlib.md5(b"one").hexdigest().upper()), ("b", "0"), ("c", "1")], "name string, md5 string")
    assert sorted(map(tuple, tables.md5_check(spark, str(folder), recorded).collect())) == [("a", "ok"), ("b", "differs"), ("c", "no file"), ("d", "not recorded")]


def edited(seq, variants):
    out, at = "", 0
    for pos, ref, alt in sorted(variants):
        if pos - 1 >= at:
            out, at = out + seq[at : pos - 1] + alt, pos - 1 + len(ref)
    return out + seq[at:]


def test_consensus_and_match(spark):
    """Variants at random, with overlaps and across chunk borders, against plain editing of strings."""
    rng = random.Random(5)
    contigs = {f"c{i}": "".join(rng.choice("ACGT") for _ in range(rng.randint(30, 60))) for i in range(30)}
    rows, want = [], {}
    for c, seq in contigs.items():
        places = sorted(rng.sample(range(2, len(seq) - 8), 4))
        own = [(p, seq[p - 1 : p - 1 + rng.randint(1, 7)], rng.choice(["A", "GG", "TTT"])) for p in places]
        kept, reach = [], 0
        for v in own:
            if v[0] > reach:
                kept.append(v)
            reach = max(reach, v[0] + len(v[1]) - 1)
        rows += [(c, p, r, a, i) for i, (p, r, a) in enumerate(own)]
        want[c] = edited(seq, kept)
    chunks = reference.chunked(spark.createDataFrame(list(contigs.items()), "chrom string, seq string"), 7)
    variants = spark.createDataFrame(rows, "chrom string, pos long, ref string, alt string, n int")
    made = {}
    for r in reference.consensus_sequence(chunks, variants, 7, "n").orderBy("chunk_no").collect():
        made[r.chrom] = made.get(r.chrom, "") + r.seq
    assert made == want
    ref = reference.chunked(spark.createDataFrame([("a", "GATTTTACA")], "chrom string, seq string"), 4)
    # One deletion of a repeated letter, written at two places, and one that differs.
    calls = spark.createDataFrame([(0, "a", 2, "AT", "A"), (1, "a", 5, "TT", "T"), (0, "a", 8, "C", "G"), (1, "a", 8, "C", "T")], "src int, chrom string, pos long, ref string, alt string")


def test_blocks_of_a_cigar(spark):
    """Insertions, deletions, clips and both strands."""
    reads = spark.createDataFrame([(1, "c", 3, "2S3M1I2M2D2M", 0, "NNGTAXCCAA", "ABCDEFGHIJ"), (2, "c", 3, "4M", 16, "GTCN", "ABCD")], "k long, chrom string, pos long, cigar string, flag int, seq string, qual string")
    chunks = reference.chunked(spark.createDataFrame([("c", "AAGTACCGGAT")], "chrom string, seq string"), 4)
    found = {(r.cycle, r.qual): (r.mismatches, r.n_bases) for r in reference.mismatch_by_cycle(reads, chunks, 4, "k").collect()}
    # Read 1: G T A against G T A, C C against C C, A A against A T; read 2 from its end: G T C N against G T A C.
    assert found == {(10, ord("J") - 33): (1, 0), (2, ord("C") - 33): (1, 0), (1, ord("D") - 33): (0, 1)}
    events = sorted((r.op, r["size"], r.cycle) for r in reference.indels(reads.withColumn("seq_len", reads.k * 0 + 10)).collect())
    assert events == [("D", 2, 7), ("I", 1, 5)]


def test_hwe_by_enumeration(spark):
    def brute(x, h, y):
        n, a = x + h + y, 2 * x + h
        ways = {k: math.factorial(n) // (math.factorial((a - k) // 2) * math.factorial(k) * math.factorial((2 * n - a - k) // 2)) * 2**k for k in range(a % 2, min(a, 2 * n - a) + 1, 2)}
        return sum(w for w in ways.values() if w <= ways[h]) / sum(ways.values())

    triples = [(x, h, y) for x in range(5) for h in range(6) for y in range(4) if x + h + y]
    table = spark.createDataFrame([*triples, *triples[:3], (None, 1, 1), (0, 0, 0)], "hom1 int, het int, hom2 int")
    found = genotypes.hwe_exact(table).collect()
    assert len(found) == len(triples) + 5
    for r in found:
        assert r.p is None if r.hom1 is None or r.hom1 + r.het + r.hom2 == 0 else abs(r.p - brute(r.hom1, r.het, r.hom2)) < 1e-9


def test_pileup_text(spark):
    cases = {"^+A.,$": (2, 1), ".+12ACGTACGTACGT,": (1, 1), "-2ggA*": (1, 0), "": (0, 0), ",-1a+1C.": (1, 1)}
    rows = spark.createDataFrame([("c", i, b) for i, b in enumerate(cases)], "chrom string, pos long, bases string")
    assert [(r.forward, r.reverse) for r in records.pileup_strand_depth(rows).orderBy("pos").collect()] == list(cases.values())
