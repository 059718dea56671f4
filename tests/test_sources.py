"""Readers, writers and streams on small texts of our own."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from strandframe.operators import intervals, sequences, stats, variants
from strandframe.sources import sinks, text
from strandframe.streaming import tracking

VCF = "##fileformat=VCFv4.1\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\n1\t10\trs1\tA\tC,G\t30\tPASS\tDP=5;DB;AF=0.5\tGT:DP\t0/1:3\t./.\n1\t12\t.\tAT\tA\t.\t.\t.\tGT\t1/1\t0|1\n"


def file(tmp_path, name, content):
    (tmp_path / name).write_text(content)
    return str(tmp_path / name)


def test_vcf(spark, tmp_path):
    v, g = text.read_vcf(spark, file(tmp_path, "a.vcf", VCF))
    rows = v.orderBy("pos").collect()
    assert rows[0].info == {"DP": "5", "DB": "", "AF": "0.5"} and rows[0].alt == ["C", "G"] and rows[0].qual == 30 and rows[1].id is None and rows[1].info == {}
    cells = {(r.pos, r["sample"]): (r.gt, r.fields) for r in g.collect()}
    assert cells[10, "A"] == ("0/1", {"GT": "0/1", "DP": "3"}) and cells[10, "B"] == ("./.", {"GT": "./."}) and cells[12, "B"][0] == "0|1"
    sinks.write_vcf(v, str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["1\t10\trs1\tA\tC,G\t30\tPASS\tAF=0.5;DB;DP=5", "1\t12\t.\tAT\tA\t.\t.\t."]


def test_sam_fastq_fasta_gff(spark, tmp_path):
    sam = text.read_sam(spark, file(tmp_path, "a.sam", "@HD\tVN:1.0\nr1\t99\tc1\t5\t60\t4M\t=\t9\t8\tACGT\tIIII\tRG:Z:x:y\tNM:i:1\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n"))
    assert [(r.flag, r.tags) for r in sam.orderBy("qname").collect()] == [(99, {"RG": "x:y", "NM": "1"}), (4, {})]
    fastq = text.read_fastq(spark, file(tmp_path, "a.fq", "@q1 x\nACG\n+\n@II\n@q2\nAA\n+\nII\n"))
    assert [(r.name, r.seq, r.qual) for r in fastq.orderBy("rec_no").collect()] == [("q1", "ACG", "@II"), ("q2", "AA", "II")]
    with pytest.raises(PySparkException):
        text.read_fastq(spark, file(tmp_path, "b.fq", "@q1\nACG\n+\n")).collect()
    fasta = text.read_fasta(spark, file(tmp_path, "a.fa", ">c1 note\nACGT\nAC\n>c2\nTT\n"), 4)
    assert sorted(map(tuple, fasta.collect())) == [("c1", 0, "ACGT"), ("c1", 1, "AC"), ("c2", 0, "TT")]
    gff = text.read_gff(spark, file(tmp_path, "a.gff", "##x\ns\t.\tCDS\t10\t20\t.\t-\t0\tID=a;locus_tag=g1\ns\t.\tCDS\t30\t34\t.\t-\t0\tlocus_tag=g1\ns\t.\tgene\t1\t2\t.\t+\t.\tID=z\n"))
    assert [(r.gene_id, r.strand, r.gene_start, r.gene_end, r.exon_length, len(r.exons)) for r in gff.collect()] == [("g1", -1, 10, 34, 16, 2)]


def test_golden_values(spark):
    """Values that the blueprint lists for histograms and intervals."""
    hist = spark.createDataFrame([("a", 1, 5), ("a", 2, 10), ("a", 3, 5), ("b", 1, 3), ("b", 2, 5), ("b", 3, 1), ("b", 6, 2), ("b", 10, 1)], "k string, bin long, freq long")
    found = {r.k: r for r in stats.histogram_stats(hist, ["k"]).collect()}
    assert found["a"].median == 2
    b = found["b"]
    assert (b.q1, b.median, b.q3, b.total) == (1, 2, 3, 12) and abs(b["mean"] - 3.16666666666667) < 1e-9 and abs(b.sd - 2.64049658629248) < 1e-9
    iv = spark.createDataFrame([("c", 5, 9), ("c", 10, 12), ("c", 20, 30), ("c", 22, 24)], "chrom string, start_pos long, end_pos long")
    once = intervals.merge_intervals(iv)
    assert sorted(map(tuple, once.collect())) == [("c", 5, 12), ("c", 20, 30)] == sorted(map(tuple, intervals.merge_intervals(once).collect()))


def test_windows_across_blocks(spark):
    """Chains and clusters that cross block borders."""
    edge = 1 << 14
    rows = [(i, "c", edge - 6 + 2 * i, "A", "C", 1) for i in range(8)] + [(100, "c", 5 * edge, "A", "C", 1)]
    df = spark.createDataFrame(rows, "var_id long, chrom string, pos long, ref string, alt string, qual long")
    groups = {r.var_id: r.grp for r in variants.cluster_by_distance(df, 2).collect()}
    assert len({groups[i] for i in range(8)}) == 1 and groups[100] != groups[0]
    assert {r.var_id: r.clustered for r in variants.snp_cluster_filter(df, 8, 20).collect()} == {**{i: True for i in range(8)}, 100: False}


def test_trimming(spark):
    """Against the running-sum rule written out."""

    def brute(q, threshold, shortest):
        if len(q) < shortest:
            return 0
        total = best = cut = 0
        for k in range(1, len(q) - shortest + 1):
            total += threshold - q[-k]
            if total < 0:
                break
            if total > best:
                best, cut = total, k
        return cut

    rows = [([30] * 36 + [2, 3, 40, 2],), ([2] * 50,), ([30] * 10,), ([25] * 40,)]
    df = spark.createDataFrame(rows, "q array<int>")
    assert [r[0] for r in df.select(sequences.trimmed_bases(F.col("q"), 20)).collect()] == [brute(q, 20, 35) for (q,) in rows]


def test_streams(spark, tmp_path):
    rows = [(i % 5, i, "s" + str(i % 3), f"2024-01-{1 + i % 20:02d} 0{i % 10}:00:00") for i in range(60)]
    batch = spark.createDataFrame(rows, "obj_id long, row_id long, state string, c string").withColumn("changed", F.to_timestamp("c")).drop("c")
    batch.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    for name, op, mode in (("t2", tracking.latest_state, "complete"), ("t3", tracking.activity_sessions, "append")):
        run = op(stream).writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        run.awaitTermination(120)
        have = {tuple(r) for r in spark.table(name).collect()}
        want = {tuple(r) for r in op(batch).collect()}
        assert have == want if mode == "complete" else have <= want and have


def test_headers_and_round_trip(spark, tmp_path):
    """Two files with different samples keep their own; a written table reads back whole, header, genotypes and missing values among it."""
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.vcf").write_text(VCF)
    (folder / "b.vcf").write_text(VCF.replace("\tA\tB\n", "\tB\tC\n").replace("1\t10\t", "2\t10\t").replace("1\t12\t", "2\t12\t"))
    v, g = text.read_vcf(spark, str(folder))
    assert sorted((r.chrom, r.pos, r["sample"], r.gt) for r in g.collect()) == sorted([("1", 10, "A", "0/1"), ("1", 10, "B", "./."), ("1", 12, "A", "1/1"), ("1", 12, "B", "0|1"), ("2", 10, "B", "0/1"), ("2", 10, "C", "./."), ("2", 12, "B", "1/1"), ("2", 12, "C", "0|1")])
    sinks.write_vcf(v, str(tmp_path / "back"), g, ["A", "B", "C"], ["##fileformat=VCFv4.1", '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth, all">'])
    v2, g2 = text.read_vcf(spark, str(tmp_path / "back"))
    key = lambda r: str(r.asDict())
    assert sorted(map(key, v.collect())) == sorted(map(key, v2.collect()))
    whole = {(r.chrom, r.pos, r["sample"]): r.gt for r in g2.collect() if r.gt not in (None, ".")}
    assert whole == {(r.chrom, r.pos, r["sample"]): r.gt for r in g.collect()}
    header = {(r.key, r.attributes.get("ID")): r.attributes for r in text.vcf_header(spark, str(tmp_path / "back")).collect()}
    assert header["INFO", "DP"]["Description"] == "Depth, all" and header["fileformat", None] == {"value": "VCFv4.1"}
    some = sinks.vcf_lines(v.withColumn("chrom", F.lit(None).cast("string")).where("pos = 12")).first().value
    assert some.split("\t")[:5] == [".", "12", ".", "AT", "A"] and len(some.split("\t")) == 8


def test_long_files(spark, tmp_path):
    """Records over several splits and files; contigs over blocks of lines."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        for k in range(3):
            (tmp_path / f"{k}.fq").write_text("".join(f"@q{k}_{i}\nAC{'G' * (i % 50)}\n+\n@@{'@' * (i % 50)}\n" for i in range(300)))
        found = text.read_fastq(spark, str(tmp_path / "*.fq")).collect()
        assert len(found) == 900 and {(r.name, len(r.seq)) for r in found} == {(f"q{k}_{i}", 2 + i % 50) for k in range(3) for i in range(300)}
        seqs = {f"c{k}": "".join("ACGT"[(i * i + k) % 4] for i in range(k * 3000)) for k in range(4)}
        (tmp_path / "a.fa").write_text("".join(f">{n} x\n" + "".join(s[i : i + 61] + "\n" for i in range(0, len(s), 61)) for n, s in seqs.items()))
        chunks = {}
        for r in text.read_fasta(spark, str(tmp_path / "a.fa"), 1000).collect():
            chunks.setdefault(r.chrom, {})[r.chunk_no] = r.seq
        assert {n: "".join(c[k] for k in sorted(c)) for n, c in chunks.items()} == seqs
        header = text.read_sam_header(spark, file(tmp_path, "h.sam", "@HD\tVN:1.0\n@RG\tID:a\tSM:s:1\nr\t4\n")).collect()
        assert {r.kind: r.tags for r in header} == {"HD": {"VN": "1.0"}, "RG": {"ID": "a", "SM": "s:1"}}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
