"""Reads as text."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.greedy import filled_chunks
from ..plans.prefix import running

#: Qualities of reads, padded to one length, that trimming sums at once.
CELLS = 1 << 20


def clean_base(seq: Column) -> Column:
    """Letters other than ACGT, and all other characters, as N."""
    return F.regexp_replace(seq, "(?s)[^ACGT]", "N")


def count_of(seq: Column, letters: str) -> Column:
    return (F.length(seq) - F.length(F.translate(seq, letters, ""))).cast("long")


def gc_histogram(fastq: DataFrame) -> DataFrame:
    """Records by their number of G and C."""
    return fastq.groupBy(count_of(F.col("seq"), "GC").alias("gc")).agg(F.count("*").alias("n"))


def length_filter(fastq: DataFrame, least: int) -> DataFrame:
    """Records of a length at least."""
    return fastq.where(F.length("seq") >= least)


def id_list_filter(fastq: DataFrame, ids: DataFrame, keep: bool = True) -> DataFrame:
    """Records whose name is listed, or isn't."""
    return fastq.join(ids.select("name").distinct(), "name", "left_semi" if keep else "left_anti")


def base_content(fastq: DataFrame) -> DataFrame:
    """Counts of each base and percentages of A, C, G and T among those at each position (cycle, from 1) of all records."""
    base = fastq.select(F.posexplode(F.split(clean_base(F.col("seq")), "")).alias("cycle", "base")).where("base <> ''")
    n = {b: F.count_if(F.col("base") == b) for b in "ACGTN"}
    known = n["A"] + n["C"] + n["G"] + n["T"]
    return base.groupBy((F.col("cycle") + 1).cast("long").alias("cycle")).agg(*(c.alias(f"n_{b.lower()}") for b, c in n.items()), *(F.try_divide(100.0 * n[b], known).alias(f"pct_{b.lower()}") for b in "ACGT"))


def tag_fraction(fastq: DataFrame, size: int, tag: str | None = None, first: int | None = None, order: str = "rec_no") -> DataFrame:
    """The most common prefix of a size (the smallest on ties) of the first records in an order, or a given tag, and the percentage of all records that begin
    with it."""
    prefix = F.substring(F.col("seq"), 1, size)
    if tag is None:
        some = fastq.select(order, prefix.alias("tag")).orderBy(order).limit(first) if first else fastq.select(prefix.alias("tag"))
        found = some.groupBy("tag").agg(F.count("*").alias("n")).agg(F.min(F.struct(-F.col("n"), F.col("tag"))).alias("t")).select("t.tag")
    else:
        found = fastq.agg(F.lit(tag).alias("tag"))
    hits = fastq.join(F.broadcast(found)).groupBy("tag").agg(F.count_if(F.startswith("seq", F.col("tag"))).alias("n"), F.count("*").alias("total"))
    return hits.select("tag", (100 * F.col("n") / F.col("total")).alias("percent"))


def assembly_stats(contigs: DataFrame, percents: list[int], genome_size: int | None = None) -> DataFrame:
    """For each percentage, the length N of the contig at which so much of the total is reached from the longest on, and how many contigs
    L that takes; of the genome size instead, if it is given (NG, LG; null if not reached). Lengths are counted first; the running sum is over
    distinct lengths, in blocks."""
    counts = contigs.groupBy(F.length("seq").cast("long").alias("len")).agg(F.count("*").alias("n")).withColumn("neg", -F.col("len"))
    run = running(running(counts, [], "neg", ["neg"], F.col("len") * F.col("n"), "cum", "sum"), [], "neg", ["neg"], F.col("n"), "cum_n", "sum")
    x = run.withColumn("total", F.lit(genome_size).cast("long") if genome_size else F.sum(F.col("len") * F.col("n")).over(Window.partitionBy()))
    made = x.agg(*(F.max(F.when(F.col("cum") * 100 >= F.col("total") * p, F.struct("len", "cum", "cum_n", "n"))).alias(f"p{p}") for p in percents), F.max("total").alias("total"))
    before = lambda p: F.col(f"p{p}.cum") - F.col(f"p{p}.len") * F.col(f"p{p}.n")
    need = lambda p: F.col(f"p{p}.cum_n") - F.col(f"p{p}.n") + F.ceil((F.col("total") * p / 100 - before(p)) / F.col(f"p{p}.len"))
    rows = F.array(*(F.struct(F.lit(p).cast("long").alias("percent"), F.col(f"p{p}.len").alias("n_len"), need(p).cast("long").alias("l_count")) for p in percents))
    return made.select(F.explode(rows).alias("r")).select("r.*")


def base_composition(contigs: DataFrame) -> DataFrame:
    """How often each base is there, and other letters (n), with percentages of all."""
    n = {b: F.sum(count_of(F.col("seq"), b)) for b in "ACGT"}
    total = F.sum(F.length("seq").cast("long"))
    sums = contigs.agg(*(c.alias(b) for b, c in n.items()), total.alias("total"))
    rows = F.array(*(F.struct(F.lit(b).alias("base"), F.col(b).alias("n")) for b in "ACGT"), F.struct(F.lit("N").alias("base"), (F.col("total") - F.col("A") - F.col("C") - F.col("G") - F.col("T")).alias("n")))
    return sums.select("total", F.explode(rows).alias("r")).select("r.base", "r.n", F.try_divide(100 * F.col("r.n"), F.col("total")).alias("percent"))


def split_at_gaps(contigs: DataFrame, least: int, name: str = "name") -> DataFrame:
    """Contigs cut at runs of `least` or more N, the parts numbered from 0; empty parts go."""
    parts = contigs.select(name, F.posexplode(F.split("seq", f"N{{{least},}}")).alias("part", "seq"))
    return parts.where(F.length("seq") > 0).select(name, F.col("part").cast("long").alias("part"), "seq")


def gc_windows(fasta: DataFrame, size: int) -> DataFrame:
    """Full windows of a size by their number of G and C."""
    starts = F.sequence(F.lit(0), F.floor(F.length("seq") / size).cast("int") - 1)
    windows = fasta.where(F.length("seq") >= size).select("seq", F.explode(starts).alias("k")).select(F.substring(F.col("seq"), F.col("k") * size + 1, F.lit(size)).alias("w"))
    return windows.groupBy(count_of(F.col("w"), "GC").alias("gc")).agg(F.count("*").alias("n"))


def clip_point(fastq: DataFrame, share: float = 0.9) -> DataFrame:
    """The position before the first one by which more than `share` of all records have had their second N; -1 if there is none."""
    seq = clean_base(F.col("seq"))
    second = F.expr("locate('N', s, locate('N', s) + 1)")
    x = fastq.select(seq.alias("s")).select(F.when(F.locate("N", F.col("s")) > 0, second).otherwise(0).alias("p"))
    counts = x.groupBy("p").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    run = running(counts.where("p > 0"), [], "p", ["p"], F.col("n"), "cum", "sum")
    hit = run.join(F.broadcast(total)).where(F.col("cum") > share * F.col("total"))
    return hit.agg(F.coalesce(F.min("p") - 1, F.lit(-1)).cast("long").alias("clip"))


def chunk_by_bases(fastq: DataFrame, size: int, pair: str | None = None) -> DataFrame:
    """A chunk number for consecutive records (rec_no): a new chunk begins where a record would take it beyond `size` bases. With `pair`, a column whose equal values are
    mates, these are taken together, where the first of them stands."""
    sized = fastq.withColumn("len", F.length("seq"))
    if pair is None:
        return sized.join(filled_chunks(sized, "rec_no", "len", size).withColumnRenamed("place", "rec_no"), "rec_no")
    pairs = sized.groupBy(pair).agg(F.min("rec_no").alias("_first"), F.sum("len").alias("_len"))
    return sized.join(pairs.join(filled_chunks(pairs, "_first", "_len", size).withColumnRenamed("place", "_first"), "_first").select(pair, "chunk"), pair)


def reverse_complement(seq: Column) -> Column:
    """Also of ambiguity codes."""
    return F.reverse(F.translate(seq, "ACGTRYKMBVDHacgtrykmbvdh", "TGCAYRMKVBHDtgcayrmkvbhd"))


# Ambiguity codes of pairs of bases.
PAIR_CODES = {"AC": "M", "AG": "R", "AT": "W", "CG": "S", "CT": "Y", "GT": "K"}


def pair_code(a: Column, b: Column) -> Column:
    """The ambiguity code of two bases, the base itself if they are equal, N if one isn't a base."""
    x, y = F.upper(a), F.upper(b)
    codes = F.create_map(*(F.lit(v) for kv in PAIR_CODES.items() for v in kv))
    return F.when(~(x.isin(*"ACGT") & y.isin(*"ACGT")), "N").when(x == y, x).otherwise(codes[F.concat(F.least(x, y), F.greatest(x, y))])


def gc_percent(seq: Column) -> Column:
    """The percentage of G and C among the letters; null for an empty sequence."""
    return F.try_divide(100.0 * count_of(F.upper(seq), "GC"), F.length(seq))


def quality_by_cycle(reads: DataFrame) -> DataFrame:
    """A5: bases of each fragment (1 first, 2 last), cycle (from 1) and quality. Qualities (array quals) of reverse reads are turned, so that cycles are as read."""
    turned = F.when(F.col("flag").bitwiseAND(F.lit(16)) != 0, F.reverse("quals")).otherwise(F.col("quals"))
    fragment = F.when(F.col("flag").bitwiseAND(F.lit(128)) != 0, 2).otherwise(1).cast("long")
    x = reads.select(fragment.alias("fragment"), F.posexplode(turned).alias("cycle", "quality"))
    return x.groupBy("fragment", (F.col("cycle") + 1).cast("long").alias("cycle"), "quality").agg(F.count("*").alias("n"))


def position_quality(q: DataFrame) -> DataFrame:
    """How often each quality is there at each position, the position's mean quality and the mean of all; base_content has the bases."""
    counts = q.groupBy("cycle", "qual").agg(F.count("*").alias("n"))
    mean = F.sum(F.col("qual") * F.col("n")) / F.sum("n")
    by_cycle, in_all = counts.groupBy("cycle").agg(mean.alias("mean_qual")), counts.agg(mean.alias("overall_mean"))
    return counts.join(F.broadcast(by_cycle), "cycle").join(F.broadcast(in_all))


def recalibration_summary(maps: DataFrame) -> DataFrame:
    """Mean quality before and after recalibration of each file and position, weighted by counts (file, pos, old_q, new_q, n)."""
    weighted = lambda c: F.try_divide(F.sum(F.col(c) * F.col("n")), F.sum("n"))
    return maps.groupBy("file", "pos").agg(weighted("old_q").alias("mean_before"), weighted("new_q").alias("mean_after"), F.sum("n").alias("n"))


def quality_map(q: DataFrame) -> DataFrame:
    """Counts and expected errors by cycle and quality."""
    return q.groupBy("cycle", "qual").agg(F.count("*").alias("n")).withColumn("errors", F.col("n") * F.pow(F.lit(10.0), -F.col("qual") / 10))


def merge_quality_maps(maps: list[DataFrame], keys: list[str]) -> DataFrame:
    """Counts and expected errors of several maps added by keys (file, position, quality), and the quality that these give (20 where undefined)."""
    out = maps[0]
    for m in maps[1:]:
        out = out.unionByName(m)
    x = out.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("errors").alias("errors"))
    return x.withColumn("new_qual", F.when((F.col("errors") > 0) & (F.col("n") > 0), F.floor(-10 * F.log10(F.col("errors") / F.col("n")) + 0.5)).otherwise(20).cast("long"))


def trimmed_bases(qual: Column, threshold: int, shortest: int = 35) -> Column:
    """Bases that running-sum trimming takes from the end of a read with an array of qualities: the cut with the largest sum of
    threshold minus quality, summed from the end until it turns negative, leaving `shortest` bases; 0 for shorter reads. Reads of a batch are summed at once."""

    @F.pandas_udf("int")
    def cut(quals: pd.Series) -> pd.Series:
        rows = [np.empty(0) if q is None else q for q in quals]
        length, out = np.fromiter(map(len, rows), "int64", len(rows)), np.zeros(len(rows), "int32")
        steps = np.maximum(length - shortest, 0)
        at = 0
        while at < len(rows):
            most = int(steps[at : at + CELLS].max(initial=0))
            n = max(1, CELLS // max(1, most))
            width = int(steps[at : at + n].max())
            if width:
                flat, ends, k = np.concatenate(rows[at : at + n]), np.cumsum(length[at : at + n])[:, None], np.arange(width)
                inside = k < steps[at : at + n, None]
                sums = np.cumsum(threshold - np.where(inside, flat[np.maximum(ends - 1 - k, 0)], threshold), axis=1)
                sums = np.where(inside & ~np.logical_or.accumulate(~(sums >= 0), axis=1), sums, 0)
                out[at : at + n] = np.where(sums.max(axis=1) > 0, sums.argmax(axis=1) + 1, 0)
            at += n
        return pd.Series(out)

    return F.when(F.size(qual) < shortest, 0).when(qual.isNotNull(), cut(qual))
