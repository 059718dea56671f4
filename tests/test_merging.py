"""Merged call sets: alleles, genotypes, arrays by allele and genotype, absent samples, trimming and faults."""

import pytest
from pyspark.sql import functions as F

from strandframe.operators import merging

RECORDS = "rec long, src long, chrom string, pos long, id string, ref string, alts array<string>, qual double, filter array<string>, info map<string,string>, n_samples int"
CELLS = "rec long, sample string, gt string, tags map<string,string>"
NUMBERS = {"PL": "G", "AD": "R", "AF": "A"}


def merged(spark, records, cells, samples, **options):
    found = merging.merge_calls(spark.createDataFrame(records, RECORDS), spark.createDataFrame(cells, CELLS), samples, NUMBERS, **options)
    return {(r.chrom, r.pos): r for r in found.collect()}


def test_three_alleles(spark):
    records = [
        (1, 0, "1", 5, None, "A", ["C"], 10.0, ["PASS"], {"DP": "3", "DP4": "1,2,3,4", "X": "a"}, 1),
        (2, 1, "1", 5, "rs1", "AT", ["GT", "CT"], 40.0, ["q10"], {"DP": "4", "DP4": "1,1,1,1", "X": "b", "Y": "c"}, 3),
        (3, 1, "1", 9, None, "G", ["<DEL>"], None, None, None, 3),
    ]
    cells = [(1, "a", "0|1", {"PL": "1,2,3", "AD": "7,8", "AF": "0.5", "DP": "9"}), (2, "b", "1/2", {"PL": "0,1,2,3,4,5", "AD": "1,2,3", "AF": "x,y"}), (2, "c", "2", {"PL": "5,6,7"}), (3, "b", "./1", {"DP": "2"})]
    found = merged(spark, records, cells, ["c", "a", "b", "d"])
    r = found["1", 5]
    assert (r.ref, r.alts, r.id, r.filter, r.qual) == ("AT", ["CT", "GT"], "rs1", ["q10"], 32.5)
    assert r.format == ["GT", "AD", "AF", "DP", "PL"]
    assert r.samples == ["1:.:.:.:5,7,6", "0|1:7,8,.:0.5,.:9:1,2,3,.,.,.", "2/1:1,3,2:y,x:.:0,3,5,1,4,2", ".:.:.:.:."]
    assert r.info == {"DP": "7", "DP4": "2,3,4,5", "X": "a", "Y": "c", "SF": "0,1f", "AN": "5", "AC": "3,1"}
    r = found["1", 9]
    assert (r.alts, r.filter, r.qual, r.format, r.samples) == (["<DEL>"], None, None, ["GT", "DP"], [".:.", ".:.", "./1:2", ".:."])


def test_trim_and_absent(spark):
    records = [(1, 0, "1", 5, None, "A", ["C", "T"], 1.0, ["PASS"], {}, 1), (2, 1, "1", 5, None, "A", ["G", "C"], 1.0, ["PASS"], {}, 1)]
    cells = [(1, "a", "0/2", {"PL": "0,1,2,3,4,5"}), (2, "b", "0/1", {"PL": "0,1,2,3,4,5"})]
    r = merged(spark, records, cells, ["a", "b", "z"], absent="0/0", trim=True)["1", 5]
    assert (r.alts, r.samples) == (["T", "G"], ["0/1:0,3,5,.,.,.", "0/2:0,.,.,1,.,2", "0/0:."])
    assert (r.info["AN"], r.info["AC"]) == ("6", "1,1")


def test_wrong_number_of_values(spark):
    records = [(1, 0, "1", 5, None, "A", ["C"], 1.0, ["PASS"], {}, 1)]
    with pytest.raises(Exception, match="4 values by genotype for 2 alleles"):
        merged(spark, records, [(1, "a", "0/1", {"PL": "1,2,3,4"})], ["a"])
    r = merged(spark, records, [(1, "a", "0/1", {"PL": "."}), (1, "b", "0/0/1", {})], ["a", "b"])["1", 5]
    assert r.samples == ["0/1:.", "0/0/1:."]


def test_sites_without_samples(spark):
    records = [(1, 0, "1", 5, None, "A", ["C"], 1.0, ["PASS"], {"DP": "1"}, 0), (2, 1, "1", 5, None, "A", ["C"], 3.0, ["PASS"], {"DP": "x"}, 0)]
    r = merged(spark, records, [], [])["1", 5]
    assert (r.samples, r.format, r.qual, r.info["DP"]) == ([], ["GT"], 2.0, "1")


def test_joined_info(spark):
    infos = F.array(*(F.create_map(*map(F.lit, x)) for x in (("A", "1.50", "B", "3"), ("A", "2", "B", "1"), ("A", "n", "B", "2"))))
    got = spark.range(1).select(merging.joined_info(infos, {"A": "sum", "B": "max"}).alias("m")).first().m
    assert got == {"A": "3.5", "B": "3"}
    with pytest.raises(Exception, match="unlike length"):
        spark.range(1).select(merging.joined_info(F.array(F.create_map(F.lit("A"), F.lit("1,2")), F.create_map(F.lit("A"), F.lit("1"))), {"A": "sum_each"})).collect()
