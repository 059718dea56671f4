"""Formats of lines: places of faults, brackets, escapes, missing values and chosen samples."""

import pytest
from pyspark.sql import functions as F

from strandframe.functions.line_format import format_line, parse_format

RECORD = "chrom string, pos long, id string, ref string, alts array<string>, qual double, filter array<string>, info map<string,string>, format array<string>, samples array<string>, line string"


@pytest.mark.parametrize(
    ("text", "said"),
    [("%", "% without a name at 0"), ("ab% c", "% without a name at 2"), ("a[%GT", r"\[ at 1 isn't closed"), ("a]b", r"\] at 1 closes nothing"), ("[a[b]]", r"\[ at 2 within the brackets opened at 0"), ("x%*=,", r"%\* at 1 is outside"), ("ab\\", "backslash ends the format at 2"), ("[%*]", "% without a name at 1")],
)
def test_faults(text, said):
    with pytest.raises(ValueError, match=said):
        parse_format(text)


def test_parts():
    assert [(p.name, p.text, p.loop) for p in parse_format("a\\[%POS\\\\[ %*=,]b[%X]")] == [(None, "a[", None), ("POS", "", None), (None, "\\", None), (None, " ", 0), ("*", "=,", 0), (None, "b", None), ("X", "", 1)]


def test_lines(spark):
    rows = [
        ("1", 5, None, "A", ["C", "<DEL>"], 3.5, ["PASS"], {"DP": "7", "DB": ""}, ["GT", "DP"], ["0|2:3", "1"], "whole"),
        ("2", 6, "rs", "G", None, None, [], None, ["DP"], ["4", "."], None),
    ]
    df = spark.createDataFrame(rows, RECORD)
    line = lambda text, **more: [r[0] for r in df.select("chrom", format_line(text, df.columns, ["x", "y"], **more).alias("l")).orderBy("chrom").select("l").collect()]
    assert line("%CHROM %POS %ID %REF %ALT %QUAL %FILTER %INFO/DP %INFO/DB %INFO/NO %NO") == ["1 5 . A C,<DEL> 3.5 PASS 7 1 . .", "2 6 rs G . . . . . . ."]
    assert line("[%SAMPLE:%GT:%GTR:%DP;]%LINE") == ["x:A|<DEL>:0|2:3;y:C:1:.;whole", "x:.:.:4;y:.:.:.;."]
    assert line("[%*=,\\t][%SAMPLE]", wanted=["y"]) == ["GT=1\ty", "DP=.\ty"]
    assert line("[%SAMPLE]", wanted=["y", "x"]) == ["yx", "yx"] and line("a[%SAMPLE]", wanted=[]) == ["a", "a"] and line("") == ["", ""]
    with pytest.raises(ValueError, match="no sample z"):
        format_line("%POS", df.columns, ["x"], ["z"])
    plan = df.select(format_line("[%GT]", df.columns, ["x", "y"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan


def test_genotypes_of_a_text_with_spaces(spark):
    assert spark.range(1).select(format_line("a b", [], []).alias("l"), F.lit(1)).first().l == "a b"
