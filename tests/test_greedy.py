"""Chunks filled by jump pointers against a plain loop, over many blocks and levels."""

import random

import pytest

from strandframe.plans import greedy


def brute(rows, size):
    out, chunk, held = {}, 0, None
    for place, n in sorted(rows):
        n = n or 0
        if held is not None and n > 0 and held + n > size:
            chunk, held = chunk + 1, 0
        held = (held or 0) + n
        out[place] = chunk
    return out


@pytest.mark.parametrize("case", ["even", "uneven", "giants", "zeros"])
def test_filled_chunks(spark, case):
    rnd = random.Random(case)
    lengths = {"even": lambda: 100, "uneven": lambda: rnd.randint(1, 900), "giants": lambda: rnd.choice([3, 50, 999, 1001, 40_000]), "zeros": lambda: rnd.choice([0, 0, None, 500, 501, 1500])}[case]
    rows = [(3 * i - 50, lengths()) for i in range(3000)]
    records = spark.createDataFrame(rows, "rec_no long, n int").repartition(7)
    assert {r.place: r.chunk for r in greedy.filled_chunks(records, "rec_no", "n", 1000, fan=4).collect()} == brute(rows, 1000)


def test_few_records(spark):
    records = spark.createDataFrame([(5, 10_000)], "rec_no long, n int")
    assert [tuple(r) for r in greedy.filled_chunks(records, "rec_no", "n", 10).collect()] == [(5, 0)]
    assert greedy.filled_chunks(records.limit(0), "rec_no", "n", 10).count() == 0
