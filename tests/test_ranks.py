"""Rank tests and overlaps against plain versions."""

import itertools
import math
import random

from strandframe.operators import calls, intervals, stats


def u_and_p(a, b):
    u = sum((x > y) + (x == y) / 2 for x in a for y in b)
    na, nb = len(a), len(b)
    least = min(u, na * nb - u)
    if min(na, nb) == 1:
        return u, 2 * (math.floor(least) + 1) / (max(na, nb) + 1)
    if max(na, nb) >= 8:
        z = (least - na * nb / 2) / math.sqrt(na * nb * (na + nb + 1) / 12)
        return u, math.erfc(abs(z) / math.sqrt(2))
    orders = [sum((x > y) for x in s for y in set(range(na + nb)) - set(s)) for s in itertools.combinations(range(na + nb), na)]
    return u, min(1.0, 2 * sum(k <= least for k in orders) / len(orders))


def test_mann_whitney(spark):
    """U and p of groups of all sizes, with ties: single rows, exact, and the normal approximation."""
    rnd = random.Random(5)
    rows, want = [], {}
    for k, (na, nb) in enumerate([(1, 5), (4, 1), (2, 3), (5, 7), (7, 7), (3, 9), (20, 30), (300, 250), (9, 8)]):
        a, b = [rnd.randint(0, 12 + na) for _ in range(na)], [rnd.randint(2, 15 + nb) for _ in range(nb)]
        rows += [(k, float(x), True) for x in a] + [(k, float(x), False) for x in b]
        want[k] = u_and_p(a, b)
    df = spark.createDataFrame(rows, "k int, x double, in_a boolean")
    found = {r.k: r for r in stats.mann_whitney(df, "x", "in_a", ["k"]).collect()}
    for k, (u, p) in want.items():
        assert found[k].u_a == u and abs(found[k].p - p) < 1e-9, (k, u, p, found[k])
    assert stats.mann_whitney(df.where("k = 7"), "x", "in_a").first().u_a == want[7][0]


def test_reads_in_intervals(spark):
    """Reads over several bins and intervals, and repeated rows, are there as often as they were."""
    rnd = random.Random(9)
    iv = [("c", s, s + rnd.randint(0, 900)) for s in rnd.sample(range(1, 40_000), 40)] + [("d", 1, 50_000)]
    reads = [(k, rnd.choice("cde"), rnd.randint(1, 45_000), rnd.choice([1, 50, 3000, 9000])) for k in range(400)]
    reads += reads[:60]
    df = spark.createDataFrame(reads, "id long, chrom string, pos long, seq_len long")
    found = intervals.reads_in_intervals(df, spark.createDataFrame(iv, "chrom string, start_pos long, end_pos long"))
    want = [r for r in reads if any(c == r[1] and s <= r[2] + r[3] - 1 and e >= r[2] for c, s, e in iv)]
    assert sorted(map(tuple, found.collect())) == sorted(want) and found.columns == df.columns


def test_genotype_status(spark):
    """Every status, by shares of the best two."""
    rows = [("tie", "a", 0.9), ("tie", "b", 0.9), ("near", "near", 0.95), ("near", "x", 0.94), ("clear", "clear", 0.95), ("clear", "x", 0.5), ("wrong", "x", 0.95), ("wrong", "wrong", 0.5)]
    rows += [("nobody", "x", 0.95), ("nobody", "y", 0.5), ("unknown", "x", 0.95), ("unknown", "y", 0.94), ("absent", "x", 0.9), ("absent", "y", 0.2), ("single", "x", 0.9)]
    identity = spark.createDataFrame(rows, "sample string, candidate string, share double")
    place = calls.F.row_number().over(calls.Window.partitionBy("sample").orderBy(calls.F.desc("share"), "candidate"))
    expected = spark.createDataFrame([("tie", "b"), ("near", "near"), ("clear", "clear"), ("wrong", "wrong"), ("nobody", None), ("absent", "z"), ("single", "x")], "sample string, expected string")
    found = {r["sample"]: r.status for r in calls.genotype_status(identity.withColumn("place", place), expected, 1.1).collect()}
    assert found == {"tie": "confirmed", "near": "unconfirmed", "clear": "confirmed", "wrong": "wrong", "nobody": "candidate", "unknown": "unknown", "absent": "candidate", "single": "confirmed"}
