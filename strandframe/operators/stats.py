"""Statistics of histograms and ranks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def histogram_stats(hist: DataFrame, keys: list[str], bin_col: str = "bin", freq: str = "freq") -> DataFrame:
    """A4: total, mean, population sd, median (first bin whose cumulative count reaches half the total, halves to even) and quartiles of
    each key's histogram. A histogram has one row per bin, so its window is small."""
    by = Window.partitionBy(*keys)
    run = by.orderBy(bin_col).rowsBetween(Window.unboundedPreceding, 0)
    x = hist.withColumns({"cum": F.sum(freq).over(run), "total": F.sum(freq).over(by)})
    b, f, t = F.col(bin_col), F.col(freq), F.col("total")
    first = lambda reach: F.min(F.when(F.col("cum") >= reach, b))
    mean = F.sum(b * f) / F.sum(f)
    return x.groupBy(*keys).agg(
        F.max("total").alias("total"),
        mean.alias("mean"),
        F.sqrt(F.greatest(F.lit(0.0), F.sum(b * b * f) / F.sum(f) - mean * mean)).alias("sd"),
        first(F.bround(t / 2)).alias("median"),
        first(t * 0.25).alias("q1"),
        first(t * 0.75).alias("q3"),
    )


def running_by_value(counts: DataFrame, keys: list[str], value: str, n: str | list[str], name: str | list[str], pieces: int = 200) -> DataFrame:
    """Adds `name`: the sum of n over the smaller values of equal keys (null for the smallest); both may be lists. Values are dealt to ranges between quantiles, so
    that no task runs over all of them; the ranges' sums, few, run along the keys."""
    ns, names = [n] if isinstance(n, str) else n, [name] if isinstance(name, str) else name
    cuts = counts.where(F.col(value).isNotNull()).agg(F.percentile_approx(F.col(value).cast("double"), [k / pieces for k in range(1, pieces)], 10_000).alias("_cuts"))
    x = counts.join(F.broadcast(cuts)).withColumn("_range", F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col(value).cast("double"))), F.lit(0))).drop("_cuts")
    sums = x.groupBy(*keys, "_range").agg(*(F.sum(c).alias(f"_sum{i}") for i, c in enumerate(ns)))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "_range", *(F.sum(f"_sum{i}").over(before).alias(f"_before{i}") for i in range(len(ns))))
    inside = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    joined = x.withColumns({f"_inside{i}": F.sum(c).over(inside) for i, c in enumerate(ns)}).join(F.broadcast(sums) if not keys else sums, [*keys, "_range"])
    both = lambda i: F.coalesce(F.col(f"_before{i}") + F.col(f"_inside{i}"), F.col(f"_before{i}"), F.col(f"_inside{i}"))
    return joined.withColumns({c: both(i) for i, c in enumerate(names)}).drop("_range", *(f"{c}{i}" for c in ("_inside", "_before") for i in range(len(ns))))


def rank_average(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Ranks with ties averaged. Values are counted first, and the running sum is over ranges of distinct values."""
    keys = keys or []
    counts = running_by_value(df.groupBy(*keys, value).agg(F.count("*").alias("n_tied")), keys, value, "n_tied", "_less")
    ranks = counts.withColumn("rank_avg", F.coalesce("_less", F.lit(0)) + (F.col("n_tied") + 1) / 2)
    return df.join(ranks.drop("n_tied", "_less"), [*keys, value])


#: Rows of either side from which the normal approximation is used, and up to which the exact distribution may be tabulated.
NORMAL_FROM = 8


def _exact_p(na: int, nb: int, u: float) -> float:
    """Twice the probability of a U of at most u, counting orders of the two sides by the recurrence on their sizes."""
    ways = {(0, k): [1] for k in range(nb + 1)} | {(k, 0): [1] for k in range(na + 1)}
    for i in range(1, na + 1):
        for j in range(1, nb + 1):
            top = [0] * (i * j + 1)
            for shift, part in ((j, ways[i - 1, j]), (0, ways[i, j - 1])):
                for k, n in enumerate(part):
                    top[k + shift] += n
            ways[i, j] = top
    all_ways = ways[na, nb]
    return min(1.0, 2 * sum(n for k, n in enumerate(all_ways) if k <= u) / sum(all_ways))


def mann_whitney(df: DataFrame, value: str, in_a: str, keys: list[str] | None = None) -> DataFrame:
    """Sizes and U of rows where in_a holds and of the others, and the two-sided p: from the rank of the smaller U if a side has one row, by the normal
    approximation (z) if one has NORMAL_FROM or more, else exact, from a table of all sizes below that."""
    u = _u(df, value, in_a, keys or [])
    least, na, nb = F.least("u_a", "u_b"), F.col("n_a"), F.col("n_b")
    z = (least - na * nb / 2) / F.sqrt(na * nb * (na + nb + 1) / 12)
    single = 2.0 * (F.floor(least) + 1) / (F.greatest(na, nb) + 1)
    small = range(2, NORMAL_FROM)
    table = F.create_map(*(F.lit(x) for a in small for b in small for k in range(2 * a * b + 1) if k <= a * b for x in (f"{a},{b},{k}", _exact_p(a, b, k / 2))))
    exact = table[F.concat_ws(",", na, nb, F.floor(2 * least).cast("long"))]
    p = F.when(F.least(na, nb) == 1, single).when(F.greatest(na, nb) >= NORMAL_FROM, normal_p(z)).otherwise(exact)
    return u.withColumns({"z": F.when(F.least(na, nb) >= 1, z), "p": F.when(F.least(na, nb) >= 1, p)})


def normal_p(z: Column) -> Column:
    """The two-sided probability of a standard normal number: the error function by its series, to 12 places and more (0 beyond 6 deviations, less than that)."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    terms = F.aggregate(F.sequence(F.lit(1), F.lit(90)), F.struct(x.alias("term"), x.alias("sum")), lambda a, k: F.struct((a["term"] * 2 * x * x / (2 * k + 1)).alias("term"), (a["sum"] + a["term"] * 2 * x * x / (2 * k + 1)).alias("sum")))
    return F.when(F.abs(z) > 6, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), 1 - 2 / F.sqrt(F.lit(math.pi)) * F.exp(-x * x) * terms["sum"]))


def _u(df: DataFrame, value: str, in_a: str, keys: list[str]) -> DataFrame:
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.count_if(F.col(in_a)).alias("a"))
    before = running_by_value(counts, keys, value, "n", "before")
    rank = F.coalesce("before", F.lit(0)) + (F.col("n") + 1) / 2
    sums = [F.sum("a").alias("n_a"), F.sum(F.col("n") - F.col("a")).alias("n_b"), F.sum(rank * F.col("a")).alias("ra")]
    s = before.groupBy(*keys).agg(*sums) if keys else before.agg(*sums)
    u = F.col("ra") - F.col("n_a") * (F.col("n_a") + 1) / 2
    return s.select(*keys, "n_a", "n_b", u.alias("u_a"), (F.col("n_a") * F.col("n_b") - u).alias("u_b"))


def peak_window(hist: DataFrame, within: float, reach: float = 0.8, bin_col: str = "bin", freq: str = "freq") -> DataFrame:
    """The modal bin (first maximum), the share of counts within `within` of it, both sides, and the smallest distance from it, as a share of it, within
    which `reach` of all counts lie. Distances are counted first, so the running sum is over a histogram."""
    mode = hist.agg(F.max(F.struct(F.col(freq), -F.col(bin_col))).alias("m"), F.sum(freq).alias("total")).select((-F.col("m.col2")).alias("mode"), "total")
    near = hist.join(F.broadcast(mode)).withColumn("off", F.abs(F.col(bin_col) - F.col("mode")))
    hit = (F.col(bin_col) >= F.col("mode") * (1 - within)) & (F.col(bin_col) <= F.col("mode") * (1 + within))
    share = near.groupBy("mode", "total").agg((F.sum(F.when(hit, F.col(freq)).otherwise(0)) / F.sum(freq)).alias("share"))
    by_off = near.groupBy("off", "total").agg(F.sum(freq).alias("n"))
    run = by_off.withColumn("cum", F.sum("n").over(Window.orderBy("off").rowsBetween(Window.unboundedPreceding, 0)))
    half = run.where(F.col("cum") >= reach * F.col("total")).agg(F.min("off").alias("off"))
    return share.join(F.broadcast(half)).select("mode", "total", "share", F.try_divide(F.col("off"), F.col("mode")).alias("half_width"))


def chromosome_deviation(counts: DataFrame) -> DataFrame:
    """Root mean square of (n - max) / max over chromosomes with counts (chrom, n); only those that end in a number."""
    numbered = counts.where(F.col("chrom").rlike("[0-9]$"))
    top = numbered.agg(F.max("n").alias("top"))
    return numbered.join(F.broadcast(top)).agg(F.sqrt(F.avg(((F.col("n") - F.col("top")) / F.col("top")) ** 2)).alias("deviation"))
