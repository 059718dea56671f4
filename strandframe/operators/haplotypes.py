"""Comparison of call sets by the sequences that their variants make."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.shared import written
from .reference import slices
from .variants import cluster_by_distance

GROUP = ["chrom", "grp"]
#: Bases before an insertion or deletion that are first looked at for an equal one further left, and what they grow by where that isn't enough.
NEAR, GROWTH = 64, 16


def upper(c: Column) -> Column:
    """Upper case of a-z only, so that a text keeps its length."""
    return F.translate(c, ascii_lowercase, ascii_uppercase)


def common_suffix(a: Column, b: Column) -> Column:
    """Letters that two texts end with alike: the number's bits are tried from the highest that the shorter one's length may have, as a longer common end has all shorter ones."""
    most = F.least(F.length(a), F.length(b))

    def tried(bits: int) -> Column:
        return F.aggregate(F.array(*(F.lit(1 << k) for k in range(bits - 1, -1, -1))), F.lit(0), lambda n, bit: F.when((n + bit <= most) & (F.right(a, n + bit) == F.right(b, n + bit)), n + bit).otherwise(n))

    return F.when(most == 0, 0).when(most < 1 << 3, tried(3)).when(most < 1 << 7, tried(7)).otherwise(tried(28))


def trimmed(events: DataFrame) -> DataFrame:
    """Events (pos, ref, alt) without the bases that ref and alt share: first behind, then in front."""
    behind = common_suffix(F.col("ref"), F.col("alt"))
    cut = events.withColumn("_n", behind).withColumns({c: F.substring(F.col(c), F.lit(1), F.length(c) - F.col("_n")) for c in ("ref", "alt")})
    front = common_suffix(F.reverse("ref"), F.reverse("alt"))
    return cut.withColumn("_n", front).withColumns({"pos": F.col("pos") + F.col("_n"), **{c: F.substring(F.col(c), F.col("_n") + 1, F.length(c)) for c in ("ref", "alt")}}).drop("_n")


def asked_for(chunks: DataFrame, spans: DataFrame, size: int) -> DataFrame:
    """The chunks up to the last one that any span (end_pos) reaches, so that those beyond aren't shuffled. The bound is one row."""
    last = spans.agg(F.floor((F.max("end_pos") - 1) / size).alias("_last"))
    return chunks.join(F.broadcast(last), F.col("chunk_no") <= F.col("_last")).drop("_last")


def leftmost(events: DataFrame, chunks: DataFrame, size: int, key: str, first: str, near: int) -> DataFrame:
    """Trimmed events moved left as far as the sequence that they make stays the same, but not before the position in column `first`.

    An insertion or deletion of n bases may move by as many places as the bases before it, followed by those bases, end alike. So many bases of the reference
    are looked at as that needs: `near` at first, more only for events that reach the end of them.
    """
    done = events.where("ref <> '' AND alt <> ''")
    todo = events.where("ref = '' OR alt = ''")
    while True:
        span = todo.withColumns({"start_pos": F.greatest(F.col("pos") - near, F.col(first), F.lit(1)), "end_pos": F.col("pos") - 1})
        before = upper(F.coalesce("seq", F.lit("")))
        own = F.concat("ref", "alt")
        step = slices(span, asked_for(chunks, span, size), size, key).withColumn("_left", before).withColumn("_n", common_suffix(F.col("_left"), F.concat("_left", own)))
        step = written(step, "moved")
        more = (F.col("_n") == F.length("_left")) & (F.col("start_pos") > F.greatest(F.col(first), F.lit(1)))
        text = F.substring(F.concat("_left", own), F.length("_left") - F.col("_n") + 1, F.length(own))
        moved = step.where(~more).withColumn("_own", text).withColumns({"pos": F.col("pos") - F.col("_n"), "ref": F.when(F.col("ref") == "", "").otherwise(F.col("_own")), "alt": F.when(F.col("alt") == "", "").otherwise(F.col("_own"))})
        done = done.unionByName(moved.select(*events.columns))
        todo = step.where(more).select(*events.columns)
        if todo.isEmpty():
            return done
        near *= GROWTH


def sequence_match(calls: DataFrame, chunks: DataFrame, size: int, win: int, near: int = NEAR, literal: bool = False) -> DataFrame:
    """Groups (chrom, grp) of variants (src, chrom, pos, ref, alt) within `win` of one another in which two sets or more have an insertion, a deletion or a
    substitution of more than one base: `sets`, the sets that do, and `same`, whether any two of them share a sequence.

    Each variant by itself makes a sequence of the reference from `win` before the group to `win` behind it; two sets agree if any variant of one makes the same sequence as any of
    the other. Substitutions of one base count in such sets, but make no set one. Symbolic and missing alternatives
    make none, nor does one that equals ref, but their positions count for groups. With `literal`, alternatives are texts, also a dot and what begins with <.

    Sequences aren't spelt out: two variants make the same one if and only if they are the same variant once shared bases are cut off and insertions and deletions stand as far left as they
    can within the group's range. So what meets in a join is a group, a position and the bases changed, however far a group reaches.
    """
    events = written(calls.select("src", "chrom", "pos", upper(F.col("ref")).alias("ref"), upper(F.col("alt")).alias("alt")).distinct(), "calls")
    every = written(cluster_by_distance(events, win), "grouped")
    grouped = every.where("ref <> alt" if literal else "alt <> '.' AND NOT startswith(alt, '<') AND ref <> alt")
    unlike = F.size(F.filter(F.zip_with(F.split("ref", ""), F.split("alt", ""), lambda a, b: a != b), lambda x: x))
    big = F.when(F.length("ref") != F.length("alt"), True).otherwise(unlike > 1)
    sets = grouped.withColumn("_big", big).groupBy(*GROUP, "src").agg(F.bool_or("_big").alias("_big"))
    ranges = sets.groupBy(*GROUP).agg(F.array_sort(F.collect_list(F.when(F.col("_big"), F.col("src")))).alias("sets")).where(F.size("sets") > 1)
    ranges = ranges.join(every.groupBy(*GROUP).agg((F.min("pos") - win).alias("_from")), GROUP)
    some = grouped.join(ranges, GROUP).where(F.array_contains("sets", F.col("src")))
    key = F.concat_ws(":", "pos", F.length("ref"), F.length("alt"), "src", F.concat("ref", "alt", "chrom"))
    some = written(some.withColumn("_event", key).select("_event", *GROUP, "src", "pos", "ref", "alt", "_from", "sets"), "events")
    made = leftmost(written(trimmed(some.drop("sets")), "trimmed"), chunks, size, "_event", "_from", near).select(*GROUP, "src", "pos", "ref", "alt").distinct()
    shared = made.groupBy(*GROUP, "pos", "ref", "alt").agg(F.array_sort(F.collect_set("src")).alias("_in")).where(F.size("_in") > 1)
    pairs = F.flatten(F.transform("_in", lambda a, i: F.transform(F.slice("_in", i + 2, F.size("_in")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    met = shared.select(*GROUP, F.explode(pairs).alias("p")).distinct().groupBy(*GROUP).agg(F.count("*").alias("_met"))
    wanted = F.size("sets") * (F.size("sets") - 1) / 2
    ranges = some.select(*GROUP, "sets").distinct()
    return ranges.join(met, GROUP, "left").select(*GROUP, F.array_join(F.col("sets").cast("array<string>"), ",").alias("sets"), (F.coalesce("_met", F.lit(0)) == wanted).alias("same"))


def match_counts(matches: DataFrame) -> DataFrame:
    """Of each combination of sets, the groups in which they agree and in which they don't."""
    return matches.groupBy("sets").agg(F.count_if("same").alias("match"), F.count_if(~F.col("same")).alias("mismatch"))
