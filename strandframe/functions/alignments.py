"""Column expressions over alignment fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of flag bits, fixed by the alignment format.
FLAG_NAMES = {1: "paired", 2: "proper", 4: "unmapped", 8: "mate_unmapped", 16: "reverse", 32: "mate_reverse", 64: "first", 128: "second", 256: "secondary", 512: "failed", 1024: "duplicate"}


def explain_flags(flag: Column) -> Column:
    """The names of a flag's bits, in order, joined with ','."""
    return F.array_join(F.array_compact(F.array(*(F.when(flag.bitwiseAND(F.lit(bit)) != 0, name) for bit, name in FLAG_NAMES.items()))), ",")


def compose_flag(**bits: Column) -> Column:
    """A flag of conditions by the names of bits, null counting as no. What needs a pair goes without one (proper, mate_unmapped, mate_reverse, first,
    second); so do proper if either mate is unmapped, and mate_reverse if the mate is."""
    is_set = lambda name: F.coalesce(bits[name], F.lit(False)) if name in bits else F.lit(False)
    paired = is_set("paired")
    rules = {name: is_set(name) for name in FLAG_NAMES.values()} | {name: is_set(name) & paired for name in ("mate_unmapped", "mate_reverse", "first", "second")}
    rules["proper"] = is_set("proper") & paired & ~is_set("unmapped") & ~is_set("mate_unmapped")
    rules["mate_reverse"] = rules["mate_reverse"] & ~is_set("mate_unmapped")
    flag = F.lit(0)
    for bit, name in FLAG_NAMES.items():
        flag = flag + F.when(rules[name], bit).otherwise(0)
    return flag.cast("long")


def cigar_span(cigar: Column, operations: str) -> Column:
    """The sum of lengths of a CIGAR's given operations."""
    lengths = F.regexp_extract_all(cigar, F.lit(f"([0-9]+)[{operations}]"), F.lit(1))
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
