"""Formatted lines of records (P1): a format's text becomes one column expression."""

from __future__ import annotations

import re
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators.calls import genotype_bases

# Names of a record's own fields.
FIELDS = {"CHROM": "chrom", "POS": "pos", "ID": "id", "REF": "ref", "ALT": "alts", "QUAL": "qual", "FILTER": "filter", "LINE": "line"}
# What stands between the parts of a field that holds several.
JOINED = {"ALT": ",", "FILTER": ";"}
TOKEN = re.compile(r"\\(?P<escape>.)|%\*(?P<marks>.{2})|%(?P<name>[A-Za-z0-9/_]+)|(?P<mark>[\[\]%])|(?P<text>[^\\%\[\]]+)", re.DOTALL)
ESCAPES = {"n": "\n", "t": "\t"}


class Part(NamedTuple):
    """A piece of a format: text as it is, a field by name, or all tags of a sample (name *, text the two marks between them); `loop` is the number of the bracket it is in."""

    name: str | None
    text: str
    loop: int | None
    at: int


def parse_format(text: str) -> list[Part]:
    """The parts of a format; a ValueError tells what is wrong and at which place."""
    out, at, loop, loops, opened = [], 0, None, 0, 0
    while at < len(text):
        found = TOKEN.match(text, at)
        if not found:
            raise ValueError(f"a backslash ends the format at {at}")
        kind = found.lastgroup
        if kind == "mark":
            mark = found["mark"]
            if mark == "%":
                raise ValueError(f"% without a name at {at}")
            if (mark == "[") == (loop is not None):
                raise ValueError(f"{mark} at {at} " + ("within the brackets opened at " + str(opened) if mark == "[" else "closes nothing"))
            if mark == "[":
                loop, loops, opened = loops, loops + 1, at
            else:
                loop = None
        elif kind in ("escape", "text"):
            piece = ESCAPES.get(found["escape"], found["escape"]) if kind == "escape" else found["text"]
            if out and out[-1].name is None and out[-1].loop == loop:
                out[-1] = out[-1]._replace(text=out[-1].text + piece)
            else:
                out.append(Part(None, piece, loop, at))
        else:
            name = found["name"] if kind == "name" else "*"
            if loop is None and name == "*":
                raise ValueError(f"%* at {at} is outside brackets")
            out.append(Part(name, found["marks"] or "", loop, at))
        at = found.end()
    if loop is not None:
        raise ValueError(f"[ at {opened} isn't closed")
    return out


def _dot(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("."))


def _field(name: str, columns: list[str]) -> Column:
    """A field outside brackets; a dot for what the record or the table lacks. A tag of INFO without a value reads 1."""
    if name.startswith("INFO/"):
        value = F.try_element_at("info", F.lit(name[5:]))
        return _dot(F.when(value == "", "1").otherwise(value))
    column = FIELDS.get(name, name)
    if column not in columns:
        return F.lit(".")
    if name in JOINED:
        return F.when(F.size(column) > 0, F.array_join(column, JOINED[name])).otherwise(".")
    return _dot(F.col(column))


def _sample_field(part: Part, name: Column, values: Column) -> Column:
    """A field of one sample, whose values stand in the order of the column format."""
    if part.name == "SAMPLE":
        return name
    if part.name == "*":
        some = F.slice("format", F.lit(1), F.least(F.size("format"), F.size(values)))
        pairs = F.transform(some, lambda tag, i: F.concat(tag, F.lit(part.text[0]), F.get(values, i)))
        return F.when(F.size(pairs) > 0, F.array_join(pairs, part.text[1])).otherwise(".")
    place = F.array_position("format", F.lit("GT" if part.name == "GTR" else part.name))
    value = F.when(place > 0, F.get(values, (place - 1).cast("int")))
    return _dot(genotype_bases(value, F.col("ref"), F.coalesce("alts", F.array().cast("array<string>"))) if part.name == "GT" else value)


def format_line(text: str, columns: list[str], samples: list[str], wanted: list[str] | None = None) -> Column:
    """The line that a format makes of a record with chrom, pos, id, ref, alts (array), qual, filter (array), info (map), format (array) and samples (array of
    texts with : between values, one for each of `samples`); `columns` are those that the table has.

    `%CHROM`, `%POS`, `%ID`, `%REF`, `%ALT`, `%QUAL`, `%FILTER`, `%LINE` (column line) and any other column stand for themselves, `%INFO/TAG` for a tag. What is in brackets is repeated
    for each of the `wanted` samples, in that order (all by default): `%SAMPLE` is its name, `%GT` its genotype in bases, `%GTR` as it is, `%TAG` any other tag, and `%*=,` all
    tags with = behind the name and , between them. A dot stands for what is missing. `\\n`, `\\t` and any other character behind a backslash stand for
    themselves. It is one expression: nothing is exploded or gathered.
    """
    parts = parse_format(text)
    unknown = [s for s in wanted or [] if s not in samples]
    if unknown:
        raise ValueError(f"no sample {unknown[0]}")
    chosen = F.array(*(F.struct(F.lit(s).alias("name"), F.lit(samples.index(s)).alias("place")) for s in (samples if wanted is None else wanted))) if samples and wanted != [] else None

    def repeated(some: list[Part]) -> Column:
        def one(s: Column) -> Column:
            values = F.split(F.coalesce(F.get("samples", s["place"]), F.lit(".")), ":")
            return F.concat(*(F.lit(p.text) if p.name is None else _sample_field(p, s["name"], values) for p in some))

        return F.array_join(F.transform(chosen, one), "")

    out = []
    for loop, some in groupby(parts, key=lambda p: p.loop):
        if loop is None:
            out += [F.lit(p.text) if p.name is None else _field(p.name, columns) for p in some]
        elif chosen is not None:
            out.append(repeated(list(some)))
    return F.concat(*out) if out else F.lit("")
