"""Exact duplicates against plain Python, with hashes that collide, nulls, ties, repeats, hot groups and clashing names."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from strandframe.llm import exact_dedup

DOCS = "doc_id long, text string, Keep_Id string, hash long, content string, best string, size int"
TEXTS = [None, "", " \n", "a b", "ab", "a\tb ", "a b", "\x1c", "A b", "é x", "éx", "éx", "😀 😀", "😀😀", "word " * 50_000, "word" * 50_000]


def table(n_hot=400):
    rows = [(i, t, "c", 1, "x", "y", 2) for i, t in enumerate(TEXTS * 2)]
    rows += [(1000 + i, "hot text " + " " * (i % 3), None, None, None, None, None) for i in range(n_hot)]
    rows += [(-5, "a b", None, None, None, None, None), (None, "a  b", None, None, None, None, None), (None, "nobody has this", None, None, None, None, None), (3, "a b", None, None, None, None, None)]
    return rows + [(5000 + i, f"one of a kind {i}", None, None, None, None, None) for i in range(700)]


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        text = text or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text), []).append((-len(text), doc_id is None, doc_id))
    out = []
    for doc_id, text, *_ in rows:
        content = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[content], key=lambda x: (x[0], x[1], x[2] or 0))
        out.append((doc_id, best[2], len(groups[content]), (-len(text or ""), doc_id is None, doc_id) == best, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digits", [32, 2, 0])
def test_mark_duplicates(spark, digits):
    """With two digits most hashes stand for several texts, with none all of them do."""
    rows = table()
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    weak = {"content_hash": lambda c: F.substring(F.md5(c), 1, digits)} if digits < 32 else {}
    found = exact_dedup.mark_duplicates(docs, **weak)
    assert found.columns == ["doc_id", "text", "hash", "content", "best", "size", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in found.collect()), key=repr) == brute(rows)


def test_extreme_ids(spark):
    ids = [2**63 - 1, -(2**63), 0, -1, 1, None]
    docs = spark.createDataFrame([(i, "same") for i in ids] + [(i, "other ") for i in ids if i != -(2**63)], "doc_id long, text string")
    found = {(r.text, r.doc_id): (r.keep_id, r.kept) for r in exact_dedup.mark_duplicates(docs).collect()}
    assert {k for k, v in found.items() if v[1]} == {("same", -(2**63)), ("other ", -1)}
    assert {v[0] for k, v in found.items() if k[0] == "same"} == {-(2**63)}


def test_keep_one_each(spark):
    docs = spark.createDataFrame([(1, "a b", 1, "x"), (2, "a  b", 2, "y"), (3, "a c", 3, "z")], "`my id` long, `te.xt` string, kept int, size string")
    found = exact_dedup.keep_one_each(docs, "my id", "te.xt")
    assert found.columns == docs.columns
    assert sorted(found.collect()) == [(2, "a  b", 2, "y"), (3, "a c", 3, "z")]
    assert exact_dedup.keep_one_each(docs.limit(0), "my id", "te.xt").count() == 0


def test_native(spark):
    docs = spark.createDataFrame(table(), DOCS)
    plan = exact_dedup.mark_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
