"""The pipeline's stages against plain versions over the same rows."""

import os
from collections import Counter

import pytest

import corpus_pipeline
from strandframe.llm import language_id, quality, simhash
from strandframe.llm.common import load, write_table

SF = "/root/testdata/sf0.001"


def linked(a, b):
    """Whether two wide fingerprints are near and share a posted pair of bytes."""
    same = (a ^ b).view("u1") == 0
    bits = sum(int(x).bit_count() for x in a ^ b)
    return bits <= simhash.WIDE_BITS and same.sum() >= simhash.WIDE_SHARED and any(same[k] and same[k + 1] for k in simhash.WIDE_PAIRS)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_stages(spark):
    docs = load(spark, SF, "documents")
    names, stages = zip(*corpus_pipeline.STAGES, strict=True)
    good = write_table(stages[0](spark, docs, SF), "t")
    selected = quality.select_target(docs, load(spark, SF, "labels")).where("selected")
    assert good.columns == docs.columns and Counter(r.doc_id for r in good.collect()) == Counter(r.doc_id for r in selected.collect())
    known = write_table(stages[1](spark, good, SF), "t")
    classify = language_id.Classifier(language_id.train_dictionaries(good))
    assert {r.doc_id for r in known.collect()} == {r.doc_id for r in good.collect() if not classify(r.text)[2]}
    one = write_table(stages[2](spark, known, SF), "t")
    prints = {r.doc_id: simhash.wide_fingerprint(r.text) for r in known.collect()}
    left, kept = set(prints), set()
    while left:
        group, queue = set(), [min(left)]
        while queue:
            i = queue.pop()
            near = {j for j in left if linked(prints[i], prints[j])}
            left -= near
            group |= near | {i}
            queue += near
        kept.add(min(group))
    assert {r.doc_id for r in one.collect()} == kept and one.columns == docs.columns
    pieces = stages[3](spark, one, SF)
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == kept
    assert corpus_pipeline.run(spark, SF).count() == pieces.count()
