"""Buckets of the language model follow the bytes of text, not the partitions that a session happens to read it in."""

import random

from strandframe.llm import language_model


def test_buckets_stay_small():
    for partitions in (1, 47, 375):
        for n in (0, 10**8, 10**10, 10**11):
            buckets = language_model.buckets_for(n, partitions)
            assert buckets >= max(24, partitions) and n <= buckets * language_model.BUCKET_BYTES
    assert language_model.block_tokens(24) == 500_000 and language_model.block_tokens(10**6) == 2_000_000


def test_score_deals_by_bytes(spark, monkeypatch):
    """One partition with much text gets many buckets, and the scores of few."""
    rnd = random.Random(4)
    words = [f"w{i}" for i in range(800)]
    rows = [(i, " ".join(rnd.choices(words, k=100))) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    merged, write = [], language_model.write_table

    def written(df, name):
        out = write(df, name)
        merged.extend([out.count()] if name == "merged" else [])
        return out

    monkeypatch.setattr(language_model, "write_table", written)
    few = {r.doc_id: r for r in language_model.score(docs).collect()}
    monkeypatch.setattr(language_model, "BUCKET_BYTES", 1000)
    many = {r.doc_id: r for r in language_model.score(docs).collect()}
    assert merged[0] <= 48 and merged[1] > 60
    assert few.keys() == many.keys()
    for i, r in few.items():
        assert abs(r.score - many[i].score) < 1e-4 and abs(r.base_score - many[i].base_score) < 1e-9 and r[1:5] == many[i][1:5]
