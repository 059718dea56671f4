"""What workers remember is bounded by bytes: long pieces of text aren't kept. Every language has a dictionary."""

import public_tokenizers
from pyspark.sql import functions as F

from strandframe.llm import bpe, language_id, packing, quality


def test_long_pieces_are_not_kept():
    long = ["日" * 20_000 + str(k) for k in range(30)]
    codec = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))
    encode, features = packing.TextEncoder(public_tokenizers.path("word_bpe_49k.json")), quality.Features(1 << 16)
    for text in (*long, "some short words", "x" * 10_000):
        assert codec.decode(codec.encode(text)) == text
        assert encode(text) and len(features(text))
    for memory in (codec.known, codec.spelt, encode, features):
        assert memory and max(map(len, memory)) <= 64


def test_many_distinct_long_pieces_in_bounded_memory():
    import tracemalloc

    features = quality.Features(1 << 16)
    tracemalloc.start()
    for k in range(20_000):
        features(f"{k:05d}" * 2_000)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 5_000_000


def test_more_than_256_languages(spark):
    rows = spark.range(600).select(F.concat(F.lit("l"), F.col("id") % 300).alias("lang"), F.concat_ws(" ", F.lit("word"), F.md5(F.col("id").cast("string"))).alias("text"))
    assert len(language_id.train_dictionaries(rows)) == 300
    assert len(language_id.train_dictionaries(rows, max_languages=7)) == 7
