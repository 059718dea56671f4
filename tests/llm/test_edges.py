"""Clashing column names, odd letters, ties, repeats and empty tables."""

import unicodedata
from itertools import product

import pytest
from pyspark.sql import functions as F

from strandframe.llm import bpe, common, language_id, media, packing, quality, sharding, url_filter
from strandframe.llm.queries import SHARDS, URL_RULES

#: Names that operators use within.
INNER = (
    "u_url u_host u_path u_best e_host e_paths e_path e_digest r_rule r_action r_key t_slot t_shard slot_of_row shard_of_row target_id target_part sample_part h n lang "
    "column_0_of_input bucket target raw is_target part before ids n_tokens vec dim node wide root key own other chunks side a.b"
).split()


def with_inner(df):
    return df.withColumns({f"`{x}`" if "." in x else x: F.lit("mine") for x in INNER if "." not in x}).withColumn("a.b", F.lit("mine"))


def test_shielded(spark):
    df = with_inner(spark.createDataFrame([(1, "t", 2)], "doc_id long, text string, column_2_of_input int"))
    plain, names = common.shielded(df, "doc_id", "text")
    assert plain.columns[:2] == ["doc_id", "text"] and not set(plain.columns) & set(INNER) - {"column_0_of_input"}
    assert common.unshielded(plain, names, df.columns).collect() == df.collect()


def test_url_filter(spark):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    long = "https://a.example.com/en/7" + "x" * 300_000
    rows = [(1, "http://example.com/en/x"), (2, None), (3, ""), (4, long), (4, long), (5, "no scheme")]
    found = url_filter.judge_urls(with_inner(spark.createDataFrame(rows, "page_id long, url string")), rules)
    assert sorted((r.page_id, r.rule, r.verdict) for r in found.collect()) == sorted(
        [(1, "com/en/", "block"), (2, None, "allow"), (3, None, "allow"), (4, "example.com/en/7", "allow"), (4, "example.com/en/7", "allow"), (5, None, "allow")], key=str
    )
    assert {v for r in found.collect() for c, v in r.asDict().items() if c in INNER} == {"mine"}
    named_so = spark.createDataFrame([("http://Example.com/en/", 1)], "host string, verdict int")
    assert url_filter.judge_urls(named_so, rules, "host").collect()[0].asDict() == {"host": "example.com", "verdict": "block", "path": "/en/", "rule": "com/en/"}
    assert url_filter.judge_urls(named_so.limit(0), rules, "host").count() == 0


def test_sharding(spark):
    df = with_inner(spark.createDataFrame([(1, "a"), (1, "a"), (None, "b")], "doc_id long, shard string"))
    found = sharding.place(df, "doc_id", SHARDS)
    assert found.count() == 3 and {v for r in found.collect() for c, v in r.asDict().items() if c in INNER} == {"mine"}
    by_shard = {r.shard for r in sharding.place(df, "shard", SHARDS).collect()}
    assert by_shard == {r.shard for r in sharding.place(df.select(F.col("shard").alias("x")), "x", SHARDS).collect()} and len(by_shard) == 2
    assert sharding.place(df.limit(0), "doc_id", SHARDS).count() == 0


def quality_tables(spark):
    good = [(i, f"the good plain text {i % 7} of words", i % 3) for i in range(60)]
    bad = [(100 + i, "x9 $$ zz " * (i % 5 + 1), 0) for i in range(60)]
    odd = [(None, "the good plain", 0), (500, None, 0), (501, "", 1), (7, "the good plain text 0 of words", 1), (7, "the good plain text 0 of words", 1)]
    docs = spark.createDataFrame(good + bad + odd, "doc_id long, text string, selected int")
    labels = spark.createDataFrame([(i, 1 if i < 60 else 0) for i in [*range(60), *range(100, 160)]], "doc_id long, quality int")
    return docs, labels


def test_quality_against_brute_force(spark):
    """Ratios, weights, the Gumbel keys' ranks and the selection by plain Python, from the counts on."""
    docs, labels = quality_tables(spark)
    found = quality.select_target(docs.drop("selected"), labels).collect()
    part = {r.doc_id: r.target_part for r in quality.mark_target(docs, labels).collect()}
    features = quality.Features(quality.BUCKETS)
    target, raw = [1.0] * quality.BUCKETS, [1.0] * quality.BUCKETS
    for r in docs.collect():
        for b in features(r.text).tolist():
            raw[b] += 1
            target[b] += part[r.doc_id] == 1
    sums = sum(target), sum(raw)
    import math

    weight = lambda text: sum(math.log10(target[b] / sums[0]) - math.log10(raw[b] / sums[1]) for b in features(text).tolist())
    weights = {(r.doc_id, r.text): weight(r.text) for r in found}
    assert all(r.log_weight == pytest.approx(weights[r.doc_id, r.text], abs=1e-9) for r in found)
    spread = [r.gumbel_key - r.log_weight * math.log(10) for r in found]
    assert len(set(spread)) == len({(r.doc_id, r.text) for r in found}) and -4 < min(spread) < max(spread) < 12
    bounds = sorted((r.log_weight for r in found if part[r.doc_id] == 2), reverse=True)
    least = bounds[math.ceil(len(bounds) * (1 - quality.MISSED)) - 1]
    n = sum(r.log_weight >= min(0.0, least) for r in found)
    bound = sorted((r.gumbel_key for r in found), reverse=True)[n - 1]
    assert 0 < n < len(found) and all(r.selected == (r.gumbel_key >= bound) for r in found)


def test_quality_clashes(spark):
    docs, labels = quality_tables(spark)
    kept = quality.keep_selected(with_inner(docs), labels)
    want = quality.select_target(docs.drop("selected"), labels).where("selected")
    assert kept.columns == with_inner(docs).columns and kept.schema["selected"].dataType.simpleString() == "int"
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in want.collect())
    assert {v for r in kept.collect() for c, v in r.asDict().items() if c in INNER} == {"mine"}
    assert quality.keep_selected(docs.limit(0), labels).count() == 0
    assert quality.keep_selected(docs, labels.limit(0)).count() == docs.count()


def test_language_without_letters(spark):
    texts = {"en": "the of and to in is that it was for " * 40, "fr": "le de et la les des en un du une que " * 40}
    made = {x: language_id.words_of(t) for x, t in texts.items()}
    rows = [(1, "½ ²"), (2, "①"), (3, "Ⅷ"), (4, "12 _ ;"), (5, None), (6, ""), (7, "the of and to"), (None, "le de et la les"), (7, "the of and to")]
    docs = with_inner(spark.createDataFrame(rows, "doc_id long, text string"))
    found = sorted((str(r.doc_id), r.lang_pred, r.score) for r in language_id.identify(docs, made).collect())
    assert [x[1] for x in found] == ["und"] * 6 + ["en", "en", "fr"] and all(0 <= x[2] <= 1 for x in found)
    kept = language_id.keep_identified(docs, made)
    assert kept.columns == docs.columns and kept.count() == 3
    assert language_id.keep_identified(docs, {}).count() == len(rows) and language_id.keep_identified(docs.limit(0), made).count() == 0
    every = "".join(chr(c) for c in range(0x110000) if unicodedata.category(chr(c))[0] != "L" and not 0xD800 <= c < 0xE000)
    classify = language_id.Classifier(made)
    assert classify(every)[0] == "und"


def test_language_against_brute_force(spark):
    """Sizes of whole encodings, from the dictionaries on, by the library's plain interface."""
    import zstandard

    texts = {"en": "the of and to in is that it was for on are as with his they be at one have this " * 30, "fr": "le de et la les des en un du une que est pour qui dans a par plus pas au sur ne se " * 30}
    labelled = spark.createDataFrame([(x, t) for x, t in texts.items()] + [(None, "skipped"), ("en", None), ("en", "")], "lang string, text string")
    made = language_id.train_dictionaries(labelled)
    assert made == {x: language_id.words_of(t) for x, t in texts.items()}
    classify = language_id.Classifier(made)
    for text in ("they have this at one", "plus pas au sur les", "that was for dans"):
        sizes = {}
        for lang, content in made.items():
            kind = zstandard.ZstdCompressionParameters.from_level(5, source_size=4096, dict_size=len(content), strategy=zstandard.STRATEGY_GREEDY, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False)
            sizes[lang] = len(zstandard.ZstdCompressor(compression_params=kind, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)).compress(language_id.words_of(text)))
        first, second = sorted(sizes, key=sizes.get)
        lang, score, rejected = classify(text)
        if 1 - sizes[first] / sizes[second] >= language_id.NARROW:
            assert lang == first and score == pytest.approx(1 - sizes[first] / sizes[second]) and not rejected


def test_packing_of_joined_marks():
    """Every letter that may be small or capital, with every joining mark, as the tokenizers library has it."""
    encode = packing.TextEncoder(packing.public_tokenizers.path("word_bpe_49k.json"))
    letters = [chr(c) for c in (*range(0x20, 0x250), 0x212A, 0x212B, 0x1E9E, 0x130) if chr(c).isprintable()]
    wrong = []
    for letter, mark in product(letters, map(chr, range(0x300, 0x370))):
        text = f"A{letter}{mark}b"
        if encode(text) != b"".join(i.to_bytes(4, "little") for i in encode.tokenizer.encode(text, add_special_tokens=False).ids):
            wrong.append(text)
    assert not wrong


def test_media_fingerprint_by_hand():
    """Peaks and pairs by a direct transform and loops."""
    import math

    samples = bytes((128 + int(60 * math.sin(i * 0.3) + 40 * math.sin(i * 0.9 + i * i / 9000))) % 256 for i in range(1000))
    x = [b - 128 for b in samples] + [0] * (-len(samples) % media.HOP)
    window = [0.5 - 0.5 * math.cos(2 * math.pi * k / (media.FRAME - 1)) for k in range(media.FRAME)]
    peaks = []
    for t, start in enumerate(range(0, len(x) - media.FRAME + 1, media.HOP)):
        frame = [x[start + k] * window[k] for k in range(media.FRAME)]
        power = [abs(sum(v * complex(math.cos(2 * math.pi * f * k / media.FRAME), -math.sin(2 * math.pi * f * k / media.FRAME)) for k, v in enumerate(frame))) for f in range(media.FRAME // 2 + 1)]
        tops = sorted((f for f in range(1, media.FRAME // 2) if power[f - 1] < power[f] >= power[f + 1]), key=lambda f: -power[f])[: media.PEAKS]
        peaks += [(t, f) for f in sorted(tops)]
    pairs = sorted((t, f << 14 | g << 6 | u - t) for i, (t, f) in enumerate(peaks) for u, g in peaks[i + 1 : i + 1 + media.FAN_OUT] if u - t <= media.MAX_GAP)
    times, hashes = media.fingerprint(samples)
    assert list(zip(times.tolist(), hashes.tolist(), strict=True)) == pairs and len(pairs) > 10


def test_shared_dir_on_clusters():
    class Conf:
        def __init__(self, **x):
            self.x = {k.replace("__", "."): v for k, v in x.items()}

        def get(self, key, default=None):
            return self.x.get(key, default)

        def set(self, key, value):
            self.x[key] = value

    class Session:
        def __init__(self, **x):
            self.conf = Conf(**x)

    assert common.shared_dir(Session(spark__checkpoint__dir="store://x/")) == "store://x"
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", ""):
        with pytest.raises(ValueError):
            common.shared_dir(Session(spark__master=master))
    assert common.shared_dir(Session(spark__master="local[*]"))


def test_bpe_table():
    """Ids are the tokenizers library's on words of few letters, in which merges compete, and on very long ones; the table has no more rows than tokens."""
    import random

    from tokenizers import Tokenizer

    path = bpe.public_tokenizers.path("byte_bpe_50k.json")
    codec, library = bpe.codec_of(path), Tokenizer.from_file(path)
    rnd = random.Random(17)
    pools = ["etaoin", "aeiou", "=-_*#.", "0123456789", [chr(c) for c in range(0xA0, 0x400)], "a"]
    words = ["".join(rnd.choice(pools[k % len(pools)]) for _ in range(rnd.randint(1, 40))) for k in range(6000)]
    words += ["".join(rnd.choice("etaoins") for _ in range(100_000)), "a" * 100_000]
    assert all(codec.encode(w) == library.encode(w, add_special_tokens=False).ids for w in words)
    assert bpe.codec_of(path) is codec and 0 < len(codec.automaton.rows) <= len(codec.automaton.labels)
    assert all(codec.decode(codec.encode(w)) == w for w in words)


def test_media_column(spark):
    """The stored WAV gives the text back, and its digests are the row's."""
    import hashlib

    rows = [(1, "abc"), (2, None), (3, "é" * 100), (None, "abc")]
    docs = with_inner(spark.createDataFrame(rows, "doc_id long, text string"))
    found = media.media_features(docs, keep_media=True).collect()
    texts = sorted(str(t or "") for _, t in rows)
    assert sorted(media.from_wav(r.media)[: r.n_bytes].decode() for r in found) == texts
    assert all(hashlib.sha256(r.media).hexdigest() == r.media_sha256 and len(r.media) == r.media_bytes for r in found)
    assert "media" not in media.media_features(docs).columns
