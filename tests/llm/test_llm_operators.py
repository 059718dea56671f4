"""Operators against brute-force versions, round trips and held-out accuracy, with nulls, empty and long texts, ties, repeats and clashes."""

import hashlib
import io
import itertools
import random
import re
import wave
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandframe.llm import bpe, language_id, language_model, media, neighbours, packing, quality, sharding, simhash, tables, url_filter
from strandframe.llm.components import connected_components

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " ", "\n\t", "a", "É È  ñ", "word " * 3, "x" * 300, "<|endoftext|> it's <|ENDOFTEXT|>", "日本語 😀 ½ ²", "\x1c \x85 a\u00a0b", "The cat. The cat, the CAT!!", "The cat. The cat, the CAT!!"]


def words(seed, n, syllables):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(n))


EN, FR = "th he in er an re on at ing ed".split(), "eau le qu on ai ment oi que é çe".split()


def documents():
    rows = [(i, words(i, 40 + i % 30, EN if i % 3 else FR), "en" if i % 3 else "fr", "s", 1) for i in range(90)]
    rows += [(1000 + i, t, None, None, None) for i, t in enumerate(ODD)]
    rows += [(500, rows[3][1], "fr", "s", 1), (501, rows[4][1] + " extra", "en", "s", 1), (502, words(7, 30_000, EN), "en", "s", 1), (None, "no id here at all", None, None, None), (7, rows[7][1], "en", "s", 1)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(), DOCS).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# 1


def brute_url(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(h + p), len(h), h + p, a) for h, p, a in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_url_filter(spark):
    rules = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "", "block")]
    urls = [None, "", "nothing", "http://", "http://A.Example.COM/en/71?x#y", "http://com/en/", "https://xcom/en/", "http://b.example.net/de/8", "a://x.org?q", "a://x.org", "a://b://org/", "http://É.com/en/é\n", "http://Q.Example.com/en/8"]
    urls += urls[:6]
    table = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    found = url_filter.judge_urls(table, spark.createDataFrame(rules, "host string, path string, action string"))
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()} == {i: brute_url(u, rules) for i, u in enumerate(urls)}
    nothing = spark.createDataFrame([], "host string, path string, action string")
    assert {r.verdict for r in url_filter.judge_urls(table, nothing).collect()} == {"allow"}
    assert url_filter.judge_urls(table.limit(0), nothing).count() == 0


# 2


@pytest.mark.parametrize("relax", [1.0, neighbours.RELAX])
def test_nearest(spark, relax):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 12)) * rng.uniform(0.5, 2, size=(1500, 1))
    x[300:700] = x[300]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2020, [0.0] * 12), (2040, [float("nan")] * 12), (2060, [None] + [1.0] * 11), (2080, []), (None, [1.0] * 12), (2100, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    found = {}
    for r in neighbours.nearest(table, k=10, every=50, relax=relax, shard_rows=400).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    hits = 0
    for q in range(0, 1500, 50):
        scores = np.einsum("d,nd->n", x[q], x)
        best = [i for i in np.lexsort((np.arange(1500), -scores)) if i != q][:10]
        got = [found[q][k][0] for k in range(1, 11)]
        hits += len(set(got) & set(best))
        assert all(abs(found[q][k][1] - x[q] @ x[found[q][k][0]]) < 1e-9 for k in found[q])
        if relax == 1:
            assert got == best
    assert hits >= 0.9 * 300 and set(found) == set(range(0, 1500, 50))
    assert neighbours.nearest(table.limit(0)).count() == 0


# 3


def test_media(docs, empty):
    found = media.media_features(docs).collect()
    texts = {r[0]: r[1] for r in documents()}
    by_text = {}
    for r in found:
        data = (texts[r.doc_id] or "").encode()
        payload = data + b"\0" * (-len(data) % 64 or (0 if data else 64))
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setparams((1, 1, media.RATE, 0, "NONE", ""))
            w.writeframes(payload)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(data), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(payload[-64:]), len(out.getvalue()), hashlib.sha256(out.getvalue()).hexdigest())
        assert by_text.setdefault(texts[r.doc_id] or "", r.feature) == r.feature and list(r.pair_times) == sorted(r.pair_times)
    assert len(found) == docs.count() and media.media_features(empty).count() == 0


def test_fingerprint_finds_a_tone():
    t = np.arange(4096)
    tone = (128 + 100 * np.sin(2 * np.pi * t * 32 / 256)).astype(np.uint8).tobytes()
    _, bins = media.spectral_peaks(tone)
    assert Counter(bins.tolist()).most_common(1)[0][0] == 32


# 4


def test_language(spark, docs, empty):
    training = docs.where(language_id.is_training(F.col("doc_id")))
    dictionaries = language_id.train_dictionaries(training)
    assert set(dictionaries) == {"en", "fr"} and language_id.train_dictionaries(empty) == {}
    found = language_id.identify(docs, dictionaries).collect()
    truth = {r[0]: r[2] for r in documents() if r[2]}
    held = [r for r in found if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 10 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.95
    assert all(r.lang_pred == "und" and r.rejected for r in found if r.doc_id in (1000, 1001, 1002, 1003))
    assert all(0 <= r.score <= 1 for r in found) and len(found) == docs.count()
    kept = language_id.keep_identified(docs, dictionaries)
    assert kept.columns == docs.columns and kept.count() == sum(not r.rejected for r in found)
    assert language_id.identify(empty, {}).count() == 0


# 5


def test_sharding(spark, docs):
    names = [f"n{i}" for i in range(7)]
    table = sharding.fill_table(names, 101)
    assert max(Counter(table).values()) - min(Counter(table).values()) <= 1
    # brute force: claims in turns, each shard trying its whole preference list
    prefer = [[(sharding._number(f"{n}#offset") + j * (sharding._number(f"{n}#skip") % 100 + 1)) % 101 for j in range(101)] for n in names]
    owner = {}
    while len(owner) < 101:
        for n, slots in zip(names, prefer, strict=True):
            if len(owner) < 101:
                owner[next(s for s in slots if s not in owner)] = n
    assert table == [owner[s] for s in range(101)]
    fewer = sharding.fill_table(names[:-1], 101)
    assert sum(a != b for a, b in zip(table, fewer, strict=True)) < 40
    found = sharding.place(docs.withColumn("slot", F.lit("clash")), "doc_id", names, 101).collect()
    for r in found:
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:8], 16) % 101
        assert (r.slot, r.shard) == (slot, table[slot])
    assert len(found) == docs.count()
    with pytest.raises(ValueError):
        sharding.fill_table(names, 100)


# 6


def test_packing(docs, empty):
    pieces = packing.pack(docs, window=64).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in documents())
    at, have, stream = 0, Counter(), {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.sequence_id * 64 + r.offset == at and r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
        stream.setdefault((r.doc_id, r.sequence_id * 64 + r.offset - r.start), []).append(r)
        at += r.length
    for (doc_id, _), some in stream.items():
        ids = np.frombuffer(b"".join(x.ids for x in some), "<u4")
        assert len(ids) == some[0].doc_tokens
        have[doc_id, tuple(ids.tolist())] += 1
    assert have == want and packing.pack(empty).count() == 0
    joined = packing.sequences(packing.pack(docs, window=64)).collect()
    assert all(len(r.ids) == 4 * r.n_tokens and (r.n_tokens == 64 or r.sequence_id == len(joined) - 1) for r in joined)


# 7


def test_language_model(docs, empty):
    found = language_model.score(docs, buckets=3).collect()
    tokens = lambda t: language_model.tokens_of(t) + [b"\n"]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    train = Counter(t for r in documents() if not held(r[0]) for t in tokens(r[1]))
    n, v = sum(train.values()), len(train)
    want = Counter((r[0], held(r[0]), len(tokens(r[1])), sum(train[t] > 0 for t in tokens(r[1])), n, round(sum(np.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(r[1])), 4)) for r in documents())
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found) == want
    assert all(r.score < 0 for r in found) and language_model.score(empty).count() == 0
    some = [r for r in found if r.held_out]
    assert sum(r.score for r in some) > sum(r.base_score for r in some)


def _seated(split=()):
    """A seating of four words (the last one unseen) with its settings, and its totals as a driver sums them."""
    lm = language_model
    hashes, hot = np.array([11, 12, 13, 14], np.uint64), np.array(sorted(split), np.uint64)
    context = np.array([64, 65, 130, 64, 200, 65, 300])
    pairs, counts = np.array([0, 0, 0, 1, 1, 2, 3]) * lm.CONTEXTS + context, np.array([5, 1, 60, 2, 300, 1, 0])
    inside = np.bincount(context, weights=counts, minlength=lm.CONTEXTS)
    s = lm.Seating(hashes, pairs, counts, 0, hot)
    settings = {"words": 3, "in_context": inside, "d2": 0.7, "d1": 0.6, "d0": 0.5}

    def totals(k):
        sums = np.zeros(lm.NUMBERS + lm.N_NUMBERS + 2 * len(hot), np.int64)
        for at, x in s.sums().items():
            sums[at] = x
        return lm._totals(sums, settings, k)

    return s, settings, totals


@pytest.mark.parametrize("split", [(), (12,)])
def test_model_is_proper(split):
    """Predictive probabilities of all words in a context add up to one with the unknown word's, whether words are split or not."""
    lm = language_model
    s, settings, totals = _seated(split)
    now = totals(0)
    for k in range(4):
        s.sweep(now, settings, k)
        assert (s.t >= 1).all() and (s.t <= s.c).all() and (s.t1 >= 1).all() and (s.t1 <= s.c1).all()
        now = totals(k + 1)
        for context in (64, 65, 130, 9, 0, 200):
            # The word that is in no text has what an unseen known one has.
            every = s.predictive(now, settings, np.array([0, 1, 2, 3]) * lm.CONTEXTS + context)
            assert (every > 0).all() and abs(every.sum() - 1) < 1e-9


def test_gibbs_against_brute_force():
    """The number of tables of dishes in two restaurants under a shared one, by many sweeps, against the exact distribution: all seatings weighed."""
    lm, d2, d1, d0, words = language_model, 0.7, 0.6, 0.5, 3
    counts = {(0, 64): 3, (0, 65): 2, (1, 64): 2}
    # One class of contexts: tables of a dish in contexts are customers in the class, whose tables are customers of the root.
    logs = {d: [r[1:] for r in tables.stirling_logs(d, 10)] for d in (d2, d1, d0)}
    rising = lambda d, tables: sum(np.log(1 + d * k) for k in range(1, tables))  # noqa: E731  opening tables, strength 1
    total = lambda n: sum(np.log(1 + k) for k in range(1, n))
    weights, ways = {}, 0.0
    for t in itertools.product(range(1, 4), range(1, 3), range(1, 3)):
        c1 = {0: t[0] + t[1], 1: t[2]}
        for t1 in itertools.product(range(1, c1[0] + 1), range(1, c1[1] + 1)):
            for t0 in itertools.product(*(range(1, x + 1) for x in t1)):
                x = sum(logs[d2][c][k - 1] for c, k in zip(counts.values(), t, strict=True)) + sum(logs[d1][c][k - 1] for c, k in zip(c1.values(), t1, strict=True)) + sum(logs[d0][c][k - 1] for c, k in zip(t1, t0, strict=True))
                x += rising(d2, t[0] + t[2]) + rising(d2, t[1]) + rising(d1, sum(t1)) + rising(d0, sum(t0)) - total(sum(c1.values())) - total(sum(t1)) - sum(t0) * np.log(words + 1)
                weights[t] = weights.get(t, 0) + np.exp(x)
                ways += np.exp(x)
    exact = sum(w / ways * np.array(t) for t, w in weights.items())
    hashes, hot = np.array([11, 12], np.uint64), np.zeros(0, np.uint64)
    pairs = np.array([w * lm.CONTEXTS + c for w, c in counts])
    inside = np.bincount([c for _, c in counts], weights=list(counts.values()), minlength=lm.CONTEXTS)
    settings = {"words": words, "in_context": inside, "d2": d2, "d1": d1, "d0": d0}
    s, sampled = lm.Seating(hashes, pairs, np.array(list(counts.values())), 0, hot), []
    for k in range(3000):
        sums = np.zeros(lm.NUMBERS + lm.N_NUMBERS, np.int64)
        for at, x in s.sums().items():
            sums[at] = x
        s.sweep(lm._totals(sums, settings, k), settings, k)
        sampled.append(s.t.copy())
    # Dishes are seated side by side given the last totals, which is close to one after another but not the same.
    assert np.abs(np.mean(sampled[200:], axis=0) - exact).max() < 0.12


def test_split_words_count_alike(docs):
    """Frequent words split over buckets by class give the same counts, and about the same scores."""
    whole = {(r.doc_id, r.n_tokens, round(r.base_score, 6)): r for r in language_model.score(docs, buckets=1).collect()}
    found = language_model.score(docs, buckets=40).collect()
    assert len(language_model.frequent_words(docs.select("text"), 1 / 160)) > 3
    for r in found:
        w = whole[r.doc_id, r.n_tokens, round(r.base_score, 6)]
        assert (r.n_known, r.train_tokens) == (w.n_known, w.train_tokens) and abs(r.score - w.score) < 0.06 * abs(w.score) + 0.5


def test_repeats_score_apart(spark):
    """Texts that training has twice score better than others by far; a model of the whole corpus tells them."""
    texts = [" ".join(f"w{(i * 7919 + k * k * (i + 3)) % 4001}" for k in range(60)) for i in range(400)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i]) for i in range(40)]
    seen = [r for r in language_model.score(spark.createDataFrame(rows, "doc_id long, text string")).collect() if not r.held_out]
    twice = {i for i, _ in rows[:40]} | {i for i, _ in rows[400:]}
    both = {r.doc_id for r in seen}
    repeated = [r.score / r.n_tokens for r in seen if r.doc_id in twice and (r.doc_id + 1000 in both or r.doc_id - 1000 in both)]
    single = [r.score / r.n_tokens for r in seen if r.doc_id not in twice]
    bound = np.quantile(single, 0.95)
    assert len(repeated) > 50 and np.mean(np.array(repeated) > bound) > 0.9


def test_wide_numbers():
    x = np.array([0, 1, 2**32 + 5, 2**62])
    assert language_model._from_planes(language_model._planes(x, 8), 8).tolist() == x.tolist()


def test_stirling_numbers():
    """With discount 0 they are the unsigned Stirling numbers of the first kind."""
    assert np.round(np.exp(tables.stirling_logs(0.0, 5)[5, 1:])).tolist() == [24, 50, 35, 10, 1]


# 8


def test_quality(spark, docs, empty):
    junk = [(2000 + i, " ".join(f"{w}!!" for w in words(i, 30, EN).upper().split()), "en", "s", 1) for i in range(15)]
    table = docs.unionByName(spark.createDataFrame(junk, DOCS)).cache()
    labels = spark.createDataFrame([(i, 1) for i in range(0, 90, 2)] + [(2000, 0), (None, 1), (4, 1)], "doc_id long, quality int")
    found = quality.select_target(table, labels).collect()
    assert len(found) == table.count()
    kept = {r.doc_id for r in found if r.selected}
    assert sum(i in kept for i in range(90)) >= 88 and not any(i in kept for i in range(2000, 2015))
    # weights against plain counting
    marked = {r.doc_id for r in quality.mark_target(table, labels).collect() if r.target_part == 1}
    f, target, raw = quality.Features(1 << 16), np.zeros(1 << 16), np.zeros(1 << 16)
    for r in found:
        np.add.at(raw, f(r.text), 1)
        if r.doc_id in marked:
            np.add.at(target, f(r.text), 1)
    share = lambda c: (c + 1) / (c.sum() + (1 << 16))
    ratio = np.log10(share(target) / share(raw))
    assert all(abs(r.log_weight - ratio[f(r.text)].sum()) < 1e-6 for r in found)
    assert quality.select_target(empty, labels).count() == 0
    assert all(r.selected for r in quality.select_target(docs, labels.limit(0)).collect())


def test_kth_largest(spark):
    values = [0.0, -1.5, 3.25, 3.25, 1e-300, 2**0.5, -1e9, 3.25 + 4e-16, 7.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    assert [quality.kth_largest(df, "x", k) for k in range(1, 10)] == sorted(values, reverse=True)
    assert quality.kth_largest(df, "x", 10) is None


# 9


def brute_fingerprint(text, n=4):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i : i + n]) for i in range(max(1, len(tokens) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                root[find(b)] = find(a)
    members = {}
    for n in nodes:
        members.setdefault(find(n), []).append(n)
    return {n: min(group) for group in members.values() for n in group}


def test_near_duplicates(docs, empty):
    found = simhash.near_duplicates(docs).collect()
    prints = [(r[0], brute_fingerprint(r[1])) for r in documents()]
    group = brute_components({f for _, f in prints}, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, f in prints:
        if i is not None:
            least[group[f]] = min(i, least.get(group[f], i))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == Counter((i, f"{f:016x}", least.get(group[f])) for i, f in prints)
    assert simhash.near_duplicates(empty).count() == 0


def brute_wide(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    out = 0
    for word in range(8):
        ones = [0] * 64
        for x in (xxhash.xxh64_intdigest(s, 42) for s in shingles):
            if word:
                x = (x + word * 0x9E3779B97F4A7C15) % 2**64
                x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
                x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
                x ^= x >> 31
            for b in range(64):
                ones[b] += x >> b & 1
        out |= sum(1 << 64 * word + b for b in range(64) if ones[b] * 2 > len(shingles))
    return out


def brute_near(a, b):
    same = [not (a ^ b) >> 8 * k & 255 for k in range(64)]
    return (a ^ b).bit_count() <= 86 and sum(same) >= 5 and any(same[4 * k + j] and same[4 * k + j + 1] for k in range(16) for j in range(3))


def test_keep_one(docs, empty):
    prints = [(r[0], brute_wide(r[1])) for r in documents()]
    group = brute_components({f for i, f in prints if i is not None}, brute_near)
    least = {}
    for i, f in prints:
        if i is not None:
            least[group[f]] = min(i, least.get(group[f], i))
    found = simhash.near_copies(docs).collect()
    assert Counter((r.doc_id, r.component_id) for r in found) == Counter((i, least[group[f]]) for i, f in prints if i is not None)
    kept = simhash.keep_one(docs.withColumns({"fp": F.lit("clash"), "wide": F.lit("clash"), "node": F.lit("clash")})).collect()
    ids = Counter(r.doc_id for r in kept)
    assert set(ids) - {None} == set(least.values()) and max((n for i, n in ids.items() if i is not None), default=1) == 1
    assert ids[None] == sum(i is None for i, _ in prints)
    assert simhash.keep_one(empty).count() == 0 and simhash.near_copies(empty).count() == 0


@pytest.mark.parametrize("chunk", [40, 2048])
def test_wide_links_of_clusters(spark, chunk, monkeypatch):
    """Dense clusters, whose posting lists are searched, or cut into chunks, and chains of near fingerprints."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rnd = random.Random(chunk)
    centre, chain = rnd.getrandbits(512), rnd.getrandbits(512)
    flip = lambda x, n: x ^ sum(1 << b for b in rnd.sample(range(512), n))
    fps = {flip(centre, rnd.randint(0, 70)) for _ in range(250)} | {rnd.getrandbits(512) for _ in range(60)} | {0, 2**512 - 1}
    for _ in range(12):
        fps.add(chain)
        chain = flip(chain, 80)
    fps = list(fps)
    df = spark.createDataFrame([(k, bytearray(f.to_bytes(64, "little"))) for k, f in enumerate(fps)], "node long, wide binary")
    links = [(r.a, r.b) for r in simhash.wide_links(df).collect()]
    assert all(brute_near(fps[a], fps[b]) for a, b in links)
    want = brute_components(set(range(len(fps))), lambda a, b: brute_near(fps[a], fps[b]))
    joined = set(links) | {(b, a) for a, b in links}
    assert brute_components(set(range(len(fps))), lambda a, b: (a, b) in joined) == want


def test_near_copies_by_similarity(spark):
    """Copies of Jaccard similarity 0.85 or more are found, those under 0.6 and unrelated texts are left alone."""
    rnd = random.Random(5)
    vocabulary = [f"word{k}" for k in range(2000)]
    shingles = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    rows, want, clean = [], [], []
    for k in range(120):
        base = rnd.choices(vocabulary, k=rnd.randint(60, 900))
        copy = list(base)
        for at in rnd.sample(range(len(copy)), max(1, int(len(copy) * rnd.choice([0.004, 0.01, 0.03, 0.15])))):
            copy[at] = rnd.choice(vocabulary)
        a, b = shingles(base), shingles(copy)
        similar = len(a & b) / len(a | b)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
        if similar >= 0.85:
            want.append(2 * k + 1)
        elif similar < 0.6:
            clean.append(2 * k + 1)
    found = {r.doc_id: r.component_id for r in simhash.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(want) > 20 and len(clean) > 20
    assert sum(found[i] == i - 1 for i in want) >= 0.97 * len(want)
    assert all(found[i] == i for i in clean) and all(found[2 * k] == 2 * k for k in range(120))


@pytest.mark.parametrize("bits", [1, 3, 4, 5, 6])
def test_links_of_clusters(spark, bits, monkeypatch):
    """Dense clusters, whose posting lists are cut into chunks, and chains."""
    monkeypatch.setattr(simhash, "CHUNK", 40)
    rnd = random.Random(bits)
    centre = rnd.getrandbits(64)
    fps = {centre ^ sum(1 << rnd.randrange(64) for _ in range(rnd.randint(0, 3))) & (2**64 - 1) for _ in range(250)}
    fps |= {rnd.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1}
    chain = rnd.getrandbits(64)
    for _ in range(10):
        fps.add(chain)
        for b in rnd.sample(range(64), bits):
            chain ^= 1 << b
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = [(r.a, r.b) for r in simhash.fingerprint_links(df, bits).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= bits for a, b in links)
    want = brute_components({signed(f) for f in fps}, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= bits)
    pairs = set(links)
    have = brute_components({signed(f) for f in fps}, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    groups = lambda m: sorted(sorted(n for n in m if m[n] == r) for r in set(m.values()))
    assert groups(have) == groups(want)


def test_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(100, i) for i in range(101, 140)] + [(i, i + 1) for i in range(200, 230)] + [(5, 5), (None, 3)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = {tuple(sorted(x)) for x in links if None not in x and x[0] != x[1]}
    nodes = {n for x in real for n in x}
    assert found == brute_components(nodes, lambda a, b: (a, b) in real)


# 10


def test_bpe(docs, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r[0]: r[1] or "" for r in documents()}
    found = bpe.encode_texts(docs, keep=True).collect()
    for r in found:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, list(r.ids), r.decoded) == (len(ids), ids, tokenizer.decode(ids, skip_special_tokens=False))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    assert len(found) == docs.count() and bpe.encode_texts(empty).count() == 0


def test_encoders_on_odd_texts():
    codec, encode = bpe.Codec(public_tokenizers.path("byte_bpe_50k.json")), packing.TextEncoder(public_tokenizers.path("word_bpe_49k.json"))
    tokenizers = [Tokenizer.from_file(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")]
    rnd = random.Random(9)
    pools = ["abcdefgh the ing ABC'sdm\n\t 0129 é ß!?.,;<|>", [chr(c) for c in (*range(1, 0x300), *range(0x300, 0x3FF), 0x1100, 0x1161, 0x200D, 0x3000, 0xFB01, 0x1F600)]]
    for k in range(600):
        text = "".join(rnd.choice(pools[k % 2]) for _ in range(rnd.randint(1, 60)))
        assert codec.encode(text) == tokenizers[0].encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizers[1].encode(text, add_special_tokens=False).ids
