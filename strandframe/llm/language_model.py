"""Language-model scoring by a hierarchical Pitman-Yor model whose restaurants are seated by Gibbs sampling."""

from __future__ import annotations

import pickle
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import input_partitions, write_table
from .tables import noise, seat

#: Levels of restaurants: the root; one for each class of words by their last two bytes (and one for the start of a text); and, within each class,
#: SUBS ones for the word itself, by hash. A token is a customer of the restaurant of the word before it. The numbers bound what sweeps
#: gather and broadcast: with them words of a class share a restaurant with one in SUBS of the others.
CLASSES, SUBS = 1024, 64
CONTEXTS = CLASSES * SUBS
#: Held out: crc32 of the id as text modulo 10 is 0.
FOLDS = 10
#: Bytes of text for each bucket: what a task holds of a bucket follows these, however the input is split; and buckets at least.
BUCKET_BYTES, BUCKETS = 16_000_000, 24
#: Words and ends in a block of documents, which are counted, asked for and scored together: so many for each bucket, that messages stay worth sending, within bounds.
TOKENS_EACH, BLOCK_TOKENS, MOST_TOKENS = 2_500, 500_000, 2_000_000
#: Bytes of answers that are handed on together.
ANSWER_BYTES = 1 << 22
#: Gibbs sweeps, and the first one whose seating is averaged.
SWEEPS, BURN_IN = 3, 2
STRENGTH = 1.0
#: Documents (their first characters) by which words are told that are too frequent for one bucket. That says where counts lie, not what they are.
SAMPLE_TEXTS, SAMPLE_CHARS = 2_000, 20_000
#: Logarithms are sent in whole numbers of this size.
UNIT = 1e-8
END = b"\n"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
SUMS = "at long, x long"
#: Places of a bucket's sums: tokens and tables of each context, tables of each class, then words, dishes with one and two customers on each
#: level, tables of the root; after these, tokens and root customers of each word that is split.
OF_CONTEXT, OF_CLASS, NUMBERS = CONTEXTS, 2 * CONTEXTS, 2 * CONTEXTS + CLASSES
N_NUMBERS = 8


def _packed(x: dict) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(x, 5))


def _unpacked(x: bytes) -> dict:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(x))


def _planes(x: np.ndarray, size: int = 4) -> bytes:
    """The low `size` bytes of whole numbers, all first ones first: they pack better."""
    return x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :size].T.tobytes()


def _from_planes(x: bytes, size: int = 4) -> np.ndarray:
    out = np.zeros((len(x) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(x, np.uint8).reshape(size, -1).T
    return out.view("<i8").ravel()


def tokens_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def context_of(word: bytes) -> int:
    """The restaurant of what follows a word; its class is the context divided by SUBS. 0 is the start of a text."""
    return (zlib.crc32(word[-2:]) % (CLASSES - 1) + 1) * SUBS + zlib.crc32(word) % SUBS


def _bucket(hashes: np.ndarray, context: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """Where (word, context) pairs are counted: by word, so that parents are local; those of split words by word and class, in as many more buckets."""
    split = np.isin(hashes, hot)
    mixed = (hashes ^ (context // SUBS + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)
    return np.where(split, np.uint64(buckets) + mixed % np.uint64(buckets), hashes % np.uint64(buckets)).astype(np.int64)


def _block(docs: list[tuple[int | None, list[bytes]]], buckets: int, hot: np.ndarray) -> tuple[bytes, list[tuple[int, bytes]]]:
    """What is asked of each bucket about a block, and what is needed to score it by the answers. Distinct (word, context) pairs are numbered by
    bucket, word and context; a document is the sorted numbers of its tokens' pairs."""
    local: defaultdict[bytes, int] = defaultdict(count().__next__)
    flat = np.fromiter((i for _, words in docs for i in (*map(local.__getitem__, words), local[END])), np.int64)
    lengths = np.array([len(words) + 1 for _, words in docs])
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in local), np.uint64, len(local))
    after = np.fromiter(map(context_of, local), np.int64, len(local))
    context = np.r_[0, after[flat[:-1]]]
    starts = np.cumsum(lengths) - lengths
    context[starts] = 0
    met, of_token = np.unique(flat * CONTEXTS + context, return_inverse=True)
    word, context = met // CONTEXTS, met % CONTEXTS
    of_bucket = _bucket(hashes[word], context, hot, buckets)
    order = np.lexsort((context, hashes[word], of_bucket))
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    number = number[of_token]
    word, context, of_bucket = word[order], context[order], of_bucket[order]
    held = np.array([zlib.crc32(("" if i is None else str(i)).encode()) % FOLDS == 0 for i, _ in docs])
    seen = np.bincount(number, weights=np.repeat(~held, lengths), minlength=len(order)).astype(np.int64)
    doc = np.repeat(np.arange(len(docs)), lengths)
    tokens = np.sort(doc << 32 | number) & 0xFFFFFFFF
    steps = np.diff(tokens, prepend=0)
    steps[starts] = tokens[starts]
    own = _packed({"ids": [i for i, _ in docs], "held": held, "lengths": lengths, "steps": _planes(steps)})
    asked = []
    edges = np.searchsorted(of_bucket, np.arange(2 * buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        part = slice(edges[b], edges[b + 1])
        begins = np.flatnonzero(np.r_[True, np.diff(word[part]) != 0])
        each = np.diff(np.r_[begins, edges[b + 1] - edges[b]])
        asked.append((int(b), _packed({"hashes": hashes[word[part][begins]], "each": _planes(each), "contexts": context[part].astype(np.uint16), "seen": _planes(seen[part])})))
    return own, asked


def block_tokens(buckets: int) -> int:
    return min(MOST_TOKENS, max(BLOCK_TOKENS, TOKENS_EACH * buckets))


def _blocks(buckets: int, hot: np.ndarray):
    most = block_tokens(buckets)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, serial = TaskContext.get().partitionId(), 0

        def out(docs: list) -> pa.RecordBatch:
            own, asked = _block(docs, buckets, hot)
            block = part << 32 | serial
            found = [(block, -1, own), *((block, b, x) for b, x in asked)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found, strict=True), (pa.int64(), pa.int32(), pa.binary()), strict=True)], ["block", "bucket", "data"])

        docs, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                words = tokens_of(text.as_py())
                docs.append((doc_id, words))
                size += len(words) + 1
                if size >= most:
                    yield out(docs)
                    docs, size, serial = [], 0, serial + 1
        if docs:
            yield out(docs)

    return rows


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """All that blocks ask of a bucket: its words, the pairs seen in training with their counts, and the questions in the order of blocks."""
    group = group.sort_values("block")
    asked = [_unpacked(x) for x in group["data"]]
    words, at = np.unique(np.concatenate([x["hashes"] for x in asked]), return_inverse=True)
    word = np.repeat(at, np.concatenate([_from_planes(x["each"]) for x in asked]))
    sizes = np.array([len(x["contexts"]) for x in asked])
    pair = word * CONTEXTS + np.concatenate([x["contexts"] for x in asked])
    seen = np.concatenate([_from_planes(x["seen"]) for x in asked])
    pairs, number = np.unique(pair, return_inverse=True)
    counts = np.bincount(number, weights=seen, minlength=len(pairs)).astype(np.int64)
    steps = np.diff(number, prepend=0)
    steps[np.cumsum(sizes) - sizes] = number[np.cumsum(sizes) - sizes]  # numbers rise within a block
    data = {"hashes": words, "pairs": _planes(np.diff(pairs, prepend=0), 8), "counts": _planes(counts, 8)}
    questions = {"blocks": group["block"].to_numpy(), "sizes": sizes, "steps": _planes(steps)}
    return pd.DataFrame({"bucket": group["bucket"].iloc[:1], "state": [_packed(data)], "questions": [_packed(questions)]})


def _keys(hashes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """What draws for words in places are keyed by."""
    return hashes ^ (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)


def _root_tables(customers: np.ndarray, tables: np.ndarray, total: int, settings: dict, hashes: np.ndarray, number: int) -> np.ndarray:
    """Tables of words in the root, given how many they had and all had."""
    return seat(customers, STRENGTH + settings["d0"] * (total - tables), np.full(len(customers), 1 / (settings["words"] + 1)), settings["d0"], noise(hashes, 3 * number + 2))


class Seating:
    """A bucket's part of the model. Level 2: the tables t of each (word, context) pair with c customers; level 1: the tables t1 of each (word, class), whose
    customers are the tables of its contexts; the root: the tables t0 of each word, whose customers are those of its classes. `totals` are
    sums over all buckets after the last sweep: tables of each context and class and of the root, and, of words split over buckets
    (`hot`, by hash), root customers and tables, which no bucket has by itself."""

    def __init__(self, hashes: np.ndarray, pairs: np.ndarray, counts: np.ndarray, bucket: int, hot: np.ndarray):
        known = counts > 0
        self.hashes, self.own, self.c, self.bucket, self.n = hashes, pairs[known], counts[known], bucket, len(hashes)
        self.word, self.context = self.own // CONTEXTS, self.own % CONTEXTS
        self.groups, self.group = np.unique(self.own // SUBS, return_inverse=True)
        self.g_word, self.g_class = self.groups // CLASSES, self.groups % CLASSES
        place = np.minimum(np.searchsorted(hot, hashes), max(0, len(hot) - 1))
        self.split = hot[place] == hashes if len(hot) else np.zeros(self.n, bool)
        self.hot = place
        self.t, self.t1 = np.ones(len(self.own), np.int64), np.ones(len(self.groups), np.int64)
        self._count_up()
        self.t0 = np.minimum(self.c0, 1)

    def _count_up(self) -> None:
        self.c1 = np.bincount(self.group, weights=self.t, minlength=len(self.groups)).astype(np.int64)
        self.c0 = np.bincount(self.g_word, weights=self.t1, minlength=self.n).astype(np.int64)

    def root(self, totals: dict, settings: dict) -> np.ndarray:
        """Probabilities of the bucket's words in the root."""
        c0, t0, d = self.c0, self.t0, settings["d0"]
        if self.split.any():
            c0, t0 = np.where(self.split, totals["hot_c0"][self.hot], c0), np.where(self.split, totals["hot_t0"][self.hot], t0)
        return (c0 - d * t0 + (STRENGTH + d * totals["tables"]) / (settings["words"] + 1)) / (STRENGTH + totals["of_class"].sum())

    def in_class(self, totals: dict, settings: dict, word: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Probabilities of words in classes."""
        key, d = word * CLASSES + kind, settings["d1"]
        at = np.minimum(np.searchsorted(self.groups, key), max(0, len(self.groups) - 1))
        rest = np.where(self.groups[at] == key, self.c1[at] - d * self.t1[at], 0) if len(self.groups) else np.zeros(len(key))
        customers = totals["of_context"].reshape(CLASSES, SUBS).sum(axis=1)
        return (rest + (STRENGTH + d * totals["of_class"][kind]) * self.root(totals, settings)[word]) / (STRENGTH + customers[kind])

    def sweep(self, totals: dict, settings: dict, number: int) -> None:
        above = self.in_class(totals, settings, self.g_word, self.g_class)
        weight = STRENGTH + settings["d2"] * (totals["of_context"][self.context] - self.t)
        self.t = seat(self.c, weight, above[self.group], settings["d2"], noise(_keys(self.hashes[self.word], self.context), 3 * number))
        self._count_up()
        weight = STRENGTH + settings["d1"] * (totals["of_class"][self.g_class] - self.t1)
        self.t1 = seat(self.c1, weight, self.root(totals, settings)[self.g_word], settings["d1"], noise(_keys(self.hashes[self.g_word], self.g_class), 3 * number + 1))
        self._count_up()
        self.t0 = _root_tables(self.c0, self.t0, totals["tables"], settings, self.hashes, number)

    def predictive(self, totals: dict, settings: dict, pairs: np.ndarray) -> np.ndarray:
        """Probabilities of pairs (word times CONTEXTS plus context)."""
        word, context, d = pairs // CONTEXTS, pairs % CONTEXTS, settings["d2"]
        at = np.minimum(np.searchsorted(self.own, pairs), max(0, len(self.own) - 1))
        rest = np.where(self.own[at] == pairs, self.c[at] - d * self.t[at], 0) if len(self.own) else np.zeros(len(pairs))
        above = self.in_class(totals, settings, word, context // SUBS)
        return (rest + (STRENGTH + d * totals["of_context"][context]) * above) / (STRENGTH + settings["in_context"][context])

    def add_to(self, sums: np.ndarray) -> None:
        """Adds what the bucket has to the sums, by place."""
        whole = ~self.split & (self.c0 > 0)
        contexts, kinds = np.bincount(self.g_word[self.c1 > 0], minlength=self.n), np.bincount(self.group, minlength=len(self.groups))
        numbers = [whole.sum(), (self.c == 1).sum(), (self.c == 2).sum(), (kinds == 1).sum(), (kinds == 2).sum(), (whole & (contexts == 1)).sum(), (whole & (contexts == 2)).sum(), self.t0[whole].sum()]
        dense = np.concatenate([np.bincount(self.context, weights=self.c, minlength=CONTEXTS), np.bincount(self.context, weights=self.t, minlength=CONTEXTS), np.bincount(self.g_class, weights=self.t1, minlength=CLASSES), numbers]).astype(np.int64)
        sums[: len(dense)] += dense
        tokens, at = np.bincount(self.word, weights=self.c, minlength=self.n).astype(np.int64), np.flatnonzero(self.split)
        place = NUMBERS + N_NUMBERS + 2 * self.hot[at]
        sums[place] += tokens[at]
        sums[place + 1] += self.c0[at]


def _swept(state: bytes, bucket: int, model: dict) -> Iterator[tuple[int, Seating]]:
    """The seating before any sweep and after each one whose totals are known. Sweeps are seeded, so a task run again gives the same; as they are few,
    a state is made again from its counts rather than stored."""
    x = _unpacked(state)
    seating = Seating(x["hashes"], np.cumsum(_from_planes(x["pairs"], 8)), _from_planes(x["counts"], 8), bucket, model["hot"])
    yield 0, seating
    for k, totals in enumerate(model["totals"]):
        seating.sweep(totals, model["settings"], k)
        yield k + 1, seating


def _sums(model: dict):
    """The sums of a task's buckets, as rows of (place, sum) where there is any."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(NUMBERS + N_NUMBERS + 2 * len(model["hot"]), np.int64)
        for frame in frames:
            for bucket, state in zip(frame["bucket"], frame["state"], strict=True):
                for _, seating in _swept(state, bucket, model):
                    pass
                seating.add_to(sums)
        at = np.flatnonzero(sums)
        yield pd.DataFrame({"at": at, "x": sums[at]})

    return rows


def _gathered(merged: DataFrame, model: dict) -> np.ndarray:
    """The sums over all buckets after the sweeps that the model has; their number is bounded by CONTEXTS, CLASSES and the words that are split."""
    found = merged.select("bucket", "state").mapInPandas(_sums(model), SUMS).groupBy("at").agg(F.sum("x").alias("x")).toPandas()
    out = np.zeros(NUMBERS + N_NUMBERS + 2 * len(model["hot"]), np.int64)
    out[found["at"].to_numpy(np.int64)] = found["x"].to_numpy(np.int64)
    return out


def _totals(sums: np.ndarray, settings: dict, sweep: int, hot: np.ndarray | None = None, last: dict | None = None) -> dict:
    """What the next sweep needs. Root tables of split words (`hot`, by hash) are drawn here, once for all buckets, as a bucket draws those of its own words."""
    hot_c0 = sums[NUMBERS + N_NUMBERS + 1 :: 2]
    hot_t0, tables = np.minimum(hot_c0, 1), int(sums[NUMBERS + 7])
    if last is not None and len(hot_c0):
        hot_t0 = _root_tables(hot_c0, last["hot_t0"], last["tables"], settings, hot, sweep - 1)
    return {"of_context": sums[OF_CONTEXT:OF_CLASS], "of_class": sums[OF_CLASS:NUMBERS], "tables": tables + int(hot_t0.sum()), "hot_c0": hot_c0, "hot_t0": hot_t0}


def _discount(ones: int, twos: int) -> float:
    return float(np.clip(ones / max(1, ones + 2 * twos), 0.05, 0.95))


def buckets_for(n_bytes: int, partitions: int) -> int:
    """Buckets for so many bytes of text: as many as keep each small, and one for each partition of the input at least."""
    return max(BUCKETS, partitions, -(-n_bytes // BUCKET_BYTES))


def frequent_words(source: DataFrame, share: float, n: int | None = None) -> np.ndarray:
    """Hashes of words that make up more than a share of the tokens of a sample of distinct texts, in order; their number is bounded by 1 / share. Texts are
    chosen by a bound on their hashes, which spread evenly, so the driver gets about SAMPLE_TEXTS of them however many partitions there are. n: rows of source, if known."""
    n = source.count() if n is None else n
    bound = min(2**63 - 1, -(2**63) + int(2**64 * min(1.0, SAMPLE_TEXTS / max(1, n))))
    key = F.xxhash64("text").alias("key")
    some = source.where(F.col("text").isNotNull()).select(key, F.substring("text", 1, SAMPLE_CHARS).alias("text")).where(F.col("key") <= bound).groupBy("key").agg(F.min("text").alias("text")).collect()
    words = [w for r in some for w in (*tokens_of(r["text"]), END)]
    names, counts = np.unique(np.array(words, object), return_counts=True) if words else (np.array([], object), np.array([], np.int64))
    return np.sort(np.array([xxhash.xxh64_intdigest(w) for w in names[counts > share * len(words)]], np.uint64))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None) -> DataFrame:
    """Scores all whole texts by a model of those that aren't held out.

    Tokens are words between ASCII white space, A-Z lower-cased, and an end. Each word is a dish served in the restaurant of the word before
    it (or of the start), whose parent is the restaurant of that word's class (its last two bytes); these share the root, whose base
    measure is uniform over the known words and one unknown. Numbers of tables are sampled by Gibbs sweeps, all buckets given the last sweep's
    totals. score is log10 of the predictive probability averaged over the sweeps from BURN_IN on (sums of numbers rounded to UNIT);
    base_score that of the smoothed unigram model; n_known counts tokens that training texts have; train_tokens is their total. Discounts follow
    from how many counts are one and two.

    A null text counts as empty (one token, the end), a null id as the empty text when folds are told (so it is held out). Repeated rows
    are texts of their own, other columns go, an empty table gives an empty one.

    Pass one cuts documents into blocks and writes them with what they ask of each bucket of words. Buckets, as many as the texts' bytes need (by word, so that a word's
    contexts meet and parents are local; words that would fill a bucket by themselves by word and class) merge the questions into counts, are
    swept with only the totals going through the driver, and answer; each block sums its answers.
    """
    source = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text")
    n, n_bytes = source.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = buckets or buckets_for(n_bytes, input_partitions(docs))
    hot = frequent_words(source, 1 / (4 * buckets), n)
    blocks = write_table(source.mapInArrow(_blocks(buckets, hot), "block long, bucket int, data binary"), "blocks")
    asked = blocks.where("bucket >= 0")
    merged = asked.groupBy("bucket").applyInPandas(_merged, "bucket int, state binary, questions binary")
    merged = write_table(merged, "merged")

    sums = _gathered(merged, {"hot": hot, "totals": []})
    hot_seen = sums[NUMBERS + N_NUMBERS :: 2]
    words, c1, c2, g1, g2, w1, w2, _ = map(int, sums[NUMBERS : NUMBERS + N_NUMBERS])
    settings = {"words": words + int((hot_seen > 0).sum()), "in_context": sums[:CONTEXTS], "train": int(sums[:CONTEXTS].sum()), "hot_seen": hot_seen, "d2": _discount(c1, c2), "d1": _discount(g1, g2), "d0": _discount(w1, w2)}
    totals = [_totals(sums, settings, 0)]
    for sweep in range(1, SWEEPS + 1):
        totals.append(_totals(_gathered(merged, {"hot": hot, "settings": settings, "totals": totals}), settings, sweep, hot, totals[-1]))

    answers = merged.mapInPandas(_answers({"hot": hot, "settings": settings, "totals": totals}), "block long, bucket int, data binary")
    own = blocks.where("bucket = -1").select("block", "data")
    return own.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_scored(settings), SCORES)


def _answers(model: dict):
    before, settings = model | {"totals": model["totals"][:-1]}, model["settings"]

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for bucket, state, questions in zip(frame["bucket"], frame["state"], frame["questions"], strict=True):
                q = _unpacked(questions)
                pairs = np.cumsum(_from_planes(_unpacked(state)["pairs"], 8))
                mean = np.zeros(len(pairs))
                for k, seating in _swept(state, bucket, before):
                    if k >= BURN_IN:
                        mean += seating.predictive(model["totals"][k], settings, pairs) / (SWEEPS - BURN_IN + 1)
                tokens = np.bincount(seating.word, weights=seating.c, minlength=seating.n).astype(np.int64)
                if seating.split.any():
                    tokens = np.where(seating.split, settings["hot_seen"][seating.hot], tokens)
                seen, logs = tokens[pairs // CONTEXTS], np.round(np.log10(mean) / -UNIT).astype(np.int64)
                edges, steps = np.r_[0, np.cumsum(q["sizes"])], _from_planes(q["steps"])
                blocks, data, size = [], [], 0
                for k, block in enumerate(q["blocks"]):
                    pair = np.cumsum(steps[edges[k] : edges[k + 1]])
                    blocks.append(block)
                    data.append(_packed({"seen": _planes(seen[pair], 8), "logs": _planes(logs[pair], 5)}))
                    size += len(data[-1])
                    if size >= ANSWER_BYTES or k + 1 == len(q["blocks"]):
                        yield pd.DataFrame({"block": blocks, "bucket": bucket, "data": data})
                        blocks, data, size = [], [], 0

    return rows


def _scored(settings: dict):
    train, words = settings["train"], settings["words"]

    def of(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        x = _unpacked(own["data"].iloc[0])
        parts = [_unpacked(a) for a in answers.sort_values("bucket")["data"]]
        seen, logs = np.concatenate([_from_planes(a["seen"], 8) for a in parts]), np.concatenate([_from_planes(a["logs"], 5) for a in parts])
        starts = np.cumsum(x["lengths"]) - x["lengths"]
        steps = _from_planes(x["steps"])
        total = np.cumsum(steps)
        tokens = total - np.repeat(total[starts] - steps[starts], x["lengths"])
        base = np.log10((seen + 0.1) / (train + 0.1 * (words + 1)))
        add = lambda values: np.add.reduceat(values[tokens], starts)
        return pd.DataFrame(
            {
                "doc_id": pd.array(x["ids"], "Int64"), "held_out": x["held"], "n_tokens": x["lengths"], "n_known": add((seen > 0).astype(np.int64)),
                "train_tokens": train, "base_score": add(base), "score": add(logs) * -UNIT,
            }
        )

    return of
