"""Alignment of two tokenizers' tokens by their byte offsets, on Arrow arrays."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import BLANKS, PLAIN, byte_letters
from .common import named, write_table

#: Characters of text that are aligned at once; longer texts are cut where both tokenizers begin a word.
AT_ONCE = 1 << 21
#: Units of each tokenizer that a worker remembers as lately used (as many used before that are kept, too), and the characters up to which it does.
REMEMBERED, SHORT = 250_000, 32
MARK = "▁"
TOKENS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, link_a array<int>, link_b array<int>, link_n array<long>"
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


class Units:
    """A tokenizer, used on units: parts of a text that no token crosses, so that a text's tokens are those of its units."""

    def __init__(self, cut: re.Pattern, encode: Callable[[list[str]], list[list[int]]], labels: list[bytes]):
        if b"" in labels:
            raise ValueError("every token must stand for a byte at least")
        self.cut, self.encode, self.labels = cut, encode, labels
        self.sizes = pa.array([len(x) for x in labels], pa.int64())
        #: Ids of units as 32-bit integers, lately used and before; those that don't spell their unit are in no memory.
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _ids(self, units: list[str]) -> tuple[list[bytes], list[int]]:
        """Ids of distinct units, and the places of those that their tokens don't spell."""
        known, before = self.known, self.before
        out = [known.get(u) or before.get(u) for u in units]
        new = [k for k, ids in enumerate(out) if ids is None]
        odd = []
        for k, ids in zip(new, self.encode([units[k] for k in new]), strict=True):
            out[k] = np.array(ids, np.int32).tobytes()
            if b"".join(map(self.labels.__getitem__, ids)) != units[k].encode():
                odd.append(k)
        wrong = set(odd)
        known.update((u, ids) for k, (u, ids) in enumerate(zip(units, out, strict=True)) if len(u) <= SHORT and k not in wrong)
        if len(known) > REMEMBERED:
            self.known, self.before = {}, known
        return out, odd

    def tokens(self, texts: list[str]) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Ids of all tokens, each token's text, and whether each text's tokens spell it."""
        units = list(map(self.cut.findall, texts))
        coded = pa.array(list(chain.from_iterable(units)), pa.large_string()).dictionary_encode()
        ids, odd = self._ids(coded.dictionary.to_pylist())
        flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
        lists = pa.LargeListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]) // 4), flat)
        taken = lists.take(coded.indices)
        text_of_unit = pa.array(np.repeat(np.arange(len(texts)), [len(u) for u in units]))
        flat, owner = pc.list_flatten(taken), text_of_unit.take(pc.list_parent_indices(taken))
        whole = np.ones(len(texts), bool)
        if odd:
            whole[text_of_unit.to_numpy()[np.isin(coded.indices.to_numpy(), odd)]] = False
        for k in np.flatnonzero(~whole):  # units may differ where the whole doesn't
            mine = flat.filter(pc.equal(owner, int(k))).to_pylist()
            whole[k] = b"".join(map(self.labels.__getitem__, mine)) == texts[k].encode()
        return flat, owner, whole

    def ends(self, ids: pa.Array, owner: pa.Array, n_texts: int) -> pa.Array:
        """A key of each token's text and end: text * 2^40 + bytes up to the token's end in its text, from one running sum over all texts."""
        sizes = self.sizes.take(ids)
        running = pc.cumulative_sum(sizes).to_numpy()
        before = np.concatenate([[0], np.cumsum(np.bincount(owner.to_numpy(), sizes.to_numpy(), n_texts).astype(np.int64))])[:-1]
        return pa.array(running + ((np.arange(n_texts) << 40) - before)[owner.to_numpy()])


@lru_cache(maxsize=2)
def byte_level(path: str) -> Units:
    """A byte-level vocabulary of the tokenizers library. White space as its splitter cuts it bounds the units; special tokens' strings are plain text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.encode_special_tokens = True
    of_letter = {c: bytes([b]) for b, c in enumerate(byte_letters())}
    labels = [b"?"] * (max(tokenizer.get_vocab(True).values()) + 1)
    for token, i in tokenizer.get_vocab(True).items():
        labels[i] = b"".join(of_letter.get(c, c.encode()) for c in token)
    letters = dict(enumerate(byte_letters()))
    merged = lambda run: tokenizer.model.tokenize(run.encode().decode("latin-1").translate(letters))

    def encode(units: list[str]) -> list[list[int]]:
        """Letters with marks behind them are runs that the splitter would give to the model; other units go through the splitter."""
        plain = list(map(PLAIN.fullmatch, units))
        others = iter(tokenizer.encode_batch_fast([u for u, p in zip(units, plain, strict=True) if not p], add_special_tokens=False))
        return [[t.id for run in p.groups() if run for t in merged(run)] if p else next(others).ids for p in plain]

    cut = re.compile(f" ?[^{BLANKS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+")
    return Units(cut, encode, labels)


@lru_cache(maxsize=2)
def pieces(path: str) -> Units:
    """A sentencepiece model that puts a space in front of a text. A run of spaces begins a unit, if no piece has a space behind another letter; else a text is one unit.
    A unit has its first space from the model, so that is taken off; what is left of a lone space is nothing, and its piece is the mark."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.vocab_size())]
    labels = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
    apart = not any(MARK in p.lstrip(MARK) for p in names)
    lone = [model.piece_to_id(MARK)]
    cut = re.compile(" +[^ ]*" if apart else "(?s).+")
    return Units(cut, lambda units: [ids or lone for ids in model.encode([u[1:] for u in units], num_threads=1)], labels)


#: Where a text may be cut: before a space between two letters, where a unit of either tokenizer begins.
PLACE = re.compile(f"(?<=[^{BLANKS}]) (?=[^{BLANKS}])")


def parts_of(text: str, at_once: int) -> list[str]:
    """A text in parts of about `at_once` characters that both tokenizers encode apart."""
    out, start = [], 0
    while len(text) - start > at_once:
        found = PLACE.search(text, start + at_once)
        if not found:
            break
        out.append(text[start : found.start()])
        start = found.start()
    return [*out, text[start:]]


class Aligner:
    """Aligns some texts at once: token groups, and links by an Acero join on the keys of text and end."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = byte_level(a_path), pieces(b_path)
        self.n = max(len(self.a.labels), len(self.b.labels))
        self.words = pa.array([f"{i}{end}" for end in ",|;" for i in range(self.n)], pa.large_string())

    def __call__(self, texts: list[str]) -> dict:
        """Of each text whether both tokenizers spell it, how many tokens and links it has, and its groups as text with `;` after each; and the links of all
        texts (text, a, b). A text that isn't spelt has neither."""
        (ids_a, of_a, whole_a), (ids_b, of_b, whole_b) = self.a.tokens(texts), self.b.tokens(texts)
        whole = whole_a & whole_b
        if not whole.all():
            keep = pa.array(whole)
            at_a, at_b = keep.take(of_a), keep.take(of_b)
            ids_a, of_a, ids_b, of_b = ids_a.filter(at_a), of_a.filter(at_a), ids_b.filter(at_b), of_b.filter(at_b)
        n, n_a, n_b = len(texts), len(ids_a), len(ids_b)
        left = pa.table({"end": self.a.ends(ids_a, of_a, n), "i": np.arange(n_a)})
        right = pa.table({"end": self.b.ends(ids_b, of_b, n), "j": np.arange(n_b)})
        links = left.join(right, "end", join_type="inner", use_threads=False).sort_by("i")
        i, j = links["i"].to_numpy(), links["j"].to_numpy()
        ends_a, ends_b = np.zeros(n_a, np.int64), np.zeros(n_b, np.int64)
        ends_a[i], ends_b[j] = 1, 1
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        # within a group A's tokens come first: each A token has the B tokens of earlier groups before it, each B token A's up to its own group
        codes = np.empty(n_a + n_b, np.int64)
        codes[np.arange(n_a) + np.concatenate([[0], j + 1])[group_a]] = ids_a.to_numpy() + self.n * ends_a
        codes[np.arange(n_b) + (i + 1)[group_b]] = ids_b.to_numpy() + 2 * self.n * ends_b
        owners_a, owners_b = of_a.to_numpy(), of_b.to_numpy()
        count_a, count_b, count = (np.bincount(x, minlength=n) for x in (owners_a, owners_b, owners_a[i]))
        groups = _joined(self.words.take(pa.array(codes)), count_a + count_b)
        links = pa.table({"text": owners_a[i], "a": ids_a.take(pa.array(i)), "b": ids_b.take(pa.array(j))})
        return {"whole": whole, "n_a": count_a, "n_b": count_b, "n_links": count, "groups": groups, "links": links}


def _joined(words: pa.LargeStringArray, counts: np.ndarray) -> list[bytes]:
    """The first words one after another, as many as the first count says, and so on: an array has its strings side by side already."""
    _, offsets, letters = words.buffers()
    cuts = np.frombuffer(offsets, np.int64)[: len(words) + 1][np.cumsum([0, *counts])].tolist() if len(words) else [0] * (len(counts) + 1)
    letters = memoryview(letters or b"")
    return [bytes(letters[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]


def _slices(texts: list[str | None], at_once: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `at_once` characters together, or of one."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        if k > start and size + len(text or "") > at_once:
            yield start, k
            start, size = k, 0
        size += len(text or "")
    if texts:
        yield start, len(texts)


def _aligned(align: Aligner, texts: list[str | None], keep: bool, at_once: int) -> dict[str, pa.Array]:
    """Columns for some texts; a long one is aligned part by part."""
    n = len(texts)
    parts = [(k, p) for k, t in enumerate(texts) if t for p in parts_of(f" {t}", at_once)]
    whole, counts = np.ones(n, bool), {c: np.zeros(n, np.int64) for c in ("n_a", "n_b", "n_links")}
    digests, kept = [hashlib.sha256() for _ in texts], [[] for _ in texts]
    links = [pa.table({"text": pa.array([], pa.int64()), "a": pa.array([], pa.int32()), "b": pa.array([], pa.int32()), "n": pa.array([], pa.int64())})]
    last = {k: x for x, (k, _) in enumerate(parts)}
    for start in range(0, len(parts), 1 if len(parts) > len(last) else max(1, len(parts))):
        some = parts[start : start + 1] if len(parts) > len(last) else parts
        of = np.array([k for k, _ in some])
        found = align([p for _, p in some])
        for x, (k, groups) in enumerate(zip(of.tolist(), found["groups"], strict=True)):
            whole[k] &= found["whole"][x]
            groups = groups[:-1] if last[k] == start + x else groups
            digests[k].update(groups)
            if keep:
                kept[k].append(groups)
        for c, total in counts.items():
            np.add.at(total, of, found[c])
        mine = found["links"].set_column(0, "text", pa.array(of[found["links"]["text"].to_numpy()], pa.int64()))
        links.append(_tally(mine, "count"))
    table = links[1] if len(links) == 2 else _tally(pa.concat_tables(links), "sum")
    table = table.filter(pa.array(whole).take(table["text"])).sort_by("text")
    offsets = pa.array(np.cumsum([0, *np.bincount(table["text"].to_numpy(), minlength=n)]), pa.int32())
    for total in counts.values():
        total[~whole] = 0
    aligned = [bool(t) and ok for t, ok in zip(texts, whole.tolist(), strict=True)]
    out = {c: pa.array(counts[c]) for c in ("n_a", "n_b")} | {c: pa.array(counts["n_links"]) for c in ("n_groups", "n_links")}
    out["groups_sha256"] = pa.array([d.hexdigest() if ok else "" for d, ok in zip(digests, aligned, strict=True)], pa.string())
    for c in "abn":
        out[f"link_{c}"] = pa.ListArray.from_arrays(offsets, table[c].combine_chunks())
    if keep:
        out["groups"] = pa.array([b"".join(g).decode() if ok else "" for g, ok in zip(kept, aligned, strict=True)], pa.string())
    return out


def _tally(links: pa.Table, how: str) -> pa.Table:
    """How often each text has each pair of ids."""
    counted = links.group_by(["text", "a", "b"], use_threads=False).aggregate([([], "count_all")] if how == "count" else [("n", "sum")])
    return counted.select(["text", "a", "b", "count_all" if how == "count" else "n_sum"]).rename_columns(["text", "a", "b", "n"])


def token_links(docs: DataFrame, a_path: str, b_path: str, keep: bool = False, id_col: str = "doc_id", text_col: str = "text", at_once: int = AT_ONCE) -> DataFrame:
    """Each text's numbers of tokens, groups and links, the digest of its groups (with `keep`, the groups too), and its distinct pairs of linked ids with
    how often it has each."""
    schema = TOKENS + (", groups string" if keep else "")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Aligner(a_path, b_path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for start, end in _slices(texts, at_once):
                columns = {"doc_id": batch["doc_id"].slice(start, end - start)} | _aligned(align, texts[start:end], keep, at_once)
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).alias("text")).mapInArrow(rows, schema)


def pair_counts(links: DataFrame) -> DataFrame:
    """a, b, count and best of each pair of ids: its links in all texts, and whether no pair of that b has more. Each batch's pairs are counted where they are; Spark adds
    up. One token of a pair is the end of the other, so there are at most as many pairs as the bytes of both vocabularies."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = pa.table({c: pc.list_flatten(batch[f"link_{c}"]) for c in "abn"})
            found = flat.group_by(["a", "b"], use_threads=False).aggregate([("n", "sum")]).select(["a", "b", "n_sum"]).rename_columns(["a", "b", "n"])
            yield from found.combine_chunks().to_batches()

    counts = links.select("link_a", "link_b", "link_n").mapInArrow(rows, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("b")))


def align_tokens(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, keep: bool = False, id_col: str = "doc_id", text_col: str = "text", at_once: int = AT_ONCE) -> DataFrame:
    """Aligns the tokens of a byte-level BPE (A, given a space and the text) and of a sentencepiece BPE (B, given the text, puts the space there itself).

    Byte offsets where tokens of both end cut them into groups; an A and a B token that end together are a link. A row for each text: doc_id, n_a and
    n_b (tokens), n_groups, n_links, n_best (links whose pair of ids is the most frequent one of its B id in all texts, ties included),
    count_sum (the pair's links in all texts, summed over the text's links), groups_sha256 (of `a1,a2|b1;a3|b2,b3`), and with `keep` the groups
    themselves. Special tokens' strings are plain text.

    Texts that are null or empty, or that the tokens of either side don't spell (U+2581 in the text reads as a space), have no tokens: zeros,
    and '' as digest. Repeated rows stay, a null id stays null, other columns go, an empty table gives no rows. Long texts are aligned in parts,
    cut where both tokenizers begin a word; a text without such a place is aligned as one.

    Pass one encodes and aligns on Arrow arrays and writes each text's pairs; pass two counts pairs, which the vocabularies bound; pass three looks
    the counts, broadcast, up for each text. Nothing is shuffled but partial counts.
    """
    links = write_table(token_links(docs, a_path or public_tokenizers.path("byte_bpe_50k.json"), b_path or public_tokenizers.path("piece_bpe_32k.model"), keep, id_col, text_col, at_once), "links")
    counts = pair_counts(links).toArrow()
    known = docs.sparkSession.sparkContext.broadcast((_pair(counts["a"], counts["b"]).to_numpy(), counts["count"].to_numpy(), counts["best"].to_numpy().astype(np.int64)))
    plain = ["doc_id", *COUNTS, "groups_sha256", *(["groups"] if keep else [])]
    schema = ", ".join(f"{c} {t}" for c, t in links.select(*plain).dtypes) + ", n_best long, count_sum long"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, count, best = known.value
        pairs = pa.array(pairs)
        for batch in batches:
            at = pc.index_in(_pair(pc.list_flatten(batch["link_a"]), pc.list_flatten(batch["link_b"])), value_set=pairs).to_numpy()
            times, text = pc.list_flatten(batch["link_n"]).to_numpy(), pc.list_parent_indices(batch["link_n"]).to_numpy()
            table = pa.table({"text": text, "best": times * best[at], "sum": times * count[at]}).group_by("text", use_threads=False).aggregate([("best", "sum"), ("sum", "sum")])
            sums = np.zeros((2, batch.num_rows), np.int64)
            sums[:, table["text"].to_numpy()] = table["best_sum"].to_numpy(), table["sum_sum"].to_numpy()
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in plain), pa.array(sums[0]), pa.array(sums[1])], [*plain, "n_best", "count_sum"])

    return links.mapInArrow(rows, schema)


def _pair(a: pa.Array, b: pa.Array) -> pa.Array:
    """Two ids as one number."""
    return pc.add(pc.multiply(a.cast(pa.int64()), pa.scalar(1 << 32)), b.cast(pa.int64()))
