"""BPE encoding and decoding by a tokenization automaton that merge gadgets build."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Encoded pieces of text that a worker remembers, and the letters up to which it does; when there are more it starts anew.
REMEMBERED, SHORT = 500_000, 64
#: Most parts: letters and marks that PATTERN takes as one word each.
PLAIN = re.compile("( ?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*#$%&|]*)")
#: White space, as a set's content: Unicode's property, which Python's own pattern \\s widens.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The initial state; the others are tokens.
START = (1 << 20) - 1
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Where a text is split before merging: the fixed pattern of byte-level vocabularies.
PATTERN = public_tokenizers.PATTERN


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Automaton:
    """A deterministic automaton over tokens that accepts exactly the sequences that BPE yields.

    It begins with one state and a loop for each byte. Merge k, of tokens u and v into x, puts a gadget in: the arc v leaves the state
    that u leads to; x gets an arc wherever u has one; and x leads to a copy of the state that v led to just before. A state is the last
    token read; `made`, `left` and `right` hold the gadgets in order. A state's row of transitions, one bit for each token, is
    compiled in whole when the state is first entered, and kept: there are no more rows than tokens. From then on, reading is by table.
    The arcs are labelled with tokens, not with single bytes: as every beginning of a word is spelt by one path only, the transition at each byte is the one token
    ending there whose arc the table has, and no arc has to be gone back on.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        of_letter = {c: b for b, c in enumerate(byte_letters())}
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        n = max([*vocab.values(), *self.special.values()]) + 1
        self.labels: list[bytes] = [b""] * n
        for token, i in vocab.items():
            self.labels[i] = bytes(of_letter[c] for c in token)
        for token, i in self.special.items():
            self.labels[i] = token.encode()
        #: Step at which a token's gadget was put in (bytes: -1), and the tokens that it joins.
        made, left, right = [-1] * n, [-1] * n, [-1] * n
        pairs: dict[tuple[int, int], int] = {}
        ok = [len(x) == 1 for x in self.labels]

        def joined(u: int, v: int, until: int) -> bool:
            """Whether the arc v leaves the state u once the gadgets before step `until` are in: the later one of the two is undone until both are bytes."""
            while pairs.get((u, v), until) >= until:
                a, b = made[u], made[v]
                if a < 0 and b < 0:
                    return True
                if a > b:
                    u, until = right[u], a
                else:
                    v, until = left[v], b + 1
            return False

        #: The arcs that merges took away from each state, with their steps.
        self.taken: dict[int, list[tuple[int, int]]] = {}
        for step, merge in enumerate(model["merges"]):
            x, y = merge.split(" ") if isinstance(merge, str) else merge
            u, v, w = vocab[x], vocab[y], vocab[x + y]
            if (u, v) in pairs or made[w] >= 0 or not (ok[u] and ok[v] and joined(u, v, step)):
                continue  # an arc that isn't there has no gadget
            pairs[u, v] = step
            self.taken.setdefault(u, []).append((v, step))
            made[w], left[w], right[w], ok[w] = step, u, v, True
        self.made, self.left, self.right = np.array(made), np.array(left), np.array(right)
        self.bytes = np.array([i for i in vocab.values() if len(self.labels[i]) == 1])
        #: Tokens with gadgets by how often their left parts can be taken, each level by step; and those that have a token as left part.
        depth = np.zeros(n, np.int64)
        order = np.argsort(self.made, kind="stable")
        order = order[self.made[order] >= 0]
        for w in order.tolist():
            depth[w] = depth[left[w]] + 1
        self.levels = [order[depth[order] == d] for d in range(1, int(depth.max()) + 1)]
        by = order[np.argsort(self.left[order], kind="stable")]
        cuts = np.flatnonzero(np.diff(self.left[by], prepend=-1))
        self.begun = dict(zip(self.left[by[cuts]].tolist(), np.split(by, cuts[1:]), strict=True))
        self.rows: dict[int, bytes] = {}
        #: Tokens by their bytes read backwards: nested dictionaries with the token under None.
        self.ends: dict = {}
        for i in vocab.values():
            if ok[i]:
                node = self.ends
                for x in reversed(self.labels[i]):
                    node = node.setdefault(x, {})
                node[None] = i

    def row(self, state: int) -> bytes:
        """The tokens that may follow, as bits. Those from before the state's own gadget are those of its right part's state as it was then; each
        later one is there if its left part was when it was made."""
        found = self.rows.get(state)
        if found is not None:
            return found
        n, step = len(self.labels), int(self.made[state]) if state != START else -1
        if step < 0:
            arcs = np.zeros(n, bool)
            arcs[self.bytes] = True
        else:
            of = int(self.right[state])
            arcs = np.unpackbits(np.frombuffer(self.row(of), np.uint8), count=n, bitorder="little").astype(bool)
            for token, when in self.taken.get(of, ()):
                if when >= step:
                    arcs[token] = True
        gone, mine = np.zeros(n, bool), self.taken.get(state, ())
        for token, when in mine:
            later = self.begun.get(token)
            if later is not None:
                gone[later[self.made[later] >= when]] = True
        for level in self.levels:
            later = level[np.searchsorted(self.made[level], step) :]
            arcs[later] = arcs[self.left[later]] & ~gone[later]
        for token, _ in mine:
            arcs[token] = False
        found = self.rows[state] = np.packbits(arcs, bitorder="little").tobytes()
        return found

    def encode(self, word: bytes) -> list[int]:
        """The one path through the automaton that spells the word. Every beginning of the word is spelt by one path, so one token ends at each
        place: the one, among those that the bytes before end with, that the state where it begins has an arc for."""
        rows, row, last, begins = self.rows, [self.row(START)], [START], [0]
        for end in range(1, len(word) + 1):
            node, at = self.ends, end
            while True:
                at -= 1
                node = node[word[at]]
                token = node.get(None)
                if token is not None and row[at][token >> 3] >> (token & 7) & 1:
                    break
            last.append(token)
            begins.append(at)
            row.append(rows.get(token) or self.row(token))
        path, at = [], len(word)
        while at:
            path.append(last[at])
            at = begins[at]
        return path[::-1]


class Known(dict):
    """What a function gives for pieces of text; a new piece is worked out and, if it is short, remembered, and a full memory starts anew."""

    def __init__(self, function, most: int):
        self.function, self.most = function, most

    def __missing__(self, piece: str) -> str:
        found = self.function(piece)
        if len(piece) <= SHORT:
            if len(self) >= self.most:
                self.clear()
            self[piece] = found
        return found


class Codec:
    """Encodes and decodes whole texts; special tokens' strings in a text are those tokens, as in the tokenizers library. Ids are
    decimal text here, each with a comma after it."""

    def __init__(self, path: str):
        self.automaton = Automaton(path)
        self.words = regex.compile(PATTERN)
        #: Parts in which every word lies whole: a run without white space and the blank before it, or white space as PATTERN cuts it.
        self.parts = re.compile(f" ?[^{BLANKS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+")
        special = self.automaton.special
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")")
        self.spelt = Known(lambda word: "".join(f"{i}," for i in self.automaton.encode(word.encode())), REMEMBERED // 2)
        self.known = Known(self._part, REMEMBERED)
        self.emits = {str(i): label for i, label in enumerate(self.automaton.labels)}

    def _part(self, part: str) -> str:
        plain = PLAIN.fullmatch(part)
        words = filter(None, plain.groups()) if plain else self.words.findall(part)
        return "".join(map(self.spelt.__getitem__, words))

    def encode_text(self, text: str) -> str:
        """Decimal ids joined by commas."""
        if any(map(text.__contains__, self.automaton.special)):
            stretches = self.specials.split(text)
        else:
            stretches = [text]
        out = [f"{self.automaton.special[x]}," if k % 2 else "".join(map(self.known.__getitem__, self.parts.findall(x))) for k, x in enumerate(stretches)]
        return "".join(out)[:-1]

    def encode(self, text: str) -> list[int]:
        found = self.encode_text(text)
        return list(map(int, found.split(","))) if found else []

    def decode_text(self, ids: str) -> str:
        """The labels of the arcs, one after another, read as UTF-8 (bytes that are none become the replacement character)."""
        return b"".join(map(self.emits.__getitem__, ids.split(","))).decode("utf-8", "replace") if ids else ""

    def decode(self, ids: list[int]) -> str:
        return self.decode_text(",".join(map(str, ids)))


@lru_cache(maxsize=2)
def codec_of(path: str) -> Codec:
    """A worker's codec: tasks that run one after another share its table and memory."""
    return Codec(path)


def _coded(path: str, keep: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                counts, of_ids, of_text, all_ids, decoded = [], [], [], [], []
                for text in some["text"]:
                    ids = codec.encode_text(text.as_py() or "")
                    back = codec.decode_text(ids)
                    if keep:
                        all_ids.append(list(map(int, ids.split(","))) if ids else [])
                        decoded.append(back)
                    counts.append(ids.count(",") + 1 if ids else 0)
                    of_ids.append(hashlib.sha256(ids.encode()).hexdigest())
                    of_text.append(hashlib.sha256(back.encode()).hexdigest())
                columns, names = [some["doc_id"], pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep:
                    columns, names = columns + [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], [*names, "ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows


def encode_texts(docs: DataFrame, tokenizer_path: str | None = None, keep: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each whole text's ids by the automaton, decoded again: count and digests, and with `keep` the ids and the decoded text.

    A null text counts as empty: no ids, and the digests of the empty text. Repeated rows stay, a null id stays null, other columns go, an empty table gives no
    rows. Texts of any length are encoded whole; pieces of over SHORT letters aren't remembered. One pass, no shuffle.
    """
    path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    schema = SCHEMA + (", ids array<int>, decoded string" if keep else "")
    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(_coded(path, keep), schema)
