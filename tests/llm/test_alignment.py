"""Token alignment against plain Python over both libraries, with odd, long and repeated texts."""

import hashlib
from collections import Counter

import pytest
from public_tokenizers import path

from strandframe.llm import alignment
from strandframe.llm.common import load

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [None, "", " ", "  ", "\n", "a", " a", "a ", "a  ", "a\n  b", "a\n b", "a \n b", "a  \n  b  c", "\t\ta b 　c", "It's we'll 'tis", "<|endoftext|> <s> </s> <unk> <0x41>", "▁", "a▁b", "▁ a", "日本語 😀 ½ ²", "x" * 5000, "日" * 3000, "the the the", "the the the", "\x00 \x1c\x1d", "é É", "ﬁ Ⅳ Å", "1234567890 12 3", "…!?--- ---", "\x85  x", "a" + " " * 40 + "b" + " " * 3]


def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))


def brute(rows):
    a, b = libraries()
    letters = [c for c in range(256) if 33 <= c <= 126 or 161 <= c <= 172 or c >= 174]
    of = {chr(c): c for c in letters} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in letters)}
    found, counts = [], Counter()
    for doc_id, text in rows:
        want = b" " + (text or "").encode()
        ids_a, ids_b = (a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text, num_threads=1)) if text else ([], [])
        bytes_a = [bytes(of[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        groups, links = [], []
        if text and b"".join(bytes_a) == want == b"".join(bytes_b):
            i = j = at_a = at_b = 0
            first_a = first_b = 0
            while i < len(ids_a):
                if at_a <= at_b:
                    at_a, i = at_a + len(bytes_a[i]), i + 1
                while at_b < at_a:
                    at_b, j = at_b + len(bytes_b[j]), j + 1
                if at_a == at_b:
                    groups.append(",".join(map(str, ids_a[first_a:i])) + "|" + ",".join(map(str, ids_b[first_b:j])))
                    links.append((ids_a[i - 1], ids_b[j - 1]))
                    first_a, first_b = i, j
        else:
            ids_a = ids_b = []
        counts.update(links)
        found.append((doc_id, len(ids_a), len(ids_b), groups, links))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    return sorted(
        ((d, n_a, n_b, len(g), len(k), sum(counts[x] == best[x[1]] for x in k), sum(counts[x] for x in k), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, n_a, n_b, g, k in found),
        key=repr,
    )


@pytest.mark.parametrize("at_once", [1 << 20, 40])
def test_align_tokens(spark, at_once):
    """Also with long texts cut into many parts."""
    rows = list(enumerate(ODD)) + [(None, "no id"), (3, "the cat's  hat"), (3, "the cat's  hat"), (90, "Ein längerer Text,  mit vielen Wörtern; " * 60)]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n_a int, link_a string").repartition(3)
    found = alignment.align_tokens(docs, keep=True, at_once=at_once)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in found.collect()), key=repr) == brute(rows)
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in found.collect() if r.n_a)


def test_parts(spark):
    text = " " + "It's  a\n b and  so on, é " * 30
    assert "".join(alignment.parts_of(text, 20)) == text and len(alignment.parts_of(text, 20)) > 20
    align = alignment.Aligner(path("byte_bpe_50k.json"), path("piece_bpe_32k.model"))
    whole, cut = align([text]), align(alignment.parts_of(text, 20))
    assert b"".join(cut["groups"]) == whole["groups"][0] and cut["n_links"].sum() == whole["n_links"][0]


def test_whole_table(spark):
    docs = load(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r[c] for c in COLUMNS) for r in alignment.align_tokens(docs).collect()), key=repr) == brute(rows)


def test_names_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "`my``id` long, `te.xt` string")
    found = alignment.align_tokens(docs, id_col="my`id", text_col="te.xt").first()
    assert (found.doc_id, found.n_groups, found.n_best) == (1, 2, 2)
    assert alignment.align_tokens(docs.limit(0), id_col="my`id", text_col="te.xt").count() == 0


def test_memory_holds_short_units_only():
    units = alignment.byte_level(path("byte_bpe_50k.json"))
    units.tokens([" " + "日" * 5000 + f"{k} ab" for k in range(20)])
    assert " ab" in units.known and max(map(len, units.known)) <= alignment.SHORT
