"""Ranked search against plain Python, with nulls, ties, repeats, classes of many members, long texts and several blocks."""

import math
import random
import re
from collections import Counter

import pytest

from strandframe.llm import bag_search

DOCS = "doc_id long, text string, n int, bag string, m int, hash string, score int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, words in wanted.items():
        scores = []
        for d, b, n in bags:
            m = 50 + 50 * n * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 20 * m)) for t in words if t in b)
            if score > 0:
                scores.append((-score, d is None, d if d is not None else 0))
        out += [(item, r, None if absent else d, -s) for r, (s, absent, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def table():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(60)] + ["ÉTÉ", "été", "日本", "I", "i", "İ"]
    rows = [(i, " ".join(rnd.choice(vocab) + rnd.choice(["", ",", "  ", "\x1c"]) for _ in range(rnd.randint(0, 12)))) for i in range(400)]
    rows += [(None, "w1 w2"), (None, "w1 w2"), (7, "w1 w2"), (7, rows[7][1]), (900, None), (901, ""), (902, " ,. "), (903, "w3 " * 400_000 + "w4"), (-4, "W1\tW2"), (-3, "w1-w2!")]
    return rows + [(10_000 + 7 * i % 997, "w5 w6 w6 other") for i in range(300)]


ITEMS = [(1, "w1 W2 w2"), (2, "w5, w6"), (3, "été ÉTÉ i İ"), (4, None), (5, ""), (6, "nothing known"), (7, "w3 w4"), (8, "other w10 w11 w12 w13"), (8, "w14"), (8, "w14"), (None, "w20 日本"), (9, "w59 " * 3000)]


@pytest.mark.parametrize("blocks", [1, 4])
@pytest.mark.parametrize("spread", [False, True])
def test_search(spark, blocks, spread, monkeypatch):
    if spread:  # classes and rows meet in a shuffle, sums run in small pieces
        monkeypatch.setattr(bag_search, "BROADCAST_BYTES", 0)
        monkeypatch.setattr(bag_search, "PAIRS_AT_ONCE", 50)
    rows = table()
    docs = spark.createDataFrame([(d, t, 1, "b", 2, "h", 3) for d, t in rows], DOCS).repartition(6)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = bag_search.search(docs, items, 20, **({"block_bytes": 500} if blocks > 1 else {}))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(rows, ITEMS, 20)


def test_cut_keeps_the_bound():
    best = bag_search._Best(2, 2)
    import numpy as np

    no = np.zeros(4, bool)
    best.add(np.array([[5, 0], [7, 1], [5, 0], [1, 0]]), np.array([4, 3, 2, 1]), no, np.arange(4))
    item, score, _, first, _ = best.cut()
    assert list(zip(item.tolist(), score.tolist(), first.tolist(), strict=True)) == [(0, 7, 3), (0, 5, 2), (1, 1, 3)]
    assert best.bound.tolist() == [5, 0]
    best.add(np.array([[5, 3], [4, 2], [0, 0], [0, 0]]), np.array([0, 9, 9, 9]), no, np.arange(4, 8))
    item, score, _, first, _ = best.cut()
    assert list(zip(item.tolist(), score.tolist(), first.tolist(), strict=True)) == [(0, 7, 3), (0, 5, 0), (1, 3, 0), (1, 2, 9)]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "`my id` long, `te.xt` string"), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    names = {"id_col": "my id", "text_col": "te.xt"}
    assert [tuple(r)[:3] for r in bag_search.search(docs, items, **names).collect()] == [(1, 1, 1)]
    assert bag_search.search(docs.limit(0), items, **names).count() == 0
    assert bag_search.search(docs, items.limit(0), **names).count() == 0


def test_pieces_of_long_texts():
    text = ("Ab1 " * 50 + "é-").encode() * 20
    assert [t for some in bag_search.term_lists(text, 64) for t in some] == [t.encode() for t in terms(text.decode())]
