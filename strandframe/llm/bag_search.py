"""Ranked lexical search over classes of documents that are alike in the items' words: each class is scored once."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import named, write_table

TOP = 50
#: Bytes of the items' terms (each with 64 more) that one pass over the documents searches for; more items are searched in further passes.
BLOCK_BYTES = 16 << 20
#: Bytes of text whose terms are listed at once, and sums that are formed at once.
AT_ONCE, PAIRS_AT_ONCE = 1 << 20, 1 << 21
#: Bytes of bags that may be broadcast; beyond, rows and chosen classes meet in a shuffle with so many salts.
BROADCAST_BYTES, SALTS = 32 << 20, 64
#: What a byte becomes: A-Z small, digits and the bytes of other characters as they are, all else a blank.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def term_lists(text: bytes, at_once: int = AT_ONCE) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in order, some at a time: runs of ASCII letters, digits and all characters beyond ASCII, A-Z made small."""
    folded, start = text.translate(FOLD), 0
    while start < len(folded):
        end = folded.find(b" ", start + at_once)
        end = len(folded) if end < 0 else end
        yield folded[start:end].split()
        start = end


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The distinct pairs (item_id, term)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                for terms in term_lists(text.as_py() or b""):
                    found = list(set(terms))
                    yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(found), pa.int64()), pa.array(found, pa.binary())], ["item_id", "term"])

    some = items.select(named(item_col).cast("long").alias("item_id"), named(text_col).cast("binary").alias("text"))
    return some.mapInArrow(rows, "item_id long, term binary").distinct()


def bags(docs: DataFrame, terms: list[bytes], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (all terms of the text, with repeats) and bag of each document that has a term. The bag holds the numbers of its terms among `terms`, ascending,
    then how often each occurs, as 32-bit integers."""
    known = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(terms)})

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value.get
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                ids, sizes, found = [], [], []
                some = batch.slice(start, 500)
                for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"], strict=True):
                    tally, n = Counter(), 0
                    for listed in term_lists(text.as_py() or b""):
                        n += len(listed)
                        tally.update(map(number, listed))
                    if n:
                        tally.pop(None, None)
                        keys = sorted(tally)
                        ids.append(doc_id)
                        sizes.append(n)
                        found.append(np.array([*keys, *map(tally.__getitem__, keys)], "<i4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(found, pa.binary())], ["doc_id", "n", "bag"])

    some = docs.select(named(id_col).cast("long").alias("doc_id"), named(text_col).cast("binary").alias("text"))
    return some.mapInArrow(rows, "doc_id long, n long, bag binary")


def _document_counts(found: DataFrame, n_terms: int) -> np.ndarray:
    """In how many bags each term is: a count for each partition's terms, added up by Spark; as many rows as terms reach the driver."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            for bag in batch["bag"]:
                pairs = np.frombuffer(bag.as_py(), "<i4")
                total[pairs[: len(pairs) // 2]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in found.select("bag").mapInArrow(rows, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r["term"]] = r["df"]
    return out


class _Best:
    """The k best classes of each item so far, by descending score, then by their smallest doc_id (null last)."""

    def __init__(self, k: int, n_items: int):
        self.k, self.bound = k, np.zeros(n_items, np.int64)
        self.kept: list[tuple[np.ndarray, ...]] = []
        self.size, self.most = 0, 4 * k * n_items + 100_000

    def add(self, scores: np.ndarray, first: np.ndarray, absent: np.ndarray, classes: np.ndarray) -> None:
        row, item = np.nonzero((scores > 0) & (scores >= self.bound))
        self.kept.append((item, scores[row, item], absent[row], first[row], classes[row]))
        self.size += len(row)
        if self.size > self.most:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        item, score, absent, first, classes = (np.concatenate(c) for c in zip(*self.kept, strict=True))
        order = np.lexsort((classes, first, absent, -score, item))
        columns = tuple(c[order] for c in (item, score, absent, first, classes))
        starts = np.flatnonzero(np.diff(columns[0], prepend=-1))
        place = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
        last = place == self.k - 1
        self.bound[columns[0][last]] = columns[1][last]
        self.kept = [tuple(c[place < self.k] for c in columns)]
        self.size = len(self.kept[0][0])
        return self.kept[0]


def _scored(classes: DataFrame, pairs: list[tuple[int, int]], n_items: int, weights: np.ndarray, k: int) -> DataFrame:
    """The k best classes of each item in each partition: item, score, first_id, class_id. The best k documents lie in the best k classes by (score, smallest doc_id), as
    each class before a document's own has a document before it."""
    terms, items = np.array(pairs, np.int64).reshape(-1, 2)[:, ::-1].T
    order = np.argsort(terms, kind="stable")
    starts = np.searchsorted(terms[order], np.arange(len(weights) + 1))
    known = classes.sparkSession.sparkContext.broadcast((items[order], starts, weights))

    def sums(rows: list[np.ndarray], slack: np.ndarray) -> np.ndarray:
        """Scores of some bags (their terms and counts) for all items."""
        items, starts, weights = known.value
        sizes = [len(r) // 2 for r in rows]
        at = np.repeat(np.arange(len(rows)), sizes)
        term = np.concatenate([r[:n] for r, n in zip(rows, sizes, strict=True)])
        tf = np.concatenate([r[n:] for r, n in zip(rows, sizes, strict=True)]).astype(np.int64)
        gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * slack[at]))
        n = starts[term + 1] - starts[term]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[term], n)
        out = np.zeros(len(rows) * n_items, np.int64)
        np.add.at(out, np.repeat(at, n) * n_items + items[place], np.repeat(gain, n))
        return out.reshape(len(rows), n_items)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Rows such that neither their sums nor the table of scores are many."""
        _, starts, _ = known.value
        for batch in batches:
            rows, size, begin = [], 0, 0
            for j, bag in enumerate(batch["bag"]):
                row = np.frombuffer(bag.as_py(), "<i4")
                term = row[: len(row) // 2]
                rows.append(row)
                size += n_items + int((starts[term + 1] - starts[term]).sum())
                if size > PAIRS_AT_ONCE or j == batch.num_rows - 1:
                    yield rows, batch.slice(begin, j + 1 - begin)
                    rows, size, begin = [], 0, j + 1

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _Best(k, n_items)
        for rows, some in chunks(batches):
            first = some["first_id"]
            found.add(sums(rows, some["m"].to_numpy()), first.fill_null(0).to_numpy(), first.is_null().to_numpy(zero_copy_only=False), some["class_id"].to_numpy())
        if found.kept:
            item, score, absent, first, chosen = found.cut()
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(score), pa.array(first, mask=absent), pa.array(chosen)], ["item", "score", "first_id", "class_id"])

    return classes.select("class_id", "first_id", "bag", "m").mapInArrow(best, "item long, score long, first_id long, class_id long")


def _top(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= k)


def _search_block(docs: DataFrame, item_ids: list, pairs: list[tuple[int, int]], terms: list[bytes], k: int, id_col: str, text_col: str) -> DataFrame:
    """search() for the items of one block: item numbers and term numbers in `pairs`."""
    spark = docs.sparkSession
    names = spark.createDataFrame(list(enumerate(item_ids)), "item long, item_id long")
    found = write_table(bags(docs, terms, id_col, text_col), "bags")
    totals = found.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("words")).first()
    documents, words = totals["documents"], totals["words"] or 1
    df = _document_counts(found, len(terms))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1))) for n in df], np.int64)

    m = F.expr(f"100 - 50 + cast((cast(50 * n as decimal(19, 0)) * cast({documents} as decimal(18, 0))) div cast({words} as decimal(38, 0)) as bigint)")
    keyed = found.where(F.length("bag") > 0).withColumn("m", m).withColumn("hash", F.unhex(F.md5(F.concat("bag", F.encode(F.col("m").cast("string"), "utf-8")))))
    same = ["hash", "bag", "m"]  # the hash deals rows out, bag and m verify it
    classes = keyed.groupBy(*same).agg(F.min("doc_id").alias("first_id"))
    classes = write_table(classes.withColumn("class_id", F.monotonically_increasing_id()), "classes")

    ranked = [F.desc("score"), F.asc_nulls_last("first_id"), F.asc("class_id")]
    scored = _scored(classes, pairs, len(item_ids), weights, k).withColumn("salt", F.shiftright("class_id", 33) % SALTS)
    chosen = write_table(_top(_top(scored, ["item", "salt"], ranked, k), ["item"], ranked, k).select("item", "score", "class_id"), "chosen")
    ids = F.broadcast(chosen.select("class_id").distinct())  # k times the block's items at most
    wanted = write_table(classes.join(ids, "class_id").select("class_id", *same), "wanted")
    size = wanted.agg(F.sum(F.length("bag") + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        members = keyed.join(F.broadcast(wanted), same)
    else:
        salted = keyed.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        members = salted.join(wanted.withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)"))), [*same, "salt"])
    members = _top(members.select("class_id", "doc_id"), ["class_id"], [F.asc_nulls_last("doc_id")], k).drop("place")
    rows = chosen.join(F.broadcast(members), "class_id") if len(item_ids) * k * k <= 1 << 20 else chosen.join(members, "class_id")
    out = _top(rows, ["item"], [F.desc("score"), F.asc_nulls_last("doc_id")], k)
    return out.join(F.broadcast(names), "item").select("item_id", F.col("place").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k documents of highest score for each item: item_id, rank (from 1), doc_id, score; fewer, if fewer score above 0. Equal scores stand by ascending doc_id.

    Terms are runs of ASCII letters, digits and any characters beyond ASCII, A-Z made small. With N documents that have a term, L terms in them, n
    terms of one, df documents with a term and tf of it in one: weight w = floor(1000 ln((2 N + 2) / (2 df + 1))), m = 50 + 50 n N div L, and
    the score is the sum of w * (10^9 tf div (1000 tf + 20 m)) over the item's distinct terms.

    Each text is cut down to its bag: the items' words in it and their counts. Documents of equal bag and m have equal scores; they are found by a 128-bit
    hash of both, which bag and m themselves confirm, and each such class is scored once. A task keeps k classes an item, so the memory
    needed depends on the items only. The members of the classes chosen are then looked up, k of each by doc_id.

    Items are searched in blocks of terms, each in passes of its own, so what is broadcast is bounded. Rows of items that share an id are one
    item with the terms of all; a null id is one too. Repeated rows of docs are documents of their own, and a null doc_id comes last. Null
    and empty texts, and any without a term, match nothing and count for nothing; an empty table of either kind gives no rows. Long texts
    are read in pieces. Other columns go, whatever their names.
    """
    spark = docs.sparkSession
    wanted = write_table(item_terms(items, item_col, item_text_col), "item-terms")
    size = wanted.agg(F.sum(F.length("term") + 64)).first()[0] or 0
    n_blocks = -(-size // block_bytes)
    parts = []
    for block in range(n_blocks):
        some = wanted if n_blocks == 1 else wanted.where(F.pmod(F.coalesce(F.xxhash64("item_id"), F.lit(0)), F.lit(n_blocks)) == block)
        item_numbers: dict[int | None, int] = {}
        term_numbers: dict[bytes, int] = {}
        pairs = [(item_numbers.setdefault(r["item_id"], len(item_numbers)), term_numbers.setdefault(bytes(r["term"]), len(term_numbers))) for r in some.toLocalIterator()]
        if pairs:
            parts.append(_search_block(docs, list(item_numbers), pairs, list(term_numbers), k, id_col, text_col))
    out = parts[0] if parts else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
