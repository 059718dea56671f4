"""SimHash near-duplicates by an inverted index of byte positions with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free_name, named, write_table
from .components import connected_components

SHINGLE_WORDS = 4
SEED = 42
MAX_BITS = 4
BYTES = 8
#: Postings of a key that are compared in one go; a longer list is cut into chunks of about this size, compared pair by pair.
CHUNK = 2048
#: Shingles whose bits are counted at once.
AT_ONCE = 1 << 16
#: Near-copies: words of a shingle, 64-bit words of a wide fingerprint, bits in which two may differ, and bytes that they must share.
#: Texts whose sets of shingles have Jaccard similarity 0.8 differ in 15 % of the bits (78 of 512, give or take 8) and share 17 bytes of 64.
COPY_WORDS = 5
WIDE = 8
WIDE_BITS = 86
WIDE_SHARED = 5
#: A wide fingerprint's first byte positions (from 0) of the pairs of neighbours that it is posted under.
WIDE_PAIRS = [k for k in range(8 * WIDE) if k % 4 != 3]
#: Candidates for near-copies: bits in which two may differ (three standard deviations above the mean at similarity 0.8), posted under all
#: pairs of neighbouring bytes. Those that aren't near by the narrower bound are verified: Jaccard similarity of the sets of shingles of at least 4 / 5.
LOOSE_BITS = 104
LOOSE_PAIRS = list(range(8 * WIDE - 1))
#: Postings up to which a list of wide fingerprints is compared pair by pair, all such lists at once.
WIDE_SHORT = 8
#: Members up to which a group of candidates is compared in one go, and bytes of shingles in a chunk of a larger group.
GROUP = 1024
GROUP_BYTES = 1 << 25


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of each shingle, in order; a text with fewer words is one shingle, one without words has none."""
    tokens = (text or "").encode().lower().split()
    if len(tokens) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tokens), SEED)] if tokens else [], np.uint64)
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = [0, *ends[:-words].tolist()]
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[a:b], SEED) for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)], np.uint64)


def _majority(hashes: np.ndarray) -> np.ndarray:
    """The bits that are set in over half of the rows of hashes, as one row."""
    ones = np.zeros(64 * hashes.shape[1], np.int64)
    for k in range(0, len(hashes), AT_ONCE):
        some = np.ascontiguousarray(hashes[k : k + AT_ONCE], "<u8")
        bits = np.unpackbits(some.view(np.uint8).reshape(len(some), -1), axis=1, bitorder="little")
        for j in range(0, len(bits), 255):  # sums of 255 bits fit a byte
            ones += bits[j : j + 255].sum(axis=0, dtype=np.uint8)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")


def wide_fingerprint(text: str | None, words: int = COPY_WORDS) -> np.ndarray:
    """A SimHash of 64 * WIDE bits over the text's distinct shingles; zeros without words. Its first word comes from the shingles' XXH64,
    the others from that number mixed anew."""
    first = np.unique(shingle_hashes(text, words))
    if not len(first):
        return np.zeros(WIDE, np.uint64)
    columns = [first]
    for k in range(1, WIDE):
        x = first + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        columns.append(x ^ (x >> np.uint64(31)))
    return _majority(np.stack(columns, axis=1))


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The text's SimHash: a bit is 1 if it is set in over half of its shingles' XXH64."""
    hashes = shingle_hashes(text, words)
    return int(_majority(hashes.reshape(-1, 1))[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed 64-bit number) of each row; null texts and texts without words have 0. Texts with
    as many words as a shingle or fewer are one shingle."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x.as_py(), words) for x in batch["text"]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.int64())], ["doc_id", "fp"])

    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(rows, "doc_id long, fp long")


def index_keys(shared: int) -> list[tuple[int, ...]]:
    """Sets of byte positions such that any `shared` positions hold one: the classes of positions, as even as can be, of which some
    one has two or more (for two positions), or the sets of all `shared` positions."""
    if shared == 4:
        # Triples within a class of three, and pairs of a class with one of the next: 20 in all, the fewest that any four positions hold one of.
        classes = [(0, 1, 2), (3, 4, 5), (6, 7)]
        out = [c for c in classes if len(c) == 3]
        for k, c in enumerate(classes):
            out += [tuple(sorted((*pair, x))) for pair in combinations(c, 2) for x in classes[(k + 1) % 3]]
        return out
    return list(combinations(range(BYTES), shared))


def _byte(fp: Column, k: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * k).bitwiseAND(F.lit(255))


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """How many of the eight bytes of a XOR are zero."""
    return (x.view(np.uint8).reshape(*x.shape, BYTES) == 0).sum(axis=-1)


def _spanning(fps: np.ndarray, side: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what the pairs of a posting list connect: a breadth-first search, whose cost is one comparison with all that
    aren't reached yet. Pairs that share too few bytes are out by the count, the rest is verified. Members of a chunk paired with
    another are compared with that one only."""
    least = BYTES - max_bits
    links, left = [], np.arange(len(fps))
    two = len(np.unique(side)) > 1
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            x = fps[left] ^ fps[at]
            near = np.bitwise_count(x) <= max_bits
            if least > 0:
                near &= shared_bytes(x) >= least
            if two:
                near &= side[left] != side[at]
            for k in left[near]:
                links.append((int(fps[at]), int(fps[k])))
                queue.append(k)
            left = left[~near]
    return links


def _small(keys: np.ndarray, fps: np.ndarray, longest: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within short posting lists, which lie one after another: each posting with the next, the one after that, and so on."""
    a, b = [fps[:0]], [fps[:0]]
    for k in range(1, longest):
        same = np.flatnonzero(keys[k:] == keys[:-k])
        if not len(same):
            break
        x = fps[same] ^ fps[same + k]
        near = same[(shared_bytes(x) >= BYTES - max_bits) & (np.bitwise_count(x) <= max_bits)]
        a.append(fps[near])
        b.append(fps[near + k])
    return np.concatenate(a), np.concatenate(b)


SHORT = 32


def _linked(max_bits: int):
    def of(keys: np.ndarray, fps: np.ndarray, side: np.ndarray) -> pd.DataFrame:
        begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[begins, len(keys)])
        short = np.repeat(sizes <= SHORT, sizes)
        a, b = _small(keys[short], fps[short], SHORT, max_bits)
        links = []
        for k in np.flatnonzero(sizes > SHORT):
            part = slice(begins[k], begins[k] + sizes[k])
            links += _spanning(fps[part], side[part], max_bits)
        more = np.array(links, np.uint64).reshape(-1, 2)
        return pd.DataFrame({"a": np.r_[a, more[:, 0]].view(np.int64), "b": np.r_[b, more[:, 1]].view(np.int64)}).drop_duplicates()

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            keys = rest["list_key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last list may go on in the next batch
            if cut:
                done, rest = rest.iloc[:cut], rest.iloc[cut:].reset_index(drop=True)
                yield of(done["list_key"].to_numpy(), done["fp"].to_numpy().view(np.uint64), done["side"].to_numpy())
        if rest is not None and len(rest):
            yield of(rest["list_key"].to_numpy(), rest["fp"].to_numpy().view(np.uint64), rest["side"].to_numpy())

    return rows


def fingerprint_links(distinct_fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect distinct fingerprints (column fp) exactly as all pairs with at most max_bits differing bits do.

    Such a pair shares 8 - max_bits bytes in their places at least. So each fingerprint is posted under sets of byte positions of which
    any so many shared ones hold one, and each posting list is searched for pairs with enough shared bytes, which are then verified.
    From a list come only links that span what it connects, so a list of many alike gives no more links than postings. Lists longer than
    CHUNK are cut into chunks, and each pair of chunks is a list of its own: no task has a whole hot list, and no pair is missed.
    """
    if not 1 <= max_bits <= 6:
        raise ValueError("the index guarantees links of 1 to 6 bits")
    fp = F.col("fp")
    keys = [F.xxhash64(F.lit(k), *(_byte(fp, i) for i in places)) for k, places in enumerate(index_keys(BYTES - max_bits))]
    postings = distinct_fps.select("fp", F.explode(F.array(*keys)).alias("key"))
    hot = postings.groupBy("key").count().where(F.col("count") > CHUNK).select("key", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks"))
    hot = write_table(hot, "hot-keys")  # on file, so that Spark knows its size and can split the join if it must shuffle
    dealt = postings.join(hot, "key", "left").withColumn("own", F.pmod(F.xxhash64("fp"), F.coalesce("chunks", F.lit(1))).cast("int"))
    pairs = dealt.select("fp", "key", "own", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)).alias("other"))
    lists = pairs.select(
        "fp",
        F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("list_key"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
    )
    return lists.repartition("list_key").sortWithinPartitions("list_key", "fp").mapInPandas(_linked(max_bits), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links of at most max_bits differing bits.

    Rows with equal fingerprints are linked; those without words have fingerprint 0 and are linked like others. Repeated rows stay; rows
    with a null id stay and link, but never name a component unless all its ids are null (then component_id is null). An empty table
    gives an empty one; other columns go. Only distinct fingerprints are indexed and joined, so copies cost one fingerprint.
    """
    made = write_table(fingerprints(docs, words, id_col, text_col), "fingerprints")
    least = write_table(made.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = connected_components(fingerprint_links(least.select("fp"), max_bits))
    rooted = least.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    names = write_table(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "names")
    named = rooted.join(names, "root").select("fp", "component_id")
    return made.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def wide_fingerprints(docs: DataFrame, words: int = COPY_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and wide (the wide fingerprint's bytes) of each row with an id."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wide_fingerprint(x.as_py(), words).tobytes() for x in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(found, pa.binary())], ["doc_id", "wide"])

    named = docs.where(F.col(id_col).isNotNull())
    return named.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(rows, "doc_id long, wide binary")


def _near(x: np.ndarray, most: int = WIDE_BITS) -> np.ndarray:
    """Which rows of a XOR of wide fingerprints share enough bytes in their places and differ in few enough bits."""
    out = np.flatnonzero((x.view(np.uint8).reshape(len(x), -1) == 0).sum(axis=1, dtype=np.uint8) >= WIDE_SHARED)
    return out[np.bitwise_count(x[out]).sum(axis=1, dtype=np.uint16) <= most]


def _wide_spanning(fps: np.ndarray, side: np.ndarray, most: int, stars: bool) -> list[tuple[int, int]]:
    """Places of links that connect what the near pairs of a posting list connect, by a breadth-first search: each place with the one it is
    reached from or, for stars, with the first of those connected. In a list made of two chunks, pairs within one chunk are left to that
    chunk's own list."""
    links, left = [], np.arange(len(fps))
    two = len(np.unique(side)) > 1
    while len(left):
        first, left = left[0], left[1:]
        queue = [first]
        while queue and len(left):
            at = queue.pop()
            near = _near(fps[left] ^ fps[at], most)
            if two:
                near = near[side[left[near]] != side[at]]
            links += [(first if stars else at, k) for k in left[near]]
            queue += left[near].tolist()
            left = np.delete(left, near)
    return links


def _wide_links(lists: pd.DataFrame, most: int, stars: bool) -> pd.DataFrame:
    """Links within whole posting lists, which lie one after another: short lists pair by pair, all lists at once; long ones by search."""
    keys, nodes, side = (lists[c].to_numpy() for c in ("list_key", "node", "side"))
    fps = np.frombuffer(b"".join(lists["wide"]), "<u8").reshape(-1, WIDE)
    begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[begins, len(keys)])
    short = np.flatnonzero(np.repeat(sizes <= WIDE_SHORT, sizes))
    a, b = [nodes[:0]], [nodes[:0]]
    for k in range(1, WIDE_SHORT):
        same = np.flatnonzero(keys[short[k:]] == keys[short[:-k]]) if len(short) > k else short[:0]
        if not len(same):
            break
        for j in range(0, len(same), AT_ONCE):
            x, y = short[same[j : j + AT_ONCE]], short[same[j : j + AT_ONCE] + k]
            near = _near(fps[x] ^ fps[y], most)
            a.append(nodes[x[near]])
            b.append(nodes[y[near]])
    for k in np.flatnonzero(sizes > WIDE_SHORT):
        part = slice(begins[k], begins[k] + sizes[k])
        found = np.array(_wide_spanning(fps[part], side[part], most, stars), np.int64).reshape(-1, 2)
        a.append(nodes[part][found[:, 0]])
        b.append(nodes[part][found[:, 1]])
    a, b = np.concatenate(a), np.concatenate(b)
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def _by_lists(links_of):
    """Links within posting lists that come sorted, by a function of frames of whole lists."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            keys = rest["list_key"].to_numpy()
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last list may go on in the next batch
            if cut:
                yield links_of(rest.iloc[:cut])
                rest = rest.iloc[cut:].reset_index(drop=True)
        if rest is not None and len(rest):
            yield links_of(rest)

    return rows


def wide_links(distinct: DataFrame, places: list[int] = WIDE_PAIRS, most: int = WIDE_BITS, stars: bool = False) -> DataFrame:
    """Links (a, b) between rows (node, wide) whose wide fingerprints differ in at most `most` bits, found among those that share a
    pair of neighbouring bytes in its place, and counted by the bytes they share before bits are compared. With `stars`, what a list
    connects is linked with its smallest node, near or not: the same components by fewer different links.

    No number of shared bytes is sure at this distance, so the index is one of chance: a pair at similarity 0.8 shares one of WIDE_PAIRS
    with probability 0.96 and one of LOOSE_PAIRS with 0.98, one at 0.85 with 0.99 and 0.997. Long lists are cut into pairs of chunks as in fingerprint_links.
    """
    keys = [F.xxhash64(F.lit(k), F.expr(f"substring(wide, {k + 1}, 2)")) for k in places]
    keyed = distinct.select("node", "wide", F.array(*keys).alias("keys"))
    hot = distinct.select(F.explode(F.array(*keys)).alias("key")).groupBy("key").count().where(F.col("count") > CHUNK)
    hot = write_table(hot.select("key", F.ceil(F.col("count") / CHUNK).cast("int").alias("chunks")), "hot-keys")
    dealt = keyed.select("node", "wide", F.explode("keys").alias("key")).join(hot, "key", "left")
    dealt = dealt.withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    pairs = dealt.select("node", "wide", "key", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    side = F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side")
    lists = pairs.select("node", "wide", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("list_key"), side)
    return lists.repartition("list_key").sortWithinPartitions("list_key", "node").mapInPandas(_by_lists(lambda x: _wide_links(x, most, stars)), "a long, b long").distinct()


def _similar(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the other sets (sorted, not empty) have Jaccard similarity 0.8 or more with this one."""
    sizes = np.array([len(x) for x in others])
    flat = np.concatenate(others)
    met = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
    both = np.add.reduceat(met.astype(np.int64), np.cumsum(sizes) - sizes)
    return 5 * both >= 4 * (len(one) + sizes - both)


def _posted(x: np.ndarray) -> np.ndarray:
    """Which rows of a XOR of wide fingerprints differ in at most WIDE_BITS bits and share one of WIDE_PAIRS."""
    same = x.view(np.uint8).reshape(len(x), -1) == 0
    return (np.bitwise_count(x).sum(axis=1, dtype=np.uint16) <= WIDE_BITS) & (same[:, :-1] & same[:, 1:])[:, WIDE_PAIRS].any(axis=1)


def rare_links(docs: DataFrame, distinct: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """Links (a, b) that connect at least all nodes (of rows node, wide) whose sets of shingles have Jaccard similarity 0.8 or more.

    Of two such sets, ordered by how many texts have a shingle, the first n - ceil(4 n / 5) + 1 shingles share one. So each node is posted
    under these, and all nodes of a posting list are linked with its smallest: rows are counted, never gathered.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 64):
                some = batch.slice(k, 64)
                found = [np.unique(shingle_hashes(x.as_py(), words)).view(np.int64) for x in some["text"]]
                sizes = np.array([len(x) for x in found])
                columns = [np.repeat(np.array(some["node"]), sizes), np.repeat(sizes, sizes), np.concatenate(found)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "n", "shingle"])

    texts = docs.selectExpr(f"cast(`{id_col}` as bigint) as node", f"`{text_col}` as text").join(distinct.select("node"), "node", "left_semi")
    posted = write_table(texts.mapInArrow(rows, "node long, n long, shingle long"), "postings")
    often = posted.groupBy("shingle").agg(F.count("*").alias("often"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("often", "shingle"))
    prefix = posted.join(often, "shingle").withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * 0.8) + 1)
    prefix = write_table(prefix.where("often > 1").select("node", "shingle"), "prefixes")
    least = write_table(prefix.groupBy("shingle").agg(F.min("node").alias("a")), "least")
    return prefix.join(least, "shingle").select("a", F.col("node").alias("b")).where("a != b").distinct()


def _copy_links(lists: pd.DataFrame, most: int = LOOSE_BITS) -> pd.DataFrame:
    """Links that connect what the near-copies within whole lists connect, by a breadth-first search as in _wide_spanning."""
    keys, nodes, side = (lists[c].to_numpy() for c in ("list_key", "node", "side"))
    fps = np.frombuffer(b"".join(lists["wide"]), "<u8").reshape(-1, WIDE)
    sets = [np.frombuffer(x, "<u8") for x in lists["shingles"]]
    edges = np.r_[np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]), len(keys)]
    found: list[tuple[int, int]] = []
    for begin, end in zip(edges[:-1], edges[1:], strict=True):
        left = np.arange(begin, end)
        two = len(np.unique(side[begin:end])) > 1
        while len(left):
            queue, left = [left[0]], left[1:]
            while queue and len(left):
                at = queue.pop()
                near = _near(fps[left] ^ fps[at], most) if most < 64 * WIDE else np.arange(len(left))
                if two:
                    near = near[side[left[near]] != side[at]]
                if len(near):
                    is_copy = _posted(fps[left[near]] ^ fps[at])
                    rest = np.flatnonzero(~is_copy)
                    if len(rest):
                        is_copy[rest] = _similar(sets[at], [sets[k] for k in left[near[rest]]])
                    near = near[is_copy]
                found += [(nodes[at], nodes[k]) for k in left[near]]
                queue += left[near].tolist()
                left = np.delete(left, near)
    out = np.array(found, np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": out.min(axis=1, initial=2**63 - 1), "b": out.max(axis=1, initial=-(2**63))}).drop_duplicates()


def copy_links(texts: DataFrame, loose: DataFrame, words: int = COPY_WORDS, most: int = LOOSE_BITS) -> DataFrame:
    """Links (a, b) that connect what the near-copies within groups of candidates connect: rows (node, wide, root) of loose, whose sets of
    shingles are made anew from their texts (node, text). Near-copies have Jaccard similarity 0.8 or more, or are links of wide_links.

    Each set goes to its group once. A group of over GROUP members or GROUP_BYTES of shingles is cut into chunks of about GROUP members, but
    no more than a quarter of the root of its members, and each pair of chunks is a list of its own: no task has a whole large group, and no
    pair is missed.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 256):
                some = batch.slice(k, 256)
                found = [x.as_py() for x in some["text"]]
                wide = pa.array([wide_fingerprint(x, words).tobytes() for x in found], pa.binary())
                sets = pa.array([np.unique(shingle_hashes(x, words)).astype("<u8").tobytes() for x in found], pa.binary())
                yield pa.RecordBatch.from_arrays([some["node"], wide, sets], ["node", "wide", "shingles"])

    wanted = texts.join(loose.select("node").distinct(), "node", "left_semi").select("node", "text")
    made = wanted.mapInArrow(rows, "node long, wide binary, shingles binary").where("length(shingles) > 0").dropDuplicates(["node", "wide"])
    sets = write_table(made.join(loose, ["node", "wide"]), "shingles")
    n, size = F.count("*"), F.sum(F.length("shingles").cast("long"))
    large = sets.groupBy("root").agg(n.alias("n"), size.alias("size")).where((F.col("n") > GROUP) | (F.col("size") > GROUP_BYTES))
    large = large.select("root", F.greatest(F.least(F.ceil(F.sqrt("n") / 4), F.ceil(F.col("n") / GROUP)), F.ceil(F.col("size") / GROUP_BYTES)).cast("int").alias("chunks"))
    dealt = sets.join(write_table(large, "large"), "root", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    pairs = dealt.select("node", "wide", "shingles", "root", "own", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    side = F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side")
    lists = pairs.select("node", "wide", "shingles", F.xxhash64("root", F.least("own", "other"), F.greatest("own", "other")).alias("list_key"), side)
    return lists.repartition("list_key").sortWithinPartitions("list_key", "node").mapInPandas(_by_lists(lambda x: _copy_links(x, most)), "a long, b long").distinct()


def near_copies(docs: DataFrame, words: int = COPY_WORDS, id_col: str = "doc_id", text_col: str = "text", exact: bool = False) -> DataFrame:
    """doc_id and component_id, the smallest doc_id reachable over pairs whose sets of shingles have Jaccard similarity 0.8 or more, or whose
    wide fingerprints differ in at most WIDE_BITS bits and share one of WIDE_PAIRS (that alone takes in some pairs at 0.7 to 0.8).

    Candidates are groups linked by wide fingerprints that differ in at most LOOSE_BITS bits; within a group, sets of shingles are compared.
    That index is one of chance (see wide_links). With `exact`, rare shingles are posted too and all pairs of a group are compared: no
    pair at 0.8 or more is lost, but texts that share rare passages then make groups whose work grows with their square.

    Rows with equal fingerprints are linked, those without words among them; rows with a null id are left out. Only distinct
    fingerprints are indexed. Repeated rows stay; an empty table gives an empty one.
    """
    made = write_table(wide_fingerprints(docs, words, id_col, text_col), "wide")
    least = write_table(made.groupBy("wide").agg(F.min("doc_id").alias("node")), "distinct")
    links = wide_links(least, LOOSE_PAIRS, LOOSE_BITS, stars=True)
    if exact:
        links = links.union(rare_links(docs, least, words, id_col, text_col))
    loose = write_table(connected_components(links), "loose")
    texts = docs.selectExpr(f"cast(`{id_col}` as bigint) as node", f"`{text_col}` as text")
    roots = connected_components(copy_links(texts, least.join(loose, "node"), words, 64 * WIDE if exact else LOOSE_BITS)).where("node != root")
    named_by = least.join(write_table(roots, "roots"), "node", "left").select("wide", F.coalesce("root", "node").alias("component_id"))
    return made.join(named_by, "wide").select("doc_id", "component_id")


def keep_one(docs: DataFrame, words: int = COPY_WORDS, id_col: str = "doc_id", text_col: str = "text", exact: bool = False) -> DataFrame:
    """One row of each group of near-copies, with all columns of docs, whatever their names and types: the one with the smallest id.

    Ids should be unique: of rows that share a kept id, the first one by its text and then by its other columns as JSON stays. Rows with a
    null id, which no group is named by, all stay. Null and empty texts are copies of each other, repeated rows too; an empty table stays so.
    """
    found = near_copies(docs, words, id_col, text_col, exact)
    kept_id, copies, place = (free_name(x, docs.columns) for x in ("kept_id", "copies", "place"))
    ids = docs.groupBy(named(id_col).cast("long").alias(kept_id)).agg(F.count("*").alias(copies))
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias(kept_id)).distinct().join(ids, kept_id)
    keep = write_table(keep, "kept")
    match = named(id_col).cast("long") == F.col(kept_id)
    single = docs.join(keep.where(F.col(copies) == 1), match, "left_semi")
    order = Window.partitionBy(named(id_col)).orderBy(named(text_col), F.to_json(F.struct(*(named(c) for c in docs.columns))))
    repeated = docs.join(keep.where(F.col(copies) > 1), match, "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).drop(place)
    return single.union(repeated).union(docs.where(named(id_col).isNull()))
