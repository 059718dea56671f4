"""Approximate nearest neighbours by inner product: vantage-point trees per shard with relaxed triangle-inequality pruning."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import named, write_table

#: Most vectors in a shard's tree, most bytes of their components, and vectors from which there are several shards, up to FEW.
SHARD_ROWS = 65_536
SHARD_BYTES = 1 << 26
SPLIT_ROWS, FEW = 2048, 8
#: Queries that a task answers about its shard at most, and tasks that there should be; with more queries, or fewer shards and queries enough, there are several tasks for a shard.
TASK_QUERIES, TASKS = 1 << 18, 48
#: Queries that go down a tree together, and vectors in a leaf.
AT_ONCE = 4096
LEAF = 64
#: Vectors after which what queries have met is merged into what they hold, at most.
STRETCH = 2048
#: A subtree is skipped if its least possible distance times a factor is over the distance of the k-th found; 1 is exact. How much a factor
#: loses depends on the vectors, so None takes the largest of FACTORS that keeps RECALL of the neighbours of a sample: at most
#: SAMPLE_ROWS vectors (and SAMPLE_BYTES of components) of the most frequent length, and SAMPLE_QUERIES of these as queries.
RELAX: float | None = None
FACTORS = (1.0, 1.25, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 10.0, 12.0, 16.0)
RECALL = 0.95
SAMPLE_ROWS, SAMPLE_QUERIES, SAMPLE_BYTES = 4096, 128, 1 << 24
#: Slack for rounding in distances, relative to the largest squared length.
SLACK = 1e-9
FOUND = "query_id long, vec_id long, score double"


def build_tree(ids: np.ndarray, vectors: np.ndarray, copies: np.ndarray | None = None, most: int = 64, leaf: int = LEAF) -> dict:
    """A vantage-point tree over vectors made longer by one component, such that distances to (query, 0) order as inner products do. Equal
    vectors are one, which has the `most` smallest of their ids (one more than are asked for), each as often as it has copies.

    Nodes are (begin, end, near, far, near's bounds, far's bounds) over the vectors in tree order; a node's vantage point comes first, then
    the near and the far half. The halves are cut by rank, so that equal distances can't unbalance them. Vectors whose squared lengths
    aren't finite numbers have no distances: a tree with such a vector is one leaf."""
    copies = np.ones(len(ids), np.int64) if copies is None else np.minimum(copies, most)
    vectors = np.ascontiguousarray(vectors + 0.0)  # -0 is 0
    _, first, group = np.unique(vectors.view(f"V{vectors.itemsize * vectors.shape[1]}").ravel(), return_index=True, return_inverse=True)
    ids, group, vectors = np.repeat(ids, copies), np.repeat(group, copies), vectors[first]
    by = np.lexsort((ids, group))
    ids, group = ids[by], group[by]
    begins = np.searchsorted(group, np.arange(len(vectors)))
    sizes = np.minimum(np.diff(np.r_[begins, len(ids)]), most)
    with np.errstate(over="ignore"):
        squares = (vectors**2).sum(axis=1)
    top = float(squares.max())
    if not math.isfinite(top):
        squares, top, leaf = np.zeros(len(vectors)), 0.0, len(vectors)
    x = np.c_[vectors, np.sqrt(np.maximum(top - squares, 0))]
    order = np.argsort(ids[begins], kind="stable")
    rng = np.random.default_rng(len(vectors))
    nodes: list[list] = []
    todo = [(0, len(vectors), -1, 0)]
    while todo:
        begin, end, above, which = todo.pop()
        at = len(nodes)
        if above >= 0:
            nodes[above][which] = at
        nodes.append([begin, end, -1, -1, 0.0, 0.0, 0.0, 0.0])
        if end - begin <= leaf:
            continue
        pick = begin + int(rng.integers(end - begin))
        order[[begin, pick]] = order[[pick, begin]]
        rest = order[begin + 1 : end]
        d = np.sqrt(((x[rest] - x[order[begin]]) ** 2).sum(axis=1))
        by = np.argsort(d, kind="stable")
        order[begin + 1 : end], d = rest[by], d[by]
        half = len(d) // 2
        nodes[at][4:] = [d[0], d[half - 1], d[half], d[-1]]
        todo += [(begin + 1, begin + 1 + half, at, 2), (begin + 1 + half, end, at, 3)]
    return {"ids": ids, "begins": begins[order], "sizes": sizes[order], "vectors": vectors[order], "last": x[order, -1], "top": top, "nodes": nodes}


class Search:
    """The k best of a tree for some queries. Each goes down to the leaf on its side first, for a bound; then all go through the tree together, so that a node is
    visited once with whoever can't skip it by then. What is found is merged where a stretch of the tree ends, wherever the queries come from, so that what one
    finds doesn't depend on the others. `compared` counts the pairs of query and vector that were compared."""

    def __init__(self, tree: dict, query_ids: np.ndarray, queries: np.ndarray, k: int, relax: float):
        self.tree, self.qids, self.q, self.k, self.relax, self.compared = tree, query_ids, queries, k, relax, 0
        with np.errstate(over="ignore"):
            self.lengths = (queries**2).sum(axis=1)
        self.slack = SLACK * (1 + tree["top"] + self.lengths)
        self.endless = ~np.isfinite(self.lengths)  # these have no distances and skip nothing
        self.scores = np.full((len(queries), k), -np.inf)
        self.ids = np.zeros((len(queries), k), np.int64)
        self.held = np.zeros((len(queries), k), bool)
        self.met: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def reach(self, rows: np.ndarray) -> np.ndarray:
        """A subtree is skipped if its least possible distance is over this: the distance of the k-th found, by the factor."""
        with np.errstate(invalid="ignore"):
            square = self.lengths[rows] + self.tree["top"] - 2 * self.scores[rows, -1]
        bound = np.sqrt(np.maximum(square, 0) + self.slack[rows]) / self.relax + np.sqrt(self.slack[rows])
        return np.where(np.isfinite(square) & ~self.endless[rows], bound, np.inf)

    def offer(self, rows: np.ndarray, begin: int, end: int) -> np.ndarray:
        """Compares queries with a stretch of vectors and returns the products. Those that can't matter are left as the fast product has them; others are exact
        sums taken alike, for each id of a vector. A query's own id and products that aren't numbers are left out."""
        self.compared += len(rows) * (end - begin)
        vectors = self.tree["vectors"][begin:end]
        with np.errstate(invalid="ignore", over="ignore"):
            least = self.scores[rows, -1] - self.slack[rows]
            products = (self.q if len(rows) == len(self.q) else self.q[rows]) @ vectors.T
            i, j = np.divmod(np.flatnonzero(~(products < np.where(np.isnan(least), -np.inf, least)[:, None])), end - begin)
            exact = np.einsum("nd,nd->n", self.q[rows[i]], vectors[j])
        if len(i):
            sizes = self.tree["sizes"][begin + j]
            place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.tree["begins"][begin + j], sizes)
            i, exact, ids = rows[np.repeat(i, sizes)], np.repeat(exact, sizes), self.tree["ids"][place]
            real = ~np.isnan(exact) & (ids != self.qids[i])
            self.met.append((i[real], exact[real], ids[real]))
        return products

    def merge(self) -> None:
        """Of a query's candidates met since the last time and those held so far, by score and id, the first k stay."""
        if not self.met:
            return
        (i, exact, ids), self.met = map(np.concatenate, zip(*self.met, strict=True)), []
        r, row = np.unique(i, return_inverse=True)
        line, held = np.r_[row, np.repeat(np.arange(len(r)), self.k)], np.r_[np.ones(len(row), bool), self.held[r].ravel()]
        score, of = np.r_[exact, self.scores[r].ravel()], np.r_[ids, self.ids[r].ravel()]
        order = np.lexsort((of, -score, ~held, line))
        best = order[np.searchsorted(line[order], np.arange(len(r)))[:, None] + np.arange(self.k)]
        self.scores[r], self.ids[r], self.held[r] = score[best], of[best], held[best]

    def distance(self, rows: np.ndarray, products: np.ndarray) -> np.ndarray:
        """Of queries from the vector that they have these products with: all vectors are equally long by their last component."""
        with np.errstate(invalid="ignore"):
            return np.sqrt(np.maximum(self.lengths[rows] + self.tree["top"] - 2 * products, 0))

    def leaves(self) -> np.ndarray:
        """Has each query meet the leaf that it comes to by staying on its side of each node; returns these nodes."""
        nodes, own = self.tree["nodes"], np.zeros(len(self.q), np.int64)
        todo = [(0, np.arange(len(self.q)))]
        while todo:
            at, rows = todo.pop()
            begin, end, near, far, *bounds = nodes[at]
            if near < 0:
                self.offer(rows, begin, end)
                own[rows] = at
                continue
            with np.errstate(invalid="ignore", over="ignore"):
                to_near = self.distance(rows, self.q[rows] @ self.tree["vectors"][begin]) <= (bounds[1] + bounds[2]) / 2
            todo += [(child, rows[side]) for child, side in ((far, ~to_near), (near, to_near)) if side.any()]
        self.merge()
        return own

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's place, vec_id, score) of what was found, nearest first for each query."""
        nodes, own, marks = self.tree["nodes"], self.leaves(), stretches(len(self.tree["vectors"]))
        todo, last = [(0, np.arange(len(self.q)), np.zeros(len(self.q)))], 0
        while todo:
            at, rows, least = todo.pop()
            begin, end, near, far, *bounds = nodes[at]
            if (stretch := np.searchsorted(marks, begin, "right")) != last:
                self.merge()
                last = stretch
            rows = rows[least <= self.reach(rows)]
            if near < 0:
                rows = rows[own[rows] != at]
                if len(rows):
                    self.offer(rows, begin, end)
                continue
            if not len(rows):
                continue
            d = self.distance(rows, self.offer(rows, begin, begin + 1)[:, 0])
            d[self.endless[rows]] = 0
            todo += [(child, rows, np.maximum(low - d, d - high)) for child, low, high in ((far, *bounds[2:]), (near, *bounds[:2]))]
        self.merge()
        i, j = np.nonzero(self.held)
        return i, self.ids[i, j], self.scores[i, j]


def stretches(n: int) -> np.ndarray:
    """Where what was met is merged: often at first, when bounds fall fast, and every STRETCH vectors at least."""
    marks, at = [], LEAF
    while at < n:
        marks.append(at)
        at += min(at // 4, STRETCH)
    return np.array(marks, np.int64)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and vec of the rows whose vector is not null, empty or zero and has only finite components."""
    vec = df.select(named(id_col).cast("long").alias("vec_id"), named(vector_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vec.where(F.col("vec_id").isNotNull() & (F.size("vec") > 0) & finite & F.exists("vec", lambda x: x != 0)).withColumn("dim", F.size("vec"))


def tune(ids: np.ndarray, vectors: np.ndarray, k: int) -> float:
    """The largest of FACTORS that finds RECALL of the k nearest of each of the first SAMPLE_QUERIES rows (half of the rows at most) among the others, found by comparing
    with all. A query isn't in the tree, as it is in one shard of all only: in its own tree it would come straight to its neighbours."""
    n = min(SAMPLE_QUERIES, len(ids) // 2)
    if not n:
        return 1.0
    some, tree = slice(0, n), build_tree(ids[n:], vectors[n:], most=k + 1)
    wanted = set(zip(*(x.tolist() for x in Search(tree, ids[some], vectors[some], k, 1.0).run()[:2]), strict=True))
    best = 1.0
    for factor in FACTORS[1:]:
        found = set(zip(*(x.tolist() for x in Search(tree, ids[some], vectors[some], k, factor).run()[:2]), strict=True))
        if len(found & wanted) < RECALL * len(wanted):
            break
        best = factor
    return best


def _tuned(rows: DataFrame, k: int) -> float:
    usual = rows.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if usual is None:
        return 1.0
    most = min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * usual["dim"]))
    some = rows.where(F.col("dim") == usual["dim"]).orderBy(F.xxhash64("vec_id", "vec", F.lit(3)), "vec_id", "vec").select("vec_id", "vec").limit(max(2, most)).collect()
    return tune(np.array([r["vec_id"] for r in some], np.int64), np.array([r["vec"] for r in some], np.float64), k)


def _searched(k: int, relax: float):
    """Answers a partition's queries. Rows come sorted by task; a task's vectors come first and become a tree, its queries after them
    are answered as they come, so that memory holds one shard and one batch of queries."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, vectors, tree = None, [], None
        for batch in batches:
            key = np.stack([np.asarray(batch[c]) for c in ("dim", "shard", "turn", "is_query")], axis=1)
            edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)] if len(key) else []
            for begin, end in zip(edges[:-1], edges[1:], strict=True):
                part, task = batch.slice(begin, end - begin), key[begin, :3].tolist()
                if task != held:
                    held, vectors, tree = task, [], None
                ids, copies = np.asarray(part["vec_id"]), np.asarray(part["copies"])
                x = part["vec"].flatten().to_numpy(zero_copy_only=False).reshape(end - begin, task[0])
                if not key[begin, 3]:
                    vectors.append((ids, x, copies))
                    continue
                if vectors:
                    tree, vectors = build_tree(*map(np.concatenate, zip(*vectors, strict=True)), most=k + 1), []
                for start in range(0, len(ids) if tree else 0, AT_ONCE):
                    some = ids[start : start + AT_ONCE]
                    at, found, scores = Search(tree, some, x[start : start + AT_ONCE], k, relax).run()
                    yield pa.RecordBatch.from_arrays([pa.array(some[at]), pa.array(found), pa.array(scores)], ["query_id", "vec_id", "score"])

    return rows


def nearest(
    df: DataFrame, k: int = 20, every: int = 20, relax: float | None = RELAX, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS
) -> DataFrame:
    """For each row whose id is divisible by `every`, the k rows with the largest inner product among all rows with another id.

    Returns query_id, rank (from 1), vec_id and score (the inner product in double precision); ties go to the smaller id, queries with
    fewer candidates get fewer rows. Rows with a null id, and vectors that are null, empty, zero or have null or non-finite components take
    no part; vectors of different lengths aren't compared. Products may overflow to an infinity, which counts as such; pairs whose products
    are no number are left out. Repeated rows are candidates each. Ids should be unique: rows that share one are one query, by the smallest of
    their vectors (component by component), and no candidates of it. Other columns go, and an empty table gives an empty one.

    With relax 1 the result is exact. Larger factors skip more and may lose neighbours; None tunes the factor on a sample (see RELAX).

    Rows are dealt to shards by hash, equal ones as one row with a count, so that no shard outgrows a task. A task makes a tree of its shard's
    vectors and then answers queries as they stream by. All queries go to all shards (and shards to several tasks where queries are many);
    trees are never sent. Each task has a partition of its own. Only the best k of each shard are shuffled, and ranked with a limit taken before the shuffle.
    """
    clean = usable(df, id_col, vector_col)
    rows = write_table(clean.groupBy("dim", "vec_id", "vec").agg(F.count("*").alias("copies")), "vectors")
    n, dim = rows.agg(F.count("*"), F.max("dim")).first()
    most = max(LEAF, min(shard_rows, SHARD_BYTES // (8 * (dim or 1))))
    shards = max(math.ceil(n / most), min(FEW, math.ceil(n / SPLIT_ROWS)), 1)
    turns = max(1, math.ceil(n / every / TASK_QUERIES), min(math.ceil(n / every / AT_ONCE), math.ceil(TASKS / shards)))
    each = lambda name, count: F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
    dealt = lambda seed, count: F.pmod(F.xxhash64("vec_id", "vec", F.lit(seed)), F.lit(count)).cast("int")
    vectors = rows.select("dim", dealt(1, shards).alias("shard"), each("turn", turns), F.lit(0).alias("is_query"), "vec_id", "vec", "copies")
    asked = rows.where(F.col("vec_id") % every == 0).groupBy("dim", "vec_id").agg(F.min("vec").alias("vec"))
    first = Window.partitionBy("vec_id").orderBy("vec")
    asked = asked.withColumn("place", F.row_number().over(first)).where("place = 1")
    asked = asked.select("dim", each("shard", shards), dealt(2, turns).alias("turn"), F.lit(1).alias("is_query"), "vec_id", "vec", F.lit(1).cast("long").alias("copies"))
    task = ["dim", "shard", "turn"]
    together = vectors.union(asked).repartitionById(shards * turns, F.col("shard") * turns + F.col("turn")).sortWithinPartitions(*task, "is_query")
    found = together.mapInArrow(_searched(k, _tuned(rows, k) if relax is None else relax), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
