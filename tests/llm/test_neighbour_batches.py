"""Queries go through a tree together: what that costs, and that it changes nothing for any of them."""

import numpy as np
import pyarrow as pa

from strandframe.llm import neighbours


class Counted(neighbours.Search):
    calls = 0

    def offer(self, *args):
        self.calls += 1
        return super().offer(*args)


def test_nodes_are_visited_once():
    """Comparisons with a node's vectors are one call for all queries, and one more for a leaf's own queries, in whatever order queries would rather go."""
    rng = np.random.default_rng(5)
    x, ids = rng.normal(size=(6000, 16)), np.arange(6000)
    tree = neighbours.build_tree(ids, x)
    search = Counted(tree, ids[:2000], x[:2000], 10, 4.0)
    search.run()
    assert search.calls <= 2 * len(tree["nodes"])


def test_found_alone_or_together():
    rng = np.random.default_rng(6)
    x, ids = rng.normal(size=(3000, 12)), np.arange(3000)
    tree = neighbours.build_tree(ids, x)
    for relax in (1.0, 5.0):
        at, found, scores = neighbours.Search(tree, ids[:40], x[:40], 10, relax).run()
        for k in range(40):
            _, alone, its = neighbours.Search(tree, ids[k : k + 1], x[k : k + 1], 10, relax).run()
            assert alone.tolist() == found[at == k].tolist() and its.tolist() == scores[at == k].tolist()
            if relax == 1:
                by = np.lexsort((ids, -np.einsum("d,nd->n", x[k], x)))
                assert alone.tolist() == by[by != k][:10].tolist()


def test_queries_longer_than_any_number():
    """A query whose squared length is infinite has no distances; it skips nothing of a tree that has some."""
    rng = np.random.default_rng(7)
    x, ids = rng.normal(size=(500, 4)), np.arange(500)
    q = np.array([[1e200, 0, 0, 0], [0, 1.0, 0, 0]])
    at, found, _ = neighbours.Search(neighbours.build_tree(ids, x), np.array([-1, -2]), q, 5, 3.0).run()
    assert found[at == 0].tolist() == np.argsort(-x[:, 0])[:5].tolist()


def test_tasks_have_partitions_of_their_own(spark, monkeypatch):
    """Tasks that are dealt by hash to as many partitions meet in some and leave others empty."""

    def tasks(k, relax):
        def rows(batches):
            met = {(int(shard), int(turn)) for b in batches for shard, turn in zip(b["shard"], b["turn"], strict=True)}
            yield pa.RecordBatch.from_pydict({"query_id": [min(met)[0] if met else -1], "vec_id": [len(met)], "score": [0.0]})

        return rows

    monkeypatch.setattr(neighbours, "_searched", lambda k, relax: tasks(k, relax))
    rng = np.random.default_rng(8)
    df = spark.createDataFrame(list(enumerate(rng.normal(size=(1200, 4)).tolist())), "vec_id long, embedding array<double>")
    assert sorted((r.query_id, r.vec_id) for r in neighbours.nearest(df, k=2, relax=1.0, shard_rows=100).collect()) == [(shard, 1) for shard in range(12)]
