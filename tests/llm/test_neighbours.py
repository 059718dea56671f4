"""Pruning, recall, repeated ids and products that overflow."""

import os

import numpy as np
import pytest

from strandframe.llm import neighbours
from strandframe.llm.queries import op2_nearest

SF = "/root/testdata/sf0.1"


def brute(ids, x, q, k):
    scores = np.einsum("d,nd->n", x[q], x)
    return [ids[i] for i in np.lexsort((ids, -scores)) if ids[i] != ids[q]][:k]


def clustered(rng, n, dim, clusters):
    centres = rng.normal(size=(clusters, dim))
    x = centres[rng.integers(clusters, size=n)] + rng.normal(size=(n, dim)) * 0.15
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def test_exact_search_prunes():
    """Where vectors have some structure, exact search leaves most of them out, and relaxed search still more."""
    rng = np.random.default_rng(3)
    x, ids, queries = clustered(rng, 8000, 32, 60), np.arange(8000), np.arange(0, 8000, 40)
    tree, share = neighbours.build_tree(ids, x), {}
    for relax in (1.0, 1.5, 2.5):
        search = neighbours.Search(tree, ids[queries], x[queries], 10, relax)
        at, found, _ = search.run()
        share[relax] = search.compared / (len(queries) * len(x))
        hits = sum(len(set(found[at == k].tolist()) & set(brute(ids, x, q, 10))) for k, q in enumerate(queries))
        print("relax", relax, "compared", share[relax], "recall", hits / (10 * len(queries)))
        assert hits == 10 * len(queries) if relax == 1 else hits >= 5 * len(queries)
    assert share[1.0] < 0.5 and share[2.5] < share[1.5] < share[1.0]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_recall_on_tables(spark):
    """Random directions are the worst case: all vectors are about equally far. Recall is 0.9 or more, and some are left out all the same."""
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in table]), np.array([r.embedding for r in table], float)
    found = {}
    for r in op2_nearest(spark, SF).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    queries = np.flatnonzero(ids % 20 == 0)
    recall = sum(len(found[int(ids[q])] & set(brute(ids, x, q, 20))) for q in queries) / (20 * len(queries))
    factor = neighbours.tune(ids[np.random.default_rng(1).permutation(len(ids))], x[np.random.default_rng(1).permutation(len(ids))], 20)
    search = neighbours.Search(neighbours.build_tree(ids, x), ids[queries], x[queries], 20, factor)
    search.run()
    print("recall", recall, "factor", factor, "compared", search.compared / (len(queries) * len(ids)))
    assert recall >= 0.9 and factor > 1 and search.compared < 0.97 * len(queries) * len(ids)


def test_repeats_and_overflow(spark):
    """Rows that share an id are one query and no candidates of it; equal rows are candidates each; products may be infinite."""
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, [-1e200, 1.0]), (20, [1e200, 3.0]), (20, [1e200, 3.0]), (40, [1e200, -1e200]), (41, [1e200, 1e200])]
    df = spark.createDataFrame([(i, v, "mine", 5) for i, v in rows], "vec_id long, embedding array<double>, dim string, shard int")
    for relax in (1.0, None):
        found = {}
        for r in sorted(neighbours.nearest(df, k=6, relax=relax).collect(), key=lambda r: (r.query_id, r.rank)):
            found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
        inf = float("inf")
        assert found[0] == [(1, 41, 1e200), (2, 20, 3.0), (3, 20, 3.0), (4, 1, 1.0), (5, 1, 1.0), (6, 2, 1.0)]
        assert [x[1:] for x in found[20]] == [(40, inf), (41, inf), (1, 2e200), (1, 2e200), (0, 1e200), (0, 3.0)]
        assert [x[1:] for x in found[40]] == [(20, inf), (20, inf), (0, 1e200), (1, 1e200), (1, 1e200), (0, -1e200)]
    assert neighbours.nearest(df.where("vec_id = 2")).count() == 0 and neighbours.nearest(df.limit(0)).count() == 0
