"""Draws of numbers of tables against enumeration, from few to many customers."""

import numpy as np
import pytest

from strandframe.llm import tables


def exact_mean(c, weight, base, d):
    """By the recurrence over customers, with every number of tables."""
    x = np.full(c + 2, -np.inf)
    x[1], t = np.log(weight) + np.log(base), np.arange(c + 2)
    for n in range(1, c):
        with np.errstate(divide="ignore"):
            stay = x + np.log(np.maximum(n - d * t, 0))
            new = np.concatenate([[-np.inf], x[:-1] + np.log(weight + d * t[:-1]) + np.log(base)])
        x = np.logaddexp(stay, new)
    p = np.exp(x - x.max())
    return float((p * t).sum() / p.sum())


@pytest.mark.parametrize("c", [2, 40, 41, 80, 200, 1000, 1500, 4000])
@pytest.mark.parametrize(("weight", "base", "d"), [(100, 0.01, 0.8), (1000, 0.01, 0.8), (10, 0.3, 0.7), (1e5, 0.02, 0.6), (1, 1e-6, 0.95), (5, 0.9, 0.05)])
def test_mean_of_draws(c, weight, base, d):
    """Evenly spread chances give the mean without sampling error."""
    n = 4000
    drawn = tables.seat(np.full(n, c), np.full(n, float(weight)), np.full(n, base), d, (np.arange(n) + 0.5) / n)
    assert drawn.min() >= 1 and drawn.max() <= c
    assert abs(drawn.mean() / exact_mean(c, weight, base, d) - 1) < (0.003 if c <= tables.WHOLE else 0.025)


def test_draws_do_not_depend_on_their_neighbours():
    rng = np.random.default_rng(0)
    c = np.concatenate([rng.integers(0, 60, 500), rng.integers(1000, 300_000, 60)])
    weight, base, chance = rng.uniform(1, 1e4, len(c)), rng.uniform(1e-6, 0.2, len(c)), tables.noise(rng.integers(0, 2**63, len(c)).astype(np.uint64), 7)
    whole = tables.seat(c, weight, base, 0.75, chance)
    tables.table_logs.cache_clear()
    order = rng.permutation(len(c))
    apart = np.empty_like(whole)
    for part in np.array_split(order, 9):
        apart[part] = tables.seat(c[part], weight[part], base[part], 0.75, chance[part])
    assert (whole == apart).all() and (whole[c == 0] == 0).all() and (whole[c == 1] == 1).all()
    assert 0.4 < chance.mean() < 0.6 and len(set(chance.tolist())) == len(c)


def test_log_gamma():
    from math import lgamma

    x = np.array([1e-3, 0.05, 0.5, 1, 1.5, 7.9, 8, 100, 1e9])
    assert np.allclose(tables.log_gamma(x), [lgamma(v) for v in x], rtol=1e-11, atol=1e-11)


def test_scores_do_not_depend_on_buckets(spark):
    """Draws are keyed by word, so tables are the same however words are dealt out."""
    from strandframe.llm import language_model
    from strandframe.llm.common import load

    docs = load(spark, "/root/testdata/sf0.001", "documents")
    key = lambda r: r.doc_id
    few, many = (sorted(language_model.score(docs, buckets=b).collect(), key=key) for b in (5, 31))
    assert max(abs(x.score - y.score) for x, y in zip(few, many, strict=True)) < 1e-4
