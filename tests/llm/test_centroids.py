import hashlib
import math
import random

import numpy as np
import pytest

from lithos.llm import centroids
from lithos.llm.centroids import Params

DDL = "vec_id long, embedding array<double>"


def brute(rows, p):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == p.dims and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(p.scale * x) for x in v]))
    named = sorted((hashlib.sha256(f"{p.seed}:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)
    where = [q for _, q in named[: p.clusters]]
    if not where:
        return []
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda q: min((dist(q, c), k) for k, c in enumerate(where))
    for _ in range(p.rounds):
        own = [nearest(q)[1] for _, q in kept]
        for k in range(len(where)):
            mine = [q for (_, q), o in zip(kept, own) if o == k]
            if mine:
                where[k] = [sum(c) // len(mine) for c in zip(*mine)]
    last = [nearest(q) for _, q in kept]
    sums = [sum(d for d, o in last if o == k) for k in range(len(where))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in where]
    return sorted(((i, k, d, sums[k], sum(sums), digest[k]) for (i, _), (d, k) in zip(kept, last)), key=str)


def got(df, p):
    return sorted(map(tuple, centroids.clustered(df, p).collect()), key=str)


@pytest.mark.parametrize("clusters,listed,dims", [(8, 3, 4), (5, 1, 3), (20, 4, 6), (3, 9, 2), (1, 3, 2)])
def test_against_brute_force(spark, clusters, listed, dims):
    rnd = random.Random(clusters)
    p = Params(dims=dims, clusters=clusters, listed=listed, rounds=6, block_rows=37)
    rows = [(i, [rnd.gauss(rnd.randrange(6), 0.4) for _ in range(dims)]) for i in range(260)]
    rows += [(300 + i, [0.5] * dims) for i in range(50)] + [(rows[9][0], rows[9][1])] * 5 + [(3, [-2.0] * dims), (None, [1.0] * dims), (None, [9.0] * dims)]
    rows += [(400, None), (401, [None] * dims), (402, [float("nan")] * dims), (403, [float("inf")] * dims), (404, [1.0] * (dims + 1)), (405, [])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], f"{DDL}, cluster int, distance string").repartition(3)
    assert got(df, p) == brute(rows, p)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(spark):
    p = Params(dims=1, clusters=4, rounds=3, scale=1)
    rows = [(i, [float(x)]) for i, x in enumerate([0, 0, 2, 2, 1, 1, -3, 7])]
    df = spark.createDataFrame(rows, DDL)
    assert got(df, p) == brute(rows, p)
    same = [(i, [1.5]) for i in range(9)]
    assert got(spark.createDataFrame(same, DDL), p) == brute(same, p)


def test_few_none_and_floats(spark):
    p = Params(dims=2)
    df = spark.createDataFrame([(5, [1.0, -1.0])], "vec_id long, embedding array<float>")
    assert got(df, p) == brute([(5, [1.0, -1.0])], p)
    assert got(df.limit(0), p) == [] and got(spark.createDataFrame([(None, [1.0, 2.0])], DDL), p) == []
    assert centroids.clustered(df.limit(0), p).dtypes == centroids.clustered(df, p).dtypes


def test_components_of_any_size(spark):
    rnd = random.Random(2)
    p = Params(dims=3, clusters=4, rounds=4, scale=1)
    rows = [(i, [rnd.uniform(-1, 1) * 2.0 ** rnd.randrange(30) for _ in range(3)]) for i in range(80)]
    assert got(spark.createDataFrame(rows, DDL), p) == brute(rows, p)
    with pytest.raises(Exception, match="62 bits"):
        centroids.clustered(spark.createDataFrame([(0, [1e30, 0.0, 0.0])], DDL), p).collect()
    far = [(i, [x, 0.0, 0.0]) for i, x in enumerate([2.0**40, -(2.0**40), 2.0**50])]
    with pytest.raises(Exception, match="63 bits|64 bits|out of range|OVERFLOW"):
        centroids.clustered(spark.createDataFrame(far, DDL), Params(dims=3, clusters=1, scale=1)).collect()


def test_bounds_certify_most_vectors_and_never_wrongly():
    rng = np.random.default_rng(5)
    q = np.concatenate([rng.normal(m, 60, (400, 8)) for m in rng.normal(0, 900, (12, 8))]).astype(np.int64)
    where = q[rng.choice(len(q), 12, replace=False)].copy()
    state = np.zeros(len(q), centroids._state_type(12, 3))
    centroids.measure(q, where, state, np.arange(len(q)))
    measured = 0
    for _ in range(12):
        new = np.array([q[state["own"] == k].mean(0).astype(int) if (state["own"] == k).any() else where[k] for k in range(12)])
        centroids.moved_bounds(state, np.sqrt(((new - where) ** 2).sum(1)))
        where = new
        some, every = centroids.certify(q, where, state)
        measured += every
        d = centroids.squared(q, where)
        assert (state["own"] == d.argmin(1)).all()
        root = np.sqrt(d)
        assert (state["upper"] >= root[np.arange(len(q)), state["own"]]).all()
        assert (state["lower"] <= np.take_along_axis(root, state["near"].astype(int), 1)).all()
        rest = root.copy()
        np.put_along_axis(rest, np.concatenate([state["own"][:, None], state["near"]], 1).astype(int), np.inf, 1)
        assert (state["rest"] <= rest.min(1)).all()
    assert measured < 0.35 * 12 * len(q)
