import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lithos.llm import bit_sliced


def brute(rows, k, modulus, kind=np.float32):
    kept = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(64 * float(kind(x))) for x in v]))
    out = []
    for n, (i, q) in enumerate(kept):
        if i % modulus == 0:
            found = sorted((-sum(a * b for a, b in zip(q, o)), j) for m, (j, o) in enumerate(kept) if m != n and len(o) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


def test_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, [0.5, -0.25, 0.0, 1.0, -1.0, 0.1, 0.1, 0.1]) for i in range(60)] + [(400, [0.0] * 8), (401, [-1.0] * 8), (402, [90.0] * 8)]
    rows += [(500, None), (505, [None] * 8), (510, [float("nan")] * 8), (515, [float("inf")] * 8), (520, [0.5] * 3), (525, [0.25] * 3), (5, [0.9] * 8), (5, rows[5][1]), (None, [0.1] * 8)]
    df = spark.createDataFrame([(i, v, 1, "z") for i, v in rows], "vec_id long, embedding array<float>, rank int, block string")
    p = bit_sliced.Params(k=7, block_rows=70, group_rows=11)
    got = bit_sliced.search(df, F.col("vec_id") % 5 == 0, p)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7, 5)


def test_fewer_rows_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [-2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in bit_sliced.search(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, -8192)]
    assert bit_sliced.search(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_sums_are_exact():
    rng = np.random.default_rng(1)
    values = rng.integers(-70, 71, (200, 16))
    block = bit_sliced._block(np.arange(200), np.arange(200), values)
    for q in (rng.integers(-64, 65, 16), np.zeros(16, int), np.full(16, -64)):
        sums = bit_sliced.scores(block, q.tolist())
        ids, found = bit_sliced.top(block, sums, 200, None)
        assert len(ids) == 200 and (found == values[ids] @ q).all()


def test_components_of_any_size_are_exact(spark):
    rnd = random.Random(8)
    rows = [(0, [1.0, 0.5]), (1, [2.0**20, 1.0]), (2, [3.0, -(2.0**30)]), (3, [2.0**40, 0.25]), (4, [-(2.0**36), 2.0**41])]
    rows += [(5 + i, [rnd.uniform(-1, 1) * 2.0 ** rnd.randrange(20), rnd.uniform(-1, 1)]) for i in range(30)] + [(7, [0.0, 0.0]), (40, [-1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = bit_sliced.search(df, F.col("vec_id").isin(0, 40), bit_sliced.Params(k=6, block_rows=9)).collect()
    want = [r for r in brute(rows, 6, 1, float) if r[0] in (0, 40)]
    assert sorted(map(tuple, got)) == want and got[0].query_id == 0
    with pytest.raises(Exception, match="64 bits"):
        bit_sliced.search(spark.createDataFrame([(0, [1.0]), (1, [1e30])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()
    with pytest.raises(Exception, match="64 bits"):
        bit_sliced.search(spark.createDataFrame([(0, [2.0**40]), (1, [2.0**40])], "vec_id long, embedding array<double>"), F.col("vec_id") == 0).collect()


def test_vectors_without_components(spark):
    df = spark.createDataFrame([(0, []), (1, []), (2, [1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in bit_sliced.search(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 0)]
