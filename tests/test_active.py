import numpy as np
import pytest

from lithos.operators import active


def full(x, y):
    """A model from nothing, by damped Newton steps."""
    f, w = np.c_[x, np.ones(len(x))], np.zeros(x.shape[1] + 1)
    loss = lambda v: np.logaddexp(0, f @ v).sum() - y @ (f @ v) + v @ v / 2
    for _ in range(300):
        q = 1 / (1 + np.exp(-np.clip(f @ w, -30, 30)))
        step = np.linalg.solve((f * (q * (1 - q))[:, None]).T @ f + np.eye(len(w)), f.T @ (q - y) + w)
        w = w - step * max((t for t in (1, 0.5, 0.1, 0.01) if loss(w - t * step) <= loss(w)), default=0)
    return w


def outcomes(x, y, pool, points, low=0.3, high=0.7):
    out = {}
    for i, p in points.items():
        pair = []
        for a in (0, 1):
            q = 1 / (1 + np.exp(-(np.c_[pool, np.ones(len(pool))] @ full(np.vstack([x, p]), np.append(y, a)))))
            pair.append(int(((q < low) | (q > high)).sum()))
        out[i] = tuple(pair)
    return out


def case(seed, n=25, pool=160, candidates=40, d=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    y = (x[:, 0] + 0.5 * rng.normal(size=n) > 0).astype(int)
    return x, y, rng.normal(size=(pool, d)) * 0.8, {i * 3 + 1: p for i, p in enumerate(rng.normal(size=(candidates, d)))}


def frames(spark, x, y, pool, points):
    return (
        spark.createDataFrame([(p.tolist(), int(a)) for p, a in zip(x, y)], "x array<double>, y int"),
        spark.createDataFrame([(p.tolist(), "z") for p in pool], "x array<double>, n string").repartition(3),
        spark.createDataFrame([(i, p.tolist(), 1) for i, p in points.items()], "id long, x array<double>, w int"),
    )


def test_one_more_row_is_the_full_fit():
    rng = np.random.default_rng(3)
    for d in (1, 5, 20):
        x, y = rng.normal(size=(30, d)) * 3, rng.integers(0, 2, 30)
        session = active.Session(x, y.astype(float))
        assert np.allclose(session.w, full(x, y), atol=1e-9)
        for a in (0, 1):
            p = rng.normal(size=d) * 4
            assert np.allclose(session.refitted(np.append(p, 1.0), a), full(np.vstack([x, p]), np.append(y, a)), atol=1e-8)


def test_what_if_counts(spark):
    x, y, pool, points = case(1, candidates=12)
    got = {r.id: (r.if_0, r.if_1) for r in active.what_if(*frames(spark, x, y, pool, points)).collect()}
    assert got == outcomes(x, y, pool, points)


@pytest.mark.parametrize("seed", [2, 5])
def test_picks_of_the_queue_are_those_of_fitting_all(spark, seed, monkeypatch):
    x, y, pool, points = case(seed)
    fitted = []
    models = active._models
    monkeypatch.setattr(active, "_models", lambda t, c, m: fitted.append(c.count()) or models(t, c, m))
    got = active.greedy(*frames(spark, x, y, pool, points), 4, at_once=10)
    want, left = [], dict(points)
    for _ in range(4):
        found = outcomes(x, y, pool, left)
        best = min(left, key=lambda i: (-min(found[i]), i))
        want.append((best, min(found[best])))
        x, y = np.vstack([x, left.pop(best)]), np.append(y, int(found[best][1] > found[best][0]))
    assert got == want and sum(fitted) < 4 * len(points)


def test_bounds_of_a_session(spark):
    x, y, pool, points = case(3, candidates=3)
    train, pool, candidates = frames(spark, x, y, pool, points)
    assert active.what_if(train, pool, candidates.limit(0)).count() == 0 and active.greedy(train, pool, candidates.limit(0), 2) == []
    assert len(active.greedy(train, pool, candidates, 9)) == 3
    assert {r.if_0 for r in active.what_if(train, pool.limit(0), candidates).collect()} == {0}
    for bad in ((train, pool, candidates, {"most": 2}), (train.limit(0), pool, candidates, {})):
        with pytest.raises(ValueError):
            active.what_if(*bad[:3], **bad[3])
