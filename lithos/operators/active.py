"""Active learning: which document to annotate next, by what a model would decide if its answer were known.

A model is a logistic regression with a ridge of one, so its objective is strongly convex. Two things follow. A model with
one more row is reached from the one without it in a few steps of one shared factorisation, corrected for the row
by the Sherman-Morrison formula. And rows added later move a model by no more than the gradient they add, so
what it decided bounds what it can decide: candidates wait in a priority queue by that bound and few are fitted again.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most rows of a session's training set, and most candidates, that are sent to the tasks.
SESSION = 20_000
#: Steps of the histogram that says how far a pool row is from being decided, and what the last of them ends at.
STEPS, FURTHEST = 128, 8.0


def _bounded(rows: DataFrame, most: int, what: str) -> list:
    found = rows.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} {what}")
    return found


def _with_one(x: np.ndarray) -> np.ndarray:
    return np.c_[x, np.ones(len(x))]


def _sigmoid(t: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(t, -30, 30)))


def _inverse_curvature(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    q = _sigmoid(x @ w)
    return np.linalg.inv((x * (q * (1 - q))[:, None]).T @ x + np.eye(len(w)))


def _stepped(x: np.ndarray, y: np.ndarray, w: np.ndarray, gradient: np.ndarray, step: np.ndarray) -> np.ndarray:
    """``w`` less the step, or less a part of it if the objective would not fall."""
    loss = lambda v: float(np.logaddexp(0, t := x @ v).sum() - y @ t + v @ v / 2)
    now, slope, share = loss(w), float(gradient @ step), 1.0
    while share > 1e-9 and loss(w - share * step) > now - 1e-4 * share * slope + 1e-12 * abs(now):
        share /= 2
    return w - share * step


class Session:
    """A fitted training set, ready for one more row."""

    #: Steps of the shared factorisation before a model far from it gets its own.
    shared_steps = 30

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.x, self.y = _with_one(x.reshape(len(y), -1)), y
        self.w = self._newton(self.x, y, np.zeros(self.x.shape[1]))
        self.inverse = _inverse_curvature(self.x, self.w)

    @staticmethod
    def _newton(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        for _ in range(200):
            gradient = x.T @ (_sigmoid(x @ w) - y) + w
            if np.abs(gradient).max() < 1e-11:
                break
            w = _stepped(x, y, w, gradient, _inverse_curvature(x, w) @ gradient)
        return w

    def refitted(self, point: np.ndarray, answer: float) -> np.ndarray:
        """The model with ``point`` (a one at its end) and its answer."""
        w, u = self.w, self.inverse @ point
        x, y = np.vstack([self.x, point]), np.append(self.y, answer)
        for _ in range(self.shared_steps):
            gradient = x.T @ (_sigmoid(x @ w) - y) + w
            if np.abs(gradient).max() < 1e-11:
                return w
            q = float(_sigmoid(w @ point))
            curve = q * (1 - q)
            w = _stepped(x, y, w, gradient, self.inverse @ gradient - u * (curve * float(u @ gradient) / (1 + curve * float(u @ point))))
        return self._newton(x, y, w)


def _training(train: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    rows = _bounded(train.select("x", "y"), most, "training rows")
    if not rows:
        raise ValueError("no training rows")
    return np.array([r.x for r in rows], float), np.array([r.y for r in rows], float)


def _models(session: Session, candidates: DataFrame, most: int) -> pd.DataFrame:
    """(id, answer, x, w) of every candidate with either answer."""
    shared = candidates.sparkSession.sparkContext.broadcast(session)

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = [(i, a, x, shared.value.refitted(np.append(x, 1.0), a)) for i, x in zip(frame["id"], frame["x"], strict=True) for a in (0, 1)]
            yield pd.DataFrame(out, columns=["id", "answer", "x", "w"])

    models = candidates.select("id", "x").mapInPandas(fit, "id long, answer int, x array<double>, w array<double>")
    found = _bounded(models, 2 * most, "candidates' models")
    return pd.DataFrame({c: [r[c] for r in found] for c in ("id", "answer", "x", "w")})


def _decided(pool: DataFrame, models: pd.DataFrame, low: float, high: float) -> np.ndarray:
    """For each model, how many rows of the pool it decides, and how many it would if it moved by up to so many steps.

    Column 0 counts the decided; column j those that a move of ``j * FURTHEST / STEPS`` could decide at most.
    """
    weights = np.stack(models["w"].to_numpy()).T
    limits = np.log(low / (1 - low)), np.log(high / (1 - high))
    shared = pool.sparkSession.sparkContext.broadcast(weights)

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = shared.value
        total = np.zeros((w.shape[1], STEPS + 1), np.int64)
        for frame in frames:
            for lo in range(0, len(frame), 1024):
                points = _with_one(np.vstack(frame["x"].to_numpy()[lo : lo + 1024]).astype(float))
                logits = np.clip(points @ w, -30, 30)
                q = 1 / (1 + np.exp(-logits))
                away = np.minimum(np.maximum(logits - limits[0], 0), np.maximum(limits[1] - logits, 0)) / np.linalg.norm(points, axis=1)[:, None]
                step = np.where((q < low) | (q > high), 0, np.minimum(np.floor(away * (STEPS / FURTHEST)) + 1, STEPS)).astype(int)
                for m in range(w.shape[1]):
                    total[m] += np.bincount(step[:, m], minlength=STEPS + 1)
        m, j = np.nonzero(total)
        yield pd.DataFrame({"m": m, "j": j, "n": total[m, j]})

    out = np.zeros((len(models), STEPS + 1), np.int64)
    for r in pool.select("x").mapInPandas(count, "m long, j long, n long").groupBy("m", "j").agg(F.sum("n").alias("n")).collect():
        out[r.m, r.j] += r.n
    shared.unpersist()
    return np.cumsum(out, 1)


def what_if(train: DataFrame, pool: DataFrame, candidates: DataFrame, low: float = 0.3, high: float = 0.7, most: int = SESSION) -> DataFrame:
    """For each candidate and either answer: how many pool rows a model refitted with it would decide.

    ``train`` is (x array, y 0/1), ``pool`` is (x) and ``candidates`` (id, x). The pool, of any size, is
    read once and scored with all models. The training set and
    the candidates are those of an annotation session: more than ``most`` of either raise ValueError.
    """
    models = _models(Session(*_training(train, most)), candidates, most)
    if not len(models):
        return candidates.sparkSession.createDataFrame([], "id long, if_0 long, if_1 long, mean double, least long")
    models["n"] = _decided(pool, models, low, high)[:, 0]
    # one row an id, also where it stands several times
    wide = models.groupby(["id", "answer"])["n"].sum().unstack()
    rows = [(int(i), int(r[0]), int(r[1])) for i, r in wide.iterrows()]
    out = candidates.sparkSession.createDataFrame(rows, "id long, if_0 long, if_1 long")
    return out.select("id", "if_0", "if_1", ((F.col("if_0") + F.col("if_1")) / 2).alias("mean"), F.least("if_0", "if_1").alias("least"))


def greedy(train: DataFrame, pool: DataFrame, candidates: DataFrame, rounds: int, low: float = 0.3, high: float = 0.7, most: int = SESSION, at_once: int = 64) -> list[tuple[int, int]]:
    """(id, worse outcome) of the candidates picked one after another, each added to ``train`` with the answer that decides most.

    In each round the candidate with the best of the worse outcomes is picked, the least id among equals. A queue holds an
    upper bound of each candidate's outcome; the ``at_once`` first are fitted and counted again until no bound that is left
    reaches the best. So the picks are those of fitting all candidates in every round.
    """
    spark = train.sparkSession
    x, y = _training(train, most)
    points = {r.id: list(r.x) for r in _bounded(candidates.select("id", "x"), most, "candidates")}
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # weights and counts, for answers 0 and 1, of when it was fitted
    fitted_in: dict[int, int] = {}
    added: list[tuple[np.ndarray, int]] = []
    picked: list[tuple[int, int]] = []

    def bound(i: int) -> float:
        """The worse outcome at most: a model has moved by no more than the gradient of the rows added since."""
        if i not in known:
            return np.inf
        weights, counts = known[i]
        since = added[fitted_in[i] :]
        worst = []
        for w, c in zip(weights, counts, strict=True):
            move = np.linalg.norm(sum(((float(_sigmoid(w @ x)) - a) * x for x, a in since), np.zeros(len(w)))) * (1 + 1e-6)
            step = int(np.ceil(move * STEPS / FURTHEST)) + (move > 0)
            worst.append(c[step] if step <= STEPS - 1 else c[-1])
        return float(min(worst))

    for number in range(rounds):
        session = Session(x, y)
        left = [i for i in points if i not in {p for p, _ in picked}]
        queue = [(-bound(i), i) for i in left]
        heapq.heapify(queue)
        best: tuple[int, int] | None = None  # (-outcome, id)
        while queue and (best is None or queue[0][0] <= best[0]):
            again = [heapq.heappop(queue)[1] for _ in range(min(at_once, len(queue)))] if number else [heapq.heappop(queue)[1] for _ in range(len(queue))]
            some = spark.createDataFrame([(i, points[i]) for i in again], "id long, x array<double>")
            models = _models(session, some, most)
            counts = _decided(pool, models, low, high)
            for k, (i, a, w) in enumerate(zip(models["id"], models["answer"], models["w"], strict=True)):
                pair = known.get(i) if fitted_in.get(i) == len(added) else None
                pair = pair or ([None, None], [None, None])
                pair[0][a], pair[1][a] = np.array(w), counts[k]
                known[i], fitted_in[i] = pair, len(added)
            best = min([(-int(min(known[i][1][0][0], known[i][1][1][0])), i) for i in again] + ([best] if best else []))
        if best is None:
            break
        i = best[1]
        picked.append((i, -best[0]))
        zero, one = (int(c[0]) for c in known[i][1])
        answer = int(one > zero)
        added.append((np.append(points[i], 1.0), answer))
        x, y = np.vstack([x, points[i]]), np.append(y, answer)
    return picked


def challenge(docs: DataFrame, score: str, least: float, labels: str) -> DataFrame:
    """Documents with a score above ``least`` that nobody has labelled: what a model should be able to decide."""
    return docs.where((F.col(score) > least) & (F.coalesce(F.size(labels), F.lit(0)) <= 0))
