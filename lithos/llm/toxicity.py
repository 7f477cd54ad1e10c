"""Toxicity by maximum-scoring segments of token log-odds.

Words, and their stems of ``stem`` bytes, are hashed to ``2 ** bits`` buckets, so the model's
size is fixed; a token has the higher of its two scores. A bucket's score is
the log-odds of its presence in toxic against other labelled documents under a Dirichlet
prior in proportion to its presence in the whole corpus (Monroe et al., 2008), if the
z-score says so, less a constant cost a token. A linear scan (Ruzzo and Tompa, 1999) finds
all maximal segments of a text; each has an E-value K n exp(-lambda S) by Karlin and
Altschul's extreme-value theory, with lambda and K from the token scores of
documents labelled otherwise. A document's evidence is the sum of -ln E over its
significant segments; a logistic curve over it, fitted on the training labels, is the score.

Labels come from a bounded sample of ``sample`` labelled rows; corpus counts cover every
document. Defined results: null and empty texts have no segment and get the lowest score;
without both labels every score is next to 0; rows that repeat an id in the labels count as toxic if
one does. Each row of ``docs`` gives a row. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lithos.llm.arrays import ALNUM, text_slices, word_bounds, word_hashes


@dataclass(frozen=True)
class Params:
    bits: int = 18
    stem: int = 4
    sample: int = 20_000
    z: float = 3.0
    cost: float = 0.3
    e_value: float = 0.05


@dataclass
class Model:
    scores: np.ndarray
    lam: float = 1.0
    k: float = 0.1
    slope: float = 0.0
    offset: float = -30.0


def _buckets(column: pa.Array, p: Params):
    """(first row, buckets of all words and below them of their stems, word offsets by row) slice by slice."""
    for i, _, data, offsets in text_slices(column):
        starts, ends, first = word_bounds(data, offsets, ALNUM)
        both = np.stack([word_hashes(data, starts, ends), word_hashes(data, starts, np.minimum(ends, starts + p.stem))])
        both = (both >> np.uint64(65 - p.bits)).astype(np.int64)
        both[1] += 1 << (p.bits - 1)
        yield i, both, first


def _sampled(labels: DataFrame, p: Params, id_col: str, label_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids, sorted, and labels of about ``p.sample`` rows at most: those whose hashed ids are least."""
    rows = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    rows = rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    n = rows.count()
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    unit = F.xxhash64(F.col("id").cast("string")).cast("double") / F.lit(2.0**64) + 0.5
    got = rows.where(unit <= min(1.0, p.sample / n)).toArrow()
    ids, y = got.column("id").to_numpy(), got.column("y").to_numpy()
    order = np.argsort(ids)
    return ids[order], y[order].astype(np.int64)


def _counts(docs: DataFrame, ids: np.ndarray, y: np.ndarray, p: Params, id_col: str, text_col: str) -> np.ndarray:
    """Documents with each bucket: all, sampled toxic, sampled other; the last row has the tokens of other ones by stem."""
    size = 1 << p.bits
    shared = docs.sparkSession.sparkContext.broadcast((ids, y))

    def run(batches):
        ids_, y_ = shared.value
        total = np.zeros((4, size), np.int64)
        for batch in batches:
            doc = batch.column("id").fill_null(-(1 << 62)).to_numpy()
            at = np.minimum(np.searchsorted(ids_, doc), max(0, len(ids_) - 1))
            group = np.where(ids_[at] == doc, 2 - y_[at], 0) if len(ids_) else np.zeros(len(doc), int)
            for i, words, first in _buckets(batch.column("text"), p):
                owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
                total[3] += np.bincount(words[1][group[i + owner] == 2], minlength=size)
                present = np.unique(owner << p.bits | words)
                who, what = present >> p.bits, present & (size - 1)
                total[0] += np.bincount(what, minlength=size)
                kind = group[i + who]
                for g in (1, 2):
                    if (kind == g).any():
                        total[g] += np.bincount(what[kind == g], minlength=size)
        some = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(t[some]) for t in total)], ["b", "n0", "n1", "n2", "n3"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    parts = rows.mapInArrow(run, "b long, n0 long, n1 long, n2 long, n3 long")
    got = parts.groupBy("b").agg(*[F.sum(f"n{i}").alias(f"n{i}") for i in range(4)]).toArrow()  # 2 ** bits rows at most
    out = np.zeros((4, size), np.int64)
    for i in range(4):
        out[i, got.column("b").to_numpy()] = got.column(f"n{i}").to_numpy()
    return out


def log_odds(all_docs: np.ndarray, toxic: np.ndarray, other: np.ndarray, z_least: float) -> np.ndarray:
    """Log-odds of presence with a Dirichlet prior that weighs as much as the toxic class; 0 where z is small."""
    weight = float(max(1, toxic.sum()))
    prior = weight * (all_docs + 1e-3) / (all_docs.sum() + 1e-3 * len(all_docs))
    a, b = toxic + prior, other + prior
    delta = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    z = delta / np.sqrt(1 / a + 1 / b)
    return np.where(np.abs(z) >= z_least, delta, 0.0)


def karlin_lambda(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of sum(p * exp(lambda * s)) = 1; 1 if the scores have none."""
    p = weights / max(1, weights.sum())
    if not (p[scores > 0].sum() > 0 and (p * scores).sum() < 0):
        return 1.0
    low, high = 1e-9, 1.0
    while (p * np.exp(np.minimum(700, high * scores))).sum() < 1:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(700, mid * scores))).sum() < 1 else (low, mid)
    return high


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in linear time (Ruzzo and Tompa).

    ``held`` are those that a later one may still join: start, end, sum before, sum through, and where the nearest one with
    a lower sum before stands. Where there is none, no later one can join them, and they are done.
    """
    done: list[tuple] = []
    held: list[tuple] = []
    total = 0.0
    previous = 0
    for at in np.flatnonzero(scores > 0).tolist():
        total += float(scores[previous:at].sum())
        previous = at + 1
        start, before, total = at, total, total + float(scores[at])
        j = len(held) - 1
        while True:
            while j >= 0 and held[j][2] >= before:
                j = held[j][4]
            if j < 0:
                done += held
                held = [(start, at + 1, before, total, -1)]
                break
            if held[j][3] >= total:
                held.append((start, at + 1, before, total, j))
                break
            start, before = held[j][0], held[j][2]
            up = held[j][4]
            del held[j:]
            j = up
    return [(s, e, through - before) for s, e, before, through, _ in done + held]


def _evidence(scores: np.ndarray, m: Model, p: Params) -> tuple[float, list[tuple[int, int, float]]]:
    """-ln E summed over significant segments of a text's token scores, and those segments."""
    if not (scores > 0).any():
        return 0.0, []
    good, total = [], 0.0
    for s, e, x in segments(scores):
        log_e = math.log(m.k * len(scores)) - m.lam * x
        if log_e < math.log(p.e_value):
            good.append((s, e, x))
            total -= log_e
    return total, good


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of a ridge-regularised logistic curve, by Newton's method."""
    features = np.stack([x, np.ones(len(x))], 1)
    w = np.zeros(2)
    ridge = np.diag([1e-3, 1e-3])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        grad = features.T @ (q - y) + ridge @ w
        step = np.linalg.solve((features * (q * (1 - q))[:, None]).T @ features + ridge + 1e-9 * np.eye(2), grad)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(w[0])), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Learn from ``labels``, which must hold training rows only; ``docs`` is the whole corpus."""
    ids, y = _sampled(labels, p, id_col, label_col)
    counts = _counts(docs, ids, y, p, id_col, text_col)
    if not counts[1].any() or not counts[2].any():
        return Model(np.zeros(1 << p.bits))
    model = Model(log_odds(*counts[:3], p.z) - p.cost)
    # The null is text labelled other, its tokens scored by their stems; half a token is spread over the positive buckets.
    positive = model.scores > 0
    null = counts[3] + 0.5 * positive / max(1, positive.sum())
    model.lam = karlin_lambda(model.scores, null)
    # Positive tokens are rare in it and stand alone, so K is their rate, undone for their score, times the chance to fall back.
    tilted = (null * np.exp(np.minimum(700, model.lam * model.scores)))[positive].sum() / max(1, null.sum())
    model.k = float(min(1.0, max(1e-9, tilted * (1 - math.exp(-model.lam * p.cost)))))
    rows = scored(docs, model, p, id_col, text_col, only=ids).groupBy("id").agg(F.max("evidence").alias("evidence")).toArrow()
    got = dict(zip(rows.column("id").to_pylist(), rows.column("evidence").to_pylist()))
    known = np.array([i in got for i in ids.tolist()])
    x = np.array([got[i] for i in ids[known].tolist()])
    model.slope, model.offset = _logistic(np.log1p(x), y[known].astype(float))
    return model


def scored(docs: DataFrame, model: Model, p: Params = Params(), id_col: str = "doc_id", text_col: str = "text", only: np.ndarray | None = None) -> DataFrame:
    """``(id, evidence, score, segments)``; segments are (start, end, score) in words. ``only``: sorted ids, a bounded sample."""
    shared = docs.sparkSession.sparkContext.broadcast((model, only))
    part = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    found = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())]))
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), T.StructField("evidence", T.DoubleType()), T.StructField("score", T.DoubleType()), T.StructField("segments", found)])

    def run(batches):
        m, some = shared.value
        for batch in batches:
            if some is not None:
                ids = batch.column("id").fill_null(-(1 << 62)).to_numpy()
                at = np.minimum(np.searchsorted(some, ids), max(0, len(some) - 1))
                batch = batch.filter(pa.array(some[at] == ids if len(some) else np.zeros(len(ids), bool)))
            values, places = [], []
            for _, words, first in _buckets(batch.column("text"), p):
                tokens = np.maximum(m.scores[words[0]], m.scores[words[1]])
                for r in range(len(first) - 1):
                    value, good = _evidence(tokens[first[r] : first[r + 1]], m, p)
                    values.append(value)
                    places.append([{"start": s, "end": e, "score": x} for s, e, x in good])
            evidence = np.array(values, float)
            z = np.clip(m.slope * np.log1p(evidence) + m.offset, -30, 30)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(evidence), pa.array(1 / (1 + np.exp(-z))), pa.array(places, pa.list_(part))], schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
