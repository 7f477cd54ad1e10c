import math
import random
import time

import numpy as np
from pyspark.sql import functions as F

from lithos.llm import toxicity


def brute_segments(s):
    """Ruzzo and Tompa's definition, by recursion on the best segment."""
    out, todo = [], [(0, len(s))]
    while todo:
        a, b = todo.pop()
        best = max(((sum(s[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best and best[0] > 1e-12:
            _, _, i, j = best
            out.append((i, j))
            todo += [(a, i), (j, b)]
    return sorted(out)


def test_segments_against_the_definition():
    rnd = random.Random(8)
    for _ in range(60):
        s = [rnd.choice([-2.0, -1.0, -0.5, 1.0, 1.25, 3.0]) + rnd.random() / 1000 for _ in range(14)]
        got = toxicity.segments(np.array(s))
        assert sorted((a, b) for a, b, _ in got) == brute_segments(s)
        assert all(abs(x - sum(s[a:b])) < 1e-9 for a, b, x in got)


def test_lambda_solves_its_equation():
    s, w = np.array([-0.3, -0.5, 4.0]), np.array([700, 280, 20])
    lam = toxicity.karlin_lambda(s, w)
    assert abs((w / w.sum() * np.exp(lam * s)).sum() - 1) < 1e-6


def corpus():
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(600)]
    rows, labels = [], []
    for i in range(700):
        w = rnd.choices(vocab, k=rnd.choice([20, 80, 200]))
        y = int(rnd.random() < 0.2)
        for _ in range(3 * y):
            w.insert(rnd.randrange(len(w)), rnd.choice(["vile", "awful", "rotten"]))
        rows.append((i, " ".join(w)))
        labels.append((i, y))
    return rows, labels


def test_held_out_accuracy(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (9000, None), (9001, ""), (None, "vile awful")], "doc_id long, text string")
    train = spark.createDataFrame([*labels[:400], (None, 1), (3, None), labels[5]], "doc_id long, toxic int")
    model = toxicity.fit(docs, train)
    got = {r.id: r for r in toxicity.scored(docs, model).collect()}
    assert len(got) == len(rows) + 3
    truth = dict(labels)
    right = sum((got[i].score >= 0.5) == bool(truth[i]) for i in range(400, 700))
    assert right >= 0.95 * 300
    low = min(r.score for r in got.values())
    assert got[9000].score == got[9001].score == low and got[None].score > 0.5
    assert all(s.score > 0 and s.end > s.start for r in got.values() for s in r.segments)


def test_without_labels_or_documents(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows[:5], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score < 1e-6 for r in toxicity.scored(docs, toxicity.fit(docs, none)).collect()] == [True] * 5
    empty = docs.where(F.lit(False))
    assert toxicity.scored(empty, toxicity.fit(empty, spark.createDataFrame(labels, "doc_id long, toxic int"))).count() == 0


def test_the_scan_is_linear_and_ties_are_as_defined():
    rnd = random.Random(3)
    for _ in range(200):
        s = [rnd.choice([-2, -1, 1, 2]) for _ in range(12)]
        got = toxicity.segments(np.array(s, float))
        assert all(x > 0 and abs(x - sum(s[a:b])) < 1e-9 for a, b, x in got)
        assert all(sum(s[a:i]) > 0 and sum(s[i:b]) > 0 for a, b, _ in got for i in range(a + 1, b))
        assert sorted(i for a, b, _ in got for i in range(a, b) if s[i] > 0) == [i for i, x in enumerate(s) if x > 0]
    falling = np.tile([1.0, -2.0], 200_000)
    rising = np.tile([-1.0, 2.0, -0.5], 100_000)
    began = time.time()
    assert len(toxicity.segments(falling)) == 200_000 and len(toxicity.segments(rising)) == 1
    assert len(toxicity.segments(np.concatenate([np.tile([3.0, -1.0], 50_000), falling]))) > 0
    assert time.time() - began < 20


def test_scores_against_brute_force(spark):
    """Every score from its definition: the words' buckets one by one, segments by recursion, and the curve."""
    rows, labels = corpus()
    short = [(i, " ".join(t.split()[:14]) + " vile awful") for i, t in rows[:40]] + [(900, None), (901, "VILE vile")]
    train = spark.createDataFrame(labels[:400], "doc_id long, toxic int")
    p = toxicity.Params()
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), train, p)
    got = {r.id: (r.score, sorted((s.start, s.end) for s in r.segments)) for r in toxicity.scored(spark.createDataFrame(short, "doc_id long, text string"), model, p).collect()}

    def bucket(word, half):
        data = np.frombuffer(word.lower().encode(), np.uint8)
        return int(toxicity.word_hashes(data, np.array([0]), np.array([len(data)]))[0] >> np.uint64(65 - p.bits)) + half * (1 << (p.bits - 1))

    for i, text in short:
        tokens = [max(model.scores[bucket(w, 0)], model.scores[bucket(w[: p.stem], 1)]) for w in (text or "").split()]
        good = [(a, b, math.log(model.k * len(tokens)) - model.lam * sum(tokens[a:b])) for a, b in brute_segments(tokens)]
        good = [g for g in good if g[2] < math.log(p.e_value)]
        z = model.slope * math.log1p(-sum(g[2] for g in good)) + model.offset
        assert got[i][1] == sorted(g[:2] for g in good) and abs(got[i][0] - 1 / (1 + math.exp(-max(-30, min(30, z))))) < 1e-9


def test_a_repeated_id_comes_home_once(spark):
    rows, labels = corpus()
    many = spark.createDataFrame([*rows[:100], *[(3, "word " * 5)] * 3000], "doc_id long, text string")
    model = toxicity.fit(many, spark.createDataFrame(labels[:100], "doc_id long, toxic int"))
    assert toxicity.scored(many, model).count() == 3100
