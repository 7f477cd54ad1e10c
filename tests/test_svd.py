import os
import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lithos.operators import ml
from lithos.operators.svd import TruncatedSVD, product, sparse
from lithos.plans.corpus import docs

DATA = "/root/testdata/sf0.001"


def matrix(n=300, v=60, seed=1):
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(n, 8)) @ (rng.normal(size=(8, v)) * np.linspace(3, 0.5, 8)[:, None]) + 0.05 * rng.normal(size=(n, v))
    a[rng.random(a.shape) < 0.7] = 0
    a[5] = 0
    return a


def frame(spark, a, dense=()):
    rows = [(i, Vectors.dense(x) if i in dense else Vectors.sparse(len(x), np.flatnonzero(x).tolist(), x[np.flatnonzero(x)].tolist())) for i, x in enumerate(a)]
    return spark.createDataFrame(rows, ["id", "features"]).repartition(3)


def test_values_and_projections_equal_a_dense_decomposition(spark):
    a = matrix()
    df = frame(spark, a, dense={3, 4, 5})
    model = TruncatedSVD(6).fit(df)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.abs(model.values / s[:6] - 1).max() < 0.01
    assert np.abs(np.abs((model.components * vt[:6].T).sum(0)) - 1).max() < 0.01
    got = {r.id: r.x for r in model.transform(df, "svd").select("id", vector_to_array("svd").alias("x")).collect()}
    assert np.allclose(np.array([got[i] for i in range(len(a))]), a @ model.components)
    assert (model.components[np.abs(model.components).argmax(0), range(6)] > 0).all()


def test_product_is_exact(spark):
    a = matrix(40, 15)
    q = np.random.default_rng(2).normal(size=(15, 4))
    assert np.allclose(product(sparse(frame(spark, a), "features"), q), a.T @ (a @ q))


def test_small_null_and_empty_tables(spark):
    a = np.array([[1.0, 0, 2], [0, 0, 0], [2, 0, 4]])
    model = TruncatedSVD(5).fit(frame(spark, a))
    assert len(model.values) == 1 and model.values[0] == pytest.approx(5)  # rank one
    df = frame(spark, a).union(frame(spark, a).selectExpr("id + 10 as id", "null as features"))
    assert TruncatedSVD(5).fit(df).values[0] == pytest.approx(5)
    assert sum(r.svd is None for r in model.transform(df, "svd").collect()) == 3
    none = TruncatedSVD(5).fit(df.limit(0))
    assert len(none.values) == 0 and none.transform(df.limit(0), "svd").count() == 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_values_on_the_features_of_documents(spark):
    rows = docs(spark, DATA).select("doc_id", "title", "abstract")
    ready = ml.vectoriser(["title", "abstract"], features=256).fit(rows).transform(rows).select("features")
    dense = np.array([r.features.toArray() for r in ready.collect()])
    model = TruncatedSVD(8).fit(ready)
    assert np.abs(model.values / np.linalg.svd(dense, compute_uv=False)[:8] - 1).max() < 0.01


def test_classifiers_beat_the_majority_on_held_out_rows(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(300):
        y = int(rnd.random() < 0.35)
        words = rnd.choices([f"w{k}" for k in range(80)], k=30) + rnd.choices([f"{'good' if y else 'poor'}{k}" for k in range(6)], k=2)
        rnd.shuffle(words)
        rows.append((i, " ".join(words), y))
    df = spark.createDataFrame(rows, "id long, t string, y int")
    train, test = df.where("id < 220"), df.where("id >= 220")
    for svd in (None, 24):
        features, models = ml.fit_labels(train, ["y"], ["t"], features=512, svd=svd)
        got = ml.predict_labels(test, features, models).collect()
        hit = sum(r.y == 1 and r.y_score > 0.5 for r in got)
        f1 = 2 * hit / max(1, sum(r.y_score > 0.5 for r in got) + sum(r.y for r in got))
        share = sum(r.y for r in got) / len(got)
        assert f1 > 2 * share / (1 + share) + 0.1, svd  # all of the class that is asked for


@pytest.mark.parametrize("svd", [None, 3])
def test_texts_are_read_once_for_all_fits(spark, svd):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(t):
        read.add(1)
        return t

    rows = spark.createDataFrame([(f"word{i % 5} other{i % 3} more", i % 2) for i in range(40)], "t string, y int").withColumn("t", seen.asNondeterministic()("t"))
    ml.fit_labels(rows, ["y"], ["t"], features=64, svd=svd)
    assert read.value == 40
