import random
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lithos.llm import near_dup
from tests.llm.helpers import components, shingles


def brute(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t))
    links = []
    for a, b in combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]):
            links.append((a, b))
    return components(sets, links)


def corpus(seed=1):
    rnd = random.Random(seed)
    vocab = [f"w{i}é" if i % 9 == 0 else f"W{i}" for i in range(400)]
    rows, base = [], [rnd.choices(vocab, k=rnd.choice([3, 5, 20, 150, 400])) for _ in range(25)]
    for i in range(260):
        w = list(rnd.choice(base[:12] if i % 2 else base))
        for _ in range(rnd.choice([0, 1, 2, 4, 8, 12])):
            w[rnd.randrange(len(w))] = rnd.choice(vocab)
        rows.append((i * 3, rnd.choice([" ", "\n", "\t  "]).join(w)))
    rows += [(2000, None), (2001, ""), (2002, " \n "), (2003, "one"), (2004, "ONE"), (2005, "one two"), (2006, "x " * 60000), (2007, "X " * 9000)]
    rows += [rows[5], rows[5], (2008, "a b c d e"), (2009, "é È è e")]
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, component_id int, digest string")
    got = near_dup.near_duplicates(df, near_dup.Params(block=600)).collect()
    assert len(got) == len(rows)
    want = brute(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    sizes = {i: len(shingles(t)) for i, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] and r.kept == (r.doc_id == r.component_id) for r in got)


def test_empty_table_and_null_ids(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(None, "a b c d e"), (4, "a b c d e"), (None, "q"), (None, None)], "doc_id long, text string")
    got = sorted(map(tuple, near_dup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 2, 4, False), (4, 2, 4, True), (None, 1, None, True), (None, 0, None, True)], key=str)


def test_texts_under_one_id_in_any_order_of_rows(spark):
    rnd = random.Random(5)
    a, b, c = ([f"w{rnd.randrange(10**6)}" for _ in range(120)] for _ in range(3))
    near = lambda w, k: " ".join(w[:-k] + [f"n{rnd.randrange(10**6)}" for _ in range(k)])
    a, b, c = " ".join(a), " ".join(b), " ".join(c)
    rows = [(5, a), (5, b), (7, near(a.split(), 3)), (9, near(b.split(), 3)), (3, c), (4, c), (8, c), (8, near(b.split(), 2)), (None, c), (5, None)]
    want = brute([r for r in rows if r[0] is not None])
    assert want[9] == 3 and want[7] == 3
    for order in ([*range(10)], [9, 8, 7, 6, 5, 4, 3, 2, 1, 0], [1, 3, 5, 7, 9, 0, 2, 4, 6, 8]):
        df = spark.createDataFrame([rows[i] for i in order], "doc_id long, text string")
        got = near_dup.near_duplicates(df).collect()
        assert len(got) == 10 and {r.doc_id: r.component_id for r in got if r.doc_id is not None and r.n_shingles} == want
        assert [r.component_id for r in got if r.doc_id is None] == [3]


def test_each_text_by_itself(spark):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(None, base), (None, base), (None, base + " x"), (2, "other words of a text"), (2, base + " y"), (1, None), (None, "alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.near_duplicates(df, by_text=True).collect()
    texts = {spark.range(1).select(F.xxhash64(F.lit(t))).first()[0]: t for _, t in rows if t}
    kept = {(r.doc_id, texts.get(r.hash)) for r in got if r.kept}
    assert kept == {(2, base + " y"), (2, "other words of a text"), (1, None), (None, "alone here")}


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(2)
    pool = rnd.integers(1, 2**63, 3000).astype(np.uint64)
    errors = []
    for n in (10, 60, 500, 2500):
        a, b = np.sort(pool[:n]), np.sort(pool[n // 5 : n + n // 5])
        sig = near_dup.super_minhash([a, b, np.zeros(0, np.uint64)], 128)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(abs((sig[0] == sig[1]).mean() - true))
        assert (sig[2] == near_dup.EMPTY).all() and (sig[:2] != near_dup.EMPTY).all()
        # Stopping early changes nothing: a set alone gets the signature that it gets among others.
        assert (near_dup.super_minhash([b], 128)[0] == sig[1]).all()
    assert max(errors) < 0.16


def test_signatures_vary_less_than_plain_minhash():
    rnd = np.random.default_rng(3)
    errors, slots = {True: [], False: []}, 64
    for _ in range(200):
        pool = rnd.integers(1, 2**63, 48).astype(np.uint64)
        a, b = np.sort(pool[:40]), np.sort(pool[8:])
        sig = near_dup.super_minhash([a, b], slots)
        errors[True].append((sig[0] == sig[1]).mean() - 32 / 48)
        each = [np.array([near_dup.mixed(s + near_dup.mixed(np.array([k], np.uint64))).min() for k in range(slots)]) for s in (a, b)]
        errors[False].append((each[0] == each[1]).mean() - 32 / 48)
    assert np.var(errors[True]) < 0.85 * np.var(errors[False])


def test_sliced_columns_hash_alike():
    column = pa.array(["zero", None, "A b c d e f", "", "b C d e"])
    whole = [s for _, sets in near_dup.shingle_sets(column, near_dup.Params()) for s in sets]
    part = [s for _, sets in near_dup.shingle_sets(column.slice(2, 3), near_dup.Params()) for s in sets]
    assert [len(s) for s in whole] == [1, 0, 3, 0, 1]
    assert all((a == b).all() for a, b in zip(whole[2:], part))
    assert whole[4][0] in whole[2]
