import random

from lithos.llm import decontaminate
from tests.llm.helpers import words


def brute(docs, items, size=10):
    out = []
    wins = []
    for i, t in items:
        w = words(t)
        n = min(size, len(w))
        wins += [(i, tuple(w[s : s + n])) for s in range(len(w) - n + 1) if n]
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for i, win in wins:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found.add(str(i))
        out.append((d, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=str)


def case():
    rnd = random.Random(7)
    vocab = ["a", "b", "É", "straße", "x1", "é", "Q"]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 3, 9, 10, 11, 25, 40])))) for i in range(20)]
    items += [(50, "a " * 30), (51, None), (7, items[7][1]), (None, "zz yy xx ww")]
    docs = []
    for d in range(60):
        w = rnd.choices(vocab, k=rnd.choice([0, 5, 60]))
        for _ in range(rnd.choice([0, 1, 3])):
            t = words(rnd.choice(items)[1])
            a = rnd.randrange(len(t) + 1)
            w[rnd.randrange(len(w) + 1) : 0] = t[a : a + 14]
        docs.append((d, rnd.choice([" ", ", ", "\n-"]).join(w)))
    docs += [(100, None), (101, ""), (102, "A! " * 200), docs[3], docs[3], (None, "ZZ yy;xx ww")]
    return docs, items


def run(spark, docs, items, **p):
    d = spark.createDataFrame([(a, b, 1, 2) for a, b in docs], "doc_id long, text string, item_id int, row int")
    b = spark.createDataFrame([(x, y, 1) for x, y in items], "item_id long, text string, fp int")
    got = decontaminate.contamination(d, b, decontaminate.Params(**p))
    return sorted([(r.doc_id, r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in got.collect()], key=str)


def test_against_brute_force(spark):
    docs, items = case()
    items = [x for x in items if x[0] is not None]
    assert run(spark, docs, items) == brute(docs, items)


def test_full_bitmap_gives_the_same(spark):
    docs, items = case()
    items = [x for x in items if x[0] is not None]
    assert run(spark, docs[:25], items, bits=6) == brute(docs[:25], items)


def test_empty_tables(spark):
    docs, items = case()
    assert run(spark, [], items) == []
    got = run(spark, docs[:4], [])
    assert [x[2:] for x in got] == [(0, [], False)] * 4


def test_an_item_without_an_id_counts_for_hits_only(spark):
    items = [(None, "a b c d e f g h i j"), (3, "d e f g h i j k l m")]
    got = run(spark, [(1, "x a b c d e f g h i j y"), (2, "a b c d e f g h i j k l m")], items)
    assert got == [(1, 12, 10, [], True), (2, 13, 13, ["3"], True)]


def test_very_long_text(spark):
    rnd = random.Random(4)
    w = [f"w{rnd.randrange(10**6)}" for _ in range(60_000)]
    item = " ".join(w[40_000:40_012])
    assert run(spark, [(1, " ".join(w))], [(9, item)]) == [(1, 60_000, 12, ["9"], True)]
