import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from lithos.llm import queries, spelling


def brute_words(docs):
    counts = {}
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    out, form = {}, {}
    for w, n in words.items():
        by = sorted((-words[v], v) for v in words if near(w, v))
        form[w] = by[0][1] if by and -by[0][0] >= 10 * n else None
        out[w] = (n, len(by), words[form[w]] if form[w] else None)
    rows = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, *out[w]))
    return sorted(rows)


def rows(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def made(rnd, k, letters="abé", lengths=(7, 11)):
    return {"".join(rnd.choices(letters, k=rnd.randint(*lengths))): rnd.choice([2, 3, 20, 31, 250, 3000]) for _ in range(k)}


def test_links_against_brute_force(spark):
    rnd = random.Random(1)
    words = made(rnd, 500) | made(rnd, 60, "xyz", (0, 5)) | {"aaaaaaa" + "b" * k: 5 for k in range(30)} | {"q" * 5000: 2, "q" * 5001: 40, "q" * 2500 + "r" + "q" * 2500: 7}
    words.pop("", None)
    df = spark.createDataFrame([*words.items(), (None, 3), ("", 9)], "word string, n long").selectExpr("*", "n as size", "word as share")
    want = brute(words)
    for share in (1, 7, 100, 100000):
        got = [r for r in rows(spelling.variants(df.where("word != ''"), share_words=share))]
        assert got == want, share
    assert {r.word for r in spelling.near_words(df).collect()} == {w for w, *r in want if r[3]}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sets(st.text("ab𝒳é", max_size=6), max_size=25), max_size=3))
def test_pairs_within_shares(shares):
    rows = [(k, w) for k, words in enumerate(shares) for w in sorted(words)]
    found = []
    for size in range(7):
        some = [r for r in rows if len(r[1]) in (size, size + 1)]
        if some:
            one = np.zeros(len(some), int)
            a, b = spelling.near_pairs([w for _, w in some], np.array([k for k, _ in some]), one, one + size + 1, one + size)
            found += [(some[i][0], *sorted((some[i][1], some[j][1]))) for i, j in zip(a, b)]
    assert sorted(found) == [(k, v, w) for k, words in enumerate(shares) for v in sorted(words) for w in sorted(words) if v < w and near(v, w)]


def test_query_against_brute_force(spark, tmp_path):
    rnd = random.Random(6)
    stock = ["internal", "Internally", "colours", "coloürs", "externe", "reseaux", "RÉSEAUX", "wordlike", "short"]
    docs = [(i if i % 9 else None, " ".join(rnd.choices(stock, k=60)) + rnd.choice([". ", "1", "×÷", "_internals"])) for i in range(200)]
    docs += [(500, None), (501, ""), (502, "12 34"), (503, "internall " * 4 + "internalx-internalx"), (503, "colour " * 30000), (504, "z" * 70000 + " " + "z" * 70000)]
    spark.createDataFrame([(*d, "en", 3) for d in docs], "doc_id long, text string, word string, n int").write.parquet(f"{tmp_path}/documents.parquet")
    words = brute_words(docs)
    got = rows(queries.op13_spelling_variants(spark, str(tmp_path)))
    assert got == brute(words) and any(r[1] for r in got)


def test_chains_of_forms(spark):
    words = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "abcdefghijk": 20000, "abcdefghijkl": 19999, "zzzzzzz": 5}
    got = rows(spelling.variants(spark.createDataFrame([*words.items()], "word string, n long")))
    assert got == brute(words) and got[0][2] == "abcdefghijk"


def test_ties_go_to_the_smallest_in_code_point_order(spark):
    words = {"aaaaaaab": 100, "aaaaaaaÿ": 100, "aaaaaaa𝒳": 100, "aaaaaaa": 10, "Zaaaaaaa": 100}
    got = rows(spelling.variants(spark.createDataFrame([*words.items()], "word string, n long")))
    assert got == brute(words) and {r[0]: r[1] for r in got}["aaaaaaa"] == "Zaaaaaaa"


def test_no_words(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert spelling.variants(empty).count() == 0 and spelling.near_words(empty).count() == 0
    assert spelling.vocabulary(spark.createDataFrame([], "doc_id long, text string")).count() == 0
