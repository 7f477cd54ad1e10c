import random

from lithos.llm import licenses, queries
from tests.llm.helpers import words


def brute(text):
    w, places = words(text), []
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    return len(w), sorted(places)


def texts():
    rnd = random.Random(6)
    parts = ["under the MIT license", "Apache License, Version 2.0", "CC-BY-NC", "cc by", "nc", "é", "under", "the", "mit", "MİT", "K", "\n", "xcc by nc", "SPDX-License-Identifier: (MIT OR Apache-2.0) AND BSD-3-Clause\n"]
    return [None, "", "...", "CC BY NC BY NC cc by nc cc by nc", "x " * 50000 + "under the mit license"] + [rnd.choice([" ", "-", "\n"]).join(rnd.choices(parts, k=30)) for _ in range(60)]


def test_places_against_brute_force(spark):
    data = list(enumerate(texts()))
    df = spark.createDataFrame([(i, t, "q") for i, t in data] + [(0, None, "q")], "doc_id long, text string, labels string")
    got = licenses.scan(df).collect()
    assert len(got) == len(data) + 1
    by = {r.doc_id: r for r in got}
    for i, t in data:
        n, places = brute(t)
        assert by[i].n_words == n and [tuple(x) for x in by[i].places] == places, t
        assert by[i].base_labels == sorted({x[1] for x in places}) and set(by[i].base_labels) <= set(by[i].labels)
        assert 0 <= by[i].score <= 1


def test_expressions():
    sets = lambda x: sorted(" & ".join(sorted(s)) for s in licenses.choices(licenses.TOKEN.findall(x.lower())))
    assert sets("MIT") == ["mit"]
    assert sets("MIT or Apache-2.0 and BSD-3-Clause") == ["apache-2 & bsd-3-clause", "mit"]
    assert sets("(MIT or Apache-2.0) and BSD-3-Clause") == ["apache-2 & bsd-3-clause", "bsd-3-clause & mit"]
    assert sets("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT") == ["gpl-2.0-only with classpath-exception-2.0", "mit"]
    assert sets("((MIT") == ["mit"] and sets("MIT or") == ["mit"] and sets("or MIT") == [] and sets("") == [] and sets("MIT) and X") == ["mit"]
    assert sets("MIT licensed text") == ["mit"]


def test_tags_add_labels():
    _, places, others, found = licenses.scan_text("SPDX-License-Identifier: MIT OR GPL-3.0\nnext line, all rights reserved", licenses.Params())
    assert places == [] and others == {"all-rights-reserved"} and len(found) == 1


def test_digest(spark, tmp_path):
    spark.createDataFrame([(1, "CC-BY-NC cc by nc"), (2, None)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op8_licenses(spark, str(tmp_path)).collect()}
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (6, 2, 0, 3, "cc-by-nc")
    assert (got[2].n_words, got[2].n_base, got[2].first_word, got[2].labels, got[2].score) == (0, 0, None, "", 0.0)


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_expressions_keep_every_license(spark):
    clauses = [("BSL-1.0", "0BSD"), *((f"A-{i}", f"Z-{i}") for i in range(9))]
    products = " AND ".join(f"({a} OR {b})" for a, b in clauses)
    many = [f"L-{i}" for i in range(100)]
    rows = [(1, f"License-Expression: {products}"), (2, "SPDX-License-Identifier: " + " OR ".join(many))]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == sorted(x.lower() for c in clauses for x in c)
    assert got[1].expressions == [products.lower()]
    assert got[2].labels == sorted(x.lower() for x in many)
    assert len(licenses.choices(licenses.TOKEN.findall(" or ".join(many).lower()))) == 100


def test_labels_are_those_of_all_choices():
    rnd = random.Random(2)
    for _ in range(300):
        tokens = rnd.choices(["(", ")", "and", "or", "with", "a", "b", "c"], k=rnd.randrange(1, 10))
        assert licenses.read(tokens)[0] == {x for s in licenses.choices(tokens) for x in s}, tokens
