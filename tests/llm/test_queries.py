"""The registered queries of the learnt operators, over small tables of their own."""

import random
import zlib

import pytest

from lithos.llm import queries
from tests.llm import test_language_id


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    rnd = random.Random(12)
    bad = ["wretch", "vermin", "scum", "filth"]
    docs, labels = [], []
    for i, text, lang in test_language_id.rows(400, seed=5):
        toxic = int(rnd.random() < 0.3)
        words = text.split()
        if toxic:
            at = rnd.randrange(len(words) + 1)
            words[at:at] = rnd.choices(bad, k=6)
        docs.append((i, " ".join(words), lang if i % 11 else None, f"src{i % 3}", 7, "x"))
        if i % 4:
            labels.append((i, 1, toxic))
    docs += [(1000, None, "en", "a", 0, "x"), (1001, "", "en", "a", 0, "x"), (1002, "12 -- 3", "de", "a", 0, "x"), docs[7], docs[7], (1003, "the and with scum vermin " * 9000, "en", "a", 0, "x")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, docs, dict((i, t) for i, _, t in labels)


def test_op2_scores_every_document_and_learns_from_the_others_only(spark, folder):
    path, docs, labels = folder
    got = queries.op2_toxicity(spark, path).collect()
    assert sorted(r.doc_id for r in got) == sorted(d[0] for d in docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert len(held) > 40 and sum(p == t for p, t in held) >= 0.95 * len(held)
    assert {r.doc_id: r.predicted for r in got}[1003] == 1 and all(r.predicted == 0 for r in got if r.doc_id in (1000, 1001, 1002))


def test_op3_predicts_every_document_and_learns_from_the_others_only(spark, folder):
    path, docs, _ = folder
    got = queries.op3_language_id(spark, path).collect()
    assert sorted(r.doc_id for r in got) == sorted(d[0] for d in docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    lang = {d[0]: d[2] for d in docs}
    held = [r for r in got if r.held_out and lang[r.doc_id] and r.doc_id < 1000]
    assert len(held) > 60 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert {r.lang_pred for r in got if r.doc_id in (1000, 1001, 1002)} == {"und"}


def test_dirty_languages_are_bounded(spark):
    from lithos.llm import language_id

    rows = [(i, f"word{i} text", f"l{i:04d}") for i in range(500)] + [(1000 + i, t, lang) for i, t, lang in test_language_id.rows(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(df, languages=10)
    assert sum(map(len, model.languages.values())) == 10 and {"en", "de", "fr", "es"} <= {x for v in model.languages.values() for x in v}
