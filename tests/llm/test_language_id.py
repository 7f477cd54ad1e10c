import random

import numpy as np

from lithos.llm import language_id

WORDS = {
    "en": "the and that with from this have were there which would people about through".split(),
    "de": "der die und nicht werden eine auch über schön möglich zwischen während größe".split(),
    "fr": "les des une dans pour était avec être après même français où déjà première".split(),
    "es": "los que una para con está más también después niño año según había".split(),
}


def rows(n=240, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lang = rnd.choice(list(WORDS))
        out.append((i, " ".join(rnd.choices(WORDS[lang], k=rnd.choice([5, 40]))), lang))
    return out


def test_held_out_accuracy_and_defined_results(spark):
    train, test = rows(seed=1), rows(seed=2)
    model = language_id.fit(spark.createDataFrame([*train, (999, None, "en"), (998, "text", None)], "doc_id long, text string, lang string"))
    assert model.languages == {"germanic": ["de", "en"], "romance": ["es", "fr"]}
    data = [*test, (5000, None, "x"), (5001, "", "x"), (5002, "12 34 !?", "x"), (5003, "the " * 50000, "x"), test[0]]
    df = spark.createDataFrame([(*r, 0.5) for r in data], "doc_id long, text string, lang string, score double")
    got = language_id.predict(df, model).collect()
    assert len(got) == len(data) and got[0].asDict().keys() == {"doc_id", "text", "lang", "lang_pred", "score"}
    right = sum(r.lang == r.lang_pred for r in got if r.doc_id < 240)
    assert right >= 0.98 * 241
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (5000, 5001, 5002)) and by[5003].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in got)


def test_one_language_no_language_and_empty(spark):
    df = spark.createDataFrame(rows(20), "doc_id long, text string, lang string")
    one = language_id.fit(df.where("lang = 'fr'"))
    assert {r.lang_pred for r in language_id.predict(df, one).collect()} == {"fr"}
    none = language_id.fit(df.limit(0))
    assert {r.lang_pred for r in language_id.predict(df, none).collect()} == {"und"}
    assert language_id.predict(df.limit(0), one).count() == 0


def test_every_language_is_learnt_and_repeats_count_once(spark):
    many = [(i * 10 + j, f"l{i}x l{i}y l{i}z " * 5, f"t{i:03d}") for i in range(300) for j in range(2)]
    df = spark.createDataFrame([*rows(60), *[(7, "the and that with", "en")] * 5000, *many], "doc_id long, text string, lang string")
    model = language_id.fit(df, sample=2000)
    assert sum(map(len, model.languages.values())) == 304
    got = language_id.predict(spark.createDataFrame([(1, "l7x l7y l7z l7x l7y", None, 1), (2, "the and that with the", "x", 2)], "doc_id long, text string, lang string, __letter int"), model)
    assert got.columns == ["doc_id", "text", "lang", "__letter", "lang_pred", "score"] and {r.doc_id: r.lang_pred for r in got.collect()}[2] == "en"


def test_classify_against_brute_force():
    rng = np.random.default_rng(4)
    model = language_id.Model(["f", "g"], rng.normal(size=(2, 6)), {"f": ["a", "b", "c"], "g": ["d"]}, {p: rng.normal(size=6) for p in (("a", "b"), ("a", "c"), ("b", "c"))})
    x = rng.normal(size=(200, 6))
    langs, scores = language_id.classify(model, x)
    for v, lang, score in zip(x, langs, scores):
        family = max(range(2), key=lambda k: model.family_weights[k] @ v)
        if family == 1:
            assert lang == "d"
            continue
        votes = {k: [0, 0.0] for k in "abc"}
        for (a, b), w in model.pairs.items():
            p = 1 / (1 + np.exp(-3 * (w @ v)))
            votes[a if w @ v > 0 else b][0] += 1
            votes[a][1] += p
            votes[b][1] += 1 - p
        assert lang == max("abc", key=lambda k: votes[k][0] + votes[k][1] / 3) and 0 <= score <= 1
