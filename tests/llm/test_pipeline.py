import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm import test_decontaminate, test_language_id, test_near_dup, test_secrets


def tables(spark, folder):
    rnd = random.Random(11)
    docs = [(i, t, lang) for i, t, lang in test_language_id.rows(160, seed=3)]
    items = [(i, " ".join(rnd.choices(sum(test_language_id.WORDS.values(), []), k=25))) for i in range(6)]
    for i, t, lang in docs[:40]:
        docs.append((200 + i, t + (" extra" if i % 2 else ""), lang))
    for i in range(12):
        docs.append((300 + i, f"intro words {i} " + items[i % 6][1] + " and an end", "en"))
    docs += [(400, "my password = hunter2hunter2 here", "en"), (401, "AKIA" + "Z9" * 10, "en"), (402, "key " + "0af3" * 8, "en")]
    docs += [(500, None, "en"), (501, "", None), (502, "12 34 --", "de"), (503, "the and " * 5000, "en"), docs[3], docs[3], (504, "über " * 3, None)]
    rows = [(i, t, lang, f"src{i % 3}", len(t or ""), 0.5) for i, t, lang in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def brute(docs, items):
    """Ids that remain before packing; random-looking spans are the operator's own and are not in this corpus."""
    left = {i: t for i, t, _ in docs if any(c.isalpha() for c in t or "")}
    groups = test_near_dup.brute(list(left.items()))
    left = {i: t for i, t in left.items() if groups[i] == i}
    found = test_decontaminate.brute(list(left.items()), items)
    left = {i: t for i, t in left.items() if i not in {r[0] for r in found if r[4]}}
    return {i: t for i, t in left.items() if not test_secrets.brute(t)}


def test_against_brute_force(spark, tmp_path):
    docs, items = tables(spark, str(tmp_path))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = brute(docs, items)
    assert {r.doc_id for r in got} == set(want)
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = set()
    for i, t in want.items():
        ids = [*whole.encode(t, add_special_tokens=False).ids, 1]
        pieces |= {(i, at // 4096, zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes())) for at in range(0, len(ids), 4096)}
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in got) == sorted(pieces)


def test_stages_keep_the_columns_and_empty_tables(spark, tmp_path):
    tables(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0)
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"]
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 0


def test_rows_without_an_id(spark, tmp_path):
    rows = [(None, "clean text of words", "en"), (None, "token=abcdefgh", "en"), (1, "clean text of other words", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.text for r in corpus_pipeline.without_secrets(spark, df, str(tmp_path)).collect()} == {"clean text of words", "clean text of other words"}
    spark.createDataFrame([(1, "clean text of words")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.text for r in corpus_pipeline.uncontaminated(spark, df, str(tmp_path)).collect()} == {"token=abcdefgh", "clean text of other words"}


def test_a_contaminated_row_takes_no_clean_row_with_it(spark, tmp_path):
    leak = "one two three four five six seven eight nine ten"
    rows = [(None, leak), (None, "clean text without an id"), (None, None), (1, leak), (1, "clean text that repeats an id"), (2, f"before {leak} after"), (3, "clean")]
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.uncontaminated(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()
    assert {(r.doc_id, r.text) for r in got} == {(None, "clean text without an id"), (None, None), (1, "clean text that repeats an id"), (3, "clean")}
    assert len(got) == 4


def test_one_row_of_each_group_whatever_the_ids(spark, tmp_path):
    base = " ".join(f"w{i}" for i in range(100))
    rows = [(None, base, "a"), (None, base, "b"), (None, base + " x", "c"), (2, "other words of a text", "d"), (2, base + " y", "e"), (1, None, "f"), (1, None, "f"), (None, "alone here", "g"), (3, "three times", "h"), (3, "three times", "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.one_of_each_group(spark, df, str(tmp_path)).collect()
    assert sorted((r.source for r in got)) == ["d", "e", "f", "f", "g", "h"]


def test_languages_are_filled_in_and_texts_stay_without_any(spark, tmp_path):
    rows = [(i, t, lang if i % 3 else None) for i, t, lang in test_language_id.rows(200, seed=4)]
    df = spark.createDataFrame([*rows, (900, "12 34", None), (901, None, "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang for r in corpus_pipeline.known_language(spark, df, str(tmp_path)).collect()}
    truth = {i: lang for i, _, lang in test_language_id.rows(200, seed=4)}
    assert set(got) == set(truth) and all(got[i] == truth[i] for i in truth if i % 3)
    assert sum(got[i] == truth[i] for i in truth) >= 0.97 * len(truth)
    unlabelled = corpus_pipeline.known_language(spark, df.withColumn("lang", df.lang.substr(9, 9)).replace("", None, "lang"), str(tmp_path))
    assert {r.doc_id for r in unlabelled.collect()} == set(truth)
