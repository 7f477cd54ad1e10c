"""Upserts, change logs, XML records, supersession, look-up results and samples against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lithos.operators import analytics, entities, fixes, sample
from lithos.sources import records
from lithos.streaming.upserts import KeyedTable, admitted, known_split


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def plain_upsert(batches):
    table = {}
    for batch in batches:
        for k, v, o in batch:
            if k not in table or o >= table[k][1]:
                table[k] = v, o
    return sorted(((k, *v) for k, v in table.items()), key=str)


def test_batches_in_any_cut_and_again(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(rnd.choice([None, *range(12)]), f"v{i}", rnd.randrange(40) * 1000 + i) for i in range(200)]  # orders differ
    schema = "k int, v string, o long"
    for cut, compact in ((200, 16), (40, 2), (7, 3)):
        batches = [rows[i : i + cut] for i in range(0, len(rows), cut)]
        kept = KeyedTable(spark, f"file://{tmp_path}/t{cut}", "k", "o", compact)
        for n, batch in enumerate(batches):
            kept.merge(spark.createDataFrame(batch, schema), n)
            if n % 5 == 1:  # the driver was lost after the write: the batch comes again
                kept.merge(spark.createDataFrame(batch, schema), n)
        assert rows_of(kept.read()) == plain_upsert(batches)
        done = kept.changes()
        assert rows_of(done.where("action = 'insert'").groupBy("k").count()) == sorted(((k, 1) for k in {r[0] for r in rows}), key=str)
        assert done.count() <= len(rows) and done.groupBy("batch", "k").count().where("count > 1").isEmpty()


def test_a_stream_killed_in_a_batch_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    rows = [(i % 7, f"v{i}", i) for i in range(70)]
    source = f"{tmp_path}/in"
    spark.createDataFrame(rows, "k int, v string, o long").repartition(7, "o").write.parquet(source)
    kept = KeyedTable(spark, f"file://{tmp_path}/table", "k", "o", 4)
    merge, calls = KeyedTable.merge, []

    def dies_once(self, batch, number):
        calls.append(number)
        merge(self, batch, number)
        if number == 2 and calls.count(2) == 1:
            raise RuntimeError("lost")

    monkeypatch.setattr(KeyedTable, "merge", dies_once)
    with pytest.raises(Exception, match="lost"):
        kept.drain(source, "k int, v string, o long")
    kept.drain(source, "k int, v string, o long")
    assert calls.count(2) == 2 and rows_of(kept.read()) == plain_upsert([rows])
    spark.createDataFrame([(3, "new", 1000), (99, "more", 1)], "k int, v string, o long").write.mode("append").parquet(source)
    kept.drain(source, "k int, v string, o long")
    got = {r.k: r.v for r in kept.read().collect()}
    assert got[3] == "new" and got[99] == "more" and len(got) == 8
    with pytest.raises(ValueError):
        KeyedTable(spark, f"file://{tmp_path}/none", "k", "o").read()


def test_known_by_the_first_key_that_any_row_has(spark):
    table = spark.createDataFrame([(1, "c1", "p1"), (2, "c1", "p2"), (3, "", "p3"), (4, None, "")], "id long, cord string, pubmed string")
    rows = spark.createDataFrame([("a", "c1", "p3"), ("b", "cx", "p3"), ("c", "", ""), ("d", None, None), ("e", "cx", "px")], "n string, cord string, pubmed string")
    assert rows_of(known_split(rows, table, ["cord", "pubmed"], "id").select("n", "known", "action")) == [("a", 1, "update"), ("b", 3, "update"), ("c", None, "insert"), ("d", None, "insert"), ("e", None, "insert")]


def test_admission_by_first_titles(spark):
    rows = [(1, "t", "", "x"), (2, "t", "a", "no"), (3, "t", "b", "x"), (4, None, "a", "x"), (5, None, "b", "x"), (6, "u", None, "x"), (7, "u", "c", "x")]
    df = spark.createDataFrame(rows, "id long, title string, abstract string, w string")
    assert [r.id for r in admitted(df, "title", "abstract", "id", F.col("w") == "x").orderBy("id").collect()] == [4, 7]


def plain_fixes(docs, log, keys):
    docs, unmatched = [dict(d) for d in docs], []
    for o, key, value, field, to in sorted(log):
        hit = [d for d in docs if d[key] is not None and str(d[key]) == value]
        for d in hit:
            d[field] = to if field != "year" or to is None else int(to)
        if not hit:
            unmatched.append(o)
    return docs, unmatched


def test_a_log_of_five_hundred_changes_equals_the_loop(spark):
    rnd = random.Random(9)
    keys, fields = ["doi", "pubmed_id", "cord_uid"], ["doi", "pubmed_id", "cord_uid", "journal", "year"]
    some = lambda p: rnd.choice([None, *[f"{p}{i}" for i in range(25)]])
    docs = [{"ord": i, "doi": some("d"), "pubmed_id": some("p"), "cord_uid": some("c"), "journal": "j", "year": 2000 + i % 9, "x": "same"} for i in range(60)]
    log = []
    for o in range(500):
        key = rnd.choice(keys)
        field = rnd.choice(fields)
        to = {"journal": f"j{o}", "year": str(1900 + o)}.get(field) or some(field[0])
        log.append((o, key, f"{key[0]}{rnd.randrange(27)}", field, to))
    df = spark.createDataFrame([tuple(d.values()) for d in docs], "ord long, doi string, pubmed_id string, cord_uid string, journal string, year int, x string")
    fx = spark.createDataFrame(rnd.sample(log, len(log)), "ord long, key string, value string, field string, to string")
    out, left = fixes.applied(df, fx, keys, fields)
    want, unmatched = plain_fixes(docs, log, keys)
    assert rows_of(out) == sorted((tuple(d.values()) for d in want), key=str) and rows_of(left.select("ord")) == sorted(((o,) for o in unmatched), key=str)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    few = fixes.applied(df, fx.limit(3), keys, fields)[0]
    plan = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert plan(few) == plan(out)
    none, left = fixes.applied(df, fx.limit(0), keys, fields)
    assert rows_of(none) == rows_of(df) and left.count() == 0
    assert fixes.applied(df.limit(0), fx, keys, fields)[1].count() == 500


@pytest.mark.parametrize("ranges", [1, 3, 17])
def test_records_at_the_edges_of_byte_ranges(spark, tmp_path, ranges):
    rnd = random.Random(ranges)
    texts = [f'<rec id="{i}">' + "".join(rnd.choices(["x", "é", "\n", "</re", "<recording/>", "漢"], k=rnd.randrange(200))) + "</rec>" for i in range(120)] + ["<rec/>skipped</rec>", "<rec>\n</rec>"]
    path = tmp_path / "in.xml"
    path.write_text("<?xml?>\n<recs>\n" + "\n".join(texts) + "\n</recs>\n", encoding="utf-8")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(64, path.stat().st_size // ranges + 1)))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        read = records.xml_records(spark, str(path), "rec")
        assert read.rdd.getNumPartitions() >= ranges
        assert sorted(r.record for r in read.collect()) == sorted(texts)
        out = f"{tmp_path}/out"
        records.write_records(read.where(F.contains("record", F.lit("漢"))), out, "<recs>", "</recs>")
        again = records.xml_records(spark, out, "rec").collect()
    finally:
        for k, v in zip(("maxPartitionBytes", "openCostInBytes"), before):
            spark.conf.set(f"spark.sql.files.{k}", v)
    digest = lambda xs: sorted(hashlib.md5(x.encode()).hexdigest() for x in xs)
    assert digest(r.record for r in again) == digest(t for t in texts if "漢" in t)
    for f in (tmp_path / "out").glob("part-*"):
        body = f.read_text(encoding="utf-8")
        assert not body or (body.startswith("<recs>\n") and body.endswith("</recs>\n") and body.count("<recs>") == 1)


def test_records_of_nothing(spark, tmp_path):
    (tmp_path / "e.xml").write_text("<recs></recs>")
    assert records.xml_records(spark, str(tmp_path / "e.xml"), "rec").count() == 0
    records.write_records(spark.createDataFrame([(None,)], "record string"), f"{tmp_path}/o", "<a>", "</a>")
    assert spark.read.text(f"{tmp_path}/o").count() == 0


def test_the_newest_file_wins_with_all_its_repeats(spark):
    rows = [("a", "f1", 1), ("a", "f2", 5), ("a", "f2", 5), ("b", "f1", 2), (None, "f1", 3), (None, "f2", 9), ("a", "f1", 0)]
    df = spark.createDataFrame(rows, "k string, f string, o int")
    got = rows_of(records.superseded(df, "k", "f", "o"))
    assert got == sorted([("a", "f2", 5, "f1", 0), ("a", "f2", 5, "f1", 0), ("b", "f1", 2, "f1", 2), (None, "f2", 9, "f1", 3)], key=str)
    assert rows_of(records.first_of_key(df, "k", "f", "o", "o")) == sorted([("a", 1), ("b", 2), (None, 3)], key=str)
    assert records.superseded(df.limit(0), "k", "f", "o").count() == 0


def test_entities_from_lookup_results(spark):
    def b(i, name, lang="en", alias=None, said="en", desc=None):
        extra = f',"alias":{{"xml:lang":"{said}","value":"{alias}"}}' if alias else ""
        extra += f',"entityDescription":{{"xml:lang":"en","value":"{desc}"}}' if desc else ""
        return f'{{"entity":{{"value":"http://x/y/{i}"}},"entityLabel":{{"xml:lang":"{lang}","value":"{name}"}}{extra}}}'

    rows = [b("Q1", "First"), b("Q1", "Aspirin", alias="Ace® tyl"), b("Q1", "Zitrone", "de", "nein"), b("Q1", "Aspirin", alias="abc", desc="drug"), b("Q2", "a/b", alias="longer"), b("Q3", "abc"), "no json", None, "[1]", b("Q4", "Nom", alias="alias fr", said="fr")]
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "o long, j string")
    got = rows_of(entities.folded(entities.bindings(df, "j", "o")))
    assert got == [("Q1", "Aspirin", "drug", ["ace tyl", "ace® tyl", "aspirin"])]
    url = entities.lookup_url("http://api", [("doi", F.col("a")), ("pmid", F.col("b"))])
    df = spark.createDataFrame([("10.1/x", "7", '{"score": 3, "t": "x"}'), (" ", "7", "Not Found"), (None, "", ""), ("", None, None), ("", "1", '"text"')], "a string, b string, r string")
    got = df.select(url.alias("u"), entities.response(F.col("r"), {"score": "double", "t": "string"}).alias("r")).collect()
    assert [(r.u, r.r.ok, r.r.score) for r in got] == [("http://api/doi/10.1/x", True, 3.0), ("http://api/pmid/7", False, None), (None, False, None), (None, False, None), ("http://api/pmid/1", False, None)]


def test_samples_by_hash(spark):
    rows = [(i, "s" if i % 3 else None) for i in range(300)] + [(None, "s"), (5, "s")]
    df = spark.createDataFrame(rows, "id long, s string").repartition(7)
    place = lambda i, seed="": hashlib.md5((f"{seed}:" * bool(seed) + ("" if i is None else str(i))).encode()).hexdigest()
    want = lambda some, k, seed="": sorted(some, key=lambda r: place(r[0], seed))[:k]
    assert sorted(map(str, rows_of(sample.bottom(df, "id", 20, seed="x")))) == sorted(map(str, want(rows, 20, "x")))
    got = rows_of(sample.bottom(df, "id", 15, "s"))
    assert sorted(map(str, got)) == sorted(map(str, want([r for r in rows if r[1]], 15) + want([r for r in rows if not r[1]], 15)))
    assert sample.bottom(df.limit(0), "id", 5, "s").count() == 0 and sample.bottom(df, "id", 999).count() == 302


def test_class_balance(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (0, None), (1, 1)], "a int, b int")
    assert rows_of(analytics.class_balance(df, ["a", "b"])) == [("a", 0, 1, 25.0), ("a", 1, 3, 75.0), ("b", 0, 1, 33.33), ("b", 1, 2, 66.67)]
    assert analytics.class_balance(df.limit(0), ["a"]).count() == 0


def test_attention_records_and_points(spark):
    good = "https://badges.altmetric.com/?size=64&score=3&types=abc"
    ddl = "r struct<altmetric_id: long, score: double, history: map<string,double>, is_oa: boolean, images: struct<large: string>>"
    df = spark.createDataFrame([((7, 1.5, {"1d": 2.0, "1w": 9.0}, True, (good,)),), (None,)], ddl)
    assert [tuple(r.a) if r.a else None for r in df.select(entities.attention(F.col("r")).alias("a")).collect()] == [(7, 1.5, 2.0, 2.0, True, "abc"), None]
    with pytest.raises(Exception, match="not a badge"):
        spark.createDataFrame([((7, 1.5, None, True, (good + "&x=1",)),)], ddl).select(entities.attention(F.col("r")).alias("a")).collect()
    df = spark.createDataFrame([("Point(-1.5 +48)",), ("Point(1 2 3)",), ("point(1 2)",), (None,), ("Point(.5 -0.25)x",)], "p string")
    assert [r[0] and tuple(r[0]) for r in df.select(entities.coordinates(F.col("p"))).collect()] == [(-1.5, 48.0), None, None, None, (0.5, -0.25)]


def test_challenge_and_filled(spark):
    df = spark.createDataFrame([(1, 9.0, ["a"]), (2, 9.0, []), (3, 9.0, None), (4, 1.0, None), (5, None, None)], "i int, s double, l array<string>")
    from lithos.operators import active

    assert [r.i for r in active.challenge(df, "s", 5, "l").collect()] == [2, 3]
    assert rows_of(analytics.filled(df, ["l", "s"])) == [("l", 1, 5), ("s", 4, 5)]
    assert rows_of(analytics.filled(df.limit(0), ["l"])) == [("l", 0, 0)]
