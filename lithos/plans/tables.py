"""Queries over the tables for upserts, change logs, supersession by file, XML records, look-up results and samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.operators import active, analytics, entities, fixes, joins, sample
from lithos.session import scratch, table
from lithos.sources import records
from lithos.streaming import upserts

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return add


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def events_upserted(spark, d):
    """The last event of every user, as a table that a stream of files has filled batch by batch."""
    events = table(spark, d, "events").withColumn("at", F.struct("ts", "event_id"))
    source = scratch(spark, "event-files")
    events.repartition(8, "event_id").write.parquet(source)
    kept = upserts.KeyedTable(spark, scratch(spark, "events-by-user"), "user_id", "at", compact_every=3)
    kept.drain(source, events.schema, files_per_batch=2)
    return kept.read().select("user_id", "event_id", "event_type", "value")


_IDS = """r AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN source ELSE '' END AS cord, CAST(doc_id AS VARCHAR) AS pubmed FROM documents),
t AS (SELECT doc_id, CASE WHEN toxic = 1 THEN 'src' || (doc_id % 50) END AS cord, CAST(doc_id AS VARCHAR) AS pubmed FROM labels)"""


@query(f"""WITH {_IDS}, c AS (SELECT cord, min(doc_id) AS i FROM t WHERE cord <> '' GROUP BY 1), p AS (SELECT pubmed, min(doc_id) AS i FROM t GROUP BY 1)
SELECT doc_id, coalesce(c.i, p.i) AS known, CASE WHEN coalesce(c.i, p.i) IS NULL THEN 'insert' ELSE 'update' END AS action FROM r LEFT JOIN c USING (cord) LEFT JOIN p USING (pubmed)""")
def known_split(spark, d):
    """Which documents are updates of rows known by one id or else another, and which are new."""
    pubmed = F.col("doc_id").cast("string").alias("pubmed")
    rows = table(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.col("source")).otherwise("").alias("cord"), pubmed)
    known = table(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 1, F.concat(F.lit("src"), F.col("doc_id") % 50)).alias("cord"), pubmed)
    return upserts.known_split(rows, known, ["cord", "pubmed"], "doc_id").select("doc_id", "known", "action")


_TITLED = "SELECT doc_id, lang, text, string_split(text, chr(10))[1] AS title, CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract FROM documents"


@query(f"""WITH t AS ({_TITLED}), a AS (SELECT *, row_number() OVER (PARTITION BY title ORDER BY doc_id) AS r FROM t WHERE abstract <> ''),
w AS (SELECT doc_id, lang FROM a WHERE r = 1 AND regexp_matches(lower(text), '(^|[^a-z0-9_])(the|une|die|que)($|[^a-z0-9_])'))
SELECT lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id) AS k FROM w) WHERE k <= 20""")
def admitted_sample(spark, d):
    """Twenty documents of each language among those with an abstract, a title not seen before and a keyword."""
    at = F.instr("text", "\n")
    rows = table(spark, d, "documents").select("doc_id", "lang", "text", F.substring_index("text", "\n", 1).alias("title"), F.when(at > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise("").alias("abstract"))
    wanted = F.lower("text").rlike(r"(^|[^a-z0-9_])(the|une|die|que)($|[^a-z0-9_])")
    return sample.bottom(upserts.admitted(rows, "title", "abstract", "doc_id", wanted), "doc_id", 20, "lang").select("lang", "doc_id")


@query("SELECT lang, doc_id FROM documents ORDER BY md5('7:' || doc_id), doc_id LIMIT 200")
def shuffled_sample(spark, d):
    """Two hundred documents in a seeded random order's beginning."""
    return sample.bottom(table(spark, d, "documents"), "doc_id", 200, seed="7").select("lang", "doc_id")


def _fixes(spark, d):
    """A rename for every nation's supplier, and a change that names it by its new name; the nations' order is reversed for every fifth."""
    n = table(spark, d, "nation").join(table(spark, d, "supplier").where("s_suppkey % 3 = 0"), F.col("n_nationkey") * 3 == F.col("s_suppkey"), "left")
    late = F.col("n_nationkey") % 5 == 0
    name = F.coalesce("s_name", F.concat(F.lit("none"), "n_nationkey"))
    renamed = F.concat(F.lit("N"), "n_nationkey")
    one = lambda o, value, field, to: F.struct(o.cast("long").alias("ord"), F.lit("s_name").alias("key"), value.alias("value"), F.lit(field).alias("field"), to.cast("string").alias("to"))
    k = F.col("n_nationkey") * 2
    return n.select(F.inline(F.array(one(F.when(late, k + 1).otherwise(k), name, "s_name", renamed), one(F.when(late, k).otherwise(k + 1), renamed, "s_acctbal", F.col("n_nationkey") + 0.5))))


@query("""SELECT s_suppkey, CASE WHEN n_nationkey IS NULL THEN s_name ELSE 'N' || n_nationkey END AS s_name, CASE WHEN n_nationkey IS NULL OR n_nationkey % 5 = 0 THEN s_acctbal ELSE n_nationkey + 0.5 END AS s_acctbal
FROM supplier LEFT JOIN nation ON n_nationkey * 3 = s_suppkey""")
def fixed_suppliers(spark, d):
    """Suppliers after a log of changes in order, of which some name a key that an earlier one has changed, or a later one will."""
    out, _ = fixes.applied(table(spark, d, "supplier"), _fixes(spark, d), ["s_name"], ["s_name", "s_acctbal"])
    return out.select("s_suppkey", "s_name", "s_acctbal")


@query("""WITH n AS (SELECT n_nationkey AS k, s_suppkey FROM nation LEFT JOIN supplier ON n_nationkey * 3 = s_suppkey)
SELECT k * 2 + 1 AS ord FROM n WHERE s_suppkey IS NULL UNION ALL SELECT k * 2 FROM n WHERE s_suppkey IS NULL OR k % 5 = 0""")
def unmatched_fixes(spark, d):
    """The changes of that log that met no supplier when their turn came."""
    return fixes.applied(table(spark, d, "supplier"), _fixes(spark, d), ["s_name"], ["s_name", "s_acctbal"])[1].select("ord")


@query("SELECT page_id, md5(html) AS digest FROM pages WHERE strpos(html, '<title>') > 0")
def xml_round_trip(spark, d):
    """Pages with a title, written as XML records, read in byte ranges, filtered, written out as they stood and read again."""
    escaped = F.replace(F.replace(F.replace("html", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    rows = table(spark, d, "pages").where("html is not null").select(F.concat(F.lit('<page id="'), "page_id", F.lit('">\n'), escaped, F.lit("</page>")).alias("record"))
    first, second = scratch(spark, "xml"), scratch(spark, "xml")
    records.write_records(rows, first, "<pages>", "</pages>")
    some = records.xml_records(spark, first, "page").where(F.contains("record", F.lit("&lt;title&gt;")))
    records.write_records(some, second, "<pages>", "</pages>")
    found = records.xml_records(spark, second, "page")
    body = F.expr("substring(record, instr(record, '\n') + 1, length(record) - instr(record, '\n') - 7)")
    plain = F.replace(F.replace(F.replace(body, F.lit("&gt;"), F.lit(">")), F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))
    return found.select(F.regexp_extract("record", 'id="([0-9]+)"', 1).cast("long").alias("page_id"), F.md5(plain).alias("digest"))


@query("""WITH c AS (SELECT conv_id, turn, role, 'day-' || (9 - turn // 3) AS day FROM conversations), m AS (SELECT conv_id, max(day) AS newest, min(day) AS first_file FROM c GROUP BY 1),
f AS (SELECT c.conv_id, min(turn) AS first_order FROM c JOIN m ON c.conv_id = m.conv_id AND c.day = m.first_file GROUP BY 1)
SELECT c.conv_id, turn, role, day, first_file, first_order FROM c JOIN m ON c.conv_id = m.conv_id AND c.day = m.newest JOIN f ON f.conv_id = c.conv_id""")
def superseded_by_file(spark, d):
    """Turns laid out as dated files: of each conversation those in the newest file that has any, and its first place."""
    path = scratch(spark, "days")
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", F.concat(F.lit("day-"), 9 - F.floor(F.col("turn") / 3)).alias("day"))
    rows.write.partitionBy("day").parquet(path)
    read = spark.read.parquet(path).select("conv_id", "turn", "role", F.regexp_extract("_metadata.file_path", "/day=([^/]+)/", 1).alias("day"))
    return records.superseded(read, "conv_id", "day", "turn")


_BINDING = """b AS (SELECT event_id AS o, 'Q' || (user_id % 50) AS id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_type || CASE WHEN event_id % 11 = 0 THEN '/' ELSE ' ' END || (event_id % 13) END AS name,
CASE WHEN event_id % 3 = 0 THEN 'Alias® ' || json_extract_string(props, '$.k') END AS alias FROM events), n AS (SELECT * FROM b WHERE name IS NOT NULL),
f AS (SELECT id, arg_max(name, o) AS name FROM n GROUP BY id), a AS (SELECT id, alias AS x FROM n WHERE alias IS NOT NULL UNION SELECT id, trim(replace(alias, '®', '')) FROM n WHERE alias IS NOT NULL UNION SELECT id, name FROM f),
g AS (SELECT id, string_agg(DISTINCT lower(trim(x)), '|' ORDER BY lower(trim(x))) AS aliases FROM a WHERE strpos(x, '/') = 0 AND length(x) > 3 GROUP BY id)"""


@query(f"WITH {_BINDING} SELECT id, name, aliases FROM f JOIN g USING (id) WHERE strpos(name, '/') = 0")
def folded_entities(spark, d):
    """Entities from look-up results in JSON: last English name, aliases of all rows."""
    e = F.col("event_id")
    name = F.concat("event_type", F.when(e % 11 == 0, "/").otherwise(" "), e % 13)
    said = lambda lang, value: F.struct(lang.alias("xml:lang"), value.alias("value"))
    k = F.variant_get(F.parse_json("props"), "$.k", "string")
    binding = F.to_json(F.struct(
        F.struct(F.concat(F.lit("http://example.org/entity/Q"), F.col("user_id") % 50).alias("value")).alias("entity"),
        said(F.when(e % 7 == 0, "de").otherwise("en"), name).alias("entityLabel"),
        F.when(e % 3 == 0, said(F.lit("en"), F.concat(F.lit("Alias® "), k))).alias("alias"),
    ))
    found = entities.folded(entities.bindings(table(spark, d, "events").select("event_id", binding.alias("json")), "json", "event_id"))
    return found.select("id", "name", F.array_join("aliases", "|").alias("aliases"))


@query("SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS last_part FROM pages")
def url_last_part(spark, d):
    return table(spark, d, "pages").select("page_id", entities.last_part(F.col("url")).alias("last_part"))


@query("""SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'https://api.example.org/doi/10.1/' || doc_id WHEN doc_id % 3 = 1 THEN 'https://api.example.org/pmid/' || doc_id WHEN trim(source) <> '' THEN 'https://api.example.org/uri/' || source END AS url FROM documents""")
def lookup_urls(spark, d):
    """Where to ask about each document, by the first of its ids."""
    i, k = F.col("doc_id"), F.col("doc_id") % 3
    ids = [("doi", F.when(k == 0, F.concat(F.lit("10.1/"), i))), ("pmid", F.when(k == 1, i.cast("string")).otherwise(" ")), ("uri", F.col("source"))]
    return table(spark, d, "documents").select("doc_id", entities.lookup_url("https://api.example.org", ids).alias("url"))


@query("""SELECT 'quality' AS label, quality AS value, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS percent FROM labels WHERE quality IS NOT NULL GROUP BY quality
UNION ALL SELECT 'toxic', toxic, count(*), round(100.0 * count(*) / sum(count(*)) OVER (), 2) FROM labels WHERE toxic IS NOT NULL GROUP BY toxic""")
def class_balance(spark, d):
    """How many rows, and what percentage, have each value of each label."""
    return analytics.class_balance(table(spark, d, "labels"), ["quality", "toxic"])


_TOPICS = "x AS (SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, [event_type, 'u' || (user_id % 20), event_type] AS topics FROM events)"


@query(f"""WITH {_TOPICS}, e AS (SELECT day, topic, count(*) AS n FROM (SELECT DISTINCT event_id, day, unnest(topics) AS topic FROM x) GROUP BY 1, 2),
b AS (SELECT topic FROM e GROUP BY topic ORDER BY sum(n) DESC, topic LIMIT 10), t AS (SELECT day, count(*) AS total FROM x GROUP BY 1)
SELECT t.day AS period, b.topic, coalesce(n, 0) AS n, round(100 * coalesce(n, 0) / total, 2) AS percent, total FROM t CROSS JOIN b LEFT JOIN e ON e.day = t.day AND e.topic = b.topic""")
def top_topic_shares(spark, d):
    """Each day's share of the ten topics that are most frequent over all days, zero filled."""
    day = F.to_date("ts").cast("string").alias("day")
    rows = table(spark, d, "events").select(day, F.array(F.col("event_type"), F.concat(F.lit("u"), F.col("user_id") % 20), F.col("event_type")).alias("topics"))
    return analytics.top_shares(rows, "day", "topics")


@query("""WITH m AS (SELECT DISTINCT * FROM (SELECT doc_id, lang AS virus, 'source' AS type, source AS name FROM documents UNION ALL SELECT doc_id, lang, 'size', CAST(length(text) % 30 AS VARCHAR) FROM documents)),
o AS (SELECT type, name, count(DISTINCT doc_id) AS overall FROM m GROUP BY 1, 2), b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY overall DESC, name) AS r FROM o) WHERE r <= 15),
c AS (SELECT virus, type, name, count(*) AS n FROM m GROUP BY 1, 2, 3)
SELECT v.virus, b.type, b.name, coalesce(n, 0) AS n, overall FROM (SELECT DISTINCT virus FROM m) v CROSS JOIN b LEFT JOIN c ON c.virus = v.virus AND c.type = b.type AND c.name = b.name""")
def top_by_overall(spark, d):
    """For each language, documents with the fifteen names of a kind that most documents have."""
    one = lambda kind, name: F.struct(F.lit(kind).alias("type"), name.cast("string").alias("name"))
    rows = table(spark, d, "documents").select("doc_id", F.col("lang").alias("virus"), F.inline(F.array(one("source", F.col("source")), one("size", F.length("text") % 30))))
    return analytics.top_by_overall(rows, "doc_id", "virus", "type", "name")


@query("""WITH a AS (SELECT CAST(user_id % 40 AS VARCHAR) AS k, count(*) AS n FROM events WHERE value > 60 GROUP BY 1)
SELECT event_type, CASE WHEN a.n < 30 THEN 'Other' ELSE k END AS bucket, count(*) AS n FROM events JOIN a ON k = CAST(user_id % 40 AS VARCHAR) WHERE value > 60 GROUP BY 1, 2""")
def rare_fold_by_type(spark, d):
    """Counts by type and user class, in which classes that are rare over all types are one."""
    rows = table(spark, d, "events").where("value > 60").select("event_type", (F.col("user_id") % 40).cast("string").alias("k"))
    return analytics.rare_fold_by(rows, "event_type", "k", 30)


@query("""WITH x AS (SELECT DISTINCT user_id, CAST(month(ts) * 100 + day(ts) AS BIGINT) AS year, event_type AS type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_id % 2 AS s FROM events),
y AS (SELECT DISTINCT user_id, year, type, CASE WHEN k % 20 = 0 THEN '-' ELSE 'C' || (k % 20) END AS id, (k % 20) * 2 + s AS text FROM x WHERE type <> 'error')
SELECT year, type, id, count(*) AS n FROM y WHERE id <> '-' GROUP BY 1, 2, 3""")
def concept_counts(spark, d):
    """Concepts by day over the distinct ones of each user, in each spelling; errors and placeholder ids are none."""
    k = F.variant_get(F.parse_json("props"), "$.k", "long") % 20
    rows = table(spark, d, "events").select("user_id", (F.month("ts") * 100 + F.day("ts")).cast("long").alias("year"), F.col("event_type").alias("type"), F.when(k == 0, "-").otherwise(F.concat(F.lit("C"), k)).alias("id"), (k * 2 + F.col("event_id") % 2).alias("text"))
    return analytics.concept_years(rows, "user_id", "year", "error")


@query("""WITH x AS (SELECT user_id % 40 AS k, day(ts) < 15 AS b FROM events), t AS (SELECT count(*) FILTER (b) AS tb, count(*) FILTER (NOT b) AS ta FROM x),
p AS (SELECT k, round(100.0 * count(*) FILTER (b) / tb, 6) AS before, round(100.0 * count(*) FILTER (NOT b) / ta, 6) AS after FROM x, t GROUP BY k, tb, ta)
SELECT k, before, after, round(after - before, 6) AS change FROM p ORDER BY change DESC, k LIMIT 8""")
def top_changes(spark, d):
    """The eight user classes whose share of the events rose most from the first half of the month to the second."""
    early = F.day("ts") < 15
    return analytics.top_changes(table(spark, d, "events").withColumn("k", F.col("user_id") % 40), "k", early, ~early)


@query("""SELECT doc_id, doc_id * 3 AS altmetric_id, CAST(length(text) AS DOUBLE) AS score, CAST(doc_id % 9 AS DOUBLE) AS score_1day, CAST(doc_id % 9 AS DOUBLE) AS score_1week, lang = 'en' AS openaccess, source AS badgetype FROM documents WHERE doc_id % 2 = 0""")
def attention_columns(spark, d):
    """What a release holds of attention records, of every other document's."""
    i = F.col("doc_id")
    badge = F.concat(F.lit("https://badges.altmetric.com/?size=320&score="), i, F.lit("&types="), "source")
    record = F.struct(
        (i * 3).alias("altmetric_id"), F.length("text").cast("double").alias("score"), F.create_map(F.lit("1d"), (i % 9).cast("double"), F.lit("1w"), F.lit(99.0)).alias("history"),
        (F.col("lang") == "en").alias("is_oa"), F.struct(badge.alias("large")).alias("images"),
    )
    rows = table(spark, d, "documents").select("doc_id", F.when(i % 2 == 0, record).alias("r"))
    return rows.select("doc_id", entities.attention(F.col("r")).alias("a")).where("a is not null").select("doc_id", "a.*")


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_suppkey + 0.5 AS DOUBLE) END AS longitude, CASE WHEN s_suppkey % 4 <> 0 THEN CAST(s_nationkey AS DOUBLE) END AS latitude FROM supplier""")
def point_coordinates(spark, d):
    """Longitude and latitude of points as text; of every fourth supplier the text is none."""
    k = F.col("s_suppkey")
    text = F.when(k % 4 == 0, "unknown").otherwise(F.concat(F.lit("Point("), k, F.lit(".5 "), "s_nationkey", F.lit(")")))
    found = table(spark, d, "supplier").select("s_suppkey", entities.coordinates(text).alias("p"))
    return found.select("s_suppkey", "p.longitude", "p.latitude")


@query("SELECT doc_id FROM documents WHERE n_chars > 2000 AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def challenge_set(spark, d):
    """Long documents without a label, as those of much attention that a model should decide."""
    named = table(spark, d, "labels").select("doc_id", F.lit("labelled").alias("label"))
    rows = joins.label_join(table(spark, d, "documents").select("doc_id", "n_chars"), ["doc_id"], named, "doc_id", "label", "doc_id")
    return active.challenge(rows, "n_chars", 2000, "labels").select("doc_id")


@query("""SELECT 'labels' AS "column", count(DISTINCT l.doc_id) AS n, count(DISTINCT d.doc_id) AS total FROM documents d LEFT JOIN labels l USING (doc_id)
UNION ALL SELECT 'lang', count(*) FILTER (lang <> 'de'), count(*) FROM documents""")
def filled_columns(spark, d):
    """How many documents have a label in their array, and how many a language that counts."""
    named = table(spark, d, "labels").select("doc_id", F.lit("labelled").alias("label"))
    rows = table(spark, d, "documents").select("doc_id", F.nullif("lang", F.lit("de")).alias("lang"))
    rows = joins.label_join(rows, ["doc_id"], named, "doc_id", "label", "doc_id")
    return analytics.filled(rows, ["labels", "lang"])
