"""Queries over the document, label, page and benchmark tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lithos.functions import text as tx
from lithos.operators import analytics, dedupe, joins, mentions, ml, release, rules, star
from lithos.session import table
from lithos.sources import files, readers
from lithos.streaming import incremental

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def docs(spark: SparkSession, d: str) -> DataFrame:
    """``documents`` with the first line as ``title`` and what follows it as ``abstract``."""
    at = F.instr("text", "\n")
    return table(spark, d, "documents").select(
        "doc_id", "lang", "source", "text", F.substring_index("text", "\n", 1).alias("title"), F.when(at > 0, F.expr("substring(text, instr(text, '\n') + 1)")).otherwise("").alias("abstract")
    )


D = """d AS (SELECT doc_id, lang, source, text, string_split(text, chr(10))[1] AS title,
  CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS abstract FROM documents)"""


def quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def rx(expr: str, todo: list[tuple[str, str]]) -> str:
    return reduce(lambda acc, r: f"regexp_replace({acc}, {quoted(r[0])}, {quoted(r[1].replace('$', chr(92)))}, 'g')", todo, expr)


def listed(xs) -> str:
    return ", ".join(quoted(x) for x in xs)


def dashed(x: str) -> str:
    return f"translate({x}, '{tx.DASHES}', '{'-' * len(tx.DASHES)}')"


def unpunctuated(x: str) -> str:
    return f"translate({x}, {quoted(tx.PUNCTUATION)}, '')"


def tokens_of(x: str) -> str:
    return f"list_filter(regexp_split_to_array(translate({x}, '{UPPER}', '{LOWER}'), '[^a-z]+'), lambda x: x <> '')"


_T = rx("title", tx.TITLE_RULES)
TITLE = f"CASE WHEN regexp_matches({_T}, {quoted(tx.WRAPPED)}) THEN {rx(_T, tx.UNWRAP_RULES)} ELSE {_T} END"
_A = dashed(rx("abstract", tx.STRIP))
IS_EMPTY = f"{unpunctuated('lower(' + _A + ')')} IN ({listed(tx.EMPTY_ABSTRACTS)})"
ABSTRACT = f"CASE WHEN {IS_EMPTY} THEN '' ELSE {rx(_A, tx.ABSTRACT_RULES)} END"


@query(f"WITH {D} SELECT doc_id, {TITLE} AS title FROM d")
def clean_title(spark, d):
    return docs(spark, d).select("doc_id", tx.clean_title(F.col("title")).alias("title"))


@query(f"WITH {D} SELECT doc_id, {ABSTRACT} AS abstract FROM d")
def clean_abstract(spark, d):
    return docs(spark, d).select("doc_id", tx.clean_abstract(F.col("abstract")).alias("abstract"))


@query(f"WITH {D} SELECT doc_id, md5({unpunctuated('lower(text)')}) AS key FROM d")
def strip_punct_key(spark, d):
    return docs(spark, d).select("doc_id", F.md5(tx.strip_punctuation(F.lower("text"))).alias("key"))


@query(f"WITH {D} SELECT doc_id, {IS_EMPTY} AS is_empty FROM d")
def empty_flag(spark, d):
    return docs(spark, d).select("doc_id", tx.is_empty_abstract(F.col("abstract")).alias("is_empty"))


@query("SELECT doc_id, regexp_matches(text, '[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in tx.CJK) + "]') AS is_cjk FROM documents")
def cjk_flag(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.has_cjk(F.col("text")).alias("is_cjk"))


@query(f"SELECT doc_id, {rx('text', [*tx.CONTROL_RULES, *tx.COMMA_RULES, *tx.BRACKET_RULES])} AS text FROM documents")
def collapse_commas(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.clean_text(F.col("text")).alias("text"))


@query(f"""WITH {D}, c AS (SELECT doc_id, lang, {TITLE} AS title, {ABSTRACT} AS abstract FROM d),
k AS (SELECT *, {unpunctuated("lower(title || ' ' || abstract)")} AS key, length(title) + length(abstract) AS n FROM c),
s AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, doc_id DESC) AS r FROM k)
SELECT lang, count(*) AS n_docs, count(*) FILTER (r = 1) AS n_survivors, count(*) FILTER (r = 1 AND abstract = '') AS n_without_abstract FROM s GROUP BY lang""")
def flagship(spark, d):
    """Clean titles and abstracts, group equal ones, keep the longest and latest of each, count by language."""
    rows = docs(spark, d).select("doc_id", "lang", tx.clean_title(F.col("title")).alias("title"), tx.clean_abstract(F.col("abstract")).alias("abstract"))
    text = tx.strip_punctuation(F.lower(F.concat_ws(" ", "title", "abstract")))
    size = (F.length("title") + F.length("abstract")).alias("n")
    keyed = rows.select("doc_id", "lang", F.sha2(text, 256).alias("key"), size, (F.col("abstract") == "").alias("bare"))
    best = keyed.groupBy("key").agg(F.max(F.struct("n", "doc_id", "lang", "bare")).alias("s"))
    kept = best.select(F.col("s.lang").alias("lang"), F.lit(0).alias("docs"), F.lit(1).alias("survivors"), F.col("s.bare").cast("int").alias("bare"))
    every = table(spark, d, "documents").select("lang", F.lit(1).alias("docs"), F.lit(0).alias("survivors"), F.lit(0).alias("bare"))
    sums = [F.sum(x).alias(y) for x, y in (("docs", "n_docs"), ("survivors", "n_survivors"), ("bare", "n_without_abstract"))]
    return kept.unionByName(every).groupBy("lang").agg(*sums)


@query("""SELECT doc_id FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 OR toxic = 1) l USING (doc_id)
WHERE d.lang IN ('en', 'eng', 'english') AND (regexp_matches(lower(text), '(^|[^a-z0-9_])rights reserved($|[^a-z0-9_])') OR l.doc_id IS NOT NULL)""")
def relevance_filter(spark, d):
    heading = F.array(F.lit("D1"))
    labelled = table(spark, d, "labels").where("quality = 1 or toxic = 1").select("doc_id", heading.alias("mesh")).distinct()
    rows = table(spark, d, "documents").where(release.is_english(F.col("lang"))).join(labelled, "doc_id", "left")
    wanted = release.is_relevant(F.col("text"), F.lit(2018), F.col("mesh"), F.lit(None).cast("array<string>"), "virus", ["rights reserved"], ["D1"])
    return rows.where(wanted).select("doc_id")


@query("""SELECT doc_id, 2 AS n_mentions FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) AND doc_id % 5 <> 0
AND source NOT IN (SELECT 'src' || item_id FROM benchmark WHERE item_id < 3)""")
def flag_filter(spark, d):
    """The final filter: a fifth of the documents has no URL, toxic ones carry a flag, three sources are held back."""
    flags = table(spark, d, "labels").where("toxic = 1").select("doc_id", F.array(F.lit("RemoveFromCorpus?")).alias("annotations")).distinct()
    rows = table(spark, d, "documents").join(flags, "doc_id", "left").withColumn("doi", F.col("source")).withColumn("url", F.when(F.col("doc_id") % 5 != 0, "u"))
    one = lambda x: F.array(F.lit(x))
    rows = rows.withColumns({"entities": one("a"), "variants": F.array().cast("array<string>"), "viral_lineages": one("b")})
    held = table(spark, d, "benchmark").where("item_id < 3").select(F.concat(F.lit("src"), "item_id").alias("doi"))
    return release.final_filter(rows, held).select("doc_id", F.size("entities").alias("n_mentions"))


@query("SELECT doc_id, quality, toxic FROM documents JOIN labels USING (doc_id)")
def labelled_only(spark, d):
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id").select("doc_id", "quality", "toxic")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_processed(spark, d):
    return incremental.remaining(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id")


@query("""WITH c AS (SELECT doc_id, nullif(source, 'src0') AS source_key FROM documents), p AS (SELECT * FROM c WHERE doc_id % 2 = 1),
f AS (SELECT *, row_number() OVER (PARTITION BY source_key ORDER BY doc_id) AS r FROM c WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.source_key IS NOT DISTINCT FROM c.source_key))
SELECT doc_id, source_key, 'previous' AS origin FROM p UNION ALL SELECT doc_id, source_key, 'current' FROM f WHERE r = 1""")
def release_merge(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.nullif("source", F.lit("src0")).alias("source_key"))
    return joins.release_merge(rows.where("doc_id % 2 = 1"), rows, "source_key", "doc_id")


@query("SELECT doc_id AS id FROM labels UNION SELECT item_id FROM benchmark")
def id_union(spark, d):
    return table(spark, d, "labels").select(F.col("doc_id").alias("id")).union(table(spark, d, "benchmark").select("item_id")).distinct()


@query("""WITH l AS (SELECT doc_id, CASE WHEN quality = 1 THEN 'good' ELSE 'poor' END AS label FROM labels UNION ALL SELECT doc_id, 'toxic' FROM labels WHERE toxic = 1)
SELECT d.doc_id, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels FROM documents d LEFT JOIN l USING (doc_id) GROUP BY d.doc_id""")
def label_join(spark, d):
    labels = table(spark, d, "labels")
    named = labels.select("doc_id", F.when(F.col("quality") == 1, "good").otherwise("poor").alias("label"))
    named = named.union(labels.where("toxic = 1").select("doc_id", F.lit("toxic")))
    out = joins.label_join(table(spark, d, "documents").select("doc_id"), ["doc_id"], named, "doc_id", "label", "doc_id")
    return out.select("doc_id", F.array_join("labels", ",").alias("labels"))


@query("""SELECT doc_id, CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id % 100 = d.doc_id % 100 AND (l.quality = 1) IS NOT DISTINCT FROM nullif(d.lang = 'en', false)) THEN 'reused' ELSE 'new' END AS status FROM documents d""")
def memo_split(spark, d):
    """Rows whose key pair, of which one part may be null, an earlier run holds are reused, the others new."""
    rows = table(spark, d, "documents").select("doc_id", (F.col("doc_id") % 100).alias("a"), F.when(F.col("lang") == "en", True).alias("b"))
    before = table(spark, d, "labels").select((F.col("doc_id") % 100).alias("a"), (F.col("quality") == 1).alias("b"), F.lit("x").alias("known"))
    done, todo = joins.memo_split(rows, before, ["a", "b"])
    return done.select("doc_id", F.lit("reused").alias("status")).unionByName(todo.select("doc_id", F.lit("new").alias("status")))


@query("""WITH a AS (SELECT nullif(lang, 'de') AS lang, source, count(*) AS n FROM documents GROUP BY 1, 2),
b AS (SELECT nullif(lang, 'de') AS lang, source, count(*) AS m FROM documents WHERE doc_id % 2 = 0 GROUP BY 1, 2)
SELECT a.lang, a.source, n, m FROM a JOIN b ON a.lang IS NOT DISTINCT FROM b.lang AND a.source IS NOT DISTINCT FROM b.source""")
def composite_null_join(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.nullif("lang", F.lit("de")).alias("lang"), "source")
    a = rows.groupBy("lang", "source").agg(F.count("*").alias("n")).alias("a")
    b = rows.where("doc_id % 2 = 0").groupBy("lang", "source").agg(F.count("*").alias("m")).alias("b")
    on = F.col("a.lang").eqNullSafe(F.col("b.lang")) & F.col("a.source").eqNullSafe(F.col("b.source"))
    return a.join(b, on).select("a.lang", "a.source", "n", "m")


@query("""WITH c AS (SELECT source, lang, count(*) AS n, min(doc_id) AS f FROM documents GROUP BY 1, 2)
SELECT source, lang FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, f) AS r FROM c) WHERE r = 1""")
def modal_name(spark, d):
    return analytics.mode_per_group(table(spark, d, "documents"), "source", "lang", "doc_id").select("source", "lang")


def _keys():
    long_title = F.length("title") >= 20
    low = lambda c: tx.strip_punctuation(F.lower(c))
    return {
        "text": F.md5("text"),
        "title": F.when(long_title, F.md5(F.concat_ws("\x1f", "lang", low(F.col("title"))))),
        "abstract": F.when(F.length("abstract") >= 50, F.md5(F.concat_ws("\x1f", "lang", low(F.col("abstract"))))),
    }


_GROUPS = f"""k AS (SELECT doc_id, 'a' || md5(text) AS key FROM d
  UNION ALL SELECT doc_id, 'b' || md5(lang || chr(31) || {unpunctuated('lower(title)')}) FROM d WHERE length(title) >= 20
  UNION ALL SELECT doc_id, 'c' || md5(lang || chr(31) || {unpunctuated('lower(abstract)')}) FROM d WHERE length(abstract) >= 50),
l AS MATERIALIZED (SELECT doc_id AS u, min(doc_id) OVER (PARTITION BY key) AS v FROM k),
e AS MATERIALIZED (SELECT u, v FROM l WHERE u <> v UNION SELECT v, u FROM l WHERE u <> v),
r(u, v) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.u, e.v FROM r JOIN e ON r.v = e.u),
g AS (SELECT u AS doc_id, min(v) AS group_id FROM r GROUP BY u)"""


@query(f"WITH RECURSIVE {D}, {_GROUPS} SELECT doc_id, group_id FROM g")
def dup_groups(spark, d):
    return dedupe.duplicate_groups(docs(spark, d), "doc_id", _keys()).select(F.col("ord").alias("doc_id"), "group_id")


@query(f"""WITH RECURSIVE {D}, {_GROUPS}, s AS (SELECT group_id, d.doc_id, nullif(title, '') AS title, length(title) AS t, length(abstract) AS a FROM d JOIN g USING (doc_id))
SELECT group_id, count(*) AS n, arg_max(title, row(t, a, doc_id)) FILTER (title IS NOT NULL) AS title, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS doc_ids FROM s GROUP BY group_id""")
def survivor_merge(spark, d):
    rows = docs(spark, d)
    groups = dedupe.duplicate_groups(rows, "doc_id", _keys()).withColumnRenamed("ord", "doc_id")
    rows = rows.select("doc_id", "title", F.length("title").alias("t"), F.length("abstract").alias("a")).join(groups, "doc_id")
    out = dedupe.survivors(rows, "group_id", ["title"], [F.col("t"), F.col("a"), F.col("doc_id")])
    ids = rows.groupBy("group_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: x.cast("string")), ",").alias("doc_ids"))
    return out.join(ids, "group_id").select("group_id", "n", "title", "doc_ids")


@query("SELECT md5(text) AS key, count(*) AS n FROM documents GROUP BY text HAVING count(*) > 1")
def dup_violations(spark, d):
    rows = table(spark, d, "documents").select(F.md5("text").alias("text"))
    return dedupe.violations(rows, ["text"]).select("key", "n")


_URL = [(r"^https?://", ""), (r"^www\.", ""), (r"[?#].*$", ""), (r"/+$", "")]


@query(f"SELECT page_id, {rx('lower(url)', _URL)} AS url FROM pages")
def canonical_url(spark, d):
    return table(spark, d, "pages").select("page_id", tx.applied(F.lower("url"), _URL).alias("url"))


STOP = ["that", "with", "this", "from"]
_LOOKUP = f"""w AS (SELECT item_id, unnest(list_distinct({tokens_of('text')})) AS alias FROM benchmark),
t AS (SELECT alias, count(*) AS n_ids FROM w WHERE length(alias) > 3 AND alias NOT IN ({listed(STOP)}) GROUP BY alias HAVING count(*) >= 2)"""


def _tokens(c):
    return F.filter(F.split(F.translate(c, UPPER, LOWER), "[^a-z]+"), lambda x: x != "")


def _terms(spark, d):
    words = table(spark, d, "benchmark").select(F.col("item_id").alias("id"), F.lit("term").alias("type"), F.explode(F.array_distinct(_tokens(F.col("text")))).alias("name"))
    terms = mentions.term_lookup(words.withColumn("aliases", F.array("name")), stop=STOP)
    return terms.groupBy("alias").agg(F.count_distinct("id").alias("n_ids")).where("n_ids >= 2")


@query(f"WITH {_LOOKUP} SELECT alias, n_ids FROM t")
def term_lookup(spark, d):
    return _terms(spark, d)


_PHRASES = f"""{_LOOKUP}, b AS (SELECT item_id, {tokens_of('text')} AS w FROM benchmark),
p AS (SELECT DISTINCT array_to_string(list_slice(w, i, i + n - 1), ' ') AS alias, n FROM (SELECT w, unnest(range(1, len(w) + 1)) AS i FROM b), range(2, 4) q(n) WHERE i + n - 1 <= len(w)
  UNION SELECT alias, 1 FROM t),
x AS (SELECT doc_id, {tokens_of('text')} AS w FROM documents),
m AS (SELECT doc_id, i - 1 AS pos, n, alias FROM (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM x), range(1, 4) q(n) WHERE i + n - 1 <= len(w)) z JOIN (SELECT DISTINCT alias FROM p) a ON z.g = a.alias)"""


def _phrase_lookup(spark, d):
    """The terms, and all runs of two and three words of the benchmark items."""
    words = table(spark, d, "benchmark").select(_tokens(F.col("text")).alias("w"))

    def runs(n):
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size("w"), F.lit(1))), lambda i: i + n - 1 <= F.size("w"))
        return F.transform(starts, lambda i: F.array_join(F.slice("w", i, n), " "))

    phrases = words.select(F.explode(F.concat(runs(2), runs(3))).alias("alias"))
    return phrases.unionByName(_terms(spark, d).select("alias")).distinct()


def _mentioned(spark, d, only_longest=False):
    rows = table(spark, d, "documents").select("doc_id", _tokens(F.col("text")).alias("w"))
    return mentions.mentions(rows, "w", _phrase_lookup(spark, d), only_longest=only_longest).select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("n").cast("long").alias("n"), "alias")


@query(f"WITH {_PHRASES} SELECT doc_id, pos, n, alias FROM m")
def ngram_mentions(spark, d):
    return _mentioned(spark, d)


@query(f"WITH {_PHRASES} SELECT doc_id, pos, n, alias FROM m")
def sharded_mentions(spark, d):
    """The same places from a trie in many shards, as a dictionary beyond a task's memory is dealt out."""
    rows = table(spark, d, "documents").select("doc_id", _tokens(F.col("text")).alias("w"))
    hits = mentions.sharded_mentions(rows, "w", _phrase_lookup(spark, d), p=mentions.Shards(aliases=500, windows=50_000))
    return hits.select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("n").cast("long").alias("n"), "alias")


@query(f"""WITH {_PHRASES}, c AS (SELECT doc_id, pos AS p, n AS k, unnest(range(pos, pos + n)) AS q FROM m)
SELECT doc_id, pos, n, alias FROM m WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.doc_id = m.doc_id AND c.q = m.pos AND c.k > m.n AND m.pos + m.n <= c.p + c.k)""")
def longest_match(spark, d):
    return _mentioned(spark, d, only_longest=True)


@query(f"""WITH {_LOOKUP}, x AS (SELECT doc_id, {tokens_of('text')} AS w FROM documents),
f AS (SELECT DISTINCT alias, item_id % 7 AS id FROM w JOIN t USING (alias)), o AS (SELECT alias FROM f GROUP BY alias HAVING count(*) = 1)
SELECT doc_id, pos, alias FROM (SELECT doc_id, i - 1 AS pos, w[i] AS alias FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM x)) JOIN o USING (alias)""")
def ambiguity_drop(spark, d):
    """Places of terms that have one candidate only, the candidates being classes of items."""
    items = table(spark, d, "benchmark").select((F.col("item_id") % 7).alias("id"), F.explode(F.array_distinct(_tokens(F.col("text")))).alias("alias"))
    lookup = items.join(_terms(spark, d), "alias").select("alias", "id").distinct()
    rows = table(spark, d, "documents").select("doc_id", _tokens(F.col("text")).alias("w"))
    hits = mentions.mentions(rows, "w", mentions.sole_aliases(lookup))
    return hits.select("doc_id", F.col("pos").cast("long").alias("pos"), "alias")


@query(f"""WITH {D}, h AS (SELECT doc_id, length(title) AS t, strpos(text, 'the') - 1 AS s FROM d WHERE strpos(text, 'the') > 0)
SELECT doc_id, CASE WHEN s + 3 <= t THEN 'title' ELSE 'abstract' END AS section, CASE WHEN s + 3 <= t THEN s ELSE s - t - 1 END AS "start", CASE WHEN s + 3 <= t THEN s + 3 ELSE s + 2 - t END AS "end" FROM h""")
def section_offsets(spark, d):
    rows = docs(spark, d).select("doc_id", F.length("title").cast("long").alias("t"), (F.instr("text", "the") - 1).cast("long").alias("start")).where("start >= 0")
    return mentions.sections(rows.withColumn("end", F.col("start") + 3), "t").select("doc_id", "section", "start", "end")


def _flags_sql() -> str:
    inner = rx("lower(text)", [(r"^\S+", ""), (r"\S+$", "")])
    hits = ", ".join(f"CASE WHEN len(list_intersect(w, [{listed(ws)}])) >= 5 THEN '{name}' END" for name, ws in rules.STOPWORDS.items())
    return f"f AS (SELECT doc_id, lang, coalesce(nullif(array_to_string(list_filter([{hits}], lambda x: x IS NOT NULL), ','), ''), 'english') AS languages FROM (SELECT doc_id, lang, list_distinct(regexp_split_to_array({inner}, '\\s+')) AS w FROM documents))"


@query(f"WITH {_flags_sql()} SELECT doc_id, languages FROM f")
def language_flags(spark, d):
    return table(spark, d, "documents").select("doc_id", rules.language_flags(F.col("text")).alias("languages"))


@query(f"WITH {_flags_sql()} SELECT lang, languages AS predicted, count(*) AS n FROM f GROUP BY 1, 2")
def language_confusion(spark, d):
    rows = table(spark, d, "documents").select("lang", rules.language_flags(F.col("text")).alias("predicted"))
    return rows.groupBy("lang", "predicted").agg(F.count("*").alias("n"))


@query("SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages")
def page_title(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))


@query("SELECT page_id, length(trim(regexp_replace(html, '<[^\\n]*?>', '', 'g'))) AS n_chars FROM pages")
def html_strip(spark, d):
    return table(spark, d, "pages").select("page_id", F.length(F.trim(tx.strip_tags(F.col("html")))).cast("long").alias("n_chars"))


@query("""SELECT page_id, len(x) AS n_links, array_to_string(x, ',') AS links FROM
(SELECT page_id, list_sort(list_distinct(regexp_extract_all(html, 'href="([^"]*)"', 1))) AS x FROM pages)""")
def page_links(spark, d):
    links = files.link_paths(F.col("html"), ['(?<=href=)"[^"]*"'])
    return table(spark, d, "pages").select("page_id", F.size(links).cast("long").alias("n_links"), F.array_join(links, ",").alias("links"))


@query(f"""WITH {D} SELECT doc_id, CASE WHEN regexp_matches(lower(title), '^(retraction|retracted|withdrawn)') THEN 'Retracted' WHEN regexp_matches(lower(title), '^(erratum|correction)') THEN 'Erratum'
WHEN regexp_matches(lower(title), '^(news)') THEN 'News' WHEN regexp_matches(lower(title), '^(editorial|comment)') THEN 'Comment/Editorial' WHEN regexp_matches(lower(title), '^(chapter )') THEN 'Book chapter'
WHEN contains(lower(title), 'meta-analysis') THEN 'Meta-analysis' WHEN regexp_matches(lower(title), '^(review|systematic review)') THEN 'Review' WHEN regexp_matches(lower(title), '^(case report|research)') THEN 'Research' END AS kind FROM d""")
def article_type(spark, d):
    return docs(spark, d).select("doc_id", rules.article_type(F.col("title")).alias("kind"))


_CATS = f"""c AS (SELECT doc_id, CASE WHEN list_has(b, 'Meta-analysis') THEN list_filter(b, lambda x: x <> 'Review') ELSE b END AS b FROM
 (SELECT doc_id, list_concat(CASE WHEN quality = 1 THEN ['Review'] ELSE ['Prognosis'] END, CASE WHEN toxic = 1 THEN ['Meta-analysis', 'Screening'] ELSE []::VARCHAR[] END,
   CASE WHEN regexp_matches(lower(abstract), {quoted(rules.TRIAL)}) THEN ['Clinical Trials'] ELSE []::VARCHAR[] END, CASE WHEN regexp_matches(title, '(?i)Chapter [0-9]') THEN ['Book chapter'] ELSE []::VARCHAR[] END) AS b
  FROM d JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) USING (doc_id))),
k AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(list_intersect(b, [{listed(rules.NON_RESEARCH)}])) > 0 THEN b ELSE list_append(b, 'Research') END)) AS k FROM c)"""


def _categories(spark, d):
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    # The texts are read for their rules before the join, so that they are not shuffled.
    said = docs(spark, d).select("doc_id", rules.said_categories(F.col("title"), F.col("abstract"), F.col("source")).alias("said"))
    rows = said.join(labels, "doc_id")
    base = F.concat(F.when(F.col("quality") == 1, F.array(F.lit("Review"))).otherwise(F.array(F.lit("Prognosis"))), F.when(F.col("toxic") == 1, F.array(F.lit("Meta-analysis"), F.lit("Screening"))).otherwise(F.array().cast("array<string>")))
    return rows.select("doc_id", base.alias("before"), rules.with_said(base, F.col("said")).alias("k"))


@query(f"WITH {D}, {_CATS} SELECT doc_id, array_to_string(k, ',') AS categories FROM k")
def rule_categories(spark, d):
    return _categories(spark, d).select("doc_id", F.array_join("k", ",").alias("categories"))


@query(f"""WITH {D}, {_CATS} SELECT doc_id, array_to_string(list_filter(k, lambda x: x IN ({listed(rules.ARTICLE_TYPES)})), ',') AS types,
array_to_string(list_filter(k, lambda x: x NOT IN ({listed(rules.ARTICLE_TYPES)})), ',') AS topics FROM k""")
def split_types_topics(spark, d):
    rows = _categories(spark, d)
    return rows.select("doc_id", F.array_join(rules.article_types(F.col("k")), ",").alias("types"), F.array_join(rules.topics(F.col("k")), ",").alias("topics"))


@query(f"WITH {D}, {_CATS} SELECT len(k) AS n_categories, count(*) AS n_docs FROM k GROUP BY 1")
def size_histogram(spark, d):
    return _categories(spark, d).groupBy(F.size("k").cast("long").alias("n_categories")).agg(F.count("*").alias("n_docs"))


@query(f"""WITH {D}, {_CATS}, a AS (SELECT category, count(*) AS n FROM (SELECT unnest(k) AS category FROM k) GROUP BY 1),
b AS (SELECT category, sum(n) AS n FROM (SELECT CASE WHEN quality = 1 THEN 'Review' ELSE 'Prognosis' END AS category, 1 AS n FROM (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY 1) JOIN documents USING (doc_id)
 UNION ALL SELECT unnest(['Meta-analysis', 'Screening']), 1 FROM (SELECT doc_id, max(toxic) AS toxic FROM labels GROUP BY 1) JOIN documents USING (doc_id) WHERE toxic = 1) GROUP BY 1)
SELECT category, CAST(a.n - coalesce(b.n, 0) AS BIGINT) AS diff FROM a LEFT JOIN b USING (category) WHERE a.n > coalesce(b.n, 0)""")
def multiset_diff(spark, d):
    one = lambda column, a, b: F.transform(column, lambda x: F.struct(x.alias("category"), F.lit(a).alias("a"), F.lit(b).alias("b")))
    rows = _categories(spark, d).select(F.inline(F.concat(one("k", 1, 0), one("before", 0, 1))))
    return rows.groupBy("category").agg(F.sum(F.col("a") - F.col("b")).alias("diff"), F.sum("a").alias("a")).where("a > 0 and diff > 0").select("category", "diff")


@query("SELECT doc_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 50")
def seeded_sample(spark, d):
    return table(spark, d, "documents").select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(50)


_ENT = "e AS (SELECT doc_id, 'lang' AS type, lang AS name FROM documents UNION ALL SELECT doc_id, 'source', source FROM documents)"
_DIM = "n AS (SELECT type, name, min(doc_id) AS f, count(DISTINCT doc_id) AS doc_count FROM e GROUP BY 1, 2), q AS (SELECT row_number() OVER (ORDER BY f, type, name) AS entity_id, * FROM n)"


def _star(spark, d):
    """Languages and sources as the mentions of a release; every document has a language, the main type."""
    e = lambda kind: F.struct(F.lit(kind).alias("type"), F.col(kind).alias("normalized"), F.col(kind).alias("id"), F.lit(0).alias("start"), F.lit(1).alias("end"), F.lit("title").alias("section"))
    none = [F.lit(None).cast("int").alias(c) for c in ("publish_year", "publish_month", "publish_day")]
    return star.star_tables(table(spark, d, "documents").select(F.col("doc_id").alias("ord"), *none, F.array(e("lang"), e("source")).alias("entities")), "lang")


@query(f"WITH {_ENT}, {_DIM} SELECT entity_id, type, name, doc_count FROM q")
def entity_dim(spark, d):
    return _star(spark, d)["entities"].select("entity_id", "type", "name", "doc_count")


@query(f"WITH {_ENT}, {_DIM} SELECT DISTINCT doc_id, entity_id FROM e JOIN q USING (type, name)")
def annotation_fact(spark, d):
    return _star(spark, d)["annotations"].select(F.col("document_id").alias("doc_id"), "entity_id")



@query("""WITH l AS (SELECT conv_id, role, turn, text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn DESC, text DESC) AS r FROM conversations)
SELECT conv_id, role, turn, md5(text) AS text_key FROM l WHERE r = 1""")
def file_supersede(spark, d):
    last = readers.latest_per_key(table(spark, d, "conversations").withColumn("key", F.struct("conv_id", "role")), "key", "turn", "text")
    return last.select("conv_id", "role", "turn", F.md5("text").alias("text_key"))


@query("""WITH x AS (SELECT toxic AS t, quality AS q, d.lang FROM documents d JOIN labels USING (doc_id)), y AS (SELECT 'toxic' AS label, t AS truth, CAST(lang = 'en' AS INTEGER) AS pred FROM x UNION ALL SELECT 'quality', q, CAST(lang IN ('en', 'fr') AS INTEGER) FROM x),
c AS (SELECT label, count(*) FILTER (truth = 1 AND pred = 1) AS tp, count(*) FILTER (truth <> 1 AND pred = 1) AS fp, count(*) FILTER (truth = 1 AND pred <> 1) AS fn, count(*) FILTER (truth <> 1 AND pred <> 1) AS tn FROM y GROUP BY label),
m AS (SELECT * FROM c UNION ALL SELECT 'MICRO', sum(tp), sum(fp), sum(fn), sum(tn) FROM c),
s AS (SELECT *, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 0) AS p, coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 0) AS r FROM m),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f1 FROM s),
o AS (SELECT * FROM f UNION ALL SELECT 'MACRO', sum(tp), sum(fp), sum(fn), sum(tn), avg(p), avg(r), avg(f1) FROM f WHERE label <> 'MICRO')
SELECT label, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, round(p, 6) AS p, round(r, 6) AS r, round(f1, 6) AS f1 FROM o""")
def eval_prf(spark, d):
    rows = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    one = lambda name, truth, pred: F.struct(F.lit(name).alias("label"), F.col(truth).alias("truth"), pred.cast("int").alias("pred"))
    long = rows.select(F.inline(F.array(one("toxic", "toxic", F.col("lang") == "en"), one("quality", "quality", F.col("lang").isin("en", "fr")))))
    return analytics.prf(long, "truth", "pred").select("label", "tp", "fp", "fn", "tn", *[F.round(c, 6).alias(c) for c in ("p", "r", "f1")])


@query("SELECT vec_id, list_max(embedding) AS max_v FROM embeddings WHERE list_max(embedding) < 0.3")
def undecided(spark, d):
    return table(spark, d, "embeddings").where(ml.undecided(F.col("embedding"), F.lit(0.3))).select("vec_id", F.array_max("embedding").alias("max_v"))
