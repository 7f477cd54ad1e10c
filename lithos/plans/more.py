"""Further queries: dictionaries, classes, shares, selections and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.functions import dates
from lithos.operators import analytics, mentions, ml, web
from lithos.session import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS concept, count(DISTINCT o_custkey) AS n FROM orders GROUP BY 1, 2")
def concept_years(spark, d):
    """Distinct holders of a concept by year."""
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("concept")).agg(F.count_distinct("o_custkey").alias("n"))


@query("SELECT p_brand AS brand, arg_max(p_partkey, row(p_retailprice, p_partkey)) AS best, max(p_retailprice) AS price FROM part GROUP BY 1")
def best_configuration(spark, d):
    """The best row of each group, the larger key among equals."""
    return table(spark, d, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.max_by("p_partkey", F.struct("p_retailprice", "p_partkey")).alias("best"), F.max("p_retailprice").alias("price"))


@query("""WITH c AS (SELECT CASE WHEN source IN ('src0', 'src1') THEN source ELSE 'other' END AS bucket, lang, count(*) AS n FROM documents GROUP BY 1, 2)
SELECT bucket, lang, n, round(n / sum(n) OVER (PARTITION BY bucket), 6) AS share FROM c""")
def share_within(spark, d):
    """Shares of languages within folded sources."""
    bucket = F.when(F.col("source").isin("src0", "src1"), F.col("source")).otherwise("other")
    rows = analytics.crosstab(table(spark, d, "documents"), bucket, F.col("lang"))
    return rows.select(F.col("a").alias("bucket"), F.col("b").alias("lang"), "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


@query("SELECT n, brand, type FROM (SELECT count(*) AS n, p_brand AS brand, p_type AS type FROM part GROUP BY 2, 3) ORDER BY n DESC, brand DESC, type DESC LIMIT 20")
def top_tuples(spark, d):
    """A top-k report by the whole tuple."""
    counts = table(spark, d, "part").groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("type")).agg(F.count("*").alias("n"))
    return counts.select("n", "brand", "type").orderBy(F.desc("n"), F.desc("brand"), F.desc("type")).limit(20)


@query("""SELECT label, count(*) FILTER (list_max(embedding) > 0.3) AS above, count(*) FILTER (list_max(embedding) < 0.25) AS below, count(*) AS n FROM embeddings GROUP BY 1""")
def confidence_counts(spark, d):
    top = F.array_max("embedding")
    return table(spark, d, "embeddings").groupBy("label").agg(F.count_if(top > F.lit(0.3)).alias("above"), F.count_if(top < F.lit(0.25)).alias("below"), F.count("*").alias("n"))


@query("SELECT label, arg_max(vec_id, row(embedding[1], vec_id)) AS vec_id FROM embeddings GROUP BY 1")
def most_confident(spark, d):
    """Of each label the row with the highest score, the last among equals."""
    return table(spark, d, "embeddings").groupBy("label").agg(F.max_by("vec_id", F.struct(F.get("embedding", F.lit(0)), "vec_id")).alias("vec_id"))


@query("""WITH RECURSIVE e AS (SELECT CAST(n_nationkey AS BIGINT) AS child, CAST(n_nationkey // 2 AS BIGINT) AS parent FROM nation WHERE n_nationkey > 1),
t(node, depth) AS (SELECT CAST(1 AS BIGINT), 0 UNION ALL SELECT child, depth + 1 FROM t JOIN e ON node = parent) SELECT node, depth FROM t""")
def transitive_classes(spark, d):
    """All classes below one, with their depth; nations stand in for classes, halved keys for parents."""
    k = F.col("n_nationkey").cast("long")
    edges = table(spark, d, "nation").where("n_nationkey > 1").select(k.alias("child"), F.floor(k / 2).cast("long").alias("parent"))
    return web.transitive(edges, 1)


@query("""SELECT r_name || '|' || n_name AS id, unnest([r_name || ' ' || n_name, n_name || ' of ' || r_name, r_name || ' ' || n_name || ' protein']) AS alias FROM region, nation""")
def template_phrases(spark, d):
    """Phrases from every pair of two small dictionaries."""
    one = lambda t, c: table(spark, d, t).select(F.col(c).alias("id"), F.array(c).alias("aliases"))
    return web.protein_phrases(one("region", "r_name"), one("nation", "n_name"))


@query("SELECT s_nationkey AS id, count(*) AS n, string_agg(s_name, ';' ORDER BY s_name) AS aliases FROM supplier GROUP BY 1")
def fold_entities(spark, d):
    """Rows of one id folded into an entity with its sorted aliases."""
    return table(spark, d, "supplier").groupBy(F.col("s_nationkey").alias("id")).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("s_name")), ";").alias("aliases"))


@query("SELECT DISTINCT lower(trim(p_name)) AS alias FROM part WHERE length(trim(p_name)) > 3 AND NOT contains(p_name, '/')")
def alias_hygiene(spark, d):
    terms = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.lit("part").alias("type"), F.col("p_name").alias("name"), F.array("p_name").alias("aliases"))
    return mentions.term_lookup(terms).select("alias").distinct()


@query("""SELECT regexp_extract(lower(url), '^https?://(?:www\\.)?([^/?#]+)', 1) AS host, count(*) AS n FROM pages WHERE NOT contains(url, 'ncbi.nlm.nih.gov') AND NOT ends_with(url, '.pdf') GROUP BY 1""")
def page_hosts(spark, d):
    """Pages by host, of the candidates for scraping."""
    rows = table(spark, d, "pages").where(F.size(web.candidate_urls(F.array("url"))) > 0)
    return rows.groupBy(F.regexp_extract(F.lower("url"), r"^https?://(?:www\.)?([^/?#]+)", 1).alias("host")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, CASE WHEN length(text) > 50 THEN left(text, 47) || '...' ELSE text END AS short FROM documents")
def truncated(spark, d):
    short = F.when(F.length("text") > 50, F.concat(F.left("text", F.lit(47)), F.lit("..."))).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", short.alias("short"))


@query("SELECT o_orderkey, CAST(epoch(CAST(o_orderdate AS DATE)) + 43200 AS BIGINT) AS epoch FROM orders")
def epoch_noon(spark, d):
    y, m, day = F.year("o_orderdate"), F.month("o_orderdate"), F.day("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", dates.epoch_noon(y, m, day).alias("epoch"))


@query("""WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y') ELSE '' END AS t FROM orders)
SELECT o_orderkey, TRY_CAST(left(t, 4) AS INTEGER) AS year, CASE WHEN length(t) = 10 THEN CAST(substr(t, 6, 2) AS INTEGER) END AS month, CASE WHEN length(t) = 10 THEN CAST(substr(t, 9, 2) AS INTEGER) END AS day FROM x""")
def partial_dates(spark, d):
    k = F.col("o_orderkey") % 3
    t = F.when(k == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k == 1, F.date_format("o_orderdate", "yyyy")).otherwise("")
    rows = table(spark, d, "orders").select("o_orderkey", t.alias("t"))
    return rows.select("o_orderkey", dates.parse_partial(F.col("t")).alias("p")).select("o_orderkey", "p.*")


@query("SELECT count(*) FILTER (event_type = 'purchase' AND value > 50) AS n, count(*) AS total, round(100 * count(*) FILTER (event_type = 'purchase' AND value > 50) / count(*), 1) AS percent FROM events")
def share_where(spark, d):
    """A count under a condition with its percentage."""
    return analytics.share_where(table(spark, d, "events"), (F.col("event_type") == "purchase") & (F.col("value") > 50))


@query("SELECT event_type, CAST(date_trunc('month', ts) AS DATE) AS month, count(*) AS n FROM events GROUP BY 1, 2")
def monthly_counts(spark, d):
    return analytics.monthly(table(spark, d, "events"), F.to_date("ts"), "event_type")


@query("""WITH r AS (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' ELSE 'other' END AS branch, o_custkey % 20 AS topic, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders),
t AS (SELECT branch, topic, row_number() OVER (PARTITION BY branch ORDER BY count(*) DESC, topic) AS k FROM r GROUP BY 1, 2)
SELECT branch, topic, month, count(*) AS n FROM r JOIN t USING (branch, topic) WHERE k <= 5 GROUP BY 1, 2, 3""")
def branch_trends(spark, d):
    """Monthly counts of the five most frequent topics of two branches that exclude each other."""
    rows = table(spark, d, "orders").withColumn("topic", F.col("o_custkey") % 20)
    branch = F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").otherwise("other")
    return analytics.branch_trends(rows, branch, "topic", F.to_date("o_orderdate"))


@query("SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1")
def topic_series(spark, d):
    return analytics.monthly(table(spark, d, "orders").where("o_orderpriority = '5-LOW'"), F.to_date("o_orderdate"))


@query("""WITH v AS (SELECT vec_id, embedding[1] AS score, embedding[2] AS pop FROM embeddings)
SELECT 'bestoutcome' AS mode, (SELECT vec_id FROM v ORDER BY score DESC, vec_id DESC LIMIT 1) AS vec_id UNION ALL SELECT 'popular', (SELECT vec_id FROM v ORDER BY pop DESC, vec_id DESC LIMIT 1)
UNION ALL SELECT 'popular label', (SELECT vec_id FROM v WHERE score > 0.1 ORDER BY pop DESC, vec_id DESC LIMIT 1) UNION ALL SELECT 'confident', (SELECT vec_id FROM v ORDER BY score DESC, vec_id DESC LIMIT 1)""")
def next_to_annotate(spark, d):
    """The document each mode of selection picks."""
    v = table(spark, d, "embeddings").select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("score"), F.get("embedding", F.lit(1)).cast("double").alias("pop"))
    modes = {"bestoutcome": ("bestoutcome", "score", None), "popular": ("popular", None, "pop"), "popular label": ("popular", "score", "pop"), "confident": ("confident", "score", None)}
    out = None
    for name, (mode, score, pop) in modes.items():
        one = ml.chosen(v, mode, "vec_id", score, pop, 0.1).select(F.lit(name).alias("mode"), "vec_id")
        out = one if out is None else out.unionByName(one)
    return out


@query("""WITH u AS (SELECT * FROM embeddings WHERE list_max(embedding) < 0.3), c AS (SELECT round(1 - (SELECT count(*) FROM u) / (SELECT count(*) FROM embeddings), 3) AS coverage)
SELECT vec_id AS document_id, 3 AS task_id, 'focus_x' AS dochash, coverage AS current_coverage FROM c, (SELECT vec_id FROM u ORDER BY embedding[1] DESC, vec_id DESC LIMIT 1)""")
def annotation_queue(spark, d):
    """The row that goes into the queue: the document, its task, a hash and how much is decided."""
    v = table(spark, d, "embeddings").withColumn("score", F.get("embedding", F.lit(0)))
    few = v.where(ml.undecided(F.col("embedding"), F.lit(0.3)))
    return ml.queue_rows(ml.chosen(few, "confident", "vec_id", "score"), "vec_id", 3, F.lit("focus_x"), ml.coverage(few, v))
