"""Queries over the order and event tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lithos.operators import analytics, joins, rules
from lithos.session import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
AS_OF = "DATE '2024-01-31'"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("""WITH n AS (SELECT c_nationkey AS k, arg_max(c_acctbal, c_custkey) AS v FROM customer GROUP BY 1), o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS custkey, CAST(o_orderkey % 30 AS INTEGER) AS nationkey FROM orders)
SELECT o_orderkey, CASE WHEN c.c_custkey IS NOT NULL THEN 'custkey' WHEN n.k IS NOT NULL THEN 'nationkey' END AS matched_by, CASE WHEN c.c_custkey IS NOT NULL THEN c.c_acctbal ELSE n.v END AS value
FROM o LEFT JOIN customer c ON o.custkey = c.c_custkey LEFT JOIN n ON o.nationkey = n.k""")
def priority_join(spark, d):
    c = table(spark, d, "customer")
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("custkey"), (F.col("o_orderkey") % 30).cast("int").alias("nationkey"))
    out = joins.priority_join(o, [("custkey", c, "c_custkey"), ("nationkey", c, "c_nationkey")], "c_custkey", "c_acctbal")
    return out.select("o_orderkey", "matched_by", "value")


@query("""WITH a AS (SELECT l_suppkey, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 2 = 0 GROUP BY 1)
SELECT s_suppkey, coalesce(q, s_acctbal) AS balance FROM supplier LEFT JOIN a ON s_suppkey = l_suppkey""")
def update_from_join(spark, d):
    staging = table(spark, d, "lineitem").where("l_returnflag = 'R' and l_suppkey % 2 = 0").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("q"))
    out = joins.update_from(table(spark, d, "supplier"), staging, "s_suppkey", "l_suppkey", "s_acctbal", F.col("q"))
    return out.select("s_suppkey", F.col("s_acctbal").alias("balance"))


@query("""WITH o AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000), c AS (SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM o)), n AS (SELECT n_nationkey FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM c))
SELECT 'customer' AS level, c_custkey AS key FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM c) UNION ALL SELECT 'nation', n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT n_nationkey FROM n)""")
def orphan_cleanup(spark, d):
    """What a cascade of clean-ups removes: customers without large orders, then nations without customers left."""
    customer, nation = table(spark, d, "customer"), table(spark, d, "nation")
    kept = joins.without_orphans(customer, "c_custkey", table(spark, d, "orders").where("o_totalprice > 400000"), "o_custkey")
    kept_nations = joins.without_orphans(nation, "n_nationkey", kept, "c_nationkey")
    gone = customer.join(kept.select("c_custkey"), "c_custkey", "left_anti").select(F.lit("customer").alias("level"), F.col("c_custkey").alias("key"))
    return gone.union(nation.join(kept_nations.select("n_nationkey"), "n_nationkey", "left_anti").select(F.lit("nation"), F.col("n_nationkey").cast("long")))


@query("""WITH e AS (SELECT *, CAST(ts AS DATE) AS day, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS p FROM events)
SELECT user_id, day, event_type, count(*) AS n FROM e WHERE p = 0 OR event_type = 'purchase' GROUP BY 1, 2, 3""")
def newest_only(spark, d):
    counts = table(spark, d, "events").groupBy("user_id", F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"))
    bought = counts.where("event_type = 'purchase'").select("user_id", "day", F.lit(True).alias("p"))
    return counts.join(bought, ["user_id", "day"], "left").where("p is null or event_type = 'purchase'").select("user_id", "day", "event_type", "n")


@query("SELECT event_type AS a, CAST(floor(value / 50) AS BIGINT) AS b, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY event_type) AS BIGINT) AS total FROM events GROUP BY 1, 2")
def crosstab(spark, d):
    return analytics.crosstab(table(spark, d, "events"), F.col("event_type"), F.floor(F.col("value") / 50).cast("long"))


@query("""WITH c AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT month, status, n, round(n / sum(n) OVER (PARTITION BY month), 6) AS share FROM c""")
def month_share(spark, d):
    rows = analytics.crosstab(table(spark, d, "orders"), F.date_format("o_orderdate", "yyyy-MM"), F.col("o_orderstatus"))
    return rows.select(F.col("a").alias("month"), F.col("b").alias("status"), "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


@query("""SELECT brand, type, n FROM (SELECT p_brand AS brand, p_type AS type, count(*) AS n, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS r FROM part GROUP BY 1, 2) WHERE r <= 3""")
def topk_per_group(spark, d):
    counts = table(spark, d, "part").groupBy(F.col("p_brand").alias("brand"), F.col("p_type").alias("type")).agg(F.count("*").alias("n"))
    return analytics.top_per_group(counts, "brand", 3, [F.desc("n"), F.col("type")])


@query("""WITH c AS (SELECT user_id % 40 AS k, count(*) AS n FROM events WHERE value > 200 GROUP BY 1)
SELECT CASE WHEN n < 10 THEN 'Other' ELSE CAST(k AS VARCHAR) END AS bucket, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 1""")
def rare_fold(spark, d):
    rows = table(spark, d, "events").where("value > 200").select((F.col("user_id") % 40).cast("string").alias("k"))
    return analytics.rare_fold(rows, "k", 10)


@query("SELECT event_type, count(*) AS n FROM (SELECT * FROM events ORDER BY value DESC, event_id LIMIT 100) GROUP BY 1")
def top_then_count(spark, d):
    return table(spark, d, "events").orderBy(F.desc("value"), "event_id").limit(100).groupBy("event_type").agg(F.count("*").alias("n"))


@query(f"""SELECT event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS r FROM events WHERE {AS_OF} - CAST(ts AS DATE) BETWEEN 0 AND 14) WHERE r <= 3""")
def trending(spark, d):
    recent = table(spark, d, "events").where(F.datediff(F.lit("2024-01-31"), "ts").between(0, 14))
    return analytics.top_per_group(recent, "event_type", 3, [F.desc("value"), F.col("event_id")]).select("event_type", "event_id", "value")


@query(f"SELECT event_id FROM events WHERE value > 150 OR event_type = 'signup' OR abs({AS_OF} - CAST(ts AS DATE)) <= 15")
def popular_or_recent(spark, d):
    rows = table(spark, d, "events")
    return rows.where(rules.popular_or_recent(F.col("value"), F.col("event_type") != "signup", F.col("ts"), F.lit("2024-01-31").cast("date"), 150)).select("event_id")


_DENSE = "c AS (SELECT o_orderstatus AS status, year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1, 2), g AS (SELECT status, y, coalesce(n, 0) AS n FROM (SELECT DISTINCT status FROM c) a CROSS JOIN (SELECT DISTINCT y FROM c) b LEFT JOIN c USING (status, y))"


@query(f"""WITH {_DENSE}, l AS (SELECT status, y, n, lead(n) OVER (PARTITION BY status ORDER BY y) AS next FROM g)
SELECT status, CAST(y AS INTEGER) AS prev_year, n AS prev, next, next - n AS diff FROM l WHERE next IS NOT NULL""")
def year_diff(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), "o_orderdate")
    return analytics.year_differences(analytics.dense_yearly(rows, "status", F.year("o_orderdate")), "status")


@query(f"""WITH {_DENSE}, t AS (SELECT status, y, 100.0 * n / sum(n) OVER (PARTITION BY y) AS pct FROM g), l AS (SELECT status, y, pct, lead(pct) OVER (PARTITION BY status ORDER BY y) AS next FROM t)
SELECT status, CAST(y AS INTEGER) AS prev_year, round(CAST(next - pct AS DOUBLE), 6) AS diff_pct FROM l WHERE next IS NOT NULL""")
def norm_diff(spark, d):
    from pyspark.sql import Window

    rows = table(spark, d, "orders").select(F.col("o_orderstatus").alias("status"), "o_orderdate")
    dense = analytics.dense_yearly(rows, "status", F.year("o_orderdate"))
    pct = dense.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("year")))
    out = pct.withColumn("next", F.lead("pct").over(Window.partitionBy("status").orderBy("year"))).where("next is not null")
    return out.select("status", F.col("year").alias("prev_year"), F.round(F.col("next") - F.col("pct"), 6).alias("diff_pct"))


@query("""WITH c AS (SELECT value, count(*) AS n FROM events GROUP BY 1), r AS (SELECT value, (coalesce(sum(n) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2.0) / (SELECT count(*) FROM events) AS pct FROM c)
SELECT event_id, round(CAST(pct AS DOUBLE), 6) AS pct FROM events JOIN r USING (value) WHERE pct < 0.1 OR pct > 0.9""")
def pct_rank_avg(spark, d):
    out = analytics.average_percentile(table(spark, d, "events").select("event_id", "value"), "value").where("pct < 0.1 or pct > 0.9")
    return out.select("event_id", F.round("pct", 6).alias("pct"))


@query("SELECT y AS year, count(*) AS n FROM (SELECT o_custkey, CAST(min(year(o_orderdate)) AS INTEGER) AS y FROM orders GROUP BY 1) GROUP BY 1")
def year_counts(spark, d):
    first = table(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.year("o_orderdate")).alias("year"))
    return first.groupBy("year").agg(F.count("*").alias("n"))


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty, round(avg(l_discount), 6) AS avg_disc FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, d):
    rows = table(spark, d, "lineitem").where("l_shipdate <= timestamp '2000-09-02'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.avg("l_discount"), 6).alias("avg_disc"))
