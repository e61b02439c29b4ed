"""Audits and source handling over the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions import exprs as E
from weftlink.operators import audit, context
from weftlink.sources import first_of

from .common import collector, table

QUERIES, SQL, query = collector()


@query("""WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS INT) AS rank FROM n) SELECT * FROM r WHERE rank <= 2""")
def value_counts_topk(spark: SparkSession, d: str) -> DataFrame:
    """A1, O2."""
    return audit.value_counts_top(table(spark, d, "events"), "user_id", "event_type", 2)


@query("SELECT lang, round(avg((coalesce(source, '') = '')::INT), 5) AS empty_source, round(avg((coalesce(text, '') = '')::INT), 5) AS empty_text FROM documents GROUP BY 1")
def empty_rates(spark: SparkSession, d: str) -> DataFrame:
    """A2."""
    return audit.empty_rates(table(spark, d, "documents"), "lang", ["source", "text"])


@query("SELECT doc_id, h FROM (SELECT doc_id, md5(coalesce(text, '')) AS h, row_number() OVER (PARTITION BY md5(coalesce(text, '')) ORDER BY doc_id) AS k FROM documents) WHERE k = 1")
def first_occurrence_dedup(spark: SparkSession, d: str) -> DataFrame:
    """A3."""
    return first_of(table(spark, d, "documents").select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("h")), "h", ["doc_id"])


@query("SELECT p_partkey, sum((p_size % 3 = 1)::INT) OVER (PARTITION BY p_brand, p_type) AS f_s1, sum((p_size % 3 <> 1)::INT) OVER (PARTITION BY p_brand, p_type) AS f_r FROM part")
def chain_frequency(spark: SparkSession, d: str) -> DataFrame:
    """A4: how many rows of either side share the keys."""
    p = audit.frequency(table(spark, d, "part"), ["p_brand", "p_type"], F.col("p_size") % 3 == 1, "f_s1")
    return audit.frequency(p, ["p_brand", "p_type"], F.col("p_size") % 3 != 1, "f_r").select("p_partkey", "f_s1", "f_r")


@query("SELECT l_partkey, count(*) AS n FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) GROUP BY 1 HAVING count(*) > 1")
def shared_records(spark: SparkSession, d: str) -> DataFrame:
    """Records in several lists."""
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey").distinct().groupBy("l_partkey").agg(F.count("*").alias("n")).where("n > 1")


@query("SELECT o_orderstatus, count(*) FILTER (o_orderpriority LIKE '1%') AS p1, count(*) FILTER (o_orderpriority LIKE '2%') AS p2, count(*) FILTER (o_orderpriority LIKE '3%') AS p3 FROM orders GROUP BY 1")
def crosstab(spark: SparkSession, d: str) -> DataFrame:
    """A table of two keys; the second's values are known."""
    o = table(spark, d, "orders").select("o_orderstatus", F.left("o_orderpriority", F.lit(1)).alias("k"))
    c = o.groupBy("o_orderstatus").pivot("k", ["1", "2", "3"]).agg(F.count(F.lit(1)))
    return c.select("o_orderstatus", *(F.coalesce(k, F.lit(0)).alias(f"p{k}") for k in ("1", "2", "3")))


@query("SELECT least(n, 10) AS bucket, count(*) AS n FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1")
def capped_hist(spark: SparkSession, d: str) -> DataFrame:
    """A8, A5."""
    return audit.capped_histogram(table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")), "n").select(F.col("bucket").cast("long").alias("bucket"), "n")


@query("""WITH n AS (SELECT c_custkey, c_nationkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT c_nationkey, count(*) AS entities, round(avg((n = 0)::INT), 6) AS singleton_rate, round(avg(n), 6) AS mean_matches, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM n GROUP BY 1""")
def eda_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Rates and shares of each group in one pass."""
    n = table(spark, d, "customer").join(table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")), F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)))
    g = n.groupBy("c_nationkey").agg(F.count("*").alias("entities"), F.round(F.avg((F.col("n") == 0).cast("int")), 6).alias("singleton_rate"), F.round(F.avg("n"), 6).alias("mean_matches"))
    total = g.agg(F.sum("entities").alias("t"))
    return g.join(F.broadcast(total)).select("c_nationkey", "entities", "singleton_rate", "mean_matches", F.round(F.col("entities") / F.col("t"), 6).alias("share"))


@query("""WITH r AS (SELECT avg(a) OVER (PARTITION BY o_totalprice) AS x, avg(b) OVER (PARTITION BY o_custkey) AS y FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice) AS a, row_number() OVER (ORDER BY o_custkey) AS b FROM orders))
SELECT round(corr(x, y), 6) AS spearman, count(*) AS n FROM r""")
def spearman(spark: SparkSession, d: str) -> DataFrame:
    """A10."""
    return audit.spearman(table(spark, d, "orders"), "o_totalprice", "o_custkey")


@query("SELECT DISTINCT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000")
def unseen_groups(spark: SparkSession, d: str) -> DataFrame:
    """U3."""
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).subtract(table(spark, d, "supplier").where("s_acctbal > 8000").select("s_nationkey"))


@query("""WITH x AS (SELECT doc_id, coalesce(lang, '') AS a, CASE WHEN doc_id % 5 = 0 THEN '' WHEN doc_id % 2 = 0 THEN 'en' ELSE 'de' END AS b FROM documents)
SELECT doc_id, CAST(CASE WHEN a <> '' AND b <> '' THEN CASE WHEN a = b THEN 1 ELSE -1 END ELSE 0 END AS TINYINT) AS tri FROM x""")
def tri_compare(spark: SparkSession, d: str) -> DataFrame:
    """F15, C11."""
    b = F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 2 == 0, "en").otherwise("de")
    return table(spark, d, "documents").select("doc_id", E.tri(F.coalesce("lang", F.lit("")), b).alias("tri"))


@query("""WITH n AS (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY left(regexp_replace(lower(p_name), '[^0-9a-z]', '', 'g'), 3), md5(CAST(p_partkey AS VARCHAR))) - 1 AS k FROM part),
b AS (SELECT *, k // 8 AS b, count(*) OVER (PARTITION BY p_brand, k // 8) AS c FROM n) SELECT p_partkey, b FROM b WHERE c = 8""")
def training_batches(spark: SparkSession, d: str) -> DataFrame:
    """Rows in batches of near sort keys; incomplete ones are dropped."""
    from weftlink.functions.normalize import sort_key_col

    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_brand", sort_key_col(F.col("p_name")).alias("key"))
    return context.batches(p, "p_brand", "key", 8).select(F.col("id").alias("p_partkey"), F.col("number").alias("b"))
