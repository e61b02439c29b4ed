"""Input and scores of outside pair scorers, over order lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.config import model_plan
from weftlink.operators import rerank

from .common import collector, table
from .pairs import _PAIRS, _pairs

QUERIES, SQL, query = collector()


def _pruned(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).select("i", "j", F.col("p").alias("p1"), "label", (F.col("p") >= 0.3).alias("pruned"))


_PRUNED = f"{_PAIRS}, pr AS (SELECT i, j, p AS p1, label, p >= 0.3 AS pruned FROM pairs)"


def _texts(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("address"), F.lit("x").alias("country"))
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("address"), F.col("p_brand").alias("country"))
    return rerank.with_texts(rerank.scoring_pairs(_pruned(spark, d), 4), o, p)


_TEXTS = f"""{_PRUNED}, tx AS (SELECT i, j, p1, label, CAST(floor(((i * 2654435761) % 4294967296) / 4294967296.0::DOUBLE * 4) AS BIGINT) % 4 AS shard,
  'name: ' || o_orderpriority || ' | address: ' || o_orderstatus || ' | country: x' AS text_a, 'name: ' || p_name || ' | address: ' || p_type || ' | country: ' || p_brand AS text_b
  FROM pr JOIN orders ON o_orderkey = i JOIN part ON p_partkey = j WHERE pruned)"""


@query(f"""WITH {_PRUNED}, s AS (SELECT DISTINCT i FROM pr WHERE i % 5 < 2),
r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY p1 DESC, j) AS k FROM pr),
own AS (SELECT * FROM r WHERE i IN (SELECT i FROM s) AND (pruned OR k <= 3)),
rival AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY p1 DESC, i) AS q FROM pr WHERE j IN (SELECT j FROM own) AND i NOT IN (SELECT i FROM s))
SELECT i, j, p1, label, CAST(pruned AS TINYINT) AS in_pruned, 1::TINYINT AS lw_ok FROM own UNION ALL SELECT i, j, p1, label, 0::TINYINT, 0::TINYINT FROM rival WHERE q = 1""")
def rerank_training_set(spark: SparkSession, d: str) -> DataFrame:
    """IO15, J13."""
    p = _pruned(spark, d)
    return rerank.training_pairs(p, p.where("i % 5 < 2"), first=3)


@query(f"WITH {_TEXTS} SELECT * FROM tx")
def rerank_texts(spark: SparkSession, d: str) -> DataFrame:
    """IO14, IO15, F3, F12: the pruned pairs with their shards and texts."""
    return _texts(spark, d)


def _by_length():
    """A stand-in for a trained model: the difference of the lengths; some have no score."""
    return lambda a, b: [(len(x) - len(y)) / 10 if len(y) % 7 else float("nan") for x, y in zip(a, b, strict=True)]


@query(f"WITH {_TEXTS} SELECT i, j, label, CASE WHEN length(text_b) % 7 = 0 THEN 0 ELSE (length(text_a) - length(text_b)) / 10 END AS z FROM tx WHERE p1 > 0.35 AND p1 < 0.9")
def rerank_scores(spark: SparkSession, d: str) -> DataFrame:
    """IO13, IO17, O4, ML9, F7, F16: all gated pairs through two models, each over its own shards."""
    t = _texts(spark, d)
    return rerank.merge_scores({m["model"]: rerank.score(t, _by_length, 64, (0.35, 0.9), m["shards"], carry=("label",)) for m in model_plan(4, 2)})


@query(f"WITH {_PAIRS} SELECT i, j, p, label, src FROM pairs WHERE p >= 0.3")
def feature_join(spark: SparkSession, d: str) -> DataFrame:
    """The pruned pairs with features of all pairs, checked to cover each once."""
    p = _pairs(spark, d)
    return rerank.attach_features(p.where("p >= 0.3").select("i", "j", "p"), p.select("i", "j", "label", "src"))
