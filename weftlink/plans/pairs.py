"""Scored pairs, their context, decisions and metrics, over order lines, events and vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftlink.functions import exprs as E
from weftlink.operators import audit, context, decide, knn, models
from weftlink.sources import check_lists, explode_ids, join_ids, known_pairs

from .common import collector, table

QUERIES, SQL, query = collector()


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """An order line is a pair of an entity (order) and a record (part)."""
    p = F.round(F.col("l_quantity") / 50 * (1 - F.col("l_discount")) * 0.999, 6)
    return table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("i"), F.col("l_partkey").alias("j")).agg(F.max(p).alias("p"), F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("label"), F.min("l_suppkey").alias("src"))


_PAIRS = "pairs AS (SELECT l_orderkey AS i, l_partkey AS j, max(round(l_quantity / 50 * (1 - l_discount) * 0.999::DOUBLE, 6)) AS p, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS label, min(l_suppkey) AS src FROM lineitem GROUP BY 1, 2)"


def _entities(spark: SparkSession, d: str) -> DataFrame:
    t = _pairs(spark, d).groupBy("i").agg(F.sum("label").alias("t"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("i"), F.col("o_orderstatus").alias("cty"))
    # the truth holds some pairs that no candidate has
    return o.join(t, "i", "left").select("i", "cty", (F.coalesce("t", F.lit(0)) + F.when(F.col("i") % 11 == 0, 1).otherwise(0)).alias("n_true"))


_ENT = "ent AS (SELECT o_orderkey AS i, o_orderstatus AS cty, coalesce(t, 0) + CASE WHEN o_orderkey % 11 = 0 THEN 1 ELSE 0 END AS n_true FROM orders LEFT JOIN (SELECT i, sum(label) AS t FROM pairs GROUP BY 1) x ON x.i = o_orderkey)"
_F05 = "CASE WHEN k = 0 THEN CASE WHEN n_true = 0 THEN 1.0::DOUBLE ELSE 0 END WHEN tp = 0 THEN 0 ELSE 1.25::DOUBLE * tp / (0.25::DOUBLE * n_true + k) END"
_SCORED = f"e AS (SELECT ent.*, coalesce(c.k, 0) AS k, coalesce(c.tp, 0) AS tp FROM ent LEFT JOIN (SELECT i, count(*) AS k, sum(label) AS tp FROM chosen GROUP BY 1) c USING (i)), f AS (SELECT *, {_F05} AS f05 FROM e)"


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


@query("""WITH r AS (SELECT event_id, user_id, value, row_number() OVER w AS rank, round(value - max(value) OVER (PARTITION BY user_id), 6) AS gap,
  round(value - coalesce(nth_value(value, 2) OVER (PARTITION BY user_id ORDER BY value DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), -1), 6) AS m2, count(*) OVER (PARTITION BY user_id) AS size
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY value DESC, event_id)) SELECT event_id, user_id, rank, gap, m2, size FROM r""")
def group_context_user(spark: SparkSession, d: str) -> DataFrame:
    """W1, W2."""
    g = context.group_context(table(spark, d, "events").select("event_id", "user_id", "value"), "user_id", "value", ["event_id"])
    return _round(g, "gap", "m2").select("event_id", "user_id", "rank", "gap", "m2", "size")


@query(f"""WITH {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS a, row_number() OVER (PARTITION BY j ORDER BY p DESC, i) AS b FROM pairs)
SELECT i, j, p FROM r WHERE p >= 0.002 AND a <= 12 AND b <= 6""")
def prune_pairs(spark: SparkSession, d: str) -> DataFrame:
    """F8."""
    return context.prune(_pairs(spark, d), "p").select("i", "j", "p")


@query(f"WITH {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY p DESC, i) AS k FROM pairs) SELECT i, j, p FROM r WHERE k = 1 AND p >= 0.5")
def assign_best(spark: SparkSession, d: str) -> DataFrame:
    """W6."""
    return context.assign(_pairs(spark, d), "p", 0.5).select("i", "j", "p")


@query(f"WITH {_PAIRS}, o AS (SELECT *, p / (1 - p) AS o FROM pairs) SELECT i, j, round(o / (1 + sum(o) OVER (PARTITION BY j)), 6) AS pe FROM o")
def exclusive_softmax(spark: SparkSession, d: str) -> DataFrame:
    """MX2, A19."""
    return _round(context.exclusive(_pairs(spark, d), "p", "softmax"), "pe").select("i", "j", "pe")


@query(f"WITH {_PAIRS} SELECT i, j, CASE WHEN row_number() OVER (PARTITION BY j ORDER BY p DESC, i) = 1 THEN p ELSE 0 END AS pe FROM pairs")
def exclusive_hard(spark: SparkSession, d: str) -> DataFrame:
    """MX2, W8."""
    return context.exclusive(_pairs(spark, d), "p", "hard").select("i", "j", "pe")


@query(f"""WITH {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS rk, max(p) OVER (PARTITION BY i) AS g FROM pairs)
SELECT i, j, CASE WHEN rk = 1 THEN p >= 0.6 ELSE p >= 0.7 AND g >= 0.6 END AS sel FROM r""")
def two_threshold(spark: SparkSession, d: str) -> DataFrame:
    """MX5."""
    return decide.select(_pairs(spark, d), "p", "two_threshold", 0.6, 0.7).select("i", "j", "sel")


_T = [round(0.2 + 0.025 * k, 3) for k in range(31)]


@query(f"""WITH {_PAIRS}, {_ENT}, t AS (SELECT unnest({_T}::DOUBLE[]) AS t), c AS (SELECT t, i, count(*) AS k, sum(label) AS tp FROM pairs JOIN t ON p >= t GROUP BY 1, 2),
e AS (SELECT t.t, ent.*, coalesce(c.k, 0) AS k, coalesce(c.tp, 0) AS tp FROM ent CROSS JOIN t LEFT JOIN c ON c.t = t.t AND c.i = ent.i)
SELECT t, round(avg({_F05}), 6) AS f05 FROM e GROUP BY 1""")
def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    """MX6, A22: macro F0.5 of 31 thresholds in one pass: each pair counts for those it reaches."""
    ts = F.array(*map(F.lit, _T))
    c = _pairs(spark, d).select("i", "label", F.explode(F.filter(ts, lambda t: F.col("p") >= t)).alias("t")).groupBy("t", "i").agg(F.count("*").alias("k"), F.sum("label").alias("tp"))
    e = _entities(spark, d)
    empty = E.f_half(F.col("n_true"), F.lit(0), F.lit(0))
    gain = c.join(e, "i").groupBy("t").agg(F.sum(E.f_half(F.col("n_true"), F.col("k"), F.col("tp")) - empty).alias("g"))
    base = e.agg(F.sum(empty).alias("b"), F.count("*").alias("n")).select(F.explode(ts).alias("t"), "b", "n")
    return base.join(gain, "t", "left").select("t", F.round((F.col("b") + F.coalesce("g", F.lit(0.0))) / F.col("n"), 6).alias("f05"))


@query(f"WITH {_PAIRS}, {_ENT}, chosen AS (SELECT * FROM pairs WHERE p >= 0.5), {_SCORED} SELECT i, n_true, k, tp, round(f05, 6) AS f05 FROM f")
def macro_f05(spark: SparkSession, d: str) -> DataFrame:
    """A22, A5."""
    return _round(decide.per_entity(_entities(spark, d), _pairs(spark, d).where("p >= 0.5")), "f05").select("i", "n_true", "k", "tp", "f05")


@query(f"""WITH {_PAIRS}, {_ENT}, chosen AS (SELECT * FROM pairs WHERE p >= 0.5), {_SCORED}
SELECT cty, round(avg(f05), 6) AS f05, count(*) AS n, round(avg(f05) FILTER (n_true = 0), 6) AS singletons, round(avg(f05) FILTER (n_true > 0), 6) AS with_matches,
  round(avg((k > 0)::INT) FILTER (n_true = 0), 6) AS false_merge_rate, round(avg((k = 0)::INT) FILTER (n_true > 0), 6) AS empty_rate FROM f GROUP BY ROLLUP (cty)""")
def breakdown_by_group(spark: SparkSession, d: str) -> DataFrame:
    """A23."""
    return decide.breakdown(decide.per_entity(_entities(spark, d), _pairs(spark, d).where("p >= 0.5")), "cty")


@query(f"""WITH {_PAIRS}, {_ENT}, e AS (SELECT ent.*, coalesce(c, 0) AS c, coalesce(tp, 0) AS tp FROM ent LEFT JOIN (SELECT i, count(*) AS c, sum(label) AS tp FROM pairs GROUP BY 1) x USING (i))
SELECT round(sum(tp) / sum(n_true), 6) AS recall, round(sum(c) / count(*), 6) AS pairs_per_s1, round(avg(CASE WHEN n_true = 0 THEN 1.0::DOUBLE WHEN tp > 0 THEN 1.25::DOUBLE * tp / (0.25::DOUBLE * n_true + tp) ELSE 0 END), 6) AS oracle_f05 FROM e""")
def oracle_f05(spark: SparkSession, d: str) -> DataFrame:
    """A25."""
    return decide.oracle(_entities(spark, d), _pairs(spark, d))


@query(f"""WITH {_PAIRS}, q AS (SELECT i, list(greatest(least(p, 1 - 1e-6), 1e-6) ORDER BY p DESC, j) AS q, count(*) AS n FROM pairs GROUP BY 1),
m AS (SELECT i, q, n, unnest(range(0, CAST(1 AS BIGINT) << n)) AS m FROM q),
w AS (SELECT i, n, m, list_aggregate(list_transform(range(0, n), lambda x: CASE WHEN (m >> x) & 1 = 1 THEN q[x + 1] ELSE 1 - q[x + 1] END), 'product') AS w, bit_count(m) AS t FROM m),
f AS (SELECT i, k, sum(w * CASE WHEN k = 0 THEN (t = 0)::INT ELSE 1.25::DOUBLE * bit_count(m & ((CAST(1 AS BIGINT) << k) - 1)) / (0.25::DOUBLE * t + k) END) AS f FROM (SELECT *, unnest(range(0, n + 1)) AS k FROM w) GROUP BY 1, 2)
SELECT i, k FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY round(f, 12) DESC, k) AS r FROM f) WHERE r = 1""")
def expected_f_select(spark: SparkSession, d: str) -> DataFrame:
    """MX3, MX4, W7: the number of records of each entity with the best expected F0.5."""
    return decide.select(_pairs(spark, d), "p", "expected_f", 1.0, 0.0).groupBy("i").agg(F.sum(F.col("sel").cast("int")).alias("k"))


@query()
def policy_tuning(spark: SparkSession, d: str) -> DataFrame:
    """A30, O2, MX6: cross-fitted choice among all settings under four kinds of exclusivity."""
    e = _entities(spark, d).withColumn("fold", F.pmod(F.xxhash64("i"), F.lit(4)).cast("int"))
    return decide.tune(decide.grid_scores(e, _pairs(spark, d), "p"))


@query(f"""WITH {_PAIRS}, c AS (SELECT *, count(*) OVER (PARTITION BY i) AS n FROM pairs), f AS (SELECT * FROM c WHERE n BETWEEN 2 AND 12),
n AS (SELECT a.i, a.j, b.j AS o, b.p, a.src <> b.src AS x, 1 / (1.0::DOUBLE + abs(a.src - b.src) / 7.3::DOUBLE) AS sim FROM f a JOIN f b ON a.i = b.i AND a.j <> b.j)
SELECT i, j, round(max(sim), 6) AS nb_max_sim, round(max(sim * p), 6) AS nb_support, round(coalesce(max(sim * p) FILTER (x), 0), 6) AS nb_support_x, round(sum(sim * p), 6) AS nb_support_sum, round(arg_max(sim, (p, -o)), 6) AS cmp_best_sim
FROM n GROUP BY 1, 2""")
def neighbour_selfjoin(spark: SparkSession, d: str) -> DataFrame:
    """A pair's support by the other pairs of its entity."""
    near = context.group_pairs(_pairs(spark, d), "i", "j")
    near = near.withColumn("sim", 1 / (1 + F.abs(F.col("a.src") - F.col("b.src")) / 7.3))
    return _round(context.support(near), "nb_max_sim", "nb_support", "nb_support_x", "nb_support_sum", "cmp_best_sim")


@query(f"""WITH {_PAIRS}, z AS (SELECT *, ln(p / (1 - p)) AS z FROM pairs), r AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY z DESC, i) AS rank, z - max(z) OVER (PARTITION BY j) AS gap,
  z - coalesce(nth_value(z, 2) OVER (PARTITION BY j ORDER BY z DESC, i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), -30) AS m2, exp(z) / (1 + sum(exp(z)) OVER (PARTITION BY j)) AS share, sum(1 / (1 + exp(-z))) OVER (PARTITION BY i) AS sum_p, sum((z > 0)::INT) OVER (PARTITION BY i) AS n_half FROM z)
SELECT i, j, rank, round(gap, 6) AS gap, round(CASE WHEN gap >= -1e-9 THEN z - m2 ELSE z - gap END, 6) AS other, round(share, 6) AS share, round(sum_p, 6) AS sum_p, n_half FROM r""")
def l2_competition(spark: SparkSession, d: str) -> DataFrame:
    """W3, A19, MX1."""
    c = context.competition(_pairs(spark, d).withColumn("s", E.logit(F.col("p"))), "s")
    r = lambda c: F.round(c, 6)
    return c.select("i", "j", F.col("cx_j_rank").alias("rank"), r("cx_j_gap").alias("gap"), r("cx_j_other").alias("other"), r("cx_j_share").alias("share"), r("cx_sum_p").alias("sum_p"), F.col("cx_n_half").alias("n_half"))


@query(f"""WITH {_PAIRS}, s AS (SELECT i, j, p * 2 - 1 AS z FROM pairs WHERE p > 0.02 AND p < 0.5)
SELECT p.i, p.j, CASE WHEN s.z IS NULL THEN 0 ELSE 1 END AS ce_has_x, round(coalesce(s.z, ln(p.p / (1 - p.p))), 6) AS z_x FROM pairs p LEFT JOIN s USING (i, j)""")
def score_left_join(spark: SparkSession, d: str) -> DataFrame:
    """Outside scores of gated pairs; the others take their own logit."""
    p = _pairs(spark, d)
    s = p.where(E.gate(F.col("p"), 0.02, 0.5)).select("i", "j", (F.col("p") * 2 - 1).alias("z"))
    return _round(context.attach_scores(p, {"x": s}, "p"), "z_x").select("i", "j", F.col("ce_has_x").cast("int").alias("ce_has_x"), "z_x")


@query(f"WITH {_PAIRS}, r AS (SELECT *, row_number() OVER (PARTITION BY i, label ORDER BY p DESC, j) AS k FROM pairs) SELECT i, j, label, p FROM r WHERE label = 1 OR k <= 2")
def hardest_negatives(spark: SparkSession, d: str) -> DataFrame:
    """W9, U1."""
    return context.hardest_negatives(_pairs(spark, d), "p", "label", 2).select("i", "j", "label", "p")


@query(f"""WITH {_PAIRS}, pool AS (SELECT DISTINCT j FROM pairs WHERE label = 1), s AS (SELECT DISTINCT i FROM pairs WHERE p >= 0.5),
r AS (SELECT *, row_number() OVER (PARTITION BY j ORDER BY p DESC, i) AS k FROM pairs WHERE j IN (SELECT j FROM pool) AND i NOT IN (SELECT i FROM s)) SELECT i, j, p FROM r WHERE k = 1""")
def competitor_negatives(spark: SparkSession, d: str) -> DataFrame:
    """J13, J12."""
    p = _pairs(spark, d)
    return context.competitor_negatives(p.where("label = 1"), p, p.where("p >= 0.5"), "p", 1).select("i", "j", "p")


@query(f"WITH {_PAIRS}, t AS (SELECT i, j FROM pairs WHERE label = 1) SELECT p.i, p.j, CASE WHEN t.i IS NULL THEN 0 ELSE 1 END AS label FROM pairs p LEFT JOIN t USING (i, j)")
def label_join(spark: SparkSession, d: str) -> DataFrame:
    """J2."""
    p = _pairs(spark, d)
    t = p.where("label = 1").select("i", "j", F.lit(1).alias("hit"))
    return p.drop("label").join(t, ["i", "j"], "left").select("i", "j", F.coalesce("hit", F.lit(0)).alias("label"))


@query(f"WITH {_PAIRS} SELECT i, string_agg(j, ',' ORDER BY p DESC, j) AS ids FROM pairs WHERE p >= 0.5 GROUP BY i")
def listagg_ids(spark: SparkSession, d: str) -> DataFrame:
    """A27, J15."""
    return join_ids(_pairs(spark, d).where("p >= 0.5"), "i", "j", [-F.col("p"), F.col("j")])


@query("SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS key, CAST(l_partkey AS VARCHAR) AS id FROM lineitem")
def explode_id_list(spark: SparkSession, d: str) -> DataFrame:
    """IO4, IO19: comma lists with blanks, empty entries and repeats, taken apart again."""
    s = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("k")).agg(F.concat(F.lit(" ,"), F.array_join(F.collect_list(F.col("l_partkey").cast("string")), " , "), F.lit(",,")).alias("ids"))
    return explode_ids(s.unionByName(s), "k", "ids")


@query(f"""WITH {_PAIRS}, m AS (SELECT i, j FROM pairs WHERE p >= 0.5), c AS (SELECT i, j FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS k FROM pairs) WHERE k <= 2)
SELECT i, j FROM m ANTI JOIN c USING (i, j)""")
def matched_not_in_candidates(spark: SparkSession, d: str) -> DataFrame:
    """J11."""
    p = _pairs(spark, d)
    c = p.withColumn("k", F.row_number().over(Window.partitionBy("i").orderBy(F.desc("p"), "j"))).where("k <= 2")
    return p.where("p >= 0.5").select("i", "j").join(c, ["i", "j"], "left_anti")


@query(f"""WITH {_PAIRS}, {_ENT}, r AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY p DESC, j) AS k FROM pairs),
c AS (SELECT i, j FROM r WHERE k <= 3), m AS (SELECT i, j FROM r WHERE p >= 0.5 OR k = 1 AND i % 3 = 0),
x AS (SELECT i AS key, j AS id FROM m UNION ALL SELECT i, -1 FROM m WHERE i % 50 = 0 UNION ALL SELECT i, j FROM m WHERE i % 70 = 0),
k AS (SELECT DISTINCT key FROM x), l AS (SELECT key FROM k UNION ALL SELECT key FROM k WHERE key % 90 = 0 UNION ALL SELECT -5),
y AS (SELECT key, id FROM x UNION ALL SELECT key, id FROM x WHERE key % 90 = 0)
SELECT (SELECT count(*) FROM ent WHERE i NOT IN (SELECT key FROM l)) AS matches_missing, (SELECT count(*) FROM l WHERE key NOT IN (SELECT i FROM ent)) AS matches_unknown,
  (SELECT count(*) FROM (SELECT key FROM l GROUP BY 1 HAVING count(*) > 1)) AS matches_repeated, (SELECT count(*) FROM y WHERE id NOT IN (SELECT j FROM pairs)) AS matches_bad_ids,
  (SELECT count(*) FROM (SELECT key, id FROM y GROUP BY 1, 2 HAVING count(*) > 1)) AS matches_twice, (SELECT count(*) FROM y ANTI JOIN c ON y.key = c.i AND y.id = c.j) AS not_candidates""")
def submission_checks(spark: SparkSession, d: str) -> DataFrame:
    """Lists with planted faults: ids that are unknown or twice, keys that are
    unknown or twice, matches that are no candidates."""
    p = _pairs(spark, d).withColumn("k", F.row_number().over(Window.partitionBy("i").orderBy(F.desc("p"), "j")))
    as_list = lambda x: join_ids(x, "i", "j", [F.col("j")]).select(F.col("i").cast("string").alias("key"), "ids")
    m = p.where("p >= 0.5 or (k = 1 and i % 3 = 0)").select("i", "j")
    m = m.unionByName(m.where("i % 50 = 0").withColumn("j", F.lit(-1).cast("long"))).unionByName(m.where("i % 70 = 0"))
    lists = as_list(m)
    lists = lists.unionByName(lists.where("CAST(key AS LONG) % 90 = 0")).unionByName(spark.createDataFrame([("-5", "")], "key string, ids string"))
    s1 = _entities(spark, d).select(F.col("i").cast("string").alias("entity_id"))
    out = check_lists(lists, as_list(p.where("k <= 3")), s1, p.select(F.col("j").cast("string").alias("entity_id")).distinct())
    keys = ("matches_missing", "matches_unknown", "matches_repeated", "matches_bad_ids", "matches_twice", "not_candidates")
    return spark.createDataFrame([tuple(out[k] for k in keys)], ", ".join(f"{k} long" for k in keys))


@query("SELECT DISTINCT l_orderkey AS key, l_partkey AS id FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') AND l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10)")
def known_id_pairs(spark: SparkSession, d: str) -> DataFrame:
    """J1, IO4: pairs whose both ends are known."""
    p = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), F.col("l_partkey").alias("id")).distinct()
    left = table(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("entity_id"))
    return known_pairs(p, left, table(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("entity_id"))).select("key", "id")


@query(f"""WITH {_PAIRS}, z AS (SELECT *, ln(p / (1 - p)) AS z, max(ln(p / (1 - p))) OVER (PARTITION BY i) AS t FROM pairs),
g AS (SELECT i, greatest(max(t), 0) + ln(exp(-greatest(max(t), 0)) + sum(exp(z - greatest(t, 0)))) AS lse, sum(label) AS pos, sum(z) FILTER (label = 1) AS zp FROM z GROUP BY 1)
SELECT round(avg(CASE WHEN pos > 0 THEN lse - zp / pos ELSE lse END), 6) AS loss, count(*) AS n FROM g""")
def listwise_value(spark: SparkSession, d: str) -> DataFrame:
    """ML8: the value of the listwise loss."""
    return _round(audit.listwise_loss(_pairs(spark, d).withColumn("z", E.logit(F.col("p"))), "z", "label"), "loss")


@query(f"""WITH {_PAIRS}, h AS (SELECT i, j, ((i * 2654435761) % 4294967296) / 4294967296.0::DOUBLE AS h FROM pairs)
SELECT i, j, round(h, 9) AS h, CAST(floor(h * 4) AS BIGINT) % 4 AS shard, h < 0.1 AS es, (i * 2654435761) % 1000 < 100 AS held FROM h""")
def hash_shards(spark: SparkSession, d: str) -> DataFrame:
    """F12, F13."""
    h = E.hash01(F.col("i"))
    return _pairs(spark, d).select("i", "j", F.round(h, 9).alias("h"), (F.floor(h * 4) % 4).alias("shard"), (h < 0.1).alias("es"), E.holdout(F.col("i")).alias("held"))


def _vectors(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    v = table(spark, d, "embeddings").where("embedding is not null").select(F.col("vec_id").alias("id"), "label", knn.unit_col(F.col("embedding")).alias("vec"))
    return v.where("id % 4 = 0"), v.where("id % 4 <> 0")


_KNN = """v AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS vec FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT q.id AS rec, b.id AS s1, list_inner_product(q.vec, b.vec) AS score FROM v q JOIN v b ON q.label = b.label WHERE q.id % 4 <> 0 AND b.id % 4 = 0),
cand AS (SELECT rec, s1, CAST(rank AS INT) AS rank, score FROM (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY round(score, 9) DESC, s1) AS rank FROM s) WHERE rank <= 20)"""


@query(f"WITH {_KNN} SELECT rec, s1, rank, round(score, 6) AS score FROM cand")
def knn_by_label(spark: SparkSession, d: str) -> DataFrame:
    """J16, MX7: every vector not divisible by 4 against those that are, of its label."""
    base, rest = _vectors(spark, d)
    return _round(knn.exact_knn(base, rest, 20, "label"), "score").select("rec", "s1", "rank", "score")


@query(f"""WITH {_KNN}, c AS (SELECT rec, s1, rank, round(score, 9) AS score FROM cand),
r AS (SELECT *, max(score) FILTER (rank = 1) OVER (PARTITION BY rec) AS t1, max(score) FILTER (rank = 2) OVER (PARTITION BY rec) AS t2, max(score) OVER (PARTITION BY s1) AS s1_max, row_number() OVER (PARTITION BY s1 ORDER BY score DESC, rec) AS s1_rank, count(*) OVER (PARTITION BY s1) AS s1_n, count(*) FILTER (rank = 1) OVER (PARTITION BY s1) AS s1_n_top1 FROM c)
SELECT rec, s1, round(t1 - score, 6) AS gap_top1, round(t1 - coalesce(t2, 0), 6) AS margin12, round(s1_max - score, 6) AS gap_s1, s1_rank, s1_n, s1_n_top1 FROM r WHERE rank <= 5""")
def competition_features(spark: SparkSession, d: str) -> DataFrame:
    """W5, J18, F9, F10."""
    base, rest = _vectors(spark, d)
    c = context.learned_competition(knn.exact_knn(base, rest, 20, "label").withColumn("score", F.round("score", 9)))
    return _round(c.where("rank <= 5"), "gap_top1", "margin12", "gap_s1").select("rec", "s1", "gap_top1", "margin12", "gap_s1", "s1_rank", "s1_n", "s1_n_top1")


@query(f"""WITH {_KNN}, t AS (SELECT q.id AS rec, q.label AS "by", b.id AS s1 FROM v q JOIN v b ON b.id = (q.id // 4) * 4 WHERE q.id % 4 <> 0 AND b.id % 4 = 0),
h AS (SELECT "by", t.rec, min(rank) AS r FROM t LEFT JOIN cand ON cand.rec = t.rec AND cand.s1 = t.s1 GROUP BY 1, 2)
SELECT "by", count(*) AS n, {", ".join(f"round(avg(coalesce(r <= {k}, false)::INT), 6) AS recall_{k}" for k in (1, 2, 3, 5, 10, 20))} FROM h GROUP BY 1""")
def recall_at_k(spark: SparkSession, d: str) -> DataFrame:
    """A26."""
    base, rest = _vectors(spark, d)
    t = rest.select(F.col("id").alias("rec"), F.col("label").alias("by"), (F.floor(F.col("id") / 4) * 4).alias("s1")).join(base.select(F.col("id").alias("s1")), "s1")
    return knn.recall_at(knn.exact_knn(base, rest, 20, "label"), t)


def _scored_docs(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", F.length("text").alias("n"), (F.length(F.regexp_replace("text", "[^.,]", "")) / F.greatest(F.length("text"), F.lit(1))).alias("marks"))
    return table(spark, d, "labels").join(t, "doc_id").withColumn("p", F.round(F.least(F.col("marks") * 15, F.lit(1.0)), 6))


@query(r"""WITH x AS (SELECT quality AS y, round(least(length(regexp_replace(text, '[^.,]', '', 'g')) / greatest(length(text), 1) * 15, 1.0::DOUBLE), 6) AS p FROM labels JOIN documents USING (doc_id)),
r AS (SELECT y, p, avg(k) OVER (PARTITION BY p) AS r FROM (SELECT *, row_number() OVER (ORDER BY p) AS k FROM x))
SELECT round((sum(r) FILTER (y = 1) - sum(y) * (sum(y) + 1) / 2.0::DOUBLE) / (sum(y) * sum(1 - y)), 6) AS auc, round(avg(CASE WHEN y = 1 THEN -ln(greatest(least(p, 1 - 1e-7), 1e-7)) ELSE -ln(1 - greatest(least(p, 1 - 1e-7), 1e-7)) END), 6) AS logloss, count(*) AS n FROM r""")
def exact_auc_logloss(spark: SparkSession, d: str) -> DataFrame:
    """A24."""
    return audit.auc_logloss(_scored_docs(spark, d), "quality", "p")


@query()
def gbt_oof_scores(spark: SparkSession, d: str) -> DataFrame:
    """ML1, ML2: out-of-fold scores of labelled documents."""
    x = _scored_docs(spark, d).select("doc_id", "quality", F.col("n").cast("double").alias("n"), "marks", F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("fold"))
    return models.out_of_fold(x, ["n", "marks"], "quality", rounds=5, depth=3).select("doc_id", "fold", "quality", "p")
