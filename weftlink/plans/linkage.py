"""Blocking over documents: operators T1, T3, A11-A18, J3, J5, J7, J19, U2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.config import Blocking
from weftlink.operators import blocking as B
from weftlink.operators import tiles
from weftlink.staging import staged

from .common import collector, table

QUERIES, SQL, query = collector()
#: Production settings; the tests set smaller ones over small tables.
MAX_DF, BUDGET = Blocking().max_df, Blocking().max_products
K_S1, K_REC = Blocking().k_s1, Blocking().k_rec


def _words(text) -> F.Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), ""))


def _side() -> F.Column:
    return F.when(F.col("doc_id") % 3 == 0, "a").otherwise("b").alias("side")


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    """(grp, side, id, view, tok): words, their starts of four letters, and words with the source."""
    views = F.array(*(F.struct(F.lit(v).alias("view"), F.col(v).alias("t")) for v in B.VIEWS))
    return _rows(spark, d).select("grp", "side", "id", F.inline(views)).select("grp", "side", "id", "view", F.explode("t").alias("tok"))


def _rows(spark: SparkSession, d: str, views: tuple[str, ...] = B.VIEWS) -> DataFrame:
    """(grp, side, id, tokens of each view)."""
    r = table(spark, d, "documents").select(F.coalesce("lang", F.lit("unk")).alias("grp"), _side(), F.col("doc_id").alias("id"), F.coalesce("source", F.lit("")).alias("source"), _words(F.col("text")).alias("w"))
    start = F.array_distinct(F.transform(F.filter("w", lambda x: F.length(x) >= 5), lambda x: F.left(x, F.lit(4))))
    of = {"name": F.col("w"), "addr": start, "mix": F.transform("w", lambda x: F.concat("source", F.lit("|"), x))}
    return r.select("grp", "side", "id", *(of[v].alias(v) for v in views))


def _sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").groupBy(F.coalesce("lang", F.lit("unk")).alias("grp")).agg(F.count("*").alias("n"))


def _stats(spark: SparkSession, d: str, max_df: int = MAX_DF) -> DataFrame:
    return B.idf(_tokens(spark, d), _sizes(spark, d), max_df)


def _sims(spark: SparkSession, d: str, max_df: int = MAX_DF, budget: float = BUDGET, views: tuple[str, ...] = B.VIEWS) -> DataFrame:
    """Similarities; documents are read once for the tokens, which are staged, and once for the sizes."""
    return _parts(spark, d, max_df, budget, views)[0]


def _parts(spark: SparkSession, d: str, max_df: int, budget: float, views: tuple[str, ...] = B.VIEWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    toks = staged(_tokens(spark, d).where(F.col("view").isin(*views)), "tokens")
    stats = staged(B.idf(toks, _sizes(spark, d), max_df), "token-stats")
    sims = B.similarities(B.weights(toks, B.budget_cut(stats, budget)))
    return sims, toks, stats


def _truth(spark: SparkSession, d: str, *more: str) -> DataFrame:
    """Pairs of both sides of a language with equal texts."""
    t = table(spark, d, "documents").where("text is not null").select(F.coalesce("lang", F.lit("unk")).alias("grp"), _side(), F.col("doc_id").alias("id"), F.md5("text").alias("h"))
    a, b = (t.where(F.col("side") == s).select("grp", "h", F.col("id").alias(k)) for s, k in (("a", "i"), ("b", "j")))
    return a.join(b, ["grp", "h"]).select(*more, "i", "j")


_TOK = r"""
d AS (SELECT coalesce(lang, 'unk') AS grp, CASE WHEN doc_id % 3 = 0 THEN 'a' ELSE 'b' END AS side, doc_id AS id, coalesce(source, '') AS source, text,
        list_distinct(list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w FROM documents),
tok AS (
  SELECT grp, side, id, 'name' AS view, unnest(w) AS tok FROM d
  UNION ALL SELECT grp, side, id, 'addr', unnest(list_distinct(list_transform(list_filter(w, lambda x: length(x) >= 5), lambda x: left(x, 4)))) FROM d
  UNION ALL SELECT grp, side, id, 'mix', unnest(list_transform(w, lambda x: source || '|' || x)) FROM d),
sz AS (SELECT grp, count(*) AS n FROM d GROUP BY 1),
st AS (SELECT grp, view, tok, count(*) FILTER (side = 'a') AS df_a, count(*) FILTER (side = 'b') AS df_b, count(*) AS df FROM tok GROUP BY 1, 2, 3),
stats AS (SELECT st.*, ln((n + 1) / (df + 1)) + 1 AS idf FROM st JOIN sz USING (grp))"""
_BUDGET = f"""c AS (SELECT *, df_a * df_b AS cost FROM stats WHERE df <= {MAX_DF}),
cut AS (SELECT *, NOT (over > 0 AND before < over) AS alive FROM (SELECT *, sum(cost) OVER (PARTITION BY grp, view) - {BUDGET} AS over,
  coalesce(sum(cost) OVER (PARTITION BY grp, view ORDER BY df DESC, tok ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c))"""
_SIM = (
    _TOK
    + f""",
{_BUDGET},
al AS (SELECT tok.*, idf FROM tok JOIN cut USING (grp, view, tok) WHERE alive),
wt AS (SELECT *, idf / sqrt(sum(idf * idf) OVER (PARTITION BY grp, view, side, id)) AS w FROM al),
dot AS (SELECT grp, a.id AS i, b.id AS j,
    coalesce(sum(a.w * b.w) FILTER (view = 'name'), 0) AS bs_name, coalesce(sum(a.w * b.w) FILTER (view = 'addr'), 0) AS bs_addr, coalesce(sum(a.w * b.w) FILTER (view = 'mix'), 0) AS bs_mix
  FROM (SELECT * FROM wt WHERE side = 'a') a JOIN (SELECT * FROM wt WHERE side = 'b') b USING (grp, view, tok) GROUP BY 1, 2, 3),
nz AS (SELECT grp, side, id, count(DISTINCT view) AS nz FROM wt GROUP BY 1, 2, 3),
sim AS (SELECT dot.*, (bs_name + bs_addr + bs_mix) / sqrt(na.nz * nb.nz) AS bs_full
  FROM dot JOIN nz na ON na.grp = dot.grp AND na.side = 'a' AND na.id = i JOIN nz nb ON nb.grp = dot.grp AND nb.side = 'b' AND nb.id = j)"""
)
_RANKS = ",\n  ".join(f"CASE WHEN row_number() OVER (PARTITION BY grp, {'i' if side == 's1' else 'j'} ORDER BY round(bs_{view}, 12) DESC, {'j' if side == 's1' else 'i'}) <= {(K_S1 if side == 's1' else K_REC)[view]} AND bs_{view} > 0 THEN {1 << bit} ELSE 0 END AS b{bit}" for (view, side), bit in B.BITS.items())
_CAND = (
    _SIM
    + f""",
rk AS (SELECT *, {_RANKS} FROM sim),
cand AS (SELECT *, CAST(b0 + b1 + b2 + b3 + b4 + b5 AS SMALLINT) AS found FROM rk WHERE b0 + b1 + b2 + b3 + b4 + b5 > 0),
truth AS (SELECT DISTINCT a.id AS i, b.id AS j FROM d a JOIN d b ON a.grp = b.grp AND a.text = b.text AND a.side = 'a' AND b.side = 'b')"""
)


@query(f"WITH {_TOK} SELECT grp, view, tok, df_a, df_b, df, round(idf, 6) AS idf, df <= {MAX_DF} AS alive FROM stats")
def token_df_idf(spark: SparkSession, d: str, max_df: int = MAX_DF, budget: float = BUDGET) -> DataFrame:
    """A11, A12, T1."""
    return _stats(spark, d, max_df).withColumn("idf", F.round("idf", 6))


@query(f"WITH {_TOK}, {_BUDGET} SELECT grp, view, tok, df, alive FROM cut")
def budget_cut_tokens(spark: SparkSession, d: str, max_df: int = MAX_DF, budget: float = BUDGET) -> DataFrame:
    """A13, W10."""
    return B.budget_cut(_stats(spark, d, max_df), budget).select("grp", "view", "tok", "df", "alive")


def _topk(spark: SparkSession, d: str, key: str, other: str, k: int, max_df: int, budget: float) -> DataFrame:
    from pyspark.sql import Window

    store = tiles.prepare(_rows(spark, d, ("name",)), ("name",), max_df, budget)
    s = tiles.best(store, {"name": (k, 0) if key == "i" else (0, k)}, 9, ["name"]) if store else _sims(spark, d, max_df, budget, ("name",))
    s = s.select("grp", "i", "j", F.round("bs_name", 9).alias("score")).where("score > 0")
    w = Window.partitionBy("grp", key).orderBy(F.desc("score"), other)
    return s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("grp", "i", "j", F.round("score", 6).alias("score"), "rank")


def _topk_sql(key: str, other: str, k: int) -> str:
    return f"""WITH {_SIM}, s AS (SELECT grp, i, j, round(bs_name, 9) AS score FROM sim WHERE round(bs_name, 9) > 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY grp, {key} ORDER BY score DESC, {other}) AS INT) AS rank FROM s)
SELECT grp, i, j, round(score, 6) AS score, rank FROM r WHERE rank <= {k}"""


@query(_topk_sql("i", "j", 6))
def topk_token_cosine_s1(spark: SparkSession, d: str, max_df: int = MAX_DF, budget: float = BUDGET) -> DataFrame:
    """The best six records of each clean one."""
    return _topk(spark, d, "i", "j", 6, max_df, budget)


@query(_topk_sql("j", "i", 3))
def topk_token_cosine_rec(spark: SparkSession, d: str, max_df: int = MAX_DF, budget: float = BUDGET) -> DataFrame:
    """The best three clean ones of each record."""
    return _topk(spark, d, "j", "i", 3, max_df, budget)


@query(f"WITH {_CAND} SELECT grp, i, j, found, round(bs_full, 6) AS bs_full, round(bs_name, 6) AS bs_name, round(bs_addr, 6) AS bs_addr FROM cand")
def candidates_found_mask(spark: SparkSession, d: str, max_df: int = MAX_DF, budget: float = BUDGET) -> DataFrame:
    """A15, U2, T3, O1, J5."""
    store = tiles.prepare(_rows(spark, d), B.VIEWS, max_df, budget)
    c = tiles.candidates(store, K_S1, K_REC) if store else B.candidates(_sims(spark, d, max_df, budget), K_S1, K_REC)
    return c.select("grp", "i", "j", "found", *(F.round(f"bs_{v}", 6).alias(f"bs_{v}") for v in ("full", "name", "addr")))


@query(f"""WITH {_CAND},
nt AS MATERIALIZED (SELECT grp, side, id, tok, idf FROM tok JOIN stats USING (grp, view, tok) WHERE view = 'name'),
tot AS (SELECT grp, side, id, sum(idf) AS m FROM nt GROUP BY 1, 2, 3),
ca AS MATERIALIZED (SELECT c.grp, c.i, c.j, a.tok, a.idf FROM cand c JOIN nt a ON a.side = 'a' AND a.id = c.i AND a.grp = c.grp),
sh AS (SELECT ca.grp, ca.i, ca.j, sum(ca.idf) AS s FROM ca JOIN nt b ON b.side = 'b' AND b.id = ca.j AND b.tok = ca.tok AND b.grp = ca.grp GROUP BY 1, 2, 3)
SELECT c.i, c.j, round(coalesce(s, 0), 6) AS name_shared, round(greatest(coalesce(ma.m, 0) - coalesce(s, 0), 0), 6) AS name_unm_a, round(greatest(coalesce(mb.m, 0) - coalesce(s, 0), 0), 6) AS name_unm_b
FROM cand c LEFT JOIN sh USING (grp, i, j) LEFT JOIN tot ma ON ma.grp = c.grp AND ma.side = 'a' AND ma.id = c.i LEFT JOIN tot mb ON mb.grp = c.grp AND mb.side = 'b' AND mb.id = c.j""")
def overlap_mass(spark: SparkSession, d: str, max_df: int = MAX_DF, budget: float = BUDGET) -> DataFrame:
    """A16."""
    if store := tiles.prepare(_rows(spark, d), B.VIEWS, max_df, budget):
        m = tiles.overlap_mass(store, tiles.candidates(store, K_S1, K_REC).select("grp", "i", "j"), "name")
    else:
        sims, toks, stats = _parts(spark, d, max_df, budget)
        m = B.overlap_mass(staged(B.candidates(sims, K_S1, K_REC), "candidates"), toks, stats, "name")
    return m.select("i", "j", *(F.round(x, 6).alias(x) for x in ("name_shared", "name_unm_a", "name_unm_b")))


@query(f"""WITH {_CAND},
t AS (SELECT truth.i, truth.j, max(sim.i IS NOT NULL) AS near, max(cand.i IS NOT NULL) AS hit FROM truth LEFT JOIN sim ON sim.i = truth.i AND sim.j = truth.j LEFT JOIN cand ON cand.i = truth.i AND cand.j = truth.j GROUP BY 1, 2)
SELECT count(*) AS true_pairs, round(avg(hit::INT), 5) AS retrieved, round(avg((NOT near AND NOT hit)::INT), 5) AS unreachable, round(avg((near AND NOT hit)::INT), 5) AS ranked_out, round(avg(near::INT), 5) AS reach_ceiling FROM t""")
def miss_diagnosis(spark: SparkSession, d: str, max_df: int = MAX_DF, budget: float = BUDGET) -> DataFrame:
    """J19, A17."""
    if store := tiles.prepare(_rows(spark, d), B.VIEWS, max_df, budget):
        return B.diagnose_near(_truth(spark, d), tiles.near(store, _truth(spark, d, "grp")), tiles.candidates(store, K_S1, K_REC))
    s = staged(_sims(spark, d, max_df, budget), "similarities")
    return B.diagnose(_truth(spark, d), s, B.candidates(s, K_S1, K_REC))


_PER = ", ".join(f"round(avg(coalesce((found >> {b}) & 1, 0)), 6) AS recall_{v}_{s}" for (v, s), b in B.BITS.items())


@query(f"""WITH {_CAND}, n AS (SELECT count(*) AS n_pairs FROM cand),
r AS (SELECT round(avg((cand.i IS NOT NULL)::INT), 6) AS recall, {_PER} FROM truth LEFT JOIN cand USING (i, j))
SELECT n_pairs, round(n_pairs / (SELECT count(*) FROM d WHERE side = 'a'), 6) AS pairs_per_s1, r.* FROM n, r""")
def recall_report(spark: SparkSession, d: str, max_df: int = MAX_DF, budget: float = BUDGET) -> DataFrame:
    """A18."""
    n = table(spark, d, "documents").where("doc_id % 3 = 0").count()
    store = tiles.prepare(_rows(spark, d), B.VIEWS, max_df, budget)
    found = staged(tiles.candidates(store, K_S1, K_REC).select("i", "j", "found"), "candidates") if store else B.candidates(_sims(spark, d, max_df, budget), K_S1, K_REC)
    return B.recall_report(found, _truth(spark, d), n)


@query("""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 OR lang IS NULL THEN 'unk' ELSE lang END AS cty FROM documents),
g AS (SELECT DISTINCT cty AS grp FROM r WHERE cty <> 'unk')
SELECT doc_id, cty, cty AS grp FROM r WHERE cty <> 'unk' UNION ALL SELECT doc_id, cty, grp FROM r, g WHERE cty = 'unk'""")
def wildcard_group_join(spark: SparkSession, d: str) -> DataFrame:
    """Rows of an unknown country join every country's group."""
    r = table(spark, d, "documents").select("doc_id", F.when((F.col("doc_id") % 7 == 0) | F.col("lang").isNull(), "unk").otherwise(F.col("lang")).alias("cty"))
    return B.with_groups(r)
