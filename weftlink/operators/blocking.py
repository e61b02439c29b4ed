"""Token similarity join (operators T1, T3, A11-A18, J3, J5, J7, J19, U2, X8).

One token join serves both directions: document frequencies, weights and the cap on
frequent tokens come first, so that no token with more than ``max_df`` rows of a group
ever meets itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.functions.normalize import tokens
from weftlink.staging import staged

VIEWS = ("name", "addr", "mix")
BITS = {("full", "s1"): 0, ("name", "s1"): 1, ("addr", "s1"): 2, ("full", "rec"): 3, ("name", "rec"): 4, ("addr", "rec"): 5}


def with_groups(rows: DataFrame, country: str = "cty", within: bool = True, wild: str = "unk") -> DataFrame:
    """Rows with their blocking groups ``grp``: one for each named country; a wild
    country joins all of them (one group ``unk`` if none is named)."""
    if not within:
        return rows.withColumn("grp", F.lit("all"))
    named = rows.where(F.col(country) != wild).select(F.col(country).alias("grp")).distinct()
    # one row of a few country names; wild rows are copied to each
    every = named.agg(F.array_sort(F.collect_set("grp")).alias("grps"))
    own = rows.where(F.col(country) != wild).withColumn("grp", F.col(country))
    loose = rows.where(F.coalesce(F.col(country), F.lit(wild)) == wild).join(F.broadcast(every))
    loose = loose.select(*rows.columns, F.explode(F.when(F.size("grps") > 0, F.col("grps")).otherwise(F.array(F.lit(wild)))).alias("grp"))
    return own.unionByName(loose)


def token_views(rows: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., view, tok) of normalized records, each token once a row and view."""
    core, words = tokens(F.col("n_core")), tokens(F.col("a_words"))
    pre = lambda p, xs: F.transform(xs, lambda t: F.concat(F.lit(p), t))
    longer = lambda xs, n: F.filter(xs, lambda t: F.length(t) >= n)
    one = lambda when, value: F.when(when, F.array(value)).otherwise(F.array().cast("array<string>"))
    first, postal, house = F.get("core", F.lit(0)), F.col("a_postal"), F.col("a_house")
    r = rows.select(*keep, core.alias("core"), words.alias("words"), tokens(F.col("n_skel")).alias("sk"), tokens(F.col("n_skel2")).alias("sk2"), "a_postal", "a_house")
    name = F.concat(pre("n", F.col("core")), F.transform(longer(F.col("core"), 5), lambda t: F.concat(F.lit("p"), F.left(t, F.lit(4)))), pre("k", longer(F.col("sk"), 2)), pre("v", longer(F.col("sk2"), 2)))
    addr = F.concat(pre("a", F.col("words")), one(postal != "", F.concat(F.lit("z"), postal)), one((house != "") & (F.size("words") > 0), F.concat(F.lit("h"), house, F.lit("|"), F.get("words", F.lit(0)))))
    last = F.when(F.size("words") > 2, F.slice("words", -2, 2)).otherwise(F.col("words"))
    mix = F.concat(one(postal != "", F.concat(F.lit("x"), first, F.lit("|"), F.left(postal, F.lit(3)))), F.transform(last, lambda w: F.concat(F.lit("y"), first, F.lit("|"), w)))
    mix = F.when(F.size("core") > 0, mix).otherwise(F.array().cast("array<string>"))
    views = F.array(*(F.struct(F.lit(v).alias("view"), F.array_distinct(t).alias("t")) for v, t in zip(VIEWS, (name, addr, mix), strict=True)))
    return r.select(*keep, F.inline(views)).select(*keep, "view", F.explode("t").alias("tok"))


def idf(toks: DataFrame, sizes: DataFrame, max_df: int) -> DataFrame:
    """(grp, view, tok, df_a, df_b, df, idf, alive) of (grp, view, tok, side, id)
    rows; sizes: (grp, n). A token is alive if its frequency is within ``max_df``."""
    df = toks.groupBy("grp", "view", "tok").agg(F.count(F.when(F.col("side") == "a", 1)).alias("df_a"), F.count(F.when(F.col("side") == "b", 1)).alias("df_b"))
    df = df.join(F.broadcast(sizes), "grp").withColumn("df", F.col("df_a") + F.col("df_b"))
    return df.select("grp", "view", "tok", "df_a", "df_b", "df", (F.ln((F.col("n") + 1) / (F.col("df") + 1)) + 1).alias("idf"), (F.col("df") <= max_df).alias("alive"))


def budget_cut(stats: DataFrame, budget: float) -> DataFrame:
    """``alive`` ends for the most frequent tokens of a group and view while the
    products of those that are left exceed the budget. Frequencies are few: their costs are
    summed up from the top, and tokens are put in order only within the one frequency that
    straddles the budget."""
    live = stats.where("alive").withColumn("cost", F.col("df_a") * F.col("df_b"))
    level = live.groupBy("grp", "view", "df").agg(F.sum("cost").alias("c"))
    w = Window.partitionBy("grp", "view")
    above = F.coalesce(F.sum("c").over(w.orderBy(F.desc("df")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = level.select("grp", "view", "df", "c", (F.sum("c").over(w) - F.lit(budget)).alias("over"), above.alias("above"))
    d = live.join(level, ["grp", "view", "df"])
    over, straddles = F.col("over") > 0, (F.col("over") > F.col("above")) & (F.col("over") <= F.col("above") + F.col("c"))
    order = Window.partitionBy("grp", "view", "df").orderBy("tok").rowsBetween(Window.unboundedPreceding, -1)
    part = d.where(over & straddles).withColumn("before", F.col("above") + F.coalesce(F.sum("cost").over(order), F.lit(0)))
    part = part.withColumn("alive", F.col("before") >= F.col("over")).select(*stats.columns)
    rest = d.where(~(over & straddles)).withColumn("alive", ~over | (F.col("above") >= F.col("over"))).select(*stats.columns)
    return rest.unionByName(part)


def weights(toks: DataFrame, stats: DataFrame) -> DataFrame:
    """(grp, view, tok, side, id, w, nz): w is the row's share of unit length over its
    alive tokens of the view, nz in how many views it has any. One shuffle by row."""
    alive = toks.join(stats.where("alive").select("grp", "view", "tok", "idf"), ["grp", "view", "tok"])
    row = Window.partitionBy("grp", "side", "id")
    sums = {v: F.sum(F.when(F.col("view") == v, F.col("idf") * F.col("idf"))).over(row) for v in VIEWS}
    d = alive.select("*", *(s.alias(f"s_{v}") for v, s in sums.items()))
    own = F.coalesce(*(F.when(F.col("view") == v, F.col(f"s_{v}")) for v in VIEWS))
    nz = sum((F.col(f"s_{v}").isNotNull().cast("int") for v in VIEWS), F.lit(0))
    return d.select("grp", "view", "tok", "side", "id", (F.col("idf") / F.sqrt(own)).alias("w"), nz.alias("nz"))


def similarities(w: DataFrame) -> DataFrame:
    """(grp, i, j, bs_full, bs_<view>...) for every pair that shares an alive
    token. The full score is the cosine over the views put side by side: their cosines'
    sum over the root of both rows' numbers of views. The weights are staged, as both sides
    of the join read them."""
    w = staged(w, "weights")
    a = w.where("side = 'a'").select("grp", "view", "tok", F.col("id").alias("i"), F.col("w").alias("wa"), F.col("nz").alias("na"))
    b = w.where("side = 'b'").select("grp", "view", "tok", F.col("id").alias("j"), F.col("w").alias("wb"), F.col("nz").alias("nb"))
    dot = F.col("wa") * F.col("wb")
    sums = [F.coalesce(F.sum(F.when(F.col("view") == v, dot)), F.lit(0.0)).alias(f"bs_{v}") for v in VIEWS]
    pairs = a.join(b, ["grp", "view", "tok"]).groupBy("grp", "i", "j").agg(*sums, F.max(F.col("na") * F.col("nb")).alias("nn"))
    full = (F.col("bs_name") + F.col("bs_addr") + F.col("bs_mix")) / F.sqrt("nn")
    return pairs.select("grp", "i", "j", full.alias("bs_full"), *(f"bs_{v}" for v in VIEWS))


def candidates(sims: DataFrame, k_s1: dict, k_rec: dict, digits: int = 12) -> DataFrame:
    """Pairs among the best k of either side in any view, with the mask of
    those (``found``); ties go to smaller ids. Of a pair in several groups the first stays.
    The three ranks of a side share a shuffle."""
    s = sims
    for side in ("s1", "rec"):
        key, other = ("i", "j") if side == "s1" else ("j", "i")
        ranks = {}
        for (view, of), bit in BITS.items():
            if of == side:
                rank = F.row_number().over(Window.partitionBy("grp", key).orderBy(F.round(f"bs_{view}", digits).desc(), other))
                ranks[f"__b{bit}"] = F.when((rank <= (k_s1 if side == "s1" else k_rec)[view]) & (F.col(f"bs_{view}") > 0), 1 << bit).otherwise(0)
        s = s.select("*", *(c.alias(n) for n, c in ranks.items()))
    found = sum((F.col(f"__b{bit}") for bit in BITS.values()), F.lit(0)).cast("smallint")
    kept = s.withColumn("found", found).where("found > 0").drop(*(f"__b{b}" for b in BITS.values()))
    first = Window.partitionBy("i", "j").orderBy("grp")
    return kept.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n")


def overlap_mass(pairs: DataFrame, toks: DataFrame, stats: DataFrame, view: str) -> DataFrame:
    """Pairs with the idf mass of common tokens (capped ones included) and of each
    side's others."""
    t = toks.where(F.col("view") == view).join(stats.select("grp", "view", "tok", "idf"), ["grp", "view", "tok"]).select("grp", "tok", "side", "id", "idf")
    total = t.groupBy("grp", "side", "id").agg(F.sum("idf").alias("m"))
    a = t.where("side = 'a'").select("grp", "tok", F.col("id").alias("i"), "idf")
    b = t.where("side = 'b'").select("grp", "tok", F.col("id").alias("j"))
    p = pairs.select("grp", "i", "j")
    shared = p.join(a, ["grp", "i"]).join(b, ["grp", "j", "tok"]).groupBy("grp", "i", "j").agg(F.sum("idf").alias("s"))
    out = pairs.join(shared, ["grp", "i", "j"], "left")
    for side, key in (("a", "i"), ("b", "j")):
        out = out.join(total.where(F.col("side") == side).select("grp", F.col("id").alias(key), F.col("m").alias(f"m{side}")), ["grp", key], "left")
    s = F.coalesce("s", F.lit(0.0))
    left = lambda m: F.greatest(F.coalesce(F.col(m), F.lit(0.0)) - s, F.lit(0.0))
    return out.select(*pairs.columns, s.alias(f"{view}_shared"), left("ma").alias(f"{view}_unm_a"), left("mb").alias(f"{view}_unm_b"))


def diagnose(truth: DataFrame, sims: DataFrame, found: DataFrame) -> DataFrame:
    """Of the true pairs, how many were retrieved, ranked out or out of reach."""
    return diagnose_near(truth, sims.where("bs_name > 0 or bs_addr > 0 or bs_mix > 0"), found)


def diagnose_near(truth: DataFrame, near: DataFrame, found: DataFrame) -> DataFrame:
    """``diagnose`` from the pairs in reach (i, j): they need cover the true pairs only."""
    near = near.select("i", "j").distinct().withColumn("near", F.lit(1))
    hit = found.select("i", "j").distinct().withColumn("hit", F.lit(1))
    t = truth.select("i", "j").distinct().join(near, ["i", "j"], "left").join(hit, ["i", "j"], "left")
    share = lambda c: F.round(F.avg(c.cast("double")), 5)
    hit, near = F.col("hit").isNotNull(), F.col("near").isNotNull()
    return t.agg(F.count("*").alias("true_pairs"), share(hit).alias("retrieved"), share(~near & ~hit).alias("unreachable"), share(near & ~hit).alias("ranked_out"), share(near).alias("reach_ceiling"))


def recall_report(found: DataFrame, truth: DataFrame, n_s1: int) -> DataFrame:
    """Pairs, pairs for each S1 entity, recall, and recall of each view and direction."""
    t = truth.select("i", "j").distinct()
    hits = t.join(found.select("i", "j", "found"), ["i", "j"], "left")
    per = [F.round(F.avg(F.when(F.coalesce(F.getbit(F.col("found").cast("int"), F.lit(b)), F.lit(0)) == 1, 1.0).otherwise(0.0)), 6).alias(f"recall_{v}_{d}") for (v, d), b in BITS.items()]
    r = hits.agg(F.round(F.avg(F.when(F.col("found").isNotNull(), 1.0).otherwise(0.0)), 6).alias("recall"), *per)
    n = found.agg(F.count("*").alias("n_pairs")).withColumn("pairs_per_s1", F.round(F.col("n_pairs") / n_s1, 6))
    # one row each
    return n.join(r)


def generate(records: DataFrame, cfg) -> DataFrame:
    """Candidates of normalized records (id, src, cty, n_*, a_*) with all blocking scores."""
    r = with_groups(records, within=cfg.within_country).withColumn("side", F.when(F.col("src") == 1, "a").otherwise("b"))
    sizes = r.groupBy("grp").agg(F.count("*").alias("n"))
    toks = staged(token_views(r, ["grp", "side", "id"]), "tokens")
    stats = staged(idf(toks, sizes, cfg.max_df), "token-stats")
    alive = budget_cut(stats, cfg.max_products)
    pairs = staged(candidates(similarities(weights(toks, alive)), cfg.k_s1, cfg.k_rec), "candidates")
    for view in ("name", "addr"):
        pairs = staged(overlap_mass(pairs, toks, stats, view), f"overlap-{view}")
    return pairs
