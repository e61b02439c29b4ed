"""Group context of scored pairs (operators W1-W9, F8-F10, J8, J9, J13, J18, A19-A21, MX2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.functions.exprs import finite, logit, sigmoid


def group_context(rows: DataFrame, key: str, value: str, order: list[str], fill: float = -1.0, prefix: str = "") -> DataFrame:
    """Rank (1 is best), gap to the best, margin over the second best (``fill`` for
    groups of one), and size, each group by value from the top, ties by ``order``. One
    shuffle for a key, whatever the number of values."""
    w = Window.partitionBy(key)
    by = w.orderBy(F.desc(value), *order)
    whole = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    second = F.coalesce(F.nth_value(value, 2).over(whole), F.lit(float(fill)))
    return rows.select("*", F.row_number().over(by).alias(f"{prefix}rank"), (F.col(value) - F.max(value).over(w)).alias(f"{prefix}gap"), (F.col(value) - second).alias(f"{prefix}m2"), F.count("*").over(w).alias(f"{prefix}size"))


def prune(pairs: DataFrame, p: str, min_p: float = 0.002, rank_s1: int = 12, rank_rec: int = 6) -> DataFrame:
    """F8: pairs that are likely enough and among the best of both sides; ranks go over all
    pairs, scores that are not finite last."""
    v = finite(F.col(p), -1.0)
    out = pairs.withColumn("__p", v)
    out = out.withColumn("__i", F.row_number().over(Window.partitionBy("i").orderBy(F.desc("__p"), "j"))).withColumn("__j", F.row_number().over(Window.partitionBy("j").orderBy(F.desc("__p"), "i")))
    return out.where((F.col("__p") >= min_p) & (F.col("__i") <= rank_s1) & (F.col("__j") <= rank_rec)).select(*pairs.columns)


def exclusive(pairs: DataFrame, p: str, mode: str, key: str = "j", other: str = "i") -> DataFrame:
    """MX2, W8: ``pe``: probabilities given that a record belongs to one entity at most, over
    all pairs of the record. softmax: its odds over 1 plus all odds; hard: only the best
    pair keeps its own; softmax_hard: both."""
    if mode not in ("none", "softmax", "hard", "softmax_hard"):
        raise ValueError(mode)
    out = pairs.withColumn("pe", F.col(p).cast("double"))
    if "softmax" in mode:
        q = F.least(F.greatest(F.col("pe"), F.lit(1e-6)), F.lit(1 - 1e-6))
        odds = q / (1 - q)
        out = out.withColumn("__o", odds)
        out = out.withColumn("pe", F.col("__o") / (1 + F.sum("__o").over(Window.partitionBy(key)))).drop("__o")
    if "hard" in mode:
        best = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("pe"), other))
        out = out.withColumn("__r", best).withColumn("pe", F.when(F.col("__r") == 1, F.col("pe")).otherwise(0.0)).drop("__r")
    return out


def assign(pairs: DataFrame, p: str, t: float) -> DataFrame:
    """Each record's best pair, if it reaches the threshold."""
    best = Window.partitionBy("j").orderBy(F.desc(p), "i")
    return pairs.withColumn("__r", F.row_number().over(best)).where((F.col("__r") == 1) & (F.col(p) >= t)).drop("__r")


def competition(pairs: DataFrame, score: str) -> DataFrame:
    """Context of both sides of a logit score: rank, gap, margin (fill -30), best
    competitor and softmax share, and on the entity's side the sum of probabilities and
    how many are over one half."""
    z = F.least(F.greatest(finite(F.col(score)), F.lit(-30.0)), F.lit(30.0))
    out = pairs.withColumn("z", z)
    for side, other in (("i", "j"), ("j", "i")):
        out = group_context(out, side, "z", [other], -30.0, f"cx_{side}_")
        top = F.col(f"cx_{side}_gap") >= -1e-9
        out = out.withColumn(f"cx_{side}_other", F.when(top, F.col("z") - F.col(f"cx_{side}_m2")).otherwise(F.col("z") - F.col(f"cx_{side}_gap")))
        out = out.withColumn(f"cx_{side}_share", F.exp("z") / (1 + F.sum(F.exp("z")).over(Window.partitionBy(side))))
    w = Window.partitionBy("i")
    out = out.withColumn("cx_sum_p", F.sum(sigmoid(F.col("z"))).over(w))
    return out.withColumn("cx_n_half", F.sum((F.col("z") > 0).cast("int")).over(w))


def group_pairs(rows: DataFrame, key: str, rid: str, most: int = 12) -> DataFrame:
    """Ordered pairs (a, b) of rows with the same key, of groups of 2 to ``most`` rows;
    larger groups are left out, so the join stays linear in the rows."""
    n = F.count("*").over(Window.partitionBy(key))
    few = rows.withColumn("__n", n).where((F.col("__n") >= 2) & (F.col("__n") <= most)).drop("__n")
    a = few.select(F.col(key).alias("k"), F.struct(*few.columns).alias("a"))
    b = few.select(F.col(key).alias("k2"), F.struct(*few.columns).alias("b"))
    return a.join(b, (F.col("k") == F.col("k2")) & (F.col(f"a.{rid}") != F.col(f"b.{rid}"))).select("a", "b")


def support(near: DataFrame) -> DataFrame:
    """(i, j, ...) of each pair a that has others b (a, b, sim; both with i, j, p
    and src): greatest similarity, greatest similarity times b's probability, over all and
    over those of another source, their sum, and the similarity to the likeliest (of equals
    the smallest) other."""
    sp = F.col("sim") * F.col("b.p")
    floor = lambda c: F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(0.0))
    cross = F.col("a.src") != F.col("b.src")
    rank = F.struct(-F.col("b.p"), F.col("b.i"), F.col("b.j"))
    return near.groupBy(F.col("a.i").alias("i"), F.col("a.j").alias("j")).agg(
        floor(F.max("sim")).alias("nb_max_sim"),
        floor(F.max(sp)).alias("nb_support"),
        floor(F.max(F.when(cross, sp))).alias("nb_support_x"),
        F.sum(sp).alias("nb_support_sum"),
        F.min_by("sim", rank).alias("cmp_best_sim"),
    )


def hardest_negatives(pairs: DataFrame, p: str, label: str, n: int) -> DataFrame:
    """All positives, and the ``n`` likeliest negatives of each entity."""
    rank = F.row_number().over(Window.partitionBy("i", F.col(label) == 1).orderBy(F.desc(p), "j"))
    return pairs.withColumn("__r", rank).where((F.col(label) == 1) | (F.col("__r") <= n)).drop("__r")


def competitor_negatives(pool: DataFrame, pairs: DataFrame, sampled: DataFrame, p: str, n: int) -> DataFrame:
    """Of records in the pool, the ``n`` likeliest pairs with entities outside the sample."""
    out = pairs.join(pool.select("j").distinct(), "j", "left_semi").join(sampled.select("i").distinct(), "i", "left_anti")
    best = Window.partitionBy("j").orderBy(F.desc(p), "i")
    return out.withColumn("__r", F.row_number().over(best)).where(F.col("__r") <= n).drop("__r")


def attach_scores(pairs: DataFrame, scores: dict[str, DataFrame], p: str) -> DataFrame:
    """Logit scores (i, j, z) of outside models; a pair without one takes the
    logit of its own p and says so in ``ce_has_<name>``; with several their mean, too.
    Scores of pairs that do not exist are stale and an error."""
    out = pairs
    for name, s in scores.items():
        if s.join(pairs, ["i", "j"], "left_anti").limit(1).count():
            raise RuntimeError(f"scores {name!r} are of other pairs")
        z = s.select("i", "j", F.col("z").alias(f"__{name}"))
        out = out.join(z, ["i", "j"], "left")
        ok = F.col(f"__{name}").isNotNull() & ~F.isnan(f"__{name}") & (F.abs(f"__{name}") != float("inf"))
        out = out.withColumn(f"ce_has_{name}", ok.cast("tinyint")).withColumn(f"z_{name}", F.when(ok, F.col(f"__{name}")).otherwise(logit(F.col(p)))).drop(f"__{name}")
    if len(scores) > 1:
        out = out.withColumn("z_mean", sum((F.col(f"z_{n}") for n in scores), F.lit(0.0)) / len(scores))
    return out


def learned_competition(cand: DataFrame) -> DataFrame:
    """Of (rec, s1, rank, score): gap to the record's best, its margin over the
    second, and the entity's best score, gap, rank, size and number of records it leads."""
    r, s = Window.partitionBy("rec"), Window.partitionBy("s1")
    top = lambda k: F.max(F.when(F.col("rank") == k, F.col("score"))).over(r)
    out = cand.select("*", (top(1) - F.col("score")).alias("gap_top1"), (top(1) - F.coalesce(top(2), F.lit(0.0))).alias("margin12"))
    return out.select("*", F.max("score").over(s).alias("s1_max"), (F.max("score").over(s) - F.col("score")).alias("gap_s1"), F.row_number().over(s.orderBy(F.desc("score"), "rec")).alias("s1_rank"), F.count("*").over(s).alias("s1_n"), F.sum((F.col("rank") == 1).cast("int")).over(s).alias("s1_n_top1"))


def batches(rows: DataFrame, country: str, key: str, size: int, seed: int = 42) -> DataFrame:
    """O3: training batches of rows whose sort keys are near: ``number`` within the country,
    and ``batch``, by which they go in a random order; the incomplete last batch of each
    country is dropped."""
    # a row's number: the rows of its country before its range, which the ranges' counts give,
    # and its place there; rows of one key go by a digest of the id, which parts them evenly
    digest = F.md5(F.col("id").cast("string"))
    d = rows.select("*", digest.alias("__d"), F.left(digest, F.lit(2)).alias("__r"))
    here = [country, key, "__r"]
    n = d.groupBy(*here).agg(F.count("*").alias("__m"))
    by = Window.partitionBy(country).orderBy(key, "__r").rowsBetween(Window.unboundedPreceding, -1)
    n = n.select(*(F.col(c).alias(f"__k{i}") for i, c in enumerate(here)), F.coalesce(F.sum("__m").over(by), F.lit(0)).alias("__pre"), F.sum("__m").over(Window.partitionBy(country)).alias("__all"))
    d = d.join(n, [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(here)])
    at = F.col("__pre") + F.row_number().over(Window.partitionBy(*here).orderBy("__d", "id")) - 1
    d = d.withColumn("number", F.floor(at / size)).where((F.col("number") + 1) * size <= F.col("__all"))
    return d.select(*rows.columns, "number", F.xxhash64(F.lit(seed), F.col(country), F.col("number")).alias("batch"))
