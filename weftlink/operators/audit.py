"""Audits of sources and scores (operators A1-A10, A24, A31, A32, J20, U3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_counts_top(rows: DataFrame, by: str, value: str, k: int = 10) -> DataFrame:
    """A1: the ``k`` commonest values of each group."""
    n = rows.groupBy(by, value).agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), value))).where(F.col("rank") <= k)


def empty_rates(rows: DataFrame, by: str, cols: list[str]) -> DataFrame:
    """A2."""
    return rows.groupBy(by).agg(*(F.round(F.avg((F.coalesce(c, F.lit("")) == "").cast("int")), 5).alias(f"empty_{c}") for c in cols))


def frequency(rows: DataFrame, keys: list[str], when, name: str) -> DataFrame:
    """A4: rows with the number of rows of the same keys (null is a key) for which ``when``
    holds: summed first and joined back, so a key with a third of all rows is split."""
    n = rows.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(F.sum(F.when(when, 1).otherwise(0)).alias(name))
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return rows.join(n, same).select(*rows.columns, name)


def capped_histogram(rows: DataFrame, value: str, cap: int = 10) -> DataFrame:
    """A8."""
    return rows.groupBy(F.least(F.col(value), F.lit(cap)).alias("bucket")).agg(F.count("*").alias("n"))


#: Ranges that a running count is cut into.
RANGES = 64


def running_below(values: DataFrame, value: str, count: str) -> DataFrame:
    """Rows of distinct numbers and their counts, with ``below``: the count of all smaller
    ones. The numbers are cut into ranges at approximate quantiles; each range is ordered
    by a task of its own, and the totals before it (one row a range) are added."""
    cuts = sorted(set(values.approxQuantile(value, [k / RANGES for k in range(1, RANGES)], 0.002)))
    at = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda x: x <= F.col(value))) if cuts else F.lit(0)
    v = values.withColumn("__b", at)
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = v.groupBy("__b").agg(F.sum(count).alias("__s"))
    sums = sums.select("__b", F.coalesce(F.sum("__s").over(before(Window.orderBy("__b"))), F.lit(0)).alias("__pre"))
    own = F.coalesce(F.sum(count).over(before(Window.partitionBy("__b").orderBy(value))), F.lit(0))
    return v.join(F.broadcast(sums), "__b").withColumn("below", F.col("__pre") + own).drop("__b", "__pre")


def spearman(rows: DataFrame, x: str, y: str) -> DataFrame:
    """A10: correlation of average ranks; null under three rows. Ranks come from counts of
    the distinct values."""
    r = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    for c in ("x", "y"):
        d = running_below(r.groupBy(c).agg(F.count("*").alias("m")), c, "m")
        r = r.join(d.select(c, (F.col("below") + (F.col("m") + 1) / 2.0).alias(f"r{c}")), c)
    return r.agg(F.when(F.count("*") >= 3, F.round(F.corr("rx", "ry"), 6)).alias("spearman"), F.count("*").alias("n"))


def auc_logloss(rows: DataFrame, label: str, p: str) -> DataFrame:
    """Exact area under the curve by average ranks of the distinct scores, and log loss
    with p clipped; null with one class only."""
    c = F.least(F.greatest(F.col(p), F.lit(1e-7)), F.lit(1 - 1e-7))
    d = rows.groupBy(F.col(p).cast("double").alias("p")).agg(F.sum(label).alias("pos"), F.count("*").alias("m"), F.sum(F.when(F.col(label) == 1, -F.ln(c)).otherwise(-F.ln(1 - c))).alias("loss"))
    d = running_below(d, "p", "m").withColumn("rank", F.col("below") + (F.col("m") + 1) / 2.0)
    pos, n = F.sum("pos"), F.sum("m")
    both = (pos > 0) & (pos < n)
    auc = (F.sum(F.col("rank") * F.col("pos")) - pos * (pos + 1) / 2.0) / F.nullif(pos * (n - pos), F.lit(0))
    return d.agg(F.when(both, F.round(auc, 6)).alias("auc"), F.when(both, F.round(F.sum("loss") / n, 6)).alias("logloss"), n.alias("n"))


def listwise_loss(pairs: DataFrame, z: str, label: str, group: str = "i") -> DataFrame:
    """ML8: mean over the groups of the cross entropy of their labels' shares (all on "none" where
    no label is 1) and the softmax of their logits with "none" at 0."""
    top = F.greatest(F.max(z), F.lit(0.0))
    g = pairs.groupBy(group).agg(top.alias("t"), F.collect_list(z).alias("z"), F.sum(label).alias("n"), F.sum(F.when(F.col(label) == 1, F.col(z))).alias("zp"))
    total = F.aggregate("z", F.exp(-F.col("t")), lambda s, x: s + F.exp(x - F.col("t")))
    g = g.select((F.col("t") + F.ln(total) - F.when(F.col("n") > 0, F.col("zp") / F.col("n")).otherwise(0.0)).alias("l"))
    return g.agg(F.avg("l").alias("loss"), F.count("*").alias("n"))


def mine_abbreviations(pairs: DataFrame, a: str, b: str, least: int = 5) -> DataFrame:
    """(short, long, n) rules: tokens of one side only that abbreviate tokens of the
    other side only, at least so often; of each short form the commonest long one."""
    from weftlink.functions.normalize import basic, tokens

    # tokens of the common form, each text's once
    t = pairs.select(tokens(basic(F.col(a))).alias("a"), tokens(basic(F.col(b))).alias("b"))
    left, right = F.array_except("a", "b"), F.array_except("b", "a")
    x = t.select(left.alias("l"), right.alias("r")).select(F.explode("l").alias("x"), "r").select("x", F.explode("r").alias("y"))
    both = x.unionByName(x.select(F.col("y").alias("x"), F.col("x").alias("y")))
    # a start, or the letters in order with both ends the same
    spread = F.concat(F.lit("^"), F.array_join(F.transform(F.split("x", ""), lambda c: F.concat(F.lit(r"\Q"), c, F.lit(r"\E"))), ".*"), F.lit("$"))
    ok = (F.length("x") >= 2) & (F.length("x") < F.length("y")) & ~F.col("x").rlike(r"^\d+$") & ~F.col("y").rlike(r"^\d+$") & (F.startswith("y", "x") | F.regexp_like("y", spread))
    n = both.where(ok).groupBy(F.col("x").alias("short"), F.col("y").alias("long")).agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return n.withColumn("__r", F.row_number().over(Window.partitionBy("short").orderBy(F.desc("n"), "long"))).where("__r = 1").drop("__r")
