"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, staged

LEAF = 2048
FAN = 16
REPEATS = 3
SEED = 11
#: Equal rows that one task spreads out again.
COPIES = 65536


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """(source, n, source_size, target) of (source, n, source_size) rows, one for
    each source. Sources in code-point order, null last, weigh 1, 2, 3, 1, ...; they
    share the whole size by weight, no target over ``repeats`` times its source's
    size, the excess reshared by weight until none is above. In closed form: with
    the sources ordered by cap over weight, those before the first that stays under
    its cap are full, and the rest share what is left by weight."""
    # one task over one row a source
    rank = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("w", (F.row_number().over(rank) - 1) % 3 + 1)
    w = w.withColumn("cap", (F.col("source_size") * repeats).cast("double"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    w = w.withColumn("share", left / F.sum("w").over(after)).withColumn("free", F.col("share") * F.col("w") <= F.col("cap"))
    level = F.min(F.when(F.col("free"), F.struct((F.col("cap") / F.col("w")).alias("at"), F.col("share").alias("share")))).over(whole)
    w = w.withColumn("level", level["share"])
    full = F.col("level").isNull() | (F.col("cap") < F.col("level") * F.col("w"))
    return w.select("source", "n", "source_size", F.when(full, F.col("cap")).otherwise(F.col("level") * F.col("w")).alias("target"))


def _uniform(seed: int, a: np.ndarray) -> np.ndarray:
    """One number in [0, 1) for each value, the same in any run (splitmix64)."""
    with np.errstate(over="ignore"):
        z = a.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (z ^ (z >> np.uint64(31))) / 2.0**64


def pivot(size: np.ndarray, x: np.ndarray, u: np.ndarray) -> int:
    """Round the copy probabilities ``x`` in place until one at most is fractional;
    its index, or -1. Two fractional rows exchange words: one gains what the other
    loses, so size @ x stays, until one of them is at 0 or 1; which way is drawn so
    that each x keeps its expectation. The larger rows meet first."""
    carry = -1
    for i in np.lexsort((np.arange(len(size)), -size)).tolist():
        if not 1e-12 < x[i] < 1 - 1e-12:
            x[i] = round(x[i])
            continue
        if carry < 0:
            carry = i
            continue
        a, b = carry, i
        up = min((1 - x[a]) * size[a], x[b] * size[b])
        down = min(x[a] * size[a], (1 - x[b]) * size[b])
        move = up if u[i] * (up + down) < down else -down
        x[a] += move / size[a]
        x[b] -= move / size[b]
        fractional = [k for k in (a, b) if 1e-9 < x[k] < 1 - 1e-9]
        for k in (a, b):
            if k not in fractional:
                x[k] = round(x[k])
        carry = fractional[0] if fractional else -1
    return carry


def _level(depth: int, last: bool):
    def rounded(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["key", "size", "id"], na_position="last", kind="stable").reset_index(drop=True)
        x, size = pdf["x"].to_numpy(float).copy(), pdf["size"].to_numpy(float)
        u = _uniform(SEED + depth, pdf["key"].to_numpy("int64"))
        at = pivot(size, x, u)
        if at >= 0 and last:
            x[at] = 1.0 if _uniform(SEED - 1, pdf["key"].to_numpy("int64")[at : at + 1])[0] < x[at] else 0.0
            at = -1
        return pdf.assign(x=x, open=np.arange(len(pdf)) == at)

    return rounded


def _each(counted: DataFrame) -> DataFrame:
    """(id, source, size, m) of ``m`` equal rows -> a row for each, with its number and a
    ``key`` of its own. More than ``COPIES`` equal rows are shared out among tasks first."""
    m = F.col("m")
    few = counted.where(m <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), m)))
    parts = F.sequence(F.lit(0).cast("long"), F.floor((m - 1) / COPIES))
    many = counted.where(m > COPIES).withColumn("part", F.explode(parts)).repartition("id", "source", "size", "part")
    first = F.col("part") * COPIES
    many = many.withColumn("copy", F.explode(F.sequence(first + 1, F.least(m, first + COPIES))))
    key = F.xxhash64("id", F.lit(SEED), "size", "copy").alias("key")
    return few.unionByName(many.drop("part")).select("id", "source", "size", key)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, copies, taken) for every row of ``docs``.

    A document's copy expectation is its source's target over its source's size (at
    most 3); its whole part is certain, the rest is rounded by pivotal pairing of
    words within groups of about 2048 documents of a source, whose single residual
    rows meet in the next level of a 16-way reduction tree until one is left. So a
    source's taken words miss its target by part of one document. Group membership
    and draws come from hashes of the id, the size and the number among equal rows, so
    reruns agree and an id that a third of all rows share fills no group. Null texts
    and texts without words have size 0, and take nothing; a null source is a source
    of its own; a null id hashes as such; repeated rows are rows of their own, and
    equal ones may change places. Other columns are ignored; an empty table gives none."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    counted = staged(rows.groupBy("id", "source", "size").agg(F.count("*").alias("m")), "mix-sizes")
    stats = counted.groupBy("source").agg(F.sum("m").alias("n"), F.sum(F.col("size") * F.col("m")).alias("source_size"))
    targets = staged(source_targets(stats), "mix-targets")
    leaves = F.greatest(F.lit(1), F.ceil(F.col("n") / LEAF)).cast("long")
    depth = F.ceil(F.log(float(FAN), leaves.cast("double")) - 1e-9).cast("int")
    t = targets.select(F.col("source").alias("s"), "source_size", "target", leaves.alias("leaves"), F.greatest(F.lit(0), depth).alias("depth"), F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("p"))
    most = t.agg(F.max("depth")).first()[0] or 0
    p = F.when(F.col("size") > 0, F.least(F.col("p"), F.lit(float(REPEATS)))).otherwise(0.0)
    r = _each(counted).join(t, F.col("source").eqNullSafe(F.col("s"))).withColumn("sure", F.floor(p).cast("long")).withColumn("x", p - F.floor(p))
    r = r.select(F.col("id").cast("string").alias("id"), "source", "size", "key", "source_size", "target", "sure", "x", F.pmod("key", "leaves").alias("node"), F.lit(False).alias("open"))
    schema = r.schema
    done, level = [], r
    for k in range(most + 1):
        out = staged(level.groupBy("source", "node").applyInPandas(_level(k, k == most), schema), f"mix-level{k}")
        done.append(out.where("not open"))
        level = out.where("open").withColumn("node", F.floor(F.col("node") / FAN).cast("long"))
    whole = done[0]
    for d in done[1:]:
        whole = whole.unionByName(d)
    copies = F.col("sure") + F.round("x").cast("long")
    return whole.select(F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
