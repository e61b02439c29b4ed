"""Exact nearest neighbours inside a group, by blocks of matrix products (operators J16, A26, MX7)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unit_col(v) -> F.Column:
    """MX7: an array over its length; zero vectors stay."""
    n = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v.cast("array<double>"))


def exact_knn(base: DataFrame, queries: DataFrame, k: int, group: str, block: int = 2048) -> DataFrame:
    """(rec, s1, rank, score): the ``k`` base vectors of the largest inner product for
    each query of the same group; ties to smaller ids. Both sides are cut into blocks by a
    hash of the id; a pair of blocks is one product, and each task keeps k a query, so no
    task holds a whole group. base, queries: (id, group, vec). Groups with an empty side
    give nothing."""
    def cut(df: DataFrame) -> DataFrame:
        n = df.groupBy(F.col(group).alias("g")).agg(F.ceil(F.count("*") / block).alias("blocks"))
        return df.join(n, F.col(group) == F.col("g")).select("g", "id", "vec", F.pmod(F.xxhash64("id"), "blocks").alias("blk"))

    def packed(df: DataFrame, p: str) -> DataFrame:
        b = cut(df).groupBy("g", "blk").agg(F.array_sort(F.collect_list(F.struct("id", "vec"))).alias("x"))
        return b.select(F.col("g").alias(f"{p}g"), F.transform("x", lambda r: r["id"]).alias(f"{p}id"), F.flatten(F.transform("x", lambda r: r["vec"])).cast("array<double>").alias(f"{p}v"))

    work = packed(queries, "q").join(packed(base, "b"), F.col("qg") == F.col("bg"))

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                q, b = (np.asarray(v, float).reshape(len(i), -1) for v, i in ((r.qv, r.qid), (r.bv, r.bid)))
                ids, s = np.asarray(r.bid), q @ b.T
                n = min(k, len(ids))
                out = []
                for row, qid in zip(s, r.qid, strict=True):
                    cutoff = np.partition(row, -n)[-n]
                    near = np.flatnonzero(row >= cutoff - 1e-9)
                    near = near[np.lexsort((ids[near], -row[near]))]
                    out.append(pd.DataFrame({"rec": qid, "s1": ids[near], "score": row[near]}))
                yield pd.concat(out)

    found = work.mapInPandas(run, "rec long, s1 long, score double")
    best = Window.partitionBy("rec").orderBy(F.desc(F.round("score", 9)), "s1")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def recall_at(cand: DataFrame, truth: DataFrame, ks: tuple[int, ...] = (1, 2, 3, 5, 10, 20)) -> DataFrame:
    """Share of records with a true entity (rec, s1; ``by`` for groups) whose best true one is within rank k."""
    hit = truth.join(cand, ["rec", "s1"], "left").groupBy("by", "rec").agg(F.min("rank").alias("r"))
    return hit.groupBy("by").agg(F.count("*").alias("n"), *(F.round(F.avg(F.when(F.col("r") <= k, 1.0).otherwise(0.0)), 6).alias(f"recall_{k}") for k in ks))
