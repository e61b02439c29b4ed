"""Input and output of outside pair scorers (operators IO13-IO15, IO17, J14, O4, T2, ML9, X13)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftlink.functions import exprs as E
from weftlink.functions.normalize import record_text

from .context import competitor_negatives

#: Loads a scorer: from two lists of texts to one logit a pair.
Loader = Callable[[], Callable[[list[str], list[str]], Sequence[float]]]


def training_pairs(pairs: DataFrame, sampled: DataFrame, p: str = "p1", first: int = 10, rivals: int = 1) -> DataFrame:
    """IO15: what a scorer learns from, of (i, j, p, pruned, ...): the sampled entities' pairs
    that were kept by pruning or are among the ``first`` likeliest, and of each of their
    records the ``rivals`` likeliest pairs with entities outside the sample. The latter are
    marked (``in_pruned`` and ``lw_ok`` 0), as they are never scored out of fold. Scores
    that are not finite come last, and no rival has one."""
    v = E.finite(F.col(p), -1.0)
    rank = F.row_number().over(Window.partitionBy("i").orderBy(v.desc(), "j"))
    own = pairs.withColumn("__r", rank).join(sampled.select("i").distinct(), "i", "left_semi")
    own = own.where(F.col("pruned") | (F.col("__r") <= first)).drop("__r")
    flags = lambda df, pruned, ok: df.withColumn("in_pruned", pruned.cast("tinyint")).withColumn("lw_ok", F.lit(ok).cast("tinyint"))
    out = flags(own, F.coalesce("pruned", F.lit(False)), 1)
    if rivals:
        sure = pairs.where(v == F.col(p))
        out = out.unionByName(flags(competitor_negatives(own, sure, sampled, p, rivals), F.lit(0), 0))
    return out.drop("pruned")


def scoring_pairs(pairs: DataFrame, shards: int) -> DataFrame:
    """IO15: the pruned pairs, each with the one model (``shard``) that scores its entity."""
    return pairs.where("pruned").drop("pruned").withColumn("shard", F.floor(E.hash01(F.col("i")) * shards) % shards)


def with_texts(pairs: DataFrame, left: DataFrame, right: DataFrame | None = None) -> DataFrame:
    """IO14: pairs with both records' texts; records: (id, name, address, country)."""
    text = record_text(F.col("name"), F.col("address"), F.col("country"))
    a = left.select(F.col("id").alias("i"), text.alias("text_a"))
    b = (left if right is None else right).select(F.col("id").alias("j"), text.alias("text_b"))
    return pairs.join(a, "i").join(b, "j").select(*pairs.columns, "text_a", "text_b")


def in_batches(scorer, a: list[str], b: list[str], size: int) -> np.ndarray:
    """O4, ML9, X13: logits of pairs, scored in batches of like length (characters of both
    texts), the longest first. A batch that memory does not hold is halved; logits that
    are not finite become 0."""
    order = np.argsort([-len(x) - len(y) for x, y in zip(a, b, strict=True)], kind="stable").tolist()
    out = np.zeros(len(a))
    at = 0
    while at < len(order):
        part = order[at : at + size]
        try:
            out[part] = np.asarray(scorer([a[k] for k in part], [b[k] for k in part]), float)
        except MemoryError:
            if size == 1:
                raise
            size //= 2
            continue
        at += len(part)
    return np.where(np.isfinite(out), out, 0.0)


def score(pairs: DataFrame, load: Loader, size: int = 256, gate: tuple = (None, None), shards: list[int] | None = None, p: str = "p1", carry: tuple[str, ...] = ()) -> DataFrame:
    """IO13: (i, j, z, carried...) of the pairs with texts that are in the shards and inside
    the gate. The scorer is loaded once a task; a task holds one Arrow batch at a time."""
    todo = pairs.where(E.gate(F.col(p), *gate))
    if shards is not None:
        todo = todo.where(F.col("shard").isin(shards))
    todo = todo.select("i", "j", *carry, "text_a", "text_b")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for d in parts:
            scorer = scorer or load()
            yield d.drop(columns=["text_a", "text_b"]).assign(z=in_batches(scorer, d["text_a"].fillna("").tolist(), d["text_b"].fillna("").tolist(), size))

    return todo.mapInPandas(run, todo.drop("text_a", "text_b").withColumn("z", F.lit(0.0)).schema)


def merge_scores(parts: dict[int, DataFrame | None]) -> DataFrame:
    """IO17: all models' scores as one table; a model without scores is an error."""
    if missing := sorted(k for k, d in parts.items() if d is None) or ([] if parts else ["all"]):
        raise RuntimeError(f"no scores of model {missing}")
    return reduce(DataFrame.unionByName, parts.values())


def attach_features(pairs: DataFrame, feats: DataFrame) -> DataFrame:
    """Pairs with their features by (i, j); a pair without, or with several rows of
    them, is an error, found by counting once."""
    n = feats.groupBy("i", "j").agg(F.count("*").alias("__n"))
    bad = pairs.select("i", "j").join(n, ["i", "j"], "left").where(F.coalesce("__n", F.lit(0)) != 1)
    if bad.limit(1).count():
        raise RuntimeError("features do not cover the pairs, each once")
    return pairs.join(feats, ["i", "j"])


def hashed(token, bits: int = 24) -> F.Column:
    """A token's bucket."""
    return F.pmod(F.xxhash64(token), F.lit(1 << bits))
