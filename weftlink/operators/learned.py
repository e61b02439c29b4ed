"""The variant with learned vectors (operators X11, ML6, C15, W5, F13, F17, IO22): an encoder gives
each record a vector; each record is matched with the clean records nearest to it."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftlink.functions.exprs import f_half, holdout
from weftlink.functions.normalize import record_text

from . import context, features, knn, models

#: Loads an encoder: from a list of texts to one vector each.
Encoder = Callable[[], Callable[[list[str]], Sequence[Sequence[float]]]]
FEATURES = "score rank gap_top1 margin12 s1_max gap_s1 s1_rank s1_n s1_n_top1 src name_tset name_ratio addr_tset addr_partial house_eq addr_empty".split()
#: The thresholds that are tried.
STEPS = [round(0.05 + 0.025 * k, 3) for k in range(37)]


def number(records: DataFrame, key: str = "id") -> DataFrame:
    """Records with ``rid``, an integer for each."""
    return records.withColumn("rid", F.xxhash64(key))


def embed(records: DataFrame, load: Encoder, path: str) -> DataFrame:
    """IO22, MX7: (rid, src, country, vec) in the order of the encoder's vectors, each of length one,
    written to ``path`` and read back. The encoder is loaded once a task."""
    text = record_text(F.col("name"), F.col("address"), F.col("country"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = load()
        for d in batches:
            v = np.asarray(encode(d["text"].tolist()), float).reshape(len(d), -1)
            yield d.drop(columns="text").assign(vec=list(v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)))

    rows = records.select("rid", F.col("src").cast("int").alias("src"), "country", text.alias("text"))
    rows.mapInPandas(run, "rid long, src int, country string, vec array<float>").write.mode("overwrite").parquet(path)
    return records.sparkSession.read.parquet(path)


def neighbours(vectors: DataFrame, k: int, path: str) -> DataFrame:
    """IO22, J16: (rec, s1, rank, score): each record's ``k`` nearest clean records of its country,
    written and read back."""
    v = vectors.select(F.col("rid").alias("id"), F.col("country").alias("group"), "vec", "src")
    knn.exact_knn(v.where("src = 1").drop("src"), v.where("src <> 1").drop("src"), k, "group").write.mode("overwrite").parquet(path)
    return vectors.sparkSession.read.parquet(path)


def owners(records: DataFrame, truth: DataFrame) -> DataFrame:
    """records with their ``owner`` (null: none), ``half`` and ``held``. Half and hold-out go
    by the owner, so a copy follows its business; a record that none owns goes by itself."""
    own = truth.select(F.xxhash64("i").alias("owner"), F.xxhash64("j").alias("r")).groupBy("r").agg(F.min("owner").alias("owner"))
    d = records.join(own, F.col("rid") == F.col("r"), "left").drop("r")
    key = F.coalesce("owner", "rid")
    # the hash of the hold-out is of an integer of 31 bits, so that no product overflows
    return d.select("*", F.pmod(F.xxhash64(key, F.lit(0)), F.lit(2)).cast("int").alias("half"), holdout(F.pmod(key, F.lit(1 << 31))).alias("held"))


def pair_features(cand: DataFrame, records: DataFrame, kept: int) -> DataFrame:
    """The 16 features of the ``kept`` nearest; the competition is among all that were found."""
    c = context.learned_competition(cand.where(F.col("rank") <= kept))
    src = records.select(F.col("rid").alias("rec"), F.col("src").cast("int").alias("src"))
    c = c.join(src, "rec").select("*", F.col("s1").alias("i"), F.col("rec").alias("j"))
    return features.learned_features(c, records.select(F.col("rid").alias("id"), "name", "address")).drop("i", "j")


def sweep(pairs: DataFrame, clean: DataFrame) -> DataFrame:
    """MX6, W6: (t, f05) of every threshold over the clean records (s1, n_true): each record's best
    pair counts from its p down."""
    best = Window.partitionBy("rec").orderBy(F.desc("p"), "s1")
    top = pairs.withColumn("__r", F.row_number().over(best)).where("__r = 1")
    steps = F.array(*map(F.lit, STEPS))
    n = top.select("s1", "label", F.explode(F.filter(steps, lambda t: F.col("p") >= t)).alias("t")).groupBy("t", "s1").agg(F.count("*").alias("k"), F.sum("label").alias("tp"))
    every = clean.select("s1", "n_true", F.explode(steps).alias("t")).join(n, ["t", "s1"], "left").fillna(0, ["k", "tp"])
    return every.groupBy("t").agg(F.avg(f_half(F.col("n_true"), F.col("k"), F.col("tp"))).alias("f05"))


def fit(records: DataFrame, truth: DataFrame, cand: DataFrame, path: str, kept: int = 5, **kw) -> dict:
    """ML6, IO23: the decision model, learned on half B (the encoder has the other half) without its
    hold-out, which picks the threshold; written to ``path``. Its figures."""
    own = owners(records, truth)
    d = pair_features(cand, records, kept).join(own.select(F.col("rid").alias("rec"), "owner", "half", "held"), "rec").where("half = 1")
    d = d.withColumn("label", F.coalesce((F.col("owner") == F.col("s1")).cast("int"), F.lit(0)))
    model = models.fit(d.where("not held"), FEATURES, stop="s1", **kw)
    held = models.predict(model, d.where("held"), FEATURES)
    n = own.where("owner is not null").groupBy(F.col("owner").alias("oid")).agg(F.count("*").alias("n_true"))
    clean = own.where("src = 1 and half = 1 and held").join(n, F.col("rid") == F.col("oid"), "left").select(F.col("rid").alias("s1"), F.coalesce("n_true", F.lit(0)).alias("n_true"))
    best = sweep(held, clean).orderBy(F.desc(F.round("f05", 9)), "t").first()
    found = {"threshold": best["t"] if best else 0.5, "f05": best["f05"] if best else None, "importances": models.importances(model, FEATURES)}
    models.save(model, FEATURES, path, **found)
    return found


def predict(records: DataFrame, cand: DataFrame, path: str, kept: int = 5) -> tuple[DataFrame, DataFrame]:
    """(pairs with p, those taken): each record's best pair, if it reaches the model's threshold; i and j
    are the records' ids."""
    model, meta = models.load(path)
    d = models.predict(model, pair_features(cand, records, kept), meta["features"]).select(F.col("s1").alias("a"), F.col("rec").alias("b"), "p")
    ids = records.select("rid", "id")
    d = d.join(ids.select(F.col("rid").alias("a"), F.col("id").alias("i")), "a").join(ids.select(F.col("rid").alias("b"), F.col("id").alias("j")), "b").select("i", "j", "p")
    return d, context.assign(d, "p", meta["threshold"])


def hashed_encoder(dim: int = 256) -> Encoder:
    """An encoder that needs no training: signed counts of hashed letter trigrams."""

    def load():
        import zlib

        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim))
            for row, t in zip(out, texts, strict=True):
                t = f"  {t.lower()} "
                for k in range(len(t) - 2):
                    h = zlib.crc32(t[k : k + 3].encode())
                    row[h % dim] += 1 if h >> 31 else -1
            return out

        return encode

    return load


def run(spark: SparkSession, train: tuple[DataFrame, DataFrame], test: DataFrame, work: str, load: Encoder, k: int = 20, kept: int = 5, **kw) -> tuple[dict, DataFrame, DataFrame]:
    """X11: (figures, the test's pairs with p, those taken); train: records (id, src, name, address,
    country) and true pairs (i, j)."""
    tables = {}
    for name, recs in (("train", train[0]), ("test", test)):
        r = number(recs)
        tables[name] = r, neighbours(embed(r, load, f"{work}/{name}-vectors"), k, f"{work}/{name}-neighbours")
    found = fit(tables["train"][0], train[1], tables["train"][1], f"{work}/decision", kept, **kw)
    return found, *predict(*tables["test"], f"{work}/decision", kept)
