"""Tab-separated sources, ground truth, and ID-list sinks (operators IO1-IO5, IO18-IO21, F2, F4, J1, U1)."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weftlink.functions.normalize import trim_all

SOURCE = ["entity_id", "business_name", "business_address", "country"]
TRUTH = ["source1_entity_id", "matched_entity_ids"]


def read_tsv(spark: SparkSession, path: str, expect: list[str], strict: bool = True, row_ix: bool = False) -> DataFrame:
    """IO1 / IO2: a tab-separated file with a header and no quoting, all text, never null.

    strict: rows with too many fields are repaired (of two columns the rest is joined by
    commas into the second; of more the surplus is joined by blanks into the last but
    one), rows with too few are filled with empty texts; blank lines are no rows. Not
    strict: rows with too many fields are dropped. Missing columns are an error.
    ``row_ix`` orders the rows as the files have them. The header is the first line of each
    file; later lines that look like it are data."""
    at = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n"))
    lines = spark.read.text(path).select("value", at.alias("row_ix"))
    heads = lines.where("row_ix.start = 0").groupBy("row_ix.path").agg(F.min_by("value", "row_ix").alias("value"), F.min("row_ix.n").alias("n"))
    heads = {r["path"]: (r["value"], r["n"]) for r in heads.collect()}
    first = heads[min(heads)] if heads else None
    head = [c.strip() for c in (first[0] if first else "").lstrip("﻿").rstrip("\r").split("\t")]
    if missing := [c for c in expect if c not in head]:
        raise ValueError(f"{path} lacks {missing}")
    n = len(head)
    raw = F.regexp_replace("value", r"\r$", "")
    place = F.struct(F.col("row_ix.path"), F.col("row_ix.start"), F.col("row_ix.n"))
    is_head = place.isin(*(F.struct(F.lit(p).alias("path"), F.lit(0).cast("long").alias("start"), F.lit(n).cast("long").alias("n")) for p, (_, n) in heads.items()))
    rows = lines.where(~is_head & (raw != ""))
    f = F.split(raw, "\t", -1)
    rows = rows.select("row_ix", f.alias("f")).withColumn("k", F.size("f"))
    if not strict:
        rows = rows.where(F.col("k") <= n)
    if n == 2:
        long = F.array(F.get("f", F.lit(0)), F.array_join(F.slice("f", F.lit(2), F.col("k")), ","))
    else:
        long = F.concat(F.slice("f", 1, n - 2), F.array(F.array_join(F.slice("f", F.lit(n - 1), F.col("k") - (n - 1)), " ")), F.slice("f", -1, 1))
    f = F.when(F.col("k") > n, long).otherwise(F.col("f"))
    rows = rows.select("row_ix", f.alias("f"))
    return rows.select(*(["row_ix"] if row_ix else []), *(trim_all(F.coalesce(F.get("f", F.lit(head.index(c))), F.lit(""))).alias(c) for c in expect))


def union_sources(tables: list[DataFrame]) -> DataFrame:
    """IO3, U1, F2: records of all sources with their number (1 is the clean one)."""
    tagged = [t.select("entity_id", F.col("business_name").alias("name"), F.col("business_address").alias("address"), "country", F.lit(k).cast("tinyint").alias("src"), *(["row_ix"] if "row_ix" in t.columns else [])) for k, t in enumerate(tables, 1)]
    return reduce(DataFrame.unionByName, tagged)


def is_s1() -> F.Column:
    """F4."""
    return F.col("src") == 1


def first_of(rows: DataFrame, key: str, order: list) -> DataFrame:
    """A3: the first row of each key, by the given order."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def explode_ids(rows: DataFrame, key: str, ids: str) -> DataFrame:
    """IO4, IO19: (key, id) of comma lists; trimmed, without empty ones, each once."""
    one = rows.select(F.col(key).alias("key"), F.explode(F.split(F.coalesce(F.col(ids), F.lit("")), ",")).alias("id"))
    return one.select("key", trim_all(F.col("id")).alias("id")).where("id <> ''").distinct()


def known_pairs(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (key, id) whose both ends are known ids (one column ``entity_id`` each)."""
    a, b = left.select(F.col("entity_id").alias("key")).distinct(), right.select(F.col("entity_id").alias("id")).distinct()
    return pairs.join(a, "key", "left_semi").join(b, "id", "left_semi")


def join_ids(pairs: DataFrame, key: str, value: str, order: list) -> DataFrame:
    """Ids of each key as one comma list in the given order."""
    s = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)), F.col(value).cast("string").alias("v"))
    return pairs.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(s)), lambda x: x["v"]), ",").alias("ids"))


def write_id_lists(keys: DataFrame, lists: DataFrame, key: str, path: str, name: str) -> None:
    """IO18: one row for each key, an empty list where there is none."""
    out = keys.join(lists, key, "left").select(key, F.coalesce("ids", F.lit("")).alias(name))
    out.orderBy(key).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def check_lists(matches: DataFrame, candidates: DataFrame, s1: DataFrame, records: DataFrame) -> dict[str, int]:
    """Faults of two ID-list tables (key, ids): keys missing, unknown or
    twice, unknown ids, ids twice in a list, and matches that are no candidates."""
    out = {}
    for name, t in (("matches", matches), ("candidates", candidates)):
        ids = t.select("key", F.explode(F.split("ids", ",")).alias("id")).where("id <> ''")
        out[f"{name}_missing"] = s1.join(t, s1.entity_id == t.key, "left_anti").count()
        out[f"{name}_unknown"] = t.join(s1, s1.entity_id == t.key, "left_anti").count()
        out[f"{name}_repeated"] = t.groupBy("key").count().where("count > 1").count()
        out[f"{name}_bad_ids"] = ids.join(records, records.entity_id == ids.id, "left_anti").count()
        out[f"{name}_twice"] = ids.groupBy("key", "id").count().where("count > 1").count()
    m, c = (t.select("key", F.explode(F.split("ids", ",")).alias("id")).where("id <> ''") for t in (matches, candidates))
    out["not_candidates"] = m.join(c, ["key", "id"], "left_anti").count()
    return out


def write_json(spark: SparkSession, path: str, value: dict, append: bool = False) -> None:
    """IO20: reports and the experiment log."""
    spark.createDataFrame([(json.dumps(value, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("append" if append else "overwrite").text(path)


def folds(entities: DataFrame, n: int, by: str | None = None, seed: int = 42) -> DataFrame:
    """IO21, J10: (entity_id, fold): hash order in ``n`` equal parts, or the values of ``by``
    (left-out-country folds). The same entities always get the same folds."""
    if by:
        return entities.select("entity_id", F.col(by).alias("fold"))
    return entities.select("entity_id", F.pmod(F.xxhash64("entity_id", F.lit(seed)), F.lit(n)).cast("int").alias("fold"))


def hash_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows by hash order, the same in each run."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def write_pairs(pairs: DataFrame, path: str) -> None:
    """IO9, IO10, W11: a pair table; an entity's pairs are together and in order, so readers
    skip files by ``i`` and no task splits an entity."""
    pairs.repartitionByRange("i").sortWithinPartitions("i", "j").write.mode("overwrite").parquet(path)


def read_pairs(spark: SparkSession, path: str, columns: list[str] | None = None, folds: list[int] | None = None, pruned: bool = False) -> DataFrame:
    """IO7, IO11, IO12: only the named columns, and only the rows of the folds and of the
    pruned set; both reach the scan."""
    d = spark.read.parquet(path)
    if folds is not None:
        d = d.where(F.col("fold").isin(folds))
    if pruned:
        d = d.where(F.col("in_pruned") == 1)
    return d.select(*columns) if columns else d


def require(spark: SparkSession, paths: list[str]) -> None:
    """IO24, X6: the inputs must exist; all that are missing are named at once."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    there = lambda p: (q := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(q)
    if missing := [p for p in paths if not there(p)]:
        raise FileNotFoundError(", ".join(missing))


def package(files: dict[str, bytes], out: str) -> None:
    """IO25: a zip of small result files, the same bytes for the same content."""
    import zipfile

    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(files):
            z.writestr(zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0)), files[name])
