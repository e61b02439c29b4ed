"""The whole linkage, from files to checked result lists (operators X7-X9, X12, IO3-IO6, ML4, ML5,
W4, F6, F18, A9). Every stage writes its table under the fingerprint of its settings and inputs."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.config import Config, fingerprint, inputs_key, stage
from weftlink.functions.exprs import logit, sigmoid
from weftlink.functions.normalize import country_key, normalized
from weftlink.functions.similarity import token_set_udf
from weftlink.sources import SOURCE, TRUTH, check_lists, explode_ids, first_of, folds, hash_sample, join_ids, known_pairs, read_tsv, union_sources, write_id_lists

from weftlink.staging import staged

from . import audit, blocking, context, decide, features, models


def records(spark: SparkSession, path: str) -> DataFrame:
    """IO3, IO5, A3, A4, N4, N16: normalized records of three sources; of one id the first in
    the order of sources and files."""
    u = union_sources([read_tsv(spark, f"{path}/source{k}.tsv", SOURCE, row_ix=True) for k in (1, 2, 3)])
    u = first_of(u, "entity_id", ["src", "row_ix"])
    keys = u.select("country").distinct().withColumn("cty", country_key(F.col("country")))
    u = u.join(keys, "country").select(F.col("entity_id").alias("id"), "name", "address", "src", "cty")
    # staged, as the frequencies read it once more each
    u = staged(normalized(u, "name", "address"), "normalized")
    one = F.col("src") == 1
    for name, key, when in (("f_name_s1", "n_core", one), ("f_name_r", "n_core", ~one), ("f_addr_s1", "a_norm", one)):
        u = audit.frequency(u, ["cty", key], when, name)
    return u


def truth(spark: SparkSession, path: str, recs: DataFrame | None = None, file: str = "truth.tsv") -> DataFrame:
    """IO4, J1: true pairs (i, j); with ``recs`` only those of known ids."""
    t = explode_ids(read_tsv(spark, f"{path}/{file}", TRUTH), *TRUTH)
    if recs is not None:
        ids = recs.select(F.col("id").alias("entity_id"), "src")
        t = known_pairs(t, ids.where("src = 1"), ids.where("src <> 1"))
    return t.select(F.col("key").alias("i"), F.col("id").alias("j"))


def entities(recs: DataFrame, pairs_truth: DataFrame) -> DataFrame:
    """IO6: (i, cty, n_true) of every clean record; n_true counts all true pairs."""
    n = pairs_truth.groupBy("i").agg(F.count("*").alias("n_true"))
    e = recs.where("src = 1").select(F.col("id").alias("i"), "cty").join(n, "i", "left")
    return e.withColumn("n_true", F.coalesce("n_true", F.lit(0)))


def candidates(recs: DataFrame, pairs_truth: DataFrame | None, cfg: Config) -> DataFrame:
    """Candidate pairs with all features; label 1 for true ones."""
    p = blocking.generate(recs, cfg.blocking)
    g = features.gather(p, recs, ["n_core", "a_norm"])
    p = g.select(*p.columns, token_set_udf(F.col("a.n_core"), F.col("b.n_core")).alias("tset_n_core"), token_set_udf(F.col("a.a_norm"), F.col("b.a_norm")).alias("tset_a_norm"))
    p = features.string_features(features.block_context(p), recs)
    if pairs_truth is None:
        return p
    return p.join(pairs_truth.withColumn("hit", F.lit(1)), ["i", "j"], "left").withColumn("label", F.coalesce("hit", F.lit(0))).drop("hit")


@dataclass(frozen=True)
class Split:
    """One split's tables: records, candidate pairs with features, and (None if unknown) the truth."""

    records: DataFrame
    pairs: DataFrame
    truth: DataFrame | None = None


def prepare(spark: SparkSession, path: str, work: str, cfg: Config, name: str, labelled: bool = True) -> Split:
    """X7, X10, IO16: a split's tables, made again only if its files or settings changed."""
    files = [f"{path}/source{k}.tsv" for k in (1, 2, 3)] + ([f"{path}/truth.tsv"] if labelled else [])
    key = f"{inputs_key(spark, files)}-{fingerprint(cfg, ('translit', 'blocking'))}"
    recs = stage(spark, work, f"{name}-records", key, lambda: records(spark, path))
    t = stage(spark, work, f"{name}-truth", key, lambda: truth(spark, path, recs)) if labelled else None
    return Split(recs, stage(spark, work, f"{name}-pairs", key, lambda: candidates(recs, t, cfg)), t)


def plan(train: Split, cfg: Config, run: str = "main") -> DataFrame:
    """F5, IO21, J10: (i, cty, n_true, sampled, fold) of the clean records: a sample by hash, and
    folds by hash or, in the run that leaves a country out, by country."""
    e = entities(train.records, train.truth)
    some = hash_sample(e, "i", cfg.sample_s1, cfg.seed).select("i", F.lit(True).alias("sampled"))
    f = folds(e.withColumnRenamed("i", "entity_id"), cfg.n_folds, "cty" if run == "loco" else None, cfg.seed)
    return e.join(some, "i", "left").join(f.withColumnRenamed("entity_id", "i"), "i").withColumn("sampled", F.coalesce("sampled", F.lit(False)))


def scored(pairs: DataFrame, test: DataFrame | None, who: DataFrame, feats: list[str], out: str, run: str = "main", **kw) -> tuple[DataFrame, DataFrame | None]:
    """ML2-ML4: the sample's pairs by models of the other folds; in the main run all other
    pairs, and the test's, by a model of the whole sample."""
    p = pairs.join(who.select("i", "sampled", "fold"), "i")
    own = p.where("sampled")
    train = models.out_of_fold(own, feats, "label", "fold", **kw)
    if run != "main":
        return train.withColumnRenamed("p", out).drop("sampled", "fold"), None
    full = models.fit(own, feats, **kw)
    train = train.unionByName(models.predict(full, p.where("not sampled"), feats)).withColumnRenamed("p", out)
    return train.drop("sampled", "fold"), None if test is None else models.predict(full, test, feats, out)


def second_context(pairs: DataFrame, recs: DataFrame, scores: dict[str, DataFrame] | None = None) -> DataFrame:
    """ML5, W3, W4, J9: pruned pairs (with p1) with the first score's and outside scores' logits,
    the competition of each, and the support of an entity's and a record's other pairs. Only
    narrow rows go through the windows and joins; the features stay aside until the end."""
    s = context.attach_scores(pairs.select("i", "j", "p1").withColumn("z_p1", logit(F.col("p1"))), scores or {}, "p1")
    names = ["z_p1", *(f"z_{n}" for n in scores or {}), *(["z_mean"] if len(scores or {}) > 1 else [])]
    for n in names:
        c = context.competition(s, n)
        s = c.drop("z").withColumnsRenamed({x: f"{x}_{n}" for x in c.columns if x.startswith("cx_") and x not in s.columns})
    rows = s.select("i", "j", sigmoid(F.col(names[-1])).alias("p"))
    rec = recs.select("id", "src", "n_core", "a_norm")
    for key, other, pre in (("i", "j", "nb"), ("j", "i", "cmp")):
        mine = rows.join(rec.withColumnRenamed("id", other), other)
        near = features.record_similarity(context.group_pairs(mine, key, other), "a", "b")
        got = context.support(near)
        got = got.select("i", "j", "nb_max_sim", "nb_support", "nb_support_x", "nb_support_sum") if pre == "nb" else got.select("i", "j", F.col("nb_max_sim").alias("cmp_max_sim"), "cmp_best_sim")
        s = s.join(got, ["i", "j"], "left").fillna(0.0, [c for c in got.columns if c not in ("i", "j")])
    return pairs.drop("p1").join(s, ["i", "j"])


def evaluation(who: DataFrame, cfg: Config, run: str, outside: bool) -> DataFrame:
    """whom the decision is tuned on: the sample if the run is not the main one or outside
    scores, which exist there only, were used; else all, or as many as the setting allows."""
    if run != "main" or outside:
        return who.where("sampled")
    return hash_sample(who, "i", cfg.decision.max_eval_s1, cfg.seed + 11)


def link(train: Split, test: Split | None, cfg: Config, run: str = "main", scores: dict[str, tuple[DataFrame, DataFrame]] | None = None, feats: list[str] | None = None, keep=lambda df, name: df, **kw) -> tuple[dict, DataFrame | None, DataFrame]:
    """First model, prune, second model, decision. (report, the test's pairs with p2, the
    train's). ``scores``: outside logits (train, test) by name. ``keep`` writes a table and
    reads it back; ``kw`` go to the models. Runs: main, loco (X7: a country left out at a
    time, on the sample only, nothing of the test)."""
    who = keep(plan(train, cfg, run), "plan")
    feats = feats or features.feature_list(train.pairs)
    p1, t1 = scored(train.pairs, test.pairs if test and run == "main" else None, who, feats, "p1", run, **kw)
    pruned = [keep(context.prune(d, "p1", cfg.prune.min_p, cfg.prune.rank_s1, cfg.prune.rank_rec), n) if d is not None else None for d, n in ((p1, "pruned"), (t1, "pruned-test"))]
    outside = scores or {}
    own = keep(second_context(pruned[0], train.records, {n: a for n, (a, _) in outside.items()}), "context")
    other = keep(second_context(pruned[1], test.records, {n: b for n, (_, b) in outside.items()}), "context-test") if pruned[1] is not None else None
    more = [*feats, *(c for c in own.columns if c.startswith(("z_", "cx_", "nb_", "cmp_", "ce_has_")))]
    p2, t2 = scored(own, other, who, more, "p2", run, **kw)
    p2 = keep(p2, "scored")
    ev = evaluation(who, cfg, run, bool(outside))
    d = cfg.decision
    numbered = ev.select("fold").distinct().orderBy("fold").collect()
    at = F.coalesce(*(F.when(F.col("fold") == r[0], F.lit(k)) for k, r in enumerate(numbered)))
    mine = p2.join(ev.select("i"), "i", "left_semi")
    tuned = decide.tune(decide.grid_scores(ev.withColumn("fold", at), mine, "p2", d.max_cands, d.excl_modes, d.policies)).orderBy(F.desc("f05"), "cfg").collect()
    best = tuned[0]["cfg"]
    per = keep(decide.per_entity(ev, chosen(mine, best, cfg)), "decided")
    pr = decide.per_entity(ev, pruned[0].join(ev.select("i"), "i", "left_semi")).agg(F.sum("tp"), F.sum("n_true"), F.sum("k"), F.count("*")).first()
    report = {"run": run, "best": best, "f05": tuned[0]["f05"], "crossfit_f05": tuned[0]["crossfit_f05"], "top": {r["cfg"]: r["f05"] for r in tuned}, "recall_pruned": round((pr[0] or 0) / max(1, pr[1] or 0), 5), "pairs_per_s1": round((pr[2] or 0) / max(1, pr[3]), 3)}
    report["by_country"] = {str(r["cty"]): {c: r[c] for c in r.asDict() if c != "cty"} for r in decide.breakdown(per, "cty").collect()}
    return report, keep(t2, "scored-test") if t2 is not None else None, p2


def chosen(pairs: DataFrame, setting: str, cfg: Config, p: str = "p2") -> DataFrame:
    """The pairs that a setting of the grid ("mode policy first second") takes."""
    mode, policy, first, second = setting.split(" ")
    return decide.select(context.exclusive(pairs, p, mode), "pe", policy, float(first), float(second), k=cfg.decision.max_cands).where("sel")


def submit(pairs: DataFrame, recs: DataFrame, setting: str, cfg: Config, out: str, p: str = "p2") -> dict[str, int]:
    """MX5, A27, IO18, J11: both result lists of every clean record, the likeliest ids first;
    the faults found in what was written."""
    spark = pairs.sparkSession
    keys = recs.where("src = 1").select(F.col("id").alias("source1_entity_id"))
    lists = {}
    for name, column, rows in (("matching_results", "matched_entity_ids", chosen(pairs, setting, cfg, p)), ("candidate_pairs", "candidate_entity_ids", pairs)):
        ids = join_ids(rows, "i", "j", [-F.col(p), F.col("j")]).withColumnRenamed("i", "source1_entity_id")
        write_id_lists(keys, ids, "source1_entity_id", f"{out}/{name}.tsv", column)
        lists[name] = read_tsv(spark, f"{out}/{name}.tsv", ["source1_entity_id", column]).toDF("key", "ids")
    s1 = recs.where("src = 1").select(F.col("id").alias("entity_id"))
    return check_lists(lists["matching_results"], lists["candidate_pairs"], s1, recs.where("src <> 1").select(F.col("id").alias("entity_id")))


def eda(train: Split, test: Split) -> dict:
    """The figures of an audit of both splits, each from one pass over its table."""
    r, t = train.records, train.truth
    e = entities(r, t)
    figures = e.agg(F.count("*").alias("n_s1_train"), F.round(F.avg((F.col("n_true") == 0).cast("int")), 5).alias("singleton_rate"), F.round(F.avg("n_true"), 3).alias("mean_matches_per_s1")).first().asDict()
    figures["match_count_hist"] = {int(x["bucket"]): x["n"] for x in audit.capped_histogram(e, "n_true").collect()}
    cols = ["src", "cty", "n_core", "a_postal"]
    g = features.gather(t, r, cols)
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    both = (a("a_postal") != "") & (b("a_postal") != "")
    rate = lambda c: F.round(F.avg(c.cast("int")), 5)
    figures |= g.agg(rate(a("cty") != b("cty")).alias("gt_pairs_cross_country_rate"), rate(a("n_core") == b("n_core")).alias("pos_exact_core_name_rate"), rate(both).alias("pos_postal_both_present_rate"), F.round(F.avg(F.when(both, (a("a_postal") == b("a_postal")).cast("int"))), 5).alias("pos_postal_equal_given_present"), *(F.count(F.when(b("src") == k, 1)).alias(f"matched_in_s{k}") for k in (2, 3))).first().asDict()
    per = t.groupBy("j").agg(F.count("*").alias("n"))
    figures["records_in_multiple_gt_lists"] = per.where("n > 1").count()
    others = r.where("src <> 1").join(per, F.col("id") == F.col("j"), "left")
    figures["unmatched_record_rate"] = others.agg(rate(F.col("n").isNull())).first()[0]
    figures["s1_share_with_duplicate_core_name"] = r.where("src = 1").agg(rate(F.col("f_name_s1") > 1)).first()[0]
    number = lambda c: F.regexp_extract(c, r"(\d+)$", 1).try_cast("double")
    figures["id_number_spearman_s1_vs_match"] = audit.spearman(t.select(number(F.col("i")).alias("x"), number(F.col("j")).alias("y")), "x", "y").first()["spearman"]
    sizes = {}
    for name, s in (("train", train), ("test", test)):
        by = s.records.groupBy("src", "cty").agg(F.count("*").alias("n")).collect()
        sizes[name] = sum(x["n"] for x in by)
        figures[f"{name}_sizes_by_src_country"] = {f"{x['src']} {x['cty']}": x["n"] for x in by}
        clean = {x["cty"]: x["n"] for x in by if x["src"] == 1}
        figures[f"{name}_country_share"] = {c: round(n / sum(clean.values()), 4) for c, n in sorted(clean.items())}
    figures["unseen_test_countries"] = sorted({k.split(" ", 1)[1] for k in figures["test_sizes_by_src_country"]} - {k.split(" ", 1)[1] for k in figures["train_sizes_by_src_country"]})
    figures["train_to_test_size_ratio"] = round(sizes["train"] / max(1, sizes["test"]), 3)
    advice = ((figures["records_in_multiple_gt_lists"] > 0, "records in several lists: exclusivity may not hold"), ((figures["gt_pairs_cross_country_rate"] or 0) > 0.01, "pairs across countries: block without them"), (abs(figures["id_number_spearman_s1_vs_match"] or 0) > 0.3, "ids correlate with matches: keep them out of the features"))
    figures["advice"] = [text for when, text in advice if when]
    return figures


def run(spark: SparkSession, train_path: str, test_path: str, work: str, out: str, cfg: Config | None = None, scores=None, loco: bool = False, feats: list[str] | None = None, **kw) -> dict:
    """Files to checked result lists; the report. ``scores(train, test)`` may give outside
    logits of the pruned pairs. ``loco`` adds the run that leaves a country out at a time."""
    cfg = cfg or Config()
    train, test = prepare(spark, train_path, work, cfg, "train"), prepare(spark, test_path, work, cfg, "test", labelled=False)
    key = f"{inputs_key(spark, [f'{p}/source{k}.tsv' for p in (train_path, test_path) for k in (1, 2, 3)] + [f'{train_path}/truth.tsv'])}-{fingerprint(cfg)}-{fingerprint(cfg, (), {'feats': feats, **kw})}"
    keep = lambda tag: lambda df, name: stage(spark, work, f"{tag}-{name}", key, lambda: df)
    report, pairs, _ = link(train, test, cfg, "main", scores(train, test) if scores else None, feats, keep("main"), **kw)
    report["submission_problems"] = {k: v for k, v in submit(pairs, test.records, report["best"], cfg, out).items() if v}
    report["eda"] = eda(train, test)
    if loco:
        report["loco"] = link(train, None, replace(cfg), "loco", None, feats, keep("loco"), **kw)[0]
    return json.loads(json.dumps(report, default=str))
