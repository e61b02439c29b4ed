"""Golden values by hand, operators against their definitions, and a whole linkage."""

import itertools
import math
import time

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weftlink import config, plans, sources
from weftlink.functions import normalize as N
from weftlink.functions import similarity as S
from weftlink.operators import audit, blocking, context, decide, features, learned, linking, models, rerank
from weftlink.sources import synthetic

SF = "/root/testdata/sf0.001"


def normalized(spark, name, address):
    return N.normalized(spark.createDataFrame([(name, address, 1)], "name string, address string, n_full int"), "name", "address").first().asDict()


def test_normalized_record(spark):
    r = normalized(spark, "Shree Ganesh Traders Pvt Ltd", "12 MG Road, Near SBI ATM, Pune 411001")
    want = {"n_full": "sri ganesh traders pvt ltd", "n_core": "sri ganesh traders", "n_legal": "pvtltd", "n_skel": "sr gns trdrs", "n_skel2": "sr kns trtrs", "n_dba": "", "a_norm": "12 mg rd nr sbi atm pune 411001", "a_words": "mg rd nr sbi atm pune", "a_postal": "411001", "a_nums": "12", "a_house": "12", "a_tail": "nr sbi atm pune 411001", "a_landmark": "sbi atm"}
    assert {k: r[k] for k in want} == want
    r = normalized(spark, None, None)
    assert {r[k] for k in N.FIELDS} == {""} and r["name"] is None
    assert normalized(spark, "The Of", "")["n_core"] == "of" and normalized(spark, "Ltd", "")["n_core"] == ""
    r = normalized(spark, "Acme Co d/b/a O'Brien's M G Stores LLC", "3rd Main, opp. श्री गणेश; 560 001 New Delhi")
    assert (r["n_dba"], r["n_legal"], r["n_acr"]) == ("acme|o briens mg stores", "llc", "aobms")
    assert (r["a_postal"], r["a_house"], r["a_landmark"], r["a_tail"]) == ("560001", "3", "shri ganesha", "opp shri ganesha 560001 dl")


@pytest.mark.parametrize(("given_", "want"), [("श्री", "shri"), ("गणेश", "ganesha"), ("abc", "abc"), ("१२", "12")])
def test_romanize(given_, want):
    assert N.romanize(given_) == want


def test_small_functions(spark):
    def of(column, *values):
        d = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, c string")
        return [r[1] for r in d.select("k", column(F.col("c"))).orderBy("k").collect()]

    assert of(N.merged, "m g rd", "a", "a b c de f g") == ["mg rd", "a", "abc de fg"]
    assert of(N.postal_code, "a 411 001 b 411 002", "springfield il 62701-1234", "1234567") == ["411002", "62701", ""]
    assert of(N.names, "Acme formerly known as Zed", "", "dba", None) == [["Acme", "known as Zed"], [""], ["dba"], [""]]
    assert of(N.country_key, " U.S.A. ", "", None, "Zed Land", "भारत") == ["us", "unk", "unk", "zed land", "bharata"]
    forms = lambda c: F.struct(*N.without_forms(N.tokens(c)))
    assert [tuple(x) for x in of(forms, "the acme co & ltd", "the the", "acme &", "inc acme income")] == [(["acme"], ["co", "ltd"]), ([], []), (["acme", "&"], []), (["inc", "acme", "income"], [])]
    assert of(N.basic, "Caf\u00e9 d'Or & Fils_1", "\uff21\uff22  x\u00b2") == ["cafe d or & fils 1", "ab x2"]


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, j in itertools.product(range(len(a)), range(len(b))):
        t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.text("abc ", max_size=12), st.text("abc ", max_size=12))
def test_similarity_properties(a, b):
    assert S.lcs(a, b) == brute_lcs(a, b)
    for f in (S.ratio, S.token_set_ratio, S.token_sort_ratio, S.partial_ratio, S.weighted_ratio):
        assert 0 <= f(a, b) <= 100 and math.isclose(f(a, b), f(b, a))
    if a.split():
        assert S.ratio(a, a) == S.token_set_ratio(a, a) == S.partial_ratio(a, a) == 100
    assert S.jaro_winkler(a, b) == S.jaro_winkler(b, a) or abs(S.jaro_winkler(a, b) - S.jaro_winkler(b, a)) < 0.35


def test_similarity_of_many_pairs():
    r = np.random.default_rng(0)
    word = lambda: "".join(r.choice(list("abcé😀"), r.integers(0, 7)))
    text = lambda: " ".join(word() for _ in range(r.integers(0, 1 + r.choice([2, 5, 30]))))
    a, b = [text() for _ in range(700)] + ["", "a", "", "x" * 64, "x" * 65, "ab " * 40], [text() for _ in range(700)] + ["", "", "b", "x" * 70, "y" + "x" * 80, "ba " * 50]
    b[:50] = [x[::-1] for x in a[:50]]
    for many, one in ((S.lcs_many, S.lcs), (S.ratio_many, S.ratio), (S.token_sort_many, S.token_sort_ratio), (S.token_set_many, S.token_set_ratio), (S.partial_many, S.partial_ratio), (S.weighted_many, S.weighted_ratio)):
        want = [one(x, y) for x, y in zip(a, b, strict=True)]
        bad = [(x, y, w, g) for x, y, w, g in zip(a, b, want, many(a, b), strict=True) if abs(w - g) > 1e-9]
        assert not bad, (one.__name__, bad[:3])
    names = lambda x: [t.replace(" ", "|", 1) if k % 3 else "" for k, t in enumerate(x)]
    want = [S.dba_best(*row) for row in zip(names(a), a, names(b[::-1]), b, strict=True)]
    got = S.dba_many(names(a), a, names(b[::-1]), b)
    assert all(w is None and math.isnan(g) or w is not None and abs(w - g) < 1e-9 for w, g in zip(want, got, strict=True))


def test_similarity_goldens():
    assert math.isclose(S.ratio("kitten", "sitting"), 200 * 4 / 13)
    assert S.token_set_ratio("a b", "c a b") == 100 and S.token_set_ratio("", "a") == 0
    assert S.partial_ratio("abc", "xxabcxx") == 100 and S.token_sort_ratio("b a", "a b") == 100
    assert math.isclose(S.jaro_winkler("martha", "marhta"), 0.9611111111)
    assert S.dba_best("", "a", "", "b") is None and S.dba_best("a|b", "a b", "", "b") == 100


def test_tsv_repair(spark, tmp_path):
    p = tmp_path / "s.tsv"
    p.write_text("﻿entity_id\tbusiness_name\tbusiness_address\tcountry\nid\tn\ta\tb\tUS\n\nx\ty\n q \t\"z\t\tfr\r\n", encoding="utf-8")
    got = {tuple(r) for r in sources.read_tsv(spark, str(p), sources.SOURCE).collect()}
    assert got == {("id", "n", "a b", "US"), ("x", "y", "", ""), ("q", '"z', "", "fr")}
    assert sources.read_tsv(spark, str(p), sources.SOURCE, strict=False).count() == 2
    q = tmp_path / "t.tsv"
    q.write_text("source1_entity_id\tmatched_entity_ids\ns1\tx\ty\ns2\t\n")
    t = sources.read_tsv(spark, str(q), sources.TRUTH)
    assert {tuple(r) for r in t.collect()} == {("s1", "x,y"), ("s2", "")}
    assert {tuple(r) for r in sources.explode_ids(t, *sources.TRUTH).collect()} == {("s1", "x"), ("s1", "y")}
    with pytest.raises(ValueError):
        sources.read_tsv(spark, str(q), sources.SOURCE)


def test_id_lists_round_trip(spark, tmp_path):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    sources.write_id_lists(keys, spark.createDataFrame([("b", "x,y")], "k string, ids string"), "k", str(tmp_path / "o"), "m")
    got = sources.read_tsv(spark, str(tmp_path / "o"), ["k", "m"])
    assert {tuple(r) for r in got.collect()} == {("a", ""), ("b", "x,y")}


def test_group_context_golden(spark):
    df = spark.createDataFrame([("a", 0.9, 1), ("a", 0.5, 2), ("a", 0.9, 3), ("b", 0.3, 4)], "k string, v double, id int")
    got = {r["id"]: (r["rank"], round(r["gap"], 6), round(r["m2"], 6), r["size"]) for r in context.group_context(df, "k", "v", ["id"]).collect()}
    assert got == {1: (1, 0, 0, 3), 2: (3, -0.4, -0.4, 3), 3: (2, 0, 0, 3), 4: (1, 0, 1.3, 1)}


def test_prune_takes_nan_last(spark):
    df = spark.createDataFrame([(1, 1, float("nan")), (1, 2, 0.5), (1, 3, 0.001), (2, 1, 0.4)], "i int, j int, p double")
    assert {(r["i"], r["j"]) for r in context.prune(df, "p").collect()} == {(1, 2), (2, 1)}
    assert {(r["i"], r["j"]) for r in context.prune(df, "p", rank_s1=1, min_p=0).collect()} == {(1, 2), (2, 1)}


def test_exclusive_golden(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (2, 1, 0.5)], "i int, j int, p double")
    assert [round(r["pe"], 6) for r in context.exclusive(df, "p", "softmax").collect()] == [0.333333, 0.333333]
    assert sorted(r["pe"] for r in context.exclusive(df, "p", "hard").collect()) == [0, 0.5]


def test_expected_f_against_enumeration():
    assert np.allclose(decide.expected_f(np.array([0.9, 0.5])), [0.05, 0.825, 0.7277777777])
    q = np.array([0.8, 0.6, 0.3, 0.2])
    for k in range(5):
        total = 0.0
        for t in itertools.product([0, 1], repeat=4):
            pr = np.prod([x if y else 1 - x for x, y in zip(q, t, strict=True)])
            n, tp = sum(t), sum(t[:k])
            f = (1.0 if n == 0 else 0.0) if k == 0 else (1.25 * tp / (0.25 * n + k) if tp else 0.0)
            total += pr * f
        assert math.isclose(decide.expected_f(q)[k], total)
    assert decide.best_size(np.array([0.9, 0.5])) == 1 and len(decide.grid()) == 200


def test_expected_f_takes_more_than_twelve_and_the_least_of_ties(spark):
    p = spark.createDataFrame([(1, j, 0.99) for j in range(15)], "i int, j int, p double")
    got = decide.select(p, "p", "expected_f", 1.0, 0.0).groupBy("i").agg(F.sum(F.col("sel").cast("int")).alias("k")).collect()
    assert [(r["i"], r["k"]) for r in got] == [(1, 15)]
    r = np.random.default_rng(5)
    for n in (0, 1, 4, 14):
        q = -np.sort(-np.round(r.random((40, n)), 2), axis=1)
        assert np.allclose(decide.expected_f_many(q), [decide.expected_f(x) for x in q])
        want = [int(np.round(decide.expected_f(np.clip(x, 1e-6, 1 - 1e-6)), 12).argmax()) for x in np.where(q > 0, q, 0.5)]
        assert decide.best_sizes(np.where(q > 0, q, 0.5)).tolist() == want
    # f(0) = 1 - q and f(1) = q are equal at one half, whatever the last bit says
    half = np.array([[0.5], [np.nextafter(0.5, 1)], [np.nextafter(0.5, 0)]])
    assert decide.best_sizes(half).tolist() == [0, 0, 0]


def test_policy_grid_is_scored_for_many_entities_at_once():
    began = time.process_time()
    q = -np.sort(-np.random.default_rng(6).random((20000, 5)), axis=1)
    for _, a, b in (s for s in decide.grid() if s[0] == "expected_f"):
        decide.best_sizes(q, a, b)
    # one by one these 500,000 take over 40 s
    assert time.process_time() - began < 20


def test_grid_scores_equal_select(spark):
    r = np.random.default_rng(3)
    p = spark.createDataFrame([(i, j, float(r.integers(1, 20)) / 20, int(r.integers(0, 2))) for i in range(9) for j in range(14) if r.random() < 0.6], "i int, j int, p double, label int")
    e = spark.createDataFrame([(i, i % 4, i % 2) for i in range(11)], "i int, n_true int, fold int")
    got = {x["cfg"]: x["f"] for x in decide.grid_scores(e, p, "p").groupBy("cfg").agg(F.sum("f").alias("f")).collect()}
    assert len(got) == 800
    for mode, s in itertools.product(("none", "softmax_hard"), (("threshold", 0.5, 0.0), ("two_threshold", 0.6, 0.4), ("expected_f", 0.85, -0.5))):
        chosen = decide.select(context.exclusive(p, "p", mode), "pe", *s).where("sel")
        want = decide.per_entity(e, chosen).agg(F.sum("f05")).first()[0]
        assert math.isclose(got[" ".join(map(str, (mode, *s)))], want)


def test_blocking_goldens(spark):
    t = spark.createDataFrame([("g", "name", "w", "a" if k < 2 else "b", k) for k in range(4)], "grp string, view string, tok string, side string, id int")
    s = blocking.idf(t, spark.createDataFrame([("g", 10)], "grp string, n int"), 4).first()
    assert (s["df_a"], s["df_b"], s["df"], s["alive"]) == (2, 2, 4, True) and round(s["idf"], 6) == 1.788457
    r = spark.createDataFrame([(1, "us"), (2, "in"), (3, "unk")], "id int, cty string")
    assert {(x["id"], x["grp"]) for x in blocking.with_groups(r).collect()} == {(1, "us"), (2, "in"), (3, "us"), (3, "in")}
    assert [x["grp"] for x in blocking.with_groups(r.where("id = 3")).collect()] == ["unk"]
    rec = spark.createDataFrame([(1, "royal bakery", "ryl bkr", "ryl pkr", "12 mg rd", "mg rd", "411001", "12")], "id int, n_core string, n_skel string, n_skel2 string, a_norm string, a_words string, a_postal string, a_house string")
    got = {(x["view"], x["tok"]) for x in blocking.token_views(rec, ["id"]).collect()}
    assert got == {("name", x) for x in ("nroyal", "proya", "nbakery", "pbake", "kryl", "kbkr", "vryl", "vpkr")} | {("addr", x) for x in ("amg", "ard", "z411001", "h12|mg")} | {("mix", x) for x in ("xroyal|411", "yroyal|mg", "yroyal|rd")}


def test_group_pairs_leave_out_large_groups(spark):
    df = spark.createDataFrame([(n, k) for n in (1, 2, 12, 13) for k in range(n)], "k int, id int")
    got = context.group_pairs(df, "k", "id").groupBy("a.k").count().collect()
    assert {r["k"]: r["count"] for r in got} == {2: 2, 12: 132}


def test_mined_abbreviations(spark):
    df = spark.createDataFrame([("acme mfg", "acme manufacturing")] * 5 + [("a.c (x", "b")], "a string, b string")
    assert [tuple(r) for r in audit.mine_abbreviations(df, "a", "b").collect()] == [("mfg", "manufacturing", 5)]


def test_config(spark, tmp_path):
    c = config.load(sets=("blocking.max_df=500", "prune.min_p=1e-3", "blocking.k_s1.full=9"))
    assert (c.blocking.max_df, c.prune.min_p, c.blocking.k_s1["full"]) == (500, 0.001, 9)
    assert config.fingerprint(c) != config.fingerprint(config.Config()) and config.fingerprint(c, ("decision",)) == config.fingerprint(config.Config(), ("decision",))
    with pytest.raises(KeyError):
        config.load(sets=("nothing=1",))
    made = []
    make = lambda: made.append(1) or spark.range(3)
    for _ in range(2):
        assert config.stage(spark, str(tmp_path), "s", "k", make).count() == 3
    assert len(made) == 1
    plan = config.model_plan(4, 2)
    assert sorted(f for m in plan for f in m["score"]) == [0, 1, 2, 3] and all(not set(m["train"]) & set(m["score"]) for m in plan)


FEATS = ["bs_full", "bs_name", "bs_addr", "ratio_n_core", "tset_a_norm", "postal_tri", "house_tri"]


def test_whole_linkage(spark, tmp_path):
    synthetic.generate(str(tmp_path / "train"), n=100, seed=0)
    synthetic.generate(str(tmp_path / "test"), n=60, seed=1, countries=("us", "fr"))
    work, out = str(tmp_path / "work"), str(tmp_path / "out")
    cfg = config.override(config.Config(), {"sample_s1": 50, "n_folds": 2, "decision.policies": ["threshold"], "decision.excl_modes": ["none", "hard"]})

    def outside(train, test):
        """A stand-in for a trained scorer: a logit of two scores, for some pairs only."""
        z = lambda s: s.pairs.where("bs_full > 0.2").select("i", "j", (F.col("bs_full") * 4 + F.col("ratio_n_core") / 25 - 4).alias("z"))
        return z(train), z(test)

    train, test = (linking.prepare(spark, str(tmp_path / n), work, cfg, n, labelled=n == "train") for n in ("train", "test"))
    assert len(features.feature_list(train.pairs)) >= 90
    assert train.pairs.where("label = 1").count() / train.truth.count() > 0.9
    # the pruned sets are not known before the first model, so the outside scores are of them
    keep = {}

    def kept(df, name):
        path = f"{work}/t-{name}"
        df.write.mode("overwrite").parquet(path)
        keep[name] = spark.read.parquet(path)
        return keep[name]

    report, pairs, scored = linking.link(train, test, cfg, "main", None, FEATS, kept, rounds=4, depth=3)
    assert report["crossfit_f05"] > 0.7 and report["recall_pruned"] > 0.85 and len(report["top"]) == 10
    assert scored.count() == keep["pruned"].count() and scored.where("p2 is null").count() == 0
    cx = keep["context"]
    assert {"nb_support", "cmp_best_sim", "cx_j_share_z_p1"} <= set(cx.columns) and cx.where("nb_support > 0").count() > 10
    faults = linking.submit(pairs, test.records, report["best"], cfg, out)
    assert not any(faults.values())
    lists = sources.read_tsv(spark, f"{out}/matching_results.tsv", ["source1_entity_id", "matched_entity_ids"])
    assert lists.count() == test.records.where("src = 1").count()
    hidden = linking.truth(spark, str(tmp_path / "test"), test.records)
    hits = sources.explode_ids(lists, *lists.columns).join(hidden, [F.col("key") == F.col("i"), F.col("id") == F.col("j")], "left_semi").count()
    assert hits / hidden.count() > 0.6
    figures = linking.eda(train, test)
    assert figures["unseen_test_countries"] == ["france"] and figures["n_s1_train"] == train.records.where("src = 1").count() and len(figures) >= 18
    assert figures["matched_in_s2"] + figures["matched_in_s3"] == train.truth.count()
    # second context with outside scores, and a stage that is not made again
    z = keep["pruned"].where("p1 > 0.1").select("i", "j", F.lit(1.0).alias("z"))
    two = linking.second_context(keep["pruned"], train.records, {"a": z, "b": z})
    assert {"z_mean", "ce_has_a", "cx_i_rank_z_mean"} <= set(two.columns) and two.count() == keep["pruned"].count()
    made = train.records.inputFiles()
    assert linking.prepare(spark, str(tmp_path / "train"), work, cfg, "train").records.inputFiles() == made
    (tmp_path / "train" / "source2.tsv").open("a").write("S2-0\tx\ty\tus\n")
    assert linking.prepare(spark, str(tmp_path / "train"), work, cfg, "train").records.inputFiles() != made


def test_learned_variant(spark, tmp_path):
    synthetic.generate(str(tmp_path / "a"), n=150, seed=0)
    recs = linking.records(spark, str(tmp_path / "a")).select("id", "src", "name", "address", F.col("cty").alias("country"))
    recs.write.parquet(str(tmp_path / "recs"))
    recs, t = spark.read.parquet(str(tmp_path / "recs")), linking.truth(spark, str(tmp_path / "a"))
    found, pairs, taken = learned.run(spark, (recs, t), recs, str(tmp_path / "w"), learned.hashed_encoder(), k=8, kept=3, rounds=4, depth=3)
    assert set(found["importances"]) == set(learned.FEATURES) and found["threshold"] in learned.STEPS
    hits = taken.join(t, ["i", "j"], "left_semi").count()
    assert hits / taken.count() > 0.7 and hits / t.count() > 0.5 and pairs.groupBy("j").count().where("count > 3").count() == 0
    own = learned.owners(learned.number(recs), t)
    ends = own.alias("r").join(own.alias("o"), F.col("r.owner") == F.col("o.rid"))
    assert ends.count() > 100 and ends.where("r.half <> o.half or r.held <> o.held").count() == 0
    model, meta = models.load(str(tmp_path / "w" / "decision"))
    assert meta["features"] == learned.FEATURES and meta["threshold"] == found["threshold"]


def test_samples_and_folds_cover_and_repeat(spark):
    e = spark.range(500).select(F.concat(F.lit("S1-"), "id").alias("entity_id"), (F.col("id") % 3).alias("cty"))
    a, b = (sources.folds(x, 4).collect() for x in (e, e.repartition(7)))
    assert sorted(a) == sorted(b) and len(a) == 500 and {r["fold"] for r in a} == {0, 1, 2, 3}
    assert {(r["entity_id"], r["fold"]) for r in sources.folds(e, 4, "cty").collect()} == {(f"S1-{k}", k % 3) for k in range(500)}
    s, t = (sorted(sources.hash_sample(x, "entity_id", 50).collect()) for x in (e, e.repartition(7)))
    assert s == t and len(s) == 50 and sources.hash_sample(e, "entity_id", 1000).count() == 500


def test_one_model_of_one_class_is_an_error(spark):
    d = spark.createDataFrame([(k, 0, float(k)) for k in range(10)], "i long, label int, x double")
    with pytest.raises(RuntimeError):
        models.fit(d, ["x"])
    assert {r["p"] for r in models.out_of_fold(d.withColumn("fold", F.col("i") % 2), ["x"]).collect()} == {0.0}


def test_budget_cut_equals_its_definition(spark):
    r = np.random.default_rng(4)
    stats = [("g", "name", f"t{k}", int(a), int(b), int(a + b), 1.0, bool(r.random() < 0.9)) for k, (a, b) in enumerate(r.integers(0, 6, (200, 2)))]
    df = spark.createDataFrame(stats, "grp string, view string, tok string, df_a long, df_b long, df long, idf double, alive boolean")
    live = sorted((s for s in stats if s[7]), key=lambda s: (-s[5], s[2]))
    total = sum(s[3] * s[4] for s in live)
    for budget in (0, 1, 137, 500, total - 1, total, 10**9):
        before, want = 0, {}
        for s in live:
            want[s[2]] = not (total > budget and before < total - budget)
            before += s[3] * s[4]
        assert {x["tok"]: x["alive"] for x in blocking.budget_cut(df, budget).collect()} == want


def test_lists_faults_and_file_order(spark, tmp_path):
    p = tmp_path / "t.tsv"
    p.write_text("entity_id\tv\n" + "".join(f"{k % 40}\t{k}\n" for k in range(200)) + "entity_id\tv\n")
    d = sources.read_tsv(spark, str(p), ["entity_id", "v"], row_ix=True)
    got = sources.first_of(d.repartition(5), "entity_id", ["row_ix"]).collect()
    assert {r["entity_id"]: r["v"] for r in got} == {str(k): str(k) for k in range(40)} | {"entity_id": "v"}
    one = lambda *rows: spark.createDataFrame(list(rows), "key string, ids string")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "entity_id string")
    f = sources.check_lists(one(("a", "x,x,z"), ("a", ""), ("q", "y")), one(("a", "x"), ("b", "")), ids("a", "b"), ids("x", "y"))
    assert f == {"matches_missing": 1, "matches_unknown": 1, "matches_repeated": 1, "matches_bad_ids": 1, "matches_twice": 1, "candidates_missing": 0, "candidates_unknown": 0, "candidates_repeated": 0, "candidates_bad_ids": 0, "candidates_twice": 0, "not_candidates": 2}


@pytest.mark.parametrize("name", sorted(plans.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages labels".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    r = c.execute(plans.oracle_sql()[name])
    cols = [x[0] for x in r.description]
    df = plans.queries()[name](spark, SF)
    assert sorted(cols) == sorted(df.columns)
    text = lambda v: v if not isinstance(v, float) else f"{v:.6g}"
    assert sorted(str([text(v) for v in x]) for x in df.select(*cols).collect()) == sorted(str([text(v) for v in x]) for x in r.fetchall())


@pytest.mark.parametrize("name", ["jaro_winkler", "string_similarity", "lev_norm", "token_jaccard"])
def test_equal_names_are_scored_once(spark, tmp_path, monkeypatch, name):
    from weftlink.plans import texts

    parts = [(k, "b", 1, f"name {k % 3}", "x") for k in range(120)] + [(500, "c", 1, "name 0", "x"), (501, "c", 2, "name 0", "x"), (502, "c", 2, None, "x")]
    spark.createDataFrame(parts, "p_partkey long, p_brand string, p_size int, p_name string, p_type string").write.parquet(str(tmp_path / "part.parquet"))
    monkeypatch.setattr(texts, "CHUNK", 7)
    monkeypatch.setattr(texts, "TASK_PAIRS", 500)
    seen, names = spark.sparkContext.accumulator(0), texts._names

    def counted(a, b):
        seen.add(len(a))
        return a.str.len() + b.str.len()

    udf = F.pandas_udf(counted, "double")
    udf.asNondeterministic()
    got = names(spark, str(tmp_path), one=udf(F.col("ni"), F.col("nj"))).collect()
    assert sorted((r["i"], r["j"]) for r in got) == sorted([*itertools.combinations(range(120), 2), (501, 502)])
    # 7140 pairs of parts, in 18 chunks of equal names
    assert seen.value <= 18 * 18 + 1
    df = plans.queries()[name](spark, str(tmp_path))
    assert df.columns[:2] == ["i", "j"] and df.count() == 7141
    assert df.where("i % 3 = j % 3 and i < 120").select(F.min(df.columns[2])).first()[0] == (100 if name == "string_similarity" else 1)


@pytest.mark.parametrize("max_df,budget,one_in", [(25, 1e12, 4), (10**6, 1500, 1)])
def test_tiles_equal_the_join(spark, tmp_path, monkeypatch, max_df, budget, one_in):
    from weftlink.operators import tiles
    from weftlink.plans import linkage

    r = np.random.default_rng(7)
    texts = [" ".join(f"word{w}" for w in r.zipf(1.3, r.integers(0, 9)) if w < 60) for _ in range(60)]
    texts += texts[:20] + ["copy of word1 and word2"] * 30 + ["", None, "alone"]
    docs = [(int(k), t, ("en", "fr", None)[int(r.integers(0, 3))], f"s{k % 2}") for k, t in enumerate(texts)] + [(900, "of one side", "de", "s")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    for name, value in (("STEP", 60), ("LEAST", 100), ("MOST", 300), ("ONE_IN", one_in), ("SHORT", 2)):
        monkeypatch.setattr(tiles, name, value)
    d, q = str(tmp_path), plans.queries()
    names = ("topk_token_cosine_s1", "topk_token_cosine_rec", "candidates_found_mask", "overlap_mass", "miss_diagnosis", "recall_report")
    rows = lambda n: sorted(map(str, q[n](spark, d, max_df, budget).collect()))
    monkeypatch.setattr(linkage.B, "similarities", lambda *_: pytest.fail("all products were listed"))
    got = {n: rows(n) for n in names}
    monkeypatch.undo()
    monkeypatch.setattr(tiles, "CELLS", 0)
    for n in names:
        assert got[n] == rows(n), n


def test_tiles_let_few_pairs_out(spark, monkeypatch):
    from weftlink.operators import tiles

    r = np.random.default_rng(3)
    rows = [("g", "a" if k % 3 == 0 else "b", k, [f"w{w}" for w in {*r.integers(0, 200, 30).tolist()}]) for k in range(900)]
    for name, value in (("LEAST", 1000), ("MOST", 3000)):
        monkeypatch.setattr(tiles, name, value)
    store = tiles.prepare(spark.createDataFrame(rows, "grp string, side string, id long, name array<string>"), ("name",), 10**6, 1e12)
    # 60 tasks: the best of 600 rows in each would be 36,000 pairs
    got = tiles.best(store, {"name": (0, 1)}, 9, ["name"])
    assert 600 <= got.count() < 15_000
    assert spark.sparkContext.parallelize([0], 1).map(lambda _: tiles.TOKENS).first() >= 16_000_000


def test_whole_blocking_keeps_frequent_tokens(spark, tmp_path):
    texts = [" ".join(c) for c in itertools.combinations("w0 w1 w2 w3 w4 w5 w6 w7".split(), 5)]
    docs = [(3 * k + side, t, "en", "s") for k, t in enumerate(texts) for side in (0, 1)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    q = plans.queries()
    r = q["recall_report"](spark, str(tmp_path)).first()
    assert r["recall"] == r["recall_name_s1"] == 1
    assert q["miss_diagnosis"](spark, str(tmp_path)).first()["unreachable"] == 0
    assert q["token_df_idf"](spark, str(tmp_path)).where("not alive").count() == 0
    assert q["recall_report"](spark, str(tmp_path), 24).first()["recall"] == 0
    assert 0 < q["budget_cut_tokens"](spark, str(tmp_path), budget=2000).where("alive").count() < q["budget_cut_tokens"](spark, str(tmp_path)).where("alive").count()


def test_running_counts(spark):
    r = np.random.default_rng(0)
    values = [float(x) for x in r.integers(0, 500, 3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double").groupBy("v").agg(F.count("*").alias("m"))
    got = {x["v"]: x["below"] for x in audit.running_below(df, "v", "m").collect()}
    assert got == {v: sum(x < v for x in values) for v in set(values)}
    assert audit.running_below(df.where("false"), "v", "m").count() == 0
    assert audit.auc_logloss(spark.createDataFrame([(1, 0.5)], "y int, p double"), "y", "p").first()["auc"] is None


def test_frequency_counts_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 1)], "k string, v int")
    assert sorted(r["n"] for r in audit.frequency(df, ["k"], F.col("v") == 1, "n").collect()) == [1, 1, 2, 2]


def test_training_pairs_golden(spark):
    nan = float("nan")
    p = spark.createDataFrame([(1, 1, 0.9, True), (1, 2, nan, False), (1, 3, 0.1, False), (2, 1, 0.5, True), (3, 1, 0.6, False), (4, 1, nan, False), (4, 9, 0.9, True)], "i long, j long, p1 double, pruned boolean")
    s = spark.createDataFrame([(1,), (1,)], "i long")
    got = {(r["i"], r["j"], r["in_pruned"], r["lw_ok"]) for r in rerank.training_pairs(p, s, first=2).collect()}
    assert got == {(1, 1, 1, 1), (1, 3, 0, 1), (3, 1, 0, 0)}
    assert rerank.training_pairs(p, s, first=3, rivals=0).count() == 3
    assert rerank.training_pairs(p.where("false"), s).count() == 0


def test_scoring_halves_batches_and_drops_nothing(spark):
    seen = []

    def scorer(a, b):
        if len(a) > 3:
            raise MemoryError
        seen.append(len(a))
        return [float(len(x)) if x != "b" else float("inf") for x in a]

    a = ["a" * (k % 5) for k in range(20)] + ["b"]
    assert rerank.in_batches(scorer, a, [""] * 21, 16).tolist() == [*map(len, a[:-1]), 0.0] and max(seen) <= 3
    with pytest.raises(MemoryError):
        rerank.in_batches(lambda a, b: (_ for _ in ()).throw(MemoryError()), ["x"], ["y"], 4)
    with pytest.raises(RuntimeError):
        rerank.merge_scores({0: spark.range(1).toDF("i"), 1: None})


def test_whole_scores_cover_all_gated_pairs(spark):
    gated = plans.queries()["rerank_texts"](spark, SF).where("p1 > 0.35 and p1 < 0.9").select("i", "j", "shard")
    scored = plans.queries()["rerank_scores"](spark, SF).join(gated, ["i", "j"])
    assert scored.count() == gated.count() and {r["shard"] for r in scored.select("shard").distinct().collect()} == {0, 1, 2, 3}


def test_features_must_cover_the_pairs(spark):
    p = spark.createDataFrame([(1, 1), (1, 2)], "i int, j int")
    f = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.1), (2, 2, 0.3)], "i int, j int, x double")
    assert rerank.attach_features(p, f).count() == 2
    for bad in (f.where("j = 1"), f.unionByName(f)):
        with pytest.raises(RuntimeError):
            rerank.attach_features(p, bad)


def test_pair_store_prunes_and_pushes(spark, tmp_path):
    p = spark.range(200).selectExpr("id % 20 AS i", "id AS j", "CAST(id % 4 AS INT) AS fold", "CAST(id % 2 AS TINYINT) AS in_pruned", "rand(1) AS x")
    sources.write_pairs(p, str(tmp_path / "p"))
    got = sources.read_pairs(spark, str(tmp_path / "p"), ["i", "j"], [1, 3], True)
    assert got.count() == 100 and got.columns == ["i", "j"]
    plan = got._jdf.queryExecution().toString()
    assert "EqualTo(in_pruned,1)" in plan and "In(fold, [1,3])" in plan
    with pytest.raises(FileNotFoundError, match="nothing"):
        sources.require(spark, [str(tmp_path), str(tmp_path / "nothing")])
    for n in ("a.zip", "b.zip"):
        sources.package({"y": b"2", "x": b"1"}, str(tmp_path / n))
    assert (tmp_path / "a.zip").read_bytes() == (tmp_path / "b.zip").read_bytes()
    h = spark.createDataFrame([("a",), ("b",)], "t string").select(rerank.hashed(F.col("t"), 8).alias("h")).collect()
    assert all(0 <= r["h"] < 256 for r in h)
