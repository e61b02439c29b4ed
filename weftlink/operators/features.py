"""Features of candidate pairs (operators J6, J21, C1-C15, U4, F11, IO10, W2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from weftlink.functions import similarity as S
from weftlink.functions.exprs import tri
from weftlink.functions.normalize import acronym_col, tokens

from .blocking import BITS
from .context import group_context

RECORD = "name n_full n_core n_skel n_legal n_dba n_digits a_norm a_words a_nums a_postal a_house a_tail a_landmark".split()
SCORES = ("bs_full", "bs_name", "bs_addr", "tset_n_core", "tset_a_norm")


def gather(pairs: DataFrame, records: DataFrame, cols: list[str]) -> DataFrame:
    """Pairs with the columns of both records, ``a_``- and ``b_``-named structs."""
    a = records.select(F.col("id").alias("i"), F.struct(*cols).alias("a"))
    b = records.select(F.col("id").alias("j"), F.struct(*cols).alias("b"))
    return pairs.join(a, "i").join(b, "j")


def block_context(pairs: DataFrame) -> DataFrame:
    """Rank, gap and margin of five scores on both sides, and both sides' numbers of candidates."""
    out = pairs
    for side, other in (("i", "j"), ("j", "i")):
        for s in SCORES:
            out = group_context(out, side, s, [other], -1.0, "__")
            out = out.withColumnsRenamed({"__rank": f"rk_{side}_{s}", "__gap": f"gap_{side}_{s}", "__m2": f"m2_{side}_{s}", "__size": f"n_cand_{side}" if s == SCORES[0] else "__n"}).drop("__n")
    return out


def string_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """C14: the pair features of normalized records (id, src, the RECORD fields, f_name_s1,
    f_name_r, f_addr_s1); pairs: (i, j, found, ...). NaN of the sources is null here."""
    g = gather(pairs, records, ["src", *RECORD, "f_name_s1", "f_name_r", "f_addr_s1"])
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    both = lambda c: (a(c) != "") & (b(c) != "")
    one = lambda c: F.coalesce(c, F.lit(False)).cast("tinyint")
    f = {}
    for v in ("n_full", "n_core", "n_skel", "a_norm", "a_words", "a_tail"):
        f[f"ratio_{v}"] = S.ratio_udf(a(v), b(v))
        if v not in ("n_core", "a_norm"):
            f[f"tset_{v}"] = S.token_set_udf(a(v), b(v))
        if v in ("n_core", "a_words"):
            f |= {f"tsort_{v}": S.token_sort_udf(a(v), b(v)), f"partial_{v}": S.partial_udf(a(v), b(v)), f"jw_{v}": S.jaro_winkler_udf(a(v), b(v)), f"lev_{v}": S.levenshtein_similarity(a(v), b(v))}
    f["wratio_n_core"] = S.weighted_udf(a("n_core"), b("n_core"))
    f["ratio_raw_name"] = S.ratio_udf(F.lower(a("name")), F.lower(b("name")))
    f["tset_landmark"] = F.when(both("a_landmark"), S.token_set_udf(a("a_landmark"), b("a_landmark")))
    f["landmark_present"] = ((a("a_landmark") != "").cast("tinyint") + (b("a_landmark") != "").cast("tinyint")).cast("tinyint")
    f["dba_best"] = S.dba_udf(a("n_dba"), a("n_core"), b("n_dba"), b("n_core"))
    f["postal_prefix3"] = F.when(both("a_postal"), one(F.left(a("a_postal"), F.lit(3)) == F.left(b("a_postal"), F.lit(3)))).otherwise(-1)
    f["house_lendiff"] = F.when(both("a_house"), F.abs(F.char_length(a("a_house")) - F.char_length(b("a_house")))).otherwise(-1)
    for name, c in (("postal", "a_postal"), ("house", "a_house"), ("legal", "n_legal"), ("name_digits", "n_digits")):
        f[f"{name}_tri"] = tri(a(c), b(c))
        if name in ("postal", "house"):
            f[f"{name}_lev"] = F.when(both(c), F.levenshtein(a(c), b(c)))
    for c in ("n_core", "n_skel", "a_norm"):
        f[f"eq_{c}"] = one(a(c) == b(c))
    in_order = lambda c: F.array_join(F.array_sort(tokens(c)), " ")
    f["eq_n_core_sorted"] = one(in_order(a("n_core")) == in_order(b("n_core")))
    tight = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    short = lambda x, y: (acronym_col(x) == tight(y)) & (F.char_length(tight(y)) >= 2)
    f["acronym_hit"] = one(short(a("n_core"), b("n_core")) | short(b("n_core"), a("n_core")))
    f["addr_nums_jacc"] = S.jaccard(tokens(a("a_nums")), tokens(b("a_nums")))
    for v in ("n_core", "a_norm"):
        x, y = F.char_length(a(v)), F.char_length(b(v))
        f |= {f"len_{v}_a": x, f"len_{v}_b": y, f"lendiff_{v}": F.abs(x - y)}
    f |= {"src_b": b("src"), "freq_name_s1": a("f_name_s1"), "freq_name_r": b("f_name_r"), "freq_addr_s1": a("f_addr_s1")}
    f |= {f"found_{v}_{d}": F.getbit(F.col("found").cast("int"), F.lit(k)).cast("tinyint") for (v, d), k in BITS.items()}
    return g.select(*pairs.columns, *(c.alias(n) for n, c in f.items()))


def learned_features(pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Six features of lower-cased raw texts; -1 for addresses if a side has none."""
    from weftlink.functions.normalize import house_col

    g = gather(pairs, records.select("id", F.lower("name").alias("name"), F.lower("address").alias("addr")), ["name", "addr"])
    n, m, x, y = F.col("a.name"), F.col("b.name"), F.col("a.addr"), F.col("b.addr")
    h, k = house_col(x), house_col(y)
    eq = F.when((h == "") | (k == ""), -1).otherwise((h == k).cast("int"))
    return g.select(*pairs.columns, S.token_set_udf(n, m).alias("name_tset"), S.ratio_udf(n, m).alias("name_ratio"), F.when((x == "") | (y == ""), -1.0).otherwise(S.token_set_udf(x, y)).alias("addr_tset"), F.when((x == "") | (y == ""), -1.0).otherwise(S.partial_udf(x, y)).alias("addr_partial"), eq.alias("house_eq"), (y == "").cast("int").alias("addr_empty"))


def record_similarity(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """``sim`` of rows with structs a and b that hold n_core and a_norm, 0 to 1."""
    name, addr = (S.token_set_udf(F.col(f"{a}.{c}"), F.col(f"{b}.{c}")) for c in ("n_core", "a_norm"))
    return pairs.withColumn("sim", (name + addr) / 200)


def feature_list(df: DataFrame, drop: tuple[str, ...] = ()) -> list[str]:
    """numeric columns that are neither ids, labels nor scores."""
    out = {"i", "j", "r", "label", "fold", "found", "p1", "p2", "pruned", "grp", *drop}
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in out]
