"""Normalization and string similarity over texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.functions import normalize as N
from weftlink.functions import similarity as S
from weftlink.functions import tables as T
from weftlink.operators import audit

from .common import collector, table

QUERIES, SQL, query = collector()


def _folded(c: str, folds: dict[str, str]) -> str:
    for a, b in folds.items():
        c = f"replace({c}, '{a}', '{b}')"
    return c


def _skeleton_sql(folds: dict[str, str]) -> str:
    f = _folded("w", folds)
    s = f"(left({f}, 1) || regexp_replace(substr({f}, 2), '[aeiouh]', '', 'g'))"
    return f"list_aggregate(list_filter(string_split({s}, ''), lambda x, i: i = 1 OR x <> string_split({s}, '')[i - 1]), 'string_agg', '')"


@query(f"WITH w AS (SELECT p_partkey, unnest(list_filter(string_split(lower(p_name), ' '), lambda x: x <> '')) AS w FROM part) SELECT p_partkey, w, {_skeleton_sql(T.FOLDS)} AS skel, {_skeleton_sql(T.FOLDS | T.VOICED)} AS skel2 FROM w")
def skeleton_key(spark: SparkSession, d: str) -> DataFrame:
    """N10, native."""
    w = table(spark, d, "part").select("p_partkey", F.explode(N.tokens(F.lower("p_name"))).alias("w"))
    return w.select("p_partkey", "w", N.skeleton_col(F.col("w")).alias("skel"), N.skeleton_col(F.col("w"), True).alias("skel2"))


@query(r"SELECT p_partkey, coalesce(list_aggregate(list_transform(list_filter(string_split(p_name || ' ' || p_type, ' '), lambda x: x <> '' AND NOT regexp_full_match(x, '\d+')), lambda x: left(x, 1)), 'string_agg', ''), '') AS acronym FROM part")
def acronym_key(spark: SparkSession, d: str) -> DataFrame:
    """N12, C10."""
    return table(spark, d, "part").select("p_partkey", N.acronym_col(F.concat_ws(" ", "p_name", "p_type")).alias("acronym"))


@query(r"SELECT c_custkey, regexp_replace(regexp_extract(c_name, '\d+'), '^0+([0-9])', '\1') AS house, left(regexp_replace(lower(c_name), '[^0-9a-z]', '', 'g'), 3) AS key FROM customer")
def house_and_sort_key(spark: SparkSession, d: str) -> DataFrame:
    """N17, N18."""
    return table(spark, d, "customer").select("c_custkey", N.house_col(F.col("c_name")).alias("house"), N.sort_key_col(F.col("c_name")).alias("key"))


@query("SELECT page_id, 'name: ' || coalesce(url, '') || ' | address: ' || CAST(page_id AS VARCHAR) || ' | country: x' AS text FROM pages")
def record_texts(spark: SparkSession, d: str) -> DataFrame:
    """F3, F2."""
    return table(spark, d, "pages").select("page_id", N.record_text(F.coalesce("url", F.lit("")), F.col("page_id").cast("string"), F.lit("x")).alias("text"))


#: Keys in an array, and pairs of keys that a task lists, about.
CHUNK = 4096
TASK_PAIRS = 2_000_000


def _names(spark: SparkSession, d: str, **scores: F.Column) -> DataFrame:
    """Scores of pairs of parts of one brand and size, by their names ``ni`` and ``nj``. Equal
    names of a brand and size are one class: a score is taken once for each two classes and
    then written for all pairs of their parts. Classes are dealt by brand and size into as
    many tasks as their pairs need; a large brand and size is split on one side."""
    group = ["p_brand", "p_size"]
    p = table(spark, d, "part").select("p_partkey", *group, F.concat_ws(" ", "p_name", "p_type").alias("n")).where("p_partkey is not null")
    n = F.col("count").cast("double")
    total, most = p.groupBy(group).count().agg(F.coalesce(F.sum(n * n), F.lit(0.0)), F.coalesce(F.max(n * n), F.lit(0.0))).first()
    salts = min(1024, 1 + int(most // (4 * TASK_PAIRS)))
    tasks = min(20_000, max(spark.sparkContext.defaultParallelism, int(total // TASK_PAIRS)))
    c = p.groupBy(*group, "n").agg(F.collect_list("p_partkey").alias("ids"))
    starts = F.sequence(F.lit(1), F.size("ids"), F.lit(CHUNK))
    c = c.select(*group, "n", F.explode(F.transform(starts, lambda k: F.slice("ids", k, CHUNK))).alias("ids"))
    c = c.withColumns({"least": F.array_min("ids"), "most": F.array_max("ids")})
    side = lambda x, k, salt: x.select(*group, salt.alias("salt"), *(F.col(v).alias(f"{v}_{k}") for v in ("n", "ids", "least", "most"))).repartition(tasks, *group, "salt")
    i = side(c, "i", F.pmod(F.xxhash64("n", "least"), F.lit(salts)))
    j = side(c, "j", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    both = i.join(j, [*group, "salt"]).where("least_i < most_j").select("ids_i", "ids_j", F.col("n_i").alias("ni"), F.col("n_j").alias("nj"))
    both = both.select("ids_i", "ids_j", *(F.round(x, 6).alias(k) for k, x in scores.items()))
    return both.select(F.explode("ids_i").alias("i"), "ids_j", *scores).select("i", F.explode("ids_j").alias("j"), *scores).where("i < j")


_NAMES = "x AS (SELECT a.p_partkey AS i, b.p_partkey AS j, a.p_name || ' ' || a.p_type AS ni, b.p_name || ' ' || b.p_type AS nj FROM part a JOIN part b USING (p_brand, p_size) WHERE a.p_partkey < b.p_partkey)"


@query(f"WITH {_NAMES} SELECT i, j, round(1 - levenshtein(ni, nj) / greatest(length(ni), length(nj)), 6) AS lev FROM x")
def lev_norm(spark: SparkSession, d: str) -> DataFrame:
    """C6."""
    return _names(spark, d, lev=S.levenshtein_similarity(F.col("ni"), F.col("nj")))


@query(f"WITH {_NAMES} SELECT i, j, round(jaro_winkler_similarity(ni, nj), 6) AS jw FROM x")
def jaro_winkler(spark: SparkSession, d: str) -> DataFrame:
    """C5."""
    return _names(spark, d, jw=S.jaro_winkler_udf(F.col("ni"), F.col("nj")))


@query(f"WITH {_NAMES}, t AS (SELECT i, j, list_distinct(string_split(ni, ' ')) AS a, list_distinct(string_split(nj, ' ')) AS b FROM x) SELECT i, j, round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 6) AS jaccard FROM t")
def token_jaccard(spark: SparkSession, d: str) -> DataFrame:
    """U4."""
    return _names(spark, d, jaccard=S.jaccard(N.tokens(F.col("ni")), N.tokens(F.col("nj"))))


@query()
def string_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Scorers without a form in SQL; the tests hold them against definitions."""
    a, b = F.col("ni"), F.col("nj")
    return _names(spark, d, **{n: u(a, b) for n, u in (("ratio", S.ratio_udf), ("token_set", S.token_set_udf), ("token_sort", S.token_sort_udf), ("partial", S.partial_udf), ("weighted", S.weighted_udf))})


def _businesses(spark: SparkSession, d: str) -> DataFrame:
    """Parts as businesses: a legal form, an article and an address by the key."""
    k = F.col("p_partkey")
    form = F.element_at(F.array(*map(F.lit, ("", "Ltd", "Pvt. Ltd.", "& Co Inc", "Corporation"))), (k % 5 + 1).cast("int"))
    name = F.concat_ws(" ", F.when(k % 3 == 0, "The"), "p_name", "p_type", form)
    address = F.concat(F.col("p_size").cast("string"), F.lit(" MG Road, Near "), "p_type", F.lit(", New York "), (k % 90000 + 10000).cast("string"))
    return table(spark, d, "part").select("p_partkey", name.alias("name"), address.alias("address"))


def _map(words: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in words.items()) + "}"


def _replaced(c: str, pairs: dict[str, str]) -> str:
    for k in sorted(pairs, key=len, reverse=True):
        c = f"regexp_replace({c}, '\\b{k}\\b', '{pairs[k]}', 'g')"
    return c


_PLAIN = "trim(regexp_replace(regexp_replace(lower({}), '[^\\w\\s&#]|_', ' ', 'g'), '\\s+', ' ', 'g'))"
_LIST = "list_filter(string_split({}, ' '), lambda x: x <> '')"
_FORMS = "|".join(sorted(T.LEGAL))


def _address(c: str) -> str:
    words = _map({**T.ADDRESS_WORDS, **T.STATES, **T.ORDINALS})
    return f"list_filter(list_transform({_LIST.format(_replaced(_PLAIN.format(c), T.STATE_PHRASES))}, lambda x: coalesce(map_extract({words}, x)[1], x)), lambda x: x <> '')"


@query(rf"""WITH b AS (SELECT p_partkey, concat_ws(' ', CASE WHEN p_partkey % 3 = 0 THEN 'The' END, p_name, p_type, ['', 'Ltd', 'Pvt. Ltd.', '& Co Inc', 'Corporation'][p_partkey % 5 + 1]) AS name,
  p_type AS kind, p_size || ' MG Road, Near ' || p_type || ', New York ' || (p_partkey % 90000 + 10000) AS address, CAST(p_partkey % 90000 + 10000 AS VARCHAR) AS code, 'Near ' || p_type || ' New York ' || (p_partkey % 90000 + 10000) AS ends FROM part),
w AS (SELECT *, list_transform({_LIST.format(_PLAIN.format("name"))}, lambda x: coalesce(map_extract({_map(T.NAME_WORDS)}, x)[1], x)) AS w, {_address("address")} AS a, {_address("ends")} AS z FROM b),
f AS (SELECT *, array_to_string(w, ' ') AS n_full, regexp_extract(' ' || array_to_string(w, ' '), '^(.*?)((?: (?:{_FORMS}|&|and))* (?:{_FORMS}))?$', 1) AS c, regexp_extract(' ' || array_to_string(w, ' '), '^(.*?)((?: (?:{_FORMS}|&|and))* (?:{_FORMS}))?$', 2) AS l FROM w),
g AS (SELECT *, list_filter({_LIST.format("c")}, lambda x: x NOT IN ({", ".join(f"'{x}'" for x in sorted(T.NAME_STOP))})) AS core, {_LIST.format("l")} AS forms FROM f)
SELECT p_partkey, n_full, array_to_string(core, ' ') AS n_core, array_to_string(list_sort(core), ' ') AS n_core_sorted,
  CASE WHEN list_contains(forms, 'pvt') AND list_contains(forms, 'ltd') THEN 'pvtltd' {" ".join(f"WHEN list_contains(forms, '{k}') THEN '{k}'" for k in T.LEGAL_ORDER)} ELSE coalesce(list_min(forms), '') END AS n_legal,
  array_to_string(list_transform(core, lambda x: left(x, 1)), '') AS n_acr, '' AS n_dba, '' AS n_digits,
  array_to_string(list_transform(core, lambda w: {_skeleton_sql(T.FOLDS)}), ' ') AS n_skel, array_to_string(list_transform(core, lambda w: {_skeleton_sql(T.FOLDS | T.VOICED)}), ' ') AS n_skel2,
  array_to_string(a, ' ') AS a_norm, array_to_string(list_filter(a, lambda x: NOT regexp_full_match(x, '\d+')), ' ') AS a_words, array_to_string(list_filter(a, lambda x: regexp_full_match(x, '\d+') AND x <> code), ' ') AS a_nums,
  code AS a_postal, coalesce(list_filter(a, lambda x: regexp_full_match(x, '\d+') AND x <> code)[1], '') AS a_house, array_to_string(z, ' ') AS a_tail, {_PLAIN.format("kind")} AS a_landmark
FROM g""")
def normalized_records(spark: SparkSession, d: str) -> DataFrame:
    """N1, N5-N10, N12-N16, IO5: parts as businesses."""
    return N.normalized(_businesses(spark, d), "name", "address").drop("name", "address")


@query("""WITH t AS (SELECT list_distinct(list_filter(string_split(lower(p_name || ' ' || p_type), ' '), lambda x: x <> '')) AS a FROM part),
s AS (SELECT a, list_distinct(list_transform(a, lambda x: left(x, 4))) AS b FROM t),
x AS (SELECT list_filter(a, lambda x: NOT list_contains(b, x)) AS l, list_filter(b, lambda x: NOT list_contains(a, x)) AS r FROM s),
p AS (SELECT x, unnest(r) AS y FROM (SELECT unnest(l) AS x, r FROM x)),
q AS (SELECT x, y FROM p UNION ALL SELECT y, x FROM p),
n AS (SELECT x AS short, y AS long, count(*) AS n FROM q WHERE length(x) >= 2 AND length(x) < length(y) AND left(x, 1) = left(y, 1) AND (starts_with(y, x) OR regexp_full_match(y, array_to_string(string_split(x, ''), '.*'))) GROUP BY 1, 2 HAVING count(*) >= 5)
SELECT short, long, n FROM (SELECT *, row_number() OVER (PARTITION BY short ORDER BY n DESC, long) AS k FROM n) WHERE k = 1""")
def mined_abbreviations(spark: SparkSession, d: str) -> DataFrame:
    """Names against themselves with every word cut to four letters."""
    p = table(spark, d, "part").select(F.concat_ws(" ", "p_name", "p_type").alias("a"))
    cut = F.array_join(F.transform(N.tokens(F.col("a")), lambda t: F.left(t, F.lit(4))), " ")
    return audit.mine_abbreviations(p.withColumn("b", cut), "a", "b", 5)


@query(r"SELECT n_nationkey, lower(trim(regexp_replace(regexp_replace(n_name, '[^\p{L}\p{N}\s&#]', ' ', 'g'), '\s+', ' ', 'g'))) AS cty FROM nation")
def country_keys(spark: SparkSession, d: str) -> DataFrame:
    """The distinct names are normalized once and joined back."""
    n = table(spark, d, "nation")
    k = n.select("n_name").distinct().withColumn("cty", N.country_key(F.col("n_name")))
    return n.join(k, "n_name").select("n_nationkey", "cty")
