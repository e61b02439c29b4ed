"""One query for each operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, decontaminate, htmltext, mixing, quality, simhash, tokens, urlfilter, warc
from .common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records and read back by byte ranges."""
    r = warc.round_trip(table(spark, sf_dir, "pages"))
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1)
    number = lambda c: F.when(page(c) != "", page(c).try_cast("long"))
    return r.select(number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", number(F.col("refers_to")).alias("refers_to"))


def _captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a fetch time (they have none of their own): day page_id mod 1461 from 2021."""
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return p.withColumn("fetched", F.timestamp_seconds(F.lit(1609459200) + F.pmod("page_id", F.lit(1461)) * 86400))


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dated list over the pages' own hosts: by a digest of the host, some are blocked
    for a while, some allowed while their domain is blocked, some blocked again."""
    hosts = table(spark, sf_dir, "pages").select(urlfilter.host_of(F.col("url")).alias("host")).where("host is not null").distinct()
    n = F.conv(F.substring(F.md5("host"), 1, 6), 16, 10).cast("long")
    day = lambda d: F.timestamp_seconds(F.lit(1609459200) + d * 86400)
    dated = F.array(
        F.struct(F.when(n % 3 == 0, F.lit("block")).alias("action"), day(n % 700).alias("since"), F.lit(False).alias("exact")),
        F.struct(F.when(n % 6 == 0, F.lit("lift")).alias("action"), day(n % 700 + 200).alias("since"), F.lit(False).alias("exact")),
        F.struct(F.when(n % 12 == 0, F.lit("block")).alias("action"), day(n % 700 + 500).alias("since"), F.lit(False).alias("exact")),
        F.struct(F.when(n % 5 == 0, F.lit("allow")).alias("action"), day(n % 900).alias("since"), F.lit(True).alias("exact")),
    )
    own = hosts.select("host", F.inline(dated)).where("action is not null").select(F.when(F.col("exact"), F.concat(F.lit("="), F.col("host"))).otherwise(F.col("host")).alias("pattern"), "action", "since")
    wide = spark.createDataFrame([("example.net", "block", 300), ("example.net", "lift", 600), ("example.org", "block", 900)], "pattern string, action string, d int")
    return own.unionByName(wide.select("pattern", "action", day(F.col("d")).alias("since")))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's capture against the list entries in force when it was fetched."""
    return urlfilter.filter_urls(_captures(spark, sf_dir), _entries(spark, sf_dir))


OP2_SQL = r"""
WITH c AS (
  SELECT page_id, url, TIMESTAMP '2021-01-01' + to_days(CAST(page_id % 1461 AS INT)) AS fetched,
    nullif(regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)', 1)), '\.+$', ''), '') AS host
  FROM pages),
h AS (SELECT host, CAST('0x' || substr(md5(host), 1, 6) AS BIGINT) AS n FROM (SELECT DISTINCT host FROM c WHERE host IS NOT NULL)),
e AS (
  SELECT host AS pattern, 'block' AS action, n % 700 AS d FROM h WHERE n % 3 = 0
  UNION ALL SELECT host, 'lift', n % 700 + 200 FROM h WHERE n % 6 = 0
  UNION ALL SELECT host, 'block', n % 700 + 500 FROM h WHERE n % 12 = 0
  UNION ALL SELECT '=' || host, 'allow', n % 900 FROM h WHERE n % 5 = 0
  UNION ALL VALUES ('example.net', 'block', 300), ('example.net', 'lift', 600), ('example.org', 'block', 900)),
s AS (SELECT pattern, d, max(CASE action WHEN 'allow' THEN 2 WHEN 'block' THEN 1 ELSE 0 END) AS r FROM e GROUP BY 1, 2),
v AS (SELECT pattern, r, TIMESTAMP '2021-01-01' + to_days(CAST(d AS INT)) AS since,
        TIMESTAMP '2021-01-01' + to_days(CAST(lead(d) OVER (PARTITION BY pattern ORDER BY d) AS INT)) AS until FROM s),
m AS (
  SELECT c.page_id, c.url, c.fetched, v.pattern, v.r, v.since,
    row_number() OVER (PARTITION BY c.page_id, c.url ORDER BY length(replace(v.pattern, '=', '')) DESC, starts_with(v.pattern, '=') DESC) AS k
  FROM c JOIN v ON (v.pattern = '=' || c.host OR v.pattern = c.host OR ends_with(c.host, '.' || v.pattern))
    AND v.r > 0 AND v.since <= c.fetched AND (v.until IS NULL OR c.fetched < v.until))
SELECT c.page_id, c.url, c.fetched, c.host, m.pattern, m.since, CASE WHEN m.r = 1 THEN 'block' ELSE 'keep' END AS decision
FROM c LEFT JOIN m ON c.page_id = m.page_id AND c.url IS NOT DISTINCT FROM m.url AND m.k = 1
"""


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 0.8 of a benchmark item's five-word shingles."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"""list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w"""
#: The distinct shingles of n words; an item of fewer than five words is one shingle.
_SHINGLES = "list_distinct(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' ')))"
OP3_SQL = rf"""
WITH d0 AS (SELECT DISTINCT doc_id, {_WORDS} FROM documents),
i0 AS (SELECT *, least(len(w), 5) AS n FROM (SELECT DISTINCT item_id, {_WORDS} FROM benchmark) WHERE len(w) > 0),
d AS (SELECT doc_id, n, unnest({_SHINGLES}) AS g FROM d0, (SELECT DISTINCT n FROM i0) WHERE len(w) >= n),
i AS (SELECT item_id, n, {_SHINGLES} AS gs FROM i0),
ig AS (SELECT item_id, n, len(gs) AS total, unnest(gs) AS g FROM i),
m AS (SELECT d.doc_id, ig.item_id, any_value(ig.total) AS total, count(DISTINCT ig.g) AS matched FROM d JOIN ig USING (n, g) GROUP BY 1, 2)
SELECT doc_id, item_id, CAST(matched AS INT) AS matched, CAST(total AS INT) AS total, matched / total AS containment
FROM m WHERE matched >= ceil(total * 0.8 - 1e-9)
"""


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose id is divisible by 50, by cosine."""
    e = table(spark, sf_dir, "embeddings")
    return ann.nearest(e, e.where("vec_id % 50 = 0"), k=5)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and decision of every document."""
    return quality.classify(table(spark, sf_dir, "documents"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted conversations, read back; conversation -1 holds the template's own marks."""
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    mine = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(c.unionByName(mine)))


OP8_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
f AS (SELECT *, '<s>' || regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') || '[INST]' || regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\\\2\3', 'g') || '[/INST]</s>' AS shown FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS whole,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length(shown)) AS formatted_chars
  FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g
"""


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by the byte-level tokenizer of 50k pieces."""
    return tokens.token_counts(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    near = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return near.select("doc_id", simhash.hex_fingerprint(F.col("fingerprint")).alias("fingerprint"), "component_id")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py over ``documents``."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_warc, op2_url_filter, op3_decontamination, op4_ann, op5_html_text, op6_mixing, op7_quality, op8_chat, op9_tokens, op10_simhash, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": OP2_SQL, "op3_decontamination": OP3_SQL, "op8_chat": OP8_SQL}
