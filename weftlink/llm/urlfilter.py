"""Temporal URL filters: dated list entries become validity intervals, and an as-of join
evaluates every capture against the entries active when it was fetched. DataFrame
operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Copies of each list entry, one for each salt of the captures, so that a host with a
#: third of all captures meets its entries in as many tasks.
SALTS = 16


def host_of(url) -> F.Column:
    """Lower-case host without user, port and trailing dot; null where there is none."""
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1))
    host = F.regexp_replace(host, r"\.+$", "")
    return F.when(host != "", host)


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, action, since, until) of dated entries (pattern, action, since): an
    entry holds from its time until the next one of its pattern, the last for ever
    (until null). action is ``block``, ``allow`` or ``lift`` (ends what was in force).
    Of entries of one pattern and time the strongest holds: allow, block, lift. Entries
    with a null pattern, action or time hold nothing; repeated ones count once."""
    e = entries.where("pattern is not null and action is not null and since is not null")
    rank = F.when(F.col("action") == "allow", 2).when(F.col("action") == "block", 1).otherwise(0)
    e = e.groupBy("pattern", "since").agg(F.max(F.struct(rank.alias("r"), F.col("action").alias("a"))).alias("x"))
    nxt = F.lead("since").over(Window.partitionBy("pattern").orderBy("since"))
    return e.select("pattern", F.col("x.a").alias("action"), "since", nxt.alias("until")).where("action <> 'lift'")


def candidates(host, deepest: int) -> F.Column:
    """The patterns that can hold for a host: the host itself (``=host``) and each of its
    domains (``host``, ``parent``, ...) of up to ``deepest`` labels, the most any has."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    least = F.greatest(F.lit(1), n - deepest + 1)
    tails = F.transform(F.sequence(least, n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    return F.array_union(F.array(F.concat(F.lit("="), host)), tails)


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """(id, url, fetched, host, pattern, since, decision) for every capture.

    Among the entries in force at the time of the fetch (since <= fetched < until)
    the longest pattern decides, an exact host before a domain of the same name; with
    none the capture is kept. decision is ``block`` or ``keep``. A capture without a
    host or a time matches nothing and is kept; repeated captures give a row each;
    empty tables are fine; other columns are ignored."""
    span = staged(intervals(entries), "intervals")
    deepest = span.agg(F.max(F.size(F.split("pattern", r"\."))).alias("n")).first()[0] or 1
    c = captures.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(time_col).alias("fetched"), host_of(F.col(url_col)).alias("host"))
    # each distinct (host, time) is looked up once; captures of one host at one time share it
    ask = c.where("host is not null and fetched is not null").groupBy("host", "fetched").agg(F.count("*").alias("captures"))
    salt = F.pmod(F.xxhash64("host", "fetched"), F.lit(SALTS)).cast("int")
    keys = ask.select("host", "fetched", salt.alias("salt"), F.explode(candidates(F.col("host"), deepest)).alias("key"))
    rules = span.select("pattern", "action", "since", "until", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("rsalt"))
    active = keys.join(rules, (F.col("key") == F.col("pattern")) & (F.col("salt") == F.col("rsalt")) & (F.col("since") <= F.col("fetched")) & (F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    weight = F.struct(F.length(F.regexp_replace("pattern", "^=", "")).alias("l"), F.col("pattern").startswith("=").alias("exact"), F.col("pattern"), F.col("action"), F.col("since"))
    won = active.groupBy(F.col("host").alias("h"), F.col("fetched").alias("f")).agg(F.max(weight).alias("w"))
    # what cannot match passes the join by
    asks = F.col("host").isNotNull() & F.col("fetched").isNotNull()
    met = c.where(asks).join(won, (F.col("host") == F.col("h")) & (F.col("fetched") == F.col("f")), "left").select(*c.columns, "w")
    out = met.unionByName(c.where(~asks).withColumn("w", F.lit(None).cast(won.schema["w"].dataType)))
    decision = F.when(F.col("w.action") == "block", "block").otherwise("keep")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("fetched").alias(time_col), "host", F.col("w.pattern").alias("pattern"), F.col("w.since").alias("since"), decision.alias("decision"))

