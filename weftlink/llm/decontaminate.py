"""Benchmark decontamination: size-partitioned MinHash containment search. DataFrame
operations only.

Items are partitioned by their number of distinct shingles q (powers of two; those of fewer
words than a shingle has are partitions of their own). A document that holds at least
``threshold`` of an item misses at most q - ceil(threshold q) of its shingles, so it holds
one of the item's q - ceil(threshold q) + 1 least MinHash values: these are its sketch. The
greatest value in the sketches of a partition is the partition's bound, and a document's
sketch there is all its MinHash values up to the bound (so it grows with the document, as
containment needs it, where a fixed number of minima would hold an item of a long document
by chance only). Whatever reaches the threshold shares a value, however long the document;
nothing is sampled. Each candidate pair is then verified on the shingles' texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, staged, words

SHINGLE = 5
THRESHOLD = 0.8
#: Sketch rows (64-bit values) up to which the probe side is broadcast.
BROADCAST_ROWS = 500_000


def _tokens(text) -> F.Column:
    return words(F.lower(text))


def _grams(tokens, size: int) -> F.Column:
    """All runs of ``size`` words, space-joined, in order, repeats included."""
    at = F.when(F.size(tokens) >= size, F.sequence(F.lit(0), F.size(tokens) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.concat_ws(" ", *(F.get(tokens, i + k) for k in range(size))))


def _hashes(tokens, size: int) -> F.Column:
    """64-bit hashes of all runs of ``size`` words, of an array of the words' hashes."""
    at = F.when(F.size(tokens) >= size, F.sequence(F.lit(0), F.size(tokens) - size)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(*(F.get(tokens, i + k) for k in range(size))))


def _word_hashes(tokens) -> F.Column:
    return F.transform(tokens, lambda w: F.xxhash64(w))


def item_shingles(items: DataFrame, id_col: str, text_col: str, size: int = SHINGLE) -> DataFrame:
    """(item, len, grams, values): distinct shingles of each distinct item text, and their
    hashes, least first. An item of
    fewer words than ``size`` is one shingle of its own length; one without words
    is left out. Rows of one id with different texts are items of their own."""
    t = items.select(F.col(id_col).alias("item"), _tokens(F.col(text_col)).alias("t")).where("size(t) > 0").distinct()
    n = F.least(F.size("t"), F.lit(size))
    grams = F.when(F.size("t") >= size, F.array_distinct(_grams(F.col("t"), size))).otherwise(F.array(F.array_join("t", " ")))
    h = _word_hashes(F.col("t"))
    values = F.when(F.size("t") >= size, _hashes(h, size))
    for k in range(1, size):
        values = values.when(F.size("t") == k, _hashes(h, k))
    return t.select("item", n.alias("len"), grams.alias("grams"), F.array_sort(F.array_distinct(values)).alias("values"))


def _verified(docs: DataFrame, items: DataFrame, threshold: float, size: int, id_col: str, text_col: str, item_col: str, item_text: str) -> DataFrame | None:
    """(id, key, item, total, matched) of every candidate pair of a row's text and an item,
    counted on the texts; ``key`` is a hash of the row's text. None without items."""
    sets = staged(item_shingles(items, item_col, item_text, size), "items")
    total = F.size("grams")
    # ceil with slack, else 0.8 * 5 in floating point could ask for one shingle too many
    need = F.ceil(total * F.lit(threshold) - F.lit(1e-9)).cast("int")
    part = F.struct(F.col("len"), F.floor(F.log2(total.cast("double")) + 1e-9).cast("int").alias("q"))
    sketch = staged(sets.select("item", part.alias("part"), F.explode(F.slice("values", F.lit(1), total - need + 1)).alias("value")), "sketch")
    bounds = sketch.groupBy("part").agg(F.max("value").alias("bound"), F.count("*").alias("n")).collect()
    if not bounds:
        return None
    rows = sum(r["n"] for r in bounds)
    keys = sketch.select("item", F.col("part").alias("kpart"), F.col("value").alias("kvalue"))
    keys = F.broadcast(keys) if rows <= BROADCAST_ROWS else keys
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    t = texts.select("id", "key", _word_hashes(_tokens(F.col("text"))).alias("t"))
    probes, lengths = [], sorted({r["part"]["len"] for r in bounds})
    for n in lengths:
        # a value goes to every partition whose bound it is within
        parts = sorted((r["bound"], r["part"]["q"]) for r in bounds if r["part"]["len"] == n)
        most = parts[-1][0]
        few = F.filter(_hashes(F.col("t"), n), lambda h, most=most: h <= F.lit(most))
        steps = [F.when(F.col("h") <= b, F.struct(F.lit(n).alias("len"), F.lit(q).alias("q"))) for b, q in parts]
        p = t.select("id", "key", F.explode(F.array_distinct(few)).alias("h"))
        p = p.select("id", "key", "h", F.explode(F.filter(F.array(*steps), lambda x: x.isNotNull())).alias("part")) if len(parts) > 1 else p.select("id", "key", "h", steps[0].alias("part"))
        probes.append(p.join(keys, (F.col("h") == F.col("kvalue")) & (F.col("part") == F.col("kpart"))).select("id", "key", "item"))
    hits = reduce(DataFrame.unionByName, probes).distinct()
    pairs = staged(hits, "candidates").select(F.col("id").alias("pid"), F.col("key").alias("pkey"), "item")
    # exact: the candidates' texts once more, against the whole shingle set of the item
    held = texts.join(pairs, F.col("id").eqNullSafe(F.col("pid")) & (F.col("key") == F.col("pkey")))
    held = held.join(sets.select(F.col("item").alias("sitem"), "len", "grams"), F.col("item").eqNullSafe(F.col("sitem")))
    held = held.select("id", "key", "item", "len", "grams", _tokens(F.col("text")).alias("t"))
    own = F.lit(None).cast("array<string>")
    for n in lengths:
        own = F.when(F.col("len") == n, _grams(F.col("t"), n)).otherwise(own)
    return held.select("id", "key", "item", F.size("grams").alias("total"), F.size(F.array_intersect("grams", own)).alias("matched"))


def _best(held: DataFrame, threshold: float, *by: str) -> DataFrame:
    """The best containment ``s`` (c, m, t) of each group, of those that reach the threshold."""
    share = F.col("matched") / F.col("total")
    best = held.groupBy(*by).agg(F.max(F.struct(share.alias("c"), F.col("matched").alias("m"), F.col("total").alias("t"))).alias("s"))
    # filtered after the aggregate: pushed below it, the predicate would split each text again for every shingle
    return best.where(F.col("s.m") >= F.ceil(F.col("s.t") * F.lit(threshold) - F.lit(1e-9)))


def contamination(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, matched, total, containment) for every document that holds at
    least ``threshold`` of an item's distinct word shingles (lower-cased words
    between ASCII white space).

    Null texts and texts without words hold nothing. Repeated items (same id and
    text) count once; repeated documents (same id and text) give one row a pair;
    rows that share an id but not the text are searched one by one and the best
    containment is given. Documents with a null id are searched, too, and joined
    null-safely. Empty tables give no rows; other columns are ignored."""
    held = _verified(docs, items, threshold, size, id_col, text_col, item_col, item_text)
    if held is None:
        ids = docs.select(F.col(id_col), F.lit(None).cast(items.schema[item_col].dataType).alias("item_id"))
        return ids.where("false").select(id_col, "item_id", F.lit(0).alias("matched"), F.lit(0).alias("total"), F.lit(0.0).alias("containment"))
    best = _best(held, threshold, "id", "item")
    return best.select(F.col("id").alias(id_col), F.col("item").alias("item_id"), F.col("s.m").alias("matched"), F.col("s.t").alias("total"), F.col("s.c").alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose own text holds no item, with all their columns. Rows that
    share an id (null included) but not the text are decided one by one; columns of any
    other name pass through as they are."""
    held = _verified(docs, items, threshold, SHINGLE, id_col, text_col, "item_id", "text")
    if held is None:
        return docs
    bid, bkey = free(docs, "leak_id", "leak_key")
    bad = staged(_best(held, threshold, "id", "key", "item").select(F.col("id").alias(bid), F.col("key").alias(bkey)).distinct(), "leaks")
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col(bid)) & (F.xxhash64(text_col) == F.col(bkey)), "left_anti")
