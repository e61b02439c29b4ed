"""SimHash near-duplicates: segment-popcount embedding, grid range join, exact check."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from .common import free, staged
from .components import components

LOW = 0x5555555555555555
SHINGLE = 3
MAX_BITS = 3
#: A fingerprint with more than one in HOT of all rows is spread over SALTS join keys;
#: there are fewer than HOT of these.
HOT = 1000
SALTS = 64
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of one text: ASCII-lowered words, ``size``-word
    shingles with repeats, XXH64 seed 42; a bit is set if over half have it.
    Fewer words than ``size``: one shingle of all; none (or null): 0."""
    import xxhash

    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    grams = map(b" ".join, zip(*(w[i:] for i in range(size)))) if len(w) >= size else [b" ".join(w)]
    n = max(1, len(w) - size + 1)
    h = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), dtype="<u8", count=n).view(np.uint8).reshape(n, 8)
    ones = np.concatenate([np.bincount(h[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<i8")[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


fingerprint_udf = F.pandas_udf(_fingerprints, LongType())


def embedding(fp) -> F.Column:
    """Bit counts (0, 1, 2) of the 32 two-bit segments, each in unary (00, 01, 11)
    within its own two bits, so that the Manhattan distance of two embeddings is
    ``bit_count(a ^ b)``. It never exceeds the Hamming distance of the fingerprints."""
    up = F.shiftrightunsigned(fp, 1)
    low = F.lit(LOW)
    return fp.bitwiseOR(up).bitwiseAND(low).bitwiseOR(F.shiftleft(fp.bitwiseAND(up).bitwiseAND(low), 1))


def links(nodes: DataFrame, fp: str = "fp") -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that differ in 1 to 3 bits.

    Grid: a cell is half of the embedding (16 segments). A pair within Manhattan
    distance 3 has a half within distance 1, so each fingerprint looks up its own
    cell and those one step up; the pair one step down looks up from its other
    end. The candidates must be within the bound over the whole embedding and then
    within 3 bits exactly. Nothing is capped."""
    x = nodes.select(F.col(fp).alias("fp"), embedding(F.col(fp)).alias("e"))
    mask = F.lit(0xFFFFFFFF)
    halves = F.array(F.struct(F.lit(0).alias("h"), F.shiftrightunsigned(F.col("e"), 32).alias("c")), F.struct(F.lit(1).alias("h"), F.col("e").bitwiseAND(mask).alias("c")))
    own = x.select("fp", F.inline(halves))
    c = F.col("c")
    step = lambda i: F.when(c.bitwiseAND(F.lit(1 << 2 * i)) == 0, c.bitwiseOR(F.lit(1 << 2 * i))).when(c.bitwiseAND(F.lit(2 << 2 * i)) == 0, c.bitwiseOR(F.lit(2 << 2 * i)))
    probes = own.select("fp", "h", F.explode(F.array(c, *(step(i) for i in range(16)))).alias("p"), "c").where("p is not null")
    probes = probes.select(F.col("fp").alias("a"), F.col("h").alias("ph"), F.col("p"), (F.col("p") == F.col("c")).alias("same"))
    at = own.select(F.col("fp").alias("b"), "h", "c")
    found = probes.join(at, (F.col("ph") == F.col("h")) & (F.col("p") == F.col("c"))).where("not same or a < b")
    bound = F.bit_count(embedding(F.col("a")).bitwiseXOR(embedding(F.col("b")))) <= MAX_BITS
    exact = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    return found.where(bound).where(exact).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint long, component_id) for every row of ``docs``.

    Fingerprints link at 3 or fewer differing bits; component_id is the smallest
    id reachable. Equal fingerprints collapse to one node first, so copies never
    meet in pairs; the rows of a common fingerprint find its component under many
    join keys, so a third of all rows is no task's work. Null ids stay as rows and count for no minimum (a component of
    null ids only has a null component_id); repeated rows each give a row; an empty
    table gives none; other columns are ignored."""
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    fps = staged(docs.select(F.col(id_col).alias("id"), fingerprint_udf(F.col(text_col)).alias("fp"), salt.alias("salt")), "simhash")
    nodes = staged(fps.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "simhash-nodes")
    roots = components(staged(links(nodes), "simhash-links"))
    linked = nodes.join(roots, nodes.fp == roots.node)
    ids = linked.groupBy("root").agg(F.min("least").alias("component"))
    far = linked.join(ids, "root").select("node", "component")
    hot = F.col("n") * HOT > (nodes.agg(F.sum("n")).first()[0] or 0)
    salts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    of = nodes.join(far, nodes.fp == far.node, "left").select(F.col("fp").alias("f"), F.coalesce("component", "least").alias("component_id"), F.explode(salts).alias("s"))
    common = F.broadcast(nodes.where(hot).select(F.col("fp").alias("common")))
    spread = fps.join(common, F.col("fp") == F.col("common"), "left").select("id", "fp", F.when(F.col("common").isNotNull(), F.col("salt")).otherwise(0).alias("salt"))
    found = spread.join(of, (F.col("fp") == F.col("f")) & (F.col("salt") == F.col("s")))
    return found.select(F.col("id").alias(id_col), F.col("fp").alias("fingerprint"), "component_id")


def hex_fingerprint(fp) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component stays, with all columns of ``docs``: that of the smallest
    id (null last), and of several texts of that id in the component the one with the
    smallest hash. Rows that share an id but no component stay apart. Null texts are like
    empty ones; columns of any other name pass through as they are."""
    row = F.struct(F.col(id_col).isNull().alias("bare"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"))
    fps = docs.select(fingerprint_udf(F.col(text_col)).alias("fp"), row.alias("row"))
    nodes = staged(fps.groupBy("fp").agg(F.min("row").alias("row")), "simhash-nodes")
    roots = components(staged(links(nodes), "simhash-links"))
    of = nodes.join(roots, nodes.fp == roots.node, "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("row").alias("row"))
    kid, kkey, own, key = free(docs, "kept_id", "kept_key", "own_id", "text_key")
    # ids that are never null, so that the join and what follows it need the same partitioning
    name = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    keep = staged(of.select(name(F.col("row.id")).alias(kid), F.col("row.key").alias(kkey)), "simhash-keep")
    # equal rows become one before the shuffle, so a text that a third of all rows hold is no task's work
    one = docs.withColumns({own: name(F.col(id_col)), key: F.xxhash64(text_col)}).dropDuplicates([own, key])
    return one.join(keep, (F.col(own) == F.col(kid)) & (F.col(key) == F.col(kkey)), "left_semi").select(*docs.columns)
