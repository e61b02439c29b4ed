"""Connected components of a link table, as DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, staged, written


def components(links: DataFrame) -> DataFrame:
    """(a long, b long) links -> (node, root): root is the smallest node reachable.

    Each round takes the least label among a node's neighbours, then jumps to
    that label's own label, so long chains shorten by powers of two. Every round
    is written to the shared folder, and the one before it deleted. No link or label
    reaches the driver, only whether any changed. Repeated links, self links and an empty
    table are fine; links with a null end are ignored."""
    both = links.where("a is not null and b is not null")
    sym = staged(both.select("a", "b").union(both.select(F.col("b"), F.col("a"))).distinct(), "links")
    spark = links.sparkSession
    at_path = written(sym.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("root")), "labels")
    labels = spark.read.schema("node long, root long").parquet(at_path)
    while True:
        near = sym.join(labels, sym.b == labels.node).groupBy("a").agg(F.min("root").alias("m"))
        one = labels.join(near, labels.node == near.a, "left").select("node", F.col("root").alias("was"), F.least("root", "m").alias("root"))
        at = labels.select(F.col("node").alias("at"), F.col("root").alias("next"))
        two = one.join(at, F.col("root") == F.col("at"), "left").select("node", "was", F.least("root", "next").alias("root"))
        path = written(two, "labels")
        done = spark.read.schema("node long, was long, root long").parquet(path)
        discard(spark, at_path)
        at_path, labels = path, done.select("node", "root")
        if not done.where("root <> was").limit(1).count():
            return labels
