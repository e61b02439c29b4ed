"""What the corpus operators share: tables, the shared folder, staged intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.staging import discard, fresh_dir, open_store, staged, written

__all__ = ["SPACE", "WORD", "discard", "free", "fresh_dir", "open_store", "staged", "table", "words", "written"]

#: ASCII white space as the contracts define it.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores as it takes to be no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
    return out


def words(text) -> F.Column:
    """Array of the maximal runs without ASCII white space; null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")
