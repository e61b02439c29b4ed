"""A Spark session with the settings the engine expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    b = SparkSession.builder.appName("weftlink")
    if master:
        b = b.master(master)
    for k, v in (SETTINGS | conf).items():
        b = b.config(k, v)
    return b.config("spark.sql.shuffle.partitions", str(partitions or 2 * (os.cpu_count() or 4))).getOrCreate()
