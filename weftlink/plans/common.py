"""Tables of the queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def collector():
    """Two registries and a decorator that fills them."""
    queries, sqls = {}, {}

    def query(sql: str | None = None):
        def put(f):
            queries[f.__name__] = f
            if sql:
                sqls[f.__name__] = sql
            return f

        return put

    return queries, sqls, query
