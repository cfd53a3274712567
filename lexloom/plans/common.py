"""Registering queries with the SQL that they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores where its files give fewer splits than would keep them busy: taking texts apart
    costs far more than dealing them. Tables of many splits, as large ones are, stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < 2 * cores else df


def add(queries: dict, oracles: dict) -> Callable:
    """A decorator that files a query, and its SQL where there is some, under the function's name."""

    def with_sql(sql: str | None) -> Callable:
        def register(f: Callable) -> Callable:
            queries[f.__name__] = f
            if sql:
                oracles[f.__name__] = sql
            return f

        return register

    return with_sql
