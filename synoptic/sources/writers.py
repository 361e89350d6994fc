"""Sinks: mapping tables, triples as text, listings, name lookups, warnings. Writes are partitioned, never collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from synoptic.operators.publish import n_triples


def triples(df: DataFrame, path: str) -> None:
    df.select(n_triples(df).alias("value")).write.mode("overwrite").text(path)


def mappings(df: DataFrame, path: str) -> None:
    df.write.mode("append").partitionBy("subject_source", "object_source").parquet(path)


def listing(df: DataFrame, path: str) -> None:
    """term;level;label, in the order of the paths: range-partitioned, so part files follow one another."""
    df.repartitionByRange("path").sortWithinPartitions("path").select("id", "level", "label").write.mode("overwrite").csv(path, sep=";", quoteAll=True)


def lookup(df: DataFrame, path: str) -> None:
    df.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").json(path)


def warnings(df: DataFrame, path: str) -> None:
    df.groupBy("warning").agg(F.count("*").alias("n")).write.mode("overwrite").json(f"{path}/summary")
    df.write.mode("overwrite").partitionBy("warning").json(f"{path}/rows")


def candidates(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def split(instruments: DataFrame, rest: DataFrame, path: str) -> None:
    instruments.write.mode("overwrite").parquet(f"{path}/instruments")
    rest.write.mode("overwrite").parquet(f"{path}/facilities")
