"""Versions of a list: differences, refreshes, fixes, and facts that supersede one another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _hash(cols: list[str]) -> Column:
    return F.xxhash64(*[F.coalesce(F.to_json(F.struct(F.col(c))), F.lit("null")) for c in cols])


def diff(old: DataFrame, new: DataFrame, key: str, content: list[str]) -> DataFrame:
    """(key, change): added, deleted, updated or unchanged, by a hash of the content."""
    a, b = old.select(key, _hash(content).alias("h1")), new.select(key, _hash(content).alias("h2"))
    change = F.when(F.col("h1").isNull(), "added").when(F.col("h2").isNull(), "deleted").when(F.col("h1") != F.col("h2"), "updated").otherwise("unchanged")
    return a.join(b, key, "full").select(key, change.alias("change"))


def refreshed(old: DataFrame, new: DataFrame, key: str, content: list[str], now: Column) -> DataFrame:
    """(key, content, modified, deprecated) of a list after it was read again: rows that are new or differ are stamped with
    `now`, unchanged ones keep their time, and those that are gone stay, marked as deprecated. `old` has modified and
    may have deprecated."""
    was = F.col("o.deprecated") if "deprecated" in old.columns else F.lit(False)
    a, b = old.withColumn("__a", _hash(content)).alias("o"), new.withColumn("__b", _hash(content)).alias("n")
    both = a.join(b, F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
    gone, same = F.col("__b").isNull(), F.col("__a") == F.col("__b")
    modified = F.when(same & ~F.coalesce(was, F.lit(False)), F.col("o.modified")).when(gone & F.coalesce(was, F.lit(False)), F.col("o.modified")).otherwise(now)
    return both.select(F.coalesce(f"o.{key}", f"n.{key}").alias(key), *[F.when(gone, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in content], modified.alias("modified"), gone.alias("deprecated"))


def newer_keys(old: DataFrame, new: DataFrame, key: str, modified: str) -> DataFrame:
    """Rows of `new` whose key is new or modified later."""
    known = old.groupBy(key).agg(F.max(modified).alias("__was"))
    return new.join(known, key, "left").where(F.col("__was").isNull() | (F.col(modified) > F.col("__was"))).drop("__was")


def latest(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last version of each key, by columns in order: one aggregate, no sort of a group."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*key, "__r.*")


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Both, the new row where a key is in both, and the later one where it is repeated."""
    both = old.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)))
    return latest(both, key, ["__side", *order]).drop("__side")


def patched(rows: DataFrame, key: str, fixes: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with fixes (action add, rename, update or delete; key; new_key; columns...) applied in that order. A rename to
    a key that exists merges into it: what that row has stays."""
    by = lambda a: fixes.where(F.col("action") == a)
    out = rows.select(key, *columns).unionByName(by("add").select(key, *columns))
    renamed = by("rename").groupBy(key).agg(F.max("new_key").alias("new_key"))
    out = out.join(renamed, key, "left").withColumn("__moved", F.col("new_key").isNotNull()).withColumn(key, F.coalesce("new_key", key)).drop("new_key")
    # max_by ignores the rows whose order is null: each column takes its value from the row that stayed, if it has one.
    out = out.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), ~F.col("__moved"))).alias(c) for c in columns])
    changes = by("update").groupBy(key).agg(*[F.max(c).alias(f"__{c}") for c in columns])
    out = out.join(changes, key, "left").select(key, *[F.coalesce(f"__{c}", c).alias(c) for c in columns])
    return out.join(by("delete").select(key).distinct(), key, "left_anti")


def superseded(facts: DataFrame, key: list[str], fact_id: str, date: str, bucket: Column) -> DataFrame:
    """Each fact with what it replaces and what replaces it; only the last of its key is not deprecated.

    `bucket` grows with the date (a month, say): facts are ordered within a bucket, and buckets by their first and last
    fact, so that no task sorts all facts of one key."""
    rows = facts.withColumn("__b", bucket)
    within, across = Window.partitionBy(*key, "__b").orderBy(date, fact_id), Window.partitionBy(*key).orderBy("__b")
    ends = rows.groupBy(*key, "__b").agg(F.min_by(fact_id, F.struct(date, fact_id)).alias("__first"), F.max_by(fact_id, F.struct(date, fact_id)).alias("__last"))
    ends = ends.select(*key, "__b", F.lag("__last").over(across).alias("__before"), F.lead("__first").over(across).alias("__after"))
    near = rows.withColumn("__p", F.lag(fact_id).over(within)).withColumn("__n", F.lead(fact_id).over(within)).join(ends, [*key, "__b"], "left")
    out = near.withColumn("replaces", F.coalesce("__p", "__before")).withColumn("replaced_by", F.coalesce("__n", "__after"))
    return out.withColumn("deprecated", F.col("replaced_by").isNotNull()).drop("__b", "__p", "__n", "__before", "__after")
