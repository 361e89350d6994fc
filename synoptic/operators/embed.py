"""Text and vector similarity: TF-IDF, hybrid embeddings, exact cosine top-k in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Characters of a word that count, and vectors of a block.
PREFIX, BLOCK = 5, 2048


def terms(text: Column) -> Column:
    """Letters and digits apart, the first characters of each word, lower case."""
    return F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|\d+)"), 1), lambda w: F.substring(w, 1, PREFIX))


def tfidf(docs: DataFrame, key: str, text: str, stop_words: list[str] | None = None) -> DataFrame:
    """(key, term, tf, weight): tf * (ln((1 + n) / (1 + df)) + 1), each text's vector of length 1 (`weight`)."""
    words = docs.select(key, F.explode(terms(F.col(text))).alias("term"))
    if stop_words:
        words = words.where(~F.col("term").isin(stop_words))
    tf = words.groupBy(key, "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    n = docs.where(F.col(text).isNotNull()).agg(F.count("*").alias("n"))
    raw = tf.join(df, "term").crossJoin(F.broadcast(n)).withColumn("raw", F.col("tf") * (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1))
    norm = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
    return raw.join(norm, key).select(key, "term", "tf", "raw", (F.col("raw") / F.col("norm")).alias("weight"))


def cosine_top_k(queries: DataFrame, base: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(query, key, score, rank): the k nearest of `base` by cosine (to 9 digits, ties by key), exact. Queries are packed into
    blocks of matrices and every block meets every part of the base; each task keeps only its k best of a query. One block
    of queries goes to all tasks, of bounded size; more are met in pairs of partitions."""
    blocks_of = max(1, -(-queries.count() // BLOCK))
    packed = queries.where(F.col(vector).isNotNull()).select(F.col(key).alias("q"), F.col(vector).alias("v")).withColumn("b", F.floor(F.pmod(F.xxhash64("q"), F.lit(1 << 30)) / (1 << 30) * F.lit(blocks_of)))
    blocks = packed.groupBy("b").agg(F.collect_list(F.struct("q", "v")).alias("block"))
    parts = base.where(F.col(vector).isNotNull()).select(F.col(key).alias("id"), F.col(vector).alias("v"))
    parts = parts.withColumn("part", F.floor(F.monotonically_increasing_id() / BLOCK)).groupBy("part", F.spark_partition_id().alias("at")).agg(F.collect_list(F.struct("id", "v")).alias("rows")).select("rows")
    blocks = blocks.select("block")
    pairs = parts.crossJoin(F.broadcast(blocks) if blocks_of == 1 else blocks.hint("shuffle_replicate_nl"))

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for rows, block in zip(df["rows"], df["block"], strict=True):
                ids, q = np.array([r["id"] for r in rows]), np.array([r["q"] for r in block])
                unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-30)
                sim = unit(np.array([r["v"] for r in block], dtype=np.float64)) @ unit(np.array([r["v"] for r in rows], dtype=np.float64)).T
                sim = np.round(sim, 9)
                sim[q[:, None] == ids[None, :]] = -np.inf
                by_id = np.argsort(ids, kind="stable")  # then a stable sort by score leaves ties in the order of ids
                kept = by_id[np.argsort(-sim[:, by_id], axis=1, kind="stable")[:, :k]]
                i = np.repeat(np.arange(len(q)), kept.shape[1])
                scores = sim[i, kept.ravel()]
                ok = np.isfinite(scores)
                yield pd.DataFrame({"q": q[i][ok], "id": ids[kept.ravel()][ok], "score": scores[ok]})

    kind = base.schema[key].dataType.simpleString()
    found = pairs.mapInPandas(best, f"q {kind}, id {kind}, score double").withColumn("score", F.round("score", 9))
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(F.col("q").alias("query"), F.col("id").alias(key), "score", "rank")


def hashed(weights: DataFrame, key: str, size: int = 256) -> DataFrame:
    """(key, vector): sparse term weights (key, term, weight) as vectors of one size, each term at a place and with a sign
    by its hash, so that products are kept on average."""
    at, sign = F.pmod(F.xxhash64("term"), F.lit(size)).cast("int"), F.when(F.pmod(F.hash("term"), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    sums = weights.groupBy(key, at.alias("at")).agg(F.sum(F.col("weight") * sign).alias("w"))
    maps = sums.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("at", "w"))).alias("m"))
    return maps.select(key, F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("vector"))


def cosine(a: Column, b: Column) -> Column:
    """The cosine of two arrays."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def weighted_mean(a: Column, n: Column, b: Column, m: Column) -> Column:
    """The vector of two synsets that were merged: the mean, weighted by their members."""
    return F.zip_with(a, b, lambda x, y: (x * n + y * m) / (n + m))


def hybrid(df: DataFrame, parts: dict[str, float], out: str, width: int = 512) -> DataFrame:
    """Embeddings (vector columns, by weight), each reduced by PCA to min(width * weight, its own size), joined and
    brought to length 1."""
    from pyspark.ml.feature import PCA, Normalizer, VectorAssembler

    names = []
    for name, weight in parts.items():
        size = len(df.select(name).first()[0])
        k = max(1, min(int(width * weight), size))
        df = PCA(k=k, inputCol=name, outputCol=f"__{name}").fit(df).transform(df)
        names.append(f"__{name}")
    df = VectorAssembler(inputCols=names, outputCol="__all").transform(df)
    return Normalizer(inputCol="__all", outputCol=out).transform(df).drop("__all", *names)
