"""Streams: incremental refresh of a list, and windows over events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from synoptic.operators.changes import upsert


def event_stream(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:  # noqa: ANN001
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) of each window; events later than `late` are left out."""
    source = events.withWatermark("ts", late) if events.isStreaming else events
    return source.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    source = events.withWatermark("ts", late) if events.isStreaming else events
    return source.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")


def _manifest(spark: SparkSession, target: str, number: int) -> dict[int, int] | None:
    """Which version of each bucket counts after a batch; None where there is no such batch."""
    path = f"{target}/manifest/{number}"
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return None
    return {r["bucket"]: r["version"] for r in spark.read.schema("bucket int, version bigint").json(path).collect()}  # a row a bucket


def _buckets(spark: SparkSession, target: str, versions: dict[int, int], schema) -> DataFrame | None:  # noqa: ANN001
    paths = [f"{target}/data/version={v}/bucket={b}" for b, v in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else None


def latest_rows(spark: SparkSession, target: str, schema, number: int) -> DataFrame:  # noqa: ANN001
    """What `keep_latest` holds after batch `number`."""
    versions = _manifest(spark, target, number)
    if versions is None:
        raise FileNotFoundError(f"{target} has no batch {number}")
    rows = _buckets(spark, target, versions, schema)
    return rows if rows is not None else spark.createDataFrame([], schema)


def keep_latest(updates: DataFrame, target: str, key: list[str], order: list[str], checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Keeps `target` at the last version of each key. Rows lie in buckets by a hash of the key, and a batch writes only the
    buckets that it touches, beside the old ones; then a manifest says which version of each bucket counts. A batch that is
    run again starts from the same manifest and gives the same result; a missing one is an error."""

    def apply(batch: DataFrame, number: int) -> None:
        spark, schema = batch.sparkSession, batch.schema
        before = _manifest(spark, target, number - 1) if number else {}
        if before is None:
            raise FileNotFoundError(f"{target} has no batch {number - 1}")
        new = batch.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # at most `buckets`
        old = _buckets(spark, target, {b: before[b] for b in touched if b in before}, schema)
        old = new.limit(0) if old is None else old.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))
        upsert(old, new, key, order).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/data/version={number}")
        after = {**before, **dict.fromkeys(touched, number)}
        spark.createDataFrame(sorted(after.items()), "bucket int, version bigint").coalesce(1).write.mode("overwrite").json(f"{target}/manifest/{number}")

    return updates.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
