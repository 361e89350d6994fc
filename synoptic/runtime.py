"""Session helpers: reading tables, cutting lineage through the shared folder, and distributed prefix sums."""

from __future__ import annotations

import atexit
import io
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset and all work is done in one process
    (tests), a folder of our own; elsewhere a folder of one machine would lose rows, so it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _own.get(spark.sparkContext.applicationId)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="synoptic-")
        _own[spark.sparkContext.applicationId] = folder
        atexit.register(shutil.rmtree, folder[7:], ignore_errors=True)
    return folder


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, unless they find it by themselves (PYTHONPATH or working folder)."""
    package = Path(__file__).resolve().parent
    context, root = spark.sparkContext, str(package.parent)
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or os.getcwd() == root or getattr(context, "_synoptic_shipped", False):
        return
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/synoptic-{uuid.uuid4().hex[:12]}.zip")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(packed.getvalue()))
    out.close()
    context.addPyFile(target.toString())
    context._synoptic_shipped = True


class Scratch:
    """Intermediate tables of one query, written to the shared folder, so that a lost executor costs no recomputation
    of what came before. Tables that a later step no longer reads are dropped at once, and so are the shuffle files of a
    step when its table is written; else they stay until the driver happens to collect its garbage."""

    CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.count = 0
        # What a result still reads is deleted when the driver ends.
        root = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(root)
        files.deleteOnExit(root)

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{self.count}"
        self.count += 1
        before = self.spark.conf.get(self.CLEAN, "false")
        self.spark.conf.set(self.CLEAN, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(self.CLEAN, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def write_in_passes(self, passes: int, step: Callable[[int], DataFrame]) -> DataFrame:
        """The rows of all passes, each written by itself: only one pass's shuffle files are there at a time."""
        parts = [self.write(step(i)) for i in range(passes)]
        out = reduce(DataFrame.union, parts)
        out._scratch_parts = parts
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in [x for t in tables for x in getattr(t, "_scratch_parts", [t])]:
            path = getattr(table, "_scratch_path", None)
            if path:
                target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def uniform(*cols: Column | str) -> Column:
    """A number in (0, 1) that depends only on the given values: recomputed tasks draw the same."""
    return (F.pmod(F.xxhash64(*cols), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))


def running_total(df: DataFrame, group: list[str], order: list[Column], bucket: Column, amount: Column, out: str) -> DataFrame:
    """Adds `out`: the sum of `amount` over all earlier rows of the group, in the order of (bucket, order).

    A group may hold a third of all rows, so no task sees a whole group: totals are made by (group, bucket) with partial
    aggregation, summed over the buckets of a group (as many rows as there are buckets), and only the rows of one bucket
    are sorted together. `bucket` must not decrease along the order that is wanted, or be part of it.
    """
    rows = df.withColumn("__b", bucket).withColumn("__n", amount)
    totals = rows.groupBy(*group, "__b").agg(F.sum("__n").alias("__t"))
    before = Window.partitionBy(*group).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("__s", F.coalesce(F.sum("__t").over(before), F.lit(0))).drop("__t")
    within = Window.partitionBy(*group, "__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn("__w", F.coalesce(F.sum("__n").over(within), F.lit(0)))
    return inner.join(starts, [*group, "__b"]).withColumn(out, F.col("__s") + F.col("__w")).drop("__b", "__n", "__s", "__w")
