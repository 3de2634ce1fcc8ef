"""Helpers shared by the operators: words, shared-folder tables, connected components."""

from __future__ import annotations

import ctypes
import gc
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentsift.session import ensure_checkpoint_dir, ship_package

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_RUN))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def word_hashes(text: Column) -> Column:
    """One 64-bit hash per word, computed in the JVM."""
    return F.transform(words(text), lambda w: F.xxhash64(w))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: ends the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sentsift-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete a table made by ``cut`` that no later plan reads."""
    spark = df.sparkSession
    jvm = spark._jvm
    for f in {p.rsplit("/", 1)[0] for p in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(f)
        if path.getName().startswith("sentsift-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let the driver collect finished plans, so that their shuffle files leave the executors' disks."""
    gc.collect()
    spark._jvm.System.gc()


#: Spark's own Bloom filters before a shuffle join: of at most 8 MB, whatever the join's sides hold.
BLOOM = {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "1t",
         "expectedNumItems": "4000000", "numBits": str(1 << 26)}
#: Spark builds a filter only from a filtered side; this one holds for every id.
ANY_ID = f"doc_id >= {-2 ** 63}"


def tidy(run):
    """A batch function whose worker gives freed memory back after a partition; workers live on between stages."""
    def inner(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return inner


@contextmanager
def bloom_joins(spark: SparkSession):
    """Semi joins written inside drop most rows without a partner before they are shuffled; a full filter drops none."""
    keys = {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in BLOOM.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); component = smallest node reachable.

    Min-label propagation with pointer jumping; every round is a pair of joins and grouped minima on
    bounded rows, so a hub's neighbours are pre-aggregated before each shuffle. Tables of edges stay distributed.
    """
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
               .filter("a <> b").distinct(), name)
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                 .select("node", F.least("node", "m").alias("component")), name)
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node"))
                .agg(F.min("component").alias("near")))
        hop = labels.join(near, "node").select("node", F.col("component").alias("was"),
                                               F.least("component", "near").alias("step"))
        up = labels.select(F.col("node").alias("step"), F.col("component").alias("up"))
        new = cut(hop.join(up, "step", "left")
                  .select("node", "was", F.least("step", F.coalesce("up", "step")).alias("component")), name)
        changed = new.filter("component <> was").limit(1).count()
        drop_cut(labels)
        labels = new.select("node", "component")
        if not changed:
            drop_cut(both)
            return labels
