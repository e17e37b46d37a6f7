"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from tillmark.sources.paths import remove_path

# Runtime settings the jobs rely on. Sizes and partition counts are left to the cluster:
# adaptive execution coalesces and splits shuffle partitions from the bytes it measures.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even if the next grouping then needs a shuffle of its own: one
    # order or item may hold a large share of all lines.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keys are hashes in hex and ids with prefixes: half the size of what Snappy makes of them.
    "spark.sql.parquet.compression.codec": "zstd",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


# Size of the Bloom filter below: bits a key (one row in 50 passes in vain), and bits at most (32 MB).
BITS_A_KEY = 8
MOST_BITS = 1 << 28


@contextlib.contextmanager
def sifted_joins(spark: SparkSession, keys: int) -> Iterator[None]:
    """While open, the large side of a shuffled join is sifted by a Bloom filter of the other side's
    keys, about `keys` of them, before it is shuffled.

    Spark plans the filter by itself, where the keys' side is a filtered scan. What passes in vain
    still meets the join, so rows never depend on the filter; beyond its largest size more passes.
    """
    bits = min(MOST_BITS, max(1 << 13, BITS_A_KEY * keys))
    options = {
        "enabled": "true",
        "applicationSideScanSizeThreshold": "0",
        "creationSideThreshold": "1t",
        "expectedNumItems": str(max(1, keys)),
        "maxNumItems": str(max(1, keys)),
        "numBits": str(bits),
        "maxNumBits": str(bits),
    }
    with _set(spark, {f"spark.sql.optimizer.runtime.bloomFilter.{k}": v for k, v in options.items()}):
        yield


@contextlib.contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """While open, what a query shuffled leaves the disks when the query ends. By itself it lies there
    until the driver happens to collect its garbage, beside the shuffles of all queries since.

    For queries that run once; one that is run again shuffles again.
    """
    with _set(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


@contextlib.contextmanager
def _set(spark: SparkSession, options: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in options}
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path for intermediate tables, in the shared folder the cluster names.

    What lies there is removed when the program ends, as lazy results may read it until then.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = f"{shared.rstrip('/')}/tillmark/{purpose}-{uuid.uuid4().hex}"
    discard_at_exit(spark, path)
    return path


def discard_at_exit(spark: SparkSession, path: str) -> None:
    atexit.register(_discard, spark, path)


def _discard(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have been stopped
        remove_path(spark, path)


def materialized(df: DataFrame, path: str) -> DataFrame:
    """Writes an intermediate result that several consumers read, and reads it back.

    Files in shared storage outlive the executors that wrote them, and each reader fetches only
    the columns it needs.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
