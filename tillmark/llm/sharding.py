"""Sharding by rendezvous hashing, with weights and gapless slots.

Every shard draws a number for a record from the record's key and its own index alone; the record
goes to the shard whose weighted draw is best. Another shard can only win records, so growing from
n to n + 1 shards moves about one record in n + 1, and only into the new shard.

Defined cases: the null key is a key like any other; rows with equal keys share a shard, each with a
slot of its own. Texts of any length count whole; a null one has no bytes. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillmark.llm.store import Store


def _draw(key: Column, shard: int, weight: float) -> Column:
    """Logarithm of a uniform number in (0, 1) over the weight: largest for the winner."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11)
    return F.log((bits.cast("double") + F.lit(0.5)) * F.lit(2.0**-53)) / F.lit(float(weight))


def rendezvous(key: Column, shards: int, weights: Sequence[float] | None = None) -> Column:
    """The shard of a key, 0 to shards - 1; a shard of twice the weight gets twice the keys."""
    weights = list(weights) if weights is not None else [1.0] * shards
    if shards < 1 or len(weights) != shards or min(weights) <= 0:
        raise ValueError("one positive weight per shard")
    name = F.coalesce(key.cast("string"), F.lit(""))
    # Prefixed, so that the null key and the empty one differ.
    name = F.concat(F.when(key.isNull(), "0").otherwise("1"), name)
    draws = [
        F.struct(_draw(name, s, w).alias("draw"), F.lit(s).alias("shard"))
        for s, w in enumerate(weights)
    ]
    best = draws[0] if shards == 1 else F.greatest(*draws)
    return best["shard"]


def with_slots(store: Store, rows: DataFrame, shard: str = "shard", slot: str = "slot",
               chunk: str = "__chunk") -> DataFrame:
    """Adds each row's place in its shard, 0, 1, 2, ... without gaps.

    Rows are numbered within (shard, chunk), where a chunk is what one task read, and shifted by
    the sizes of the shard's earlier chunks. No task holds more of a shard than one input split
    gave, whatever the keys. The rows are written first: chunks then stay as they are, also when
    a lost task is run again. A column named like `slot` is replaced; other columns stay, but for names
    that begin with two underscores, which are the operator's own.
    """
    held = store.hold(
        rows.withColumn(chunk, F.spark_partition_id())
        .withColumn(slot, F.monotonically_increasing_id()),
        "chunks",
    )
    sizes = held.groupBy(shard, chunk).agg(F.count(F.lit(1)).alias("__size"))
    before = W.partitionBy(shard).orderBy(chunk).rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(
        shard, chunk, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__first")
    )
    within = W.partitionBy(shard, chunk).orderBy(slot)
    return (
        held.withColumn(slot, F.row_number().over(within).cast("long") - 1)
        .join(starts, [shard, chunk])
        .withColumn(slot, F.col(slot) + F.col("__first"))
        .drop(chunk, "__first")
    )


def write_shards(docs: DataFrame, path: str, key: str, shards: int,
                 weights: Sequence[float] | None = None, column: str = "shard") -> None:
    """Writes one folder per shard. Rebalancing splits a large shard over many tasks and files."""
    (
        docs.withColumn(column, rendezvous(F.col(key), shards, weights))
        .hint("rebalance", column)
        .write.mode("overwrite")
        .partitionBy(column)
        .parquet(path)
    )


def shard_documents(docs: DataFrame, shards: int = 24, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Each document's shard by key, its slot there, and its shard after adding one.

    `size` is the text's bytes in UTF-8 plus 8; a null text has none and a CRC-32 of 0.
    """
    store = Store(docs.sparkSession, "shards")
    k = F.col(key)
    rows = docs.select(
        k.alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(k, shards).alias("shard"),
        rendezvous(k, shards + 1).alias("grown_shard"),
    )
    return with_slots(store, rows).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
