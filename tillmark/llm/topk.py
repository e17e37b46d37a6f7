"""Exact top-k search by three phases with a uniform threshold.

A score is the sum of partial scores over `lists` groups of dimensions, each of which ranks all
rows. Phase 1 gathers the head of every local list with the totals of its entries; the k-th best
total of a query is a safe cutoff, since k rows reach it. Phase 2 broadcasts it: a row whose
partial scores all lie under cutoff / lists can't reach the cutoff, so only list entries at or
above that are sufficient. Phase 3 resolves the totals of those rows exactly and keeps the best.

Both passes compute the partial scores of every row in every list, as nothing keeps lists in order;
the threshold spares totals, not products.

The lists of a row lie in one task, so totals need no exchange; what leaves a task is at most
`k` rows per query and list. Queries come in blocks of bounded size, each against all rows.

Defined cases: vectors that are null or hold a null or non-finite component take no part; a
shorter vector counts as padded with zeros. A query isn't compared with rows of its own id. Of
several rows with one query id the smallest vector that takes part asks. Totals are exact within 64 bits.
Equal scores go to the smaller id; repeated candidates are rows of their own. An empty table gives no
rows. Columns beside id and vector, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillmark.llm.store import Store

CELLS = 1 << 21  # scores held at once, in one list
HEADS = "query int, id long, score long"


def scaled(batch: pa.RecordBatch, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and floor(scale * x) of the rows that take part."""
    column = batch["vector"]
    ids = batch["id"]
    usable = column.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(
        zero_copy_only=False
    )
    lengths = np.where(usable, column.value_lengths().fill_null(0).to_numpy(), 0)
    width = int(lengths.max(initial=0))
    values = column.flatten().cast(pa.float64())
    flat = values.to_numpy(zero_copy_only=False)  # null as NaN
    if len(flat) != lengths.sum():  # a null row may hide values
        column = pa.array(column.to_pylist(), pa.list_(pa.float64()))
        flat = column.flatten().to_numpy(zero_copy_only=False)
        keep = np.repeat(usable, column.value_lengths().fill_null(0).to_numpy())
        flat = flat[keep]
    dense = np.zeros((len(batch), width))
    dense[np.arange(width) < lengths[:, None]] = flat
    usable &= np.isfinite(dense).all(axis=1)
    return ids.to_numpy(zero_copy_only=False)[usable].astype(np.int64), np.floor(dense[usable] * scale)


def aligned(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without the dimensions that one of them lacks: those add nothing."""
    width = min(a.shape[1], b.shape[1])
    return a[:, :width], b[:, :width]


def partial_scores(rows: np.ndarray, queries: np.ndarray, lists: int) -> list[np.ndarray]:
    """Inner products over each group of dimensions, rows x queries, exact."""
    most = np.abs(rows).max(initial=0) * np.abs(queries).max(initial=0) * max(1, rows.shape[1])
    kind = np.float64 if most < 2**53 else np.int64  # floats are exact up to there, and fast
    rows, queries = rows.astype(kind), queries.astype(kind)
    groups = np.array_split(np.arange(rows.shape[1]), lists)
    return [(rows[:, g] @ queries[:, g].T).astype(np.int64) for g in groups]


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best entries, ties to the smaller id."""
    order = np.lexsort((ids, -score, query))
    sorted_query = query[order]
    first = np.searchsorted(sorted_query, sorted_query, side="left")
    return order[np.arange(len(order)) - first < k]


class _Entries:
    """The best entries per query so far."""

    def __init__(self, k: int):
        self.k = k
        self.query = self.ids = self.score = np.empty(0, np.int64)

    def add(self, query, ids, score) -> None:
        query, ids, score = (
            np.concatenate(x)
            for x in ((self.query, query), (self.ids, ids), (self.score, score))
        )
        keep = best(query, ids, score, self.k)
        self.query, self.ids, self.score = query[keep], ids[keep], score[keep]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.query, pa.int32()), pa.array(self.ids), pa.array(self.score)],
            names=["query", "id", "score"],
        )


def _blocks(batches, queries, lists, scale):
    """(ids, partial scores, own) of the rows of a task, a bounded number at a time."""
    query_ids, query_vectors = queries
    step = max(64, CELLS // max(1, len(query_ids)))
    for batch in batches:
        for start in range(0, len(batch), step):
            ids, rows = scaled(batch.slice(start, step), scale)
            if len(ids):
                parts = partial_scores(*aligned(rows, query_vectors), lists)
                yield ids, parts, ids[:, None] == query_ids[None, :]


def _heads(queries, k, lists, scale):
    """Phase 1: the heads of the local lists, each entry once, with its total."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = _Entries(k * lists)
        floor = np.iinfo(np.int64).min
        for ids, parts, own in _blocks(batches, queries.value, lists, scale):
            chosen = np.zeros(own.shape, bool)
            n = min(k, len(ids))
            for part in parts:
                ranked = np.where(own, floor, part)
                top = np.argpartition(ranked, len(ids) - n, axis=0)[len(ids) - n:]
                np.put_along_axis(chosen, top, True, axis=0)
            row, query = np.nonzero(chosen & ~own)
            heads.add(query, ids[row], sum(part[row, query] for part in parts))
        yield heads.batch()

    return run


def _resolved(queries, cutoffs, k, lists, scale):
    """Phases 2 and 3: entries at or above the uniform threshold, their totals resolved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutoff = cutoffs.value
        threshold = -(-cutoff // lists)  # a partial score below can't lift a total to the cutoff
        found = _Entries(k)
        for ids, parts, own in _blocks(batches, queries.value, lists, scale):
            sufficient = parts[0] >= threshold
            for part in parts[1:]:
                sufficient |= part >= threshold
            row, query = np.nonzero(sufficient & ~own)
            total = sum(part[row, query] for part in parts)
            keep = total >= cutoff[query]
            found.add(query[keep], ids[row[keep]], total[keep])
        yield found.batch()

    return run


def _usable(vector: Column) -> Column:
    """Whether a vector takes part: null components would be the smallest ones."""
    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    return F.coalesce(F.forall(vector, finite), F.lit(False))


def exact_top_k(vectors: DataFrame, is_query: Column, id: str = "vec_id",
                vector: str = "embedding", k: int = 5, lists: int = 4, scale: int = 256,
                block: int = 4096) -> DataFrame:
    """The k rows of highest inner product for every query row: query_id, rank, vec_id, score.

    `lists` is the number of dimension groups; `block` bounds the queries that are broadcast at
    once (their number times the width of a vector, so a few MB).
    """
    spark = vectors.sparkSession
    context = spark.sparkContext
    rows = vectors.select(
        F.col(id).cast("long").alias("id"), F.col(vector).alias("vector"),
        is_query.alias("asks"),
    )
    asking = (
        rows.filter("asks").filter(_usable(F.col("vector"))).groupBy("id")
        .agg(F.min("vector").alias("vector"))
    )
    blocks = max(1, -(-asking.count() * 2 // block))  # half full, so none is over by chance
    store = Store(spark, "topk")
    out = None
    for number in range(blocks):
        part = asking.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number)
        queries = _gathered(part, scale)
        if not len(queries[0]):
            continue
        shared = context.broadcast(queries)
        candidates = rows.select("id", "vector")
        heads = candidates.mapInArrow(_heads(shared, k, lists, scale), HEADS)
        place = W.partitionBy("query").orderBy(F.desc("score"))
        kth = (
            heads.withColumn("place", F.row_number().over(place)).filter(F.col("place") == k)
        ).select("query", "score").toArrow()
        # Without k heads there aren't k candidates: then every one is sufficient.
        cutoff = np.full(len(queries[0]), -(2**62), np.int64)
        cutoff[kth["query"].to_numpy()] = kth["score"].to_numpy()
        top = candidates.mapInArrow(
            _resolved(shared, context.broadcast(cutoff), k, lists, scale), HEADS
        )
        place = W.partitionBy("query").orderBy(F.desc("score"), "id")
        names = spark.createDataFrame(
            pa.table({"query": pa.array(range(len(queries[0])), pa.int32()),
                      "query_id": pa.array(queries[0])})
        )
        top = (
            top.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
            .join(names, "query")
            .select("query_id", F.col("rank").cast("int").alias("rank"),
                    F.col("id").alias("vec_id"), "score")
        )
        out = top
        store.add(top, "found")
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return store.read("found", out)


def _gathered(queries: DataFrame, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """One block of queries: ids and scaled vectors."""
    table = queries.select("id", "vector").toArrow().combine_chunks()
    batches = table.to_batches()
    if not batches:
        return np.empty(0, np.int64), np.empty((0, 0))
    return scaled(batches[0], scale)
