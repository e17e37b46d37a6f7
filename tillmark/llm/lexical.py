"""Ranked lexical search by pipelined term partitioning.

Terms are runs of ASCII digits and letters, A-Z in lower case, and of all characters beyond ASCII.

1. Index. One pass over the documents cuts each task's rows into blocks of bounded number and
   bytes, sorted by id, and writes per block and term the places of the documents that hold it, with
   occurrences and document length. Terms that no item asks for are left out: by a broadcast set
   while the items' vocabulary is at most `most_terms` large, by a join beyond.
2. Owners. Each term belongs to the stage that owns its weight: the rarest terms come first, the terms
   that nearly all documents hold come last.
3. Pipeline. Items go in bundles of bounded size. A bundle carries sparse accumulators, scores by item
   and document, through the stages one after the other: in each it is cogrouped, block by block,
   with the postings of the terms that the stage owns, and their integer contributions are added.
4. Between stages the k-th best score so far of an item is its cutoff, a score that the k-th of the
   result reaches. An accumulator that can't reach it any more, given the largest contributions of
   the terms still to come, is dropped, and once a document that is new could not, none is added.
   Both are exact: dropped documents lie below the result's k-th.
5. Selection: each block's k best of an item, then the k best of these.

A cogroup holds one bundle's terms in one block, whatever a term's frequency; no accumulator and no
document's id passes through the driver. Every stage is written before the next reads it.

Defined cases: a null text has no terms and is no document of the count; each row counts as a
document, repeated rows and ids too. Rows of one id that score alike come in any order. A null
document id comes after all others. An item without terms has no rows. Of several items with one id the
smallest text counts; a null id is an id. Very long texts are a block of their own. Without documents or
items there are no rows. Columns beside id and text, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tillmark.llm.batches import LOWER, bounded, pieces, utf8
from tillmark.llm.store import Store

# Bytes of a term after lower-casing; all others separate terms.
_TERM = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_SPLIT = bytes(b if b in _TERM else 0x20 for b in LOWER)

INDEX = (
    "kind string, block long, term binary, holders long, most long, shortest long, places binary,"
    " times binary, lengths binary, ids array<long>, terms long"
)
ASKED = "item long, term binary, times long"
CARRIED = "bundle int, block long, item long, places binary, scores binary, heads array<long>"
FOUND = "item long, block long, place int, score long"
BLOCK_ROWS = 4096
BUNDLE = 2048  # pairs of item and term that a bundle should hold


def terms(text: bytes) -> list[bytes]:
    return text.translate(_SPLIT).split()


def damped(length: np.ndarray, documents: int, all_terms: int) -> np.ndarray:
    """m: a hundred for a document of average length, more for longer ones."""
    return 100 - 75 + (75 * length * documents) // all_terms


def impact(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + 8 * m)


# ---- index -----------------------------------------------------------------------------------


class _Block:
    """Documents of one task, a bounded number."""

    def __init__(self, wanted: dict[bytes, int] | None, most_bytes: int):
        self.wanted, self.most_bytes = wanted, most_bytes
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.numbers: list[np.ndarray] = []
        self.bytes = 0
        self.names: dict[bytes, int] = {} if wanted is None else wanted

    def add(self, id: int | None, text: bytes) -> None:
        found = terms(text)
        if self.wanted is None:
            numbers = [self.names.setdefault(t, len(self.names)) for t in found]
        else:
            numbers = [n for n in map(self.names.get, found) if n is not None]
        self.ids.append(id)
        self.lengths.append(len(found))
        self.numbers.append(np.array(numbers, np.int64))
        self.bytes += len(text)

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_ROWS or self.bytes >= self.most_bytes

    def batch(self, block: int) -> pa.RecordBatch:
        """One row per term, and one about the documents."""
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i] or 0))
        ids = [self.ids[i] for i in order]
        lengths = np.array([self.lengths[i] for i in order], np.int64)
        numbers = [self.numbers[i] for i in order]
        places = np.repeat(np.arange(len(ids)), [len(n) for n in numbers])
        pairs = np.concatenate(numbers) * BLOCK_ROWS + places
        pairs, times = np.unique(pairs, return_counts=True)
        number, place = np.divmod(pairs, BLOCK_ROWS)
        starts = np.flatnonzero(np.diff(number, prepend=-1))
        ends = np.append(starts[1:], len(number))
        held = lengths[place]
        name = {n: t for t, n in self.names.items()} if len(starts) else {}
        rows = [
            ("term", block, name[int(number[s])], int(e - s), int(times[s:e].max()),
             int(held[s:e].min()), place[s:e].astype(np.int32).tobytes(),
             times[s:e].astype(np.int32).tobytes(), held[s:e].astype(np.int32).tobytes(), None, None)
            for s, e in zip(starts, ends)
        ]
        rows.append(("documents", block, None, int((lengths > 0).sum()), None, None, None, None,
                     None, ids, int(lengths.sum())))
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(),
                 pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64()]
        names = [c.split()[0] for c in INDEX.split(", ")]
        columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, names=names)


def _index(wanted, most_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if wanted is None else wanted.value
        first = TaskContext.get().partitionId() << 32
        written, block = 0, _Block(known, most_bytes)
        for batch in batches:
            for rows, texts in pieces(batch, batch["text"]):
                for id, text in zip(rows["id"].to_pylist(), utf8(texts)):
                    block.add(id, text)
                    if block.full():
                        yield block.batch(first + written)
                        written, block = written + 1, _Block(known, most_bytes)
        if block.ids:
            yield block.batch(first + written)

    return run


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An item's terms and how often it has them."""
    for batch in batches:
        for rows, texts in pieces(batch, batch["text"]):
            for id, text in zip(rows["item"].to_pylist(), utf8(texts)):
                found = Counter(terms(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([id] * len(found), pa.int64()), pa.array(list(found), pa.binary()),
                     pa.array(list(found.values()), pa.int64())],
                    names=["item", "term", "times"],
                )


class Index:
    """Postings of the asked terms by block, ids of the documents by block, and totals."""

    def __init__(self, store: Store, docs: DataFrame, vocabulary: DataFrame, most_terms: int,
                 block_bytes: int):
        spark = docs.sparkSession
        bounded(spark)
        wanted = None
        if vocabulary.count() <= most_terms:
            known = vocabulary.select("term").toArrow()["term"].to_pylist()
            wanted = spark.sparkContext.broadcast({bytes(t): n for n, t in enumerate(known)})
        index = docs.mapInArrow(_index(wanted, block_bytes), INDEX)
        index.write.partitionBy("kind").parquet(store.path("index"))
        held = store.read("index", index)
        self.postings = held.filter("kind = 'term'")
        if wanted is None:
            self.postings = self.postings.join(vocabulary, "term", "left_semi")
        self.blocks = held.filter("kind = 'documents'")
        totals = self.blocks.agg(F.sum("holders"), F.sum("terms")).first()
        self.documents, self.terms = (int(x or 0) for x in totals)


# ---- stages ----------------------------------------------------------------------------------


def _weights(store: Store, index: Index, asked: DataFrame, stages: int) -> DataFrame:
    """Per item and term: weight with repeats, the owning stage, and the most it can contribute."""
    found = index.postings.groupBy("term").agg(
        F.sum("holders").alias("holders"), F.max("most").alias("most"),
        F.min("shortest").alias("shortest"),
    )
    n = index.documents
    found = found.withColumn(
        "weight",
        F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("holders") + 1))).cast("long"),
    )
    top = float(np.log(2.0 * n + 2) * 1000)  # above every weight
    owner = F.least(F.floor(stages * (1 - F.col("weight") / top)), F.lit(stages - 1))
    # As if the document with most occurrences were the shortest: no posting contributes more.
    m = F.expr(f"100 - 75 + (75 * shortest * {n}L) div {max(1, index.terms)}L")
    bound = F.expr("(1000000000L * most) div (1000 * most + 8 * m)")
    about = found.withColumn("m", m).select(
        "term", "weight", F.greatest(owner, F.lit(0)).cast("int").alias("stage"),
        bound.alias("bound"),
    )
    return store.hold(
        asked.join(about, "term").select(
            "bundle", "item", "term", "stage", (F.col("times") * F.col("weight")).alias("weight"),
            (F.col("times") * F.col("weight") * F.col("bound")).alias("reach"),
        ),
        "weights",
    )


def _heads(scores: np.ndarray, k: int) -> np.ndarray:
    return -np.sort(-scores, kind="stable")[:k]


def carry(documents: int, all_terms: int, k: int):
    """One stage of one bundle in one block: accumulators and postings to accumulators."""

    def run(carried: pa.Table, postings: pa.Table) -> pa.Table:
        # item -> dense scores, the documents that have one, the cutoff, what may come after
        state: dict[int, tuple] = {}
        key = (carried if len(carried) else postings).select(["bundle", "block"]).slice(0, 1)
        (bundle,), (block,) = (key[c].to_pylist() for c in ("bundle", "block"))
        for row in carried.to_pylist():
            places = np.frombuffer(row["places"], np.int32)
            scores = np.zeros(BLOCK_ROWS, np.int64)
            held = np.zeros(BLOCK_ROWS, bool)
            scores[places] = np.frombuffer(row["scores"], np.int64)
            held[places] = True
            state[row["item"]] = scores, held, row["cutoff"], row["after"]
        columns = ["places", "times", "lengths", "askers"]
        for batch in postings.select(columns).to_batches(max_chunksize=256):
            for row in batch.to_pylist():
                places = np.frombuffer(row["places"], np.int32)
                lengths, times = (
                    np.frombuffer(row[c], np.int32).astype(np.int64) for c in ("lengths", "times")
                )
                value = impact(times, damped(lengths, documents, all_terms))
                for asker in row["askers"]:
                    mine = state.get(asker["item"])
                    if mine is None:
                        if not asker["opens"]:
                            continue  # no document of this block can come into its result
                        mine = state[asker["item"]] = (
                            np.zeros(BLOCK_ROWS, np.int64), np.zeros(BLOCK_ROWS, bool),
                            asker["cutoff"], asker["after"],
                        )
                    mine[0][places] += asker["weight"] * value
                    if asker["opens"]:
                        mine[1][places] = True
        rows = []
        for item, (scores, held, cutoff, after) in state.items():
            best = np.partition(scores[held], -k)[-k] if held.sum() >= k else 0
            there = np.flatnonzero(held & (scores + after >= max(cutoff, best)) & (scores + after > 0))
            if len(there):
                kept = scores[there]
                rows.append((bundle, block, item, there.astype(np.int32).tobytes(), kept.tobytes(),
                             _heads(kept, k).tolist()))
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        names = [c.split()[0] for c in CARRIED.split(", ")]
        columns = zip(*rows) if rows else [[]] * len(kinds)
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

    return run


def _cutoffs(carried: DataFrame, k: int) -> DataFrame:
    """The k-th best score so far of each item that has as many."""
    place = W.partitionBy("item").orderBy(F.desc("head"))
    return (
        carried.select("item", F.explode("heads").alias("head"))
        .withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= k)
        .filter(F.col("place") == k)
        .select("item", F.col("head").alias("cutoff"))
    )


def _selected(k: int):
    """The k best of each item in a block; places follow the ids, so ties are settled too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, blocks, places, scores = [], [], [], []
            for row in batch.to_pylist():
                place = np.frombuffer(row["places"], np.int32)
                score = np.frombuffer(row["scores"], np.int64)
                best = np.lexsort((place, -score))[:k]
                best = best[score[best] > 0]
                items += [row["item"]] * len(best)
                blocks += [row["block"]] * len(best)
                places += place[best].tolist()
                scores += score[best].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.int64()), pa.array(blocks, pa.int64()),
                 pa.array(places, pa.int32()), pa.array(scores, pa.int64())],
                names=["item", "block", "place", "score"],
            )

    return run


def _stage(spark: SparkSession, number: int, index: Index, weights: DataFrame,
           carried: DataFrame | None, k: int) -> DataFrame:
    """The accumulators after the stage of that number."""
    rest = weights.groupBy("item").agg(
        F.sum(F.when(F.col("stage") >= number, F.col("reach")).otherwise(0)).alias("before"),
        F.sum(F.when(F.col("stage") > number, F.col("reach")).otherwise(0)).alias("after"),
    )
    cutoffs = _cutoffs(carried, k) if carried is not None else spark.createDataFrame(
        [], "item long, cutoff long"
    )
    state = rest.join(cutoffs, "item", "left").fillna(0, ["cutoff"])
    asker = F.struct(
        "item", "weight", "cutoff", "after", (F.col("before") >= F.col("cutoff")).alias("opens")
    )
    askers = (
        weights.filter(F.col("stage") == number).join(state, "item")
        .groupBy("term", "bundle").agg(F.collect_list(asker).alias("askers"))
    )
    owned = index.postings.join(askers, "term").select(
        "bundle", "block", "places", "times", "lengths", "askers"
    )
    own = spark.createDataFrame([], CARRIED) if carried is None else carried
    own = own.drop("heads").join(state.select("item", "cutoff", "after"), "item").select(
        "bundle", "block", "item", "places", "scores", "cutoff", "after"
    )
    key = ["bundle", "block"]
    return own.groupBy(*key).cogroup(owned.groupBy(*key)).applyInArrow(
        carry(index.documents, max(1, index.terms), k), CARRIED
    )


def search(items: DataFrame, docs: DataFrame, item_id: str = "item_id", item_text: str = "text",
           doc_id: str = "doc_id", text: str = "text", k: int = 10, stages: int = 5,
           bundle: int = BUNDLE, most_terms: int = 1 << 20, block_bytes: int = 8 << 20) -> DataFrame:
    """The k best documents of each item: item_id, rank, doc_id, score.

    `bundle` is the number of pairs of item and term that a bundle should hold, `stages` that of owners.
    """
    spark = docs.sparkSession
    store = Store(spark, "lexical")
    texts = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(item_text).alias("text"))
    named = store.hold(
        texts.filter("text is not null").groupBy("item_id").agg(F.min("text").alias("text"))
        .withColumn("item", F.monotonically_increasing_id()),  # ids may be null
        "items",
    )
    asked = store.hold(named.select("item", "text").mapInArrow(_asked, ASKED), "asked")
    bundles = max(1, -(-asked.count() // bundle))
    asked = asked.withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int"))
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    index = Index(store, rows, asked.select("term").distinct(), most_terms, block_bytes)
    weights = _weights(store, index, asked, stages)
    carried = None
    for number in sorted(r.stage for r in weights.select("stage").distinct().collect()):
        before, carried = carried, store.hold(
            _stage(spark, number, index, weights, carried, k), f"stage-{number}"
        )
        if before is not None:
            store.drop(last)
        last = f"stage-{number}"
    if carried is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = carried.select("item", "block", "places", "scores").mapInArrow(_selected(k), FOUND)
    ids = index.blocks.select("block", F.posexplode("ids").alias("place", "doc_id"))
    place = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.join(ids, ["block", "place"])
        .withColumn("rank", F.row_number().over(place).cast("int"))
        .filter(F.col("rank") <= k)
        .join(named.select("item", "item_id"), "item")
        .select("item_id", "rank", "doc_id", "score")
    )
