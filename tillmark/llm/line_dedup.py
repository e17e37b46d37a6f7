"""Lines that many documents share, by levelled sorted runs of line hashes.

A line's key is the line without ASCII white space at both ends, A-Z in lower case. A run is a table
of key hashes and the number of documents that hold them, bucketed and sorted by hash. A batch of
documents comes as one hash per different key and document. It is counted, merge-anti-joined with
the settled part of every run (keys already known to be in enough documents need no more counting),
and added as a run of the lowest level. Whenever a level holds `fanout` runs, they are merged
into one of the next level, where counts add up and more keys settle. In the end all runs are
merged, and what is settled are the repeated keys.

Buckets of all runs hold the same hashes in the same order, so neither the anti-join nor the merging of
runs shuffles or sorts a run: only a batch's counted hashes are shuffled, 24 bytes per different
line, summed within tasks first, so a line in a third of all documents is one row per task. A key
has 128 bits of hash; two of 10**12 different keys share one with a chance of 2e-15.

The repeated lines' places are found by joining the documents' line hashes with the repeated keys, a join
that Spark broadcasts or sorts by their measured size. Places meet their texts again by a hash of id
and text: that shuffles the texts once, with keys of their own. All of it is SQL functions.

Defined cases: a null text is one empty line and stays null; an empty one is one empty line.
Keys shorter than `least_chars` are never dropped, so the empty key isn't. Each row counts as a
document, repeated rows and ids too. A line that a document repeats counts once, and all its
places go. Texts of any length are split whole. A document that loses all lines is empty. An
empty table gives no rows. Columns named like the operator's own (`n_lines`, `n_dropped`) are replaced.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.store import Store

BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["high", "low"]


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def keys(text: Column) -> Column:
    """The keys of a text's lines, in order."""
    return F.transform(lines(F.translate(text, UPPER, LOWER)), lambda x: F.btrim(x, F.lit(BLANKS)))


def _hashes(key: str) -> list[Column]:
    return [F.xxhash64(key).alias("high"), F.xxhash64(F.lit(1), key).alias("low")]


def hashed(docs: DataFrame, text: str, least_chars: int, *columns: Column) -> DataFrame:
    """One row per document and different key of at least that length: its hash, and `columns`."""
    each = docs.select(*columns, F.explode(F.array_distinct(keys(F.col(text)))).alias("_key"))
    names = [c for c in each.columns if c != "_key"]
    return each.filter(F.char_length("_key") >= least_chars).select(*names, *_hashes("_key"))


@contextlib.contextmanager
def _sorted_buckets(spark: SparkSession) -> Iterator[None]:
    """Lets plans rely on the order within buckets: every bucket of a run is one sorted file."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Runs:
    """Levelled runs of key hashes: high, low, docs, and whether the key is settled."""

    def __init__(self, store: Store, least_docs: int, fanout: int = 3):
        if fanout < 2 or least_docs < 1:
            raise ValueError("a level merges two runs at least, a key needs one document")
        self.store, self.spark = store, store.spark
        self.least, self.fanout = least_docs, fanout
        # As many buckets as a shuffle has partitions: then a task writes whole buckets.
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.written = 0

    def tables(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def settled(self) -> list[DataFrame]:
        return [run.filter("settled").select(*KEY) for run in self.tables()]

    def unsettled(self, batch: DataFrame) -> DataFrame:
        """A batch's hashes, counted, without those settled in a run."""
        rest = batch.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"))
        for run in self.settled():
            rest = rest.hint("merge").join(run.hint("merge"), KEY, "left_anti")
        return rest

    def add(self, batch: DataFrame) -> None:
        with _sorted_buckets(self.spark):
            self._write(self.unsettled(batch), 0)
            level = 0
            while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
                self._merge(level, level + 1)
                level += 1

    def merged(self, names: list[str]) -> DataFrame:
        # No selection on the single tables: it would hide from the plan that buckets match.
        all_rows = self.spark.table(names[0])
        for name in names[1:]:
            all_rows = all_rows.union(self.spark.table(name))
        return all_rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"))

    def _merge(self, lowest: int, into: int) -> None:
        names = [name for level in self.levels[lowest:into] for name in level]
        self._write(self.merged(names), into)
        for level in range(lowest, into):
            self.levels[level] = []
        for name in names:
            self._forget(name)

    def repeated(self) -> DataFrame:
        """The hashes of all keys in enough documents, after one last merge of all runs."""
        with _sorted_buckets(self.spark):
            if sum(map(len, self.levels)) > 1:
                self._merge(0, len(self.levels))
            parts = self.settled()
        if not parts:
            return self.spark.createDataFrame([], "high long, low long")
        return parts[0]

    def _write(self, counted: DataFrame, level: int) -> None:
        name = f"tillmark_lines_{uuid.uuid4().hex}"
        (
            counted.withColumn("settled", F.col("docs") >= self.least)
            .write.partitionBy("settled").bucketBy(self.buckets, *KEY).sortBy(*KEY)
            .option("path", self.store.path(name)).format("parquet").saveAsTable(name)
        )
        self.levels += [[] for _ in range(level + 1 - len(self.levels))]
        self.levels[level].append(name)
        self.written += 1

    def _forget(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.store.drop(name)

    def close(self) -> None:
        for level in self.levels:
            for name in level:
                self._forget(name)
        self.levels = []


def _row_key(id: str, text: str) -> list[Column]:
    """Equal for rows that are alike in id and text, and so in their lines."""
    return [F.xxhash64(id, text).alias("_row"), F.xxhash64(F.lit(1), id, text).alias("_row2")]


def repeated_places(docs: DataFrame, store: Store, id: str, text: str, least_docs: int,
                    least_chars: int, batches: int, fanout: int) -> DataFrame:
    """The places of repeated lines, from 0, of each document that has any: _row, _row2, _drop."""
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64(id, text), F.lit(batches)).cast("int").alias("batch")
    landed = hashed(docs, text, least_chars, batch)
    landed.write.partitionBy("batch").parquet(store.path("landed"))
    runs = Runs(store, least_docs, fanout)
    for number in range(batches):
        runs.add(store.read("landed", landed).filter(F.col("batch") == number))
    each = docs.select(*_row_key(id, text), F.posexplode(keys(F.col(text))).alias("_place", "_key"))
    each = each.filter(F.char_length("_key") >= least_chars).select(
        "_row", "_row2", "_place", *_hashes("_key")
    )
    places = each.join(runs.repeated(), KEY).groupBy("_row", "_row2").agg(
        F.collect_set("_place").alias("_drop")
    )
    held = store.hold(places, "places")
    runs.close()
    store.drop("landed")
    return held


def drop_repeated(docs: DataFrame, id: str = "doc_id", text: str = "text", least_docs: int = 10,
                  least_chars: int = 1, batches: int = 6, fanout: int = 3) -> DataFrame:
    """The documents without lines whose key at least `least_docs` documents hold.

    Adds `n_lines`, the lines before, and `n_dropped`. `batches` is the number of deliveries that the
    table is cut into, by a hash of id and text.
    """
    store = Store(docs.sparkSession, "lines")
    places = repeated_places(docs, store, id, text, least_docs, least_chars, batches, fanout)
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    keyed = docs.select(*columns, *_row_key(id, text))
    all_lines = lines(F.col(text))
    dropped = F.coalesce(F.size("_drop"), F.lit(0))
    # The set difference is linear and keeps the order, however many lines a text has.
    kept = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("_drop"))
    rest = F.array_join(F.transform(kept, lambda place: all_lines[place]), "\n")
    return keyed.join(places, ["_row", "_row2"], "left").select(
        *[F.when(dropped > 0, rest).otherwise(F.col(text)).alias(text) if c == text else F.col(f"`{c}`")
          for c in columns],
        F.size(all_lines).cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
    )


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    out = drop_repeated(docs.select("doc_id", "text"), **options)
    code = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return out.select("doc_id", "n_lines", "n_dropped", code.alias("kept_sha256"))
