"""Near-duplicate documents by SetSketch registers.

Words are what lies between ASCII white space, A-Z in lower case; a document's set are its distinct
shingles of `WORDS` words (the whole sequence, if it has fewer). Two documents are linked if the
Jaccard similarity of their sets is at least 3/4, and classes are what links connect.

1. Each text is read once: its set is hashed, and `REGISTERS` registers are kept, the minima of as
   many hash functions on a logarithmic scale of base `BASE`, rounded, which `RATE` shifts so that
   those of sets of any size, one shingle included, differ as they should. They merge by maximum. Rows
   and registers are written. Equal sets become one node, whatever their number.
2. Registers are banded in threes. A pair at the threshold shares one of the bands but for a
   chance of 3e-8 (0.578 to the power 32), a closer pair still more surely.
3. In a band's bucket every node is compared with the lowest one only, a number of pairs linear in
   the bucket. The registers of a pair and both set sizes give its similarity by maximum
   likelihood; pairs that fall short by more than five standard errors go. The rest is confirmed
   on the full sets. Links connect nodes into components.
4. What remains is pairs of one bucket in different components. Buckets with such pairs are cut
   into tiles of bounded size; tiles inside the largest component are left out. In each tile the
   likelihood estimate picks pairs (in the first band that a pair shares, so once), the full sets
   of the documents in these pairs are fetched, and the pairs are confirmed. New links join
   components. No bucket is capped.

No task holds a bucket, and no pair is sought between nodes that are already connected. Joins are
between written tables, whose skewed sides Spark splits.

Defined cases: null and empty texts, or such without words, have an empty set and are linked with
nothing; their component is their own id. Very long texts are read whole. An empty table gives no rows.
Repeated rows are copies. The component's id is the
smallest non-null id in it, null if there is none, and `kept` compares null-safely.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.batches import LOWER, bounded, extended, pieces, utf8
from tillmark.llm.graph import components
from tillmark.llm.store import Store

WORDS = 5
LEAST, OF = 75, 100  # 100 * intersection >= 75 * union
REGISTERS, ROWS = 96, 3
BANDS = REGISTERS // ROWS
BASE = 1.001
RATE = 32.0  # the largest h, of the largest 32-bit hash, is 23
TILE = 1024
# Five standard errors of the estimate at the threshold.
CUT = LEAST / OF - 5 * (LEAST / OF * (1 - LEAST / OF) / REGISTERS) ** 0.5

# ---- sets ------------------------------------------------------------------------------------


class _WordHashes(dict):
    """Hashes of words, remembered; of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 18:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()
_MIX, _END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_32, _29 = np.uint64(32), np.uint64(29)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles."""
    found = text.translate(LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.array(list(map(_HASHES.__getitem__, found)), np.uint64)
    length = min(words, len(hashes))
    starts = len(hashes) - length + 1
    value = np.full(starts, length, np.uint64)  # a short text equals no shingle
    for i in range(length):
        value = ((value ^ (value >> _29)) * _MIX) + hashes[i:i + starts]
    value ^= value >> _32
    value *= _END
    value ^= value >> _32
    return np.unique(value)


# ---- registers -------------------------------------------------------------------------------

_FACTORS = (
    np.random.default_rng(20250101).integers(0, 2**32, REGISTERS, np.uint64) | 1
).astype(np.uint32)


def registers(hashes: np.ndarray) -> np.ndarray:
    """floor(1 - log_b(h / a)) of the least h per hash function, h exponentially distributed; a is
    `RATE`, above all values of h, so no register of any set is cut off below."""
    values = (hashes >> _32).astype(np.uint32)
    least = np.full(REGISTERS, 2**32 - 1, np.uint32)
    for start in range(0, len(values), 2048):
        part = values[start:start + 2048, None] * _FACTORS
        np.minimum(least, part.min(axis=0), out=least)
    uniform = (least + 0.5) / 2.0**32
    level = np.floor(1 - np.log(-np.log1p(-uniform) / RATE) / np.log(BASE))
    return np.clip(level, 0, 2**16 - 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def _share(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


_GRID = np.linspace(0, 1, 81)


def similarity(above: np.ndarray, below: np.ndarray, n_a: np.ndarray, n_b: np.ndarray
               ) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs, from how many registers of the first are
    above and below those of the second and from both set sizes."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)
    best, at = np.full(len(u), -np.inf), np.zeros(len(u))
    for step in _GRID:
        j = step * most
        p, q = _share(u - v * j), _share(v - u * j)
        tiny = 1e-12
        fit = (
            above * np.log(np.maximum(p, tiny)) + below * np.log(np.maximum(q, tiny))
            + (REGISTERS - above - below) * np.log(np.maximum(1 - p - q, tiny))
        )
        better = fit > best
        best[better], at[better] = fit[better], j[better]
    return at


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two full sets are linked."""
    if LEAST * max(len(a), len(b)) > OF * min(len(a), len(b)):
        return False
    common = len(a) + len(b) - len(np.union1d(a, b))
    return OF * common >= LEAST * (len(a) + len(b) - common)


# ---- step 1 ----------------------------------------------------------------------------------

SKETCHED = "key binary, n long, sketch binary"


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in pieces(batch, batch["text"]):
            keys, sizes, sketches = [], [], []
            for text in utf8(texts):
                found = shingles(text)
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found) if len(found) else None)
                sketches.append(registers(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [rows["row"], rows["text"], pa.array(keys, pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())],
                names=["row", "text", "key", "n", "sketch"],
            )


# ---- steps 3 and 4 ---------------------------------------------------------------------------


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both sketches, those that may reach the threshold."""
    for batch in batches:
        if not len(batch):
            continue
        a, b = _matrix(batch["sketch_a"]), _matrix(batch["sketch_b"])
        estimate = similarity(
            (a > b).sum(axis=1), (a < b).sum(axis=1),
            batch["n_a"].to_numpy(), batch["n_b"].to_numpy(),
        )
        kept = batch.filter(pa.array(estimate >= CUT))
        yield kept.select(["a", "b"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both texts' sets, the linked ones."""
    for batch in batches:
        pairs = zip(batch["set_a"].to_pylist(), batch["set_b"].to_pylist())
        found = [alike(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in pairs]
        yield batch.filter(pa.array(found, pa.bool_())).select(["a", "b"])


def _by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one tile at a time, from batches sorted by tile."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not len(batch):
            continue
        ids = np.stack([batch[c].to_numpy() for c in ("band", "i", "j")])
        edges = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
        for start, stop in zip([0, *edges], [*edges, len(batch)]):
            tile = tuple(ids[:, start])
            if tile != now and held:
                yield pa.Table.from_batches(held)
                held = []
            now = tile
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each tile, the nodes of pairs that may reach the threshold; a left node with its
    partners. Only pairs of different components, in the first band that they share."""
    for tile in _by_tile(batches):
        tile = tile.combine_chunks().to_batches()[0]
        node, component, n = (tile[c].to_numpy() for c in ("node", "component", "n"))
        left, right = (tile[c].to_numpy(zero_copy_only=False) for c in ("is_left", "is_right"))
        sketch = _matrix(tile["sketch"])
        band = tile["place"][0].as_py()
        rights = np.flatnonzero(right)
        partners: dict[int, list[int]] = {}
        lefts = np.flatnonzero(left)
        step = max(1, (1 << 23) // max(1, len(rights) * REGISTERS))
        for start in range(0, len(lefts), step):
            ls = lefts[start:start + step]
            a, b = sketch[ls][:, None, :], sketch[rights][None, :, :]
            equal = (a == b).reshape(len(ls), len(rights), BANDS, ROWS).all(axis=3)
            first = equal.argmax(axis=2) == band
            both = right[ls][:, None] & left[rights][None, :]  # each pair once
            fresh = component[ls][:, None] != component[rights][None, :]
            fresh &= ~both | (node[ls][:, None] < node[rights][None, :])
            x, y = np.nonzero(first & equal.any(axis=2) & fresh)
            if not len(x):
                continue
            p, q = sketch[ls[x]], sketch[rights[y]]
            estimate = similarity(
                (p > q).sum(axis=1), (p < q).sum(axis=1), n[ls[x]], n[rights[y]]
            )
            for i, j in zip(ls[x[estimate >= CUT]], rights[y[estimate >= CUT]]):
                partners.setdefault(int(i), []).append(int(node[j]))
        if partners:
            asked = {p for own in partners.values() for p in own}
            rows = [i for i in range(len(node)) if i in partners or int(node[i]) in asked]
            chosen = tile.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [chosen["band"], chosen["i"], chosen["j"], chosen["node"], chosen["component"],
                 pa.array([partners.get(i, []) for i in rows], pa.list_(pa.int64()))],
                names=["band", "i", "j", "node", "component", "partners"],
            )


CANDIDATES = "band long, i int, j int, node long, component long, partners array<long>"


def _joining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components, confirmed on full sets; none that earlier ones imply."""
    for tile in _by_tile(batches):
        sets, own, asked = {}, {}, {}
        for node, component, partners, content in zip(*(
            tile[c].to_pylist() for c in ("node", "component", "partners", "set")
        )):
            sets[node], own[node] = np.frombuffer(content, np.uint64), component
            asked.setdefault(node, []).extend(partners)
        top: dict[int, int] = {}

        def root(c: int) -> int:
            while c in top:
                c = top[c]
            return c

        links = []
        for node, partners in asked.items():
            for other in partners:
                a, b = root(own[node]), root(own[other])
                if a != b and alike(sets[node], sets[other]):
                    top[max(a, b)] = min(a, b)
                    links.append((own[node], own[other]))
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in pieces(batch, batch["text"]):
            found = [shingles(t).tobytes() for t in utf8(texts)]
            yield pa.RecordBatch.from_arrays(
                [rows["node"], pa.array(found, pa.binary())], names=["node", "set"]
            )


# Spark filters the larger side of a join by a Bloom filter of the smaller one from these sizes on.
BLOOM = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "64m",
}


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


# ---- the operator ----------------------------------------------------------------------------


class NearDuplicates:
    """Classes of a table's rows. `documents` holds row (all columns but the text), text, number
    (of the row), id, n and key; `classes` maps a key to its component's id and the row to keep."""

    def __init__(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text"):
        self.columns, self.text = docs.columns, text
        self.spark = docs.sparkSession
        bounded(self.spark)
        self.store = Store(self.spark, "near")
        rows = docs.select(
            F.struct(
                F.lit(0).alias("__row"), *[F.col(f"`{c}`") for c in docs.columns if c != text]
            ).alias("row"),
            F.col(f"`{text}`").alias("text"),
        )
        schema = extended(rows.schema, SKETCHED)
        self.documents = self.store.hold(
            rows.mapInArrow(_sketched, schema)
            .withColumn("number", F.monotonically_increasing_id())
            .withColumn("id", F.col(f"row.`{doc_id}`").cast("long")),
            "documents",
        )
        self.classes = self._classes()

    def _classes(self) -> DataFrame:
        hold = self.store.hold
        nodes = hold(
            self.documents.filter("key is not null").groupBy("key").agg(
                F.max("n").alias("n"), F.max("sketch").alias("sketch"),
                F.min("id").alias("least_id"), F.min("number").alias("node"),
            ),
            "nodes",
        )
        members = hold(self._members(nodes), "members")
        sketches = nodes.select("node", "n", "sketch")

        # Step 3: every node against the lowest of its buckets.
        pairs = members.filter("node <> hub").select(
            F.col("hub").alias("a"), F.col("node").alias("b")
        ).distinct()
        near = hold(self._with_sketches(pairs, sketches).mapInArrow(_near, "a long, b long"), "near")
        sets = self._sets_of(near.select(F.col("a").alias("node")).union(near.select("b")), "star")
        links = self._with(self._with(near, sets, "b"), sets, "a").select("a", "b", "set_a", "set_b")
        found = components(links.mapInArrow(_confirmed, "a long, b long"), self.store, "star")

        # Step 4: what may still join two components.
        tiles = self._tiles(members, found, sketches)
        sets = self._sets_of(tiles.select("node"), "tile")
        joining = self._by_tile(tiles.join(sets, "node")).mapInArrow(_joining, "a long, b long")
        over = components(joining, self.store, "tile").select(
            F.col("node").alias("component"), F.col("component").alias("larger")
        )
        nodes = hold(
            nodes.select("key", "node", "least_id").join(found, "node", "left")
            .withColumn("component", F.coalesce("component", "node"))
            .join(over, "component", "left")
            .select("key", "least_id", F.coalesce("larger", "component").alias("component")),
            "connected",
        )
        ids = hold(
            nodes.groupBy("component").agg(F.min("least_id").alias("component_id")), "ids"
        )
        classes = hold(nodes.join(ids, "component").select("key", "component", "component_id"),
                       "classes")
        self.store.drop("nodes", "members", "near", "star-wanted", "star-sets", "tiles",
                        "tile-wanted", "tile-sets", "connected", "ids")
        return classes

    def _members(self, nodes: DataFrame) -> DataFrame:
        """Nodes of the buckets that hold more than one."""
        width = ROWS * 2
        keys = [
            F.struct(F.lit(i).alias("place"),
                     F.xxhash64(F.substring("sketch", width * i + 1, width), F.lit(i)).alias("band"))
            for i in range(BANDS)
        ]
        banded = nodes.select("node", F.explode(F.array(*keys)).alias("at")).select(
            "node", "at.band", "at.place"
        )
        shared = (
            banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
            .filter("last > hub").drop("last")
        )
        return banded.join(shared, "band")

    def _with_sketches(self, pairs: DataFrame, sketches: DataFrame) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(
                sketches.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"),
                                F.col("sketch").alias(f"sketch_{side}")), side
            )
        return pairs

    def _with(self, pairs: DataFrame, sets: DataFrame, side: str) -> DataFrame:
        return pairs.join(
            sets.select(F.col("node").alias(side), F.col("set").alias(f"set_{side}")), side
        )

    def _sets_of(self, nodes: DataFrame, name: str) -> DataFrame:
        """Full sets of some nodes, from the text of the row that a node is named after.

        Only texts that pass Spark's Bloom filter of the wanted nodes (8 MB at most) are shuffled.
        """
        wanted = self.store.hold(nodes.distinct(), f"{name}-wanted")
        texts = self.documents.select(F.col("number").alias("node"), "text").join(
            # Numbers aren't negative; Spark wants a filter that looks selective.
            wanted.filter("node >= 0"), "node"
        )
        with _settings(self.spark, BLOOM):
            return self.store.hold(
                texts.select("node", "text").mapInArrow(_sets, "node long, set binary"),
                f"{name}-sets",
            )

    def _by_tile(self, rows: DataFrame) -> DataFrame:
        """Tiles together and in order. A stated number of partitions is not reduced: what a tile
        costs is comparisons, not bytes."""
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        tile = ("band", "i", "j")
        return rows.repartition(partitions, *tile).sortWithinPartitions(*tile)

    def _tiles(self, members: DataFrame, found: DataFrame, sketches: DataFrame) -> DataFrame:
        """Nodes with their candidate partners, by tile (band, i, j)."""
        members = self.store.hold(
            members.filter("node <> hub").drop("hub").join(found, "node", "left")
            .withColumn("component", F.coalesce("component", "node")),
            "open",
        )
        mixed = self.store.hold(
            members.groupBy("band", "component").agg(F.count(F.lit(1)).alias("size"))
            .groupBy("band").agg(
                F.max(F.struct("size", "component")).alias("major"),
                F.sum("size").alias("total"), F.count(F.lit(1)).alias("components"),
            )
            .filter("components > 1")
            .select("band", F.col("major.component").alias("major"),
                    F.ceil(F.col("major.size") / TILE).cast("int").alias("majors"),
                    F.ceil((F.col("total") - F.col("major.size")) / TILE).cast("int").alias("minors")),
            "mixed",
        )
        rows = members.join(mixed, "band")
        is_major = F.col("component") == F.col("major")
        chunk = F.when(
            is_major, F.col("minors") + F.pmod(F.xxhash64("node"), F.col("majors")).cast("int")
        ).otherwise(F.pmod(F.xxhash64("node"), F.col("minors")).cast("int"))
        minors, everyone = F.col("minors"), F.col("minors") + F.col("majors")
        # A tile pairs a chunk outside the largest component with any chunk.
        others = F.when(is_major, F.sequence(F.lit(0), minors - 1)).otherwise(
            F.sequence(F.lit(0), everyone - 1)
        )
        tiled = self._by_tile(
            rows.withColumn("chunk", chunk)
            .select("band", "place", "node", "component", "chunk", F.explode(others).alias("other"))
            .select(
                "band", "place", "node", "component",
                F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"),
                (F.col("chunk") <= F.col("other")).alias("is_left"),
                (F.col("chunk") >= F.col("other")).alias("is_right"),
            )
            .join(sketches, "node")
        )
        out = self.store.hold(
            tiled.select("band", "i", "j", "place", "node", "component", "n", "sketch", "is_left",
                         "is_right").mapInArrow(_candidates, CANDIDATES),
            "tiles",
        )
        self.store.drop("open", "mixed")
        return out

    # ---- results

    def rows(self) -> DataFrame:
        """number, id, n, component_id of every row."""
        rows = self.documents.select("number", "id", "n", "key").join(self.classes, "key", "left")
        return rows.select(
            "number", "id", "n", "component",
            F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
            .alias("component_id"),
        )

    def report(self) -> DataFrame:
        return self.rows().select(
            F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )

    def kept(self) -> DataFrame:
        """The table without all but one row of each class: of the rows with the component's id
        the first. Rows with empty sets stay."""
        rows = self.store.hold(self.rows().filter("component is not null"), "rows")
        stays = rows.filter(_is_named()).groupBy("component").agg(F.min("number").alias("stays"))
        stays = self.store.hold(stays, "stays")
        gone = rows.join(stays, "component").filter("number <> stays").select("number")
        gone = self.store.hold(gone, "gone")
        return self.documents.join(gone, "number", "left_anti").select(
            *[F.col("text").alias(c) if c == self.text else F.col(f"row.`{c}`")
              for c in self.columns]
        )


def _is_named() -> Column:
    return F.col("id").eqNullSafe(F.col("component_id"))


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    return NearDuplicates(docs, **options).report()


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents with one row of each class; columns stay as they are."""
    return NearDuplicates(docs, **options).kept()
