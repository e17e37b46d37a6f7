"""Benchmark decontamination by a broadcast hash set of word n-grams.

Texts are normalised to words: A-Z in lower case, then runs of digits, letters a-z and all
characters beyond ASCII. Of each benchmark item every window of n words is hashed (the whole item,
if it has fewer). A scan of the documents maps words to numbers, hashes the windows that consist of
benchmark words alone, looks the hashes up, and compares the words of every hit. Words inside a
matched window are hit.

The benchmark's size is taken first; beyond `most_bytes` it goes in blocks of items, each broadcast
for a pass of its own over a written table, and the hits of the passes are united.

Defined cases: a null text has no words. An item without words matches nothing. The windows of an item
without an id are hits like others; all such items count as one, which the list of ids leaves out.
A document without words is not contaminated. Repeated items count once by id. Very long texts are
searched whole. Without items nothing is hit; an empty table gives no rows. Columns that clash with the
operator's own stay as they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.batches import LOWER, bounded, pieces, utf8
from tillmark.llm.store import Store

# Bytes of a word after lower-casing; all others separate words.
_WORD = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_SPLIT = bytes(b if b in _WORD else 0x20 for b in LOWER)
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER_TEXT = {c: c + 32 for c in range(65, 91)}
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

WINDOW_BYTES = 600  # of one window while an index is built, as measured
MATCH = (
    "n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<start:int,stop:int>>"
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_SPLIT).split()


def _hash(columns) -> np.ndarray:
    """Of one window per element, given its words' numbers column by column."""
    value = None
    for column in columns:
        column = column.astype(np.uint64)
        value = column if value is None else (value * _FACTOR) ^ (value >> np.uint64(31))
        value = value + column
    return value


@dataclass
class Windows:
    """All windows of one length: sorted hashes, their words' numbers, and whose they are."""

    length: int
    hashes: np.ndarray
    words: np.ndarray
    first_item: np.ndarray  # window i belongs to items[first_item[i]:first_item[i + 1]]
    items: np.ndarray


@dataclass
class Index:
    vocabulary: dict[bytes, int]  # numbers from 1; 0 is any other word
    windows: list[Windows]
    names: list[str | None]  # item ids as strings; items without one come last


def build_index(items: list[tuple[str | None, bytes]], n: int) -> Index:
    vocabulary: dict[bytes, int] = {}
    names: list[str | None] = sorted({name for name, _ in items if name is not None})
    if any(name is None for name, _ in items):
        names.append(None)
    place = {name: i for i, name in enumerate(names)}
    by_length: dict[int, dict[tuple, set[int]]] = {}
    for name, text in items:
        numbers = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in words(text)]
        length = min(n, len(numbers))
        if length:
            found = by_length.setdefault(length, {})
            for start in range(len(numbers) - length + 1):
                found.setdefault(tuple(numbers[start:start + length]), set()).add(place[name])
    windows = []
    for length, found in by_length.items():
        matrix = np.array(list(found), np.int64).reshape(-1, length)
        owners = [sorted(o) for o in found.values()]
        hashes = _hash(matrix.T)
        order = np.argsort(hashes, kind="stable")
        owners = [owners[i] for i in order]
        windows.append(Windows(
            length, hashes[order], matrix[order],
            np.cumsum([0, *map(len, owners)]), np.concatenate(owners).astype(np.int64),
        ))
    return Index(vocabulary, windows, names)


def matches(index: Index, numbers: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, starts, window numbers) of all occurrences in a sequence of word numbers."""
    size = len(numbers)
    places = np.arange(size)
    unknown = np.where(numbers == 0, places, size)
    next_unknown = np.minimum.accumulate(unknown[::-1])[::-1] if size else unknown
    for w in index.windows:
        starts = np.flatnonzero(next_unknown - places >= w.length)
        if not len(starts):
            continue
        hashes = _hash(numbers[starts + i] for i in range(w.length))
        at = np.searchsorted(w.hashes, hashes, side="left")
        # Different windows of one hash lie next to each other; look at each.
        while len(starts):
            same = at < len(w.hashes)
            same[same] = w.hashes[at[same]] == hashes[same]
            starts, at, hashes = starts[same], at[same], hashes[same]
            if not len(starts):
                break
            equal = np.ones(len(starts), bool)
            for i in range(w.length):
                equal &= numbers[starts + i] == w.words[at, i]
            if equal.any():
                yield w.length, starts[equal], at[equal]
            starts, at, hashes = starts[~equal], at[~equal] + 1, hashes[~equal]


def _char_spans(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Code points covered by runs of neighbouring hit words."""
    spans: list[dict[str, int]] = []
    before = False
    for is_hit, m in zip(hit, _WORDS.finditer(text.translate(_LOWER_TEXT))):
        if is_hit and before:
            spans[-1]["stop"] = m.end()
        elif is_hit:
            spans.append({"start": m.start(), "stop": m.end()})
        before = is_hit
    return spans


def _united(a: list[dict], b: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in sorted((dict(s) for s in [*a, *b]), key=lambda s: (s["start"], s["stop"])):
        if out and span["start"] <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], span["stop"])
        else:
            out.append(span)
    return out


def _sorted(names: set[str | None]) -> list[str | None]:
    return sorted(names, key=lambda name: (name is None, name))


def _scan(shared):
    kind = pa.struct([
        ("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ])

    def scan(texts: pa.Array, before: list[dict | None]) -> pa.Array:
        index: Index = shared.value
        get = index.vocabulary.get
        raw = utf8(texts)
        documents = [words(t) for t in raw]
        counts = np.array([len(d) for d in documents], np.int64)
        # One sequence with an unknown word after each document, so that no window spans two.
        firsts = np.cumsum(counts + 1) - counts - 1
        numbers = np.zeros(int((counts + 1).sum()), np.int64)
        for first, d in zip(firsts, documents):
            numbers[first:first + len(d)] = [get(w, 0) for w in d]
        change = np.zeros(len(numbers) + 1, np.int64)
        items: list[set[str] | None] = [None for _ in documents]  # None: no hit
        windows = {w.length: w for w in index.windows}
        for length, starts, at in matches(index, numbers):
            np.add.at(change, starts, 1)
            np.add.at(change, starts + length, -1)
            w = windows[length]
            owner = np.searchsorted(firsts, starts, side="right") - 1
            for document, window in set(zip(owner.tolist(), at.tolist())):
                own = w.items[w.first_item[window]:w.first_item[window + 1]]
                items[document] = items[document] or set()
                items[document].update(index.names[i] for i in own)
        hit = np.cumsum(change[:-1]) > 0
        out = []
        for i, (first, count) in enumerate(zip(firsts, counts)):
            found = {"n_words": int(count), "n_hit": 0, "items": [], "spans": []}
            if items[i] is not None:
                text = raw[i].decode("utf-8", "replace")
                found["spans"] = _char_spans(text, hit[first:first + count])
                found["items"] = _sorted(items[i])
                found["n_hit"] = int(hit[first:first + count].sum())
            old = before[i]
            if old is not None and old["n_hit"]:  # of an earlier block of items
                found["items"] = _sorted({*found["items"], *old["items"]})
                found["spans"] = _united(found["spans"], old["spans"])
                text = raw[i].decode("utf-8", "replace").translate(_LOWER_TEXT)
                found["n_hit"] = sum(
                    len(_WORDS.findall(text, s["start"], s["stop"])) for s in found["spans"]
                )
            out.append(found)
        return pa.array(out, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in pieces(batch, batch["text"]):
                found = scan(texts, rows["match"].to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows["row"], rows["text"], found], names=["row", "text", "match"]
                )

    return run


def _blocks(benchmark: DataFrame, item_id: str, text: str, n: int, most_bytes: int):
    items = benchmark.select(
        F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")
    ).dropna(subset=["text"])
    # While it is built, a window costs its words' numbers as Python objects, a hash and a set of owners;
    # a word has three bytes or more with the blank after it, mostly.
    size = items.agg(F.sum(F.octet_length("text") * F.lit(WINDOW_BYTES // 4 + n) + F.lit(100)))
    size = size.first()[0] or 0
    blocks = max(1, -(-int(size) // most_bytes))
    part = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = items.filter(part == block).collect()
        yield build_index([(r.id, r.text.encode()) for r in rows], n)


def match_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                    item_id: str = "item_id", item_text: str = "text", n: int = 13,
                    most_bytes: int = 256 << 20) -> DataFrame:
    """`row` (all columns of docs), `text` and `match`: word counts, hit words, item ids in order
    (null last), and the code points of the hit passages (runs of neighbouring hit words)."""
    spark = docs.sparkSession
    bounded(spark)
    rows = docs.select(
        F.struct(
            F.lit(0).alias("__row"), *[F.col(f"`{c}`") for c in docs.columns if c != text]
        ).alias("row"),
        F.col(f"`{text}`").alias("text"),
        F.lit(None).cast(f"struct<{MATCH}>").alias("match"),
    )
    store = None
    for number, index in enumerate(
        _blocks(benchmark, item_id, item_text, n, most_bytes)
    ):
        if number:  # one pass's memory at a time
            store = store or Store(spark, "benchmark")
            rows = store.hold(rows, f"pass-{number}")
            store.drop(f"pass-{number - 1}")  # a copy of all texts; this pass has read it
        rows = rows.mapInArrow(_scan(spark.sparkContext.broadcast(index)), rows.schema)
    return rows


def is_contaminated(match: str = "match", one_in: int = 20):
    """A hit, and at least one word in `one_in` is hit."""
    n_hit, n_words = F.col(f"{match}.n_hit"), F.col(f"{match}.n_words")
    return (n_hit > 0) & (n_hit * one_in >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """Per document: counts, a digest of the matched item ids, and the verdict."""
    text = options.get("text", "text")
    found = match_benchmark(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias(text)), benchmark, **options
    )
    return found.select(
        "row.doc_id", "match.n_words", "match.n_hit",
        F.size("match.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("match.items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def remove(docs: DataFrame, benchmark: DataFrame, what: str = "documents", text: str = "text",
           **options) -> DataFrame:
    """The documents without contaminated ones, or (`what="spans"`) all with their hit passages
    cut out, each leaving a space. Columns stay as they are."""
    found = match_benchmark(docs, benchmark, text=text, **options)
    if what == "documents":
        kept, cleaned = found.filter(~is_contaminated()), F.col("text")
    elif what == "spans":
        # What lies between the passages: from each stop to the next start.
        starts = F.concat(F.col("match.spans.start"), F.array(F.length("text")))
        stops = F.concat(F.array(F.lit(0)), F.col("match.spans.stop"))
        between = F.zip_with(
            stops, starts, lambda a, b: F.substring(F.col("text"), a + 1, b - a)
        )
        kept = found
        cleaned = F.when(F.col("match.n_hit") > 0, F.array_join(between, " ")).otherwise(
            F.col("text")
        )
    else:
        raise ValueError(what)
    return kept.select(
        *[cleaned.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns]
    )


def items_digest(ids: list[str]) -> str:
    """What `report` gives for a list of item ids."""
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
