"""Packing of tokenised documents into fixed windows by the sum-of-squares rule.

A document's ids fill whole windows first; the rest is placed online. With N(h) the number of open
windows filled up to level h, it goes to the level (0: a new window) that makes the sum of N(h)^2
smallest, which keeps the levels varied and so leaves few gaps; between equal ones the fullest.
N is the level array, next to a stack of open windows per level. At the end of a task, or when
more than `MOST_OPEN` windows are open, they are topped up: documents in the emptiest are cut to
fill the fullest, so a task leaves one window partly filled at most.

A task packs what it reads, so nothing is shuffled and a lost task can be repeated alone; the
windows of a task are numbered from its partition's number upwards. Memory: the open windows.

Defined cases: a null or empty text is the end token alone. Repeated rows are packed each. Texts
are taken whole, whatever their length. An empty table gives no pieces.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tillmark.llm.batches import bounded, pieces, strings

MOST_OPEN = 4096
PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long,"
    " offset long"
)
# Fixed value: how the byte-level vocabulary splits a text before it merges bytes.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


class Piece:
    __slots__ = ("doc", "start", "ids", "total")

    def __init__(self, doc, start: int, ids: np.ndarray, total: int):
        self.doc, self.start, self.ids, self.total = doc, start, ids, total

    def cut(self, length: int) -> tuple[Piece, Piece]:
        return (
            Piece(self.doc, self.start, self.ids[:length], self.total),
            Piece(self.doc, self.start + length, self.ids[length:], self.total),
        )


class SumOfSquares:
    """Open windows by level."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)  # N; a full window isn't counted
        self.open: list[list[list[Piece]]] = [[] for _ in range(size)]
        self.windows = 0

    def level_for(self, length: int) -> int:
        """Where a piece goes. Moving a window from h to h + length changes the sum of squares by
        2 (N(h + length) - N(h)) + 2, less the part of level 0 or of a full window."""
        levels = np.flatnonzero(self.count[: self.size - length + 1])
        after = levels + length
        change = 1 - 2 * self.count[levels] + np.where(
            after < self.size, 2 * self.count[after] + 1, 0
        )
        new = 2 * self.count[length] + 1 if length < self.size else 0
        if not len(levels) or new < (least := change.min()):
            return 0
        return int(levels[np.flatnonzero(change == least)[-1]])

    def place(self, piece: Piece) -> list[Piece] | None:
        """The window, if the piece fills it."""
        level = self.level_for(len(piece.ids))
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        else:
            window = []
        self.windows += not level
        window.append(piece)
        level += len(piece.ids)
        if level == self.size:
            self.windows -= 1
            return window
        self.open[level].append(window)
        self.count[level] += 1
        return None

    def topped_up(self) -> Iterator[list[Piece]]:
        """All open windows, filled from one another; only the last may have room left."""
        rest = [w for level in self.open for w in level]
        self.__init__(self.size)
        first, last = 0, len(rest) - 1
        while first <= last:
            window = rest[last]
            last -= 1
            room = self.size - sum(len(p.ids) for p in window)
            while room and first <= last:
                piece = rest[first].pop()
                if len(piece.ids) > room:
                    piece, back = piece.cut(room)
                    rest[first].append(back)
                window.append(piece)
                room -= len(piece.ids)
                if not rest[first]:
                    first += 1
            yield window


def pack(documents: Iterator[tuple[object, np.ndarray]], size: int,
         most_open: int = MOST_OPEN) -> Iterator[list[Piece]]:
    """Windows of pieces from (document, ids)."""
    bins = SumOfSquares(size)
    for doc, ids in documents:
        total = len(ids)
        whole = total - total % size
        for start in range(0, whole, size):
            yield [Piece(doc, start, ids[start:start + size], total)]
        if whole < total:
            full = bins.place(Piece(doc, whole, ids[whole:], total))
            if full:
                yield full
        if bins.windows > most_open:
            *full, rest = bins.topped_up()
            yield from full
            for piece in rest:
                done = bins.place(piece)
                if done:
                    yield done
    yield from bins.topped_up()


# ---- tokens ----------------------------------------------------------------------------------


def encoder(path: str, special: bool = False):
    """A function from a text to its ids, of the byte-level vocabulary in a tokenizer file.

    The vocabulary's ids are also its merge order, which is all that the faster library needs.
    With `special`, as in the operator, the file's added tokens in a text get their own ids, as the
    tokenizers library gives them; without, they are ordinary text. One text at a time, on one
    thread.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        described = json.load(f)
    added = {t["content"]: t for t in described.get("added_tokens", ())}
    # What the faster library can't tell apart: tokens that take blanks, or hold one another.
    odd = [
        t for t, how in added.items() if how.get("lstrip") or how.get("rstrip")
        or how.get("single_word") or any(o != t and (o in t or t in o) for o in added)
    ] if special else []
    # Byte-level vocabularies write a byte as a printable character: itself where it is one, else
    # the next free code point from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(printable)]
    byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
    ranks = {
        bytes(byte_of[c] for c in token): number
        for token, number in described["model"]["vocab"].items()
        if token not in added
    }
    encoding = tiktoken.Encoding(
        "documents", pat_str=SPLIT, mergeable_ranks=ranks,
        special_tokens={t: how["id"] for t, how in added.items()} if special else {},
    )

    slow = None

    def slowly(text: str) -> np.ndarray:
        nonlocal slow
        if slow is None:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(path)
            slow.encode_special_tokens = not special
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def ids(text: str) -> np.ndarray:
        if any(t in text for t in odd):
            return slowly(text)
        try:
            found = encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=())
            return np.asarray(found, np.uint32)
        except ValueError:  # a run of about a million blanks is too long for the fast splitter
            return slowly(text)

    return ids


_ENCODERS: dict[str, object] = {}


def _encoder(path: str):
    if path not in _ENCODERS:
        _ENCODERS[path] = encoder(path, special=True)
    return _ENCODERS[path]


# ---- the operator ----------------------------------------------------------------------------


def _packed(path: str, size: int, end: int, most_open: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = _encoder(path)
        tail = np.array([end], np.uint32)

        def documents():
            for batch in batches:
                for rows, texts in pieces(batch, batch["text"]):
                    for doc, text in zip(rows["doc_id"].to_pylist(), strings(texts)):
                        yield doc, np.concatenate([ids_of(text), tail])

        number = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        for window in pack(documents(), size, most_open):
            offset = 0
            for p in window:
                rows.append((p.doc, p.start, len(p.ids), p.ids.astype("<u4").tobytes(), p.total,
                             number, offset))
                offset += len(p.ids)
            number += 1
            if len(rows) >= 1024:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, length, ids, total, sequence, offset = zip(*rows)
    long = pa.int64()
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, long), pa.array(start, long), pa.array(length, long),
         pa.array(ids, pa.binary()), pa.array(total, long), pa.array(sequence, long),
         pa.array(offset, long)],
        names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
    )


def pack_documents(docs: DataFrame, tokenizer: str, size: int = 2048, end: int = 1,
                   doc_id: str = "doc_id", text: str = "text",
                   most_open: int = MOST_OPEN) -> DataFrame:
    """The pieces of all documents; `ids` are little-endian unsigned 32-bit numbers.

    `tokenizer` is the path of a byte-level tokenizer file, the same on every machine; `end` is
    the id appended to each document. `most_open` bounds the windows that a task holds open.
    """
    bounded(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{doc_id}` as long) doc_id", f"`{text}` text")
    return rows.mapInArrow(_packed(tokenizer, size, end, most_open), PIECES)
