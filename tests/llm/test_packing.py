import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillmark.llm import packing, queries

SCHEMA = "doc_id long, text string, start string, length string, ids int"


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ids_of():
    return packing.encoder(queries.TOKENIZER)


@given(st.text())
@settings(max_examples=300, deadline=None)
def test_ids_equal_the_tokenizers(reference, ids_of, text):
    assert list(ids_of(text)) == reference(text)


@pytest.mark.parametrize("text", [
    "", " ", "x" * 100000, "a  b\n\n \t c", "<|endoftext|> it's I'LL", "1½² ١٢", "\x00\x1c é", "🙂" * 50,
])
def test_ids_of_odd_texts(reference, ids_of, text):
    assert list(ids_of(text)) == reference(text)


def test_a_million_blanks(ids_of, reference):
    text = "a" + " " * 1_000_000 + "b"
    assert list(ids_of(text)) == reference(text)


def squares(windows, size):
    levels = {}
    for w in windows:
        level = sum(map(len, w))
        if level < size:
            levels[level] = levels.get(level, 0) + 1
    return sum(n * n for n in levels.values())


def test_each_step_minimises_the_sum_of_squares():
    rng = np.random.default_rng(3)
    size, bins = 16, packing.SumOfSquares(16)
    for _ in range(300):
        length = int(rng.integers(1, size))
        n = bins.count.copy()

        def after(level):
            m = n.copy()
            if level:
                m[level] -= 1
            if level + length < size:
                m[level + length] += 1
            return int((m**2).sum())

        options = [0] + [h for h in range(1, size - length + 1) if n[h]]
        level = bins.level_for(length)
        assert level in options
        assert after(level) == min(map(after, options))
        bins.place(packing.Piece(0, 0, np.zeros(length, np.uint32), length))


def check(windows, docs, size):
    """Each id once, in order; windows without gaps; one may be short."""
    assert all(0 < sum(len(p.ids) for p in w) <= size for w in windows)
    assert sum(sum(len(p.ids) for p in w) < size for w in windows) <= 1
    got = {}
    for w in windows:
        for p in w:
            got.setdefault(p.doc, []).append((p.start, list(p.ids), p.total))
    for doc, ids in docs:
        at = 0
        for start, part, total in sorted(got.get(doc, [])):
            assert start == at and part == list(ids[start:start + len(part)]) and total == len(ids)
            at += len(part)
        assert at == len(ids)


@pytest.mark.parametrize("most_open", [4096, 5])
def test_windows_hold_each_id_once(most_open):
    rng = np.random.default_rng(1)
    docs = [(i, rng.integers(0, 9, rng.integers(1, 90), np.uint32)) for i in range(400)]
    check(list(packing.pack(iter(docs), 32, most_open)), docs, 32)


def test_no_documents():
    assert list(packing.pack(iter([]), 32)) == []


def packed(spark, rows, size=64, parts=2):
    df = spark.createDataFrame([(i, t, "a", "b", 1) for i, t in rows], SCHEMA).repartition(parts)
    return packing.pack_documents(df, queries.TOKENIZER, size=size).collect()


def test_round_trip_of_odd_rows(spark, reference):
    rows = [(1, None), (2, ""), (3, "word " * 3000), (4, "hello, world"), (None, "no id"),
            (6, "same"), (6, "same"), (7, "퟿ é \x00")]
    found = packed(spark, rows)
    sequences = {}
    for p in found:
        assert p.length == len(p.ids) // 4 > 0
        sequences.setdefault(p.sequence_id, []).append(p)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64
    by_doc = {}
    for p in found:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for doc, text in rows:
        ids = reference(text or "") + [1]
        parts = by_doc[doc, len(ids)]
        copies = rows.count((doc, text))
        ends = sorted((p.start, np.frombuffer(p.ids, "<u4").tolist()) for p in parts)
        assert sum(len(x) for _, x in ends) == copies * len(ids)
        for start, part in ends:
            assert part == ids[start:start + len(part)]


@pytest.mark.parametrize("text", [
    "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", "<|endoftext| >",
    "a  <|endoftext|>  \n", "it's<|endoftext|>'s", "<|endoftext|>" + " " * 1_000_000 + "b",
])
def test_added_tokens_get_their_ids(spark, text):
    unmodified = Tokenizer.from_file(queries.TOKENIZER)
    expected = unmodified.encode(text, add_special_tokens=False).ids + [1]
    found = sorted(packed(spark, [(1, text)]), key=lambda p: p.start)
    assert [i for p in found for i in np.frombuffer(p.ids, "<u4").tolist()] == expected
    assert {p.doc_tokens for p in found} == {len(expected)}


def test_empty_table(spark):
    assert packed(spark, []) == []
