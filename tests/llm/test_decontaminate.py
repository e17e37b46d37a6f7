import hashlib
import re

import pytest

from tillmark.llm import decontaminate

DOCS = "doc_id long, text string, n_words string, match int, row long"
ITEMS = "item_id long, text string, id string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(docs, items, n=13):
    out = []
    for doc, text in docs:
        words = WORD.findall(lower(text))
        hit, found = set(), set()
        for item, item_text in items:
            own = WORD.findall(lower(item_text))
            size = min(n, len(own))
            if item_text is None or not size:
                continue
            windows = {tuple(own[i:i + size]) for i in range(len(own) - size + 1)}
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add(item)
        names = sorted(str(i) for i in found if i is not None)
        ids = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(found), ids,
                    len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(i, t, "w", 1, 2) for i, t in docs], DOCS).repartition(2),
        spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS),
    )


def run(spark, docs, items, **options):
    found = decontaminate.report(*frames(spark, docs, items), **options)
    return sorted(map(tuple, found.collect()), key=repr)


LONG = " ".join(f"w{i}" for i in range(40))
CASES = [
    (1, f"Before it {LONG.upper()}, after it."), (2, " ".join(f"w{i}" for i in range(12))),
    (3, "tiny Item!"), (4, "an ITEM tiny"), (5, None), (6, ""), (7, "... !!"),
    (8, "filler " * 5000 + LONG[:60] + " filler" * 2000), (9, LONG), (9, LONG),
    (10, "é Ünï straße x"), (11, "a a a a a a"), (None, "tiny item"),
    (12, "clean words only"), (13, "w0 w1 w2 " * 30), (14, "x.y-z_1 tiny-item"),
]
BENCH = [
    (10, LONG), (9, "Tiny item"), (2, "é ünï straße"), (3, None), (4, ""), (5, "?!"), (None, "clean words"),
    (11, "a a a"), (100, " ".join(f"w{i}" for i in range(5, 30))), (10, "Clean Words only"),
    (12, "Ünï straße"),
]


@pytest.mark.parametrize("most_bytes", [256 << 20, 2000])
def test_equals_brute_force(spark, most_bytes):
    assert run(spark, CASES, BENCH, most_bytes=most_bytes) == brute(CASES, BENCH)


def test_windows_do_not_span_documents(spark):
    docs = [(i, f"w{i}") for i in range(40)]
    items = [(1, LONG)]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], BENCH) == []
    assert run(spark, CASES, []) == brute(CASES, [])


def test_documents_are_removed_whole(spark):
    docs, items = frames(spark, CASES, BENCH)
    kept = decontaminate.remove(docs, items)
    assert kept.columns == docs.columns
    clean = {r[0] for r in brute(CASES, BENCH) if not r[5]}
    assert sorted(map(repr, kept.select("doc_id", "text").collect())) == sorted(
        map(repr, docs.filter(docs.doc_id.isin(*[c for c in clean if c is not None]))
            .select("doc_id", "text").collect())
    )


@pytest.mark.parametrize("most_bytes", [256 << 20, 2000])
def test_spans_are_cut_out(spark, most_bytes):
    docs, items = frames(spark, CASES, BENCH)
    left = decontaminate.remove(docs, items, "spans", most_bytes=most_bytes)
    assert left.columns == docs.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert texts[1] == "Before it  , after it."
    assert texts[3] == " !" and texts[5] is None and texts[12] == " "
    assert texts[10] == "é   x" and texts[4] == "an ITEM tiny"


@pytest.mark.parametrize("most_bytes", [256 << 20, 400])
def test_items_without_an_id_leave_no_document(spark, most_bytes):
    rows = [(1, f"x {LONG} y"), (2, "other words"), (3, "tiny item"), (4, "tiny item and clean words")]
    bench = [(None, LONG), (None, "clean words"), (7, "tiny item"), (8, None), (None, None)]
    docs, items = frames(spark, rows, bench)
    kept = decontaminate.remove(docs, items, most_bytes=most_bytes)
    assert [r.doc_id for r in kept.collect()] == [2]
    found = decontaminate.report(docs, items, most_bytes=most_bytes).collect()
    assert {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in found} == {
        1: (40, 1, True), 2: (0, 0, False), 3: (2, 1, True), 4: (4, 2, True)}
    assert run(spark, rows, bench, most_bytes=most_bytes) == brute(rows, bench)


def test_hash_collisions_are_told_apart(monkeypatch):
    import numpy as np

    monkeypatch.setattr(decontaminate, "_hash", lambda columns: [
        np.zeros(len(c), np.uint64) for c in columns][0])
    index = decontaminate.build_index([("1", b"a b"), ("2", b"c d"), ("3", b"b a")], 13)
    numbers = np.array([index.vocabulary[w] for w in (b"c", b"d", b"a", b"b", b"a")])
    found = sorted((s, index.windows[0].words[w].tolist())
                   for _, starts, at in decontaminate.matches(index, numbers)
                   for s, w in zip(starts, at))
    v = index.vocabulary
    assert found == [(0, [v[b"c"], v[b"d"]]), (2, [v[b"a"], v[b"b"]]), (3, [v[b"b"], v[b"a"]])]
