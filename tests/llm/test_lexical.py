import math
import random
import re
from collections import Counter

import pytest

from tillmark.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item int, block string, rank string, score int, terms int"
ITEMS = "item_id long, text string, doc_id int, term string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(items, docs, k):
    """Every item against every document, term by term."""
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    there = sum(n > 0 for *_, n in held)
    whole = sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    texts = {}
    for i, t in items:
        if t is not None:
            texts[i] = min(texts.get(i, t), t)
    for item, text in texts.items():
        scores = []
        for i, counts, n in held:
            score = 0
            for t, q in Counter(terms(text)).items():
                if counts[t]:
                    m = 100 - 75 + 75 * n * there // whole
                    w = math.floor(1000 * math.log((2 * there + 2) / (2 * df[t] + 1)))
                    score += q * w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scores)[:k], 1):
            found.append((str(item), rank, str(i), -score))
    return sorted(found)


def got(spark, items, docs, parts=3, **options):
    found = lexical.search(
        spark.createDataFrame([(i, t, 1, "t") for i, t in items], ITEMS),
        spark.createDataFrame([(i, t, 1, "b", "r", 2, 3) for i, t in docs], DOCS).repartition(parts),
        **options,
    )
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((str(r.item_id), r.rank, str(r.doc_id), r.score) for r in found.collect())


def corpus(draw, size, words=400):
    """Words of a skewed distribution, so that some are in nearly every document."""
    def text(n):
        return " ".join(f"w{int(words ** draw.random())}" for _ in range(n))

    return [(i, text(draw.randint(0, 40))) for i in range(size)], text


@pytest.mark.parametrize("seed,options", [
    (1, {}), (2, {"stages": 1}), (3, {"k": 3, "stages": 9, "bundle": 20}), (4, {"most_terms": 0}),
])
def test_equals_brute_force(spark, seed, options):
    draw = random.Random(seed)
    docs, text = corpus(draw, 300)
    items = [(i, text(draw.randint(1, 12))) for i in range(12)]
    assert got(spark, items, docs, block_bytes=2000, **options) == brute(items, docs, options.get("k", 10))


def test_odd_rows(spark):
    """Nulls, texts without terms, repeated ids and rows, ties, a long text, a word everywhere."""
    docs = [
        (None, None), (None, "null id word"), (1, None), (2, ""), (3, " .,;@[`{\x7f"), (4, "Word"),
        (4, "word"), (5, "ÉTÉ été Été"), (6, "word " * 30000 + "rare"), (7, "a-b_c 1 2"),
        *[(100 + i, "every word is alike") for i in range(30)], *[(200, "same row word")] * 15,
    ]
    items = [
        (None, "word null"), (1, None), (2, ""), (3, "..."), (4, "WORD rare rare"), (5, "été ÉTÉ"),
        (6, "nothing known"), (7, "zzz alike"), (7, "every alike"), (8, "b 1"), (9, "word " * 5000),
    ]
    assert got(spark, items, docs) == brute(items, docs, 10)
    assert got(spark, items, docs, k=1, stages=2, bundle=2) == brute(items, docs, 1)
    assert got(spark, items, docs, k=200) == brute(items, docs, 200)


def test_nothing_to_search(spark):
    docs, items = [(1, "a b")], [(1, "a")]
    assert got(spark, [], docs) == []
    assert got(spark, items, []) == []
    assert got(spark, items, [(1, None), (2, "?")]) == []
    assert got(spark, [(1, "c")], docs) == []


def test_documents_that_can_not_come_in_are_not_carried(spark, monkeypatch):
    """Common words alone lift no document into the result once rare ones have been added."""
    docs = [(i, f"common often {'often' if i % 2 else ''}" + (" rare" if i < 20 else "")) for i in range(400)]
    sizes = []
    stage = lexical._stage

    def spy(spark_, number, *rest):
        out = stage(spark_, number, *rest)
        sizes.append(sum(len(r.places) // 4 for r in out.collect()))
        return out

    monkeypatch.setattr(lexical, "_stage", spy)
    items = [(1, "rare common")]
    assert got(spark, items, docs, k=5, block_bytes=2000) == brute(items, docs, 5)
    assert len(sizes) == 2 and max(sizes) <= 20


def test_a_stage_adds_to_what_a_bundle_carries():
    import numpy as np
    import pyarrow as pa

    def ints(values, kind=np.int64):
        return np.array(values, kind).tobytes()

    carried = pa.Table.from_pylist([
        {"bundle": 0, "block": 7, "item": 1, "places": ints([2, 5], np.int32),
         "scores": ints([40, 10]), "cutoff": 30, "after": 0},
    ])
    asker = {"item": 1, "weight": 2, "cutoff": 30, "after": 0, "opens": False}
    postings = pa.Table.from_pylist([
        {"bundle": 0, "block": 7, "places": ints([5, 9], np.int32), "times": ints([1, 1], np.int32),
         "lengths": ints([1, 1], np.int32), "askers": [asker]},
    ])
    (row,) = lexical.carry(10, 10, 2)(carried, postings).to_pylist()
    value = 1_000_000_000 // (1000 + 8 * 100)
    assert np.frombuffer(row["places"], np.int32).tolist() == [2, 5]  # 9 was not let in
    assert np.frombuffer(row["scores"], np.int64).tolist() == [40, 10 + 2 * value]
    assert row["heads"] == [10 + 2 * value, 40]
