import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmark.llm import graph, near_dup
from tillmark.llm.store import Store

SCHEMA = "doc_id long, text string, key string, n int, component string, number int"


def shingle_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    size = min(5, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} if size else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    top = list(range(len(rows)))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                top[b] = a
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(root(i), []).append(doc)
    out = []
    for i, (doc, _) in enumerate(rows):
        least = min((d for d in ids[root(i)] if d is not None), default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", 1, "c", 2) for i, t in rows], SCHEMA).repartition(3)


def run(spark, rows):
    found = near_dup.report(frame(spark, rows))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, found.collect()), key=repr)


def edited(base, share, rng, fresh):
    return " ".join(f"{fresh}{i}" if rng.random() < share else w for i, w in enumerate(base))


def corpus(seed=5):
    """Families of copies edited to various degrees, and texts that share a passage."""
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = []
    for family in range(12):
        base = rng.choices(vocabulary, k=rng.choice((12, 60, 150)))
        for copy in range(rng.choice((2, 5, 14))):
            rows.append(edited(base, rng.choice((0, 0.01, 0.03, 0.06, 0.1)), rng, f"f{family}c{copy}x"))
    passage = " ".join(rng.choices(vocabulary, k=40))
    rows += [f"{' '.join(rng.choices(vocabulary, k=rng.choice((5, 15, 60))))} {passage}" for _ in range(25)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_equals_brute_force(spark):
    rows = corpus()
    assert run(spark, rows) == brute(rows)


def test_a_large_group_in_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "TILE", 8)
    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    rows = [(i, edited(base, rng.choice((0.005, 0.02, 0.03, 0.04, 0.06)), rng, f"e{i}x"))
            for i in range(140)]
    expected = brute(rows)
    assert 3 < len({r[2] for r in expected}) < 140  # neither one class nor none
    assert run(spark, rows) == expected


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\r\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "two one"),
        (8, "a b c d e"), (9, "a b c d e"), (9, "a b c d e"), (None, "a  b\tc d E"), (None, "alone here"),
        (None, "Alone HERE"), (10, "a b c d"), (11, "É x y z w"), (12, "é x y z w"), (13, "a b c d e f"),
        (14, "w " * 50000), (15, "w " * 60000), (16, " ".join(f"x{i}" for i in range(30000))),
        (16, "an id that comes twice"),
    ]
    assert run(spark, rows) == brute(rows)


def test_copies_without_end(spark):
    rows = [(i, "the same text in every row of it") for i in range(1500)] + [(-3, "another text")]
    found = run(spark, rows)
    assert found == sorted([(i, 4, 0, i == 0) for i in range(1500)] + [(-3, 1, -3, True)], key=repr)


def test_empty_table(spark):
    assert run(spark, []) == []
    assert near_dup.keep_one(frame(spark, [])).collect() == []


def test_one_row_of_each_class_stays(spark):
    rows = corpus(6)[:40] + [(3, "repeated row of this text"), (3, "repeated row of this text"),
                             (None, None), (500, None), (501, "")]
    df = frame(spark, rows)
    kept = near_dup.keep_one(df)
    assert kept.columns == df.columns
    got = sorted((tuple(r) for r in kept.select("doc_id", "text").collect()), key=repr)
    full = brute(rows)
    stay = {(r[0], r[1]) for r in full if r[3]}
    expected = sorted({(i, t) for i, t in rows if (i, len(shingle_set(t))) in stay}, key=repr)
    assert got == expected


def test_registers_merge():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(0, 2**64, n, np.uint64) for n in (300, 500))
    both = near_dup.registers(np.concatenate([a, b]))
    assert (near_dup.merged(near_dup.registers(a), near_dup.registers(b)) == both).all()


@pytest.mark.parametrize("common,only_a,only_b", [(900, 50, 50), (600, 100, 100), (300, 300, 300),
                                                  (0, 400, 100), (500, 0, 500)])
def test_likelihood_estimates_similarity(common, only_a, only_b):
    rng = np.random.default_rng(2)
    estimates = []
    for _ in range(60):
        x = rng.integers(0, 2**64, common + only_a + only_b, np.uint64)
        a, b = x[:common + only_a], np.concatenate([x[:common], x[common + only_a:]])
        p, q = near_dup.registers(a), near_dup.registers(b)
        estimates.append(near_dup.similarity(
            np.array([(p > q).sum()]), np.array([(p < q).sum()]), np.array([len(a)]), np.array([len(b)])
        )[0])
    j = common / (common + only_a + only_b)
    assert abs(np.mean(estimates) - j) < 0.03
    assert np.std(estimates) < 1.5 * (max(j * (1 - j), 0.01) / near_dup.REGISTERS) ** 0.5 + 0.01


def test_pairs_at_the_threshold_meet_in_a_band():
    rng = np.random.default_rng(3)
    missed = 0
    for _ in range(400):
        x = rng.integers(0, 2**64, 500, np.uint64)
        p, q = near_dup.registers(x[:437]), near_dup.registers(x[62:])  # 375 of 500
        equal = (p == q).reshape(near_dup.BANDS, near_dup.ROWS).all(axis=1)
        missed += not equal.any()
    assert missed == 0


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1300)]
    edges += [(1, 1), (5, 4), (4, 5), (3, 4)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = dict(map(tuple, graph.components(df, Store(spark, "test"), "g").collect()))
    expected = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(1000, 1300)]} | {3: 3, 4: 3, 5: 3}
    assert found == expected


def test_rows_from_an_expression(spark):
    rows = spark.range(50).select(F.col("id").alias("doc_id"), F.lit("a b c d e f").alias("text"))
    assert near_dup.report(rows).filter("kept").count() == 1


def test_no_register_of_a_small_set_is_cut_off():
    ends = np.array([0, 1, 2**32 - 1, 2**63, 2**64 - 1], np.uint64)
    for value in ends:
        found = near_dup.registers(np.array([value], np.uint64))
        assert found.min() > 0 and found.max() < 2**16 - 1


def test_unlike_texts_of_one_word_share_no_band():
    sketches = np.array([
        near_dup.registers(near_dup.shingles(f"word{i}".encode())) for i in range(20000)
    ])
    for band in range(near_dup.BANDS):
        part = sketches[:, near_dup.ROWS * band: near_dup.ROWS * (band + 1)]
        assert len(np.unique(part, axis=0)) == len(part)
