import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmark.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score string, id int"


def brute(rows, k):
    usable = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    asked = {}
    for i, v in usable:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    for q, a in asked.items():
        scores = sorted(
            (-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q
        )
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def search(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    found = topk.exact_top_k(df.repartition(3), F.col("vec_id") % 50 == 0, **options)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


def vectors(n, width, seed, low=-1.0):
    rng = np.random.default_rng(seed)
    return [[float(x) for x in v] for v in rng.uniform(low, 1, (n, width)).astype(np.float32)]


@pytest.mark.parametrize("lists,block", [(4, 4096), (3, 4), (1, 4096)])
def test_equals_brute_force(spark, lists, block):
    rows = list(enumerate(vectors(400, 10, 1)))
    assert search(spark, rows, k=5, lists=lists, block=block) == brute(rows, 5)


def test_bad_vectors_take_no_part(spark):
    rows = list(enumerate(vectors(60, 4, 2)))
    rows += [(100, None), (150, [1.0, None, 0.0, 0.0]), (200, [float("nan")] * 4),
             (61, [float("inf"), 0.0, 0.0, 0.0]), (62, None), (None, [1.0] * 4)]
    assert search(spark, rows, k=5) == brute(rows, 5)


@pytest.mark.parametrize("bad", [[None, 9.0, 9.0, 9.0], [float("-inf"), 0.0, 0.0, 0.0], [float("nan")] * 4, None])
def test_a_bad_vector_does_not_ask_for_its_id(spark, bad):
    rows = list(enumerate(vectors(120, 4, 3))) + [(50, bad)]
    found = search(spark, rows, k=5)
    assert found == brute(rows, 5)
    assert sum(r[0] == 50 for r in found) == 5


def test_ties_and_repeated_rows(spark):
    rows = [(i, [1.0, 0.5]) for i in range(120)] + [(7, [1.0, 0.5])] * 3
    found = search(spark, rows, k=5)
    assert found == brute(rows, 5)
    assert [r[2] for r in found if r[0] == 0] == [1, 2, 3, 4, 5]


def test_negative_scores_and_few_candidates(spark):
    rows = [(0, [1.0, 1.0]), (1, [-1.0, -1.0]), (2, [-0.5, 0.25])]
    assert search(spark, rows, k=5) == brute(rows, 5) == [(0, 1, 2, -16384), (0, 2, 1, -131072)]


def test_one_vector_and_none(spark):
    assert search(spark, [(0, [1.0])], k=5) == []
    assert search(spark, [], k=5) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [2.0**20 + i, 3.0 + i]) for i in range(60)]
    assert search(spark, rows, k=3) == brute(rows, 3)


def test_short_vectors_count_as_padded(spark):
    rows = [(0, [1.0, 1.0, 1.0]), (1, [2.0]), (2, []), (3, [0.5, 0.5])]
    assert search(spark, rows, k=5) == brute(rows, 5)
