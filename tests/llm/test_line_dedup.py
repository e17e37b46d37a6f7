import hashlib
import random
from collections import Counter

import pytest

from tillmark.llm import line_dedup
from tillmark.llm.store import Store

SCHEMA = "doc_id long, text string, n_lines string, n_dropped int, docs int, settled string, high int"


def docs(spark, rows, parts=3):
    return spark.createDataFrame(
        [(i, t, "x", 1, 2, "s", 3) for i, t in rows], SCHEMA
    ).repartition(parts)


def key(line):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    return lowered.strip(" \t\n\x0b\f\r")


def brute(rows, least_docs=10, least_chars=1):
    held = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    found = []
    for i, t in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if held[key(x)] < least_docs or len(key(x)) < least_chars]
        text = "\n".join(kept)
        found.append((str(i), len(parts), len(parts) - len(kept), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found)


def got(df):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (5, 3)])
def test_equals_brute_force(spark, batches, fanout):
    draw = random.Random(batches)
    common = [f"Line {i}" + " " * (i % 3) for i in range(30)]
    rows = [
        (i, "\n".join(draw.choice(common + [f"own {i} {j}"] * 20) for j in range(draw.randint(0, 8))))
        for i in range(300)
    ]
    found = line_dedup.report(docs(spark, rows), batches=batches, fanout=fanout)
    assert got(found) == brute(rows)


def test_odd_rows(spark):
    """Nulls, blanks, cases, repeats within a document, repeated rows, long texts, a hot line."""
    rows = [
        (None, None), (None, "\n\n"), (1, None), (1, ""), (2, " \t\x0b\f\r "), (3, "a\n"), (3, "a\n"),
        (4, " hot "), (5, "É\né"), (6, "x" * 200000 + "\n" + "hot\n" * 3000 + "end"),
        (7, " " * 200000 + "\nown"),
        *[(100 + i, f"\tHOT \r\nown {i}\nhot\n\n") for i in range(25)],
        *[(200, "same row\nhot")] * 12,
    ]
    for least in (1, 2, 10, 11, 40):
        found = line_dedup.report(docs(spark, rows), least_docs=least, batches=3, fanout=2)
        assert got(found) == brute(rows, least)
    found = line_dedup.report(docs(spark, rows), least_chars=4)
    assert got(found) == brute(rows, least_chars=4)


def test_the_documents_keep_their_columns(spark):
    rows = [(i, f"{i}\nshared") for i in range(10)] + [(None, None), (11, "")]
    out = line_dedup.drop_repeated(docs(spark, rows))
    assert out.columns == ["doc_id", "text", "docs", "settled", "high", "n_lines", "n_dropped"]
    found = {r.doc_id: r for r in out.collect()}
    assert found[3].text == "3" and found[3].settled == "s" and found[3].n_dropped == 1
    assert found[None].text is None and found[11].text == "" and found[11].n_dropped == 0


def test_empty_table(spark):
    found = line_dedup.report(docs(spark, []))
    assert found.collect() == []
    assert found.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]


def hashes(spark, keys):
    return spark.createDataFrame([(k, -k) for k in keys], "high long, low long")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_merge_by_levels_and_settled_keys_are_not_counted_again(spark):
    runs = line_dedup.Runs(Store(spark, "runs"), least_docs=3, fanout=2)
    try:
        runs.add(hashes(spark, [1, 1, 1, 2, 3]))
        assert [len(level) for level in runs.levels] == [1]
        left = runs.unsettled(hashes(spark, [1, 2, 2]))
        assert [(r.high, r.docs) for r in left.collect()] == [(2, 2)]
        runs.add(hashes(spark, [1, 2, 4]))
        assert [len(level) for level in runs.levels] == [0, 1]
        runs.add(hashes(spark, [2, 5]))
        assert [len(level) for level in runs.levels] == [1, 1]
        assert sorted(r.high for r in runs.repeated().collect()) == [1, 2]
    finally:
        runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tillmark_lines")]


def test_no_run_is_shuffled_or_sorted(spark):
    runs = line_dedup.Runs(Store(spark, "runs"), least_docs=3, fanout=9)
    try:
        for keys in ([1, 1, 1, 2, 3], [2, 4], [2, 5]):
            runs.add(hashes(spark, keys))
        with line_dedup._sorted_buckets(spark):
            names = [name for level in runs.levels for name in level]
            assert "Exchange" not in plan(runs.merged(names))
            text = plan(runs.unsettled(hashes(spark, [1, 7])))
        # The batch's counts are shuffled and sorted once, for the joins with all three runs.
        assert text.count("SortMergeJoin") == 3
        assert text.count("Exchange") == 1 and text.count("Sort [") == 1
    finally:
        runs.close()


def test_no_python_in_the_plans(spark):
    found = line_dedup.report(docs(spark, [(1, "a"), (2, None)]))
    text = plan(found) + plan(line_dedup.hashed(docs(spark, [(1, "a")]), "text", 1))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
