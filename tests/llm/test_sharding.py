import zlib
from collections import Counter

from pyspark.sql import functions as F

from tillmark.llm import sharding

SCHEMA = "doc_id long, text string, shard string, slot int, size string, chunk int"


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "s", 1, "z", 2) for i, t in rows], SCHEMA).repartition(parts)


def check(found, rows, shards=24):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows
    )
    assert {r.law for r in found} <= {"key"}
    for shard in {r.shard for r in found}:
        slots = sorted(r.slot for r in found if r.shard == shard)
        assert slots == list(range(len(slots)))
    by_key = {}
    for r in found:
        assert 0 <= r.shard < shards
        assert r.grown_shard in (r.shard, shards)
        assert by_key.setdefault(r.doc_id, (r.shard, r.grown_shard)) == (r.shard, r.grown_shard)


def test_documents(spark):
    rows = [(i, f"text {i} é") for i in range(3000)]
    found = sharding.shard_documents(docs(spark, rows)).collect()
    check(found, rows)
    counts = Counter(r.shard for r in found)
    assert len(counts) == 24 and max(counts.values()) < 2 * min(counts.values())
    moved = sum(r.grown_shard != r.shard for r in found)
    assert 60 < moved < 200  # one in 25 is 120


def test_odd_rows(spark):
    rows = [(None, None), (None, "a"), (1, None), (1, ""), (2, "x" * 300000)] + [(5, "same")] * 500
    check(sharding.shard_documents(docs(spark, rows)).collect(), rows)


def test_empty_table(spark):
    found = sharding.shard_documents(docs(spark, []))
    assert found.collect() == []
    assert found.columns == [
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    ]


def test_law_depends_on_key_and_count_only(spark):
    df = spark.range(500).select(
        sharding.rendezvous(F.col("id"), 8).alias("a"),
        sharding.rendezvous(F.col("id").cast("string"), 8).alias("b"),
    )
    assert df.filter("a <> b").count() == 0


def test_weights(spark):
    df = spark.range(20000).select(sharding.rendezvous(F.col("id"), 3, [1.0, 2.0, 5.0]).alias("s"))
    counts = {r.s: r["count"] for r in df.groupBy("s").count().collect()}
    assert abs(counts[0] - 2500) < 250 and abs(counts[1] - 5000) < 350
    more = spark.range(2000).select(
        sharding.rendezvous(F.col("id"), 3, [1, 2, 5]).alias("a"),
        sharding.rendezvous(F.col("id"), 3, [1, 2, 9]).alias("b"),
    )
    # A heavier shard only wins keys.
    assert more.filter("a <> b and b <> 2").count() == 0


def test_null_and_empty_key_differ(spark):
    df = spark.createDataFrame([(None,), ("",)], "k string").select(
        *[sharding.rendezvous(F.concat(F.col("k"), F.lit("")), n).alias(str(n)) for n in range(2, 9)]
    )
    null, empty = map(tuple, df.collect())
    assert null != empty


def test_no_python_in_the_plan(spark):
    found = sharding.shard_documents(docs(spark, [(1, "a")]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_written_shards(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    sharding.write_shards(rows, str(tmp_path / "out"), "doc_id", 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 1000
    assert back.filter(sharding.rendezvous(F.col("doc_id"), 4) != F.col("shard")).count() == 0


def test_slots_keep_columns_of_other_names(spark):
    from tillmark.llm.store import Store

    rows = spark.range(50).select(
        "id", (F.col("id") % 3).alias("shard"), F.lit("c").alias("chunk"), F.lit(7).alias("first_slot"),
        F.lit(8).alias("size_of_chunk"), F.lit(-1).alias("slot"),
    ).repartition(4)
    found = sharding.with_slots(Store(spark, "test"), rows)
    assert set(found.columns) == set(rows.columns)
    got = found.collect()
    assert {(r.chunk, r.first_slot, r.size_of_chunk) for r in got} == {("c", 7, 8)}
    for shard in range(3):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
