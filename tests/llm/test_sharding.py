import zlib

from pyspark.sql import functions as F

from hourstar.llm.queries import op3_sharding
from hourstar.llm.sharding import feistel, shard_rows


def test_feistel_is_a_permutation(spark):
    for n, a, b in ((1, 1, 1), (2, 2, 1), (3, 2, 2), (10, 4, 3), (1000, 32, 32), (4999, 71, 71)):
        places = spark.range(n).select(feistel(F.col("id"), F.lit(a), F.lit(b), F.lit(n), 7).alias("p"))
        assert sorted(r.p for r in places.collect()) == list(range(n))


def check(rows, shards):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    assert all(0 <= k < shards for k in by)
    sizes = [len(by.get(k, [])) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_places_sizes_and_nulls(spark):
    data = [(i, "copy") for i in range(70)] + [(None, None), (None, ""), (5, "copy"), (5, "copy"), (99, "ü" * 50_000)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("bucket", F.lit(1)).withColumn("id", F.lit("x"))
    rows = shard_rows(df, 8).collect()
    assert len(rows) == len(data)
    check(rows, 8)
    assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows) == sorted(
        (i or -1, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in data
    )


def test_same_places_from_any_layout(spark):
    data = [(i, f"text {i % 7}") for i in range(500)]
    first = shard_rows(spark.createDataFrame(data, "doc_id long, text string").repartition(1), 40).collect()
    second = shard_rows(spark.createDataFrame(data[::-1], "doc_id long, text string").repartition(7), 40).collect()
    assert set(first) == set(second)


def test_empty_table(spark):
    assert shard_rows(spark.createDataFrame([], "doc_id long, text string"), 40).count() == 0


def test_query(spark):
    rows = op3_sharding(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200
    check(rows, 40)
