import math

import numpy as np
import pytest

from hourstar.llm.queries import op1_top_k
from hourstar.llm.topk import cover_tree, search, top_k

SF_DIR = "/root/testdata/sf0.001"


def plain(rows, is_query, k):
    ints = [(i, [math.floor(float(x) * 1024) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ints:
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ints if i != q and len(a) == len(b))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


def test_query_over_the_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert found(op1_top_k(spark, SF_DIR)) == plain(rows, lambda i: i % 100 == 0, 10)


@pytest.mark.parametrize("bounds", [(8192, 2048), (40, 3)])
def test_awkward_vectors(spark, monkeypatch, bounds):
    monkeypatch.setattr("hourstar.llm.topk.SHARD_ROWS", bounds[0])
    monkeypatch.setattr("hourstar.llm.topk.BLOCK_ROWS", bounds[1])
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(150)]
    rows += [(200 + i, [1.0, -0.5, 0.25, 0.125]) for i in range(120)]  # one vector many times
    rows += [(400, None), (410, []), (420, [1.0, None, 0.0, 0.0]), (430, [1.0, float("nan"), 0.0, 0.0]), (440, [float("inf"), 0.0, 0.0, 0.0]),
             (None, [1.0, 1.0, 1.0, 1.0]), (450, [1.0, 2.0]), (460, [0.0] * 4), (470, [-1e-9] * 4), (480, [1.0, 2.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, score int, id int")
    assert found(top_k(df, lambda c: c % 10 == 0, 5)) == plain(rows, lambda i: i % 10 == 0, 5)
    assert top_k(df, lambda c: c < -1, 5).count() == 0
    assert top_k(df.limit(0), lambda c: c % 10 == 0, 5).count() == 0
    assert len(found(top_k(df.where("vec_id < 3"), lambda c: c == 0, 5))) == 2


def test_large_components_are_exact(spark):
    rows = [(i, [1e6 + i * 1e-3, 3e5 - i, 7.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(top_k(df, lambda c: c % 7 == 0, 4)) == plain(rows, lambda i: i % 7 == 0, 4)


def test_nodes_are_covered():
    points = np.random.default_rng(5).normal(size=(700, 6))
    tree = cover_tree(points)
    assert sorted(tree.order) == list(range(700))
    for start, end, centre, radius in zip(tree.start, tree.end, tree.centre, tree.radius):
        assert np.linalg.norm(points[tree.order[start:end]] - points[centre], axis=1).max() <= radius + 1e-12


def test_clustered_data(monkeypatch):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 8)) * 4000
    data = np.floor(np.repeat(centres, 60, axis=0) + rng.normal(size=(2400, 8)) * 20)
    ids = np.arange(2400)
    found = {}
    for row, column, value in search(data[::60], ids[::60], data, ids, 5):
        found.setdefault(row, []).append((-value, column))
    for row, ranked in found.items():
        scores = data @ data[row * 60]
        assert ranked == sorted((-int(s), i) for i, s in enumerate(scores.tolist()) if i != row * 60)[:5]
    assert len(found) == 40


def test_repeated_query_rows(spark, monkeypatch):
    monkeypatch.setattr("hourstar.llm.topk.SHARD_ROWS", 10)
    monkeypatch.setattr("hourstar.llm.topk.BLOCK_ROWS", 2)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(40)]
    schema = "vec_id long, embedding array<double>"
    once = found(top_k(spark.createDataFrame(rows, schema), lambda c: c == 0, 10))
    assert once == found(top_k(spark.createDataFrame(rows + [rows[0]], schema), lambda c: c == 0, 10)) == plain(rows, lambda i: i == 0, 10)
    other = (0, rng.normal(size=4).tolist())
    both = found(top_k(spark.createDataFrame(rows + [other], schema), lambda c: c == 0, 10))
    assert both == sorted(once + plain([other] + rows[1:], lambda i: i == 0, 10))


def visited(spark, rows, is_query, k):
    """How many (query, shard) pairs are searched, and how many there are."""
    from pyspark.sql import functions as F

    from hourstar.llm import topk

    df = spark.createDataFrame(rows, "id long, vector array<double>")
    data, groups = topk.grouped(df.withColumn("length", F.size("vector")))
    home = topk.queries_at_home(data, is_query)
    place = ("group", "shard", "length")
    near = home.groupBy(*place).cogroup(data.groupBy(*place)).applyInPandas(topk.best_of(k), "query_id long, query long, id long, score long")
    n, shards = home.count(), sum(g.shards for g in groups)
    return n + topk.visits(home, near, groups, k).count(), n * shards


def test_shards_without_a_chance_are_not_visited(spark, monkeypatch):
    monkeypatch.setattr("hourstar.llm.topk.SHARD_ROWS", 50)
    monkeypatch.setattr("hourstar.llm.topk.BLOCK_ROWS", 7)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 8)) * 20
    rows = [(i, (centres[i % 40] + rng.normal(size=8) * 0.05).tolist()) for i in range(2000)]
    searched, pairs = visited(spark, rows, lambda i: i % 20 == 0, 5)
    assert searched < pairs / 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(top_k(df, lambda i: i % 20 == 0, 5)) == plain(rows, lambda i: i % 20 == 0, 5)
    # Without clusters every query meets every shard, and once.
    loose = [(i, rng.normal(size=32).tolist()) for i in range(600)]
    searched, pairs = visited(spark, loose, lambda i: i % 20 == 0, 5)
    assert searched == pairs


@pytest.mark.parametrize("groups", [1, 3, 1024])
def test_groups_do_not_change_the_result(spark, monkeypatch, groups):
    monkeypatch.setattr("hourstar.llm.topk.SHARD_ROWS", 30)
    monkeypatch.setattr("hourstar.llm.topk.GROUPS", groups)
    rng = np.random.default_rng(10)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(200)] + [(200 + i, [0.5, 0.5, 0.5]) for i in range(100)]
    rows += [(300 + i, [1e6 * (i % 3), 3e5 - i, 7.0, 1e5]) for i in range(70)] + [(400, [1e3, 1.0]), (401, [1.0, 1e-300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(top_k(df, lambda i: i % 10 == 0, 6)) == plain(rows, lambda i: i % 10 == 0, 6)
