import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hourstar.llm.queries import op9_simhash
from hourstar.llm.shared import components, forest
from hourstar.llm.simhash import fingerprint, golay_indices, keys_of, linked_parts, near_duplicates

SF_DIR = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, f"{prints[i]:016x}", least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def test_golay_code_is_perfect():
    assert (np.bincount(golay_indices()) == 2048).all()


def test_keys_meet_within_four_bits():
    rng = np.random.default_rng(1)
    for _ in range(400):
        a = rng.integers(0, 2**64, dtype=np.uint64)
        b = a
        for bit in rng.choice(64, rng.integers(1, 5), replace=False):
            b ^= np.uint64(1 << int(bit))
        keys, owners = keys_of(np.array([a, b]).view(np.int64))
        assert set(keys[owners == 0]) & set(keys[owners == 1])


def test_parts_of_a_key():
    values = np.array([0, 1, 3, 0xFF, 0x1FF, 1 << 40 | 1 << 41 | 0xFFFF00], np.int64)
    assert dict(linked_parts(values)) == {1: 0, 3: 0, 0x1FF: 0xFF}
    far = np.array([0, 0x1F, 0x1F << 20], np.int64)
    assert list(linked_parts(far)) == []


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One TWO three", "a b c d", "Ünï x y z w " * 30, "x " * 70_000])
def test_fingerprint(text):
    assert fingerprint(text or "") == plain_fingerprint(text)


def test_components_against_brute_force(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choices("alpha beta gamma delta epsilon zeta eta theta".split(), k=60)) for _ in range(12)]
    rows = [(i, rng.choice(base)) for i in range(60)]
    for i in range(60, 160):  # near copies of the hot text, some of them in chains
        words = base[0].split() if i % 2 else rows[i - 1][1].split()
        words[rng.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(None, base[1]), (None, None), (200, None), (201, ""), (201, ""), (202, "word"), (None, "alone in the world here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("id", F.lit(1))
    found = [tuple(r) for r in near_duplicates(df).collect()]
    assert sorted(found, key=str) == sorted(plain_components(rows), key=str)


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_chain(spark):
    chain = spark.range(300).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    more = spark.createDataFrame([(1000, 1001), (1001, 1000), (1002, 1001), (-5, -5)], "a long, b long")
    found = {r.node: r.root for r in components(chain.union(more)).collect()}
    assert found == {**{k: 0 for k in range(301)}, 1000: 1000, 1001: 1000, 1002: 1000}
    assert components(chain.limit(0)).count() == 0


def test_forest():
    assert dict(forest([(1, 2), (5, 2), (9, 8), (8, 9), (7, 7)])) == {2: 1, 5: 1, 9: 8}


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = [tuple(r) for r in op9_simhash(spark, SF_DIR).select("doc_id", "fingerprint", "component_id").collect()]
    assert sorted(found) == sorted(plain_components(rows))
