import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hourstar.llm import lexical
from hourstar.llm.lexical import INDEX_ARROW, Best, OpenShard, Shard, count_terms, dampers, top_documents

TERMS = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def plain_terms(text):
    return Counter(re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERMS.findall(text or ""))


def plain(docs, queries, k):
    """{(query id, text): [(id, score)]}, every document scored."""
    counted = [(i, c, sum(c.values())) for i, t in docs if (c := plain_terms(t))]
    n, length = len(counted), sum(s for *_, s in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = {}
    for query, text in set(queries):
        scores = []
        for i, c, size in counted:
            m = 100 - 25 + (25 * size * n) // length
            score = 0
            for term, times in plain_terms(text).items():
                if term in c:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += times * w * ((1000000000 * c[term]) // (1000 * c[term] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        if scores:
            out[query, text] = [(None if gone else i, -s) for s, gone, i in sorted(scores)[:k]]
    return out


def check(spark, docs, queries, k):
    df = spark.createDataFrame([(*r, 0, "x") for r in docs], "doc_id long, text string, item_id int, score string")
    asked = spark.createDataFrame([(*r, 1) for r in queries], "item_id long, text string, doc_id int")
    rows = top_documents(df, asked, k).collect()
    got = sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in rows), key=str)
    wanted = [(q, rank, i, s) for (q, _), found in plain(docs, queries, k).items() for rank, (i, s) in enumerate(found, 1)]
    assert got == sorted(wanted, key=str)
    return got


def words(rng, n, most=400):
    return " ".join(f"w{int(most * rng.random() ** 3)}" for _ in range(n))


def test_against_every_document_scored(spark, monkeypatch):
    """Small shards, blocks of postings and blocks of queries."""
    monkeypatch.setattr(lexical, "SHARD_DOCS", 50)
    monkeypatch.setattr(lexical, "BLOCK", 4)
    monkeypatch.setattr(lexical, "QUERY_TERMS", 60)
    rng = random.Random(5)
    docs = [(k, words(rng, rng.choice([1, 5, 40, 200]))) for k in range(600)]
    queries = [(k, words(rng, rng.choice([1, 3, 20, 50]))) for k in range(12)] + [(50, "nothing of this"), (51, "W0, w1; W0 w399!")]
    assert len(check(spark, docs, queries, 7)) > 60


def test_ties_copies_and_awkward_rows(spark):
    docs = [(k, "Alpha beta") for k in range(30, 0, -1)] + [(None, "alpha beta"), (3, "alpha beta"), (3, "ALPHA"), (70, None), (71, ""), (72, "-- !"), (73, "Éa Ω alpha1 " * 3)]
    queries = [(1, "alpha"), (1, "alpha"), (1, "beta beta"), (None, "alpha Éa"), (2, None), (3, ""), (4, "éa Ω")]
    got = check(spark, docs, queries, 20)
    assert [r[2] for r in got if r[0] == 4] == [73]
    check(spark, docs, queries, 100)
    assert check(spark, [], queries, 5) == [] == check(spark, docs, [], 5) == check(spark, [(1, None)], queries, 5)


@pytest.mark.parametrize("text", ["", "A-b_C1\x00\x7f ÀÉ x" + "y" * 50, "a b " * 100])
def test_terms(text, monkeypatch):
    for size in (3, 1 << 20):
        monkeypatch.setattr(lexical, "PART", size)
        assert {t.decode(): n for t, n in count_terms(text).items()} == dict(plain_terms(text))


def test_blocks_of_non_essential_lists_stay_closed():
    """Candidates of a rare term; the common term's blocks are opened only where a candidate lies that may still get in."""
    shard, rng = Shard(), random.Random(6)
    for k in range(8000):
        found = {b"common": rng.randint(1, 3)}
        if k % 400 == 0:
            found[b"rare"] = 1 + k // 4000
        shard.docs += 1
        shard.length += 100
        shard.add(k, 100, found)
    row = pa.RecordBatch.from_pylist([shard.row()], INDEX_ARROW)
    query = [("rare", 8000), ("common", 40)]

    def opened():
        return OpenShard({c: row.column(c)[0] for c in row.schema.names}, 8000, 800_000)

    full = opened()
    places, scores = full.search(query, 0)
    assert len(places) == 8000 and len(full.opened) == len(full.lasts)
    best = Best(10)
    best.add(scores, full.ids[places], full.missing[places])
    again = opened()
    found, found_scores = again.search(query, best.threshold)
    same = Best(10)
    same.add(found_scores, again.ids[found], again.missing[found])
    assert same.ids.tolist() == best.ids.tolist() and same.scores.tolist() == best.scores.tolist()
    # One block of the rare term, and at most one for each of its documents with two occurrences.
    assert len(again.opened) <= 11


def test_lengths_beyond_64_bits():
    assert dampers(np.array([1, 1 << 40]), 1 << 40, 1 << 50).tolist() == [75, 75 + 25 * (1 << 30)]
