import random
import re

import duckdb

from hourstar.llm.decontaminate import contaminated, item_shingles, sketched
from hourstar.llm.queries import op6_decontamination

SF_DIR = "/root/testdata/sf0.01"


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(docs, items):
    own = {}
    for item, text in items:
        own.setdefault(item, set()).update(shingles(text))
    out = []
    for doc, text in docs:
        held = shingles(text)
        for item, wanted in own.items():
            if wanted and 10 * len(wanted & held) >= 8 * len(wanted):
                out.append((doc, item, len(wanted & held), len(wanted)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.item_id, r.shared, r.item_shingles) for r in df.collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([3, 5, 6, 9, 14, 30, 60])))) for i in range(40)]
    items += [(40, ""), (41, None), (42, "Just four small Words"), (3, items[3][1]), (None, "an item that has no id at all"), (43, "a a a a a a a a")]
    docs = []
    for k in range(300):
        words = rng.choices(vocabulary, k=rng.randint(0, 200))
        text = (rng.choice(items)[1] or "").split()
        for _ in range(rng.choice([0, 0, 1, 2, 4])):  # some words changed, so that containment falls below the threshold
            if text:
                text[rng.randrange(len(text))] = "changed"
        docs.append((k, " ".join(words) + "\n" + ", ".join(text).upper() + "! " + " ".join(rng.choices(vocabulary, k=20))))
    docs += [(1000, None), (1001, ""), (1002, "just FOUR small words"), (1003, "a " * 9), (None, items[8][1]), (7, docs[7][1]),
             (1004, " ".join(rng.choices(vocabulary, k=120_000)) + " " + items[9][1])]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, shingle string, size int")
    result = found(contaminated(df, spark.createDataFrame(items, "item_id long, text string")))
    assert result == plain(docs, items)
    assert len(result) > 60


def test_sketch_covers_the_allowed_gaps(spark):
    items = spark.createDataFrame([(n, " ".join(f"a{k}" for k in range(n + 4))) for n in (1, 2, 4, 5, 9, 10, 33)], "item_id long, text string")
    rows = sketched(item_shingles(items, "item_id", "text")).collect()
    for n in (1, 2, 4, 5, 9, 10, 33):
        own = [r for r in rows if r.item == n]
        assert len(own) == n and own[0].size == n
        kept = sum(r.in_sketch for r in own)
        assert kept > n - -(-8 * n // 10)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert contaminated(docs.limit(0), items).count() == 0
    assert contaminated(docs, items.limit(0)).count() == 0


def test_query_over_whole_tables(spark):
    read = lambda name, key: duckdb.sql(f"SELECT {key}, text FROM '{SF_DIR}/{name}.parquet'").fetchall()
    wanted = plain(read("documents", "doc_id"), read("benchmark", "item_id"))
    assert found(op6_decontamination(spark, SF_DIR)) == wanted
    assert wanted


def test_texts_of_one_id_are_searched_for_each(spark):
    texts = [" ".join(f"{c}{k}" for k in range(20)) for c in "abcdef"]
    items = [(0, texts[0]), (0, texts[1]), (0, texts[1].upper()), (None, texts[2]), (None, texts[3]), (5, texts[4])]
    docs = [(k, f"before {text} after") for k, text in enumerate(texts)] + [(9, texts[0] + " " + texts[1])]
    result = found(contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")))
    wanted = [(0, 0), (1, 0), (2, None), (3, None), (4, 5), (9, 0), (9, 0)]
    assert result == sorted(((d, i, 16, 16) for d, i in wanted), key=str)
