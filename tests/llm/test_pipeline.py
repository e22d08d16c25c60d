import random

from pyspark.sql import functions as F

import corpus_pipeline
from hourstar.llm import toxicity
from test_decontaminate import plain as plain_contamination
from test_simhash import plain_components

SF_DIR = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    model = toxicity.fit(docs, labels)
    reader = toxicity.Reader(model.stems)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    rows = [r for r in rows if toxicity.score(model, reader.matches(r[1])) < toxicity.THRESHOLD]
    rows = [r for r, (i, _, root) in zip(rows, plain_components(rows)) if i == root]
    held = {d for d, *_ in plain_contamination(rows, items)}
    wanted = {i for i, _ in rows if i not in held}
    found = [r.doc_id for r in corpus_pipeline.run(spark, SF_DIR).collect()]
    assert sorted(found) == sorted(wanted)
    assert 0 < len(wanted) < docs.count()


def test_stages_keep_columns_and_handle_awkward_rows(spark):
    text = " ".join(f"w{k}" for k in range(80))
    rows = [(1, text, "a", 1), (2, text, "b", 2), (2, text, "b", 2), (3, None, None, None), (4, "", "x", 0), (None, "some words of no one", "c", 3),
            (5, "other words " * 9, "d", 4), (5, "other words " * 9, "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _rank string, held int")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3, 5]
    assert corpus_pipeline.drop_toxic(spark, docs, SF_DIR).count() == len(rows)
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").first()[0]
    more = docs.union(spark.createDataFrame([(9, "before " + item.upper() + " after", "e", 1)], docs.schema))
    left = corpus_pipeline.drop_contaminated(spark, more, SF_DIR)
    assert left.where("doc_id = 9").count() == 0 and left.count() == len(rows)
    assert corpus_pipeline.encode(spark, docs.withColumn("ids", F.lit(1)), SF_DIR).count() == len(rows)


def test_one_row_of_each_group_stays(spark):
    """Against brute force on random near copies, copies, and repeated and missing ids."""
    rng = random.Random(8)
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(10_000)}" for _ in range(rng.choice([3, 60, 600]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = "changed"
            rows.append((rng.choice([None, *range(40)]), " ".join(words)))
    rows += [(50, "hot text of many copies")] * 80 + [(60 + k, "hot text of many Copies") for k in range(80)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, _name int")
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    places = [(k, t) for k, (_, t) in enumerate(rows)]
    groups = {}
    for k, _, root in plain_components(places):
        groups.setdefault(root, []).append(rows[k])
    assert len(kept) == len(groups) < 150
    group_of = {rows[k]: root for k, _, root in plain_components(places)}
    assert sorted(group_of[r] for r in kept) == sorted(groups)
    for doc_id, text in kept:
        ids = [i for i, _ in groups[group_of[doc_id, text]] if i is not None]
        assert doc_id == min(ids, default=None)


def test_stages_judge_rows_by_their_texts(spark):
    rng = random.Random(9)
    a, b, c, d = (" ".join(f"w{rng.randrange(10_000)}" for _ in range(60)) for _ in range(4))
    rows = [(3, a), (5, a), (5, b), (7, b), (None, c), (None, c), (None, d), (None, a), (8, c.upper()), (9, d), (9, d), (9, "alone")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, _name int")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(3, a), (5, b), (8, c.upper()), (9, d), (9, "alone")])
    nameless = docs.where("doc_id IS NULL")
    kept = corpus_pipeline.drop_near_duplicates(spark, nameless, "").collect()
    assert sorted(r.text for r in kept) == sorted([a, c, d]) and {r.doc_id for r in kept} == {None}


def test_contaminated_rows_go_alone(spark):
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("text").first()[0]
    rows = [(None, "before " + item + " after"), (None, "clean"), (None, None), (1, item), (1, "clean too"), (1, "")]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, _held int")
    left = corpus_pipeline.drop_contaminated(spark, docs, SF_DIR)
    assert left.columns == docs.columns
    assert sorted((r.text or "") for r in left.collect()) == ["", "", "clean", "clean too"]
