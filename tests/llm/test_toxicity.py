import zlib

import pytest

from hourstar.llm.queries import op10_toxicity
from hourstar.llm.toxicity import Model, Reader, choose_stems, fit, grammar, is_toxic, sample, score, scores

SF_DIR = "/root/testdata/sf0.1"
READER = Reader(["idiot$", "lowe", "scum$"])


@pytest.mark.parametrize(("text", "found"), [
    ("this idiot came", {"I": 1}),
    ("You are an idiot.", {"D": 1}),
    ("idiot, that is what they are", {"D": 1}),
    ("he is not an idiot", {"n": 1}),
    ("they said the idiot was there", {"r": 1}),
    ("they said he was not an idiot", {"r": 1}),
    ("he came. an idiot", {"I": 1}),
    ("I will kill again", {"T": 1}),
    ("not to be able to see the idiot", {"I": 1}),
    ("loweish people; scum and scum", {"I": 3}),
    ("idiots and slower skills", {}),
    ("", {}),
    ("idiot " * 5, {"I": 5}),
    ("idiot idiot idiot idiot you", {"D": 4}),
    ("idiot " * 50 + "you scum. idiot", {"D": 51, "I": 1}),
])
def test_clauses(text, found):
    assert {k: n for k, n in READER.matches(text).items() if n} == found


def test_grammar_is_a_complete_table():
    table = grammar()
    assert all(set(row) == set("ITPNRO#") for row in table)
    assert all(0 <= state < len(table) for row in table for state, _ in row.values())


def test_stems_are_as_long_as_their_support_allows():
    counted = [("low", 40, 0), ("lowe", 40, 0), ("lowex", 9, 0), ("lowey", 30, 0), ("los", 20, 30), ("clo", 20, 0), ("clow", 20, 0), ("clown", 20, 0), ("clown$", 20, 0)]
    assert choose_stems(counted, 50, 500) == ("clown$", "lowe")


def plain_score(model, text):
    """Every word tried, clause by clause, without the automaton."""
    own, found = Reader(model.stems), {}
    import re
    from hourstar.llm.toxicity import features
    from collections import Counter
    found = Counter()
    for clause in re.split(r"[.!?;:\n]", text.lower()):
        words = re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", clause)
        symbols = [own.symbol.get(w) or ("I" if own.is_insult(w) else "O") for w in words]
        if not {"I", "T"} & set(symbols):
            continue
        negated, said, waiting, named = 0, False, 0, "P" in symbols
        for s in symbols:
            if s == "N":
                negated = 4
                continue
            kind = s
            if s in "IT":
                if negated > 1:
                    kind, negated = "n", 1
                if said:
                    kind = "r"
            said |= s == "R"
            negated = max(0, negated - 1)
            if kind == "I" and named:
                kind = "D"
            if kind in "IDnrT":
                found[kind] += 1
    z = sum(w * x for w, x in zip(model.weights, features(found)))
    return 1 / (1 + 2.718281828459045 ** -max(-30, min(30, z)))


@pytest.mark.parametrize(("sf_dir", "caught"), [(SF_DIR, 0.9), ("/root/testdata/check_s", 0.95)])
def test_query_over_whole_tables(spark, sf_dir, caught):
    """With the 329 toxic labels to learn from in the smaller tables fewer words are known."""
    rows = op10_toxicity(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert len(rows) == docs.count()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    right = {0: [0, 0], 1: [0, 0]}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
        if r.held_out and r.doc_id in toxic:
            right[toxic[r.doc_id]][r.predicted] += 1
    assert right[1][1] >= caught * sum(right[1]) and right[0][0] >= 0.99 * sum(right[0])


def test_scores_against_plain_reading(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in scores(docs, model).collect():
        assert abs(r.score - plain_score(model, texts[r.doc_id])) < 1e-9


def test_held_out_labels_are_not_used(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    assert fit(docs, labels) == fit(docs, flipped)


def test_awkward_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "you idiot", "y"), (3, "you idiot. " * 30_000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = Model(("idiot$",))
    found = {(r.doc_id, r.predicted) for r in scores(docs, model).collect()}
    assert found == {(1, 0), (2, 0), (None, 1), (3, 1)}
    assert docs.where(~is_toxic(model)("text")).count() == 3
    labels = spark.createDataFrame([(1, None), (None, 1), (9, 1)], "doc_id long, toxic int")
    twice = docs.union(spark.createDataFrame([(8, t, "x") for t in ("a word", "b word", "B word")], docs.schema)).repartition(3)
    eight = spark.createDataFrame([(8, 0)], "doc_id long, toxic int")
    assert [r.text for r in sample(twice, eight, "doc_id", "text").collect()] == ["B word"]
    assert fit(docs, labels) == Model() == fit(docs, labels.limit(0)) == fit(docs.limit(0), labels)
    assert scores(docs.limit(0), Model()).count() == 0
    assert {r.predicted for r in scores(docs, Model()).collect()} == {0}
    assert score(Model(), Reader(()).matches("")) < 0.3
