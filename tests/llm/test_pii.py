import hashlib
import random
import re

import numpy as np
import pytest

from hourstar.llm import pii
from hourstar.llm.pii import FEATURES, KINDS, Model, as_text, boost, calibrate, find, fit
from hourstar.llm.queries import op13_pii

SF_DIR = "/root/testdata/sf0.001"
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_right(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        turned = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in turned) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    spans = []
    for k, kind in enumerate(KINDS):
        spans += [(m.start(), k, m.end()) for m in re.finditer(BASE[kind], text or "") if is_right(kind, m.group())]
    return sorted(spans)


def joined(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


AWKWARD = [
    None, "", "plain words", "a@b.cd_e@f.gh", "x.@y.z@w.v", "é.a@b.c.", "..@-.-", "a@b", "a@b..c", "1.2.3.4.5.6.7.8", "0001.2.3.255 1.2.3.256 1.2.3",
    "𝔘𝔫𝔦 me@x.org 😀 10.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1111.", "4111  1111", "41111111111111111111111111", "000000000000", "+1 (017) 555-7713", "++1 (2) 3",
    "+49.30.1234567+44 20 1234567", "+(12) 345678901", "+1 2", "5 +123456789) ", "1.2.3.4@x.y 1.2.3.4", "a@b.c" * 5, "٣.1.2.3.4", "\n10.0.0.1\r\n+123 456 789\n",
    "1-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1-", "1 " * 40 + "x", "id 4111111111111111id",
]


def check(spark, texts, model=Model()):
    docs = spark.createDataFrame([(k % 3 or None, t, "s") for k, t in enumerate(texts)], "doc_id long, text string, spans string")
    rows = find(docs, model).select("*", as_text("spans").alias("all"), as_text("base").alias("named")).collect()
    assert len(rows) == len(texts)
    wanted = sorted((joined(plain(t)), *[sum(k == s[1] for s in plain(t)) for k in range(4)]) for t in texts)
    assert sorted((r.named, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in rows) == wanted
    return rows


def test_base_spans_against_plain_patterns(spark):
    rng = random.Random(3)
    random_texts = ["".join(rng.choices("19.@+- (a_é", weights=[6, 6, 4, 2, 2, 2, 2, 1, 2, 1, 1], k=rng.randint(1, 120))) for _ in range(1500)]
    rows = check(spark, AWKWARD + random_texts)
    assert all(r.all == r.named for r in rows)


def test_very_many_matches_and_long_runs(spark):
    """Texts that take the plain patterns quadratic time; their spans are known."""
    texts = ["9" * 300_000, "a" * 300_000 + " " + "1 " * 100_000, "#" * 200_000 + "a@b.cd, " * 20_000, "+1 (017) 555-7713\n" * 9_000]
    wanted = [[], [], [(200_000 + 8 * k, 0, 200_006 + 8 * k) for k in range(20_000)], [(18 * k, 3, 18 * k + 17) for k in range(9_000)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in find(docs, Model()).collect():
        assert [(s.start, s.kind, s.end) for s in r.base] == wanted[r.doc_id]


def sample_docs():
    """Phone numbers of one format: with a plus they are base spans, a few lack it; other numbers are none."""
    rng = random.Random(4)
    texts = []
    for k in range(1200):
        number = f"({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
        texts.append(f"{k} please call us: {'1 ' if k % 40 == 0 else '+1 '}{number} soon, order {rng.randint(10**8, 10**9)} was sent")
    return texts


def test_candidates_that_look_like_base_spans_are_added(spark):
    texts = sample_docs()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = fit(docs)
    assert model.thresholds[KINDS.index("phone")] is not None
    rows = {r.doc_id: r for r in find(docs, model).collect()}
    for k, text in enumerate(texts):
        added = [tuple(s) for s in rows[k].spans if s not in rows[k].base]
        assert [(s.start, s.kind, s.end) for s in rows[k].base] == plain(text)
        if k % 40 == 0:
            assert len(added) == 1 and text[added[0][0] : added[0][2]].endswith(re.search("555-....", text).group())
        else:
            assert not added
    assert fit(docs.limit(0)) == Model() == fit(docs.selectExpr("doc_id", "cast(null AS string) AS text"))


def test_trees_in_sql_score_as_the_fitted_ones(spark):
    rng = np.random.default_rng(5)
    x = {name: rng.integers(0, size, 400) for name, size in FEATURES.items()}
    chance = (x["digits"] > 4) * 0.5 + (x["cue"] * x["grouped"]) * 0.4 + 0.05
    good = rng.binomial(50, chance).astype(float)
    model = boost(x, good, 50 - good)
    scores = model.scores(x)
    assert np.abs(scores - chance).mean() < 0.08
    rows = spark.createDataFrame([tuple(int(x[n][k]) for n in FEATURES) for k in range(400)], ", ".join(f"{n} int" for n in FEATURES))
    from pyspark.sql import functions as F
    got = [r.s for r in rows.select(model.score(F.struct(*FEATURES)).alias("s")).collect()]
    assert np.allclose(got, scores)
    limits = calibrate(model, x, good, 50 - good).thresholds
    for kind, limit in enumerate(limits):
        mine = (x["kind"] == kind) & (scores >= (2 if limit is None else limit))
        assert limit is None or good[mine].sum() >= 0.9 * 50 * mine.sum()


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.cd")], "doc_id long, text string")
    plan = find(docs, Model())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query_over_the_whole_table(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op13_pii(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        base = joined(plain(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
    assert sum(r.n_email for r in rows) > 0


@pytest.mark.parametrize("kind", KINDS)
def test_feature_codes_stay_in_their_range(spark, kind):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame([(t or "", b) for t in AWKWARD for b in ("", "x", "7", "!", "my card, tel: ", "token = ")], "m string, b string")
    codes = rows.select(*pii.features(kind, F.col("m"), F.col("b"), F.col("b"), F.lit(True))).distinct().collect()
    assert all(0 <= r[name] < size for r in codes for name, size in FEATURES.items())
