import itertools
import random
import re
import zlib

import pytest

from hourstar.llm import spelling
from hourstar.llm.queries import op12_spelling
from hourstar.llm.spelling import near_in_list, near_pairs, near_words, spelling_groups

SF_DIR = "/root/testdata/sf0.001"


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_counts(rows):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def plain(rows):
    """word: (n, n_near, form, form_n, root) from all pairs of words."""
    counts = plain_counts(rows)
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    forms = {}
    for w, n in counts.items():
        others = [o for k in (-1, 0, 1) for o in by_length.get(len(w) + k, []) if near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        forms[w] = (len(others), best if best and counts[best] >= 5 * n else None)
    out = []
    for w, n in counts.items():
        root = w
        while forms[root][1]:
            root = forms[root][1]
        form = forms[w][1]
        out.append((w, n, forms[w][0], form, counts.get(form), root))
    return sorted(out)


def found(df):
    return sorted((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect())


def common(a, b):
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return k


def test_scan_of_a_list():
    rng = random.Random(1)
    for _ in range(2000):
        words = sorted({"".join(rng.choices("abé", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 20))})
        shared = [0] + [common(a, b) for a, b in zip(words, words[1:])]
        word = "".join(rng.choices("abé", k=rng.randint(1, 6)))
        assert [words[i] for i in near_in_list(word, words, shared)] == [w for w in words if near(word, w)]


def test_skipped_ranges_are_not_read():
    class Counted(str):
        read = 0

        def __getitem__(self, at):
            Counted.read += 1
            return str.__getitem__(self, at)

    words = sorted("zz" + "".join(p) for p in itertools.product("abcdef", repeat=4))
    shared = [0] + [common(a, b) for a, b in zip(words, words[1:])]
    assert list(near_in_list("aaaaaa", [Counted(w) for w in words], shared)) == []
    assert Counted.read == 2


def test_pairs_of_a_list_are_those_of_its_places():
    words = ["abcdef", "abcdeg", "abxdef", "abcdeff", "abcddef", "zbcdef"]
    got = {(a, b) for low, high in ((0, 3), (3, 7)) for a, _, b, _ in near_pairs([(w, 1) for w in words], 6, low, high, low == 0)}
    wanted = {frozenset((a, b)) for a in words for b in words if near(a, b) and min(len(a), len(b)) == 6}
    assert {frozenset(p) for p in got} == wanted and len(got) == len(wanted)


@pytest.mark.parametrize("limit", [1, 4, 512])
def test_lists_of_any_size_keep_every_pair(spark, monkeypatch, limit):
    """A third of all words begin alike, as many end alike; small limits force halves of halves."""
    monkeypatch.setattr(spelling, "LIST", limit)
    rng = random.Random(3)
    words = {"enormous" + "".join(rng.choices("ab", k=rng.randint(1, 5))) for _ in range(60)}
    words |= {"".join(rng.choices("ab", k=rng.randint(1, 5))) + "enormous" for _ in range(60)}
    words |= {"".join(rng.choices("abc", k=rng.randint(6, 8))) for _ in range(80)} | {"ab" * 300, "ab" * 300 + "a"}
    pairs = near_words(spark.createDataFrame([(w, 5) for w in words], "word string, n long")).collect()
    got = [frozenset((r.a, r.b)) for r in pairs]
    assert len(got) == len(set(got))
    assert set(got) == {frozenset((a, b)) for a in words for b in words if near(a, b)}


def test_words_forms_and_roots(spark):
    text = "Château " * 125 + "chateau " * 25 + "chateaux " * 5 + "chatea " * 25 + "gateau! " * 3 + "x1y ÀBÇDEF "
    rows = [(1, text), (1, text), (None, "Gateau gateau"), (2, None), (3, ""), (None, "gateau " * 9), (4, "ÿ÷×ÿÀÀ " * 6)]
    docs = spark.createDataFrame([(*r, 1, "n") for r in rows], "doc_id long, text string, word int, n string")
    got = found(spelling_groups(docs))
    assert got == plain(rows)
    assert {r[0]: (r[3], r[5]) for r in got}["chateaux"] == ("chateau", "château")
    assert spelling_groups(docs.limit(0)).count() == 0


def test_long_text_is_counted_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 10)
    rng = random.Random(4)
    rows = [(k, " ".join("".join(rng.choices("ab", k=7)) for _ in range(3000))) for k in range(6)]
    assert found(spelling_groups(spark.createDataFrame(rows, "doc_id long, text string"))) == plain(rows)


def test_query_over_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    got = found(op12_spelling(spark, SF_DIR))
    assert got == plain(rows)
    assert sum(r[3] is not None for r in got) > 5
