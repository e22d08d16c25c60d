"""Encoding, decoding and counting against the libraries, on awkward and on whole real texts."""

import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hourstar.llm.bpe import codec, merge
from hourstar.llm.queries import op2_bpe, op7_token_count, tokenizer_file
from hourstar.llm.token_count import count_tokens, transducer

SF_DIR = "/root/testdata/sf0.001"
PIECES = ["a", "é", "é", "ß", "Σ", "İ", "ﬀ", " ", "  ", "\n", "\r\n", "\x1c", "\x85", "\xa0", " ", "​", "\0", "'s", "'ll", "'S",
          "1", "½", "漢", "😀", "<|endoftext|>", "<|startoftext|>", "<|endo", "́", "...", "the", "ing", "_", "﻿", "\x1f"]
LONG = ["", " ", "a" * 5000, "ab" * 3000, "é" * 1000, "x " * 20_000, " " * 4000, "<|endoftext|>" * 3000]


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), codec(tokenizer_file("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def counter():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), transducer(tokenizer_file("byte_bpe_50k.json"))


def texts():
    rng = random.Random(3)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 40))) for _ in range(600)] + LONG


def test_ids_and_decoding(words):
    library, own = words
    for text in texts():
        wanted = library.encode(text, add_special_tokens=False).ids
        ids = own.encode(text)
        assert ids.tolist() == wanted, text[:60]
        assert own.decode(ids) == library.decode(wanted, skip_special_tokens=False)


def test_every_code_point(words):
    library, own = words
    points = [chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000]
    for form in ("a{}a", "{}", "é{}\u0301", "1{}Σ"):
        texts = ["".join(form.format(c) for c in points[k : k + 64]) for k in range(0, len(points), 64)]
        for text, wanted in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
            assert own.encode(text).tolist() == wanted.ids, ascii(text[:20])


def test_pairs_of_code_points_that_versions_know_differently(words):
    library, own = words
    rng = random.Random(5)
    odd = [chr(p) for p in range(0x110000) if not 0xD800 <= p < 0xE000 and own.doubtful.match(chr(p))]
    known = [c for c in map(chr, range(0x1E00, 0x20000)) if not 0xD800 <= ord(c) < 0xE000 and own.doubtful.match(c)]
    for _ in range(4000):
        text = "".join(rng.choice((odd, known, PIECES))[rng.randrange(30)] if rng.random() < 0.2 else rng.choice(known) for _ in range(rng.randint(1, 12)))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_files_of_other_kinds_are_refused():
    with pytest.raises(ValueError, match="not a file"):
        codec(tokenizer_file("byte_bpe_50k.json"))


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_any_text(words, counter, text):
    assert words[1].encode(text).tolist() == words[0].encode(text, add_special_tokens=False).ids
    assert counter[1].count(text, 5) == len(counter[0].encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("chunk", [5, 64, 1 << 15])
def test_counts_do_not_depend_on_chunks(counter, chunk):
    library, own = counter
    for text in texts():
        if len(text) < 3000 or chunk > 5:
            assert own.count(text, chunk) == len(library.encode(text, add_special_tokens=False).ids), text[:60]


def test_composition_is_associative(counter):
    own = counter[1]
    rng = random.Random(5)
    for _ in range(200):
        a, b, c = (own.chunk_map("".join(rng.choices(PIECES, k=rng.randint(0, 6)))) for _ in range(3))
        total = lambda m: own.run(m.head) + m.count + own.run(m.tail)
        assert total(own.compose(own.compose(a, b), c)) == total(own.compose(a, own.compose(b, c)))


def test_emptied_state_table_changes_nothing(counter, monkeypatch):
    monkeypatch.setattr("hourstar.llm.token_count.STATES", 20)
    counter[1].composed.clear()
    text = "the quick brown foxes are jumping over the lazier dogs " * 20
    assert counter[1].count(text) == len(counter[0].encode(text, add_special_tokens=False).ids)


def test_stale_entries_are_skipped():
    ranks = {(1, 1): (0, 2), (2, 1): (1, 3), (2, 2): (2, 4)}
    assert merge([1, 1, 1], ranks) == [3]
    assert merge([1] * 4, ranks) == [4]
    assert merge([], ranks) == [] and merge([7], ranks) == [7]


def test_queries_over_whole_tables(spark, words, counter):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op2_bpe(spark, SF_DIR).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = words[0].encode(docs[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(words[0].decode(ids, skip_special_tokens=False).encode()).hexdigest()
    for r in op7_token_count(spark, SF_DIR).collect():
        n = len(counter[0].encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 512)


def test_nulls_repeats_and_clashing_columns(spark):
    spec = tokenizer_file("byte_bpe_50k.json")
    df = spark.createDataFrame([(1, None, 5), (1, "a b", 6), (1, "a b", 6), (None, "", 7)], "doc_id long, text string, id int")
    rows = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in count_tokens(df, spec).collect())
    assert rows == [(0, 0, 0), (1, 0, 0), (1, 3, 2), (1, 3, 2)]
    assert count_tokens(df.limit(0), spec).count() == 0
