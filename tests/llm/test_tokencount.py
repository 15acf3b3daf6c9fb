import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fathomkit.llm.jobs import QUERIES
from fathomkit.llm.tokencount import TokenCounter, default_tokenizer, token_counts, whole_tokens

BYTE_LEVEL = default_tokenizer().replace("word_bpe_49k", "byte_bpe_50k")


def spec_of(path):
    with open(path, encoding="utf-8") as f:
        return f.read()


@pytest.fixture(scope="module")
def both():
    spec = spec_of(default_tokenizer())
    return TokenCounter(spec, whole_tokens(spec)), Tokenizer.from_str(spec)


def reference(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_all_documents(spark, sf, docs, both):
    got = {r.doc_id: r for r in QUERIES["op12_token_counts"](spark, sf).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        n = reference(both[1], r.text)
        assert got[r.doc_id][1:] == (len((r.text or "").encode()), n, n > 2048)


def test_odd_rows(odd, empty, both):
    want = sorted((str(r.doc_id), reference(both[1], r.text)) for r in odd.select("doc_id", "text").collect())
    out = token_counts(odd, "odd_count")
    assert out.columns == [*odd.columns, "odd_count"]
    assert sorted((str(r.doc_id), r.odd_count) for r in out.collect()) == want
    assert token_counts(empty).collect() == []


# Spaces of all kinds, letters with marks apart and together, final and capital forms, special strings in parts.
HARD = [
    "", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", " ", " ", " ", " ",
    " ", "　", "​", "﻿", "\x00", "a", "B", "é", "́", "̸", "=", "É", "ß", "İ", "Σ", "ΟΔΟΣ", "ǅ", "ﬁ",
    "한", "한", "中文", "क्षि", "\U0001f600", "\U0001d400", "½", "٣", "12345", "'s", "'S", "'re", "it's", "'",
    "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "--", "...", "x" * 70, "the", "The", "naïve",
]


def test_pieces_of_hard_text(both):
    rng = random.Random(11)
    for _ in range(6000):
        text = "".join(rng.choice(HARD) for _ in range(rng.randint(1, 9)))
        assert both[0].count(text) == reference(both[1], text), repr(text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=("Cs",)), max_size=60))
def test_any_text(both, text):
    assert both[0].count(text) == reference(both[1], text)


def test_whole_tokens_are_proven(both):
    spec = spec_of(default_tokenizer())
    whole = whole_tokens(spec)
    assert len(whole) == len(set(whole)) > 30_000
    model = both[1].model
    assert all(len(model.tokenize(w)) == 1 for w in whole)


def test_merges_only_run_for_the_rest(both):
    spec = spec_of(default_tokenizer())
    counter = TokenCounter(spec, whole_tokens(spec))
    merged = []
    counter.merge = lambda token: merged.append(token) or both[1].model.tokenize(token)
    text = "the house of zzyzxqv and the house"
    assert counter.count(text) == reference(both[1], text)
    assert merged == ["zzyzxqv"]


def test_forgetting_changes_nothing(both, monkeypatch):
    monkeypatch.setattr("fathomkit.llm.tokencount.CACHE_CHARS", 20)
    spec = spec_of(default_tokenizer())
    counter = TokenCounter(spec, whole_tokens(spec))
    text = " ".join(f"word{i % 9} other{i}" for i in range(200))
    assert counter.count(text) == reference(both[1], text)
    assert counter.chars <= 20 + 64


def test_a_vocabulary_that_keeps_spaces():
    spec = spec_of(BYTE_LEVEL)
    counter, tokenizer = TokenCounter(spec, whole_tokens(spec)), Tokenizer.from_str(spec)
    assert not counter.spaceless
    rng = random.Random(12)
    for _ in range(2000):
        text = "".join(rng.choice(HARD) for _ in range(rng.randint(1, 9)))
        assert counter.count(text) == reference(tokenizer, text), repr(text)
