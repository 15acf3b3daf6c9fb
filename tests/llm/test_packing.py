import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from fathomkit.llm.packing import Codec, default_tokenizer, fullest, pack, plan_bins, sequences


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_tokenizer())


def reference_pieces(tokenizer, text, capacity=2048):
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
    first = (len(ids) - 1) % capacity + 1
    cuts = [0, *range(first, len(ids) + 1, capacity)]
    return [(k, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes()))
            for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def check(rows, docs, tokenizer, capacity=2048):
    want = sorted((str(i), *p) for i, t in docs for p in reference_pieces(tokenizer, t, capacity))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(r.length for r in rows)
    return len(places), -(-total // capacity)


def test_all_documents_in_the_fewest_sequences(spark, docs, tokenizer):
    used, least = check(pack(docs).collect(), docs.select("doc_id", "text").collect(), tokenizer)
    assert used <= least + 1


def test_odd_rows(odd, tokenizer):
    check(pack(odd).collect(), odd.select("doc_id", "text").collect(), tokenizer)


def test_small_capacity_and_empty_table(odd, empty, tokenizer):
    check(pack(odd, capacity=64).collect(), odd.select("doc_id", "text").collect(), tokenizer, 64)
    assert pack(empty).collect() == []


def test_ids_of_any_text(tokenizer):
    import json

    codec = Codec(json.load(open(default_tokenizer(), encoding="utf-8")))
    texts = [
        "", " ", "  a", "a  b", "a \n b", "a\n\nb ", " a", "a ", "it's we'll I'M", "x<|endoftext|>y <|endoftext|>",
        " a 　 b", " a b", "naïve 12,345 --- \U0001f600", "a\tb \t c", "\x1c a \x1d", "a\r\nb", "¿qué? «x»",
    ]
    for t in texts:
        assert list(np.frombuffer(codec.encode(t), "<u4")) == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_fullest_against_all_combinations():
    from itertools import product

    rng = np.random.RandomState(3)
    for _ in range(200):
        counts = {int(n): int(rng.randint(1, 4)) for n in rng.randint(1, 30, 4)}
        gap = int(rng.randint(0, 60))
        items = sorted(counts.items(), reverse=True)
        uses = fullest(items, gap)
        got = sum(n * k for n, k in uses.items())
        assert all(uses[n] <= counts[n] for n in uses) and got <= gap
        sums = (sum(n * k for (n, _), k in zip(items, ks)) for ks in product(*(range(c + 1) for _, c in items)))
        assert got == max(s for s in sums if s <= gap)


def test_plan_uses_every_length_once():
    histogram = {2048: 3, 1000: 5, 700: 9, 48: 7, 3: 1000, 1: 10_000}
    plan = plan_bins(histogram)
    taken = {}
    for times, uses in plan:
        assert sum(n * k for n, k in uses.items()) <= 2048
        for n, k in uses.items():
            taken[n] = taken.get(n, 0) + times * k
    assert taken == histogram


def test_sequences_hold_the_ids(docs, tokenizer):
    packed = pack(docs.limit(40), keep_ids=True)
    for row in sequences(packed).collect():
        assert 0 < len(row.ids) <= 2048
    texts = {r.doc_id: r.text for r in docs.limit(40).collect()}
    for r in packed.collect():
        ids = [*tokenizer.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 0]
        assert r.ids == ids[r.start: r.start + r.length]
