import random
import re
import zlib
from collections import Counter

from fathomkit.llm.spelling import PositionIndex, block_rows, followed, near_words, spelling_variants, word_counts


def edits(word, letters):
    """All texts that one inserted, deleted or replaced letter makes of ``word``."""
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out - {word}


def reference(words, ratio=5):
    letters, near, form = {c for w in words for c in w}, {}, {}
    for w, n in words.items():
        near[w] = sorted((x for x in edits(w, letters) if x in words), key=lambda x: (-words[x], x))
        form[w] = next((x for x in near[w][:1] if words[x] >= ratio * n), None)
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: r[0])


def crowd(size, seed=3):
    """Words over few letters, of many lengths, with runs of one letter, so that nearly all have many near words."""
    rng = random.Random(seed)
    words = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 9))) for _ in range(size)}
    return {w: rng.choice((1, 1, 2, 5, 10, 30, 200)) for w in words}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def test_index_against_all_edits():
    words = sorted(crowd(400))
    letters = {c for w in words for c in w}
    for q, found in PositionIndex(words).near(words):
        assert {w for i, w in enumerate(words) if found >> i & 1} == edits(q, letters) & set(words)


def test_index_splits_pairs_by_common_beginning():
    words = sorted(crowd(300))
    index = PositionIndex(words)
    whole = dict(index.near(words))
    for q in words:
        m = len(q)
        cuts = [m * i // 3 for i in range(4)]
        parts = [found for lo, hi in zip(cuts, [*cuts[1:-1], 1 << 30]) if lo <= m
                 for _, found in index.near([q], lo, hi)]
        assert sum(parts) == whole[q]


def test_all_words_whatever_the_blocks(spark):
    words = crowd(700)
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    want = reference(words)
    for segments, block_words in ((3, 8192), (3, 5), (2, 1), (1, 100), (4, 0)):
        assert rows(spelling_variants(df, 5, segments, block_words)) == want, (segments, block_words)


def test_one_block_for_a_third_of_the_words(spark):
    rng = random.Random(5)
    words = {"prefixpre" + "".join(rng.choice("abcdefgh") for _ in range(4)): rng.randint(1, 90) for _ in range(1500)}
    words |= crowd(1500)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    sizes = block_rows(df, 3, 100).groupBy("block").count().agg({"count": "max"}).first()[0]
    assert sizes <= 100 + 64
    got = near_words(df, 3, 100).select("word", "n_near", "best").collect()
    want = {r[0]: r[4] for r in reference(words) if r[4]}
    assert {r.word: r.n_near for r in got} == want


def test_long_chains(spark):
    links = [(str(i), str(i + 1)) for i in range(27)]
    got = followed(spark.createDataFrame(links, "word string, form string")).collect()
    assert {(r.word, r.root) for r in got} == {(str(i), "27") for i in range(27)}


def test_counts_of_runs_with_typos(odd, empty):
    for every in (0, 3, 199):
        want = Counter()
        for r in odd.select("doc_id", "text").collect():
            text = "".join(c.lower() if c.isascii() else c for c in r.text or "")
            for run in re.findall("[a-zÀ-ÿ]+", text):
                h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
                want[run[:h % len(run)] + run[h % len(run) + 1:] if every and h % every == 0 else run] += 1
        got = {r.word: r.n for r in word_counts(odd, 4, 2, every).collect()}
        assert got == {w: n for w, n in want.items() if len(w) >= 4 and n >= 2}
    assert spelling_variants(word_counts(empty)).collect() == []
    assert spelling_variants(word_counts(odd)).count() > 0


def test_letters_outside_ascii_keep_their_case(spark):
    text = "ÉCOLES écoles École's ecoles " * 6 + "straße STRASSE x÷yzabc"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r.word: (r.n, r.n_near) for r in spelling_variants(word_counts(docs, 5, 1)).collect()}
    assert got["Écoles"] == (6, 3) and got["écoles"] == (6, 2) and got["ecoles"] == (6, 2) and got["École"] == (6, 1)
    assert got["straße"] == (1, 0) and got["strasse"] == (1, 0) and got["x÷yzabc"] == (1, 0)
