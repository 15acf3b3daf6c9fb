"""Spelling variants by a bit-sliced position index.

Words are near if one inserted, deleted or replaced letter turns one into the other. A vocabulary in any order has one
bitset per (position, letter), kept as one integer: the words with that letter there. A query word is followed letter by
letter with word-parallel recurrences over four bitsets: words equal so far, words with one letter replaced, and, by
positions shifted by one, words that lack a letter of the query or have one more. Queries in alphabetical order share the
states of their common beginning. Bits are in the order of falling counts, so the lowest bit that is left is the most
frequent near word.

No task holds the vocabulary. Let m be the length of the shorter word of a pair, cut into ``SEGMENTS`` parts: the letters
before and after one part are equal in both words (pigeonhole), so words fall into blocks by m, part, and what stands
around the part, two times ``SEGMENTS`` blocks a word. Each pair counts in one block alone: the one whose part holds the
end of their common beginning, which the recurrence tells. A block of more than ``BLOCK_WORDS`` words is dealt again by
the same rule with single letters as parts; what is left around one letter fixes all but one letter of the words of m
letters and all but two of the others, so with the 90 letters of runs (a-z and U+00C0 to U+00FF) such a block has at most
90 + 90 * 90 words, whatever the vocabulary. Nothing is dropped, and pairs are never rows.

Defined cases: a null text has no words, nor has one without letters; texts of any length are read whole; repeated rows
count each; a null doc_id is the empty text where a doc_id has a say; other columns are ignored; words with equal counts
are ordered by code points; an empty table gives no rows.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomkit.llm.jobs import query, table
from fathomkit.session import hold

LEAST_LETTERS = 6
LEAST_COUNT = 5
RATIO = 5
TYPO_EVERY = 199
SEGMENTS = 3
BLOCK_WORDS = 8_192
HELD_WORDS = 200_000


def with_typos(doc_id: str, runs: Counter, every: int) -> Counter:
    """``runs`` of one document with a letter deleted where the checksum of id and run is a multiple of ``every``."""
    before, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), before)
        if h % every == 0:
            run = run[:h % len(run)] + run[h % len(run) + 1:]
        out[run] += n
    return out


def word_counts(
    docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, typo_every: int = 0,
) -> DataFrame:
    """word, n: runs of letters, A-Z in lower case, of at least so many letters and occurrences.

    Tasks add up their words before the shuffle and let go of them at ``HELD_WORDS`` distinct ones.
    """
    letters = re.compile("[a-zÀ-ÿ]{%d,}" % least_letters)

    def batch_of(seen):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    def count(batches):
        seen = Counter()
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                runs = Counter(letters.findall(raw.lower().decode("utf-8", "replace")))
                seen.update(with_typos(doc_id, runs, typo_every) if typo_every else runs)
                if len(seen) >= HELD_WORDS:
                    yield batch_of(seen)
                    seen = Counter()
        yield batch_of(seen)

    texts = docs.where("text IS NOT NULL").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"))
    words = texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where((F.char_length("word") >= least_letters) & (F.col("n") >= least_count))


def _blocked(words: DataFrame, lo, hi) -> DataFrame:
    """With the number of the block of each row: by m and the letters before ``lo`` and after ``hi``."""
    return words.withColumn("lo", lo).withColumn("hi", hi).withColumn("block", F.expr(
        "xxhash64(m, lo, hi, left(word, lo), right(word, m - hi))"))


def block_rows(words: DataFrame, segments: int = SEGMENTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, n, m, lo, hi, block: every word in its blocks, crowded blocks dealt anew by single letters."""
    shortest = words.agg(F.min(F.char_length("word"))).first()[0] or 1
    part = words.select("word", "n", F.explode(F.expr(
        "array(char_length(word), char_length(word) - 1)")).alias("m")).where(F.col("m") >= shortest).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("part"))
    coarse = _blocked(part, F.expr(f"m * part div {segments}").cast("int"),
                      F.expr(f"m * (part + 1) div {segments}").cast("int")).where("lo < hi").drop("part")
    crowded = hold(coarse.groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > block_words))
    fine = coarse.join(crowded, "block", "left_semi").select(
        "word", "n", "m", F.explode(F.expr("sequence(lo, hi - 1)")).alias("at"))
    fine = _blocked(fine, F.col("at"), F.col("at") + 1)
    return coarse.join(crowded, "block", "left_anti").unionByName(fine.drop("at"))


class PositionIndex:
    """Bitsets over ``words`` by position and letter; bit i stands for words[i]."""

    def __init__(self, words: list[str]):
        self.words, self.all = words, (1 << len(words)) - 1
        self.has: dict[tuple[int, str], int] = {}
        self.length: dict[int, int] = {}
        has, length = self.has, self.length
        for i, word in enumerate(words):
            bit = 1 << i
            length[len(word)] = length.get(len(word), 0) | bit
            for key in enumerate(word):
                has[key] = has.get(key, 0) | bit

    def near(self, queries: list[str], lo: int = 0, hi: int = 1 << 30):
        """(query, bitset of its near words) for queries in any order.

        Only words whose common beginning with the query has at least ``lo`` and fewer than ``hi`` letters.
        """
        get, of_length = self.has.get, self.length.get
        # states[i], after i letters of the query: equal, one replaced, query has one more, query lacks one
        states, last = [(self.all, 0, 0, self.all)], ""
        for q in sorted(queries):
            i = 0
            for a, b in zip(q, last):
                if a != b:
                    break
                i += 1
            del states[i + 1:]
            equal, changed, longer, shorter = states[i]
            for i in range(i, len(q)):
                c = q[i]
                here = get((i, c), 0)
                longer = longer & get((i - 1, c), 0) | equal
                changed = changed & here | equal & ~here
                equal &= here
                shorter = shorter & get((i + 1, c), 0) | equal
                states.append((equal, changed, longer, shorter))
            last, n = q, len(q)
            found = (changed & of_length(n, 0) | longer & of_length(n - 1, 0) | shorter & of_length(n + 1, 0))
            found &= states[lo][0]
            if hi < n:
                found &= ~states[hi][0]
            yield q, found


def _near_in_block(words: list[str], m: int, lo: int, hi: int):
    """(index of a word, near words in this block, index of the first of them); words of m and m + 1 letters."""
    index = PositionIndex(words)
    place = {w: i for i, w in enumerate(words)}
    short = index.length.get(m, 0)
    for q, found in index.near(words, lo, hi if hi < m else 1 << 30):
        if len(q) > m:  # two words of m + 1 letters meet in the blocks of m + 1
            found &= short
        if found:
            yield place[q], found.bit_count(), (found & -found).bit_length() - 1


def near_words(words: DataFrame, segments: int = SEGMENTS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, n_near, best_n, best: how many words are near, and the most frequent of them; words without any lack."""
    rows = block_rows(words, segments, block_words).repartition("block").sortWithinPartitions(
        "block", "m", "lo", "hi", F.desc("n"), "word")

    def search(batches):
        rest = None
        for batch in batches:
            got = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            keys = np.stack([got.column(c).to_numpy() for c in ("block", "m", "lo", "hi")], 1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            full = int(cuts[-1]) if len(cuts) else 0
            yield blocks(got.slice(0, full), keys[:full], cuts)
            rest = got.slice(full).to_batches()[0] if full < len(got) else None
        if rest is not None:
            got = pa.Table.from_batches([rest])
            yield blocks(got, np.stack([got.column(c).to_numpy() for c in ("block", "m", "lo", "hi")], 1), [len(got)])

    def blocks(got, keys, ends):
        words, counts = got.column("word").to_pylist(), got.column("n").to_pylist()
        out, a = [], 0
        for b in map(int, ends):
            if b - a > 1:
                m, lo, hi = keys[a, 1:].tolist()
                for i, n_near, best in _near_in_block(words[a:b], m, lo, hi):
                    out.append((words[a + i], n_near, counts[a + best], words[a + best]))
            a = b
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, kinds)]
        return pa.RecordBatch.from_arrays(columns, names=["word", "n_near", "best_n", "best"])

    found = rows.mapInArrow(search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", (-F.col("top.less")).alias("best_n"), F.col("top.best").alias("best"))


def followed(links: DataFrame) -> DataFrame:
    """word, root: the end of the chain of forms from each word; a chain is as long as counts can grow by RATIO, so
    doubling it settles in a few rounds."""
    links = hold(links.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        if links.join(ahead, "root", "left_semi").isEmpty():
            return links
        links = hold(links.join(ahead, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")))


def spelling_variants(
    words: DataFrame, ratio: int = RATIO, segments: int = SEGMENTS, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of the vocabulary ``words`` (word, n).

    The form of a word is its most frequent near word, if that is at least ``ratio`` times as frequent.
    """
    words = hold(words.select("word", "n"))
    near = near_words(words, segments, block_words)
    is_form = F.col("best_n") >= F.lit(ratio) * F.col("n")
    found = hold(words.join(near, "word", "left").select(
        "word", F.when(is_form, F.col("best")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best_n")).alias("form_n")))
    roots = followed(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = rf"""
WITH RECURSIVE
bits AS (SELECT list(list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY b) AS crc
  FROM (SELECT unnest(range(256))::BIGINT AS b)),
runs AS (SELECT doc_id, run, count(*) AS c FROM (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(
    translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
  FROM documents) WHERE length(run) >= {LEAST_LETTERS} GROUP BY ALL),
hexed AS (SELECT run, c, hex(encode(doc_id || ':' || run)) AS x FROM runs),
hashed AS (SELECT run, c, xor(list_reduce(list_concat([4294967295], list_transform(range(0, len(x), 2),
    lambda i: ('0x' || substr(x, i + 1, 2))::BIGINT)),
    lambda a, b: xor(crc[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) AS h FROM hexed, bits),
typed AS (SELECT CASE WHEN h % {TYPO_EVERY} = 0
    THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c FROM hashed),
w AS (SELECT word, sum(c)::BIGINT AS n FROM typed GROUP BY word
  HAVING length(word) >= {LEAST_LETTERS} AND sum(c) >= {LEAST_COUNT}),
without AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
pairs AS (
  SELECT a.word, b.word AS other FROM without a JOIN without b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, w.word FROM without a JOIN w ON a.rest = w.word
  UNION SELECT w.word, a.word FROM without a JOIN w ON a.rest = w.word),
near AS (SELECT p.word, count(*) AS n_near, max(o.n) AS best_n, first(o.word ORDER BY o.n DESC, o.word) AS best
  FROM pairs p JOIN w o ON o.word = p.other GROUP BY p.word),
forms AS (SELECT w.word, CASE WHEN best_n >= {RATIO} * n THEN best END AS form, n, coalesce(n_near, 0) AS n_near,
  CASE WHEN best_n >= {RATIO} * n THEN best_n END AS form_n FROM w LEFT JOIN near USING (word)),
chain(word, seat, ahead) AS (
  SELECT word, word, form FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.ahead)
SELECT f.word, f.form, c.seat AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.ahead IS NULL"""


@query("op11_spelling_variants", SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its form, root and near words."""
    return spelling_variants(word_counts(table(spark, sf_dir, "documents"), typo_every=TYPO_EVERY))
