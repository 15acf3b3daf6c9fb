"""Token counts by the whole-token shortcut.

The vocabulary is tried once, on the driver: a string of it that the merges of the model turn into one token when it
stands alone is proven to be a whole token. In a text, a pre-token that is such a string counts one without any merge;
the merges run for the others alone. Where the pre-tokenizer drops white space, no normal form and no pre-token reaches
over a space or a line end, so a text is a sequence of stretches between these, and the count of a stretch is the same
wherever it stands: counts of short stretches are remembered up to ``CACHE_CHARS`` characters. Long stretches are
counted each time, texts are never cut, and what a task holds beyond the stretches of one batch has that bound.

Normal forms, pre-tokens and merges come from the library of the vocabulary file. Strings of added tokens count one each
and separate what stands around them, as in the library's default.

Defined cases: a null or empty text has no tokens and no bytes; texts of any length are counted whole; repeated rows give
repeated results; a null doc_id is kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomkit.llm.jobs import query, table, with_scored_text

LIMIT = 2048
CACHE_CHARS = 8_000_000
LONGEST_KEPT = 64


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def whole_tokens(spec: str) -> list[str]:
    """Pre-tokens that the merges turn into one token; proven by merging every string of the vocabulary alone."""
    from tokenizers import Tokenizer

    model = json.loads(spec)["model"]
    ending = model.get("end_of_word_suffix") or ""
    alone = (w[:len(w) - len(ending)] for w in model["vocab"] if w.endswith(ending))
    merge = Tokenizer.from_str(spec).model.tokenize
    return [w for w in alone if w and len(merge(w)) == 1]


class TokenCounter:
    """Counts the tokens of texts as the tokenizer of ``spec`` gives them; ``whole``: its whole tokens."""

    def __init__(self, spec: str, whole: list[str]):
        from tokenizers import Tokenizer

        tokenizer, told = Tokenizer.from_str(spec), json.loads(spec)
        added = told["added_tokens"]
        if any(a["normalized"] and told["normalizer"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError("added tokens must stand for their exact strings in the raw text")
        self.added = re.compile("|".join(re.escape(a["content"]) for a in added)) if added else None
        self.normal = tokenizer.normalizer.normalize_str if tokenizer.normalizer else None
        self.pre_tokens = tokenizer.pre_tokenizer.pre_tokenize_str
        self.merge = tokenizer.model.tokenize
        self.whole = frozenset(whole)
        self.spaceless = not self.pre_tokens("  \n \n\n") and all(" " not in a["content"] for a in added)
        self.known: dict[str, int] = {}
        self.chars = 0

    def plain(self, text: str) -> int:
        if not text:
            return 0
        n = 0
        for token, _ in self.pre_tokens(self.normal(text) if self.normal else text):
            n += 1 if token in self.whole else len(self.merge(token))
        return n

    def direct(self, text: str) -> int:
        """Tokens of ``text``, without anything remembered."""
        if self.added is None:
            return self.plain(text)
        parts = self.added.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1

    def stretch(self, text: str) -> int:
        n = self.direct(text)
        if len(text) <= LONGEST_KEPT:
            if self.chars > CACHE_CHARS:
                self.known.clear()
                self.chars = 0
            self.known[text] = n
            self.chars += len(text)
        return n

    def count(self, text: str) -> int:
        if not self.spaceless:
            return self.direct(text)
        n, known = 0, self.known
        for part in text.replace("\n", " ").split(" "):
            if part:
                got = known.get(part)
                n += self.stretch(part) if got is None else got
        return n


def token_counts(docs: DataFrame, name: str = "n_tokens", tokenizer: str | None = None) -> DataFrame:
    """``docs`` with the number of tokens of each whole text; ``tokenizer``: a BPE file of the tokenizers library."""
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        spec = f.read()
    # One vocabulary file and a part of its strings: a fixed size.
    shared = docs.sparkSession.sparkContext.broadcast((spec, whole_tokens(spec)))

    def make():
        counter = TokenCounter(*shared.value)
        return lambda texts: pa.array(map(counter.count, texts), pa.int64())

    return with_scored_text(docs, name, T.LongType(), make)


@query("op12_token_counts")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every whole text, and whether it has more than ``LIMIT`` tokens."""
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
