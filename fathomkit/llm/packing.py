"""Best-fit packing of documents into sequences by minimum bin slack.

For one bin after the other a subset-sum over the lengths still available (a bit set in one integer) finds the fullest
feasible combination, which is then removed. Equal bins follow each other, so a combination is found once and taken as
often as the lengths allow. The bins are planned on the histogram of lengths alone, which has at most ``capacity``
entries however many documents there are; each time a length binds, less of it is left than the combination uses, so
there are at most sum(capacity / length + 1) combinations (about 19,000 for 2,048). Which document takes which place
follows from its rank among the pieces of its length, counted by Spark in hash buckets, so a length that a third of all
pieces share uses many tasks.

Defined cases: a null text is an empty one and gives a piece with the end id alone; texts of any length are cut, never
shortened; repeated rows are packed as often as they occur; a null doc_id is kept; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathomkit.llm.jobs import query, table
from fathomkit.session import hold

CAPACITY = 2048
END_ID = 0
BUCKET_ROWS = 50_000
CACHE_BYTES = 32_000_000

# Fixed value: the word pattern of the byte-level vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_RAGGED = re.compile(r" \s|\s ")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_names() -> dict[str, int]:
    """Printable bytes stand for themselves in the vocabulary file, the others for code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Codec:
    """Ids of a byte-level vocabulary file as little-endian unsigned 32-bit bytes.

    A lone space between two other characters always begins a token, so the stretches between such spaces are encoded
    once and remembered, up to ``CACHE_BYTES``; ``forget`` empties the memory.
    """

    def __init__(self, spec: dict):
        import tiktoken

        names, special = _byte_names(), {x["content"]: x["id"] for x in spec["added_tokens"]}
        ranks = {
            bytes(names[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special
        }
        self.core = tiktoken.Encoding("bytes", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.later: dict[str, bytes] = {}
        self.held = 0

    def plain(self, text: str) -> bytes:
        return np.asarray(self.core.encode_ordinary(text), "<u4").tobytes()

    def stretch(self, part: str) -> bytes:
        got = self.plain(" " + part)
        size = 200 + 4 * len(part) + len(got)  # a generous estimate of both objects and their place
        if size > CACHE_BYTES // 100:
            return got
        if self.held + size > CACHE_BYTES:
            self.forget()
        self.later[part] = got
        self.held += size
        return got

    def forget(self) -> None:
        self.later.clear()
        self.held = 0

    def encode(self, text: str) -> bytes:
        if self.cut and any(s in text for s in self.special):
            parts = self.cut.split(text)
            return b"".join(
                np.asarray([self.special[p]], "<u4").tobytes() if i % 2 else self.encode(p) for i, p in enumerate(parts)
            )
        if not text:
            return b""
        if _RAGGED.search(text):
            return self.plain(text)
        head, *rest = text.split(" ")
        known, miss = self.later.get, self.stretch
        return self.plain(head) + b"".join([known(p) or miss(p) for p in rest])


@functools.lru_cache(maxsize=2)
def _codec(spec: bytes) -> Codec:
    return Codec(json.loads(spec))


def tokenised(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, if wanted, ids.

    Only documents longer than ``capacity`` are cut; their first piece may be shorter than the others.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())  # one vocabulary file, a fixed size
    fields = [
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if keep_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.LongType())))

    def pieces(batches):
        codec = _codec(vocabulary.value)
        end = np.asarray([END_ID], "<u4").tobytes()
        for batch in batches:
            of, piece, start, length, crc, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column(1).to_pylist()):
                raw = codec.encode(text or "") + end
                total = len(raw) // 4
                at, k = 0, 0
                while at < total:
                    n = (total - at - 1) % capacity + 1 if k == 0 else capacity
                    part = raw[4 * at: 4 * (at + n)]
                    of.append(row), piece.append(k), start.append(at), length.append(n), crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int64))
                    at, k = at + n, k + 1
            columns = [
                batch.column(0).take(pa.array(of, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
            ]
            if keep_ids:
                columns.append(pa.array(ids, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])
        codec.forget()

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(pieces, T.StructType(fields))


def fullest(counts: list[tuple[int, int]], gap: int) -> dict[int, int]:
    """Uses of each length that fill ``gap`` best; ``counts``: (length, available), longest first."""
    mask, reach, steps = (1 << (gap + 1)) - 1, 1, []
    for length, available in counts:
        if length > gap:
            continue
        many, k = min(available, gap // length), 1
        while many > 0:
            k = min(k, many)
            grown = reach | (reach << (length * k)) & mask
            if grown != reach:
                steps.append((length, k, reach))
                reach = grown
            many, k = many - k, 2 * k
        if reach >> gap & 1:
            break
    at, uses = reach.bit_length() - 1, Counter()
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            at -= length * k
            uses[length] += k
    return dict(uses)


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """(times, uses of each length) of the bins; each starts with the longest length left."""
    left, plan = dict(sorted(histogram.items(), reverse=True)), []
    while left:
        top = next(iter(left))
        counts = [(n, c - (n == top)) for n, c in left.items() if c - (n == top) > 0]
        uses = Counter({top: 1}) + Counter(fullest(counts, capacity - top))
        times = min(left[n] // k for n, k in uses.items())
        for n, k in uses.items():
            left[n] -= times * k
            if not left[n]:
                del left[n]
        plan.append((times, dict(uses)))
    return plan


def _slots(plan: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """Where the pieces of a length go, by their rank: one entry per combination and length in it."""
    entries, taken, first_bin = [], Counter(), 0
    for times, uses in plan:
        offset = 0
        for length, k in sorted(uses.items(), reverse=True):
            entries.append((length, taken[length], k, first_bin, offset))
            taken[length] += times * k
            offset += length * k
        first_bin += times
    table = np.asarray(sorted(entries), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "uses", "bin", "offset"), table.T))


def pack(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False,
) -> DataFrame:
    """Pieces of ``docs`` with their sequence_id and offset (and ids, if wanted)."""
    pieces = hold(tokenised(docs, tokenizer or default_tokenizer(), capacity, keep_ids))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = _slots(plan_bins(histogram, capacity))
    buckets = sum(histogram.values()) // BUCKET_ROWS + 1

    of = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = of.groupBy("length", "bucket").agg(F.count("*").alias("n")).select(
        "length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
    )
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = of.withColumn("nth", F.row_number().over(inside)).join(base, ["length", "bucket"]).select(
        *pieces.columns, (F.col("base") + F.col("nth") - 1).alias("rank"),
    )
    names, schema = pieces.columns, T.StructType([
        *pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])

    def place(batches):
        # (length, rank) as one sorted key: ranks stay below 2^45, lengths below 2^18
        keys = slots["length"] << 45 | slots["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, length << 45 | rank, side="right") - 1
            beyond = rank - slots["rank"][at]
            bins = slots["bin"][at] + beyond // slots["uses"][at]
            offset = slots["offset"][at] + beyond % slots["uses"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(bins), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids, and the doc_ids in their order (at most ``capacity`` ids)."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"),
    )


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
