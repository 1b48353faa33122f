"""Packing of tokenised documents into sequences by bulk-synchronous best fit.

Lengths are whole numbers up to the capacity, so documents of one length are alike
and so are open sequences with one history.  The rounds therefore work on classes
of documents and of gaps: one class of documents at a time, longest first, sweeps
over the sorted gap classes from its successor (the smallest gap that holds it)
upwards; within a class the k-th document takes the k-th place.  After each sweep
the gaps are updated.  What a round handles is bounded by the capacity, not by the
number of documents, and gives what best fit would give document by document.

The documents themselves never leave the executors.  Spark counts them by length,
ranks them within their length (a length with very many documents is cut into
salted parts), and each looks up its place in the plan by its rank.
"""

from __future__ import annotations

import bisect
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardbrook.llm.common import map_rows, whole_text
from shardbrook.storage import store

# A part of a length holds at most this share of all pieces, and at most so many.
SALT_SHARE = 1000
SALT_ROWS = 1_000_000
# Words whose ids a task remembers.
WORDS_HELD = 400_000


# Letters that every library lower-cases and composes alike, as a character class.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ſ"
NUMBERS = "0-9²³¹¼-¾"


class WordEncoder:
    """Ids of whole texts by a tokenizer that splits at white space.

    A text of common characters goes through the same merges as byte ranks: a
    word's last byte and its end mark are one symbol there, the mark being written
    as a space.  Other texts go to the tokenizer itself, word by word (no match of
    its split pattern, no normalisation and no merge crosses white space), and the
    words are remembered; those with characters on which libraries disagree about
    white space go there whole.
    """

    COMMON = re.compile(rf"[\t-\r -~{LETTERS}¡-ÿ–—‘-„…]*")
    # What needs a space on both sides; runs of letters stand between.
    APART = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{NUMBERS}]|[^\s{LETTERS}{NUMBERS}]+")
    ODD_SPACE = re.compile(r"[\x1c-\x1f]")

    def __init__(self, tokenizer_file: bytes):
        self.exact = tokenizers.Tokenizer.from_buffer(tokenizer_file)
        self.exact.encode_special_tokens = True
        layout = json.loads(tokenizer_file)
        end = layout["model"]["end_of_word_suffix"]
        byte_of = {c: b for b, c in _byte_letters().items()}
        special = {t["content"] for t in layout["added_tokens"]}
        ranks = {}
        for token, rank in layout["model"]["vocab"].items():
            if token in special:
                continue
            whole = token.endswith(end) and token != end
            body = token.removesuffix(end) if whole else token
            ranks[bytes(byte_of[c] for c in body) + b" " * whole] = rank
        self.fast = tiktoken.Encoding(
            "words", pat_str="[^ ]+ ", mergeable_ranks=ranks, special_tokens={}
        )
        self.held: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self.COMMON.fullmatch(text):
            words = self.APART.sub(r" \g<0> ", text.lower())
            for space in "\t\n\v\f\r":
                words = words.replace(space, " ")
            ids = self.fast.encode_ordinary(words + " ")
            return np.asarray(ids, dtype="<u4").tobytes()
        if self.ODD_SPACE.search(text):
            return self._exact(text)
        if len(self.held) > WORDS_HELD:
            self.held.clear()
        held, words = self.held, text.split()
        for word in words:
            if word not in held:
                held[word] = self._exact(word)
        return b"".join(map(held.__getitem__, words))

    def _exact(self, text: str) -> bytes:
        ids = self.exact.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    hidden = (b for b in range(256) if b not in letters)
    letters.update({b: chr(256 + i) for i, b in enumerate(list(hidden))})
    return letters


def tokenise(
    docs: DataFrame,
    *,
    capacity: int = 2048,
    end_id: int = 0,
    tokenizer: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``id_col, piece, start, length, ids``.

    A document's ids are those of its whole text (null: empty) and ``end_id``; only
    a longer one is cut.  ``ids`` are little-endian unsigned 32-bit integers.  Rows
    with null or repeated ids are taken like any other; other columns are not read.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    with open(path, "rb") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    stop = np.asarray([end_id], dtype="<u4").tobytes()

    def setup():
        encoder = WordEncoder(vocabulary.value)

        def apply(columns):
            for key, text in zip(*columns):
                ids = encoder.encode(text) + stop
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    yield (key, piece, at // 4, len(cut) // 4, cut), len(cut) + 32

        return apply

    rows = docs.select(F.col(id_col), whole_text(text_col).alias("text"))
    schema = T.StructType(
        [
            rows.schema[0],
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    return map_rows(rows, setup, schema)


@dataclass(slots=True)
class Placing:
    """Pieces of one length, by rank, and the sequences that take them."""

    length: int
    first_rank: int
    first_sequence: int
    each: int  # pieces in a sequence, one after the other
    offset: int


def best_fit_plan(counts: dict[int, int], capacity: int) -> tuple[list[Placing], int]:
    """Places for ``counts[length]`` pieces of each length; how many sequences.

    Gap classes hold ``(first sequence, sequences)`` ranges that are filled alike,
    sorted by gap.  In each round the longest lengths left claim places: from the
    successor gap upwards, as many pieces to a sequence as it takes before its gap
    would no longer be the best fit.  Pieces without a gap open new sequences.
    """
    gaps: list[int] = []  # sorted, without repeats
    ranges: dict[int, list[tuple[int, int]]] = {}
    plan: list[Placing] = []
    sequences = 0

    def open_gap(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in ranges:
                bisect.insort(gaps, gap)
                ranges[gap] = []
            ranges[gap].append((first, n))

    def take(length: int, gap: int, first: int, n: int, rank: int, left: int) -> int:
        """Fill up to ``n`` sequences with this gap; how many pieces that took."""
        each = gap // length
        full = min(n, left // each)
        if full:
            plan.append(Placing(length, rank, first, each, capacity - gap))
            open_gap(gap - each * length, first, full)
        took = full * each
        over = left - took
        if full < n and 0 < over < each:  # the last one gets fewer
            plan.append(Placing(length, rank + took, first + full, over, capacity - gap))
            open_gap(gap - over * length, first + full, 1)
            full, took = full + 1, left
        open_gap(gap, first + full, n - full)
        return took

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect.bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, n = ranges[gap].pop()
                if not ranges[gap]:
                    del ranges[gap], gaps[at]
            else:
                each = capacity // length
                gap, first, n = capacity, sequences, -(-left // each)
                sequences += n
            took = take(length, gap, first, n, rank, left)
            left, rank = left - took, rank + took
    return plan, sequences


def pack(
    pieces: DataFrame,
    *,
    capacity: int = 2048,
    length_col: str = "length",
    order_by: list[str],
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (both long).

    Every piece (1 to ``capacity`` long) gets a place; sequences are filled without
    holes.  ``order_by`` ranks pieces of one length; rows that tie in it are alike.
    A null length, or one outside the range, fails the job.  ``pieces`` is read
    three times, so store it first; existing columns of the two names are replaced.
    """
    spark = pieces.sparkSession
    taken = {"sequence_id", "offset", "_length", "_salt", "_rank", "_before"}
    kept = [c for c in pieces.columns if c not in taken]
    length = F.col(length_col).cast("long")
    sized = pieces.select(
        *kept,
        F.when(length.between(1, capacity), length)
        .otherwise(F.raise_error(F.lit(f"a piece's length must be 1 to {capacity}")).cast("long"))
        .alias("_length"),
    )
    histogram = {r["_length"]: r["count"] for r in sized.groupBy("_length").count().collect()}
    plan, _ = best_fit_plan(histogram, capacity)

    most = max(1, min(SALT_ROWS, sum(histogram.values()) // SALT_SHARE))
    parts = spark.createDataFrame(
        [(n, -(-count // most)) for n, count in histogram.items()], "_length long, _parts long"
    )
    salted = sized.join(F.broadcast(parts), "_length").withColumn(
        "_salt", F.pmod(F.xxhash64(*order_by, F.lit(7)), F.col("_parts"))
    )
    by_part = Window.partitionBy("_length").orderBy("_salt").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = (
        salted.groupBy("_length", "_salt")
        .agg(F.count("*").alias("_n"))
        .select("_length", "_salt", F.coalesce(F.sum("_n").over(by_part), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy("_length", "_salt").orderBy(*order_by)
    ranked = (
        salted.withColumn("_rank", F.row_number().over(within) - 1)
        .join(before, ["_length", "_salt"])
        .select(*kept, "_length", (F.col("_rank") + F.col("_before")).alias("_rank"))
    )

    # Rank and length in one number, so that one search finds a piece's row of the plan.
    shift = max(1, max(histogram.values(), default=1)).bit_length()
    plan.sort(key=lambda p: (p.length, p.first_rank))
    fields = ("length", "first_rank", "first_sequence", "each", "offset")
    columns = {f: np.array([getattr(p, f) for p in plan], dtype=np.int64) for f in fields}
    shared = spark.sparkContext.broadcast(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = (table["length"] << shift) + table["first_rank"]
        for batch in batches:
            lengths = batch.column("_length").to_numpy()
            ranks = batch.column("_rank").to_numpy()
            at = np.searchsorted(keys, (lengths << shift) + ranks, side="right") - 1
            k, each = ranks - table["first_rank"][at], table["each"][at]
            sequence = table["first_sequence"][at] + k // each
            offset = table["offset"][at] + (k % each) * lengths
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)],
                names=[*kept, "sequence_id", "offset"],
            )

    schema = T.StructType(
        [sized.schema[c] for c in kept]
        + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return ranked.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, *, capacity: int = 2048, id_col: str = "doc_id", **how) -> DataFrame:
    """Places of all pieces: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.

    The pieces' own ids come from ``tokenise``; what is packed is their lengths and
    checksums, written once to the shared folder.  An empty table gives no rows.
    """
    pieces = tokenise(docs, capacity=capacity, id_col=id_col, **how)
    narrow = store(
        pieces.select(
            id_col, "piece", "start", "length", F.crc32("ids").cast("long").alias("ids_crc32")
        ),
        "pieces",
    )
    return pack(narrow, capacity=capacity, order_by=[id_col, "piece", "start", "ids_crc32"])
