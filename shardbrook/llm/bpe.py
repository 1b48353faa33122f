"""Byte-level BPE by tree reduction.

A text is cut into halves until a piece is short enough for the plain encoder,
and neighbours are joined on the way up.  A join encodes a window around the cut
again and keeps the tokens outside it once they can no longer change:

* An edge where a non-space is followed by white space is always an edge between
  two matches of the split pattern, whatever stands further away, so nothing
  beyond it depends on the window.
* An edge inside a run of one kind (letters, digits, signs, equal spaces) lies
  inside one match.  A sequence of tokens is the encoding of its bytes exactly if
  every two neighbours are the encoding of their own bytes, so the edge holds if
  its two tokens, encoded together, come out as the same two tokens.

Until both edges hold, the window grows to twice as many tokens on each side.
"""

from __future__ import annotations

import base64

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardbrook.llm.common import map_rows, whole_text

SIGNS = frozenset("!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
DIGITS = frozenset("0123456789")


class TreeCodec:
    """Encodes and decodes whole texts by the ranks of one vocabulary.

    The split pattern is ``public_tokenizers.PATTERN``: where a token boundary holds
    whatever follows (``_kind``) rests on it.
    """

    def __init__(self, rank_file: bytes, leaf_chars: int = 512):
        pairs = (line.split() for line in rank_file.splitlines() if line)
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.plain = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks=ranks,
            special_tokens={},
        )
        self.leaf_chars = max(1, leaf_chars)
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        # Characters that begin inside a token, and whether it begins inside one.
        self.begun = [sum(b & 0xC0 != 0x80 for b in token) for token in self.bytes_of]
        self.midway = [token[:1] > b"\x7f" and token[0] & 0xC0 == 0x80 for token in self.bytes_of]
        self.stays: dict[tuple[int, int], bool] = {}

    def encode(self, text: str) -> list[int]:
        return self._encode(text, 0, len(text))

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def _encode(self, text: str, low: int, high: int) -> list[int]:
        if high - low <= self.leaf_chars:
            return self.plain.encode_ordinary(text[low:high])
        cut = (low + high) // 2
        return self._join(
            text, low, self._encode(text, low, cut), cut, self._encode(text, cut, high), high
        )

    def _join(
        self, text: str, low: int, left: list[int], cut: int, right: list[int], high: int
    ) -> list[int]:
        reach = 1
        while True:
            kept, start = self._edge_before(text, low, left, cut, reach)
            dropped, end = self._edge_after(text, high, right, cut, reach)
            window = self.plain.encode_ordinary(text[start:end])
            if (kept == 0 or self._holds(text, start, left[kept - 1], window[0])) and (
                dropped == len(right) or self._holds(text, end, window[-1], right[dropped])
            ):
                return left[:kept] + window + right[dropped:]
            reach *= 2

    def _edge_before(self, text, low, ids, at, reach):
        k = len(ids)
        while k:
            k -= 1
            at -= self.begun[ids[k]]
            far = len(ids) - k >= reach
            if far and at > low and not self.midway[ids[k]] and self._kind(text, at):
                return k, at
        return 0, low

    def _edge_after(self, text, high, ids, at, reach):
        for k, token in enumerate(ids):
            if k >= reach and not self.midway[token] and self._kind(text, at):
                return k, at
            at += self.begun[token]
        return len(ids), high

    @staticmethod
    def _kind(text: str, at: int) -> str:
        """``between`` two matches, ``inside`` one, or empty if that is not sure."""
        before, after = text[at - 1], text[at]
        if after in " \n\t\r":
            if before.isalnum() or before in SIGNS or before == "'":
                return "between"
            return "inside" if before == after and text[at + 1 : at + 2] == after else ""
        if before.isalpha() and after.isalpha():
            return "" if "'" in text[max(0, at - 3) : at] else "inside"
        if (before in DIGITS and after in DIGITS) or (before in SIGNS and after in SIGNS):
            return "inside"
        return ""

    def _holds(self, text: str, at: int, before: int, after: int) -> bool:
        if self._kind(text, at) == "between":
            return True
        pair = (before, after)
        if pair not in self.stays:
            if len(self.stays) > 500_000:
                self.stays.clear()
            joined = self.bytes_of[before] + self.bytes_of[after]
            self.stays[pair] = self.plain._encode_single_piece(joined) == [before, after]
        return self.stays[pair]


def encode_documents(
    docs: DataFrame,
    *,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    leaf_chars: int = 512,
) -> DataFrame:
    """Token ids of every whole text, and what they decode to.

    Returns ``id_col, n_tokens, ids, decoded`` for every row: ``ids`` as
    little-endian unsigned 32-bit integers, ``decoded`` as the bytes they stand
    for.  A null text counts as empty and has no tokens; rows with a null or a
    repeated id are encoded like any other; other columns are not read.

    The vocabulary file (its size does not depend on the data) is read by the
    driver and broadcast.  Every row is encoded where it is read: no shuffle.
    """
    spark = docs.sparkSession
    path = vocabulary or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = spark.sparkContext.broadcast(file.read())

    def setup():
        codec = TreeCodec(ranks.value, leaf_chars)

        def apply(columns):
            for key, text in zip(*columns):
                ids = codec.encode(text)
                packed = np.asarray(ids, dtype="<u4").tobytes()
                decoded = codec.decode(ids)
                yield (key, len(ids), packed, decoded), len(packed) + len(decoded) + 32

        return apply

    rows = docs.select(F.col(id_col), whole_text(text_col).alias("text"))
    schema = T.StructType(
        [
            rows.schema[0],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("decoded", T.BinaryType()),
        ]
    )
    return map_rows(rows, setup, schema)
