import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from shardbrook.llm.bpe import TreeCodec, encode_documents

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = [
    "a", "b", "th", "ing", "'", "s", "re", "ll", " ", "  ", "\n", "\t", "1", "23", "é", "ß", "…",
    "!", "==", "-", "中文", "한", "😀", "́", "\xa0", "\x1c", "A", "LL", "'S", "x" * 9,
]


@pytest.fixture(scope="module")
def plain():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as file:
        return TreeCodec(file.read())


@pytest.mark.parametrize("leaf", [1, 2, 3, 7, 16])
def test_tree_gives_what_the_library_gives(codec, plain, leaf):
    codec.leaf_chars = leaf
    rng = random.Random(leaf)
    for _ in range(1500):
        some = rng.sample(PIECES, rng.choice((2, 4, 6, len(PIECES))))
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 60)))
        ids = codec.encode(text)
        assert ids == plain.encode_ordinary(text), (leaf, text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("unit", ["a", "ab", " ", "=", "1", "\n", "中", "'s", "aB9!"])
def test_long_runs_without_a_safe_edge(codec, plain, unit):
    codec.leaf_chars = 64
    text = unit * 5000
    assert codec.encode(text) == plain.encode_ordinary(text)


def test_every_token_is_its_own_encoding(codec):
    """What the proof that edges hold rests on."""
    for rank, token in enumerate(codec.bytes_of):
        if token:
            assert codec.plain._encode_single_piece(token) == [rank]


def test_documents(documents, plain):
    texts = ["Hello there, it's 12!", "", None, "  \n x", "Hello there, it's 12!", "é" * 3000]
    docs = documents(texts, "").selectExpr("*", "1 AS n_tokens", "'x' AS ids")
    docs = docs.union(docs.where("doc_id = 0").selectExpr("NULL", *docs.columns[1:]))
    found = encode_documents(docs, leaf_chars=8).collect()
    assert len(found) == 7
    for row in found:
        text = texts[row.doc_id or 0] or ""
        ids = plain.encode_ordinary(text)
        assert row.n_tokens == len(ids)
        assert bytes(row.ids) == np.asarray(ids, dtype="<u4").tobytes()
        assert bytes(row.decoded) == text.encode()
    assert encode_documents(docs.limit(0)).count() == 0


def test_query(spark, plain):
    from shardbrook.llm.queries import LLM_QUERIES

    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = LLM_QUERIES["op1_byte_bpe"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = plain.encode_ordinary(texts[row.doc_id])
        packed = np.asarray(ids, dtype="<u4").tobytes()
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(packed).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
