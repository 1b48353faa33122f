import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

from shardbrook.llm.packing import WordEncoder, best_fit_plan, pack, pack_documents, tokenise

PIECES = [
    "²", "¼", "×", "÷", "ª", "µ", "ø", "\r", "\x0b", "’", "“", "ŉ", "À", "a", "b", "th", "ing", "'",
    "s", "re", "ll", " ", "  ", "\n", "\t", "1", "23", "é", "ß", "…", "!", "==", "-", "中文", "한",
    "😀", "́", "\xa0", "\x1c", "A", "LL", "'S", "x" * 9, "<|endoftext|>", "Σ", "ΑΣ", "İ",
    "\x85", "\x00", "</w>", "ſ", "Å", "K", "ﬁ",
]


@pytest.fixture(scope="module")
def encoder():
    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        return WordEncoder(file.read())


def test_ids_are_those_of_the_tokenizer(encoder):
    rng = random.Random(3)
    for _ in range(5000):
        some = rng.sample(PIECES, rng.choice((2, 4, 6, len(PIECES))))
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 40)))
        found = np.frombuffer(encoder.encode(text), dtype="<u4").tolist()
        assert found == encoder.exact.encode(text, add_special_tokens=False).ids, text


def _best_fit_decreasing(lengths, capacity):
    """Document by document."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fits = [g for g in gaps if g >= length]
        if fits:
            gap = min(fits)
            gaps.remove(gap)
        else:
            gap = capacity
        gaps.append(gap - length)
    return len(gaps)


@pytest.mark.parametrize("seed", range(30))
def test_plan_is_best_fit_and_whole(seed):
    rng = random.Random(seed)
    capacity = rng.choice((5, 10, 37, 100))
    lengths = [rng.randint(1, rng.choice((3, capacity))) for _ in range(rng.randint(1, 120))]
    counts = defaultdict(int)
    for length in lengths:
        counts[length] += 1
    plan, sequences = best_fit_plan(counts, capacity)
    assert sequences == _best_fit_decreasing(lengths, capacity)
    filled = defaultdict(list)
    for length, count in counts.items():
        for rank in range(count):
            row = [p for p in plan if p.length == length and p.first_rank <= rank][-1:]
            row = max(
                (p for p in plan if p.length == length and p.first_rank <= rank),
                key=lambda p: p.first_rank,
            )
            k = rank - row.first_rank
            filled[row.first_sequence + k // row.each].append(
                (row.offset + k % row.each * length, length)
            )
    assert len(filled) == sequences
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def _check(rows, capacity):
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_documents(documents, encoder):
    texts = ["", None, "one two three", "one two three", "word " * 5000, "a"] + ["b c d"] * 50
    docs = documents(texts).selectExpr("*", "7 AS offset", "'x' AS sequence_id", "1 AS piece")
    docs = docs.union(docs.where("doc_id = 2").selectExpr("NULL", *docs.columns[1:]))
    rows = pack_documents(docs, capacity=64).collect()
    pieces = defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
    for key, text in [*enumerate(texts), (None, texts[2])]:
        ids = np.frombuffer(encoder.encode(text or ""), dtype="<u4").tolist() + [0]
        mine = sorted(pieces[key], key=lambda r: r.piece)
        assert [r.start for r in mine] == list(range(0, len(ids), 64))
        for row in mine:
            cut = ids[row.start : row.start + 64]
            assert row.length == len(cut)
            assert row.ids_crc32 == zlib.crc32(np.asarray(cut, dtype="<u4").tobytes())
    _check(rows, 64)
    assert pack_documents(docs.limit(0)).count() == 0


def test_a_length_that_half_of_all_pieces_have(spark):
    """Ranks are exact across the salted parts of a hot length."""
    pieces = spark.range(20_000).selectExpr(
        "id AS doc_id", "IF(id % 2 = 0, 30L, 1 + id % 90) AS length"
    )
    rows = pack(pieces, capacity=100, order_by=["doc_id"]).collect()
    assert len(rows) == 20_000
    _check(rows, 100)


def test_lengths_out_of_range_fail(spark):
    for bad in ("0L", "101L", "NULL"):
        pieces = spark.sql(f"SELECT 1L AS doc_id, CAST({bad} AS BIGINT) AS length")
        with pytest.raises(Exception, match="length"):
            pack(pieces, capacity=100, order_by=["doc_id"]).collect()


def test_pieces_carry_their_ids(documents, encoder):
    rows = tokenise(documents(["one two"]), capacity=2).orderBy("piece").collect()
    ids = np.frombuffer(b"".join(bytes(r.ids) for r in rows), dtype="<u4").tolist()
    assert ids == encoder.exact.encode("one two", add_special_tokens=False).ids + [0]


def test_registered_query_over_its_whole_table(spark, encoder):
    """Every piece of every document, in as few sequences as best fit document by document."""
    from shardbrook.llm.queries import LLM_QUERIES

    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = LLM_QUERIES["op3_best_fit_packing"](spark, sf_dir).collect()
    found = defaultdict(list)
    for row in rows:
        found[row.doc_id].append(row)
    assert set(found) == set(texts)
    lengths = []
    for key, text in texts.items():
        ids = encoder.exact.encode(text or "", add_special_tokens=False).ids + [0]
        cuts = [ids[at : at + 2048] for at in range(0, len(ids), 2048)]
        mine = sorted(found[key], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in mine] == [
            (n, 2048 * n, len(cut)) for n, cut in enumerate(cuts)
        ]
        assert [r.ids_crc32 for r in mine] == [zlib.crc32(np.asarray(c, "<u4").tobytes()) for c in cuts]
        lengths += map(len, cuts)
    assert _check(rows, 2048) == _best_fit_decreasing(lengths, 2048)
