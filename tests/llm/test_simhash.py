import random

import numpy as np
import pytest
import xxhash

from shardbrook.llm.simhash import (
    block_count,
    components,
    fingerprint,
    link_classes,
    near_duplicates,
    trie_classes,
)


def _plain_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(values):
    """Smallest index that links of at most three bits reach."""
    first = list(range(len(values)))

    def find(i):
        while first[i] != i:
            i = first[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                first[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def _values(seed, n=120):
    rng = random.Random(seed)
    values = [rng.getrandbits(64) for _ in range(n // 3)]
    while len(values) < n:  # around some of them, nearer and further
        value = rng.choice(values)
        for _ in range(rng.randint(1, 5)):
            value ^= 1 << rng.randrange(64)
        values.append(value)
    return values


@pytest.mark.parametrize("text", ["", " \t", "One", "one TWO", "a b c", "É a\x0bb É a b c d", "x y " * 500])
def test_fingerprint(text):
    assert fingerprint(text.encode()) % 2**64 == _plain_fingerprint(text)


@pytest.mark.parametrize("leaf", [1, 4, 64])
def test_trie_finds_every_class(leaf):
    for seed in range(4):
        values = sorted(set(_values(seed, 300)))
        n = len(values)
        root = [np.array([x]) for x in (0, n, 0, n, 0, 0)]
        found = trie_classes(np.array(values, dtype=np.uint64), root, 3, leaf)
        assert found.tolist() == _classes(values)


def _signed(value):
    return value - 2**64 if value >= 2**63 else value


@pytest.mark.parametrize(("blocks", "node_rows"), [(4, 50_000), (5, 50_000), (6, 50_000), (4, 5), (5, 2)])
def test_links_lose_no_class(spark, blocks, node_rows):
    """Whatever the number of blocks, and with crowded nodes split."""
    values = sorted({_signed(v) for v in _values(blocks + node_rows)} | {_signed(1 << b) for b in range(64)} | {0})
    table = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    labels = components(link_classes(table, blocks=blocks, node_rows=node_rows))
    named = {r.node: r.label for r in labels.collect()}
    found = [named.get(v, v) for v in values]
    wanted = [values[i] for i in _classes([v % 2**64 for v in values])]
    assert found == wanted


def test_more_blocks_as_the_table_grows():
    assert [block_count(n) for n in (0, 10**6, 10**8, 10**10)] == [4, 4, 5, 6]


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.label for r in components(links).collect()} == {0}
    assert components(links.limit(0)).count() == 0


def test_documents(documents):
    base = " ".join(f"w{i}" for i in range(200))
    texts = [None, "", "\n", base, base.upper(), base + " tail", "other words here", "a b c d"]
    docs = documents(texts).selectExpr("*", "'x' AS fingerprint", "1 AS component_id")
    docs = docs.union(docs.where("doc_id = 3")).union(
        docs.where("doc_id = 7").selectExpr("NULL", *docs.columns[1:])
    )
    rows = near_duplicates(docs).collect()
    assert len(rows) == 10
    prints = {i: _plain_fingerprint(t or "") for i, t in enumerate(texts)}
    classes = _classes([prints[i] for i in range(8)])
    for row in rows:
        key = 7 if row.doc_id is None else row.doc_id
        assert row.fingerprint % 2**64 == prints[key]
        assert row.component_id == classes[key]
    only_null = docs.where("doc_id IS NULL")
    assert [r.component_id for r in near_duplicates(only_null).collect()] == [None]
    assert near_duplicates(docs.limit(0)).count() == 0


def test_query(spark):
    from shardbrook.llm.queries import LLM_QUERIES

    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    prints = [_plain_fingerprint(d.text) for d in docs]
    classes = _classes(prints)
    rows = {r.doc_id: r for r in LLM_QUERIES["op9_simhash"](spark, sf_dir).collect()}
    assert len(rows) == len(docs)
    for doc, value, first in zip(docs, prints, classes):
        assert rows[doc.doc_id].fingerprint == f"{value:016x}"
        assert rows[doc.doc_id].component_id == docs[first].doc_id
