import hashlib

import pytest

from shardbrook.llm import manifest
from shardbrook.llm.oracles import MANIFEST
from shardbrook.llm.queries import LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _hash(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _leaf(row):
    values = [None if row[c] is None else str(row[c]) for c in COLUMNS]
    return _hash("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def _tree(nodes, arity):
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for way, i in zip(ways, range(len(at))):
            run, place = runs[at[i] // arity], at[i] % arity
            way.append(("".join(run[:place]), "".join(run[place + 1 :])))
            at[i] //= arity
        nodes = [_hash("".join(run)) for run in runs]
    return nodes, ways


def _brute(rows, arity):
    """(id, leaf, path, subroot, root) of every row."""
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append((row["doc_id"], _leaf(row)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
        trees[lang] = _tree([leaf for _, leaf in groups[lang]], arity)
    (root,), above = _tree([trees[lang][0][0] for lang in order], arity)
    return sorted(
        (str(i), leaf, tuple(way + rest), trees[lang][0][0], root)
        for lang, rest in zip(order, above)
        for (i, leaf), way in zip(groups[lang], trees[lang][1])
    )


def _odd(documents, extra=""):
    rows = [(i, f"text {i}", "en", None, 7) for i in range(40)]
    rows += [(i, "ü" * i, None, "s", None) for i in range(-5, 9)] + [(3, None, "", "", 0)]
    rows += [(9, "x", "é", "s", 1)] * 3 + [(None, "x", "é", "s", 1), (None, None, None, None, None)]
    rows += [(1, "one", "de", "s", 3)] + [(i, "long " * 9000, "zz", "s", 5) for i in range(9)]
    return documents(rows)


@pytest.mark.parametrize("arity,height", [(2, 8), (2, 2), (3, 1)])
def test_against_brute_force(documents, arity, height):
    docs = _odd(documents).selectExpr("*", "1 AS leaf", "2 AS path", "3 AS root", "4 AS _node")
    found = manifest.manifest(docs, keep=("_node",), arity=arity, height=height).collect()
    got = sorted(
        (str(r.doc_id), r.leaf, tuple((s.before, s.after) for s in r.path), r.subroot, r.root)
        for r in found
    )
    assert got == _brute([r.asDict() for r in docs.collect()], arity)
    assert {r._node for r in found} == {4}


def test_every_leaf_folds_to_the_root(documents):
    found = manifest.manifest(_odd(documents), arity=4, height=1)
    assert found.count() == 70
    path = manifest.F.col("path")
    assert found.where(manifest.folded(manifest.F.col("leaf"), path) != manifest.F.col("root")).isEmpty()
    wrong = manifest.folded(manifest.F.sha2(manifest.F.col("leaf"), 256), path)
    assert found.where(wrong == manifest.F.col("root")).isEmpty()


def test_lone_leaf_and_no_rows(documents):
    row = manifest.manifest(documents(["one"])).first()
    assert row.leaf == row.subroot == row.root and row.path == []
    assert manifest.manifest(documents(["one"]).limit(0)).count() == 0


def test_registered_query_against_sql(spark, duck, documents, tmp_path):
    folder = str(tmp_path)
    _odd(documents).write.parquet(f"{folder}/documents.parquet")
    for where, pattern in ((SF_DIR, "documents.parquet"), (folder, "documents.parquet/*.parquet")):
        duck.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{where}/{pattern}'")
        wanted = duck.sql(MANIFEST)
        found = LLM_QUERIES["op13_merkle_manifest"](spark, where)
        assert found.columns == wanted.columns
        got = sorted((tuple(r) for r in found.collect()), key=str)
        assert got == sorted(wanted.fetchall(), key=str)
        assert {r[-1] for r in got} == {True, False}
