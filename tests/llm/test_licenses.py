import random
import re

import pytest
from pyspark.sql import functions as F

from shardbrook.llm import licenses

PHRASES = [
    ("the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]
TO_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(TO_LOWER))
    places, labels = [], set()
    for phrase, label in PHRASES:
        wanted = phrase.split()
        for i in range(len(words) - len(wanted) + 1):
            if words[i : i + len(wanted)] == wanted:
                places.append(i)
                labels.add(label)
    first, last = min(places, default=None), max(places, default=None)
    return len(words), len(places), first, last, ",".join(sorted(labels))


TEXTS = [
    None,
    "",
    " ,.",
    "The MIT License",
    "the mit license the MIT-license the_mit_license",
    "The MIT Licenses, theé mit license",
    "see cc-by-nc and CC BY NC; the Apache License, Version 2.0 or the mIT license.",
    "ĞİK the mİt license the mit licenſe K",
    "x " * 3000 + "apache license version 2 " * 40,
]


def test_phrases(documents):
    docs = documents(TEXTS).selectExpr("*", "'x' AS labels", "1 AS score", "2 AS hash")
    docs = docs.union(docs.where("doc_id = 3")).union(
        docs.where("doc_id = 6").selectExpr("NULL", *docs.columns[1:])
    )
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        text = TEXTS[6 if row.doc_id is None else row.doc_id]
        assert tuple(row[1:6]) == _base(text)
        base = set(row.base_labels.split(",")) - {""}
        assert base <= set(row.labels.split(","))
        assert 0 <= row.score <= 1 and (row.score == 1 or not base)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_a_license_with_changes_is_found_where_it_stands(documents):
    label, text = licenses.TEMPLATES[0]
    words = licenses.template_words(text)
    changed = words[:20] + ["really"] + words[20:50] + words[52:]
    filler = [f"f{i}" for i in range(30)]
    found = licenses.scan(
        documents([" ".join(filler + changed + filler), " ".join(words[:15]), " ".join(filler)])
    ).orderBy("doc_id").collect()
    assert found[0].labels == label and not found[0].base_labels
    assert len(found[0].spans) == 1
    assert (found[0].spans[0].first, found[0].spans[0]["last"]) == (30, 30 + len(changed) - 1)
    assert 0.8 < found[0].score < 1
    assert found[1].labels == "" and 0 < found[1].score < licenses.LEAST_SCORE
    assert found[2].labels == "" and found[2].score == 0 and found[2].spans == []


def test_the_same_license_twice_is_two_spans(documents):
    label, text = licenses.TEMPLATES[5]
    gap = " ".join(f"f{i}" for i in range(40))
    (row,) = licenses.scan(documents([f"{text} {gap} {text}"])).collect()
    assert row.labels == label and len(row.spans) == 2 and row.score == 1


def test_a_repeated_phrase_is_no_license(documents):
    """A phrase eight times, a clause thirty times, sentences in the wrong order."""
    bsd = licenses.template_words(next(t for label, t in licenses.TEMPLATES if label == "bsd"))
    clause = " ".join(bsd[:14])
    mit = licenses.template_words(next(t for label, t in licenses.TEMPLATES if label == "mit"))
    third = len(mit) // 3
    turned = " ".join(mit[2 * third :] + mit[third : 2 * third] + mit[:third])
    texts = ["gnu general public license " * 8, f"{clause} " * 30, " ".join(bsd[20:40]) * 3, turned]
    found = licenses.scan(documents(texts)).orderBy("doc_id").collect()
    assert [r.labels for r in found] == [""] * 4
    assert all(r.score < licenses.LEAST_SCORE and r.spans == [] for r in found)


def test_places_in_order(spark):
    rng = random.Random(1)
    lists = [[], [5], [3, 3, 3], [9, 8, 7], [1, 2, 3]]
    lists += [[rng.randrange(30) for _ in range(rng.randint(1, 60))] for _ in range(40)]

    def longest(places):
        best = []
        for i, p in enumerate(places):
            best.append(1 + max((best[j] for j in range(i) if places[j] < p), default=0))
        return max(best, default=0)

    table = spark.createDataFrame([(i, p) for i, p in enumerate(lists)], "i int, p array<int>")
    found = table.select("i", licenses.in_order(F.col("p"))).collect()
    assert dict(map(tuple, found)) == {i: longest(p) for i, p in enumerate(lists)}


def test_odd_texts_against_sql(spark, duck, documents, tmp_path):
    """Licenses with changes, repeats and other orders, as the SQL twin sees them."""
    from shardbrook.llm.oracles import LLM_ORACLES
    from shardbrook.llm.queries import LLM_QUERIES

    rng = random.Random(6)
    texts = list(TEXTS)
    for label, text in licenses.TEMPLATES:
        words = licenses.template_words(text)
        for _ in range(3):
            some = [w for w in words if rng.random() > 0.05]
            cut = rng.randrange(len(some))
            texts.append(" ".join(some[cut:] + some[: rng.randrange(len(some))] * rng.randint(1, 3)))
    documents(texts).write.parquet(f"{tmp_path}/documents.parquet")
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    wanted = duck.execute(LLM_ORACLES["op2_license_scan"])
    names = [c[0] for c in wanted.description]
    found = LLM_QUERIES["op2_license_scan"](spark, str(tmp_path)).select(*names).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted.fetchall()))


def test_short_templates_are_refused(spark):
    with pytest.raises(ValueError, match="words"):
        licenses.template_places(spark, [("x", "two words")], 4)


def test_query(spark):
    from shardbrook.llm.queries import LLM_QUERIES

    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = LLM_QUERIES["op2_license_scan"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    assert all(tuple(row[1:6]) == _base(texts[row.doc_id]) for row in rows)
    gpl = {k for k, text in texts.items() if "GNU General Public License, version 3" in text}
    assert {r.doc_id for r in rows if "gpl-3" in r.labels} == gpl


def test_query_against_sql(spark, duck):
    from shardbrook.llm.oracles import LLM_ORACLES
    from shardbrook.llm.queries import LLM_QUERIES

    sf_dir = "/root/testdata/sf0.001"
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    wanted = duck.execute(LLM_ORACLES["op2_license_scan"])
    names = [c[0] for c in wanted.description]
    found = LLM_QUERIES["op2_license_scan"](spark, sf_dir).select(*names).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, wanted.fetchall()))


def test_only_a_to_z_are_lowered_in_any_language(documents, spark):
    texts = ["Ünder THE MIT LICENSE", "é Apache License, VERSION 2", "This worK is licensed under a licenſe"]
    locales = spark.sparkContext._jvm.java.util.Locale
    was = locales.getDefault()
    try:
        locales.setDefault(locales.forLanguageTag("tr-TR"))
        rows = licenses.scan(documents(texts), templates=[("x", "this work is licensed")]).collect()
    finally:
        locales.setDefault(was)
    assert {r.doc_id: tuple(r[1:6]) for r in rows} == {i: _base(t) for i, t in enumerate(texts)}
    # A Kelvin sign is no k.
    assert {r.labels for r in rows if r.doc_id == 2} == {""}
