import importlib
import os
import subprocess
import sys

from pyspark.sql import functions as F

import corpus_pipeline
from shardbrook.llm import rules, secrets, simhash
from shardbrook.llm.queries import LLM_QUERIES

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_one_by_one(spark, tmp_path):
    """Each stage against its operator's own result on the stage's input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def run(name, docs):
        path = str(tmp_path / name.replace(" ", "-"))
        stages[name](spark, docs, SF_DIR).write.parquet(path)
        return spark.read.parquet(path)

    ruled = run("quality rules", docs)
    assert ruled.columns == COLUMNS
    wanted = {r.doc_id for r in rules.judge(docs).collect() if r.kept}
    assert {r.doc_id for r in ruled.collect()} == wanted
    assert ruled.exceptAll(docs).isEmpty()

    good = run("quality classifier", ruled)
    assert good.columns == COLUMNS and good.exceptAll(ruled).isEmpty()
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").where("quality = 1")
    lost = ruled.join(good, "doc_id", "left_anti").join(labels, "doc_id")
    assert lost.count() <= 0.01 * ruled.count()

    single = run("simhash near-dedup", good)
    groups = {r.component_id for r in simhash.near_duplicates(good).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(groups)
    assert single.columns == COLUMNS and single.exceptAll(good).isEmpty()

    masked = run("secret scan", single)
    assert masked.columns == COLUMNS and masked.count() == single.count()
    found = {r.doc_id: r for r in secrets.find_secrets(single).collect()}
    both = masked.join(single.select("doc_id", F.col("text").alias("was")), "doc_id").collect()
    assert any(r.places for r in found.values())
    for row in both:
        assert (row.text == row.was) == (not found[row.doc_id].places)
        assert row.n_chars == len(row.text)

    packed = run("best-fit packing", masked)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in masked.collect()}


def test_whole_run_and_its_parts_agree(spark):
    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert packed.columns[:2] == ["doc_id", "piece"] and packed.count() > 100


def test_odd_tables(spark, documents):
    good = "Some words that make a sentence which is long enough to stay here."
    rows = [(1, good), (1, good), (2, good), (None, good + " More of them."), (3, None), (4, "")]
    rows.append((5, good + " password = abcdefgh1 and then it goes on for a while in clear words"))
    docs = documents(rows).selectExpr("*", "true AS kept", "1 AS score", "'x' AS spans", "2 AS _id")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        empty = stage(spark, docs.limit(0), SF_DIR)
        assert empty.columns == columns and empty.count() == 0, name
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema)
    found = {r.doc_id: r for r in docs.collect()}
    assert set(found) >= {1, 5} and 2 not in found and 3 not in found and 4 not in found
    assert docs.where("doc_id = 1").count() == 1
    assert secrets.MASK in found[5].text and found[5].n_chars == len(found[5].text)


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert names >= set(LLM_QUERIES) | {"pipeline"}
    assert {int(n[2:].split("_")[0]) for n in LLM_QUERIES} == set(range(1, 14))
    assert set(entry.oracle_sql()) <= names


def test_nothing_of_the_package_is_needed_on_the_workers(tmp_path):
    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    code = (
        f"import sys; sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "from shardbrook.session import build_session\n"
        "spark = build_session('x', 'local[4]', spark_ui_enabled='false')\n"
        "for n in ('op1_byte_bpe', 'op3_best_fit_packing', 'op5_html_extract', 'op7_language_id',\n"
        "          'op8_top_products', 'op9_simhash'):\n"
        "    print('rows', n, e.queries()[n](spark, '/root/testdata/sf0.001').count() > 0)\n"
    )
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code],
        cwd=tmp_path,
        env=environment,
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.stdout.count("True") == 6, done.stderr[-2000:]
