"""The quality ranking and language identification."""

import math
import re
import zlib

import numpy as np
import regex
from pyspark.sql import functions as F

from shardbrook.llm import langid, quality
from shardbrook.llm.queries import LLM_QUERIES

SF_DIR = "/root/testdata/sf0.01"
ODD = [None, "", " ", "12 34 !!", "x" * 200_000, "word " * 30_000, "é\n\n|"]


def _held_out(key):
    return zlib.crc32(str(key).encode()) % 4 == 2


def test_pairs_rank_good_above_poor():
    rng = np.random.default_rng(1)
    good, poor = rng.normal(1, 0.3, (200, 3)), rng.normal(-1, 0.3, (50, 3))
    ranking = quality.fit_pairs(good, poor, 0.2)
    weights = np.array(ranking.weights)
    assert (good @ weights).min() > ranking.threshold > (poor @ weights).max()


def test_nothing_is_rejected_when_nothing_is_learned(documents, spark):
    docs = documents([*ODD, "fine text"])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    ranking = quality.learn(docs, labels)
    assert {r.predicted for r in quality.score_documents(docs, ranking).collect()} == {1}


def test_labels_of_held_out_and_doubtful_ids_are_not_used(documents, spark):
    docs = documents([(i, "a clean text" if i % 2 else "### $$$ %%% ###") for i in range(200)])
    right = [(i, i % 2, 0) for i in range(200)]
    wrong = [(i, 1 - i % 2 if _held_out(i) else i % 2, 0) for i in range(200)]
    wrong += [(None, 1, 0), (7, None, 0), (9, 5, 0)]
    rankings = [
        quality.learn(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
        for rows in (right, wrong)
    ]
    assert rankings[0] == rankings[1]
    both = spark.createDataFrame(right + [(1, 0, 0)], "doc_id long, quality int, toxic int")
    assert quality.learn(docs, both).weights


def test_scores_of_odd_rows(documents, spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    ranking = quality.learn(spark.read.parquet(f"{SF_DIR}/documents.parquet"), labels)
    docs = documents(ODD).selectExpr("*", "'x' AS score", "1 AS held_out", "3 AS _id")
    docs = docs.union(docs.where("doc_id = 3")).union(
        docs.where("doc_id = 6").selectExpr("NULL", *docs.columns[1:])
    )
    rows = quality.score_documents(docs, ranking).collect()
    assert len(rows) == len(ODD) + 2
    for row in rows:
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.7)
        assert row.held_out == (row.doc_id is None or _held_out(row.doc_id))
    assert quality.score_documents(docs.limit(0), ranking).count() == 0


def test_held_out_quality(spark):
    rows = LLM_QUERIES["op4_quality_ranking"](spark, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = rows.where("held_out").join(labels, "doc_id").select("quality", "predicted").collect()
    right = sum(r.quality == r.predicted for r in found)
    assert len(found) > 50 and right >= 0.95 * len(found)
    assert rows.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()


def test_tables_compute_the_network(spark):
    """Look-ups of byte pairs against the convolution written out."""
    net = langid.train(["the cat sat on the mat " * 20, "le chat est sur la table " * 20], ["en", "fr"], epochs=2)
    windows, _ = langid.windows_of(("the chat é " * 30).encode())
    pooled = []
    for w, filters, bias in zip(langid.WIDTHS, net.filters, net.biases):
        x = net.embedding[windows]
        response = sum(x[:, k : langid.WINDOW - w + 1 + k] @ filters[k] for k in range(w))
        pooled.append(response.max(axis=1) + bias)
    logits = np.maximum(np.concatenate(pooled, axis=1), 0) @ net.dense + net.offset
    wanted = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    assert np.allclose(langid.Predictor(net).probabilities(windows), wanted, atol=1e-5)


def test_a_text_is_the_average_of_its_windows():
    net = langid.train(["abc " * 200, "xyz " * 200], ["a", "x"], epochs=2)
    predictor = langid.Predictor(net)
    texts = [b"", b"abc", b"xyz " * 5000, b"abc " * 50 + b"xyz " * 9]
    together = predictor.predict(texts)
    assert np.allclose(together, np.concatenate([predictor.predict([t]) for t in texts]))
    assert np.allclose(together.sum(axis=1), 1)


def test_languages_of_odd_rows(documents):
    docs = documents([(i, "the cat sat on the mat", "en", "s", 1) for i in range(0, 40)] + [(i, "le chat est sur la table", "fr", "s", 1) for i in range(40, 80)] + [(90, "zzz", None, "s", 1), (91, "12", "12", "s", 1)])
    net = langid.learn(docs)
    assert net.languages == ["en", "fr"]
    odd = documents(ODD).selectExpr("*", "'x' AS lang_pred", "1 AS score", "1 AS _bytes")
    odd = odd.union(odd.where("doc_id = 4")).union(
        odd.where("doc_id = 4").selectExpr("NULL", *odd.columns[1:])
    )
    rows = langid.identify(odd, net).collect()
    assert len(rows) == len(ODD) + 2
    for row in rows:
        text = ODD[4 if row.doc_id is None else row.doc_id]
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= row.score <= 1
    assert langid.identify(odd.limit(0), net).count() == 0
    assert langid.learn(docs.where("lang IS NULL")) is None
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}


def test_held_out_languages(spark):
    rows = LLM_QUERIES["op7_language_id"](spark, SF_DIR)
    truth = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang")
    found = rows.join(truth, "doc_id").where("held_out").select(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")
    )
    assert found.first().right >= 0.97


def _features(text):
    """The quality features by plain Python."""
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [line for line in text.split("\n") if line]

    def share(part, whole):
        return math.sqrt(min(part / max(1, whole), 1.0))

    def count(pattern):
        return len(regex.findall(pattern, text))

    n, chars = len(words), len(text)
    return [
        share(count(r"[#*$%&|<>{}\[\]\\~^=_@]"), n),
        share(count(r"[!?]"), n),
        share(count(r"\p{Lu}"), chars),
        share(count(r"[0-9]"), chars),
        share(count(r"[\p{L}\x20\n.,]"), chars),
        math.log(max(1, n) / max(1, len(set(words)))),
        share(max(1, len(lines)) - len(set(lines)), len(lines)),
        min(max(1, chars) / max(1, n), 30.0) / 10,
        share(sum(not regex.search(r"[\p{L}\p{N}]", w) for w in words), n),
    ]


def test_quality_scores_against_plain_python(documents, spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    ranking = quality.learn(docs, labels)
    assert len(ranking.weights) == len(_features(""))
    some = [r.text for r in docs.collect()] + ODD + ["A B b B\nB\nB", "ÀÉ ß ﬁ İ 中文 😀 \x0b ¼ ² _ #"]
    found = quality.score_documents(documents(some), ranking).collect()
    assert len(found) == len(some)
    for row in found:
        strength = sum(w * f for w, f in zip(ranking.weights, _features(some[row.doc_id])))
        z = (strength - ranking.threshold) / ranking.scale + math.log(0.7 / 0.3)
        wanted = 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))
        assert abs(row.score - wanted) < 1e-9, some[row.doc_id][:80]


def test_the_bounds_of_the_samples_are_parameters(documents, spark):
    texts = [f"text number {i}" if i % 2 else "### $$$ ### und so weiter" for i in range(80)]
    docs = documents([(i, t, "en" if i % 2 else "de", "s", 0) for i, t in enumerate(texts)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)], "doc_id long, quality int, toxic int")
    assert quality.learn(docs, labels, pairs=50) != quality.learn(docs, labels, pairs=5000)
    short, long = langid.learn(docs, sample_chars=3), langid.learn(docs, sample_chars=300)
    assert not np.array_equal(short.embedding, long.embedding)


def _quality_rows():
    """Texts of two kinds whose features overlap, with their labels."""
    rng = np.random.default_rng(3)
    texts, labels = [], []
    for i in range(400):
        label = int(rng.random() < 0.7)
        words = [f"w{rng.integers(60)}" if rng.random() < 0.4 else "Word"[: rng.integers(1, 5)] for _ in range(40)]
        words += ["#!"] * int(rng.integers(0, 6 if label else 12))
        texts.append(" ".join(words))
        labels.append(label)
    return texts, labels


def test_all_pairs_of_all_labelled_documents_count(documents, spark):
    texts, labels = _quality_rows()
    told = spark.createDataFrame([(i, y, 0) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    docs = documents(list(enumerate(texts)))
    ranking = quality.learn(docs, told)
    f = np.array([_features(t) for i, t in enumerate(texts) if not _held_out(i)])
    y = np.array([label for i, label in enumerate(labels) if not _held_out(i)])
    spread = f.std(axis=0)
    spread[spread < 1e-9] = 1.0
    d = ((f[y == 1][:, None] - f[y == 0][None]) / spread).reshape(-1, f.shape[1])
    w = np.zeros(f.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-(d @ w)))
        slope = ((1 - p)[:, None] * d).mean(axis=0) - 1e-3 * w
        w += np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-3 * np.eye(len(w)), slope)
    assert np.abs(np.array(ranking.weights) * spread - w).max() < 2e-3
    strength = f @ np.array(ranking.weights)
    in_order, n_poor = np.sort(strength), int((y == 0).sum())
    assert abs(ranking.threshold - in_order[n_poor - 1 : n_poor + 1].mean()) < 1e-9
    assert abs(ranking.scale - np.median(np.abs(strength - ranking.threshold)) / 3) < 1e-9
    local = quality.fit_pairs(f[y == 1], f[y == 0], n_poor / len(y))
    assert np.allclose(local.weights, ranking.weights, atol=1e-3)
    assert abs(local.threshold - ranking.threshold) < 1e-2
    # The order and the partitions of the rows are of no account; a repeated row counts once.
    shuffled = docs.union(docs.limit(50)).orderBy(F.rand(1)).repartition(7)
    assert quality.learn(shuffled, told.repartition(3)) == ranking


def test_values_at_ranks(spark):
    rng = np.random.default_rng(2)
    for values in ([1.5], [2.0] * 9, [*rng.normal(size=3000), *[0.25] * 500, 1e9, -1e9], [0.0, 5e-324]):
        frame = spark.createDataFrame([(float(v),) for v in values], "v double")
        ordered = [*sorted(map(float, values)), max(map(float, values))]
        for rank in {0, len(values) // 2, len(values) - 1}:
            assert quality._at_rank(frame, rank) == (ordered[rank], ordered[rank + 1])
