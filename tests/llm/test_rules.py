import random
import re
from collections import Counter

from pyspark.sql import functions as F

from shardbrook.llm import rules


def _base(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, repeated_lines = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated_lines += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = set()
    for i, window in enumerate(windows):
        if often[window] > 1:
            covered.update(range(i, i + 5))
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, repeated_lines, len(covered), failed


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
TEXTS = [
    None,
    "",
    " \n \t",
    "one two three four five",
    "a b c d e a b c d e f",
    "a a a a a a a a a a a a",
    "l1 x y\nl1 x y\n\n\n \nl2\nl1 x y",
    " ".join(f"w{i}" for i in range(60)) + " w1 w2 w3 w4 w5 w6",
    "é\xa0b #*$%&|<> 😀 " * 3,
    " ".join(f"v{i}" for i in range(30_000)) + " v7 v8 v9 v10 v11",
    "p q r s t " * 2000,
]


def test_counts(documents):
    docs = documents(TEXTS).selectExpr("*", "'x' AS score", "false AS kept", "1 AS n_words")
    docs = docs.union(docs.where("doc_id = 4")).union(
        docs.where("doc_id = 7").selectExpr("NULL", *docs.columns[1:])
    )
    rows = rules.judge(docs, keep=("lang",)).collect()
    assert len(rows) == len(TEXTS) + 2
    for row in rows:
        text = TEXTS[7 if row.doc_id is None else row.doc_id]
        assert tuple(row[n] for n in NAMES) == _base(text), text
        assert row.lang == "en"
        assert row.kept == (not row.base_failed and row.score >= rules.THRESHOLD)
    assert rules.judge(docs.limit(0)).count() == 0


def test_score_is_the_mean_log_ratio(documents):
    """Against a plain computation over the same hash buckets."""
    import math

    texts = ["good words stand here in a row of ten words", "bad bad words", "good words", "", None]
    docs = documents(texts)
    buckets = 1 << 10
    rows = {
        r.doc_id: r.score
        for r in rules.judge(docs, trusted=F.col("_text").contains("good"), buckets=buckets).collect()
    }
    spark = docs.sparkSession

    def grams(text):
        words = (text or "").split()
        if not words:
            return []
        hashes = [r.h for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.xxhash64("w").alias("h")).collect()]
        two = list(zip(hashes, hashes[1:]))
        pairs = (
            [r.h for r in spark.createDataFrame(two, "a long, b long").select(F.xxhash64("a", "b").alias("h")).collect()]
            if two
            else []
        )
        return [h & (buckets - 1) for h in hashes + pairs]

    every = [grams(t) for t in texts]
    all_, good = Counter(), Counter()
    for text, found in zip(texts, every):
        all_.update(found)
        if text and "good" in text:
            good.update(found)
    n_all, n_good = sum(all_.values()), sum(good.values())
    for key, found in enumerate(every):
        ratios = [
            round(1000 * (math.log((good[b] + 0.5) / (n_good + 0.5 * buckets)) - math.log((all_[b] + 0.5) / (n_all + 0.5 * buckets))))
            for b in found
        ]
        wanted = sum(ratios) / 1000 / len(ratios) if ratios else 0.0
        assert abs(rows[key] - wanted) < 0.0015


def test_clean_text_stays_and_junk_goes(spark):
    from shardbrook.llm.queries import LLM_QUERIES

    sf_dir = "/root/testdata/sf0.01"
    rows = LLM_QUERIES["op6_quality_rules"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("q"))
    found = rows.join(labels, "doc_id").where("NOT base_failed").groupBy("q", "kept").count().collect()
    n = {(r.q, r.kept): r["count"] for r in found}
    assert n.get((1, False), 0) <= 0.01 * n[1, True]
    assert n.get((0, True), 0) <= 0.1 * n[0, False]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for row in rows.collect():
        assert tuple(row[c] for c in NAMES) == _base(texts[row.doc_id])


def test_few_repeated_pairs_can_not_fail_the_base_rules(documents):
    """Texts on both sides of the limit: where repeats are not looked for there are too few."""
    rng = random.Random(9)
    texts = []
    for _ in range(400):
        words = [f"w{rng.randrange(rng.choice([20, 300, 5000]))}" for _ in range(rng.randint(10, 120))]
        for _ in range(rng.randint(0, 3)):
            at, size = rng.randrange(len(words)), rng.randint(5, 12)
            words[rng.randrange(len(words)) : 0] = words[at : at + size]
        texts.append(" ".join(words))
    hashed = rules._hashes(documents(texts), "doc_id", "text", [])
    paired = hashed.withColumn("_pairs", rules._windows(F.col("_n"), F.col("_hash"), 2))
    whole = {r._id: r.base_failed for r in rules._measured(paired).select("_id", "base_failed").collect()}
    some = rules._measured(paired, rules._may_repeat()).select("_id", "base_failed", rules._may_repeat().alias("searched"))
    found = some.collect()
    assert {r._id: r.base_failed for r in found} == whole
    assert {True, False} == set(whole.values()) and any(not r.searched for r in found)
