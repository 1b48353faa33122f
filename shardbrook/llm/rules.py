"""Quality rules, and a hashed n-gram log-likelihood ratio against a trusted target.

Words are runs of anything but ASCII white space.  Base rules reject a document by
counts taken inside it.  The method then compares two multinomials over hashed
n-grams of words: one of trusted documents, one of the whole corpus.  A document's
score is the sum of its n-grams' log ratios divided by their number, and it is kept
if that reaches a fixed threshold.  Both multinomials count all documents; what they
leave is one number per hash bucket, whatever the size of the corpus.

Everything here is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardbrook.llm.common import settled, whole_text

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[^#*$%&|<>]+"  # what is not a symbol
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
BUCKETS = 1 << 16
# A document whose n-grams are, on average, this much rarer in trusted text than in
# the corpus is rejected.
THRESHOLD = -0.1


def _hashes(df: DataFrame, id_col: str, text_col: str, own: list[str]) -> DataFrame:
    """The id, ``own`` columns, the text, its words and the words' hashes."""
    return (
        df.select(F.col(id_col).alias("_id"), *own, whole_text(text_col).alias("_text"))
        .withColumn("_words", F.array_remove(F.split("_text", f"{SPACE}+"), ""))
        .withColumn("_n", F.size("_words"))
        .withColumn("_hash", F.transform("_words", lambda w: F.xxhash64(w)))
    )


def _windows(n: Column, hashes: Column, size: int) -> Column:
    """Hashes of all windows of ``size`` words."""
    return F.when(
        n >= size,
        F.transform(
            F.sequence(F.lit(0), n - size),
            lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(size))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _measured(df: DataFrame, searched: Column | None = None) -> DataFrame:
    """Adds the base counts; repeated windows are looked for where ``searched`` says so."""
    n = F.col("_n") if searched is None else F.when(searched, F.col("_n")).otherwise(0)
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    repeated = F.size(F.array_distinct("_grams")) < F.size("_grams")
    # Windows sorted by hash: equal ones stand next to each other.
    by_hash = F.when(
        repeated,
        F.array_sort(
            F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        ),
    )

    def place_if_repeated(k: Column) -> Column:
        s = F.col("_sorted")
        this = F.get(s, k)
        same = (F.get(s, k - 1)["h"] == this["h"]) | (F.get(s, k + 1)["h"] == this["h"])
        return F.when(F.coalesce(same, F.lit(False)), this["i"])

    places = F.when(
        F.col("_sorted").isNotNull(),
        F.array_sort(
            F.filter(
                F.transform(F.sequence(F.lit(0), F.size("_sorted") - 1), place_if_repeated),
                lambda i: i.isNotNull(),
            )
        ),
    )
    p = F.col("_places")
    covered = F.when(
        F.size(p) > 0,
        F.aggregate(
            F.zip_with(
                F.slice(p, 2, F.size(p)),
                p,
                # The last place has none after it.
                lambda after, i: F.least(F.coalesce(after - i, F.lit(WINDOW)), F.lit(WINDOW)),
            ),
            F.lit(0).cast("long"),
            lambda total, step: total + step,
        ),
    )
    return (
        df.withColumn("_grams", _windows(n, F.col("_hash"), WINDOW))
        .withColumn("_sorted", by_hash)
        .withColumn("_places", places)
        .select(
            *(c for c in df.columns),
            F.col("_n").cast("long").alias("n_words"),
            F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("_text", SYMBOLS, "")).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        )
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
    )


def _bucket(hashed: Column, buckets: int) -> Column:
    """``buckets`` is a power of two."""
    return hashed.bitwiseAND(F.lit(buckets - 1)).cast("int")


def log_ratios(hashed: DataFrame, trusted: Column, buckets: int) -> DataFrame:
    """One row, ``ratios``: per bucket the log of its trusted over its corpus probability.

    Counts of both multinomials are smoothed by one half.
    """
    counts = (
        hashed.select(
            F.coalesce(trusted, F.lit(False)).cast("long").alias("t"),
            F.concat("_hash", "_pairs").alias("g"),
        )
        # The outer form: the plain one adds a filter on "g", which the planner moves down
        # and which would then compute the hashes anew for every window.
        .select("t", F.explode_outer("g").alias("h"))
        .select("t", _bucket(F.col("h"), buckets).alias("bucket"))
        .groupBy("bucket")
        .agg(F.sum("t").alias("t"), F.count("*").alias("a"))
    )
    # One row per bucket from here on, whatever the corpus.
    every = hashed.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("t", F.lit(0)).alias("t"), F.coalesce("a", F.lit(0)).alias("a")
    )
    listed = filled.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "t", "a"))).alias("of"),
        (F.sum("t") + 0.5 * buckets).alias("all_t"),
        (F.sum("a") + 0.5 * buckets).alias("all_a"),
    )
    return listed.select(
        F.transform(
            "of",
            lambda e: F.log((e["t"] + 0.5) / F.col("all_t")) - F.log((e["a"] + 0.5) / F.col("all_a")),
        ).alias("ratios")
    )


def _may_repeat() -> Column:
    """False where too few pairs of words come again for the base rules to fail.

    Every pair inside a window that comes again comes again too.  Such windows cover runs of
    at least ``WINDOW - 1`` pairs that are found twice or more, so at most ``WINDOW / (WINDOW
    - 1)`` words for each of those pairs; and at least half of them are not the first of
    their kind.
    """
    again = F.size("_pairs") - F.size(F.array_distinct("_pairs"))
    return 100 * 2 * WINDOW * again > MAX_REPEAT_PERCENT * (WINDOW - 1) * F.col("_n")


def default_trust() -> Column:
    """Texts that pass the base rules, with hardly a symbol and mostly distinct pairs of words."""
    return (
        ~F.col("base_failed")
        & (100 * F.col("n_symbols") <= F.col("_n"))
        & (2 * F.size(F.array_distinct("_pairs")) >= F.size("_pairs"))
    )


def judge(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
    trusted: Column | None = None,
    buckets: int = BUCKETS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Counts, score and verdict for every row.

    Returns ``id_col``, the ``keep`` columns and ``n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, score, kept``.  ``trusted`` is a
    condition on ``_text``, its words ``_words`` (``_n`` of them), the base counts, ``base_failed`` and
    ``keep`` columns; without it, base rules are part of what makes a text trusted.  A null or empty text has no words and fails the base
    rules; its score is 0.  Null and repeated ids are taken like any other row;
    columns not named are not read, and a ``keep`` column may have any name but
    those of the result.

    ``docs`` is read twice: once for the multinomials, once for the verdicts.  The
    only shuffle is of bucket counts, summed in each task first; the driver gets
    ``buckets`` numbers.
    """
    own = list(keep)
    hashed = _hashes(docs, id_col, text_col, own)
    measured = _measured(hashed)
    paired = hashed.withColumn("_pairs", _windows(F.col("_n"), F.col("_hash"), 2))
    if trusted is None:
        # Only whether the base rules fail is asked here.
        model = log_ratios(_measured(paired, _may_repeat()), default_trust(), buckets)
    else:
        model = log_ratios(_measured(paired), trusted, buckets)
    # One number per bucket, in thousandths; folded to a constant array by the planner.
    listed = model.select(
        F.to_json(F.transform("ratios", lambda r: F.round(r * 1000).cast("int"))).alias("r")
    ).first()["r"]
    ratios = F.from_json(F.lit(listed), "array<int>")

    def ratio(hashed: Column) -> Column:
        return F.get(ratios, _bucket(hashed, buckets))

    zero = F.lit(0).cast("long")
    ones = F.aggregate("_hash", zero, lambda total, h: total + ratio(h))
    pairs = F.aggregate(
        _windows(F.col("_n"), F.col("_hash"), 2), zero, lambda total, h: total + ratio(h)
    )
    grams = F.greatest(2 * F.col("n_words") - 1, F.lit(1))
    return settled(
        measured.withColumn("score", (ones + pairs) / (1000.0 * grams))
        .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
        .select(
            F.col("_id").alias(id_col),
            *own,
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            "score",
            "kept",
        )
    )
