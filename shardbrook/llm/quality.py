"""Document quality by Bradley-Terry pairwise ranking.

Each document is a vector of features.  Every pair of labelled documents (a good one,
a poor one) is a preference, and weights are fitted so that the logistic function of the
weighted feature difference predicts which of the two is preferred.  A document's
strength is its weighted features; the threshold is the quantile of strengths that
leaves below it the share of poor documents among all labelled ones.  Strengths are mapped
to scores from 0 to 1 such that the threshold falls on ``CUT``.

All labelled documents and all their pairs count, but no pair is written out.  For one step of
the fit a document is dealt by its strength to the two nearest of ``GRID`` places, and
Spark adds up counts, features and their products there.  A sum over pairs of documents is
then one over pairs of places, whatever the number of documents.  Scoring is column expressions
over the whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardbrook.llm.common import held_out, settled, whole_text
from shardbrook.storage import store

CUT = 0.7
PER_CLASS = 2000  # labelled documents of each kind, if a fit is bounded by the caller
PAIRS = 20_000  # preference pairs, if a fit is bounded by the caller
GRID = 1024  # places of strength in a step of the fit, and ranges in a search for a rank
RIDGE = 1e-3
UNIT = float(1 << 24)  # sums are of whole numbers of 1 / UNIT, so their order is of no account


def _left(text: Column, dropped: str) -> Column:
    """How many characters are left without those that match."""
    return F.length(F.regexp_replace(text, dropped, "")).cast("double")


def features(text_col: str = "_text") -> dict[str, Column]:
    """What a score sees of a text; ``_words`` and ``_lines`` are its words and lines."""
    text = F.col(text_col)
    n_words = F.greatest(F.size("_words").cast("double"), F.lit(1.0))
    n_chars = F.greatest(F.length(text).cast("double"), F.lit(1.0))
    n_lines = F.greatest(F.size("_lines").cast("double"), F.lit(1.0))
    distinct = F.greatest(F.size(F.array_distinct("_words")).cast("double"), F.lit(1.0))

    def share(part: Column, whole: Column) -> Column:
        return F.sqrt(F.least(part / whole, F.lit(1.0)))

    return {
        "symbols": share(_left(text, r"[^#*$%&|<>{}\[\]\\~^=_@]+"), n_words),
        "exclaiming": share(_left(text, r"[^!?]+"), n_words),
        "upper": share(_left(text, r"[^\p{Lu}]+"), n_chars),
        "digits": share(_left(text, r"[^0-9]+"), n_chars),
        "letters": share(_left(text, r"[^\p{L}\x20\n.,]+"), n_chars),
        "repeats": F.log(n_words / distinct),
        "same_lines": share(n_lines - F.size(F.array_distinct("_lines")), n_lines),
        "word_length": F.least(n_chars / n_words, F.lit(30.0)) / 10,
        "bare_signs": share(
            F.size(F.filter("_words", lambda w: ~w.rlike(r"[\p{L}\p{N}]"))).cast("double"), n_words
        ),
    }


def _featured(docs: DataFrame, text_col: str, own: list) -> DataFrame:
    parts = docs.select(*own, whole_text(text_col).alias("_text")).withColumns(
        {
            "_words": F.array_remove(F.split("_text", r"[\x20\x09-\x0D]+"), ""),
            "_lines": F.array_remove(F.split("_text", "\n"), ""),
        }
    )
    return parts.withColumn("_f", F.array(*features().values()))


@dataclass
class Ranking:
    """Weights over raw features; a strength of ``threshold`` scores ``CUT``."""

    weights: list[float]
    threshold: float
    scale: float

    def strength(self, f: Column) -> Column:
        strength = F.lit(0.0)
        for i, w in enumerate(self.weights):
            strength = strength + F.get(f, F.lit(i)) * w
        return strength

    def score(self, f: Column) -> Column:
        z = (self.strength(f) - self.threshold) / self.scale + float(np.log(CUT / (1 - CUT)))
        return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))


def _moments(u: np.ndarray, strength: np.ndarray, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the grid, and in ``UNIT`` the sums there of 1, features and their products.

    A row stands between two places; its parts go to both, the nearer one's is larger.
    """
    at = np.clip((strength - grid[0]) / (grid[1] - grid[0]), 0.0, len(grid) - 1.0)
    low = np.minimum(at.astype(np.int64), len(grid) - 2)
    upper = np.triu_indices(u.shape[1])
    row = np.column_stack([np.ones(len(u)), u, u[:, upper[0]] * u[:, upper[1]]])
    both = np.concatenate([row * (1 - (at - low))[:, None], row * (at - low)[:, None]])
    units, places = np.rint(both * UNIT).astype(np.int64), np.concatenate([low, low + 1])
    order = np.argsort(places, kind="stable")
    found, starts = np.unique(places[order], return_index=True)
    return found, np.add.reduceat(units[order], starts, axis=0)


def _strength(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Row by row, so that a row's strength does not depend on the rows around it."""
    strength = np.zeros(len(u))
    for k in range(len(w)):
        strength += u[:, k] * w[k]
    return strength


def _fit(low: np.ndarray, high: np.ndarray, sums: Callable) -> np.ndarray:
    """Weights by Newton steps on the logistic loss of all pairs of a good and a poor row.

    ``sums(w, grid)`` gives for both kinds, good first, the ``_moments`` of all rows; ``low``
    and ``high`` bound their features.
    """
    width = len(low)
    w, upper = np.zeros(width), np.triu_indices(width)
    for _ in range(30):
        least, most = np.minimum(low * w, high * w).sum(), np.maximum(low * w, high * w).sum()
        grid = np.linspace(least - 1e-6, most + 1e-6, GRID)
        good, poor = sums(w, grid)
        p = 1 / (1 + np.exp(-np.clip(grid[:, None] - grid[None, :], -50, 50)))
        pairs = good[:, 0].sum() * poor[:, 0].sum()

        def squares(kind: np.ndarray, weight: np.ndarray) -> np.ndarray:
            found = np.zeros((width, width))
            found[upper] = weight @ kind[:, 1 + width :]
            return found + np.triu(found, 1).T

        g, q = good[:, 1 : 1 + width], poor[:, 1 : 1 + width]
        slope = ((1 - p) @ poor[:, 0]) @ g - ((1 - p).T @ good[:, 0]) @ q
        bend = p * (1 - p)
        cross = g.T @ bend @ q
        second = squares(good, bend @ poor[:, 0]) + squares(poor, bend.T @ good[:, 0]) - cross - cross.T
        step = np.linalg.solve(second / pairs + RIDGE * np.eye(width), slope / pairs - RIDGE * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_pairs(
    good: np.ndarray,
    poor: np.ndarray,
    poor_share: float,
    *,
    pairs: int | None = None,
    seed: int = 5,
) -> Ranking:
    """Fit weights to all pairs of rows, or to so many that are drawn, by Newton steps.

    Without both kinds there are no pairs: weights are zero and every text scores
    ``CUT``, so nothing is rejected.
    """
    if not len(good) or not len(poor):
        return Ranking([0.0] * max(good.shape[1], poor.shape[1]), 0.0, 1.0)
    both = np.concatenate([good, poor])
    spread = both.std(axis=0)
    spread[spread < 1e-9] = 1.0
    if pairs is None:
        kinds = [(kind - both.mean(axis=0)) / spread for kind in (good, poor)]

        def sums(w: np.ndarray, grid: np.ndarray) -> list[np.ndarray]:
            found = [_moments(u, _strength(u, w), grid) for u in kinds]
            return [_on_grid(*f) for f in found]

        every = np.concatenate(kinds)
        w = _fit(every.min(axis=0), every.max(axis=0), sums)
    else:
        w = _fit_drawn(good, poor, spread, pairs, seed)
    weights = w / spread
    # The rows may hold both kinds in other shares than the labels do.
    strength = both @ weights
    mass = np.concatenate(
        [np.full(len(good), (1 - poor_share) / len(good)), np.full(len(poor), poor_share / len(poor))]
    )
    order = np.argsort(strength, kind="stable")
    below = np.cumsum(mass[order])
    at = int(np.searchsorted(below, poor_share - 1e-12))
    following = min(at + 1, len(order) - 1)
    threshold = float(strength[order[at]] + strength[order[following]]) / 2
    scale = max(float(np.median(np.abs(strength - threshold))) / 3, 1e-6)
    return Ranking([float(x) for x in weights], threshold, scale)


def _on_grid(places: np.ndarray, units: np.ndarray) -> np.ndarray:
    full = np.zeros((GRID, units.shape[1]))
    full[places] = units / UNIT
    return full


def _fit_drawn(
    good: np.ndarray, poor: np.ndarray, spread: np.ndarray, pairs: int, seed: int
) -> np.ndarray:
    rng = np.random.default_rng(seed)
    d = (good[rng.integers(0, len(good), pairs)] - poor[rng.integers(0, len(poor), pairs)]) / spread
    w, ridge = np.zeros(d.shape[1]), RIDGE * pairs
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -50, 50)))
        slope = d.T @ (1 - p) - ridge * w
        bend = (d * (p * (1 - p))[:, None]).T @ d + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def _at_rank(values: DataFrame, rank: int) -> tuple[float, float]:
    """The values of column ``v`` at ``rank`` (from 0) and the next rank, exactly.

    Rounds of counts in ``GRID`` ranges of the values left; each leaves one range.  The last
    value has none after it and comes twice.
    """
    v = F.col("v")
    low, high, n = values.agg(F.min(v), F.max(v), F.count("*")).first()
    after = None
    while low < high:
        place = F.least(F.floor((v - low) / (high - low) * GRID), F.lit(GRID - 1))
        found = (
            values.where(v.between(low, high))
            .groupBy(place.alias("place"))
            .agg(F.min(v).alias("low"), F.max(v).alias("high"), F.count("*").alias("n"))
            .orderBy("place")
            .collect()  # at most GRID rows
        )
        for i, part in enumerate(found):
            if rank < part["n"]:
                break
            rank -= part["n"]
        if i + 1 < len(found):
            after = found[i + 1]["low"]
        low, high, n = part["low"], part["high"], part["n"]
    return low, low if rank + 1 < n or after is None else after


def _fit_all(rows: DataFrame) -> Ranking:
    """A ranking from all rows of the stored table ``_label, f``."""
    names = list(features())
    width = len(names)
    flat = rows.select("_label", *(F.get("f", F.lit(i)).alias(c) for i, c in enumerate(names)))

    def whole(part: Column) -> Column:
        return F.sum(F.round(part * UNIT).cast("bigint"))

    ends = flat.agg(
        F.count("*").alias("n"),
        F.sum("_label").alias("n_good"),
        *(whole(F.col(c)).alias(f"sum_{c}") for c in names),
        *(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in names),
    ).first()
    n, n_good = ends["n"], ends["n_good"] or 0
    if not n_good or n_good == n:
        return Ranking([0.0] * width, 0.0, 1.0)
    mean = [ends[f"sum_{c}"] / UNIT / n for c in names]
    squares = flat.agg(*(whole((F.col(c) - m) * (F.col(c) - m)) for c, m in zip(names, mean))).first()
    center, spread = np.array(mean), np.sqrt(np.array(squares, dtype=float) / UNIT / n)
    spread[spread < 1e-9] = 1.0
    n_sums = 1 + width + width * (width + 1) // 2

    def sums(w: np.ndarray, grid: np.ndarray) -> list[np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = {kind: np.zeros((GRID, n_sums), dtype=np.int64) for kind in (1, 0)}
            for batch in batches:
                label, *parts = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                u = (np.column_stack(parts) - center) / spread
                strength = _strength(u, w)
                for kind, total in held.items():
                    own = label == kind
                    if own.any():
                        places, units = _moments(u[own], strength[own], grid)
                        total[places] += units
            for kind, total in held.items():
                places = np.flatnonzero(total.any(axis=1))
                columns = [np.full(len(places), kind, dtype=np.int32), places.astype(np.int32)]
                columns += list(total[places].T)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], fields)

        fields = ["kind", "place", *(f"s{i}" for i in range(n_sums))]
        schema = "kind int, place int, " + ", ".join(f"s{i} bigint" for i in range(n_sums))
        found = (
            flat.mapInArrow(run, schema)
            .groupBy("kind", "place")
            .agg(*(F.sum(f"s{i}") for i in range(n_sums)))
            .collect()  # at most two rows for each place of the grid
        )
        kinds = []
        for kind in (1, 0):
            own = sorted(tuple(r)[1:] for r in found if r["kind"] == kind)
            table = np.array(own, dtype=np.int64)
            kinds.append(_on_grid(table[:, 0], table[:, 1:]))
        return kinds

    low, high = (np.array([ends[f"{f}_{c}"] for c in names]) for f in ("min", "max"))
    weights = [float(x) for x in _fit((low - center) / spread, (high - center) / spread, sums) / spread]
    strengths = store(rows.select(Ranking(weights, 0.0, 1.0).strength(F.col("f")).alias("v")), "strengths")
    threshold = sum(_at_rank(strengths, n - n_good - 1)) / 2
    far = strengths.select(F.abs(F.col("v") - threshold).alias("v"))
    middle, following = _at_rank(far, (n - 1) // 2)
    median = middle if n % 2 else (middle + following) / 2
    return Ranking(weights, threshold, max(median / 3, 1e-6))


def learn(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    per_class: int | None = None,
    pairs: int | None = None,
) -> Ranking:
    """Fit all pairs of all labelled documents.

    Labels of held-out ids, null ids, and anything but 0 or 1 are not used; an id
    with both labels is not either.  A repeated id counts once.

    Features are computed before the labels are joined, so ids and features are shuffled and
    no text is.  They are written once; each step of the fit reads them.

    A caller may bound the fit: then it sees ``pairs`` drawn pairs of ``per_class``
    documents of each kind at most, those with the smallest hashes of their ids.
    """
    usable = (
        labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1))
        .groupBy(F.col(id_col).alias("_id"))
        .agg(F.min(label_col).alias("_low"), F.max(label_col).alias("_label"))
        .where("_low = _label")
        .select("_id", "_label")
    )
    if per_class is None and pairs is None:
        told = settled(
            _featured(docs.where(~held_out(id_col)), text_col, [F.col(id_col).alias("_id")]).select("_id", "_f")
        )
        found = told.join(usable, "_id").groupBy("_id", "_label").agg(F.max("_f").alias("f"))
        return _fit_all(store(found.select("_label", "f"), "labelled"))
    per_class, pairs = per_class or PER_CLASS, pairs or PAIRS
    share = {r["_label"]: r["count"] for r in usable.groupBy("_label").count().collect()}
    wanted = None
    for kind in (0, 1):
        some = usable.where(F.col("_label") == kind).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        wanted = some if wanted is None else wanted.unionByName(some)
    # Not more than twice per_class rows of two numbers.
    found = _featured(
        docs.join(F.broadcast(wanted), F.col(id_col) == F.col("_id")), text_col, ["_id", "_label"]
    )
    rows = (
        found.groupBy("_id", "_label").agg(F.max("_f").alias("f")).select("_label", "f").collect()
    )
    width = len(features())
    kinds = [
        np.array([r["f"] for r in rows if r["_label"] == k], dtype=float).reshape(-1, width)
        for k in (1, 0)
    ]
    total = sum(share.values())
    return fit_pairs(*kinds, share.get(0, 0) / total if total else 0.0, pairs=pairs)


def score_documents(
    docs: DataFrame,
    ranking: Ranking,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``id_col, keep..., held_out, score, predicted`` for every row.

    ``predicted`` is 1 where the score reaches ``CUT``.  A null text counts as empty
    and is scored as such.  Null and repeated ids are scored like any other (a null
    id is held out); columns not named are not read.  No shuffle.
    """
    scored = _featured(
        docs, text_col, [F.col(id_col).alias("_id"), *keep, held_out(id_col).alias("held_out")]
    ).withColumn("score", ranking.score(F.col("_f")))
    return settled(
        scored.select(
            F.col("_id").alias(id_col),
            *keep,
            "held_out",
            "score",
            (F.col("score") >= CUT).cast("int").alias("predicted"),
        )
    )
