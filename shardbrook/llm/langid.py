"""Language identification by a byte convolutional network.

A window of bytes (ASCII letters in lower case) is embedded, filters of several
widths slide over it, each filter's largest response is kept, and a softmax layer
turns those into probabilities.  The network is trained in numpy on windows of a
bounded sample of labelled texts.  A text is cut into fixed-length windows, all of
them are scored in batches, and their probabilities are averaged by length.

At prediction a filter of width w is a sum of table look-ups: bytes are looked up
in pairs, in tables that hold the embedded and weighted value of each pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardbrook.llm.common import held_out, whole_text

WINDOW = 128  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 12  # of each width
EMBEDDING = 8
PER_LANGUAGE = 600  # labelled texts of each language that training sees
SAMPLE_CHARS = 512  # of each of them that training sees
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING
    filters: list[np.ndarray]  # per width: width x EMBEDDING x FILTERS
    biases: list[np.ndarray]
    dense: np.ndarray
    offset: np.ndarray


def windows_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The text's windows (the last filled with zero bytes) and how long each is."""
    raw = np.frombuffer(text.lower(), dtype=np.uint8)
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, dtype=np.uint8)
    out[: len(raw)] = raw
    sizes = np.full(n, WINDOW)
    sizes[-1] = len(raw) - (n - 1) * WINDOW
    return out.reshape(n, WINDOW), sizes


def train(texts: list[str], names: list[str], *, epochs: int = 12, seed: int = 11) -> Network:
    """Fit by Adam on the windows of labelled texts; deterministic for one input."""
    languages = sorted(set(names))
    rng = np.random.default_rng(seed)
    rows, marks = [], []
    for text, name in zip(texts, names):
        found, _ = windows_of(text.encode())
        rows.append(found)
        marks += [languages.index(name)] * len(found)
    x, y = np.concatenate(rows), np.array(marks)
    value = {
        "e": rng.normal(0, 0.5, (256, EMBEDDING)),
        "d": rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))),
        "o": np.zeros(len(languages)),
    }
    for w in WIDTHS:
        value[f"f{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS))
        value[f"b{w}"] = np.zeros(FILTERS)
    value = {k: v.astype(np.float32) for k, v in value.items()}
    first = {k: np.zeros_like(v) for k, v in value.items()}
    second = {k: np.zeros_like(v) for k, v in value.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            some = order[at : at + 128]
            xb, yb = x[some], y[some]
            n = len(xb)
            embedded = value["e"][xb]
            pooled, best = [], []
            for w in WIDTHS:
                slides = np.lib.stride_tricks.sliding_window_view(embedded, w, axis=1)
                slides = slides.transpose(0, 1, 3, 2).reshape(n, WINDOW - w + 1, w * EMBEDDING)
                response = slides @ value[f"f{w}"]
                top = response.argmax(axis=1)
                pooled.append(np.take_along_axis(response, top[:, None], axis=1)[:, 0] + value[f"b{w}"])
                best.append(top)
            z = np.concatenate(pooled, axis=1)
            h = np.maximum(z, 0)
            logits = h @ value["d"] + value["o"]
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(n), yb] -= 1
            p /= n
            slope = {k: np.zeros_like(v) for k, v in value.items()}
            slope["d"], slope["o"] = h.T @ p, p.sum(axis=0)
            back = (p @ value["d"].T) * (z > 0)
            for i, w in enumerate(WIDTHS):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                slope[f"b{w}"] = g.sum(axis=0)
                places = best[i][:, :, None] + np.arange(w)  # n x FILTERS x w
                seen = xb[np.arange(n)[:, None, None], places]
                got = value["e"][seen].reshape(n, FILTERS, w * EMBEDDING)
                slope[f"f{w}"] = np.einsum("nfk,nf->kf", got, g)
                to_bytes = (value[f"f{w}"].T[None] * g[:, :, None]).reshape(-1, EMBEDDING)
                np.add.at(slope["e"], seen.reshape(-1), to_bytes)
            step += 1
            rate = 0.01 * (1 - epoch / epochs) + 0.001
            for k in value:
                first[k] += 0.1 * (slope[k] - first[k])
                second[k] += 0.001 * (slope[k] ** 2 - second[k])
                lift = np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8
                value[k] -= rate * (first[k] / (1 - 0.9**step)) / lift
    return Network(
        languages,
        value["e"],
        [value[f"f{w}"].reshape(w, EMBEDDING, FILTERS) for w in WIDTHS],
        [value[f"b{w}"] for w in WIDTHS],
        value["d"],
        value["o"],
    )


class Predictor:
    """The network as tables of byte pairs."""

    def __init__(self, network: Network):
        self.network = network
        parts = [
            [network.embedding @ taps for taps in filters] for filters in network.filters
        ]  # per width and place: 256 x FILTERS

        def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (a[:, None] + b[None]).reshape(256 * 256, -1).astype(np.float32)

        # What starts at a byte, for all widths, and what follows two bytes on.
        self.start = np.concatenate([pair(p[0], p[1]) for p in parts], axis=1)
        self.third = parts[1][2].astype(np.float32)
        self.third_fourth = pair(parts[2][2], parts[2][3])

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        net, n = self.network, FILTERS
        wide = windows.astype(np.int32)
        pairs = wide[:, :-1] * 256 + wide[:, 1:]
        start = self.start[pairs]  # windows x places x (widths * FILTERS)
        three = start[:, :-1, n : 2 * n] + self.third[windows[:, 2:]]
        four = start[:, :-2, 2 * n :] + self.third_fourth[pairs[:, 2:]]
        pooled = [start[:, :, :n].max(axis=1), three.max(axis=1), four.max(axis=1)]
        h = np.maximum(np.concatenate([p + b for p, b in zip(pooled, net.biases)], axis=1), 0)
        logits = h @ net.dense + net.offset
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def predict(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities of whole texts: their windows' average, weighted by length."""
        total = np.zeros((len(texts), len(self.network.languages)))
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = 0

        def flush() -> None:
            nonlocal held, count
            windows, sizes, owner = (np.concatenate(c) for c in zip(*held))
            for at in range(0, len(windows), 512):
                part = slice(at, at + 512)
                weighted = self.probabilities(windows[part]) * sizes[part, None]
                np.add.at(total, owner[part], weighted)
            held, count = [], 0

        for i, text in enumerate(texts):
            windows, sizes = windows_of(text)
            held.append((windows, np.maximum(sizes, 1), np.full(len(windows), i)))
            count += len(windows)
            if count >= 4096:
                flush()
        if held:
            flush()
        return total / np.maximum(total.sum(axis=1, keepdims=True), 1e-12)


def learn(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = PER_LANGUAGE,
    sample_chars: int = SAMPLE_CHARS,
) -> Network | None:
    """Train on about ``per_language`` labelled texts of each language.

    Training sees ``sample_chars`` characters of each, from a place given by its id;
    predictions read whole texts.

    Held-out rows, rows with a null language, and texts without a letter are not
    used.  Rows are chosen by a hash of their id at a rate that follows from their
    language's count, so the sample is the same in every run and small languages are
    in it.  None if there is no labelled text.
    """
    labelled = docs.select(
        F.col(id_col).alias("_id"),
        F.col(lang_col).cast("string").alias("_lang"),
        whole_text(text_col).alias("_text"),
        (~held_out(id_col)).alias("_seen"),
    ).where("_seen AND _lang IS NOT NULL")
    # As many rows as the network has outputs.
    counts = {r["_lang"]: r["count"] for r in labelled.groupBy("_lang").count().collect()}
    if not counts:
        return None
    rates = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, per_language / n)))
    share = F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(1_000_000)) / 1e6
    room = F.greatest(F.length("_text") - sample_chars, F.lit(0)) + 1
    place = (F.pmod(F.xxhash64("_id", F.lit(4)), room) + 1).cast("int")
    chosen = (
        labelled.where(share < F.element_at(rates, F.col("_lang")))
        .select("_lang", "_id", F.substring("_text", place, F.lit(sample_chars)).alias("_text"))
        .where(F.col("_text").rlike(r"\p{L}"))
        # A repeated id may stand for many rows of one rate.
        .groupBy("_lang", "_id")
        .agg(F.min("_text").alias("_text"))
    )
    rows = sorted((r["_lang"], r["_text"]) for r in chosen.select("_lang", "_text").collect())
    if not rows:
        return None
    return train([text for _, text in rows], [lang for lang, _ in rows])


def identify(
    docs: DataFrame,
    network: Network | None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, held_out, lang_pred, score`` for every row.

    A null text, or one without a letter, is ``und`` with score 0, and so is every
    text when nothing was learned.  Null and repeated ids are predicted like any
    other; other columns are not read.  No shuffle; the network is broadcast (its
    size does not depend on the data).
    """
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        held_out(id_col).alias("held_out"),
        F.when(text.rlike(r"\p{L}"), text.cast("binary")).alias("_bytes"),
    )
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["_id"].dataType),
            T.StructField("held_out", T.BooleanType()),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(vars(network) if network else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(Network(**shared.value)) if shared.value else None
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                texts = batch.column("_bytes").to_pylist()
                names: list[str] = [UNKNOWN] * len(texts)
                scores = [0.0] * len(texts)
                known = [i for i, text in enumerate(texts) if text is not None]
                if predictor and known:
                    p = predictor.predict([texts[i] for i in known])
                    for i, best, row in zip(known, p.argmax(axis=1), p):
                        names[i] = predictor.network.languages[best]
                        scores[i] = min(1.0, float(row[best]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), batch.column("held_out"), pa.array(names), pa.array(scores)],
                    names=schema.names,
                )

    return rows.mapInArrow(run, schema)
