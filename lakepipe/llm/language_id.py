"""Language identification by a convolutional network over bytes, trained in numpy.

Filters of several widths slide over fixed-length windows of bytes; each keeps its maximum over the
window, and a softmax turns these maxima into probabilities. A text is cut into consecutive windows
without gaps, so all of it is read; its score for a language is the mean over its windows.

Defined results: a null text and a text without any letter are `und` with score 1.0. A text that is
shorter than a window is padded with zero bytes, a very long one just has more windows. Rows with a
null lang are predicted like others and not learnt from. If there is nothing to learn from, every
text is `und` with score 0.0. Repeated rows get equal results; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.arrays import flat, slices
from lakepipe.llm.frames import bounded_sample, fresh_name, held_out, quoted, ship, table, texts_of

UNDETERMINED = "und"
#: Bounds of the training sample: documents of each language and of all, windows of each document.
DOCS_PER_LANGUAGE, SAMPLE_DOCS, WINDOWS_PER_DOC = 400, 4096, 3
WINDOW = 256
WIDTHS, FILTERS, EMBEDDING = (2, 3, 4), 16, 8
EPOCHS, BATCH, RATE = 5, 64, 0.01
CHUNK, PREDICT_BYTES = 32, 1 << 19

_LETTER = regex.compile(r"\p{L}")


@dataclass
class LanguageModel:
    """`taps[w][j]` maps the byte at offset j of a width-w filter to its share of the filter's output."""

    languages: list[str]
    taps: dict[int, np.ndarray] = field(default_factory=dict)
    biases: dict[int, np.ndarray] = field(default_factory=dict)
    output: np.ndarray | None = None
    output_bias: np.ndarray | None = None

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """(windows x languages) for uint8 windows."""
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), CHUNK):
            part = windows[at : at + CHUNK]
            pooled = []
            for width, taps in self.taps.items():
                reach = part.shape[1] - width + 1
                total = taps[0][part[:, :reach]]
                for j in range(1, width):
                    total += taps[j][part[:, j : j + reach]]
                pooled.append(np.maximum(total.max(axis=1) + self.biases[width], 0))
            logits = np.concatenate(pooled, axis=1) @ self.output + self.output_bias
            logits = np.exp(logits - logits.max(axis=1, keepdims=True))
            out[at : at + CHUNK] = logits / logits.sum(axis=1, keepdims=True)
        return out


def cut_windows(column: pa.Array, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(windows, bounds): text t has windows[bounds[t]:bounds[t+1]], at least one, zero-padded."""
    data, offsets = flat(column)
    lengths = np.diff(offsets)
    counts = np.maximum(1, -(-lengths // size))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    grid = np.zeros(bounds[-1] * size, np.uint8)
    grid[np.arange(len(data)) + np.repeat(bounds[:-1] * size - offsets[:-1], lengths)] = data
    return grid.reshape(-1, size), bounds


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed: int = 7) -> LanguageModel:
    """Adam on the cross-entropy; max pooling lets the gradient flow through one place per filter."""
    if not languages:
        return LanguageModel([])
    draw = np.random.default_rng(seed)
    features = FILTERS * len(WIDTHS)
    p = {"emb": draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)}
    for w in WIDTHS:
        p[f"w{w}"] = draw.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS)).astype(np.float32)
        p[f"b{w}"] = np.zeros(FILTERS, np.float32)
    p["out"] = draw.normal(0, features**-0.5, (features, len(languages))).astype(np.float32)
    p["bias"] = np.zeros(len(languages), np.float32)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = draw.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            x, y = windows[rows].astype(np.int64), labels[rows]
            vectors = p["emb"][x]
            pooled, places = [], {}
            for w in WIDTHS:
                reach = x.shape[1] - w + 1
                patches = np.concatenate([vectors[:, j : j + reach] for j in range(w)], axis=2)
                conv = patches @ p[f"w{w}"] + p[f"b{w}"]
                best = conv.argmax(axis=1)
                top = np.take_along_axis(conv, best[:, None, :], 1)[:, 0]
                places[w] = (best, np.take_along_axis(patches, best[:, :, None], 1), top > 0)
                pooled.append(np.maximum(top, 0))
            hidden = np.concatenate(pooled, axis=1)
            logits = hidden @ p["out"] + p["bias"]
            probs = np.exp(logits - logits.max(axis=1, keepdims=True))
            probs /= probs.sum(axis=1, keepdims=True)
            probs[np.arange(len(y)), y] -= 1
            probs /= len(y)
            g = {"out": hidden.T @ probs, "bias": probs.sum(axis=0), "emb": np.zeros_like(p["emb"])}
            back = probs @ p["out"].T
            for i, w in enumerate(WIDTHS):
                best, patch, alive = places[w]
                d = back[:, i * FILTERS : (i + 1) * FILTERS] * alive
                g[f"w{w}"] = np.einsum("bfe,bf->ef", patch, d)
                g[f"b{w}"] = d.sum(axis=0)
                into = d[:, :, None] * p[f"w{w}"].T[None]
                for j in range(w):
                    used = np.take_along_axis(x, best + j, 1)
                    np.add.at(g["emb"], used, into[:, :, j * EMBEDDING : (j + 1) * EMBEDDING])
            step += 1
            for k in p:
                first[k] = 0.9 * first[k] + 0.1 * g[k]
                second[k] = 0.999 * second[k] + 0.001 * g[k] ** 2
                p[k] -= (
                    RATE
                    * (first[k] / (1 - 0.9**step))
                    / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                ).astype(np.float32)
    taps = {w: np.stack([p["emb"] @ part for part in np.split(p[f"w{w}"], w)]).astype(np.float32) for w in WIDTHS}
    return LanguageModel(languages, taps, {w: p[f"b{w}"] for w in WIDTHS}, p["out"], p["bias"])


def _sampled_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Up to WINDOWS_PER_DOC windows of each text, evenly spaced over it."""
    for batch in batches:
        for at, part in slices(batch.column("text")):
            windows, bounds = cut_windows(part)
            counts = np.minimum(np.diff(bounds), WINDOWS_PER_DOC)
            chosen = np.concatenate(
                [np.linspace(a, b - 1, c).astype(np.int64) for a, b, c in zip(bounds[:-1], bounds[1:], counts)]
            )
            lang = batch.column("lang").slice(at, len(part)).take(pa.array(np.repeat(np.arange(len(part)), counts)))
            yield pa.RecordBatch.from_arrays(
                [lang, pa.array([w.tobytes() for w in windows[chosen]], pa.binary())], ["lang", "window"]
            )


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from the documents that are not held out; the sample is bounded and drawn by a hash of key and text.

    A missing key is not held out, like the key of an empty text. Rows that agree in key, text and
    language are one document of the sample.
    """
    ship(docs.sparkSession)
    known = docs.select(quoted(key).alias("key"), quoted(text).alias("text"), quoted(lang).alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("key"))
    )
    known = known.withColumn("text_hash", F.xxhash64("text"))
    drawn = bounded_sample(known, "lang", "key", DOCS_PER_LANGUAGE)
    # At most SAMPLE_DOCS rows of a key, a language and a hash.
    chosen = drawn.orderBy(F.xxhash64("text_hash", "key"), "key", "lang").limit(SAMPLE_DOCS)
    sample = texts_of(known.select("key", "text_hash", "text"), chosen, "lang")
    rows = sample.mapInArrow(_sampled_windows, "lang string, window binary").orderBy("lang", "window").toArrow()
    languages = sorted(set(rows.column("lang").to_pylist()))
    code = {name: i for i, name in enumerate(languages)}
    labels = np.array([code[x] for x in rows.column("lang").to_pylist()], np.int64)
    grid = np.frombuffer(b"".join(rows.column("window").to_pylist()), np.uint8).reshape(-1, WINDOW)
    return train(grid, labels, languages)


def _predict(model: LanguageModel, column: pa.Array) -> tuple[list[str], np.ndarray]:
    names, scores = [], np.zeros(len(column))
    for at, part in slices(column, PREDICT_BYTES):
        windows, bounds = cut_windows(part)
        letters = np.array([_LETTER.search(t) is not None for t in part.to_pylist()])
        if not model.languages:
            names += [UNDETERMINED] * len(part)
            scores[at : at + len(part)] = np.where(letters, 0.0, 1.0)
            continue
        probs = model.probabilities(windows).astype(np.float64)
        mean = np.add.reduceat(probs, bounds[:-1], axis=0) / np.diff(bounds)[:, None]
        best = mean.argmax(axis=1)
        names += [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters)]
        scores[at : at + len(part)] = np.where(letters, mean[np.arange(len(part)), best], 1.0)
    return names, np.clip(scores, 0.0, 1.0)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")):
    """Add the predicted language and its score. A column that already has one of these names is replaced."""

    ship(docs.sparkSession)

    @F.arrow_udf("lang_pred string, score double")
    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            names, scores = _predict(model, column)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang_pred", "score"])

    found = fresh_name(docs, "_language")
    with_result = docs.withColumn(found, predict(quoted(text)))
    return with_result.withColumns(
        {into[0]: F.col(f"{found}.lang_pred"), into[1]: F.col(f"{found}.score")}
    ).drop(found)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


QUERIES = {"op10_language_id": op10_language_id}
ORACLE: dict[str, str] = {}
