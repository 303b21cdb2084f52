"""Toxicity by compression distance: how much better toxic text explains a window than ordinary text.

Two zstandard dictionaries are trained: one on ordinary documents, one on the words that toxic
documents hold clearly more often (see `_toxic_words`): some ordinary rows may quote such a word or
be labelled wrongly without taking it from the dictionary. A text
is cut into windows of WINDOW to 2 * WINDOW bytes at white space, A-Z lower-cased. Each window is
compressed knowing ordinary text, and knowing toxic text in front of the same ordinary text; the
difference of the two lengths is its gap, which only toxic content can make large. A logistic
regression on the largest gaps of a text, how many are large, and the number of windows is fitted
on other training rows than the dictionaries, and its scores are scaled piece by piece so that the
threshold with the best F1 is CUT.

The training sample is bounded: TOXIC_DOCS and ORDINARY_DOCS rows, of at most TEXT_BYTES each. The
threshold weighs them as the labels are in the whole table. Everything else reads whole texts.

Defined results: null, empty and blank texts have no window and get the score of a text without any
gap. A null label is no label; a document that is labelled twice counts twice. Without rows of both
labels to learn from, every score is 0. Repeated rows get equal scores. Other columns stay.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.llm.arrays import LOWER_BYTES
from lakepipe.llm.frames import bounded_sample, fresh_name, held_out, quoted, ship, table

WINDOW, LEVEL = 64, 6
TOXIC_DOCS, ORDINARY_DOCS, TEXT_BYTES = 2000, 6000, 1 << 16
TOXIC_BYTES, ORDINARY_BYTES = 4096, 16384
#: Toxic words stand in at least so many toxic documents of the sample, so many times as often there
#: as in ordinary ones, with this log-likelihood ratio (2e-4 of unrelated words reach it).
LEAST_DOCS, LEAST_RATIO, LEAST_EVIDENCE = 3, 4, 14
LARGE = 4
CUT = 0.3

_PLAIN = bytes(32 if b in b"\t\n\x0b\x0c\r" else LOWER_BYTES[b] for b in range(256))


def windows(text: str | None) -> list[bytes]:
    """Consecutive stretches of a text, each up to the first space after WINDOW bytes."""
    data = (text or "").encode().translate(_PLAIN).strip(b" ")
    out, at = [], 0
    while at < len(data):
        end = data.find(b" ", at + WINDOW, at + 2 * WINDOW)
        end = min(len(data), at + 2 * WINDOW) if end < 0 else end
        out.append(data[at:end])
        at = end
    return out


@dataclass(frozen=True)
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    cut: float


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False
    )


@lru_cache(maxsize=2)
def _compressors(ordinary: bytes, toxic: bytes):
    # The nearest content comes last, so ordinary text is found at equal distances by both.
    return _compressor(ordinary).compress, _compressor(toxic + ordinary).compress


def features(text: str | None, ordinary: bytes, toxic: bytes) -> list[float]:
    plain, with_toxic = _compressors(ordinary, toxic)
    gaps = sorted((len(plain(w)) - len(with_toxic(w)) for w in windows(text)), reverse=True)
    top = [max(0, g) for g in (gaps + [0, 0, 0])[:3]]
    large = sum(g >= LARGE for g in gaps)
    return [1.0, *top, float(np.log1p(large)), float(np.log1p(len(gaps)))]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; samples too small to train on are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _words(text: str) -> list[bytes]:
    return text.encode().translate(_PLAIN).split()


def _toxic_words(toxic: list[str], ordinary: list[str]) -> set[bytes]:
    """Words whose smoothed document frequency is LEAST_RATIO times that of ordinary documents, beyond chance."""
    inside, outside = (Counter(w for t in texts for w in set(_words(t))) for texts in (toxic, ordinary))
    found = set()
    for word, n in inside.items():
        other = outside[word]
        if n < LEAST_DOCS or (n + 0.5) * (len(ordinary) + 1) < LEAST_RATIO * (other + 0.5) * (len(toxic) + 1):
            continue
        expected = (n + other) * len(toxic) / (len(toxic) + len(ordinary))
        evidence = n * np.log(n / expected)
        if other:
            evidence += other * np.log(other / (n + other - expected))
        if 2 * evidence >= LEAST_EVIDENCE:
            found.add(word)
    return found


def train(texts: list[str], labels: list[int], ordinary_per_toxic: float | None = None) -> ToxicityModel | None:
    """Dictionaries from every other row, calibration on the rest.

    `ordinary_per_toxic` is the ratio of the labels where the model will be used; without it, that
    of the given rows.
    """
    toxic, ordinary = ([t for t, y in zip(texts, labels) if y == wanted] for wanted in (1, 0))
    if len(toxic) < 2 or len(ordinary) < 2:
        return None
    chosen = _toxic_words(toxic[::2], ordinary[::2])
    distinct = [b" ".join(w for w in _words(t) if w in chosen) + b" " for t in toxic[::2]]
    ordinary_dict = _dictionary([w for t in ordinary[::2] for w in windows(t)], ORDINARY_BYTES)
    toxic_dict = _dictionary([s for s in distinct if len(s) >= 8], TOXIC_BYTES)

    rest = toxic[1::2] + ordinary[1::2]
    x = np.array([features(t, ordinary_dict, toxic_dict) for t in rest])
    y = np.array([1.0] * len(toxic[1::2]) + [0.0] * len(ordinary[1::2]))
    weights = _logistic(x, y)
    p = 1 / (1 + np.exp(-x @ weights))
    order = np.argsort(-p, kind="stable")
    each = 1.0 if ordinary_per_toxic is None else ordinary_per_toxic * y.sum() / (len(y) - y.sum())
    hits, wrong = np.cumsum(y[order]), np.cumsum(1 - y[order]) * each
    f1 = 2 * hits / (hits + wrong + y.sum())
    last = np.append(p[order][1:] < p[order][:-1], True)
    best = int(np.argmax(np.where(last, f1, -1)))
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return ToxicityModel(ordinary_dict, toxic_dict, tuple(weights.tolist()), float((p[order][best] + below) / 2))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Newton's method with a ridge, each label weighing the same."""
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum())) * len(y)
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w)) * penalty
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + ridge @ w
        w = w - np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, gradient)
    return w


def score(text: str | None, model: ToxicityModel | None) -> float:
    if model is None:
        return 0.0
    z = float(np.dot(features(text, model.ordinary, model.toxic), model.weights))
    p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    if p < model.cut:
        return float(CUT * p / model.cut)
    return float(CUT + (1 - CUT) * (p - model.cut) / max(1 - model.cut, 1e-12))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic"):
    """Learn from a bounded sample of labelled documents that are not held out, drawn by a hash of key and label.

    Of documents with the same key one is learnt from, the one whose text has the smallest hash.
    """
    named = labels.select(quoted(key).alias("key"), quoted(label).cast("int").alias("label"))
    usable = named.filter(F.col("label").isin(0, 1) & F.col("key").isNotNull() & ~held_out(F.col("key")))
    usable = usable.withColumn("text_hash", F.xxhash64("label"))
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    chosen = bounded_sample(usable.filter("label = 1"), "label", "key", TOXIC_DOCS).unionByName(
        bounded_sample(usable.filter("label = 0"), "label", "key", ORDINARY_DOCS)
    )
    texts = docs.select(quoted(key).alias("key"), quoted(text).alias("text")).filter(
        F.octet_length("text").between(1, TEXT_BYTES)
    )
    # At most TOXIC_DOCS + ORDINARY_DOCS rows of two numbers.
    labelled = texts.join(F.broadcast(chosen.select("key", "label")), "key")
    first = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    rows = labelled.groupBy("key", "label").agg(first).select("key", "label", "first.text")
    rows = rows.orderBy(F.xxhash64("key"), "key", "label").toArrow()
    ratio = counts.get(0, 0) / max(1, counts.get(1, 0))
    return train(rows.column("text").to_pylist(), rows.column("label").to_pylist(), ratio)


def add_score(docs: DataFrame, model: ToxicityModel | None, text: str = "text", into: tuple[str, str] = ("score", "predicted")):
    """Add score and prediction; columns of these names are replaced."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([score(t.as_py(), shared.value) for t in column], pa.float64())

    found = fresh_name(docs, "_toxicity")
    scored = docs.withColumn(found, scores(quoted(text)))
    return scored.withColumns({into[0]: F.col(found), into[1]: (F.col(found) >= CUT).cast("int")}).drop(found)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return add_score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE: dict[str, str] = {}
