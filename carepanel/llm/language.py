"""Language of whole texts: sparse multinomial logistic regression on TF-IDF character n-grams.

Trained online with follow-the-regularised-leader (per-coordinate rates, elastic net), then calibrated with one
temperature. Document frequencies count every training text; only the fit itself uses a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carepanel.llm.shared import ship_package

BITS = 13
FEATURES = 1 << BITS
LONGEST_GRAM = 3
CHUNK = 1 << 20
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> np.ndarray | None:
    """Counts of the hashed 1- to 3-grams of a whole text; None if it is null or has no letter.

    Letters are lower-cased, each run of other characters is one space. Long texts are read in overlapping chunks.
    """
    counts, tail, seen = np.zeros(FEATURES, np.int64), np.full(1, 32, np.uint32), False
    text = text or ""
    for at in range(0, len(text), CHUNK):
        codes = np.frombuffer(text[at : at + CHUNK].lower().encode("utf-32-le", "replace"), "<u4")
        letter = _letters()[codes]
        seen = seen or bool(letter.any())
        codes = np.r_[tail, np.where(letter, codes, 32)]
        codes = codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]]
        known = len(tail)
        tail = codes[1 - LONGEST_GRAM :]
        state = codes.astype(np.uint32)
        for n in range(1, LONGEST_GRAM + 1):
            if n > 1:
                state = state[:-1] ^ codes[n - 1 :]
            state = state * np.uint32(0x9E3779B1) + np.uint32(n)
            state ^= state >> np.uint32(15)
            new = state[max(0, known - n + 1) :]  # grams that end after the part already counted
            counts += np.bincount((new * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS), minlength=FEATURES)
    return counts if seen else None


def _weighted(counts: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(counts)
    value = (1 + np.log(counts[at])) * idf[at]
    return at, value / np.sqrt(np.square(value).sum())


class Model:
    """Weights, document-frequency weights, temperature and the languages in the order of the columns."""

    def __init__(self, languages: list[str], weights: np.ndarray, idf: np.ndarray, temperature: float = 1.0):
        self.languages, self.weights, self.idf, self.temperature = languages, weights, idf, temperature

    def logits(self, counts: np.ndarray) -> np.ndarray:
        at, value = _weighted(counts, self.idf)
        return value @ self.weights[at]

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = gram_counts(text) if self.languages else None
        if counts is None:
            return UNKNOWN, 0.0
        p = _softmax(self.logits(counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def follow_the_leader(rows, classes: int, epochs: int = 4, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.001, seed: int = 7) -> np.ndarray:
    """Weights (feature x class) after FTRL-proximal passes over rows of (positions, values, class).

    Every coordinate keeps its summed gradient z and squared gradient n; its weight is zero while |z| is within l1,
    else -(z - sign(z) l1) / ((beta + sqrt(n)) / alpha + l2).
    """
    z, n = np.zeros((FEATURES, classes)), np.zeros((FEATURES, classes))

    def weight(at):
        rate = (beta + np.sqrt(n[at])) / alpha
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / (rate + l2))

    draw = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            at, value, label = rows[i]
            w = weight(at)
            error = _softmax(value @ w)
            error[label] -= 1
            gradient = value[:, None] * error
            squared = n[at] + np.square(gradient)
            z[at] += gradient - (np.sqrt(squared) - np.sqrt(n[at])) / alpha * w
            n[at] = squared
    return weight(slice(None)).astype(np.float32)


def best_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm.

    The target is 1 - 1 / (n + 2) for the label and the rest for the others, so that texts which are all told apart do
    not drive every score to 1.
    """
    if not len(labels):
        return 1.0
    classes = logits.shape[1]
    rest = 1 / (len(labels) + 2)
    target = np.full(logits.shape, rest / max(1, classes - 1))
    target[np.arange(len(labels)), labels] = 1 - rest

    def loss(log_t: float) -> float:
        return float(-(target * np.log(np.maximum(_softmax(logits / np.exp(log_t)), 1e-300))).sum(axis=1).mean())

    low, high, golden = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame, text_col: str) -> tuple[np.ndarray, int]:
    """In how many of all texts with a letter each feature occurs, and how many texts those are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(FEATURES + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                counts = gram_counts(text.as_py())
                if counts is not None:
                    found[:-1] += counts > 0
                    total += 1
        found[-1] = total
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], ["feature", "n"])

    rows = texts.select(text_col).mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    frequency = np.zeros(FEATURES + 1, np.int64)
    for feature, n in rows.collect():  # FEATURES + 1 rows at most
        frequency[feature] = n
    return frequency[:-1], int(frequency[-1])


def train(labelled: DataFrame, per_language: int = 500, text_col: str = "text", lang_col: str = "lang", most_languages: int = 200) -> Model:
    """A model of the languages of all rows with a non-null label.

    The fit takes ``per_language`` distinct texts of each of the ``most_languages`` most frequent labels at most: those
    with the smallest hashes, so neither row order nor copies matter. Four fifths of them train the weights, the
    rest set the temperature. Document frequencies count every labelled text.
    """
    ship_package(labelled.sparkSession)
    usable = labelled.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("lang is not null and text is not null")
    frequency, total = document_frequencies(usable, "text")
    idf = np.log((1 + total) / (1 + frequency)) + 1

    key = F.xxhash64("text")
    first = Window.partitionBy("lang").orderBy("key")
    labels = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages)
    learned = usable.where(F.col("lang").isin([r.lang for r in labels.collect()]))
    drawn = learned.select("lang", key.alias("key")).distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_language)
    drawn = F.broadcast(drawn.select("lang", "key"))  # per_language * most_languages rows at most
    picked = learned.withColumn("key", key).join(drawn, ["lang", "key"], "left_semi")

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, hashed, text in zip(*(batch.column(i) for i in range(3)), strict=True):
                counts = gram_counts(text.as_py())
                if counts is not None:
                    at = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays([pa.array([lang.as_py()]), pa.array([hashed.as_py()]), pa.array([at.astype(np.int32)]), pa.array([counts[at]])], ["lang", "key", "at", "n"])

    sample = picked.select("lang", "key", "text").mapInArrow(sparse, "lang string, key long, at array<int>, n array<long>")
    sample = sample.dropDuplicates(["lang", "key"]).toArrow().sort_by([("key", "ascending"), ("lang", "ascending")])
    languages = sorted(set(sample.column("lang").to_pylist()))
    rows = []
    for lang, at, n in zip(*(sample.column(c) for c in ("lang", "at", "n")), strict=True):
        counts = np.zeros(FEATURES, np.int64)
        counts[at.values.to_numpy()] = n.values.to_numpy()
        rows.append((*_weighted(counts, idf), languages.index(lang.as_py())))
    fit, held = [r for i, r in enumerate(rows) if i % 5], rows[::5]
    if not languages:
        return Model([], np.zeros((FEATURES, 0), np.float32), idf)
    model = Model(languages, follow_the_leader(fit or rows, len(languages)), idf)
    logits = np.array([value @ model.weights[at] for at, value, _ in held]).reshape(len(held), len(languages))
    model.temperature = best_temperature(logits, np.array([label for _, _, label in held]))
    return model


def is_held_out(id_col: str = "doc_id"):
    """crc32 of the id as text is divisible by 5; a null id counts as the empty text, whose crc32 is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0


def with_language(docs: DataFrame, model: Model, text_col: str = "text", into: str = "language") -> DataFrame:
    """Every row with ``into``, a struct of ``lang`` and ``score`` (calibrated probability); all its columns stay.

    Null texts and texts without a letter get ``und`` and 0, as does every text if nothing was learned.
    """
    ship_package(docs.sparkSession)

    @F.arrow_udf("struct<lang:string,score:double>")
    def predicted(texts: pa.Array) -> pa.Array:
        found = [model.predict(t.as_py()) for t in texts]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang", "score"])

    return docs.withColumn(into, predicted(F.col(text_col).cast("string")))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 500) -> DataFrame:
    """Per row: id, held_out, lang_pred, score. Only rows that are not held out and have a label are learned from.

    Null and repeated ids are kept (a null id is held out). An empty table gives no rows. Other columns are ignored.
    """
    model = train(docs.where(~is_held_out(id_col)), per_language, text_col, lang_col)
    rows = docs.select(F.col(id_col), is_held_out(id_col).alias("held_out"), F.col(text_col).alias("_text"))
    return with_language(rows, model, "_text", "_found").select(id_col, "held_out", F.col("_found.lang").alias("lang_pred"), F.col("_found.score").alias("score"))
