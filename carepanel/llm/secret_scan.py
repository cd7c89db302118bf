"""Secrets in text: fixed patterns, and character Markov models that tell random strings from identifiers."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carepanel.llm.shared import ship_package

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
KEYWORDS = ("passw", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

#: Characters that the models know; all others share the last class.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CLASSES = len(ALPHABET) + 1
CLASS_OF = np.full(128, CLASSES - 1, np.int64)
CLASS_OF[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, secret part) of the fixed kinds, leftmost and non-overlapping per kind, in code points."""
    found = []
    lowered = text.lower()
    if any(k in lowered for k in KEYWORDS):
        found += [(m.start(), m.end(), "assign", m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access", m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), "hex", m[0]) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _classes(token: str) -> np.ndarray:
    codes = np.frombuffer(token.encode("utf-32-le"), "<u4")
    return CLASS_OF[np.minimum(codes, 127)]


def pair_counts(token: str) -> np.ndarray:
    """Positions in the flattened (state, next) table that a token visits; the start has a state of its own."""
    chars = _classes(token)
    return np.r_[CLASSES, chars[:-1]] * CLASSES + chars


class MarkovPair:
    """Log-likelihood ratio per character of the random-string model over the identifier model.

    A state seen rarely falls back on how often each character occurs at all in its model.
    """

    def __init__(self, random_counts: np.ndarray, plain_counts: np.ndarray, smoothing: float = 0.5):
        self.ratio = self._log(random_counts, smoothing) - self._log(plain_counts, smoothing)

    @staticmethod
    def _log(counts: np.ndarray, smoothing: float) -> np.ndarray:
        table = counts.reshape(CLASSES + 1, CLASSES)
        overall = table.sum(axis=0) + smoothing
        table = table + 4 * overall / overall.sum()
        return np.log(table / table.sum(axis=1, keepdims=True)).ravel()

    def score(self, token: str) -> float:
        return float(self.ratio[pair_counts(token)].mean()) if token else -math.inf


def labelled_tokens(text: str) -> Iterator[tuple[str, bool]]:
    """Tokens with a label: what the fixed kinds hold is random, long words and names outside them are ordinary.

    Assigned values count as random only where they mix letters and digits, as a password can be a plain word.
    """
    spans = base_spans(text)
    taken = [(s[0], s[1]) for s in spans]
    for _, _, kind, secret in spans:
        if kind != "assign" or (re.search("[0-9]", secret) and re.search("[A-Za-z]", secret)):
            yield secret, True
    for m in re.finditer(r"[A-Za-z][A-Za-z_-]{5,}[0-9]{0,2}", text):
        if not any(a < m.end() and m.start() < b for a, b in taken):
            yield m[0], False


def train_markov(docs: DataFrame, per_label: int = 5_000, text_col: str = "text") -> MarkovPair:
    """Both models, from a bounded labelled sample: ``per_label`` distinct tokens of each label at most.

    The sample holds the tokens with the smallest hashes, so it depends neither on row order nor on partitioning.
    Without any labelled token of a label its model is uniform.
    """
    ship_package(docs.sparkSession)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the smallest hashes of each task are enough to find the smallest of all
        least: dict[bool, dict[str, int]] = {True: {}, False: {}}

        def trim(label: bool) -> None:
            least[label] = dict(sorted(least[label].items(), key=lambda x: (x[1], x[0]))[:per_label])

        for batch in batches:
            for text in batch.column(0):
                for token, random in labelled_tokens(text.as_py() or ""):
                    token = token[:256]
                    if token not in least[random]:
                        least[random][token] = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=7).digest(), "big")
            for label in least:
                if len(least[label]) > 4 * per_label:
                    trim(label)
        for label in least:
            trim(label)
        rows = [(t, label, h) for label, kept in least.items() for t, h in kept.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.string(), pa.bool_(), pa.int64()))],
            ["token", "random", "hash"],
        )

    found = docs.select(F.col(text_col).cast("string")).mapInArrow(tokens, "token string, random boolean, hash long").distinct()
    first = Window.partitionBy("random").orderBy("hash", "token")
    sample = found.withColumn("n", F.row_number().over(first)).where(F.col("n") <= per_label).select("token", "random")
    counts = {label: np.zeros((CLASSES + 1) * CLASSES) for label in (True, False)}
    for token, random in sample.collect():  # 2 * per_label rows at most
        np.add.at(counts[random], pair_counts(token), 1)
    return MarkovPair(counts[True], counts[False])


def scan_text(text: str, model: MarkovPair, least_ratio: float) -> tuple[list, list]:
    """Base spans, and base spans plus those of kind ``random`` (start, end, kind) that overlap none of them."""
    base = [s[:3] for s in base_spans(text)]
    more = []
    for m in CANDIDATE.finditer(text):
        token = m[0]
        if not (re.search("[0-9]", token) and re.search("[A-Za-z]", token)):
            continue
        if model.score(token) >= least_ratio and not any(a < m.end() and m.start() < b for a, b, _ in base):
            more.append((m.start(), m.end(), "random"))
    return base, sorted(base + more, key=lambda s: (s[0], (*KINDS, "random").index(s[2])))


def find_secrets(docs: DataFrame, model: MarkovPair | None = None, least_ratio: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id with ``secrets``: array of (start, end, kind, base), and counts and digest of the base spans.

    Kinds: assign, access and hex by fixed pattern; random for a run of 16 or more key characters holding letters and
    digits whose log-likelihood ratio per character reaches ``least_ratio``. Offsets are code points, end exclusive.
    Null and empty texts have no spans. Null and repeated ids are kept as they are. An empty table gives no rows.
    Other columns are ignored. Texts are read whole, one at a time.
    """
    ship_package(docs.sparkSession)
    model = model or train_markov(docs, text_col=text_col)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())])

    @F.arrow_udf("array<struct<start:int,end:int,kind:string,base:boolean>>")
    def scanned(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            base, spans = scan_text(text.as_py() or "", model, least_ratio)
            out.append([{"start": a, "end": b, "kind": k, "base": k in KINDS} for a, b, k in spans])
        return pa.array(out, pa.list_(span))

    return docs.select(F.col(id_col), scanned(F.col(text_col).cast("string")).alias("secrets"))


def span_report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per fixed kind, digest of the base spans and all spans as text, from ``find_secrets``."""
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = written(F.filter("secrets", lambda s: s["base"]))
    return found.select(id_col, *(count(k) for k in KINDS), F.sha2(base, 256).alias("base_sha256"), written(F.col("secrets")).alias("spans"))
