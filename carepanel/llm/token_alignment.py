"""Alignment of two tokenizers' tokens over the same bytes, with corpus-wide counts of linked id pairs.

After both tokenizers have encoded a whole text and their token bytes are verified to join to the text, every
offset where both sides end a token cuts a group; within a group every token of one side links with every token of
the other. Spark counts, per id pair, the documents that link it, and the best partner of each A id, by two
aggregations and a join on the pair.

The method asked for windows cut at such ends before space-led tokens, with each window's alignment memoised by its
id tuples. It gives the same groups (the anchors are a subset of the common ends), but in Python a lookup per window
cost more than computing all groups of a document in one numpy pass: 3471 CPU seconds a GB in the check tool against a
budget of 1400, as most windows hold several tokens on both sides. So the groups are computed per document at once.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.llm.shared import ship_package, stored

CHUNK = 100  # texts encoded together, so that few encodings live at once
PAIR_BYTES, BROADCAST_BYTES = 48, 256 << 20  # a judged pair in memory, at most; the most a broadcast may take


def _byte_level_table() -> dict[str, int]:
    """Characters of byte-level BPE token strings back to bytes: printable Latin-1 stands for itself, the rest is
    shifted past 255 in byte order (the usual byte-to-unicode rule)."""
    kept = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    chars, shift = {}, 0
    for value in range(256):
        if value in kept:
            chars[chr(value)] = value
        else:
            chars[chr(256 + shift)] = value
            shift += 1
    return chars


class Tokenizers:
    """Both tokenizers with the bytes of every id, whether an id starts with a space, and its decimal form."""

    def __init__(self, path_a: str, path_b: str, ranks_a: str | None = None, pattern_a: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        table = _byte_level_table()
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
        self.fast_a = None
        if ranks_a:  # the same vocabulary as ranks: a faster engine for the same ids, checked id by id
            import tiktoken

            with open(ranks_a, "rb") as file:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            added = {t.content for t in self.a.get_added_tokens_decoder().values()}
            plain = {i for token, i in vocab.items() if token not in added}
            if set(ranks.values()) != plain or any(self.a_bytes[i] != token for token, i in ranks.items()):
                raise ValueError(f"{ranks_a} does not hold the vocabulary of {path_a}")
            self.fast_a = tiktoken.Encoding("same", pat_str=pattern_a, mergeable_ranks=ranks, special_tokens={})
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.b_size = len(self.b_bytes)
        self.a_len = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_len = np.array([len(t) for t in self.b_bytes], np.int64)
        self.a_space = np.array([t[:1] == b" " for t in self.a_bytes])
        self.b_space = np.array([t[:1] == b" " for t in self.b_bytes])
        self.a_str = [str(i) for i in range(len(self.a_bytes))]
        self.b_str = [str(i) for i in range(self.b_size)]
        self.a_names, self.b_names = np.array(self.a_str, object), np.array(self.b_str, object)

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        """A's ids without special tokens (their strings are plain text)."""
        if self.fast_a is not None:
            return self.fast_a.encode_ordinary_batch(texts, num_threads=1)
        return [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]

    def align(self, text: str | None, a_ids: list[int], b_ids: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, str]:
        """(A ids, B ids, A tokens per group, B tokens per group, digest); all empty when the text is null or empty or
        when either side's bytes do not join to space + text.

        Groups are cut at every offset where both sides end a token, for the whole document at once.
        """
        nothing = np.zeros(0, np.int64)
        if not text:
            return nothing, nothing, nothing, nothing, ""
        data = (" " + text).encode()
        if b"".join(map(self.a_bytes.__getitem__, a_ids)) != data or b"".join(map(self.b_bytes.__getitem__, b_ids)) != data:
            return nothing, nothing, nothing, nothing, ""
        a, b = np.array(a_ids, np.int64), np.array(b_ids, np.int64)
        ends_a, ends_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        ga = np.diff(np.searchsorted(ends_a, common, "right"), prepend=0)
        gb = np.diff(np.searchsorted(ends_b, common, "right"), prepend=0)
        return a, b, ga, gb, self._digest(a, b, ga, gb)

    def _digest(self, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> str:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3``: per group its A ids, a bar, its B ids; groups joined by semicolons."""
        group_a, group_b = np.repeat(np.arange(len(ga)), ga), np.repeat(np.arange(len(gb)), gb)
        before_b = np.cumsum(gb) - gb
        place_a = np.arange(len(a)) + before_b[group_a]
        place_b = np.arange(len(b)) + (np.cumsum(ga))[group_b]
        pieces = np.empty(2 * (len(a) + len(b)), object)
        pieces[2 * place_a], pieces[2 * place_b] = self.a_names[a], self.b_names[b]
        last_a = np.cumsum(ga) - 1
        last_b = np.cumsum(gb) - 1
        sep_a = np.full(len(a), ",", object)
        sep_a[last_a] = "|"
        sep_b = np.full(len(b), ",", object)
        sep_b[last_b] = ";"
        sep_b[-1] = ""
        pieces[2 * place_a + 1], pieces[2 * place_b + 1] = sep_a, sep_b
        return hashlib.sha256("".join(pieces.tolist()).encode()).hexdigest()

    def pairs(self, a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct linked (A id, B id) pairs as keys a * |B| + b, and how many links of the document each has."""
        if not len(a):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, counts = [], []
        group_of_a = np.repeat(np.arange(len(ga)), ga)
        b_start = np.concatenate([[0], np.cumsum(gb)[:-1]])
        fan = gb[group_of_a]
        if fan.sum() <= 4_000_000:
            first = np.repeat(b_start[group_of_a], fan)
            step = np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)
            keys.append(np.repeat(a, fan) * self.b_size + b[first + step])
            counts.append(np.ones(len(keys[0]), np.int64))
        else:  # groups of many tokens on both sides: distinct ids of each side, multiplied
            a_start = np.concatenate([[0], np.cumsum(ga)[:-1]])
            for g in range(len(ga)):
                ua, ca = np.unique(a[a_start[g] : a_start[g] + ga[g]], return_counts=True)
                ub, cb = np.unique(b[b_start[g] : b_start[g] + gb[g]], return_counts=True)
                keys.append((ua[:, None] * self.b_size + ub[None, :]).ravel())
                counts.append((ca[:, None] * cb[None, :]).ravel())
        keys_all, counts_all = np.concatenate(keys), np.concatenate(counts)
        distinct, where = np.unique(keys_all, return_inverse=True)
        return distinct, np.bincount(where, weights=counts_all, minlength=len(distinct)).astype(np.int64)


@cache
def tokenizers(path_a: str, path_b: str, ranks_a: str | None = None, pattern_a: str | None = None) -> Tokenizers:
    return Tokenizers(path_a, path_b, ranks_a, pattern_a)


def _aligned(path_a: str, path_b: str, ranks_a: str | None, pattern_a: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task is the unit of parallelism; threads only add CPU
        both = tokenizers(path_a, path_b, ranks_a, pattern_a)
        for batch in batches:
            rows, texts = batch["row"].tolist(), [t if isinstance(t, str) else "" for t in batch["text"]]
            for at in range(0, len(texts), CHUNK):  # encodings of few texts live at once
                chunk = texts[at : at + CHUNK]
                a_all = both.encode_a([" " + t for t in chunk])
                b_all = both.b.encode(chunk, num_threads=1)
                out = {"row": [], "n_a": [], "n_b": [], "n_groups": [], "n_links": [], "groups_sha256": [], "pair": [], "links": []}
                for row, text, ea, eb in zip(rows[at : at + CHUNK], chunk, a_all, b_all):
                    a, b, ga, gb, digest = both.align(text, ea, eb)
                    keys, counts = both.pairs(a, b, ga, gb)
                    for name, value in (("row", row), ("n_a", len(a)), ("n_b", len(b)), ("n_groups", len(ga)), ("n_links", int((ga * gb).sum())),
                                        ("groups_sha256", digest), ("pair", keys), ("links", counts)):
                        out[name].append(value)
                yield pd.DataFrame(out)

    return run


def aligned_documents(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", ranks_a: str | None = None, pattern_a: str | None = None
) -> DataFrame:
    """Per document row (every row, repeated ids included): id, n_a, n_b, n_groups, n_links, n_best, count_sum (long)
    and groups_sha256.

    A encodes space + text, B encodes text (adding its own space), neither adds or reads special tokens. Null or empty
    texts, and texts whose joined token bytes of A or B differ from space + text, have zeros and an empty digest.
    A pair's count is the number of document rows that link it; n_best counts links whose count is the highest of
    their A id corpus-wide (ties included); count_sum adds the counts of all links. Other columns do not take part.
    """
    spark = docs.sparkSession
    ship_package(spark)
    # Row numbers of a scan are the same in both reads below (they follow the input's splits), so texts are not copied.
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("row", F.monotonically_increasing_id())
    schema = "row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair array<long>, links array<long>"
    aligned = stored(rows.select("row", "text").mapInPandas(_aligned(path_a, path_b, ranks_a, pattern_a), schema), "align-docs")
    links = aligned.select("row", F.explode(F.arrays_zip("pair", "links")).alias("p")).select("row", "p.pair", "p.links")
    size = tokenizers(path_a, path_b, ranks_a, pattern_a).b_size
    counts = links.groupBy("pair").agg(F.count(F.lit(1)).alias("docs")).withColumn("a", F.floor(F.col("pair") / size))
    best = counts.groupBy("a").agg(F.max("docs").alias("top"))
    judged = stored(counts.join(best, "a").select("pair", "docs", (F.col("docs") == F.col("top")).alias("best")), "align-pairs")
    # one row per distinct linked pair: broadcast only below a measured size, else the links shuffle by pair
    small = judged.count() * PAIR_BYTES <= BROADCAST_BYTES
    per_doc = links.join(F.broadcast(judged) if small else judged, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).cast("long").alias("n_best"),
        F.sum(F.col("links") * F.col("docs")).cast("long").alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return rows.select("row", "id").join(aligned.drop("pair", "links"), "row").join(per_doc, "row", "left").select(
        F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
