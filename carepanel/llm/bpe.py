"""Byte-pair encoding and decoding in batched numpy merge rounds."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carepanel.llm.shared import ship_package
from carepanel.llm.words import CUT_PROBE, PIECES, PLAIN, WordTokens, byte_level


class MergeTables:
    """The vocabulary and merges of a tokenizer file as arrays.

    Pair keys (left id * vocabulary size + right id) are sorted; a pair's rank and the id it makes lie beside its key.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("a plain byte-pair model is needed")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in told["added_tokens"]}
        if any(re.search(r"\s", t) for t in self.added) or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in told["added_tokens"]):
            raise ValueError("added tokens that reach over white space are not supported")
        names = {i: t for t, i in (self.vocab | self.added).items()}
        self.size = max(names) + 1
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right, made = (np.array([self.vocab[f(m)] for m in merges]) for f in (lambda m: m[0], lambda m: m[1], lambda m: m[0] + m[1]))
        rank_of = np.full(self.size, -1)
        rank_of[made] = np.arange(len(merges))
        if len(np.unique(made)) != len(made) or (np.maximum(rank_of[left], rank_of[right]) >= np.arange(len(merges))).any():
            raise ValueError("a merge may only use what earlier merges have made")
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], order, made[order]
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        raw = [names.get(i, "").encode() + b" " for i in range(self.size)]
        self.token_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.token_ends = np.r_[0, np.cumsum(list(map(len, raw)))]

    def merge(self, ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apply all merges to many words whose symbols lie in one flat array; returns flat ids and lengths.

        A round looks every adjacent pair up by binary search, finds the lowest rank of each word and merges the
        leftmost non-overlapping occurrences of that pair. Words without a known pair are finished and leave.
        """
        done_ids, done_word = [], []
        word = np.repeat(np.arange(len(lengths)), lengths)
        none = np.iinfo(np.int64).max
        while len(ids):
            rank = np.full(len(ids), none)
            inner = np.flatnonzero(word[1:] == word[:-1])
            if len(self.keys) and len(inner):
                key = ids[inner] * self.size + ids[inner + 1]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                known = self.keys[at] == key
                rank[inner[known]] = self.ranks[at[known]]
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            size = np.diff(np.r_[starts, len(ids)])
            least = np.repeat(np.minimum.reduceat(rank, starts), size)
            live = least != none
            if not live.all():
                done_ids.append(ids[~live])
                done_word.append(word[~live])
                ids, word, rank, least = ids[live], word[live], rank[live], least[live]
            hit = np.flatnonzero(rank == least)
            if not len(hit):
                continue
            # in a run of adjacent hits (a pair of equal symbols) every second one overlaps
            run = np.cumsum(np.r_[True, np.diff(hit) != 1]) - 1
            first = np.flatnonzero(np.r_[True, np.diff(run) != 0])
            hit = hit[(np.arange(len(hit)) - first[run]) % 2 == 0]
            ids[hit] = self.made[np.searchsorted(self.keys, ids[hit] * self.size + ids[hit + 1])]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            ids, word = ids[keep], word[keep]
        if not done_ids:
            return ids, lengths
        ids, word = np.concatenate(done_ids), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=len(lengths))

    def join(self, ids: np.ndarray) -> bytes:
        """The tokens' strings, each followed by a space."""
        start = self.token_ends[ids]
        length = self.token_ends[ids + 1] - start
        done = np.cumsum(length)
        where = np.arange(done[-1] if len(done) else 0) + np.repeat(start - done + length, length)
        return self.token_bytes[where].tobytes()


class Encoder:
    """Words to ids. Normalising and cutting into pieces follow the tokenizer file, the merging is ``MergeTables.merge``.

    A piece that an earlier word had is not merged again (the table of pieces is cleared as that of words is).
    """

    def __init__(self, path: str):
        self.tables = MergeTables(path)
        self.rules = Tokenizer.from_file(path)
        self.words = WordTokens(self.tokenize)
        self.pieces = WordTokens(self._merged)  # a piece is byte-level text, or the id of an added token
        told = [p for p, _ in self.rules.pre_tokenizer.pre_tokenize_str(self.rules.normalizer.normalize_str(CUT_PROBE))]
        self.cut_known = told == [byte_level(p) for w in CUT_PROBE.split() for p in PIECES.findall(w.lower())]

    def _pieces(self, word: str) -> list[str]:
        text = self.rules.normalizer.normalize_str(word)
        return [piece for piece, _ in self.rules.pre_tokenizer.pre_tokenize_str(text)]

    def _parts(self, word: str) -> list[str | int]:
        added, out = self.tables.added, []
        for part in filter(None, self.tables.added_pattern.split(word) if self.tables.added_pattern else [word]):
            out += [added[part]] if part in added else self._pieces(part)
        return out

    def _merged(self, pieces: list[str | int]) -> tuple[np.ndarray, np.ndarray]:
        vocab, suffix = self.tables.vocab, self.tables.suffix
        symbols: list[int] = []
        lengths = np.zeros(len(pieces), np.int64)
        for n, piece in enumerate(pieces):
            new = [piece] if isinstance(piece, int) else [*map(vocab.__getitem__, piece[:-1]), vocab[piece[-1] + suffix]]
            symbols += new
            lengths[n] = len(new)
        return self.tables.merge(np.array(symbols, np.int64), lengths)

    def tokenize(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces: list[str | int] = []
        ends = []
        plain, cut = PLAIN.fullmatch if self.cut_known else lambda word: None, PIECES.findall
        for word in words:
            if "<" in word or not plain(word):
                pieces += self._parts(word)
            elif word.isascii():
                pieces += cut(word.lower())
            else:
                pieces += map(byte_level, cut(word.lower()))
            ends.append(len(pieces))
        sizes = np.diff(np.array(ends, np.int64), prepend=0)
        return self.pieces.ids(pieces, sizes)


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _whole(parts: Iterator[tuple[np.ndarray, bool]]) -> Iterator[bytes]:
    held = []
    for ids, ends in parts:
        held.append(ids.astype("<u4").tobytes())
        if ends:
            yield b"".join(held)
            held = []


def with_ids(docs: DataFrame, path: str, text_col: str = "text", into: str = "ids") -> DataFrame:
    """Every row with ``into``: the ids of its whole text as little-endian unsigned 32-bit integers; all columns stay.

    Ids are those of the tokenizer file without special tokens added around the text, unused truncation and padding.
    Null and empty texts have no ids (an empty value). Long texts are encoded in pieces that end at white space.
    """
    ship_package(docs.sparkSession)

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        return pa.array(_whole(encoder(path).words.texts(t.as_py() or "" for t in texts)), pa.binary())

    return docs.withColumn(into, encoded(F.col(text_col).cast("string")))


def with_decoded(docs: DataFrame, path: str, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """Every row with ``into``: its ids as text, tokens joined by spaces as the tokenizer file decodes without skipping.

    Null or empty ids give the empty text; an id that the vocabulary lacks is left out.
    """
    ship_package(docs.sparkSession)

    @F.arrow_udf("string")
    def decoded(values: pa.Array) -> pa.Array:
        tables = encoder(path).tables
        known = np.diff(tables.token_ends) > 1
        out = []
        for value in values:
            ids = np.frombuffer(value.as_py() or b"", "<u4").astype(np.int64)
            ids = ids[ids < tables.size]
            out.append(tables.join(ids[known[ids]])[:-1])
        return pa.array(out, pa.binary()).cast(pa.string())

    return docs.withColumn(into, decoded(F.col(ids_col)))


def _digests_of(parts: Iterator[tuple[np.ndarray, bool]], tables: MergeTables) -> Iterator[tuple[int, str, str]]:
    """(n_tokens, ids_sha256, decoded_sha256) per text, updated part by part: no text's ids or decoded text are held."""
    known = np.diff(tables.token_ends) > 1
    count, ids_hash, text_hash, pending = 0, hashlib.sha256(), hashlib.sha256(), b""
    for ids, ends in parts:
        count += len(ids)
        ids_hash.update(ids.astype("<u4").tobytes())
        wide = ids.astype(np.int64)
        wide = wide[wide < tables.size]
        joined = tables.join(wide[known[wide]]) if len(wide) else b""
        if joined:  # every token is followed by a space; the text's last one is dropped
            text_hash.update(pending + joined[:-1])
            pending = joined[-1:]
        if ends:
            yield count, ids_hash.hexdigest(), text_hash.hexdigest()
            count, ids_hash, text_hash, pending = 0, hashlib.sha256(), hashlib.sha256(), b""


def encoded_digests(docs: DataFrame, path: str, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 and decoded_sha256, as ``digests(with_decoded(with_ids(...)))`` gives them,
    in one pass of one Python worker that returns only the three values (null and empty texts: no ids)."""
    ship_package(docs.sparkSession)
    kind = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"

    @F.arrow_udf(kind)
    def digested(texts: pa.Array) -> pa.Array:
        coder = encoder(path)
        rows = list(_digests_of(coder.words.texts(t.as_py() or "" for t in texts), coder.tables))
        return pa.array([{"n_tokens": n, "ids_sha256": i, "decoded_sha256": d} for n, i, d in rows], pa.struct(
            [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        ))

    return docs.select(id_col, digested(F.col(text_col).cast("string")).alias("d")).select(id_col, "d.*")


def digests(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256."""
    return encoded.select(
        id_col,
        F.floor(F.octet_length(ids_col) / 4).alias("n_tokens"),
        F.sha2(F.col(ids_col), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded_col).cast("binary"), 256).alias("decoded_sha256"),
    )
