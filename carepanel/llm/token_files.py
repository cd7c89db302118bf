"""Token ids of a corpus as flat binary files that can be memory-mapped.

A file set is a folder. Part n holds three files: ``part-n.ids`` (the ids of its documents one after the other, unsigned,
little-endian, 16 bits if the vocabulary fits, else 32), ``part-n.starts`` (64-bit offsets of its documents and of its
end, counted in ids from the part's begin) and ``part-n.docs`` (64-bit document ids). Parts follow each other in
ascending document id. The manifest, a small Parquet table, names each part's documents, ids and bases: the prefix
sums that turn local offsets into global ones.
"""

from __future__ import annotations

import contextlib
import os
import re
import uuid
from collections.abc import Iterator
from functools import cache
from pathlib import Path
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from carepanel.llm.shared import shared_folder, ship_package
from carepanel.llm.words import CUT_PROBE, PIECES, PLAIN, WordTokens, byte_level

MOST_WORDS, MOST_PIECES = 700_000, 600_000
NULL_ID = np.iinfo(np.int64).min  # stands for a missing document id, and sorts first as nulls do


class LibraryWords:
    """Words to ids by the tokenizers library; a piece of a word that was met before is not tokenised again."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.words = WordTokens(self.tokenize, MOST_WORDS)
        self.pieces: dict[str, list[int]] = {}
        told = [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(CUT_PROBE))]
        self.cut_known = told == [byte_level(p) for w in CUT_PROBE.split() for p in PIECES.findall(w.lower())]

    def _ids(self, word: str) -> list[int]:
        if "<|" in word or not self.cut_known or not PLAIN.fullmatch(word):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        ids: list[int] = []
        for piece in PIECES.findall(word.lower()):
            if (known := self.pieces.get(piece)) is None:
                known = self.pieces[piece] = [t.id for t in self.tokenizer.model.tokenize(byte_level(piece))]
            ids += known
        return ids

    def tokenize(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.pieces) > MOST_PIECES:
            self.pieces.clear()
        found = [self._ids(w) for w in words]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for f in found for i in f), np.int32, int(lengths.sum())), lengths


@cache
def _library(path: str) -> LibraryWords:
    return LibraryWords(path)


def local_path(folder: str) -> Path:
    """The mounted path of a folder URI; files that are memory-mapped need one on every executor."""
    told = urlparse(folder)
    if told.scheme not in ("", "file"):
        raise ValueError(f"{folder} is not a mounted folder, and its files could not be memory-mapped")
    return Path(unquote(told.path))


def _in_place(path: Path):
    """A new file beside its final place."""
    return open(path.with_name(f"{path.name}.{uuid.uuid4().hex}"), "xb")


def _finish(file, path: Path) -> None:
    file.close()
    os.replace(file.name, path)  # a second attempt of a task replaces whole files by the same content


def write_token_files(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode all texts, write the file set into ``folder`` (a new one) and return its manifest.

    Documents lie in ascending id; ``end_id`` is appended to each (None: nothing). Null and empty texts have the end
    id alone. A null document id comes first and is stored as the smallest 64-bit integer. Rows that repeat an id are
    all written, in any order among themselves; they are spread over parts like others. An empty table gives a file set
    without parts. Other columns are ignored. Texts are encoded whole, in pieces that end at white space.
    """
    spark = docs.sparkSession
    ship_package(spark)
    root = local_path(folder)
    root.mkdir(parents=True, exist_ok=False)
    kind = "<u2" if max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), (end_id or 0) + 1) <= 1 << 16 else "<u4"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        doc_ids: list[int] = []

        def texts():
            for batch in batches:
                doc_ids.extend(NULL_ID if i is None else i for i in batch.column(0).to_pylist())
                for text in batch.column(1):
                    yield text.as_py() or ""

        paths = [root / f"part-{part:06d}.{x}" for x in ("ids", "starts", "docs")]
        with contextlib.ExitStack() as stack:
            ids_file, starts_file, docs_file = (stack.enter_context(_in_place(p)) for p in paths)
            at, starts = 0, [0]
            for ids, ends in _library(tokenizer_path).words.texts(texts()):
                if ends and end_id is not None:
                    ids = np.r_[ids, end_id]
                ids_file.write(ids.astype(kind).tobytes())
                at += len(ids)
                if ends:
                    starts.append(at)
            starts_file.write(np.array(starts, "<i8").tobytes())
            docs_file.write(np.array(doc_ids, "<i8").tobytes())
            files = (ids_file, starts_file, docs_file)
            if doc_ids:
                for file, path in zip(files, paths, strict=True):
                    _finish(file, path)
            else:
                for file in files:
                    os.unlink(file.name)
        if doc_ids:
            yield pa.RecordBatch.from_pylist([{"part": part, "n_docs": len(doc_ids), "n_ids": at, "kind": kind}], pa.schema([("part", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("kind", pa.string())]))

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    totals = ordered.select("id", "text").mapInArrow(write, "part int, n_docs long, n_ids long, kind string")
    # one row per part, gathered once so that the encoding runs once; prefix sums over them give the bases
    gathered = spark.createDataFrame(totals.toArrow())
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = [F.coalesce(F.sum(f"n_{x}").over(earlier), F.lit(0)).alias(f"{x}_base") for x in ("docs", "ids")]
    gathered.select("*", *bases).coalesce(1).write.parquet(f"{root.as_uri()}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per part: part, n_docs, n_ids, kind, docs_base, ids_base."""
    schema = "part int, n_docs long, n_ids long, kind string, docs_base long, ids_base long"
    return spark.read.schema(schema).parquet(f"{local_path(folder).as_uri()}/manifest")


def read_token_files(spark: SparkSession, folder: str, view) -> DataFrame:
    """Apply ``view`` to every document of a file set, on memory-mapped ids.

    ``view`` takes a one-dimensional unsigned array and returns a long. Result: doc_id, start (global offset in ids), n_tokens, value.
    """
    ship_package(spark)
    root = local_path(folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                path = root / f"part-{row['part']:06d}"
                starts, doc_ids = (np.fromfile(path.with_suffix(x), "<i8") for x in (".starts", ".docs"))
                # a part of empty documents without end ids has nothing to map
                ids = np.memmap(path.with_suffix(".ids"), row["kind"], "r") if row["n_ids"] else np.zeros(0, row["kind"])
                for a in range(0, len(doc_ids), 10_000):
                    b = min(a + 10_000, len(doc_ids))
                    values = [view(ids[starts[i] : starts[i + 1]]) for i in range(a, b)]
                    missing = doc_ids[a:b] == NULL_ID
                    columns = [pa.array(doc_ids[a:b], mask=missing), pa.array(starts[a:b] + row["ids_base"]), pa.array(np.diff(starts[a : b + 1])), pa.array(values, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "value"])

    manifest = read_manifest(spark, folder)
    parts = manifest.repartition(max(1, spark.sparkContext.defaultParallelism * 2), "part")
    return parts.mapInArrow(read, "doc_id long, start long, n_tokens long, value long")


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
