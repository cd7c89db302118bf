"""SimHash near-duplicates through an inverted index on the fingerprints' byte positions."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.llm.components import components
from carepanel.llm.shared import ship_package, stored

BYTES = 8
CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """64-bit SimHash of a whole text.

    A-Z are lower-cased, words are runs of other bytes than ASCII white space, each run of ``shingle_words`` words is
    hashed with XXH64 (seed 42), repeats included; fewer words count as one shingle, none give 0. A bit is set if
    it is set in over half of the hashes.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    parts = map(b" ".join, zip(*(words[i : i + n] if n > 1 else words[i : i + 1] for i in range(min(shingle_words, len(words)))), strict=True))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(42)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int, id_col: str, text_col: str) -> DataFrame:
    """``id`` and ``fp``, the fingerprint as a long with the same 64 bits."""
    ship_package(docs.sparkSession)

    @F.arrow_udf("long")
    def signed(texts: pa.Array) -> pa.Array:
        made = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in texts), np.uint64, len(texts))
        return pa.array(made.view(np.int64))

    return docs.select(F.col(id_col).alias("id"), signed(F.col(text_col).cast("string")).alias("fp"))


def position_sets(matches: int) -> list[tuple[int, ...]]:
    """Sets of ``matches - 1`` byte positions such that any ``matches`` positions hold at least one of them.

    Greedy cover. For 5 matches these are the 14 blocks of a Steiner system: any 5 positions hold exactly one.
    """
    size = max(1, matches - 1)
    open_sets = {frozenset(c) for c in combinations(range(BYTES), matches)}
    chosen: list[tuple[int, ...]] = []
    while open_sets:
        best = max(combinations(range(BYTES), size), key=lambda c: sum(s.issuperset(c) for s in open_sets))
        chosen.append(best)
        open_sets = {s for s in open_sets if not s.issuperset(best)}
    return chosen


def _bucket_links(key: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """For rows sorted by posting key: each fingerprint with the representative of those it is linked to in its bucket.

    Compares rows at distance 1, 2, ... within the buckets; a pair is verified if the tally of shared positional bytes
    reaches the minimum. Links are merged as they are found, so what comes out is a star per component and bucket.
    """
    size = len(fp)
    label = np.arange(size)
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    ends = np.repeat(np.r_[starts[1:], size], np.diff(np.r_[starts, size]))
    octets = fp.view(np.uint8).reshape(-1, BYTES)
    left, step = np.arange(size), 1
    while len(left := left[left + step < ends[left]]):
        right = left + step
        fresh = label[left] != label[right]
        a, b = left[fresh], right[fresh]
        tally = (octets[a] == octets[b]).sum(axis=1)
        near = tally >= BYTES - max_bits
        a, b = a[near], b[near]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        _merge(label, a[near], b[near])
        step += 1
    linked = label != np.arange(size)
    return fp[linked], fp[label[linked]]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def _links_of_partition(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    last = None

    def linked():
        key, fp = (np.concatenate(x) for x in zip(*kept, strict=True))
        a, b = _bucket_links(key, fp.view(np.uint64), max_bits)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        key, fp = (np.ascontiguousarray(batch.column(i).to_numpy()) for i in (0, 1))
        if not len(key):
            continue
        cut = int(np.searchsorted(key, key[-1]))  # the last bucket may go on in the next batch
        if kept and (cut or key[-1] != last):
            kept.append((key[:cut], fp[:cut]))
            yield linked()
            kept = [(key[cut:], fp[cut:])]
        elif cut:
            kept = [(key[:cut], fp[:cut])]
            yield linked()
            kept = [(key[cut:], fp[cut:])]
        else:
            kept.append((key, fp))
        last = key[-1]
    if kept:
        yield linked()


def fingerprint_links(distinct_fp: DataFrame, max_bits: int) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints (column ``fp``) at ``max_bits`` or fewer differing bits.

    At most max_bits of the 8 positional bytes differ, so such a pair shares at least 8 - max_bits of them. Posting
    lists of single bytes would grow with the square of the table; instead a fingerprint is posted under its bytes
    at each of a few position sets that together hold a set of any such pair, so its lists are intersections
    already. Inside a list the shared bytes are tallied, pairs with the minimum verified, and a star per component
    comes out: at most one link per posting, however dense a list is.
    """
    need = BYTES - max_bits
    if max_bits < 0 or need < 2:
        raise ValueError("max_bits must lie between 0 and 6")
    byte = lambda i: F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255))
    octets = F.array(*(byte(i) for i in range(BYTES)))
    # the key has the set's number in the high byte; sets of more than 7 positions do not occur
    keys = [
        sum((F.shiftleft(F.col("o")[p], 8 * k) for k, p in enumerate(positions)), F.shiftleft(F.lit(n).cast("long"), 56))
        for n, positions in enumerate(position_sets(need))
    ]
    postings = distinct_fp.select("fp", octets.alias("o")).select(F.explode(F.array(*keys)).alias("key"), "fp")
    ordered = postings.repartition("key").sortWithinPartitions("key", "fp")
    return ordered.mapInArrow(lambda batches: _links_of_partition(batches, max_bits), "a long, b long").distinct()


def fingerprint_roots(distinct_fp: DataFrame, max_bits: int) -> DataFrame:
    """``fp``, ``root``: the component of every distinct fingerprint."""
    roots = components(fingerprint_links(distinct_fp, max_bits)).withColumnRenamed("node", "fp")
    return distinct_fp.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's id, ``fingerprint`` (16 hex digits) and ``component_id`` (the smallest id reachable, its own included).

    Rows are linked if their fingerprints differ in ``max_bits`` bits or fewer; copies share a fingerprint and are
    never paired. Null, empty and blank texts have fingerprint zero, linked like any other. A row with a null id is
    kept; its component_id is null only if the whole component has no id. Rows that repeat an id are all kept. An
    empty table gives no rows. Other columns are ignored.
    """
    prints = stored(fingerprints(docs, shingle_words, id_col, text_col), "prints")
    smallest = stored(prints.groupBy("fp").agg(F.min("id").alias("least_id")), "classes")
    roots = components(fingerprint_links(smallest.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    rooted = smallest.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    members = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(members, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
