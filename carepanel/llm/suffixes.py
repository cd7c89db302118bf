"""Removal of repeated byte strings: a sparse suffix array that Spark sorts.

Every window of ``length`` bytes has an anchor: the start of its least ``lead`` bytes by hash. Equal windows have
equal anchors at equal offsets, so only the suffixes at anchors need sorting, about one for each 70 bytes. A suffix carries the stretch of
text whose windows share the anchor.

1. Suffixes are range-partitioned, by splitters that Spark samples, on the name (hash) of their leading bytes and of their
   stretch, and sorted locally. Equal neighbours are stretches that occur twice. Stretches that share only their
   leading bytes, and those at a bucket's boundaries, go on to the next step.
2. These few are compared window by window on their bytes: per leading name a multikey sort over 8-byte words, equal
   neighbours again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.llm.shared import ship_package, stored

CHUNK = 1 << 22
POSITION_BITS = 24  # holds a position inside a chunk
MULTIPLIER = 0x9E3779B97F4A7C15
SECOND = 0xC2B2AE3D27D4EB4F
MOST_STRETCHES = 20_000
_SUFFIX = "lead long, stretch long, k1 long, k2 long, at int, size int, tie int"


@cache
def _powers(multiplier: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for m in (multiplier, pow(multiplier, -1, 1 << 64)):
        p = np.full(count, m, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _prefix(data: np.ndarray, multiplier: int) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    powers = _powers(multiplier, 1 << int(max(len(data), 1 << 16)).bit_length())[0]
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return sums


def _names(sums: np.ndarray, start: np.ndarray, end: np.ndarray, multiplier: int) -> np.ndarray:
    """Hashes of the strings from start to end, from prefix sums."""
    back = _powers(multiplier, 1 << int(max(len(sums) - 1, 1 << 16)).bit_length())[1]
    h = (sums[end] - sums[start]) * back[start]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def anchored_stretches(data: np.ndarray, length: int, lead: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Names of the leading bytes and of the stretch, start and size, for every maximal run of windows with one anchor."""
    for base in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[base : base + CHUNK + length - 1]
        sums = _prefix(part, MULTIPLIER)
        grams = np.arange(len(part) - lead + 1)
        name = _names(sums, grams, grams + lead, MULTIPLIER)
        key = (name >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)) | grams.astype(np.uint64)
        width = length - lead + 1
        rows = -(-len(key) // width)
        padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(key)] = key
        table = padded.reshape(rows, width)
        upto = np.minimum.accumulate(table, axis=1).ravel()
        since = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
        count = len(key) - width + 1
        anchor = (np.minimum(since[:count], upto[width - 1 : len(key)]) & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
        start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        end = np.r_[start[1:], count] - 1 + length
        yield name[anchor[start]], _names(sums, start, end, MULTIPLIER), start + base, end - start


def _suffixes(batches: Iterator[pa.RecordBatch], length: int, lead: int) -> Iterator[pa.RecordBatch]:
    tie = 0
    for batch in batches:
        for k1, k2, text in zip(*(batch.column(i) for i in range(3)), strict=True):
            data = np.frombuffer(text.as_py().encode("utf-8"), np.uint8)
            for name, stretch, start, size in anchored_stretches(data, length, lead):
                n = len(name)
                tie += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), pa.array(stretch.view(np.int64)), *(pa.array(np.full(n, k.as_py(), np.int64)) for k in (k1, k2)),
                     *(pa.array(x.astype(np.int32)) for x in (start, size, np.full(n, tie)))],
                    ["lead", "stretch", "k1", "k2", "at", "size", "tie"],
                )


def _pooled(batches: Iterator[pa.RecordBatch], rows: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Few large batches instead of one for each text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a sorted bucket: the stretches that occur twice, and those to be compared by bytes (``open``)."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    name, stretch, k1, k2, at = (table.column(c).to_numpy() for c in ("lead", "stretch", "k1", "k2", "at"))
    size = len(name)
    same_lead = name[1:] == name[:-1]
    same = same_lead & (stretch[1:] == stretch[:-1])
    twice = np.r_[False, same] | np.r_[same, False]
    begins = np.r_[True, ~same]
    first = np.flatnonzero(begins)
    last = np.r_[first[1:], size] - 1
    # a kind of stretch is compared by bytes if its leading name has another one, or reaches the bucket's boundary
    has_other = np.r_[False, same_lead][first] | np.r_[same_lead, False][last]
    has_other[[0, -1]] = True
    compare = np.zeros(size, bool)
    compare[first[has_other]] = True
    place = (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1]) & (at[1:] == at[:-1])
    again = np.r_[False, same & place]  # the same stretch of a copy of the same text
    for flag, rows in ((False, np.flatnonzero(twice & ~again)), (True, np.flatnonzero(compare))):
        if len(rows):
            picked = table.select(["lead", "k1", "k2", "at", "size"]).take(pa.array(rows))
            yield from picked.append_column("open", pa.array(np.full(len(rows), flag))).combine_chunks().to_batches()


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the stretches of each text."""
    for batch in batches:
        for k1, k2, text, list_of in zip(*(batch.column(i) for i in range(4)), strict=True):
            data = text.as_py().encode("utf-8")
            rows = [{"lead": s["lead"], "many": s["many"], "k1": k1.as_py(), "k2": k2.as_py(), "at": s["at"], "bytes": data[s["at"] : s["at"] + s["size"]]} for s in list_of.as_py()]
            yield pa.RecordBatch.from_pylist(rows, _CUT)


_CUT = pa.schema([("lead", pa.int64()), ("many", pa.bool_()), ("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int32()), ("bytes", pa.binary())])


def equal_windows(data: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows at ``start`` equal another one of their group: multikey sort over big-endian 8-byte words.

    Each round sorts the windows that still tie by their next word; ties that are left after the last word are equal.
    """
    padded = np.r_[data, np.zeros(8, np.uint8)]
    order = np.argsort(group, kind="stable")
    run = group[order]
    words = [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]
    for offset in words:
        edge = np.r_[True, run[1:] != run[:-1]]
        alone = edge & np.r_[edge[1:], True]
        order, run = order[~alone], run[~alone]
        if not len(order):
            break
        at = start[order] + offset
        word = np.zeros(len(at), np.uint64)
        for k in range(8):
            word = (word << np.uint64(8)) | padded[at + k]
        by = np.lexsort((word, run))
        order, run, word = order[by], run[by], word[by]
        run = np.cumsum(np.r_[False, (run[1:] != run[:-1]) | (word[1:] != word[:-1])])
    equal = np.zeros(len(start), bool)
    if len(order):
        edge = np.r_[True, run[1:] != run[:-1]]
        equal[order[~(edge & np.r_[edge[1:], True])]] = True
    return equal


def _windows_of(table: pa.Table, length: int):
    """All bytes of some stretches one after the other, and per window its start there, its row and its place in the text."""
    sizes = np.array([len(b) for b in table.column("bytes").to_pylist()])
    data = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    count = sizes - length + 1
    row = np.repeat(np.arange(len(sizes)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return data, begin[row] + inside, row, inside


def _compare(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated windows of whole groups of one leading name, as merged spans; batches are sorted by that name."""

    def spans(table: pa.Table) -> pa.RecordBatch:
        data, start, row, inside = _windows_of(table, length)
        equal = equal_windows(data, start, table.column("lead").to_numpy()[row], length)
        row, inside = row[equal], inside[equal]
        opens = np.r_[True, (row[1:] != row[:-1]) | (inside[1:] != inside[:-1] + 1)] if len(row) else np.zeros(0, bool)
        first = np.flatnonzero(opens)
        last = np.r_[first[1:], len(row)][: len(first)] - 1
        at = table.column("at").to_numpy()[row[first]]
        columns = [pa.array(table.column(k).to_numpy()[row[first]]) for k in ("k1", "k2")]
        columns += [pa.array((at + inside[first]).astype(np.int32)), pa.array((at + inside[last] + length).astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["k1", "k2", "from", "to"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            name = batch.column(0).to_numpy()
            if held and held[-1].column(0)[-1].as_py() != name[0] and sum(b.num_rows for b in held) >= 2000:
                yield spans(pa.Table.from_batches(held))
                held = []
            # up to the end of the first group that makes the held rows enough
            want = max(1, 2000 - sum(b.num_rows for b in held))
            cut = len(name) if want >= len(name) else int(np.searchsorted(name, name[want - 1], "right"))
            held.append(batch.slice(0, cut))
            batch = batch.slice(cut)
    if held:
        yield spans(pa.Table.from_batches(held))


def _window_names(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        data, start, row, inside = _windows_of(table, length)
        names = [_names(_prefix(data, m), start, start + length, m).view(np.int64) for m in (MULTIPLIER, SECOND)]
        columns = [*names, *(table.column(k).to_numpy()[row] for k in ("k1", "k2")), (table.column("at").to_numpy()[row] + inside).astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["n1", "n2", "k1", "k2", "from"])


def repeated_spans(texts: DataFrame, length: int = 200, lead: int = 64) -> DataFrame:
    """k1, k2, from, to: byte spans of texts (columns k1, k2, text) that are covered by strings that start elsewhere too."""
    ship_package(texts.sparkSession)
    long_enough = texts.where(F.octet_length("text") >= length).select("k1", "k2", "text")
    suffixes = long_enough.mapInArrow(lambda b: _pooled(_suffixes(b, length, lead)), _SUFFIX)
    order = ["lead", "stretch", "k1", "k2", "at", "tie"]
    sorted_suffixes = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    found = stored(sorted_suffixes.mapInArrow(_neighbours, "lead long, k1 long, k2 long, at int, size int, open boolean"), "suffixes")
    whole = found.where("not open").select("k1", "k2", F.col("at").alias("from"), (F.col("at") + F.col("size")).alias("to"))
    # copies of a text are repeated whole, so that what is compared below holds every text once
    copied = long_enough.select("k1", "k2", F.octet_length("text").alias("size")).groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max("size").alias("to"))
    copied = copied.where("n > 1").select("k1", "k2", F.lit(0).alias("from"), "to")
    once = long_enough.groupBy("k1", "k2").agg(F.first("text").alias("text"))  # combines before the shuffle

    # leading names with very many kinds of stretches are compared by window names that combine before the shuffle
    crowded = found.where("open").groupBy("lead").count().where(F.col("count") > MOST_STRETCHES).select("lead", F.lit(True).alias("many"))
    wanted = found.where("open").join(crowded, "lead", "left").withColumn("many", F.coalesce("many", F.lit(False)))
    wanted = wanted.groupBy("k1", "k2").agg(F.collect_set(F.struct("lead", "many", "at", "size")).alias("list_of"))  # bounded by the text
    cut = once.join(wanted, ["k1", "k2"]).mapInArrow(lambda b: _cut(b, length), "lead long, many boolean, k1 long, k2 long, at int, bytes binary")
    cut = stored(cut, "stretches")
    compared = cut.where("not many").repartition("lead").sortWithinPartitions("lead").mapInArrow(lambda b: _compare(b, length), "k1 long, k2 long, from int, to int")
    named = cut.where("many").mapInArrow(lambda b: _window_names(b, length), "n1 long, n2 long, k1 long, k2 long, from int")
    often = named.groupBy("n1", "n2").count().where("count > 1").select("n1", "n2")
    by_name = named.join(often, ["n1", "n2"]).select("k1", "k2", "from", (F.col("from") + length).alias("to"))
    return whole.union(copied).union(compared).union(by_name)


def without_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_bytes``, ``removed`` (array of from, to: the maximal removed runs) and ``kept`` (the other bytes).

    A byte of a text's UTF-8 form is removed if a string of ``length`` bytes that covers it also starts anywhere else,
    in the same text or another one; strings are judged on the input and never reach over two texts. Null counts as the
    empty text; texts shorter than ``length`` keep everything. What is kept need not be valid UTF-8. Copies of a text
    are places of their own, so all of them lose everything. Null and repeated ids are kept. An empty table gives no
    rows. Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2"), text.alias("text"))
    spans = repeated_spans(rows, length).groupBy("k1", "k2").agg(F.collect_set(F.struct("from", "to")).alias("spans"))  # bounded by the text
    joined = rows.join(spans, ["k1", "k2"], "left")
    result = pa.struct([("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))), ("kept", pa.binary())])

    @F.arrow_udf("struct<n_bytes:long,removed:array<struct<from:int,to:int>>,kept:binary>")
    def taken_out(texts: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, each in zip(texts, found, strict=True):
            data, removed = text.as_py().encode("utf-8"), []
            for a, b in sorted((s["from"], s["to"]) for s in each.as_py() or []):
                if removed and a <= removed[-1][1]:
                    removed[-1][1] = max(b, removed[-1][1])
                else:
                    removed.append([a, b])
            ends = [0, *(x for span in removed for x in span), len(data)]
            kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
            out.append({"n_bytes": len(data), "removed": [{"from": a, "to": b} for a, b in removed], "kept": kept})
        return pa.array(out, result)

    return joined.select(F.col("id").alias(id_col), taken_out("text", "spans").alias("r")).select(id_col, "r.n_bytes", "r.removed", "r.kept")
