"""Benchmark items in documents, re-parameterised ones too: template windows, a hash join and a slot check.

Numbers, names and units become typed placeholders. Windows of canonical tokens are joined by hash, words with a capital
read both ways (as they are, and as a name). What the placeholders stood for is compared along each run of windows, where
one value of the item must answer to one value of the document; runs on both sides of an edit are chained.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepanel.llm.shared import hold_table, ship_package, stored

#: Units that are a slot right after a number.
UNITS = frozenset(
    "mm cm m km in inch inches ft foot feet yd yard yards mile miles g mg kg lb lbs oz ton tons ml l liter liters litre litres "
    "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "mph hz khz mhz ghz v w kw j kj pa kpa c f k usd eur dollar dollars euro euros cent cents percent".split()
)

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?\n]|[0-9]+(?:[.,][0-9]+)*|[%$€]")
#: The same for texts of Latin-1 characters, whose letters are listed: several times as fast as the class of all letters.
LATIN = "".join(c for c in map(chr, range(256)) if re.match(r"[^\W\d_]", c))
LATIN_TOKEN = re.compile(TOKEN.pattern.replace(r"[^\W\d_]", f"[{LATIN}]"))
ENDERS = frozenset(".!?\n")
LITERAL, NUMBER, NAME, UNIT, ENDER = range(5)
MARKED = dict.fromkeys(UNITS | {"%", "$", "\u20ac"}, UNIT) | dict.fromkeys(ENDERS, ENDER)
BITMAP_BITS = 23
#: Characters cut at a time (more where no space follows), so that what is held per character stays small.
CUT_CHARS = 1 << 17
START = "^"  # marks a slot that starts a sentence
_HIT = "array<struct<h:long,pos:int,rank:int,slots:array<string>>>"


PLACEHOLDERS = np.array([0, *map(xxhash.xxh64_intdigest, ("<num>", "<name>", "<unit>"))], np.uint64)


def tokens_of(text: str) -> list[str]:
    """The tokens of a text, as ``Cutter`` finds them without making them."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return TOKEN.findall(text)
    return LATIN_TOKEN.findall(text)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Cutter:
    """Where the tokens of ``TOKEN`` lie in a text, their kinds, and hashes of them in lower case, without a string for any.

    Classes, case and hash value of a character are listed by code point, in blocks of 256 as the texts need them. A
    token's hash is the sum of its characters' values times powers of an odd number, from running sums.
    """

    OTHER, LETTER, DIGIT, SINGLE = range(4)
    CHANGES, UPPER, SMALL, DIGIT_LIKE = 1, 2, 4, 8
    #: Characters whose lower case takes two characters or depends on their neighbours.
    UNEVEN = (0x130, 0x3A3)
    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        points = 0x110000
        self.classes, self.cases, self.values = np.zeros(points, np.uint8), np.zeros(points, np.uint8), np.zeros(points, np.uint64)
        self.listed = np.zeros(points >> 8, bool)
        self.powers = self.inverses = np.zeros(0, np.uint64)
        self._list([0])
        self.latin_classes, self.latin_cases = self.classes[:256].tobytes(), self.cases[:256].tobytes()
        marked = sorted(MARKED)
        hashes = self._hash_strings(marked)
        order = np.argsort(hashes)
        self.marked, self.mark = hashes[order], np.array([MARKED[m] for m in marked], np.int8)[order]
        self.maybe_marked = np.zeros(1 << 16, bool)
        self.maybe_marked[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def _list(self, blocks: list[int]) -> None:
        for block in blocks:
            for code in range(block << 8, (block + 1) << 8):
                c = chr(code)
                lowered = c.lower()
                if c.isalnum() and not c.isdecimal():
                    self.classes[code] = self.LETTER
                elif "0" <= c <= "9":
                    self.classes[code] = self.DIGIT
                elif c in MARKED:
                    self.classes[code] = self.SINGLE
                self.values[code] = ord(lowered) + 1 if len(lowered) == 1 else code + 1
                if self.classes[code]:
                    self.cases[code] = self.CHANGES * (lowered != c) | self.UPPER * c.isupper() | self.SMALL * (c.islower() or c.istitle() and not c.isupper()) | self.DIGIT_LIKE * c.isdigit()
            part = slice(block << 8, (block + 1) << 8)
            self.values[part] = _mixed(_mixed(self.values[part] * np.uint64(self.BASE)))
            self.listed[block] = True

    def _hashes(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(points)
        if n > len(self.powers):
            size = max(n, CUT_CHARS + (CUT_CHARS >> 3))
            self.powers, self.inverses = (np.cumprod(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)]) for b in (self.BASE, pow(self.BASE, -1, 1 << 64)))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[points] * self.powers[:n], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.inverses[starts]
        if n > CUT_CHARS * 8:  # a text without a space
            self.powers = self.inverses = np.zeros(0, np.uint64)
        return _mixed(found + (ends - starts).astype(np.uint64))

    def _hash_strings(self, strings: list[str]) -> np.ndarray:
        points = np.frombuffer("".join(strings).encode("utf-32-le"), "<u4")
        self._list_new(points)
        ends = np.cumsum(list(map(len, strings)))
        return self._hashes(points, np.r_[0, ends[:-1]], ends)

    def _list_new(self, points: np.ndarray) -> None:
        blocks = np.unique(points >> 8)
        self._list(blocks[~self.listed[blocks]].tolist())

    def cut(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends, kinds (of units and literals by themselves) and hashes of the tokens of a text that begins and ends with a space."""
        try:
            raw = text.encode("latin-1")
            points = np.frombuffer(raw, np.uint8)
            classes, cases = np.frombuffer(bytearray(raw.translate(self.latin_classes)), np.uint8), np.frombuffer(raw.translate(self.latin_cases), np.uint8)
            uneven = None
        except UnicodeEncodeError:
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            self._list_new(points)
            classes, cases = self.classes[points], self.cases[points]
            uneven = np.flatnonzero((points == self.UNEVEN[0]) | (points == self.UNEVEN[1]))
        at = np.flatnonzero((points == ord(".")) | (points == ord(",")))
        at = at[(classes[at - 1] == self.DIGIT) & (classes[at + 1] == self.DIGIT)]
        classes[at] = self.DIGIT
        at = np.flatnonzero(points == ord("'"))
        at = at[(classes[at - 1] == self.LETTER) & (classes[at + 1] == self.LETTER)]
        if len(at) > 1:  # of apostrophes with only letters between them every second one joins
            follows = np.r_[False, np.add.reduceat(classes != self.LETTER, at, dtype=np.int64)[:-1] == 1]
            nth = np.arange(len(at))
            at = at[(nth - np.maximum.accumulate(np.where(follows, 0, nth))) % 2 == 0]
        classes[at] = self.LETTER
        change, inside, alone = classes[1:] != classes[:-1], classes != self.OTHER, classes == self.SINGLE
        starts = np.flatnonzero((change | alone[1:]) & inside[1:]) + 1
        ends = np.flatnonzero((change | alone[:-1]) & inside[:-1]) + 1
        if not len(starts):
            return starts, ends, np.zeros(0, np.int8), np.zeros(0, np.uint64)
        hashes = self._hashes(points, starts, ends)
        if uneven is not None and len(uneven):
            which = np.unique(np.searchsorted(starts, uneven, "right") - 1)
            hashes[which] = self._hash_strings([text[s:e].lower() for s, e in zip(starts[which].tolist(), ends[which].tolist(), strict=True)])
        first, case = cases[starts], np.bitwise_or.reduceat(cases, starts)
        changes = case & self.CHANGES != 0
        kinds = np.where(~changes & (first & self.DIGIT_LIKE != 0), np.int8(NUMBER), np.int8(LITERAL))
        kinds[changes & (first & self.UPPER != 0) & (case & self.SMALL != 0)] = NAME
        maybe = np.flatnonzero(self.maybe_marked[(hashes & np.uint64(0xFFFF)).view(np.int64)])
        place = np.minimum(np.searchsorted(self.marked, hashes[maybe]), len(self.marked) - 1)
        known = self.marked[place] == hashes[maybe]
        kinds[maybe[known]] = self.mark[place[known]]
        return starts, ends, kinds, hashes

    def cut_long(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same in parts that begin and end with a space."""
        parts, at = [], 0
        while True:
            end = text.find(" ", at + CUT_CHARS, -1)
            starts, ends, kinds, hashes = self.cut(text[at : end + 1 if end >= 0 else len(text)])
            parts.append((starts + at, ends + at, kinds, hashes))
            if end < 0:
                return tuple(map(np.concatenate, zip(*parts, strict=True)))
            at = end


@cache
def cutter() -> Cutter:
    return Cutter()


class Windows:
    """The template windows of some texts.

    A word with a capital is read both as a word and as a name, so a window has a hash for each reading; a unit counts as
    one right after a number only. Windows tell something if ``literals`` of their words are no slot: of an item those
    that are no name in mid-sentence, of a document (``loose``) all words. Texts of fewer than ``size`` words, and
    sentences of documents that may be one, are windows of their own (``whole``).
    """

    def __init__(self, texts: list[str], size: int, literals: int, loose: bool):
        hold_table("templates", lambda: None)
        self.size, self.joined = size, " ".join(["", *texts, ""])
        starts, ends, kinds, hashes = cutter().cut_long(self.joined)
        begins = np.searchsorted(starts, np.cumsum([1, *(len(t) + 1 for t in texts)]))
        text = np.repeat(np.arange(len(texts)), np.diff(begins))
        before = np.r_[ENDER, kinds[:-1]][: len(kinds)]
        before[np.r_[True, text[1:] != text[:-1]][: len(text)]] = ENDER
        after = np.r_[kinds[1:], ENDER][: len(kinds)]
        after[np.r_[text[1:] != text[:-1], True][: len(text)]] = ENDER
        kinds = np.where((kinds == UNIT) & (before != NUMBER), LITERAL, kinds)
        words = np.flatnonzero(kinds != ENDER)
        self.opens, self.closes = before[words] == ENDER, after[words] == ENDER
        self.kinds, self.text, self.hashes = kinds[words], text[words], hashes[words]
        self.starts, self.ends = starts[words], ends[words]
        first = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.length = np.diff(first)
        self.position = np.arange(len(self.text)) - first[self.text]
        count = max(0, len(self.kinds) - size + 1)
        name = self.kinds == NAME
        literal = ((self.kinds == LITERAL) | (name if loose else name & self.opens)).astype(np.int64)
        plain, flags = np.zeros(count, np.int64), np.zeros(count, np.int64)
        for k in range(size):
            plain += literal[k : k + count]
            flags |= name[k : k + count].astype(np.int64) << k
        inside = self.text[:count] == self.text[size - 1 : size - 1 + count]
        self.telling = np.flatnonzero((plain >= literals) & inside)
        self.flags = flags[self.telling]

    def readings(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places and hashes of the telling windows, for one choice of names at a time."""
        codes = np.where((self.kinds == LITERAL) | (self.kinds == NAME), self.hashes, PLACEHOLDERS[self.kinds])
        masks = {0}
        for flags in np.unique(self.flags).tolist():
            mask = flags
            while mask:
                masks.add(mask)
                mask = (mask - 1) & flags
        named = np.flatnonzero(self.flags)  # few windows hold a name
        flags, places = self.flags[named], self.telling[named]
        for mask in sorted(masks):
            at = places[(flags & mask) == mask] if mask else self.telling
            yield at, self._hash(at, [PLACEHOLDERS[NAME] if mask >> k & 1 else codes[at + k] for k in range(self.size)])

    def whole(self, width: int, entire: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of strings of ``width`` words between sentence ends (``entire``: that are a whole text)."""
        at = np.flatnonzero(self.opens[: max(0, len(self.kinds) - width + 1)])
        at = at[self.closes[at + width - 1] & (self.text[at] == self.text[at + width - 1])]
        if entire:
            at = at[self.length[self.text[at]] == width]
        return at, self._hash(at, [np.uint64(width), *(self.hashes[at + k] for k in range(width))])

    @staticmethod
    def _hash(at: np.ndarray, codes: list) -> np.ndarray:
        window = np.zeros(len(at), np.uint64)
        for code in codes:
            window = window * np.uint64(0x9E3779B97F4A7C15) + code
        window ^= window >> np.uint64(29)
        window *= np.uint64(0xBF58476D1CE4E5B9)
        return window ^ (window >> np.uint64(32))

    def slots(self, at: int) -> list[str]:
        """What the placeholders of a window stand for, empty for other words."""
        mark = lambda i: START if self.kinds[i] == NAME and self.opens[i] else ""
        return ["" if self.kinds[i] == LITERAL else mark(i) + self.joined[self.starts[i] : self.ends[i]].lower() for i in range(at, min(at + self.size, len(self.kinds)))]


def _groups(texts: pa.Array, size: int = 1 << 20) -> Iterator[list[str]]:
    """Some texts at a time, about ``size`` characters."""
    held, chars = [], 0
    for text in texts:
        held.append(text.as_py() or "")
        chars += len(held[-1])
        if chars >= size:
            yield held
            held, chars = [], 0
    if held:
        yield held


def _windows(table: DataFrame, text_col: str, size: int, literals: int, bitmap: np.ndarray | None, widths: list[int], into: str) -> DataFrame:
    """Rows with ``into``: the telling windows (those in the bitmap, if one is given) with the values of their slots."""
    ship_package(table.sparkSession)

    @F.arrow_udf(_HIT)
    def windows(texts: pa.Array) -> pa.Array:
        out = []
        marked = None if bitmap is None else np.unpackbits(bitmap.astype("<u8").view(np.uint8), bitorder="little").view(bool)
        for group in _groups(texts):
            found = Windows(group, size, literals, bitmap is not None)
            hits = [[] for _ in group]
            rank = dict(zip(found.telling.tolist(), (np.arange(len(found.telling)) - np.searchsorted(found.text[found.telling], found.text[found.telling])).tolist(), strict=True)) if bitmap is None else {}
            for at, hashes in chain(found.readings(), (found.whole(w, bitmap is None) for w in widths)):
                if bitmap is not None and len(at):
                    passed = marked[hashes.view(np.int64) & ((1 << BITMAP_BITS) - 1)]
                    at, hashes = at[passed], hashes[passed]
                for i, h, text, pos in zip(at.tolist(), hashes.view(np.int64).tolist(), found.text[at].tolist(), found.position[at].tolist(), strict=True):
                    hits[text].append({"h": h, "pos": pos, "rank": rank.get(i, 0), "slots": found.slots(i)})
            out += hits
        return pa.array(out, pa.list_(pa.struct([("h", pa.int64()), ("pos", pa.int32()), ("rank", pa.int32()), ("slots", pa.list_(pa.string()))])))

    # not to be run once more by a filter on what it returns
    return table.withColumn(into, windows.asNondeterministic()(F.col(text_col)))


def window_bitmap(windows: DataFrame) -> np.ndarray:
    """One bit per hash value modulo 2^BITMAP_BITS: 1 MiB whatever the number of windows."""
    slot = F.col("h").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    words = windows.select(F.shiftright(slot, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"))
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    for word, bits in words.groupBy("word").agg(F.bit_or("bit")).collect():  # as many rows as words at most
        bitmap[word] = np.uint64(bits & 0xFFFFFFFFFFFFFFFF)
    return bitmap


def _answers(pairs: Iterator[tuple[list[str], list[str]]]) -> dict[str, str] | None:
    """Document value of every item value, None if a value has two."""
    out: dict[str, str] = {}
    for a, b in pairs:
        for x, y in zip(a, b, strict=False):
            if x and out.setdefault(x.lstrip(START), (y or x).lstrip(START)) != (y or x).lstrip(START):
                return None
    return out


def _same_slots(a: list[str], b: list[str], starts_only: bool) -> bool:
    return all(x.lstrip(START) == (y or x).lstrip(START) for x, y in zip(a, b, strict=False) if x and (x[0] == START or y[:1] == START or not starts_only))


def _runs(windows: list, size: int) -> Iterator[list]:
    run: list = []
    for w in windows:
        if run and w[0] > run[-1][0] + size:
            yield run
            run = []
        run.append(w)
    if run:
        yield run


def _segments(windows: list, size: int, tries: int = 0) -> Iterator[tuple[list, dict, bool]]:
    """Runs with consistent slots; of other runs the windows with equal sentence starts, then the verbatim ones."""
    for run in _runs(windows, size):
        answers = _answers((a, b) for _, _, a, b in run)
        verbatim = all(_same_slots(a, b, False) for _, _, a, b in run)
        if answers is not None or verbatim:
            yield run, answers or {}, verbatim
        elif tries < 2:
            yield from _segments([w for w in run if _same_slots(w[2], w[3], tries == 0)], size, tries + 1)


def best_alignment(hits: list[dict], n_windows: int, size: int) -> tuple[float, int]:
    """Largest share of the item's windows and longest run of its words along a chain of segments.

    A segment may follow another one in item and document whose shift differs by ``size`` words at most, unless their
    slots contradict each other. If words were only put in or only left out between them, the run goes on and the
    windows over that edit count.
    """
    shifts: dict[int, dict[int, tuple]] = {}
    for h in hits:
        shifts.setdefault(h["pos"] - h["item_pos"], {})[h["item_pos"]] = (h["item_pos"], h["rank"], h["item_slots"], h["slots"])
    segments = []
    for shift, windows in shifts.items():
        for run, answers, verbatim in _segments([windows[i] for i in sorted(windows)], size):
            segments.append((run[-1][0] + size, shift, run[0][0], [w[1] for w in run], answers, verbatim))
    segments.sort(key=lambda s: (s[0], s[0] + s[1]))
    chained: dict[int, list] = {}
    most, longest = 0, 0
    for end, shift, begin, ranks, answers, verbatim in segments:
        best = (len(ranks), end - begin, begin, answers)
        for other in range(shift - size, shift + size + 1):
            for end0, begin0, last0, held0, run0, open0, answers0, verbatim0 in chained.get(other, ()):
                if not (end0 < end and begin0 < begin and end0 + other < end + shift and begin0 + other < begin + shift):
                    continue
                if not (verbatim or verbatim0) and any(answers0.get(x, y) != y for x, y in answers.items()):
                    continue
                fresh = [r for r in ranks if r > last0]
                held, opened = held0 + len(fresh), begin
                missing, added = max(0, begin - end0), max(0, begin + shift - end0 - other)
                if other != shift and min(missing, added) == 0 and fresh:
                    held, opened = held + fresh[0] - last0 - 1, open0
                best = max(best, (held, max(run0, end - opened), opened, answers0 | answers), key=lambda b: b[:2])
        held, run, opened, all_answers = best
        chained.setdefault(shift, []).append((end, begin, ranks[-1], held, run, opened, all_answers, verbatim))
        most, longest = max(most, held), max(longest, run)
    return min(1.0, most / n_windows), longest


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    size: int = 5,
    literals: int = 2,
    least_share: float = 0.8,
    least_run: int = 13,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``key`` (MD5 of a document's text) and item of every leak, with the share of the item's windows and the longest run.

    An alignment of document and item is a leak if it holds ``least_share`` of the item's telling windows, or a run of
    ``least_run`` words, in runs that are verbatim or have consistent slots (see ``best_alignment``). Documents are scanned once against a bitmap of fixed size;
    only windows that pass it are joined with the item windows by hash, so neither side is ever broadcast whole.

    An item shorter than ``size`` words matches where it stands word for word between sentence ends. Null and empty texts,
    and longer items without a telling window (slots only), match nothing. Copies of a text are judged once. Items that repeat count once per distinct id and text; a null item id is an id.
    """
    items = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("item_text")).where("item_text is not null").distinct()
    listed = _windows(items, "item_text", size, literals, None, list(range(1, size)), "w").where(F.size("w") > 0)
    listed = listed.withColumn("n_windows", F.array_max("w.rank") + 1).withColumn("width", F.size(F.col("w")[0]["slots"]))
    asked = listed.select("item_id", F.md5("item_text").alias("item_key"), "n_windows", "width", F.explode("w").alias("w"))
    asked = stored(asked.select("item_id", "item_key", "n_windows", "width", "w.h", "w.rank", F.col("w.pos").alias("item_pos"), F.col("w.slots").alias("item_slots")), "items")
    bitmap = window_bitmap(asked)
    widths = [r.width for r in asked.where(F.col("width") < size).select("width").distinct().collect()]  # fewer than size

    scanned = _windows(docs.select(F.col(text_col).cast("string").alias("doc_text")), "doc_text", size, literals, bitmap, widths, "w")
    hits = scanned.where(F.size("w") > 0).select(F.md5("doc_text").alias("key"), F.explode("w").alias("w"))
    hits = hits.select("key", "w.h", "w.pos", "w.slots").distinct()
    of_item = ["item_pos", "pos", "rank", "item_slots", "slots"]
    aligned = hits.join(asked, "h").groupBy("key", "item_id", "item_key", "n_windows", "width").agg(F.collect_set(F.struct(*of_item)).alias("hits"))  # bounded by item and text
    found = pa.struct([("share", pa.float64()), ("run", pa.int32())])

    @F.arrow_udf("struct<share:double,run:int>")
    def judge(hits: pa.Array, n_windows: pa.Array, width: pa.Array) -> pa.Array:
        out = (best_alignment(h.as_py(), n.as_py(), w.as_py()) for h, n, w in zip(hits, n_windows, width, strict=True))
        return pa.array([{"share": share, "run": run} for share, run in out], found)

    judged = aligned.select("key", "item_id", "item_key", judge.asNondeterministic()("hits", "n_windows", "width").alias("j")).select("key", "item_id", "item_key", "j.share", "j.run")
    leaks = judged.where((F.col("share") >= least_share) | (F.col("run") >= least_run))
    return leaks.groupBy("key", "item_id", "item_key").agg(F.max("share").alias("share"), F.max("run").alias("run"))


def leaked_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **choices) -> DataFrame:
    """A row per leak: document id, item_id, ``share`` of the item's windows, longest ``run`` of tokens.

    Documents without a leak have no row; rows that repeat an id or text all have theirs; null ids stay null.
    """
    found = stored(find_contamination(docs, benchmark, text_col=text_col, **choices), "leaks")
    rows = docs.select(F.col(id_col), F.md5(F.col(text_col).cast("string")).alias("key"))
    return rows.join(found, "key").select(id_col, "item_id", F.round("share", 6).alias("share"), "run")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **choices) -> DataFrame:
    """The rows whose text holds no benchmark item, with their columns; null texts stay."""
    found = stored(find_contamination(docs, benchmark, text_col=text_col, **choices).select("key").distinct(), "leaks")
    row = docs.select(F.struct(*docs.columns).alias("_row"), F.md5(F.col(text_col).cast("string")).alias("key"))
    return row.join(found, "key", "left_anti").select("_row.*")
