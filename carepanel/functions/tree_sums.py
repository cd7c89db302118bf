"""What tasks do for boosted trees (``operators.boosting``): bin rows, place them in trees, sum up per bin. Numpy only, as
every Python worker loads it."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

#: Codes of one bundle of columns. A column with more bins has a bundle of its own.
MOST_CODES = 2048
#: Distinct values kept per column in the summary that thresholds come from; more are merged into neighbours.
MOST_VALUES = 10_000

#: A weighted summary of a column: sorted values and their weights.
Summary = tuple[np.ndarray, np.ndarray]


@dataclass
class Layout:
    """The columns of one set: bins each, thresholds of numbers, and how they are packed into bundles.

    Column ``c`` is digit ``code // stride[c] % dims[c]`` of bundle ``bundle[c]``. A categorical column's last bin holds
    the levels that training has not seen.
    """

    thresholds: list[np.ndarray]
    levels: list[int]
    dims: list[int] = field(default_factory=list)
    bundle: list[int] = field(default_factory=list)
    stride: list[int] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)

    def __post_init__(self) -> None:
        self.dims = [len(t) + 1 for t in self.thresholds] + [n + 1 for n in self.levels]
        self.bundle, self.stride = [0] * len(self.dims), [0] * len(self.dims)
        for c in sorted(range(len(self.dims)), key=lambda c: -self.dims[c]):
            b = next((b for b, size in enumerate(self.sizes) if size * self.dims[c] <= MOST_CODES), len(self.sizes))
            if b == len(self.sizes):
                self.sizes.append(1)
            self.bundle[c], self.stride[c] = b, self.sizes[b]
            self.sizes[b] *= self.dims[c]

    @property
    def slots(self) -> int:
        return len(self.thresholds) + sum(self.levels)

    def encode(self, columns: list[np.ndarray]) -> np.ndarray:
        """A row of codes per bundle."""
        codes = np.zeros((len(self.sizes), len(columns[0])), np.int64)
        for c, values in enumerate(columns):
            if c < len(self.thresholds):
                digit = np.searchsorted(self.thresholds[c], values)
            else:
                digit = np.clip(values.astype(np.int64), 0, self.dims[c] - 1)
            codes[self.bundle[c]] += digit * self.stride[c]
        return codes.astype(np.uint16 if max(self.sizes) <= 1 << 16 else np.uint32)


@dataclass
class Split:
    """Column ``column``'s bins above ``at`` go right (numbers), or the rows with level ``at`` or all others do."""

    column: int
    at: int
    slot: int
    numeric: bool
    level_goes_right: bool = True


@dataclass
class Part:
    """The rows of one set in one partition: codes, kinds (a kind names a label and a weight), margins, what the round's
    tree fits, who takes part in it, and the sums per leaf of the round before."""

    of: int
    at: int
    codes: np.ndarray
    kind: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    margin: np.ndarray
    target: np.ndarray
    drawn: np.ndarray
    ended: np.ndarray | None = None


def packed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Rows (set, ``width`` columns, label, weight) as pickled blocks of numpy columns, a block per batch and set."""
    for batch in batches:
        of, *columns = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(width + 3))
        for k in np.unique(of):
            here = of == k
            block = (int(k), [c[here] for c in columns[:width]], columns[width][here], columns[width + 1][here])
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, protocol=5)], pa.binary())], ["block"])


def thinned(values: np.ndarray, weights: np.ndarray, most: int = MOST_VALUES) -> Summary:
    """Sorted distinct values with their weights added up; beyond ``most`` runs of equal weight keep their last value."""
    values, place = np.unique(values, return_inverse=True)
    weights = np.bincount(place, weights, len(values))
    if len(values) <= most:
        return values, weights
    run = np.minimum((np.cumsum(weights) - weights) / weights.sum() * most, most - 1).astype(np.int64)
    last = np.flatnonzero(np.append(run[1:] != run[:-1], True))
    return values[last], np.bincount(run, weights)[run[last]]


def summary(blocks: Iterator[tuple], numbers: int) -> Iterator[dict]:
    """Per set: rows, weight, labels seen and a summary per numeric column."""
    found: dict[int, dict] = {}
    for k, columns, label, weight in blocks:
        one = {"n": len(label), "weight": float(weight.sum()), "least": float(weight.min()), "labels": set(np.unique(label).tolist())}
        one["columns"] = [thinned(c, weight) for c in columns[:numbers]]
        found = merged(found, {k: one})
    yield found


def merged(a: dict, b: dict) -> dict:
    for k, y in b.items():
        x = a.get(k)
        if x is None:
            a[k] = y
            continue
        columns = [thinned(np.concatenate([u[0], v[0]]), np.concatenate([u[1], v[1]])) for u, v in zip(x["columns"], y["columns"], strict=True)]
        a[k] = {"n": x["n"] + y["n"], "weight": x["weight"] + y["weight"], "least": min(x["least"], y["least"]), "labels": x["labels"] | y["labels"], "columns": columns}
    return a


def dealt(source: int, blocks: Iterator[tuple], layouts: dict[int, Layout], parts: int) -> Iterator[tuple]:
    """Encoded slices of the blocks, dealt over the partitions so that each gets its share of every set."""
    slices = min(parts, 8)
    for seq, (k, columns, label, weight) in enumerate(blocks):
        codes = layouts[k].encode(columns)
        for i in range(slices):
            rows = slice(len(label) * i // slices, len(label) * (i + 1) // slices)
            to = (source + seq * slices + i) % parts
            yield to, (k, source, seq, i, np.ascontiguousarray(codes[:, rows]), label[rows], weight[rows])


def gathered(at: int, dealt: Iterator[tuple], seed: int, share: float) -> Iterator[Part]:
    by_set: dict[int, list] = {}
    for _, piece in dealt:
        by_set.setdefault(piece[0], []).append(piece)
    for k in sorted(by_set):
        pieces = sorted(by_set[k], key=lambda p: p[1:4])  # slices arrive in any order
        label, weight = (np.concatenate([p[i] for p in pieces]) for i in (5, 6))
        label = np.where(label == 1, 1.0, -1.0)
        kinds, kind = np.unique(label + 1j * weight, return_inverse=True)
        small = kind.astype(np.uint8 if len(kinds) <= 256 else np.uint32)
        codes = np.concatenate([p[4] for p in pieces], axis=1)
        yield Part(k, at, codes, small, kinds.real.copy(), kinds.imag.copy(), np.zeros(len(label)), label, _drawn(seed, 0, k, at, len(label), share))


def _goes_right(layout: Layout, split: Split) -> np.ndarray:
    """Per code of the split's bundle, whether it goes right."""
    digit = np.arange(layout.sizes[layout.bundle[split.column]]) // layout.stride[split.column] % layout.dims[split.column]
    if split.numeric:
        return digit > split.at
    return (digit == split.at) == split.level_goes_right


def places(part: Part, layout: Layout, tree: list[list[Split | None]]) -> np.ndarray:
    """Where the rows stand below the given levels of splits; nodes that do not split pass their rows on to the left."""
    n = part.codes.shape[1]
    place = np.zeros(n, np.int64)
    flat, each = part.codes.ravel(), np.arange(n)
    for splits in tree:
        tables = [(layout.bundle[s.column], _goes_right(layout, s)) if s else (0, np.zeros(1, bool)) for s in splits]
        if len(splits) == 1:
            b, right = tables[0]
            place = right[part.codes[b]].astype(np.int64) if splits[0] else place
            continue
        wide = max(layout.sizes)
        table = np.zeros((len(splits), wide), bool)
        for j, (_, right) in enumerate(tables):
            table[j, : len(right)] = right
        start = np.array([b for b, _ in tables], np.int64) * n
        at = start[place]
        at += each
        code = flat[at]
        np.multiply(place, wide, out=at)
        at += code
        right = table.ravel()[at]
        place *= 2
        place += right
    return place


def _drawn(seed: int, turn: int, of: int, at: int, n: int, share: float) -> np.ndarray:
    """Who takes part in a round's tree; the same for every run of a task."""
    if share >= 1.0:
        return np.ones(n, bool)
    return np.random.Generator(np.random.SFC64([seed, turn, of, at])).random(n, np.float32) < share


def leaf_sums(part: Part, place: np.ndarray, places: int) -> np.ndarray:
    """Per place below the last level: rows, weight, weighted sum and sum of squares of the target."""
    weight = part.weights[part.kind] * part.drawn
    fit = weight * part.target
    rows = np.bincount(place[part.drawn], minlength=places)
    return np.stack([rows, *(np.bincount(place, x, places) for x in (weight, fit, fit * part.target))], axis=1)


def grown(part: Part, layout: Layout, tree: list, values: np.ndarray, turn: int, seed: int, share: float, step: float) -> Part:
    """The rows for the round after ``turn``: margins moved by the tree's leaves, the negative gradient as target, rows
    drawn, and the sums of the tree's leaves."""
    place = places(part, layout, tree)
    margin = part.margin + step * values[place]
    target = 2.0 * (part.labels[part.kind] - np.tanh(margin))
    drawn = _drawn(seed, turn + 1, part.of, part.at, len(margin), share)
    return Part(part.of, part.at, part.codes, part.kind, part.labels, part.weights, margin, target, drawn, leaf_sums(part, place, len(values)))


def level_sums(parts: Iterator[Part], layouts: dict, trees: dict, active: dict) -> Iterator[dict]:
    """Per set: sums per active node and bin (weight, weighted target), and those of the leaves of the round before."""
    found: dict[int, tuple] = {}
    for part in parts:
        layout, tree, nodes = layouts[part.of], trees[part.of], active[part.of]
        if not len(nodes):
            continue
        weight = part.weights[part.kind]
        weight *= part.drawn
        fit = part.target * weight
        many, last = 2 ** len(tree), len(nodes)
        place = places(part, layout, tree) if many > 1 else None
        if many > last:  # the rows of nodes that are leaves already have a seat of their own
            seat = np.full(many, last, np.int64)
            seat[nodes] = np.arange(last)
            place = seat[place]
        bins = np.zeros((last, 2, sum(layout.dims)))
        start = np.concatenate([[0], np.cumsum(layout.dims)])
        idx = np.empty(len(fit), np.int64)
        for b, size in enumerate(layout.sizes):
            if many > 1:
                np.multiply(place, size, out=idx)
                idx += part.codes[b]
            else:
                idx[:] = part.codes[b]
            joint = np.stack([np.bincount(idx, x, (last + 1) * size)[: last * size].reshape(last, size) for x in (weight, fit)], axis=1)
            for c, d in enumerate(layout.dims):
                if layout.bundle[c] == b:
                    lo = layout.stride[c]
                    bins[:, :, start[c] : start[c] + d] = joint.reshape(last, 2, size // (lo * d), d, lo).sum(axis=(2, 4))
        found[part.of] = added(found.get(part.of), (bins, part.ended))
    yield found


def ended_sums(parts: Iterator[Part], layouts: dict, trees: dict, places_of: dict) -> Iterator[dict]:
    """Per set the sums of the leaves of the last round."""
    found: dict[int, tuple] = {}
    for part in parts:
        place = places(part, layouts[part.of], trees[part.of])
        found[part.of] = added(found.get(part.of), (None, leaf_sums(part, place, places_of[part.of])))
    yield found


def added(a: tuple | None, b: tuple) -> tuple:
    return b if a is None else tuple(None if x is None else x + y for x, y in zip(a, b, strict=True))


def added_up(a: dict, b: dict) -> dict:
    return {k: added(a.get(k), b[k]) if k in b else a[k] for k in a.keys() | b.keys()}
