import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from carepanel.llm import simhash
from carepanel.llm.components import components


def brute_fingerprint(text, n=3):
    words = [w for w in (text or "").encode().lower().replace(b"\x0b", b" ").split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def brute_roots(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "É b c d É b c", "a b c a b c a b c " * 9])
@pytest.mark.parametrize("n", [1, 3, 5])
def test_fingerprint(text, n):
    assert simhash.fingerprint(text, n) == brute_fingerprint(text, n)


@pytest.mark.parametrize("matches", range(2, 9))
def test_any_matching_positions_hold_a_posting_set(matches):
    chosen = simhash.position_sets(matches)
    assert all(any(set(c) <= set(m) for c in chosen) for m in combinations(range(8), matches))


@pytest.mark.parametrize("max_bits", [0, 1, 3, 6])
def test_links_connect_what_brute_force_connects(spark, max_bits):
    draw = random.Random(max_bits)
    prints = {draw.getrandbits(64) for _ in range(150)} | {0, 1, 7, 15, 2**64 - 1, 2**63}
    for p in list(prints)[:60]:  # dense balls and chains
        for _ in range(6):
            p ^= sum(1 << draw.randrange(64) for _ in range(draw.randrange(1, max(2, max_bits + 2))))
            prints.add(p % 2**64)
    signed = [int(np.array([p], np.uint64).view(np.int64)[0]) for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp long"), max_bits)
    found = {r.node: r.root for r in components(links).collect()}
    edges = [(a, b) for a, b in combinations(signed, 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= max_bits]
    expected = brute_roots(signed, edges)
    groups = lambda roots: sorted(sorted(n for n in signed if roots.get(n, n) == r) for r in {roots.get(n, n) for n in signed})
    assert groups(found) == groups(expected)


def test_bad_distances_are_refused(spark):
    for bits in (-1, 7):
        with pytest.raises(ValueError):
            simhash.fingerprint_links(spark.range(1).selectExpr("id as fp"), bits)


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(900, 950)] + [(5000, 5000), (None, 3)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(roots) == {*range(61), *range(900, 950), 1000}
    assert len({roots[i] for i in range(61)}) == 1
    assert len({roots[i] for i in [*range(900, 950), 1000]}) == 1
    assert len(set(roots.values())) == 2


def test_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    prints = {(r.doc_id, r.fingerprint): r.component_id for r in rows}
    blank = {i for (i, f) in prints if f == "0" * 16}
    assert {0, 1, 2, None} <= blank
    assert prints[(0, "0" * 16)] == 0 and prints[(2, "0" * 16)] == 0 and prints[(None, "0" * 16)] == 0
    assert {c for (i, f), c in prints.items() if i == 50} == {10}
    assert simhash.near_duplicates(no_docs).count() == 0
