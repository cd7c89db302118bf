import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

from carepanel.llm import contamination, language, line_templates, suffixes

from .conftest import prose


def brute_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def repeats():
    shared, other = prose(3, 60), prose(4, 45)
    texts = [prose(i, 80) for i in range(6)]
    texts += [f"{prose(20, 20)} {shared} {prose(21, 20)}", f"{prose(22, 9)} {shared}", f"{shared[:230]}é{shared[230:]}", f"{shared[5:240]} {other}{other}", "ab" * 400, "z" * 700, "ab" * 150]
    near = prose(5, 100).split(" ")
    return texts + [" ".join(near[:i] + ["changed"] + near[i:]) for i in range(0, 100, 9)] + [texts[0], None, "", "é" * 130, shared[:199]]


@pytest.mark.parametrize("length,lead", [(200, 64), (120, 50)])
def test_repeats_match_brute_force(make_docs, length, lead, monkeypatch):
    texts = repeats()
    found = suffixes.without_repeats(make_docs(list(enumerate(texts))), length).orderBy("doc_id").collect()
    got = [(r.n_bytes, sum(s["to"] - s["from"] for s in r.removed), len(r.removed), bytes(r.kept)) for r in found]
    assert got == brute_removed(texts, length)


def test_crowded_leading_names_give_the_same_spans(spark, make_docs, monkeypatch):
    texts = repeats()
    monkeypatch.setattr(suffixes, "MOST_STRETCHES", 2)
    found = suffixes.without_repeats(make_docs(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [(r.n_bytes, bytes(r.kept)) for r in found] == [(n, kept) for n, _, _, kept in brute_removed(texts, 200)]


def test_copies_of_a_text_are_compared_once(make_docs, monkeypatch):
    kept, plain = {}, suffixes.stored
    monkeypatch.setattr(suffixes, "stored", lambda df, label: kept.setdefault(label, plain(df, label)))
    near = prose(5, 100).split(" ")
    texts = [" ".join(near)] * 300 + [" ".join(near[:i] + ["changed"] + near[i:]) for i in (40, 60)] + ["q" + prose(6, 50)] * 50
    found = suffixes.without_repeats(make_docs(list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [(r.n_bytes, bytes(r.kept)) for r in found] == [(n, kept) for n, _, _, kept in brute_removed(texts, 200)]
    stretches = kept["stretches"].select("k1", "k2", "at")
    assert 0 < stretches.count() == stretches.distinct().count()


def test_stretches_do_not_depend_on_chunks(monkeypatch):
    data = np.frombuffer(("".join(repeats()[:6]) * 3).encode(), np.uint8)
    flat = lambda: {(int(n), a, a + s) for g, _, at, size in suffixes.anchored_stretches(data, 200, 64) for n, a, s in zip(g, at.tolist(), size.tolist(), strict=True)}
    windows = lambda found: {(n, w) for n, a, b in found for w in range(a, b - 199)}
    once = windows(flat())
    monkeypatch.setattr(suffixes, "CHUNK", 333)
    assert windows(flat()) == once and len(once) == len(data) - 199


def test_repeats_of_odd_tables(odd_docs, no_docs):
    rows = suffixes.without_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {bytes(r.kept) for r in rows if r.doc_id in (10, 50)} == {b""}
    assert suffixes.without_repeats(no_docs).count() == 0


LINES = [
    *(f"own {w} words\nUser name{i} logged in from host{i} at noon\nAll rights reserved." for i, w in enumerate("abcdefg")),
    *(f"job started by {w} on the main cluster today\n\n  All   rights reserved. \nx" for w in ("amy", "bob", "cyd", "dan", "eve", "fay")),
    "only here\nx\nx",
]


def test_recurring_templates_leave_all_but_the_first(make_docs):
    rows = line_templates.without_repeated_lines(make_docs(list(enumerate(LINES))), min_docs=5).orderBy("doc_id").collect()
    assert rows[0].text == LINES[0] and rows[0].n_dropped == 0
    assert all(r.text == f"own {'abcdefg'[r.doc_id]} words" for r in rows[1:7])
    assert rows[7].text == "job started by amy on the main cluster today\n\nx"
    assert all(r.text == "\nx" and (r.n_lines, r.n_dropped) == (4, 2) for r in rows[8:13])
    assert rows[13].text == LINES[13]


def test_copies_of_a_text_count_once(make_docs):
    text = "the same five words here\nand more of them there"
    rows = line_templates.without_repeated_lines(make_docs([(i, text) for i in range(40)])).collect()
    assert {(r.text, r.n_dropped) for r in rows} == {(text, 0)}


def test_lines_of_odd_tables(odd_docs, no_docs):
    rows = line_templates.without_repeated_lines(odd_docs).collect()
    assert Counter((r.doc_id, r.text, r.key) for r in rows) == Counter((r.doc_id, r.text, r.key) for r in odd_docs.collect())
    assert {r.n_lines for r in rows if r.text is None} == {0}
    assert rows[0].asDict().keys() == {*odd_docs.columns, "n_lines", "n_dropped"}
    assert line_templates.without_repeated_lines(no_docs).count() == 0


ITEM = "When Anna buys 3 kg of apples for Anna and her brother Tom while the shop sells every apple at 2 dollars apiece"
RENAMED = "When Maria buys 5 g of apples for Maria and her brother Ali while the shop sells every apple at 7 euros apiece"
MIXED = "When Maria buys 5 g of apples for Clara and her brother Ali while the shop sells every apple at 7 euros apiece"


def test_leaks_and_slots(spark, make_docs):
    other = "the quick machine of a far town was never used by people who came to see it on a cold day in winter"
    bench = spark.createDataFrame([(1, ITEM), (2, other), (3, None), (4, "too short"), (None, prose(9, 30)), (1, ITEM)], "item_id long, text string")
    halves = other.split()
    docs = make_docs(
        [(0, f"Well. {ITEM}. End."), (1, f"x {RENAMED}"), (2, MIXED), (3, prose(8, 200)), (4, None), (5, ""), (6, " ".join(halves[:13]) + " and then"), (7, " ".join(halves[:9])), (0, ITEM)]
        + [(20, prose(9, 30)), (None, f"so {ITEM}")]
    )
    found = Counter((r.doc_id, r.item_id) for r in contamination.leaked_documents(docs, bench).collect())
    assert found == {(0, 1): 2, (1, 1): 1, (6, 2): 1, (20, None): 1, (None, 1): 1}
    kept = contamination.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 7]


def test_leaks_with_renamed_starts_edits_and_short_items(spark, make_docs):
    tom = "Tom has 3 apples. Tom buys 5 more apples at the market."
    words = "the old harbour was rebuilt after a storm by people of a small town".split()[:13]
    bench = spark.createDataFrame([(1, tom), (2, ITEM), (3, " ".join(words)), (4, "Too short")], "item_id long, text string")
    docs = make_docs(
        [(0, "Ana has 4 apples. Ana buys 6 more apples at the market."), (1, "So Ana has 4 apples. Ana buys 4 more apples at the market."), (2, ITEM.lower()), (3, ITEM.replace("Anna and", "Eve and"))]
        + [(4, " ".join(words[:6] + ["big"] + words[6:])), (5, " ".join(words[:6] + words[7:])), (6, "It is. Too short. Yes"), (7, "far too short of breath"), (8, MIXED), (9, prose(8, 200))]
    )
    found = {(r.doc_id, r.item_id) for r in contamination.leaked_documents(docs, bench).collect()}
    assert found == {(0, 1), (1, 1), (2, 2), (3, 2), (4, 3), (5, 3), (6, 4)}


def test_leaks_of_odd_tables(odd_docs, no_docs, spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert contamination.leaked_documents(odd_docs, bench).count() == 0
    assert contamination.without_leaks(odd_docs, bench.limit(0)).count() == odd_docs.count()
    assert contamination.leaked_documents(no_docs, bench).count() == 0


def test_leaks_match_plain_containment(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    items = bench.collect()
    expected = {(d.doc_id, b.item_id) for d in docs.collect() for b in items if b.text in d.text}
    assert {(r.doc_id, r.item_id) for r in contamination.leaked_documents(docs, bench).collect()} == expected


def test_language_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = language.identify(docs).collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in truth}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_tables(odd_docs, no_docs):
    rows = language.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    said = {(r.doc_id, r.lang_pred) for r in rows if r.doc_id in (0, 1, 2, 4, 5, 7)}
    assert said == {(0, "und"), (1, "und"), (2, "und"), (4, "und"), (5, "und"), (7, "en")}
    assert language.identify(no_docs).count() == 0


def test_grams_of_long_texts_do_not_depend_on_chunks(monkeypatch):
    text = prose(3, 900) + " É, ñ! 12 ß"
    whole = language.gram_counts(text)
    monkeypatch.setattr(language, "CHUNK", 97)
    assert (language.gram_counts(text) == whole).all()
    assert language.gram_counts("1 2") is None


def test_the_temperature_flattens_overconfident_scores():
    draw = np.random.default_rng(1)
    labels = draw.integers(0, 3, 500)
    logits = 9.0 * np.eye(3)[np.where(draw.random(500) < 0.7, labels, (labels + 1) % 3)]
    assert language.best_temperature(logits, labels) > 2
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")
