"""Tokens of benchmark search: found in numpy as the pattern finds them, and read once by each task."""

import random

import pytest

from carepanel.llm import contamination

ODD = "aAbÉéß'’..,,!?\n 0123 5m kmKG%$€²¼ªµ_-٠中文ǅΣσςİiıẞⒶ𝐀̇\x00\t\xa0 L"


def told_kind(token: str) -> int:
    lowered = token.lower()
    if lowered in contamination.MARKED:
        return contamination.MARKED[lowered]
    if lowered == token:
        return contamination.NUMBER if token[0].isdigit() else contamination.LITERAL
    return contamination.NAME if token[0].isupper() and not token.isupper() else contamination.LITERAL


@pytest.mark.parametrize("part", [contamination.CUT_CHARS, 7])
def test_tokens_kinds_and_hashes_are_those_of_the_pattern(monkeypatch, part):
    monkeypatch.setattr(contamination, "CUT_CHARS", part)
    draw = random.Random(5)
    latin = [c for c in ODD if ord(c) < 256]
    texts = ["", "a'b'c'd'e f'g", "1.2,3.,4 5", "".join(map(chr, range(0x600))), " ".join(map(chr, range(0x600)))]
    texts += ["".join(draw.choices(alphabet, k=draw.randint(0, 40))) for alphabet in (ODD, latin) for _ in range(1500)]
    hash_of = {}
    for text in texts:
        held = f" {text} "
        starts, ends, kinds, hashes = contamination.cutter().cut_long(held)
        tokens = contamination.TOKEN.findall(text)
        assert [held[s:e] for s, e in zip(starts, ends, strict=True)] == tokens
        assert kinds.tolist() == [told_kind(t) for t in tokens]
        for token, h in zip(tokens, hashes.tolist(), strict=True):
            assert hash_of.setdefault(token.lower(), h) == h
    assert len(set(hash_of.values())) == len(hash_of)


def test_a_text_is_read_once_whatever_is_asked_of_its_windows(spark):
    docs = spark.createDataFrame([(1, "Tom has 3 red apples and 4 green pears in a basket.")], "doc_id long, text string")
    items = docs.select(docs.doc_id.alias("item_id"), "text")
    plan = contamination.find_contamination(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 2  # the windows and the verdict


def test_a_worker_keeps_no_table_of_the_tokens_it_has_met():
    cleared = []
    contamination.hold_table("another operator", lambda: cleared.append(1))
    contamination.Windows(["some words of a text", "and of another"], 5, 2, True)
    assert cleared == [1]
    assert not any(isinstance(v, dict) for v in vars(contamination.cutter()).values())
