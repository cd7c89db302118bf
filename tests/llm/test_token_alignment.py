import hashlib
from collections import Counter

import public_tokenizers

from carepanel.llm import queries, token_alignment

from .conftest import ODD_TEXTS, prose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    both = token_alignment.tokenizers(A, B)
    per_doc = []
    for text in texts:
        if not text:
            per_doc.append(None)
            continue
        a = both.a.encode(" " + text, add_special_tokens=False).ids
        b = both.b.encode(text)
        data = (" " + text).encode()
        if b"".join(both.a_bytes[i] for i in a) != data or b"".join(both.b_bytes[i] for i in b) != data:
            per_doc.append(None)
            continue
        ends_a, ends_b, pos = [], [], 0
        for i in a:
            pos += len(both.a_bytes[i])
            ends_a.append(pos)
        pos = 0
        for i in b:
            pos += len(both.b_bytes[i])
            ends_b.append(pos)
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, prev = [], 0
        for cut in cuts:
            groups.append(([i for i, e in zip(a, ends_a) if prev < e <= cut], [i for i, e in zip(b, ends_b) if prev < e <= cut]))
            prev = cut
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        per_doc.append((a, b, groups, links))
    count = Counter()
    for d in per_doc:
        if d:
            count.update(set(d[3]))
    top = {}
    for (x, _), n in count.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for d in per_doc:
        if not d:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = d
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append((len(a), len(b), len(groups), len(links), sum(count[p] == top[p[0]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest()))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
TEXTS = [t for t in ODD_TEXTS] + [
    "Hello world, hello world!", "hello  world\n\nnew   line", "café naïve 日本語 text", "<s> </s> <unk> <|endoftext|>",
    "Hello world, hello world!", "", "x" * 3000, prose(3, 300), "  leading spaces", "trailing  ", "ab" * 500 + " end",
]


def test_matches_brute_force_with_odd_texts(spark, make_docs):
    docs = make_docs(list(enumerate(TEXTS)) + [(None, "Hello world"), (3, "Hello world")])
    found = {r.doc_id if r.doc_id is not None else -1: r for r in token_alignment.aligned_documents(docs, A, B).collect()}
    assert len(found) == len(TEXTS) + 1  # the repeated id 3 collapses in this dict only
    expected = brute(TEXTS + ["Hello world", "Hello world"])
    for i, text in enumerate(TEXTS):
        if i != 3:
            assert tuple(getattr(found[i], c) for c in COLUMNS) == expected[i], text
    assert tuple(getattr(found[-1], c) for c in COLUMNS) == expected[len(TEXTS)]
    assert found[0].groups_sha256 == "" and found[0].n_a == 0


def test_windows_give_the_whole_document_alignment():
    both = token_alignment.tokenizers(A, B)
    text = prose(7, 2000) + " Hello, world. Über 12.5% naïve"
    a, b, ga, gb, digest = both.align(text, both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text))
    assert ga.sum() == len(a) and gb.sum() == len(b) and (ga > 0).all() and (gb > 0).all()
    assert digest == brute([text])[0][6]


def test_the_fast_engine_gives_the_same_rows(spark, make_docs):
    docs = make_docs(list(enumerate(TEXTS)))
    fast = token_alignment.aligned_documents(docs, A, B, ranks_a=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern_a=public_tokenizers.PATTERN)
    assert sorted(tuple(r) for r in fast.collect()) == sorted(tuple(r) for r in token_alignment.aligned_documents(docs, A, B).collect())


def test_empty_table(spark, no_docs):
    assert token_alignment.aligned_documents(no_docs, A, B).count() == 0


def test_query_matches_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    found = {r.doc_id: tuple(getattr(r, c) for c in COLUMNS) for r in queries.op13_alignment(spark, sf_dir).collect()}
    assert found == dict(zip([d.doc_id for d in docs], brute([d.text for d in docs])))
