import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from carepanel.llm import bpe, token_files, words

from .conftest import ODD_TEXTS

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abß'SéÉÀ×÷ÿΣİ日!9 \n\t\x0b\x1c\x85\xa0¿«ªµ<|>endoftext0́"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd_strings():
    draw = random.Random(4)
    return [t or "" for t in ODD_TEXTS] + ["aaaaaaaaa", "don't we'll 'S", "<|startoftext|>x<|endoftext"] + ["".join(draw.choice(ALPHABET) for _ in range(draw.randrange(40))) for _ in range(1500)]


def whole(encoder, texts):
    out, part = [], []
    for ids, ends in encoder.texts(iter(texts)):
        part += ids.tolist()
        if ends:
            out.append(part)
            part = []
    return out


def test_merge_rounds_give_the_library_ids(library, odd_strings):
    expected = [library.encode(t, add_special_tokens=False).ids for t in odd_strings]
    assert whole(bpe.encoder(PATH).words, odd_strings) == expected
    assert whole(token_files._library(PATH).words, odd_strings) == expected


def test_long_texts_in_pieces(library, odd_strings, monkeypatch):
    text = " ".join(odd_strings)
    monkeypatch.setattr(words, "PIECE_CHARS", 64)
    monkeypatch.setattr(words.pieces_of, "__defaults__", (64,))
    assert whole(bpe.Encoder(PATH).words, [text, "", text]) == [library.encode(t, add_special_tokens=False).ids for t in (text, "", text)]


def test_a_full_word_table_is_cleared(library):
    texts = [f"w{i} x{i} y{i}" for i in range(20)]
    encoder = bpe.Encoder(PATH)
    encoder.words.most_words = 3
    assert [whole(encoder.words, [t])[0] for t in texts] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_digests(odd_docs, no_docs, library):
    texts = {(r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in odd_docs.collect()}
    expected = sorted(
        (i is not None, i or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
        for i, ids in ((r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in odd_docs.collect())
    )
    rows = bpe.digests(bpe.with_decoded(bpe.with_ids(odd_docs, PATH), PATH)).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == expected
    assert len(texts) > 5
    assert bpe.digests(bpe.with_decoded(bpe.with_ids(no_docs, PATH), PATH)).count() == 0


def test_token_files(spark, odd_docs, library):
    folder = token_files.new_folder(spark)
    manifest = token_files.write_token_files(odd_docs, folder, PATH)
    rows = token_files.read_token_files(spark, folder, lambda ids: zlib.crc32(ids.astype("<u4").tobytes())).collect()
    source = odd_docs.collect()
    assert len(rows) == len(source) == sum(r.n_docs for r in manifest.collect())
    key = lambda i, n, c: (i is not None, i or 0, n, c)
    expected = sorted(key(r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for r in source for ids in [library.encode(r.text or "", add_special_tokens=False).ids + [2]])
    assert sorted(key(r.doc_id, r.n_tokens, r.value) for r in rows) == expected
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.start for r in ordered] == [0, *np.cumsum([r.n_tokens for r in ordered])[:-1].tolist()]
    assert [(r.doc_id is not None, r.doc_id or 0) for r in ordered] == sorted((r.doc_id is not None, r.doc_id or 0) for r in rows)


def test_token_files_without_rows_or_end_ids(spark, no_docs, make_docs):
    folder = token_files.new_folder(spark)
    token_files.write_token_files(no_docs, folder, PATH)
    assert token_files.read_token_files(spark, folder, len).count() == 0
    folder = token_files.new_folder(spark)
    token_files.write_token_files(make_docs([(1, None), (2, "")]), folder, PATH, end_id=None)
    assert [(r.doc_id, r.start, r.n_tokens, r.value) for r in token_files.read_token_files(spark, folder, len).orderBy("doc_id").collect()] == [(1, 0, 0, 0), (2, 0, 0, 0)]


def test_a_store_that_is_not_mounted_is_refused():
    with pytest.raises(ValueError):
        token_files.local_path("hdfs://store/x")


def test_fused_digests_equal_the_three_steps(spark, odd_docs, sf_dir):
    docs = odd_docs.select("doc_id", "text").unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    steps = bpe.digests(bpe.with_decoded(bpe.with_ids(docs, PATH).drop("text"), PATH))
    fused = bpe.encoded_digests(docs, PATH)
    assert fused.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, fused.collect()), key=repr) == sorted(map(tuple, steps.collect()), key=repr)
