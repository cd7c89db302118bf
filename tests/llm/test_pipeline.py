import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from carepanel.llm import simhash
from carepanel.llm.shared import stored

from .conftest import prose
from .test_simhash import brute_roots


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
        out.append(docs)
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_all_but_the_last_stage_return_documents(stages):
    assert [s.columns for s in stages[1:-1]] == [stages[0].columns] * 4


def test_clean_documents_pass_the_language_stage(stages):
    assert texts(stages[1]) == {i: t for i, t in texts(stages[0]).items() if any(c.isalpha() for c in t)}


def test_line_stage_keeps_rows_and_drops_only_lines(stages):
    before, after = texts(stages[1]), texts(stages[2])
    assert before.keys() == after.keys()
    for i, text in after.items():
        rest = iter(before[i].split("\n"))
        assert all(line in rest for line in text.split("\n")) or text == ""
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_one_document_of_each_group_stays(stages):
    before = texts(stages[2])
    prints = {i: simhash.fingerprint(t) for i, t in before.items()}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert set(texts(stages[3])) == set(brute_roots(sorted(prints), pairs).values())


def test_no_benchmark_item_is_left(spark, sf_dir, stages):
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    before, after = texts(stages[3]), texts(stages[4])
    assert after == {i: t for i, t in before.items() if not any(b in t for b in items)}


def test_rows_of_the_last_stage_count_the_tokens(stages):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    counts = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts(stages[4]).items()}
    assert {r.doc_id: r.n_tokens for r in stages[5].collect()} == counts


def test_odd_documents_go_through(spark, sf_dir):
    rows = [(None, "Ab cd", "en"), (1, None, None), (2, "", "fr"), (3, "12", None), (4, prose(1, 50), "en"), (4, prose(2, 50), "en"), (4, prose(1, 50), "en"), (5, prose(1, 50), "en")]
    docs = spark.createDataFrame([(i, t, lang, None, None) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            table = stored(stage(spark, table, sf_dir), "stage")
        assert table.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_null_and_shared_ids_keep_a_row_of_each_group(spark, sf_dir):
    a, b, c, d = (prose(i, 60) for i in (31, 32, 33, 34))
    rows = [(None, a), (None, b), (None, b), (4, c), (4, d), (4, c), (5, c), (None, d)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.one_of_each_group(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted([(0, a), (0, b), (4, c), (4, d)])
