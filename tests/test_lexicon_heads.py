"""Only tokens that begin a lexicon term become n-grams."""

from pyspark.sql import functions as F

from carepanel.operators import lexicon as lx


def test_grams_are_built_after_the_join_on_first_tokens(spark):
    lexicon = lx.lexicon_of_pairs(spark, [("heart failure", "K"), ("heart", "K"), ("chronic kidney disease", "K")])
    sentences = spark.createDataFrame([(1, "Chronic heart failure."), (2, "the heart"), (3, "chronic kidney"), (4, "chronic kidney disease"), (5, None)], "id int, sentence string")
    found = lx.term_matches(sentences, lexicon, ["id"], resolve="all")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and "flatten" not in plan
    got = sorted((r.id, r.start, r.n, r.term) for r in found.collect())
    assert got == [(1, 1, 1, "heart"), (1, 1, 2, "heart failure"), (2, 1, 1, "heart"), (4, 0, 3, "chronic kidney disease")]


def test_both_ways_find_the_same_terms(spark, monkeypatch):
    words = F.array(*[F.lit(w) for w in ("heart", "failure", "no", "a", "fib")])
    word = lambda k: F.get(words, F.abs(F.hash("id", F.lit(k))) % 5)
    sentences = spark.range(200).select("id", F.concat_ws(" ", *[word(k) for k in range(9)]).alias("sentence"))
    lexicon = lx.lexicon_of_pairs(spark, [("a fib", "K"), ("heart failure", "K"), ("failure", "L"), ("no heart failure", "K"), ("Failure", "M")])
    rows = lambda resolve: sorted(tuple(r) for r in lx.term_matches(sentences, lexicon, ["id"], resolve=resolve).collect())
    by_heads = [rows("longest"), rows("all")]
    monkeypatch.setattr(lx, "BROADCAST_BYTES", -1)
    assert [rows("longest"), rows("all")] == by_heads
    assert by_heads[1]
