import random

from carepanel.operators import lexicon as lx
from carepanel.operators import notes as nt
from carepanel.plans import note_queries as nq

WORDS = ["heart", "failure", "chronic", "kidney", "disease", "no", "a", "fib", "pain", "chest"]


def brute(tokens, terms):
    """Greedy left to right, the longest term at each start; all terms of a kept span."""
    spans = sorted({(i, len(t.split())) for t in terms for i in range(len(tokens)) if tokens[i : i + len(t.split())] == t.split()}, key=lambda s: (s[0], -s[1]))
    kept, end = [], -1
    for start, n in spans:
        if start >= end:
            kept.append((start, n))
            end = start + n
    return {(s, n, t) for s, n in kept for t in terms if " ".join(tokens[s : s + n]) == t}


def test_longest_matches_equal_brute_force(spark):
    draw = random.Random(3)
    terms = sorted({" ".join(draw.choice(WORDS) for _ in range(draw.randrange(1, 4))) for _ in range(25)})
    sentences = [(i, " ".join(draw.choice(WORDS) for _ in range(draw.randrange(0, 15))) + draw.choice([".", "", " ,"])) for i in range(300)]
    lexicon = lx.lexicon_of_pairs(spark, [(t.upper() if i % 3 == 0 else t, "K") for i, t in enumerate(terms)] + [(None, "K"), ("--", "K")])
    df = spark.createDataFrame(sentences + [(300, None), (301, "")], "id int, sentence string")
    got = {}
    for r in lx.term_matches(df, lexicon, ["id"]).collect():
        got.setdefault(r.id, set()).add((r.start, r.n, r.term))
    for i, text in sentences:
        assert got.get(i, set()) == brute(text.replace(",", " ").replace(".", " ").split(), terms), text
    assert 300 not in got and 301 not in got
    every = {(r.id, r.start, r.n) for r in lx.term_matches(df, lexicon, ["id"], resolve="all").collect()}
    assert {(i, s, n) for i, spans in got.items() for s, n, _ in spans} <= every


def test_a_large_lexicon_keeps_the_plan_and_finds_its_terms(spark, sf_dir):
    small = lx.lexicon_of_pairs(spark, nt.default_lexicon())
    large = lx.lexicon_table(
        spark.range(100_000).selectExpr("concat('term', CAST(id AS STRING), ' x', CAST(id % 7 AS STRING)) AS term", "'K' AS kind").union(
            spark.createDataFrame(nt.default_lexicon(), "term string, kind string")
        )
    )
    notes = nq._notes(spark, sf_dir)
    plan = lambda lexicon: len(lx.lexicon_entities(notes, lexicon, resolve="all")._jdf.queryExecution().optimizedPlan().toString())
    assert plan(large) < 2 * plan(small)
    rows = lambda lexicon: sorted(tuple(r) for r in lx.lexicon_entities(notes, lexicon, resolve="all").collect())
    assert rows(large) == rows(small)
    planted = spark.createDataFrame([(1, "Assessment and Plan:\nterm99999 x4 noted. No term5 x5 here.")], "note_id long, note_text string")
    found = {(r.text, r.assertion) for r in lx.lexicon_entities(planted, large).collect()}
    assert found == {("term99999 x4", "confirmed"), ("term5 x5", "negated")}


def test_odd_notes(spark):
    notes = spark.createDataFrame(
        [(1, None), (2, ""), (None, "Assessment and Plan:\nCHF and HF."), (3, "Assessment and Plan:\nchronic kidney disease")],
        "note_id long, note_text string",
    )
    lexicon = lx.lexicon_of_pairs(spark, nt.default_lexicon())
    got = sorted((r.note_id or -1, r.text) for r in lx.lexicon_entities(notes, lexicon).collect())
    assert got == [(-1, "chf"), (-1, "hf"), (3, "chronic kidney disease")]
    assert lx.lexicon_entities(notes, lx.lexicon_of_pairs(spark, [("--", "K")])).count() == 0
