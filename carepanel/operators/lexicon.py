"""Lexicon terms in sentences by a token n-gram join with longest-match resolution.

The lexicon is a table of any size: its terms become token strings, every sentence emits its token n-grams of the
lengths the lexicon has, and one equality join finds the matches. Per sentence, overlapping matches give way to the
longest (the earliest among equals). The plan does not grow with the number of terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepanel.functions.text import find_all, strip
from carepanel.operators import notes as nt

#: Tokens of terms and sentences: runs of lower-case letters and digits.
TOKEN = r"[a-z0-9]+"
#: The lexicon is broadcast only when its terms and kinds take at most this many bytes; else both sides shuffle.
BROADCAST_BYTES = 8 << 20


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0)


def lexicon_table(lexicon: DataFrame, term_col: str = "term", kind_col: str = "kind") -> DataFrame:
    """(term, kind, n, gram): lower-case term, its kind, its number of tokens and its tokens joined by one space.

    Terms without a token (null, empty, punctuation only) can match nothing and are left out; repeated rows count once.
    """
    tokens = _tokens(F.col(term_col))
    return (
        lexicon.select(F.lower(term_col).alias("term"), F.col(kind_col).cast("string").alias("kind"), tokens.alias("tokens"))
        .where(F.size("tokens") > 0)
        .select("term", "kind", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("gram"))
        .distinct()
    )


def lexicon_of_pairs(spark, pairs: list[tuple[str, str]]) -> DataFrame:
    return lexicon_table(spark.createDataFrame(pairs, "term string, kind string"))


def _resolved(matches: Column) -> Column:
    """Longest matches first at each start, then left to right; matches of the same span (other terms) stay together."""
    ordered = F.array_sort(
        matches,
        lambda x, y: F.when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(y["n"] - x["n"]).cast("int"),
    )
    kept = F.array().cast("array<struct<start:int,n:int,term:string,kind:string>>")
    start = F.struct(F.lit(-1).alias("end"), F.lit(-1).alias("start"), F.lit(-1).alias("n"), kept.alias("kept"))

    def step(state: Column, m: Column) -> Column:
        same_span = (m["start"] == state["start"]) & (m["n"] == state["n"])
        free = m["start"] >= state["end"]
        keep = free | same_span
        return F.struct(
            F.when(free, m["start"] + m["n"]).otherwise(state["end"]).alias("end"),
            F.when(free, m["start"]).otherwise(state["start"]).alias("start"),
            F.when(free, m["n"]).otherwise(state["n"]).alias("n"),
            F.when(keep, F.concat(state["kept"], F.array(m))).otherwise(state["kept"]).alias("kept"),
        )

    return F.aggregate(ordered, start, step, lambda s: s["kept"])


def term_matches(sentences: DataFrame, lexicon: DataFrame, keys: list[str], text_col: str = "sentence", resolve: str = "longest") -> DataFrame:
    """Per sentence row (``keys`` identify it; they are kept), the lexicon terms it holds as whole token sequences:
    rows of ``keys`` plus start (token), n (tokens), term and kind.

    ``resolve="longest"`` leaves non-overlapping spans, the longest at each place (the earliest among equals; all
    terms of one span stay); ``resolve="all"`` keeps every match, terms inside longer ones too. A null or empty
    sentence, or one without tokens, matches nothing. ``lexicon`` is a ``lexicon_table``.
    """
    if resolve not in ("longest", "all"):
        raise ValueError(f"unknown resolution: {resolve!r}")
    lengths = sorted(r["n"] for r in lexicon.select("n").distinct().collect())  # one per term length in tokens
    if not lengths:
        return sentences.select(*keys).limit(0).select(*keys, *[F.lit(None).cast(t).alias(c) for c, t in (("start", "int"), ("n", "int"), ("term", "string"), ("kind", "string"))])
    tokens = _tokens(F.coalesce(F.col(text_col), F.lit("")))
    size = lexicon.agg(F.sum(F.length("gram") + F.length("term") + F.coalesce(F.length("kind"), F.lit(0)) + 16)).first()[0] or 0
    tokenized = sentences.select(*keys, tokens.alias("tokens"))
    gram = lambda start, n: F.array_join(F.slice("tokens", start + 1, n), " ")
    if size <= BROADCAST_BYTES:
        # only tokens that begin a term become n-grams, of the lengths that terms with this first token have
        heads = lexicon.select(F.substring_index("gram", " ", 1).alias("head"), "n").distinct()
        placed = tokenized.select(*keys, "tokens", F.posexplode("tokens").alias("start", "head")).join(F.broadcast(heads), "head")
        inside = placed.where(F.col("start") + F.col("n") <= F.size("tokens"))
        candidates = inside.select(*keys, "start", "n", gram(F.col("start"), F.col("n")).alias("gram"))
    else:
        positions = F.when(F.size("tokens") > 0, F.sequence(F.lit(0), F.size("tokens") - 1)).otherwise(F.array().cast("array<int>"))
        fitting = lambda i: F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: i + n <= F.size("tokens"))
        grams = F.flatten(F.transform(positions, lambda i: F.transform(fitting(i), lambda n: F.struct(i.alias("start"), n.alias("n"), gram(i, n).alias("gram")))))
        candidates = tokenized.select(*keys, F.explode(grams).alias("g")).select(*keys, "g.*")
    table = F.broadcast(lexicon) if size <= BROADCAST_BYTES else lexicon
    found = candidates.join(table, ["n", "gram"]).select(*keys, F.struct("start", "n", "term", "kind").alias("m"))
    if resolve == "all":
        return found.select(*keys, "m.*")
    per_sentence = found.groupBy(*keys).agg(_resolved(F.collect_list("m")).alias("kept"))
    return per_sentence.select(*keys, F.explode("kept").alias("m")).select(*keys, "m.*")


def entity_sentences(notes: DataFrame, key: str = "note_id", text_col: str = "note_text") -> DataFrame:
    """(key, section_order, section, sentence_order, sentence): the sentences of the first section of each
    diagnostic kind, as the note annotation splits them."""
    parts = notes.select(key, nt.sections(F.col(text_col)).alias("parts"))
    chosen = F.array(
        *[F.struct(F.lit(s).alias("section"), F.coalesce(nt.section_text(F.col("parts"), s), F.lit("")).alias("text")) for s in nt.ENTITY_SECTIONS]
    )
    rows = parts.select(key, F.posexplode(chosen).alias("section_order", "part"))
    split = F.filter(F.transform(find_all(F.col("part.text"), nt.SENTENCE), strip), lambda s: s != "")
    return rows.select(key, "section_order", F.col("part.section").alias("section"), F.posexplode(split).alias("sentence_order", "sentence"))


def lexicon_entities(
    notes: DataFrame, lexicon: DataFrame, key: str = "note_id", text_col: str = "note_text", resolve: str = "longest"
) -> DataFrame:
    """One row per note, sentence and distinct term found there (see ``term_matches`` for ``resolve``): key, text,
    entity_type, assertion, section, sentence, confidence (1.0), as the annotation's entities."""
    sentences = entity_sentences(notes, key, text_col)
    keys = [key, "section_order", "section", "sentence_order", "sentence"]
    found = term_matches(sentences, lexicon, keys, resolve=resolve).select(*keys, "term", "kind").distinct()
    return found.select(
        key,
        F.col("term").alias("text"),
        F.col("kind").alias("entity_type"),
        nt.assertion(F.col("sentence"), F.col("term"), F.col("section")).alias("assertion"),
        "section",
        "sentence",
        F.lit(1.0).alias("confidence"),
    )
