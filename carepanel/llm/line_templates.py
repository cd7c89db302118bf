"""Repeated lines by a log-template tree of fixed depth (native: DataFrame functions only).

A line walks the tree by its token count and its first tokens to a leaf. Tokens with a digit are variable from the
start. Inside a leaf a token is constant at its position if enough documents have it there, and variable else; a line
whose tokens behind the first ones are constant in a high share takes the generalised template, any other line stays
its own template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carepanel.llm.shared import stored

VARIABLE = "<*>"
SIEVE = 1 << 18


def masked_line(line: Column) -> Column:
    """The line with single spaces between tokens and tokens that hold a digit made variable."""
    uneven = line.startswith(" ") | line.endswith(" ")
    for white in ("  ", "\t", "\r", "\f", "\x0b"):
        uneven = uneven | line.contains(white)
    even = F.when(uneven, F.trim(F.regexp_replace(line, r"[ \t\r\f\x0b]+", " "))).otherwise(line)
    # only token starts can match, so a long unbroken string costs one pass
    return F.when(even.rlike("[0-9]"), F.regexp_replace(even, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", VARIABLE)).otherwise(even)


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _lines(docs: DataFrame, depth: int, least_tokens: int) -> DataFrame:
    """key, first_id, form, leaf, masked: a row per line that has enough tokens."""
    # masked inside the generator: the optimizer copies a plain expression into every later use of its column
    masked = docs.select("key", "id", F.explode(F.transform(F.split("text", "\n"), masked_line)).alias("masked"))
    n_tokens = F.octet_length("masked") - F.octet_length(F.replace(F.col("masked"), F.lit(" "), F.lit(""))) + 1
    leaf = F.xxhash64(n_tokens, F.substring_index("masked", " ", depth))
    return masked.where(n_tokens >= least_tokens).select("key", "id", _digest(F.col("masked")).alias("form"), leaf.alias("leaf"), "masked")


def _generalised(lines: DataFrame, found: DataFrame, depth: int, min_docs: int, similarity: float) -> DataFrame:
    """form, template for the lines that share a leaf with others and are constant in ``similarity`` of their later tokens."""
    busy = found.groupBy("leaf").agg(F.count("*").alias("n"), F.min("form").alias("one"), F.max("form").alias("other"))
    busy = stored(busy.where((F.col("n") >= min_docs) & (F.col("one") != F.col("other"))).select("leaf"), "leaves")
    weights = found.join(busy, "leaf", "left_semi").groupBy("form").agg(F.count("*").alias("n"))
    # a first sieve by hash keeps most text out of the shuffle; at most SIEVE slots are broadcast
    slot = F.pmod(F.col("leaf"), F.lit(SIEVE)).cast("int").alias("slot")
    texts = lines.select("form", "leaf", "masked", slot).join(F.broadcast(busy.select(slot).distinct()), "slot", "left_semi")
    texts = texts.join(busy, "leaf", "left_semi").groupBy("form").agg(F.first("leaf").alias("leaf"), F.first("masked").alias("masked"))
    tokens = stored(texts.join(weights, "form").select("form", "leaf", "n", F.posexplode(F.split("masked", " ")).alias("pos", "token")), "tokens")
    # the first tokens are those of the leaf and constant anyway
    later = tokens.where(F.col("pos") >= depth)
    constant = later.groupBy("leaf", "pos", "token").agg(F.sum("n").alias("support")).where(F.col("support") >= min_docs)
    known = later.join(constant.withColumn("constant", F.lit(True)), ["leaf", "pos", "token"], "left")
    fixed = F.coalesce("constant", F.lit(False)) & (F.col("token") != VARIABLE)
    marked = known.select("form", "leaf", "pos", F.when(fixed, F.col("token")).otherwise(VARIABLE).alias("token"), fixed.cast("int").alias("same"))
    first = tokens.where(F.col("pos") < depth).select("form", "leaf", "pos", "token", F.lit(None).cast("int").alias("same"))
    whole = marked.union(first).groupBy("form", "leaf").agg(
        F.avg("same").alias("share"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda t: t["token"]), " ").alias("template"),
    )
    return whole.where(F.col("share") >= similarity).select("form", _digest(F.col("template")).alias("template"))


def without_repeated_lines(
    docs: DataFrame, depth: int = 3, min_docs: int = 5, similarity: float = 0.7, least_tokens: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every row with its text freed of recurring lines, plus ``n_lines`` and ``n_dropped``; all its columns stay.

    A template recurs if ``min_docs`` different texts have it. Its lines are dropped from all but the first of them
    (that with the smallest id), so that what copies share survives once. Copies of a text count as one and are
    treated alike. Lines with fewer than ``least_tokens`` tokens, blank ones too, always stay. Lines end at line feeds.

    Null text: null, 0 lines. Empty text: one empty line, kept. A text whose lines all recur becomes empty. Null ids
    come last in the choice of the first. An empty table gives no rows. Columns that are named like the working columns
    or like the two new counts are carried through a struct, and give way to the counts only.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).cast("string").alias("_text"), F.col(id_col).alias("_id"))
    rows = rows.withColumn("_key", _digest(F.col("_text")))
    lines = _lines(rows.select(F.col("_key").alias("key"), F.col("_id").alias("id"), F.col("_text").alias("text")), depth, least_tokens)
    found = stored(lines.groupBy("key", "form", "leaf").agg(F.min("id").alias("first_id")), "lines")
    wider = stored(_generalised(lines, found, depth, min_docs, similarity), "templates")
    of_text = stored(
        found.join(wider, "form", "left").select("key", "form", "first_id", F.coalesce("template", "form").alias("template")),
        "by_template",
    )
    order = F.struct(F.col("first_id").isNull().alias("none"), "first_id", "key")
    recurring = of_text.groupBy("template", "key", "first_id").count().groupBy("template").agg(F.count("*").alias("n"), F.min(order).alias("first"))
    recurring = recurring.where(F.col("n") >= min_docs).select("template", F.col("first.key").alias("first_key"))
    drops = of_text.join(recurring, "template").where("key <> first_key").groupBy("key").agg(F.collect_set("form").alias("_drop"))
    joined = rows.join(drops.withColumnRenamed("key", "_key"), "_key", "left")
    all_lines = F.split("_text", "\n")
    kept = F.filter(all_lines, lambda line: ~F.array_contains("_drop", _digest(masked_line(line))))
    kept = F.when(F.col("_drop").isNotNull(), kept).otherwise(all_lines)
    size = lambda a: F.when(F.col("_text").isNull(), 0).otherwise(F.size(a)).cast("long")
    joined = joined.withColumn("_kept", kept)
    columns = [F.array_join("_kept", "\n").alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return joined.select(*columns, size(all_lines).alias("n_lines"), (size(all_lines) - size(F.col("_kept"))).alias("n_dropped"))
