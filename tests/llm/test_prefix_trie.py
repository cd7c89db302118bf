import hashlib
import zlib

from carepanel.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string, depth int, a string, b string, pa long, chars string"


def _rem(c, m):
    return abs(c) % m * (1 if c >= 0 else -1)


def brute(rows, every=100, shared=6):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t, r or "", x or ""))
    ordered = {c: [(r, x) for t, r, x in sorted(v, key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2]))] for c, v in convs.items()}
    rebuilt = {}
    for c, own in ordered.items():
        h = zlib.crc32(str(c).encode()) % shared
        rebuilt[c] = ordered.get(c - _rem(c, every), [])[:h] + own[h:]
    nodes = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)

    def under(p):
        return [q for q in nodes if len(q) >= len(p) and q[: len(p)] == p]

    out = set()
    for prefix, members in nodes.items():
        d = len(prefix)
        subtree = under(prefix)
        leaves = sum(1 for p in subtree if not any(len(q) == len(p) + 1 for q in under(p)))
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in subtree if p)
        ends = ",".join(map(str, sorted(m for m in members if len(rebuilt[m]) == d)))
        parent = None if d == 0 else min(nodes[prefix[:-1]])
        children = sum(1 for q in subtree if len(q) == d + 1)
        out.add((min(members), d, parent, len(members), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def got(df):
    return {tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()}


ODD = [
    (0, 0, "user", "hi"), (0, 1, "assistant", "hello there"), (0, 2, "user", "more"), (0, None, "system", "be kind"),
    (0, 3, None, None), (0, 4, "user", "ünï 🙂"), (0, 5, "assistant", "x" * 5000), (0, 6, "user", "tail"),
    (1, 0, "user", "hi"), (1, 1, "assistant", "other"), (1, 1, "assistant", "other"), (1, 1, "assistant", "again"),
    (2, None, None, None), (5, 3, "user", "only"), (7, 0, "user", "hi"), (7, 1, "assistant", "hello there"),
    (100, 0, "user", "hi"), (101, 9, "user", "a"), (150, 0, "user", "hi"), (None, 0, "user", "lost"),
    (-150, 0, "user", "neg"), (-100, 0, "user", "neg"), (-100, 1, "user", "neg2"), (12, 0, "", ""),
]


def test_odd_table_matches_brute_force(spark):
    rows = [(c, t, r, x, 1, "a", "b", 2, "c") for c, t, r, x in ODD]
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA))
    assert got(found) == brute(ODD)


def test_deep_conversations_match_brute_force(spark):
    rows = [(c, t, "user" if t % 2 else "assistant", f"w{t % 3}" if c % 3 else f"v{t}") for c in range(300, 330) for t in range(c % 23)]
    found = prefix_trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert got(found) == brute(rows)


def test_empty_tables_give_no_node(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.conversation_trie(empty).count() == 0
    only_null = spark.createDataFrame([(None, 1, "u", "t")], "conv_id long, turn long, role string, text string")
    assert prefix_trie.conversation_trie(only_null).count() == 0


def test_query_over_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    found = queries.op11_prefix_trie(spark, sf_dir)
    assert got(found) == brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
