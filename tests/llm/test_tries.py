import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from meterline.llm import queries, tries
from tests.oracle import compare, connect

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def rebuilt(turns):
    """Conversations by the rule, as lists of (role, text)."""
    own = {}
    for c, t, r, x in turns:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [s[2:] for s in sorted(steps)] for c, steps in own.items()}
    found = {}
    for c, steps in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        found[c] = own.get(c - c % 100, [])[:h] + steps[h:]
    return found


def brute(convs):
    """All nodes, by looking at every prefix of every conversation."""
    members = {}
    for c, steps in convs:
        for d in range(len(steps) + 1):
            members.setdefault(tuple(steps[:d]), []).append(c)
    kids, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    for p, inside in members.items():
        cost = (len(inside) - 1) * (len(p[-1][1]) if p else 0)
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in kids)
            saved[p[:d]] = saved.get(p[:d], 0) + cost
    rows = []
    for p, inside in members.items():
        ends = ",".join(str(c) for c, steps in sorted(convs) if tuple(steps) == p)
        rows.append((min(inside), len(p), min(members[p[:-1]]) if p else None, len(inside),
                     kids.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def rows(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def made(rng, n):
    """Conversations in families that share beginnings of many lengths; one is very common."""
    turns = []
    common = [("user", f"common {i}") for i in range(9)]
    for c in rng.sample(range(-150, 900), n):
        steps = common[: rng.randrange(10)] if rng.random() < 0.6 else []
        steps = steps + [(rng.choice(["user", "assistant", None]), rng.choice("abc") * rng.randrange(4))
                         for _ in range(rng.randrange(5))]
        steps = steps or [("user", "")]
        turns += [(c, i, r, x) for i, (r, x) in enumerate(steps)]
    return turns


@pytest.mark.parametrize("shards", [None, 1, 7, 40])
def test_nodes_match_brute_force(spark, shards):
    turns = made(random.Random(3), 300)
    df = spark.createDataFrame(turns, TURNS).repartition(5)
    found = tries.prefix_trie(tries.with_family_heads(tries.paths_of(df)), shards)
    assert found.columns == COLUMNS
    assert rows(found) == brute(list(rebuilt(turns).items()))


def test_query_on_given_conversations(spark):
    sf = "/root/testdata/sf0.001"
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    assert rows(queries.op11_conversation_trie(spark, sf)) == brute(list(rebuilt(turns).items()))


def test_query_equals_its_sql(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        sql = connect(sf).sql(tries.ORACLE_SQL)
        assert compare(queries.op11_conversation_trie(spark, sf), sql) is None


def test_deep_spine_in_many_shards(spark):
    """One long conversation, and others that leave it at every depth."""
    long = [("u", f"turn {i}") for i in range(70)]
    convs = [(c, long[:c] + [("a", f"own {c} {'x' * c}")] * (c % 3)) for c in range(71)]
    convs += [(100 + c, long) for c in range(40)]
    turns = [(c, i, r, x) for c, steps in convs for i, (r, x) in enumerate(steps)]
    paths = tries.paths_of(spark.createDataFrame(turns, TURNS))
    want = brute([(c, steps) for c, steps in convs if steps])
    assert rows(tries.prefix_trie(paths, 12)) == want


def test_odd_conversations(spark):
    turns = [(1, None, None, None), (1, 0, "user", "é😀"), (1, 0, "user", "é😀"), (2, 5, "", ""),
             (None, 1, "user", "no conversation"), (3, 2, "user", None), (3, 1, None, "x" * 5000),
             (3, 2, "user", None), (-105, 1, "user", "negative"), (100, 7, "b", "t"), (100, 7, "a", "t"),
             (104, 1, "q", "y")]
    df = spark.createDataFrame(
        [(*t, 1, "k", 2) for t in turns], TURNS + ", depth long, path string, a int"
    ).repartition(3)
    found = tries.prefix_trie(tries.with_family_heads(tries.paths_of(df)), 3)
    assert rows(found) == brute(list(rebuilt(turns).items()))


def test_repeated_conversations_and_turnless_ones(spark):
    kind = "conv_id long, path array<struct<a: bigint, b: bigint, n: int>>"
    step = lambda i: (i, i + 1, 3)
    data = [(5, []), (5, []), (7, [step(1)]), (7, [step(1)]), (9, [step(1), step(2)])]
    found = tries.prefix_trie(spark.createDataFrame(data, kind), 2)
    assert [r[:7] for r in rows(found)] == [
        (5, 0, None, 5, 1, 1, 6), (7, 1, 5, 3, 1, 1, 6), (9, 2, 7, 1, 0, 1, 0)]


def test_no_conversations(spark):
    df = spark.createDataFrame([], TURNS)
    found = tries.prefix_trie(tries.with_family_heads(tries.paths_of(df)))
    assert found.columns == COLUMNS and found.count() == 0


def test_parentheses():
    rng = random.Random(1)
    for n, block in itertools.product((1, 2, 5, 40, 700), (2, 8, 64)):
        opens, level, left = [], 0, n
        while left or level:
            up = left and (not level or rng.random() < 0.55)
            opens.append(bool(up))
            level += 1 if up else -1
            left -= bool(up)
        stack, want = [], {}
        for i, up in enumerate(opens):
            if up:
                stack.append(i)
            else:
                want[stack.pop()] = i
        tree = tries.Parentheses(np.array(opens), block)
        at = np.flatnonzero(opens)
        close = tree.findclose(at)
        assert close.tolist() == [want[i] for i in at.tolist()]
        leaves = [sum(opens[p] and not opens[p + 1] for p in range(a, b)) for a, b in want.items()]
        pairs = tree.leaf_pairs(np.array(list(want)), np.array(list(want.values())))
        assert pairs.tolist() == leaves
