"""Prefix trie of conversations: balanced parentheses per shard, shared spines merged.

Conversations are dealt to shards by ranges of their turns' hashes, so that a prefix is in one
shard, or in neighbours only if it is a prefix of the conversations at their borders. Each shard
writes its trie as balanced parentheses in depth-first order. ``findclose``, over a tree of block
minima of the excess, gives each node's subtree as a range; leaves are pairs ``()`` and are counted
by rank, members and savings by differences of cumulative arrays. Nodes on the spines at a shard's
borders are added up by key afterwards: all their figures are sums over shards, less what a node
that several shards hold was counted too often, which is added up along the spine by doubling.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import settle
from meterline.plans.sizing import broadcast_when_small

# Fixed values of the rebuilding rule: conversations in a family, and one more than the longest head.
FAMILY, HEADS = 100, 6
_STEP = "array<struct<a: bigint, b: bigint, n: int>>"
NO_ENDS = hashlib.sha256(b"").hexdigest()

_NODE = """conv_id long, depth long, key binary, parent_key binary, parent_conv_id long, n_convs long,
  n_children long, n_leaves long, spent long, chars long, own_chars long, ends_sha256 string,
  edge boolean, parent_edge boolean"""


# --- balanced parentheses --------------------------------------------------------------------


class Parentheses:
    """A balanced sequence (True opens) with a tree of the least excess of its blocks."""

    def __init__(self, opens: np.ndarray, block: int = 64):
        n = len(opens)
        self.block = block
        self.excess = np.cumsum(np.where(opens, 1, -1)).astype(np.int64)
        blocks = max(1, -(-n // block))
        self.leaves = 1 << (blocks - 1).bit_length()
        # Beyond the end the excess never falls low enough to be found.
        padded = np.full(self.leaves * block, np.iinfo(np.int64).max, np.int64)
        padded[:n] = self.excess
        self.rows = padded.reshape(self.leaves, block)
        self.least = np.full(2 * self.leaves, np.iinfo(np.int64).max, np.int64)
        self.least[self.leaves :] = self.rows.min(axis=1)
        level = self.leaves
        while level > 1:
            half = level // 2
            self.least[half:level] = self.least[level : 2 * level].reshape(-1, 2).min(axis=1)
            level = half
        pairs = np.zeros(n + 1, np.int64)
        if n:
            pairs[1:n] = np.cumsum(opens[:-1] & ~opens[1:])
            pairs[n] = pairs[n - 1]
        self.pairs = pairs

    def findclose(self, at: np.ndarray) -> np.ndarray:
        """Where the parentheses opened at ``at`` close: the first later place of less excess."""
        wanted = self.excess[at] - 1
        found = np.full(len(at), -1, np.int64)
        for first in range(0, len(at), 1 << 14):
            some = slice(first, first + (1 << 14))
            found[some] = self._in_block(at[some] // self.block, at[some] % self.block, wanted[some])
        open_ = np.flatnonzero(found < 0)
        node = self.leaves + at[open_] // self.block
        target = wanted[open_]
        # Up, until the right neighbour's subtree goes low enough, ...
        climbing = np.arange(len(open_))
        while len(climbing):
            here = node[climbing]
            right = (here & 1 == 0) & (self.least[np.minimum(here + 1, len(self.least) - 1)]
                                       <= target[climbing])
            node[climbing] = np.where(right, here + 1, here >> 1)
            climbing = climbing[~right]
        # ... and down again to the first block that does.
        node = self._down(node, target)
        for first in range(0, len(node), 1 << 14):
            some = slice(first, first + (1 << 14))
            found[open_[some]] = self._in_block(
                node[some] - self.leaves, np.full(len(node[some]), -1), target[some]
            )
        return found

    def _down(self, node: np.ndarray, target: np.ndarray) -> np.ndarray:
        while (above := node < self.leaves).any():
            left = 2 * node[above]
            node[above] = np.where(self.least[left] <= target[above], left, left + 1)
        return node

    def _in_block(self, block, after, target) -> np.ndarray:
        low = self.rows[block] <= target[:, None]
        low &= np.arange(self.block)[None, :] > after[:, None]
        first = low.argmax(axis=1)
        return np.where(low[np.arange(len(first)), first], block * self.block + first, -1)

    def leaf_pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs ``()`` that begin in places a to b (b not included)."""
        return self.pairs[b] - self.pairs[a]


class Shard:
    """The trie of conversations that come in the order of their turns."""

    def __init__(self):
        self.opens: list[bool] = []
        self.parent: list[int] = []
        self.chars: list[int] = []
        self.keys: list[bytes] = []
        self.ends: list[int] = []
        self.least: list[int | None] = []
        self.digests: dict[int, str] = {}
        self.stack: list[int] = []
        self.path: list[tuple] | None = None
        self.first: list[int] = []
        self.digest = None

    def add(self, path: list[tuple], conv_id: int) -> None:
        """Add a conversation; equal ones come one after the other, smaller ids first."""
        if path != self.path:
            self._finish()
            same = 0
            if self.path is None:
                self._open(-1, 0, bytes(16))
            else:
                for x, y in zip(path, self.path, strict=False):
                    if x != y:
                        break
                    same += 1
                gone = len(self.stack) - 1 - same
                self.opens += [False] * gone
                del self.stack[same + 1 :]
            for a, b, n in path[same:]:
                top = self.stack[-1]
                step = a.to_bytes(8, "little", signed=True) + b.to_bytes(8, "little", signed=True)
                key = hashlib.blake2b(self.keys[top] + step, digest_size=16).digest()
                self._open(top, n, key)
            if self.path is None:
                self.first = list(self.stack)
            self.path = path
            self.digest = hashlib.sha256()
        node = self.stack[-1]
        self.digest.update(str(conv_id).encode() if not self.ends[node] else b",%d" % conv_id)
        self.ends[node] += 1
        if self.least[node] is None:
            self.least[node] = conv_id

    def _open(self, parent: int, chars: int, key: bytes) -> None:
        self.stack.append(len(self.parent))
        self.opens.append(True)
        self.parent.append(parent)
        self.chars.append(chars)
        self.keys.append(key)
        self.ends.append(0)
        self.least.append(None)

    def _finish(self) -> None:
        if self.digest is not None:
            self.digests[self.stack[-1]] = self.digest.hexdigest()

    def nodes(self) -> pa.RecordBatch | None:
        """One row per node, its figures for this shard alone."""
        if self.path is None:
            return None
        self._finish()
        last = list(self.stack)
        opens = np.array(self.opens + [False] * len(self.stack), bool)
        tree = Parentheses(opens)
        at = np.flatnonzero(opens)
        close = tree.findclose(at)
        n = len(at)
        own = np.arange(n)
        past = own + (close - at + 1) // 2
        convs = _between(np.array(self.ends, np.int64), own, past)
        chars = np.array(self.chars, np.int64)
        parent = np.array(self.parent, np.int64)
        least = self.least
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            if least[up] is None or least[i] < least[up]:
                least[up] = least[i]
        conv = np.array(least, np.int64)
        depth = tree.excess[at] - 1
        edge = np.zeros(n, bool)
        edge[self.first] = edge[last] = True
        up = np.maximum(parent, 0)
        top = parent < 0
        keys = pa.array(self.keys, pa.binary())
        columns = [
            pa.array(conv),
            pa.array(depth),
            keys,
            keys.take(pa.array(up, mask=top)),
            pa.array(conv[up], mask=top),
            pa.array(convs),
            pa.array(np.bincount(parent[1:], minlength=n).astype(np.int64)),
            pa.array(tree.leaf_pairs(at, close)),
            pa.array(_between(convs * chars, own, past)),
            pa.array(_between(chars, own, past)),
            pa.array(chars),
            pa.array([self.digests.get(i) for i in range(n)], pa.string()),
            pa.array(edge),
            pa.array(edge[up] & ~top),
        ]
        return pa.RecordBatch.from_arrays(columns, names=_names())


def _between(values: np.ndarray, first: np.ndarray, past: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=sums[1:])
    return sums[past] - sums[first]


def _names() -> list[str]:
    return [c.split()[0] for c in _NODE.split(",")]


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shard = Shard()
    for batch in batches:
        paths = batch.column("path")
        steps = paths.flatten()
        flat = list(zip(*(steps.field(i).to_pylist() for i in range(3)), strict=True))
        ends = np.cumsum(paths.value_lengths().to_numpy()).tolist()
        start = 0
        for end, conv_id in zip(ends, batch.column("conv_id").to_pylist(), strict=True):
            shard.add(flat[start:end], conv_id)
            start = end
    nodes = shard.nodes()
    if nodes is not None:
        for at in range(0, len(nodes), 10_000):
            yield nodes.slice(at, 10_000)


# --- Spark -----------------------------------------------------------------------------------


def paths_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): each conversation's turns in order, as two hashes and the text's length.

    Input: ``conv_id``, ``turn``, ``role``, ``text`` and any other columns. Turns are in the order
    of ``turn``, null first, and of role and hashes where it ties. Null roles and texts are empty;
    rows without ``conv_id`` belong to no conversation. Texts are hashed where they are read and
    not shuffled; a conversation's hashes, 20 bytes a turn, have to fit into a task.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    steps = F.sort_array(F.collect_list(F.struct("turn", "role", "a", "b", "n")))
    return (
        conversations.where(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long"),
            "turn",
            role.alias("role"),
            F.xxhash64(role, text).alias("a"),
            F.xxhash64(F.lit("second"), role, text).alias("b"),
            F.length(text).alias("n"),
        )
        .groupBy("conv_id")
        .agg(F.transform(steps, lambda s: F.struct(s["a"], s["b"], s["n"])).alias("path"))
        .select("conv_id", F.col("path").cast(_STEP).alias("path"))
    )


def with_family_heads(paths: DataFrame) -> DataFrame:
    """(conv_id, path): each path with its first h turns replaced by the first h of its family's.

    The family's conversation is ``conv_id - conv_id % 100``; h is the CRC-32 of the decimal
    ``conv_id`` modulo 6. If the family's conversation is shorter all of it is taken, if it is
    absent nothing.
    """
    paths = settle(paths)
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = paths.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"), F.slice("path", 1, HEADS - 1).alias("head")
    )
    keyed = paths.withColumns(
        {"base": base, "h": (F.crc32(F.col("conv_id").cast("string")) % HEADS).cast("int")}
    )
    joined = keyed.join(broadcast_when_small(heads), "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast(_STEP)), F.lit(1), F.col("h"))
    left = F.greatest(F.size("path") - F.col("h"), F.lit(0))
    return joined.select(
        "conv_id", F.concat(head, F.slice("path", F.col("h") + 1, left)).alias("path")
    )


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """The nodes of the trie of ``paths`` (conv_id, path), one row per distinct prefix.

    Result: ``conv_id`` (the smallest member), ``depth`` (0 at the root), ``parent_conv_id`` (null
    at the root), ``n_convs``, ``n_children``, ``n_leaves`` and ``saved_tokens`` (over the subtree,
    each node's members but one times its last text's length) and ``ends_sha256`` (of the sorted
    ids of the conversations that end there, joined by commas).

    Conversations without turns are members of the root alone. Repeated ``conv_id`` rows count
    as conversations of their own. Without conversations there is no node. ``shards`` is the
    number of ranges, by default Spark's own; a prefix that a third of all conversations share
    is split among them, while equal conversations stream through one task, as their ids are
    digested in order.
    """
    by = ([shards] if shards else []) + ["path"]
    dealt = settle(paths).repartitionByRange(*by).sortWithinPartitions("path", "conv_id")
    found = settle(dealt.mapInArrow(_shard, _NODE))
    spines = settle(_merged(found.where("edge")))
    saved = (F.col("spent") - F.col("chars")).alias("saved_tokens")
    figures = ["n_convs", "n_children", "n_leaves", saved, "ends_sha256"]
    inner = found.where("NOT edge").select(
        "conv_id", "depth", "parent_key", "parent_conv_id", "parent_edge", *figures
    )
    shared = spines.select(
        "conv_id", "depth", "parent_key", F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(True).alias("parent_edge"), *figures,
    )
    above = broadcast_when_small(
        spines.select(F.col("key").alias("above"), F.col("conv_id").alias("above_conv_id"))
    )
    joined = inner.unionByName(shared).join(
        above, F.col("parent_edge") & (F.col("parent_key") == F.col("above")), "left"
    )
    return joined.select(
        "conv_id",
        "depth",
        F.coalesce("above_conv_id", "parent_conv_id").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )


def _merged(edges: DataFrame) -> DataFrame:
    """Spine nodes of all shards, one row each, counted as if there were one shard."""
    tip = (F.col("n_children") == 0).cast("long")
    held = settle(
        edges.groupBy("key").agg(
            *(F.min(c).alias(c) for c in ("conv_id", "depth", "parent_key", "own_chars")),
            *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "spent", "chars")),
            F.max("ends_sha256").alias("ends_sha256"),
            F.count("*").alias("held"),
            F.sum(tip).alias("tips"),
        )
    )
    shared = held.where("held > 1")
    # What a node's copies add too much: leaves that are none or one, and their text's length.
    extra = settle(
        shared.select(
            "key",
            F.col("parent_key").alias("jump"),
            (F.col("tips") - F.when(F.col("tips") == F.col("held"), 1).otherwise(0)).alias("leaves"),
            ((F.col("held") - 1) * F.col("own_chars")).alias("text"),
        )
    )
    deepest = shared.agg(F.max("depth")).first()[0] or 0
    for _ in range(deepest.bit_length()):
        extra = settle(_doubled(extra))
    children = shared.groupBy(F.col("parent_key").alias("key")).agg(
        F.sum(F.col("held") - 1).alias("children")
    )
    more = extra.select("key", "leaves", "text").join(children, "key", "full")
    joined = held.join(more, "key", "left")
    less = lambda c, by: (F.col(c) - F.coalesce(by, F.lit(0))).alias(c)
    return joined.select(
        "key", "conv_id", "depth", "parent_key", "n_convs", "spent", "ends_sha256",
        less("n_children", "children"), less("n_leaves", "leaves"), less("chars", "text"),
    )


def _doubled(sums: DataFrame) -> DataFrame:
    """Sums over descendants nearer than 2**(t+1) from those nearer than 2**t, which ``jump`` is
    above."""
    below = sums.where("jump IS NOT NULL").groupBy(F.col("jump").alias("key")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("text").alias("more_text")
    )
    jumps = sums.select(F.col("key").alias("jump"), F.col("jump").alias("next"))
    return (
        sums.join(below, "key", "left")
        .join(jumps, "jump", "left")
        .select(
            "key",
            F.col("next").alias("jump"),
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
            (F.col("text") + F.coalesce("more_text", F.lit(0))).alias("text"),
        )
    )


# --- the same in SQL -------------------------------------------------------------------------

# CRC-32 bit by bit: each byte is followed by seven zeros, one item a shift.
_CRC = """list_reduce(
  list_concat([CAST(4294967295 AS BIGINT)], flatten(list_transform(
    range(1, length(CAST(c AS VARCHAR)) + 1),
    lambda i: [CAST(ascii(substr(CAST(c AS VARCHAR), CAST(i AS INT), 1)) AS BIGINT),
               0, 0, 0, 0, 0, 0, 0]))),
  lambda crc, x: xor(xor(crc, x) >> 1, 3988292384 * (xor(crc, x) & 1)))"""

ORACLE_SQL = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % {FAMILY} AS base, xor(crc, 4294967295) % {HEADS} AS h
  FROM (SELECT c, {_CRC} AS crc FROM (SELECT DISTINCT c FROM turns))),
rebuilt AS (
  SELECT convs.c, 0 AS part, p, r, x FROM convs JOIN turns ON turns.c = base AND p <= h
  UNION ALL SELECT convs.c, 1, p, r, x FROM convs JOIN turns ON turns.c = convs.c AND p > h),
placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, p) AS d, r, x FROM rebuilt),
keyed AS (
  SELECT c, d, length(x) AS chars,
         sha256(string_agg(length(r) || ':' || r || length(x) || ':' || x, '')
                  OVER (PARTITION BY c ORDER BY d)) AS k
  FROM placed
  UNION ALL SELECT c, 0, 0, 'root' FROM convs),
steps AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up FROM keyed),
nodes AS (
  SELECT k, d, any_value(up) AS up, min(c) AS c, count(*) AS n, any_value(chars) AS chars
  FROM steps GROUP BY k, d),
children AS (SELECT up AS k, count(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT s.k, sum(CASE WHEN ch.k IS NULL THEN 1 ELSE 0 END) AS n_leaves,
         sum((nodes.n - 1) * nodes.chars) AS saved
  FROM nodes JOIN steps s ON s.c = nodes.c AND s.d <= nodes.d
  LEFT JOIN children ch ON ch.k = nodes.k GROUP BY s.k),
lasts AS (SELECT c, max_by(k, d) AS k FROM steps GROUP BY c),
ends AS (SELECT k, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest
         FROM lasts GROUP BY k)
SELECT nodes.c AS conv_id, CAST(nodes.d AS BIGINT) AS depth, parents.c AS parent_conv_id,
       nodes.n AS n_convs, coalesce(n_children, 0) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       coalesce(digest, '{NO_ENDS}') AS ends_sha256
FROM nodes LEFT JOIN nodes parents ON parents.k = nodes.up
LEFT JOIN children ON children.k = nodes.k
JOIN below ON below.k = nodes.k LEFT JOIN ends ON ends.k = nodes.k
"""
