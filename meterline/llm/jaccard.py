"""Exact Jaccard self-join of documents' shingle sets by signature trees.

Equal sets are one class. Of each class the rarest shingles are listed, so many that two linked
sets share three; sets that list a shingle, and whose sizes are near enough, are the members
of a tree, unless they are few: then two must meet three times. A tree's rows are bitmaps of whole sets, its nodes hold the bitmaps of those below OR-ed
together and their range of sizes, and a traversal of pairs of nodes leaves out those whose largest
possible overlap is too small for a link. What passes is compared exactly.

A tree's rows are first compared with the one that is most like all others, which connects a large
group of near copies at the cost of one comparison a set; the traversal then only looks for links
between sets that are not connected yet.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import settle, slices
from meterline.llm.components import components
from meterline.llm.counts import Counter, buckets, summed
from meterline.plans.sizing import broadcast_when_small

SHINGLE, PERCENT = 3, 90
# Two linked sets list SHARED of the same shingles; in groups of up to FEW that is counted.
SHARED, FEW = 3, 8
# Rows of a tree; larger groups are dealt to several trees.
MOST = 4096
FAN_OUT = 4
_WORDS = 1 << 20

_NAME = "doc_id <=> __doc AND __tag = __named"


# --- sets ------------------------------------------------------------------------------------


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256)
_LOWER[65:91] += 32
# Random values of bytes and an odd base: a word's hash is a polynomial of its bytes.
_random = np.random.default_rng(20240307)
_BYTES = _random.integers(0, 1 << 63, 256, np.uint64)[_LOWER] | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
# Texts are hashed in pieces of this many bytes, cut at white space; longer words by XXH64.
_PIECE, _LONG = 1 << 20, 200
_GAP = re.compile(rb"[ \t-\r]")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@functools.cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    found = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        powers = np.full(_PIECE + 1, base, np.uint64)
        powers[0] = 1
        found.append(np.multiply.accumulate(powers))
    return found[0], found[1]


def _word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the words of a piece; ASCII letters count as lower case."""
    import xxhash

    data = np.frombuffer(raw, np.uint8)
    gap = np.ones(len(data) + 2, bool)
    gap[1:-1] = _SPACE[data]
    first, last = (np.flatnonzero(x) for x in (gap[:-1] & ~gap[1:], ~gap[:-1] & gap[1:]))
    if len(data) > _PIECE:
        # One word, without a gap to cut at.
        return first, np.array([xxhash.xxh64_intdigest(raw.strip().lower())], np.uint64)
    powers, back = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[: len(data)], out=sums[1:])
    size = last - first
    hashes = _mixed((sums[last] - sums[first]) * back[first] + size.astype(np.uint64))
    for i in np.flatnonzero(size > _LONG).tolist():
        hashes[i] = xxhash.xxh64_intdigest(raw[first[i] : last[i]].lower())
    return first, hashes


def _pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """Parts of at most ``_PIECE`` bytes, or one word each."""
    at = 0
    while len(raw) - at > _PIECE:
        cut = max(raw.rfind(g, at, at + _PIECE) for g in (b" ", b"\n", b"\t", b"\x0b", b"\x0c", b"\r"))
        if cut <= at:
            found = _GAP.search(raw, at + 1)
            cut = found.start() if found else len(raw)
        yield at, raw[at:cut]
        at = cut
    yield at, raw[at:]


def _shingles(h: np.ndarray, width: int) -> np.ndarray:
    total = np.full(max(0, len(h) - width + 1), np.uint64(width))
    for i in range(width):
        total = (total ^ h[i : i + len(total)]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return _mixed(total)


def shingle_sets(texts: list[str | None], size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes.

    ASCII letters are lower-cased. With fewer words the whole sequence is the only shingle;
    without words there is none.
    """
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    starts = np.cumsum([0, *(len(r) + 1 for r in raws)])
    parts = [(at + first, h) for at, piece in _pieces(b"\n".join(raws))
             for first, h in [_word_hashes(piece)]]
    places, hashes = (np.concatenate(x) for x in zip(*parts, strict=True))
    bounds = np.searchsorted(places, starts).tolist()
    whole = _shingles(hashes, size)
    found = []
    for a, b in itertools.pairwise(bounds):
        if b - a >= size:
            found.append(np.unique(whole[a : b - size + 1]))
        else:
            found.append(_shingles(hashes[a:b], b - a) if b > a else hashes[:0])
    return found


def _named(docs: DataFrame) -> DataFrame:
    tag = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select("doc_id", "text", tag.alias("__tag"))


def _with_sets(batch: pa.RecordBatch, shingle: int):
    """(rows of a batch, their sets), about a megabyte of text at a time."""
    for at, texts in slices(batch.column("text")):
        yield batch.slice(at, len(texts)), shingle_sets(texts, shingle)


def _marks(batches, shingle: int) -> Iterator[pa.RecordBatch]:
    """A row per document, and at the end the task's counts of shingles, a row per slice."""
    counter = Counter()
    names = ["doc_id", "__tag", "id", "n", "slice", "counts"]
    kind = None
    for whole in batches:
        kind = whole.column("doc_id").type
        for batch, sets in _with_sets(whole, shingle):
            digests = [_digest(s) if len(s) else None for s in sets]
            counter.add(np.concatenate(sets))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("__tag"),
                    pa.array(digests, pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.nulls(len(batch), pa.int32()),
                    pa.nulls(len(batch), pa.binary()),
                ],
                names=names,
            )
    if kind is not None:
        used, counts = counter.slices()
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(used), kind),
                pa.nulls(len(used), pa.int64()),
                pa.nulls(len(used), pa.binary()),
                pa.nulls(len(used), pa.int64()),
                pa.array(used, pa.int32()),
                pa.array(counts, pa.binary()),
            ],
            names=names,
        )


def _digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def bitmap(values: np.ndarray) -> bytes:
    """A set's signature: a bit for each shingle, four bits at least for every shingle."""
    width = max(64, 1 << (4 * len(values) - 1).bit_length())
    bits = np.zeros(width, bool)
    bits[(values & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def rarest(values: np.ndarray, table: np.ndarray, percent: int) -> np.ndarray:
    """So many of the rarest shingles that two linked sets share ``shared_by`` of them.

    They have ``percent * n / 100`` in common at least.
    """
    n = len(values)
    listed = n - -(-percent * n // 100) + shared_by(percent)
    return values[np.lexsort((values, table[buckets(values)]))[:listed]]


def shared_by(percent: int) -> int:
    """Sets that are linked and differ have ``percent`` in common for each ``100 - percent``."""
    return max(1, min(SHARED, percent // max(1, 100 - percent)))


def _signed(batches, table: np.ndarray, shingle: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Each class's size, signature, place in the tree and rarest shingles."""
    for whole in batches:
        for _, sets in _with_sets(whole, shingle):
            out: list[tuple] = []
            for values in sets:
                near = int(_mixed(values ^ np.uint64(0x5851F42D4C957F2D)).min() >> np.uint64(1))
                listed = rarest(values, table, percent).view(np.int64).tolist()
                out.append((_digest(values), len(values), bitmap(values), near, listed))
            ids, n, bits, near, listed = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.binary()),
                    pa.array(n, pa.int64()),
                    pa.array(bits, pa.binary()),
                    pa.array(near, pa.int64()),
                    pa.array(listed, pa.list_(pa.int64())),
                ],
                names=["id", "n", "bits", "near", "listed"],
            )


def _whole(batches, shingle: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for _, sets in _with_sets(whole, shingle):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_digest(s) for s in sets], pa.binary()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                names=["id", "shingles"],
            )


# --- groups ----------------------------------------------------------------------------------


def _groups(batches, percent: int, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows with one shingle whose sizes follow closely: their members' ids in one value.

    Of a run of more than ``most`` each row is passed on by itself, with what names the run.
    """
    names = ["members", "shingle", "first", "id"]
    held = None
    passing: tuple[int, int] | None = None
    for batch in batches:
        rows = [
            batch.column("shingle").to_numpy(),
            batch.column("n").to_numpy(),
            np.frombuffer(b"".join(batch.column("id").to_pylist()), "V16"),
        ]
        if not len(rows[0]):
            continue
        if held is not None:
            rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
        shingles, n, ids = rows
        apart = (shingles[1:] != shingles[:-1]) | (100 * n[:-1] < percent * n[1:])
        bounds = [0, *(np.flatnonzero(apart) + 1).tolist(), len(n)]
        members: list[bytes] = []
        alone: list[tuple] = []
        for a, b in _complete(bounds):
            if passing and a == 0:
                # The held row has been passed on already.
                alone += [(*passing, i.tobytes()) for i in ids[1:b]]
                passing = None
            elif b - a <= most:
                members.append(ids[a:b].tobytes())
            else:
                alone += [(int(shingles[a]), int(n[a]), i.tobytes()) for i in ids[a:b]]
        last = bounds[-2]
        if passing and last == 0:
            alone += [(*passing, i.tobytes()) for i in ids[1:]]
            last = len(n) - 1
        elif len(n) - last > most:
            passing = (int(shingles[last]), int(n[last]))
            alone += [(*passing, i.tobytes()) for i in ids[last:]]
            last = len(n) - 1
        else:
            passing = None
        held = [x[last:] for x in rows]
        yield from _emitted(members, alone, names)
    if held is not None and not passing and len(held[0]) > 1:
        yield from _emitted([held[2].tobytes()], [], names)


def _all_pairs(batches) -> Iterator[pa.RecordBatch]:
    """The pairs of members of groups of up to ``FEW``, as two ids in one value."""
    for batch in batches:
        pairs = []
        for members in batch.column("members").to_pylist():
            ids = sorted({members[i : i + 16] for i in range(0, len(members), 16)})
            pairs += [a + b for a, b in itertools.combinations(ids, 2)]
        yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.binary())], names=["tree"])


def _complete(bounds: list[int]) -> Iterator[tuple[int, int]]:
    """All runs of two rows or more but the last one, and the first one whatever its length."""
    ends = np.array(bounds)
    many = np.flatnonzero(np.diff(ends[:-1]) > 1).tolist()
    if len(bounds) > 2 and (not many or many[0] != 0):
        many = [0, *many]
    for i in many:
        yield bounds[i], bounds[i + 1]


def _emitted(members, alone, names) -> Iterator[pa.RecordBatch]:
    members = [m for m in members if len(m) > 16]
    if not members and not alone:
        return
    k = len(members)
    shingles, first, ids = zip(*alone, strict=True) if alone else ((), (), ())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([*members, *[None] * len(alone)], pa.binary()),
            pa.array([*[None] * k, *shingles], pa.int64()),
            pa.array([*[None] * k, *first], pa.int64()),
            pa.array([*[None] * k, *ids], pa.binary()),
        ],
        names=names,
    )


def _trees(signed: DataFrame, percent: int, most: int) -> DataFrame:
    """(tree, id): which sets meet in which trees; each pair that may be linked meets in one."""
    listed = signed.select(F.explode("listed").alias("shingle"), "n", "id")
    runs = settle(
        listed.repartition("shingle")
        .sortWithinPartitions("shingle", "n", "id")
        .mapInArrow(
            partial(_groups, percent=percent, most=most),
            "members binary, shingle long, first long, id binary",
        )
    )
    lists = runs.where("members IS NOT NULL").select("members")
    # Sets that share a few rare shingles by chance meet in few groups, and nowhere else.
    few = F.length("members") <= 16 * FEW
    met = lists.where(few).mapInArrow(_all_pairs, "tree binary").groupBy("tree").count()
    pairs = met.where(F.col("count") >= shared_by(percent)).select(F.col("tree").alias("members"))
    # Near copies list the same shingles, so many of the other groups are equal.
    small = pairs.unionByName(lists.where(~few).distinct())
    each = F.expr(
        """explode(transform(sequence(0, length(members) DIV 16 - 1),
                             i -> substring(members, 16 * i + 1, 16)))"""
    )
    small = small.select(F.md5("members").alias("tree"), each.alias("id"))
    # A larger group's rows go to blocks, and every two blocks make a tree.
    large = runs.where("members IS NULL").select("shingle", "first", "id")
    blocks = large.groupBy("shingle", "first").agg(
        F.ceil(F.count("*") * 2 / most).cast("int").alias("blocks")
    )
    dealt = large.join(broadcast_when_small(settle(blocks)), ["shingle", "first"]).withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    )
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = F.concat_ws(
        ".", "shingle", "first", F.least("own", "other"), F.greatest("own", "other")
    )
    return small.unionByName(dealt.select(pair.alias("tree"), "id"))


# --- trees -----------------------------------------------------------------------------------


class Tree:
    """Signatures of one width with their sizes, in an order that puts similar ones together."""

    def __init__(self, bits: np.ndarray, n: np.ndarray, labels: np.ndarray, percent: int):
        self.percent = percent
        slack = n - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        self.levels = [(bits, n, n, slack, labels, labels)]
        while len(self.levels[-1][1]) > 1:
            self.levels.append(self._above(*self.levels[-1]))

    @staticmethod
    def _above(bits, low, high, slack, least, most):
        starts = np.arange(0, len(low), FAN_OUT)
        return (
            np.bitwise_or.reduceat(bits, starts),
            np.minimum.reduceat(low, starts),
            np.maximum.reduceat(high, starts),
            np.maximum.reduceat(slack, starts),
            np.minimum.reduceat(least, starts),
            np.maximum.reduceat(most, starts),
        )

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of different labels that may be linked, by traversal of pairs of nodes."""
        a = b = np.zeros(1, np.int64)
        for level in range(len(self.levels) - 2, -1, -1):
            found = []
            step = 1 << 16
            for at in range(0, len(a), step):
                found.append(self._below(level, a[at : at + step], b[at : at + step]))
            if not found:
                break
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
        if len(self.levels) == 1:
            return a[:0], b[:0]
        return a, b

    def _below(self, level: int, a: np.ndarray, b: np.ndarray):
        """The children of the pairs of nodes that may hold a link."""
        bits, low, high, slack, least, most = self.levels[level]
        child = np.arange(FAN_OUT)
        i = (FAN_OUT * a[:, None] + np.repeat(child, FAN_OUT)).reshape(-1)
        j = (FAN_OUT * b[:, None] + np.tile(child, FAN_OUT)).reshape(-1)
        keep = (i < len(low)) & (j < len(low)) & (i < j if not level else i <= j)
        i, j = i[keep], j[keep]
        keep = (self.percent * low[i] <= 100 * high[j]) & (self.percent * low[j] <= 100 * high[i])
        # Sets that are connected already are of no interest.
        keep &= (least[i] != most[i]) | (least[j] != most[j]) | (least[i] != least[j])
        i, j = i[keep], j[keep]
        keep = np.zeros(len(i), bool)
        step = max(1, _WORDS // bits.shape[1])
        for at in range(0, len(i), step):
            p, q = i[at : at + step], j[at : at + step]
            shared = np.bitwise_count(bits[p] & bits[q]).sum(axis=1, dtype=np.int64)
            largest = shared + np.minimum(slack[p], slack[q])
            needed = self.percent * (low[p] + low[q])
            keep[at : at + step] = (100 + self.percent) * largest >= needed
        return i[keep], j[keep]

    def most_alike(self) -> int:
        """The row whose bits the rows have in common the most, for its size."""
        bits = self.levels[0][0]
        votes = np.zeros(bits.shape[1] * 64, np.int64)
        raw = bits.view(np.uint8)
        for at in range(0, len(raw), 64):
            votes += np.unpackbits(raw[at : at + 64], axis=1, bitorder="little").sum(
                axis=0, dtype=np.int64
            )
        scores = np.empty(len(raw))
        for at in range(0, len(raw), 64):
            own = np.unpackbits(raw[at : at + 64], axis=1, bitorder="little")
            shared = own @ votes
            scores[at : at + 64] = shared / (own.sum(axis=1) * len(raw) + votes.sum() - shared)
        return int(scores.argmax())


def trees_of(rows: list[tuple], percent: int) -> Iterator[tuple[list[tuple], Tree]]:
    """One tree for each width of signatures, with the sets of the next width that are near."""
    for width in sorted({len(r[2]) for r in rows}):
        own = [r for r in rows if len(r[2]) == width]
        reach = 100 * max(r[1] for r in own)
        own += [r for r in rows if len(r[2]) == 2 * width and percent * r[1] <= reach]
        if len(own) < 2:
            continue
        own.sort(key=lambda r: (r[3], r[1], r[0]))
        bits = np.stack([_folded(r[2], width) for r in own]).view(np.uint64)
        n = np.array([r[1] for r in own], np.int64)
        labels = np.array([r[4] for r in own], np.int64)
        yield own, Tree(bits, n, labels, percent)


def _folded(bits: bytes, width: int) -> np.ndarray:
    found = np.frombuffer(bits, np.uint8)
    while len(found) > width:
        found = found[: len(found) // 2] | found[len(found) // 2 :]
    return found


def _candidates(batches, percent: int, star: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of each tree: with its most typical row, or all that the traversal leaves."""

    def found(rows: list[tuple]) -> list[tuple[bytes, bytes]]:
        # A set that is dealt to a tree twice, or rows of equal documents, count once.
        rows = list({r[0]: r for r in rows}.values())
        if len(rows) == 2:
            x, y = sorted(rows)
            return [(x[0], y[0])] if x[4] != y[4] and _may_link(x, y, percent) else []
        pairs = []
        for own, tree in trees_of(rows, percent):
            if star and len(own) > 2:
                centre = tree.most_alike()
                others = np.delete(np.arange(len(own)), centre)
                a, b = np.minimum(others, centre), np.maximum(others, centre)
                a, b = _near(tree, a, b)
            else:
                a, b = tree.pairs()
            pairs += [(own[i][0], own[j][0]) for i, j in zip(a.tolist(), b.tolist(), strict=True)]
        return [(min(p), max(p)) for p in pairs]

    current, rows, pairs = None, [], []
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("tree", "id", "n", "bits", "near", "label")]
        for tree, *row in zip(*columns, strict=True):
            if tree != current:
                if len(rows) > 1:
                    pairs += found(rows)
                current, rows = tree, []
            rows.append(tuple(row))
        if len(pairs) > 10_000:
            yield _of_pairs(pairs)
            pairs = []
    if len(rows) > 1:
        pairs += found(rows)
    if pairs:
        yield _of_pairs(pairs)


def _may_link(x: tuple, y: tuple, percent: int) -> bool:
    """The bound of a tree's rows for two sets alone."""
    width = min(len(x[2]), len(y[2]))
    p, q = (int.from_bytes(_folded(r[2], width).tobytes(), "little") for r in (x, y))
    slack = min(x[1] - p.bit_count(), y[1] - q.bit_count())
    largest = min((p & q).bit_count() + slack, x[1], y[1])
    return (100 + percent) * largest >= percent * (x[1] + y[1])


def _near(tree: Tree, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bits, n, _, slack, *_ = tree.levels[0]
    shared = np.bitwise_count(bits[a] & bits[b]).sum(axis=1, dtype=np.int64)
    largest = np.minimum(shared + np.minimum(slack[a], slack[b]), np.minimum(n[a], n[b]))
    keep = (100 + tree.percent) * largest >= tree.percent * (n[a] + n[b])
    return a[keep], b[keep]


def _of_pairs(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"]
    )


# --- the join --------------------------------------------------------------------------------


def _verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b): those of the distinct pairs whose sets have enough in common, by comparing them whole."""
    wanted = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "__id")
    some = texts.join(broadcast_when_small(settle(wanted)), F.col("id") == F.col("__id"), "left_semi")
    sets = settle(
        some.select("text").mapInArrow(
            partial(_whole, shingle=shingle), "id binary, shingles array<long>"
        ).dropDuplicates(["id"])
    )
    for side in ("a", "b"):
        own = sets.select(F.col("id").alias(side), F.col("shingles").alias(f"of_{side}"))
        pairs = pairs.join(own, side)
    both = F.size(F.array_intersect("of_a", "of_b"))
    enough = (100 + percent) * both >= percent * (F.size("of_a") + F.size("of_b"))
    return settle(pairs.where(enough).select("a", "b"))


def links(
    docs: DataFrame, marks: DataFrame, shingle: int, percent: int, most: int
) -> DataFrame:
    """Links (a, b) between classes that connect all that are linked at all."""
    table = summed(marks.where("slice IS NOT NULL"))
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("d"), F.col("__tag").alias("t"))
    names = (
        marks.where("id IS NOT NULL").groupBy("id").agg(F.min(first).alias("f"))
        .select("id", F.col("f.d").alias("__doc"), F.col("f.t").alias("__named"))
    )
    names = settle(names)
    texts = _named(docs).join(broadcast_when_small(names), F.expr(_NAME)).select("id", "text")
    signed = texts.select("text").mapInArrow(
        partial(_signed, table=table, shingle=shingle, percent=percent),
        "id binary, n long, bits binary, near long, listed array<long>",
    )
    signed = settle(signed)
    if signed.count() > names.count():
        # Rows equal in doc_id and text share a name.
        signed = settle(signed.dropDuplicates(["id"]))
    trees = _trees(signed, percent, most)
    trees = settle(trees)
    wanted = broadcast_when_small(settle(trees.select("id").distinct()))
    signatures = signed.select("id", "n", "bits", "near").join(wanted, "id", "left_semi")
    rows = settle(trees.join(signatures, "id"))
    apart = F.xxhash64("id").alias("label")
    star = settle(_pairs(rows.select("*", apart), percent, star=True).distinct())
    known = _verified(star, texts, shingle, percent)
    joined = components(known)
    roots = joined.select(F.col("node").alias("id"), "root")
    label = F.xxhash64(F.coalesce("root", "id")).alias("label")
    labelled = rows.join(broadcast_when_small(settle(roots)), "id", "left").select(*rows.columns, label)
    open_ = settle(
        labelled.groupBy("tree")
        .agg(F.min("label").alias("l"), F.max("label").alias("m"), F.count("*").alias("k"))
        .where("l <> m AND k > 2")
        .select("tree")
    )
    left = labelled.join(broadcast_when_small(open_), "tree", "left_semi")
    more = _pairs(left, percent, star=False).distinct().join(star, ["a", "b"], "left_anti")
    return known.unionByName(_verified(settle(more), texts, shingle, percent))


def _pairs(rows: DataFrame, percent: int, star: bool) -> DataFrame:
    dealt = rows.repartition("tree").sortWithinPartitions("tree")
    return dealt.mapInArrow(
        partial(_candidates, percent=percent, star=star), "a binary, b binary"
    )


def jaccard_components(
    docs: DataFrame, *, shingle: int = SHINGLE, percent: int = PERCENT, most: int = MOST
) -> DataFrame:
    """Documents with their set's size and the component of links they are in.

    Input: ``doc_id``, ``text`` and any other columns. Result: ``doc_id``, ``n_shingles`` (distinct
    shingles of ``shingle`` words) and ``component_id`` (the smallest ``doc_id`` that links reach).
    Two documents are linked if ``100 * |intersection| >= percent * |union|`` of their sets.

    Null and empty texts and those of white space have no shingles and are linked with nothing,
    not even with each other. Equal sets are linked. A null ``doc_id`` counts only where nothing
    else is reachable: ``component_id`` is then null. Repeated rows stay. An empty table gives no
    rows. ``most`` bounds a tree; the result does not depend on it.
    """
    marks = settle(
        _named(docs).mapInArrow(
            partial(_marks, shingle=shingle),
            f"""doc_id {docs.schema["doc_id"].dataType.simpleString()}, __tag long, id binary,
                n long, slice int, counts binary""",
        )
    )
    rows = marks.where("slice IS NULL").select("doc_id", "__tag", "id", "n")
    classes = rows.where("id IS NOT NULL").groupBy("id").agg(F.min("doc_id").alias("least"))
    found = components(links(docs, marks, shingle, percent, most))
    reached = (
        found.join(classes, found["node"] == classes["id"])
        .groupBy("root")
        .agg(F.min("least").alias("reached"))
    )
    roots = found.join(reached, "root").select(F.col("node").alias("id"), "reached")
    named = classes.join(roots, "id", "left").select("id", F.coalesce("reached", "least").alias("c"))
    component: Column = F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("c"))
    return rows.join(broadcast_when_small(settle(named)), "id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )
