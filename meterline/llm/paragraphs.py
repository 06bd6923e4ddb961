"""Repeated paragraphs through MinHash banding.

A paragraph is a line of at least ``MIN_WORDS`` words, or as many words of consecutive shorter
lines up to a blank one. Equal ones (same words) are collapsed first. The MinHash of the five-word shingles of each distinct paragraph is cut into bands; those
that share a band are candidates, and candidates are linked if their exact Jaccard similarity or
their edit similarity in words is 0.8 or more. Links make components, of which the first paragraph
stays in its document.

Jaccard alone would cut a large group of copies with a few typos each into thousands of parts that
all have to be compared with each other: two typos in ninety words already leave less than 0.8.

In what is left, every run of ``PASSAGE`` words that stands anywhere earlier goes too, wherever it
begins and over line ends. Windows of ``ANCHOR`` words are picked by their content so that each
such run holds at least one; only runs around a window that occurs again are compared.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

from meterline.llm.common import SPACES, give_back, settle
from meterline.llm.components import components
from meterline.llm.counts import Counter, buckets, summed
from meterline.plans.sizing import broadcast_when_small

MIN_WORDS = 40
SHINGLE = 5
SIMILAR = 0.8
# A pair at 0.8 shares one of 16 bands of 4 with probability 1 - (1 - 0.8**4)**16 > 0.9997.
BANDS, ROWS = 16, 4
# The smallest of PASSAGE - ANCHOR + 1 neighbouring windows is picked: all that a passage holds.
PASSAGE, ANCHOR = 50, 25
_WORD = re.compile(rb"\S+")
# Where words of a line are not joined by single spaces already.
_SPACING = (b"  ", b" \n", b"\n ", b"\t", b"\r", b"\x0b", b"\x0c")

_FOUND = "para integer, first_word integer, n_words integer, digest binary"


def lines_of(text: str | None, least: int = MIN_WORDS) -> list[tuple[int, int, int, bytes]]:
    """(line number, number of the first word in the text, words, joined words) of each paragraph."""
    found = []
    line_at = first = number = 0
    joined: list[bytes] = []
    at = 0
    whole = b"\n" + (text or "").encode("utf-8", "surrogatepass") + b"\n"
    plain = not any(map(whole.__contains__, _SPACING))
    for i, raw in enumerate(whole[1:-1].split(b"\n")):
        line = raw if plain else b" ".join(raw.split())
        n = line.count(b" ") + 1 if line else 0
        if n and n < least:
            if not joined:
                line_at, first = i, at
            joined.append(line)
            number += n
        else:
            if number >= least and joined:
                found.append((line_at, first, number, b" ".join(joined)))
            joined, number = [], 0
            if n:
                found.append((i, at, n, line))
        at += n
    if number >= least and joined:
        found.append((line_at, first, number, b" ".join(joined)))
    return found


def units_of(text: str | None, least: int = MIN_WORDS) -> list[tuple[int, int, list[bytes]]]:
    """(line number, number of the first word in the text, words) of each paragraph."""
    return [(i, first, line.split(b" ")) for i, first, _, line in lines_of(text, least)]


def paragraphs_of(text: str | None, least: int = MIN_WORDS) -> list[tuple[int, list[bytes]]]:
    """(line number, words) of each paragraph with at least ``least`` words."""
    return [(line, words) for line, _, words in units_of(text, least)]


def shingle_hashes(words: list[bytes], size: int = SHINGLE) -> np.ndarray:
    """64-bit hashes of the windows of ``size`` words (fewer words: of all), repeats included."""
    import xxhash

    line = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(line)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    starts = [0, *ends[:-size]]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a : b - 1]) for a, b in zip(starts, ends[size - 1 :], strict=True)]
    return np.array(hashes, np.uint64)


def shingles_of(line: bytes, size: int = SHINGLE) -> set[tuple[bytes, ...]]:
    """The distinct windows of ``size`` words themselves (fewer words: all)."""
    words = line.split(b" ")
    return set(zip(*(words[i:] for i in range(min(size, len(words))))))


def edit_distance(a: list[bytes], b: list[bytes]) -> int:
    """Words to insert, delete or replace; one row of the table is two integers' bits."""
    if not a or not b:
        return max(len(a), len(b))
    places: dict[bytes, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    every, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, distance = every, 0, len(a)
    for word in b:
        same = places.get(word, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right, left = down | (every & ~(diagonal | up)), up & diagonal
        distance += bool(right & last) - bool(left & last)
        right, left = (right << 1 | 1) & every, (left << 1) & every
        up, down = left | (every & ~(diagonal | right)), right & diagonal
    return distance


def similarity(a: bytes, b: bytes, of_a: set, of_b: set, edits: bool = True) -> float:
    """The larger of the exact Jaccard similarity and, if that is too low, of the edit one."""
    both = len(of_a & of_b)
    jaccard = both / (len(of_a) + len(of_b) - both)
    if jaccard >= SIMILAR or not edits:
        return jaccard
    words = a.split(b" "), b.split(b" ")
    longer = max(map(len, words))
    if min(map(len, words)) < SIMILAR * longer:
        return jaccard
    return max(jaccard, 1 - edit_distance(*words) / longer)


def min_hash(
    values: np.ndarray, factors: np.ndarray, shifts: np.ndarray, begins: np.ndarray | None = None
) -> np.ndarray:
    """The smallest hash of a set under each of several hash functions (64-bit wrapping).

    With ``begins``, a row for each of the sets that lie one after the other and begin there.
    """
    first = [0] if begins is None else begins
    own = values ^ (values >> np.uint64(29))
    mixed, upper = np.empty_like(own), np.empty_like(own)
    low = np.empty((len(first), len(factors)), np.uint64)
    for i, (factor, shift) in enumerate(zip(factors, shifts, strict=True)):
        np.multiply(own, factor, out=mixed)
        mixed += shift
        mixed ^= np.right_shift(mixed, np.uint64(32), out=upper)
        mixed *= np.uint64(0x9E3779B97F4A7C15)
        low[:, i] = np.minimum.reduceat(mixed, first)
    return low[0] if begins is None else low


def joined_hashes(
    lines: bytes, starts: np.ndarray, ends: np.ndarray, base: int = 0x9E3779B97F4A7C15
) -> np.ndarray:
    """64-bit hashes of the byte ranges from ``starts`` to ``ends``, equal for equal bytes."""
    powers, back = _powers(1 << max(16, len(lines).bit_length()), base)
    sums = np.zeros(len(lines) + 1, np.uint64)
    values = np.frombuffer(lines, np.uint8).astype(np.uint64)
    np.cumsum((values + np.uint64(1)) * powers[: len(lines)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * back[starts]
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return hashes ^ (hashes >> np.uint64(29))


@lru_cache(maxsize=1)
def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse (64-bit wrapping), from 0."""
    both = []
    for number in (base, pow(base, -1, 1 << 64)):
        powers = np.full(n, number, np.uint64)
        powers[0] = 1
        both.append(np.multiply.accumulate(powers))
    return both[0], both[1]


def _hash_functions() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240229)
    factors = random.integers(1, 1 << 32, BANDS * ROWS, np.uint64) | np.uint64(1)
    return factors, random.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def bands_of(lines: list[bytes], functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One number per paragraph and band of its MinHash; the band's own number is mixed into it.

    Paragraphs are words joined by single spaces. Their windows of ``SHINGLE`` words (fewer words:
    all) are hashed for all of them at once.
    """
    import xxhash

    whole = b"\n".join(lines) + b"\n"
    raw = np.frombuffer(whole, np.uint8)
    ends = np.flatnonzero((raw == 32) | (raw == 10))
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = np.flatnonzero(raw[ends] == 10)
    words = np.diff(last, prepend=-1)
    number = np.maximum(words - SHINGLE + 1, 1)
    begins = np.cumsum(number) - number
    at = np.arange(number.sum()) + np.repeat(last - words + 1 - begins, number)
    to = np.minimum(at + SHINGLE - 1, np.repeat(last, number))
    places = zip(starts[at].tolist(), ends[to].tolist(), strict=True)
    hashes = b"".join([xxhash.xxh64_digest(whole[a:b]) for a, b in places])
    values = np.frombuffer(hashes, ">u8").astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    low = min_hash(values, *functions, begins)
    for r in range(ROWS):
        key = (key ^ low[:, r::ROWS]) * np.uint64(0x100000001B3)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


def band_keys(words: list[bytes], functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The bands of one paragraph."""
    return bands_of([b" ".join(words)], functions)[0]


def found_paragraphs(
    docs: DataFrame, keys: list[str], least: int = MIN_WORDS, extra: str | None = None
) -> DataFrame:
    """(keys, para, first_word, n_words, digest) of every paragraph of every whole text.

    ``extra`` adds its ``bands`` or its words as one ``line``.
    """
    schema = docs.select(*keys).schema
    for column in _FOUND.split(", "):
        schema = schema.add(*column.split())
    if extra:
        schema = schema.add(extra, ArrayType(LongType()) if extra == "bands" else BinaryType())
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        functions = _hash_functions()
        for batch in batches:
            texts = batch.column("__text")
            for first in range(0, len(texts), 500):
                at, para, places, n, digests, more = [], [], [], [], [], []
                for i, cell in enumerate(texts.slice(first, 500)):
                    for number, place, size, line in lines_of(cell.as_py(), least):
                        at.append(first + i)
                        para.append(number)
                        places.append(place)
                        n.append(size)
                        digests.append(hashlib.md5(line).digest())
                        if extra:
                            more.append(line)
                if at:
                    columns = [batch.column(c).take(pa.array(at)) for c in keys]
                    columns += [pa.array(x, pa.int32()) for x in (para, places, n)]
                    columns.append(pa.array(digests, pa.binary()))
                    if extra == "bands":
                        found = [bands_of(some, functions) for some in _runs(more)]
                        flat = pa.array(np.concatenate(found).reshape(-1))
                        offsets = pa.array(np.arange(0, len(flat) + 1, BANDS), pa.int32())
                        columns.append(pa.ListArray.from_arrays(offsets, flat))
                    elif extra:
                        columns.append(pa.array(more, pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        give_back()

    return docs.select(*keys, F.col("text").alias("__text")).mapInArrow(run, schema)


def _runs(lines: list[bytes], size: int = 1 << 17) -> Iterator[list[bytes]]:
    """Neighbouring lines of about ``size`` bytes together."""
    first = total = 0
    for i, line in enumerate(lines):
        total += len(line)
        if total >= size:
            yield lines[first : i + 1]
            first, total = i + 1, 0
    if first < len(lines):
        yield lines[first:]


def similar_pairs(
    distinct: DataFrame, lines: DataFrame, similar: float = SIMILAR, edits: bool = True
) -> DataFrame:
    """Links (a, b) that connect all similar candidates among distinct paragraphs.

    ``distinct`` has their ``digest`` and ``bands``; ``lines`` has ``digest`` and ``line`` of all
    paragraphs, of which only those that share a band are kept. Everything in a band is compared
    with the band's centre, the paragraph whose bands are the fullest; what is not similar to it,
    with what lists one of its rarest shingles or words too (``_left_pairs``). Two paragraphs both
    similar to the centre are connected through it, so no link between components is lost, and a
    large cluster costs one comparison per paragraph instead of one per pair. Without ``edits`` Jaccard similarity alone counts.
    """
    bands = distinct.select("digest", F.explode("bands").alias("band"))
    shared = settle(bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1"))
    members = settle(bands.join(broadcast_when_small(shared), "band"))
    wanted = settle(members.select("digest").distinct())
    sets = settle(
        lines.join(broadcast_when_small(wanted), "digest", "left_semi").dropDuplicates(["digest"])
    )
    weight = members.groupBy("digest").agg(F.sum("n").alias("weight"))
    centre = (
        members.join(weight, "digest")
        .groupBy("band")
        .agg(F.max(F.struct("weight", "digest"))["digest"].alias("centre"))
    )
    near = members.join(centre, "band").where("digest <> centre")
    pairs = near.select(F.col("centre").alias("a"), F.col("digest").alias("b"))
    first = settle(_verified(pairs, sets, edits))
    linked = first.where(F.col("similarity") >= similar).select("a", "b")
    known = linked.select(F.col("a").alias("centre"), F.col("b").alias("digest"))
    apart = settle(near.join(known, ["centre", "digest"], "left_anti").select("band", "digest"))
    second = settle(_left_pairs(distinct, members, apart, sets, linked, similar, edits))
    rest = second.join(first.select("a", "b"), ["a", "b"], "left_anti")
    second = _verified(rest, sets, edits).where(F.col("similarity") >= similar)
    return linked.unionByName(second.select("a", "b"))


def _left_pairs(
    distinct: DataFrame,
    members: DataFrame,
    apart: DataFrame,
    sets: DataFrame,
    linked: DataFrame,
    similar: float,
    edits: bool,
) -> DataFrame:
    """(a, b): candidates among paragraphs that a band's centre has not connected.

    Different paragraphs that share filler collide in great numbers. So each lists its rarest
    shingles, as many as two similar ones must share one of; filler, which is common, is not among
    them. Edits are words, so for these it lists its rarest words, numbered by occurrence. Only
    what lists the same, shares a band and is not connected yet is paired.
    """
    wanted = members.join(broadcast_when_small(settle(apart.select("band").distinct())), "band")
    wanted = settle(wanted.select("digest").distinct())
    lines = sets.join(broadcast_when_small(wanted), "digest", "left_semi")
    counts = lines.select("line").mapInArrow(
        partial(_token_counts, edits=edits), "slice int, counts binary"
    )
    listed = lines.select("digest", "line").mapInArrow(
        partial(_rarest, table=summed(counts), similar=similar, edits=edits),
        "digest binary, n int, token long",
    )
    label = F.coalesce("root", "digest").alias("label")
    roots = components(linked).select(F.col("node").alias("digest"), "root")
    rows = listed.join(broadcast_when_small(settle(roots)), "digest", "left").select(
        "digest", "n", "token", label
    )
    alone = apart.select("digest").distinct().withColumn("apart", F.lit(True))
    rows = settle(rows.join(broadcast_when_small(settle(alone)), "digest", "left"))
    # A token that only one component lists joins nothing.
    mixed = (
        rows.groupBy("token")
        .agg(F.min("label").alias("l"), F.max("label").alias("m"), F.max("apart").alias("any"))
        .where("l <> m AND any")
        .select("token")
    )
    rows = rows.join(mixed, "token").join(distinct.select("digest", "bands"), "digest")
    rows = settle(rows)
    one = rows.where("apart").select(
        "token",
        F.col("digest").alias("a"),
        F.col("n").alias("na"),
        F.col("label").alias("la"),
        F.col("bands").alias("ba"),
    )
    other = rows.select(
        "token",
        F.col("digest").alias("b"),
        F.col("n").alias("nb"),
        F.col("label").alias("lb"),
        F.col("bands").alias("bb"),
    )
    near = F.arrays_overlap("ba", "bb") & (F.col("na") >= similar * F.col("nb")) & (F.col("nb") >= similar * F.col("na"))
    return (
        one.join(other, "token")
        .where((F.col("la") != F.col("lb")) & near)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def _tokens(line: bytes, edits: bool) -> list[np.ndarray]:
    """Hashes of a paragraph's shingles and, for edits, of its words numbered by occurrence."""
    import xxhash

    words = line.split(b" ")
    found = [np.unique(shingle_hashes(words))]
    if edits:
        seen: dict[bytes, int] = {}
        hashes = []
        for word in words:
            seen[word] = seen.get(word, 0) + 1
            hashes.append(xxhash.xxh64_intdigest(word, seen[word]))
        found.append(np.array(hashes, np.uint64))
    return found


def _token_counts(batches, edits: bool) -> Iterator[pa.RecordBatch]:
    counter = Counter()
    for batch in batches:
        for line in batch.column("line"):
            for hashes in _tokens(line.as_py(), edits):
                counter.add(hashes)
    numbers, counts = counter.slices()
    yield pa.RecordBatch.from_arrays(
        [pa.array(numbers, pa.int32()), pa.array(counts, pa.binary())], names=["slice", "counts"]
    )


def _rarest(batches, table: np.ndarray, similar: float, edits: bool) -> Iterator[pa.RecordBatch]:
    """(digest, n, token): of each list of n hashes the rarest that two similar ones must share."""
    for batch in batches:
        for at in range(0, len(batch), 500):
            rows, sizes, tokens = [], [], []
            for i, line in enumerate(batch.column("line").slice(at, 500)):
                for kind, hashes in enumerate(_tokens(line.as_py(), edits)):
                    n = len(hashes)
                    take = n - math.ceil(similar * n - 1e-9) + 1
                    rare = hashes[np.lexsort((hashes, table[buckets(hashes)]))[:take]]
                    rows += [at + i] * len(rare)
                    sizes += [n] * len(rare)
                    # Shingles and words must not meet.
                    tokens.append((rare ^ np.uint64(kind * 0x9E3779B97F4A7C15)).view(np.int64))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("digest").take(pa.array(rows)),
                        pa.array(sizes, pa.int32()),
                        pa.array(np.concatenate(tokens)),
                    ],
                    names=["digest", "n", "token"],
                )


def _verified(pairs: DataFrame, sets: DataFrame, edits: bool) -> DataFrame:
    """The exact ``similarity`` of each distinct pair (a, b)."""
    pairs = pairs.distinct()
    for side in ("a", "b"):
        own = sets.select(F.col("digest").alias(side), F.col("line").alias(f"of_{side}"))
        pairs = pairs.join(own, side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            last, p = None, set()
            for x, y in zip(batch.column("of_a"), batch.column("of_b"), strict=True):
                x, y = x.as_py(), y.as_py()
                if x != last:
                    last, p = x, shingles_of(x)
                found.append(similarity(x, y, p, shingles_of(y), edits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(found, pa.float64())],
                names=["a", "b", "similarity"],
            )

    schema = pairs.select("a", "b").schema.add("similarity", "double")
    return pairs.select("a", "b", "of_a", "of_b").mapInArrow(run, schema)


def _name(place: str) -> Column:
    """The order of occurrences: by ``doc_id`` (null last), text hash and place in the text."""
    return F.struct(
        F.col("doc_id").isNull().alias("unnamed"),
        F.col("doc_id").alias("doc"),
        F.col("text_hash").alias("hash"),
        F.col(place).alias("place"),
    )


def _ranges(rows: DataFrame) -> DataFrame:
    """(__doc, __hash, __gone): the word ranges (first, number) that go from each text."""
    return rows.groupBy(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash")).agg(
        F.collect_set(F.struct("first_word", "n_words")).alias("__gone")
    )


_SAME = "doc_id <=> __doc AND text_hash = __hash"


def _pieces(text: str, gone: list[dict]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first word, words) of the parts between ranges that go."""
    words = text.encode("utf-8", "surrogatepass").split()
    start = 0
    for first, n in sorted((g["first_word"], g["n_words"]) for g in gone):
        if first - start >= PASSAGE:
            yield start, words[start:first]
        start = max(start, first + n)
    if len(words) - start >= PASSAGE:
        yield start, words[start:]


def _placed(words: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Words joined by spaces, and where each begins and ends there."""
    line = b" ".join(words)
    ends = np.append(np.flatnonzero(np.frombuffer(line, np.uint8) == 32), len(line))
    return line, np.append(0, ends[:-1] + 1), ends


def _sliding(of, values: np.ndarray, width: int) -> np.ndarray:
    """``of`` (minimum or maximum) of every ``width`` neighbouring values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values, have = of(values[:-step], values[step:]), have + step
    return values


def anchors_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of windows of ``ANCHOR`` words, one at least in every ``PASSAGE`` words.

    Which windows of a passage are picked inside it depends on the passage's words alone.
    """
    line, starts, ends = _placed(words)
    windows = joined_hashes(line, starts[: len(words) - ANCHOR + 1], ends[ANCHOR - 1 :])
    near = PASSAGE - ANCHOR + 1
    least = _sliding(np.minimum, windows, near)
    pad = np.zeros(near - 1, np.uint64)
    # The smallest of some passage: the largest of the minima around it is its own.
    around = _sliding(np.maximum, np.concatenate([pad, least, pad]), near)
    picked = np.flatnonzero(around == windows)
    return picked, windows[picked].view(np.int64)


def _anchors(named: DataFrame, gone: DataFrame) -> DataFrame:
    """(doc_id, text_hash, anchor, at) of the picked windows of each text less what goes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, anchors, places = [], [], []
            for i, (text, ranges) in enumerate(
                zip(batch.column("text"), batch.column("__gone"), strict=True)
            ):
                for first, words in _pieces(text.as_py() or "", ranges.as_py() or []):
                    picked, hashes = anchors_of(words)
                    rows.append(np.full(len(picked), i))
                    anchors.append(hashes)
                    places.append(picked + first)
            if rows:
                at = pa.array(np.concatenate(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(at) for c in ("doc_id", "text_hash")),
                        pa.array(np.concatenate(anchors), pa.int64()),
                        pa.array(np.concatenate(places), pa.int32()),
                    ],
                    names=["doc_id", "text_hash", "anchor", "at"],
                )
        give_back()

    kind = named.schema["doc_id"].dataType.simpleString()
    joined = named.join(gone, F.expr(_SAME), "left").select("doc_id", "text_hash", "text", "__gone")
    return joined.mapInArrow(run, f"doc_id {kind}, text_hash long, anchor long, at int")


def _windows(wanted: DataFrame) -> DataFrame:
    """(doc_id, text_hash, para, start, digest) of the passages around the windows ``__at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                text = batch.column("text")[i].as_py() or ""
                lines = [len(x.split()) for x in text.encode("utf-8", "surrogatepass").split(b"\n")]
                ends = np.cumsum(lines)
                at = np.unique(np.array(batch.column("__at")[i].as_py()))
                near = (at[:, None] - np.arange(PASSAGE - ANCHOR + 1)).reshape(-1)
                near = np.unique(near)
                starts, digests = [], []
                for first, words in _pieces(text, batch.column("__gone")[i].as_py() or []):
                    inside = near[(near >= first) & (near + PASSAGE <= first + len(words))]
                    line, begin, end = _placed(words)
                    begin, end = begin[inside - first], end[inside - first + PASSAGE - 1]
                    starts += inside.tolist()
                    for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                        digests.append(hashlib.md5(line[a:b]).digest())
                if starts:
                    same = pa.array(np.full(len(starts), i))
                    para = np.searchsorted(ends, starts, side="right")
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(c).take(same) for c in ("doc_id", "text_hash")),
                            pa.array(para, pa.int32()),
                            pa.array(starts, pa.int32()),
                            pa.array(digests, pa.binary()),
                        ],
                        names=["doc_id", "text_hash", "para", "start", "digest"],
                    )
        give_back()

    kind = wanted.schema["doc_id"].dataType.simpleString()
    return wanted.select("doc_id", "text_hash", "text", "__gone", "__at").mapInArrow(
        run, f"doc_id {kind}, text_hash long, para int, start int, digest binary"
    )


def repeated_passages(named: DataFrame, removed: DataFrame) -> DataFrame:
    """Runs of ``PASSAGE`` words or more that stand earlier, in texts less the rows ``removed``.

    Columns are those of ``repeated_paragraphs``. Every word of a window of ``PASSAGE`` words that
    occurs earlier belongs to a run; inside one text only if both occurrences do not overlap. For
    each ``cluster``, the words a run begins with, there is also a row where they occur first.
    """
    gone = broadcast_when_small(settle(_ranges(removed)))
    anchors = settle(_anchors(named, gone))
    shared = settle(anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1"))
    places = settle(
        anchors.join(broadcast_when_small(shared), "anchor")
        .groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__text"))
        .agg(F.collect_set("at").alias("__at"))
    )
    wanted = named.join(
        broadcast_when_small(places), F.expr("doc_id <=> __id AND text_hash = __text")
    ).join(gone, F.expr(_SAME), "left")
    windows = settle(_windows(wanted))
    first = windows.groupBy("digest").agg(F.min(_name("start")).alias("keeper"))
    own = _name("start")
    overlaps = (
        F.col("doc_id").eqNullSafe(F.col("keeper.doc"))
        & (F.col("text_hash") == F.col("keeper.hash"))
        & (F.col("start") < F.col("keeper.place") + PASSAGE)
    )
    later = windows.join(first, "digest").where((own != F.col("keeper")) & ~overlaps).distinct()
    order = Window.partitionBy("doc_id", "text_hash").orderBy("start")
    opens = F.coalesce(F.col("start") > F.lag("start").over(order) + PASSAGE, F.lit(True))
    runs = settle(
        later.withColumn("opens", opens.cast("int"))
        .withColumn("run", F.sum("opens").over(order))
        .groupBy("doc_id", "text_hash", "run")
        .agg(
            F.min(F.struct("start", "para", "digest", "keeper")).alias("first"),
            (F.max("start") - F.min("start") + PASSAGE).cast("int").alias("n_words"),
        )
        .select("doc_id", "text_hash", "first.*", "n_words")
    )
    kept = runs.select("digest", "keeper").distinct().withColumnRenamed("keeper", "of")
    kept = windows.join(kept, "digest").where(own == F.col("of"))
    rows = runs.withColumn("removed", F.lit(True)).unionByName(
        kept.select(
            *("doc_id", "text_hash", "start", "para", "digest"),
            F.col("of").alias("keeper"),
            F.lit(PASSAGE).alias("n_words"),
            F.lit(False).alias("removed"),
        )
    )
    return rows.select(
        "doc_id",
        "text_hash",
        "para",
        F.col("start").alias("first_word"),
        "n_words",
        F.lower(F.hex("digest")).alias("cluster"),
        F.col("keeper.doc").alias("keeper_doc_id"),
        "removed",
    )


def repeated_paragraphs(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """Every paragraph that occurs again, exactly or nearly, and every passage: a row each time.

    Input: ``doc_id``, ``text`` and any other columns. Result: ``doc_id``, ``text_hash`` (which
    with ``doc_id`` names the row), ``para`` (the number of the line it begins in, from 0),
    ``first_word`` (its number in the text, from 0), ``n_words``, ``cluster`` (hex digest that is
    the same for all occurrences), ``keeper_doc_id`` and ``removed``: all but the first occurrence
    by (``doc_id``, text hash, place) go. Passages are those of ``repeated_passages``.

    Null and empty texts have no paragraphs. A null ``doc_id`` comes last. Rows equal in
    ``doc_id`` and text have the same name, hence the same fate. An empty table gives no rows.
    """
    named = docs.select(
        "doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")
    )
    keys = ["doc_id", "text_hash"]
    # Equal paragraphs have equal bands, so any one of them serves.
    distinct = settle(
        found_paragraphs(named, keys, least, "bands")
        .groupBy("digest")
        .agg(F.first("bands").alias("bands"), F.count("*").alias("n"))
    )
    lines = found_paragraphs(named, [], least, "line").select("digest", "line")
    clusters = components(similar_pairs(distinct.select("digest", "bands"), lines))
    cluster = distinct.select("digest", "n").join(
        clusters.withColumnRenamed("node", "digest"), "digest", "left"
    )
    cluster = cluster.where("root IS NOT NULL OR n > 1").select(
        "digest", F.coalesce("root", "digest").alias("cluster")
    )
    # The places are found again rather than kept, and most are in no cluster.
    small = broadcast_when_small(settle(cluster))
    rows = settle(found_paragraphs(named, keys, least).join(small, "digest"))
    name = _name("para")
    first = rows.groupBy("cluster").agg(F.min(name).alias("keeper"))
    whole = settle(
        rows.join(first, "cluster").select(
            "doc_id",
            "text_hash",
            "para",
            "first_word",
            "n_words",
            F.lower(F.hex("cluster")).alias("cluster"),
            F.col("keeper.doc").alias("keeper_doc_id"),
            (name != F.col("keeper")).alias("removed"),
        )
    )
    return whole.unionByName(repeated_passages(named, whole.where("removed")))


def without_words(text: str, gone: list[dict]) -> str:
    """A text less ranges of its words; lines that had words and have none left go whole."""
    ranges = sorted((g["first_word"], g["first_word"] + g["n_words"]) for g in gone)
    lines, at, r = [], 0, 0
    for line in text.split("\n"):
        raw = line.encode("utf-8", "surrogatepass")
        words = list(_WORD.finditer(raw))
        end, kept, left, cut = at + len(words), [], 0, 0
        while r < len(ranges) and ranges[r][0] < end:
            a, b = max(ranges[r][0], at), min(ranges[r][1], end)
            if b > a:
                kept.append(raw[left : words[a - at].start()])
                # The space after the range goes with it.
                left = words[b - at].start() if b < end else len(raw.rstrip())
                cut += b - a
            if ranges[r][1] > end:
                break
            r += 1
        at = end
        if not cut:
            lines.append(line)
        elif cut < len(words):
            rest = b"".join([*kept, raw[left:]])
            lines.append(rest.decode("utf-8", "surrogatepass"))
    return "\n".join(lines)


def without_repeats(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``docs`` with removed paragraphs and passages cut out of ``text``, ``n_chars`` set anew.

    Texts without such paragraphs stay as they are, byte for byte; a document of which no word is
    left goes. Of rows equal in ``doc_id`` and text each is treated alike. Other columns stay.
    """
    gone = settle(_ranges(repeated_paragraphs(docs, least).where("removed")))
    hashed = docs.withColumn("__own", F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__own") == F.col("__hash"))
    joined = hashed.join(broadcast_when_small(gone), same, "left")
    columns = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays, texts, counts = [], [], []
            for i, ranges in enumerate(batch.column("__gone")):
                text = batch.column("text")[i].as_py()
                if ranges.is_valid:
                    text = without_words(text, ranges.as_py())
                    if not text.strip(SPACES):
                        continue
                stays.append(i)
                texts.append(text)
                counts.append(len(text) if ranges.is_valid else None)
            left = batch.select(columns).take(pa.array(stays, pa.int64()))
            arrays = dict(zip(columns, left.columns, strict=True))
            arrays["text"] = pa.array(texts, pa.string())
            if "n_chars" in arrays:
                old = arrays["n_chars"]
                arrays["n_chars"] = pc.coalesce(pa.array(counts, pa.int64()).cast(old.type), old)
            yield pa.RecordBatch.from_arrays([arrays[c] for c in columns], names=columns)
        give_back()

    return joined.select(*columns, "__gone").mapInArrow(run, docs.schema)
