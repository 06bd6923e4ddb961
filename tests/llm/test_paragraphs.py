import random
from collections import defaultdict

import numpy as np

from meterline.llm import paragraphs
from tests.llm.conftest import DOCS


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def linked(a, b):
    p, q = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a, b))
    if len(p & q) >= 0.8 * len(p | q):
        return True
    functions = paragraphs._hash_functions()
    shared = paragraphs.band_keys(a, functions) == paragraphs.band_keys(b, functions)
    return bool(shared.any()) and distance(a, b) <= 0.2 * max(len(a), len(b))


def brute(docs, least=40):
    """(doc, line, removed) of every repeated paragraph, by comparing all pairs."""
    found = []
    for doc, text in docs:
        for line, words in paragraphs.paragraphs_of(text, least):
            found.append((doc, line, words))
    parent = list(range(len(found)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = {}
    for i, (_, _, words) in enumerate(found):
        for shingle in {tuple(words[k : k + 5]) for k in range(len(words) - 4)}:
            index.setdefault(shingle, []).append(i)
    # Paragraphs without a common shingle have neither a common band nor any similarity.
    for i, j in sorted({(a, b) for group in index.values() for a in group for b in group if a < b}):
        if find(i) != find(j) and linked(found[i][2], found[j][2]):
            parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc, line, _) in enumerate(found):
        groups[find(i)].append((doc, line))
    return sorted(
        (doc, line, (doc, line) != min(g)) for g in groups.values() if len(g) > 1 for doc, line in g
    )


def near(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def made(rng):
    base = [[f"w{rng.randrange(5000)}" for _ in range(rng.randrange(45, 140))] for _ in range(60)]
    docs = []
    for i in range(120):
        lines = [near(rng, rng.choice(base), rng.choice([0, 0, 1, 2, 6])) for _ in range(2)]
        lines.append([f"own{i}x{j}" for j in range(50)])
        docs.append((i, "\n".join("  ".join(x) for x in lines) + "\nshared short line"))
    return docs


def test_clusters_match_all_pairs(spark):
    docs = made(random.Random(11))
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS).repartition(4)
    found = paragraphs.repeated_paragraphs(df).collect()
    assert sorted((r["doc_id"], r["para"], r["removed"]) for r in found) == brute(docs)
    keepers = {r["cluster"]: r["doc_id"] for r in found if not r["removed"]}
    assert all(r["keeper_doc_id"] == keepers[r["cluster"]] for r in found)


def test_chain_whose_ends_differ(spark):
    rng = random.Random(2)
    words = [f"c{i}" for i in range(120)]
    docs = []
    for i in range(12):
        docs.append((i, " ".join(words)))
        words = near(rng, words, 1)
        words = near(rng, words, 1)
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS)
    found = paragraphs.repeated_paragraphs(df).collect()
    assert sorted((r["doc_id"], r["para"], r["removed"]) for r in found) == brute(docs)


def test_texts_without_repeats(spark):
    para = " ".join(f"p{i}" for i in range(60))
    docs = [(1, f"first\n{para}\nend"), (2, f"{para}\r\n\nkept  as is\n"), (3, para), (4, "clean"),
            (5, ""), (6, None)]
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], DOCS)
    left = {r["doc_id"]: (r["text"], r["n_chars"]) for r in paragraphs.without_repeats(df).collect()}
    assert left == {1: (docs[0][1], len(docs[0][1])), 2: ("\nkept  as is\n", 13), 4: ("clean", 5),
                    5: ("", 0), 6: (None, 0)}


def test_odd_documents(odd_docs):
    found = {(r["doc_id"], r["para"], r["removed"])
             for r in paragraphs.repeated_paragraphs(odd_docs).collect()}
    assert found == {(1, 0, False), (2, 0, True)}
    left = paragraphs.without_repeats(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.count() == odd_docs.count() - 1


def test_no_documents(no_docs):
    assert paragraphs.repeated_paragraphs(no_docs).count() == 0
    assert paragraphs.without_repeats(no_docs).count() == 0


def test_long_paragraph_in_blocks():
    import numpy as np

    rng = np.random.default_rng(1)
    factors = rng.integers(1, 1 << 32, 8, np.uint64) | np.uint64(1)
    values = rng.integers(0, 1 << 62, 10_000, np.uint64)
    whole = paragraphs.min_hash(values, factors, factors)
    parts = [paragraphs.min_hash(values[i : i + 4096], factors, factors) for i in (0, 4096, 8192)]
    assert (whole == np.min(parts, axis=0)).all()


def test_edit_distance():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randrange(9))] for _ in range(2))
        assert paragraphs.edit_distance(a, b) == distance(a, b)


def test_copies_with_two_typos_each_are_one_cluster(spark):
    rng = random.Random(6)
    words = [f"c{i}" for i in range(87)]
    docs = [(i, " ".join(near(rng, words, 2 if i else 0))) for i in range(60)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS)
    found = paragraphs.repeated_paragraphs(df).collect()
    assert sorted((r["doc_id"], r["para"], r["removed"]) for r in found) == brute(docs)
    assert len({r["cluster"] for r in found}) == 1 and len(found) == 60


def test_filler_and_clusters_in_one_band(spark):
    """Paragraphs that share filler collide in bands without being similar; clusters of copies,
    chains and edited copies lie among them."""
    rng = random.Random(12)
    filler = [f"f{j}" for j in range(60)]
    docs = []
    for i in range(150):
        docs.append(filler + [f"own{i}x{j}" for j in range(40)])
    for c in range(6):
        words = filler + [f"k{c}x{j}" for j in range(40)]
        for _ in range(12):
            docs.append(near(rng, words, rng.randrange(5)))
    rng.shuffle(docs)
    docs = [(i, " ".join(w)) for i, w in enumerate(docs)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS).repartition(4)
    found = paragraphs.repeated_paragraphs(df).where(f"n_words <> {paragraphs.PASSAGE}")
    got = {(r["doc_id"], r["removed"]) for r in found.collect() if r["n_words"] == 100}
    assert got == {(d, gone) for d, _, gone in brute(docs)}


def test_listed_tokens_hold_every_similar_pair():
    """Against all pairs, with bands left aside: what is similar lists a token in common."""
    rng = random.Random(13)
    filler = [b"f%d" % (j % 17) for j in range(30)]
    lines = []
    for c in range(12):
        words = filler + [b"c%dx%d" % (c, j) for j in range(rng.randrange(15, 120))]
        lines += [[w.encode() if isinstance(w, str) else w for w in near(rng, words, rng.randrange(9))]
                  for _ in range(8)]
    counter = paragraphs.Counter()
    for words in lines:
        for hashes in paragraphs._tokens(b" ".join(words), True):
            counter.add(hashes)
    import pyarrow as pa

    joined = [b" ".join(w) for w in lines]
    batch = pa.RecordBatch.from_pydict(
        {"digest": pa.array([str(i).encode() for i in range(len(lines))], pa.binary()),
         "line": pa.array(joined, pa.binary())})
    listed = [set() for _ in lines]
    for out in paragraphs._rarest([batch], counter.table, 0.8, True):
        for row in out.to_pylist():
            listed[int(row["digest"])].add(row["token"])
    pairs = 0
    for i in range(len(lines)):
        for j in range(i):
            of = [paragraphs.shingles_of(joined[k]) for k in (i, j)]
            if paragraphs.similarity(joined[i], joined[j], *of) >= 0.8:
                pairs += 1
                assert listed[i] & listed[j]
    assert pairs > 200


def cut_brute(docs, size=50):
    """Words of each text outside the windows that occur earlier, by looking at all windows."""
    seen, left = {}, {}
    for doc, text in docs:
        words = text.split()
        gone = set()
        for i in range(len(words) - size + 1):
            first = seen.setdefault(tuple(words[i : i + size]), (doc, i))
            if first[0] != doc or i - first[1] >= size:
                gone |= set(range(i, i + size))
        left[doc] = [w for i, w in enumerate(words) if i not in gone]
    return left


def test_passages_in_lines_and_over_line_ends(spark):
    rng = random.Random(5)
    docs = []
    passage = [[f"p{k}x{j}" for j in range(50 + 7 * k)] for k in range(4)]
    for i in range(24):
        own = [f"own{i}x{j}" for j in range(140)]
        at, shared = rng.randrange(20, 120), passage[i % 4]
        if i % 3 == 1:
            # Short lines with ends at other places in each text.
            shared = [w + "\n" if rng.random() < 0.1 else w for w in shared]
        docs.append((i, " ".join(own[:at] + shared + own[at:]).replace("\n ", "\n")))
    docs.append((24, "\n".join(" ".join(passage[0][a : a + 10]) for a in range(0, 50, 10))))
    docs.append((25, "again " * 400 + "end"))
    docs.append((26, " ".join(passage[3][:49])))
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS).repartition(5)
    left = {r["doc_id"]: r["text"] for r in paragraphs.without_repeats(df).collect()}
    want = cut_brute(docs)
    assert not want.pop(24) and 24 not in left
    assert {d: t.split() for d, t in left.items()} == want
    assert len(want[26]) == 49 and len(want[5]) == 140 and len(want[25]) < 110
    removed = [r for r in paragraphs.repeated_paragraphs(df).collect() if r["removed"]]
    assert {r["doc_id"] for r in removed} == {*range(4, 25), 25}
    assert {r["keeper_doc_id"] for r in removed if r["doc_id"] < 24} == {0, 1, 2, 3}


def test_paragraphs_of_short_lines(spark):
    rng = random.Random(7)
    words = [f"s{j}" for j in range(48)]

    def block(ws):
        return "\n".join(" ".join(ws[a : a + 8]) for a in range(0, 48, 8))

    docs = [(1, "title one\n\n" + block(words)), (2, "another\n\n" + block(near(rng, words, 1)) + "\n\nend")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS)
    left = {r["doc_id"]: r["text"] for r in paragraphs.without_repeats(df).collect()}
    assert left == {1: docs[0][1], 2: "another\n\n\nend"}


def test_bands_of_many_paragraphs_are_those_of_each():
    rng = random.Random(11)
    lines = [b" ".join(rng.choices([b"a", b"bb", b"c\xc3\xa9", b"d."], k=rng.choice([1, 4, 5, 6, 90])))
             for _ in range(60)]
    functions = paragraphs._hash_functions()
    together = paragraphs.bands_of(lines, functions)
    assert (together == [paragraphs.band_keys(x.split(b" "), functions) for x in lines]).all()
    # Equal shingle sets have equal bands, whatever the order and number of the shingles.
    around = [b" ".join([b"a", b"b", b"c"] * n) for n in (4, 9)]
    assert (np.diff(paragraphs.bands_of(around, functions), axis=0) == 0).all()


def test_spacing_makes_no_difference_to_paragraphs():
    text = " one\ttwo  three\r\nfour five \n\n\x0bsix\x0c seven\neight"
    plain = "one two three\nfour five\n\nsix seven\neight"
    assert paragraphs.lines_of(text, 3) == paragraphs.lines_of(plain, 3)
    assert paragraphs.lines_of(text, 3)[0] == (0, 0, 3, b"one two three")


def test_anchors_are_the_smallest_windows_of_each_passage():
    rng = random.Random(12)
    words = [b"%d" % rng.randrange(40) for _ in range(400)]
    picked, hashes = paragraphs.anchors_of(words)
    ranks = dict(zip(picked.tolist(), hashes.tolist(), strict=True))
    near = paragraphs.PASSAGE - paragraphs.ANCHOR + 1
    for start in range(len(words) - paragraphs.PASSAGE + 1):
        assert any(start + i in ranks for i in range(near))
    alone = paragraphs.anchors_of(words[100:150])
    assert set(alone[1].tolist()) <= set(hashes.tolist())
