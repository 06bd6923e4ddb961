import random
import string
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterline.llm import packing, queries, vocab
from meterline.llm.vocab import Encoder, public_path
from tests.llm.conftest import DOCS

FILES = ("byte_bpe_50k.json", "word_bpe_49k.json")
PARTS = st.sampled_from(
    ["a", "The", " ", "  ", "\n", "\n\n", "\t", "\r\n", "'s", "'", "!", "...", "é", "é", "中文", "😀",
     "12", "\xa0", " ", "​", "﻿", "\x1c", "\x85", "᠎", "Σ", "ΑΣ", "İ", "<|endoftext|>",
     "<|startoftext|>", "́", "ﬁ", "\x00", " x", "y "])


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = public_path(request.param)
    return Encoder(path, remembered=50), Tokenizer.from_file(path)


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.lists(PARTS, max_size=12).map("".join), min_size=1, max_size=5))
def test_cuts_give_the_tokenizers_ids(both, texts):
    own, library = both
    want = [array("I", e.ids).tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want


@pytest.mark.parametrize("file", FILES)
def test_cuts_that_are_blank_or_end_blank(file):
    path = public_path(file)
    library = Tokenizer.from_file(path)
    ends = ["", "\n", "\n\n", " ", "\n \n", "\t", "\x85", "a ", " a ", "\nb\n", " c\n\n"]
    for one in ends:
        texts = [one, *ends, *(a + "word" + b for a in ends for b in ends)]
        want = [array("I", e.ids).tobytes()
                for e in library.encode_batch(texts, add_special_tokens=False)]
        assert Encoder(path).encode(texts) == want


@pytest.mark.parametrize("file", FILES)
def test_fresh_encoders_give_the_tokenizers_ids(file):
    """Every cut of a batch is new, so that all are encoded in runs."""
    path = public_path(file)
    library, own = Tokenizer.from_file(path), Encoder(path)
    rng = random.Random(8)
    blanks, words = ["", "\n", "\n\n", " ", "  ", "\r\n"], ["one", "Two,", "3", "x.y", "é", "中"]
    for _ in range(150):
        own.ids.clear()
        texts = ["".join([rng.choice(blanks), *(rng.choice(words) + rng.choice(blanks[1:])
                 for _ in range(rng.randrange(6)))]) for _ in range(60)]
        want = [array("I", e.ids).tobytes()
                for e in library.encode_batch(texts, add_special_tokens=False)]
        assert own.encode(texts) == want


def test_words_do_not_go_through_the_whole_tokenizer():
    path = public_path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), Encoder(path)
    text = "The caf\u00e9 stayed\nopen### until nine\nZo\u00eb said"
    asked = []

    def whole(cuts, **options):
        asked.extend(cuts)
        return library.encode_batch_fast(cuts, **options)

    own.ids.whole = whole
    assert own.encode([text]) == [array("I", library.encode(text).ids).tobytes()]
    assert asked == ["###"]


def cuts_one_by_one(text):
    """The rule of ``vocab``, character by character."""
    cuts, begin = [], 0
    for i in range(1, len(text)):
        after, before = text[i + 1 : i + 2], text[i - 1]
        if text[i] in " \n":
            new = after and not (after.isspace() or after in "\u180e\u200b\ufeff")
        else:
            letter = before.isascii() and before.isalpha() or "\xc0" <= before <= "\xff"
            new = text[i] in set(string.punctuation) - set("_'") and letter and before not in "\xd7\xf7"
        if new:
            cuts.append(text[begin:i])
            begin = i
    return cuts + [text[begin:]] * bool(text)


def check_cuts(texts):
    cuts, first = vocab._cut(pa.array(texts, pa.large_string()), ["<|endoftext|>"])
    want = [[t] if "<|endoftext|>" in t else cuts_one_by_one(t) for t in texts]
    found = cuts.to_pylist()
    assert [found[a:b] for a, b in zip(first, first[1:], strict=False)] == want


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.lists(PARTS | st.characters(codec="utf-8"), max_size=12).map("".join),
                      min_size=1, max_size=5))
def test_texts_are_cut_in_bulk_where_each_would_be(texts):
    check_cuts(texts)


def test_cuts_before_and_after_every_character():
    every = [c for c in map(chr, range(0x10000)) if not "\ud800" <= c <= "\udfff"]
    check_cuts([t for c in every for t in (f"{c}.b", f"a {c}", f"a\n{c}b", f"a{c}", c)])


def test_each_distinct_cut_of_a_call_is_looked_up_once():
    path = public_path("byte_bpe_50k.json")
    own, asked = Encoder(path), []

    class Asked(type(own.ids)):
        def __getitem__(self, cut):
            asked.append(cut)
            return super().__getitem__(cut)

    own.ids = Asked(own.model)
    own.encode([" the end" * 50, " end" * 50])
    assert sorted(asked) == [" end", " the"]


def test_cuts_in_use_stay_known():
    path = public_path("byte_bpe_50k.json")
    own, library, asked = Encoder(path, remembered=20), Tokenizer.from_file(path), []
    tokenize = own.ids.tokenize
    own.ids.tokenize = lambda word: asked.append(word) or tokenize(word)
    for i in range(0, 300, 10):
        text = " the" + "".join(f" w{'x' * (j % 17)}{'y' * (j // 17)}" for j in range(i, i + 10))
        assert own.encode([text]) == [array("I", library.encode(text).ids).tobytes()]
        assert len(own.ids) + len(own.ids.old) <= 2 * (20 + 11)
    assert len(asked) == 301
    own.forget()
    assert not own.ids and not own.ids.old


def test_blank_documents_are_packed(spark):
    docs = [(1, "\n"), (2, "\n\n"), (3, " "), (4, "\n \n"), (5, "\nend\n")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], DOCS).coalesce(1)
    check(docs, packing.pack(df, with_ids=True).collect())


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(max_size=60), min_size=1, max_size=5))
def test_any_text_gives_the_tokenizers_ids(both, texts):
    own, library = both
    want = [array("I", e.ids).tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert own.encode(texts) == want


def check(docs, pieces, size=1024):
    """Each id in one piece, sequences gapless and none too long; the padding."""
    library = Tokenizer.from_file(public_path("byte_bpe_50k.json"))
    want = sorted((d, tuple(library.encode(t or "", add_special_tokens=False).ids) + (0,)) for d, t in docs)
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert p["length"] == len(p["ids"]) > 0
        assert zlib.crc32(np.array(p["ids"], "<u4").tobytes()) == p["ids_crc32"]
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]].append((p["start"], p["ids"], p["doc_tokens"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    got = []
    for doc, parts in by_doc.items():
        ids = []
        for start, more, total in sorted(parts):
            assert start == len(ids)
            ids += more
        assert len(ids) == total
        got.append((doc, tuple(ids)))
    assert sorted(got) == want
    fills = [sum(n for _, n in p) for p in by_sequence.values()]
    return sum(size - f for f in fills)


def test_query_on_given_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    pieces = packing.pack(docs, with_ids=True).collect()
    assert check(plain, pieces) < 1024 * docs.rdd.getNumPartitions()
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    query = queries.op6_packing(spark, sf)
    assert query.columns == columns
    assert sorted(map(tuple, query.collect())) == sorted(tuple(p[c] for c in columns) for p in pieces)


def test_odd_documents(spark, odd_docs, no_docs):
    docs = odd_docs.where("doc_id NOT IN (1, 7)").dropna(subset=["doc_id"])
    check([tuple(r) for r in docs.select("doc_id", "text").collect()],
          packing.pack(docs, with_ids=True).collect())
    pieces = packing.pack(odd_docs).collect()
    assert {p["doc_tokens"] for p in pieces if p["doc_id"] == 3} == {1}
    assert len({p["doc_id"] for p in pieces}) == 8
    assert packing.pack(no_docs).count() == 0


def test_level_is_the_one_of_least_squares():
    rng = np.random.default_rng(7)
    packer = packing.Packer(16, lambda *a: None)
    for _ in range(400):
        length = int(rng.integers(1, 16))
        best, level = None, packer.choose(length)
        for h in range(0, 16 - length + 1):
            if h == 0 or packer.count[h]:
                count = packer.count.copy()
                count[h] -= h > 0
                if h + length < 16:
                    count[h + length] += 1
                total = int((count[1:16] ** 2).sum())
                if best is None or total <= best[0]:
                    best = (total, h)
        assert level == best[1]
        packer.add(0, b"\0" * 4 * length, length)


def test_drain_leaves_one_open_window():
    done = []
    packer = packing.Packer(16, lambda *a: done.append(a), most_open=5)
    rng = np.random.default_rng(1)
    total = 0
    for doc in range(500):
        n = int(rng.choice([3, 7, 9, 11, 40]))
        total += n
        packer.add(doc, bytes(range(n)) * 4, n)
        assert packer.opened <= 5
    packer.finish()
    fills = defaultdict(int)
    for _, _, ids, _, sequence, offset in done:
        assert offset == fills[sequence]
        fills[sequence] += len(ids) // 4
    assert sum(fills.values()) == total and sum(f < 16 for f in fills.values()) <= 1
