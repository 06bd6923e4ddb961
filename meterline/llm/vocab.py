"""Exact and fast use of a tokenizer file: texts are cut where the tokenizer always cuts too.

A pre-token never runs across a single space or line end that is followed by a character other
than white space, nor from a letter to ASCII punctuation (but for _ and '), so a text's ids are
those of its cuts, one after the other, and a cut seen before need not be encoded again. Texts with
a special token's string, whose neighbourhood the tokenizer treats differently, are given to it
whole. Cuts are found in bulk, in the bytes of many texts, and each distinct one is looked up once.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from meterline.llm.common import give_back

if TYPE_CHECKING:
    from tokenizers import Tokenizer

# Anything any of the libraries counts as white space, and characters near it.
_BLANK = r"\s\x85\xa0" + "".join(map(chr, (0x180E, 0x200B, 0xFEFF)))
# Letters to every library: ASCII and Latin-1.
_LETTER = "A-Za-z" + "".join(map(chr, [0xC0, 45, 0xD6, 0xD8, 45, 0xF6, 0xF8, 45, 0xFF]))
# ASCII punctuation that ends a word to every library.
_ENDING = r"!-&(-/:-@\[-^`{-~"
_WORD = re.compile(rf"( ?|\n)([{_LETTER}]+)\Z")
_KNOWN: dict[str, "Encoder"] = {}

# White space of two and three bytes, as big-endian integers.
_WIDE = [c.encode() for c in map(chr, range(0x80, 0x10000)) if re.match(f"[{_BLANK}]", c)]
_WIDE_BLANKS = [[int.from_bytes(c) for c in _WIDE if len(c) == n] for n in (2, 3)]
# What a byte of UTF-8 text may be, as bits. All Latin-1 letters begin with one byte.
_BREAKS, _IS_BLANK, _IS_LETTER, _ENDS, _SECOND, _OPENS_WIDE = (1 << i for i in range(6))
_LATIN = "\xc0".encode()[0]


def _kinds() -> np.ndarray:
    classes = {_BREAKS: r" \n", _IS_BLANK: _BLANK, _IS_LETTER: _LETTER, _ENDS: _ENDING}
    found = np.zeros(256, np.int64)
    for bit, chars in classes.items():
        found[:128] |= [bit * bool(re.match(f"[{chars}]", chr(b))) for b in range(128)]
    found[128:192] |= [_SECOND * bool(re.match(f"[{_LETTER}]", chr(c))) for c in range(192, 256)]
    found[list({c[0] for c in _WIDE})] |= _OPENS_WIDE
    return found.astype(np.uint8)


_KINDS = _kinds()


def _wide_blank(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether characters beyond ASCII that begin at places of UTF-8 text are white space."""
    one, two, three = (
        data[np.minimum(places + i, len(data) - 1)].astype(np.int64) for i in range(3)
    )
    pair = one << 8 | two
    return np.isin(pair, _WIDE_BLANKS[0]) | np.isin(pair << 8 | three, _WIDE_BLANKS[1])


def _cut(texts: pa.LargeStringArray, special: list[str]) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The cuts of all texts, one after the other, and where each text's begin and the last's end."""
    _, offsets, content = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
    n = int(ends[-1])
    if not n:
        return texts[:0], np.zeros(len(ends), np.int64)
    data = np.frombuffer(content, np.uint8)[:n]
    kinds = _KINDS[data]
    here, after = kinds[:-1], kinds[1:]
    breaks = np.zeros(n + 1, bool)
    breaks[: n - 1] = (here & _BREAKS != 0) & (after & _IS_BLANK == 0)
    wide = np.flatnonzero(breaks[: n - 1] & (after & _OPENS_WIDE != 0))
    breaks[wide[_wide_blank(data, wide + 1)]] = False
    breaks[ends[1:] - 1] = False
    letters = kinds & _IS_LETTER != 0
    letters[1:] |= (data[:-1] == _LATIN) & (after & _SECOND != 0)
    cut = breaks
    cut[1:n] |= letters[:-1] & (after & _ENDS != 0)
    # Where a text begins, whatever the one before ends with.
    cut[ends] = True
    for s in special:
        for i in np.flatnonzero(pc.match_substring(texts, s)):
            cut[ends[i] + 1 : ends[i + 1]] = False
    places = np.flatnonzero(cut)
    cuts = pa.LargeStringArray.from_buffers(len(places) - 1, pa.py_buffer(places), content)
    return cuts, np.searchsorted(places, ends)


def _byte_names() -> dict[int, str]:
    """The character that byte-level tokenizers write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Cuts(dict):
    """Ids by cut. Those of a byte-level tokenizer's words come from its model when first asked for.

    One letter run, a space before it included, is one pre-token, and a line end before it another,
    so the model can be asked without looking for pre-tokens.

    ``old`` holds what was known when the cuts last aged; what is not asked for until they age
    again is forgotten.
    """

    def __init__(self, model: Tokenizer):
        self.old: dict[str, bytes] = {}
        names = _byte_names()
        # What byte-level tokenizers write for each character of ASCII and Latin-1.
        self.names = {c: "".join(names[b] for b in chr(c).encode()) for c in range(256)}
        self.space = self.names[ord(" ")]
        self.whole, self.tokenize = model.encode_batch_fast, model.model.tokenize

    def age(self) -> None:
        old = dict(self)
        self.clear()
        self.old = old

    def clear(self) -> None:
        super().clear()
        self.old = {}

    def __missing__(self, cut: str) -> bytes:
        ids = self.old.get(cut)
        if ids is None:
            ids = self._ask(cut)
        self[cut] = ids
        return ids

    def _ask(self, cut: str) -> bytes:
        first, rest = cut[0], cut[1:]
        if first == " " and rest.isascii() and rest.isalpha():
            found = [t.id for t in self.tokenize(self.space + rest)]
        elif word := _WORD.match(cut):
            parts = word.groups() if first == "\n" else (cut,)
            found = [t.id for p in parts for t in self.tokenize(p.translate(self.names))]
        else:
            found = self.whole([cut], add_special_tokens=False)[0].ids
        return array("I", found).tobytes()


class Encoder:
    """Ids of texts by one tokenizer file, with a bounded memory of cuts: at most two ages of them."""

    def __init__(self, path: str, remembered: int = 200_000):
        # Tasks already use all cores.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()
        self.special = [t.content for t in self.model.get_added_tokens_decoder().values()]
        self.remembered = remembered
        self.by_words = _byte_level(path)
        self.ids = _Cuts(self.model)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        if not texts:
            return []
        cuts, first = _cut(pa.array(texts, pa.large_string()), self.special)
        seen = cuts.dictionary_encode()
        found = self._found(seen.dictionary.to_numpy(zero_copy_only=False).tolist())
        joined = pa.array(found, pa.large_binary()).take(seen.indices)
        _, offsets, content = joined.buffers()
        ends = np.frombuffer(offsets, np.int64)[first].tolist()
        ids = memoryview(content or b"")
        return [ids[a:b].tobytes() for a, b in zip(ends, ends[1:], strict=False)]

    def _found(self, cuts: list[str]) -> list[bytes]:
        known = self.ids
        if len(known) > self.remembered:
            known.age()
        if not self.by_words:
            missing = [c for c in cuts if c not in known and c not in known.old]
            new = self.model.encode_batch_fast(missing, add_special_tokens=False)
            known |= {c: array("I", f.ids).tobytes() for c, f in zip(missing, new, strict=True)}
        return [known[c] for c in cuts]

    def forget(self) -> None:
        """Give back what the cuts take: a worker that idles, or runs another stage, needs none."""
        self.ids.clear()
        give_back()


def _byte_level(path: str) -> bool:
    """Whether a tokenizer takes texts as they are, cut by the byte-level pattern into pre-tokens."""
    with open(path, encoding="utf-8") as file:
        plan = json.load(file)
    pre = plan.get("pre_tokenizer") or {}
    exact = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    return not plan.get("normalizer") and all(pre.get(k) == v for k, v in exact.items())


def encoder(path: str) -> Encoder:
    """The encoder of this worker process for a file."""
    if path not in _KNOWN:
        _KNOWN[path] = Encoder(path)
    return _KNOWN[path]


def public_path(name: str) -> str:
    """Where the installed file of a public tokenizer lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
