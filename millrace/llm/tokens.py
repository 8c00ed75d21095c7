"""Token ids of whole texts by a vocabulary file of the tokenizers library, at word-cache speed.

The two vocabularies in use never merge across white space, so a text's ids are the ids of its
words one after another. Each distinct word goes through the library once per worker and is looked
up from then on. Texts for which this does not hold by the letter (rare white space, spaces in a
row, text like a special token) go through the library whole.

Of a word the library's model merges the pre-tokens, each distinct one of a call once. Cutting a word into
them by the vocabulary's pattern needs no more than to know letters and numbers, so words of characters that every
version of Unicode knows alike are cut here. All other words, and all words of a vocabulary with another
pattern, go through the library's own normalizer and pre-tokenizer.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space and invisible characters other than space, tab, line feed and carriage return. A text with
#: any of them, or with the opening of a special token, is encoded whole.
UNUSUAL = re.compile(
    r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\xa0\u0300-\u036f\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff]"
)
UNUSUAL_ASCII = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
SPECIAL = "<|"
#: Words a worker remembers, of those it met twice; past that it starts anew. Only speed depends on it.
CACHED_WORDS = 800_000
#: Bits that mark words met once, by hash, and pre-tokens the library itself remembers.
MET_BITS = 1 << 25
LIBRARY_CACHE = 20_000
#: Bytes of the texts whose words a worker holds as lists at once, and one text more.
HELD_BYTES = 1 << 20
#: Words that go to the library in one call, and what sets them apart there.
JOINED_WORDS = 2000
MARK = "\x01"

#: The pre-tokenizers whose patterns are written out here, with the normalizer that goes before them. ``L`` and ``N``
#: stand for letters and numbers. A null byte, which no word has, is the end of a word.
SUFFIXES = "'s|'t|'re|'ve|'m|'ll|'d"
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True}
PATTERNS = [
    (
        None,
        BYTE_LEVEL | {"use_regex": True},
        SUFFIXES + r"| ?[L]+| ?[N]+| ?[^\s\0LN]+|\s+(?![^\s\0])|\s+|\0",
    ),
    (
        {
            "type": "Sequence",
            "normalizers": [
                {"type": "NFC"},
                {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                {"type": "Lowercase"},
            ],
        },
        {
            "type": "Sequence",
            "pretokenizers": [
                {
                    "type": "Split",
                    "pattern": {"Regex": SUFFIXES + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                    "behavior": "Removed",
                    "invert": True,
                },
                BYTE_LEVEL | {"use_regex": False},
            ],
        },
        SUFFIXES + r"|[L]+|[N]|[^\s\0LN]+|\0",
    ),
]

_ENCODERS: dict[tuple[str, bool], Encoder] = {}


@cache
def _alphabet() -> tuple[str, str, str]:
    """The letters, the numbers and all characters, as insides of a character class, that Unicode has had as
    such since version 3.2. White space is that of words, see ``UNUSUAL``."""
    kinds = []
    for code in range(0x20, 0x110000):
        kind = unicodedata.category(chr(code))[0]
        stable = kind in "LNMPS" and unicodedata.ucd_3_2_0.category(chr(code))[0] == kind
        kinds.append(kind if stable else "")

    def ranges(wanted: str) -> str:
        found, start = [], None
        for code, kind in enumerate([*kinds, ""], 0x20):
            inside = kind != "" and kind in wanted
            if inside and start is None:
                start = code
            elif not inside and start is not None:
                found.append(f"\\U{start:08x}-\\U{code - 1:08x}")
                start = None
        return "".join(found)

    return ranges("L"), ranges("N"), r" \t\n\r" + ranges("LNMPS")


@cache
def _byte_chars() -> list[tuple[str, str]]:
    """The bytes that another character stands for in a byte-level vocabulary, but the null byte, and that character."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(0x100) if byte not in printed]
    return [(chr(byte), chr(0x100 + k)) for k, byte in enumerate(others) if byte]


def cutter(path: str) -> tuple[Callable, Callable] | None:
    """What cuts words, null bytes between them, into pre-tokens, and what says whether it may cut a word, for the vocabulary of a file; none
    where its normalizer or pre-tokenizer is not one of ``PATTERNS``."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    for normalizer, pre_tokenizer, pattern in PATTERNS:
        if made.get("normalizer") == normalizer and made.get("pre_tokenizer") == pre_tokenizer:
            letters, numbers, known = _alphabet()
            cut = re.compile(pattern.replace("L", letters).replace("N", numbers)).findall
            plain = re.compile(f"[{known}]*").fullmatch
            if normalizer is None:
                return cut, lambda word: word.isascii() or plain(word)
            # Words that the normalizer leaves as they are.
            return cut, lambda word: word == word.lower() and (
                word.isascii() or plain(word) and unicodedata.is_normalized("NFC", word)
            )
    return None


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids.

    ``spaced``: a word's ids depend on the one space before it (byte-level vocabularies).
    """

    def __init__(self, path: str, spaced: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.model._resize_cache(LIBRARY_CACHE)
        self.spaced = spaced
        self.known: dict[str, bytes] = {}
        self.met = np.zeros(MET_BITS // 8, dtype=np.uint8)
        self.model, self.cut = self.library.model, cutter(path)
        alone = self._whole([f" {MARK}" if spaced else MARK])[0]
        self.mark = np.frombuffer(alone, dtype="<u4").tolist()

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.library.encode_batch(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in encoded]

    def _encoded(self, words: list[str]) -> dict[str, bytes]:
        """Ids of many words."""
        if self.cut is None:
            return self._joined(words)
        cut, may = self.cut
        plain = [w for w in words if may(w)]
        found = self._merged(plain, cut) if plain else {}
        if len(plain) < len(words):
            found.update(self._joined([w for w in words if w not in found]))
        return found

    def _merged(self, words: list[str], cut: Callable) -> dict[str, bytes]:
        """Ids of words from their pre-tokens, each of which the model merges once."""
        places: dict[str, int] = {}
        # Words end where a null byte is, which is a pre-token of its own, without ids.
        order = [places.setdefault(part, len(places)) for part in cut("\0".join([*words, ""]))]
        end = places.pop("\0", -1)
        raw = "\0".join(places).encode().decode("latin-1")
        for char, shown in _byte_chars():
            raw = raw.replace(char, shown)
        merge = self.model.tokenize
        ids = [[token.id for token in merge(part)] for part in raw.split("\0")]
        if end >= 0:
            ids.insert(end, [])
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        begins = np.cumsum(sizes) - sizes
        flat = np.fromiter(chain.from_iterable(ids), dtype="<u4", count=int(sizes.sum()))
        # The ids of the parts in order.
        at = np.array(order, dtype=np.int64)
        ends = np.cumsum(sizes[at])
        total = int(ends[-1]) if len(ends) else 0
        whole = flat[np.repeat(begins[at] - ends + sizes[at], sizes[at]) + np.arange(total)].tobytes()
        stops = (4 * ends[at == end]).tolist()
        return {w: whole[a:b] for w, a, b in zip(words, [0, *stops], stops, strict=False)}

    def _joined(self, words: list[str]) -> dict[str, bytes]:
        """Ids of many words in few calls: set apart by a character that no such word has."""
        apart = [w for w in words if self.spaced and w[:1] != " "]
        found = dict(zip(apart, self._whole(apart))) if apart else {}
        joined = [w for w in words if not self.spaced or w[:1] == " "]
        between = f" {MARK}" if self.spaced else f" {MARK} "
        for start in range(0, len(joined), JOINED_WORDS):
            part = joined[start : start + JOINED_WORDS]
            ids = np.frombuffer(self._whole([between.join(part)])[0], dtype="<u4")
            places = np.flatnonzero(ids == self.mark[-1])
            begins = [0, *(places + 1).tolist()]
            ends = [*(places + 1 - len(self.mark)).tolist(), len(ids)]
            raw = ids.tobytes()
            found.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(part, begins, ends, strict=True))
        return found

    def _remember(self, found: dict[str, bytes]) -> None:
        """Of words just added, keeps those that an earlier call has met too."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
            self.met[:] = 0
            return
        places = np.fromiter(map(hash, found), dtype=np.int64, count=len(found)) % MET_BITS
        bits = np.left_shift(1, places & 7).astype(np.uint8)
        once = (self.met[places >> 3] & bits) == 0
        np.bitwise_or.at(self.met, places >> 3, bits)
        for word in compress(found, once.tolist()):
            del self.known[word]

    def _words(self, text: str) -> list[str] | None:
        if SPECIAL in text or (UNUSUAL_ASCII if text.isascii() else UNUSUAL).search(text):
            return None
        if not self.spaced:
            # The vocabulary ignores case, character by character and in order: not so for a capital sigma, and a
            # dotted capital I becomes two characters, which its normalizer would put in order with those after them.
            return (text if "\u03a3" in text or "\u0130" in text else text.lower()).split()
        if "  " in text or text[-1:] == " ":
            return None
        found = text.replace(" ", "\0 ").split("\0")
        return found if found[0] else found[1:]

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(self.encoded(pa.array(texts, pa.string())))

    def encoded(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text of a column, a null taken as empty. Few of a batch are held as words, or as ids, at once."""
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        places = np.cumsum(sizes, dtype=np.int64) // HELD_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(places)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:]):
            yield from self._some([x or "" for x in texts[a:b].to_pylist()])

    def _some(self, texts: list[str]) -> list[bytes]:
        split = [self._words(text) for text in texts]
        found: list[bytes | None] = [None] * len(split)
        whole = [i for i, parts in enumerate(split) if parts is None]
        if whole:
            for i, ids in zip(whole, self._whole([texts[i] for i in whole])):
                found[i] = ids
        known = self.known
        new = set().union(*[parts for parts in split if parts]).difference(known)
        fresh = self._encoded(list(new))
        known.update(fresh)
        for i, parts in enumerate(split):
            if parts is not None:
                found[i] = b"".join(map(known.__getitem__, parts))
        self._remember(fresh)
        return found


def encoder(path: str, spaced: bool) -> Encoder:
    """This worker's encoder for a vocabulary."""
    if (path, spaced) not in _ENCODERS:
        _ENCODERS[path, spaced] = Encoder(path, spaced)
    return _ENCODERS[path, spaced]
