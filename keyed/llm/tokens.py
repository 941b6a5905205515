"""Ids of public tokenizers, a batch of texts at a time.

Texts are split at single spaces between two other characters: neither of the supported tokenizers joins what stands on
both sides of one, so the ids of the pieces are the ids of the text. Most pieces have been seen before; the ids of new
ones come from the library, in batches of bounded bytes. A text of any length is worked on piece by piece.
"""

from __future__ import annotations

import functools
import itertools
import re
from array import array

from tokenizers import Tokenizer

from keyed.llm.common import utf8

#: Pieces of a generation: beyond it the older generation is dropped. Bounds a worker's memory.
KEPT_PIECES = 400_000
#: Pieces longer than this are not kept.
KEPT_CHARS = 64
#: Bytes of one call of the library.
BATCH_BYTES = 64 << 10

#: Lines of one word of letters and other marks after it; the marks hold no apostrophe. No token spans a border of these.
_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_MARKS = r"[!-&(-/:-@\[-`{-~]*"
_PLAIN = re.compile(f"{_LETTERS}{_MARKS}(?:\n{_LETTERS}{_MARKS})*")
_PARTS = re.compile(f"\n|{_LETTERS}|{_MARKS[:-1]}+")
_SPLIT = re.compile(r"(?<=\S) (?=\S)")
#: White space that may stand beside a space; any of it makes the split look at each space.
_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
_ASCII_SPACES = [c for c in _SPACES if c < "\x80"]


def _byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


def split_text(text: str) -> list[str]:
    """Pieces that give the text when joined by a space."""
    spaces = _ASCII_SPACES if text.isascii() else _SPACES
    if "  " in text or text[:1] == " " or text[-1:] == " " or any(f"{c} " in text or f" {c}" in text for c in spaces if c in text):
        return _SPLIT.split(text)
    return text.split(" ")


class Encoder:
    """Ids as packed little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.spaced = self._whole(" a") != self._whole("a")
        self.lead = " " if self.spaced else ""
        self._map = dict(enumerate(_byte_chars()))
        self._space = self._map[32] if self.spaced else ""
        self.first: dict[str, bytes] = {}  # pieces without a space before them
        self.rest: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self._marks: dict[str, bytes] = {}
        probes = ["a", "the", "Zebra", "héllo", "Über", "qqqzzz", "stupid", "ÿç"]
        self._direct = all(self._word(self._space * bool(x), w) == self._whole(x + w) for w in probes for x in ("", " "))

    def _whole(self, text: str) -> bytes:
        return _packed(self.library.encode(text, add_special_tokens=False).ids)

    def _word(self, space: str, word: str) -> bytes:
        """Ids of letters alone: one word to the tokenizer, so its model can be asked directly."""
        if not self.spaced:
            word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self._map)
        return _packed([t.id for t in self.library.model.tokenize(space + word)])

    def _plain(self, store: dict[str, bytes], space: str, piece: str) -> bytes:
        ids, lead = [], space
        for part in _PARTS.findall(piece):
            if part[0].isalpha():
                if lead == space and part in store:
                    ids.append(store[part])
                else:
                    ids.append(self._word(lead, part))
                    if lead == space and part != piece:
                        store[part] = ids[-1]
            else:
                if part not in self._marks:
                    self._marks[part] = self._whole(part)
                ids.append(self._marks[part])
            lead = ""
        return b"".join(ids)

    def _learn(self, store: dict[str, bytes], new: set[str], lead: str) -> dict[str, bytes]:
        """Adds the pieces; returns the ids of those too long to keep."""
        odd, long, space = [], {}, self._space if lead else ""
        for piece in new:
            if self._direct and len(piece) <= KEPT_CHARS and _PLAIN.fullmatch(piece):
                store[piece] = self._plain(store, space, piece)
            else:
                odd.append(piece)
        at = 0
        while at < len(odd):
            lot, size = [], 0
            while at < len(odd) and (not lot or size + len(odd[at]) <= BATCH_BYTES):
                lot.append(odd[at])
                size += len(odd[at])
                at += 1
            for piece, e in zip(lot, self.library.encode_batch_fast([lead + p for p in lot], add_special_tokens=False), strict=True):
                (store if len(piece) <= KEPT_CHARS else long)[piece] = _packed(e.ids)
        return long

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts; nulls count as empty."""
        if len(self.rest) > KEPT_PIECES:
            self.rest, self.old = {}, self.rest
        if len(self.first) + len(self._marks) > KEPT_PIECES:
            self.first, self._marks = {}, {}
        pieces = [split_text(t if _clean(t) else utf8(t).decode("utf-8", "replace")) for t in (t or "" for t in texts)]
        wanted: set[str] = set()
        wanted.update(*pieces)
        wanted = wanted.difference(self.rest)
        if self.old:
            self.rest.update({p: self.old[p] for p in wanted if p in self.old})
            wanted = wanted.difference(self.rest)
        rest = self._getter(self.rest, wanted, self.lead)
        first = self._getter(self.first, {p[0] for p in pieces}.difference(self.first), "")
        return [first(p[0]) + b"".join(map(rest, itertools.islice(p, 1, None))) for p in pieces]

    def _getter(self, store: dict[str, bytes], wanted: set[str], lead: str):
        long = self._learn(store, wanted, lead)
        return (lambda p: long[p] if p in long else store[p]) if long else store.__getitem__


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


def _clean(text: str) -> bool:
    try:
        text.encode()
    except UnicodeEncodeError:
        return False
    return True


@functools.cache
def encoder(path: str) -> Encoder:
    """One per Python worker and file."""
    return Encoder(path)
