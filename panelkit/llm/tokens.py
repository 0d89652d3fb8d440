"""Token ids of many texts by a tokenizer file, with the ids of units remembered.

The tokenizers used here cut a text at white space before they do anything else, so the ids of a text are those of
its units in order, and a unit met before need not be encoded again. A unit is a run of characters outside ASCII
white space; if the tokenizer keeps white space, with the one space before it, and what other white space
remains is a unit by itself, as the tokenizer cuts it. Texts for which this may not hold (white space beyond ASCII,
the strings of special tokens) are encoded whole.

Units are found in the bytes of a whole batch, told apart by 64-bit hashes, and their ids gathered by number, all in numpy; Python
sees only units that were not met before. Two different units of a batch share a hash with a chance of about 2**-64.

Only the library encodes, never this module; but a unit of plain letters and punctuation goes straight to the library's
model, as its letters and its punctuation are one piece each for these tokenizers.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from .common import utf8
from .wordscan import SPACE, run_hashes, runs

REMEMBERED = 1_000_000  # units; beyond it, all are forgotten

_UNSURE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
_PLAIN = re.compile(r"( ?)([A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*)([!-&(-/:-@\[-`{-~]*)")

# bytes with which, or after 0xE2 with which two, a character of _UNSURE may begin
_MAYBE = np.zeros(256, bool)
_MAYBE[[*range(0x1C, 0x20), 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
_MAYBE_NEXT = np.zeros(256, bool)  # the second byte of such a character
_MAYBE_NEXT[[0x85, 0xA0, 0x9A, 0x80, 0x81, 0xBB]] = True


def _byte_letters() -> dict[int, str]:
    """What stands for each byte in a byte-level vocabulary: itself if printable, else letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()


class _Known:
    """The ids of the units met so far: hashes in order, and of each where its ids begin and how many they are."""

    def __init__(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        """Which of some hashes are not known yet."""
        if not len(self.hashes):
            return np.ones(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return self.hashes[at] != hashes

    def add(self, hashes: np.ndarray, ids: list[list[int]]) -> None:
        """New units, in order of hash."""
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        first = len(self.ids) + np.cumsum(count) - count
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.first, self.count = (
            np.insert(old, at, new) for old, new in ((self.hashes, hashes), (self.first, first), (self.count, count))
        )
        self.ids = np.concatenate((self.ids, np.array([i for x in ids for i in x], np.uint32)))


class Encoder:
    """Encodes texts as little-endian unsigned 32-bit ids, without special tokens around them."""

    def __init__(self, path: str):
        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._keeps_spaces = spec.get("normalizer") is None
        self._special = [t["content"] for t in spec.get("added_tokens", [])]
        self._known = _Known()

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """The ids of each text; null has none."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        data, offsets = utf8(texts)
        if offsets[-1] == offsets[0]:
            return [b""] * len(texts)
        whole = self._whole(data, offsets)
        start, end = self._bounds(data, offsets)
        if whole:  # their units are not needed
            units = ~np.isin(np.searchsorted(offsets, start, side="right") - 1, list(whole))
            start, end = start[units], end[units]
        ids, before = self._gather(data, start, end)
        cuts = before[np.searchsorted(start, offsets)]
        out = [ids[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        for i in whole:
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
            out[i] = np.array(self._library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return out

    def _whole(self, data: np.ndarray, offsets: np.ndarray) -> set[int]:
        """The texts that cannot be cut."""
        low, high = int(offsets[0]), int(offsets[-1])
        own = data[low:high]
        at = np.flatnonzero(_MAYBE[own])
        at = at[(own[at] < 0x80) | _MAYBE_NEXT[own[np.minimum(at + 1, len(own) - 1)]]]
        rows = np.unique(np.searchsorted(offsets, at + low, side="right") - 1)
        found = {int(i) for i in rows if _UNSURE.search(data[offsets[i] : offsets[i + 1]].tobytes().decode())}
        raw = own.tobytes()
        for special in map(str.encode, self._special):
            place = raw.find(special)
            while place >= 0:
                row = int(np.searchsorted(offsets, place + low, side="right")) - 1
                if place + low + len(special) <= offsets[row + 1]:
                    found.add(row)
                place = raw.find(special, place + 1)
        return found

    def _bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where units begin and end."""
        if not self._keeps_spaces:
            words = runs(data, offsets)
            return words.start, words.end
        low, high = int(offsets[0]), int(offsets[-1])
        own = data[low:high]
        space = SPACE[own]
        edge = np.zeros(len(own) + 1, bool)  # a text begins here
        edge[offsets - low] = True
        begins = edge[:-1].copy()
        after = np.concatenate(([False], space[:-1]))
        begins |= space & ~after
        begins |= ~space & after & np.concatenate(([False], own[:-1] != 0x20))
        begins[:-1] |= space[:-1] & ~space[1:] & ~edge[1:-1]  # the last of some white space before a word
        start = np.flatnonzero(begins) + low
        return start, np.append(start[1:], high)

    def _gather(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, and how many lie before each unit and after the last."""
        known = self._known
        if len(known.hashes) > REMEMBERED:
            known = self._known = _Known()
        hashes, first, of = np.unique(run_hashes(data, start, end), return_index=True, return_inverse=True)
        new = np.flatnonzero(known.missing(hashes))
        if len(new):
            known.add(hashes[new], [self._unit(data[start[i] : end[i]].tobytes().decode()) for i in first[new]])
        at = np.searchsorted(known.hashes, hashes)
        count = known.count[at][of]
        before = np.concatenate(([0], np.cumsum(count)))
        places = np.arange(before[-1]) + np.repeat(known.first[at][of] - before[:-1], count)
        return known.ids[places].astype("<u4", copy=False), before

    def _unit(self, unit: str) -> list[int]:
        """The ids of a unit that was not met before."""
        plain = _PLAIN.fullmatch(unit)
        if not plain or any(s in unit for s in self._special):
            return self._library.encode(unit, add_special_tokens=False).ids
        space, letters, marks = plain.groups()
        if not self._keeps_spaces:
            letters = letters.lower()
        elif letters:
            letters = space + letters
        else:
            marks = space + marks
        tokenize = self._library.model.tokenize
        return [t.id for part in (letters, marks) if part for t in tokenize(part.encode().decode("latin-1").translate(_LETTERS))]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file, kept for the tasks that follow in the same Python process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
