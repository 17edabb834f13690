"""Texts cut into units that a tokenizer treats apart, each unit encoded once.

Tokenizers never join symbols across certain places (before a blank that
follows a word). Texts are cut there with numpy; a block's distinct units are
looked up in a bounded memory of the worker, and only new ones are encoded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np

from twinledger.llm.textblocks import hash_texts

#: Units remembered by one Python worker; beyond it the memory starts afresh.
MEMORY_UNITS = 1_200_000
_LONG = 64

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = True
_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord(c) for c in ".,;:!?"]] = True
# Last bytes of blanks beyond ASCII (U+0085, U+00A0, U+1680, U+2000-200A,
# U+2028, U+2029, U+202F, U+205F, U+3000).
_WIDE_BLANK_END = np.zeros(256, dtype=bool)
_WIDE_BLANK_END[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = True


def _shifted(flags: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros(len(flags), dtype=bool)
    out[by:] = flags[:-by] if by < len(flags) else False
    return out


def cut_before_blanks(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Unit starts: each blank run begins a unit with the word that follows it.

    No cut where the character before might be a blank beyond ASCII.
    """
    blank = _BLANK[raw]
    cut = blank & ~_shifted(blank, 1)
    wide = _WIDE_BLANK_END[raw]
    wide &= _shifted(raw == 0xC2, 1) | _shifted((raw >= 0xE1) & (raw <= 0xE3), 2)
    return _starts(cut & ~_shifted(wide, 1), offsets)


def cut_before_spaces(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Unit starts: each run of U+0020 or U+2581 begins a unit."""
    space = raw == 32
    low = _shifted(_shifted(raw == 0xE2, 1) & (raw == 0x96), 1) & (raw == 0x81)  # last byte of U+2581
    first = np.zeros(len(raw), dtype=bool)
    first[:-2] = low[2:]
    return _starts((space | first) & ~_shifted(space | low, 1), offsets)


def cut_words(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Unit starts: after each blank, and at a stop that follows a letter or digit."""
    blank = _BLANK[raw]
    return _starts((~blank & _shifted(blank, 1)) | (_STOPS[raw] & _shifted(_ALNUM[raw], 1)), offsets)


def _starts(cut: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    if not len(cut):
        return np.zeros(0, dtype=np.int64)
    cut[offsets[:-1][offsets[:-1] < len(cut)]] = True
    return np.flatnonzero(cut)


class Ragged:
    """Integer sequences, one after another, that can grow."""

    def __init__(self) -> None:
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.ends = np.zeros(1 << 16, dtype=np.int64)
        self.rows = self.used = 0

    def append(self, lengths: np.ndarray, flat: np.ndarray) -> np.ndarray:
        """Adds sequences and returns their row numbers."""
        rows = np.arange(self.rows, self.rows + len(lengths))
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.rows + len(lengths) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.flat[self.used : self.used + len(flat)] = flat
        self.ends[self.rows : self.rows + len(lengths)] = self.used + np.cumsum(lengths)
        self.rows += len(lengths)
        self.used += len(flat)
        return rows

    def lengths(self, rows: np.ndarray) -> np.ndarray:
        return self.ends[rows] - np.where(rows > 0, self.ends[rows - 1], 0)

    def gather(self, rows: np.ndarray) -> np.ndarray:
        """The sequences of these rows, in this order, as one array."""
        lengths = self.lengths(rows)
        total = int(lengths.sum())
        shift = np.repeat(self.ends[rows] - np.cumsum(lengths), lengths)
        return self.flat[np.arange(total) + shift]


class UnitMemory:
    """Encodes each distinct unit once; `encode` maps a list of units to lengths and ids."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.encode = encode
        self.known: dict[int, int] = {}
        self.store = Ragged()

    def rows(
        self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: np.ndarray | None = None
    ) -> np.ndarray:
        """Row of the store for every unit. Valid until the next call.

        Units are told apart by a 64-bit hash of their bytes in `key`, the text
        itself if not given (a case-folded copy, where case does not matter).
        """
        if len(self.known) > MEMORY_UNITS:
            self.known, self.store = {}, Ragged()
        key = raw if key is None else key
        hashes = hash_texts(key, starts, ends)
        data, long = raw.tobytes(), np.flatnonzero(ends - starts > _LONG).tolist()
        for i in long:
            digest = hashlib.blake2b(key[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
            hashes[i] = int.from_bytes(digest, "little")
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        keys = distinct.tolist()
        get = self.known.get
        rows = np.fromiter((get(k, -1) for k in keys), dtype=np.int64, count=len(keys))
        new = np.flatnonzero(rows < 0)
        if len(new):
            at = first[new]
            lengths, flat = self.encode([data[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            rows[new] = self.store.append(lengths, flat)
            self.known.update(zip(distinct[new].tolist(), rows[new].tolist()))
        return rows[back]


def per_text(values: np.ndarray, starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a value per unit over the units of each text."""
    sums = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=sums[1:])
    return np.diff(sums[np.searchsorted(starts, offsets)])
