"""Words of many texts as 64-bit hashes, found with array operations on their bytes."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and their inverses, modulo 2 ** 64."""
    global _powers
    if len(_powers[0]) < size:
        size = max(size, 1 << 16)
        inverse = pow(_BASE, -1, 1 << 64)
        both = []
        for base in (_BASE, inverse):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            both.append(np.cumprod(table))
        _powers = both[0], both[1]
    return _powers


class Words:
    """The words of some texts in lower case: runs of ASCII letters, digits and all other characters above ASCII.

    `start` and `end` are byte places in all texts together, `offsets` the first word of each text and,
    at the end, the number of words; `base` are the byte places of the texts.
    """

    def __init__(self, texts: pa.Array):
        lower = pc.utf8_lower(pc.fill_null(texts, ""))
        _, offsets, data = lower.buffers()
        places = np.frombuffer(offsets, np.int32)[lower.offset : lower.offset + len(lower) + 1] if len(lower) else np.zeros(1, np.int32)
        self.base = places - places[0]
        raw = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data is not None else np.empty(0, np.uint8)
        self.bytes = raw
        letter = _LETTER[raw]
        before = np.concatenate([[False], letter[:-1]]) if len(raw) else letter
        after = np.concatenate([letter[1:], [False]]) if len(raw) else letter
        inner = self.base[(self.base > 0) & (self.base < len(raw))]
        before[inner] = False
        after[inner - 1] = False
        self.start = np.flatnonzero(letter & ~before)
        self.end = np.flatnonzero(letter & ~after) + 1
        self.offsets = np.searchsorted(self.start, self.base)
        up, self._down = _tables(len(raw) + 1)
        self._sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=self._sums[1:])
        self._hashes: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Hash of the bytes from `start` to `end`, of whole words if not given; equal bytes, equal hashes."""
        if start is None and end is None:
            if self._hashes is None:
                self._hashes = self.hashes(self.start, self.end)
                self._hashes.flags.writeable = False
            return self._hashes
        start = self.start if start is None else start
        end = self.end if end is None else end
        h = (self._sums[end] - self._sums[start]) * self._down[start]
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


class Table:
    """Membership of hashes in a sorted set, with a bit map that turns most others away."""

    def __init__(self, hashes: np.ndarray):
        self.order = np.sort(hashes.astype(np.uint64))
        bits = max(16, int(len(hashes) * 16).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.map = np.zeros(1 << bits, bool)
        self.map[(self.order & self.mask).astype(np.int64)] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in `hashes` that are in the set, and their ranks in the set's order."""
        maybe = np.flatnonzero(self.map[(hashes & self.mask).astype(np.int64)])
        rank = np.searchsorted(self.order, hashes[maybe])
        rank[rank == len(self.order)] = 0
        hit = self.order[rank] == hashes[maybe] if len(self.order) else np.zeros(len(maybe), bool)
        return maybe[hit], rank[hit]
