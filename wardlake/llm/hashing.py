"""64-bit hashes of words, vectorised over the bytes of a whole Arrow column."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

_U = np.uint64
_POWER = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A finalising 64-bit hash."""
    x = x + _U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (1 << 64) - 1)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@functools.lru_cache(maxsize=1)
def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    up, down = np.full(size, _POWER, _U), np.full(size, pow(_POWER, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


BYTE = mixed(np.arange(256, dtype=_U), 1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes of words cut at white space only, and of words cut at all ASCII but letters and digits.
UNSPACED = np.ones(256, bool)
UNSPACED[[32, *range(9, 14)]] = False
ALPHANUMERIC = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow string array, and where texts start and end."""
    column = column.cast(pa.large_string())
    _, raw_offsets, raw = column.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words:
    """The lower-cased words of texts: ``starts`` and ``ends`` in the bytes, and for each text
    where its words begin (``first``, with one more entry)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = UNSPACED):
        inside = in_word[data]
        before = np.zeros_like(inside)
        before[1:] = inside[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros_like(inside)
        after[:-1] = inside[1:]
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, offsets)
        up, self.down = powers(1 << max(16, int(len(data)).bit_length()))
        self.total = np.zeros(len(data) + 1, _U)
        np.cumsum(BYTE[LOWER[data]] * up[: len(data)], out=self.total[1:])

    def hashes(self, most: int | None = None) -> np.ndarray:
        """Hashes of the words, or of their first ``most`` bytes."""
        ends = self.ends if most is None else np.minimum(self.ends, self.starts + most)
        return mixed((self.total[ends] - self.total[self.starts]) * self.down[self.starts])


def as_lists(found: list[np.ndarray]) -> pa.ListArray:
    """Arrays of hashes as lists of long."""
    flat = np.concatenate(found) if found else np.zeros(0, _U)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), pa.array(flat.view(np.int64)))


def as_arrays(column: pa.ListArray) -> list[np.ndarray]:
    flat, ends = column.values.to_numpy().view(_U), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
