"""The words of a batch of texts as byte ranges of one buffer, with hashes of all of them at once.

Words are runs of bytes other than the six ASCII white-space characters; no word
becomes an object of its own, so a batch costs a few arrays.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
#: Longer words are hashed one by one.
_BY_BLOCKS = 512


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class Words:
    """``data`` holds the texts, a space after each; text ``i`` is ``data[offsets[i] : offsets[i + 1] - 1]``.

    Word ``k`` is ``data[starts[k] : ends[k]]``, and text ``i`` has the words
    ``first[i]`` to ``first[i + 1] - 1``.  A null text has none.
    """

    def __init__(self, texts: pa.Array):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        closed = pc.binary_join_element_wise(texts, pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
        _, offsets, data = closed.buffers()
        offsets = np.frombuffer(offsets, np.int64)[closed.offset : closed.offset + len(closed) + 1]
        n = int(offsets[-1] - offsets[0])
        self.offsets = offsets - offsets[0]
        self._padded = np.zeros(n + 8, np.uint8)
        if n:
            self._padded[:n] = np.frombuffer(data, np.uint8)[offsets[0] : offsets[0] + n]
        self.data = self._padded[:n]
        space = _SPACE[self.data]
        edge = space[1:] != space[:-1]
        change = np.flatnonzero(edge) + 1
        if n and not space[0]:
            change = np.concatenate([[0], change])
        self.starts, self.ends = change[0::2], change[1::2]  # the last byte is a space
        self.first = np.searchsorted(self.starts, self.offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """64 bits for each word."""
        eight = np.ndarray((len(self.data) + 1,), "<u8", self._padded.data, strides=(1,))
        length = self.ends - self.starts
        out = mix(length.astype(np.uint64) ^ (eight[self.starts] & _MASKS[np.minimum(length, 8)]) * _M2)
        at, more = 8, np.flatnonzero((length > 8) & (length <= _BY_BLOCKS))
        while len(more):
            block = eight[self.starts[more] + at] & _MASKS[np.minimum(length[more] - at, 8)]
            out[more] = mix((out[more] + _M1) ^ block * _M2)
            at += 8
            more = more[length[more] > at]
        for k in np.flatnonzero(length > _BY_BLOCKS).tolist():
            out[k] = xxhash.xxh3_64_intdigest(self.data[self.starts[k] : self.ends[k]].tobytes())
        return out

    def joined(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The kept words, a space after each: their bytes, and the offsets of the texts in them."""
        starts, ends = self.starts[keep], self.ends[keep]
        change = np.zeros(len(self.data) + 1, np.int8)
        change[starts] = 1
        change[ends + 1] -= 1
        data = self.data.copy()
        data[ends] = 0x20
        size = np.concatenate([[0], np.cumsum(ends - starts + 1)])
        kept_before = np.concatenate([[0], np.cumsum(keep)])
        return data[np.cumsum(change[:-1], dtype=np.int8) > 0], size[kept_before[self.first]]
