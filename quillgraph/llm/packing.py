"""Sum-of-squares online packing of token sequences into fixed windows."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quillgraph.llm.common import batched, texts_of
from quillgraph.llm.library_ids import encoder_for

WINDOW = 2048
END_ID = 1
#: Ids of a unit: documents are cut at the last whole unit, so that windows and units fill up from few sizes.
UNIT = 32
#: Partly filled windows that a packer holds (at most 2048 ids each); beyond it, they are drained.
OPEN_WINDOWS = 4096
Piece = tuple[object, int, bytes, int]  # document, start, ids as bytes, ids of the document


class FillLevels:
    """Sum-of-squares placement: ``counts[h]`` bins are filled to ``h``, for 0 < h < size.

    An item of size s moves a bin from h to h + s (h = 0: a new bin; h + s =
    size: it closes), and the move that changes the sum of squared counts least
    is taken, ties to the fullest bin.
    """

    def __init__(self, size: int):
        self.size, self.n_open = size, 0
        self.counts = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[list[Piece]]] = defaultdict(list)

    def level_for(self, size: int) -> int:
        """The fill level, 0 for a new bin, that an item of ``size`` (less than a bin) goes to."""
        c, last = self.counts, self.size - size
        change = 2 * (c[size : self.size + 1] - c[: last + 1]) + 2
        change[0] = 2 * c[size] + 1
        if last:
            change[last] = 1 - 2 * c[last]
            change[1:][c[1 : last + 1] == 0] = np.iinfo(np.int64).max
        return last - int(np.argmin(change[::-1]))

    def put(self, pieces: list[Piece], size: int) -> list[Piece] | None:
        """Place an item; the pieces of the bin if that closes it."""
        if size == self.size:
            return pieces
        level = self.level_for(size)
        if level:
            held = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
            held += pieces
        else:
            held = list(pieces)
        if level + size == self.size:
            return held
        self.open[level + size].append(held)
        self.counts[level + size] += 1
        self.n_open += 1
        return None

    def emptied(self) -> list[Piece]:
        """The pieces of all open bins, the fullest first; no bin is open then."""
        pieces = [p for level in sorted(self.open, reverse=True) for held in self.open[level] for p in held]
        self.open.clear()
        self.counts[:] = 0
        self.n_open = 0
        return pieces


class SumOfSquaresPacker:
    """Fills windows with whole units, and units with what is left of documents, both by sum of squares.

    A document's whole windows go as they are.  The rest is cut at its last
    whole unit: the units before are placed in a window, the ids after it in a
    unit, and a unit that closes is placed in a window in its turn.  ``drain``
    lays the pieces of all open windows and units end to end and cuts them into
    full windows; what is left, under one window, is cut into falling powers of
    two, which need no padding.  ``placed`` and ``drained`` count the windows of
    several documents that closed in either way.
    """

    def __init__(self, window: int = WINDOW, most_open: int = OPEN_WINDOWS, unit: int = UNIT):
        if window % unit:
            raise ValueError("a window must be whole units")
        self.window, self.unit, self.most_open = window, unit, most_open
        self.windows, self.units = FillLevels(window // unit), FillLevels(unit)
        self.placed = self.drained = 0

    @property
    def n_open(self) -> int:
        return self.windows.n_open + self.units.n_open

    def put(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place a document's ids; give out the windows that close."""
        yield from self._place(piece)
        if self.n_open > self.most_open:
            yield from self.drain(keep_rest=True)

    def _place(self, piece: Piece) -> Iterator[list[Piece]]:
        doc, start, ids, total = piece
        step = 4 * self.window
        for at in range(0, len(ids) - step + 1, step):  # whole windows of a long document
            yield [(doc, start + at // 4, ids[at : at + step], total)]
        head = len(ids) - len(ids) % step
        tail = len(ids) - len(ids) % (4 * self.unit)
        closed = []
        if tail > head:
            closed.append(self.windows.put([(doc, start + head // 4, ids[head:tail], total)], (tail - head) // (4 * self.unit)))
        if len(ids) > tail and (whole := self.units.put([(doc, start + tail // 4, ids[tail:], total)], len(ids) // 4 - tail // 4)):
            closed.append(self.windows.put(whole, 1))
        for window in closed:
            if window:
                self.placed += 1
                yield window

    def drain(self, keep_rest: bool = False) -> Iterator[list[Piece]]:
        """Close every open window.  ``keep_rest``: what doesn't fill a window is placed again instead."""
        pieces = self.windows.emptied() + self.units.emptied()
        window, free = [], self.window
        left = sum(len(p[2]) for p in pieces) // 4
        full = left - left % self.window
        for doc, start, ids, total in pieces:
            while ids:
                if full <= 0 and not window:
                    if keep_rest:
                        yield from self._place((doc, start, ids, total))
                        break
                    free = 1 << (left.bit_length() - 1)
                take = min(free, len(ids) // 4)
                window.append((doc, start, ids[: 4 * take], total))
                start, ids, free, left, full = start + take, ids[4 * take :], free - take, left - take, full - take
                if not free:
                    self.drained += 1
                    yield window
                    window, free = [], self.window


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed(docs: DataFrame, definition: str, with_ids: bool = False, window: int = WINDOW) -> DataFrame:
    """Tokenize every whole text, end it with id 1, and pack it into sequences of at most 2048 ids.

    A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset`` (and ``ids`` if asked for).  Every task packs its own
    rows, so there is no shuffle, and a task that runs again gives the same
    sequences; ``sequence_id`` has the task's partition in its upper bits.
    Memory is bounded by one batch and ``OPEN_WINDOWS`` windows and units.  No sequence
    but those of 2^k ids is shorter than a window, so nothing is padded; a task
    makes at most 11 such.  A null or empty text is the end id alone; rows that
    repeat are packed as often as they come; other columns are dropped.
    """
    data = docs.sparkSession.sparkContext.broadcast(open(definition, "rb").read())
    batched(docs.sparkSession)
    end, schema = END_ID.to_bytes(4, "little"), PIECES + ", ids binary" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, packer = encoder_for(data.value), SumOfSquaresPacker(window)
        base, made = TaskContext.get().partitionId() << 40, 0

        def rows(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal made
            out: list[tuple] = []
            for pieces in windows:
                at = 0
                for doc, start, ids, total in pieces:
                    n = len(ids) // 4
                    out.append((doc, start, n, zlib.crc32(ids), total, base + made, at, ids))
                    at += n
                made += 1
            names = [c.split()[0] for c in schema.split(", ")]
            kinds = [*[pa.int64()] * 7, pa.binary()]
            return pa.record_batch([pa.array(v, k) for v, k, _ in zip(zip(*out, strict=True), kinds, names)], names)

        for batch in batches:
            closed: list[list[Piece]] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                ids = library.encode(text) + end
                closed += packer.put((doc, 0, ids, len(ids) // 4))
            if closed:
                yield rows(closed)
        if closed := list(packer.drain()):
            yield rows(closed)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
