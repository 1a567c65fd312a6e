"""Byte-level BPE by prefix dynamic programming.

For every prefix of a byte string the greedy-merge encoding has one last token,
so an encoding is a chain of last tokens.  The table of last tokens is extended
byte by byte: the last token of a prefix is the one token that ends there and
whose neighbour (the last token of the prefix before it) stays unmerged next to
it.  Appending is therefore exact and touches nothing that came before, and an
edit leaves the table before it as it is.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from quillgraph.llm.common import arrow_map, kept, texts_of

#: The pattern that splits text before the merges (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of a worker's caches of words, of pattern matches and of token pairs, each emptied when full (at most some 300 MB),
#: and the longest word that is kept.
CACHE_WORDS, CACHE_PIECES, CACHE_PAIRS, LONGEST_KEPT = 700_000, 500_000, 400_000, 64
_NEVER = 1 << 60
_WHITE_RUN = re.compile(r"\s\s|^\s|\s$")


class PrefixBPE:
    """Encoder and decoder over a rank table (token bytes -> id, lower ids merge first)."""

    def __init__(self, ranks: dict[bytes, int]):
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"vocabulary lacks single bytes: {missing[:5]}")
        self.ranks = ranks
        self.token: dict[int, bytes] = {i: t for t, i in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.joined: dict[tuple[int, int], int] = {}
        self.usable: dict[bytes, int] = {}
        for rank in sorted(self.token):
            word = self.token[rank]
            if len(word) == 1 or self._derive(word, rank):
                self.usable[word] = rank
        self.reach: dict[bytes, int] = {}  # the longest token that ends in these three bytes
        for word in self.usable:
            if len(word) > 2:
                self.reach[word[-3:]] = max(len(word), self.reach.get(word[-3:], 0))
        self._fits: dict[tuple[int, int], bool] = {}

    @classmethod
    def from_tiktoken(cls, data: bytes) -> PrefixBPE:
        """Read a ``base64 rank`` per line file."""
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a})

    def _derive(self, word: bytes, rank: int) -> bool:
        """Find the two earlier tokens whose merge makes ``word``; False if no merge order reaches it."""
        for cut in range(len(word) - 1, 0, -1):
            a, b = self.usable.get(word[:cut]), self.usable.get(word[cut:])
            if a is not None and b is not None and self._stays_apart(a, b):
                self.halves[rank] = (a, b)
                self.joined[a, b] = rank
                return True
        return False

    def _stays_apart(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` side by side are an encoding of their bytes.

        Undo merges from the latest to the earliest; if, before the merge just
        undone, the parts at the seam would have merged, the pair can't arise.
        An equal merge to the left goes first.
        """
        limit = _NEVER
        while True:
            if self.joined.get((a, b), _NEVER) < limit:
                return False
            in_a, in_b = self.halves.get(a), self.halves.get(b)
            if in_a and (not in_b or a > b):
                limit, a = a, in_a[1]
            elif in_b:
                limit, b = b + 1, in_b[0]
            else:
                return True

    def fits(self, a: int, b: int) -> bool:
        if len(self._fits) >= CACHE_PAIRS:
            self._fits.clear()
        known = self._fits[a, b] = self._stays_apart(a, b)
        return known

    def extend(self, data: bytes, last: list[int], begin: list[int]) -> None:
        """Extend a prefix table over ``data``; ``last[j]``, ``begin[j]``: last token of the first j bytes, and its start."""
        usable, reach, fits, known = self.usable, self.reach, self.fits, self._fits
        for end in range(len(last), len(data) + 1):
            for start in range(max(0, end - reach.get(data[end - 3 : end], 2)) if end > 2 else 0, end):
                token = usable.get(data[start:end])
                if token is not None and (not start or ((fit := known.get((last[start], token))) is None and fits(last[start], token)) or fit):
                    last.append(token)
                    begin.append(start)
                    break

    def table(self, data: bytes) -> tuple[list[int], list[int]]:
        last, begin = [-1], [0]
        self.extend(data, last, begin)
        return last, begin

    def append(self, table: tuple[list[int], list[int]], data: bytes) -> None:
        """``data`` is the whole string, grown at its end since ``table`` was made."""
        self.extend(data, *table)

    def edit(self, table: tuple[list[int], list[int]], data: bytes, at: int) -> None:
        """``data`` is the string after an edit whose first changed byte is ``at``: only what follows is done again."""
        del table[0][at + 1 :], table[1][at + 1 :]
        self.extend(data, *table)

    @staticmethod
    def read(table: tuple[list[int], list[int]], end: int | None = None) -> list[int]:
        """Ids of the first ``end`` bytes (all, by default)."""
        last, begin = table
        end, ids = len(last) - 1 if end is None else end, []
        while end:
            ids.append(last[end])
            end = begin[end]
        return ids[::-1]

    def encode_piece(self, piece: bytes) -> list[int]:
        token = self.usable.get(piece)
        return [token] if token is not None else self.read(self.table(piece))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class TextEncoder:
    """Whole texts to ids: pattern matches are encoded one by one, with a bounded cache of words.

    Where every white-space character of a text stands alone between others, a
    match never spans a single space or line feed on its left, so words between
    them can be encoded apart and cached whole.  Other texts are matched whole.
    """

    def __init__(self, bpe: PrefixBPE):
        self.bpe, self.find = bpe, regex.compile(PATTERN).findall
        self.inner: dict[str, bytes] = {}  # words that follow a space
        self.first: dict[str, bytes] = {}  # words that begin a line
        self.line_feed = self._whole("\n")
        self.pieces: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        out = array("I")
        for piece in self.find(text):
            out.extend(self.bpe.encode_piece(piece.encode("utf-8", "surrogatepass")))
        return out.tobytes()

    def _add(self, cache: dict[str, bytes], word: str, before: str) -> bytes:
        if len(cache) >= CACHE_WORDS:
            cache.clear()
        ids, pieces = b"", self.pieces
        for piece in self.find(before + word):
            known = pieces.get(piece)
            if known is None:
                if len(pieces) >= CACHE_PIECES:
                    pieces.clear()
                known = array("I", self.bpe.encode_piece(piece.encode("utf-8", "surrogatepass"))).tobytes()
                if len(piece) <= LONGEST_KEPT:
                    pieces[piece] = known
            ids += known
        if len(word) <= LONGEST_KEPT:
            cache[word] = ids
        return ids

    def encode(self, text: str) -> array:
        """Ids as an array of unsigned 32-bit integers."""
        ids = array("I")
        if not text:
            return ids
        if _WHITE_RUN.search(text):
            ids.frombytes(self._whole(text))
            return ids
        inner, first, add, out = self.inner, self.first, self._add, []
        for n, line in enumerate(text.split("\n")):
            if n:
                out.append(self.line_feed)
            head, *words = line.split(" ")
            if (got := first.get(head)) is None:
                got = add(first, head, "")
            out.append(got)
            found = list(map(inner.get, words))
            if None in found:
                found = [add(inner, w, " ") if f is None else f for f, w in zip(found, words, strict=True)]
            out += found
        ids.frombytes(b"".join(out))
        return ids


def encoder_for(data: bytes) -> tuple[TextEncoder, list[bytes]]:
    """This process's encoder of a rank file, and the decimal digits of each id."""

    def made() -> tuple[TextEncoder, list[bytes]]:
        bpe = PrefixBPE.from_tiktoken(data)
        return TextEncoder(bpe), [b"%d" % i for i in range(max(bpe.token) + 1)]

    return kept(("ranks", hashlib.sha256(data).hexdigest()), made)


def tokenized(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids array<int>`` of every whole text (null: empty text, no ids).

    ``vocabulary``: path of a rank file.  It is read on the driver and sent to
    the workers; its size is that of the vocabulary, whatever the input.
    """
    data = docs.sparkSession.sparkContext.broadcast(open(vocabulary, "rb").read())

    def make():
        text_encoder, _ = encoder_for(data.value)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [text_encoder.encode(t) for t in texts_of(batch)]
            return pa.record_batch([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

        return one

    return arrow_map(docs.select("doc_id", "text"), make, "doc_id long, ids array<int>", keeps=True)


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode every whole text, decode the ids, and digest both.

    Returns ``doc_id, n_tokens, ids_sha256, decoded_sha256``: the hash of the
    decimal ids joined by commas, and that of the decoded bytes.  A null text
    counts as empty: no ids, hashes of nothing.  A map without a shuffle; rows
    that repeat give repeated results; other columns are dropped.
    """
    data = docs.sparkSession.sparkContext.broadcast(open(vocabulary, "rb").read())

    def make():
        text_encoder, digits = encoder_for(data.value)
        decode, sha = text_encoder.bpe.decode, hashlib.sha256

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ids_sha, text_sha = [], [], []
            for text in texts_of(batch):
                ids = text_encoder.encode(text).tolist()
                n.append(len(ids))
                ids_sha.append(sha(b",".join(map(digits.__getitem__, ids))).hexdigest())
                text_sha.append(sha(decode(ids)).hexdigest())
            return pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

        return one

    return arrow_map(docs.select("doc_id", "text"), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", keeps=True)
