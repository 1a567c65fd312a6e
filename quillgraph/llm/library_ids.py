"""Ids of the ``tokenizers`` library for whole texts, with bounded caches of words.

White space ends a match in both public vocabularies used here, so a text is cut
into words, and the library's own merge model encodes each distinct piece of a
word once.  A word keeps the line feed before it, or else stands for itself and
the space before it.  Words with characters beyond Latin-1 (where normalisation
matters) and texts where white space runs together go through the whole library.
"""

from __future__ import annotations

import hashlib
import re
from array import array

from tokenizers import Tokenizer

from quillgraph.llm.common import kept

#: Entries of a worker's caches of words and of pieces, each emptied when full, and the longest word that is kept.
CACHE_WORDS, CACHE_PIECES, LONGEST_KEPT = 600_000, 500_000, 64
_BEYOND = re.compile("[^\\t\\n\\r -~¡-ÿ]")
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")
#: Letters, numbers and the rest among the characters up to U+00FF (fixed values of Unicode).
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾"
_BYTE_LEVEL = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
_WORD_END = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\s{_L}{_N}]+")


def _byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: itself where printable, else the next one from U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)}


_LETTERS = _byte_letters()


class LibraryEncoder:
    """``encode(text)``: the ids, as little-endian unsigned 32-bit bytes.  ``spaced``: a space belongs to the word after it."""

    def __init__(self, definition: bytes):
        self.whole = Tokenizer.from_buffer(definition)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self.whole.no_padding()
        self.whole.no_truncation()
        self.model = self.whole.model
        self.spaced = self.whole.normalizer is None
        self.find = (_BYTE_LEVEL if self.spaced else _WORD_END).findall
        self.inner: dict[str, bytes] = {}
        self.first: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _library(self, text: str) -> bytes:
        return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()

    def _add(self, cache: dict[str, bytes], word: str, before: str) -> bytes | None:
        """The ids of a word; None where its white space may run on into its neighbours."""
        if self.spaced:
            if word[:1] == "\n":
                before = ""
            if not word or word[-1].isspace() or word.removeprefix("\n")[0].isspace():
                return None
        if len(cache) >= CACHE_WORDS:
            cache.clear()
        if _BEYOND.search(word):
            ids = self._library(before + word)
        else:
            ids, pieces = b"", self.pieces
            for piece in self.find(before + word if self.spaced else word.lower()):
                known = pieces.get(piece)
                if known is None:
                    if len(pieces) >= CACHE_PIECES:
                        pieces.clear()
                    letters = piece.encode().decode("latin-1").translate(_LETTERS)
                    known = array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
                    if len(piece) <= LONGEST_KEPT:
                        pieces[piece] = known
                ids += known
        if len(word) <= LONGEST_KEPT:
            cache[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.spaced:
            words = text.replace("\n", " \n").split(" ")
            head = words[0]
            begin = self.first.get(head)
            if begin is None and (begin := self._add(self.first, head, "")) is None:
                return self._library(text)
            del words[0]
        else:
            if any(c in text for c in _SEPARATORS):
                return self._library(text)  # str.split() parts words there, the library doesn't
            words, begin = text.split(), b""
        found = list(map(self.inner.get, words))
        if None in found:
            at = -1
            for _ in range(found.count(None)):
                at = found.index(None, at + 1)
                if (ids := self._add(self.inner, words[at], " ")) is None:
                    return self._library(text)
                found[at] = ids
        return begin + b"".join(found)


def encoder_for(definition: bytes) -> LibraryEncoder:
    """This process's encoder of a tokenizer definition."""
    return kept(("library", hashlib.sha256(definition).hexdigest()), lambda: LibraryEncoder(definition))
