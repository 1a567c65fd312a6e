"""The search language: words, "phrases", prefix*, AND, OR, NOT; a query that can't be read is all its words."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillgraph.functions.text import ACCENTED, PLAIN

_PIECE = re.compile(r'"([^"]*)"(\*?)|([()])|([^\s()"]+)')
Leaf = tuple[str, str, bool]  # "leaf", folded words, whether the last is a prefix


def folded(words: str) -> str:
    plain = words.lower().translate(str.maketrans(ACCENTED, PLAIN))
    return re.sub("[^a-z0-9]+", " ", plain).strip()


def _pieces(query: str) -> list:
    out: list = []
    for m in _PIECE.finditer(query):
        if m[3]:
            out.append(m[3])
        elif m[4] in ("AND", "OR", "NOT"):
            out.append(m[4])
        else:
            raw, star = (m[1], bool(m[2])) if m[1] is not None else (m[4].rstrip("*"), m[4].endswith("*"))
            if words := folded(raw):
                out.append(("leaf", words, star))
    return out


def parsed(query: str):
    """A tree of ("and" | "or" | "not", a, b) and leaves; None for a query without words."""
    pieces = _pieces(query)
    at = 0

    def peek():
        return pieces[at] if at < len(pieces) else None

    def step():
        nonlocal at
        at += 1
        return pieces[at - 1]

    def one():
        piece = peek()
        if piece == "(":
            step()
            tree = either()
            if peek() != ")":
                raise ValueError("bracket")
            step()
            return tree
        if not isinstance(piece, tuple):
            raise ValueError("operator without a word")
        return step()

    def without():
        tree = one()
        while peek() == "NOT":
            step()
            tree = ("not", tree, one())
        return tree

    def both():
        tree = without()
        while (piece := peek()) is not None and piece not in ("OR", ")"):
            if piece == "AND":
                step()
            tree = ("and", tree, without())
        return tree

    def either():
        tree = both()
        while peek() == "OR":
            step()
            tree = ("or", tree, both())
        return tree

    if not pieces:
        return None
    try:
        tree = either()
        if peek() is not None:
            raise ValueError("rest")
        return tree
    except ValueError:
        words = [("leaf", w, False) for w in folded(query).split()]
        tree = None
        for word in words:
            tree = word if tree is None else ("and", tree, word)
        return tree


def leaves(tree) -> list[Leaf]:
    """The leaves that count for a hit, each once: not those that NOT takes away."""
    if tree is None:
        return []
    if tree[0] == "leaf":
        return [tree]
    parts = [tree[1]] if tree[0] == "not" else [tree[1], tree[2]]
    return list(dict.fromkeys(x for p in parts for x in leaves(p)))


def occurrences(text: Column, leaf: Leaf) -> Column:
    """How often a leaf stands in folded text; neighbours may share a space."""
    return F.regexp_count(text, F.lit(rf"(?<![a-z0-9]){leaf[1]}" + ("" if leaf[2] else "(?![a-z0-9])")))


def matches(tree, text: Column) -> Column:
    if tree[0] == "leaf":
        return occurrences(text, tree) > 0
    a, b = matches(tree[1], text), matches(tree[2], text)
    return a & b if tree[0] == "and" else a | b if tree[0] == "or" else a & ~b
