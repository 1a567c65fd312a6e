"""Text normalisation as Column expressions; nothing here runs Python on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented letters and their plain forms (fixed values).
ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"
#: Words that name a kind of unit, left out of skeletons (fixed values).
UNIT_WORDS = ("AGENCY", "DISTRICT", "RESERVE", "BAND", "THE", "OF", "OR")
#: Cells that mean nothing was recorded (fixed values).
BLANKS = ("", "nan", "None", "...")
#: Words kept small within a title (fixed values).
SMALL_WORDS = ("a", "an", "and", "at", "by", "for", "in", "of", "on", "or", "the", "to", "with")


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold(c: Column | str) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(_c(c)), ACCENTED, PLAIN)


def norm(c: Column | str) -> Column:
    """Folded, every run of other characters than a-z and 0-9 one space, trimmed."""
    return F.trim(F.regexp_replace(fold(c), "[^a-z0-9]+", " "))


def squash(c: Column | str) -> Column:
    """``norm`` without its spaces."""
    return F.replace(norm(c), F.lit(" "), F.lit(""))


def unit_squash(c: Column | str) -> Column:
    """Upper case letters and digits, unit words left out."""
    spaced = F.upper(F.regexp_replace(fold(c), "[^a-z0-9]+", " "))
    return F.replace(F.regexp_replace(spaced, rf"\b({'|'.join(UNIT_WORDS)})\b", ""), F.lit(" "), F.lit(""))


def skeleton(c: Column | str) -> Column:
    """``unit_squash`` without vowels, repeats of a letter once."""
    return F.regexp_replace(F.regexp_replace(unit_squash(c), "[AEIOUY]", ""), r"(.)\1+", "$1")


def slug(c: Column | str, longest: int = 30, fallback: str = "section") -> Column:
    """Words joined by hyphens, cut to ``longest`` without a hyphen at the end; ``fallback`` if nothing is left."""
    joined = F.trim(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), F.lit("-"))
    cut = F.rtrim(F.substring(joined, 1, longest), F.lit("-"))
    return F.when(cut == "", F.lit(fallback)).otherwise(cut)


def absent(c: Column | str) -> Column:
    """Trimmed; null where the cell says that nothing was recorded."""
    x = F.trim(_c(c))
    return F.when(x.isin(*BLANKS), None).otherwise(x)


def listed(c: Column | str, mark: str = r"\|") -> Column:
    """The parts of a delimited cell, blanks left out, not trimmed; null gives an empty list."""
    return F.filter(F.split(F.coalesce(_c(c), F.lit("")), mark), lambda x: F.trim(x) != "")


def title_case(c: Column | str) -> Column:
    """First letters raised, small words but the first kept low."""
    words = F.split(F.lower(_c(c)), " ")
    up = F.transform(words, lambda w, i: F.when((i > 0) & w.isin(*SMALL_WORDS), w).otherwise(F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))))
    return F.array_join(up, " ")


def leading_clause(c: Column | str) -> Column:
    """What stands before the first full stop, colon, semicolon or dash with spaces around it."""
    return F.trim(F.split(_c(c), r"[.:;]| - ", 2)[0])


def tokens(c: Column | str) -> Column:
    """The folded words of a text."""
    return F.regexp_extract_all(fold(c), F.lit("([a-z0-9]+)"), 1)


def text_version(c: Column | str) -> Column:
    """The first 12 hexadecimal digits of the text's SHA-1."""
    return F.substring(F.sha1(_c(c)), 1, 12)


def html_to_text(c: Column | str) -> Column:
    """Tags out, common character references decoded, white space one space."""
    x = F.regexp_replace(_c(c), "(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    x = F.regexp_replace(x, "(?s)<[^>]*>", " ")
    for name, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(char))
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def escaped(c: Column | str) -> Column:
    """Text made safe for HTML."""
    x = _c(c)
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        x = F.replace(x, F.lit(char), F.lit(name))
    return x
