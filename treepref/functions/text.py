"""Column expressions for text rules (F1-F3, F8, P14, P16 building blocks).

Everything here returns a ``pyspark.sql.Column`` built from JVM-side
functions, so it stays inside whole-stage codegen.  Python string semantics
that the engines do not share are pinned down explicitly:

* ``str.strip`` strips all Unicode whitespace; ``trim`` strips spaces only, so
  :func:`strip` is ``btrim`` over Python's whitespace characters.
* ``\\W`` is ASCII-only in Java regex; :data:`NON_WORD` spells out the Unicode
  word class.
* ``str.split(sep)[1]`` raises when ``sep`` is absent; ``split_part`` returns
  ``''``.  Callers guard with :func:`has`.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's behaviour) -------------------
# Python's whitespace for str.strip()/str.split(): Java's \s plus vertical tab,
# the Unicode separators and the four information separators plus NEL.
WS_CLASS = r"[\s\x{0b}\p{Z}\x{1c}-\x{1f}\x{85}]"
# ASCII punctuation removed by the answer normaliser (Python string.punctuation).
PUNCTUATION = string.punctuation
# Articles removed by the answer normaliser.
ARTICLES = ("a", "an", "the")
# Python's \w in Unicode mode: letters, numbers, underscore.
NON_WORD = r"[^\p{L}\p{N}_]+"
ARTICLE_WORD = rf"(?<![\p{{L}}\p{{N}}_])(?:{'|'.join(ARTICLES)})(?![\p{{L}}\p{{N}}_])"
# Unicode decimal digits, as Python's \d.
DIGITS = r"\p{Nd}+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Every character Python's str.isspace() accepts (all lie below U+3001).
PY_WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip(c: Column | str) -> Column:
    """Python ``str.strip()``: trims the whitespace character set from both
    ends with ``btrim`` (no regex)."""
    return F.btrim(col(c), F.lit(PY_WHITESPACE))


def has(c: Column | str, needle: str) -> Column:
    """``needle in c`` (literal, case-sensitive)."""
    return F.instr(col(c), needle) > 0


def after_first(c: Column | str, marker: str) -> Column:
    """``c.split(marker)[1]``: text between the first and second marker."""
    return F.split_part(col(c), F.lit(marker), F.lit(2))


def before_first(c: Column | str, marker: str) -> Column:
    """``c.split(marker)[0]``."""
    return F.split_part(col(c), F.lit(marker), F.lit(1))


def after_last(c: Column | str, marker: str) -> Column:
    """``c.split(marker)[-1]``."""
    return F.substring_index(col(c), marker, -1)


def replace_chain(c: Column | str, steps: Iterable[tuple[str, str] | str]) -> Column:
    """Apply a chain of string calls in order (order matters): a pair is a
    literal ``str.replace(old, new)``; the words ``"lower"`` and ``"strip"``
    stand for those calls."""
    out = col(c)
    for st in steps:
        if st == "lower":
            out = F.lower(out)
        elif st == "strip":
            out = strip(out)
        else:
            out = F.replace(out, F.lit(st[0]), F.lit(st[1]))
    return out


# Whitespace characters Python splits on that Java's \s does not cover.
EXTRA_WS = "\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(chr(x) for x in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"


def split_ws(c: Column | str) -> Column:
    """Python ``str.split()`` with no argument: whitespace runs, no empties.

    The extra Unicode whitespace is first mapped to a space (a per-character
    ``translate``), so the split runs on Java's plain ``\\s+``."""
    x = F.translate(col(c), EXTRA_WS, " " * len(EXTRA_WS))
    return F.array_remove(F.split(x, r"\s+"), "")


def normalize_answer(c: Column | str) -> Column:
    """lower, drop ASCII punctuation, drop articles, collapse whitespace.

    Articles are whole words in Python's sense, so they also go next to
    non-ASCII punctuation (the look-around spells out the Unicode word class).
    """
    no_punct = F.translate(F.lower(col(c)), PUNCTUATION, "")
    return F.array_join(split_ws(F.regexp_replace(no_punct, ARTICLE_WORD, " ")), " ")


def numbers(c: Column | str) -> Column:
    """All runs of decimal digits, as ``re.findall(r'\\d+', c)``."""
    return F.regexp_extract_all(col(c), F.lit(DIGITS), F.lit(0))


def last_number(c: Column | str) -> Column:
    """Last digit run or null when there is none."""
    arr = numbers(c)
    return F.when(F.size(arr) > 0, F.element_at(arr, -1))


def first_number(c: Column | str) -> Column:
    arr = numbers(c)
    return F.when(F.size(arr) > 0, F.element_at(arr, 1))


ARABIC_MARK = "(arabic numerals) is "


def extract_number_last(c: Column | str) -> Column:
    """search-side number extractor.

    Strip; if ``arabic numerals`` occurs take the piece after the first
    ``(arabic numerals) is `` and drop commas; return the last digit run, or
    ``'-1'``.  When ``arabic numerals`` occurs without the full marker the
    reference raises; we return ``'-1'``.
    """
    y = strip(c)
    marked = F.when(~has(y, "arabic numerals"), y).when(
        has(y, ARABIC_MARK), F.replace(after_first(y, ARABIC_MARK), F.lit(","), F.lit("")))
    return F.coalesce(last_number(marked), F.lit("-1"))


def truncate_to_last_stop(c: Column | str) -> Column:
    """P16 tail rule: keep text through its last ``.``; null when there is no ``.``.

    Mirrors ``'.'.join(s.split('.')[:-1]) + '.'`` for text not ending in ``.``.
    """
    x = col(c)
    return F.when(F.endswith(x, F.lit(".")), x).when(
        has(x, "."), F.regexp_extract(x, r"(?s)^(.*\.)", 1))


def any_contains(c: Column | str, needles: Sequence[str]) -> Column:
    x = col(c)
    out = F.lit(False)
    for n in needles:
        out = out | has(x, n)
    return out
