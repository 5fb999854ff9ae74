"""Operator 7, quality rules: repetition coverage.

Rolling hashes of several n-gram lengths, computed with numpy over whole Arrow
batches, mark every word inside an n-gram that occurs twice or more in its
text; the share of word characters so covered, and the share inside repeated
lines, decide whether a text is kept.  Row-local: no shuffle, no state.

Defined results: a null or empty text has no words, so all counts are 0 and it
fails the base rule; repeated rows and ties are judged one by one; an empty
table gives an empty result; further columns are ignored.  Hashes have 64 bits,
so equality of n-grams and lines is up to a collision (about 1e-11 for a text of
20,000 words).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treepref.llm import textkernel as K

#: Largest share of characters in repeated n-grams, by n-gram length (in words).
NGRAM_SHARES = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Fixed value: largest share of characters in lines equal to an earlier line.
LINE_SHARE = 0.30
MIN_WORDS = 50
BASE_REPEAT_PERCENT = 50
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, dup_line_chars long, "
          + ", ".join(f"dup_chars_{n} long" for n in NGRAM_SHARES))


def _repeated(hashes: np.ndarray, group: np.ndarray, n: int, among: np.ndarray | None = None) -> np.ndarray:
    """First words of the n-word windows that their text holds twice or more.

    ``among``: the only windows to look at (those made of shorter repeated ones).
    """
    at, h = K.windows(hashes, group, n, among)
    if not len(at):
        return at
    h = h ^ K.mix(group[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(h)
    s = h[order]
    same = np.zeros(len(s), bool)
    eq = s[1:] == s[:-1]
    same[1:] |= eq
    same[:-1] |= eq
    return np.sort(at[order[same]])


def _covered(at: np.ndarray, n: int, total: int) -> np.ndarray:
    """Words inside the windows that begin at ``at``."""
    edge = np.bincount(at, minlength=total + 1) - np.bincount(at + n, minlength=total + 1)
    return np.cumsum(edge[:total]) > 0


def _longer(at: np.ndarray, step: int, total: int) -> np.ndarray:
    """Windows longer by ``step`` words whose parts of the present length are all in ``at``.

    A window repeats only if each of its parts does, so no other can.
    """
    inside = np.zeros(total + step + 1, bool)
    inside[at] = True
    ok = inside[at]
    for k in range(1, step + 1):
        ok &= inside[at + k]
    return at[ok]


def measure(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of every text in a chunk, and the two verdicts."""
    n = len(offs) - 1
    chars = K.code_points(buf)
    starts, ends, doc = K.words(buf, offs)
    h = K.span_hashes(buf, starts, ends)
    wc = chars[ends] - chars[starts]
    out = {"n_words": np.bincount(doc, minlength=n).astype(np.int64), "word_chars": K.per_group(wc, doc, n)}
    sym = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(_SYMBOL[buf], out=sym[1:])
    out["n_symbols"] = sym[offs[1:]] - sym[offs[:-1]]
    # Lines: cut at \n; only those with a word count.
    ls, le, ld = K.runs(buf, offs, buf != 10)
    with_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, ld = ls[with_word], le[with_word], ld[with_word]
    lh = K.span_hashes(buf, ls, le) ^ K.mix(ld.astype(np.uint64) + np.uint64(1))
    again = np.ones(len(lh), bool)
    if len(lh):
        again[np.unique(lh, return_index=True)[1]] = False
    out["n_dup_lines"] = np.bincount(ld[again], minlength=n).astype(np.int64)
    # Word characters, so that the share has the same whole as the n-gram shares.
    cum = np.zeros(len(wc) + 1, np.int64)
    np.cumsum(wc, out=cum[1:])
    line_chars = cum[np.searchsorted(starts, le)] - cum[np.searchsorted(starts, ls)]
    size, at = 3, _repeated(h, doc, 3)
    out["n_repeat_words"] = K.per_group(_covered(at, 3, len(h)), doc, n)
    failed = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > BASE_REPEAT_PERCENT * out["n_words"])
    out["base_failed"] = failed
    out["dup_line_chars"] = K.per_group(line_chars * again, ld, n)
    kept = ~failed & (out["dup_line_chars"] <= LINE_SHARE * out["word_chars"])
    for longer, share in NGRAM_SHARES.items():
        at = _repeated(h, doc, longer, _longer(at, longer - size, len(h)))
        size = longer
        c = K.per_group(wc * _covered(at, size, len(h)), doc, n)
        out[f"dup_chars_{size}"] = c
        kept &= c <= share * out["word_chars"]
    out["kept"] = kept
    return out


def repetition_quality(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and the measures of ``text``, a row for each row."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    # Own names inside, so that columns of the input may be called like the measures.
    inner = [f"k{i}" for i in range(len(keep))]
    given = df.select(*[F.col(c).alias(k) for c, k in zip(keep, inner)], F.col(text).alias("text"))
    head = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in given.schema.fields[:-1])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, offs in K.chunks(b.column(len(inner))):
                m = measure(buf, offs)
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).slice(i, j - i) for k in range(len(inner))] + [pa.array(m[c]) for c in names],
                    inner + names)

    return given.mapInArrow(rows, f"{head}, {SCHEMA}").withColumnsRenamed(dict(zip(inner, keep)))
