"""Library tokenizers at corpus speed: each distinct unit of text is encoded once.

A unit is a stretch of text that a tokenizer's own splitting never joins with
its neighbours, so the ids of a text are those of its units in order:

* ``word`` (white space is dropped): runs of non-space characters;
* ``byte`` (GPT-2 style splitting): a run of non-space characters with the one
  space before it, or a run of white space as that splitting cuts it.

Units seen before come from a bounded two-generation cache of the worker
process; new ones go to the library in one call for many units, with a mark
between them that is always one token of its own.  Texts with the control characters on which Python
and the library disagree about white space (U+001C to U+001F) go to the library
whole.

Columns of texts (``UnitEncoder.column``) are cut by numpy and each distinct unit of a
chunk is looked up once; only texts with white space beyond the plain kind take
the path by text.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from treepref.llm import textkernel as K

#: White space other than a space or \n, and the marks used to cut texts.
_OTHER = re.compile("[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\x00\\x01]")
_ODD = re.compile("[\x1c-\x1f]")
_BYTE_UNIT = re.compile(r" ?\S+|\s+(?!\S)|\s+")
#: ASCII characters that are neither letters, digits nor white space: such a run after letters is split off.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Texts that numpy does not cut, by kind: other white space or control characters, or, where
#: white space is kept, more than one together or at an end.
_WIDE = "\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
_ASIDE = {"word": f"[\\x00-\\x08\\x0e-\\x1f{_WIDE}]",
          "byte": f"[\\x00-\\x09\\x0b-\\x1f{_WIDE}]|[ \\n][ \\n]|\\A[ \\n]|[ \\n]\\z"}
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_IS_MARK = np.zeros(256, bool)
_IS_MARK[list(_MARKS.encode())] = True
_IS_PLAIN = np.zeros(256, bool)
_IS_PLAIN[[c for c in range(128) if chr(c).isalnum()]] = True
#: Bytes of text whose distinct units are looked up together.
COLUMN_BYTES = 4 << 20
#: Bytes of a generation of the cache, and about so many of an entry beside its unit's characters.
CACHE = 100 << 20
SMALL_CACHE = 12 << 20
ENTRY = 200
JOINED = 4000


class Cache:
    """Two generations of about ``size`` bytes; the older is dropped when the younger is full."""

    def __init__(self, size: int = CACHE):
        self.size, self.young, self.old, self.chars = size, {}, {}, 0

    def missing(self, units: Iterable[str]) -> set[str]:
        """Units without an entry; the others are all in the young generation afterwards."""
        todo = set(units).difference(self.young)
        if todo:
            self.chars += sum(map(len, todo))
            if self.old:
                for u in [u for u in todo if u in self.old]:
                    self.young[u] = self.old[u]
                    todo.discard(u)
        return todo

    def turn(self) -> None:
        if self.chars + ENTRY * len(self.young) > self.size:
            self.young, self.old, self.chars = {}, self.young, 0


class UnitEncoder:
    """Ids of texts as little-endian integers of ``width`` bytes."""

    def __init__(self, path: str, kind: str, width: int = 2, cache: int = CACHE):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.kind, self.type, self.cache = kind, np.dtype(f"<u{width}"), Cache(cache)
        self.mark, self.glue = ("\n", "\n") if kind == "byte" else ("\x01", " \x01 ")
        (self.mark_id,) = self.tokenizer.encode(self.mark, add_special_tokens=False).ids

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type).tobytes()

    def _learn(self, units: set[str]) -> None:
        """Encode new units.  A word with marks after its letters is the word and the marks."""
        young, split, plain = self.cache.young, [], set()
        for u in units:
            core = u.rstrip(_MARKS)
            if core != u and (core[1:] if core[:1] == " " else core).isalpha():
                split.append((u, core, u[len(core):]))
            else:
                plain.add(u)
        plain |= self.cache.missing([x for _, c, m in split for x in (c, m)])
        batch = []
        for u in plain:
            if u.isspace() or self.mark in u:
                young[u] = self._ids(u)
            else:
                batch.append(u)
        for f in range(0, len(batch), JOINED):
            self._learn_joined(batch[f:f + JOINED])
        for u, core, marks in split:
            young[u] = young[core] + young[marks]

    def _learn_joined(self, units: list[str]) -> None:
        """One call for many units, with a mark between them that is always one token of its own."""
        e = self.tokenizer.encode_batch_fast([self.glue.join(units)], add_special_tokens=False)[0]
        ids = np.array(e.ids, self.type)
        cut = np.flatnonzero(ids == self.mark_id)
        raw, w, young = ids.tobytes(), self.type.itemsize, self.cache.young
        first = [0, *(cut * w + w).tolist()]
        last = [*(cut * w).tolist(), len(raw)]
        if len(first) != len(units):
            raise AssertionError("the mark between units is not one token of its own")
        for u, f, t in zip(units, first, last):
            young[u] = raw[f:t]

    def units(self, text: str) -> list[str] | None:
        """The units of a text, or None if it must go to the library whole."""
        other = _OTHER.search(text)
        if other and _ODD.search(text):
            return None
        if self.kind == "word":
            # Lower-casing first only merges cache entries; beyond ASCII it is left to the library.
            return (text.lower() if text.isascii() else text).split()
        if (other or "  " in text or " \n" in text or "\n " in text or "\n\n" in text
                or text[:1].isspace() or text[-1:].isspace()):
            return _BYTE_UNIT.findall(text)
        if not text:
            return []
        return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        units = [self.units(t) for t in texts]
        todo = self.cache.missing(set().union(*[x for x in units if x is not None]))
        if todo:
            self._learn(todo)
        get = self.cache.young.__getitem__
        for t, x in zip(texts, units):
            yield self._ids(t) if x is None else b"".join(map(get, x))
        self.cache.turn()


    def _cut(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes, first byte of each unit, units before the end of each text) of plain texts.

        A unit also ends where a mark follows an ASCII letter or digit, since every tokenizer splits there."""
        if not len(buf):
            return buf, np.zeros(0, np.int64), np.zeros(len(offs) - 1, np.int64)
        first = np.zeros(len(buf), bool)
        first[offs[:-1][offs[:-1] < offs[1:]]] = True
        first[1:] |= _IS_PLAIN[buf[:-1]] & _IS_MARK[buf[1:]]
        if self.kind == "byte":
            line = buf == 0x0A
            first |= line | (buf == 0x20)
            first[1:] |= line[:-1]
            starts = np.flatnonzero(first)
            return buf, starts, np.searchsorted(starts, offs[1:])
        space = _IS_SPACE[buf]
        first[1:] |= space[:-1]
        kept = np.flatnonzero(~space)
        starts = np.flatnonzero(first[kept])
        ends = np.searchsorted(starts, np.searchsorted(kept, offs[1:]))
        buf = buf[kept]
        if len(starts):
            # As by text: lower case merges cache entries of ASCII units.
            ascii_only = np.maximum.reduceat(buf, starts) < 128
            buf = np.where(np.repeat(ascii_only, np.diff(np.append(starts, len(buf)))), K.LOWER[buf], buf)
        return buf, starts, ends

    def _plain(self, buf: np.ndarray, offs: np.ndarray, tail: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with the tail after it, end of each text's ids)."""
        buf, starts, ends = self._cut(buf, offs)
        where = np.append(starts, len(buf)).astype(np.int32)
        found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(where), pa.py_buffer(buf)).dictionary_encode()
        units = found.dictionary.to_numpy(zero_copy_only=False).tolist()
        young = self.cache.young
        ids = list(map(young.get, units))
        todo = self.cache.missing([u for u, x in zip(units, ids) if x is None])
        if todo:
            self._learn(todo)
        ids = [young[u] if x is None else x for u, x in zip(units, ids)]
        self.cache.turn()
        at = np.insert(found.indices.to_numpy(), ends, len(units))
        out = pa.array([*ids, tail], pa.binary()).take(pa.array(at))
        _, where, data = out.buffers()
        where = np.frombuffer(where, np.int32, len(out) + 1, 4 * out.offset) // self.type.itemsize
        flat = np.frombuffer(data, self.type, where[-1]) if where[-1] else np.zeros(0, self.type)
        return flat, where[1:][ends + np.arange(len(ends))].astype(np.int64)

    def column(self, column: pa.Array, tail: bytes, limit: int = COLUMN_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first text, ids, end of each text's ids) of chunks of a text column, the tail after each text; nulls as empty texts."""
        column = K.strings(column)
        for i, j, buf, offs in K.chunks(column, limit):
            part = column.slice(i, j - i)
            aside = pc.match_substring_regex(part, _ASIDE[self.kind]).to_numpy(zero_copy_only=False)
            if not aside.any():
                yield i, *self._plain(buf, offs, tail)
                continue
            other = iter([x + tail for _, texts in slices(part.filter(pa.array(aside)).to_pylist()) for x in self.encode(texts)])
            size = np.diff(offs)
            flat, ends = self._plain(buf[~np.repeat(aside, size)], np.concatenate([[0], np.cumsum(size[~aside])]), tail)
            plain = iter(np.split(flat, ends[:-1]) if len(ends) else [])
            ids = [np.frombuffer(next(other), self.type) if a else next(plain) for a in aside]
            yield i, np.concatenate(ids), np.cumsum([len(x) for x in ids])


_ENCODERS: dict[tuple[str, str, int], UnitEncoder] = {}


def let_go() -> None:
    """End of a task after which the worker goes on with other stages: it keeps neither tokenizer nor cache."""
    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()


def encoder(path: str, kind: str, cache: int = CACHE) -> UnitEncoder:
    """The worker's encoder for a tokenizer file, with the cache of earlier tasks; others are let go."""
    if (path, kind, cache) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, kind, cache] = UnitEncoder(path, kind, cache=cache)
    return _ENCODERS[path, kind, cache]


def slices(texts: list[str | None], chars: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) in slices of about ``chars`` characters; nulls as empty texts."""
    part, size, first = [], 0, 0
    for k, t in enumerate(texts):
        part.append(t or "")
        size += len(part[-1])
        if size > chars:
            yield first, part
            part, size, first = [], 0, k + 1
    if part:
        yield first, part
