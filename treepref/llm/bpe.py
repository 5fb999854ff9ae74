"""Operator 6, byte-level BPE: two-tier lookup.

Texts are split by the vocabulary's own pattern.  A pre-token that is itself an
entry of the vocabulary is resolved by a minimal perfect hash (hash and
displace: buckets of several keys get a seed that sends them to free slots,
buckets of one key a free slot itself), looked up for many pre-tokens at once
with numpy and checked against the entry's bytes.  The others are merged by a
heap over a linked list of their bytes, lowest rank first and leftmost among
equals.  Results of both tiers are kept in a bounded cache of the worker.

Row-local: no shuffle.  Defined results: a null or empty text has no ids and
decodes to no bytes; repeated rows are encoded alike; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treepref.llm import textkernel as K
from treepref.llm import tokens as T

_SEED_STEP = np.uint64(0x9E3779B97F4A7C15)
_TRIES = 128


def read_ranks(path: str) -> list[bytes]:
    """Entries of a rank file in order of rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out = [b""] * len(pairs)
    for word, rank in pairs:
        out[int(rank)] = base64.b64decode(word)
    return out


def _hashes(words: list[bytes]) -> np.ndarray:
    ends = np.cumsum([len(w) for w in words])
    return K.span_hashes(np.frombuffer(b"".join(words), np.uint8), np.concatenate([[0], ends[:-1]]), ends)


class PerfectHash:
    """Slots 0 to n - 1 for n different keys; other words get some slot too."""

    def __init__(self, words: list[bytes], load: int = 4):
        h, n = _hashes(words), len(words)
        self.n, self.buckets = np.uint64(n), np.uint64(max(1, n // load))
        bucket = (h % self.buckets).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        names, first, count = np.unique(bucket[order], return_index=True, return_counts=True)
        self.seed = np.zeros(int(self.buckets), np.int64)
        self.word_at = np.full(n, -1, np.int64)
        for b in np.argsort(-count, kind="stable"):
            keys = order[first[b]:first[b] + count[b]]
            if len(keys) == 1:
                break
            start = 1
            while True:
                seeds = np.arange(start, start + _TRIES)
                slots = self._slots(h[keys][:, None], seeds[None])
                s = np.sort(slots, axis=0)
                ok = (self.word_at[slots] < 0).all(axis=0) & (s[1:] != s[:-1]).all(axis=0)
                if ok.any():
                    j = int(np.argmax(ok))
                    self.seed[names[b]] = seeds[j]
                    self.word_at[slots[:, j]] = keys
                    break
                start += _TRIES
        single = names[count == 1]
        free = np.flatnonzero(self.word_at < 0)
        self.seed[single] = -1 - free[:len(single)]
        self.word_at[free[:len(single)]] = order[first[count == 1]]

    def _slots(self, h: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        return (K.mix(h + seeds.astype(np.uint64) * _SEED_STEP) % self.n).astype(np.int64)

    def find(self, words: list[bytes]) -> np.ndarray:
        """The only key that each word can be, by its position."""
        h = _hashes(words)
        seed = self.seed[(h % self.buckets).astype(np.int64)]
        return self.word_at[np.where(seed < 0, -1 - seed, self._slots(h, np.maximum(seed, 0)))]


def merge(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Ids of a word by merging its bytes, the pair of lowest rank first."""
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that begins here; 0 once it is merged away
    before = list(range(-1, n))  # start of the part before
    get = rank.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if not j or j >= n or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        before[stop] = i
        if stop < n and (r := get(word[i:end[stop]])) is not None:
            heapq.heappush(heap, (r, i, end[stop]))
        p = before[i]
        if p >= 0 and (r := get(word[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(rank[word[i:end[i]]])
        i = end[i]
    return out


class RankEncoder(T.UnitEncoder):
    """Ids by the two tiers, as 32-bit integers."""

    def __init__(self, path: str, pattern: str):
        import regex
        self.words = read_ranks(path)
        self.rank = {w: i for i, w in enumerate(self.words)}
        self.hash = PerfectHash(self.words)
        self.split = regex.compile(pattern).findall
        self.kind, self.type, self.cache = "byte", np.dtype("<u4"), T.Cache()

    def _resolve(self, tokens: list[str]) -> list[bytes]:
        raw = [t.encode() for t in tokens]
        found = self.hash.find(raw).tolist()
        words, rank, kind = self.words, self.rank, self.type
        return [k.to_bytes(4, "little") if words[k] == w else np.array(merge(w, rank), kind).tobytes()
                for k, w in zip(found, raw)]

    def _ids(self, text: str) -> bytes:
        return b"".join(self._resolve(self.split(text))) if text else b""

    def _learn(self, units: set[str]) -> None:
        split = {u: self.split(u) for u in units}
        todo = list(self.cache.missing({t for x in split.values() for t in x}))
        young = self.cache.young
        if todo:
            young.update(zip(todo, self._resolve(todo)))
        for u, x in split.items():
            if len(x) != 1:
                young[u] = b"".join([young[t] for t in x])

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.words.__getitem__, np.frombuffer(ids, self.type).tolist()))


_ENCODERS: dict[tuple[str, str], RankEncoder] = {}


def rank_encoder(path: str, pattern: str) -> RankEncoder:
    """The worker's encoder for a rank file, with the cache of earlier tasks."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = RankEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, id: str = "doc_id", text: str = "text",
           digests: bool = False) -> DataFrame:
    """(id, ids binary, 32-bit little-endian) of every row; with ``digests`` instead
    (id, n_tokens, ids_sha256, decoded_sha256), the last of the ids decoded again."""
    docs = df.select(F.col(id).alias("id"), F.col(text).alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = rank_encoder(path, pattern)
        for b in batches:
            for first, texts in T.slices(b.column(1).to_pylist()):
                ids = list(enc.encode(texts))
                own = b.column(0).slice(first, len(ids))
                if not digests:
                    yield pa.RecordBatch.from_arrays([own, pa.array(ids, pa.binary())], ["id", "ids"])
                    continue
                yield pa.RecordBatch.from_arrays(
                    [own, pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                     pa.array([hashlib.sha256(enc.decode(x)).hexdigest() for x in ids])],
                    ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["id"].dataType.simpleString()
    rest = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids binary"
    return docs.mapInArrow(rows, f"id {kind}, {rest}").withColumnRenamed("id", id)


def decode(df: DataFrame, path: str, pattern: str, id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(id, data binary): the bytes that 32-bit little-endian ids stand for; null ids give none."""
    rows_in = df.select(F.col(id).alias("id"), F.col(ids).alias("ids"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = rank_encoder(path, pattern)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([enc.decode(x or b"") for x in b.column(1).to_pylist()], pa.binary())],
                ["id", "data"])

    kind = rows_in.schema["id"].dataType.simpleString()
    return rows_in.mapInArrow(rows, f"id {kind}, data binary").withColumnRenamed("id", id)
