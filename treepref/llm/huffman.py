"""Operator 1, token-id output: canonical length-limited Huffman coding.

Texts are encoded once and their ids kept as a table in the shared folder.
Global counts of the ids (at most a count for each entry of the vocabulary)
give code lengths by package-merge, limited to ``LIMIT`` bits; the codes follow
from the lengths.  Documents are dealt into ranges of ascending id and each
range is written as a file, which a reader decodes by table look-up: the ids lie
in blocks of ``BLOCK``, the bit offset of every block is kept, and all blocks
are decoded side by side with numpy.

File format, little-endian: the magic ``TPHUFF01``; 64-bit numbers of documents,
ids, vocabulary entries, ids in a block, bits of the longest code, blocks and
32-bit words; for each document its id, 1 if that is null, its number of ids;
the bit offset of each block; the code length of each vocabulary entry (one
byte); the code bits as 32-bit words, the first bit on top.

Defined results: a null or empty text is its end id alone; equal document ids
are in order of their ids; null ids come first; an empty table writes nothing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from treepref.llm import tokens as T
from treepref.llm.files import make_folder, write_file
from treepref.session import drop_path, materialize, scratch_path

MAGIC = b"TPHUFF01"
LIMIT = 20
BLOCK = 1024
FILE_IDS = 2_000_000


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits; 0 for ids that do not occur."""
    out = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.float64)
    if len(order) > 1 << limit:
        raise ValueError("the vocabulary needs longer codes")
    # Package-merge: at each level the leaves are merged with pairs of the level below.
    levels, pairs = [], np.zeros(0)
    for _ in range(limit):
        both = np.concatenate([weight, pairs])
        by = np.argsort(both, kind="stable")
        levels.append(by < len(weight))
        both = both[by]
        both = both[:len(both) // 2 * 2]
        pairs = both[0::2] + both[1::2]
    take, length = 2 * len(order) - 2, np.zeros(len(order) + 1, np.int64)
    for leaf in reversed(levels):
        n = int(leaf[:take].sum())
        length[:n] += 1
        take = 2 * (take - n)
    out[order] = length[:-1]
    return out


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids by length and id, their codes)."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.argsort(lengths[ids], kind="stable")]
    n = lengths[ids].astype(np.int64)
    top = int(n.max()) if len(n) else 0
    # Aligned to the longest code, each code begins where the one before ends.
    size = np.int64(1) << (top - n)
    begin = np.cumsum(size) - size
    return ids, begin >> (top - n)


def encode(ids: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(32-bit words, bit offset of each block)."""
    symbols, codes = canonical(lengths)
    code = np.zeros(len(lengths), np.uint64)
    code[symbols] = codes.astype(np.uint64)
    n = lengths[ids].astype(np.int64)
    end = np.cumsum(n)
    begin = end - n
    bits = int(end[-1]) if len(end) else 0
    words = np.zeros(bits // 32 + 2, np.uint64)
    if len(ids):
        at = begin >> 5
        v = code[ids] << (64 - n - (begin & 31)).astype(np.uint64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        # Codes do not overlap, so adding them up joins their bits.
        sums = np.add.reduceat(v >> np.uint64(32), first)
        words[at[first]] += sums
        words[at[first] + 1] += np.add.reduceat(v & np.uint64(0xFFFFFFFF), first)
    return words.astype("<u4"), begin[::BLOCK].astype("<i8")


def decode(words: np.ndarray, offsets: np.ndarray, total: int, block: int, lengths: np.ndarray) -> np.ndarray:
    """The ids; all blocks advance by one id at a time."""
    out = np.zeros((block, len(offsets)), np.uint32)
    if not total:
        return out.ravel()
    symbols, _ = canonical(lengths)
    top = int(lengths.max())
    n = lengths[symbols].astype(np.int64)
    reach = np.int64(1) << (top - n)
    table = np.zeros(1 << top, np.uint32)
    step = np.ones(1 << top, np.uint8)
    table[:reach.sum()] = np.repeat(symbols, reach)
    step[:reach.sum()] = np.repeat(n, reach)
    wide = words.astype(np.uint64)
    wide = np.concatenate([wide, np.zeros(2, np.uint64)])
    wide = (wide[:-1] << np.uint64(32)) | wide[1:]
    at, last = offsets.astype(np.int64).copy(), len(wide) - 1
    mask = np.uint64((1 << top) - 1)
    for k in range(block):
        w = wide[np.minimum(at >> 5, last)]
        peek = (w >> (64 - top - (at & 31)).astype(np.uint64)) & mask
        out[k] = table[peek]
        at += step[peek]
    return out.T.ravel()[:total]


def file_bytes(docs: list[int | None], counts: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> bytes:
    words, offsets = encode(ids, lengths)
    head = np.array([len(docs), len(ids), len(lengths), BLOCK, int(lengths.max()) if len(lengths) else 0,
                     len(offsets), len(words)], "<i8")
    return b"".join([MAGIC, head.tobytes(), np.array([d or 0 for d in docs], "<i8").tobytes(),
                     np.array([d is None for d in docs], "<i8").tobytes(), counts.astype("<i8").tobytes(),
                     offsets.tobytes(), lengths.tobytes(), words.tobytes()])


def read_bytes(data: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, numbers of ids, all ids) of a file."""
    if data[:8] != MAGIC:
        raise ValueError("not a file of this format")
    n_docs, total, vocab, block, _, n_blocks, n_words = np.frombuffer(data, "<i8", 7, 8).tolist()
    at = 64
    docs, null, counts = (np.frombuffer(data, "<i8", n_docs, at + 8 * n_docs * k) for k in range(3))
    at += 24 * n_docs
    offsets = np.frombuffer(data, "<i8", n_blocks, at)
    at += 8 * n_blocks
    lengths = np.frombuffer(data, np.uint8, vocab, at)
    words = np.frombuffer(data[at + vocab:], "<u4", n_words)
    return [None if z else d for d, z in zip(docs.tolist(), null.tolist())], counts, decode(
        words, offsets, total, block, lengths)


def _encoded(docs: DataFrame, path: str, kind: str, end: int) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = T.encoder(path, kind)
        tail = np.array([end], enc.type).tobytes()
        for b in batches:
            for first, ids, ends in enc.column(b.column(1), tail):
                where = pa.py_buffer(np.append(0, ends * ids.itemsize).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(first, len(ends)),
                     pa.Array.from_buffers(pa.binary(), len(ends), [None, where, pa.py_buffer(ids)])], ["id", "ids"])

    return docs.mapInArrow(rows, "id long, ids binary")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, np.int64)
    for b in batches:
        for x in b.column(0):
            total += np.bincount(np.frombuffer(x.as_buffer(), "<u2"), minlength=1 << 16)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["token", "c"])


def write_archive(df: DataFrame, folder: str, path: str, end: int, vocab: int, kind: str = "word", id: str = "doc_id",
                  text: str = "text", file_ids: int = FILE_IDS) -> None:
    """Write the ids of every text, ascending by ``id``, as files of ``folder``."""
    spark = df.sparkSession
    make_folder(spark, folder)
    table_path = scratch_path(spark, "ids")
    ids = materialize(_encoded(df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")), path, kind,
                               end), path=table_path)
    counts = np.zeros(vocab, np.int64)
    for r in ids.select("ids").mapInArrow(_count, "token long, c long").groupBy("token").agg(
            F.sum("c").alias("c")).collect():  # at most a row for each vocabulary entry
        counts[r["token"]] = r["c"]
    if not counts.any():
        drop_path(spark, table_path)
        return
    lengths = code_lengths(counts)
    files = int(-(-counts.sum() // file_ids))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, names, raw, size, n = TaskContext.get().partitionId(), [], [], 0, 0

        def flush() -> None:
            nonlocal names, raw, size, n
            if names:
                flat = np.frombuffer(b"".join(raw), "<u2")
                each = np.array([len(x) // 2 for x in raw])
                write_file(folder, f"ids-{part:06d}-{n:06d}.huf", file_bytes(names, each, flat, lengths))
                names, raw, size, n = [], [], 0, n + 1

        for b in batches:
            for d, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                names.append(d)
                raw.append(x)
                size += len(x) // 2
                if size >= file_ids:
                    flush()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["files"])

    ranged = ids.repartitionByRange(files, "id") if files > 1 else ids.coalesce(1)
    ranged.sortWithinPartitions("id", "ids").mapInArrow(write, "files long").agg(F.sum("files")).collect()
    drop_path(spark, table_path)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file, place) of every document in the files of ``folder``."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                docs, counts, ids = read_bytes(data.as_buffer().to_pybytes())
                ends = np.cumsum(counts)
                ids = ids.astype("<u4")
                crc = [zlib.crc32(ids[e - c:e].tobytes()) for e, c in zip(ends, counts)]
                m = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(ends - counts), pa.array(counts), pa.array(crc, pa.int64()),
                     pa.array([name.rpartition("/")[2]] * m), pa.array(np.arange(m))],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "file", "place"])

    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.huf").load(folder).select("path", "content")
    local = materialize(found.mapInArrow(
        rows, "doc_id long, start long, n_tokens long, ids_crc32 long, file string, place long"), "decoded")
    # Ids of the files before: one row for each file.
    sums = local.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ids_before"))
    return local.join(sums, "file").select("doc_id", (F.col("start") + F.col("ids_before")).alias("start"), "n_tokens",
                                           "ids_crc32", "file", "place")
