"""Token files: ids in static range asymmetric numeral coding, in independent blocks."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import lean
from .tokens import encoder
from .words import binary, parts

MAGIC, LANES, BLOCK = b"TKF1", 1024, 1 << 18
_HEAD = struct.Struct("<4sBIIQIIIII")  # magic, scale bits, lanes, block, tokens, documents, symbols, blocks, index bytes, table bytes
_CHECKPOINT = struct.Struct("<QIII")  # first token, words before, words, crc32 of the block
_LOW = np.uint64(1 << 31)
_32 = np.uint64(32)
_COLUMNS = ["part", "seq", "n_docs", "n_tokens", "frame"]


def scaled(counts: np.ndarray) -> tuple[np.ndarray, int]:
    """Frequencies of at least 1 with a power of two as their sum, and its exponent."""
    scale = min(24, max(14, int(len(counts)).bit_length() + 3))
    freq = np.maximum(1, counts.astype(np.int64) * (1 << scale) // max(1, int(counts.sum())))
    over = int(freq.sum()) - (1 << scale)
    while over > 0:
        top = int(freq.argmax())
        less = min(over, max(1, int(freq[top]) // 8))
        freq[top] -= less
        over -= less
    freq[int(freq.argmax())] -= over
    return freq, scale


def encode_block(symbols: np.ndarray, freq: np.ndarray, first: np.ndarray, scale: int) -> bytes:
    """One block: every lane's last state, then the words in the order in which they are read."""
    x = np.full(LANES, _LOW, np.uint64)
    up, low = np.uint64(63 - scale), np.uint64(0xFFFFFFFF)
    words: list[np.ndarray] = []
    freq, first = freq.astype(np.uint64), first.astype(np.uint64)
    limit = freq << up
    for at in range((len(symbols) - 1) // LANES * LANES, -1, -LANES):
        s = symbols[at : at + LANES]
        f, c = freq[s], first[s]
        y = x[: len(f)]
        full = np.flatnonzero(y >= limit[s])
        if len(full):
            over = y[full]
            words.append((over & low).astype("<u4"))
            y[full] = over >> _32
        q = y // f
        x[: len(f)] = (q << np.uint64(scale)) + (y - q * f) + c
    return x.astype("<u8").tobytes() + b"".join(w.tobytes() for w in reversed(words))


def decode_block(data: bytes, n: int, freq: np.ndarray, first: np.ndarray, slots: np.ndarray, scale: int) -> np.ndarray:
    x = np.frombuffer(data, "<u8", LANES).copy()
    words = np.frombuffer(data, "<u4", offset=8 * LANES)
    out = np.empty(n, slots.dtype)
    mask, bits, read = np.uint64((1 << scale) - 1), np.uint64(scale), 0
    freq, first = freq.astype(np.uint64), first.astype(np.uint64)
    for at in range(0, n, LANES):
        y = x[: n - at]
        slot = y & mask
        s = slots[slot]
        out[at : at + LANES] = s
        y = freq[s] * (y >> bits) + slot - first[s]
        low = np.flatnonzero(y < _LOW)
        if len(low):
            y[low] = (y[low] << _32) | words[read : read + len(low)]
            read += len(low)
        x[: len(y)] = y
    return out


def write_frame(doc_ids: list[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """Whole documents' ids as bytes: header, document index, frequency table, checkpoints, blocks.

    All blocks of a frame share its table; each has its own states, words, checkpoint and
    checksum, so any block can be read alone.
    """
    counts = np.bincount(ids) if len(ids) else np.ones(1, np.int64)
    symbols = np.flatnonzero(counts)
    place = np.zeros(len(counts), np.int32)
    place[symbols] = np.arange(len(symbols))
    inverse, counts, symbols = place[ids], counts[symbols], symbols.astype(np.uint32)
    freq, scale = scaled(counts)
    first = np.cumsum(freq) - freq
    blocks = [encode_block(inverse[i : i + BLOCK], freq, first, scale) for i in range(0, len(ids), BLOCK)]
    has = np.array([d is not None for d in doc_ids], np.uint8)
    index = zlib.compress(has.tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes() + sizes.astype("<u4").tobytes(), 1)
    table = zlib.compress(np.diff(symbols, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 1)
    marks, at = [], 0
    for i, b in enumerate(blocks):
        marks.append(_CHECKPOINT.pack(i * BLOCK, at // 4, len(b) // 4, zlib.crc32(b)))
        at += len(b)
    head = _HEAD.pack(MAGIC, scale, LANES, BLOCK, len(ids), len(doc_ids), len(symbols), len(blocks), len(index), len(table))
    front = head + index + table + b"".join(marks)
    return front + struct.pack("<I", zlib.crc32(front)) + b"".join(blocks)


def read_frame(frame: bytes, only: range | None = None) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, sizes, and the ids of all tokens (or of the blocks ``only``). Raises ValueError if a checksum fails."""
    magic, scale, lanes, block, tokens, docs, n_symbols, n_blocks, n_index, n_table = _HEAD.unpack_from(frame)
    at = _HEAD.size + n_index + n_table
    end = at + n_blocks * _CHECKPOINT.size
    if magic != MAGIC or lanes != LANES or zlib.crc32(frame[:end]) != struct.unpack_from("<I", frame, end)[0]:
        raise ValueError("not a frame, or its front is damaged")
    index = zlib.decompress(frame[_HEAD.size : _HEAD.size + n_index])
    has, doc_ids, sizes = np.frombuffer(index, np.uint8, docs), np.frombuffer(index, "<i8", docs, docs), np.frombuffer(index, "<u4", docs, 9 * docs)
    table = np.frombuffer(zlib.decompress(frame[_HEAD.size + n_index : at]), "<u4").reshape(2, n_symbols)
    symbols, freq = np.cumsum(table[0]).astype(np.uint32), table[1].astype(np.int64)
    first = np.cumsum(freq) - freq
    slots = np.repeat(np.arange(n_symbols, dtype=np.int32), freq)
    out = []
    for i in only if only is not None else range(n_blocks):
        _, before, words, crc = _CHECKPOINT.unpack_from(frame, at + i * _CHECKPOINT.size)
        data = frame[end + 4 + 4 * before : end + 4 + 4 * (before + words)]
        if zlib.crc32(data) != crc:
            raise ValueError(f"block {i} is damaged")
        out.append(symbols[decode_block(data, min(block, tokens - i * block), freq, first, slots, scale)])
    return [int(d) if h else None for d, h in zip(doc_ids, has, strict=True)], sizes, np.concatenate(out) if out else np.zeros(0, np.uint32)


def write_tokens(docs: DataFrame, tokenizer_path: str, out: str, end_id: int = 0, frame_tokens: int = 1 << 21) -> None:
    """Encodes every text and writes the ids in ascending doc_id order as a table of frames at ``out``.

    Each document's ids are followed by ``end_id``. Range-partitioned and sorted by doc_id; a
    partition's documents are coded in frames of about ``frame_tokens`` ids, a document being
    whole in one frame. Columns: part, seq (the frames' order), n_docs, n_tokens, frame. Null
    text: empty; null ids come first; rows that repeat an id each have their place; an empty
    table writes no frames.
    """
    spark = docs.sparkSession

    @lean
    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(tokenizer_path, keep_space=True)
        part, seq = TaskContext.get().partitionId(), 0
        ids, sizes, names, held = [], [], [], 0

        def made() -> pa.RecordBatch:
            frame = write_frame(names, np.concatenate(sizes), np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([part], "int32"), pa.array([seq], "int32"), pa.array([len(names)], "int64"), pa.array([held], "int64"), pa.array([frame], "binary")], names=_COLUMNS)

        for b in batches:
            docs_here = b.column("doc_id").to_pylist()
            for s, raw, bounds in parts(b.column("text"), min(1 << 20, 2 * frame_tokens)):
                found, n = e.encode(raw, bounds)
                ids.append(np.insert(found, np.cumsum(n), end_id))
                sizes.append(n + 1)
                names += docs_here[s]
                held += len(ids[-1])
                if held >= frame_tokens:
                    yield made()
                    ids, sizes, names, held, seq = [], [], [], 0, seq + 1
        if names:
            yield made()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(frames, "part int, seq int, n_docs long, n_tokens long, frame binary").write.option("compression", "none").parquet(out)


def read_tokens(spark: SparkSession, path: str, derive: dict[str, Column] | None = None) -> DataFrame:
    """From the files at ``path``, one row per document: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit).

    With ``derive``, columns computed from ids take their place, and no ids are shuffled.

    ``start`` counts the ids of all documents before it: totals of parts (one row a range
    partition) are added up, then those of the frames within each part.
    """

    @lean
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, seq, frame in zip(*(b.column(c).to_pylist() for c in ("part", "seq", "frame")), strict=True):
                names, sizes, ids = read_frame(frame)
                raw, edges = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
                for i in range(0, len(names), 2000):
                    at = edges[i : i + 2001]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(at) - 1, part, np.int32)), pa.array(np.full(len(at) - 1, seq, np.int32)), pa.array(names[i : i + 2000], "int64"),
                        pa.array(at[:-1]), pa.array(np.diff(at)), binary(raw[4 * at[0] : 4 * at[-1]], 4 * (at - at[0])),
                    ], names=["part", "seq", "doc_id", "inside", "n_tokens", "ids"])

    files = spark.read.schema("part int, seq int, n_docs long, n_tokens long, frame binary").parquet(path)
    before = F.coalesce(F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).select("part", before.alias("base"))
    within = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = files.select("part", "seq", "n_tokens").withColumn("within", within).join(parts, "part").select("part", "seq", (F.col("base") + F.col("within")).alias("base"))
    rows = files.select("part", "seq", "frame").mapInArrow(documents, "part int, seq int, doc_id long, inside long, n_tokens long, ids binary")
    derive = {"ids": F.col("ids")} if derive is None else derive
    rows = rows.select("part", "seq", "doc_id", "inside", "n_tokens", *[c.alias(k) for k, c in derive.items()])
    return rows.join(bases, ["part", "seq"]).select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", *derive)
