"""Token ids in wavelet-matrix shards: one compressed file answers access, counts and occurrences.

Method: succinct bit-planes with rank and select (wavelet matrix), one per shard of whole documents.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.llm.arrow_text import chunks
from sparkmart.llm.token_ids import token_ids
from sparkmart.session import durable

MAGIC = b"WVMX0001"
BLOCK_BITS = 1 << 16
SHARD_TOKENS = 1 << 21


def build_shard(ids: np.ndarray, doc_ids: list[int | None], doc_tokens: np.ndarray, width: int) -> bytes:
    """The file of one shard.

    Layout: magic, length of the header, header (JSON), compressed document directory, then for
    each bit from the highest the compressed blocks of its plane. The header holds the zeros of each
    plane, the ones before each block and the place of each block, so a reader opens only what it needs.
    """
    packer = zstandard.ZstdCompressor(level=1)
    values = ids.astype(np.uint16 if width <= 16 else np.uint32)
    body: list[bytes] = []
    planes = []
    for bit in range(width - 1, -1, -1):
        ones = (values >> bit) & 1 == 1
        packed = np.packbits(ones)
        blocks = [packer.compress(packed[k : k + BLOCK_BITS // 8].tobytes()) for k in range(0, len(packed), BLOCK_BITS // 8)]
        starts = np.arange(0, len(values), BLOCK_BITS)
        before = np.concatenate(([0], np.cumsum(np.add.reduceat(ones, starts, dtype=np.int64)))) if len(values) else np.zeros(1, np.int64)
        planes.append({"zeros": int(len(values) - before[-1]), "before": before[:-1].tolist(), "bytes": [len(b) for b in blocks]})
        body += blocks
        values = np.concatenate((values[~ones], values[ones]))
    known = np.array([d is not None for d in doc_ids], np.uint8)
    directory = packer.compress(
        np.array([d or 0 for d in doc_ids], "<i8").tobytes() + known.tobytes() + np.asarray(doc_tokens, "<i8").tobytes()
    )
    header = json.dumps(
        {"tokens": len(ids), "documents": len(doc_ids), "width": width, "directory": len(directory), "planes": planes}
    ).encode()
    return b"".join([MAGIC, struct.pack("<I", len(header)), header, directory, *body])


class WaveletMatrix:
    """Reader of one shard; blocks are opened when they are asked for."""

    def __init__(self, file: bytes):
        if file[:8] != MAGIC:
            raise ValueError("not a wavelet-matrix shard")
        (size,) = struct.unpack("<I", file[8:12])
        self.header = json.loads(file[12 : 12 + size])
        self.file, self.n, self.width = file, self.header["tokens"], self.header["width"]
        at = 12 + size
        count = self.header["documents"]
        raw = zstandard.decompress(file[at : at + self.header["directory"]])
        ids = np.frombuffer(raw, "<i8", count)
        known = np.frombuffer(raw, np.uint8, count, 8 * count)
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.doc_tokens = np.frombuffer(raw, "<i8", count, 9 * count)
        at += self.header["directory"]
        self.places = []
        for plane in self.header["planes"]:
            sizes = np.array(plane["bytes"], np.int64)
            self.places.append(at + np.concatenate(([0], np.cumsum(sizes))))
            at += int(sizes.sum())
        self._open: dict[tuple[int, int], np.ndarray] = {}

    def _block(self, level: int, block: int) -> np.ndarray:
        key = (level, block)
        if key not in self._open:
            a, b = self.places[level][block : block + 2]
            left = min(BLOCK_BITS, self.n - block * BLOCK_BITS)
            self._open[key] = np.unpackbits(np.frombuffer(zstandard.decompress(self.file[a:b]), np.uint8), count=left)
        return self._open[key]

    def _ones(self, level: int, at: int) -> int:
        """Ones of a plane before position ``at``."""
        plane = self.header["planes"][level]
        if at >= self.n:
            return self.n - plane["zeros"]
        block, rest = divmod(at, BLOCK_BITS)
        return plane["before"][block] + int(self._block(level, block)[:rest].sum())

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for level, plane in enumerate(self.header["planes"]):
            ones = self._ones(level, at)
            if self._block(level, at // BLOCK_BITS)[at % BLOCK_BITS]:
                value, at = value * 2 + 1, plane["zeros"] + ones
            else:
                value, at = value * 2, at - ones
        return value

    def _range(self, token: int, start: int, stop: int) -> tuple[int, int]:
        for level, plane in enumerate(self.header["planes"]):
            a, b = self._ones(level, start), self._ones(level, stop)
            if token >> (self.width - 1 - level) & 1:
                start, stop = plane["zeros"] + a, plane["zeros"] + b
            else:
                start, stop = start - a, stop - b
        return start, stop

    def count(self, token: int, start: int = 0, stop: int | None = None) -> int:
        """Occurrences of an id between two positions (rank)."""
        if token >> self.width:
            return 0
        a, b = self._range(token, start, self.n if stop is None else stop)
        return b - a

    def _select(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of this value in a plane."""
        before = np.array(self.header["planes"][level]["before"], np.int64)
        if not bit:
            before = np.arange(len(before)) * BLOCK_BITS - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        return block * BLOCK_BITS + int(np.flatnonzero(self._block(level, block) == bit)[k - before[block]])

    def occurrence(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of an id (select)."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        at = self._range(token, 0, self.n)[0] + k
        for level in range(self.width - 1, -1, -1):
            bit = token >> (self.width - 1 - level) & 1
            at = self._select(level, bit, at - self.header["planes"][level]["zeros"] if bit else at)
        return at

    def all_ids(self) -> np.ndarray:
        """Every id, by undoing the partitions from the lowest plane up."""
        values = np.zeros(self.n, np.uint16 if self.width <= 16 else np.uint32)
        for level in range(self.width - 1, -1, -1):
            blocks = [self._block(level, b) for b in range(len(self.header["planes"][level]["bytes"]))]
            ones = np.concatenate(blocks).view(bool) if blocks else np.zeros(0, bool)
            self._open.clear()
            zeros = self.header["planes"][level]["zeros"]
            before = np.empty_like(values)
            before[~ones] = values[:zeros]
            before[ones] = values[zeros:] | values.dtype.type(1 << (self.width - 1 - level))
            values = before
        return values.astype(np.uint32)


def write_shards(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    shard_tokens: int = SHARD_TOKENS,
    doc_id: str = "doc_id",
    text: str = "text",
    spaces_matter: bool = True,
) -> DataFrame:
    """Encode whole texts in ascending id order and store them as wavelet-matrix shards.

    Returns the stored table (part, seq, n_docs, n_tokens, shift, file), one row per shard; shift
    counts the ids before the shard in its part. Ranges of ids
    go to tasks, a task sorts its range and closes a shard at ``shard_tokens`` ids, so memory is bounded by
    a shard plus one document. Spark's writer commits the files; a lost task is simply run again. NULL text counts as
    empty, NULL ids come first, rows with equal ids are ordered by a hash of the text and each keeps its own place.
    Other columns are ignored. An empty table gives no shard.
    """

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(tokenizer, spaces_matter)
        width = max(1, int(max(encoder.tokenizer.get_vocab_size() - 1, end_id)).bit_length())
        part, seq = TaskContext.get().partitionId(), 0
        ids, names, sizes, held, shift = [], [], [], 0, 0

        def close() -> pa.RecordBatch:
            file = build_shard(np.concatenate(ids), names, np.concatenate(sizes), width)
            row = (part, seq, len(names), held, shift, file)
            return pa.RecordBatch.from_pydict({f.name: [v] for f, v in zip(_SHARDS, row)}, schema=_SHARDS)

        for batch in batches:
            for rows, texts in chunks(batch, "text", 8 << 20):
                flat, offsets = encoder.encode(texts, end_id)
                ids.append(flat)
                names += rows.column(0).to_pylist()
                sizes.append(np.diff(offsets))
                held += len(flat)
                if held >= shard_tokens:
                    yield close()
                    seq, shift = seq + 1, shift + held
                    ids, names, sizes, held = [], [], [], 0
        if names:
            yield close()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("hash"))
    # ranges of (id, hash of the text), so that rows of one id are cut up as well
    ordered = rows.repartitionByRange("doc_id", "hash").sortWithinPartitions("doc_id", "hash", "text").select("doc_id", "text")
    return durable(ordered.mapInArrow(shards, "part int, seq int, n_docs long, n_tokens long, shift long, file binary"), "token-shards")


_SHARDS = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("shift", pa.int64()), ("file", pa.binary())]
)


def read_documents(shards: DataFrame) -> DataFrame:
    """Documents read back from stored shards: doc_id, start (ids before it), n_tokens, ids (little-endian 32 bit).

    The start of a shard is its shift plus the totals of the parts before its own. There is one row per
    part, as many as the writing job had partitions, so that table is broadcast.
    """
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before.alias("before"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, start in zip(batch.column(0), batch.column(1).to_pylist()):
                shard = WaveletMatrix(file.as_py())
                offsets = np.concatenate(([0], np.cumsum(shard.doc_tokens)))
                flat = shard.all_ids().astype("<u4")
                step = 4096
                for k in range(0, len(shard.doc_ids), step):
                    cut = offsets[k : k + step + 1]
                    data = pa.py_buffer(flat[cut[0] : cut[-1]])
                    places = pa.py_buffer(((cut - cut[0]) * 4).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(shard.doc_ids[k : k + step], pa.int64()),
                            pa.array(start + cut[:-1], pa.int64()),
                            pa.array(np.diff(cut), pa.int64()),
                            pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, places, data]),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    placed = shards.join(F.broadcast(parts), "part").select("file", (F.col("before") + F.col("shift")).alias("start"))
    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")


def token_output(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write shards, read them back."""
    return read_documents(write_shards(docs, tokenizer, end_id))
