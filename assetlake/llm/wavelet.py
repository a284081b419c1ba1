"""Token ids of a corpus as wavelet matrices, one compressed file for each shard.

A shard has the ids of consecutive documents in ascending doc_id (null ids first; equal ids in order of text), each
document followed by the end id. File: a line of JSON (counts, document ids and starts, block lengths), then the
list of distinct ids, most frequent first, and the bit planes of the ids' places in that list (codes), highest bit
first, each compressed on its own. Plane k has bit k of the codes after they were stably parted by the bits above; with
ranks of ones at every ``RANK`` bits this gives the id at a place, the number of an id's occurrences and the place of its
n-th occurrence without decoding the rest.

Texts are dealt by ranges of doc_id and written by the tasks to the shared folder; the driver sees one number for each
partition. Null and empty texts have the end id alone.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assetlake.llm.batches import byte_texts, pieces
from assetlake.llm.storage import shared_path, written
from assetlake.llm.tokens import check_words, default_path, opened
from assetlake.session import shuffle_partitions

END_ID = 2
SHARD_TOKENS = 1 << 21
RANK = 512
FILES = "part int, shard int, path string, n_tokens bigint"
ROWS = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


class WaveletMatrix:
    """Bit planes of the codes of a list of ids, with ranks; ``symbols`` has the id of each code."""

    def __init__(self, symbols: np.ndarray, planes: list[np.ndarray], n: int):
        self.symbols, self.planes, self.n = symbols, planes, n
        self.zeros: list[int] = []
        self.ranks: list[np.ndarray] = []
        for plane in planes:
            ones = np.bitwise_count(plane)
            ones = np.append(ones, np.zeros(-len(ones) % (RANK // 8), ones.dtype)).reshape(-1, RANK // 8).sum(axis=1, dtype=np.int64)
            self.ranks.append(np.concatenate([[0], np.cumsum(ones)]))
            self.zeros.append(n - int(self.ranks[-1][-1]))

    @staticmethod
    def build(ids: np.ndarray) -> "WaveletMatrix":
        counts = np.bincount(ids)
        order = np.argsort(-counts, kind="stable")
        symbols = order[: np.count_nonzero(counts)].astype(np.uint32)
        width = max(1, (len(symbols) - 1).bit_length())
        codes = np.zeros(len(counts), np.uint16 if width <= 16 else np.uint32)
        codes[symbols] = np.arange(len(symbols))
        now = codes.take(ids)
        planes = []
        for k in range(width - 1, -1, -1):
            bit = (now >> now.dtype.type(k)).astype(np.uint8) & 1
            planes.append(np.packbits(bit))
            ones = bit.view(bool)
            if k:
                now = np.concatenate([now[~ones], now[ones]])
        return WaveletMatrix(symbols, planes, len(ids))

    def rank1(self, k: int, i: int) -> int:
        """Ones before bit i of plane k."""
        block = i // RANK
        part = self.planes[k][block * RANK // 8 : (i + 7) // 8]
        bits = np.unpackbits(part)[: i - block * RANK]
        return int(self.ranks[k][block]) + int(bits.sum())

    def select(self, k: int, bit: int, n: int) -> int:
        """Place of the n-th (from 0) bit of that value in plane k."""
        ranks = self.ranks[k]
        have = ranks if bit else np.minimum(np.arange(len(ranks)) * RANK, self.n) - ranks
        block = int(np.searchsorted(have, n, side="right")) - 1
        bits = np.unpackbits(self.planes[k][block * RANK // 8 : (block + 1) * RANK // 8])
        return block * RANK + int(np.flatnonzero(bits == bit)[n - int(have[block])])

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for k, plane in enumerate(self.planes):
            bit = plane[i >> 3] >> (7 - (i & 7)) & 1
            ones = self.rank1(k, i)
            value, i = value << 1 | int(bit), self.zeros[k] + ones if bit else i - ones
        return int(self.symbols[value])

    def code(self, symbol: int) -> int | None:
        at = np.flatnonzero(self.symbols == symbol)
        return int(at[0]) if len(at) else None

    def _range(self, value: int | None, end: int) -> tuple[int, int]:
        start, depth = 0, len(self.planes)
        if value is None:
            return 0, 0
        for k in range(depth):
            a, b = self.rank1(k, start), self.rank1(k, end)
            one = value >> (depth - 1 - k) & 1
            start, end = (self.zeros[k] + a, self.zeros[k] + b) if one else (start - a, end - b)
        return start, end

    def count(self, value: int, end: int | None = None) -> int:
        """Occurrences of an id before place ``end``."""
        a, b = self._range(self.code(value), self.n if end is None else end)
        return b - a

    def locate(self, value: int, n: int) -> int:
        """Place of the n-th occurrence (from 0) of an id."""
        value = self.code(value)
        a, b = self._range(value, self.n)
        if not 0 <= n < b - a:
            raise IndexError("no such occurrence")
        at, depth = a + n, len(self.planes)
        for k in range(depth - 1, -1, -1):
            one = value >> (depth - 1 - k) & 1
            at = self.select(k, one, at - self.zeros[k] if one else at)
        return at

    def ids(self) -> np.ndarray:
        """All ids in order, by undoing the partings from the lowest plane up."""
        depth = len(self.planes)
        now = np.zeros(self.n, np.uint16 if depth <= 16 else np.uint32)
        for k in range(depth - 1, -1, -1):
            bit = np.unpackbits(self.planes[k], count=self.n)
            ones = bit.view(bool)
            back = np.empty_like(now)
            back[~ones], back[ones] = now[: self.zeros[k]], now[self.zeros[k] :]
            back |= bit.astype(now.dtype) << now.dtype.type(depth - 1 - k)
            now = back
        return self.symbols.take(now)


def to_bytes(ids: np.ndarray, doc_ids: list, starts: list[int]) -> bytes:
    matrix = WaveletMatrix.build(ids)
    packer = zstandard.ZstdCompressor(level=1)
    planes = [packer.compress(p.tobytes()) for p in (matrix.symbols.astype("<u4"), *matrix.planes)]
    head = {"n": len(ids), "doc_ids": doc_ids, "starts": starts, "blocks": [len(p) for p in planes]}
    return json.dumps(head).encode() + b"\n" + b"".join(planes)


def from_bytes(data: bytes) -> tuple[WaveletMatrix, list, list[int]]:
    """The matrix, the documents' ids and the places where they begin."""
    line = data.index(b"\n")
    head, at, planes = json.loads(data[:line]), line + 1, []
    for size in head["blocks"]:
        planes.append(np.frombuffer(zstandard.ZstdDecompressor().decompress(data[at : at + size]), np.uint8))
        at += size
    return WaveletMatrix(planes[0].view("<u4"), planes[1:], head["n"]), head["doc_ids"], head["starts"]


def _files(folder: str):
    """File system and path of a folder that all executors share."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def write_shards(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards of ``docs`` (doc_id, text) below ``folder``; returns one row for each file, in order of (part, shard).

    A task that is run again writes files under new names; only the files named by the returned rows count.
    """
    file = path or default_path()
    check_words(file)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        system, root = _files(folder)
        system.create_dir(root, recursive=True)
        part, encoder = TaskContext.get().partitionId(), opened(file)
        doc_ids: list = []
        starts: list[int] = []
        held: list[bytes] = []
        size, shard = 0, 0

        def close() -> pa.RecordBatch:
            nonlocal size, shard
            name = f"part-{part:06d}-{shard:06d}-{uuid.uuid4().hex}.wm"
            ids = np.frombuffer(b"".join(held), "<u4")
            with system.open_output_stream(f"{root}/{name}") as out:
                out.write(to_bytes(ids, doc_ids, starts))
            row = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([name]), pa.array([size], pa.int64())], [f.split()[0] for f in FILES.split(", ")])
            doc_ids.clear(), starts.clear(), held.clear()
            size, shard = 0, shard + 1
            return row

        for batch in batches:
            ids, values = batch.column(0).to_pylist(), byte_texts(batch.column(1))
            for lo, hi in pieces(values):
                for doc_id, found in zip(ids[lo:hi], encoder.encode(values[lo:hi])):
                    doc_ids.append(doc_id)
                    starts.append(size)
                    held.append(found + end)
                    size += len(found) // 4 + 1
                    if size >= shard_tokens:
                        yield close()
        if held:
            yield close()

    base = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    dealt = base.repartitionByRange(max(1, shuffle_partitions(docs.sparkSession)), F.col("doc_id").asc_nulls_first())
    return written(dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(run, FILES), "shards")


def read_shards(files: DataFrame, folder: str) -> DataFrame:
    """Documents read back from shard files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    totals = sorted((r[0], r[1]) for r in files.groupBy("part").agg(F.sum("n_tokens")).collect())  # one row a partition
    offset, offsets = 0, []
    for part, n in totals:
        offsets.append((part, offset))
        offset += n
    spark = files.sparkSession
    base = spark.createDataFrame(offsets, "part int, base bigint")
    placed = files.join(base, "part").withColumn("first", F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _files(folder)
        for batch in batches:
            for name, first in zip(*[c.to_pylist() for c in batch.columns]):
                with system.open_input_file(f"{root}/{name}") as source:
                    matrix, doc_ids, starts = from_bytes(source.read())
                ids = matrix.ids().astype("<u4")
                ends = [*starts[1:], len(ids)]
                crcs = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array([first + a for a in starts], pa.int64()), pa.array([b - a for a, b in zip(starts, ends)], pa.int64()), pa.array(crcs, pa.int64())],
                    [f.split()[0] for f in ROWS.split(", ")],
                )

    return placed.select("path", "first").repartition(max(1, shuffle_partitions(spark))).mapInArrow(run, ROWS)


def corpus_file(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` to a new shared folder and read the documents' digests back."""
    folder = shared_path(docs.sparkSession, "wavelet")
    return read_shards(write_shards(docs, folder, path, end_id), folder)
