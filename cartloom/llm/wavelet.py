"""Token ids in wavelet matrices: one per shard, with access, counting and lookup from the same bytes.

Documents are range-partitioned by id and written in ascending order. A partition writes shards of
about ``SHARD_TOKENS`` ids. A shard is one binary value of the Parquet file: a header, the document
table, the alphabet of the ids that occur, and per bit of an id's place in it (highest first) the bit
plane with a rank sample every 512 bits. The
sequence of the next plane is the zeros of this one followed by its ones, in order, which is what
makes rank and select work on every plane.

Defined results: null and empty texts hold the end id alone; rows of a repeated doc_id are all
written, in order of their text; a null doc_id comes first; an empty table gives no shard.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from cartloom.llm.pieces import Pieces
from cartloom.llm.shared import Memo, as_bytes, slices

SHARD_TOKENS = 1 << 20
#: Chunks that a Python worker keeps per generation.
MEMO = 800_000
_BLOCK = 512
_HEAD = struct.Struct("<4sQIII")  # mark, ids, planes, documents, letters
_MARK = b"WMX2"


class WaveletMatrix:
    """Bit planes with sampled ranks."""

    def __init__(self, planes: list[np.ndarray], ranks: list[np.ndarray], size: int):
        self.planes, self.ranks, self.size = planes, ranks, size
        self.zeros = [size - int(rank[-1]) for rank in ranks]

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        top = int(ids.max()).bit_length() if len(ids) else 0
        now = ids.astype(np.uint16 if top <= 16 else np.uint32)
        planes, ranks = [], []
        for level in range(max(1, top) - 1, -1, -1):
            bits = (now & now.dtype.type(1 << level)) != 0
            plane = np.packbits(bits, bitorder="little")
            planes.append(plane)
            ranks.append(cls._sample(plane))
            # Places are found faster than a mask is applied to bits without order.
            now = np.concatenate([now.take(np.flatnonzero(~bits)), now.take(np.flatnonzero(bits))])
        return cls(planes, ranks, len(ids))

    @staticmethod
    def _sample(plane: np.ndarray) -> np.ndarray:
        """Ones before every block of 512 bits, and in all."""
        wide = np.zeros(-(-len(plane) // 64) * 64, np.uint8)
        wide[: len(plane)] = plane
        ones = np.bitwise_count(wide.view(np.uint64)).reshape(-1, 8).sum(1, dtype=np.uint32)
        return np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])

    def rank1(self, level: int, at: int) -> int:
        """Ones among the first ``at`` bits of a plane."""
        block = at // _BLOCK
        first = block * _BLOCK // 8
        part = np.unpackbits(self.planes[level][first : first + _BLOCK // 8], bitorder="little")
        return int(self.ranks[level][block]) + int(part[: at - block * _BLOCK].sum())

    def _select(self, level: int, nth: int, bit: int) -> int:
        """Position of the nth (from 0) bit of that value in a plane."""
        rank = self.ranks[level].astype(np.int64)
        if not bit:
            rank = np.minimum(np.arange(len(rank)) * _BLOCK, self.size) - rank
        block = int(np.searchsorted(rank, nth, side="right")) - 1
        first = block * _BLOCK // 8
        part = np.unpackbits(self.planes[level][first : first + _BLOCK // 8], bitorder="little")
        return block * _BLOCK + int(np.nonzero(part == bit)[0][nth - rank[block]])

    def access(self, at: int) -> int:
        if not 0 <= at < self.size:
            raise IndexError(at)
        value = 0
        for level, plane in enumerate(self.planes):
            bit = plane[at >> 3] >> (at & 7) & 1
            ones = self.rank1(level, at)
            at = self.zeros[level] + ones if bit else at - ones
            value = value << 1 | int(bit)
        return value

    def _interval(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences among the first ``end`` ids lie after the last plane."""
        low, high = 0, end
        if value < 0 or value >> len(self.planes):
            return 0, 0
        for level in range(len(self.planes)):
            ones_low, ones_high = self.rank1(level, low), self.rank1(level, high)
            if value >> (len(self.planes) - 1 - level) & 1:
                low, high = self.zeros[level] + ones_low, self.zeros[level] + ones_high
            else:
                low, high = low - ones_low, high - ones_high
        return low, high

    def count(self, value: int, end: int | None = None) -> int:
        """How often an id occurs among the first ``end`` ids."""
        low, high = self._interval(value, self.size if end is None else min(end, self.size))
        return high - low

    def locate(self, value: int, nth: int) -> int:
        """Position of the nth (from 0) occurrence of an id."""
        low, high = self._interval(value, self.size)
        if not 0 <= nth < high - low:
            raise IndexError(nth)
        at = low + nth
        for level in range(len(self.planes) - 1, -1, -1):
            if value >> (len(self.planes) - 1 - level) & 1:
                at = self._select(level, at - self.zeros[level], 1)
            else:
                at = self._select(level, at, 0)
        return at

    def ids(self) -> np.ndarray:
        """All ids in their order, plane by plane from the last."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        now = np.zeros(self.size, kind)
        for level in range(len(self.planes) - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], bitorder="little", count=self.size).view(bool)
            out = np.empty(self.size, kind)
            out[np.flatnonzero(~bits)] = now[: self.zeros[level]]
            out[np.flatnonzero(bits)] = now[self.zeros[level] :] | kind(1 << (len(self.planes) - 1 - level))
            now = out
        return now

    def to_bytes(self) -> bytes:
        return b"".join([part.tobytes() for pair in zip(self.planes, self.ranks) for part in pair])


class Shard:
    """The ids of a run of documents: their alphabet, and a wavelet matrix of places in it."""

    def __init__(self, matrix: WaveletMatrix, letters: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray):
        self.matrix, self.letters, self.doc_ids, self.lengths = matrix, letters, doc_ids, lengths

    @classmethod
    def build(cls, ids: np.ndarray, doc_ids: np.ndarray, lengths: np.ndarray) -> Shard:
        """An alphabet of the ids that occur keeps the planes few."""
        used = np.bincount(ids) > 0 if len(ids) else np.zeros(0, bool)
        letters = np.flatnonzero(used)
        place = (np.cumsum(used) - 1).astype(np.uint16 if len(letters) <= 1 << 16 else np.uint32)
        return cls(WaveletMatrix.build(place[ids]), letters, doc_ids, lengths)

    def _place(self, value: int) -> int:
        at = int(np.searchsorted(self.letters, value))
        return at if at < len(self.letters) and self.letters[at] == value else -1

    def access(self, at: int) -> int:
        return int(self.letters[self.matrix.access(at)])

    def count(self, value: int, end: int | None = None) -> int:
        return self.matrix.count(self._place(value), end)

    def locate(self, value: int, nth: int) -> int:
        return self.matrix.locate(self._place(value), nth)

    def ids(self) -> np.ndarray:
        return self.letters.astype("<u4")[self.matrix.ids()]

    def to_bytes(self) -> bytes:
        """Header, document ids, ids per document, alphabet, planes with their ranks."""
        matrix = self.matrix
        head = _HEAD.pack(_MARK, matrix.size, len(matrix.planes), len(self.doc_ids), len(self.letters))
        parts = [self.doc_ids.astype("<i8"), self.lengths.astype("<u4"), self.letters.astype("<u4")]
        return b"".join([head, *[part.tobytes() for part in parts], matrix.to_bytes()])

    @classmethod
    def from_bytes(cls, content: bytes) -> Shard:
        mark, size, planes, docs, letters = _HEAD.unpack_from(content)
        if mark != _MARK:
            raise ValueError("not a shard")
        at = _HEAD.size
        doc_ids = np.frombuffer(content, "<i8", docs, at)
        lengths = np.frombuffer(content, "<u4", docs, at + 8 * docs)
        alphabet = np.frombuffer(content, "<u4", letters, at + 12 * docs)
        at += 12 * docs + 4 * letters
        width, samples = -(-size // 8), -(-size // _BLOCK) + 1
        found, ranks = [], []
        for _ in range(planes):
            found.append(np.frombuffer(content, np.uint8, width, at))
            ranks.append(np.frombuffer(content, "<u4", samples, at + width))
            at += width + 4 * samples
        return cls(WaveletMatrix(found, ranks, size), alphabet, doc_ids, lengths)


class LibraryEncoder(dict):
    """Ids of whole texts; every distinct chunk and pre-token is encoded once by the library's model.

    Chunks are kept in two generations, like the pre-tokens: a full one is forgotten by and by.
    """

    def __init__(self, path: str):
        super().__init__()
        self.pieces = Pieces(path)
        self.model = self.pieces.library.model
        self.ids = Memo(self._piece, MEMO // 2)
        self.old: dict[bytes, bytes] = {}

    def _piece(self, piece: str | int) -> bytes:
        ids = [piece] if isinstance(piece, int) else [token.id for token in self.model.tokenize(piece)]
        return array("I", ids).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        value = self.old.get(chunk)
        if value is None:
            value = b"".join(map(self.ids.__getitem__, self.pieces.parts(chunk)))
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[chunk] = value
        return value

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


#: first: ids before the shard in its own partition.
SHARDS = "part int, shard int, first long, n_tokens long, n_docs long, content binary"
#: Stands for a null doc_id in a shard.
NO_ID = np.iinfo(np.int64).min


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int, partitions: int) -> None:
    """Encode ``docs`` (doc_id, text), ascending by doc_id, and write the shards to ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(path).encode, np.array([end_id], "<u4").tobytes()
        part, number = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        names: list[int] = []
        held = first = 0

        def shard() -> pa.RecordBatch:
            lengths = np.array([len(value) // 4 for value in ids])
            content = Shard.build(np.frombuffer(b"".join(ids), "<u4"), np.array(names, np.int64), lengths).to_bytes()
            row = [[part], [number], [first], [int(lengths.sum())], [len(names)], [content]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(value, kind) for value, kind in zip(row, kinds)],
                ["part", "shard", "first", "n_tokens", "n_docs", "content"],
            )

        for batch in slices(batches):
            keys = batch.column("doc_id").to_pylist()
            for key, text in zip(keys, as_bytes(batch.column("text"))):
                value = encode(text) + end
                ids.append(value)
                names.append(NO_ID if key is None else key)
                held += len(value) // 4
                if held >= SHARD_TOKENS:
                    yield shard()
                    ids, names, number = [], [], number + 1
                    first, held = first + held, 0
        if names:
            yield shard()

    ordered = docs.select("doc_id", "text").repartitionByRange(partitions, "doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SHARDS).write.option("compression", "zstd").parquet(folder)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the shards: place, ids and their checksum, all from the files."""
    shards = spark.read.schema(SHARDS).parquet(folder)
    # One number per partition of the writer goes to the driver; partitions are in order of doc_id.
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("ids"))
    totals = dict(map(tuple, parts.collect()))
    starts, before = {}, 0
    for part in sorted(totals):
        starts[part], before = before, before + totals[part]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, first, content = (batch.column(k)[row].as_py() for k in range(3))
                shard = Shard.from_bytes(content)
                ids, doc_ids, lengths = shard.ids(), shard.doc_ids, shard.lengths
                ends = np.cumsum(lengths, dtype=np.int64)
                begins = ends - lengths
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, mask=doc_ids == NO_ID),
                        pa.array(begins + starts[part] + first),
                        pa.array(lengths.astype(np.int64)),
                        pa.array(sums, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return shards.select("part", "first", "content").mapInArrow(
        run, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
