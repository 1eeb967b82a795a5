"""Bottom-k sketches of word shingles: the k smallest distinct hashes of a text's five-word shingles.

A sketch is a sorted array of unsigned 64-bit hashes stored as little-endian binary. The union of two
sketches, cut at k again, is the sketch of the union, so parts of a text or of a corpus can be
sketched apart and merged. From two sketches come resemblance (Jaccard), containment and, from the
k-th smallest hash, the number of distinct shingles.

Words are runs without ASCII white space. A text of one to four words has one shingle, the whole
sequence. Null and text without words have the empty sketch: like another empty one (1.0), unlike any
other (0.0). Equal texts have equal sketches; long texts are read whole; an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cartloom.llm.shared import as_text, slices

K = 128
SHINGLE = 5
#: Blocks of neighbouring ids at most; each is one task's stream, so the number bounds no data.
MAX_BLOCKS = 4_096

_BASE, _STEP = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD1342543DE82EF95)


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; different values stay different."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_OF_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _BASE)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def _powers(base: np.uint64, count: int) -> np.ndarray:
    out = np.ones(count, np.uint64)
    if count > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, extended as longer inputs come."""

    def __init__(self):
        self.inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            self.up, self.down = _powers(_BASE, count), _powers(self.inverse, count)
        return self.up[:count], self.down[:count]


_POWERS = _Powers()


def shingle_hashes(texts: list[bytes], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of the texts, and where each text's hashes end.

    A word's hash is a polynomial of its bytes, taken from running sums over the whole input; a
    shingle's is a polynomial of its words' hashes, spread at the end.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    white = _WHITE[data]
    before = np.concatenate([[True], white[:-1]])
    starts = np.nonzero(~white & before)[0]
    ends = np.nonzero(white & ~before)[0]
    up, down = _POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * up[:-1], out=total[1:])
    words = _mixed((total[ends] - total[starts]) * down[starts])

    text_ends = np.cumsum([len(text) + 1 for text in texts])
    word_ends = np.searchsorted(starts, text_ends)
    counts = np.diff(np.concatenate([[0], word_ends]))
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    shingle_ends = np.cumsum(made)
    firsts = np.repeat(word_ends - counts - (shingle_ends - made), made) + np.arange(made.sum())
    lengths = np.repeat(np.minimum(counts, size), made)
    value = np.zeros(len(firsts), np.uint64)
    for k in range(size):
        use = k < lengths
        value[use] = (value[use] + words[firsts[use] + k]) * _STEP
    return _mixed(value + lengths.astype(np.uint64)), shingle_ends


def sketches(texts: list[bytes], k: int = K, size: int = SHINGLE) -> list[np.ndarray]:
    hashes, ends = shingle_hashes(texts, size)
    out, start = [], 0
    for end in ends.tolist():
        own = hashes[start:end]
        start = end
        if len(own) > 4 * k:
            # All below a bound that surely holds k distinct hashes; else all of them.
            least = np.partition(own, 3 * k)[: 3 * k + 1]
            found = np.unique(least)
            if len(found) <= k:
                found = np.unique(own)
        else:
            found = np.unique(own)
        out.append(found[:k])
    return out


def merge(*parts: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of what the parts were made of."""
    return np.unique(np.concatenate(parts))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of common shingles among all, estimated from the k smallest of the union."""
    union = merge(a, b, k=k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum() / len(union))


def distinct_shingles(sketch: np.ndarray, k: int = K) -> float:
    """Exact below k hashes; else from how densely the k smallest fill the hash range."""
    if len(sketch) < k:
        return float(len(sketch))
    return (k - 1) * 2.0**64 / (float(sketch[k - 1]) + 1.0)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has too."""
    if not len(a):
        return 1.0
    union = distinct_shingles(merge(a, b, k=k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct_shingles(a, k))


def to_text(sketch: np.ndarray) -> str:
    return base64.b64encode(sketch.astype("<u8").tobytes()).decode()


def from_text(value: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(value), "<u8")


def sketch_documents(docs: DataFrame, text: str = "text", k: int = K) -> DataFrame:
    """(doc_id, sketch binary) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            texts = [value.encode() for value in as_text(batch.column(text))]
            found = [sketch.astype("<u8").tobytes() for sketch in sketches(texts, k)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.binary())], ["doc_id", "sketch"]
            )

    return docs.select("doc_id", text).mapInArrow(run, "doc_id long, sketch binary")


def merge_sketches(parts: DataFrame, by: list[str], k: int = K) -> DataFrame:
    """Merge sketches per key. Hashes are made distinct, then cut at k before and after the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(value or b"", "<u8") for value in batch.column("sketch").to_pylist()]
            counts = [len(value) for value in found]
            rows = np.repeat(np.arange(len(found)), counts)
            # Order of signed numbers as that of the unsigned ones.
            flat = np.concatenate([*found, np.zeros(0, "<u8")]) ^ np.uint64(1 << 63)
            keys = [batch.column(name).take(pa.array(rows)) for name in by]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(flat.view(np.int64))], [*by, "hash"])

    kinds = ", ".join(f"`{name}` {parts.schema[name].dataType.simpleString()}" for name in by)
    hashes = parts.select(*by, "sketch").mapInArrow(run, f"{kinds}, hash long").distinct()
    order = Window.partitionBy(*by).orderBy("hash")
    least = hashes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    return least.groupBy(*by).agg(F.array_sort(F.collect_list("hash")).alias("hashes"))


def _chunked(value: str) -> bytes:
    return value.encode("utf-8", "surrogatepass")


def with_next(docs: DataFrame) -> DataFrame:
    """One partition per block of neighbouring ids, ending with the document that follows the block.

    Columns: doc_id, text, guest. A block is sorted by descending doc_id, then text (null lowest);
    its last row, the guest, is the first of the block below, after the lowest block the very first
    of all. So every document is followed by the next one of the whole table, and each text is
    shuffled once. Only the cuts between blocks and one id per block pass through the driver.
    """
    blocks = min(MAX_BLOCKS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)).cast("long"))
    ids = docs.select(key.alias("key"))
    marks = [k / blocks for k in range(1, blocks)] or [0.5]
    cuts = ids.agg(F.percentile_approx("key", marks, 10 * blocks)).first()[0]
    bounds = F.array(*[F.lit(cut).cast("long") for cut in sorted(set(cuts or [0]))])
    block = F.size(F.filter(bounds, lambda cut: cut < F.col("key")))
    tops = ids.groupBy(block.alias("block")).agg(F.max("key").alias("top")).orderBy("block").collect()
    # The highest id of a block comes after the lowest one of the block above it.
    target = [
        F.when(F.col("key") == row["top"], F.lit(tops[(n + 1) % len(tops)]["block"]))
        for n, row in enumerate(tops)
    ]
    placed = docs.select("doc_id", "text", key.alias("key")).withColumns(
        {"own": block, "target": F.coalesce(*target) if target else F.lit(None).cast("int")}
    )
    copies = F.array(
        F.struct(F.col("own").alias("block"), F.lit(False).alias("guest")),
        F.struct(F.col("target").alias("block"), F.lit(True).alias("guest")),
    )
    rows = placed.select("doc_id", "text", "key", F.inline(F.filter(copies, lambda c: c["block"].isNotNull())))
    rows = rows.repartitionById(blocks, F.col("block"))
    return rows.sortWithinPartitions("guest", F.desc("key"), "text").select("doc_id", "text", "guest")


def compare_edited(docs: DataFrame, k: int = K) -> DataFrame:
    """Sketch every text and its edited form, and compare it with that and with the next text.

    Edited: the last third of the code points (rounded down) replaced by as many first ones of the
    next document, or all it has. A table of one document is its own next.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Lists of (doc_id, text) in which each but the last has its next one behind it."""
        held: list[tuple] = []
        for batch in slices(batches):
            guests = batch.column("guest").to_pylist()
            own = list(zip(batch.column("doc_id").to_pylist(), as_text(batch.column("text"))))
            first = guests.index(True) if True in guests else len(own)
            held += own[: first + 1]
            if len(held) > 1:
                yield held
            if first < len(own):
                return
            held = held[-1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows(batches):
            texts = [text for _, text in part]
            thirds = [len(text) // 3 for text in texts]
            changed = [
                _chunked(text[: len(text) - third] + following[:third])
                for text, third, following in zip(texts, thirds, texts[1:])
            ]
            own = sketches([_chunked(text) for text in texts], k)
            edited = sketches(changed, k)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_id for doc_id, _ in part[:-1]], pa.int64()),
                    pa.array(list(map(len, texts[:-1])), pa.int64()),
                    pa.array([hashlib.sha256(value).hexdigest() for value in changed]),
                    pa.array(list(map(to_text, own[:-1]))),
                    pa.array(list(map(to_text, edited))),
                    pa.array([resemblance(a, b, k) for a, b in zip(own, edited)]),
                    pa.array([resemblance(a, b, k) for a, b in zip(own, own[1:])]),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return with_next(docs).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double",
    )
