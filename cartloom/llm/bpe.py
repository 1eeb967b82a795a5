"""BPE by forced boundaries: certain cuts first, then every fragment on its own.

A merge joins neighbouring bytes into one vocabulary token. Two bytes that stand side by side in no
vocabulary token can therefore never be joined, and what is left and right of them is merged
independently. ``byte_pairs`` lists the pairs that do occur; everything else is a cut. Fragments are
encoded by the library's merge model, the last one of a pre-token with the end-of-word mark, the
others without, and the ids are put together again.

Defined results: null and empty texts have no ids and decode to an empty text; equal rows give equal
results; a long text is encoded whole; an empty table gives no rows. Other columns stay, but one named like
an output gives way to it.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer, models

from cartloom.llm.pieces import Pieces, byte_alphabet
from cartloom.llm.shared import Memo, as_bytes, slices, without

#: Ids that are decoded at a time.
SLICE_IDS = 1 << 18
#: Chunks kept per Python worker and generation.
MEMO = 120_000


def byte_pairs(vocabulary: list[str], end: str) -> np.ndarray:
    """256 x 256: whether the second byte follows the first inside some vocabulary token."""
    number = {letter: value for value, letter in enumerate(byte_alphabet())}
    seen = np.zeros((256, 256), bool)
    for token in vocabulary:
        body = token.removesuffix(end) if end else token
        if all(letter in number for letter in body):
            values = [number[letter] for letter in body]
            seen[values[:-1], values[1:]] = True
    return seen


class ForcedBoundaryBpe:
    def __init__(self, path: str):
        self.pieces = Pieces(path)
        state = json.loads(self.pieces.library.to_str())["model"]
        if state["type"] != "BPE" or state.get("ignore_merges") or state.get("byte_fallback"):
            raise ValueError("a byte-level BPE file is needed")
        self.end = state.get("end_of_word_suffix") or ""
        self.closing = self.pieces.library.model
        merges = [tuple(pair) if isinstance(pair, list) else tuple(pair.split(" ")) for pair in state["merges"]]
        self.open = models.BPE(state["vocab"], merges)
        pairs = byte_pairs(list(state["vocab"]), self.end)
        letters = byte_alphabet()
        self.joined = {letters[a] + letters[b] for a, b in zip(*map(np.ndarray.tolist, np.nonzero(pairs)))}
        self.piece_ids = Memo(self._piece, MEMO)
        self.chunk_ids = Memo(self._chunk, MEMO)

    def fragments(self, piece: str) -> list[str]:
        """The piece cut between any two bytes that no token holds side by side."""
        joined, out, start = self.joined, [], 0
        for at in range(1, len(piece)):
            if piece[at - 1 : at + 1] not in joined:
                out.append(piece[start:at])
                start = at
        out.append(piece[start:])
        return out

    def _piece(self, piece: str | int) -> bytes:
        if isinstance(piece, int):
            return array("i", [piece]).tobytes()
        *inner, last = self.fragments(piece)
        ids = [token.id for fragment in inner for token in self.open.tokenize(fragment)]
        ids += [token.id for token in self.closing.tokenize(last)]
        return array("i", ids).tobytes()

    def _chunk(self, chunk: bytes) -> bytes:
        return b"".join(map(self.piece_ids.__getitem__, self.pieces.parts(chunk)))

    def encode(self, text: bytes) -> bytes:
        """All ids of a text as 32-bit integers."""
        return b"".join(map(self.chunk_ids.__getitem__, text.split()))


def encoded(bpe: ForcedBoundaryBpe, texts: list[bytes]) -> list[bytes]:
    """Ids of every text. Equal neighbours, as the epochs of a document in a mix, are encoded once."""
    found: list[bytes] = []
    for at, text in enumerate(texts):
        found.append(found[-1] if at and text == texts[at - 1] else bpe.encode(text))
    return found


def token_texts(path: str) -> dict[int, str]:
    """Token of every id, special ones too."""
    library = Tokenizer.from_file(path)
    if library.decoder is not None:
        raise ValueError("a file without a decoder is needed: its ids are joined by spaces")
    return {value: token for token, value in library.get_vocab().items()}


@lru_cache(maxsize=2)
def token_array(path: str) -> pa.Array:
    """Token at the place of every id; null at a number that is no id."""
    by_id = token_texts(path)
    return pa.array([by_id.get(number) for number in range(max(by_id) + 1)], pa.large_string())


def id_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_IDS) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the lists of a column have about ``limit`` values at most; a longer one stands alone."""
    for batch in batches:
        start = held = 0
        for row, length in enumerate(pc.fill_null(pc.list_value_length(batch.column(column)), 0).to_pylist()):
            if held and held + length > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += length
        if batch.num_rows:
            yield batch.slice(start)


@lru_cache(maxsize=2)
def codec(path: str) -> ForcedBoundaryBpe:
    return ForcedBoundaryBpe(path)


def _with(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind, False)])


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """All columns of ``docs`` without the text, and the token ids of the whole text."""
    docs = without(docs, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        for batch in slices(batches, text):
            found = encoded(bpe, as_bytes(batch.column(text)))
            ends = np.cumsum([0] + [len(value) // 4 for value in found]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(found), np.int32))
            column = pa.ListArray.from_arrays(pa.array(ends), values)
            yield pa.RecordBatch.from_arrays([*batch.drop_columns([text]).columns, column], [*names, ids])

    names = [name for name in docs.columns if name != text]
    schema = _with(docs.drop(text).schema, ids, T.ArrayType(T.IntegerType(), False))
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All columns, and the text of the ids; null ids give an empty text.

    As the library does for a file without a decoder: tokens with spaces between.
    """
    encoded = without(encoded, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_array(path)
        for part in id_slices(batches, ids):
            lists = part.column(ids)
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int64())
            held = pa.LargeListArray.from_arrays(ends, tokens.take(pc.list_flatten(lists)))
            found = pc.binary_join(held, pa.scalar(" ", pa.large_string())).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, found], [*names, text])

    names = encoded.columns
    return encoded.mapInArrow(run, _with(encoded.schema, text, T.StringType()))


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: number of ids, and digests of the ids and of the text decoded from them."""
    found = decode(encode(docs.select("doc_id", "text"), path), path)
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
