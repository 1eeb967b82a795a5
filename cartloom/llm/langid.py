"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text word by word: the bytes of a word (ASCII letters in lower case, after a
space) go through one recurrent layer forwards and one backwards, and both states at a byte give
that byte's language probabilities. A document's probabilities are the mean over all its bytes. As
the states start anew at every word, equal words give equal sums and are computed once per task,
and a sequence is bounded: words over ``SEGMENT`` bytes are read in segments.

The network is trained here in numpy, by backpropagation through time, on the words of a hashed
sample of about ``SAMPLE`` labelled documents per language, ``SAMPLE_CHARS`` characters of each.

Defined results: ``und`` with score 0 for null texts and texts without a letter; long texts are read
whole; equal texts give equal answers; ties go to the language first in code point order; without
labelled documents every text is ``und``; an empty table gives no rows; a column named like an
output gives way to it.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cartloom.llm.shared import as_text, slices, without

UNKNOWN = "und"
SAMPLE = 150
#: Characters of a sampled document that are learned from, at a place that its number draws.
SAMPLE_CHARS = 2_000
#: Drawn words per language. Above so many languages steps grow with their number, and draws, memo
#: and batches shrink with it.
DRAWN = 20_000
MANY = 64
HIDDEN = 16
SEGMENT = 32
STEPS = 700
BATCH = 512
#: Distinct words whose sums a Python worker keeps.
MEMO = 300_000
# A superset of letters that is quick to find: numerals like a half are in it too.
_LETTER = re.compile(r"[^\W\d_]")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


class Layer:
    """One direction: h' = (1 - z) * n + z * h, with n = tanh(x + r * (h U_n))."""

    def __init__(self, rng: np.random.Generator, hidden: int):
        self.hidden = hidden
        self.p = {
            "x": rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32),
            "u": rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32),
        }

    def step(self, codes: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        size = self.hidden
        x, u = self.p["x"][codes], h @ self.p["u"]
        gates = _sigmoid(x[:, : 2 * size] + u[:, : 2 * size])
        z, r = gates[:, :size], gates[:, size:]
        n = np.tanh(x[:, 2 * size :] + r * u[:, 2 * size :])
        return n + z * (h - n), (codes, h, z, r, n, u[:, 2 * size :])

    def back(self, d: np.ndarray, kept: tuple, slope: dict[str, np.ndarray]) -> np.ndarray:
        """Gradient of the state before, given that of the state after; adds to ``slope``."""
        codes, h, z, r, n, un = kept
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        du = np.concatenate([dz, dr, dn * r], axis=1)
        np.add.at(slope["x"], codes, np.concatenate([dz, dr, dn], axis=1))
        slope["u"] += h.T @ du
        return d * z + du @ self.p["u"].T


class Network:
    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.ahead, self.behind = Layer(rng, hidden), Layer(rng, hidden)
        self.out = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    @staticmethod
    def padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the words, one row each, longest first as given, and their lengths."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.zeros((len(words), int(lengths.max())), np.uint8)
        codes[np.arange(codes.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        return codes, lengths

    def states(self, codes: np.ndarray, lengths: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Both states at every byte (time, row, 2 * hidden). Rows are sorted by falling length."""
        size, (rows, width) = self.ahead.hidden, codes.shape
        live = [int(np.searchsorted(-lengths, -at, side="left")) for at in range(width)]
        both = np.zeros((width, rows, 2 * size), np.float32)
        h = np.zeros((rows, size), np.float32)
        for at in range(width):
            n = live[at]
            h[:n], kept = self.ahead.step(codes[:n, at], h[:n].copy() if keep is not None else h[:n])
            both[at, :n, :size] = h[:n]
            if keep is not None:
                keep.append(kept)
        h = np.zeros((rows, size), np.float32)
        for at in range(width - 1, -1, -1):
            n = live[at]
            h[:n], kept = self.behind.step(codes[:n, at], h[:n].copy() if keep is not None else h[:n])
            both[at, :n, size:] = h[:n]
            if keep is not None:
                keep.append(kept)
        return both

    def probabilities(self, both: np.ndarray) -> np.ndarray:
        scores = both @ self.out + self.bias
        scores -= scores.max(-1, keepdims=True)
        np.exp(scores, out=scores)
        return scores / scores.sum(-1, keepdims=True)

    def label_bytes(self, word: bytes) -> np.ndarray:
        """Language probabilities at every byte of a word."""
        codes, lengths = self.padded([word])
        return self.probabilities(self.states(codes, lengths))[:, 0]

    def word_sums(self, words: list[bytes]) -> np.ndarray:
        """Sum of the byte probabilities of every word."""
        out = np.zeros((len(words), len(self.languages)), np.float32)
        parts = [(k, part) for k, word in enumerate(words) for part in segments(word)]
        parts.sort(key=lambda part: -len(part[1]))
        size = max(1, 4 * BATCH * MANY // max(MANY, len(self.languages)))
        for start in range(0, len(parts), size):
            own = parts[start : start + size]
            codes, lengths = self.padded([word for _, word in own])
            found = self.probabilities(self.states(codes, lengths))
            found *= (np.arange(codes.shape[1])[:, None] < lengths)[..., None]
            np.add.at(out, [k for k, _ in own], found.sum(0))
        return out

    def train(self, words: list[bytes], targets: np.ndarray, steps: int = STEPS, seed: int = 12) -> None:
        """Adam on the cross-entropy of every byte's label, gradients through time."""
        rng = np.random.default_rng(seed)
        size = self.ahead.hidden
        weights = [self.ahead.p["x"], self.ahead.p["u"], self.behind.p["x"], self.behind.p["u"], self.out, self.bias]
        first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
        lengths_all = np.fromiter(map(len, words), np.int64, len(words))
        for turn in range(1, steps + 1):
            chosen = rng.integers(0, len(words), min(BATCH, len(words)))
            chosen = chosen[np.argsort(-lengths_all[chosen], kind="stable")]
            codes, lengths = self.padded([words[k] for k in chosen])
            keep: list = []
            both = self.states(codes, lengths, keep)
            width = codes.shape[1]
            mask = np.arange(width)[:, None] < lengths
            d = self.probabilities(both)
            d[:, np.arange(len(chosen)), targets[chosen]] -= 1
            d *= mask[..., None] / np.float32(mask.sum())
            slopes = [{k: np.zeros_like(v) for k, v in layer.p.items()} for layer in (self.ahead, self.behind)]
            state = d @ self.out.T
            for layer, slope, kept, part, times in (
                (self.ahead, slopes[0], keep[:width], slice(0, size), range(width - 1, -1, -1)),
                (self.behind, slopes[1], keep[width:][::-1], slice(size, None), range(width)),
            ):
                carried = np.zeros((len(chosen), size), np.float32)
                for at in times:
                    n = len(kept[at][0])
                    carried[:n] = layer.back(carried[:n] + state[at, :n, part], kept[at], slope)
            flat = both.reshape(-1, 2 * size)
            gradients = [
                slopes[0]["x"], slopes[0]["u"], slopes[1]["x"], slopes[1]["u"],
                flat.T @ d.reshape(-1, d.shape[-1]), d.sum((0, 1)),
            ]
            rate = 0.02 * (1 - turn / (steps + 1)) + 0.001
            for k, (w, g) in enumerate(zip(weights, gradients)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                w -= (rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)).astype(np.float32)


def text_words(text: bytes) -> list[bytes]:
    """Words in lower case (ASCII), each after a space."""
    return [b" " + word for word in text.lower().split()]


def segments(word: bytes) -> list[bytes]:
    """A word in parts of at most ``SEGMENT`` bytes, cut before whole characters where it is UTF-8."""
    parts, start = [], 0
    while len(word) - start > SEGMENT:
        end = start + SEGMENT
        while end > start + SEGMENT - 4 and word[end] & 0xC0 == 0x80:
            end -= 1
        parts.append(word[start:end])
        start = end
    return [*parts, word[start:]]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, _LETTER.findall(text[:64]))) or any(
        found[0].isalpha() for found in _LETTER.finditer(text)
    )


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE) -> Network | None:
    """A network of the labelled documents that are not held out; the driver reads the bounded sample.

    The sample is chosen from ids and labels alone; texts are read for the chosen rows.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    labelled = labelled.where(~held_out(F.col("doc_id")))
    sizes = labelled.groupBy("lang").count().collect()
    steps = {row["lang"]: -(-row["count"] // sample) for row in sizes}
    if not steps:
        return None
    # A constant, one lookup per row at any number of languages.
    step = F.element_at(F.create_map(*[F.lit(value) for pair in steps.items() for value in pair]), F.col("lang"))
    # Row by row: a doc_id that many rows share does not bring them all.
    chosen = F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), step) == 0
    spare = F.greatest(F.length("text") - SAMPLE_CHARS, F.lit(0))
    part = F.substring("text", 1 + F.pmod(F.xxhash64("doc_id"), spare + 1).cast("int"), F.lit(SAMPLE_CHARS))
    rows = labelled.where(chosen).select("doc_id", "lang", part.alias("text"))
    texts: dict[str, list[str]] = {lang: [] for lang in sorted(steps)}
    for lang, _, text in sorted((row["lang"], row["doc_id"], row["text"]) for row in rows.collect()):
        texts[lang].append(text)
    languages = list(texts)
    drawn = -(-DRAWN * MANY // max(MANY, len(languages)))
    words: list[bytes] = []
    targets: list[int] = []
    for number, lang in enumerate(languages):
        own = [part for text in texts[lang] for word in text_words(text.encode()) for part in segments(word)]
        # Languages count alike, whatever their number of words in the sample.
        own = [own[k] for k in np.random.default_rng(number).integers(0, len(own), drawn)] if own else []
        words += own
        targets += [number] * len(own)
    if not words:
        return None
    network = Network(languages)
    network.train(words, np.array(targets), -(-STEPS * max(MANY, len(languages)) // MANY))
    return network


class _Places(dict):
    """Words in the order in which they were asked for first, numbered."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


class _Sums:
    """Sums per distinct word. Of more than a worker keeps, those stay that came twice since the last time."""

    def __init__(self, network: Network):
        self.network = network
        self.place = _Places()
        self.table = np.zeros((0, len(network.languages)), np.float32)
        self.lengths, self.seen = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def forget(self) -> None:
        kept = np.nonzero(self.seen > 1)[0]
        words = list(self.place)
        self.place = _Places((words[old], new) for new, old in enumerate(kept.tolist()))
        self.table, self.lengths, self.seen = self.table[kept], self.lengths[kept], np.zeros(len(kept), np.int64)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of every text; zeros for a text without words."""
        if len(self.place) > MEMO * MANY // max(MANY, self.table.shape[1]):
            self.forget()
        place, known = self.place, len(self.place)
        words = [text.lower().split() for text in texts]
        counts = np.array(list(map(len, words)))
        ids = np.fromiter(map(place.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        if len(place) > known:
            fresh = [b" " + word for word in islice(place, known, None)]
            self.table = np.concatenate([self.table, self.network.word_sums(fresh)])
            self.lengths = np.concatenate([self.lengths, np.fromiter(map(len, fresh), np.int64, len(fresh))])
            self.seen = np.concatenate([self.seen, np.zeros(len(fresh), np.int64)])
        self.seen += np.bincount(ids, minlength=len(place))
        text = np.repeat(np.arange(len(texts)), counts)
        out = np.zeros((len(texts), self.table.shape[1]))
        for column in range(out.shape[1]):
            out[:, column] = np.bincount(text, self.table[ids, column], len(texts))
        total = np.bincount(text, self.lengths[ids], len(texts))
        return out / np.maximum(1, total)[:, None]


#: The sums of the network that this Python worker used last, by the plan's own token.
_WORKER: dict[str, _Sums] = {}


def identify(
    docs: DataFrame, network: Network | None, label: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """All columns of ``docs`` with the language and its score; reads the text alone."""
    docs = without(docs, label, score)
    if network is None:
        return docs.withColumns({label: F.lit(UNKNOWN), score: F.lit(0.0)})
    names, token = docs.columns, uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _WORKER.get(token)
        if sums is None:
            _WORKER.clear()
            sums = _WORKER[token] = _Sums(network)
        for batch in slices(batches):
            texts = as_text(batch.column("text"))
            means = sums.pooled([text.encode() for text in texts])
            best = means.argmax(1)
            known = np.array([has_letter(text) for text in texts])
            labels = [network.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            scores = np.where(known, means[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels, pa.string()), pa.array(np.clip(scores, 0, 1))],
                [*names, label, score],
            )

    schema = T.StructType([*docs.schema.fields]).add(label, "string", False).add(score, "double", False)
    return docs.mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
