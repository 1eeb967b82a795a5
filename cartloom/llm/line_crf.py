"""Quality rule by line labels: Viterbi decoding of a linear-chain conditional random field.

Every line with a word is content or boilerplate. The field scores a line by features of its
characters and words and by the label of the line before; the best sequence of labels (Viterbi)
gives the share of the text's characters in content lines, and that share decides about the text.
Base rules come first: at least ``MIN_WORDS`` words, and at most ``MAX_REPEATED`` percent of the words
in an eight-word window that is found twice or more.

The field is trained here, by gradient ascent on the likelihood (forward-backward in numpy), on a
hashed sample of about ``SAMPLE`` labelled documents: lines of good ones are content, lines of bad
ones and repeated lines are boilerplate.

Defined results: null and empty texts have no words and are not kept; lines without words take no
part; lines longer than any other are lines all the same; equal rows give equal results; without
labelled documents every line is content; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cartloom.llm.shared import as_text, hashed_sample, slices

MIN_WORDS = 20
MAX_REPEATED = 30
WINDOW = 8
#: Share of word characters in content lines from which a text is kept.
MIN_CONTENT = 0.5
SAMPLE = 1_500
#: Lines that training reads of each document of the sample at most.
SAMPLE_LINES = 200
ROUNDS = 200
_SYMBOLS = "#*$%&|<>"
_WHITE = "\x20\t\n\x0b\f\r"
_MARKS = re.compile(r"[^\w\s]", re.ASCII)
_UPPER = re.compile(r"[A-Z]")
_LOWER = re.compile(r"[^\W\d_A-Z]")
_DIGIT = re.compile(r"[0-9]")
FEATURES = ("one", "symbols", "marks", "upper", "digits", "repeated", "few words", "word length", "distinct", "ended")


def line_features(line: str, words: list[str], repeated: bool) -> list[float]:
    """Values between 0 and 1."""
    size, count = len(line), len(words)
    upper, lower = len(_UPPER.findall(line)), len(_LOWER.findall(line))
    symbols = sum(map(line.count, _SYMBOLS))
    return [
        1.0,
        min(1.0, 5 * symbols / size),
        min(1.0, 3 * len(_MARKS.findall(line)) / size),
        upper / max(1, upper + lower),
        len(_DIGIT.findall(line)) / size,
        float(repeated),
        1.0 / count,
        min(1.0, sum(map(len, words)) / count / 12),
        len(set(words)) / count,
        float(line.rstrip()[-1:] in ".!?:;"),
    ]


def text_lines(text: str) -> tuple[list[list[float]], list[int], int]:
    """Features and word characters of every line with a word, and how many repeat an earlier one."""
    seen: set[str] = set()
    features, sizes, repeats = [], [], 0
    for line in text.split("\n"):
        words = line.split()
        if not words:
            # Other white space than ASCII may be all a line has; that counts as a word.
            if not line.strip(_WHITE):
                continue
            words = [line.strip(_WHITE)]
        repeated = line in seen
        seen.add(line)
        repeats += repeated
        features.append(line_features(line, words, repeated))
        sizes.append(len(line) - sum(map(line.count, _WHITE)))
    return features, sizes, repeats


class Field:
    """Weights of a two-label chain; label 1 is content."""

    def __init__(self, emission: np.ndarray, step: np.ndarray):
        self.emission, self.step = emission, step

    @classmethod
    def blank(cls) -> Field:
        emission = np.zeros((2, len(FEATURES)))
        emission[1, 0] = 1.0
        return cls(emission, np.zeros((2, 2)))

    def viterbi(self, features: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best labels of sequences that follow one another in ``features``."""
        scores = features @ self.emission.T
        order = np.argsort(-lengths, kind="stable")
        starts = (np.cumsum(lengths) - lengths)[order]
        sorted_lengths = lengths[order]
        back = np.zeros((len(scores), 2), np.int8)
        best = np.zeros((len(lengths), 2))
        longest = int(sorted_lengths[0]) if len(lengths) else 0
        for at in range(longest):
            live = int(np.searchsorted(-sorted_lengths, -at, side="left"))
            rows = starts[:live] + at
            if at:
                ways = best[:live, :, None] + self.step[None]
                back[rows] = ways.argmax(1)
                best[:live] = ways.max(1) + scores[rows]
            else:
                best[:live] = scores[rows]
        labels = np.zeros(len(scores), np.int8)
        current = best.argmax(1).astype(np.int8)
        for at in range(longest - 1, -1, -1):
            live = int(np.searchsorted(-sorted_lengths, -at, side="left"))
            rows = starts[:live] + at
            labels[rows] = current[:live]
            current[:live] = back[rows, current[:live]]
        return labels

    @classmethod
    def train(cls, sequences: list[np.ndarray], labels: list[np.ndarray], rounds: int = ROUNDS) -> Field:
        """Maximum likelihood with a small penalty; Adam steps on the whole sample."""
        if not sequences:
            return cls.blank()
        order = sorted(range(len(sequences)), key=lambda k: -len(sequences[k]))
        longest = len(sequences[order[0]])
        x = np.zeros((len(order), longest, len(FEATURES)))
        y = np.zeros((len(order), longest), int)
        lengths = np.array([len(sequences[k]) for k in order])
        for row, k in enumerate(order):
            x[row, : lengths[row]], y[row, : lengths[row]] = sequences[k], labels[k]
        mask = np.arange(longest) < lengths[:, None]
        one_hot = np.eye(2)[y] * mask[..., None]
        seen = np.einsum("ntl,ntf->lf", one_hot, x)
        moves = np.einsum("nta,ntb->ab", one_hot[:, :-1], one_hot[:, 1:])
        field = cls(np.zeros((2, len(FEATURES))), np.zeros((2, 2)))
        first = [np.zeros_like(field.emission), np.zeros_like(field.step)]
        second = [np.zeros_like(field.emission), np.zeros_like(field.step)]
        for turn in range(1, rounds + 1):
            states, pairs = field._marginals(x, mask)
            expected = np.einsum("ntl,ntf->lf", states, x)
            slopes = [
                (seen - expected) / len(order) - 1e-4 * field.emission,
                (moves - pairs) / len(order) - 1e-4 * field.step,
            ]
            for k, (weights, slope) in enumerate(zip((field.emission, field.step), slopes)):
                first[k] = 0.9 * first[k] + 0.1 * slope
                second[k] = 0.999 * second[k] + 0.001 * slope**2
                weights += 0.1 * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.999**turn)) + 1e-8)
        return field

    def _marginals(self, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected labels per line, and expected moves in all (forward-backward)."""
        scores = x @ self.emission.T
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for at in range(1, scores.shape[1]):
            ways = forward[:, at - 1, :, None] + self.step
            forward[:, at] = np.where(mask[:, at, None], np.logaddexp(ways[:, 0], ways[:, 1]) + scores[:, at], forward[:, at - 1])
        total = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        for at in range(scores.shape[1] - 2, -1, -1):
            ways = self.step + (scores[:, at + 1] + backward[:, at + 1])[:, None, :]
            backward[:, at] = np.where(mask[:, at + 1, None], np.logaddexp(ways[..., 0], ways[..., 1]), 0.0)
        states = np.exp(forward + backward - total[:, None, None]) * mask[..., None]
        after = (scores + backward)[:, 1:, None, :] + forward[:, :-1, :, None] + self.step - total[:, None, None, None]
        return states, (np.exp(after) * mask[:, 1:, None, None]).sum((0, 1))


def train(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> Field:
    """The field of a hashed sample of about ``bound`` labelled documents, which the driver reads."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = hashed_sample(known, "doc_id", bound)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id")
    sequences, marks = [], []
    for row in texts.select("text", "quality").orderBy("doc_id").collect():
        features, _, _ = text_lines(row["text"])
        if features:
            lines = np.array(features[:SAMPLE_LINES])
            sequences.append(lines)
            marks.append(((row["quality"] == 1) & (lines[:, FEATURES.index("repeated")] == 0)).astype(int))
    return Field.train(sequences, marks)


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[list[bytes]], window: int = WINDOW) -> list[int]:
    """Per text, words that stand in a window of ``window`` words found twice or more in the text."""
    assert window == 8, "windows are built by doubling"
    number: dict[bytes, int] = {}
    get = number.setdefault
    counts = np.array([len(own) for own in words])
    total = int(counts.sum())
    out = np.zeros(len(words), np.int64)
    if total < window:
        return out.tolist()
    ids = np.fromiter((get(word, len(number)) for own in words for word in own), np.int64, total)
    text = np.repeat(np.arange(len(words)), counts)
    code = (ids.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
    code ^= code >> np.uint64(29)
    for span in (1, 2, 4):
        code = code[:-span] * (_MULTIPLIER + np.uint64(2 * span)) + code[span:]
        code ^= code >> np.uint64(31)
    code += text[: len(code)].astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
    begins = np.nonzero(text[: len(code)] == text[window - 1 :])[0]
    order = begins[np.argsort(code[begins], kind="stable")]
    left, right = order[:-1], order[1:]
    equal = (code[left] == code[right]) & (text[left] == text[right])
    left, right = left[equal], right[equal]
    for k in range(window):  # the hash proposes, the words decide
        same = ids[left + k] == ids[right + k]
        left, right = left[same], right[same]
    edge = np.zeros(total + 1, np.int64)
    starts = np.unique(np.concatenate([left, right]))
    edge[starts] += 1
    edge[starts + window] -= 1
    np.add.at(out, text[np.cumsum(edge[:-1]) > 0], 1)
    return out.tolist()


def judge(docs: DataFrame, field: Field, min_content: float = MIN_CONTENT) -> DataFrame:
    """doc_id, counts, base_failed, kept, content share, lines and content lines of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = as_text(batch.column("text"))
            words = [text.encode().split() for text in texts]
            n_words = np.array(list(map(len, words)))
            repeated = np.array(repeated_words(words))
            del words
            word_chars = [len(text) - sum(map(text.count, _WHITE)) for text in texts]
            symbols = [sum(map(text.count, _SYMBOLS)) for text in texts]
            lines = [text_lines(text) for text in texts]
            lengths = np.array([len(features) for features, _, _ in lines])
            features = np.array([row for own, _, _ in lines for row in own]).reshape(-1, len(FEATURES))
            sizes = np.array([size for _, own, _ in lines for size in own], np.int64)
            content = field.viterbi(features, lengths).astype(np.int64)
            text = np.repeat(np.arange(len(texts)), lengths)
            good = np.bincount(text, content * sizes, len(texts))
            share = good / np.maximum(1, np.bincount(text, sizes, len(texts)))
            failed = (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEATED * n_words)
            columns = [
                batch.column("doc_id"),
                n_words,
                word_chars,
                symbols,
                [repeats for _, _, repeats in lines],
                repeated,
                failed,
                ~failed & (share >= min_content),
                share,
                lengths,
                np.bincount(text, content, len(texts)).astype(np.int64),
            ]
            kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] + [pa.int64()] * 2
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds)], names
            )

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, content_share double, n_lines long, n_content_lines long"
    )
    names = [part.split()[0] for part in schema.split(",")]
    return docs.select("doc_id", "text").mapInArrow(run, schema)
