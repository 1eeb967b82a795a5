"""Quality rule, tokens, sketches and languages against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartloom.llm import bpe, langid, line_crf, sketch, wavelet

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df, *columns):
    return sorted(((row["doc_id"], *[row[c] for c in columns]) for row in df.collect()), key=str)


# --- quality rule


def plain_base(text):
    text = text or ""
    words, seen, repeats = WORDS.findall(text), set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            repeats += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if counts[window] > 1:
            covered.update(range(k, k + 8))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeats, len(covered), failed


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@pytest.mark.parametrize("table", ["docs", "repeated", "empty", "clashing"])
def test_base_rules(table, request):
    df = request.getfixturevalue(table)
    found = line_crf.judge(df, line_crf.Field.blank())
    expected = sorted(((row["doc_id"], *plain_base(row["text"])) for row in df.collect()), key=str)
    assert by_id(found, *BASE) == expected
    assert all(row["kept"] == (not row["base_failed"]) for row in found.collect())


def test_viterbi_against_all_sequences():
    rng = np.random.default_rng(1)
    field = line_crf.Field(rng.normal(size=(2, 10)), rng.normal(size=(2, 2)))
    lengths = np.array([3, 0, 6, 1])
    features = rng.normal(size=(10, 10))
    labels, start = field.viterbi(features, lengths), 0
    for length in lengths:
        x = features[start : start + length]

        def score(y):
            steps = sum(field.step[a, b] for a, b in zip(y, y[1:]))
            return steps + sum(field.emission[label] @ row for label, row in zip(y, x))

        best = max(itertools.product((0, 1), repeat=int(length)), key=score)
        assert tuple(labels[start : start + length]) == best
        start += length


def test_marginals_against_all_sequences():
    rng = np.random.default_rng(2)
    field = line_crf.Field(rng.normal(size=(2, 10)), rng.normal(size=(2, 2)))
    x = rng.normal(size=(1, 4, 10))
    states, pairs = field._marginals(x, np.ones((1, 4), bool))
    weights, expected, moves = [], np.zeros((4, 2)), np.zeros((2, 2))
    every = list(itertools.product((0, 1), repeat=4))
    for y in every:
        score = sum(field.step[a, b] for a, b in zip(y, y[1:])) + sum(field.emission[k] @ r for k, r in zip(y, x[0]))
        weights.append(np.exp(score))
    for y, weight in zip(every, np.array(weights) / sum(weights)):
        expected[range(4), y] += weight
        for a, b in zip(y, y[1:]):
            moves[a, b] += weight
    assert np.allclose(states[0], expected) and np.allclose(pairs, moves)


def test_trained_field_tells_junk_lines(spark):
    good = "The ship left the harbour at noon. It carried grain and salt to the islands."
    junk = "BUY### NOW&&& CHEAP*** | CLICK | HERE!!! WIN$$$ FREE%%% OFFER### BEST### DEAL&&&"
    rows = [(n, "\n".join([good, junk][n % 2] + f" {n} {k}" for k in range(6))) for n in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(n, 1 - n % 2, 0) for n in range(60)], "doc_id long, quality int, toxic int")
    found = line_crf.judge(docs, line_crf.train(docs, labels))
    shares = {row["doc_id"]: row["content_share"] for row in found.collect()}
    assert all(share == 1 - n % 2 for n, share in shares.items())


def test_no_labels(docs, spark):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    assert line_crf.judge(docs, line_crf.train(docs, labels)).count() == docs.count()


# --- tokens


def library(path):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.mark.parametrize("table", ["docs", "repeated", "empty", "clashing"])
def test_forced_boundary_ids(table, request, vocabulary):
    df, tokenizer = request.getfixturevalue(table), library(vocabulary)
    found = bpe.digests(df, vocabulary)
    expected = []
    for row in df.collect():
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids
        text = tokenizer.decode(ids, skip_special_tokens=False)
        joined = " ".join(map(str, ids))
        expected.append(
            (row["doc_id"], len(ids), *(hashlib.sha256(value.encode()).hexdigest() for value in (joined, text)))
        )
    assert by_id(found, "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=str)


def test_encoders_on_random_texts(vocabulary):
    """Both encoders against the library on texts of awkward characters."""
    rng, tokenizer = np.random.default_rng(3), library(vocabulary)
    parts = [
        *"abcXYZ012.,'!?<|>_-\t\n\r\x0b\x0c \x00\x1c\x1f\x7f\x85\xa0", "'s", "'LL", "'Re", "the", "ing", "é", "É", "ß", "ÿ", "×", "ª", "µ",
        "e\u0301", "\u0301", "İ", "ı", "ſ", "K", "ﬁ", "½", "²", "٣", "日本", "한", "\u1100\u1161", "🙂", "\u200b", "\u2028", "\u3000", "Σ", "ς",
        "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "\ufeff", "\u0130x", "ǅ", "qzj",
    ]
    forced, whole = bpe.codec(vocabulary), wavelet.encoder(vocabulary)
    for _ in range(3000):
        text = "".join(rng.choice(parts, rng.integers(0, 30)))
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(forced.encode(text.encode()), np.int32).tolist() == expected, repr(text)
        assert np.frombuffer(whole.encode(text.encode()), np.uint32).tolist() == expected, repr(text)


def test_cuts_are_forced(vocabulary):
    codec = bpe.ForcedBoundaryBpe(vocabulary)
    pieces = ["qzjxq", "strengthsqj", "éèçàü", "aaaa", "x"]
    letters = bpe.byte_alphabet()
    for piece in ["".join(letters[b] for b in text.encode()) for text in pieces]:
        parts = codec.fragments(piece)
        assert "".join(parts) == piece
        for left, right in zip(parts, parts[1:]):
            assert not any(left[-1] + right[0] in token for token in bpe.token_texts(vocabulary).values())
    assert any(len(codec.fragments("".join(letters[b] for b in text.encode()))) > 1 for text in pieces)


def test_equal_neighbours_are_encoded_once(vocabulary):
    codec, calls = bpe.codec(vocabulary), []

    class Counted:
        def encode(self, text):
            calls.append(text)
            return codec.encode(text)

    texts = [b"", b"", b"one text", b"one text", b"one text", b"another", b"one text", b""]
    assert bpe.encoded(Counted(), texts) == [codec.encode(text) for text in texts]
    assert calls == [b"", b"one text", b"another", b"one text", b""]
    assert bpe.encoded(Counted(), []) == []


def test_encode_keeps_other_columns(clashing, vocabulary):
    encoded = bpe.encode(clashing, vocabulary)
    assert "IDS" not in encoded.columns and "SCORE" in encoded.columns and "text" not in encoded.columns
    assert bpe.decode(encoded, vocabulary).where("decoded is null").count() == 0


@pytest.mark.parametrize("table", ["docs", "empty", "clashing"])
def test_wavelet_shards(table, request, spark, tmp_path, vocabulary):
    df, tokenizer = request.getfixturevalue(table), library(vocabulary)
    wavelet.write_shards(df, vocabulary, str(tmp_path / "w"), 1, 3)
    start, expected = 0, []
    for row in sorted(df.collect(), key=lambda row: (row["doc_id"] is not None, row["doc_id"] or 0)):
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [1]
        expected.append((row["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = by_id(wavelet.read_documents(spark, str(tmp_path / "w")), "start", "n_tokens", "ids_crc32")
    assert found == sorted(expected, key=str)


def test_repeated_rows_in_shards(repeated, spark, tmp_path, vocabulary):
    wavelet.write_shards(repeated, vocabulary, str(tmp_path / "w"), 1, 3)
    rows = wavelet.read_documents(spark, str(tmp_path / "w")).orderBy("start").collect()
    assert len(rows) == repeated.count()
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize("size, top", [(1, 1), (700, 5), (5000, 60_000), (3000, 70_000)])
def test_wavelet_matrix(size, top):
    ids = np.random.default_rng(size).integers(0, top, size)
    docs, lengths = np.array([4, 9]), np.array([0, size])
    matrix = wavelet.Shard.from_bytes(wavelet.Shard.build(ids, docs, lengths).to_bytes())
    assert list(matrix.doc_ids) == [4, 9] and list(matrix.lengths) == [0, size]
    assert np.array_equal(matrix.ids(), ids)
    for at in (0, size // 2, size - 1):
        value = int(ids[at])
        assert matrix.access(at) == value
        assert matrix.count(value, at) == int((ids[:at] == value).sum())
        places = np.nonzero(ids == value)[0]
        assert [matrix.locate(value, n) for n in range(min(3, len(places)))] == places[:3].tolist()
        assert matrix.locate(value, len(places) - 1) == places[-1]
    assert matrix.count(1 << 20) == 0
    with pytest.raises(IndexError):
        matrix.locate(int(ids[0]), size)


# --- sketches


def shingles(text):
    words = WORDS.findall(text)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("table", ["docs", "empty", "clashing"])
@pytest.mark.parametrize("blocks", ["1", "4"])
def test_edited_texts(table, blocks, request, spark):
    df = request.getfixturevalue(table)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", blocks)
    try:
        found = {row["doc_id"]: row for row in sketch.compare_edited(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(df.collect(), key=lambda row: (row["doc_id"] is None, -(row["doc_id"] or 0)))
    assert len(found) == len(order)
    for row, following in zip(order, order[1:] + order[:1]):
        text, third = row["text"] or "", len(row["text"] or "") // 3
        edited = text[: len(text) - third] + (following["text"] or "")[:third]
        one = found[row["doc_id"]]
        assert one["n_chars"] == len(text)
        assert one["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for column, other in (("near_edited", edited), ("near_next", following["text"] or "")):
            a, b = shingles(text), shingles(other)
            assert abs(one[column] - (len(a & b) / len(a | b) if a | b else 1.0)) < 0.2
    texts = {}
    for row in order:
        texts.setdefault(row["text"] or "", set()).add(found[row["doc_id"]]["fingerprint"])
    assert all(len(values) == 1 for values in texts.values())


def test_sketch_estimates_and_merging(spark):
    a = [f"w{n}" for n in range(6000)]
    b = a[2000:] + [f"v{n}" for n in range(2000)]
    whole, other = sketch.sketches([" ".join(a).encode(), " ".join(b).encode()])
    assert abs(sketch.resemblance(whole, other) - 0.5) < 0.15
    assert abs(sketch.containment(whole, other) - 2 / 3) < 0.2
    assert 0.7 < sketch.distinct_shingles(whole) / 5996 < 1.3
    parts = sketch.sketches([" ".join(a[:3004]).encode(), " ".join(a[3000:]).encode()])
    assert np.array_equal(sketch.merge(*parts), whole)
    assert np.array_equal(sketch.from_text(sketch.to_text(whole)), whole)
    rows = [(1, " ".join(a[:3004])), (1, " ".join(a[3000:])), (2, "one two"), (2, None)]
    own = sketch.sketch_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    merged = {row["doc_id"]: row["hashes"] for row in sketch.merge_sketches(own, ["doc_id"]).collect()}
    assert [value ^ -(1 << 63) for value in merged[1]] == [int(v) - (1 << 64) if v >> np.uint64(63) else int(v) for v in whole]
    assert len(merged[2]) == 1


# --- languages


LANGUAGES = {
    "en": "the and that with have this from they would there their what about which when make",
    "de": "und der die das nicht auch eine einer zwischen schön über würde straße größe können",
    "fr": "les des une être avoir était après élève française où déjà très même aussi pourquoi",
}


def corpus(spark, count=240):
    rng = np.random.default_rng(5)
    names = sorted(LANGUAGES)
    rows = []
    for n in range(count):
        words = LANGUAGES[names[n % 3]].split()
        rows.append((n, " ".join(rng.choice(words, 30)), names[n % 3], "s", 0))
    return rows


def test_network_on_held_out_documents(spark, rows, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 150)
    edge = [(1000 + n, row[1], None, row[3], row[4]) for n, row in enumerate(rows)]
    docs = spark.createDataFrame(corpus(spark) + edge, "doc_id long, text string, lang string, source string, n_chars long")
    network = langid.train(docs)
    assert network.languages == ["de", "en", "fr"]
    found = langid.identify(docs, network).collect()
    held = [row for row in found if row["doc_id"] < 1000 and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 1]
    assert len(held) > 50 and all(row["lang_pred"] == row["lang"] for row in held)
    for row in found:
        letters = any(ch.isalpha() for ch in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not letters) and 0 <= row["score"] <= 1
    assert network.label_bytes(b" schon").shape == (6, 3)
    # The sum over a task's distinct words is the mean over the bytes of the text.
    text = "und der that würde"
    mean = np.concatenate([network.label_bytes(word) for word in langid.text_words(text.encode())]).mean(0)
    assert np.allclose(langid._Sums(network).pooled([text.encode()])[0], mean, atol=1e-5)


def test_gradients(monkeypatch):
    """Backpropagation through time against differences."""
    network = langid.Network(["a", "b"], hidden=3)
    words, targets = [b"abc", b"b", b"cab"], np.array([0, 1, 1])
    order = [0, 2, 1]
    codes, lengths = network.padded([words[k] for k in order])

    def loss():
        p = network.probabilities(network.states(codes, lengths)).astype(float)
        return -sum(np.log(p[at, row, targets[k]]) for row, k in enumerate(order) for at in range(lengths[row])) / lengths.sum()

    captured = {}
    original = langid.Layer.back

    def spy(self, d, kept, slope):
        captured.setdefault(id(self), slope)
        return original(self, d, kept, slope)

    monkeypatch.setattr(langid.Layer, "back", spy)
    class Chosen:
        def integers(self, *a, **k):
            return np.array([0, 1, 2])

    monkeypatch.setattr(langid.np.random, "default_rng", lambda seed=None: Chosen())
    saved = [w.copy() for w in (network.ahead.p["u"], network.behind.p["u"], network.ahead.p["x"], network.out, network.bias, network.behind.p["x"])]
    network.train(words, targets, steps=1)
    for w, old in zip((network.ahead.p["u"], network.behind.p["u"], network.ahead.p["x"], network.out, network.bias, network.behind.p["x"]), saved):
        w[...] = old
    for layer, name, place in ((network.ahead, "u", (1, 4)), (network.behind, "u", (0, 7)), (network.ahead, "x", (98, 2))):
        w = layer.p[name]
        old = w[place]
        w[place] = old + 1e-2
        up = loss()
        w[place] = old - 1e-2
        down = loss()
        w[place] = old
        assert abs((up - down) / 2e-2 - captured[id(layer)][name][place]) < 2e-3


@pytest.mark.parametrize("table", ["empty", "clashing", "docs"])
def test_identify_without_network_and_edges(table, request):
    df = request.getfixturevalue(table)
    found = langid.identify(df, None)
    assert found.count() == df.count()
    assert found.where((F.col("lang_pred") != "und") | (F.col("score") != 0)).count() == 0
    assert langid.report(df.where("doc_id < 0")).count() == 0


def test_frequent_words_stay_known(monkeypatch):
    """Of more words than a worker keeps, those that came twice stay; answers do not change."""
    asked = []

    class Counted(langid.Network):
        def word_sums(self, words):
            asked.extend(words)
            return super().word_sums(words)

    network = Counted(["aa", "bb"])
    texts = [f"often twice once{n} often".encode() for n in range(30)] + [b"", b"often"]
    whole = langid._Sums(network).pooled(texts)
    asked.clear()
    monkeypatch.setattr(langid, "MEMO", 6)
    sums = langid._Sums(network)
    assert np.allclose(np.concatenate([sums.pooled([text]) for text in texts]), whole, atol=1e-6)
    assert Counter(asked)[b" often"] == Counter(asked)[b" twice"] == 1 and len(asked) == 32
    assert len(sums.place) <= 8 and list(sums.place.values()) == list(range(len(sums.place)))


def test_every_label_is_an_output(spark, monkeypatch):
    """More labelled languages than one network of few outputs would have: none is left out."""
    monkeypatch.setattr(langid, "STEPS", 30)
    rows = [(n, f"alpha{n % 70} beta{n % 70} gamma{n % 70} " * 20, f"l{n % 70:02}", "a", 1) for n in range(420)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    network = langid.train(spark.createDataFrame(rows, schema))
    assert network.languages == [f"l{n:02}" for n in range(70)]
    assert network.word_sums([b" alpha1", b" beta69"]).shape == (2, 70)


# --- letters, segments and decoding in parts


def test_letters_and_numerals():
    for text in ("½ ² ①", "Ⅷ ३ 12", "", "... !", "\u2153 " * 40):
        assert not langid.has_letter(text), text
    for text in ("½ é", "日", "① " * 50 + "x", "ª"):
        assert langid.has_letter(text), text


def test_numerals_are_no_language(spark):
    rows = [(n, text, lang) for n, (text, lang) in enumerate([("the house and the tree", "en"), ("das haus und der baum", "de")] * 6)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = langid.Network(["de", "en"])
    docs = spark.createDataFrame([(1, "½ ² ①"), (2, "Ⅷ"), (3, "the ½")], "doc_id long, text string")
    found = {row["doc_id"]: (row["lang_pred"], row["score"]) for row in langid.identify(docs, network).collect()}
    assert found[1] == found[2] == ("und", 0.0) and found[3][0] in ("de", "en")
    assert train.count() == 12


def test_segments_are_whole_characters():
    for word in (" 日本語の長い単語" * 9, "x" * 100, " é" * 40, "🙂" * 30, "", "a"):
        parts = langid.segments(word.encode())
        assert b"".join(parts) == word.encode() and all(len(part) <= langid.SEGMENT for part in parts)
        assert "".join(part.decode() for part in parts) == word


def test_segments_of_broken_bytes():
    assert b"".join(langid.segments(b"\x80" * 100)) == b"\x80" * 100


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_slices_of_ids(limit):
    lists = [[1, 2], None, [], [3] * 5, [4], [5, 6, 7]]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], ["ids"])
    parts = [part.column("ids").to_pylist() for part in bpe.id_slices(iter([batch]), "ids", limit)]
    assert [value for part in parts for value in part] == lists
    assert all(sum(len(v or []) for v in part) <= max(limit, 5) for part in parts)


def test_a_file_with_a_decoder_is_refused(tmp_path):
    from tokenizers import Tokenizer, decoders, models

    tokenizer = Tokenizer(models.BPE({"a": 0, "b": 1}, []))
    tokenizer.decoder = decoders.BPEDecoder()
    tokenizer.save(str(tmp_path / "file.json"))
    with pytest.raises(ValueError, match="decoder"):
        bpe.token_texts(str(tmp_path / "file.json"))
