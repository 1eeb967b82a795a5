"""Pre-tokens of a tokenizer file, chunk by chunk, as its own normalizer and pre-tokenizer make them."""

from __future__ import annotations

import re

from tokenizers import Tokenizer

#: Plain chunks: ASCII and the Latin-1 letters. Their normal form is their lower case.
_PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
# The split pattern of the file, written for plain chunks.
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-zß-öø-ÿ0-9]+")
_ENDS = {bytes([mark]) for mark in b".,;:!?#$%&*|"}
_SPLIT_OF_FILE = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Pieces:
    """Splits a chunk (a run without ASCII white space) into pre-tokens and special tokens.

    White space ends a pre-token in this kind of file, so chunks can be taken one by one. Special
    tokens are cut out of the raw text first. Plain chunks are normalized here, all others by the
    library itself; so are all where the file has another normalizer or split pattern.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder()
        self.special = {token.content: key for key, token in added.items()}
        found = "|".join(sorted(map(re.escape, self.special), key=len, reverse=True))
        self._special = re.compile(f"({found})") if found else None
        state = self.library.to_str()
        self._fast = _SPLIT_OF_FILE in state.replace("\\\\", "\\") and '"Lowercase"' in state and '"NFC"' in state
        letters = byte_alphabet()
        self._shown = {chr(b): letters[b] for b in range(256)}

    def parts(self, chunk: bytes) -> list[str | int]:
        """Byte-level pre-tokens as text, special tokens as their ids."""
        if self._fast:
            low = chunk.lower()
            if low.isalpha():  # bytes: ASCII letters alone
                return [low.decode()]
            if low[:-1].isalpha() and low[-1:] in _ENDS:
                return [low[:-1].decode(), low[-1:].decode()]
        text = chunk.decode()
        if self._special is None or not self._special.search(text):
            return self.plain(text)
        out: list[str | int] = []
        for part in self._special.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self.plain(part)
        return out

    def plain(self, text: str) -> list[str]:
        if self._fast and _PLAIN.fullmatch(text):
            found = _SPLIT.findall(text.lower())
            return found if text.isascii() else [self._bytes(piece) for piece in found]
        normal = self.library.normalizer.normalize_str(text)
        return [piece for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _bytes(self, piece: str) -> str:
        return piece.encode().decode("latin-1").translate(_table(self._shown))


_TABLE: dict[int, str] = {}


def _table(shown: dict[str, str]) -> dict[int, str]:
    if not _TABLE:
        _TABLE.update({ord(a): b for a, b in shown.items()})
    return _TABLE
