"""Token ids of whole texts by a public tokenizer file, with bounded caches of words.

White space never is part of a token of these tokenizers and its words are encoded apart from each
other, so the ids of a text are the ids of its white-space chunks one after another. Chunks of
printable Latin-1 characters are cut into the tokenizer's own pre-tokens and encoded by its model;
any other chunk goes through the whole tokenizer.
"""

from __future__ import annotations

import re

import numpy as np

_LETTERS, _NUMBERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc\xbd\xbe"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_NUMBERS}]|[^{_LETTERS}{_NUMBERS}]+")
_PLAIN = re.compile("[\x21-\x7e\xa1-\xac\xae-\xff]+")
_CHUNK = re.compile("[^ \t\n\r]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level tokenizers write each byte as a printable character; this is that table's rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in table):
        table[b] = chr(256 + k)
    return table


class WordTokenizer:
    """ids(text) equal to Tokenizer.encode(text, add_special_tokens=False).ids."""

    def __init__(self, path: str, most_pieces: int = 600_000, most_chunks: int = 250_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.letters = str.maketrans({chr(b): c for b, c in _byte_letters().items()})
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.most_pieces, self.most_chunks = most_pieces, most_chunks
        kinds = [p["type"] for p in __import__("json").loads(self.whole.to_str())["pre_tokenizer"].get("pretokenizers", [])]
        self.cuttable = kinds == ["Split", "ByteLevel"]

    def _piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        out = np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()
        self.pieces[piece] = out
        return out

    def _chunk(self, chunk: str) -> bytes:
        if "<|" in chunk or not self.cuttable or not _PLAIN.fullmatch(chunk):
            return np.array(self.whole.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
        get = self.pieces.get
        return b"".join([get(p) or self._piece(p) for p in _PIECES.findall(chunk.lower())])

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if not text:
            return b""
        if len(self.pieces) > self.most_pieces:
            self.pieces.clear()
        if len(self.chunks) > self.most_chunks:
            self.chunks.clear()
        chunks = self.chunks
        # str.split() also cuts at these four, which are no white space to the tokenizer
        words = _CHUNK.findall(text) if any(c in text for c in "\x1c\x1d\x1e\x1f") else text.split()
        out = list(map(chunks.get, words))
        if None in out:
            for i, found in enumerate(out):
                if found is None:
                    word = words[i]
                    found = chunks.get(word)
                    if found is None:
                        found = chunks[word] = self._chunk(word)
                    out[i] = found
        return b"".join(out)


_KEPT: dict[str, WordTokenizer] = {}


def tokenizer(name_or_path: str) -> WordTokenizer:
    """The tokenizer of a file name among the public vocabularies, or of a path; kept by the worker."""
    if name_or_path not in _KEPT:
        path = name_or_path
        if "/" not in path:
            import public_tokenizers

            path = public_tokenizers.path(path)
        _KEPT[name_or_path] = WordTokenizer(str(path))
    return _KEPT[name_or_path]
