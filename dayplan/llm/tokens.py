"""Token ids of texts, by a public tokenizer of the ``tokenizers`` library.

A byte-level BPE works on pre-tokens (a word with the space before it, a number, a run of signs or
white space) and never joins across them, so the ids of a text are the ids of its pre-tokens. Each
task keeps the ids of pre-tokens, and of what lies between two spaces, that it has met, up to a
bound, and hands only new ones to the tokenizer's model.

A vocabulary may add tokens of its own, like an end-of-text mark: where a text spells one out, the
library gives its id, and so does ``Encoder``, unless it is told to encode the mark as any other text.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

import numpy as np
import regex

from dayplan.llm.shared import keeps

TOKENIZER = "byte_bpe_50k.json"
CACHE_PIECES = 800_000  # about 150 MB, twice
# The byte-level pre-token pattern (fixed value of the tokenizer).
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# The same for texts whose characters are below U+0250 and, there, no numbers beside 0-9 and no \x1C-\x1F.
_PLAIN_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_NOT_PLAIN = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]")

_CUT = re.compile(r" (?=\S)")
_SPACED = re.compile(r" (?:\s|$)")


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(rest)}


_WRITTEN = _byte_letters()


def pre_tokens(text: str) -> list[str]:
    return (_PIECE if _NOT_PLAIN.search(text) else _PLAIN_PIECE).findall(text)


class _Bytes(dict):
    """Ids of pre-tokens as bytes, made when first asked for."""

    def __init__(self, model, dtype: np.dtype):
        super().__init__()
        self.tokenize = model.tokenize
        self.order, self.letter = ">" if dtype.byteorder == ">" else "<", "BHIQ"[dtype.itemsize.bit_length() - 1]
        self.one = struct.Struct(self.order + self.letter)

    def __missing__(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():  # of these only the space is written in another way
            written = piece.replace(" ", _WRITTEN[32])
        else:
            written = piece.encode().decode("latin-1").translate(_WRITTEN)
        tokens = self.tokenize(written)
        if len(tokens) == 1:
            found = self[piece] = self.one.pack(tokens[0].id)
        else:
            found = self[piece] = struct.pack(f"{self.order}{len(tokens)}{self.letter}", *[token.id for token in tokens])
        return found


class _Chunks(dict):
    """Ids of a space and what follows up to the next space."""

    def __init__(self, pieces: _Bytes):
        super().__init__()
        self.get_piece = pieces.__getitem__

    def __missing__(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha():  # a word of letters alone is one pre-token
            found = self[chunk] = self.get_piece(" " + chunk)
        else:
            found = self[chunk] = b"".join(map(self.get_piece, pre_tokens(" " + chunk)))
        return found


def added_tokens(path: str) -> dict[str, int]:
    """Tokens beside the model, with their ids; an error if the file is not a plain byte-level vocabulary."""
    with open(path, encoding="utf-8") as source:
        parts = json.load(source)
    before = parts.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
    added = parts.get("added_tokens") or []
    if not plain or parts.get("normalizer") or any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
        raise ValueError(f"{path} does more to a text than byte-level pre-tokens")
    return {t["content"]: t["id"] for t in added}


class Encoder:
    """``ids(texts)``: the ids of each text as bytes of ``dtype``, the same as the library's.

    With ``added`` off, added tokens in texts are spelled out like other text.
    """

    def __init__(self, path: str, dtype: str = "<u2", cache_pieces: int = CACHE_PIECES, added: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        tokens = added_tokens(path)
        self.added = {content: np.array([i], dtype).tobytes() for content, i in tokens.items()} if added else {}
        # of several that begin at one place the longest counts
        names = "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True))
        self.mark = re.compile(f"({names})") if names else None
        self.dtype, self.most = np.dtype(dtype), cache_pieces
        if self.tokenizer.get_vocab_size() > np.iinfo(self.dtype).max + 1:
            raise ValueError(f"ids do not fit in {dtype}")
        self.pieces = _Bytes(self.tokenizer.model, self.dtype)
        self.chunks = _Chunks(self.pieces)

    def _ids(self, text: str) -> bytes:
        # a space before another character is where a pre-token starts
        first, *rest = _CUT.split(text) if _SPACED.search(text) else text.split(" ")
        head = b"".join(map(self.pieces.__getitem__, pre_tokens(first)))
        return head + b"".join(map(self.chunks.__getitem__, rest))

    def ids(self, texts: list[str | None]) -> list[bytes]:
        for cache in (self.pieces, self.chunks):
            if len(cache) > self.most:
                cache.clear()
        return [self._whole(text or "") for text in texts]

    def _whole(self, text: str) -> bytes:
        if self.mark is None or not self.mark.search(text):
            return self._ids(text)
        return b"".join(self.added.get(part) or self._ids(part) for part in self.mark.split(text) if part)


@lru_cache(maxsize=1)
def encoder(name: str = TOKENIZER, dtype: str = "<u2", added: bool = True) -> Encoder:
    """The encoder of a vocabulary file; a bare name is looked up among the public ones."""
    keeps("tokens", encoder.cache_clear)
    path = name
    if not os.path.isabs(name):
        import public_tokenizers

        path = public_tokenizers.path(name)
    return Encoder(path, dtype, added=added)


def text_runs(texts: list[str | None], limit: int = 1 << 20):
    """Index ranges of ``texts`` with about ``limit`` characters each."""
    at = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= limit:
            yield at, i + 1
            at, total = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
