"""Whole-text encoding with a public BPE tokenizer, through a bounded cache of word pieces.

The word tokenizer drops white space and never merges across words, so the ids of a text are the
concatenated ids of its pieces.  Texts of plain Latin characters are cut at white space, chunks not seen
lately are cut into pieces, and only pieces not seen lately go to the library's BPE model; everything
else goes to the library whole.
"""

from __future__ import annotations

import functools
import os
import re
import struct

import numpy as np

#: Characters whose normal form, lower case and class are the same in every Unicode version.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
#: The tokenizer's own split pattern, over those characters, after lower-casing.
_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\s0-9a-zß-öø-ÿ]+")
_CHUNK = re.compile(r"[^ \n]+")


class WordEncoder:
    """Ids of a text as little-endian unsigned 32-bit integers.

    At most ``max_entries`` chunks and pieces are remembered, and only those up to 64 characters.  They
    lie in two halves: a full younger half takes the place of the older one, and what is looked up
    in the older one moves to the younger, so frequent words stay.
    """

    def __init__(self, path: str, max_entries: int = 800_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.half = max(1, max_entries // 2)
        self.pieces: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.vocab_size = self.tok.get_vocab_size()
        # the pre-tokenizer writes each byte as a character: as it does for one letter, it does for all
        split = self.tok.pre_tokenizer.pre_tokenize_str
        self.written = {k: "".join(s for s, _ in split(chr(k))) for k in range(0xC0, 0x100)}

    def _library(self, text: str) -> bytes:
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.translate(self.written)
        ids = [t.id for t in self.tok.model.tokenize(piece)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _remember(self, part: str, ids: bytes) -> None:
        if len(part) <= 64:
            if len(self.pieces) >= self.half:
                self.older, self.pieces = self.pieces, {}
            self.pieces[part] = ids

    def _part(self, part: str, make) -> bytes:
        got = self.pieces.get(part)
        if got is None:
            got = self.older.get(part)
            if got is None:
                got = make(part)
            self._remember(part, got)
        return got

    def _chunk(self, chunk: str) -> bytes:
        """Ids of a run of lower-cased characters without white space."""
        pieces = _PIECE.findall(chunk)
        if len(pieces) == 1:
            return self._piece(chunk)
        return b"".join([self._part(p, self._piece) for p in pieces])

    def _plain(self, text: str) -> bytes:
        # pieces never cross white space, so whole chunks are looked up and only new ones are cut
        chunks = text.lower().split()
        found = list(map(self.pieces.get, chunks))
        if None in found:
            for k, got in enumerate(found):
                if got is None:
                    found[k] = self._part(chunks[k], self._chunk)
        return b"".join(found)

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if "<|" not in text and _PLAIN.fullmatch(text):
            return self._plain(text)
        # special tokens hold no blank, and nothing composes across one
        return b"".join(self._plain(c) if "<|" not in c and _PLAIN.fullmatch(c) else self._library(c)
                        for c in _CHUNK.findall(text))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per Python worker and file."""
    return WordEncoder(path)


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def end_bytes(end_id: int | None) -> bytes:
    return b"" if end_id is None else np.asarray([end_id], "<u4").tobytes()
