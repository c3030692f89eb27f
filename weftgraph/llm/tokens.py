"""Exact, cached encoding with the public tokenizers.

A text is cut at single blanks and line ends and each distinct chunk is encoded
once by the tokenizers library.  Both supported vocabularies split there
anyway: the word vocabulary drops white space, and the byte vocabulary starts a
pre-token at a blank between two non-blanks.  Where that does not hold (runs of
white space), the whole text goes through the library.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np

from .common import kept

END_ID = 2
#: Entries of the cache that stays, and of the one that is emptied when full.
KEPT, PASSING = 400_000, 60_000


class ChunkEncoder:
    """Encode texts to little-endian unsigned 32-bit ids; ``style`` is "byte" or "word"."""

    def __init__(self, path: str, style: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenize = self.tokenizer.model.tokenize
        self.style = style
        # False: the chunk touches more white space, so its text is encoded whole
        self.kept: dict = {} if style == "byte" else {"": b""}
        self.passing: dict = {}
        self.kept_most, self.passing_most = KEPT, PASSING
        self.marks: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.passing) > self.passing_most:
            self.passing.clear()
        cut = list(map(self._cut, texts))
        found, unknown = [], set()
        for chunks in cut:
            got = list(map(self.kept.get, chunks))
            holes = []
            if None in got:
                i = -1
                for _ in range(got.count(None)):
                    i = got.index(None, i + 1)
                    holes.append(i)
                unknown.update(map(chunks.__getitem__, holes))
            found.append((got, holes))
        unknown.difference_update(self.passing)
        new = self._learn(list(unknown))
        self.passing.update(new)
        out = []
        for text, chunks, (got, holes) in zip(texts, cut, found, strict=True):
            for i in holes:
                got[i] = self.passing[chunks[i]]
            try:
                out.append(self._join(got))
            except TypeError:
                out.append(self.whole(text))
        if len(self.kept) < self.kept_most:
            self.kept.update(new)
            self.passing.clear()
        return out

    def _join(self, got: list):
        return b"".join(got)

    def _cut(self, text: str) -> list:
        if self.style == "word":
            return text.replace("\n", " ").split(" ")
        chunks = text.replace("\n", " \n").split(" ")
        chunks[0] = (chunks[0],)  # no blank before it
        return chunks

    def _source(self, chunk) -> str:
        """What the library encodes for a chunk, with the white space before it."""
        if self.style == "word":
            return " " + chunk
        return chunk[0] if isinstance(chunk, tuple) else chunk if chunk[:1] == "\n" else " " + chunk

    def _learn(self, chunks: list) -> dict:
        new: dict = {}
        rest = []
        byte, plain = self.style == "byte", _PLAIN.fullmatch
        for c in chunks:
            if byte and c.__class__ is str and (m := plain(c)) and m[1].isascii():
                # a word of letters behind a blank
                new[c] = self._plain(" ", m[1], m[2], new)
                continue
            source = self._source(c)
            core = source[not isinstance(c, tuple) :]
            if byte and ((not core and not isinstance(c, tuple)) or core[:1].isspace() or core[-1:].isspace()):
                new[c] = False
            elif (m := _PLAIN.fullmatch(core)) and m[1].lower().isalpha():
                new[c] = self._plain(source[: len(source) - len(core)], m[1], m[2], new)
            else:
                rest.append(c)
        for c, e in zip(rest, self.tokenizer.encode_batch([self._source(c) for c in rest], add_special_tokens=False), strict=True):
            new[c] = np.array(e.ids, "<u4").tobytes()
        return new

    def _plain(self, lead: str, word: str, marks: str, new: dict) -> bytes:
        """A word of letters and the marks behind it are pre-tokens of their own: the model alone can encode them."""
        out = b""
        if self.style == "word":
            word = word.lower()
        elif lead == "\n":
            out = self._model("\n")
        else:
            word = lead + word
        for known in (self.kept, self.passing, new) if marks and word[:1] == " " else ():
            if got := known.get(word[1:]):
                out += got
                break
        else:
            out += self._model(word)
        if marks:
            if marks not in self.marks:
                if len(self.marks) > 10_000:
                    self.marks.clear()
                self.marks[marks] = self._model(marks)
            out += self.marks[marks]
        return out

    def _model(self, piece: str) -> bytes:
        return array("I", self._ids(piece)).tobytes()

    def _ids(self, piece: str) -> list[int]:
        mapped = piece.replace(" ", _BLANK) if piece.isascii() and "\n" not in piece else piece.encode().decode("latin-1").translate(_BYTES)
        return [t.id for t in self.tokenize(mapped)]


def _byte_characters() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself, or the next free character from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


_BYTES = _byte_characters()
_BLANK = _BYTES[32]
#: Letters up to U+024F, then ASCII marks other than the apostrophe.
_PLAIN = re.compile("([A-Za-z\u00c0-\u024f]+)([!-&(-/:-@\\[-`{-~]*)")

def encoder(path: str, style: str) -> ChunkEncoder:
    """The encoder of a vocabulary; its words serve later tasks of the same operator too."""
    return kept((path, style), lambda: ChunkEncoder(path, style))
