"""BPE with a lexicon: a minimal acyclic transducer of frequent words with their ids.

The most frequent words of the corpus (counted over all texts) are compiled to a
minimal acyclic automaton with shared suffixes.  Each edge carries how many
words sort before it, so a word's path sums to its rank, which points to its
ids.  The automaton is a flat file that each executor process maps into memory.
Words outside it are merged by the vocabulary's own rules, so every text gets
exactly the ids of the vocabulary, whole words or not.

Cases: null or empty text has no ids and decodes to an empty text; odd white
space and marks go through the library; very long texts are encoded whole; repeated rows are
encoded each; a null doc_id stays null; words of like frequency are in the lexicon together or
not; extra columns are left alone, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import mmap
import os
import re
import struct
import tempfile
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, slices, stored, texts
from .tokens import ChunkEncoder

WORDS = 50_000
_HEAD = struct.Struct("<4sIIII")
_LETTERS = re.compile("[a-zß-öø-ÿ]+")


def compile_lexicon(entries: Iterable[tuple[str, list[int]]]) -> bytes:
    """Words with their ids to the bytes of the automaton (incremental construction over sorted words)."""
    ordered = sorted((w.encode(), ids) for w, ids in dict(entries).items())
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []  # (final, edges)
    path: list[list] = [[False, []]]  # of the last word: final, edges

    def frozen(node: list) -> int:
        key = (node[0], tuple(node[1]))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    def shorten(depth: int, word: bytes) -> None:
        while len(path) - 1 > depth:
            node = path.pop()
            path[-1][1].append((word[len(path) - 1], frozen(node)))

    last = b""
    for word, _ in ordered:
        shared = len(os.path.commonprefix([last, word]))
        shorten(shared, last)
        path += [[False, []] for _ in word[shared:]]
        path[-1][0] = True
        last = word
    shorten(0, last)
    root = frozen(path[0])
    reach = np.zeros(len(states), np.int64)  # words below; targets come before their sources
    for i, (final, edges) in enumerate(states):
        reach[i] = final + sum(reach[t] for _, t in edges)
    begin, labels, targets, skips = array("I", [0]), bytearray(), array("I"), array("I")
    for final, edges in states:
        before = int(final)
        for label, target in edges:
            labels.append(label)
            targets.append(target)
            skips.append(before)
            before += int(reach[target])
        begin.append(len(labels))
    offsets, ids = array("I", [0]), array("I")
    for _, own in ordered:
        ids.extend(own)
        offsets.append(len(ids))
    finals = bytes(final for final, _ in states)
    head = _HEAD.pack(b"WLEX", len(states), len(labels), len(ordered), root)
    pad = b"\0" * (-(len(finals) + len(labels)) % 4)
    return b"".join([head, struct.pack("<I", len(ids)), begin.tobytes(), targets.tobytes(), skips.tobytes(), offsets.tobytes(), ids.tobytes(), finals, bytes(labels), pad])


class Lexicon:
    """A compiled lexicon in memory or in a mapped file; ``get`` gives the ids of a word or None."""

    def __init__(self, data):
        magic, n_states, n_edges, self.n_words, self.root = _HEAD.unpack_from(data)
        if magic != b"WLEX":
            raise ValueError("not a lexicon")
        (n_ids,) = struct.unpack_from("<I", data, _HEAD.size)
        at = _HEAD.size + 4
        view = memoryview(data)

        def numbers(n: int) -> memoryview:
            nonlocal at
            at += 4 * n
            return view[at - 4 * n : at].cast("I")

        self.begin, self.target, self.skip = numbers(n_states + 1), numbers(n_edges), numbers(n_edges)
        self.offset, self.ids = numbers(self.n_words + 1), numbers(n_ids)
        self.final = view[at : at + n_states]
        self.data, self.labels = data, at + n_states

    @classmethod
    def mapped(cls, data: bytes) -> Lexicon:
        """The lexicon as a file of this machine, mapped; the name goes at once, the pages with the process."""
        handle, name = tempfile.mkstemp(suffix=".wlex")
        with os.fdopen(handle, "r+b") as file:
            file.write(data)
            file.flush()
            os.unlink(name)
            shared = mmap.mmap(file.fileno(), 0, prot=mmap.PROT_READ)
        return cls(shared)

    def get(self, word: bytes) -> list[int] | None:
        state, rank, find, base = self.root, 0, self.data.find, self.labels
        begin, target, skip = self.begin, self.target, self.skip
        for i in range(len(word)):
            low, high = begin[state], begin[state + 1]
            edge = find(word[i : i + 1], base + low, base + high)
            if edge < 0:
                return None
            edge -= base
            rank += skip[edge]
            state = target[edge]
        if not self.final[state]:
            return None
        return self.ids[self.offset[rank] : self.offset[rank + 1]].tolist()


class Codec(ChunkEncoder):
    """Encodes and decodes texts with the word vocabulary: per text (ids, decoded), as text."""

    def __init__(self, path: str, lexicon: Lexicon):
        super().__init__(path, "word")
        self.lexicon = lexicon
        self.kept_most, self.passing_most = 300_000, 60_000
        self.none = (0, "", "")
        self.kept = {"": self.none}

    def _learn(self, chunks: list[str]) -> dict:
        new = {}
        rest = []
        for c in chunks:
            low = c.lower()
            m = _LETTERS.match(low)
            word = m[0] if m else ""
            if word and (len(word) == len(low) or (len(low) == len(word) + 1 and low[-1] in ".,;:!?")):
                ids = self.lexicon.get(word.encode())
                if ids is None:
                    ids = self._ids(word)
                if len(low) > len(word):
                    mark = low[-1]
                    if mark not in self.marks:
                        self.marks[mark] = self._ids(mark)
                    ids = ids + self.marks[mark]
                new[c] = self._value(ids)
            else:
                rest.append(c)
        for c, e in zip(rest, self.tokenizer.encode_batch([" " + c for c in rest], add_special_tokens=False), strict=True):
            new[c] = self._value(e.ids)
        return new

    def _value(self, ids: list[int]) -> tuple[int, str, str]:
        return len(ids), " ".join(map(str, ids)), " ".join(map(self.tokenizer.id_to_token, ids))

    def _join(self, got: list[tuple]) -> tuple[int, str, str]:
        if self.none in got:
            got = [v for v in got if v[0]]
            if not got:
                return self.none
        n, ids, decoded = zip(*got, strict=True)
        return sum(n), " ".join(ids), " ".join(decoded)


def frequent_words(docs: DataFrame, most: int = WORDS) -> list[str]:
    """The most frequent lower-case words of all texts, at most ``most``; words of like frequency are in together or out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in slices(batches):
            for text in batch["text"].to_pylist():
                counts.update(_LETTERS.findall(text.lower()))
            if len(counts) > 400_000:
                yield out()
                counts = Counter()
        if counts:
            yield out()

    counted = stored(texts(docs).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where("n > 1"))
    # counts on a scale of eighths of powers of two: a few hundred rows tell how far down the words fit
    step = F.floor(F.log2("n") * 8)
    room, least = most, None
    for level, words in counted.groupBy(step.alias("level")).count().orderBy(F.desc("level")).collect():
        room -= words
        if room < 0:
            break
        least = level
    if least is None:
        return []
    return sorted(r.word for r in counted.where(step >= least).select("word").collect())


def lexicon_of(docs: DataFrame, tokenizer_path: str, most: int = WORDS) -> bytes:
    """The compiled lexicon of a corpus: at most ``most`` words, so at most a few MB."""
    plain = ChunkEncoder(tokenizer_path, "word")
    return compile_lexicon((w, np.frombuffer(plain.whole(w), "<u4").tolist()) for w in frequent_words(docs, most))


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])
def codec(path: str, data: bytes) -> Codec:
    """The codec of a lexicon, kept by a Python worker for later tasks of the same run."""
    return kept((path, hashlib.sha256(data).hexdigest()), lambda: Codec(path, Lexicon.mapped(data)))


def encode(docs: DataFrame, tokenizer_path: str, most: int = WORDS, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (decimal, one blank apart), decoded of each text; ``digests``: sha256 of both instead."""
    data = docs.sparkSession.sparkContext.broadcast(lexicon_of(docs, tokenizer_path, most))
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else _ARROW.names

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(tokenizer_path, data.value)
        for batch in slices(batches, limit=2 << 20, keeps=True):
            n, ids, decoded = zip(*code.encode(batch["text"].to_pylist()), strict=True)
            if digests:
                ids, decoded = ([hashlib.sha256(x.encode()).hexdigest() for x in v] for v in (ids, decoded))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())], names=names)

    return texts(docs).mapInArrow(work, f"doc_id long, n_tokens long, {names[2]} string, {names[3]} string")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, decoded of rows with ``ids`` (decimal, one blank apart), as the vocabulary decodes them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ChunkEncoder(tokenizer_path, "word").tokenizer
        for batch in slices(batches, "ids"):
            out = [tokenizer.decode(list(map(int, x.split())), skip_special_tokens=False) for x in batch["ids"].fill_null("").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, decoded string")
