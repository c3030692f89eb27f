"""Token-ID output as static range asymmetric numeral system (rANS) frames.

A *frame* is one binary value: a frequency table shared by its blocks, the index
of the documents it holds, and blocks of ``BLOCK`` ids.  A block interleaves
``LANES`` independent 64-bit coder states that emit 32-bit words; every
``EVERY`` steps the states and the word position are kept as a checkpoint, so a
reader can start at any checkpoint, and blocks decode independently.  Each
block has a crc32 of its ids and each frame one of its bytes.

Frame layout (little endian): magic, version, scale bits, lanes, checkpoint
distance, symbols, documents, ids, blocks; zlib of the table; zlib of the index;
then for each block its header, states, positions and words; last the crc32.

Cases: null text is empty (one end id); repeated doc_ids are ordered by text
hash and keep a row each; no rows give no frames; a document longer than a frame
goes on in the next one.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, shared_dir, slices, texts
from .tokens import END_ID, encoder

MAGIC, VERSION = b"WRNS", 1
SCALE, LANES, EVERY = 20, 1024, 64
BLOCK, FRAME = 1 << 18, 1 << 20
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sBBHHIIQI")
_BLOCK = struct.Struct("<IIII")


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of 2**SCALE, at least 1 each."""
    free = (1 << SCALE) - len(counts)
    out = 1 + counts.astype(np.int64) * free // max(1, int(counts.sum()))
    if len(out):
        out[np.argmax(out)] += (1 << SCALE) - out.sum()
    return out


def encode_block(symbols: np.ndarray, freq: np.ndarray, start: np.ndarray) -> bytes:
    """symbols: indices into the table; the last step is filled up with symbol 0."""
    steps = -(-len(symbols) // LANES)
    grid = np.zeros(steps * LANES, np.int32)
    grid[: len(symbols)] = symbols
    grid = grid.reshape(steps, LANES)
    x = np.full(LANES, _LOW, np.uint64)
    chunks, states = [], []
    for t in range(steps - 1, -1, -1):
        f, c = freq[grid[t]], start[grid[t]]
        full = x >= f << np.uint64(63 - SCALE)
        chunks.append(x[full].astype("<u4"))
        x = np.where(full, x >> np.uint64(32), x)
        q = x // f
        x = (q << np.uint64(SCALE)) + (x - q * f) + c
        if t % EVERY == 0:
            states.append(x)
    chunks.reverse()
    at = np.concatenate(([0], np.cumsum([len(c) for c in chunks])))[:-1:EVERY] if steps else np.zeros(0)
    words = np.concatenate(chunks) if chunks else np.zeros(0, "<u4")
    return b"".join([_BLOCK.pack(len(symbols), len(words), len(states), 0), *(s.astype("<u8").tobytes() for s in reversed(states)), at.astype("<u4").tobytes(), words.tobytes()])


def decode_block(block: bytes, table: tuple, first: int = 0, last: int | None = None) -> np.ndarray:
    """Symbols from checkpoint ``first`` up to before checkpoint ``last`` (None: to the end)."""
    lookup, freq, start = table
    n, n_words, n_states, _ = _BLOCK.unpack_from(block)
    at = _BLOCK.size
    states = np.frombuffer(block, "<u8", n_states * LANES, at).reshape(n_states, LANES)
    at += states.nbytes
    places = np.frombuffer(block, "<u4", n_states, at)
    words = np.frombuffer(block, "<u4", n_words, at + places.nbytes)
    steps = -(-n // LANES)
    begin, end = first * EVERY, steps if last is None else min(steps, last * EVERY)
    if begin >= end:
        return np.zeros(0, np.int64)
    out = np.empty((end - begin, LANES), lookup.dtype)
    x, p = states[first].astype(np.uint64), int(places[first])
    mask, k = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for t in range(end - begin):
        slot = x & mask
        s = lookup[slot]
        out[t] = s
        x = freq[s] * (x >> k) + slot - start[s]
        low = np.flatnonzero(x < _LOW)
        if len(low):
            x[low] = x[low] << np.uint64(32) | words[p : p + len(low)]
            p += len(low)
    return out.reshape(-1)[: min(n, end * LANES) - begin * LANES]


def decode_blocks(blocks: list, table: tuple) -> np.ndarray:
    """Symbols of whole blocks, one behind another; the states of all checkpoints step together."""
    lookup, freq, start = table
    states, at, words, counts, steps, begin = [], [], [], [], [], 0
    for block in blocks:
        n, n_words, n_states, _ = _BLOCK.unpack_from(block)
        size = _BLOCK.size + 8 * n_states * LANES
        states.append(np.frombuffer(block, "<u8", n_states * LANES, _BLOCK.size).reshape(n_states, LANES))
        at.append(np.frombuffer(block, "<u4", n_states, size) + np.int64(begin))
        words.append(np.frombuffer(block, "<u4", n_words, size + 4 * n_states))
        begin += n_words
        counts.append(n)
        whole = -(-n // LANES)
        steps.append(np.minimum(EVERY, whole - EVERY * np.arange(n_states)))
    if not blocks:
        return np.zeros(0, np.int64)
    x, p, words, steps = np.concatenate(states).astype(np.uint64), np.concatenate(at), np.concatenate([*words, np.zeros(1, "<u4")]), np.concatenate(steps)
    grid = np.empty((len(x), EVERY, LANES), lookup.dtype)
    mask, k = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for t in range(int(steps.max(initial=0))):
        live = steps > t  # only the last checkpoint of a block is shorter
        own = x[live]
        slot = own & mask
        s = lookup[slot]
        grid[live, t] = s
        own = freq[s] * (own >> k) + slot - start[s]
        low = own < _LOW
        taken = np.cumsum(low, axis=1)
        word = words[np.where(low, p[live, None] + taken - 1, 0)]
        x[live] = np.where(low, own << np.uint64(32) | word, own)
        p[live] += taken[:, -1]
    out, first = [], 0
    for n in counts:
        rows = -(-(-(-n // LANES)) // EVERY)
        out.append(grid[first : first + rows].reshape(-1)[:n])
        first += rows
    return np.concatenate(out)


def encode_frame(ids: np.ndarray, index: np.ndarray) -> bytes:
    """index: int64 rows (document ordinal, doc_id, is null, ids in this frame)."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    symbols = symbols[np.argsort(-counts[symbols], kind="stable")]
    place = np.zeros(len(counts), np.int32)
    place[symbols] = np.arange(len(symbols))
    freq = frequencies(counts[symbols])
    start = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    grid, freq64 = place[ids], freq.astype(np.uint64)
    table = zlib.compress(symbols.astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 1)
    about = zlib.compress(np.ascontiguousarray(index.T, "<i8").tobytes(), 1)
    blocks = []
    for i in range(0, len(ids), BLOCK):
        body = encode_block(grid[i : i + BLOCK], freq64, start)
        blocks.append(struct.pack("<II", len(body), zlib.crc32(ids[i : i + BLOCK].astype("<u4").tobytes())) + body)
    frame = b"".join([_HEAD.pack(MAGIC, VERSION, SCALE, LANES, EVERY, len(symbols), len(index), len(ids), len(blocks)), struct.pack("<II", len(table), len(about)), table, about, *blocks])
    return frame + struct.pack("<I", zlib.crc32(frame))


class Frame:
    """A read frame: ``index``, and blocks to decode as a whole or from a checkpoint."""

    def __init__(self, data: bytes):
        view = memoryview(data)
        if zlib.crc32(view[:-4]) != struct.unpack_from("<I", view, len(view) - 4)[0]:
            raise ValueError("frame checksum differs")
        magic, version, scale, lanes, every, n_symbols, n_docs, self.n_ids, n_blocks = _HEAD.unpack_from(view)
        if (magic, version, scale, lanes, every) != (MAGIC, VERSION, SCALE, LANES, EVERY):
            raise ValueError("not a frame of this version")
        at = _HEAD.size
        n_table, n_about = struct.unpack_from("<II", view, at)
        at += 8
        table = np.frombuffer(zlib.decompress(view[at : at + n_table]), "<u4").reshape(2, n_symbols)
        self.symbols, freq = table[0], table[1].astype(np.int64)
        at += n_table
        self.index = np.frombuffer(zlib.decompress(view[at : at + n_about]), "<i8").reshape(4, n_docs).T
        at += n_about
        self.table = (
            np.repeat(np.arange(n_symbols, dtype=np.uint32), freq),
            freq.astype(np.uint64),
            np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64),
        )
        self.blocks = []
        for _ in range(n_blocks):
            size, crc = struct.unpack_from("<II", view, at)
            self.blocks.append((view[at + 8 : at + 8 + size], crc))
            at += 8 + size

    def ids(self) -> np.ndarray:
        """All ids: every checkpoint of every block starts at the same time."""
        out = self.symbols[decode_blocks([body for body, _ in self.blocks], self.table)]
        for i, (_, crc) in enumerate(self.blocks):
            if zlib.crc32(out[i * BLOCK : (i + 1) * BLOCK].tobytes()) != crc:
                raise ValueError("block checksum differs")
        return out

    def part(self, begin: int, end: int) -> np.ndarray:
        """The ids from begin up to before end, decoded from the checkpoint before to the one after."""
        span, out = LANES * EVERY, [np.zeros(0, "<u4")]
        for i in range(begin // BLOCK, -(-end // BLOCK)):
            a, b = max(begin - i * BLOCK, 0), min(end - i * BLOCK, BLOCK)
            ids = self.symbols[decode_block(self.blocks[i][0], self.table, a // span, -(-b // span))]
            out.append(ids[a % span : a % span + b - a])
        return np.concatenate(out)


_FRAMES = pa.schema([("part", pa.int32()), ("frame", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])


_NAMES = "part int, frame int, before long, n_ids long, data binary"


def write_ids(docs: DataFrame, tokenizer_path: str, path: str, style: str = "byte", end_id: int = END_ID) -> None:
    """Encode documents and write frames in ascending doc_id order: part, then frame; before: ids of the part's earlier frames.

    One range shuffle of the texts; a task holds one frame of ids at a time.
    """
    n = partitions(docs.sparkSession)
    keys = [F.col("doc_id"), F.xxhash64("text")]
    ordered = texts(docs).repartitionByRange(n, *keys).sortWithinPartitions(*keys)

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, code, end = TaskContext.get().partitionId(), encoder(tokenizer_path, style), np.uint32(end_id).astype("<u4").tobytes()
        held, index, size, k, ordinal, before = [], [], 0, 0, 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, index, size, k, before
            ids = np.frombuffer(b"".join(held), "<u4")
            row = [part, k, before, len(ids), encode_frame(ids, np.array(index, np.int64).reshape(-1, 4))]
            held, index, size, k, before = [], [], 0, k + 1, before + len(ids)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _FRAMES, strict=True)], schema=_FRAMES)

        for batch in slices(batches, limit=4 << 20, rows=1 << 16, keeps=True):
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, data in zip(doc_ids, code.encode(batch.column("text").to_pylist()), strict=True):
                data += end
                while data:
                    piece, data = data[: 4 * (FRAME - size)], data[4 * (FRAME - size) :]
                    held.append(piece)
                    index.append((ordinal, doc_id or 0, doc_id is None, len(piece) // 4))
                    size += len(piece) // 4
                    if size == FRAME:
                        yield flush()
                ordinal += 1
        if size:
            yield flush()

    ordered.mapInArrow(frames, _NAMES).write.option("compression", "none").parquet(path)


def crc32_combine(first: int, second: int, n_bytes: int) -> int:
    """crc32 of two joined byte strings from the crc32 of each and the length of the second."""

    def times(matrix, vector):
        out = 0
        for row in matrix:
            if not vector:
                break
            if vector & 1:
                out ^= row
            vector >>= 1
        return out

    shift = [0xEDB88320] + [1 << i for i in range(31)]  # by one zero bit
    for _ in range(3):
        shift = [times(shift, row) for row in shift]
    while n_bytes:  # shift is by 1, 2, 4, ... zero bytes
        if n_bytes & 1:
            first = times(shift, first)
        shift = [times(shift, row) for row in shift]
        n_bytes >>= 1
    return first ^ second


_PIECES = pa.schema([("part", pa.int32()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())])


def read_ids(spark, path: str, with_ids: bool = False) -> DataFrame:
    """Decode frames to one row per document and frame: part, ordinal, doc_id, start, length, crc[, ids].

    start counts the ids of all documents before; ids are little-endian 32-bit.
    The totals of the parts, one row for each task that wrote, pass through the driver.
    """
    frames = spark.read.schema(_NAMES).parquet(path)
    totals = {r.part: r.n for r in frames.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    base, total = {}, 0
    for part in sorted(totals):
        base[part] = total
        total += totals[part]
    shared = spark.sparkContext.broadcast(base)
    schema = _PIECES.append(pa.field("ids", pa.binary())) if with_ids else _PIECES

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "data"):
            for part, before, data in zip(batch["part"].to_pylist(), batch["before"].to_pylist(), batch["data"], strict=True):
                frame = Frame(data.as_py())
                flat = memoryview(frame.ids().astype("<u4").tobytes())
                ordinal, doc_id, null, length = frame.index.T
                ends = np.cumsum(length)
                parts = [flat[4 * a : 4 * b] for a, b in zip((ends - length).tolist(), ends.tolist(), strict=True)]
                columns = [np.full(len(ends), part, np.int32), ordinal, pa.array(doc_id, pa.int64(), mask=null.astype(bool)), shared.value[part] + before + ends - length, length, np.array([zlib.crc32(x) for x in parts], np.int64)]
                if with_ids:
                    columns.append([bytes(x) for x in parts])
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    extra = ", ids binary" if with_ids else ""
    return frames.mapInArrow(pieces, "part int, ordinal long, doc_id long, start long, length long, crc long" + extra)


def document_digests(pieces: DataFrame) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32; pieces of a document in several frames are joined."""

    @F.pandas_udf("long")
    def joined(parts):
        import pandas as pd

        def one(rows):
            out = rows[0]["crc"]
            for r in rows[1:]:
                out = crc32_combine(out, r["crc"], 4 * r["length"])
            return out

        return pd.Series([one(sorted(p, key=lambda r: r["start"])) for p in parts])

    grouped = pieces.groupBy("part", "ordinal").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.sum("length").alias("n_tokens"), F.collect_list(F.struct("start", "length", "crc")).alias("parts")
    )
    return grouped.select("doc_id", "start", "n_tokens", joined("parts").alias("ids_crc32"))


def token_file(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> DataFrame:
    """Write documents as frames (to ``path`` or the shared folder), read them back, digest each document."""
    spark = docs.sparkSession
    path = path or shared_dir(spark)
    write_ids(docs, tokenizer_path, path)
    return document_digests(read_ids(spark, path))
