"""Exact removal of repeated passages with a column-wise multi-string BWT.

A byte goes if a ``WIDTH``-byte string over it also starts in a document with a
smaller doc_id.  Equal strings have the equal smallest ``K``-byte hash inside
them (their minimizer), so

1. texts are gathered into groups of a few MB, each a compressed row;
2. every group sends its distinct minimizers to hash buckets and gets back which of
   them other documents have too;
3. runs of windows with a shared minimizer, short strings of ``WIDTH`` to ``LONGEST``
   bytes, go to the bucket of the minimizer, once per group and string, with
   the smallest doc_id that has it there; a minimizer with very many strings has
   its windows sent one by one instead, each to the bucket of its own hash;
4. each bucket builds the Burrows-Wheeler transform and the common-prefix array of all its
   strings that are not alone with their minimizer, column by column: every round inserts one symbol of each string, reading the
   two arrays from files front to back and writing the next ones.  Neighbours with a common
   prefix of ``WIDTH`` or more are one class, and the class's smallest doc_id goes
   back to the groups;
5. each group marks its windows and drops the bytes under marked ones.

Long documents never make long strings, and a passage in many documents
travels once per group.  Cases: null text is empty; texts under WIDTH bytes keep
all; very long texts are read whole; rows with an equal doc_id never remove from each other; a null doc_id counts
as the largest; matches stay within a document; extra columns are left alone, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, partitions, slices, stored
from .shingles import _VALUE as BYTE_VALUES
from .shingles import mix

WIDTH, K = 50, 25
#: Windows of a run at most, and so the longest string.
WINDOWS = 32
LONGEST = WIDTH + WINDOWS - 1
GROUP, BITS = 6 << 20, 40
#: Entries of a collection's files that are read at once.
STREAM = 1 << 16
#: Bytes of text for each bucket, so that a bucket does not grow with the corpus; and strings of a minimizer that one bucket takes.
BUCKET, HOT = 8 << 20, 4096
NO_ID = (1 << 63) - 1
_B = np.uint64(0x9E3779B97F4A7C15)
_PLACES = np.arange(1 << 16, dtype=np.uint32)
#: Logarithm of the size of a range in a block, rounded down.
_LOG = (np.frexp(np.arange((1 << 16) + 1))[1] - 1).astype(np.int64)
_SIZE = 1 << np.arange(17)


def squeeze(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(a).tobytes() for a in arrays))


def loosen(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_B), n, 1 << 64))


def spread(h: np.ndarray) -> np.ndarray:
    """A permutation of the ``BITS``-bit numbers: minimizers, the least of many hashes, pile up near 0."""
    half, mask = np.uint64(BITS // 2), np.uint64((1 << BITS) - 1)
    for odd in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93):
        h = h * np.uint64(odd) & mask
        h = h ^ h >> half
    return h


def window_hashes(data: np.ndarray, at: np.ndarray, step: int = 1 << 16) -> np.ndarray:
    """A ``BITS``-bit hash of each window that begins at ``at``."""
    powers = np.array([_power(WIDTH - 1 - k) for k in range(WIDTH)], np.uint64)
    parts = [(BYTE_VALUES[data[at[i : i + step, None] + np.arange(WIDTH)]] * powers).sum(1, dtype=np.uint64) for i in range(0, len(at), step)]
    return mix(np.concatenate([np.zeros(0, np.uint64), *parts])) >> np.uint64(64 - BITS)


def minimizers(data: np.ndarray, offsets: np.ndarray, step: int = 1 << 19) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one minimizer: (hash, first window, windows), in text order; offsets delimit the documents."""
    hashes, firsts, counts = [], [], []
    for at in range(0, max(0, len(data) - WIDTH + 1), step):
        part = data[at : at + step + WIDTH - 1]
        n = len(part) - WIDTH + 1
        if n < 1:
            break
        h = {1: BYTE_VALUES[part]}
        for size in (1, 2, 4, 8):  # hash of 2*size bytes from two of size bytes
            h[2 * size] = h[size][: len(h[size]) - size] * _power(size) + h[size][size:]
        m = len(part) - K + 1
        kmer = mix((h[16][:m] * _power(8) + h[8][16 : 16 + m]) * _B + h[1][24 : 24 + m]) >> np.uint64(64 - BITS)
        low = kmer
        for size in (1, 2, 4, 8):
            low = np.minimum(low[: len(low) - size], low[size:])
        low = np.minimum(low[:n], low[10 : 10 + n])  # of 26 places
        # a window that reaches into the next document is none
        ok = np.ones(n, bool)
        for end in offsets[np.searchsorted(offsets, at + 1) : np.searchsorted(offsets, at + n + WIDTH)].tolist():
            ok[max(0, end - at - WIDTH + 1) : max(0, end - at)] = False
        new = np.ones(n, bool)
        new[1:] = (low[1:] != low[:-1]) | ~ok[:-1]
        first = np.flatnonzero(new & ok)
        if not len(first):
            continue
        stop = np.flatnonzero(np.append(new[1:] | ~ok[1:], True) & ok) + 1
        size = stop - first
        pieces = -(-size // WINDOWS)
        who = np.repeat(np.arange(len(first)), pieces)
        k = np.arange(len(who)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        start = first[who] + k * WINDOWS
        hashes.append(low[start])
        firsts.append(start + at)
        counts.append(np.minimum(size[who] - k * WINDOWS, WINDOWS))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return spread(np.concatenate(hashes)), np.concatenate(firsts), np.concatenate(counts)


class Collection:
    """BWT and common prefixes of many short strings, built one column a round.

    ``symbols``: 0 where a string begins, else its byte + 1 (UTF-8 has no byte over 0xF4).
    Entry i of the prefix array is the common prefix of suffixes i-1 and i.  Between rounds both
    arrays are files: a round reads the old ones from front to back in blocks of ``STREAM`` entries, once to find
    where the new suffixes go and once to write the new ones, so it holds a block and
    some numbers for each string, never the arrays.
    """

    def __init__(self, strings: list[bytes], block: int = STREAM):
        self.n, self.block, self.least = len(strings), block, RangeLeast(block)
        self.sizes = np.array(list(map(len, strings)), np.int64)
        flat = np.frombuffer(b"".join(strings), np.uint8) + np.uint8(1)
        ends = np.cumsum(self.sizes)
        begin = ends - self.sizes
        with tempfile.TemporaryFile() as a, tempfile.TemporaryFile() as b, tempfile.TemporaryFile() as c, tempfile.TemporaryFile() as d:
            old, new = (a, b), (c, d)
            # the end marks of all strings, in their order
            first = np.where(self.sizes > 0, flat[np.maximum(ends - 1, 0)] if len(flat) else 0, 0).astype(np.uint8)
            a.write(first)
            b.write(bytes(self.n))
            self.counts = np.bincount(first, minlength=256)
            place, live, length = np.arange(self.n), np.arange(self.n), 0
            while True:
                keep = self.sizes[live] > length
                live, place = live[keep], place[keep]
                if not len(live):
                    break
                length += 1
                at = ends[live] - length - 1
                before = np.where(at >= begin[live], flat[np.maximum(at, 0)], 0).astype(np.uint8)
                to, low, fix, fixed = self._targets(old, place)
                order = np.argsort(to)
                live, place, before = live[order], to[order], before[order]
                self._merged(old, new, place, before, low[order], fix, fixed)
                self.counts += np.bincount(before, minlength=256)
                old, new = new, old
            for file in old:
                file.seek(0)
            self.symbols, self.prefix = (np.frombuffer(f.read(), np.uint8) for f in old)

    def _targets(self, files: tuple, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the suffixes at ``place`` (ascending): where those with one symbol more go and their common prefixes; where the prefix of a right neighbour changes, and to what.

        The neighbours of a new suffix extend the last and the next place with the same symbol, so
        its common prefixes are one more than the least ones up to there.
        """
        base = self.n + np.cumsum(self.counts) - self.counts - self.counts[0]
        to = np.empty(len(place), np.int64)
        low, after = np.zeros(len(place), np.uint8), np.zeros(len(place), np.uint8)
        has_after = np.zeros(len(place), bool)
        seen = np.zeros(256, np.int64)
        carry = np.full(256, 255, np.uint8)  # least prefix since the last place of each symbol
        waiting = np.full(256, -1, np.int64)  # the suffix whose next place of its symbol is still to come
        least = self.least
        for file in files:
            file.seek(0)
        start = k = 0
        while data := files[0].read(self.block):
            symbols, prefix = np.frombuffer(data, np.uint8), np.frombuffer(files[1].read(self.block), np.uint8)
            size = len(symbols)
            stop = int(np.searchsorted(place, start + size))
            p = place[k:stop] - start
            # (symbol, place) in order: each symbol's places lie together
            key = symbols.astype(np.uint32) << np.uint32(16) | _PLACES[:size]
            ordered = np.sort(key)
            edges = np.searchsorted(ordered, np.arange(257, dtype=np.uint32) << np.uint32(16))
            count = np.diff(edges)
            have = np.flatnonzero(count)
            order = (ordered & np.uint32(0xFFFF)).astype(np.int64)
            least.of(prefix)
            first, last = order[edges[have]], order[edges[have + 1] - 1]
            w = waiting[have] >= 0
            who = waiting[have[w]]
            after[who] = np.minimum(carry[have[w]], least(np.zeros(len(who), np.int64), first[w] + 1))
            has_after[who] = True
            waiting[have] = -1
            if len(p):
                own = symbols[p].astype(np.int64)
                rank = np.searchsorted(ordered, key[p])
                inner = rank - edges[own]
                to[k:stop] = base[own] + seen[own] + inner
                is_first, is_last = inner == 0, inner == count[own] - 1
                before = np.where(is_first, 0, order[np.maximum(rank - 1, 0)] + 1)
                here = least(before, p + 1)
                low[k:stop] = np.where(is_first, np.where(seen[own] > 0, np.minimum(carry[own], here) + 1, 0), here + 1)
                inside = np.flatnonzero(~is_last)
                after[k + inside] = least(p[inside] + 1, order[rank[inside] + 1] + 1)
                has_after[k + inside] = True
                ends = np.flatnonzero(is_last)
                waiting[own[ends]] = k + ends
            carry = np.minimum(carry, prefix.min())
            carry[have] = np.where(last + 1 < size, least(np.minimum(last + 1, size - 1), np.full(len(last), size)), 255)
            seen += count
            start, k = start + size, stop
        return to, low, to[has_after] + 1, after[has_after] + np.uint8(1)

    def _merged(self, old: tuple, new: tuple, to: np.ndarray, symbols: np.ndarray, low: np.ndarray, fix: np.ndarray, fixed: np.ndarray) -> None:
        """Write the arrays with the new entries at ``to`` (ascending); a changed neighbour that is new itself stays as it is."""
        by = np.argsort(fix)
        fix, fixed = fix[by], fixed[by]
        for file in (*old, *new):
            file.seek(0)
        total, at, k, j = int(self.counts.sum()) + len(to), 0, 0, 0
        while at < total:
            size = min(self.block, total - at)
            k1, j1 = np.searchsorted(to, at + size), np.searchsorted(fix, at + size)
            mine, changed = to[k:k1] - at, fix[j:j1] - at
            rest = np.ones(size, bool)
            rest[mine] = False
            for i, own in enumerate((symbols, low)):
                out = np.empty(size, np.uint8)
                out[rest] = np.frombuffer(old[i].read(size - len(mine)), np.uint8)
                out[mine] = own[k:k1]
                if i:
                    ok = rest[changed]
                    out[changed[ok]] = fixed[j:j1][ok]
                new[i].write(out)
            at, k, j = at + size, k1, j1
        for file in new:
            file.flush()

    def classes(self, width: int = WIDTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(string, offset, class) of all windows, for one suffix length after another: a walk over the last-first mapping."""
        group = np.cumsum(self.prefix < width, dtype=np.int32)
        order = np.argsort(self.symbols, kind="stable")
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32) + np.int32(self.n - int((self.symbols == 0).sum()))
        del order
        place, live = np.arange(self.n), np.arange(self.n)
        for length in range(1, int(self.sizes.max(initial=0)) + 1):
            keep = self.sizes[live] >= length
            live, place = live[keep], rank[place[keep]]
            if length >= width:
                yield live, self.sizes[live] - length, group[place]


class RangeLeast:
    """The least values of ranges [begin, end) of one block, from the least ones of all ranges of 1, 2, 4, ... entries."""

    def __init__(self, most: int):
        self.room = np.empty((max(1, most).bit_length(), max(1, most)), np.uint8)  # a row for each size of ranges
        self.most = self.room.shape[1]

    def of(self, values: np.ndarray) -> None:
        n, size = len(values), 1
        self.room[0, :n] = values
        for below, row in zip(self.room, self.room[1:], strict=False):
            if 2 * size > n:
                break
            np.minimum(below[: n - 2 * size + 1], below[size : n - size + 1], out=row[: n - 2 * size + 1])
            size *= 2

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        level = _LOG[end - begin]
        flat, at = self.room.reshape(-1), level * self.most
        return np.minimum(flat[at + begin], flat[at + end - _SIZE[level]])


def smallest_owners(strings: list[bytes], owners: np.ndarray) -> list[np.ndarray]:
    """For each window of each string the least owner of any string that has it.

    Only strings with an equal minimizer can share a window.  One collection has all (distinct) strings whose
    minimizer has another one; a string that is alone with its minimizer shares no window and is not built.
    """
    unique: dict[bytes, int] = {}
    which = np.array([unique.setdefault(s, len(unique)) for s in strings], np.int64)
    least = np.full(len(unique), NO_ID, np.int64)
    np.minimum.at(least, which, owners)
    listed = list(unique)
    sizes = np.array(list(map(len, listed)), np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes - WIDTH + 1)))
    flat = np.repeat(least, sizes - WIDTH + 1)
    ends = np.cumsum(sizes)
    h, first, _ = minimizers(np.frombuffer(b"".join(listed), np.uint8), np.append(0, ends))
    own = h[np.searchsorted(first, ends - sizes)]  # of each string's first window
    _, kind, count = np.unique(own, return_inverse=True, return_counts=True)
    chosen = np.flatnonzero(count[kind] > 1)
    built = Collection([listed[i] for i in chosen.tolist()])
    best = np.full(len(built.prefix) + 1, NO_ID, np.int64)
    for live, _, group in built.classes():
        np.minimum.at(best, group, least[chosen[live]])
    for live, offset, group in built.classes():
        flat[starts[chosen[live]] + offset] = best[group]
    return [flat[starts[w] : starts[w + 1]] for w in which.tolist()]


def gathered(docs: DataFrame, others: list[str] | None = None) -> DataFrame:
    """Rows (group, ids, sizes, nulls, data, rest): some MB of documents each, in the order they are read; rest has other columns."""
    others = others or []
    schema = pa.schema([("group", pa.int64()), *((c, pa.binary()) for c in ("ids", "sizes", "nulls", "data", "rest"))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out() -> pa.RecordBatch:
            nonlocal k, held, size
            raw = [t for b in held for t in b["text"].cast(pa.binary()).to_pylist()]
            ids = [i for b in held for i in b["__key"].to_pylist()]
            rest = pa.BufferOutputStream()
            if others:
                with pa.ipc.new_stream(rest, held[0].select(others).schema) as to:
                    for b in held:
                        to.write_batch(b.select(others))
            row = [
                part << 32 | k,
                np.array([NO_ID if i is None else i for i in ids], np.int64).tobytes(),
                np.array(list(map(len, raw)), np.int64).tobytes(),
                np.array([i is None for i in ids], np.uint8).tobytes(),
                zstandard.ZstdCompressor(level=3).compress(b"".join(raw)),
                rest.getvalue().to_pybytes(),
            ]
            k, held, size = k + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema, strict=True)], schema=schema)

        for batch in slices(batches, limit=GROUP // 2):
            held.append(batch)
            size += batch["text"].nbytes
            if size >= GROUP:
                yield out()
        if held:
            yield out()

    rows = docs.select(F.col("doc_id").cast("long").alias("__key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *others)
    return rows.mapInArrow(work, "group long, ids binary, sizes binary, nulls binary, data binary, rest binary")


class Group:
    def __init__(self, row: dict):
        self.group = row["group"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], np.uint8).astype(bool)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.offsets = np.concatenate(([0], np.cumsum(self.sizes)))
        self.raw = loosen(row["data"])
        self.data = np.frombuffer(self.raw, np.uint8)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, first window, windows, document) of each run."""
        h, first, count = minimizers(self.data, self.offsets)
        return h, first, count, np.searchsorted(self.offsets, first, "right") - 1


def bucket_runs(h: np.ndarray, n_buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, begin, end) of the buckets that sorted hashes fall in, in order."""
    high, low = h >> np.uint64(BITS // 2), h & np.uint64((1 << BITS // 2) - 1)
    n = np.uint64(n_buckets)  # h * n_buckets / 2**BITS, in two steps that do not overflow
    bucket = (high * n + (low * n >> np.uint64(BITS // 2))) >> np.uint64(BITS // 2)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(h) else np.zeros(0, np.int64)
    yield from zip(bucket[first].tolist(), first.tolist(), np.append(first, len(h))[1:].tolist(), strict=True)


def _rows(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


_ASK = pa.schema([("bucket", pa.int32()), ("group", pa.int64()), ("data", pa.binary())])


def _row_dicts(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in slices(batches, "data", rows=1):
        yield batch.to_pylist()[0]


def shared_minimizers(groups: DataFrame, n_buckets: int, n_parts: int) -> DataFrame:
    """(group, bucket, data): two bits for each distinct minimizer of the group, set if two documents have it, and if it has very many strings."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _row_dicts(batches):
            own = Group(row)
            h, start, count, doc = own.runs()
            order = np.argsort(h, kind="stable")
            h, start, count, doc = h[order], start[order], count[order], doc[order]
            first = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
            more = np.minimum.reduceat(doc, first) != np.maximum.reduceat(doc, first) if len(first) else np.zeros(0, bool)
            # strings of those that more than one document has
            n = more.astype(np.uint16)
            last = np.append(first[1:], len(h))
            for i in np.flatnonzero(more & (last - first >= 8)).tolist():
                runs = zip(start[first[i] : last[i]].tolist(), (count[first[i] : last[i]] + WIDTH - 1).tolist(), strict=True)
                n[i] = min(len({own.raw[a : a + size] for a, size in runs}), 65535)
            h = h[first]
            out = [(b, squeeze(np.diff(h[x:y], prepend=np.uint64(0)), n[x:y])) for b, x, y in bucket_runs(h, n_buckets)]
            yield _rows({"bucket": [b for b, _ in out], "group": [own.group] * len(out), "data": [d for _, d in out]}, _ASK)

    def answer(bucket):
        import pandas as pd

        asked = []
        for data in bucket["data"]:
            raw = loosen(data)
            n = len(raw) // 10
            asked.append((np.cumsum(np.frombuffer(raw, np.uint64, n)), np.frombuffer(raw, np.uint16, n, 8 * n)))
        every, which, count = np.unique(np.concatenate([h for h, _ in asked]), return_inverse=True, return_counts=True)
        strings = np.concatenate([n for _, n in asked])
        shared = (count > 1) | (np.bincount(which, strings > 0) > 0)
        hot = shared & (np.bincount(which, np.maximum(strings, 1)) > HOT)
        cut = np.cumsum([len(h) for h, _ in asked])[:-1]
        bits = [np.packbits(np.concatenate((shared[w], hot[w]))).tobytes() for w in np.split(which, cut)]
        return pd.DataFrame({"group": bucket["group"], "bucket": bucket["bucket"], "data": bits})

    asked = groups.mapInArrow(ask, "bucket int, group long, data binary")
    return asked.repartition(n_parts, "bucket").groupBy("bucket").applyInPandas(lambda g: answer(g), "group long, bucket int, data binary")


def with_answers(groups: DataFrame, answers: DataFrame, name: str, n_parts: int, how: str = "inner") -> DataFrame:
    """The groups with all their answers (bucket, data) in one array column."""
    own = answers.select("group", "bucket", "data").repartition(n_parts, "group").groupBy("group").agg(F.collect_list(F.struct("bucket", "data")).alias(name))
    return groups.repartition(n_parts, "group").join(own, "group", how)


def asked_strings(groups: DataFrame, shared: DataFrame, n_buckets: int, n_parts: int) -> DataFrame:
    """(bucket, group, data): strings with their least owner for each bucket; bucket -1: the places of the group's strings."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _row_dicts(batches):
            own = Group(row)
            h, first, count, doc = own.runs()
            unique = np.unique(h)
            on, hot = np.zeros(len(unique), bool), np.zeros(len(unique), bool)
            answers = {s["bucket"]: s["data"] for s in row["shared"]}
            for b, x, y in bucket_runs(unique, n_buckets):
                on[x:y], hot[x:y] = np.unpackbits(np.frombuffer(answers[b], np.uint8), count=2 * (y - x)).reshape(2, -1)
            place = np.searchsorted(unique, h)
            keep, many = on[place], hot[place]
            if many.any():
                single = np.repeat(first[many], count[many]) + np.concatenate([np.arange(n) for n in count[many].tolist()])
                keep = np.append(keep & ~many, np.ones(len(single), bool))
                h, first = np.append(h, window_hashes(own.data, single)), np.append(first, single)
                doc, count = np.append(doc, np.repeat(doc[many], count[many])), np.append(count, np.ones(len(single), np.int64))
            order = np.flatnonzero(keep)[np.argsort(h[keep], kind="stable")]
            h, first, count, doc = h[order], first[order], count[order], doc[order]
            strings: dict[bytes, int] = {}
            raw = own.raw
            which = np.array([strings.setdefault(raw[a : a + n], len(strings)) for a, n in zip(first.tolist(), (count + WIDTH - 1).tolist(), strict=True)], np.int64)
            least = np.full(len(strings), NO_ID, np.int64)
            np.minimum.at(least, which, own.ids[doc])
            at = np.full(len(strings), len(h), np.int64)
            np.minimum.at(at, which, np.arange(len(h)))  # strings are numbered by hash
            listed = list(strings)
            out = [(-1, squeeze(np.array([len(which), len(listed)]), np.diff(which, prepend=0).astype(np.int32), first.astype(np.uint32), count.astype(np.uint8), np.array(list(map(len, listed)), np.uint8)))]
            for b, x, y in bucket_runs(h[at], n_buckets):
                sizes = np.array(list(map(len, listed[x:y])), np.int64)
                out.append((b, squeeze(np.array([y - x]), least[x:y], sizes.astype(np.uint8), np.frombuffer(b"".join(listed[x:y]), np.uint8))))
            yield _rows({"bucket": [b for b, _ in out], "group": [own.group] * len(out), "data": [d for _, d in out]}, _ASK)

    return with_answers(groups, shared, "shared", n_parts).mapInArrow(work, "bucket int, group long, data binary")


def answered(asked: DataFrame, n_parts: int) -> DataFrame:
    """(group, bucket, data): for each window of the strings asked the least doc_id that has it; places pass through."""

    def work(bucket):
        import pandas as pd

        if bucket["bucket"].iloc[0] < 0:
            return bucket[["group", "bucket", "data"]]
        strings, owners, counts = [], [], []
        for data in bucket["data"]:
            raw = loosen(data)
            n = int(np.frombuffer(raw, np.int64, 1)[0])
            owners.append(np.frombuffer(raw, np.int64, n, 8))
            ends = np.cumsum(np.frombuffer(raw, np.uint8, n, 8 + 8 * n), dtype=np.int64)
            text = raw[8 + 9 * n :]
            strings += [text[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            counts.append(n)
        least = smallest_owners(strings, np.concatenate(owners))
        cut = np.cumsum([0, *counts]).tolist()
        out = pd.DataFrame({"group": bucket["group"], "bucket": bucket["bucket"], "data": [squeeze(*least[a:b]) for a, b in zip(cut, cut[1:], strict=False)]})
        del strings, owners, least, text, raw
        give_back()
        return out

    # rows with places are spread by their group
    key = F.when(F.col("bucket") < 0, F.col("group")).otherwise(F.lit(-1))
    asked = asked.withColumn("own", key).repartition(n_parts, "bucket", "own")
    return asked.groupBy("bucket", "own").applyInPandas(lambda g: work(g), "group long, bucket int, data binary")


def removed_runs(own: Group, answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the maximal removed runs in the group's bytes; runs do not join over the end of a document."""
    by = {a["bucket"]: a["data"] for a in answers}
    if -1 not in by:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = loosen(by.pop(-1))
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    which, first = np.cumsum(np.frombuffer(raw, np.int32, n, 16), dtype=np.int64), np.frombuffer(raw, np.uint32, n, 16 + 4 * n).astype(np.int64)
    count, sizes = np.frombuffer(raw, np.uint8, n, 16 + 8 * n).astype(np.int64), np.frombuffer(raw, np.uint8, m, 16 + 9 * n).astype(np.int64)
    least = np.concatenate([np.frombuffer(loosen(by[b]), np.int64) for b in sorted(by)]) if by else np.zeros(0, np.int64)
    starts = np.cumsum(sizes - WIDTH + 1) - (sizes - WIDTH + 1)
    k = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    window = np.repeat(first, count) + k
    doc = np.searchsorted(own.offsets, window, "right") - 1
    window = window[least[np.repeat(starts[which], count) + k] < own.ids[doc]]
    depth = np.zeros(len(own.data) + 1, np.int32)
    np.add.at(depth, window, 1)
    np.add.at(depth, window + WIDTH, -1)
    gone = np.cumsum(depth[:-1]) > 0
    edge = np.ones(len(gone) + 1, bool)
    edge[1:-1] = gone[1:] != gone[:-1]
    edge[own.offsets] = True
    at = np.flatnonzero(edge)
    begin, end = at[:-1], at[1:]
    on = gone[begin] if len(begin) else np.zeros(0, bool)
    return begin[on], end[on]


def kept_parts(own: Group, answers: list[dict]) -> Iterator[tuple[int, int, bytes]]:
    """(bytes before, removed runs, bytes that stay) of each document."""
    begin, end = removed_runs(own, answers)
    lo, hi = np.searchsorted(begin, own.offsets[:-1]).tolist(), np.searchsorted(begin, own.offsets[1:]).tolist()
    for i, (a, b) in enumerate(zip(own.offsets[:-1].tolist(), own.offsets[1:].tolist(), strict=True)):
        spans = zip(begin[lo[i] : hi[i]].tolist(), end[lo[i] : hi[i]].tolist(), strict=True)
        cuts = [a, *(x for s in spans for x in s), b]
        yield b - a, hi[i] - lo[i], b"".join(own.raw[x:y] for x, y in zip(cuts[0::2], cuts[1::2], strict=True))


def _resolved(docs: DataFrame, others: list[str] | None = None) -> DataFrame:
    """The groups with the answers to all their strings."""
    spark = docs.sparkSession
    groups = stored(gathered(docs, others), "none")
    n_groups = groups.count()
    n_buckets = max(256, partitions(spark), -(-n_groups * GROUP // BUCKET))
    # numbers of tasks follow the data too: a few groups, or a few buckets, each
    by_group, by_bucket = max(partitions(spark), -(-n_groups // 2)), max(partitions(spark), -(-n_buckets // 2))
    shared = stored(shared_minimizers(groups, n_buckets, by_bucket))
    answers = stored(answered(asked_strings(groups, shared, n_buckets, by_group), by_bucket), "none")
    return with_answers(groups, answers, "answers", by_group, "left")


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept: the bytes that stay] of every document."""
    schema = _OUT if with_text else pa.schema(list(_OUT)[:-1])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _row_dicts(batches):
            own = Group(row)
            out: dict[str, list] = {f.name: [] for f in schema}
            for i, (size, spans, kept) in enumerate(kept_parts(own, row["answers"] or [])):
                values = (None if own.nulls[i] else int(own.ids[i]), size, size - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept)
                for f, v in zip(schema, values, strict=False):
                    out[f.name].append(v)
            yield _rows(out, schema)

    names = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return _resolved(docs).mapInArrow(work, names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with their repeated passages cut out, in the same columns; n_chars follows, emptied documents go.

    Bytes of a character that lost others of its bytes go too.
    """
    names = docs.columns
    schema = docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _row_dicts(batches):
            own = Group(row)
            text = [kept.decode("utf-8", "ignore") for _, _, kept in kept_parts(own, row["answers"] or [])]
            rest = pa.ipc.open_stream(row["rest"]).read_all().combine_chunks()
            new = {"text": pa.array(text, pa.string())}
            if "n_chars" in names:
                new["n_chars"] = pa.array(list(map(len, text)), rest.schema.field("n_chars").type)
            out = pa.table({n: new.get(n, rest[n] if n in rest.column_names else None) for n in names})
            yield from out.filter(pa.array([bool(t) for t in text], pa.bool_())).to_batches()

    return _resolved(docs, [n for n in names if n != "text"]).mapInArrow(work, schema)
