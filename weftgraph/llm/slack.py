"""Best-fit packing by minimum bin slack.

A bin takes the longest piece left and, besides it, the combination of the other lengths
that fills it most: a subset-sum dynamic program over a bitset of reachable sums.  Which
pieces share a bin depends on their lengths alone, and a combination stays the fullest while
its lengths last, so the plan is made on a histogram of lengths and says how often each
combination is used.  Histogram and plan are bounded by the window, not by the data: at most
``WINDOW`` lengths, and a length ends a combination at most 2 + log2(WINDOW / length) times.

Pieces then find their places without meeting: a piece is known by its length and its number
among the pieces of that length, and the plan maps intervals of those numbers to windows.

Cases: null or empty text is its end id alone; a document longer than a window is cut into whole
windows and a rest; repeated rows are packed once each, a null doc_id stays null; pieces of one
length are taken in the order of their tasks; extra columns are left alone, whatever
their names; no rows give no sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored, texts
from .tokens import encoder

WINDOW, END_ID = 4096, 1

_PIECES = pa.schema([("part", pa.int32()), ("number", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def fullest(counts: dict[int, int], order: list[int], size: int) -> dict[int, int]:
    """Copies of each length in the fullest bin with the longest piece; ``order``: the lengths left, longest first."""
    longest = order[0]
    room = size - longest
    reach, mask, steps = 1, (1 << room + 1) - 1, []  # bit s of reach: some pieces have the sum s
    for n in order:
        copies, chunk = min(counts[n] - (n == longest), room // n), 1
        while copies > 0:
            take = min(chunk, copies)
            more = reach | reach << take * n & mask
            if more != reach:
                steps.append((n, take, reach))
                reach = more
            copies, chunk = copies - take, 2 * chunk
        if reach >> room:
            break
    chosen, rest = {longest: 1}, reach.bit_length() - 1
    for n, take, before in reversed(steps):
        if not before >> rest & 1:
            rest -= take * n
            chosen[n] = chosen.get(n, 0) + take
    return chosen


def combinations(counts: dict[int, int], size: int = WINDOW) -> Iterator[tuple[int, dict[int, int]]]:
    """(how many bins, copies of each length in such a bin) until no piece is left."""
    left = {n: c for n, c in counts.items() if c > 0}
    order = sorted(left, reverse=True)
    while order:
        chosen = fullest(left, order, size)
        times = min(left[n] // c for n, c in chosen.items())
        for n, c in chosen.items():
            left[n] -= times * c
        order = [n for n in order if left[n]]
        yield times, chosen


def intervals(counts: dict[int, int], size: int = WINDOW) -> np.ndarray:
    """Rows (length, first number, bins, first bin, offset), ordered: pieces ``first number + j`` go to bin ``first bin + j % bins``."""
    used, rows, bins = dict.fromkeys(counts, 0), [], 0
    for times, chosen in combinations(counts, size):
        offset = 0
        for n, c in chosen.items():
            rows.append((n, used[n], times, bins, offset))
            used[n] += times * c
            offset += n * c
        bins += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def placed(plan: np.ndarray, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces by length and number among their length."""
    at = np.searchsorted(plan[:, 0] << 48 | plan[:, 1], length << 48 | number, "right") - 1
    _, first, times, bins, offset = plan[at].T
    return bins + (number - first) % times, offset + (number - first) // times * length


def pieces(docs: DataFrame, tokenizer_path: str, style: str, end_id: int, size: int) -> DataFrame:
    """One row for each piece, numbered within its task (``part``) and length; the text is read once and never shuffled."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, code, end = TaskContext.get().partitionId(), encoder(tokenizer_path, style), np.uint32(end_id).astype("<u4").tobytes()
        numbers = [0] * (size + 1)
        for batch in slices(batches, limit=4 << 20, rows=1 << 16, keeps=True):
            rows = []
            for doc_id, ids in zip(batch["doc_id"].to_pylist(), code.encode(batch["text"].to_pylist()), strict=True):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    one = ids[at : at + 4 * size]
                    n = len(one) // 4
                    rows.append((part, numbers[n], doc_id, k, at // 4, n, zlib.crc32(one)))
                    numbers[n] += 1
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), _PIECES, strict=True)], schema=_PIECES)

    return texts(docs).mapInArrow(cut, "part int, number long, doc_id long, piece int, start long, length long, ids_crc32 long")


def pack_fullest(docs: DataFrame, tokenizer_path: str, style: str = "word", end_id: int = END_ID, size: int = WINDOW) -> DataFrame:
    """Pieces of all documents in sequences of at most ``size`` ids, one row each.

    Only the histogram of lengths reaches the driver, and only the plan is broadcast.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer_path, style, end_id, size))
    of_part = cut.groupBy("part", "length").count()
    histogram = {r.length: r.n for r in of_part.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(intervals(histogram, size))
    # a length may have a third of all pieces, but has one row for each task here
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = of_part.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sequence, offset = placed(plan.value, batch["length"].to_numpy(), batch["number"].to_numpy())
                columns = [batch[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    numbered = cut.join(firsts.hint("merge"), ["part", "length"]).withColumn("number", F.col("number") + F.col("first"))
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "number").mapInArrow(work, _PLACED)
