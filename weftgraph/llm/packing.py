"""Bounded-space online packing of token sequences.

Each task keeps at most ``OPEN`` open windows.  A piece goes to the window it
fills best; when none has room, the fullest is closed, filled up with the head
of the piece if ``MIN_CUT`` ids or more are missing.  The windows still open at
the end of a task are leftovers; leftovers of ``FAN_IN`` neighbouring tasks are
merged piece by piece, best-fit from the longest, without further cuts.

Cases: null or empty text is its end id alone; a document longer than a window
takes whole windows first; repeated rows are packed once each; a null doc_id stays null; of windows
that fit alike the oldest is taken; extra columns are left alone, whatever their names; no rows
give no sequences.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, texts
from .tokens import END_ID, encoder

WINDOW, OPEN, MIN_CUT, FAN_IN = 4096, 64, 16, 8

_COLUMNS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Windows:
    """Open windows of one task, ordered by room; ``place`` returns (window, offset) of a piece that fits."""

    def __init__(self, size: int = WINDOW, most: int = OPEN):
        self.size, self.most, self.count = size, most, 0
        self.open: list[tuple[int, int]] = []  # (room, window)

    def place(self, n: int, force: bool = False) -> tuple[int, int] | None:
        """Best fit, else a new window while there may be one more; None if neither (unless forced)."""
        i = bisect_left(self.open, (n, -1))
        if i < len(self.open):
            room, window = self.open.pop(i)
        elif len(self.open) < self.most or force:
            room, window = self.size, self.count
            self.count += 1
        else:
            return None
        if room > n:
            insort(self.open, (room - n, window))
        return window, self.size - room

    def close_fullest(self) -> tuple[int, int]:
        return self.open.pop(0)


def cut_and_place(lengths: Iterator[int], windows: Windows, min_cut: int = MIN_CUT) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, window, offset) of each piece; documents are numbered as they come."""
    for k, n in enumerate(lengths):
        start = 0
        while start < n:
            length = min(n - start, windows.size)
            if (at := windows.place(length)) is None:
                room, window = windows.close_fullest()
                if room < min_cut:
                    continue
                length, at = room, (window, windows.size - room)
            yield k, start, length, *at
            start += length


def pack(docs: DataFrame, tokenizer_path: str, style: str = "word", end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of at most ``WINDOW`` ids, one row each.

    The text is read once and never shuffled; only leftovers move.  ``with_ids``
    adds the ids of each piece (little-endian 32-bit).
    """
    schema = pa.schema(
        [("part", pa.int32()), ("left", pa.bool_()), *((c.split()[0], pa.int64()) for c in _COLUMNS.split(", "))] + [("ids", pa.binary())] * with_ids
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, code, end = TaskContext.get().partitionId(), encoder(tokenizer_path, style), np.uint32(end_id).astype("<u4").tobytes()
        windows, rows = Windows(), {}  # rows of the windows that are still open

        def out(done: list[int], left: bool) -> pa.RecordBatch:
            flat = [r for w in done for r in rows.pop(w)]
            values = [[part] * len(flat), [left] * len(flat), *([r[i] for r in flat] for i in range(7 + with_ids))]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in slices(batches, limit=4 << 20, rows=1 << 16, keeps=True):
            coded = [x + end for x in code.encode(batch.column("text").to_pylist())]
            doc_ids = batch.column("doc_id").to_pylist()
            for k, start, length, window, offset in cut_and_place((len(x) // 4 for x in coded), windows):
                ids = coded[k][4 * start : 4 * (start + length)]
                row = (doc_ids[k], start, length, zlib.crc32(ids), len(coded[k]) // 4, part << 33 | window, offset)
                rows.setdefault(window, []).append((*row, ids) if with_ids else row)
            still = {w for _, w in windows.open}
            if done := [w for w in rows if w not in still]:
                yield out(done, False)
        if rows:
            yield out(list(rows), True)

    names = _COLUMNS + (", ids binary" if with_ids else "")
    pieces = stored(texts(docs).mapInArrow(packed, "part int, left boolean, " + names))

    def merge(group):
        import pandas as pd

        windows = Windows(most=1 << 30)
        group = group.sort_values(["length", "part", "sequence_id", "offset"], ascending=[False, True, True, True], kind="stable")
        at = [windows.place(int(n)) for n in group["length"]]
        key = int(group["part"].iloc[0]) // FAN_IN << 33 | 1 << 32 if len(group) else 0
        group = group.assign(sequence_id=pd.Series([key | w for w, _ in at], index=group.index, dtype="int64"), offset=pd.Series([o for _, o in at], index=group.index, dtype="int64"))
        return group.drop(columns=["part", "left"])

    merged = pieces.where("left").groupBy(F.floor(F.col("part") / FAN_IN)).applyInPandas(lambda g: merge(g), names)
    return pieces.where("not left").drop("part", "left").unionByName(merged)
