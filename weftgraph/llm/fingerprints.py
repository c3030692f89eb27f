"""Bottom-k sketches of shingle hashes: mergeable document fingerprints.

A sketch holds the ``K`` smallest distinct shingle hashes of a text.  Two
sketches give estimates of resemblance, containment and distinct shingles, and
their union's sketch, without the texts; below ``K`` distinct shingles all are exact.

Cases: null text is empty; a text without words has an empty sketch, like any
other such text (likeness 1) and unlike the rest (0); repeated rows follow each
other in text order; a null doc_id comes last; a lone document is its own next one; very long texts are
read whole; extra columns are left alone, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, slices, texts
from .shingles import shingle_hashes

K = 256


def sketches(values: list[str], k: int = K) -> list[np.ndarray]:
    hashes, at = shingle_hashes(pa.array(values, pa.large_string()))
    return [np.unique(hashes[a:b])[:k] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    union = merged(a, b, k)
    if not len(union):
        return 1.0
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


def distinct(a: np.ndarray, k: int = K) -> float:
    return float(len(a)) if len(a) < k else (k - 1) / ((int(a[k - 1]) + 1) / 2**64)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of a's distinct shingles that b has too."""
    if not len(a):
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct(merged(a, b, k), k) / distinct(a, k))


def to_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), ">u8").astype(np.uint64)


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, n_shingles (estimated) of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = sketches(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(map(to_text, made), pa.string()), pa.array(map(distinct, made), pa.float64())], ["doc_id", "fingerprint", "n_shingles"])

    return texts(docs).mapInArrow(work, "doc_id long, fingerprint string, n_shingles double")


_OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, containment double, n_shingles double"
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("containment", pa.float64()), ("n_shingles", pa.float64())])


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Rows ordered by doc_id descending inside ``part``, each part followed by the head of the next (``guest``).

    Cut points come from quantiles of the ids; they and the heads of the parts, a few
    rows for each task, pass through the driver.  The texts are shuffled once; a row that is a
    head as well goes to two parts.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    keyed = texts(docs).withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    cuts = keyed.agg(F.percentile_approx("key", [i / (4 * n) for i in range(1, 4 * n)], 10 * n * 4)).first()[0]
    ascending = spark.sparkContext.broadcast(np.array(sorted(set(cuts or [])), np.int64))

    @F.pandas_udf("int")
    def part(key: pd.Series) -> pd.Series:
        return pd.Series(len(ascending.value) - np.searchsorted(ascending.value, key.to_numpy(), "right"))

    keyed = keyed.withColumn("part", part("key"))
    heads = sorted((r.part, r.key) for r in keyed.groupBy("part").agg(F.max("key").alias("key")).collect())
    # the first head follows the last part
    homes = [(key, heads[i - 1][0]) for i, (_, key) in enumerate(heads)]
    homes = F.broadcast(spark.createDataFrame(homes, "key long, home int"))  # at most 4 n rows
    both = F.array(F.struct(F.col("part"), F.lit(False).alias("guest")), F.struct(F.col("home").alias("part"), F.lit(True).alias("guest")))
    rows = keyed.join(homes, "key", "left").select("doc_id", "key", "text", F.explode(both).alias("at")).where("at.part is not null").select("doc_id", "key", "text", "at.part", "at.guest")
    # neighbouring parts share a task
    rows = rows.repartitionById(n, (F.col("part") * n / F.lit(max(1, len(heads)))).cast("int"))
    return rows.sortWithinPartitions("part", "guest", F.desc("key"), "text").drop("key")


def compare_edited(docs: DataFrame) -> DataFrame:
    """Each text against itself with its last third replaced by the head of the next document, and against that one."""

    def digest(rows: list[tuple], nexts: list[str], next_sketches: list[np.ndarray], made: list[np.ndarray]) -> pa.RecordBatch:
        edited = []
        for (_, text, _, _), after in zip(rows, nexts, strict=True):
            m = len(text) // 3
            edited.append(text[: len(text) - m] + after[:m])
        sketched = sketches(edited)
        columns = [
            [r[0] for r in rows],
            [len(r[1]) for r in rows],
            [hashlib.sha256(e.encode()).hexdigest() for e in edited],
            map(to_text, made),
            map(to_text, sketched),
            map(resemblance, made, sketched),
            map(resemblance, made, next_sketches),
            map(containment, made, sketched),
            map(distinct, made),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row whose next one is still to come, and its sketch
        for batch in slices(batches):
            rows = list(zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "part", "guest")), strict=True))
            made = sketches([r[1] for r in rows])
            both = ([held] if held else []) + list(zip(rows, made, strict=True))
            pairs = [(a, b) for a, b in zip(both, both[1:], strict=False) if not a[0][3] and a[0][2] == b[0][2]]
            if pairs:
                yield digest([a[0] for a, _ in pairs], [b[0][1] for _, b in pairs], [b[1] for _, b in pairs], [a[1] for a, _ in pairs])
            held = both[-1]

    return with_neighbours(docs).mapInArrow(work, _OUT)
