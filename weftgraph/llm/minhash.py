"""Near-duplicates by BagMinHash over multisets of word shingles.

A text is a bag of its 5-word shingles.  For each shingle a Poisson process runs
over its weight, in strips [0,1), [1,2), [2,4), [4,8), ...; every point has a
place in its strip, so that a weight takes part of a strip (and two bags share the
points below the smaller weight), a time and one of ``SIZE`` registers.  A register
keeps its earliest point: two bags agree in it with a probability of their
weighted Jaccard similarity.  Points are made in order of time only up to the
time at which all registers are full.

Signatures are banded; buckets give candidates, whose bags are then compared exactly.
Equal bags are one node.  Every member of a bucket is compared with the smallest one,
its center, which puts most near copies into one component at one comparison each.
The members that are not linked to their center are then queries against all nodes
around it, in blocks of at most ``BLOCK`` nodes with an inverted index, and only
links between components leave a block: no link of a bucket is lost and no pairs are listed.

Cases: null or empty texts and texts without words have no bag: only equal ones
(null is empty) form a class; shorter texts have one shingle; very long texts are
read whole; rows that repeat a doc_id are one document and stay or go together;
a null doc_id gets the class of its bag (null if no other row has that) and stays; extra columns are left
alone, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, texts
from .components import connected_components
from .shingles import mix, shingle_hashes

SIZE, BANDS, LEAST = 128, 32, 0.8
#: Nodes of a block of queries or of members around one center.
BLOCK = 4096
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count), ordered by text and hash."""
    hashes, at = shingle_hashes(column)
    text = np.repeat(np.arange(len(column)), np.diff(at))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return text[first], hashes[first], np.diff(np.append(first, len(hashes)))


def signatures(text: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n_texts: int, size: int = SIZE) -> np.ndarray:
    """BagMinHash signatures, one row per text (zero where a text has no shingles)."""
    out = np.zeros((n_texts, size), np.uint64)
    weight = np.bincount(text, counts, n_texts)
    # one process for each shingle and strip; strip s > 0 is [2**(s-1), 2**s)
    strips = 1 + np.ceil(np.log2(np.maximum(counts, 1))).astype(np.int64)
    who = np.repeat(np.arange(len(text)), strips)
    strip = np.arange(len(who)) - np.repeat(np.cumsum(strips) - strips, strips)
    seed = mix(hashes[who] + strip.astype(np.uint64) * _GOLDEN)
    rate = np.where(strip > 0, 2.0 ** (strip - 1), 1.0)
    low = np.where(strip > 0, rate, 0.0)
    open_ = weight > 0
    reach = np.where(open_, size * (math.log(size) + 3) / np.maximum(weight, 1), 0)
    while open_.any():
        live = np.flatnonzero(open_[text[who]])
        time = np.zeros(len(live))
        keys, times, values = [], [], []
        k = 0
        while len(live):
            r = mix(seed[live] + np.uint64((k + 1) * int(_GOLDEN) % (1 << 64)))
            time = time - np.log(((r >> np.uint64(11)).astype(float) + 1) / 2**53) / rate[live]
            on = time < reach[text[who[live]]]
            live, time, r = live[on], time[on], r[on]
            place = low[live] + rate[live] * ((mix(r + np.uint64(1)) >> np.uint64(11)).astype(float) / 2**53)
            inside = place < counts[who[live]]
            register = (mix(r + np.uint64(2)) % np.uint64(size)).astype(np.int64)
            keys.append((text[who[live]] * size + register)[inside])
            times.append(time[inside])
            values.append(r[inside])
            k += 1
        key, at, value = map(np.concatenate, (keys, times, values))
        order = np.lexsort((at, key))
        key, value = key[order], value[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        key, value = key[first], value[first]
        full = open_ & (np.bincount(key // size, minlength=n_texts) == size)
        done = full[key // size]
        out.reshape(-1)[key[done]] = value[done]
        open_ &= ~full
        reach *= 2
    return out


def band_hashes(signature: np.ndarray, n_bands: int = BANDS) -> np.ndarray:
    rows = signature.shape[1] // n_bands
    grid = signature.reshape(len(signature), n_bands, rows)
    out = np.broadcast_to(np.arange(n_bands, dtype=np.uint64) * _GOLDEN, grid.shape[:2]).copy()
    for i in range(rows):
        out = mix(out + grid[:, :, i])
    return out


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two bags as sorted hashes with repeats."""
    if not len(a) and not len(b):
        return 1.0
    (ha, na), (hb, nb) = (np.unique(x, return_counts=True) for x in (a, b))
    _, ia, ib = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    shared = int(np.minimum(na[ia], nb[ib]).sum())
    return shared / (len(a) + len(b) - shared)


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, bag (identity of the bag, two longs), bands (null without shingles)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n = batch.num_rows
            text, hashes, counts = bags(batch["text"])
            bands = band_hashes(signatures(text, hashes, counts, n)).view(np.int64)
            identity = []
            empty = np.bincount(text, minlength=n) == 0
            wordless = np.flatnonzero(empty)  # known by the text itself
            own = [hashlib.blake2b(batch["text"][i].as_py().encode(), digest_size=16).digest() for i in wordless.tolist()]
            own = np.frombuffer(b"".join(own), np.uint64).reshape(-1, 2)
            for k, salt in enumerate((11, 12)):
                total = np.zeros(n, np.uint64)
                np.add.at(total, text, mix(hashes + np.uint64(salt)) * counts.astype(np.uint64))
                total[wordless] = own[:, k]
                identity.append(total.view(np.int64))
            del text, hashes, counts
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(bands.reshape(-1)))
            lists = pc.if_else(pa.array(empty), None, lists)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, identity), lists], ["doc_id", "bag1", "bag2", "bands"])

    return texts(docs).mapInArrow(work, "doc_id long, bag1 long, bag2 long, bands array<long>")


def bag_rows(docs: DataFrame) -> DataFrame:
    """doc_id, bag: sorted 64-bit shingle hashes with repeats."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes, at = shingle_hashes(batch["text"])
            own = [np.sort(hashes[a:b]).tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(own, pa.binary())], ["id", "bag"])

    return docs.mapInArrow(work, "id long, bag binary")


def verified(pairs: DataFrame, bag: DataFrame, least: float = LEAST) -> DataFrame:
    """The pairs (a, b) whose bags reach the similarity."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "bag_b"):
            ok = [weighted_jaccard(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) >= least for x, y in zip(batch["bag_a"], batch["bag_b"], strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    joined = pairs.join(bag.select(F.col("id").alias("b"), F.col("bag").alias("bag_b")), "b").join(bag.select(F.col("id").alias("a"), F.col("bag").alias("bag_a")), "a")
    # bags of very different size cannot be similar
    size_a, size_b = F.length("bag_a"), F.length("bag_b")
    joined = joined.where(F.least(size_a, size_b) >= F.lit(least) * F.greatest(size_a, size_b))
    return joined.select("a", "b", "bag_a", "bag_b").mapInArrow(work, "a long, b long")


def block_links(rows, least: float = LEAST):
    """Links between components among queries and members of one block, one for each two components."""
    import pandas as pd

    bags_ = [np.unique(np.frombuffer(b, np.uint64), return_counts=True) for b in rows["bag"]]
    size = np.array([n.sum() for _, n in bags_], np.int64)
    node, component = rows["node"].to_numpy(), rows["component"].to_numpy()
    member = np.flatnonzero(rows["member"].to_numpy())
    if not len(member):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    token = np.concatenate([bags_[m][0] for m in member])
    weight = np.concatenate([bags_[m][1] for m in member])
    whose = np.repeat(member, [len(bags_[m][0]) for m in member])
    order = np.argsort(token, kind="stable")
    token, weight, whose = token[order], weight[order], whose[order]
    found = {}
    for q in np.flatnonzero(~rows["member"].to_numpy()).tolist():
        own, count = bags_[q]
        low, high = np.searchsorted(token, own, "left"), np.searchsorted(token, own, "right")
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        shared = np.bincount(whose[at], np.minimum(weight[at], np.repeat(count, n)), len(node))
        hit = np.flatnonzero((shared >= least * (size + size[q] - shared)) & (component != component[q]) & (shared > 0))
        for h in hit.tolist():
            found.setdefault((min(component[q], component[h]), max(component[q], component[h])), (node[q], node[h]))
    return pd.DataFrame(list(found.values()), columns=["a", "b"]).astype("int64")


def missed_links(around: DataFrame, bag: DataFrame, least: float = LEAST) -> DataFrame:
    """Links (a, b) between components around a center; ``around``: center, node, component, of (the center's component)."""
    mixed = around.groupBy("center").agg(F.count("*").alias("n"), F.count_if(F.col("component") != F.col("of")).alias("u")).where("u > 0")
    mixed = mixed.select("center", F.ceil(F.col("n") / BLOCK).cast("int").alias("members"), F.ceil(F.col("u") / BLOCK).cast("int").alias("queries"))
    rows = around.join(mixed, "center")
    own = F.xxhash64("node")
    member = rows.select("center", "node", "component", F.lit(True).alias("member"), F.explode(F.sequence(F.lit(0), F.col("queries") - 1)).alias("i"), F.pmod(own, F.col("members")).cast("int").alias("j"))
    query = rows.where(F.col("component") != F.col("of")).select("center", "node", "component", F.lit(False).alias("member"), F.pmod(own, F.col("queries")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("members") - 1)).alias("j"))
    blocks = member.unionByName(query).join(bag.withColumnRenamed("id", "node"), "node")
    return blocks.groupBy("center", "i", "j").applyInPandas(lambda rows: block_links(rows, least), "a long, b long")


def near_duplicates(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), kept, same_bag (documents with the same bag)."""
    made = stored(sketched(docs))
    nodes = stored(made.groupBy("bag1", "bag2").agg(F.min("doc_id").alias("node"), F.count("*").alias("same_bag")))
    # bands of one document of each bag
    band = made.where("bands is not null").join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi")
    band = band.dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("node"), F.explode("bands").alias("band"))
    crowd = band.groupBy("band").agg(F.min("node").alias("center"), F.max("node").alias("last")).where("center < last")
    around = stored(band.join(crowd.select("band", "center"), "band").select("center", "node").distinct())
    ids = around.select(F.col("node").alias("doc_id")).distinct()
    bag = stored(bag_rows(texts(docs).join(ids.hint("merge"), "doc_id")).dropDuplicates(["id"]))
    star = around.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b"))
    links = stored(verified(star, bag, least))
    label = connected_components(links)
    of = label.select(F.col("id").alias("center"), F.col("component").alias("of"))
    here = around.join(label.withColumnRenamed("id", "node"), "node", "left").join(of, "center", "left")
    here = here.select("center", "node", F.coalesce("component", "node").alias("component"), F.coalesce("of", "center").alias("of"))
    more = stored(missed_links(stored(here), bag, least))
    if not more.isEmpty():
        label = connected_components(links.unionByName(more))
    classes = nodes.join(label.select(F.col("id").alias("node"), "component"), "node", "left")
    classes = classes.select("bag1", "bag2", "same_bag", F.coalesce("component", "node").alias("class_id"))
    return made.select("doc_id", "bag1", "bag2").join(classes, ["bag1", "bag2"]).select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"), "same_bag")


def one_of_each(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents without the near-duplicates of a smaller doc_id, with all their columns as they were."""
    gone = near_duplicates(docs, least).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
