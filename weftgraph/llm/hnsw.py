"""Embedding near-duplicates with hierarchical navigable small-world graphs per shard.

Equal vectors of a label are one node with a multiplicity.  The nodes of a label
are split into shards of about ``SHARD`` rows; each shard gets a graph.  The nodes
of every shard query the graphs of all shards of their label (each pair of
shards once), whatever the size of the shards.  A beam starts at ``BEAM`` and is doubled until an audit passes:
it compares some queries with the whole shard and asks that the search has found all
their links.  The audit takes ``AUDIT`` queries and as many more, up to a quarter of them, as it needs to see
``AUDIT_LINKS`` links besides those of a query with itself.  A query whose beam is full of links searches
again with a wider one.  Beams grow to ``WIDEST`` or a quarter of the shard; queries that are
still full then, and pairs of shards whose audit still fails, are compared in blocks.  Every
link is verified by cosine in double precision.  A pair of shards returns link
counts, a spanning forest of its links (never all pairs), and what its audit saw (``recall``).

Cases: null or unlike labels, and null, zero or non-finite vectors link with
nothing and stay alone; any other finite vector counts, however long or short; vectors of other
lengths are other shards; repeated rows of a vec_id are one vector (the first in order, of several
different ones); a null vec_id gives a null component_id and kept, and links with nothing; ties in cosine are all links;
extra columns are left alone, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, stored
from .components import connected_components
from .shingles import mix

COSINE, SHARD, BEAM, WIDEST, AUDIT, AUDIT_LINKS = 0.93, 8192, 24, 192, 192, 100
DEGREE, BUILD_BEAM, BATCH = 12, 40, 512


class Graph:
    """A graph over unit vectors; ``links[layer]`` holds neighbours of each node, -1 where none."""

    def __init__(self, unit: np.ndarray, links: list[np.ndarray] | None = None):
        self.unit = unit.astype(np.float32)
        self.n = len(unit)
        if links is not None:
            self.links = links
            return
        draw = mix(np.arange(self.n, dtype=np.uint64) + np.uint64(5)).astype(float) / 2**64
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(DEGREE)).astype(int), 4)
        order = np.argsort(-level, kind="stable")  # highest first; the first one is where searches begin
        self.top = int(order[0])
        self.links = [np.full((self.n, DEGREE * (2 if layer == 0 else 1)), -1, np.int32) for layer in range(int(level.max(initial=0)) + 1)]
        done, size = 1, 1
        while done < self.n:
            batch = order[done : done + size]
            self._insert(batch, level[batch])
            done += size
            size = min(2 * size, BATCH)

    def _insert(self, batch: np.ndarray, level: np.ndarray) -> None:
        q = self.unit[batch]
        start = np.full((len(batch), 1), self.top, np.int32)
        own = q @ q.T
        np.fill_diagonal(own, -2)
        for layer in range(len(self.links) - 1, -1, -1):
            ids, sims = self._beam(q, start, layer, BUILD_BEAM if layer == 0 else 8)
            start = ids[:, :4]
            at = np.flatnonzero(level >= layer)
            if not len(at):
                continue
            # nodes of the same batch are candidates too
            mates = np.argsort(-own[np.ix_(at, at)], axis=1)[:, :DEGREE]
            near = np.concatenate([ids[at], batch[at][mates]], 1)
            sim = np.concatenate([sims[at], np.take_along_axis(own[np.ix_(at, at)], mates, 1)], 1)
            sim[near < 0] = -2
            best = np.argsort(-sim, axis=1, kind="stable")[:, :BUILD_BEAM]
            self._connect(batch[at], np.take_along_axis(near, best, 1), np.take_along_axis(sim, best, 1), layer)

    def _connect(self, nodes: np.ndarray, near: np.ndarray, sim: np.ndarray, layer: int) -> None:
        """Diverse neighbours first (nearer to the node than to any chosen one), then the nearest left over."""
        taken = np.zeros(near.shape, bool)
        count = np.zeros(len(nodes), int)
        closest = np.full(near.shape, -2.0, np.float32)
        for c in range(near.shape[1]):
            ok = (sim[:, c] > closest[:, c]) & (count < DEGREE) & (sim[:, c] > -2)
            rows = np.flatnonzero(ok)
            if len(rows):
                taken[rows, c] = True
                count[rows] += 1
                cross = np.einsum("rkd,rd->rk", self.unit[near[rows]], self.unit[near[rows, c]])
                closest[rows] = np.maximum(closest[rows], cross)
        rank = np.argsort(~taken, axis=1, kind="stable")[:, :DEGREE]
        chosen = np.where(np.take_along_axis(sim, rank, 1) > -2, np.take_along_axis(near, rank, 1), -1)
        table = self.links[layer]
        table[nodes, : chosen.shape[1]] = chosen
        source = np.repeat(nodes, chosen.shape[1])[chosen.reshape(-1) >= 0]
        target = chosen.reshape(-1)[chosen.reshape(-1) >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        cut = np.flatnonzero(np.diff(target)) + 1
        for own, new in zip(target[np.concatenate(([0], cut))] if len(target) else [], np.split(source, cut), strict=False):
            row = table[own]
            free = np.flatnonzero(row < 0)
            if len(free) >= len(new):
                row[free[: len(new)]] = new
            else:  # half of the places for the nearest, half for earlier links
                every = np.unique(np.concatenate((row[row >= 0], new)))
                if len(every) <= len(row):
                    row[: len(every)], row[len(every) :] = every, -1
                    continue
                order = every[np.argsort(-(self.unit[every] @ self.unit[own]), kind="stable")]
                half = len(row) // 2
                row[:half] = order[:half]
                rest = order[half:]
                row[half:] = rest[np.argsort(mix(rest.astype(np.uint64) + np.uint64(own)), kind="stable")][: len(row) - half]

    def _beam(self, q: np.ndarray, start: np.ndarray, layer: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest nodes found for each query, best first (-1 where fewer)."""
        n_q = len(q)
        rows = np.arange(n_q)[:, None]
        seen = np.zeros((n_q, self.n + 1), bool)
        seen[:, self.n] = True
        ids = np.full((n_q, width), -1, np.int32)
        sims = np.full((n_q, width), -2, np.float32)
        open_ = np.zeros((n_q, width), bool)
        start = start[:, :width]
        k = start.shape[1]
        ids[:, :k] = start
        sims[:, :k] = np.where(start >= 0, np.einsum("qkd,qd->qk", self.unit[start], q), -2)
        open_[:, :k] = start >= 0
        seen[rows, np.where(start < 0, self.n, start)] = True
        while (live := np.flatnonzero(open_.any(1))).size:
            step = np.argsort(~open_[live], axis=1, kind="stable")[:, :3]  # the best ones not yet followed
            is_open = np.take_along_axis(open_[live], step, 1)
            heads = np.where(is_open, np.take_along_axis(ids[live], step, 1), -1)
            open_[live[:, None], step] = False
            near = np.where(heads[:, :, None] >= 0, self.links[layer][heads], -1).reshape(len(live), -1)
            near = np.where(near < 0, self.n, near)
            near = np.where(seen[live[:, None], near], self.n, near)
            near.sort(axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = self.n
            seen[live[:, None], near] = True
            fresh = near < self.n
            sim = np.where(fresh, np.einsum("qkd,qd->qk", self.unit[np.where(fresh, near, 0)], q[live]), -2)
            all_sims = np.concatenate([sims[live], sim], 1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(fresh, near, -1)], 1), best, 1)
            sims[live] = np.take_along_axis(all_sims, best, 1)
            open_[live] = np.take_along_axis(np.concatenate([open_[live], fresh], 1), best, 1)
        return ids, sims

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        start = np.full((len(q), 1), self.top, np.int32)
        for layer in range(len(self.links) - 1, 0, -1):
            start = self._beam(q, start, layer, 4)[0]
        return self._beam(q, start, 0, width)


def audited(graph: Graph, queries: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(queries, their numbers of links) of an audit: queries in no order, compared with the whole shard."""
    order = np.argsort(mix(np.arange(len(queries), dtype=np.uint64) + np.uint64(7)), kind="stable")
    most = max(AUDIT, len(order) // 4)
    count, seen = [np.zeros(0, np.int64)], 0
    for at in range(0, min(most, len(order)), 64):
        count.append((queries[order[at : at + 64]] @ graph.unit64.T >= least).sum(1))
        seen += int(count[-1].sum()) - same * len(count[-1])
        if at + 64 >= AUDIT and seen >= AUDIT_LINKS:
            break
    links = np.concatenate(count)
    return order[: len(links)], links


def linked(graph: Graph, queries: np.ndarray, least: float = COSINE, beam: int = BEAM, same: bool = False, audit: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of (query, node, cosine) with cosine >= least.

    same: the queries are the nodes.  audit: a list that gets the audited queries, their links, those that
    the first beam found besides full beams, and the beam that passed (0: none did).
    """
    exact = graph.unit64
    widest = min(graph.n, max(WIDEST, graph.n // 4))
    chosen, links = audited(graph, queries, least, same)
    width, first, passed = min(beam, graph.n), None, False
    while not passed and width <= widest:
        ids, _ = graph.search(queries[chosen].astype(np.float32), width)
        got = (np.einsum("qkd,qd->qk", exact[ids], queries[chosen]) >= least) & (ids >= 0)
        full = got.all(1) & (width < graph.n)  # widened in any case
        found = np.where(full, links, got.sum(1))
        first = int(found.sum()) if first is None else first
        passed = bool((found >= links).all())
        if not passed:
            width = min(2 * width, graph.n) if width < widest else widest + 1
    if audit is not None:
        audit += [len(chosen), int(links.sum()), first or 0, width if passed else 0]
    for at in range(0, len(queries), 1024):
        todo = np.arange(at, min(at + 1024, len(queries)))
        wide = width
        while len(todo) and wide <= widest:
            ids, _ = graph.search(queries[todo].astype(np.float32), wide)
            cosine = np.einsum("qkd,qd->qk", exact[ids], queries[todo])
            hit = (cosine >= least) & (ids >= 0)
            full = hit.all(1) & (wide < graph.n)
            a, b = np.nonzero(hit & ~full[:, None])
            yield todo[a], ids[a, b], cosine[a, b]
            todo, wide = todo[full], 4 * wide if 4 * wide <= widest or wide == widest else widest
        for i in range(0, len(todo), 256):
            cosine = queries[todo[i : i + 256]] @ exact.T
            a, b = np.nonzero(cosine >= least)
            yield todo[i + a], b, cosine[a, b]


def joined(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """parent (each node's smallest known node) after linking a to b."""
    while len(a):
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        on = low < high
        a, b = a[on], b[on]
        np.minimum.at(parent, high[on], low[on])
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return parent


def unit_vectors(flat: bytes, dim: int) -> np.ndarray:
    """Vectors of length 1; their largest component is made 1 first, so that no square is too large or too small."""
    x = np.frombuffer(flat, np.float64).reshape(-1, dim)
    top = np.abs(x).max(1, keepdims=True)
    x = np.ldexp(x, -np.frexp(top)[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _shard(group):
    """One row per shard: its ids, multiplicities, vectors and graph."""
    import pandas as pd

    group = group.sort_values("node")
    x = np.stack([np.asarray(v, np.float64) for v in group["embedding"]])
    flat = x.tobytes()
    graph = Graph(unit_vectors(flat, x.shape[1]))
    first = group.iloc[0]
    return pd.DataFrame(
        {
            "label": [first["label"]], "dim": [x.shape[1]], "shard": [first["shard"]],
            "ids": [group["node"].to_numpy(np.int64).tobytes()], "times": [group["times"].to_numpy(np.int64).tobytes()], "vectors": [flat],
            "graph": [b"".join(t.tobytes() for t in graph.links)], "layers": [len(graph.links)], "top": [graph.top],
        }
    )


_SHARDS = "label long, dim int, shard int, ids binary, times binary, vectors binary, graph binary, layers int, top int"


def load_graph(row: dict) -> Graph:
    unit = unit_vectors(row["vectors"], row["dim"])
    flat, links, at = np.frombuffer(row["graph"], np.int32), [], 0
    for layer in range(row["layers"]):
        width = DEGREE * (2 if layer == 0 else 1)
        links.append(flat[at : at + len(unit) * width].reshape(len(unit), width))
        at += len(unit) * width
    graph = Graph(unit, links)
    graph.top, graph.unit64 = row["top"], unit
    return graph


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each pair of shards: rows (id, links, to) of its linked nodes, ``to`` being the root of the node's tree; and a row with its audit."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            graph = load_graph(row)
            same = row["shard"] == row["q_shard"]
            side = [(np.frombuffer(row[k + "ids"], np.int64), np.frombuffer(row[k + "times"], np.int64)) for k in ("", "q_")]
            queries = graph.unit64 if same else unit_vectors(row["q_vectors"], row["dim"])
            found = np.zeros((len(queries), graph.n), bool)  # at most two shards wide
            audit: list = []
            for q, node, _ in linked(graph, queries, same=same, audit=audit):
                found[q, node] = True
                if same:
                    found[node, q] = True
            if same:
                np.fill_diagonal(found, False)
            base = 0 if same else graph.n
            parent = np.arange(graph.n if same else graph.n + len(queries))
            q_links = np.zeros(len(queries), np.int64)
            links = np.zeros(graph.n, np.int64)
            for at in range(0, len(queries), 512):
                block = found[at : at + 512]
                q_links[at : at + 512] = block @ side[0][1].astype(float)
                if not same:
                    links += (side[1][1][at : at + 512].astype(float) @ block).astype(np.int64)
                a, b = np.nonzero(block)
                parent = joined(parent, base + at + a, b)
            ids = side[0][0] if same else np.concatenate((side[0][0], side[1][0]))
            count = q_links if same else np.concatenate((links, q_links))
            on = np.flatnonzero(count)
            columns = [np.append(x[on], 0) for x in (ids, count, ids[parent])]
            last = np.arange(len(on) + 1) == len(on)
            about = pa.array([None] * len(on) + [audit], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64(), mask=last) for c in columns), about], ["id", "links", "to", "audit"])
            del found, graph, queries, block
        give_back()


def prepared(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, label, embedding of each vector, null where it links with nothing; the nodes)."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label"))
    fine = F.coalesce(
        F.col("label").isNotNull()
        & F.col("vec_id").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0),
        F.lit(False),
    )
    # -0.0 and 0.0 are one value
    key = F.when(fine, F.transform("embedding", lambda x: x + 0.0))
    rows = rows.select("vec_id", F.struct("label", key.alias("embedding")).alias("x"))
    rows = stored(rows.groupBy("vec_id").agg(F.min("x").alias("x")).select("vec_id", "x.label", "x.embedding"))
    good = rows.where("embedding is not null")
    nodes = stored(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("times")).withColumn("dim", F.size("embedding")))
    return rows, nodes


def searched(nodes: DataFrame, shard: int = SHARD) -> DataFrame:
    """(id, links, to, audit) of all pairs of shards."""
    crowd = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(shard)).cast("int").alias("shards"))
    placed = nodes.join(crowd, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    graphs = stored(placed.select("label", "dim", "shard", "node", "times", "embedding").groupBy("label", "dim", "shard").applyInPandas(lambda g: _shard(g), _SHARDS))
    keys = graphs.select("label", "dim", "shard")
    pairs = keys.join(keys.withColumnRenamed("shard", "q_shard"), ["label", "dim"]).where("q_shard >= shard")
    other = graphs.select("label", "dim", F.col("shard").alias("q_shard"), *(F.col(c).alias("q_" + c) for c in ("ids", "times", "vectors")))
    both = pairs.repartition("label", "dim", "shard", "q_shard").join(graphs, ["label", "dim", "shard"]).join(other, ["label", "dim", "q_shard"])
    return stored(both.select("dim", "shard", "q_shard", "ids", "times", "vectors", "graph", "layers", "top", "q_ids", "q_times", "q_vectors").mapInArrow(_pairs, "id long, links long, to long, audit array<long>"))


def recall(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """What the audits of all pairs of shards saw: queries, links, found (by the first beam), beam (the widest that passed), failed (pairs compared in blocks)."""
    a = searched(prepared(vectors)[1], shard).where("audit is not null").select(*(F.col("audit")[i].alias(c) for i, c in enumerate(("queries", "links", "found", "beam"))))
    return a.agg(F.sum("queries").alias("queries"), F.sum("links").alias("links"), F.sum("found").alias("found"), F.max("beam").alias("beam"), F.count_if(F.col("beam") == 0).alias("failed"))


def near_vectors(vectors: DataFrame, shard: int = SHARD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector (columns vec_id, embedding, label)."""
    rows, nodes = prepared(vectors)
    found = searched(nodes, shard).where("id is not null").drop("audit")
    label = connected_components(found.select(F.col("id").alias("a"), F.col("to").alias("b")))
    links = found.groupBy(F.col("id").alias("node")).agg(F.sum("links").alias("links"))
    of_node = nodes.join(links, "node", "left").join(label.withColumnRenamed("id", "node"), "node", "left")
    of_node = of_node.select("label", "embedding", F.coalesce("links", F.lit(0)).alias("links"), "times", F.coalesce("component", "node").alias("component"))
    # copies get what their node has: equal vectors meet again by label and vector
    out = rows.join(of_node, ["label", "embedding"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("links") + F.col("times") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("vec_id") == component).alias("kept"))
