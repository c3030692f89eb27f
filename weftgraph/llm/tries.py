"""Source divergence audit: how far the words of a language's sources are from each other.

Each task counts terms in byte tries, one for each language, with a counter for each source
at the leaves (columns of numbers, where a leaf is a row); tries that grow large are handed on and new ones begun.  The leaves are
partitioned by ranges of terms, so a task gets all leaves of a range of
prefixes in byte order, merges equal ones in a trie again and keeps those of enough documents.
A traversal of the merged tries in byte order (that of UTF-8) then gives, for each pair of
sources, the sum over the terms it has seen, and for each source its first candidates.

A term's share of a source is p = 1 + floor(SCALE (count + 1) / (N + V)): N counts the source's kept
terms, V the language's.  Two shares diverge by floor((p - q)^2 / q).  Most terms are in few
sources, so a pair's sum starts from V times the divergence of two absent terms and only terms that
one of them has correct it; leaves with equal counters are counted, and worked on once.

Cases: null text, language and source are read as ''; groups without terms take part, with p of
an absent term; equal rows count once each; very long texts are read whole; equal values rank by
the bytes of their item; extra columns are left alone; no rows give none.
"""

from __future__ import annotations

import gc
from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import batched, chain, pairwise
from itertools import count as number

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, slices, stored

SCALE, LEAST_DOCUMENTS, RANKS = 1_000_000_000, 3, 200
#: Counters of a task's tries before they are handed on; leaves of a merged trie, and their bytes; rows of a batch; counters worked on at once.
COUNTERS, HELD, HELD_BYTES, ROWS, PROFILES = 1_500_000, 20_000, 64 << 20, 10_000, 50_000
#: Cells of a block of pair sums.
CELLS = 4 << 20

#: Bytes of terms: A-Z lower-cased, other letters a-z and all beyond ASCII kept, the rest blank.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Trie:
    """A radix trie over bytes; a node is [label, children by first byte, leaf], a leaf {source: count} or the row that its counters stand in."""

    def __init__(self):
        self.root: list = [b"", {}, None]

    def leaf(self, term: bytes) -> dict:
        """The counters of a term, made if need be."""
        node = self._node(term)
        if node[2] is None:
            node[2] = {}
        return node[2]

    def put(self, term: bytes, row: int) -> None:
        """A term whose counters are a row of columns."""
        self._node(term)[2] = row

    def _node(self, term: bytes) -> list:
        node, at, end = self.root, 0, len(term)
        while at < end:
            children = node[1]
            first = term[at]
            child = children.get(first)
            if child is None:
                child = children[first] = [term[at:], {}, None]
                return child
            label = child[0]
            if not term.startswith(label, at):
                same = 1
                stop = min(len(label), end - at)
                while same < stop and term[at + same] == label[same]:
                    same += 1
                between = [label[:same], {label[same]: child}, None]
                child[0] = label[same:]
                children[first] = child = between
                label = child[0]
            node = child
            at += len(label)
        return node

    def add(self, counts: dict[bytes, int], source) -> None:
        """Counts of terms in a source."""
        for term, n in counts.items():
            leaf = self.leaf(term)
            leaf[source] = leaf.get(source, 0) + n

    def leaves(self) -> Iterator[tuple[bytes, dict | int]]:
        """(term, leaf) in the order of bytes."""
        open_nodes = [(b"", self.root)]
        while open_nodes:
            prefix, node = open_nodes.pop()
            prefix += node[0]
            if node[2] is not None:
                yield prefix, node[2]
            open_nodes.extend((prefix, node[1][b]) for b in sorted(node[1], reverse=True))


def acyclic(work: Callable) -> Callable:
    """A task without the search for cycles, which tries and counters have none of and which takes a fifth of its time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        try:
            yield from work(batches)
        finally:
            gc.enable()
            give_back()

    return run


_LEAVES = "term binary, lang string, documents long, sources binary, counters binary"
_MERGED = "lang string, term binary, sources array<string>, counts array<long>"
_COLUMNS = ["term", "lang", "documents", "sources", "counters"]

#: Bits of a term's number beside that of its document or group.
_BITS = 40
_TERM = (1 << _BITS) - 1


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of ranges, one range after another."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def ends(lengths: np.ndarray) -> np.ndarray:
    """Where parts of these lengths begin, and the end of the last."""
    return np.concatenate([[0], np.cumsum(lengths)])


def raw(values: pa.Array) -> np.ndarray:
    """The bytes of all values of a binary column, one after another."""
    kind = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    at = np.frombuffer(values.buffers()[1], kind)[values.offset : values.offset + len(values) + 1] if len(values) else [0, 0]
    return np.frombuffer(values.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]


def cut(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary column of the bytes between places."""
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def leaf_batch(terms: pa.Array, langs: pa.Array, documents: np.ndarray, bounds: np.ndarray, names: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    """Leaves as rows.  Leaf i has the counters from bounds[i] to bounds[i + 1]: their sources' names one after another, and (count, length of the name) of each."""
    lengths = pc.binary_length(names).to_numpy()
    numbers = np.column_stack([counts, lengths]).astype("<i8").reshape(-1).view(np.uint8)
    return pa.RecordBatch.from_arrays([terms, langs, pa.array(documents, pa.int64()), cut(raw(names), ends(lengths)[bounds]), cut(numbers, 16 * bounds)], _COLUMNS)


def counters(batch: pa.RecordBatch) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of leaves: how many counters each one has; the source and the count of every counter."""
    numbers = np.frombuffer(raw(batch["counters"]).tobytes(), "<i8").reshape(-1, 2)
    names = pa.Array.from_buffers(pa.large_binary(), len(numbers), [None, pa.py_buffer(ends(numbers[:, 1])), pa.py_buffer(raw(batch["sources"]).tobytes())])
    return pc.binary_length(batch["counters"]).to_numpy() // 16, names, numbers[:, 0]


class Counted:
    """What a task has counted, as columns: terms and (language, source) groups by number, and each group's count and documents of a term."""

    def __init__(self):
        self.terms: dict[bytes, int] = defaultdict(number().__next__)
        self.groups: dict[tuple, int] = defaultdict(number().__next__)
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, batch: pa.RecordBatch) -> None:
        terms = [text.translate(_TERMS).split() for text in batch["text"].cast(pa.binary()).to_pylist()]
        lengths = np.array(list(map(len, terms)))
        seen = np.fromiter(map(self.terms.__getitem__, chain.from_iterable(terms)), np.int64, lengths.sum())
        group = np.array([self.groups[g] for g in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), strict=True)], np.int64)
        key = np.sort(np.repeat(np.arange(len(terms)), lengths) << _BITS | seen)
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        key, counts = key[starts], np.diff(starts, append=len(key))
        self.parts.append((group[key >> _BITS] << _BITS | key & _TERM, counts, np.ones(len(key), np.int64)))
        self.size += len(key)

    def gather(self) -> None:
        """Equal terms of a group become one counter."""
        key, *sums = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.diff(key, prepend=-1))
        self.parts = [(key[starts], *(np.add.reduceat(c[order], starts) if len(key) else c for c in sums))]
        self.size = len(starts)

    def leaves(self) -> Iterator[pa.RecordBatch]:
        """The leaves of the tries, one for each language.  A term of a single document needs no node: its one counter is handed on as it is."""
        if not self.size:
            return
        self.gather()
        key, counts, documents = self.parts[0]
        langs = list(dict.fromkeys(lang for lang, _ in self.groups))
        lang_of = np.array([langs.index(lang) for lang, _ in self.groups], np.int64)
        names = pa.array([s.encode() for _, s in self.groups], pa.large_binary())
        texts = pa.array(list(self.terms), pa.binary())
        leaf = lang_of[key >> _BITS] << _BITS | key & _TERM
        order = np.argsort(leaf, kind="stable")  # groups of a leaf stay in their order
        leaf, key, counts = leaf[order], key[order], counts[order]
        starts = np.flatnonzero(np.diff(leaf, prepend=-1))
        lengths, documents, leaf = np.diff(starts, append=len(leaf)), np.add.reduceat(documents[order], starts), leaf[starts]
        for k, lang in enumerate(langs):
            a, b = np.searchsorted(leaf, [k << _BITS, (k + 1) << _BITS])
            often = np.flatnonzero(documents[a:b] > 1) + a
            trie = Trie()
            for term, row in zip(texts.take(pa.array(leaf[often] & _TERM)).to_pylist(), often.tolist(), strict=True):
                trie.put(term, row)
            rows = np.concatenate([np.flatnonzero(documents[a:b] == 1) + a, np.array([row for _, row in trie.leaves()], np.int64)])
            del trie
            for part in parts(rows, lengths):
                at = spread(starts[part], lengths[part])
                yield leaf_batch(texts.take(pa.array(leaf[part] & _TERM)), pa.array([lang] * len(part), pa.string()), documents[part], ends(lengths[part]), names.take(pa.array(key[at] >> _BITS)), counts[at])


def parts(rows: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Rows in pieces of at most ``ROWS`` with not many more than ``CELLS`` counters."""
    for at in range(0, len(rows), ROWS):
        some = rows[at : at + ROWS]
        yield from np.split(some, np.flatnonzero(np.diff(np.cumsum(lengths[some]) // CELLS)) + 1)


def counted(docs: DataFrame) -> DataFrame:
    """Leaves of the tries of each task."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))

    @acyclic
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counted()
        for batch in slices(batches, rows=1 << 12):
            found.add(batch)
            if found.size >= 2 * COUNTERS:
                found.gather()
                if found.size >= COUNTERS:
                    yield from found.leaves()
                    found = Counted()
        yield from found.leaves()

    return rows.mapInArrow(work, _LEAVES)


def changes(batch: pa.RecordBatch) -> np.ndarray:
    """Where the (term, language) groups of ordered rows begin, and the end of the last."""
    n = batch.num_rows
    unlike = pc.or_(*(pc.not_equal(batch[c].slice(1), batch[c].slice(0, n - 1)) for c in ("lang", "term")))
    return np.concatenate([[0], np.flatnonzero(unlike.to_numpy(zero_copy_only=False)) + 1, [n]])


def summed(batch: pa.RecordBatch, bounds: np.ndarray) -> pa.RecordBatch:
    """One leaf for each group of rows, its counters in the order of sources."""
    n, names, counts = counters(batch)
    sources = names.dictionary_encode()
    order = pc.array_sort_indices(sources.dictionary).to_numpy()
    place = np.argsort(order)
    group = np.repeat(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)), n)
    key = group * len(order) + place[sources.indices.to_numpy()]
    at = np.argsort(key, kind="stable")
    key = key[at]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    key, counts = key[starts], np.add.reduceat(counts[at], starts)
    first = pa.array(bounds[:-1])
    documents = np.add.reduceat(batch["documents"].to_numpy(), bounds[:-1])
    return leaf_batch(batch["term"].take(first), batch["lang"].take(first), documents, np.searchsorted(key, np.arange(len(bounds)) * len(order)), sources.dictionary.take(pa.array(order[key % len(order)])), counts)


def whole(batches: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Merged leaves of ordered rows; those of fewer than ``least`` documents go."""

    def enough(batch: pa.RecordBatch, bounds: np.ndarray) -> Iterator[pa.RecordBatch]:
        good = np.add.reduceat(batch["documents"].to_numpy(), bounds[:-1]) >= least
        if good.any():
            rows = np.diff(bounds)
            yield summed(batch.filter(pa.array(np.repeat(good, rows))), ends(rows[good]))

    held: list[pa.RecordBatch] = []  # the last group may go on in the next batch
    for batch in batches:
        if batch.num_rows:
            held.append(pa.RecordBatch.from_arrays([batch[c] for c in _COLUMNS], _COLUMNS))
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            bounds = changes(batch)
            last = int(bounds[-2])
            if last:
                yield from enough(batch.slice(0, last), bounds[:-1])
            held = [summed(batch.slice(last), bounds[-2:] - last)]
    for batch in held:
        yield from enough(batch, np.array([0, 1]))


def merged(leaves: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """Leaves of all tasks, merged by ranges of prefixes; terms of fewer than ``least`` documents go."""

    @acyclic
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[str, Trie] = {}
        held: list[pa.RecordBatch] = []
        rows = 0

        def out() -> Iterator[pa.RecordBatch]:
            every = pa.Table.from_batches(held)
            for lang, trie in tries.items():
                for part in batched(trie.leaves(), ROWS):
                    for found in every.take(pa.array([row for _, row in part])).combine_chunks().to_batches():
                        n, names, counts = counters(found)
                        at = pa.array(ends(n), pa.int32())
                        names = pa.ListArray.from_arrays(at, names.cast(pa.large_string()).cast(pa.string()))
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), found["term"], names, pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], ["lang", "term", "sources", "counts"])

        # rows are ordered: later terms are larger
        for batch in whole(batches, least):
            for row, (term, lang) in enumerate(zip(batch["term"].to_pylist(), batch["lang"].to_pylist(), strict=True), rows):
                tries.setdefault(lang, Trie()).put(term, row)
            held.append(batch)
            rows += batch.num_rows
            if rows >= HELD or sum(b.nbytes for b in held) >= HELD_BYTES:
                yield from out()
                tries, held, rows = {}, [], 0
        if held:
            yield from out()

    # the term first: its head is what the sort compares
    return leaves.repartitionByRange("term", "lang").sortWithinPartitions("term", "lang").mapInArrow(work, _MERGED)


def shares(count: np.ndarray, of: np.ndarray) -> np.ndarray:
    """p of counts in groups of ``of`` = N + V; exact also where the product exceeds 64 bits."""
    if not count.size or count.max() < 9_000_000_000:
        return 1 + SCALE * (count + 1) // of
    return (1 + SCALE * (count.astype(object) + 1) // of.astype(object)).astype(np.int64)


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class Audit:
    """Pair sums and candidates of one language in one task; ``of``: N + V of each source, ``whole``: of the language."""

    def __init__(self, names: list[str], of: np.ndarray, whole: int):
        self.names, self.of, self.whole = names, of, np.int64(whole)
        self.number = {s: i for i, s in enumerate(names)}
        self.absent = shares(np.zeros(len(names), np.int64), of)
        self.profiles: Counter = Counter()
        self.best: dict[int, list[tuple[int, bytes]]] = {}
        self.block = max(1, CELLS // len(names))
        # of all pairs, where they fit into one block
        self.sums = np.zeros((len(names), len(names)), np.int64) if len(names) <= self.block else None

    def add(self, terms: list[bytes], sources: list[list[str]], counts: list[list[int]]) -> None:
        """Leaves in the order of bytes, after those that came before."""
        numbers = [tuple(map(self.number.__getitem__, s)) for s in sources]
        self.profiles.update(zip(numbers, map(tuple, counts), strict=True))
        source, row = _flat(numbers)
        count, _ = _flat(counts)
        total = np.array([sum(r) for r in counts], np.int64)
        p = shares(count, self.of[source])
        q = shares(total, np.full(len(total), self.whole))[row]
        above = np.flatnonzero(p > q)
        source, value, row = source[above], divergence(p[above], q[above]), row[above]
        order = np.lexsort((row, -value, source))
        source, value, row = source[order], value[order], row[order]
        starts = np.flatnonzero(np.diff(source, prepend=-1)).tolist()
        for a, b in pairwise([*starts, len(source)]):
            new = [(int(v), terms[r]) for v, r in zip(value[a : min(b, a + RANKS)], row[a : min(b, a + RANKS)], strict=True)]
            known = self.best.get(int(source[a]), [])
            self.best[int(source[a])] = sorted(known + new, key=lambda x: -x[0])[:RANKS]  # stable: earlier terms first

    def pairs(self, last: bool = True) -> Iterator[tuple[str, str, int]]:
        """Partial sums of pairs; before the ``last`` call only those that cannot be kept."""
        n, known = len(self.names), list(self.profiles.items())
        self.profiles.clear()
        for a in range(0, n, self.block):
            sums = self.sums if self.sums is not None else np.zeros((min(self.block, n - a), n), np.int64)
            at = 0
            while at < len(known):
                end, cells = at, 0
                while end < len(known) and (end == at or cells < CELLS // 8):
                    cells += len(known[end][0][0]) * n
                    end += 1
                self._correct(sums, a, known[at:end])
                at = end
            if last or self.sums is None:
                for i, j in zip(*map(np.ndarray.tolist, np.nonzero(sums)), strict=True):
                    if i + a != j:
                        yield self.names[i + a], self.names[j], int(sums[i, j])

    def _correct(self, sums: np.ndarray, first: int, known: list) -> None:
        """What these leaves add to the pairs of sources from ``first``, beyond terms that both lack."""
        source, row = _flat([z for (z, _), _ in known])
        count, _ = _flat([c for (_, c), _ in known])
        times = np.array([t for _, t in known], np.int64)[row][:, None]
        present = shares(count, self.of[source])
        p = np.tile(self.absent, (len(known), 1))
        p[row, source] = present
        lacks = np.ones(p.shape, bool)
        lacks[row, source] = False
        some = np.flatnonzero((source >= first) & (source < first + len(sums)))
        mine = source[some]
        np.add.at(sums, mine - first, times[some] * (divergence(present[some][:, None], p[row[some]]) - divergence(self.absent[mine][:, None], self.absent)))
        absent = self.absent[first : first + len(sums)]
        more = times * lacks[row, first : first + len(sums)] * (divergence(absent, present[:, None]) - divergence(absent, self.absent[source][:, None]))
        np.add.at(sums.T, source, more)


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    """All values, and the number of the list that each one is in."""
    return np.array([x for r in lists for x in r], np.int64), np.repeat(np.arange(len(lists)), [len(r) for r in lists])


_FOUND = "lang string, source string, part string, item string, value long"
_ARROW = pa.schema([(c, pa.string()) for c in ("lang", "source", "part", "item")] + [("value", pa.int64())])


def audited(kept: DataFrame, totals: DataFrame) -> DataFrame:
    """Partial pair sums and candidates of every task; ``totals``: one row for each language."""
    @acyclic
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, audit = None, None

        def out(last: bool = True) -> Iterator[pa.RecordBatch]:
            pairs = ((lang, a, "pair", b, v) for a, b, v in audit.pairs(last))
            terms = ((lang, audit.names[i], "term", t.decode(), v) for i, best in audit.best.items() for v, t in best) if last else ()
            for rows in batched(chain(pairs, terms), 20_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)

        for batch in batches:
            # runs of one language
            names = batch["lang"].to_pylist()
            at = 0
            while at < len(names):
                end = at
                while end < len(names) and names[end] == names[at]:
                    end += 1
                if names[at] != lang:
                    if audit:
                        yield from out()
                    lang = names[at]
                    groups, of, whole = (batch[c][at].as_py() for c in ("groups", "group_of", "lang_of"))
                    audit = Audit(groups, np.array(of, np.int64), whole)
                part = batch.slice(at, end - at)
                audit.add(*(part[c].to_pylist() for c in ("term", "sources", "counts")))
                at = end
                if len(audit.profiles) > PROFILES:
                    yield from out(last=False)
        if audit:
            yield from out()

    return kept.join(totals, "lang").select("lang", "term", "sources", "counts", "groups", "group_of", "lang_of").sortWithinPartitions("lang", "term").mapInArrow(work, _FOUND)


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, of (N + V of the group), lang_of (of the language), v (V) of every group of the documents."""
    groups = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    of_lang = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c)).alias("n"))
    of_group = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n_group"))
    v, zero = F.coalesce("v", F.lit(0)), F.lit(0)
    return groups.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").select(
        "lang", "source", (F.coalesce("n_group", zero) + v).alias("of"), (F.coalesce("n", zero) + v).alias("lang_of"), v.alias("v")
    )


def divergences(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part, item, value, rank: all other sources of the language, and the ``ranks`` (at most 200) most divergent terms.

    The result has a row for each pair of sources of a language, so its groups are few beside
    the documents; the totals of a language travel as one row.
    """
    kept = stored(merged(stored(counted(docs)), least))  # ranges are drawn from the stored leaves
    groups = stored(group_totals(docs, kept))
    totals = groups.where("v > 0").groupBy("lang", "lang_of").agg(F.sort_array(F.collect_list(F.struct("source", "of"))).alias("g"))
    totals = totals.select("lang", "lang_of", F.col("g.source").alias("groups"), F.col("g.of").alias("group_of"))
    found = stored(audited(kept, totals))

    def p_absent(of: str):
        return 1 + F.expr(f"{SCALE}L div {of}")

    a, b = (groups.select("lang", F.col("source").alias(n), F.col("of").alias(f"{n}_of"), "v") for n in ("source", "item"))
    pairs = a.join(b.drop("v"), "lang").where("source != item")  # the result's own rows
    p = pairs.withColumns({"p": F.when(F.col("v") > 0, p_absent("source_of")).otherwise(0), "q": F.when(F.col("v") > 0, p_absent("item_of")).otherwise(1)})
    base = p.select("lang", "source", "item", F.when(F.col("v") > 0, F.col("v") * F.expr("((p - q) * (p - q)) div q")).otherwise(0).alias("value"))
    pair = base.unionByName(found.where("part = 'pair'").drop("part")).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = pair.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    term = found.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")
