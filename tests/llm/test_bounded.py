"""Minimum bin slack, centroid clustering and source divergence against brute force."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import DATA, SCHEMA, labels, odd, tokens  # noqa: F401
from weftgraph.llm import centroids, queries, slack, tries
from weftgraph.llm.common import table


def test_the_fullest_combination_is_that_of_all_subsets():
    rng = random.Random(7)
    for _ in range(200):
        size = rng.randint(5, 40)
        lengths = [rng.randint(1, size) for _ in range(rng.randint(1, 9))]
        counts = dict(collections.Counter(lengths))
        longest = max(lengths)
        rest = list(lengths)
        rest.remove(longest)
        best = max(longest + sum(c) for r in range(len(rest) + 1) for c in itertools.combinations(rest, r) if longest + sum(c) <= size)
        chosen = slack.fullest(counts, sorted(counts, reverse=True), size)
        assert sum(n * c for n, c in chosen.items()) == best and chosen[longest] >= 1 and all(counts[n] >= c for n, c in chosen.items())
        # used again while its lengths last, a combination stays the fullest: one bin at a time gives the same fills
        fills, left = [], dict(counts)
        while any(left.values()):
            one = slack.fullest(left, sorted((n for n in left if left[n]), reverse=True), size)
            fills.append(sum(n * c for n, c in one.items()))
            for n, c in one.items():
                left[n] -= c
        assert fills == [sum(n * c for n, c in chosen.items()) for times, chosen in slack.combinations(counts, size) for _ in range(times)]


def test_the_plan_does_not_grow_with_the_pieces():
    rng = np.random.default_rng(3)
    lengths, counts = np.unique(np.clip(rng.lognormal(5, 1.2, 50_000).astype(int) + 1, 1, 4096), return_counts=True)
    small, large = (slack.intervals({int(n): int(c) * k for n, c in zip(lengths, counts, strict=True)}) for k in (1, 1_000_000))
    most = sum(2 + math.log2(4096 / n) for n in range(1, 4097))
    assert len({(r[2], r[3]) for r in large.tolist()}) <= most and len(large) < 4 * len(small)


def check_packed(rows, texts, end_id=1, size=4096):
    code = tokens("word_bpe_49k.json")
    ids = {i: np.array(code(t or "") + [end_id], "<u4") for i, t in texts.items()}
    by_document, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_document[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_document) == set(ids)
    for i, found in by_document.items():
        found.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length) for r in found] == [(k, at, min(size, len(ids[i]) - at)) for k, at in enumerate(range(0, len(ids[i]), size))]
        assert all(r.ids_crc32 == zlib.crc32(ids[i][r.start : r.start + r.length].tobytes()) for r in found)
    for found in by_sequence.values():
        at = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
    return len(by_sequence), -(-sum(map(len, ids.values())) // size)


def test_bin_slack(spark, odd):  # noqa: F811
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall())
    used, least = check_packed(queries.op11_bin_slack(spark, DATA).collect(), texts)
    assert used <= math.ceil(1.02 * least)
    unlike = odd.dropDuplicates(["doc_id"])
    check_packed(slack.pack_fullest(unlike, queries.vocabulary("word_bpe_49k.json")).collect(), dict(unlike.select("doc_id", "text").collect()))
    rows = slack.pack_fullest(odd.repartition(3), queries.vocabulary("word_bpe_49k.json")).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows) and sum(r.doc_id == 3 for r in rows) == 2
    assert slack.pack_fullest(odd.limit(0), queries.vocabulary("word_bpe_49k.json")).count() == 0


def test_bins_of_many_tasks_with_one_common_length(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("a b c")).otherwise(F.expr("repeat('word ', cast(id as int))")).alias("text")).repartition(13)
    rows = slack.pack_fullest(docs, queries.vocabulary("word_bpe_49k.json")).collect()
    used, least = check_packed(rows, {r.doc_id: r.text for r in docs.collect()})
    assert used <= least + 1


def clusters(vectors, k=40, rounds=5):
    """In Python's integers, comparing all."""
    kept = [(i, [math.floor(256 * float(x)) if abs(x) < 1e300 else 256 * int(x) for x in v]) for i, v in vectors if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest()))
    found = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(found))
    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[near(v)[1]].append(v)
        found = [[sum(c) // len(groups[j]) for c in zip(*groups[j], strict=True)] if j in groups else found[j] for j in range(len(found))]
    last = [(i, *near(v)) for i, v in kept]
    sums = collections.Counter()
    for _, d, j in last:
        sums[j] += d
    cap = (1 << 63) - 1
    return sorted((i, j, min(cap, d), min(cap, sums[j]), min(cap, sum(sums.values())), hashlib.sha256(",".join(map(str, found[j])).encode()).hexdigest()) for i, d, j in last)


def taken(rows):
    return sorted((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in rows)


def test_clusters(spark):
    rows = table(spark, DATA, "embeddings").collect()
    assert taken(queries.op12_centroids(spark, DATA).collect()) == clusters([(r.vec_id, r.embedding) for r in rows])
    # the screen spares work and changes nothing; vectors of unlike length show it
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=64) * np.repeat(rng.exponential(size=16), 4)).tolist(), "x") for i in range(600)]
    made = centroids.cluster(spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string"), k=20).collect()
    assert taken(made) == clusters([r[:2] for r in rows], k=20)
    assert sum(r.n_exact for r in made) < 0.9 * 20 * len(made)


def test_clusters_of_odd_vectors(spark):
    one = [float(x) for x in range(64)]
    cases = [one, one, None, one[:63], [*one, 1.0], [], [*one[:63], None], [*one[:63], float("nan")], [*one[:63], float("-inf")], [0.0] * 64, [-0.001] * 64, [1e7] + [0.5] * 63, [3e6] * 64, [-1e308] * 64, [1e308] * 64, [2e7] * 64, [524288.0] * 64, [-524288.5] * 64]
    rows = [(i, v) for i, v in enumerate(cases)]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, vector int, norms string")
    for k in (3, 40):
        assert taken(centroids.cluster(frame, k=k).collect()) == clusters(rows, k=k)
    assert centroids.cluster(spark.createDataFrame([(None, one), (None, one), (4, one)], "vec_id long, embedding array<double>")).count() == 3
    assert centroids.cluster(frame.limit(0)).count() == 0


def test_trie():
    rng = random.Random(2)
    words = ["".join(rng.choices("abé日", k=rng.randint(1, 6))).encode() for _ in range(3000)]
    trie, want = tries.Trie(), collections.Counter(words)
    trie.add(want, "s")
    trie.add({words[0]: 5}, "t")
    found = list(trie.leaves())
    assert [t for t, _ in found] == sorted(want) and all(leaf["s"] == want[t] for t, leaf in found) and trie.leaf(words[0])["t"] == 5


def divergences(docs, least=3):
    rows = [tuple("" if x is None else x for x in r) for r in docs]
    terms = [re.findall("[a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[0])) for r in rows]
    out = []
    for lang in {r[1] for r in rows}:
        mine = [(t, r[2]) for t, r in zip(terms, rows, strict=True) if r[1] == lang]
        df = collections.Counter(w for t, _ in mine for w in set(t))
        kept = [w for w in df if df[w] >= least]
        sources = sorted({s for _, s in mine})
        count = {s: collections.Counter(w for t, x in mine if x == s for w in t if df[w] >= least) for s in sources}
        every = sum(count.values(), collections.Counter())
        share = lambda c, w, kept=kept: 1 + 10**9 * (c[w] + 1) // (c.total() + len(kept))
        f = lambda p, q: (p - q) ** 2 // q
        for s in sources:
            pairs = [(sum(f(share(count[s], w), share(count[o], w)) for w in kept), o) for o in sources if o != s]
            found = [(f(share(count[s], w), share(every, w)), w) for w in kept if count[s][w] and share(count[s], w) > share(every, w)]
            for part, items in (("pair", pairs), ("term", found)):
                items = sorted(items, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, o, v, n) for n, (v, o) in enumerate(items, 1) if part == "pair" or n <= 200]
    return sorted(out)


def test_divergence(spark, odd, monkeypatch):  # noqa: F811
    names = ("text", "lang", "source")
    docs = table(spark, DATA, "documents")
    got = sorted(map(tuple, queries.op13_divergence(spark, DATA).collect()))
    assert got == divergences(docs.select(*names).collect())
    rows = [(t, lang, s, 1, 2) for t in ("The thé the THE", "a the É é", None, "", "...", "日本 a b c", "x" * 100_000 + " b") for lang in ("en", None, "") for s in ("b", "a", None, "日")]
    rows += [("no kept term", "it", "only", 0, 0), (None, "xx", "p", 0, 0), ("", "xx", "q", 0, 0), *rows[:3]]
    frame = spark.createDataFrame(rows, "text string, lang string, source string, term int, value int").repartition(5)
    want = divergences([r[:3] for r in rows])
    assert sorted(map(tuple, tries.divergences(frame).collect())) == want
    assert {(r[0], r[1]) for r in want if r[4] == 0 and r[2] == "pair"} >= {("xx", "p"), ("xx", "q")}
    assert sorted(map(tuple, tries.divergences(odd).collect())) == divergences(odd.select(*names).collect())
    assert tries.divergences(frame.limit(0)).count() == 0
    # many windows in a task, and terms that some of them have in one document
    monkeypatch.setattr(tries, "COUNTERS", 40)
    assert sorted(map(tuple, tries.divergences(frame).collect())) == want


def test_blocks_of_sources_give_the_same_sums():
    rng = random.Random(4)
    names = [f"s{i}" for i in range(11)]
    leaves = [(f"t{k:03}".encode(), sorted(rng.sample(names, rng.randint(1, 11)))) for k in range(300)]
    counts = [[rng.randint(1, 50) for _ in s] for _, s in leaves]
    of = np.array([sum(c[s.index(n)] for (_, s), c in zip(leaves, counts, strict=True) if n in s) + 300 for n in names])

    def sums(block):
        audit, out = tries.Audit(names, of, int(sum(map(sum, counts))) + 300), collections.Counter()
        if block:
            audit.block, audit.sums = block, None
        for at in range(0, 300, 90):
            audit.add([t for t, _ in leaves[at : at + 90]], [s for _, s in leaves[at : at + 90]], counts[at : at + 90])
            for a, b, v in audit.pairs(last=False):
                out[a, b] += v
        for a, b, v in audit.pairs():
            out[a, b] += v
        return {k: v for k, v in out.items() if v}

    assert sums(None) == sums(3) == sums(1)


def test_shares_beyond_64_bits():
    count = np.array([0, 5, 10**13], np.int64)
    assert tries.shares(count, np.full(3, 4 * 10**13)).tolist() == [1 + 10**9 * (int(c) + 1) // (4 * 10**13) for c in count]


@pytest.mark.parametrize("name", ["op12_centroids", "op13_divergence"])
def test_same_as_sql(spark, name):
    for t in ("documents", "embeddings"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, DATA), duckdb.sql(queries.ORACLE_SQL[name])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_leaves_merge_across_batches():
    rng = random.Random(6)
    want, rows = collections.defaultdict(collections.Counter), []
    for _ in range(600):
        key = rng.choice("abcde") * rng.randint(1, 3), rng.choice(["en", ""])
        sources = rng.sample(["", "s", "日本", "x\0y"], rng.randint(1, 4))
        counts = [rng.randint(1, 1 << 40) for _ in sources]
        want[key].update(dict(zip(sources, counts, strict=True)))
        one = tries.leaf_batch(pa.array([key[0].encode()]), pa.array([key[1]]), np.array([1]), np.array([0, len(sources)]), pa.array([s.encode() for s in sources], pa.large_binary()), np.array(counts))
        rows.append((key, one))
    rows.sort(key=lambda r: r[0])
    for size in (1, 7, 600):
        batches = [pa.Table.from_batches([b for _, b in rows[i : i + size]]).combine_chunks().to_batches()[0] for i in range(0, 600, size)]
        got = {}
        for batch in tries.whole(batches, 3):
            n, names, counts = tries.counters(batch)
            at = tries.ends(n)
            for i, key in enumerate(zip(batch["term"].to_pylist(), batch["lang"].to_pylist(), strict=True)):
                part = slice(at[i], at[i + 1])
                got[key[0].decode(), key[1]] = {k.decode(): int(v) for k, v in zip(names.to_pylist()[part], counts[part], strict=True)}
        few = collections.Counter(k for k, _ in rows)
        assert got == {k: dict(v) for k, v in want.items() if few[k] >= 3}
