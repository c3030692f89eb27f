"""The operators on Spark: odd rows, and brute force over the smallest tables."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weftgraph.llm import fingerprints, hnsw, languages, lexicon, licenses, minhash, packing, queries, rans, suffixes, toxicity
from weftgraph.llm.common import table
from weftgraph.llm.components import connected_components

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, key string, part int, letters boolean, component long"
PASSAGE = "this passage of a good many words is in several documents and so it should be found there "


@pytest.fixture(scope="module")
def odd(spark):
    text = [None, "", "...", "same text again and again here", "same text again and again here", "x" * 300_000, PASSAGE + "one", "two " + PASSAGE, "Größe naïve 日本 " * 9, "word " * 20_000, "  tabs\tand\n\nlines ", "MIT License"]
    rows = [(i, t, "en" if i % 2 else None, None, None, "k", 1, True, 0) for i, t in enumerate(text)]
    rows += [rows[3], (None, "no id at all", "en", "s", 3, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(0, 1, 1), (3, 1, None), (6, 0, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def corpus():
    return {i: t or "" for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{DATA}/documents.parquet'").fetchall()}


def tokens(name):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(queries.vocabulary(name))
    return lambda text: made.encode(text, add_special_tokens=False).ids


def test_token_file(spark, odd, corpus):
    code, start = tokens("byte_bpe_50k.json"), 0
    got = {r.doc_id: r for r in queries.op1_token_output(spark, DATA).collect()}
    for i in sorted(corpus):
        ids = np.array(code(corpus[i]) + [2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    rows = rans.token_file(odd, queries.vocabulary("byte_bpe_50k.json")).orderBy("start").collect()
    assert len(rows) == odd.count() and rows[0].doc_id is None and [r.n_tokens for r in rows if r.doc_id in (0, 1)] == [1, 1]
    assert rans.token_file(odd.limit(0), queries.vocabulary("byte_bpe_50k.json")).count() == 0


def test_packing(spark, odd, corpus):
    code = tokens("word_bpe_49k.json")
    for docs, texts in ((table(spark, DATA, "documents"), corpus), (odd.dropDuplicates(["doc_id"]), {r.doc_id: r.text or "" for r in odd.collect()})):
        rows = packing.pack(docs, queries.vocabulary("word_bpe_49k.json")).collect()
        by = collections.defaultdict(list)
        for r in rows:
            by[r.doc_id].append(r)
        assert set(by) == set(texts)
        for i, text in texts.items():
            ids, at = np.array([*code(text), 2], "<u4"), 0
            for r in sorted(by[i], key=lambda r: r.start):
                assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
        windows = collections.defaultdict(list)
        for r in rows:
            windows[r.sequence_id].append((r.offset, r.length))
        for pieces in windows.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 4096
    assert packing.pack(odd.limit(0), queries.vocabulary("word_bpe_49k.json")).count() == 0
    twice = odd.where("doc_id = 3")  # this row is there twice
    assert sorted((r.start, r.length) for r in packing.pack(twice, queries.vocabulary("word_bpe_49k.json")).collect()) == [(0, 7), (0, 7)]


def removed(texts):
    first = {}
    for i in sorted(texts):
        for p in range(len(texts[i]) - 49):
            first.setdefault(texts[i][p : p + 50], i)
    for i, x in texts.items():
        gone = bytearray(len(x))
        for p in range(len(x) - 49):
            if first[x[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        yield i, x, gone


def kept_bytes(texts):
    for i, x, gone in removed(texts):
        yield i, bytes(b for b, g in zip(x, gone, strict=True) if not g)


def repeats(texts):
    kept = dict(kept_bytes(texts))
    for i, x, gone in removed(texts):
        spans = sum(1 for k in range(len(x)) if gone[k] and not (k and gone[k - 1]))
        yield i, (len(x), sum(gone), spans, hashlib.sha256(kept[i]).hexdigest())


def test_repeats(spark, odd, corpus):
    small = odd.where("doc_id IS NOT NULL AND doc_id NOT IN (5, 9)").dropDuplicates(["doc_id"])
    for docs, texts in ((table(spark, DATA, "documents"), corpus), (small, {r.doc_id: r.text or "" for r in small.collect()})):
        got = {r.doc_id: tuple(r)[1:] for r in suffixes.remove_repeats(docs).collect()}
        assert got == dict(repeats({i: t.encode() for i, t in texts.items()}))
    assert suffixes.remove_repeats(odd).count() == odd.count()
    cut = {r.doc_id: r for r in suffixes.without_repeats(odd).collect()}
    assert cut[7].text == "two " and cut[7].n_chars == 4 and 4 in cut and 0 not in cut
    assert suffixes.without_repeats(odd).columns == odd.columns and suffixes.remove_repeats(odd.limit(0)).count() == 0


def test_windows_of_hot_minimizers_are_spread(spark, monkeypatch, corpus):
    rng = random.Random(7)
    line = "a line of over fifty bytes that all of the documents have somewhere in them"
    texts = {i: t for i, t in corpus.items() if i % 4 == 0} | {10_000 + i: "".join(rng.choices("abcd ", k=60)) + line[rng.randint(0, 8) :] + "".join(rng.choices("abcd ", k=60)) for i in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    groups = suffixes.stored(suffixes.gathered(docs), "none")

    def most_strings_of_a_bucket():
        strings = collections.Counter()
        shared = suffixes.shared_minimizers(groups, 64, 4)
        for r in suffixes.asked_strings(groups, shared, 64, 4).where("bucket >= 0").collect():
            strings[r.bucket] += int(np.frombuffer(suffixes.loosen(r.data), np.int64, 1)[0])
        return max(strings.values())

    together = most_strings_of_a_bucket()
    monkeypatch.setattr(suffixes, "HOT", 4)
    assert together - most_strings_of_a_bucket() >= 15  # the common line's strings have left its bucket
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.remove_repeats(docs).collect()}
    assert got == dict(repeats({i: t.encode() for i, t in texts.items()}))


def test_lexicon(spark, odd, corpus):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    for docs, texts in ((table(spark, DATA, "documents"), corpus), (odd, {r.doc_id: r.text or "" for r in odd.collect()})):
        coded = lexicon.encode(docs, queries.vocabulary("word_bpe_49k.json"), most=500)
        rows = coded.collect()
        assert len(rows) == docs.count()
        for r in rows:
            ids = plain.encode(texts[r.doc_id], add_special_tokens=False).ids
            assert (r.n_tokens, r.ids, r.decoded) == (len(ids), " ".join(map(str, ids)), plain.decode(ids, skip_special_tokens=False))
    assert {r.doc_id: r.decoded for r in lexicon.decode(coded, queries.vocabulary("word_bpe_49k.json")).collect()} == {r.doc_id: r.decoded for r in rows}
    assert lexicon.encode(odd.limit(0), queries.vocabulary("word_bpe_49k.json")).count() == 0


def bag(text):
    words = [w.lower() for w in re.findall(rb"[0-9A-Za-z_\x80-\xff]+", text.encode())]
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else collections.Counter()


def classes(texts):
    bags = {i: bag(t) for i, t in texts.items()}
    top = {i: i for i in texts}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    order = sorted(texts)
    for k, i in enumerate(order):
        for j in order[:k]:
            a, b = bags[i], bags[j]
            shared = sum((a & b).values())
            if texts[i] == texts[j] or shared >= 0.8 * (sum(a.values()) + sum(b.values()) - shared) > 0:
                x, y = find(i), find(j)
                top[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def test_near_duplicates(spark, odd, corpus):
    known = odd.where("doc_id IS NOT NULL")
    for docs, texts in ((table(spark, DATA, "documents"), corpus), (known, {r.doc_id: r.text or "" for r in known.collect()})):
        got = minhash.near_duplicates(docs)
        assert got.count() == docs.count()
        assert {r.doc_id: r.class_id for r in got.collect()} == classes(texts)
    kept = minhash.one_of_each(odd)
    assert kept.columns == odd.columns and 4 not in {r.doc_id for r in kept.collect()}
    assert minhash.near_duplicates(odd.limit(0)).count() == 0


def test_a_chain_of_near_copies_is_one_class(spark):
    words = [f"w{i}" for i in range(400)]
    texts = {}
    for k in range(12):
        texts[k] = " ".join(words)
        for p in range(k * 30, k * 30 + 6):
            words[p] = f"new{k}x{p}"
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()} == classes(texts)


def test_missed_links_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    texts = {i: " ".join(f"c{i % 5}w{j}" if j % 60 else f"u{i}n{j}" for j in range(300)) for i in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bags = minhash.bag_rows(docs)
    around = docs.select(F.lit(0).cast("long").alias("center"), F.col("doc_id").alias("node"), F.col("doc_id").alias("component"), F.lit(0).cast("long").alias("of"))
    links = minhash.missed_links(around, bags).union(minhash.verified(around.where("node > 0").select(F.col("center").alias("a"), F.col("node").alias("b")), bags))
    got = dict(connected_components(links).collect())
    assert got == {i: i % 5 for i in range(40)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (7, 7)]
    got = dict(connected_components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints(spark, odd, corpus):
    got = {r.doc_id: r for r in fingerprints.compare_edited(table(spark, DATA, "documents")).collect()}
    order = sorted(corpus, reverse=True)
    for k, i in enumerate(order):
        text, after = corpus[i], corpus[order[(k + 1) % len(order)]]
        m = len(text) // 3
        edited = text[: len(text) - m] + after[:m]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b = set(bag(text)), set(bag(edited))
        assert got[i].near_edited == pytest.approx(len(a & b) / len(a | b) if a | b else 1, abs=0.15)
        c = set(bag(after))
        assert got[i].near_next == pytest.approx(len(a & c) / len(a | c) if a | c else 1, abs=0.15)
        # the fingerprint is the sketch of the text alone, and likenesses come from the two fingerprints
        own, edit, then = (fingerprints.sketches([t])[0] for t in (text, edited, after))
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (fingerprints.to_text(own), fingerprints.to_text(edit))
        assert (got[i].near_edited, got[i].near_next) == (fingerprints.resemblance(own, edit), fingerprints.resemblance(own, then))
    rows = fingerprints.compare_edited(odd).collect()
    assert len(rows) == odd.count() and len({r.fingerprint for r in rows if r.doc_id in (3, 4)}) == 1
    assert fingerprints.compare_edited(odd.limit(0)).count() == 0
    lone = fingerprints.compare_edited(odd.where("doc_id = 6")).collect()
    assert len(lone) == 1 and lone[0].near_next == 1.0
    assert fingerprints.fingerprint(odd).count() == odd.count()


def test_vectors(spark):
    r = np.random.default_rng(5)
    base = r.normal(size=(30, 16))
    rows = [(i, (base[i % 30] + r.normal(size=16) * 0.15 * (i % 3)).tolist(), i % 2) for i in range(300)]
    rows += [(1000, None, 1), (1001, [0.0] * 16, 1), (1002, [float("nan")] * 16, 1), (1003, [None] * 16, 1), (1004, rows[0][1], None), (1005, rows[0][1], 0), (1006, [], 0), (1005, rows[0][1], 0)]
    got = {r.vec_id: r for r in hnsw.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), shard=64).collect()}
    good = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows[:300]} | {1005: np.array(rows[0][1]) / np.linalg.norm(rows[0][1])}
    label = {i: k for i, _, k in rows}
    links = {i: {j for j in good if j != i and label[i] == label[j] and good[i] @ good[j] >= 0.93} for i in good}
    assert len(got) == 307
    for i in good:
        assert got[i].n_links == len(links[i])
        seen, front = {i}, {i}
        while front:
            front = set().union(*(links[x] for x in front)) - seen
            seen |= front
        assert got[i].component_id == min(seen) and got[i].kept == (i == min(seen))
    assert all(got[i].n_links == 0 and got[i].component_id == i for i in (1000, 1001, 1002, 1003, 1004, 1006))
    assert hnsw.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_vectors_of_extreme_length(spark):
    rows = [(1, [1e200, 1e200], 0), (2, [1e200, 1.001e200], 0), (3, [1e-200, 1e-200], 0), (4, [1.0, 0.01], 0), (5, [0.01, 1.0], 0), (6, [5e-324, 0.0], 0), (None, [1.0, 1.0], 0)]
    rows += [(7, [-1.0, 0.0], 0), (7, [0.0, -1.0], 0), (7, [-1.0, 0.0], 0)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit(1)).withColumn("node", F.lit(2)).withColumn("x", F.lit(3))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in hnsw.near_vectors(docs).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 4: (1, 4, True), 6: (1, 4, False), 5: (0, 5, True), 7: (0, 7, True), None: (0, None, None)}


def test_graphs_find_the_links(spark):
    """Shards large enough for searches of a few of many nodes; links counted against brute force."""
    r = np.random.default_rng(9)
    base = r.normal(size=(500, 24))
    x = np.concatenate([base + r.normal(size=base.shape) * s for s in (0, 0.1, 0.2, 0.3, 0.35)])
    docs = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.93).sum(1) - 1
    seen = hnsw.recall(docs, shard=1300).first()
    # a quarter of the queries at most is audited, so most links come by the graphs alone
    assert seen.failed == 0 and seen.queries < 2 * len(x) and seen.found >= 0.99 * seen.links > 200
    got = {r.vec_id: r.n_links for r in hnsw.near_vectors(docs, shard=1300).collect()}
    assert sum(got.values()) >= 0.99 * links.sum() and all(got[i] <= n for i, n in enumerate(links.tolist()))


def test_classifiers_on_odd_rows(spark, odd, labels):
    got = languages.identify(odd).collect()
    assert len(got) == odd.count() and all(r.lang_pred == "und" for r in got if r.doc_id in (0, 1, 2)) and all(0 <= r.score <= 1 for r in got)
    kept = languages.accepted(odd)
    assert kept.columns == odd.columns and {0, 1, 2}.isdisjoint({r.doc_id for r in kept.collect()})
    assert languages.identify(odd.limit(0)).count() == 0 and languages.accepted(odd.limit(0)).count() == 0
    scored = toxicity.score(odd, labels).collect()
    assert len(scored) == odd.count() and all(r.predicted == int(r.score >= 0.3) for r in scored)
    assert toxicity.clean(odd, labels.limit(0)).count() == odd.count() and toxicity.score(odd.limit(0), labels).count() == 0


def test_classifiers_on_held_out_rows(spark):
    data = "/root/testdata/sf0.01"
    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    lang = languages.identify(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert lang > 0.93
    toxic = toxicity.score(docs, labels).where("held_out").join(labels, "doc_id")
    assert toxic.where("toxic = 0").agg(F.avg("predicted")).first()[0] < 0.1
    assert toxic.where("toxic = 1").agg(F.avg("predicted")).first()[0] > 0.5


def test_only_learned_languages_are_accepted(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    rng = random.Random(4)
    noise = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 10))) for _ in range(n)) for n in (5, 20, 300)]
    unlearned = ["Wszyscy ludzie rodza sie wolni i rowni pod wzgledem swej godnosci i swych praw.", "Все люди рождаются свободными и равными.", "人人生而自由,在尊严和权利上一律平等。", *noise]
    extra = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(unlearned)], docs.schema)
    known = {r.doc_id for r in docs.where(r"lang is not null and text rlike '\\p{L}'").select("doc_id").collect()}
    kept = {r.doc_id for r in languages.accepted(docs.unionByName(extra)).select("doc_id").collect()}
    assert known <= kept and not any(i < 0 for i in kept)


def test_licenses(spark, odd, corpus):
    got = {r.doc_id: r for r in licenses.scan_licenses(table(spark, DATA, "documents")).collect()}
    for i, text in corpus.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        places = [(k, name) for phrase, name in licenses.BASE.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(words), len(places), ",".join(sorted({n for _, n in places})))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
    rows = {r.doc_id: r for r in licenses.scan_licenses(odd).collect()}
    assert rows[11].base_labels == "mit" and rows[0].n_words == 0 and licenses.scan_licenses(odd.limit(0)).count() == 0


def test_pipeline(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = table(spark, DATA, "documents")
    columns = docs.columns
    ids = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == columns, name
        now = {r.doc_id for r in docs.collect()}
        assert now and (ids is None or now <= ids)
        ids = now
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert {r.doc_id for r in packed.collect()} == ids


def test_pipeline_is_its_stages_by_brute_force(spark, tmp_path, odd):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = table(spark, DATA, "documents")
    own = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).withColumn("doc_id", F.col("doc_id") + 10_000)
    docs.unionByName(own, allowMissingColumns=True).write.parquet(f"{tmp_path}/all/documents.parquet")
    table(spark, DATA, "labels").write.parquet(f"{tmp_path}/all/labels.parquet")
    docs, labels = table(spark, f"{tmp_path}/all", "documents"), table(spark, f"{tmp_path}/all", "labels")
    # the classifiers are held against brute force on their own; the stages must do what they say
    known = languages.identify(docs).where("lang_pred <> 'und'").select("doc_id")
    read = docs.join(known, "doc_id", "left_semi").select(docs.columns)
    clean = toxicity.score(read, labels).where("predicted = 0").select("doc_id")
    texts = {r.doc_id: r.text for r in read.join(clean, "doc_id", "left_semi").collect()}
    assert {10_000, 10_001, 10_002}.isdisjoint(texts) and len(texts) > 100
    texts = {i: texts[i] for i, of in classes(texts).items() if of == i}
    left = {i: kept.decode("utf-8", "ignore") for i, kept in kept_bytes({i: t.encode() for i, t in texts.items()})}
    code = tokens("word_bpe_49k.json")
    want = {i: np.array([*code(t), 2], "<u4") for i, t in left.items() if t}
    pieces = collections.defaultdict(list)
    for r in corpus_pipeline.run(spark, f"{tmp_path}/all").collect():
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(want)
    for i, ids in want.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)


def test_pipeline_on_odd_rows(spark, tmp_path, odd, labels):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    for name, docs in (("odd", odd), ("none", odd.limit(0))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    ids = {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()}
    assert 3 in ids and {0, 1, 2, 4}.isdisjoint(ids)
    empty = corpus_pipeline.run(spark, f"{tmp_path}/none")
    assert empty.count() == 0 and {"doc_id", "sequence_id", "ids_crc32"} <= set(empty.columns)


def test_many_languages_are_all_learned(spark):
    rng = random.Random(8)
    sets = [rng.sample("abcdefghijklmnopqrstuvwxyz", 4) for _ in range(1200)]
    # at least two learned texts of each language
    ids = {k: [i for i in range(k * 40, k * 40 + 40) if zlib.crc32(str(i).encode()) % 4 != 2][:3] for k in range(1200)}
    rows = [(i, " ".join("".join(rng.choices(sets[k], k=5)) for _ in range(40)), f"l{k:04}") for k in ids for i in ids[k]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("count", F.lit(1)).withColumn("n", F.lit(2)).withColumn("share", F.lit(3))
    learned = languages.training_rows(docs)
    assert learned.select("lang").distinct().count() == 1200 and learned.columns == ["doc_id", "lang", "text"]
    assert {r.lang_pred for r in languages.identify(docs).collect()} - {"und"} <= {f"l{k:04}" for k in range(1200)}
    assert languages.accepted(docs).columns == docs.columns


def test_no_language_is_lost_by_the_draw(spark):
    """3,000 languages of 40 documents each: all are learned, and held-out texts are told apart."""
    rng = random.Random(9)
    words = [["".join(rng.choices(rng.sample("abcdefghijklmnopqrstuvwxyz", 6), k=5)) for _ in range(12)] for _ in range(3000)]
    rows = [(i, " ".join(rng.choices(words[i // 40], k=30)), f"l{i // 40:04}") for i in range(120_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    learned = languages.training_rows(docs).collect()
    per = collections.Counter(r.lang for r in learned)
    assert len(per) == 3000 and min(per.values()) >= languages.FEWEST and len(learned) < 5 * 3000
    assert len({r.doc_id for r in learned}) == len(learned) and all(zlib.crc32(str(r.doc_id).encode()) % 4 != 2 for r in learned)
    learned.sort(key=lambda r: r.doc_id)
    model = languages.fit([r.text for r in learned], [r.lang for r in learned])
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2][::60]
    names, _ = languages.predict(model, pa.array([r[1] for r in held]), pa.array([True] * len(held)))
    assert sum(a == r[2] for a, r in zip(names, held, strict=True)) > 0.9 * len(held)


def test_copies_of_one_id_and_long_texts_stay_out_of_the_draw(spark):
    rows = [(i, "some words of a language " * 3, "en") for i in range(40)] + [(0, f"copy {k}", "en") for k in range(3000)]
    rows += [(100 + i, "lange Worte " * 40_000 + str(i), "de") for i in range(9)] + [(200 + i, "very long " * 50_000, "en") for i in range(5)]
    got = languages.training_rows(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    assert len({r.doc_id for r in got}) == len(got) and sum(r.lang == "de" for r in got) == languages.FEWEST
    assert all(r.doc_id < 40 for r in got if r.lang == "en")


def test_language_kernel_is_the_dense_one():
    texts = ["the cat sat on the mat", "le chat est sur le tapis", "", "a", "Größe der Katze", "the cat " * 300]
    raw = [t.encode().lower() for t in texts]
    sets = [{x[i : i + n] for n in (1, 2, 3) for i in range(len(x) - n + 1)} for x in raw]
    marks = languages.Landmarks.of(pa.array(texts))
    want = [[len(a & b) / max(1, len(a)) ** 0.5 / max(1, len(b)) ** 0.5 for b in sets] for a in sets]
    assert np.allclose(marks.kernel(pa.array(texts)), want, atol=1e-6)
    # the Nystroem features of all texts make the ridge that of the whole kernel
    names = ["en", "fr", "en", "en", "de", "en"]
    used = [0, 1, 4, 5]
    model = languages.fit([texts[i] for i in used], [names[i] for i in used])
    k = np.array(want)[np.ix_(used, used)]
    w = 1 / np.array([2, 1, 1, 2])
    y = np.where(np.array([names[i] for i in used])[:, None] == np.array(model.languages), 1.0, -1.0)
    # minimise sum w (y - K a - b)^2 + ridge (a' K a + b^2)
    wide = np.hstack([k, np.ones((4, 1))])
    penalty = np.zeros((5, 5))
    penalty[:4, :4], penalty[4, 4] = k, 1
    beta = np.linalg.lstsq(wide.T @ (wide * w[:, None]) + languages.RIDGE * penalty, wide.T @ (y * w[:, None]), rcond=None)[0]
    assert np.allclose(model.scores(pa.array([texts[i] for i in used])), wide @ beta, atol=1e-3)


def test_marginals_are_those_of_all_labellings():
    import itertools

    rng = np.random.default_rng(3)
    for n in (1, 2, 5):
        emission, trans = rng.normal(size=n), rng.normal(size=(2, 2))
        total, toxic = 0.0, np.zeros(n)
        for labels in itertools.product((0, 1), repeat=n):
            p = np.exp(sum(emission[i] * y for i, y in enumerate(labels)) + sum(trans[a, b] for a, b in zip((0, *labels[:-1]), labels, strict=True)))
            total += p
            toxic += p * np.array(labels)
        assert np.allclose(toxicity.marginals(emission, np.array([n]), trans), toxic / total)


def test_toxicity_is_the_model_on_each_text(spark, odd):
    data = "/root/testdata/sf0.001"
    docs, labels = table(spark, data, "documents"), table(spark, data, "labels")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in queries.op4_toxicity(spark, data).collect()}
    for r in docs.collect():
        words = re.findall(r"[^\W\d_]+", r.text or "")
        emission = model.emissions([w.lower() for w in words]) if words else np.zeros(0)
        p = toxicity.marginals(emission, np.array([len(words)]), model.trans) if words else np.zeros(0)
        x = np.array([1, np.log1p(p[p > 0.05].sum()), p.max(initial=0)])
        score = 1 / (1 + np.exp(-x @ model.document))
        g = got[r.doc_id]
        assert g.score == pytest.approx(score, abs=1e-9) and g.predicted == int(score >= 0.3) and g.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert len(g.spans) == (p >= 0.5).sum() and all(r.text[s.begin : s.end] in words for s in g.spans)


def test_licenses_are_those_of_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    want = con.sql(queries.ORACLE_SQL["op10_licenses"])
    got = queries.op10_licenses(spark, DATA)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
