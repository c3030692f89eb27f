"""Toxic spans with a linear-chain conditional random field.

Labels exist for documents only, so tokens get theirs first: words and
runs of letters that occur in toxic training documents and (almost) nowhere else are
seeds, and the tokens of toxic documents that hold a seed are labelled toxic.
A two-state CRF is then trained on the labelled tokens (features: the word and its
letter runs, hashed).  Forward-backward marginals give each token's probability;
a document's score comes from a logistic fit on the sum and the largest of them,
and tokens with a marginal of one half or more are the offending offsets.

The fit reads at most about ``PER_CLASS`` documents of each label, by a hash of
the id; scoring reads every whole text, very long ones too.  Cases: null or empty text scores as a text without
any toxic token; without labels of both kinds every score is 0; of several labels of a doc_id
the largest counts, of several texts of a doc_id the first in order is learned; repeated rows
score alike; a null doc_id is held out; extra columns are left alone, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, slices
from .shingles import mix, powers

PER_CLASS, THRESHOLD, DIMENSIONS = 1200, 0.3, 1 << 20
ROUNDS, SEGMENT = 40, 256
_TOKEN = re.compile(r"[^\W\d_]+")


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, hashed feature) of each word's runs of 4 and 5 bytes, ends marked, and of the word itself."""
    marked = [f"\x02{w}\x03".encode() for w in words]
    sizes = np.array(list(map(len, marked)), np.int64)
    data = mix(np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64) + np.uint64(77))
    owner = np.repeat(np.arange(len(words)), sizes)
    begin = np.cumsum(sizes) - sizes
    power, _ = powers(int(sizes.max(initial=1)))
    owners, hashes = [np.arange(len(words))], [np.add.reduceat(data * power[np.arange(len(data)) - begin[owner]], begin) if len(words) else np.zeros(0, np.uint64)]
    for n in (4, 5):
        m = max(0, len(data) - n + 1)
        h = np.zeros(m, np.uint64)
        for k in range(n):
            h = h * np.uint64(0x100000001B3) + data[k : k + m]
        same = owner[:m] == owner[len(data) - m :] if m else np.zeros(0, bool)
        owners.append(owner[:m][same])
        hashes.append(h[same] + np.uint64(n))
    return np.concatenate(owners), (mix(np.concatenate(hashes)) % np.uint64(DIMENSIONS)).astype(np.int64)


def marginals(emission: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """P(toxic) of each token by forward-backward, over sequences that lie one behind another."""
    forward, q, _ = forward_backward(emission, lengths, trans)
    return forward * q / (1 + forward * q)


def expected_steps(emission: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each token, and how many steps of each kind [from, to] the model expects."""
    forward, q, odds = forward_backward(emission, lengths, trans)
    (a, b), (c, d) = np.exp(trans)
    before = np.zeros(len(emission))  # odds of the token before; a start counts as clean
    before[1:] = forward[:-1]
    before[np.cumsum(lengths) - lengths] = 0
    here = odds * q
    total = a + c * before + (b + d * before) * here
    steps = [[(a / total).sum(), (b * here / total).sum()], [(c * before / total).sum(), (d * before * here / total).sum()]]
    return forward * q / (1 + forward * q), np.array(steps)


def forward_backward(emission: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each token: forward odds and backward ratio of toxic against clean, and its own odds.

    ``emission``: score of toxic against clean; ``trans``: scores [from, to], start as from clean.
    All sequences step together, the longer ones to the end.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(longest), "left")  # sequences longer than t
    (a, b), (c, d) = np.exp(trans)
    forward = np.empty(len(emission))
    backward = np.ones(len(emission))
    # odds of toxic against clean; alpha_t = e^emission * (b + d r) / (a + c r)
    odds = np.exp(np.clip(emission, -30, 30))
    r = np.zeros(len(sizes))
    for t in range(longest):
        k = alive[t]
        at = starts[:k] + t
        r = odds[at] * (b + d * r[:k]) / (a + c * r[:k])
        forward[at] = r
    # q = beta(toxic) / beta(clean)
    q = np.ones(len(sizes))
    for t in range(longest - 2, -1, -1):
        k = alive[t + 1]
        at = starts[:k] + t
        o = odds[at + 1] * q[:k]
        q[:k] = (c + d * o) / (a + b * o)
        backward[at] = q[:k]
    return forward, backward, odds


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    trans: np.ndarray
    document: np.ndarray  # intercept, weight of log(1 + sum), of the largest

    def emissions(self, words: list[str]) -> np.ndarray:
        owner, feature = codes(words)
        return np.bincount(owner, self.weights[feature], len(words)) + self.bias

    def scores(self, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-_summary(p, lengths) @ self.document))


def _summary(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of each sequence: 1, log of one and the summed odds above 0.05, largest marginal."""
    out = np.zeros((len(lengths), 3))
    out[:, 0] = 1
    some = np.flatnonzero(lengths)
    if len(some):
        at = (np.cumsum(lengths) - lengths)[some]
        out[some, 1] = np.log1p(np.add.reduceat(np.where(p > 0.05, p, 0), at))
        out[some, 2] = np.maximum.reduceat(p, at)
    return out


def seeds(counts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Features of toxic documents and next to no clean ones, in more of them than chance explains.

    ``counts``: clean and toxic documents of each feature.  With a share s of toxic
    documents, a feature without meaning is in n toxic documents only with
    probability s**n; n must make that rare among all features.
    """
    n_features = max(2, int((counts.sum(0) > 0).sum()))
    share = min(toxic.mean(), 1 - 1e-6)
    least = max(3, np.ceil(np.log(0.01 / n_features) / np.log(share)))
    ratio = max(1, (toxic == 0).sum()) / max(1, toxic.sum())
    return (counts[1] >= least) & (counts[1] * ratio >= 25 * (counts[0] + 0.2))


def fit(texts: list[str], toxic: np.ndarray) -> Model:
    tokens = [[w.lower() for w in _TOKEN.findall(t)] for t in texts]
    vocabulary: dict[str, int] = {}
    flat = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for t in tokens for w in t), np.int32)
    lengths = np.array([len(t) for t in tokens], np.int64)
    del tokens
    of, feature = codes(list(vocabulary))
    of, feature = of.astype(np.int32), feature.astype(np.int32)
    n_words = len(vocabulary)
    by_word = np.argsort(of, kind="stable")
    ends = np.searchsorted(of[by_word], np.arange(n_words + 1))
    counts = np.zeros((2, DIMENSIONS), np.int32)
    start = 0
    for n, bad in zip(lengths.tolist(), toxic, strict=True):
        word = np.unique(flat[start : start + n])
        start += n
        own = [feature[by_word[ends[w] : ends[w + 1]]] for w in word.tolist()]
        if own:
            counts[int(bad), np.unique(np.concatenate(own))] += 1
    chosen = seeds(counts, toxic)
    seeded = np.bincount(of, chosen[feature], n_words) > 0
    y = seeded[flat] & np.repeat(toxic.astype(bool), lengths)
    # long documents are trained as segments
    cut = np.concatenate([[min(SEGMENT, n - i) for i in range(0, n, SEGMENT)] for n in lengths.tolist() if n]).astype(np.int64) if len(flat) else np.zeros(0, np.int64)
    weights, bias, trans = np.zeros(DIMENSIONS), -4.0, np.zeros((2, 2))
    label = y.astype(np.int64)
    before = np.concatenate([[0], label[:-1]])[: len(label)]
    before[np.cumsum(cut) - cut] = 0
    seen = np.bincount(2 * before + label, minlength=4).reshape(2, 2)
    square = [np.zeros(DIMENSIONS), 0.0, np.zeros((2, 2))]
    for _ in range(ROUNDS if len(flat) else 0):
        emission = np.bincount(of, weights[feature], n_words)[flat] + bias
        p, steps = expected_steps(emission, cut, trans)
        # gradient of the log-likelihood: empirical less expected counts
        gap = np.bincount(flat, y - p, n_words)
        gradient = np.bincount(feature, gap[of], DIMENSIONS) - 0.01 * weights
        square[0] += gradient**2
        weights += 0.5 * gradient / np.sqrt(square[0] + 1e-3)
        square[1] += gap.sum() ** 2
        bias += 0.5 * gap.sum() / np.sqrt(square[1] + 1e-3)
        gradient = seen - steps - 0.01 * trans
        square[2] += gradient**2
        trans = np.clip(trans + 0.1 * gradient / np.sqrt(square[2] + 1e-3), -3, 3)
    model = Model(weights, bias, trans, np.zeros(3))
    emission = np.bincount(of, weights[feature], n_words)[flat] + bias if len(flat) else np.zeros(0)
    x = _summary(marginals(emission, lengths, trans), lengths)
    beta = np.zeros(3)
    for _ in range(25):  # logistic fit by Newton steps
        q = 1 / (1 + np.exp(-x @ beta))
        hess = x.T @ (x * (q * (1 - q))[:, None]) + 0.05 * np.eye(3)
        beta += np.linalg.solve(hess, x.T @ (toxic - q) - 0.05 * beta)
    model.document = beta
    return model


class Tagger:
    """Scores batches of texts; word emissions are remembered up to a bound."""

    def __init__(self, model: Model, most: int = 300_000):
        self.model, self.most = model, most
        self.known: dict[str, float] = {}

    def _emissions(self, words: list[str]) -> np.ndarray:
        got = list(map(self.known.get, words))
        if None in got:
            if len(self.known) > self.most:
                self.known.clear()
                got = [None] * len(words)
            new = list({w for w, v in zip(words, got, strict=True) if v is None})
            self.known.update(zip(new, self.model.emissions([w.lower() for w in new]).tolist(), strict=True))
            got = list(map(self.known.__getitem__, words))
        return np.array(got, float)

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        words = list(map(_TOKEN.findall, texts))
        lengths = np.array(list(map(len, words)), np.int64)
        flat = [w for ws in words for w in ws]
        return (marginals(self._emissions(flat), lengths, self.model.trans) if flat else np.zeros(0)), lengths

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
        p, lengths = self.marginals(texts)
        ends = np.cumsum(lengths)
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(p >= 0.5), "right")).tolist():
            own = p[ends[i] - lengths[i] : ends[i]] >= 0.5
            spans[i] = [m.span() for m, bad in zip(_TOKEN.finditer(texts[i]), own, strict=True) if bad]
        return self.model.scores(p, lengths), spans


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """About ``per_class`` documents of each label that are not held out; the ids, ``4 * per_class`` at most, are broadcast."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = known.groupBy("toxic").count()
    drawn = F.pmod(F.xxhash64(F.lit(4), "doc_id"), F.lit(1_000_003)) / 1_000_003.0
    ids = known.join(F.broadcast(counts), "toxic").where(drawn < per_class / F.col("count")).select("doc_id", "toxic")
    ids = F.broadcast(ids.limit(4 * per_class))
    # rows that repeat a doc_id are one text
    rows = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(ids, "doc_id")
    return rows.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model | None:
    rows = training_rows(docs, labels, per_class).orderBy("doc_id", F.xxhash64("text")).collect()
    toxic = np.array([r.toxic for r in rows], float)
    return fit([r.text for r in rows], toxic) if 0 < toxic.sum() < len(rows) else None


_ARROW = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("spans", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, spans (code-point offsets of toxic tokens) of every document."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag = Tagger(model.value) if model.value else None
        for batch in slices(batches, limit=4 << 20, rows=1 << 16):
            n = batch.num_rows
            scores, spans = tag(batch["text"].to_pylist()) if tag else (np.zeros(n), [[]] * n)
            spans = [[{"begin": a, "end": b} for a, b in s] for s in spans]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32)), pa.array(spans, _ARROW.field("spans").type)], schema=_ARROW)

    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(work, "doc_id long, held_out boolean, score double, predicted int, spans array<struct<begin:int,end:int>>")


def clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns as they were."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag = Tagger(model.value) if model.value else None
        for batch in slices(batches, limit=4 << 20, rows=1 << 16):
            yield batch.filter(pa.array(tag(batch["text"].fill_null("").to_pylist())[0] < threshold)) if tag else batch

    return docs.mapInArrow(work, docs.schema)
