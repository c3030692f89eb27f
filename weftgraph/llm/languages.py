"""Language ID with string kernels.

The kernel of two texts counts the n-grams (bytes of the lower-cased text,
n = 1 to 3, blended) present in both, normalised by those in each; no n-gram is left
out or shares a place with another one.  Landmarks (Nystroem) turn it into features;
kernel ridge regression is fitted one language against the rest; a batch of texts is
scored by two matrix products, its n-grams by those of the landmarks and the kernel by the weights.

The fit reads at most about ``PER_LANGUAGE`` texts of each language, and about ``TEXTS`` of
all, but the ``FEWEST`` first by a hash of the id of each language, so that none is lost; scoring reads every whole text.
The outputs of the ridge only rank languages (their sum is about constant), so a text is recognised by another
figure: the share of its distinct letter trigrams that some learned text has.
Cases: a text that is null, has no letter or has too few known trigrams is ``und``
with score 0; one too short for a trigram is recognised; null languages are not
learned; without any language to learn all texts are ``und``; very long texts are read
whole; repeated rows score alike; of two languages that tie the first by name is taken; a null doc_id is
held out; extra columns are left alone, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, slices, stored
from .shingles import utf8

PER_LANGUAGE, TEXTS, FEWEST, LANDMARKS, RIDGE = 400, 8000, 4, 160, 1e-2
#: Longer texts (bytes) are learned from only where a language has no ``FEWEST`` others; all texts are scored.
LONGEST = 1 << 18
#: Texts whose n-grams are laid out at once; rows of a table that may be broadcast.
LAID_OUT, BROADCAST = 64, 20_000
#: A text with a smaller share of known trigrams is of no learned language.  Of the texts of the tables of 0.1 and 0.5 GB
#: none and 3 of 256,410 have less (short ones, two with a key of letters); random letters (360 texts) had at most 0.67, sentences of five unlearned languages 0.62.
LEAST_KNOWN = 0.7
#: A language with few texts to learn asks for less: this much under the 1 % quantile of its texts, each against the others.
SLACK = 0.1

_LOWER = np.arange(256, dtype=np.int64)
_LOWER[65:91] += 32
_LOWER[9:14] = 32


#: Codes of n-grams: bytes as digits 1 to 256 of a number.
_GRAMS = 257**3


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])[: len(x)]]


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of the distinct n-grams of each text, in order; none reaches over the end of its text."""
    data, offsets = utf8(column)
    digit = _LOWER[data] + 1
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    found, code = [], np.zeros(len(digit), np.int64)
    for n in (1, 2, 3):
        code = code[: max(0, len(digit) - n + 1)] * 257 + digit[n - 1 :]
        same = text[n - 1 :] == text[: len(code)]
        found.append((text[: len(code)] * _GRAMS + code)[same])
    every = distinct(np.concatenate(found))
    return every // _GRAMS, every % _GRAMS


#: Letters: a to z and the bytes of all others; 0 is what stands between words.
_LETTER = np.zeros(256, np.int64)
_LETTER[97:123] = np.arange(1, 27)
_LETTER[65:91] = np.arange(1, 27)
_LETTER[128:] = np.arange(27, 155)
_CODES = 155**3


def letter_trigrams(column: pa.Array) -> np.ndarray:
    """text * _CODES + code of the distinct trigrams of each text, with two letters at least.

    Words with digits in them (keys, hashes) count only in a text that has no others.
    """
    data, offsets = utf8(column)
    letter = _LETTER[data]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    digit = (data >= 48) & (data < 58)
    word = (letter > 0) | digit
    run = np.cumsum(np.append(False, (word[1:] != word[:-1]) | (text[1:] != text[:-1]))[: len(data)])
    plain = np.where((np.bincount(run, digit) > 0)[run], 0, letter) if len(data) else letter
    same = text[2:] == text[:-2]

    def use(x: np.ndarray) -> np.ndarray:
        return same & ((x[:-2] > 0).astype(np.int8) + (x[1:-1] > 0) + (x[2:] > 0) > 1)

    bare = np.bincount(text[:-2][use(plain)], minlength=len(column)) == 0
    x = np.where(bare[text], letter, plain)
    return distinct((text[:-2] * _CODES + (x[:-2] * 155 + x[1:-1]) * 155 + x[2:])[use(x)])


def share_in(known: np.ndarray, trigrams: np.ndarray, n: int) -> np.ndarray:
    """The share of known ones (packed bits) among the trigrams of each of n texts; 1 if there are none."""
    text = trigrams // _CODES
    have = np.bincount(text, minlength=n)
    code = trigrams % _CODES
    hit = known[code >> 3] >> (7 - (code & 7)) & 1
    return np.where(have > 0, np.bincount(text, hit, n) / np.maximum(have, 1), 1.0)


@dataclass
class Landmarks:
    """The distinct n-grams of the landmark texts, and which landmark has which (1, else 0), each landmark of length 1."""

    codes: np.ndarray
    has: np.ndarray

    @classmethod
    def of(cls, column: pa.Array) -> Landmarks:
        text, code = grams(column)
        codes = np.unique(code)
        has = np.zeros((len(column), len(codes)), np.float32)
        has[text, np.searchsorted(codes, code)] = 1
        return cls(codes, has / np.maximum(np.sqrt(has.sum(1, keepdims=True)), 1))

    def kernel(self, column: pa.Array) -> np.ndarray:
        """The kernel of each text with each landmark."""
        out = np.zeros((len(column), len(self.has)), np.float32)
        for at in range(0, len(column), LAID_OUT):
            part = column.slice(at, LAID_OUT)
            text, code = grams(part)
            length = np.sqrt(np.maximum(np.bincount(text, minlength=len(part)), 1))
            place = np.minimum(np.searchsorted(self.codes, code), max(0, len(self.codes) - 1))
            shared = self.codes[place] == code if len(self.codes) else np.zeros(len(code), bool)
            laid = np.zeros((len(part), len(self.codes)), np.float32)
            laid[text[shared], place[shared]] = 1
            out[at : at + LAID_OUT] = (laid @ self.has.T) / length[:, None]
        return out


@dataclass
class Model:
    languages: list[str]
    landmarks: Landmarks
    weights: np.ndarray
    known: np.ndarray  # trigrams of learned texts, packed bits
    floor: np.ndarray  # share of known trigrams that a text of each language needs at least

    def scores(self, column: pa.Array) -> np.ndarray:
        return self.landmarks.kernel(column) @ self.weights[:-1] + self.weights[-1]

    def recognised(self, column: pa.Array, best: np.ndarray) -> np.ndarray:
        return share_in(self.known, letter_trigrams(column), len(column)) >= self.floor[best]


def recognition(texts: list[str], which: np.ndarray, n_languages: int, least: float = LEAST_KNOWN) -> tuple[np.ndarray, np.ndarray]:
    """(trigrams of the texts, packed bits; share of them that a text of each language needs)."""
    found = [letter_trigrams(pa.array(texts[i : i + 64], pa.large_string())) for i in range(0, len(texts), 64)]
    count = np.zeros(_CODES, np.int64)
    for trigrams in found:
        np.add.at(count, trigrams % _CODES, 1)
    others = np.concatenate([share_in(np.packbits(count > 1), t, min(64, len(texts) - 64 * k)) for k, t in enumerate(found)])
    floor = [min(least, np.quantile(others[which == k], 0.01) - SLACK) for k in range(n_languages)]
    return np.packbits(count > 0), np.array(floor)


def fit(texts: list[str], languages: list[str], least: float = LEAST_KNOWN) -> Model:
    names = sorted(set(languages))
    number = {name: k for k, name in enumerate(names)}
    which = np.array([number[x] for x in languages], np.int64)
    column = pa.array(texts, pa.large_string())
    marks = np.concatenate([np.flatnonzero(which == k)[: max(1, LANDMARKS // len(names))] for k in range(len(names))])
    landmarks = Landmarks.of(column.take(pa.array(marks)))
    values, vectors = np.linalg.eigh((landmarks.has @ landmarks.has.T).astype(np.float64))
    kept = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, kept] / np.sqrt(values[kept])  # K_mm to the power -1/2
    phi = np.hstack([landmarks.kernel(column).astype(np.float64) @ root, np.ones((len(texts), 1))])
    y = np.where(which[:, None] == np.arange(len(names)), 1.0, -1.0)
    # each language weighs the same
    w = 1 / np.bincount(which, minlength=len(names))[which]
    beta = np.linalg.solve(phi.T @ (phi * w[:, None]) + RIDGE * np.eye(phi.shape[1]), phi.T @ (y * w[:, None]))
    return Model(names, landmarks, np.vstack([root @ beta[:-1], beta[-1:]]).astype(np.float32), *recognition(texts, which, len(names), least))


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE, texts: int = TEXTS) -> DataFrame:
    """doc_id, lang, text of about ``per_language`` texts of each language that are not held out, and about ``texts`` of all, but ``FEWEST`` of each.

    Each id has a place from 0 to 1 by its hash, and a text over ``LONGEST`` bytes one from 1 to 2. A language takes the places
    up to its share, or up to its ``FEWEST``-th one if that is more.  One row is taken of each id.
    """
    place = F.pmod(F.xxhash64(F.lit(9), "doc_id"), F.lit(1_000_003)) / 1_000_003.0 + F.when(F.octet_length("text") > LONGEST, 1).otherwise(0)
    known = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "lang", "text", place.alias("place"))
    places = stored(known.select("lang", "place"))
    counts = places.groupBy("lang").agg(F.count("*").alias("n"))
    languages = counts.count()
    wanted = F.lit(max(FEWEST, min(per_language, texts // max(1, languages))))
    # a task hands on no more than the first places of a language
    first = places.withColumn("r", F.dense_rank().over(Window.partitionBy("lang").orderBy("place"))).where(F.col("r") <= FEWEST)
    limits = counts.join(first.groupBy("lang").agg(F.max("place").alias("least")), "lang")
    limits = limits.select("lang", F.greatest(F.least(wanted / F.col("n"), F.lit(1.0)), "least").alias("limit"))
    # beside a small table of languages no text is shuffled
    limits = F.broadcast(limits) if languages <= BROADCAST else limits
    drawn = known.join(limits, "lang").where("place <= limit")
    one = F.min(F.struct(F.xxhash64("text").alias("h"), "lang", "text"))
    return drawn.groupBy("doc_id").agg(one.alias("x")).select("doc_id", "x.lang", "x.text")


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; the model (a few MB) is broadcast."""
    spark = docs.sparkSession
    rows = training_rows(docs, per_language).orderBy("doc_id", F.xxhash64("text")).collect()
    model = spark.sparkContext.broadcast(fit([r.text for r in rows], [r.lang for r in rows]) if rows else None)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 18):
            names, score = predict(model.value, batch["text"], batch["letters"])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(score, pa.float64())], schema=schema)

    return docs.select(
        F.col("doc_id").cast("long"), held_out().alias("held_out"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    ).mapInArrow(work, "doc_id long, held_out boolean, lang_pred string, score double")


def predict(model: Model | None, column: pa.Array, letters: pa.Array) -> tuple[list[str], np.ndarray]:
    letters = letters.to_numpy(zero_copy_only=False)
    if model is None:
        return ["und"] * len(column), np.zeros(len(column))
    scores = model.scores(column)
    best = scores.argmax(1)
    fine = letters & model.recognised(column, best)
    names = [model.languages[b] if ok else "und" for b, ok in zip(best, fine, strict=True)]
    return names, np.where(fine, np.clip((scores.max(1).astype(float) + 1) / 2, 0, 1), 0)


def accepted(docs: DataFrame, least: float = LEAST_KNOWN) -> DataFrame:
    """The documents whose language is recognised, with all their columns as they were."""
    spark = docs.sparkSession
    rows = training_rows(docs).orderBy("doc_id", F.xxhash64("text")).collect()
    model = spark.sparkContext.broadcast(fit([r.text for r in rows], [r.lang for r in rows], least) if rows else None)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=1 << 18):
            names, _ = predict(model.value, batch["text"].fill_null(""), batch["__letters"])
            keep = pa.array([n != "und" for n in names], pa.bool_())
            yield batch.drop_columns("__letters").filter(keep)

    return docs.withColumn("__letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))).mapInArrow(work, docs.schema)
