"""Toxicity by multiple-instance learning.

A document is a bag of sentences; only the document has a label.  Each
sentence gets a probability from the words it holds (logistic), and the
document's is their noisy-or: it is toxic unless every sentence is clean.
A word is known by itself and by its beginnings, so inflected forms that the
sample lacks are still told.
The gradient of the bag's likelihood teaches the words' weights, so the
sentences that made a bag toxic can be told afterwards.

The model is fitted on a bounded sample of labelled documents
(``MAX_SAMPLE``, those with the smallest hash of their id); scoring covers
every document.

Defined cases: a null or empty text is one empty sentence and gets the
score of the bias alone; without labels of both kinds the model has no features
and a bias from the share of toxic labels; null labels and null ids teach
nothing; repeated rows get equal scores; any length of text is scored whole;
other columns pass through, those whose names clash with the new ones give
way.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from velolake.llm.common import extended, slices

MAX_SAMPLE = 4000  # labelled documents that the model is fitted on
MAX_FEATURES = 4000  # words and word beginnings that the model may weigh
LEAST_DOCUMENTS = 3  # one is weighed if so many sampled documents hold it
BEGINNINGS = range(4, 9)  # letters
WORDS_KEPT = 200_000  # entries of the table of weighed words, per worker
STEPS, RATE, DECAY = 200, 0.1, 1e-2
THRESHOLD = 0.3
OFFENDING = 0.5  # a sentence from here on is reported

SENTENCE = re.compile(r"[.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """The word (with an end mark) and its beginnings."""
    return [word + "$", *(word[:k] for k in BEGINNINGS if k < len(word))]


@dataclass
class Model:
    bias: float = -6.0
    weights: dict[str, float] = field(default_factory=dict)
    known: dict[str, float] = field(default_factory=dict, repr=False, compare=False)

    def weight(self, word: str) -> float:
        """Sum of the weights of a word's features."""
        got = self.known.get(word)
        if got is None:
            if len(self.known) >= WORDS_KEPT:
                self.known.clear()
            get = self.weights.get
            got = self.known[word] = sum(get(f, 0.0) for f in features(word))
        return got

    def sentences(self, text: str) -> tuple[float, list[tuple[str, float]]]:
        """The text's probability and its sentences' (those with words that
        the model knows; the others have the bias alone)."""
        low = text.lower()
        known = {w for w in set(WORD.findall(low)) if self.weight(w)}
        parts = [s for s in SENTENCE.split(low) if s.strip()] or [""]
        clean, told = 0.0, []
        if known:
            for s in parts:
                hit = known.intersection(WORD.findall(s))
                if hit:
                    z = self.bias + sum(self.weight(w) for w in sorted(hit))
                    clean += _softplus(z)
                    told.append((s.strip(), float(np.exp(-np.logaddexp(0.0, -z)))))
        clean += (len(parts) - len(told)) * _softplus(self.bias)
        return -float(np.expm1(-clean)), told


def _softplus(z: float) -> float:
    return float(np.logaddexp(0.0, z))


def _bag(text: str) -> list[list[str]]:
    """Features of the distinct words of each sentence."""
    return [[f for w in sorted(set(WORD.findall(s))) for f in features(w)] for s in SENTENCE.split((text or "").lower()) if s.strip()] or [[]]


def fit(rows: list[tuple[str, int]]) -> Model:
    """Fit on (text, label) rows by Adam steps on the bags' likelihood."""
    rows = [(x, y) for x, y in rows if y in (0, 1)]
    toxic = sum(y for _, y in rows)
    if not toxic or toxic == len(rows):
        share = min(max(toxic / len(rows), 1e-3), 1 - 1e-3) if rows else 1e-3
        return Model(bias=float(np.log(share / (1 - share))))
    bags = [_bag(x) for x, _ in rows]
    y = np.array([v for _, v in rows], float)
    held: list[Counter] = [Counter(), Counter()]
    for bag, v in zip(bags, y):
        held[int(v)].update(set().union(*bag))
    n1, n0 = toxic, len(rows) - toxic

    def weight_of_evidence(w: str) -> float:
        a, b = (held[1][w] + 0.5) / (n1 + 1), (held[0][w] + 0.5) / (n0 + 1)
        pooled = (held[1][w] + held[0][w] + 1) / (len(rows) + 2)
        return abs(a - b) / np.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0))

    words = [w for w in {*held[0], *held[1]} if held[0][w] + held[1][w] >= LEAST_DOCUMENTS]
    words = sorted(words, key=lambda w: (-weight_of_evidence(w), w))[:MAX_FEATURES]
    index = {w: k for k, w in enumerate(words)}
    doc, sent, feat, n = [], [], [], 0
    for d, bag in enumerate(bags):
        for s in bag:
            doc.append(d)
            known = [index[w] for w in s if w in index]
            sent += [n] * len(known)
            feat += known
            n += 1
    doc, sent, feat = np.array(doc), np.array(sent, np.int64), np.array(feat, np.int64)
    # start from half the log odds of each feature, so that one of several
    # words that come together is not left to the others
    odds = [np.log((held[1][f] + 0.5) / (n1 + 1)) - np.log((held[0][f] + 0.5) / (n0 + 1)) for f in words]
    w, b = 0.5 * np.array(odds), -np.log(n / toxic)
    first, second, at_b = np.zeros_like(w), np.zeros_like(w), [0.0, 0.0]
    for step in range(1, STEPS + 1):
        z = b + np.bincount(sent, w[feat], n)
        clean = np.bincount(doc, np.logaddexp(0, z), len(y))  # minus log of no toxic sentence
        slope = np.where(y > 0, -1 / np.expm1(np.maximum(clean, 1e-9)), 1.0)
        dz = slope[doc] / (1 + np.exp(-z)) / len(y)
        gw, gb = np.bincount(feat, dz[sent], len(w)), dz.sum()
        first, second = 0.9 * first + 0.1 * gw, 0.999 * second + 0.001 * gw**2
        at_b = [0.9 * at_b[0] + 0.1 * gb, 0.999 * at_b[1] + 0.001 * gb**2]
        c1, c2 = 1 - 0.9**step, 1 - 0.999**step
        w = w - RATE * ((first / c1) / (np.sqrt(second / c2) + 1e-4) + DECAY * w)
        b = b - RATE * (at_b[0] / c1) / (np.sqrt(at_b[1] / c2) + 1e-4)
    return Model(float(b), {t: float(v) for t, v in zip(words, w) if abs(v) > 0.05})


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def training_sample(documents: DataFrame, labels: DataFrame, most: int = MAX_SAMPLE) -> list[tuple[str, int]]:
    """A bounded sample of (text, label): rows that are not held out, by the
    hash of their id.  Only ids are sorted; texts are fetched for the chosen."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    teach = known.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
    chosen = F.broadcast(teach.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    rows = documents.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic", F.xxhash64("doc_id", "text").alias("o"))
    return [(r.text or "", r.toxic) for r in rows.orderBy("o").limit(most).collect()]


OFFENCE = StructType([StructField("sentence", StringType()), StructField("score", DoubleType())])
SCORED = StructType([StructField("score", DoubleType()), StructField("predicted", IntegerType()), StructField("offending", ArrayType(OFFENCE))])


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score``, ``predicted`` and the ``offending`` sentences."""
    kept, schema = extended(df, SCORED)
    source, places = df.columns.index(text), [df.columns.index(k) for k in kept]
    offence = pa.struct([("sentence", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = [model.sentences(x or "") for x in batch.column(source).to_pylist()]
            told = [[{"sentence": s, "score": p} for s, p in t if p >= OFFENDING] for _, t in got]
            scores = [p for p, _ in got]
            new = [pa.array(scores, pa.float64()), pa.array([int(p >= THRESHOLD) for p in scores], pa.int32()), pa.array(told, pa.list_(offence))]
            yield pa.RecordBatch.from_arrays([batch.column(p) for p in places] + new, names=schema.names)

    return df.mapInArrow(run, schema)


def digest(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: held out or not, score, prediction, offending sentences."""
    model = fit(training_sample(documents, labels))
    scored = score(documents.select("doc_id", "text"), model)
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted", F.size("offending").alias("n_offending"))
