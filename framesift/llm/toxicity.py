"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is (noisy-or).

p(document) = 1 - product over sentences of (1 - sigmoid(bias + sum of the weights of its words)). Only document labels
are known; the gradient of the noisy-or gives each sentence its share. A word's weight is the sum over its features:
the word, its beginnings of 3 to 6 characters and its last 3.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framesift.llm.common import kept_in_process, table

TRAIN_DOCS, TRAIN_BYTES = 8_000, 100 << 20  # at most so many labelled documents, and bytes of their texts, are learned from
FEATURES = 6_000  # at most so many weights
THRESHOLD = 0.3
SENTENCE = r"[^.!?\n。！？]+[.!?\n。！？]*|[.!?\n。！？]+"
WORD = r"[^\W_]+"


def features(word: str) -> list[str]:
    n = len(word)
    return [f"={word}", *[f"^{word[:k]}" for k in range(3, 7) if n > k], *([f"{word[-3:]}$"] if n > 3 else [])]


def learn(texts: list[str], labels: list[int], most: int = FEATURES, rounds: int = 300) -> dict:
    """{"bias": float, "weights": {feature: float}}. Without documents of both labels: the constant share of label 1."""
    y = np.array(labels, dtype=float)
    if not len(y) or y.min() == y.max():
        return {"bias": None, "share": float(y.mean()) if len(y) else 0.0, "weights": {}}
    split, words = re.compile(SENTENCE).findall, re.compile(WORD).findall
    known: dict[str, list[str]] = {}
    one, all_ = Counter(), Counter()
    for text, label in zip(texts, labels, strict=True):
        seen = set()
        for w in set(words(text.lower())):
            seen.update(features(w))
        all_.update(seen)
        if label:
            one.update(seen)
    n1, n = y.sum(), len(y)

    def strength(f: str) -> float:  # of the association with the label, in standard deviations
        a, b = one[f], all_[f]
        expected = b * n1 / n
        return (a - expected) / np.sqrt(expected * (1 - n1 / n) + 0.5)

    chosen = sorted((f for f, c in all_.items() if c >= 4 and abs(strength(f)) > 2.5), key=lambda f: (-abs(strength(f)), f))[:most]
    index = {f: k for k, f in enumerate(chosen)}
    rows, cols, of = array("q"), array("q"), array("q")
    for d, text in enumerate(texts):
        for s in split(text):
            for w in words(s.lower()):
                ids = known.get(w)
                if ids is None:
                    ids = known[w] = [index[f] for f in features(w) if f in index]
                rows.extend([len(of)] * len(ids))
                cols.extend(ids)
            of.append(d)
    rows, cols, of = np.array(rows, dtype=np.int64), np.array(cols, dtype=np.int64), np.array(of, dtype=np.int64)
    w, b = np.zeros(len(chosen)), -4.0 - np.log(max(1, len(of) / n))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        z = np.clip(b + np.bincount(rows, weights=w[cols], minlength=len(of)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        none = np.exp(np.bincount(of, weights=np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(y)))
        doc = np.clip(1 - none, 1e-9, 1 - 1e-9)
        # d loss / d z of a sentence: p for label 0, -p * none / (1 - none) for label 1
        g = p * np.where(y == 1, -(1 - doc) / doc, 1.0)[of] / n
        grad = np.append(np.bincount(cols, weights=g[rows], minlength=len(w)) + 3e-5 * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return {"bias": float(b), "share": float(n1 / n), "weights": dict(zip(chosen, w.tolist(), strict=True))}


class Scorer:
    MOST, LONG = 300_000, 48

    def __init__(self, model: dict):
        self.model, self.known = model, {}
        self.split, self.find = re.compile(SENTENCE).finditer, re.compile(WORD).findall

    def word(self, w: str) -> float:
        x = self.known.get(w)
        if x is None:
            weights = self.model["weights"]
            x = sum(weights.get(f, 0.0) for f in features(w))
            if len(w) <= self.LONG:
                if len(self.known) >= self.MOST:
                    self.known.clear()
                self.known[w] = x
        return x

    def sentences(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """Spans of the sentences, and their scores."""
        bias, spans, z = self.model["bias"], [], []
        for m in self.split(text):
            spans.append(m.span())
            z.append(bias + sum(map(self.word, self.find(m[0].lower()))))
        return spans, 1 / (1 + np.exp(-np.clip(np.array(z), -30, 30)))

    def score(self, text: str) -> tuple[float, list[tuple[int, int]]]:
        """The document's score and the sentences that alone would reach the threshold, worst first."""
        if self.model["bias"] is None:
            return self.model["share"], []
        spans, p = self.sentences(text)
        if not spans:
            return 0.0, []
        bad = [k for k in np.argsort(-p, kind="stable").tolist() if p[k] >= THRESHOLD]
        return float(-np.expm1(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())), [spans[k] for k in bad]


def train(docs: DataFrame, labels: DataFrame, most_docs: int = TRAIN_DOCS) -> dict:
    """A model from the labelled documents that are not held out: those with the smallest hashes of their ids, at most
    most_docs, and of these as many as have TRAIN_BYTES together, so that only ids are sorted and the texts fetched are
    bounded. Null texts count as empty; null labels and ids are left out; a document with several labels has the largest."""
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labels = labels.where(~held_out()).join(docs.select("doc_id"), "doc_id", "left_semi")
    chosen = labels.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(most_docs)
    x = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    so_far = Window.orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # of most_docs rows
    x = x.dropDuplicates(["doc_id"]).withColumn("bytes", F.sum(F.octet_length("text").cast("long")).over(so_far)).where(F.col("bytes") <= TRAIN_BYTES)
    got = sorted(x.select("doc_id", "text", "toxic").collect())
    return learn([r[1] for r in got], [int(r[2]) for r in got])


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))


def _digest(model: dict) -> str:
    return hashlib.sha256(repr((model["bias"], model["share"], sorted(model["weights"].items()))).encode()).hexdigest()


def scored(docs: DataFrame, model: dict) -> DataFrame:
    """docs(doc_id, text) to (doc_id, held_out, score, predicted, offending), a row for each row, repeated ones too.

    offending lists the code point spans of the sentences that alone reach the threshold, worst first. Null and empty
    texts have no sentences and score 0 (the constant share, if the model had nothing to learn from); a null doc_id
    counts as held out. No rows give no rows.
    """
    shared, digest = docs.sparkSession.sparkContext.broadcast(model), _digest(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept_in_process("toxicity", digest, lambda: Scorer(shared.value))
        for batch in batches:
            got = [scorer.score(t or "") for t in batch.column(1).to_pylist()]
            spans = pa.array([[{"start": a, "stop": b} for a, b in x[1]] for x in got], pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([x[0] for x in got], pa.float64()), spans], names=["doc_id", "held_out", "score", "offending"])

    out = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out().alias("held_out"))
    out = out.mapInArrow(run, "doc_id long, held_out boolean, score double, offending array<struct<start:int,stop:int>>")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")


def not_toxic(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores under THRESHOLD. No join: each row is judged in place."""
    shared, digest, least, at = docs.sparkSession.sparkContext.broadcast(model), _digest(model), THRESHOLD, docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = kept_in_process("toxicity", digest, lambda: Scorer(shared.value))
        for batch in batches:
            yield batch.filter(pa.array([scorer.score(t or "")[0] < least for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those that are not held out: see train() and scored()."""
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, table(spark, sf_dir, "labels")))
