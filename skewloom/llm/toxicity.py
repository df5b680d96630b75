"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a probability of being toxic, from the weights of its words; the
document's probability is their noisy-or, 1 - product of (1 - p). Only documents have labels: the weights are fitted by
gradient descent on the noisy-or, which finds by itself the sentences that explain a toxic document. Applied to a text,
the sentence probabilities then show the offending sentences.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import in_fold, map_batches, out_of_fold, release

SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 7)
BUCKETS = 1 << 18
CACHE = 200_000


def features(word: str) -> list[int]:
    """Hash buckets of a lower-case word and of its beginnings."""
    from xxhash import xxh3_64_intdigest as digest

    parts = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]
    return [digest(part.encode()) % BUCKETS for part in parts]


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences with a word, in code points."""
    found, start = [], 0
    for gap in SENTENCE.finditer(text):
        found.append((start, gap.start()))
        start = gap.end()
    found.append((start, len(text)))
    return [(a, b) for a, b in found if WORD.search(text, a, b)]


def sentence_words(text: str, start: int, end: int) -> set[str]:
    """The distinct words of a sentence in lower case. Each word is lowered by itself, so that offsets stay those of the text."""
    return {w.lower() for w in set(WORD.findall(text, start, end))}


def sample(documents: DataFrame, labels: DataFrame, limit: int) -> list[tuple[str, int]]:
    """(text, toxic) of at most `limit` labelled documents, those whose ids hash smallest.

    A document is toxic if any of its labels is 1. Null labels, ids and texts are left out, and of rows that share an
    id only one is taken.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64(F.col("doc_id").cast("string"))
    known = known.withColumn("order", order).orderBy("order", "doc_id").limit(limit)
    # At most `limit` rows of two numbers, whatever the input.
    rows = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").filter(F.col("text").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"), F.first("order").alias("order"))
    return [(r["text"], r["toxic"]) for r in sorted(rows.toLocalIterator(), key=lambda r: (r["order"], r["doc_id"]))]


def fit(rows: list[tuple[str, int]], steps: int = 120, rate: float = 0.1, sparsity: float = 3e-4) -> tuple[np.ndarray, float]:
    """Weights of the feature buckets and the bias, from labelled texts, by gradient steps on the noisy-or likelihood.

    Features of few documents are left out, and each step draws the weights towards zero, so that few are not zero.
    Without rows, or with one kind of label only, the weights are zero and the bias gives the share of toxic rows.
    """
    vocabulary: dict[str, int] = {}
    words, sentence_of, document_of = array("i"), array("i"), array("i")
    labels = np.array([label for _, label in rows], float)
    for number, (text, _) in enumerate(rows):
        for start, end in sentences(text):
            found = {vocabulary.setdefault(w, len(vocabulary)) for w in sorted(sentence_words(text, start, end))}
            words.extend(found)
            sentence_of.extend([len(document_of)] * len(found))
            document_of.append(number)
    weights, bias = np.zeros(BUCKETS, np.float32), -3.0
    if not document_of or labels.min() == labels.max():
        share = labels.mean() if len(labels) else 0.0
        return weights, float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    words, sentence_of, document_of = (np.array(x, np.int32) for x in (words, sentence_of, document_of))
    lists = [features(word) for word in vocabulary]
    sizes = [len(x) for x in lists]
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), sizes)
    flat = np.concatenate([np.array(x) for x in lists])
    pairs = np.unique(words.astype(np.int64) * len(rows) + document_of[sentence_of])
    documents_with = np.bincount(flat, np.bincount(pairs // len(rows), minlength=len(lists))[owner], BUCKETS)
    frequent = documents_with[flat] >= max(3, len(rows) // 400)
    owner = owner[frequent]
    used, local = np.unique(flat[frequent], return_inverse=True)
    theta, first, second = (np.zeros(len(used) + 1) for _ in range(3))
    theta[-1] = bias
    for step in range(1, steps + 1):
        of_word = np.bincount(owner, theta[local], len(lists))
        z = np.bincount(sentence_of, of_word[words], len(document_of)) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.bincount(document_of, np.log1p(-np.minimum(p, 1 - 1e-12)), len(rows))  # log P(no toxic sentence)
        toxic = np.maximum(-np.expm1(clean), 1e-9)
        per_document = np.where(labels > 0, -np.exp(clean) / toxic, 1.0)
        g = per_document[document_of] * p / len(rows)
        of_word = np.bincount(words, g[sentence_of], len(lists))
        gradient = np.append(np.bincount(local, of_word[owner], len(used)), g.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        pace = rate / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        theta -= pace * first / (1 - 0.9**step)
        shrunk = np.maximum(np.abs(theta[:-1]) - np.minimum(pace[:-1] * sparsity, rate), 0)
        theta[:-1] = np.sign(theta[:-1]) * shrunk
    weights[used] = theta[:-1]
    bias = float(theta[-1])
    del words, sentence_of, document_of, pairs, owner, flat, g, p, z, of_word, per_document, clean, toxic
    release()
    return weights, bias


class SentenceScorer:
    """Sentence log odds from the weights; words seen before are kept, up to a bound."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.known = weights, bias, {}

    def word(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            found = self.known[word] = float(self.weights[features(word)].sum())
        return found

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability and (start, end, probability) of its sentences."""
        clean, found = 0.0, []
        for start, end in sentences(text):
            z = self.bias + sum(map(self.word, sentence_words(text, start, end)))
            p = 1 / (1 + np.exp(-min(max(z, -30.0), 30.0)))
            clean += np.log1p(-min(p, 1 - 1e-12))
            found.append((start, end, float(p)))
        return float(-np.expm1(clean)), found


def score(
    documents: DataFrame, weights: np.ndarray, bias: float, threshold: float = 0.5, sentence_threshold: float = 0.5, keep_text: bool = False
) -> DataFrame:
    """All columns of `documents`, text only if `keep_text`, with score, predicted and the spans of the offending sentences.

    score: the noisy-or of the sentences, 0 for a text without a word or null. predicted: 1 from `threshold` on. spans:
    start and end (code points) of the sentences whose own probability reaches `sentence_threshold`. Columns of these
    names are replaced.
    """
    results = ("score", "predicted", "spans") if keep_text else ("text", "score", "predicted", "spans")
    kept = [c for c in documents.columns if c not in results]
    sent = kept if keep_text else [*kept, "text"]
    at = sent.index("text")
    schema = ", ".join(
        [f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in kept]
        + ["score double", "predicted int", "spans array<struct<start: int, end: int, score: double>>"]
    )
    packed = (weights.astype(np.float32).tobytes(), bias)  # 1 MB, whatever the input
    shared = documents.sparkSession.sparkContext.broadcast(packed)

    def run(batch: pa.RecordBatch, scorer: SentenceScorer) -> dict:
        scores, spans = [], []
        for text in batch.column(at).to_pylist():
            total, found = scorer.score(text) if text else (0.0, [])
            scores.append(total)
            spans.append([{"start": a, "end": b, "score": p} for a, b, p in found if p >= sentence_threshold])
        columns = {c: batch.column(i) for i, c in enumerate(kept)}
        return {**columns, "score": scores, "predicted": [int(s >= threshold) for s in scores], "spans": spans}

    def scorer() -> SentenceScorer:
        weights, bias = shared.value
        return SentenceScorer(np.frombuffer(weights, np.float32), bias)

    return map_batches(documents.select(*sent), run, schema, setup=scorer)


def toxicity(documents: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0, limit: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted, spans of each row of `documents` (doc_id, text).

    Learned from at most `limit` labelled rows of `labels` (doc_id, toxic) that are not held out; held_out: crc32 of the
    id modulo `parts` is `part`. Repeated rows are scored alike; rows without an id are not held out.
    """
    weights, bias = fit(sample(documents, labels.filter(out_of_fold(F.col("doc_id"), parts, part)), limit))
    rows = documents.select("doc_id", in_fold(F.col("doc_id"), parts, part).alias("held_out"), "text")
    return score(rows, weights, bias)
