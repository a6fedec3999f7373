"""Toxicity by multiple-instance learning: a document is toxic if at least one of its sentences is.

A sentence has a logistic score; a document's is the noisy-or of its sentences', 1 - prod(1 - s). Only documents are
labelled: the gradient of the document's likelihood reaches each sentence by its share, so that the model finds out which
sentences offend. These are then reported with their place.

Features of a sentence are its words, letters folded, and the first bytes of each word, hashed to buckets. The model is
fitted on the driver from a bounded sample (PER_CLASS documents of each class, of MAX_CHARS characters at most).

Defined results: a null or empty text has no sentence and scores 0. Without any label every sentence scores as the
start value of the bias. Repeated rows are scored alike and kept. Labels of a document that contradict each other both
count.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.arrays import PUNCTUATION, Words, hash_spans, words_of
from starling.llm.common import doc_texts, filtered_texts, labelled, steps

BITS = 18
STEMS = (4, 6)  # bytes
PER_CLASS = 1500
MAX_CHARS = 20_000
FEATURES = 1 + len(STEMS)
CHUNK = 1 << 18  # buckets that the fit handles together
START = -6.0
_STOP = np.zeros(256, bool)
_STOP[[0x0A, 0x21, 0x2E, 0x3F]] = True  # line end ! . ?


class Model(NamedTuple):
    weights: np.ndarray  # float32, one for each bucket
    bias: float


class Sentences(NamedTuple):
    """Sentences with at least one word."""

    words: Words
    bounds: np.ndarray  # words of sentence i are bounds[i] : bounds[i + 1]
    doc: np.ndarray  # text of sentence i
    buckets: np.ndarray  # FEATURES for each word: its own and those of its stems


def sentences_of(texts: list[bytes]) -> Sentences:
    words = words_of(texts, PUNCTUATION, folded=True)
    stops = np.cumsum(_STOP[words.data])
    own = stops[words.starts]
    new = np.flatnonzero(np.diff(own, prepend=-1))
    bounds = np.append(new, len(own))
    shift = np.uint64(64 - BITS)
    hashes = [words.hashes]
    for i, size in enumerate(STEMS):
        stems = hash_spans(words.data, words.starts, np.minimum(words.ends, words.starts + size))
        hashes.append(stems ^ np.uint64((i + 1) << 62))
    buckets = np.stack(hashes, axis=1) >> shift
    return Sentences(words, bounds, words.doc[new], buckets.reshape(-1).astype(np.int64))


def sentence_scores(model: Model, found: Sentences) -> np.ndarray:
    if not len(found.doc):
        return np.empty(0)
    margins = np.add.reduceat(model.weights[found.buckets].astype(float), FEATURES * found.bounds[:-1])
    return 1 / (1 + np.exp(-np.clip(margins + model.bias, -30, 30)))


def noisy_or(scores: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """1 - prod(1 - s) over the sentences of each document; 0 without any."""
    return -np.expm1(np.bincount(doc, np.log1p(-np.minimum(scores, 1 - 1e-12)), docs))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each sentence and buckets of each word, as bytes of 32-bit numbers: all that leaves a task."""
    for step in steps(batches):
        found = sentences_of([t.encode() for t in step.column("text").to_pylist()])
        first = np.searchsorted(found.doc, np.arange(step.num_rows + 1))
        sizes = np.diff(found.bounds).astype(np.uint32)
        words, buckets = found.words.bounds, found.buckets.astype(np.uint32)
        lists = [
            [sizes[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)],
            [buckets[FEATURES * a : FEATURES * b].tobytes() for a, b in zip(words[:-1], words[1:], strict=True)],
        ]
        columns = [step.column(c) for c in ("doc_id", "label", "weight")] + [pa.array(x, pa.binary()) for x in lists]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "weight", "sizes", "buckets"])


def fit(sample: DataFrame, rounds: int = 200, rate: float = 0.3, sparsity: float = 1e-4, least: float = 0.005) -> Model:
    """The model from doc_id, text, label and weight of a bounded sample, by gradient steps on the documents' likelihood.

    Buckets found in less than `least` of the documents stay at 0, and `sparsity` draws the others there. Texts do not
    come to the driver, only the buckets of their words.
    """
    bias, weights = START, np.zeros(1 << BITS, np.float32)
    rows = sample.mapInArrow(_features, "doc_id long, label int, weight double, sizes binary, buckets binary").toPandas()
    if not len(rows):
        return Model(weights, bias)
    rows = rows.sort_values(["doc_id", "label", "buckets"])
    label, weight = rows["label"].to_numpy(float), rows["weight"].to_numpy(float) / rows["weight"].sum()
    docs, many = np.zeros(1 << BITS, np.int32), len(rows)
    for own in rows["buckets"]:
        docs[np.unique(np.frombuffer(own, np.uint32))] += 1
    used = np.flatnonzero(docs >= least * many)
    place = np.zeros(1 << BITS, np.int32)
    place[used] = np.arange(1, len(used) + 1)
    # Of each sentence the buckets that learn, after one at place 0 that does not, so that none is empty.
    doc, buckets, bounds, last = [], [], [np.zeros(1, np.int64)], 0
    for i, (sizes, own) in enumerate(zip(rows["sizes"], rows["buckets"], strict=True)):
        sizes, own = np.frombuffer(sizes, np.uint32), place[np.frombuffer(own, np.uint32)]
        sentence = np.repeat(np.arange(len(sizes)), FEATURES * sizes)[own > 0]
        ends = np.cumsum(np.bincount(sentence, minlength=len(sizes)))
        buckets.append(np.insert(own[own > 0], np.append(0, ends[:-1]), 0) if len(sizes) else own)
        bounds.append(last + ends + np.arange(1, len(sizes) + 1))
        last += len(buckets[-1])
        doc.append(np.full(len(sizes), i))
    del rows
    doc, buckets, bounds = np.concatenate(doc), np.concatenate(buckets), np.concatenate(bounds)
    cuts = np.unique(np.append(np.searchsorted(bounds[:-1], np.arange(0, len(buckets), CHUNK)), len(doc)))
    chunks = [(a, b, bounds[a], bounds[b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    learned, seen, seen_bias = np.zeros(len(used) + 1), np.full(len(used) + 1, 1e-5), 1e-10
    for _ in range(rounds):
        margins = [np.add.reduceat(learned[buckets[c:d]], bounds[a:b] - c) for a, b, c, d in chunks]
        margins = np.concatenate(margins) if margins else np.empty(0)
        scores = 1 / (1 + np.exp(-np.clip(margins + bias, -30, 30)))
        chance = np.clip(noisy_or(scores, doc, many), 1e-9, 1)
        # Of the log-likelihood by a sentence's margin: -s for clean documents, s (1 - p) / p for toxic ones.
        share = weight * np.where(label == 1, -(1 - chance) / chance, 1.0)
        slope = share[doc] * scores
        slopes = np.zeros(len(used) + 1)
        for a, b, c, d in chunks:
            slopes += np.bincount(buckets[c:d], np.repeat(slope[a:b], np.diff(bounds[a : b + 1])), len(slopes))
        slopes[0] = 0
        seen, seen_bias = seen + slopes**2, seen_bias + slope.sum() ** 2
        step = rate / np.sqrt(seen)
        learned = learned - step * slopes
        learned = np.sign(learned) * np.maximum(np.abs(learned) - step * sparsity, 0)
        bias -= rate * slope.sum() / np.sqrt(seen_bias)
    weights[used] = learned[1:]
    return Model(weights, float(bias))


def sample_of(docs: DataFrame, labels: DataFrame, folds: int, held_out: int) -> DataFrame:
    return labelled(docs, labels, "toxic", folds, held_out, PER_CLASS, MAX_CHARS)


def toxicity(docs: DataFrame, model: Model, offends: float = 0.5) -> DataFrame:
    """doc_id, score, and sentences: first and last byte (exclusive) and score of each that scores at least `offends`.

    Every row of docs gives one row. Bytes are those of the UTF-8 text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 1 MB

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            found = sentences_of([t.encode() for t in step.column("text").to_pylist()])
            scores = sentence_scores(shared.value, found)
            total = noisy_or(scores, found.doc, step.num_rows)
            listed: list[list[dict]] = [[] for _ in range(step.num_rows)]
            words = found.words
            for i in np.flatnonzero(scores >= offends):
                doc = int(found.doc[i])
                start = int(words.starts[found.bounds[i]] - words.offsets[doc])
                end = int(words.ends[found.bounds[i + 1] - 1] - words.offsets[doc])
                listed[doc].append({"start": start, "end": end, "score": float(scores[i])})
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), pa.array(np.clip(total, 0, 1)), pa.array(listed, kind)],
                names=["doc_id", "score", "sentences"],
            )

    schema = "doc_id long, score double, sentences array<struct<start: long, end: long, score: double>>"
    return doc_texts(docs).mapInArrow(score, schema)


def rejected(scored: DataFrame, threshold: float) -> DataFrame:
    """Add predicted: 1 for toxic."""
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def without_toxic(docs: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of docs that are not predicted to be toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def stays(texts: list[str]) -> np.ndarray:
        found = sentences_of([t.encode() for t in texts])
        return noisy_or(sentence_scores(shared.value, found), found.doc, len(texts)) < threshold

    return filtered_texts(docs, stays)
