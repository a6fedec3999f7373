"""Quality by nearest neighbours among labelled documents, in a latent-semantic space.

Terms are hashed runs of three and five characters of a text's shape (letters are only upper or lower case, digits one
sign, the rest themselves) and marks for repeated words. A vector is the square root of the terms' shares, times their
inverse document frequency, projected to the leading singular vectors of a bounded labelled sample (PER_CLASS documents
of each class, of MAX_CHARS characters at most) and scaled to length 1. Every document is compared with every labelled
vector, in blocks, by exact cosine products; the NEIGHBOURS nearest vote with their similarity.

Defined results: a null or empty text has no terms; its vector is 0, all similarities are 0, and it scores the share of
label 1 among labelled documents. Without any label every score is 0.5. Repeated rows are scored alike and kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.arrays import BYTE, mix, rolling, words_of
from starling.llm.common import doc_texts, labelled, steps

BITS = 11
PER_CLASS = 2000
MAX_CHARS = 20_000
DIMENSIONS = 48
NEIGHBOURS = 25
BLOCK = 512  # documents compared at once
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[ord("a") : ord("z") + 1] = ord("a")
_SHAPE[0x80:] = ord("a")
_SHAPE[ord("A") : ord("Z") + 1] = ord("A")
_SHAPE[ord("0") : ord("9") + 1] = ord("0")


class Space(NamedTuple):
    """The latent space and the labelled vectors in it."""

    weights: np.ndarray  # inverse document frequency of each term
    axes: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled documents x dimensions
    votes: np.ndarray  # weight of each labelled document
    labels: np.ndarray


def term_shares(texts: list[bytes]) -> np.ndarray:
    """Square roots of the shares of all terms: one row for each text, 0 for a text without terms."""
    words = words_of(texts)
    counts = np.zeros(len(texts) << BITS)
    owner = np.repeat(np.arange(len(texts)), np.diff(words.offsets))
    shape = BYTE[_SHAPE[words.data]]

    def add(hashes: np.ndarray, doc: np.ndarray) -> None:
        buckets = (mix(hashes) >> np.uint64(64 - BITS)).astype(np.int64)
        counts[:] += np.bincount((doc << BITS) + buckets, minlength=len(counts))

    for length in (3, 5):
        hashes = rolling(shape, length)
        if len(hashes):
            whole = owner[: len(hashes)] == owner[length - 1 :]
            add(hashes[whole], owner[: len(hashes)][whole])
    doc = words.doc
    for back in (1, 2):
        if len(doc) > back:
            again = (words.hashes[back:] == words.hashes[:-back]) & (doc[back:] == doc[:-back])
            # A repeated word weighs as much as a word's characters do.
            for i in range(4):
                add(np.full(int(again.sum()), 8 * back + i, np.uint64), doc[back:][again])
    counts = counts.reshape(len(texts), 1 << BITS)
    return np.sqrt(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def fit(sample: DataFrame) -> Space | None:
    """The space from text, label and weight of a bounded sample; None if it is empty."""

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            rows = term_shares([t.encode() for t in step.column("text").to_pylist()]).astype(np.float16)
            out = [step.column(c) for c in ("doc_id", "label", "weight")] + [pa.array([r.tobytes() for r in rows])]
            yield pa.RecordBatch.from_arrays(out, names=["doc_id", "label", "weight", "terms"])

    # At most 2 * PER_CLASS rows of 4 kB.
    rows = sample.mapInArrow(shares, "doc_id long, label int, weight double, terms binary").toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["doc_id", "label", "terms"])
    terms = np.stack([np.frombuffer(t, np.float16) for t in rows["terms"]]).astype(np.float32)
    weights = np.log((1 + len(terms)) / (1 + (terms > 0).sum(axis=0))).astype(np.float32) + 0.1
    terms = unit(terms * weights)
    # The leading singular vectors, from the products of the terms.
    values, vectors = np.linalg.eigh((terms.T @ terms).astype(np.float64))
    axes = vectors[:, np.argsort(values)[::-1][:DIMENSIONS]].astype(np.float32)
    votes, labels = rows["weight"].to_numpy(np.float32), rows["label"].to_numpy(np.float32)
    return Space(weights, axes, unit(terms @ axes), votes, labels)


def vote(space: Space, terms: np.ndarray) -> np.ndarray:
    """Share of label 1 among the nearest labelled vectors, each weighted by its similarity."""
    prior = float((space.votes * space.labels).sum() / space.votes.sum())
    out = np.empty(len(terms))
    near = min(NEIGHBOURS, len(space.vectors))
    for start in range(0, len(terms), BLOCK):
        block = unit((terms[start : start + BLOCK] * space.weights) @ space.axes)
        likeness = block @ space.vectors.T
        nearest = np.argpartition(-likeness, near - 1, axis=1)[:, :near]
        weight = np.maximum(np.take_along_axis(likeness, nearest, axis=1), 0) * space.votes[nearest]
        total = weight.sum(axis=1)
        score = (weight * space.labels[nearest]).sum(axis=1) / np.where(total > 0, total, 1)
        out[start : start + BLOCK] = np.where(total > 0, score, prior)
    return np.clip(out, 0, 1)


def sample_of(docs: DataFrame, labels: DataFrame, folds: int, held_out: int) -> DataFrame:
    return labelled(docs, labels, "quality", folds, held_out, PER_CLASS, MAX_CHARS)


def quality(docs: DataFrame, space: Space | None) -> DataFrame:
    """doc_id and score of every row of docs."""
    if space is None:
        return doc_texts(docs).select("doc_id", F.lit(0.5).alias("score"))
    # 2 * PER_CLASS vectors of DIMENSIONS, and the axes: about 1 MB.
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            terms = term_shares([t.encode() for t in step.column("text").to_pylist()])
            scores = pd.Series(vote(shared.value, terms))
            yield pa.RecordBatch.from_arrays([step.column("doc_id"), pa.array(scores)], names=["doc_id", "score"])

    return doc_texts(docs).mapInArrow(score, "doc_id long, score double")
