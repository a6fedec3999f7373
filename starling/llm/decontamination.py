"""Find passages of test items in training documents: rare word n-grams as seeds, then Smith-Waterman alignment.

1. Test items are read in blocks that fit in memory, and each block is held against all documents.
2. A first pass counts in how many documents each n-gram of the block occurs. The rarest SHARE of an item's n-grams are
   its seeds: by that count times the number of items that have the n-gram. There is no count beyond which an n-gram
   is dropped, so that an item which many documents copy keeps its seeds.
3. A second pass finds the seeds in each document. Around seeds of one item the words are aligned with the item (match
   +2, other word -1, gap -1); the best score, over that of a whole exact copy, is the item's score in the document.

Words are runs of characters other than white space and ASCII punctuation, letters folded, so that other case, line ends
and punctuation do not hide a copy. Documents never move; only hits do.

Defined results: null or empty texts match nothing. An item with fewer than GRAM words has no seed and is never found.
Items of the same text are all reported. A repeated row is reported once per row. Without items the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.arrays import PUNCTUATION, Words, words_of
from starling.llm.common import doc_texts, filtered_texts, steps, text_of

GRAM = 3
SHARE = 0.75
BLOCK_GRAMS = 200_000
MATCH, OTHER, GAP = 2, -1, -1
# Cells of the alignment tables that are filled together.
CELLS = 1 << 22


class Items(NamedTuple):
    """A block of test items: their words, and their seeds in the order of the hash."""

    ids: np.ndarray
    words: list[np.ndarray]
    grams: np.ndarray
    item: np.ndarray  # number of the item of each seed
    place: np.ndarray  # its first word in the item


def _words(texts: list[str]) -> Words:
    return words_of([t.encode() for t in texts], PUNCTUATION, folded=True)


def _found(hashes: np.ndarray, sorted_hashes: np.ndarray) -> np.ndarray:
    """Where hashes occur among sorted ones."""
    # Most are not there: a table of 2**22 bits tells before the search.
    table = np.zeros(1 << 22, bool)
    table[sorted_hashes & np.uint64((1 << 22) - 1)] = True
    maybe = np.flatnonzero(table[hashes & np.uint64((1 << 22) - 1)])
    at = np.searchsorted(sorted_hashes, hashes[maybe])
    return maybe[sorted_hashes[np.minimum(at, len(sorted_hashes) - 1)] == hashes[maybe]]


def read_items(block: pd.DataFrame) -> Items:
    words = _words(list(block["text"]))
    grams, first = words.runs(GRAM)
    item = words.doc[first] if len(first) else np.empty(0, np.int64)
    order = np.argsort(grams, kind="stable")
    place = first - words.bounds[item] if len(first) else first
    parts = [words.hashes[a:b] for a, b in zip(words.bounds, words.bounds[1:], strict=False)]
    return Items(block["item_id"].to_numpy(), parts, grams[order], item[order], place[order])


def gram_counts(docs: DataFrame, grams: np.ndarray) -> np.ndarray:
    """In how many documents each of the sorted, distinct n-grams occurs."""
    shared = docs.sparkSession.sparkContext.broadcast(grams)  # at most BLOCK_GRAMS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for step in steps(batches):
            words = _words(step.column("text").to_pylist())
            hashes, first = words.runs(GRAM)
            hits = _found(hashes, shared.value)
            at = np.searchsorted(shared.value, hashes[hits])
            pairs = np.unique(words.doc[first[hits]] * len(total) + at) if len(hits) else at
            total += np.bincount(pairs % len(total), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["gram", "docs"])

    found = doc_texts(docs).mapInArrow(count, "gram long, docs long").groupBy("gram").agg(F.sum("docs").alias("docs"))
    out = np.zeros(len(grams), np.int64)
    rows = found.toPandas()
    out[rows["gram"].to_numpy(int)] = rows["docs"].to_numpy(int)
    return out


def with_seeds(items: Items, docs: DataFrame) -> Items:
    """Keep the rarest n-grams of each item."""
    grams, at, shared_by = np.unique(items.grams, return_inverse=True, return_counts=True)
    common = (gram_counts(docs, grams) * shared_by)[at]
    order = np.lexsort((items.place, common, items.item))
    sizes = np.bincount(items.item, minlength=len(items.ids))
    rank = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = np.sort(order[rank < np.ceil(SHARE * np.repeat(sizes, sizes))])
    return items._replace(grams=items.grams[kept], item=items.item[kept], place=items.place[kept])


def regions(words: Words, items: Items) -> pd.DataFrame:
    """Parts of documents to align: doc, item, and words start to end (exclusive), counted over the whole step."""
    hashes, first = words.runs(GRAM)
    hits = _found(hashes, items.grams) if len(items.grams) else np.empty(0, np.int64)
    low, high = (np.searchsorted(items.grams, hashes[hits], side) for side in ("left", "right"))
    many = high - low
    seed = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = np.repeat(first[hits], many)
    doc, item = words.doc[at], items.item[seed]
    size = np.array([len(w) for w in items.words], np.int64)[item]
    # The item may lie about half its length further than the seed says.
    start = np.maximum(at - items.place[seed] - size // 2, words.bounds[doc])
    end = np.minimum(at - items.place[seed] + size + size // 2, words.bounds[doc + 1])
    rows = pd.DataFrame({"doc": doc, "item": item, "start": start, "end": end}).sort_values(["doc", "item", "start"])
    if not len(rows):
        return rows
    same = (rows[["doc", "item"]] == rows[["doc", "item"]].shift()).all(axis=1)
    reach = rows.groupby(["doc", "item"])["end"].cummax().shift().fillna(-1)
    rows["part"] = (~(same & (rows["start"] <= reach))).cumsum()
    return rows.groupby("part").agg(doc=("doc", "first"), item=("item", "first"), start=("start", "first"), end=("end", "max"))


def align(item: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Best local alignments of pairs (rows, padded with 0): score, and last word of the text, counted from 1."""
    pairs, width = text.shape
    row = np.zeros((pairs, width + 1), np.int32)
    best, end = np.zeros(pairs, np.int32), np.zeros(pairs, np.int64)
    slope = -GAP * np.arange(width + 1, dtype=np.int32)
    for i in range(item.shape[1]):
        word = item[:, i : i + 1]
        gain = np.where((text == word) & (word != 0), MATCH, OTHER)
        new = np.maximum(row + GAP, 0)
        new[:, 1:] = np.maximum(new[:, 1:], row[:, :-1] + gain)
        # A gap in the item's row: what stands to the left, less a GAP for each step.
        row = np.maximum.accumulate(new + slope, axis=1) - slope
        row[word[:, 0] == 0] = 0
        top = row.argmax(axis=1)
        value = row[np.arange(pairs), top]
        end = np.where(value > best, top, end)
        best = np.maximum(best, value)
    return np.stack([best, end], axis=1)


def padded(parts: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(parts), max(map(len, parts))), np.uint64)
    for row, part in zip(out, parts, strict=True):
        row[: len(part)] = part
    return out


def alignments(words: Words, items: Items, found: pd.DataFrame) -> pd.DataFrame:
    """The best alignment of each document and item: score, and the words of the document that it covers."""
    found = found.assign(cells=(found["end"] - found["start"]) * [len(items.words[i]) for i in found["item"]])
    found = found.sort_values("cells", kind="stable").reset_index(drop=True)
    score, first, last = np.zeros(len(found)), np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
    start = 0
    while start < len(found):
        stop = start + 1
        # Of similar size, as they are sorted: padding stays small.
        while stop < len(found) and found["cells"][stop] * (stop + 1 - start) <= CELLS:
            stop += 1
        rows = found.iloc[start:stop]
        own = [items.words[i] for i in rows["item"]]
        parts = [words.hashes[a:b] for a, b in zip(rows["start"], rows["end"], strict=True)]
        sizes = np.array([len(w) for w in own])
        ahead = align(padded(own), padded(parts))
        # Backwards from the end of the best alignment, to find where it starts.
        ends = ahead[:, 1]
        back = align(padded([w[::-1] for w in own]), padded([p[:e][::-1] for p, e in zip(parts, ends, strict=True)]))
        score[start:stop] = ahead[:, 0] / (MATCH * sizes)
        last[start:stop] = rows["start"].to_numpy() + ends
        first[start:stop] = last[start:stop] - back[:, 1]
        start = stop
    found = found.assign(score=score, first=first, last=last)
    return found.sort_values(["doc", "item", "score", "first"]).groupby(["doc", "item"]).tail(1)


def matched(texts: list[str], items: Items, least: float) -> tuple[Words, pd.DataFrame]:
    """Words of the texts, and the alignments that score enough."""
    words = _words(texts)
    found = regions(words, items)
    if len(found):
        found = alignments(words, items, found)
        found = found[found["score"] >= least]
    return words, found


def _matches(docs: DataFrame, items: Items, least: float) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)  # a block of items

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            words, found = matched(step.column("text").to_pylist(), shared.value, least)
            if not len(found):
                continue
            doc = found["doc"].to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    step.column("doc_id").take(pa.array(doc)),
                    pa.array(shared.value.ids[found["item"].to_numpy()], pa.int64()),
                    pa.array(found["score"].to_numpy()),
                    pa.array(words.starts[found["first"].to_numpy()] - words.offsets[doc], pa.int64()),
                    pa.array(words.ends[found["last"].to_numpy() - 1] - words.offsets[doc], pa.int64()),
                ],
                names=["doc_id", "item_id", "score", "start", "end"],
            )

    return doc_texts(docs).mapInArrow(match, "doc_id long, item_id long, score double, start long, end long")


def seeded_blocks(docs: DataFrame, benchmark: DataFrame, block_grams: int) -> Iterator[Items]:
    """The test items in blocks, with their seeds."""
    tests = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), text_of(benchmark).alias("text"))
    # An item has fewer n-grams than half its characters.
    size = tests.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = size // (2 * block_grams) + 1
    for block in range(blocks):
        rows = tests.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = read_items(rows.orderBy("item_id", "text").toPandas())
        if len(items.grams):
            yield with_seeds(items, docs)


def contamination(docs: DataFrame, benchmark: DataFrame, least: float = 0.5, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """doc_id, item_id, score (0 to 1), and the bytes start to end (exclusive) of the passage, for scores from `least` on.

    One row for each row of docs and item that match.
    """
    found = [_matches(docs, items, least) for items in seeded_blocks(docs, benchmark, block_grams)]
    if not found:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, score double, start long, end long")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.5, block_grams: int = BLOCK_GRAMS) -> DataFrame:
    """The rows of docs that hold no passage of a test item."""
    for items in seeded_blocks(docs, benchmark, block_grams):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def stays(texts: list[str], shared=shared) -> np.ndarray:
            out = np.ones(len(texts), bool)
            out[matched(texts, shared.value, least)[1]["doc"].to_numpy(int)] = False
            return out

        docs = filtered_texts(docs, stays)
    return docs
