"""Remove every byte covered by a long string that also starts anywhere else, by induced suffix sorting.

A suffix array of all texts would sort each of their bytes. Here, as in induced sorting, a sample of suffixes is sorted
first and the others are induced from it, byte by byte to the left, each step carrying ranks and common-prefix values:

1. Sample. In each window (a string of SHORTEST bytes) the leftmost smallest hash of ANCHOR bytes is the window's anchor.
   It depends on the window's bytes alone, so equal windows have the same anchor at the same distance. Consecutive
   windows of one anchor make a segment, about one for each (SHORTEST - ANCHOR) / 2 bytes; its tail are the bytes from its
   last window on, LENGTH at most or up to the end of the text.
2. Segments are counted by anchor. Anchors that occur once cannot be part of a repeat. Equal segments (with equal tails)
   are one row with a count, and all their windows repeat; an anchor that occurs in different segments needs sorting.
3. Segments to be sorted are tuples (anchor, suffix at the anchor, bytes to its left), put in order by Spark's external
   sort, whose queues of sorted runs are on disk. A task reads the tuples of its anchors in that order, some whole
   anchors at a time, with the common prefix of each with the one before.
4. Induction. The suffixes that start one byte further left are in order after a stable sort by that byte; the common
   prefix of neighbours is one more than the least one in between. Strings whose common prefix with a neighbour reaches
   LENGTH repeat and are removed. Common prefixes from SHORTEST to LENGTH give the longest repeat of each text, and remove
   nothing.

Only segments of shared anchors are sorted, and of equal ones one; a task holds a batch of anchors, never a whole shard.
An anchor's different segments must fit in the memory of a task.

Defined results: null or empty texts, and texts shorter than LENGTH bytes, keep everything. Repeated rows are copies of
each other, and lose all windows. Matches never cross texts. A longest repeat below SHORTEST counts as 0, one beyond LENGTH
as LENGTH.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.arrays import BASE, BYTE, mix, rolling, sliding_min
from starling.llm.common import STEP_CHARS, joined_texts, keyed_texts, steps
from starling.session import materialize

LENGTH = 400
SHORTEST = 250  # a passage of 50 words is rarely shorter
ANCHOR = 64
BATCH = 20_000  # segments sorted together
STEP = 1 << 18  # bytes that are hashed together, with some ten numbers of 64 bits for each
_PLACE = np.uint64((1 << 24) - 1)


def segments(data: np.ndarray, owner: np.ndarray, length: int, anchor: int, shortest: int, most: int | None = None) -> dict[str, np.ndarray]:
    """Segments of some bytes and their owners: anchor and content (hashes), first window, count, distance to the anchor, tail.

    Windows are shortest bytes; only those that begin in the first `most` bytes count.
    """
    grams = mix(rolling(BYTE[data], anchor))
    reach = shortest - anchor + 1
    if len(grams) < reach:
        return {}
    key = sliding_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), reach)
    starts = np.flatnonzero(owner[: len(key)][:most] == owner[shortest - 1 :][:most])
    if not len(starts):
        return {}
    place = (key[starts] & _PLACE).astype(np.int64)
    new = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
    first, place = starts[new], place[new]
    count = np.diff(np.append(new, len(starts)))
    last = first + count - 1
    tail = np.minimum(length, np.searchsorted(owner, owner[last], side="right") - last)
    windows = rolling(BYTE[data], shortest)
    content = mix(windows[first]) + mix(windows[last] + np.uint64(1)) * np.uint64(BASE)
    for done in range(shortest, length, shortest):
        content = mix(content) * np.uint64(BASE) + windows[last + np.minimum(done, tail - shortest)]
    content = mix(mix(content) + count.astype(np.uint64) + tail.astype(np.uint64) * np.uint64(BASE))
    return {"anchor": grams[place].view(np.int64), "content": content.view(np.int64), "first": first, "count": count, "lead": place - first, "tail": tail}


def pieces(step: pa.RecordBatch, length: int, shortest: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, their owner (row of the step), where each row's bytes begin, and how far into the row.

    Long texts come in parts of 4 * STEP_CHARS bytes, followed by the rest of the strings that begin in them.
    """
    texts = [t.encode() for t in step.column("text").to_pylist()]
    most = 4 * STEP_CHARS
    if len(texts) > 1 or len(texts[0]) <= most:
        sizes = np.array([len(t) for t in texts])
        yield np.frombuffer(b"".join(texts), np.uint8), np.repeat(np.arange(len(texts)), sizes), np.cumsum(sizes) - sizes, np.zeros(len(texts), np.int64)
        return
    data = np.frombuffer(texts[0], np.uint8)
    for start in range(0, len(data) - (shortest or length) + 1, most):
        part = data[start : start + most + length - 1]
        yield part, np.zeros(len(part), np.int64), np.zeros(1, np.int64), np.array([start])


def all_segments(texts: DataFrame, length: int, anchor: int, shortest: int) -> DataFrame:
    """id, copy, anchor, content, count, lead, tail and first of every segment."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches, most=STEP):
            most = 4 * STEP_CHARS if step.num_rows == 1 else None
            for data, owner, begins, skipped in pieces(step, length, shortest):
                if found := segments(data, owner, length, anchor, shortest, most):
                    row = owner[found["first"]]
                    yield pa.RecordBatch.from_arrays(
                        [
                            step.column("id").take(pa.array(row)),
                            step.column("copy").take(pa.array(row)),
                            pa.array(found["anchor"]),
                            pa.array(found["content"]),
                            pa.array(found["count"], pa.int32()),
                            pa.array(found["lead"], pa.int32()),
                            pa.array(found["tail"], pa.int32()),
                            pa.array(found["first"] - begins[row] + skipped[row], pa.int64()),
                        ],
                        names=["id", "copy", "anchor", "content", "count", "lead", "tail", "first"],
                    )

    return texts.mapInArrow(cut, "id long, copy long, anchor long, content long, count int, lead int, tail int, first long")


def tuples(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The segments to be sorted, with the suffix at the anchor (at most length bytes) and the bytes to its left, turned."""
    lists = wanted.groupBy("id", "copy").agg(F.collect_list(F.struct("anchor", "content", "count", "lead", "first")).alias("own"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            out = []
            for text, own in zip(step.column("text").to_pylist(), step.column("own").to_pylist(), strict=True):
                data = text.encode()
                for x in own:
                    at = x["first"] + x["lead"]
                    out.append((x["anchor"], x["content"], x["count"], x["lead"], data[at : at + length], data[x["first"] : at][::-1]))
            kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(zip(*out, strict=True), kinds, strict=True)],
                names=["anchor", "content", "count", "lead", "suffix", "left"],
            )

    return texts.join(lists, ["id", "copy"]).mapInArrow(
        read, "anchor long, content long, count int, lead int, suffix binary, left binary"
    )


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings as rows, padded with 0, and their sizes."""
    values = column.to_pylist()
    sizes = np.array([len(v) for v in values])
    return np.frombuffer(b"".join(v.ljust(width, b"\0") for v in values), np.uint8).reshape(len(values), width), sizes


def induce(anchors: np.ndarray, counts: np.ndarray, leads: np.ndarray, suffixes: np.ndarray, sizes: np.ndarray, lefts: np.ndarray, length: int) -> np.ndarray:
    """Common prefix (length at most) of each window with the nearest others: a row for each segment, a column for each
    distance to the anchor.

    Segments come in the order of anchor and suffix.
    """
    out = np.zeros((len(anchors), int(leads.max()) + 1), np.int32)
    group = np.cumsum(np.diff(anchors, prepend=anchors[0]) != 0)
    differ = suffixes[1:] != suffixes[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    prefix = np.zeros(len(anchors), np.int32)
    prefix[1:] = np.where(group[1:] == group[:-1], np.minimum(common, np.minimum(sizes[1:], sizes[:-1])), 0)
    order = np.arange(len(anchors))  # segments in the order of their suffixes
    nearest = leads - counts + 1  # distance of the last window
    for distance in range(out.shape[1]):
        if distance:
            there = np.flatnonzero(leads[order] >= distance)
            key = group[order[there]] * 256 + lefts[order[there], distance - 1]
            there = there[np.argsort(key, kind="stable")]
            order_new = order[there]
            key = group[order_new] * 256 + lefts[order_new, distance - 1]
            # The least common prefix in between, from the one after the neighbour up to the own.
            bounds = np.stack([there[:-1] + 1, there[1:] + 1], axis=1).reshape(-1)
            least = np.zeros(len(there), np.int32)
            if len(there) > 1:
                same = key[1:] == key[:-1]
                ranges = bounds.reshape(-1, 2)[same].reshape(-1)
                if len(ranges):
                    least[1:][same] = np.minimum.reduceat(np.append(prefix, 0), ranges)[::2] + 1
            order, prefix = order_new, least
        if not len(order):
            break
        # Only windows of the segments themselves are compared: the bytes further right may be another segment's, of the
        # same place where a long text was cut.
        own = np.flatnonzero(nearest[order] <= distance)
        if len(own) > 1:
            shared = np.zeros(len(own) + 1, np.int32)
            shared[1:-1] = np.minimum.reduceat(np.append(prefix, 0), own + 1)[:-1]
            out[order[own], distance] = np.minimum(np.maximum(shared[:-1], shared[1:]), length)
    return out


def sorted_marks(found: DataFrame, length: int, shortest: int, batch: int = BATCH) -> DataFrame:
    """anchor, content, count, start, end and longest: runs of places where a string of length bytes repeats, counted from
    the first window of a segment, and the segment's longest repeat. Segments with shorter repeats alone have an empty run.
    """

    def marks(rows: pa.Table) -> pa.RecordBatch:
        suffixes, sizes = _matrix(rows.column("suffix"), length)
        leads = rows.column("lead").to_numpy()
        lefts, _ = _matrix(rows.column("left"), max(1, int(leads.max())))
        common = induce(rows.column("anchor").to_numpy(), rows.column("count").to_numpy(), leads, suffixes, sizes, lefts, length)
        hit, longest = common >= length, common.max(axis=1)
        # From distances to places: turned, and with a column without a hit on both sides, runs begin and end at changes.
        wide = np.zeros((len(hit), hit.shape[1] + 2), np.int8)
        wide[:, 1:-1] = hit[:, ::-1]
        segment, begin = np.nonzero(np.diff(wide, axis=1) == 1)
        _, end = np.nonzero(np.diff(wide, axis=1) == -1)
        shift = (hit.shape[1] - 1 - leads)[segment]
        short = np.flatnonzero((longest >= shortest) & (longest < length))
        none = np.zeros(len(short), np.int64)
        marked = np.append(segment, short)
        columns = [rows.column(c).combine_chunks().take(pa.array(marked)) for c in ("anchor", "content", "count")]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(np.append(begin - shift, none)), pa.array(np.append(end - shift, none)), pa.array(longest[marked])],
            names=["anchor", "content", "count", "start", "end", "longest"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for step in batches:
            if not step.num_rows:
                continue
            held.append(step)
            if sum(b.num_rows for b in held) >= batch:
                rows = pa.Table.from_batches(held).combine_chunks()
                anchors = rows.column("anchor").to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1]))  # the last anchor may go on
                if cut:
                    yield marks(rows.slice(0, cut))
                    held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield marks(pa.Table.from_batches(held).combine_chunks())

    placed = found.repartition("anchor").sortWithinPartitions("anchor", "suffix", F.length("suffix"))
    return placed.mapInArrow(run, "anchor long, content long, count int, start long, end long, longest int")


def repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shortest: int | None = None) -> DataFrame:
    """id, copy and found, of all texts that hold a repeat of shortest (else length) bytes.

    found.spans are runs [start, end) of places where a string of length bytes begins that repeats, found.longest is the size
    of the longest repeat, length at most.
    """
    shortest = min(shortest or length, length)
    texts = keyed_texts(docs).drop("doc_id")
    found = materialize(all_segments(texts, length, anchor, shortest), "segments")
    first = F.min(F.struct("id", "copy", "first")).alias("at")
    kinds = found.groupBy("anchor", "content", "count", "lead", "tail").agg(F.count("*").alias("times"), first)
    shared = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("times").alias("all")).filter("all > 1")
    kinds = materialize(kinds.join(shared.drop("all"), "anchor"), "kinds")
    wanted = kinds.filter("kinds > 1").select("at.*", "anchor", "content", "count", "lead")
    marks = sorted_marks(tuples(texts, wanted, length), length, shortest)
    # At the end of a text the last windows are shorter than length.
    end = F.greatest(F.col("count") - length + F.col("tail"), F.lit(0)).cast("long").alias("end")
    longest = F.least(F.col("tail") + F.col("count") - 1, F.lit(length)).alias("longest")
    known = kinds.filter("times > 1").select("anchor", "content", "count", F.lit(0).cast("long").alias("start"), end, longest)
    # Of a kind that is known to repeat the marks add nothing, and do no harm.
    marks = materialize(known.unionByName(marks), "marks")
    spans = found.join(marks, ["anchor", "content", "count"])
    span = F.struct((F.col("first") + F.col("start")).alias("start"), (F.col("first") + F.col("end")).alias("end"))
    spans = spans.select("id", "copy", F.when(F.col("start") < F.col("end"), span).alias("span"), "longest").distinct()
    both = F.struct(F.collect_list("span").alias("spans"), F.max("longest").alias("longest"))
    return spans.groupBy("id", "copy").agg(both.alias("found"))


def _kept(text: str, spans: list[dict] | None, length: int) -> tuple[bytes, int, int, int]:
    """Remaining bytes, bytes there were, bytes removed, and maximal removed runs."""
    data = text.encode()
    if not spans:
        return data, len(data), 0, 0
    change = np.zeros(len(data) + 1, np.int64)
    np.add.at(change, [s["start"] for s in spans], 1)
    np.add.at(change, [s["end"] - 1 + length for s in spans], -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(np.count_nonzero(np.diff(gone, prepend=False) & gone))
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), len(data), int(gone.sum()), runs


def without_repeats(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, shortest: int = SHORTEST) -> DataFrame:
    """Add kept (the remaining bytes), n_bytes, n_removed, n_spans (maximal removed runs) and longest_repeat to the rows of docs.

    longest_repeat has the bytes of the text's longest string that also starts anywhere else: length at most, 0 below shortest.
    """
    stored = materialize(repeats(docs, length, anchor, shortest), "repeats")
    kinds = {"kept": pa.binary(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "longest_repeat": pa.int64()}

    def remove(text: str, found: dict | None) -> tuple[bytes, int, int, int, int]:
        return *_kept(text, found and found["spans"], length), found["longest"] if found else 0

    return joined_texts(docs, stored, "found", remove, kinds)


def shortened(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """docs with the remaining text, and its n_chars. Bytes of a character that was cut are dropped."""
    stored = materialize(repeats(docs, length, anchor), "repeats")

    def shorten(text: str, found: dict | None) -> tuple[str, int]:
        kept = _kept(text, found["spans"], length)[0].decode(errors="ignore") if found else text
        return kept, len(kept)

    out = joined_texts(docs, stored, "found", shorten, {"text": pa.string(), "n_chars": pa.int64()})
    return out.select(*docs.columns)
