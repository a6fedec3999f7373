"""Pack token sequences of documents into as few training sequences as possible, by the linear grouping scheme.

1. Documents are encoded, an end id is added, and what is longer than a sequence is cut into pieces.
2. Lengths are whole numbers up to the capacity, so the whole problem is a histogram with `capacity` counts. It is
   solved on the driver in a time that does not depend on the number of documents:
   - large lengths are sorted, cut into groups of equal cardinality and rounded up to the largest of their group;
   - how often each configuration of these few sizes is used is a small linear programme (columns are made as needed by
     a knapsack over the capacity), rounded down to whole numbers;
   - actual lengths take the places of the rounded ones, and the last place of a sequence may use the freed space;
   - what rounding down left over, and all small lengths, go by best fit, longest first.
   Sequences that hold the same lengths are one entry with a count throughout.
3. Pieces are numbered among those of equal length, by counts per length and input partition that are carried on; the
   number of a piece gives its sequence and its place by looking up the entry. No group of pieces comes together.

Defined results: a null or empty text has only its end id. Repeated rows are pieces of their own.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starling.llm.common import doc_texts, steps
from starling.session import materialize

GROUPS = 64
LARGE = 4  # lengths from a 4th of the capacity on are large
# Fixed value: how byte-level vocabularies of this family split a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# White space as that pattern knows it, in a run that is too long for its backtracking.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")
_ENCODERS: dict[str, tiktoken.Encoding] = {}


def encoder(path: str) -> tiktoken.Encoding:
    """The tokenizer of a `tokenizers` file of the byte-level merging kind.

    Ids and splitting are the file's, as a test over all characters shows; the other library's loop over the merges is
    five times as fast. For long runs of white space see `ids_of`. Special strings inside a text become their ids, which is the default of `tokenizers`.
    """
    if path not in _ENCODERS:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        kind = told["pre_tokenizer"]
        if (told["normalizer"], kind["type"], kind["add_prefix_space"], kind["use_regex"]) != (None, "ByteLevel", False, True):
            raise ValueError(f"{path} is of another kind")
        # Byte-level vocabularies write a byte as a printable character: itself, or the next free one from 256 on.
        own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in own]
        byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(other)}
        special = {x["content"]: x["id"] for x in told["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in name): i for name, i in told["model"]["vocab"].items() if name not in special
        }
        _ENCODERS[path] = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
    return _ENCODERS[path]


def ids_of(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    """Token ids of a text. Long runs of white space are cut out where the pattern cuts them.

    A run is one unit, whose last character goes with the word that follows; nothing before a run extends into it. At the
    end of the text, and before a special string, it is one unit as a whole.
    """
    out, start, special = [], 0, tuple(encoding.special_tokens_set)
    for run in BLANKS.finditer(text):
        whole = run.end() == len(text) or text.startswith(special, run.end())
        end = run.end() if whole else run.end() - 1
        out.append(encoding.encode_to_numpy(text[start : run.start()], allowed_special="all"))
        out.append(np.array(encoding._encode_single_piece(text[run.start() : end]), np.uint32))
        start = end
    out.append(encoding.encode_to_numpy(text[start:], allowed_special="all"))
    return np.concatenate(out)


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length and ids of every piece. Only the first piece of a cut document may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for step in steps(batches):
            rows = [[], [], [], [], []]
            for doc, text in zip(step.column("doc_id").to_pylist(), step.column("text").to_pylist(), strict=True):
                ids = ids_of(encoding, text).astype("<u4").tobytes() + end
                n = len(ids) // 4
                stops = [*range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [n]
                start = 0
                for i, stop in enumerate(stops):
                    for column, value in zip(rows, (doc, i, start, stop - start, ids[4 * start : 4 * stop]), strict=True):
                        column.append(value)
                    start = stop
            kinds = pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind) for values, kind in zip(rows, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    return doc_texts(docs).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


class Run(NamedTuple):
    """Equal sequences: how many, what they hold, as (length, how often) in order, and the space left."""

    count: int
    holds: tuple[tuple[int, int], ...]
    free: int


def linear_groups(counts: np.ndarray, smallest: int, groups: int) -> list[list[tuple[int, int]]]:
    """Lengths of at least `smallest`, longest first, in groups of equal cardinality: (length, how many) of each."""
    total = int(counts[smallest:].sum())
    out: list[list[tuple[int, int]]] = []
    if not total:
        return out
    size = -(-total // groups)
    room = 0
    for length in range(len(counts) - 1, smallest - 1, -1):
        left = int(counts[length])
        while left:
            if not room:
                out.append([])
                room = size
            take = min(room, left)
            out[-1].append((length, take))
            room, left = room - take, left - take
    return out


def best_pattern(sizes: list[int], values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The configuration of the highest value: an unbounded knapsack over the capacity."""
    best = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    sizes_at = np.array(sizes)
    for room in range(min(sizes), capacity + 1):
        fits = sizes_at <= room
        gains = np.where(fits, best[room - np.where(fits, sizes_at, 0)] + values, 0)
        i = int(gains.argmax())
        if gains[i] > best[room - 1]:
            best[room], pick[room] = gains[i], i
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            pattern[pick[room]] += 1
            room -= sizes[pick[room]]
    return float(best[capacity]), pattern


def configurations(sizes: list[int], demand: np.ndarray, capacity: int, rounds: int = 600) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often to use each so that the demand is met with the fewest sequences (fractions allowed)."""
    basis = np.diag([float(capacity // s) for s in sizes])
    use = demand / np.diag(basis)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        value, pattern = best_pattern(sizes, prices, capacity)
        if value <= 1 + 1e-7:
            break
        step = np.linalg.solve(basis, pattern.astype(float))
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        use = use - ratio[out] * step
        use[out] = ratio[out]
        use = np.maximum(use, 0)
        basis[:, out] = pattern
    return [(basis[:, i].astype(np.int64), float(use[i])) for i in range(len(sizes))]


def substitute(pattern: list[int], times: int, left: np.ndarray, smallest: int, capacity: int) -> list[Run]:
    """Sequences of one configuration (sizes, longest first) with actual lengths, which are taken from `left`.

    A place gets the longest length that is left and not above its size; the last place may be as long as the space that
    remains, since the actual lengths before it were shorter than their sizes.
    """
    runs = [Run(times, (), capacity)]
    for place, size in enumerate(pattern):
        out = []
        for run in runs:
            many = run.count
            length = run.free if place == len(pattern) - 1 else min(size, run.free)
            while many:
                while length >= smallest and not left[length]:
                    length -= 1
                if length < smallest:
                    out.append(run._replace(count=many))
                    break
                take = min(many, int(left[length]))
                out.append(Run(take, (*run.holds, (length, 1)), run.free - length))
                left[length] -= take
                many -= take
        runs = out
    return runs


def best_fit(runs: list[Run], rest: np.ndarray, capacity: int) -> list[Run]:
    """Put the rest, longest first, where the least space remains; open sequences where nothing fits."""
    by_free: list[list[Run]] = [[] for _ in range(capacity + 1)]
    for run in runs:
        by_free[run.free].append(run)
    for length in range(len(rest) - 1, 0, -1):
        left, free = int(rest[length]), length
        while left:
            while free <= capacity and not by_free[free]:
                free += 1
            if free > capacity:
                each = capacity // length
                run = Run(-(-left // each), (), capacity)
            else:
                run = by_free[free].pop()
                each = free // length
            full, odd = divmod(min(left, run.count * each), each)
            for many, items in ((full, each), (1 if odd else 0, odd)):
                if many:
                    space = run.free - items * length
                    by_free[space].append(Run(many, (*run.holds, (length, items)), space))
            if spare := run.count - full - bool(odd):
                if run.free < capacity:
                    by_free[run.free].append(run._replace(count=spare))
            left -= full * each + odd
    return [run for runs in by_free for run in runs]


def plan(counts: np.ndarray, capacity: int, groups: int = GROUPS) -> list[Run]:
    """Sequences for counts[length] pieces of every length from 1 to the capacity."""
    rest = counts.copy()
    runs = [Run(int(rest[capacity]), ((capacity, 1),), 0)] if rest[capacity] else []
    rest[capacity] = 0
    smallest = capacity // LARGE
    grouped = linear_groups(rest, smallest, groups)
    if grouped:
        sizes = [group[0][0] for group in grouped]
        demand = np.array([sum(many for _, many in group) for group in grouped], float)
        used = [
            ([size for size, many in zip(sizes, pattern, strict=True) for _ in range(many)], int(times + 1e-9))
            for pattern, times in configurations(sizes, demand, capacity)
        ]
        # Configurations of the largest sizes first, while the lengths that fill their last places are there.
        for pattern, times in sorted(used, reverse=True):
            if times:
                runs += substitute(pattern, times, rest, smallest, capacity)
    return best_fit([run for run in runs if run.holds], rest, capacity)


def places(runs: list[Run]) -> pd.DataFrame:
    """For every length, which of its pieces (by number) go to which sequences: one row for each entry that holds it."""
    rows, taken, sequence = [], {}, 0
    for run in runs:
        offset = 0
        for length, items in run.holds:
            first = taken.get(length, 0)
            taken[length] = first + run.count * items
            rows.append((length, first, sequence, items, offset))
            offset += length * items
        sequence += run.count
    return pd.DataFrame(rows, columns=["length", "first", "sequence", "items", "offset"], dtype="int64")


def numbered(items: DataFrame) -> DataFrame:
    """Add number: the place of a piece among those of its length, from 0. `part` says which task wrote it."""
    counts = items.groupBy("length", "part").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    within = Window.partitionBy("length", "part").orderBy("row.doc_id", "row.piece", "row.start")
    placed = items.withColumn("within", F.row_number().over(within) - 1).join(counts, ["length", "part"])
    return placed.select("row", "length", (F.col("before") + F.col("within")).alias("number"))


def pack(items: DataFrame, capacity: int, groups: int = GROUPS) -> DataFrame:
    """Add sequence_id and offset to pieces, given by doc_id, piece, start and length.

    Other columns are kept, whatever their names; new columns replace those of the same name.
    """
    names = [c for c in items.columns if c not in ("sequence_id", "offset")]
    row = F.struct(*[items[c] for c in names]).alias("row")
    stored = materialize(items.select(row, items["length"].alias("length"), F.spark_partition_id().alias("part")), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, many in stored.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = many
    table = places(plan(counts, capacity, groups))
    entries = {int(k): v.drop(columns="length").to_numpy().T for k, v in table.groupby("length", sort=False)}

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, numbers: pd.Series) -> pd.DataFrame:
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        lengths, numbers = lengths.to_numpy(), numbers.to_numpy()
        order = np.argsort(lengths, kind="stable")
        cuts = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            rows = order[start:stop]
            length = int(lengths[rows[0]])
            first, sequences, items_each, offsets = entries[length]
            at = np.searchsorted(first, numbers[rows], "right") - 1
            past = numbers[rows] - first[at]
            sequence[rows] = sequences[at] + past // items_each[at]
            offset[rows] = offsets[at] + past % items_each[at] * length
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = numbered(stored).select("row", place("length", "number").alias("place"))
    return placed.select(*[F.col("row")[c].alias(c) for c in names], "place.sequence_id", "place.offset")
