"""Remove every word covered by a run of WINDOW words that also starts anywhere else, by fixed-block anchors.

1. Index and probe. Each text is cut into non-overlapping blocks of half a window (rounded up). A window that starts in
   two places holds a whole block of either text, and the other place has the same words at some rolling position. So all
   blocks are indexed, and every rolling run of a block's length probes them. Hashes meet in shards: a task sends each
   different probe at most twice for each shard and flush, with 40 bits beyond those that the shard takes, so a frequent
   run of words costs as little as a rare one. A block that fewer than two rolling positions equal is in no repeat.
2. Extension. Around the blocks that were hit all windows are compared by their full hash, in shards of the smallest
   block hash in the window. Neighbouring windows of one shard go as one run. Equal runs of one flush are known to
   repeat and go on as one. Runs of windows that repeat, joined, are the maximal exact repeats.

No two texts are compared with each other, and no group of copies comes together but as one entry for each flush.

Words are runs of bytes other than space, tab and line ends, unchanged. Defined results: null and empty texts, and texts
of fewer than WINDOW words, keep all words. Repeated rows are copies of each other. Matches never cross texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.arrays import BASE, Words, mix, rolling, sliding_min, words_of
from starling.llm.common import joined_texts, keyed_texts, steps
from starling.session import materialize

WINDOW = 35
SHARD_CHARS = 8 << 20  # characters of text for each shard
FLUSH = 1 << 20  # probes that a task gathers before it sends them
STEP = 256 << 10  # characters that are hashed at a time
_TAIL = 5  # bytes
_GOLDEN = np.uint64(BASE)


def _shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each hash: in the order of the hashes, from their high bits."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _tails(hashes: np.ndarray) -> bytes:
    return np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_TAIL]).tobytes()


def _from_tails(parts: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, _TAIL)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :_TAIL] = raw
    return wide.view("<u8").reshape(-1)


def _joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _words(step: pa.RecordBatch) -> tuple[Words, np.ndarray, np.ndarray]:
    words = words_of([t.encode() for t in step.column("text").to_pylist()])
    return words, step.column("id").to_numpy(), step.column("copy").to_numpy()


def block_length(window: int) -> int:
    return (window + 1) // 2


def indexed(texts: DataFrame, window: int, shards: int) -> DataFrame:
    """For each shard and flush: tails of all probes; and tails, id, copy and number of all blocks."""
    block = block_length(window)

    def flush(probes: list, blocks: list) -> Iterator[pa.RecordBatch]:
        probes = np.concatenate(probes)
        probes.sort()
        # Once where a run of words occurs once here, twice where it occurs more often.
        third = np.zeros(len(probes), bool)
        third[2:] = probes[2:] == probes[:-2]
        probes = probes[~third]
        hashes, ids, copies, numbers = (np.concatenate(x) for x in zip(*blocks, strict=True))
        order = np.argsort(hashes, kind="stable")
        hashes, ids, copies, numbers = hashes[order], ids[order], copies[order], numbers[order]
        edges = np.arange(shards + 1)
        at, own = (np.searchsorted(_shard(h, shards), edges) for h in (probes, hashes))
        rows = []
        for i in np.flatnonzero((np.diff(at) > 0) | (np.diff(own) > 0)):
            p, b = slice(at[i], at[i + 1]), slice(own[i], own[i + 1])
            rows.append((i, _tails(probes[p]), _tails(hashes[b]), ids[b].tobytes(), copies[b].tobytes(), numbers[b].tobytes()))
        kinds = pa.int32(), *[pa.binary()] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, kind) for v, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["shard", "probes", "blocks", "ids", "copies", "numbers"],
        )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes, blocks, held = [], [], 0
        for step in steps(batches, most=STEP):
            words, ids, copies = _words(step)
            hashes, first = words.runs(block)
            if not len(hashes):
                continue
            doc = words.doc[first]
            place = first - words.bounds[doc]
            own = place % block == 0
            probes.append(hashes)
            blocks.append((hashes[own], ids[doc[own]], copies[doc[own]], (place[own] // block).astype("<i8")))
            held += len(hashes)
            if held >= FLUSH:
                yield from flush(probes, blocks)
                probes, blocks, held = [], [], 0
        if held:
            yield from flush(probes, blocks)

    return texts.mapInArrow(index, "shard int, probes binary, blocks binary, ids binary, copies binary, numbers binary")


def hit_blocks(entries: DataFrame) -> DataFrame:
    """id, copy and number of the blocks that at least two rolling positions equal."""

    def match(table: pa.Table) -> pa.Table:
        probes = _from_tails(table.column("probes").to_pylist())
        tails = _from_tails(table.column("blocks").to_pylist())
        known, which = np.unique(tails, return_inverse=True)
        if len(known):
            at = np.minimum(np.searchsorted(known, probes), len(known) - 1)
            counts = np.bincount(at[known[at] == probes], minlength=len(known))
            hit = counts[which] > 1
        else:
            hit = np.zeros(0, bool)
        columns = {"id": "ids", "copy": "copies", "number": "numbers"}
        return pa.table({name: pa.array(_joined(table.column(c), "<i8")[hit]) for name, c in columns.items()})

    return entries.groupBy("shard").applyInArrow(match, "id long, copy long, number long")


def window_runs(texts: DataFrame, hits: DataFrame, window: int, shards: int) -> DataFrame:
    """Runs of windows around hit blocks, packed: for each shard and flush hashes, sizes, and the runs' owners and starts.

    A null shard holds runs that are known to repeat. In other rows owned says which runs wait for an answer.
    """
    block = block_length(window)
    lists = hits.groupBy("id", "copy").agg(F.collect_set("number").alias("numbers"))

    def found(step: pa.RecordBatch) -> tuple | None:
        words, ids, copies = _words(step)
        hashes = rolling(words.hashes, window)
        if not len(hashes):
            return None
        # Windows that hold a hit block: they start at most window - block words before it.
        change = np.zeros(len(hashes) + 1, np.int64)
        for i, numbers in enumerate(step.column("numbers").to_pylist()):
            at = words.bounds[i] + block * np.array(numbers)
            last = words.bounds[i + 1] - window
            if last >= words.bounds[i]:
                low = np.maximum(at - (window - block), words.bounds[i])
                high = np.minimum(at, last) + 1
                np.add.at(change, low[high > low], 1)
                np.add.at(change, high[high > low], -1)
        starts = np.flatnonzero(np.cumsum(change[:-1]) > 0)
        if not len(starts):
            return None
        anchors = sliding_min(mix(rolling(words.hashes, block)), window - block + 1)[starts]
        doc = words.doc[starts]
        new = np.flatnonzero((np.diff(starts, prepend=-2) != 1) | (np.diff(doc, prepend=-1) != 0) | np.append(True, anchors[1:] != anchors[:-1]))
        sizes = np.diff(np.append(new, len(starts)))
        full = mix(hashes[starts])
        place = np.arange(len(starts)) - np.repeat(new, sizes)
        content = np.add.reduceat(mix(full + place.astype(np.uint64) * _GOLDEN), new) + sizes.astype(np.uint64)
        owner = doc[new]
        return full, sizes, mix(anchors[new]), content, ids[owner], copies[owner], starts[new] - words.bounds[owner]

    def flush(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        full, sizes, anchors, content, ids, copies, starts = (np.concatenate(x) for x in zip(*parts, strict=True))
        begins = np.cumsum(sizes) - sizes
        _, first, which, times = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
        known = times[which] > 1
        sent = ~known
        sent[first] = True  # one for all that are equal
        rows = []
        if known.any():
            rows.append((None, b"", *(x[known].astype("<i8").tobytes() for x in (sizes, starts, ids, copies)), b""))
        runs = np.flatnonzero(sent)
        runs = runs[np.argsort(anchors[runs], kind="stable")]
        at = np.searchsorted(_shard(anchors[runs], shards), np.arange(shards + 1))
        for i in np.flatnonzero(np.diff(at)):
            own = runs[at[i] : at[i + 1]]
            hashes = np.concatenate([full[b : b + n] for b, n in zip(begins[own], sizes[own], strict=True)])
            packed = (x[own].astype("<i8").tobytes() for x in (sizes, starts, ids, copies))
            rows.append((i, hashes.tobytes(), *packed, (~known[own]).astype(np.uint8).tobytes()))
        kinds = pa.int32(), *[pa.binary()] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, kind) for v, kind in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=["shard", "hashes", "sizes", "starts", "ids", "copies", "owned"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for step in steps(batches, most=STEP):
            if (part := found(step)) is not None:
                parts.append(part)
                held += len(part[0])
            if held >= FLUSH:
                yield from flush(parts)
                parts, held = [], 0
        if held:
            yield from flush(parts)

    schema = "shard int, hashes binary, sizes binary, starts binary, ids binary, copies binary, owned binary"
    return texts.join(lists, ["id", "copy"]).mapInArrow(run, schema)


def repeated_runs(packed: DataFrame) -> DataFrame:
    """id, copy, and runs [start, end) of windows that repeat."""
    schema = "id long, copy long, start long, end long"

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in batches:
            sizes, starts, ids, copies = (_joined(step.column(c), "<i8") for c in ("sizes", "starts", "ids", "copies"))
            columns = [pa.array(x) for x in (ids, copies, starts, starts + sizes)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "copy", "start", "end"])

    def count(table: pa.Table) -> pa.Table:
        hashes = _joined(table.column("hashes"), "<u8")
        sizes, starts, ids, copies = (_joined(table.column(c), "<i8") for c in ("sizes", "starts", "ids", "copies"))
        owned = _joined(table.column("owned"), np.uint8).astype(bool)
        _, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
        run = np.repeat(np.arange(len(sizes)), sizes)
        hit = np.flatnonzero((times[which] > 1) & owned[run])
        run = run[hit]
        place = hit - (np.cumsum(sizes) - sizes)[run] + starts[run]
        new = np.flatnonzero((np.diff(hit, prepend=-2) != 1) | (np.diff(run, prepend=-1) != 0))
        many = np.diff(np.append(new, len(hit)))
        run, place = run[new], place[new]
        return pa.table({"id": ids[run], "copy": copies[run], "start": place, "end": place + many})

    known = packed.filter("shard IS NULL").mapInArrow(unpack, schema)
    return known.unionByName(packed.filter("shard IS NOT NULL").groupBy("shard").applyInArrow(count, schema))


def repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """id, copy and spans: runs [start, end) of window starts, counted in words, of all texts that have some."""
    texts = keyed_texts(docs).drop("doc_id")
    chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    shards = chars // SHARD_CHARS + 1
    hits = materialize(hit_blocks(indexed(texts, window, shards)), "hits")
    packed = materialize(window_runs(texts, hits, window, shards), "runs")
    return repeated_runs(packed).groupBy("id", "copy").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add kept (the remaining words, joined by a space), n_words and n_removed to the rows of docs."""
    stored = materialize(repeats(docs, window), "repeats")

    def remove(text: str, spans: list[dict] | None) -> tuple[str, int, int]:
        words = text.encode().split()
        if not spans:
            return b" ".join(words).decode(), len(words), 0
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, [s["start"] for s in spans], 1)
        np.add.at(change, [s["end"] - 1 + window for s in spans], -1)
        stays = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        return b" ".join([words[i] for i in stays]).decode(), len(words), len(words) - len(stays)

    kinds = {"kept": pa.string(), "n_words": pa.int64(), "n_removed": pa.int64()}
    return joined_texts(docs, stored, "spans", remove, kinds)
