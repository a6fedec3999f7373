"""Near-duplicate documents by BagMinHash over multisets of five-word shingles.

Signature. A shingle with multiplicity w owns the levels [0, w) of its weight. Levels are covered by a hierarchy of
Poisson processes: one over [0, 1), and one over each [2**(k-1), 2**k), whose rate is the length of the interval. A
point has a time, a component of the signature and a level; points at levels from w on belong to other documents only.
The signature holds the earliest time of each component, so two documents agree in a component with the probability of
their weighted Jaccard likeness, without bias. Processes are followed only up to a time after which no component is
expected to change (and on, where one is still empty), so that a document costs about its shingles plus
COMPONENTS * log(COMPONENTS) points.

Candidates. The first half of a signature is cut into BANDS bands of ROWS components. Documents that agree in a band meet in a bucket. Its
hub is the member that meets most others in all its buckets. A likeness of 0.8 is missed by all bands with a probability
of 2e-4, one of 0.85 with 2e-6. Candidates are verified by the exact overlap of their multisets, and verified links make
classes. No bucket is compared all with all: each document is first compared with the best connected of its hubs, which
joins most of a group; then those that are in another class than the hub of a bucket, with that hub; then, a few at a
time, with the members of other classes, until each of them has been. In this last step, pairs whose signatures, by two bits of each component, agree
in less than SCREEN of the components are left out before anything moves; for a likeness of 0.8 that is 3.5 standard
deviations off, as rare as a miss by all bands.

Copies of one text are one node throughout, however many there are.

Words are runs of characters other than white space, letters folded. Defined results: a text of one to four words is one
shingle; null and empty texts have none, are copies of each other and like nothing else. Rows of one doc_id with
different texts are separate nodes. A null doc_id takes part and comes last as a representative.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm.arrays import BASE, Words, mix, rolling, words_of
from starling.llm.common import NO_ID, keyed_rows, keyed_texts, steps
from starling.session import materialize

SHINGLE = 5
BANDS, ROWS = 28, 6
COMPONENTS = 336  # the first BANDS * ROWS make the bands, all serve to screen pairs
LIKENESS = 0.8
SCREEN = 0.709
_GOLDEN = np.uint64(BASE)


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: text, hash, multiplicity; in the order of text and hash."""
    hashes, first = words.runs(SHINGLE)
    doc = words.doc[first] if len(first) else first
    short = np.flatnonzero((np.diff(words.bounds) > 0) & (np.diff(words.bounds) < SHINGLE))
    if len(short):
        whole = [int(rolling(words.hashes[a:b], b - a)[0]) for a, b in zip(words.bounds[short], words.bounds[short + 1], strict=True)]
        hashes = np.concatenate([hashes, mix(np.array(whole, np.uint64) + np.uint64(1))])
        doc = np.concatenate([doc, short])
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.flatnonzero((np.diff(doc, prepend=-1) != 0) | np.concatenate([[True], hashes[1:] != hashes[:-1]])[: len(doc)])
    return doc[new], hashes[new], np.diff(np.append(new, len(doc)))


def signatures(doc: np.ndarray, hashes: np.ndarray, weights: np.ndarray, docs: int) -> np.ndarray:
    """Earliest time of each component; infinite for documents without shingles."""
    out = np.full((docs, COMPONENTS), np.inf)
    # Process k of a shingle covers [0, 1) for k = 0, and [2**(k-1), 2**k) beyond.
    shingle, blocks = [np.arange(len(doc))], [np.zeros(len(doc), np.int64)]
    k = 1
    while len(more := np.flatnonzero(weights > 1 << (k - 1))):
        shingle.append(more)
        blocks.append(np.full(len(more), k))
        k += 1
    shingle, block = np.concatenate(shingle), np.concatenate(blocks)
    owner, weight = doc[shingle], weights[shingle]
    low = np.where(block > 0, 1 << np.maximum(block - 1, 0), 0)
    length = np.maximum(low, 1)
    seed = mix(mix(hashes[shingle]) + (block.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
    total = np.bincount(doc, weights, docs)
    until = np.zeros(docs)
    until[total > 0] = (math.log(COMPONENTS) + 3) / total[total > 0]
    todo = np.flatnonzero(total > 0)
    while len(todo):
        wanted = np.zeros(docs, bool)
        wanted[todo] = True
        alive = np.flatnonzero(wanted[owner])
        time, point, chunk = np.zeros(len(alive)), 0, 1
        while len(alive):
            number = (np.arange(point, point + chunk, dtype=np.uint64) + np.uint64(1)) * _GOLDEN
            random = mix(seed[alive][:, None] + number)
            wait = -np.log(((random >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53)
            times = wait / (COMPONENTS * length[alive][:, None])
            times[:, 0] += time
            times = np.cumsum(times, axis=1)
            hit = times <= until[owner[alive]][:, None]
            row, column = np.nonzero(hit)
            other = mix(random[row, column])
            component = ((other >> np.uint64(32)) * np.uint64(COMPONENTS)) >> np.uint64(32)
            span = length[alive[row]].astype(np.uint64)
            level = low[alive[row]] + (((other & np.uint64(0xFFFFFFFF)) * span) >> np.uint64(32)).astype(np.int64)
            own = level < weight[alive[row]]
            cell = owner[alive[row[own]]] * COMPONENTS + component[own].astype(np.int64)
            np.minimum.at(out.reshape(-1), cell, times[row[own], column[own]])
            time = times[:, -1][hit[:, -1]]
            alive = alive[hit[:, -1]]
            point, chunk = point + chunk, min(max(1, point + chunk), 1 << 8)
        # Where a component is still empty its earliest point comes later: the document is followed for longer.
        todo = todo[np.isinf(out[todo]).any(axis=1)]
        until[todo] *= 2
        out[todo] = np.inf
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """One hash for each document and band."""
    parts = signature[:, : BANDS * ROWS].copy().view(np.uint64).reshape(len(signature), BANDS, ROWS)
    out = np.repeat(np.arange(BANDS, dtype=np.uint64)[None, :] * _GOLDEN, len(signature), axis=0)
    for i in range(ROWS):
        out = mix(out * _GOLDEN + parts[:, :, i])
    return out.view(np.int64)


def screens(signature: np.ndarray) -> np.ndarray:
    """Two bits of each component, 32 components to a number."""
    wide = -(-COMPONENTS // 32) * 32
    bits = np.zeros((len(signature), wide), np.uint64)
    bits[:, :COMPONENTS] = mix(signature.view(np.uint64)) >> np.uint64(62)
    places = np.tile(np.arange(0, 64, 2, dtype=np.uint64), wide // 32)
    return np.bitwise_or.reduce((bits << places).reshape(len(signature), -1, 32), axis=2).view(np.int64)


def other_components(left: Column, right: Column) -> Column:
    """In how many components two screens differ."""
    out = F.lit(0)
    for i in range(-(-COMPONENTS // 32)):
        both = left[i].bitwiseXOR(right[i])
        either = both.bitwiseOR(F.shiftrightunsigned(both, 1)).bitwiseAND(F.lit(0x5555555555555555))
        out = out + F.bit_count(either)
    return out


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, copy, units (how many shingles), bands and screen (both null for texts without words) from doc_id, copy and text."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            words = words_of([t.encode() for t in step.column("text").to_pylist()], folded=True)
            doc, hashes, weights = shingles(words)
            signature = signatures(doc, hashes, weights, step.num_rows)
            size = np.bincount(doc, weights, step.num_rows).astype(np.int64)
            there = size > 0
            columns = [step.column("doc_id"), step.column("copy"), pa.array(size)]
            for rows in (bands(signature), screens(signature)):
                listed = [r if some else None for r, some in zip(rows, there, strict=True)]
                columns.append(pa.array(listed, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "copy", "units", "bands", "screen"])

    return docs.mapInArrow(sketch, "doc_id long, copy long, units long, bands array<long>, screen array<long>")


def with_units(docs: DataFrame) -> DataFrame:
    """copy and units: a hash for each shingle and each time it occurs, so that the multiset is a set."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps(batches):
            words = words_of([t.encode() for t in step.column("text").to_pylist()], folded=True)
            doc, hashes, weights = shingles(words)
            nth = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
            units = mix(np.repeat(hashes, weights) + nth.astype(np.uint64) * _GOLDEN).view(np.int64)
            sizes = np.bincount(doc, weights, step.num_rows).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(units))
            yield pa.RecordBatch.from_arrays([step.column("copy"), lists], names=["copy", "units"])

    return docs.mapInArrow(unfold, "copy long, units array<long>")


def likeness(left: Column, right: Column) -> Column:
    """Weighted Jaccard likeness of two unfolded multisets."""
    both = F.size(F.array_intersect(left, right))
    return both / (F.size(left) + F.size(right) - both)


def verified(pairs: DataFrame, units: DataFrame, least: float) -> DataFrame:
    """Links (a, b) of classes, stored: those (a_root, b_root) of pairs (a, b) of nodes whose multisets overlap enough."""
    left = units.select(F.col("copy").alias("a"), F.col("units").alias("left"))
    right = units.select(F.col("copy").alias("b"), F.col("units").alias("right"))
    joined = pairs.join(left, "a").join(right, "b")
    ratio = F.least(F.size("left"), F.size("right")) / F.greatest(F.size("left"), F.size("right"))
    joined = joined.filter((ratio >= least) & (likeness(F.col("left"), F.col("right")) >= least))
    return materialize(joined.select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct(), "verified")


def connected(links: DataFrame) -> DataFrame:
    """node and root (the smallest node of its component) of every node in links (a, b).

    Each round every node takes the smallest root around it and then that root's own; rounds end when nothing changes.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    both = materialize(both.unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other"))).distinct(), "links")
    roots = both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("root"))
    roots = materialize(roots, "roots")
    while True:
        around = both.join(roots.select(F.col("node").alias("other"), "root"), "other").groupBy("node").agg(F.min("root").alias("near"))
        near = roots.join(around, "node").select("node", F.col("root").alias("was"), F.least("root", "near").alias("step"))
        own = roots.select(F.col("node").alias("step"), F.col("root").alias("far"))
        new = near.join(own, "step", "left")
        new = new.select("node", F.least("step", F.coalesce("far", "step")).alias("root"), "was")
        new = materialize(new, "roots")
        if new.filter("root <> was").isEmpty():
            return new.select("node", "root")
        roots = new.select("node", "root")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """roots (node, root) after more links of classes. Only the classes that they connect are gone through again."""
    if links.isEmpty():
        return roots
    new = connected(links).select(F.col("node").alias("root"), F.col("root").alias("new"))
    return materialize(roots.join(new, "root", "left").select("node", F.coalesce("new", "root").alias("root")), "roots")


def _with_roots(shared: DataFrame, roots: DataFrame) -> DataFrame:
    return materialize(shared.join(roots.withColumnRenamed("node", "copy"), "copy"), "members")


def _outside(members: DataFrame) -> DataFrame:
    """Members whose class is not that of their bucket's hub, and the hub's class."""
    own = members.filter("copy = hub").select("bucket", F.col("root").alias("hub_root"))
    return members.join(own, "bucket").filter("root <> hub_root")


def _further(
    members: DataFrame, nodes: DataFrame, used: DataFrame | None, width: int, least: float
) -> tuple[DataFrame, DataFrame]:
    """Pivots (bucket, pivot) of the next round, and their pairs (a, b) with members of other classes.

    Pivots are members outside the class of their bucket's hub that were none before: up to `width` for each bucket, the
    smallest of each of as many parts. They were compared with the hub already. A pair comes from one common bucket only.
    """
    outside = _outside(members)
    if used is not None:
        outside = outside.join(used.withColumnRenamed("pivot", "copy"), ["bucket", "copy"], "left_anti")
    part = F.pmod(F.xxhash64("copy"), F.lit(width))
    pivots = outside.groupBy("bucket", part.alias("part")).agg(F.min(F.struct("copy", "root")).alias("pivot"))
    pivots = materialize(pivots.select("bucket", "pivot.copy", "pivot.root"), "pivots")
    sketches = nodes.select("copy", "units", "bands", "screen")
    own = [F.col(c).alias(f"own_{c}") for c in ("copy", "root", "units", "bands", "screen")]
    left = pivots.join(sketches, "copy").select("bucket", *own)
    right = members.filter("copy <> hub").join(pivots.select("bucket").distinct(), "bucket", "left_semi").join(sketches, "copy")
    # Two bits of different components are equal once in four times.
    agree = other_components(F.col("own_screen"), F.col("screen")) <= int(0.75 * (1 - SCREEN) * COMPONENTS)
    once = F.array_min(F.array_intersect("own_bands", "bands")) == F.col("bucket")
    sizes = F.least("own_units", "units") >= least * F.greatest("own_units", "units")
    met = left.join(right, "bucket").filter((F.col("root") != F.col("own_root")) & sizes & agree & once)
    first = F.col("own_copy") < F.col("copy")
    sides = F.struct("own_copy", "own_root"), F.struct(F.col("copy").alias("own_copy"), F.col("root").alias("own_root"))
    a, b = F.when(first, sides[0]).otherwise(sides[1]), F.when(first, sides[1]).otherwise(sides[0])
    pairs = met.select(a.alias("a"), b.alias("b")).distinct()
    pairs = pairs.select(*[F.col(x)[f"own_{c}"].alias(n) for x in "ab" for c, n in (("copy", x), ("root", f"{x}_root"))])
    return pivots.select("bucket", F.col("copy").alias("pivot")), pairs


def near_duplicates(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """doc_id, copy (hash of the text), class_id (the smallest doc_id of its class) and class_copy (the text of that row).

    One row for each row of docs. A class is what verified links and equal texts connect.
    """
    texts = keyed_texts(docs)
    # One node for each text; copies have the same bands.
    own = [F.first(c).alias(c) for c in ("units", "bands", "screen")]
    nodes = materialize(sketched(texts).groupBy("copy").agg(F.min("doc_id").alias("first_id"), *own), "nodes")
    members = nodes.select("copy", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    met = materialize(members.join(sizes, "bucket"), "met")
    degrees = met.groupBy("copy").agg(F.sum("size").alias("degree"))
    best = F.max(F.struct("degree", "copy")).alias("best")
    hubs = met.join(degrees, "copy").groupBy("bucket").agg(best).select("bucket", F.col("best.copy").alias("hub"), F.col("best.degree").alias("degree"))
    shared = materialize(met.select("copy", "bucket").join(hubs, "bucket"), "buckets")
    # Only texts that share a bucket are read again, one row for each.
    wanted = shared.select("copy").distinct().join(nodes, "copy")
    wanted = wanted.select("copy", F.coalesce("first_id", F.lit(NO_ID)).alias("id"))
    # As many as the table has near duplicates: merged, never broadcast.
    read = texts.join(wanted.hint("merge"), ["copy", "id"]).select("copy", "text")
    units = materialize(with_units(read).dropDuplicates(["copy"]), "units")

    first = shared.filter("copy <> hub").groupBy("copy").agg(F.max(F.struct("degree", "hub")).alias("best"))
    first = first.select("copy", F.col("best.hub").alias("first"))
    pairs = first.select(*[F.col(c).alias(n) for c, n in (("copy", "a"), ("first", "b"), ("copy", "a_root"), ("first", "b_root"))])
    roots = shared.select(F.col("copy").alias("node")).distinct().withColumn("root", F.col("node"))
    roots = merged(roots, verified(pairs, units, least))
    members = _with_roots(shared, roots)
    outside = _outside(members).join(first, "copy").filter("hub <> first")
    pairs = outside.select(*[F.col(c).alias(n) for c, n in (("copy", "a"), ("hub", "b"), ("root", "a_root"), ("hub_root", "b_root"))])
    roots = merged(roots, verified(pairs.distinct(), units, least))
    members, used, width = _with_roots(shared, roots), None, 16
    while True:
        pivots, pairs = _further(members, nodes, used, width, least)
        if pivots.isEmpty():
            break
        after = merged(roots, verified(pairs, units, least))
        if after is not roots:
            roots, members = after, _with_roots(shared, after)
        used = pivots if used is None else used.unionByName(pivots)
        width *= 16

    classes = nodes.select("copy", "first_id").join(roots.withColumnRenamed("node", "copy"), "copy", "left")
    classes = classes.withColumn("root", F.coalesce("root", "copy"))
    order = F.coalesce("first_id", F.lit((1 << 63) - 1))
    firsts = classes.groupBy("root").agg(F.min(F.struct(order, "first_id", "copy")).alias("first"))
    classes = classes.join(firsts, "root")
    classes = classes.select("copy", F.col("first.first_id").alias("class_id"), F.col("first.copy").alias("class_copy"))
    return texts.select("doc_id", "copy").join(classes, "copy")


def representatives(docs: DataFrame, least: float = LIKENESS) -> DataFrame:
    """docs without all rows of a class but one, with its own columns. A repeated row stays once."""
    found = near_duplicates(docs, least)
    kept = found.filter((F.col("copy") == F.col("class_copy")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    kept = kept.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "copy").distinct()
    rows = keyed_rows(docs).drop("text").join(kept, ["id", "copy"])
    return rows.dropDuplicates(["id", "copy"]).select("row.*")
