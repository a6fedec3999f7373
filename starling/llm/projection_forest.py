"""Nearest neighbours by largest inner product, with a forest of random-projection trees.

1. Lift. With M the largest norm of all vectors, a candidate x becomes (x, sqrt(M**2 - |x|**2)) and a query q (q * M / |q|, 0).
   The nearest lifted points are those of largest inner product.
2. Fit. TREES trees are built on the driver from at most SAMPLE vectors (those of smallest hash, SAMPLE_BYTES at most).
   A node projects its points on the difference of two of them, drawn at random, and splits at the median, until leaves
   hold about LEAF points of the sample.
3. Index. Every vector goes down each tree to one leaf.
4. Search. One priority queue of a query holds open nodes of all trees, by the squared distance to their side of the splits
   above. The nearest node is opened until `visits` leaves have been reached, and further until these surely hold enough
   rows. `visits` is the smallest number with which the trees find a share RECALL of the true neighbours within the sample.
5. Rerank. Leaves are cut into units of at most about UNIT rows; a unit meets the queries that have reached one of its
   leaves, batch by batch, and keeps the best of each by exact products, ties with the smaller vec_id. The best of all
   units, each row once, are the result. Large leaves, and many queries, are split over several units.
   This is done for the FIRST nearest leaves of a query, and then for the others: what is worse there than the last of
   the first best cannot be in the result, and does not leave its unit. So units send a number of rows for each query
   that does not grow with the number of units.

On data without any structure the neighbours of a query are spread over many leaves; then `visits` is large, and the search
costs a fixed share of comparing all. More rows than the sample make leaves larger, not more.

Defined results: vectors that are null, zero, of another length than most of the sample, or that hold null or non-finite
components take no part. Rows are told apart even if repeated: each is a query and a candidate of its own. A null vec_id
is no query; as a candidate it comes last among ties. An empty table, and one of a single vector, give no row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starling.llm.common import finite_vectors
from starling.session import materialize

TREES = 4
SAMPLE = 20_000
SAMPLE_BYTES = 32 << 20
LEAF = 16
TRIALS = 256  # vectors of the sample that serve as queries to set `visits`
RECALL = 0.95
FIRST = 2 * TREES  # leaves
UNIT = 4096  # rows
BLOCK = 1 << 16  # queries of a unit
BATCH = 256  # queries compared together


class Forest(NamedTuple):
    planes: np.ndarray  # tree, node, component: float32; children of node i are 2 i + 1 and 2 i + 2
    cuts: np.ndarray  # tree, node: points with a projection beyond it go right
    largest: float  # norm
    visits: int

    @property
    def leaves(self) -> int:
        return self.cuts.shape[1] + 1


class Units(NamedTuple):
    unit: np.ndarray  # tree, leaf: its first unit
    blocks: np.ndarray  # tree, leaf: over how many units its rows are spread
    sizes: np.ndarray  # tree, leaf: rows
    query_blocks: int


def lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    rest = np.maximum(largest**2 - (vectors**2).sum(axis=1), 0)
    return np.column_stack([vectors, np.sqrt(rest)])


def lifted_queries(vectors: np.ndarray, largest: float) -> np.ndarray:
    scale = largest / np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.column_stack([vectors * scale, np.zeros(len(vectors))])


def grow(points: np.ndarray, depth: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Planes and cuts of one tree."""
    planes, cuts = np.zeros(((1 << depth) - 1, points.shape[1]), np.float32), np.zeros((1 << depth) - 1)
    held = [np.arange(len(points))]
    for node in range(len(cuts)):
        own = held[node]
        if len(own) > 1:
            a, b = points[rng.choice(own, 2, replace=False)]
            apart = a - b
        else:
            apart = np.zeros(points.shape[1])
        if not apart.any():
            apart = rng.normal(size=points.shape[1])
        planes[node] = apart / np.linalg.norm(apart)
        seen = points[own] @ planes[node].astype(float)
        cuts[node] = np.median(seen) if len(own) else 0.0
        right = seen > cuts[node]
        held += [own[~right], own[right]]
    return planes, cuts


def leaves_of(forest: Forest, points: np.ndarray) -> np.ndarray:
    """The leaf of each lifted point in each tree."""
    out = np.empty((len(points), len(forest.cuts)), np.int32)
    for tree, (planes, cuts) in enumerate(zip(forest.planes, forest.cuts, strict=True)):
        node = np.zeros(len(points), np.int64)
        while len(node) and node[0] < len(cuts):
            seen = np.einsum("ij,ij->i", points, planes[node].astype(float))
            node = 2 * node + 1 + (seen > cuts[node])
        out[:, tree] = node - len(cuts)
    return out


def reached(forest: Forest, query: np.ndarray, sizes: np.ndarray, enough: int, visits: int | None = None) -> list[tuple[int, int]]:
    """Leaves (tree, leaf) in the order in which the shared queue gives them out.

    At least `visits` leaves, and so many that those of one tree hold `enough` rows, if there are so many.
    """
    visits = forest.visits if visits is None else visits
    margins = forest.planes @ query - forest.cuts
    inner = forest.cuts.shape[1]
    queue = [(0.0, tree, 0) for tree in range(len(forest.cuts))]
    out: list[tuple[int, int]] = []
    held = [0] * len(forest.cuts)
    while queue and (len(out) < visits or max(held) < enough):
        cost, tree, node = heapq.heappop(queue)
        while node < inner:
            margin = margins[tree, node]
            right = margin > 0
            heapq.heappush(queue, (cost + margin * margin, tree, 2 * node + 2 - right))
            node = 2 * node + 1 + right
        out.append((tree, node - inner))
        held[tree] += sizes[tree, node - inner]
    return out


def fit(sample: np.ndarray, largest: float, wanted: int, recall: float = RECALL, seed: int = 7) -> Forest:
    """Trees over a bounded sample, and how many leaves a query has to visit."""
    rng = np.random.default_rng(seed)
    points = lifted(sample, largest)
    depth = max(0, int(np.log2(max(1, len(points) / LEAF))))
    grown = [grow(points, depth, rng) for _ in range(TREES)]
    forest = Forest(np.stack([p for p, _ in grown]), np.stack([c for _, c in grown]), largest, TREES << depth)
    own = leaves_of(forest, points)
    trials = rng.permutation(len(sample))[:TRIALS]
    queries = lifted_queries(sample[trials], largest)
    sizes = np.stack([np.bincount(own[:, t], minlength=forest.leaves) for t in range(TREES)])
    counts = np.zeros((TREES << depth) + 1)
    for at, query in zip(trials, queries, strict=True):
        products = sample @ sample[at]
        products[at] = -np.inf
        best = np.argsort(-products, kind="stable")[: min(wanted, len(sample) - 1)]
        rank = np.empty((TREES, forest.leaves), np.int64)
        for place, leaf in enumerate(reached(forest, query, sizes, 0, TREES << depth)):
            rank[leaf] = place + 1
        counts += np.bincount(rank[np.arange(TREES), own[best]].min(axis=1), minlength=len(counts))
    found = np.cumsum(counts)
    visits = int(np.searchsorted(found, recall * found[-1])) if found[-1] else 1
    return forest._replace(visits=max(1, visits))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(float)


def prepared(vectors: DataFrame, vector: str) -> tuple[DataFrame, int, float]:
    """Stored rows (row, vec_id, vector) that take part, how many there are, and the largest norm."""
    rows = finite_vectors(vectors, vector, ("vec_id",))
    rows = rows.filter(F.exists("vector", lambda x: x != 0))
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), "vector"), "vectors")
    size = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if size is None:
        return rows, 0, 0.0
    rows = rows.filter(F.size("vector") == size["size"])
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    return rows, size["count"], rows.agg(F.max(norm)).first()[0]


def sampled(rows: DataFrame, count: int, dims: int) -> np.ndarray:
    """A bounded sample of vectors: those whose hash is below a share of all values, in its order."""
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * dims)))
    by = F.xxhash64("row")
    if count > 2 * most:
        rows = rows.filter(F.pmod(by, F.lit(1 << 30)) < int(2 * most / count * (1 << 30)) + 1)
    found = rows.orderBy(by, "row").limit(most).select("vector").toArrow()
    return _matrix(found.column("vector").combine_chunks())


def _indexed(rows: DataFrame, forest: Forest) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = leaves_of(shared.value, lifted(_matrix(batch.column("vector")), shared.value.largest))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, leaves.size + 1, leaves.shape[1]), pa.int32()), pa.array(leaves.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["row", "vec_id", "vector", "leaves"])

    return rows.mapInArrow(run, "row long, vec_id long, vector array<double>, leaves array<int>")


def planned(indexed: DataFrame, forest: Forest, queries: int) -> Units:
    """Units of about UNIT rows: some leaves of one tree, or a part of a large leaf. One number for each leaf is read."""
    found = indexed.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().toPandas()
    sizes = np.zeros((len(forest.cuts), forest.leaves), np.int64)
    sizes[found["tree"], found["leaf"]] = found["count"]
    unit, blocks = np.zeros_like(sizes), np.ones_like(sizes)
    current = 0
    for tree in range(len(sizes)):
        held = 0
        for leaf, size in enumerate(sizes[tree]):
            if held and held + size > UNIT:
                current, held = current + 1, 0
            unit[tree, leaf], blocks[tree, leaf] = current, max(1, -(-size // UNIT))
            held += size
            current += blocks[tree, leaf] - 1
        current += 1
    return Units(unit, blocks, sizes, max(1, -(-queries // BLOCK)))


_SIDES = "unit long, block int, leaf array<int>, row long, vec_id long, vector array<double>, least double"
_NAMES = ["unit", "block", "leaf", "row", "vec_id", "vector", "least"]


def _candidates(indexed: DataFrame, units: Units) -> DataFrame:
    """Each row once for each tree (and block of queries), with its unit and leaf."""
    shared = indexed.sparkSession.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            leaves = _matrix(batch.column("leaves")).astype(np.int32) if batch.num_rows else np.zeros((0, 0), np.int32)
            row = batch.column("row").to_numpy()
            for tree in range(leaves.shape[1]):
                leaf = leaves[:, tree]
                unit = plan.unit[tree, leaf] + row % plan.blocks[tree, leaf]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(leaf) + 1), pa.int32()), pa.array(leaf))
                for block in range(plan.query_blocks):
                    columns = [pa.array(unit), pa.array(np.full(len(unit), block, np.int32)), lists]
                    columns += [*[batch.column(c) for c in _NAMES[3:-1]], pa.nulls(len(unit), pa.float64())]
                    yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return indexed.mapInArrow(run, _SIDES)


def _searches(queries: DataFrame, forest: Forest, units: Units, wanted: int, part: slice) -> DataFrame:
    """Each query once for each unit that holds rows of a leaf it has reached, with these leaves, or a part of them."""
    shared = queries.sparkSession.sparkContext.broadcast((forest, units))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, plan = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column("row").to_numpy()
            owner, unit, lists = [], [], []
            for i, query in enumerate(lifted_queries(_matrix(batch.column("vector")), trees.largest)):
                met: dict[int, list[int]] = {}
                for tree, leaf in reached(trees, query, plan.sizes, wanted + 1)[part]:
                    first = int(plan.unit[tree, leaf])
                    for number in range(first, first + int(plan.blocks[tree, leaf])):
                        met.setdefault(number, []).append(leaf)
                owner += [i] * len(met)
                unit += met.keys()
                lists += met.values()
            at = pa.array(owner, pa.int64())
            block = pa.array(rows[owner] % plan.query_blocks, pa.int32())
            own = [batch.column(c).take(at) for c in _NAMES[3:]]
            yield pa.RecordBatch.from_arrays([pa.array(unit, pa.int64()), block, pa.array(lists, pa.list_(pa.int32())), *own], names=_NAMES)

    return queries.mapInArrow(run, _SIDES)


def best_of(
    queries: np.ndarray, own_rows: np.ndarray, asked: list[list[int]], above: np.ndarray, points: np.ndarray, rows: np.ndarray,
    ids: np.ndarray, bounds: dict[int, tuple[int, int]], wanted: int,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its place, its best points of at least some product, and their products.

    Points come by leaf; ids are floats, infinite for null.
    """
    scores = np.full((len(queries), len(points)), -np.inf)
    by_leaf: dict[int, list[int]] = {}
    for i, leaves in enumerate(asked):
        for leaf in leaves:
            by_leaf.setdefault(leaf, []).append(i)
    for leaf, who in by_leaf.items():
        if leaf in bounds:
            a, b = bounds[leaf]
            scores[who, a:b] = queries[who] @ points[a:b].T
    scores[own_rows[:, None] == rows[None, :]] = -np.inf
    reach = np.abs(scores, where=np.isfinite(scores), out=np.zeros_like(scores)).max(axis=1, initial=0)
    for i, row in enumerate(scores):
        least = np.partition(row, -wanted)[-wanted] if len(row) > wanted else -np.inf
        # Sums of another order may differ in the last digits: all that could belong to the best are summed alike.
        near = np.flatnonzero((row >= max(least, above[i]) - 1e-9 * reach[i]) & (row > -np.inf))
        exact = (points[near] * queries[i]).sum(axis=1)
        near, exact = near[exact >= above[i]], exact[exact >= above[i]]
        order = np.lexsort((rows[near], ids[near], -exact))[:wanted]
        yield i, near[order], exact[order]


def _met(sides: DataFrame, wanted: int) -> DataFrame:
    """query, query_id, row, vec_id and score: the best of each unit. Of a unit the rows come first, then its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, points = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("unit", "block")], axis=1)
            kinds = batch.column("query").to_numpy(zero_copy_only=False)
            new = np.any(np.diff(keys, axis=0, prepend=-1) != 0, axis=1) | (np.diff(kinds.astype(int), prepend=-1) != 0)
            starts = np.flatnonzero(new)
            for a, b in zip(starts, np.append(starts[1:], len(keys)), strict=True):
                own, part = tuple(keys[a]), batch.slice(a, b - a)
                if own != key:
                    key, held, points = own, [], None
                if not kinds[a]:
                    held.append(part)
                    continue
                if held and points is None:
                    table = pa.Table.from_batches(held).combine_chunks()
                    leaf = table.column("leaf").combine_chunks().flatten().to_numpy()
                    edges = np.flatnonzero(np.diff(leaf, prepend=-1))
                    bounds = {int(leaf[x]): (int(x), int(y)) for x, y in zip(edges, np.append(edges[1:], len(leaf)), strict=True)}
                    ids = table.column("vec_id").combine_chunks()
                    points = _matrix(table.column("vector").combine_chunks()), table.column("row").to_numpy(), ids.cast(pa.float64(), safe=False).fill_null(np.inf).to_numpy(), ids, bounds
                for at in range(0, part.num_rows if held else 0, BATCH):
                    step = part.slice(at, BATCH)
                    owner, found, products = [], [], []
                    vectors, rows, order, ids, bounds = points
                    asked, own = step.column("leaf").to_pylist(), [step.column(c).to_numpy() for c in ("row", "least")]
                    for i, best, exact in best_of(_matrix(step.column("vector")), own[0], asked, own[1], vectors, rows, order, bounds, wanted):
                        owner += [i] * len(best)
                        found.append(best)
                        products.append(exact)
                    found = np.concatenate(found)
                    owner = pa.array(owner, pa.int64())
                    columns = [step.column("row").take(owner), step.column("vec_id").take(owner)]
                    columns += [pa.array(rows[found]), ids.take(pa.array(found)), pa.array(np.concatenate(products))]
                    yield pa.RecordBatch.from_arrays(columns, names=["query", "query_id", "row", "vec_id", "score"])

    return sides.mapInArrow(run, "query long, query_id long, row long, vec_id long, score double")


def neighbours(vectors: DataFrame, every: int = 20, wanted: int = 20, vector: str = "embedding", recall: float = RECALL) -> DataFrame:
    """query_id, rank, vec_id and score: for each row whose vec_id is divisible by `every` the `wanted` nearest others found."""
    rows, count, largest = prepared(vectors, vector)
    if count < 2:
        none = rows.filter("false").select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
        return none
    dims = rows.select(F.size("vector")).first()[0]
    forest = fit(sampled(rows, count, dims), largest, wanted, recall)
    indexed = materialize(_indexed(rows, forest), "indexed")
    asked = indexed.filter(F.col("vec_id") % every == 0)
    units = planned(indexed, forest, asked.count())
    # A row may be found in several trees, with the same score.
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")

    def found(queries: DataFrame, part: slice) -> DataFrame:
        queries = _searches(queries.select("row", "vec_id", "vector", "least"), forest, units, wanted, part)
        sides = _candidates(indexed, units).withColumn("query", F.lit(False)).unionByName(queries.withColumn("query", F.lit(True)))
        sides = sides.repartition("unit", "block").sortWithinPartitions("unit", "block", "query", "leaf")
        return materialize(_met(sides, wanted), "found")

    first = found(asked.withColumn("least", F.lit(float("-inf"))), slice(FIRST))
    ranked = first.dropDuplicates(["query", "row"]).withColumn("rank", F.row_number().over(order))
    bounds = ranked.filter(F.col("rank") == wanted).select(F.col("query").alias("row"), F.col("score").alias("least"))
    asked = asked.join(bounds, "row", "left").withColumn("least", F.coalesce("least", F.lit(float("-inf"))))
    best = first.unionByName(found(asked, slice(FIRST, None))).dropDuplicates(["query", "row"])
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted)
    return best.select("query_id", "rank", "vec_id", "score")
