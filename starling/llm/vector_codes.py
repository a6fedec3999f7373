"""Product codes of vectors: each of PARTS equal parts is replaced by its nearest entry of a codebook.

Codebooks are learned by Lloyd's rounds in whole numbers, so that results do not depend on the order of sums. A round
costs less the more entries have come to rest (active-entry Lloyd): each part keeps its entry and its exact distance. If
that entry has not moved, nothing that has not moved either can have come nearer, and the part is compared with the moved
entries only; if it has, the part is compared with all. Of equally near entries the one of the lower index is taken, in
both cases.

A round is one job. A task reads some vectors with their state, writes them with the new one, and ends with the sums of
its parts by entry; PARTS * ENTRIES such sums come to the driver, whatever the number of vectors. No vector is shuffled.
The state of a round is deleted when the next one is written.

Distances are taken in doubles, which are exact up to 2**53; hence the largest component, see `largest`.

Defined results: vectors that are null or hold null or non-finite components are dropped. Vectors whose length differs from
that of the vector with the smallest vec_id, or cannot be cut into PARTS, and vectors with a component beyond `largest`
are kept with null code and error, and do not form entries. Repeated rows count again. A null vec_id comes last among the
first entries. With fewer vectors than entries each is an entry. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starling.llm.common import discard, finite_vectors
from starling.session import materialize

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024

Codebooks = np.ndarray  # part, entry, place: whole numbers as doubles


def largest(width: int) -> int:
    """How large a scaled component may be for exact distances of parts of so many components."""
    return math.isqrt((1 << 51) // max(1, width))


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each point from each entry."""
    return (points**2).sum(axis=1)[:, None] - 2 * (points @ entries.T) + (entries**2).sum(axis=1)[None, :]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lowest of equals, and its distance."""
    all_of = distances(points, entries)
    index = all_of.argmin(axis=1)
    return index, all_of[np.arange(len(points)), index]


def reassign(
    points: np.ndarray, entries: np.ndarray, moved: np.ndarray, index: np.ndarray, distance: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The same as `nearest`, from the entry and the distance before some entries moved."""
    index, distance = index.copy(), distance.copy()
    rescanned = moved[index]
    if rescanned.any():
        index[rescanned], distance[rescanned] = nearest(points[rescanned], entries)
    active, kept = np.flatnonzero(moved), np.flatnonzero(~rescanned)
    if len(active) and len(kept):
        place, near = nearest(points[kept], entries[active])
        place = active[place]
        better = (near < distance[kept]) | ((near == distance[kept]) & (place < index[kept]))
        index[kept[better]], distance[kept[better]] = place[better], near[better]
    return index, distance


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _assigned(rows: DataFrame, books: Codebooks, moved: np.ndarray | None) -> DataFrame:
    """One round. Rows of vectors have `whole`, `entry` and `distance`; rows of sums have part, of_entry, total and times."""
    parts, entries, width = books.shape
    fields = [f for f in rows.schema if f.name in ("vec_id", "label")]
    kinds = "whole array<int>, entry array<int>, distance array<long>, part int, of_entry int, total array<long>, times long"
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in fields), kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, times = np.zeros((parts, entries, width), np.int64), np.zeros((parts, entries), np.int64)
        own = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.select(["vec_id", "label"])
            whole = _matrix(batch.column("whole"), parts * width).astype(float)
            index, distance = np.zeros((len(whole), parts), np.int32), np.zeros((len(whole), parts), np.int64)
            if moved is not None:
                old = _matrix(batch.column("entry"), parts), _matrix(batch.column("distance"), parts).astype(float)
            for part in range(parts):
                points = whole[:, part * width : (part + 1) * width]
                if moved is None:
                    found = nearest(points, books[part])
                else:
                    found = reassign(points, books[part], moved[part], old[0][:, part], old[1][:, part])
                index[:, part], distance[:, part] = found
                order = np.argsort(index[:, part], kind="stable")
                used, first = np.unique(index[order, part], return_index=True)
                total[part][used] += np.add.reduceat(points[order].astype(np.int64), first)
                times[part] += np.bincount(index[:, part], minlength=entries)
            lists = [
                pa.ListArray.from_arrays(pa.array(np.arange(0, a.size + 1, a.shape[1]), pa.int32()), pa.array(a.reshape(-1)))
                for a in (index, distance)
            ]
            empty = [pa.nulls(len(whole), k) for k in (pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.int64())]
            yield pa.RecordBatch.from_arrays([*own.columns, batch.column("whole"), *lists, *empty], names=names)
        if own is not None:
            part, entry = np.nonzero(times)
            none = [pa.nulls(len(part), k) for k in (*(c.type for c in own.columns), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()))]
            sums = pa.array(list(total[part, entry]), pa.list_(pa.int64()))
            columns = [*none, pa.array(part, pa.int32()), pa.array(entry, pa.int32()), sums, pa.array(times[part, entry])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["vec_id", "label", *[k.split()[0] for k in kinds.split(", ")]]
    return rows.select("vec_id", "label", *[c for c in ("whole", "entry", "distance") if c in rows.columns]).mapInArrow(run, schema)


def moved_to(state: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry at the floor of the mean of its parts; unused ones stay."""
    sums = state.filter(F.col("part").isNotNull()).select("part", "of_entry", "times", F.posexplode("total"))
    rows = sums.groupBy("part", "of_entry", "pos").agg(F.sum("col").alias("total"), F.sum("times").alias("times")).toPandas()
    out = books.copy()
    at = tuple(rows[c].to_numpy() for c in ("part", "of_entry", "pos"))
    out[at] = rows["total"].to_numpy(np.int64) // rows["times"].to_numpy(np.int64)
    return out


def fingerprint(books: Codebooks) -> str:
    """sha256 of all components by part, entry and place, as decimal numbers between commas."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.reshape(-1)).encode()).hexdigest()


def encoded(
    vectors: DataFrame, vector: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """vec_id, label, entries (index by part), error (summed squared distance), label_error and codebooks_sha256.

    One row for each vector that is kept. Components are floor(1024 * x).
    """
    rows = finite_vectors(vectors, vector, ("vec_id", "label"))
    first = rows.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(1).collect()
    dims = len(first[0]["vector"]) if first else 0
    width = dims // parts if dims % parts == 0 else 0
    limit = largest(width)
    whole = F.transform("vector", lambda x: F.floor(x * SCALE))
    fits = (F.size("vector") == dims) & F.forall("vector", lambda x: F.abs(x * SCALE) < limit) & F.lit(width > 0)
    rows = rows.withColumn("whole", F.when(fits, whole.cast("array<int>")))
    inside = rows.filter(F.col("whole").isNotNull()).select("vec_id", "label", "whole")
    start = inside.orderBy(F.asc_nulls_last("vec_id"), "whole").limit(entries).collect()
    start = np.array([r["whole"] for r in start], float).reshape(len(start), parts, width)
    books = np.ascontiguousarray(start.transpose(1, 0, 2))

    state, moved = None, None
    if books.size:
        state = materialize(_assigned(inside, books, None), "codes")
        for _ in range(rounds):
            after = moved_to(state, books)
            moved, books = (after != books).any(axis=2), after
            if not moved.any():
                break
            before, state = state, materialize(_assigned(state.filter(F.col("part").isNull()), books, moved), "codes")
            discard(before)
    outside = rows.filter(F.col("whole").isNull()).select(
        "vec_id", "label", F.lit(None).cast("array<int>").alias("entries"), F.lit(None).cast("long").alias("error")
    )
    found = outside
    if state is not None:
        error = F.aggregate("distance", F.lit(0).cast("long"), lambda a, x: a + x)
        codes = state.filter(F.col("part").isNull()).select("vec_id", "label", F.col("entry").alias("entries"), error.alias("error"))
        found = codes.unionByName(outside)
    errors = found.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    found = found.join(errors, found["label"].eqNullSafe(errors["of_label"])).drop("of_label")
    return found.withColumn("codebooks_sha256", F.lit(fingerprint(books)))


def codes(found: DataFrame) -> DataFrame:
    """vec_id, code (two hex digits for each part), error, label_error and codebooks_sha256."""
    digits = F.transform("entries", lambda x: F.lower(F.lpad(F.hex(x), 2, "0")))
    return found.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", "codebooks_sha256")
