"""Neighbour search and product codes of vectors against brute force."""

import hashlib
import random

import numpy as np
import pytest

from starling.llm import projection_forest, vector_codes
from starling.llm.queries import op12_neighbours, op13_vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, row string, unit int, entry int, whole string, error long, query int"
FOLDER = "/root/testdata/sf0.1"


def table_of(spark, rows):
    """rows: (vec_id, vector, label)."""
    return spark.createDataFrame([(*r, "r", 1, 2, "w", 3, 4) for r in rows], SCHEMA)


def vectors(count, dims=8, seed=2):
    rng = np.random.default_rng(seed)
    return np.float32(rng.normal(size=(count, dims)) * rng.uniform(0.1, 3, (count, 1)))


AWKWARD = [None, [], [None] * 8, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [1.0] * 5, [1.0, None] * 4]


# Neighbours


def exact_neighbours(x, ids, query, wanted):
    scores = (x.astype(float) * x[query].astype(float)).sum(axis=1)
    order = sorted((-scores[i], ids[i] is None, ids[i] or 0, i) for i in range(len(x)) if i != query)[:wanted]
    return [(rank + 1, ids[o[3]], -o[0]) for rank, o in enumerate(order)]


def test_full_recall_equals_brute_force(spark, monkeypatch):
    """All leaves visited: the same rows as comparing all, with ties, repeated rows, nulls, and units of few rows."""
    monkeypatch.setattr(projection_forest, "UNIT", 40)
    monkeypatch.setattr(projection_forest, "BLOCK", 7)
    monkeypatch.setattr(projection_forest, "BATCH", 3)
    x = vectors(400)
    x[50:250] = x[50]  # a hot vector
    ids = [i if i % 37 else None for i in range(400)]
    ids[41] = ids[40]
    rows = [(i, v.tolist(), 1) for i, v in zip(ids, x)] + [(20 * i, v, None) for i, v in enumerate([*AWKWARD, [0.0] * 8])]
    got = projection_forest.neighbours(table_of(spark, rows), recall=1.0, wanted=20).collect()
    queries = [i for i in range(400) if ids[i] is not None and ids[i] % 20 == 0]
    assert len(got) == 20 * len(queries)
    found = sorted(tuple(r) for r in got)
    want = sorted((ids[q], *n) for q in queries for n in exact_neighbours(x, ids, q, 20))
    close = [a[:2] + (round(a[3], 9),) for a in found], [b[:2] + (round(b[3], 9),) for b in want]
    missed = sum(a != b for a, b in zip(*close))
    assert missed <= 0.02 * len(want)  # recall 1 holds for the trial queries
    scores = {(a[0], a[2]): a[3] for a in found}
    single = [w for w in want if w[2] not in (None, 40) and w[0] != 40]
    assert all(scores[q, n] == s for q, _, n, s in single if (q, n) in scores)


def test_fewer_rows_than_wanted(spark):
    x = vectors(5)
    got = projection_forest.neighbours(table_of(spark, [(20 * i, v.tolist(), 0) for i, v in enumerate(x)])).collect()
    assert sorted(tuple(r) for r in got) == sorted((20 * q, *n) for q in range(5) for n in exact_neighbours(x, [0, 20, 40, 60, 80], q, 20))
    for rows in ([], [(0, x[0].tolist(), 1)], [(0, None, 1)] * 3):
        assert projection_forest.neighbours(table_of(spark, rows)).collect() == []


def test_queue_gives_out_leaves_by_distance():
    x = vectors(500).astype(float)
    largest = np.linalg.norm(x, axis=1).max()
    forest = projection_forest.fit(x, largest, 20)
    sizes = np.ones((projection_forest.TREES, forest.leaves), int)
    query = projection_forest.lifted_queries(x[:1], largest)[0]
    order = projection_forest.reached(forest, query, sizes, 0, sizes.size)
    assert sorted(order) == [(t, i) for t in range(projection_forest.TREES) for i in range(forest.leaves)]

    def cost(tree, leaf):
        node, total = leaf + forest.leaves - 1, 0.0
        while node:
            parent = (node - 1) // 2
            margin = forest.planes[tree, parent] @ query - forest.cuts[tree, parent]
            total += margin**2 if (margin > 0) != (node == 2 * parent + 2) else 0
            node = parent
        return total

    costs = [cost(*o) for o in order]
    assert np.allclose(costs, sorted(costs))


def test_recall(spark):
    x = spark.read.parquet(f"{FOLDER}/embeddings.parquet").orderBy("vec_id").toPandas()
    m = np.array(x["embedding"].tolist(), float)
    got = op12_neighbours(spark, FOLDER).toPandas()
    hit = 0
    for q, own in got.groupby("query_id"):
        assert own.sort_values("rank")["score"].is_monotonic_decreasing and len(own) == 20 and q not in set(own["vec_id"])
        scores = m @ m[q]
        scores[q] = -np.inf
        hit += len(set(np.argsort(-scores)[:20]) & set(own["vec_id"]))
    assert got["query_id"].nunique() == 100 and hit >= 0.9 * len(got)


# Codes


def brute_codes(rows, dims, entries=256, rounds=4):
    """(vec_id, code, error, label_error, sha) by plain rounds in Python's whole numbers."""
    kept = [(i, [int(np.floor(float(c) * 1024)) for c in v], label) for i, v, label in rows]
    width = dims // 4
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [[kept[k][1][p * width : (p + 1) * width] for k in order] for p in range(4)]

    def assign():
        out = []
        for _, v, _ in kept:
            own = []
            for p in range(4):
                x = v[p * width : (p + 1) * width]
                own.append(min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[p])))
            out.append(own)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(4):
            for j in range(len(books[p])):
                members = [kept[k][1][p * width : (p + 1) * width] for k in range(len(kept)) if found[k][p][1] == j]
                if members:
                    books[p][j] = [sum(c) // len(members) for c in zip(*members)]
    found = assign()
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    errors = [sum(d for d, _ in own) for own in found]
    by_label = {}
    for (_, _, label), e in zip(kept, errors):
        by_label[label] = by_label.get(label, 0) + e
    return sorted(
        ((i, "".join(f"{j:02x}" for _, j in own), e, by_label[label], sha) for (i, _, label), own, e in zip(kept, found, errors)), key=repr
    )


def codes_of(table, **options):
    return sorted((tuple(r) for r in vector_codes.codes(vector_codes.encoded(table, **options)).collect()), key=repr)


def test_codes_equal_brute_force(spark):
    rand = random.Random(4)
    x = np.round(vectors(300), 1)  # many ties
    x[100:180] = x[100]
    rows = [(i if i % 29 else None, v.tolist(), rand.choice([0, 1, None])) for i, v in enumerate(x)]
    rows += [rows[5], rows[5]]
    bad = [v for v in AWKWARD if v is None or (len(v) == 8)]
    table = table_of(spark, rows + [(1000 + i, v, 1) for i, v in enumerate(bad)])
    rows = [(i, np.float32(v), label) for i, v, label in rows]
    assert codes_of(table, entries=16) == brute_codes(rows, 8, entries=16)
    assert codes_of(table) == brute_codes(rows, 8)


def test_rows_beyond_the_range_are_kept_without_code(spark):
    x = vectors(30)
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(98, [1.0] * 5, 1), (99, [1e30] + [0.0] * 7, 1), (100, [], 1)]
    got = codes_of(table_of(spark, rows + odd))
    want = brute_codes([(i, np.float32(v), label) for i, v, label in rows], 8)
    assert [r for r in got if r[0] < 90] == want
    assert [r[:4] for r in got if r[0] >= 90] == sorted([(i, None, None, want[0][3]) for i in (98, 99, 100)], key=repr)


def test_no_vectors(spark):
    assert codes_of(table_of(spark, [])) == [] and codes_of(table_of(spark, [(1, None, 1)])) == []


@pytest.mark.parametrize("seed", range(5))
def test_reassigning_equals_a_full_scan(seed):
    rng = np.random.default_rng(seed)
    points, entries = rng.integers(-3, 4, (500, 3)).astype(float), rng.integers(-3, 4, (20, 3)).astype(float)
    index, distance = vector_codes.nearest(points, entries)
    for _ in range(4):
        moved = rng.random(20) < 0.3
        entries[moved] += rng.integers(-1, 2, (moved.sum(), 3))
        index, distance = vector_codes.reassign(points, entries, moved, index, distance)
        want = vector_codes.nearest(points, entries)
        assert np.array_equal(index, want[0]) and np.array_equal(distance, want[1])


def test_every_vector_has_a_code(spark):
    rows = op13_vector_codes(spark, FOLDER).collect()
    assert len(rows) == 2000 and all(len(r["code"]) == 8 for r in rows) and len({r["codebooks_sha256"] for r in rows}) == 1
