"""Suffix and block deduplication, near duplicates, and the pipeline."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starling.llm import bagminhash, block_dedup, common, suffix_dedup, toxicity
from starling.llm.arrays import rolling, sliding_min, words_of
from starling.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def covered(units, window, starts):
    gone = np.zeros(len(units), bool)
    for s in starts:
        gone[s : s + window] = True
    return gone


def brute_force(texts, window):
    """For each sequence which units are covered by a window that starts twice."""
    counts = Counter(tuple(t[i : i + window]) for t in texts for i in range(len(t) - window + 1))
    return [
        covered(t, window, [i for i in range(len(t) - window + 1) if counts[tuple(t[i : i + window])] > 1]) for t in texts
    ]


def check_bytes(docs, length, anchor):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
    want = []
    for (i, data), gone in zip(rows, brute_force([d for _, d in rows], length), strict=True):
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        want.append((i, kept, len(data), int(gone.sum()), runs))
    found = suffix_dedup.without_repeats(docs, length, anchor)
    got = [(r["doc_id"], bytes(r["kept"]), r["n_bytes"], r["n_removed"], r["n_spans"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return found


def check_words(docs, window):
    rows = [(r["doc_id"], (r["text"] or "").encode().split()) for r in docs.collect()]
    want = []
    for (i, words), gone in zip(rows, brute_force([w for _, w in rows], window), strict=True):
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g).decode()
        want.append((i, kept, len(words), int(gone.sum())))
    found = block_dedup.without_repeats(docs, window)
    got = [(r["doc_id"], r["kept"], r["n_words"], r["n_removed"]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def random_texts(seed, many, parts, longest):
    """Texts with shared passages, periodic ones and copies."""
    rand = random.Random(seed)
    passages = ["".join(rand.choice(parts) for _ in range(rand.randrange(1, longest))) for _ in range(6)]
    out = []
    for _ in range(many):
        pieces = [rand.choice([rand.choice(passages), rand.choice(parts) * rand.randrange(40), "".join(rand.choice(parts) for _ in range(20))]) for _ in range(rand.randrange(5))]
        out.append("".join(pieces))
    return out + out[:3]


@pytest.mark.parametrize("seed, length, anchor", [(1, 16, 4), (2, 12, 5), (3, 9, 2), (4, 30, 8)])
def test_repeated_bytes(docs_of, seed, length, anchor):
    docs = docs_of(list(enumerate(random_texts(seed, 40, ["a", "b", "\0", "é", "c "], 60))))
    check_bytes(docs, length, anchor)


@pytest.mark.parametrize("seed, window", [(1, 5), (2, 6), (3, 2), (4, 9)])
def test_repeated_words(docs_of, seed, window):
    docs = docs_of(list(enumerate(random_texts(seed, 40, ["a ", "b\n", "É\t", "c  "], 40))))
    check_words(docs, window)


@pytest.mark.parametrize("check", [lambda d: check_bytes(d, 400, 64), lambda d: check_words(d, 35)])
def test_repeats_of_awkward_rows(docs_of, awkward, check):
    check(awkward)
    check(docs_of([]))
    check(docs_of([(1, "too short")]))


def test_hot_groups_and_flushes(docs_of, monkeypatch):
    passage = " ".join(f"p{i}" for i in range(60))
    rand = random.Random(9)
    docs = docs_of([(i, f"{rand.random()} {passage} {rand.random()}" if i % 3 else passage) for i in range(300)])
    monkeypatch.setattr(block_dedup, "SHARD_CHARS", 3000)
    check_words(docs.repartition(5), 35)
    check_bytes(docs.repartition(5), 100, 16)


def test_blocks_are_hashed_in_small_steps(docs_of, monkeypatch):
    """Steps and flushes of a few texts give the repeats of all."""
    monkeypatch.setattr(block_dedup, "STEP", 50)
    monkeypatch.setattr(block_dedup, "FLUSH", 20)
    rand = random.Random(11)
    check_words(docs_of([(i, " ".join(rand.choices("abc", k=rand.randrange(30)))) for i in range(60)]), 6)


def test_long_texts_come_in_parts(docs_of, monkeypatch):
    monkeypatch.setattr(common, "STEP_CHARS", 100)
    rand = random.Random(10)
    text = "".join(rand.choice("ab") for _ in range(3000))
    found = []
    step = docs_of([(1, text)]).select(F.lit(1).cast("long").alias("id"), F.lit(2).cast("long").alias("copy"), "text").toArrow().to_batches()[0]
    for data, _, _, skipped in suffix_dedup.pieces(step, 20):
        found += [(int(skipped[0]) + i, bytes(data[i : i + 20])) for i in range(len(data) - 19)]
    assert found == [(i, text[i : i + 20].encode()) for i in range(len(text) - 19)]


def longest_by_force(texts, length, shortest):
    """Of each text, the bytes of the longest string that starts twice: from shortest to length, else 0."""
    out = [0] * len(texts)
    for size in range(shortest, length + 1):
        counts = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
        for k, t in enumerate(texts):
            if any(counts[t[i : i + size]] > 1 for i in range(len(t) - size + 1)):
                out[k] = size
    return out


@pytest.mark.parametrize("seed, length, anchor, shortest", [(1, 16, 4, 10), (2, 30, 5, 8), (3, 25, 3, 12), (4, 18, 8, 18)])
def test_longest_repeats(docs_of, seed, length, anchor, shortest):
    """Repeats that are too short to be removed are reported, and what is removed stays the same."""
    texts = random_texts(seed, 40, ["a", "b", "\0", "é", "c "], 60)
    docs = docs_of(list(enumerate(texts)))
    data = [t.encode() for t in texts]
    got = {r["doc_id"]: r for r in suffix_dedup.without_repeats(docs, length, anchor, shortest).collect()}
    assert [got[i]["longest_repeat"] for i in range(len(texts))] == longest_by_force(data, length, shortest)
    assert [got[i]["n_removed"] for i in range(len(texts))] == [int(g.sum()) for g in brute_force(data, length)]


def test_passages_shorter_than_what_is_removed(docs_of):
    """A passage of over 50 words below 400 bytes stays, as it must, and is reported."""
    rand = random.Random(12)
    passage = " ".join("".join(rand.choices("abcdefgh", k=4)) for _ in range(60))
    own = ["".join(rand.choices("ijklmnop ", k=900)) for _ in range(4)]
    docs = docs_of([(1, own[0] + "<" + passage + ">" + own[1]), (2, own[2] + "(" + passage + ")"), (3, own[3]), (4, None)])
    got = {r["doc_id"]: (r["n_removed"], r["longest_repeat"]) for r in suffix_dedup.without_repeats(docs).collect()}
    assert got == {1: (0, 299), 2: (0, 299), 3: (0, 0), 4: (0, 0)}


def test_places_where_long_texts_are_cut_are_no_repeats(docs_of):
    most = 4 * common.STEP_CHARS
    rand = random.Random(13)
    once, cut = (rand.randbytes(most + 3000).hex()[: most + 3000] for _ in range(2))
    twice = cut + "-" + cut[most - 250 : most + 250]
    for texts, want in (([once], [(0, 0, 0)]), ([once, twice], [(0, 0, 0), (1000, 2, 400)])):
        found = suffix_dedup.without_repeats(docs_of(list(enumerate(texts))))
        got = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["longest_repeat"]) for r in found.collect()}
        assert [got[i] for i in range(len(texts))] == want


def test_shortened_rows_keep_their_columns(docs_of, awkward):
    out = suffix_dedup.shortened(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    kept = {r["doc_id"]: r for r in out.collect() if r["doc_id"] in (4, 6)}
    assert kept[4]["text"] == "" and kept[4]["n_chars"] == 0 and len(kept[6]["text"]) == kept[6]["n_chars"] > 200_000


def test_rolling_and_minimum():
    values = np.random.default_rng(11).integers(0, 1 << 60, 50).astype(np.uint64)
    for length in (1, 2, 7, 16, 50, 51):
        hashes = rolling(values, length)
        assert len(hashes) == max(0, 51 - length)
        assert all(hashes[i] == rolling(values[i : i + length], length)[0] for i in range(len(hashes)))
        least = sliding_min(values, length)
        assert list(least) == [values[i : i + length].min() for i in range(max(0, 51 - length))]


def multiset(text):
    words = text.encode().lower().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def classes_of(rows, least=0.8):
    """Smallest doc_id of each class, by comparing all with all."""
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    sets = [multiset(t or "") for _, t in rows]
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            equal = (rows[i][1] or "") == (rows[j][1] or "")
            both = sum((a & b).values())
            if equal or (both and both >= least * (sum(a.values()) + sum(b.values()) - both)):
                root[find(i)] = find(j)
    first = {}
    for i, (doc, _) in enumerate(rows):
        first.setdefault(find(i), []).append(doc)
    return [min((d for d in first[find(i)] if d is not None), default=None) for i in range(len(rows))]


def near_copies(seed):
    rand, rows = random.Random(seed), []
    for _ in range(8):
        base = [f"w{rand.randrange(60)}" for _ in range(rand.randrange(3, 150))]
        for _ in range(rand.randrange(1, 9)):
            copy = list(base)
            for _ in range(rand.randrange(4)):
                copy[rand.randrange(len(copy))] = f"x{rand.randrange(1000)}"
            rows.append(" ".join(copy) + rand.choice(["", "\n"]))
    rand.shuffle(rows)
    return [(100 - i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("seed", range(4))
def test_classes_are_those_of_brute_force(docs_of, seed):
    rows = near_copies(seed)
    found = bagminhash.near_duplicates(docs_of(rows))
    assert sorted((r["doc_id"], r["class_id"]) for r in found.collect()) == sorted(zip([i for i, _ in rows], classes_of(rows), strict=True))
    kept = bagminhash.representatives(docs_of(rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(classes_of(rows)))


def test_classes_of_chains(docs_of):
    """Each text is like its neighbours only: classes connect them all, though their bucket has one hub."""
    words = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(words[6 * i : 6 * i + 100])) for i in range(10)]
    found = bagminhash.near_duplicates(docs_of(rows))
    assert {r["class_id"] for r in found.collect()} == {0}
    assert set(classes_of(rows)) == {0}


def test_near_duplicates_of_awkward_rows(docs_of, awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    found = bagminhash.near_duplicates(awkward)
    got = sorted(((r["doc_id"], r["class_id"]) for r in found.collect()), key=repr)
    assert got == sorted(zip([i for i, _ in rows], classes_of(rows), strict=True), key=repr)
    kept = bagminhash.representatives(awkward)
    assert kept.columns == awkward.columns and kept.count() == 9
    assert bagminhash.near_duplicates(docs_of([])).collect() == []
    assert bagminhash.representatives(docs_of([])).collect() == []


def test_signatures_are_unbiased():
    """The share of equal components is the weighted Jaccard likeness."""
    rand = np.random.default_rng(12)
    texts = []
    for _ in range(60):
        a = rand.integers(0, 6, 12) ** 2
        b = np.where(rand.random(12) < 0.5, a, rand.integers(0, 6, 12) ** 2)
        texts += [a, b]
    shingles = np.tile(np.arange(12), len(texts)).astype(np.uint64) + np.repeat(np.arange(len(texts)) // 2 * 100, 12).astype(np.uint64)
    weights, doc = np.concatenate(texts), np.repeat(np.arange(len(texts)), 12)
    there = weights > 0
    signature = bagminhash.signatures(doc[there], shingles[there] * np.uint64(0x9E3779B97F4A7C15), weights[there], len(texts))
    equal = (signature[0::2] == signature[1::2]).mean(axis=1)
    true = np.array([np.minimum(a, b).sum() / np.maximum(a, b).sum() for a, b in zip(texts[0::2], texts[1::2], strict=True)])
    assert abs((equal - true).mean()) < 0.01 and np.abs(equal - true).max() < 0.12


def test_shingles_of_short_texts():
    doc, hashes, weights = bagminhash.shingles(words_of([b"", b"a b", b"a b c d e a b c d e", b"x x x x x x"]))
    assert list(np.bincount(doc, weights, 4)) == [0, 1, 6, 2]
    assert len(hashes) == 1 + 5 + 1


def test_pipeline(spark):
    """Each stage against what it must keep, by brute force where that can be had."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "suffix_dedup", "decontamination", "packing"]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}

    step = {}
    kept = docs
    for name in ("toxicity", "near_duplicates", "suffix_dedup", "decontamination"):
        kept = stages[name](spark, kept, FOLDER)
        assert kept.columns == docs.columns
        assert [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
        step[name] = {r["doc_id"]: r["text"] for r in kept.collect()}
        kept = spark.createDataFrame(kept.collect(), docs.schema)

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = toxicity.fit(toxicity.sample_of(docs, labels, 3, 1))
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, model).collect()}
    assert set(step["toxicity"]) == {i for i, s in scores.items() if s < 0.7}

    ids = sorted(step["toxicity"])
    classes = classes_of([(i, rows[i]) for i in ids])
    assert set(step["near_duplicates"]) == set(classes)

    ids = sorted(step["near_duplicates"])
    data = [rows[i].encode() for i in ids]
    for i, text, gone in zip(ids, data, brute_force(data, corpus_pipeline.REPEAT_BYTES), strict=True):
        assert step["suffix_dedup"][i] == bytes(b for b, g in zip(text, gone, strict=True) if not g).decode(errors="ignore")

    tests = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    leaks = {i for i, t in step["suffix_dedup"].items() if any(x in " ".join(t.split()) for x in tests)}
    assert set(step["decontamination"]) == set(step["suffix_dedup"]) - leaks

    packed = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in packed} == set(step["decontamination"])
    ends = {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert ends.get(r["sequence_id"], 0) == r["offset"]
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048


def test_queries_on_the_smallest_tables(spark):
    """op3 and op5 with production parameters, against brute force."""
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    ids = sorted(rows)
    for name, units, join, window in (
        ("op3_suffix_dedup", [rows[i].encode() for i in ids], lambda kept: bytes(kept), 400),
        ("op5_block_dedup", [rows[i].encode().split() for i in ids], lambda kept: b" ".join(kept), 35),
    ):
        got = {r["doc_id"]: (r["n_removed"], r["kept_sha256"]) for r in QUERIES[name](spark, FOLDER).collect()}
        for i, held, gone in zip(ids, units, brute_force(units, window), strict=True):
            kept = join([u for u, g in zip(held, gone, strict=True) if not g])
            assert got[i] == (int(gone.sum()), hashlib.sha256(kept).hexdigest())
