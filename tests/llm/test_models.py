"""Toxicity, quality and decontamination."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starling.llm import decontamination, quality, toxicity
from starling.llm.arrays import words_of
from starling.llm.queries import op2_toxicity, op4_quality

FOLDER = "/root/testdata/sf0.1"
LABELS = "doc_id long, quality int, toxic int"


def labelled_docs(docs_of, spark):
    """Documents of which those with an even id hold one bad sentence."""
    rand, rows = random.Random(5), []
    for i in range(400):
        sentences = [" ".join(f"w{rand.randrange(80)}" for _ in range(8)) for _ in range(rand.randrange(1, 9))]
        if i % 2 == 0:
            sentences[rand.randrange(len(sentences))] += " You awful MORON"
        rows.append((i, ". ".join(sentences) + "."))
    labels = spark.createDataFrame([(i, 1, 1 - i % 2) for i in range(400)] + [(None, 1, 1), (3, None, None)], LABELS)
    return docs_of(rows), labels


def test_toxicity_finds_the_sentence(spark, docs_of):
    docs, labels = labelled_docs(docs_of, spark)
    model = toxicity.fit(toxicity.sample_of(docs, labels, folds=3, held_out=1))
    texts = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    for row in toxicity.toxicity(docs, model).collect():
        assert (row["score"] >= 0.7) == (row["doc_id"] % 2 == 0)
        found = [texts[row["doc_id"]][s["start"] : s["end"]] for s in row["sentences"]]
        assert len(found) == 1 - row["doc_id"] % 2 and all(f.endswith(b"MORON") for f in found)
    assert toxicity.without_toxic(docs, model, 0.7).count() == 200


def test_toxicity_of_awkward_rows(spark, docs_of, awkward):
    _, labels = labelled_docs(docs_of, spark)
    model = toxicity.fit(toxicity.sample_of(awkward, labels, folds=3, held_out=1))
    rows = toxicity.toxicity(awkward, model).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["score"] for r in rows if r["doc_id"] in (1, 2)} == {0.0}
    kept = toxicity.without_toxic(awkward, model, 2.0)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    none = toxicity.fit(toxicity.sample_of(docs_of([]), labels, folds=3, held_out=1))
    assert toxicity.toxicity(docs_of([]), none).collect() == []


def test_noisy_or():
    scores, doc = np.array([0.5, 0.5, 1.0]), np.array([0, 0, 2])
    assert np.allclose(toxicity.noisy_or(scores, doc, 3), [0.75, 0, 1])


@pytest.mark.parametrize("query, label, least", [(op2_toxicity, "toxic", 0.95), (op4_quality, "quality", 0.98)])
def test_held_out_documents(spark, query, label, least):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = query(spark, FOLDER).filter("held_out").join(labels, "doc_id").select("predicted", label).collect()
    assert len(rows) > 50 and np.mean([r[0] == r[1] for r in rows]) >= least


def test_quality_of_awkward_rows(spark, docs_of, awkward):
    labels = spark.createDataFrame([(3, 1, 0), (4, 1, 0), (6, 0, 0), (8, 0, 0)], LABELS)
    space = quality.fit(quality.sample_of(awkward, labels, folds=1000, held_out=999))
    rows = quality.quality(awkward, space).collect()
    assert len(rows) == awkward.count() and all(0 <= r["score"] <= 1 for r in rows)
    near = {r["doc_id"]: r["score"] for r in rows}
    # Repeated labelled rows count by the weight of their class: half of the labels are 1.
    assert near[1] == pytest.approx(0.5)
    assert quality.fit(quality.sample_of(docs_of([]), labels, 5, 0)) is None
    assert {r["score"] for r in quality.quality(awkward, None).collect()} == {0.5}


def test_votes_are_exact():
    rand = np.random.default_rng(6)
    space = quality.Space(np.ones(8, np.float32), np.eye(8, dtype=np.float32), quality.unit(rand.normal(size=(60, 8))), np.ones(60), rand.integers(0, 2, 60))
    terms = rand.normal(size=(700, 8))
    got = quality.vote(space, terms)
    for row, score in zip(terms, got, strict=True):
        like = space.vectors @ (row / np.linalg.norm(row))
        top = np.argsort(-like)[: quality.NEIGHBOURS]
        weight = np.maximum(like[top], 0)
        assert score == pytest.approx((weight * space.labels[top]).sum() / weight.sum(), abs=1e-5)


def smith_waterman(item, text):
    best, table = 0, np.zeros((len(item) + 1, len(text) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            gain = decontamination.MATCH if a == b else decontamination.OTHER
            gaps = max(table[i - 1, j], table[i, j - 1]) + decontamination.GAP
            table[i, j] = max(0, table[i - 1, j - 1] + gain, gaps)
            best = max(best, table[i, j])
    return best


def test_alignment_is_exact():
    rand = np.random.default_rng(7)
    items = [rand.integers(1, 5, rand.integers(1, 12)).astype(np.uint64) for _ in range(200)]
    texts = [rand.integers(1, 5, rand.integers(1, 25)).astype(np.uint64) for _ in range(200)]
    got = decontamination.align(decontamination.padded(items), decontamination.padded(texts))[:, 0]
    assert list(got) == [smith_waterman(a, b) for a, b in zip(items, texts, strict=True)]


ITEM = "the quick brown fox jumps over one lazy dog while seven grey cats look on from a wall of red bricks"


def planted():
    words = ITEM.split()
    edit = [w for i, w in enumerate(words) if i not in (4, 11)]
    edit[8] = "sleepy"
    rand = random.Random(8)
    noise = lambda n: " ".join(f"n{rand.randrange(500)}" for _ in range(n))
    return [
        (1, f"{noise(50)} {ITEM} {noise(50)}"),
        (2, f"{noise(30)}\n{ITEM.upper()}!"),
        (3, f"{noise(9)} {' '.join(edit)} {noise(9)}"),
        (4, noise(100)),
        (5, " ".join(sorted(words))),
        (6, " ".join(words[:6]) + " " + noise(40)),
        (7, f"{noise(5)} {ITEM} {noise(60)} {ITEM}"),
    ]


@pytest.mark.parametrize("block_grams", [200_000, 20])
def test_copies_are_found(spark, docs_of, block_grams):
    items = [(0, ITEM), (1, "another test item about something else entirely, and not in any of the documents"), (2, None), (3, "two words"), (4, ITEM)]
    tests = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    docs = docs_of(planted())
    rows = decontamination.contamination(docs, tests, block_grams=block_grams).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(d, i) for d in (1, 2, 3, 7) for i in (0, 4)}
    texts = dict(planted())
    for r in rows:
        passage = texts[r["doc_id"]].encode()[r["start"] : r["end"]].decode().lower()
        assert passage.split()[0] == "the" and passage.split()[-1] == "bricks"
        assert (r["score"] == 1) == (r["doc_id"] != 3) and r["score"] > 0.7
        whole = [w.hashes for w in (words_of([ITEM.encode()]), words_of([texts[r["doc_id"]].lower().replace("!", "").encode()]))]
        assert r["score"] * decontamination.MATCH * len(whole[0]) == pytest.approx(smith_waterman(*whole))
    kept = decontamination.without_contaminated(docs, tests, block_grams=block_grams)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [4, 5, 6]


def test_awkward_rows_hold_no_passage(spark, docs_of, awkward):
    tests = spark.createDataFrame([(None, None), (1, ITEM)], "item_id long, text string")
    assert decontamination.contamination(awkward, tests).collect() == []
    assert decontamination.without_contaminated(awkward, tests).count() == awkward.count()
    assert decontamination.contamination(docs_of([]), tests).collect() == []
    assert decontamination.contamination(awkward, tests.limit(0)).collect() == []
    many = docs_of([(i, ITEM) for i in range(300)])
    # An item that all documents copy keeps its seeds.
    assert decontamination.contamination(many, tests).count() == 300
