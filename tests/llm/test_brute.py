"""Fingerprints and toxicity scores, recomputed from their definitions."""

import math
import random
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import xxhash

from starling.llm import fingerprints, token_counts, toxicity
from starling.llm.arrays import BASE, BYTE
from starling.llm.queries import op2_toxicity

FOLDER = "/root/testdata/sf0.1"
ALL = (1 << 64) - 1


def levels_of(text, lexicon):
    """For each level the sorted lexicon terms of each part."""
    held = sorted({xxhash.xxh64_intdigest(w.encode(), 42) for w in text.split()} & lexicon)
    out = []
    for bits, parts in fingerprints.LEVELS:
        part = {h: xxhash.xxh64_intdigest(struct.pack("<i", bits), xxhash.xxh64_intdigest(struct.pack("<Q", h), 42)) & ((1 << bits) - 1) for h in held}
        out.append([tuple(h for h in held if part[h] == i) for i in range(parts)])
    return out


def likeness(a, b):
    if a == b:
        return 1.0
    shares, equal, held = [], 0, 0
    for left, right in zip(a, b, strict=True):
        some = [(x, y) for x, y in zip(left, right, strict=True) if x or y]
        same = sum(x == y for x, y in some)
        shares += [same / len(some)] if len(some) >= fingerprints.LEAST else []
        equal, held = equal + same, held + len(some)
    return max(shares) if shares else equal / max(1, held)


def test_fingerprints_equal_their_definition(docs_of):
    rand = random.Random(5)
    texts = [" ".join(f"w{int(rand.paretovariate(0.6)) % 900}" for _ in range(rand.randrange(20, 200))) for _ in range(300)]
    for i in range(0, 300, 7):
        texts[i] = texts[(i * 31) % 300]
    for i in range(3, 300, 10):
        texts[i] = texts[i - 1] + " w5"
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(docs_of(list(enumerate(texts)))).collect()}
    docs = Counter(w for t in texts for w in set(t.split()))
    lexicon = {xxhash.xxh64_intdigest(w.encode(), 42) for w, n in docs.items() if n * fingerprints.RARE >= 300 and n <= fingerprints.FREQUENT * 300}
    levels = {i: levels_of(t, lexicon) for i, t in enumerate(texts)}
    for i, text in enumerate(texts):
        after = texts[i - 1]
        cut = len(text) // 3
        edited = levels_of(text[: len(text) - cut] + after[:cut], lexicon)
        assert math.isclose(found[i]["near_edited"], likeness(levels[i], edited)), i
        assert math.isclose(found[i]["near_next"], likeness(levels[i], levels[(i - 1) % 300])), i
        assert (found[i]["fingerprint"] == found[i]["edited_fingerprint"]) == (levels[i] == edited)
    by_levels, by_text = {}, {}
    for i in range(300):
        by_levels.setdefault(str(levels[i]), set()).add(i)
        by_text.setdefault(found[i]["fingerprint"], set()).add(i)
    assert sorted(map(sorted, by_levels.values())) == sorted(map(sorted, by_text.values()))


def mixed(x):
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & ALL
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & ALL
    return x ^ (x >> 31)


def hashed(word):
    return mixed((sum(int(BYTE[b]) * pow(BASE, i, 1 << 64) for i, b in enumerate(word)) + len(word)) & ALL)


def score_of(text, model):
    """Noisy-or of the sentences, word by word."""
    clean, stops = 1.0, b"\n!.?"
    sentences, word = [[]], b""
    for b in text.lower().encode() + b"\n":
        if b in b" \t\n\v\f\r" or 0x21 <= b < 0x30 or 0x3A <= b < 0x41 or 0x5B <= b < 0x61 or 0x7B <= b < 0x7F:
            if word:
                sentences[-1].append(word)
            word = b""
            if b in stops:
                sentences.append([])
        else:
            word += bytes([b])
    for words in filter(None, sentences):
        margin = model.bias
        for w in words:
            shift = 64 - toxicity.BITS
            margin += model.weights[hashed(w) >> shift]
            for i, size in enumerate(toxicity.STEMS):
                margin += model.weights[(hashed(w[:size]) ^ ((i + 1) << 62)) >> shift]
        clean *= 1 - 1 / (1 + math.exp(-margin))
    return 1 - clean


def test_toxicity_scores_equal_their_definition(spark, docs_of):
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(0, 0.5, 1 << toxicity.BITS).astype(np.float32), -2.0)
    rand = random.Random(4)
    words = ["Some", "words", "of", "MORON", "été", "中文", "it's", "a-b", "x" * 30, "2024", "no!", "end.", "why?", "line\nend"]
    texts = [" ".join(rand.choices(words, k=rand.randrange(40))) for _ in range(60)]
    found = {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs_of(list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        assert math.isclose(found[i], score_of(text, model), rel_tol=1e-6, abs_tol=1e-9), text


def test_held_out_recall_and_precision_of_toxicity(spark):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = op2_toxicity(spark, FOLDER).filter("held_out").join(labels, "doc_id").groupBy("predicted", "toxic").count().collect()
    many = {(r["predicted"], r["toxic"]): r["count"] for r in rows}
    assert many[1, 1] >= 0.7 * (many[1, 1] + many[0, 1])
    assert many[1, 1] >= 0.95 * (many[1, 1] + many.get((1, 0), 0))


def test_words_without_blanks_are_not_kept():
    rand = random.Random(2)
    texts = ["".join(chr(0x4E00 + rand.randrange(2000)) for _ in range(3000)) for _ in range(30)]
    counter = token_counts.PrefixTable(public_tokenizers.path("piece_bpe_32k.model"))
    for text in texts:
        counter.steps_of(text)
    assert max(map(len, counter._words), default=0) <= token_counts.MAX_KEPT
    assert max(map(len, counter._parts), default=0) <= token_counts.MAX_KEPT
