"""Fingerprints, token counts, URL filter and packing."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starling.llm import fingerprints, packing, token_counts, url_filter
from starling.llm.queries import URL_RULES, op1_fingerprints

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = "the an \n\t  \u2581é中😀aaabcs<s>  .,!?'0123\x00\r"


def edited(texts):
    """Texts in descending order of the id, each with its last third replaced."""
    out = []
    for i, text in enumerate(texts):
        cut = len(text) // 3
        out.append(text[: len(text) - cut] + texts[(i + 1) % len(texts)][:cut])
    return out


def text_of(row):
    return row["text"] or ""


def check_fingerprints(docs, found):
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0)))
    by_id = {}
    for row in found.collect():
        by_id.setdefault(row["doc_id"], []).append(row)
    assert sum(map(len, by_id.values())) == len(rows)
    if len({r["doc_id"] for r in rows}) == len(rows):
        for row, text in zip(rows, edited([text_of(r) for r in rows]), strict=True):
            (got,) = by_id[row["doc_id"]]
            assert got["n_chars"] == len(text_of(row))
            assert got["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    return by_id


def test_fingerprints_follow_edits(spark, docs_of):
    rand = random.Random(1)
    texts = [" ".join(f"w{int(rand.paretovariate(0.5)) % 4000}" for _ in range(rand.randrange(1, 300))) for _ in range(700)]
    texts[10] = texts[500]
    docs = docs_of([(3 * i - 40, t) for i, t in enumerate(texts)])
    found = check_fingerprints(docs, fingerprints.fingerprints(docs))
    rows = {i: r[0] for i, r in found.items()}
    assert rows[3 * 10 - 40]["fingerprint"] == rows[3 * 500 - 40]["fingerprint"]
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows.values())
    edits, nexts = (np.mean([r[c] for r in rows.values()]) for c in ("near_edited", "near_next"))
    assert edits > 0.3 > 3 * nexts


def test_fingerprints_of_awkward_rows(awkward):
    found = check_fingerprints(awkward, fingerprints.fingerprints(awkward))
    assert len(found[None]) == 2 and len(found[4]) == 2
    # The repeated row is its own next one.
    assert max(r["near_next"] for r in found[4]) == 1
    assert all(r[c] is not None for rows in found.values() for r in rows for c in ("fingerprint", "near_edited", "near_next"))


def test_fingerprints_of_few_rows(docs_of):
    assert fingerprints.fingerprints(docs_of([])).collect() == []
    (row,) = fingerprints.fingerprints(docs_of([(9, "abc def")])).collect()
    assert row["near_next"] == 1 and row["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest()


def test_lexicon_is_a_band(spark, docs_of):
    # "all" is in every document, "some" in one of ten; of 400 documents a term of one is too rare.
    docs = docs_of([(i, f"all only{i} " + ("some" if i % 10 == 0 else "")) for i in range(400)])
    kept = fingerprints.lexicon(docs)
    words = spark.createDataFrame([("all",), ("some",), ("only7",)], "word string")
    known = words.join(kept, F.xxhash64("word") == kept["term"]).collect()
    assert [r["word"] for r in known] == ["some"]


def test_fingerprints_run_no_python(spark):
    plan = op1_fingerprints(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    assert "SinglePartition" not in plan


def test_counts_at_every_prefix():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    table = token_counts.PrefixTable.of(PIECES)
    rand = random.Random(2)
    for _ in range(300):
        text = "".join(rand.choice(SIGNS) for _ in range(rand.randrange(30)))
        assert list(table.counts(text)) == [len(model.encode(text[:i])) for i in range(len(text) + 1)], text


def test_token_counts(spark, awkward, docs_of):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = token_counts.token_counts(awkward, PIECES, budget=100, keep_table=True)
    assert found.count() == awkward.count()
    texts = {}
    for r in awkward.collect():
        texts.setdefault((r["doc_id"], len(text_of(r).encode())), text_of(r))
    for row in found.withColumn("of_three", token_counts.tokens_of_prefix(F.col("prefix_tokens"), F.least(F.lit(3), F.col("cut_chars")))).collect():
        text = texts[row["doc_id"], row["n_bytes"]]
        assert row["n_tokens"] == len(model.encode(text)) and row["over_limit"] == (row["n_tokens"] > 100)
        assert row["of_three"] == len(model.encode(text[: min(3, row["cut_chars"])]))
        assert len(model.encode(text[: row["cut_chars"]])) <= 100
        assert row["over_limit"] == (row["cut_chars"] < len(text))
    assert token_counts.token_counts(docs_of([]), PIECES, 5).count() == 0


URLS = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "https://WWW.Example.COM/en/a?b",
    "http://example.com/en/x",
    "http://a.example.com/en",
    "http://b.net/fr/1#t",
    "http://net/es/",
    "http://notnet.de/es/",
    "http://com?x/y",
    "ftp://ÄÖ.com/Pfad/é",
    "http://one.net/de/2",
    "http://one.net/de/2",
    "http://u://com/x",
]


def judged(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(str(r)), default=None)
    return host, path, str(best) if best else None, best.verdict if best else None


@pytest.mark.parametrize("urls", [URLS, URLS[:2], []])
def test_url_rules(spark, urls):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit(None))
    rows = {r["page_id"]: r for r in url_filter.url_filter(pages, URL_RULES).collect()}
    assert len(rows) == len(urls)
    for i, url in enumerate(urls):
        host, path, rule, verdict = judged(url)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule)
        assert rows[i]["verdict"] == (verdict or ("allow" if rows[i]["score"] >= 0.5 else "block"))


def test_url_model_learns_from_a_table(spark):
    rand = random.Random(3)
    rows = [(f"{rand.randrange(10**6)}.casino-{rand.randrange(99)}.org" if i % 2 else f"news{rand.randrange(10**6)}.org", f"/{i}", 1 - i % 2) for i in range(400)]
    table = spark.createDataFrame(rows, "host string, path string, label int")
    pages = spark.createDataFrame([(0, "http://x.casino-7.org/1"), (1, "http://news5.org/1")], "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in url_filter.url_filter(pages, (), table).collect()}
    assert found == {0: "block", 1: "allow"}


def test_ids_are_those_of_the_library():
    library, own, rand = Tokenizer.from_file(BYTES), packing.encoder(BYTES), random.Random(4)
    parts = [*SIGNS, "<|endoftext|>", "'ll", "\u00a0", "\u0085", "\u3000", "½", "٣"]
    for _ in range(500):
        text = "".join(rand.choice(parts) for _ in range(rand.randrange(40)))
        assert own.encode(text, allowed_special="all") == library.encode(text, add_special_tokens=False).ids


def check_packing(rows, docs, capacity):
    library = Tokenizer.from_file(BYTES)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    for row in docs.dropDuplicates(["doc_id"]).collect():
        if len({text_of(r) for r in docs.collect() if r["doc_id"] == row["doc_id"]}) > 1:
            continue
        ids = library.encode(text_of(row), add_special_tokens=False).ids + [0]
        many = docs.filter(F.col("doc_id").eqNullSafe(row["doc_id"])).count()
        pieces = sorted(by_doc[row["doc_id"]], key=lambda r: r["piece"])[::many]
        assert sum(p["length"] for p in pieces) == len(ids)
        assert all(p["length"] == capacity for p in pieces[1:])
        start = 0
        for i, p in enumerate(pieces):
            part = ids[start : start + p["length"]]
            assert (p["piece"], p["start"]) == (i, start)
            assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
            start += p["length"]
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_packing_of_awkward_rows(awkward, docs_of):
    items = packing.pieces(awkward, BYTES, 64).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    rows = packing.pack(items, 64).collect()
    assert check_packing(rows, awkward, 64) <= sum(r["length"] for r in rows) / 64 * 1.01 + 2
    assert packing.pack(packing.pieces(docs_of([]), BYTES, 64), 64).collect() == []


def test_groups_have_equal_cardinality():
    counts = np.zeros(101, np.int64)
    counts[[20, 50, 70, 90]] = 7, 10, 1, 6
    groups = packing.linear_groups(counts, 20, 4)
    assert [sum(many for _, many in g) for g in groups] == [6, 6, 6, 6]
    assert groups[0] == [(90, 6)] and groups[3] == [(20, 6)]


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_close_to_the_bound(seed):
    rand = np.random.default_rng(seed)
    counts = np.zeros(513, np.int64)
    counts[1:] = rand.poisson(30 * rand.random(512) ** 3)
    runs = packing.plan(counts, 512)
    held = np.zeros(513, np.int64)
    for run in runs:
        assert sum(length * many for length, many in run.holds) + run.free == 512 and run.free >= 0
        for length, many in run.holds:
            held[length] += run.count * many
    assert (held == counts).all()
    # Few pieces of many lengths: rounding costs little more than the best that is known.
    plain = packing.best_fit([], counts.copy(), 512)
    assert sum(run.count for run in runs) <= 1.02 * sum(run.count for run in plain) + 1


BLANKS = [" ", "\n", "\t", "\r\n", " \n", "\u3000", "\xa0 ", "\x85\u2028"]


def test_ids_of_all_characters():
    """Each character beside letters, digits, signs, blanks and itself."""
    library, own = Tokenizer.from_file(BYTES), packing.encoder(BYTES)
    codes = [c for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for start in range(0, len(codes), 500):
        text = "".join(f"a{c}{c} {c}1{c}.  {c}" for c in map(chr, codes[start : start + 500]))
        assert packing.ids_of(own, text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("blank", BLANKS)
def test_ids_of_long_blanks(blank):
    library, own = Tokenizer.from_file(BYTES), packing.encoder(BYTES)
    run = (blank * 30_000)[:30_000]
    for text in (run, f"a{run}b", f"{run}1", f"!{run}", f"{run[:9_999]}x{run[:10_001]}'s", f"x{run}<|endoftext|>{run}y", f"\x1c{run}\x1f"):
        assert packing.ids_of(own, text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_pieces_of_two_million_blanks(docs_of):
    texts = [" " * 2_000_000, "\n" * 2_000_000, " \n\t" * 700_000 + "end"]
    rows = packing.pieces(docs_of(list(enumerate(texts))), BYTES, 2048).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    library = Tokenizer.from_file(BYTES)
    assert {r["doc_id"]: r["n"] for r in rows} == {i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_packing_keeps_columns_of_its_own_names(spark):
    names = ("part", "place", "number", "within", "before", "row", "count", "sequence_id", "offset")
    schema = "doc_id long, piece int, start long, length long, " + ", ".join(f"{n} string" for n in names)
    table = spark.createDataFrame([(i, 0, 0, 1 + i % 7, *names) for i in range(50)], schema)
    rows = packing.pack(table, 16).collect()
    assert len(rows) == 50 and all(r[n] == n for r in rows for n in names[:-2])
    assert sorted((r["doc_id"], r["length"]) for r in rows) == [(i, 1 + i % 7) for i in range(50)]
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 50
