"""Source divergence audit against plain sums over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from starling.llm import source_audit
from starling.llm.queries import op11_source_audit

SCHEMA = "doc_id long, text string, lang string, source string, term int, n string, base long, peer string"
WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least_docs, top):
    """rows: (text, lang, source)."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups.add((lang, source))
        count[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = sorted(t for t, n in docs[lang].items() if n >= least_docs)
        peers = sorted(s for x, s in groups if x == lang)

        def shares(counts):
            whole = sum(counts[t] for t in kept) + 2 * len(kept)
            return [1 + 10**9 * (counts[t] + 2) // whole for t in kept]

        own = shares(count[lang, source])
        pairs = []
        for peer in peers:
            if peer != source:
                pairs.append((-sum((p - q) ** 2 // (p + q) for p, q in zip(own, shares(count[lang, peer]))), peer.encode()))
        whole = shares(sum((count[lang, s] for s in peers), Counter()))
        terms = [
            (-((p - q) ** 2 // (p + q)), t.encode()) for t, p, q in zip(kept, own, whole) if count[lang, source][t] and p > q
        ]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item.decode(), -value, rank + 1) for rank, (value, item) in enumerate(found)]
    return sorted(out)


def rows_of(found):
    return sorted(tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture(scope="module")
def mixed():
    """Nulls, clashing names, a hot source, groups without terms, a language without kept terms, repeated rows."""
    rand, rows = random.Random(3), []
    for _ in range(400):
        lang = rand.choice(["en", "en", "de", "", None, "xx"])
        source = rand.choice(["hot"] * 4 + ["b", "c", "", None, "Ä"])
        words = [rand.choice("the THE of ÄÖ äö 中文 wörd x y z a1b it's".split()) for _ in range(rand.randrange(30))]
        rows.append((rand.choice([" ", "\n", "."]).join(words) if lang != "xx" else f"only{len(rows)}q", lang, source))
    rows += [(None, "en", "silent"), ("", "en", "silent"), ("123 456", "en", "digits"), (None, None, None)]
    rows += [("same words twice " * 50, "fr", "one")] * 12
    rows.append(("long " * 700_000 + "x" * 300_000, "en", "hot"))
    return rows


def test_equals_brute_force(spark, mixed, monkeypatch):
    table = spark.createDataFrame([(i, *row, 1, "n", 2, "p") for i, row in enumerate(mixed)], SCHEMA)
    want = brute(mixed, 10, 10)
    assert rows_of(source_audit.audit(table)) == want
    # Texts, counts and posting lists in many parts.
    monkeypatch.setattr(source_audit, "HELD", 5)
    assert rows_of(source_audit.audit(table)) == want
    assert rows_of(source_audit.audit(table, least_docs=3, top=2)) == brute(mixed, 3, 2)


def test_no_rows(spark):
    assert source_audit.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_shares_are_exact_where_products_leave_64_bits(spark):
    values = [(10**15 + 7, 3 * 10**15 + 1), (0, 2), (9 * 10**9, 9 * 10**9 + 2), (5, 10**12)]
    table = spark.createDataFrame(values, "n long, whole long")
    got = [r[0] for r in table.select(source_audit.share(table["n"], table["whole"])).collect()]
    assert got == [1 + 10**9 * (n + 2) // whole for n, whole in values]


def test_scatter_equals_pairs_of_postings():
    rng = np.random.default_rng(1)
    term = np.sort(rng.integers(0, 50, 300))
    source = np.concatenate([rng.permutation(40)[:n] for n in np.unique(term, return_counts=True)[1]])
    p, base = rng.integers(10**3, 10**8, 300), rng.integers(1, 10**3, 300)
    want = np.zeros((40, 40), np.int64)
    for i in range(300):
        for j in np.flatnonzero(term == term[i]):
            a, b, c, d = (int(x) for x in (p[i], base[i], p[j], base[j]))
            f = lambda x, y: (x - y) ** 2 // (x + y)
            want[source[i], source[j]] += f(a, c) - f(a, d) - f(b, c) + f(b, d)
    for own, peers in source_audit.scatter(source, term, p, base):
        assert np.array_equal(peers, want[own][: len(peers)])


def test_query_keeps_all_groups(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("text", "lang", "source")
    assert rows_of(op11_source_audit(spark, folder)) == brute([tuple(r) for r in docs.collect()], 10, 10)
