"""How the words of each source of a language differ from those of its other sources, term by term.

A group is a pair (lang, source). Its share of a kept term is p = 1 + floor(10**9 * (count + 2) / (N + 2 V)), so also terms
that it never uses have a share, its baseline. Two groups diverge by the sum of f = floor((p - q)**2 / (p + q)) over all V
kept terms of the language. Summing all terms of all pairs would take groups**2 * V steps. By Gustavson's row accumulation
only terms that both have are visited:

    sum f = V f(p0, q0) + S(own, peer) + S(peer, own) + X

with p0 and q0 the baselines. S(own, peer), the sum of f(p, q0) - f(p0, q0) over the own terms, depends on how often the
own shares occur: a histogram that has as many entries as the group has different counts. X, the sum of
f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0) over shared terms, is scattered: the index is cut by terms, each task holds some
whole posting lists, and each of its groups goes through the lists of its terms into a dense array of its peers. Only
these arrays leave a task, never a pair of postings.

All numbers are whole. Shares are divided in three steps of a thousand, which is exact up to 9 * 10**15 words in a language.

Defined results: null text, lang and source count as ''. A repeated row counts again. A language without a kept term
gives pairs of value 0 and no terms; a language of one source gives no pairs; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.llm.common import steps
from starling.session import materialize

LEAST_DOCS = 10
TOP_TERMS = 10
HELD = 500_000  # counts or postings that a task holds
SALTS = 32
_COUNTS = ["lang", "source", "term", "n", "docs"]
# Bytes that are no ASCII letter and below 0x80 become blanks; A-Z become a-z.
_TERMS = np.full(256, 0x20, np.uint8)
_TERMS[0x80:] = np.arange(0x80, 256)
_TERMS[0x61:0x7B] = _TERMS[0x41:0x5B] = np.arange(0x61, 0x7B)


def terms_of(texts: pa.StringArray) -> pa.ListArray:
    """The terms of each text, with an empty one where it begins or ends between terms."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = _TERMS[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]] if data is not None else np.empty(0, np.uint8)
    buffers = [None, pa.py_buffer(offsets - offsets[0]), pa.py_buffer(flat)]
    return pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(texts), buffers))


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs."""
    keys = np.sort(keys)
    new = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[new], np.diff(np.append(new, len(keys)))


def counted(step: pa.RecordBatch) -> pa.Table:
    """lang, source, term, n and docs of some texts."""
    lists = terms_of(step.column("text"))
    doc = np.repeat(np.arange(step.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    terms = lists.flatten().dictionary_encode()
    lang, source = (step.column(c).dictionary_encode() for c in ("lang", "source"))
    group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    many = len(terms.dictionary)
    code = terms.indices.to_numpy().astype(np.int64)
    keys, n = _counts(group[doc] * many + code)
    pairs, _ = _counts(doc * many + code)
    _, docs = _counts(group[pairs // max(1, many)] * many + pairs % max(1, many))
    own, code = keys // max(1, many), keys % max(1, many)
    columns = [
        lang.dictionary.take(pa.array(own // len(source.dictionary))),
        source.dictionary.take(pa.array(own % len(source.dictionary))),
        terms.dictionary.take(pa.array(code)),
        pa.array(n, pa.int64()),
        pa.array(docs, pa.int64()),
    ]
    return pa.table(columns, names=_COUNTS).filter(pc.not_equal(pc.field("term"), ""))


def named(docs: DataFrame) -> DataFrame:
    """lang, source and text without nulls; no other columns."""
    return docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def term_counts(texts: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (texts with the term). Tasks count before rows are shuffled."""

    def merged(held: list[pa.Table]) -> pa.Table:
        found = pa.concat_tables(held).group_by(_COUNTS[:3]).aggregate([("n", "sum"), ("docs", "sum")])
        return found.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(_COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for step in steps(batches):
            held.append(counted(step))
            size += held[-1].num_rows
            if size > 2 * HELD:
                held = [merged(held)]
                size = held[0].num_rows
                if size > HELD:
                    yield from held[0].combine_chunks().to_batches()
                    held, size = [], 0
        if held:
            yield from merged(held).combine_chunks().to_batches()

    return texts.mapInArrow(count, "lang string, source string, term string, n long, docs long")


def kept_postings(texts: DataFrame, least_docs: int) -> DataFrame:
    """lang, term, source and n of the kept terms, and total: the term's occurrences in the language.

    Tasks send one row for each group, term and HELD counts, so that also the commonest term meets in one task as few rows;
    one shuffle brings together its sources, and which of them keep it. Most terms are rare, and go no further.
    """
    found = term_counts(texts).repartition("lang", "term")
    found = found.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = Window.partitionBy("lang", "term")
    found = found.withColumn("total", F.sum("n").over(own)).withColumn("docs", F.sum("docs").over(own))
    return found.filter(F.col("docs") >= least_docs).drop("docs")


def share(count: Column, whole: Column) -> Column:
    """1 + floor(10**9 * (count + 2) / whole), without leaving 64 bits."""
    out, rest = F.lit(0).cast("long"), count + 2
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + _div(rest, whole), rest % whole
    return out + 1


def _div(left: Column, right: Column) -> Column:
    """Whole part of the quotient of two longs."""
    return F.call_function("div", left, right)


def divergence(p: Column, q: Column) -> Column:
    return _div((p - q) * (p - q), p + q)


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def scatter(source: np.ndarray, term: np.ndarray, p: np.ndarray, base: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each source (numbered from 0) the sums X with all sources, over postings that come by term."""
    new = np.flatnonzero(np.diff(term, prepend=-1))
    bounds = np.append(new, len(term))
    which = np.cumsum(np.diff(term, prepend=term[:1]) != 0)
    sources = int(source.max()) + 1
    order = np.argsort(source, kind="stable")
    for own in np.split(order, np.searchsorted(source[order], np.arange(1, sources))):
        peers = np.zeros(sources, np.int64)
        # Lists of the own terms, some at a time.
        ends = np.cumsum(np.diff(bounds)[which[own]])
        cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], HELD)), len(own)))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            mine = own[a:b]
            lists, sizes = bounds[which[mine]], np.diff(bounds)[which[mine]]
            at = np.arange(sizes.sum()) + np.repeat(lists - np.cumsum(sizes) + sizes, sizes)
            left, left_base = np.repeat(p[mine], sizes), np.repeat(base[mine], sizes)
            right, right_base = p[at], base[at]
            extra = _divergence(left, right) - _divergence(left, right_base)
            extra += _divergence(left_base, right_base) - _divergence(left_base, right)
            np.add.at(peers, source[at], extra)
        yield int(source[own[0]]), peers


def shared_terms(index: DataFrame) -> DataFrame:
    """lang, source, peer and extra: the sums X of all pairs with a common term, from lang, term, source, p and base."""

    def sums(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        codes = langs.indices.to_numpy()
        for start in np.flatnonzero(np.diff(codes, prepend=-1)):
            lang = langs.dictionary[int(codes[start])]
            own = rows.slice(int(start), int(np.count_nonzero(codes == codes[start])))
            sources = own.column("source").combine_chunks().dictionary_encode()
            terms = own.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
            numbers = [own.column(c).to_numpy() for c in ("p", "base")]
            for source, peers in scatter(sources.indices.to_numpy(), terms, *numbers):
                there = np.flatnonzero(peers)
                columns = [
                    pa.array([lang.as_py()] * len(there), pa.string()),
                    pa.array([sources.dictionary[source].as_py()] * len(there), pa.string()),
                    sources.dictionary.take(pa.array(there)).cast(pa.string()),
                    pa.array(peers[there]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "peer", "extra"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= HELD:
                rows = pa.Table.from_batches(held)
                last = {c: rows.column(c)[-1] for c in ("lang", "term")}
                # The last list may go on; rows are sorted, so its postings are at the end.
                same = pc.and_(pc.equal(rows.column("lang"), last["lang"]), pc.equal(rows.column("term"), last["term"]))
                cut = size - pc.sum(same).as_py()
                if cut:
                    yield from sums(rows.slice(0, cut))
                    held, size = rows.slice(cut).to_batches(), size - cut
        if held:
            yield from sums(pa.Table.from_batches(held))

    cut = index.select("lang", "term", "source", "p", "base").repartition("lang", "term").sortWithinPartitions("lang", "term")
    found = cut.mapInArrow(run, "lang string, source string, peer string, extra long")
    return found.groupBy("lang", "source", "peer").agg(F.sum("extra").alias("extra"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank.

    A pair's item is another source of the language, with all ranks; a term's is one that the source uses more than the
    language does, up to rank `top`. Terms count if at least `least_docs` texts of the language have them.
    """
    texts = named(docs)
    postings = materialize(kept_postings(texts, least_docs), "postings")
    terms = postings.groupBy("lang", "term").agg(F.max("total").alias("total"))
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("words"))
    own = postings.groupBy("lang", "source").agg(F.sum("n").alias("own"))
    groups = texts.select("lang", "source").distinct().join(langs, "lang", "left").join(own, ["lang", "source"], "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("kept", "words", "own")])
    base = F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("own") + 2 * F.col("kept")))
    groups = materialize(groups.withColumn("base", base), "groups")

    p = share(F.col("n"), F.col("own") + 2 * F.col("kept"))
    q = share(F.col("total"), F.col("words") + 2 * F.col("kept"))
    index = postings.join(groups, ["lang", "source"]).select("lang", "term", "source", "base", p.alias("p"), q.alias("q"))
    index = materialize(index, "index")

    entry = F.struct("p", F.col("count").alias("times"))
    shares = index.groupBy("lang", "source", "p").count().groupBy("lang", "source").agg(F.collect_list(entry).alias("shares"))
    sides = groups.filter("kept > 0").join(shares, ["lang", "source"], "left")
    # A language is one key, so its pairs are spread by the own source.
    left = sides.withColumn("salt", F.pmod(F.xxhash64("source"), F.lit(SALTS)))
    names = {c: f"peer_{c}" for c in ("base", "shares")} | {"source": "peer"}
    right = sides.select("lang", *[F.col(a).alias(b) for a, b in names.items()])
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>")))
    pairs = left.join(right, ["lang", "salt"]).filter(F.col("source") != F.col("peer"))
    both = divergence(F.col("base"), F.col("peer_base"))

    def apart(own_shares: str, other: str) -> Column:
        """Sum over terms of one side, as if the other had none of them."""
        added = F.aggregate(
            own_shares,
            F.lit(0).cast("long"),
            lambda total, x: total + x["times"] * (divergence(x["p"], F.col(other)) - divergence(F.col("base"), F.col("peer_base"))),
        )
        return F.coalesce(added, F.lit(0).cast("long"))

    value = F.col("kept") * both + apart("shares", "peer_base") + apart("peer_shares", "base")
    pairs = pairs.select("lang", "source", "peer", value.alias("apart"))
    pairs = pairs.join(shared_terms(index), ["lang", "source", "peer"], "left")
    value = F.col("apart") + F.coalesce("extra", F.lit(0).cast("long"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), F.col("peer").alias("item"), value.alias("value"))
    none = groups.filter("kept = 0")
    peers = none.select("lang", F.col("source").alias("item"))
    empty = none.join(peers, "lang").filter(F.col("source") != F.col("item"))
    empty = empty.select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    more = index.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), divergence(F.col("p"), F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.unionByName(empty).withColumn("rank", F.row_number().over(order))
    best = more.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.unionByName(best)
