"""I-Match fingerprints with randomised lexicons, by Spark's own functions alone.

The lexicon holds the terms whose share of documents lies within a band (so their inverse document frequency does). A
document's distinct lexicon terms are sorted, and hashed once for each of several random parts of the lexicon: parts are
a 4th, a 16th, a 64th and a 256th of it, so that texts of any length have parts in which they hold one or two terms, and
an edit leaves some of them as they are. The fingerprint is the list of these hashes.

Likeness is the share of equal hashes among the parts of one size, where that is highest; sizes with fewer than LEAST
parts that hold a term of either text count only if no other does.

The lexicon is broadcast: terms in at least 1 / RARE of the documents are at most RARE times as many as a document has
terms on average. The size is checked, and beyond MAX_BROADCAST terms the join is left to Spark.

Terms are runs of letters and digits, in lower case, known by a 64-bit hash. Defined results: a text without a lexicon
term has the hash of all its sorted terms as its fingerprint, and likeness 1 to the same and 0 to any other; without any
term it is the hash of the text. Null texts are empty. Repeated rows each have a row, and are each other's next ones. A
null doc_id comes after all others. The only document is its own next one.
"""

from __future__ import annotations

import bisect

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starling.llm.common import NO_ID, doc_texts
from starling.session import materialize

RARE, FREQUENT = 300, 0.3
LEVELS = ((2, 4), (4, 8), (6, 16), (8, 24))  # (bits, parts): that many of the 2**bits parts
LEAST = 4
MAX_BROADCAST = 1_000_000
RANGE_ROWS = 256
SAMPLED = 8  # ids seen for each bound between ranges
MAX_RANGES = 1 << 16
NOT_TERM = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """Distinct terms of a text."""
    return F.array_distinct(F.array_remove(F.split(F.lower(text), NOT_TERM), ""))


def lexicon(docs: DataFrame, rare: int = RARE, frequent: float = FREQUENT) -> DataFrame:
    """Hashes of the terms in the band, over all rows of docs."""
    count = docs.count()
    found = doc_texts(docs).select(F.explode(terms(F.col("text"))).alias("word")).select(F.xxhash64("word").alias("term"))
    found = found.groupBy("term").count().filter((F.col("count") * rare >= count) & (F.col("count") <= frequent * count))
    stored = materialize(found.select("term"), "lexicon")
    return F.broadcast(stored) if stored.count() <= MAX_BROADCAST else stored


def part_hashes(found: Column) -> list[Column]:
    """For each level the hashes of the sorted lexicon terms in its parts; null for a part without any."""
    out = []
    for bits, parts in LEVELS:
        part = lambda term, bits=bits: F.xxhash64(term, F.lit(bits)).bitwiseAND(F.lit((1 << bits) - 1))
        own = F.filter(found, lambda term: part(term) < parts)
        hashed = F.transform(
            F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.filter(own, lambda term: part(term) == i)
        )
        out.append(F.transform(hashed, lambda held: F.when(F.size(held) > 0, F.hash(held))))
    return out


def fingerprint(levels: list[Column], whole: Column) -> Column:
    """The hashes as text; `whole` where there is none."""
    hashes = F.concat(*levels)
    listed = F.array_join(F.transform(hashes, lambda h: F.coalesce(F.lower(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF)))), F.lit(""))), ".")
    return F.when(F.exists(hashes, lambda h: h.isNotNull()), listed).otherwise(F.concat(F.lit("="), F.lower(F.hex(whole))))


def likeness(left: list[Column], right: list[Column], same: Column) -> Column:
    """Likeness of two lists of levels; `same` says whether the fingerprints are equal."""
    equal, held = [], []
    for a, b in zip(left, right, strict=True):
        pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
        held.append(F.size(F.filter(pairs, lambda p: p["a"].isNotNull() | p["b"].isNotNull())))
        equal.append(F.size(F.filter(pairs, lambda p: p["a"] == p["b"])))
    shares = [F.when(h >= LEAST, e / h) for e, h in zip(equal, held, strict=True)]
    all_held, all_equal = sum(held[1:], held[0]), sum(equal[1:], equal[0])
    overall = F.when(all_held > 0, all_equal / F.greatest(all_held, F.lit(1))).otherwise(F.lit(0.0))
    return F.when(same, 1.0).otherwise(F.coalesce(F.greatest(*shares), overall))


def in_ranges(docs: DataFrame) -> DataFrame:
    """doc_id, text, range and guest: documents in ranges of ids, each with the first document of the next range as a guest.

    Ranges hold about RANGE_ROWS rows; their bounds come from a sample of the ids. Next is the range of the next lower
    ids, and for the lowest the highest. So each text moves once, and each range knows the next document of its last one.
    """
    spark = docs.sparkSession
    texts = doc_texts(docs).withColumn("key", F.coalesce("doc_id", F.lit(NO_ID)))
    ids = texts.select("key")
    rows = max(RANGE_ROWS, ids.count() // MAX_RANGES)
    sampled = ids.filter(F.pmod(F.xxhash64("key"), F.lit(rows // SAMPLED)) == 0).orderBy("key")
    # At most SAMPLED * MAX_RANGES numbers, give or take the sample's error.
    bounds = sorted({row[0] for row in sampled.collect()[SAMPLED // 2 :: SAMPLED]})
    # How many bounds are at most the key, by halving: the list is filled up to 2**depth - 1.
    depth = max(1, len(bounds).bit_length())
    table = spark.createDataFrame([(bounds + [(1 << 63) - 1] * ((1 << depth) - 1 - len(bounds)),)], "bounds array<long>")
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(depth))])
    within = lambda key: F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get("bounds", at + step - 1) <= key, at + step).otherwise(at)
    )
    ranged = texts.withColumn("bounds", table.scalar()).withColumn("range", within(F.col("key"))).drop("bounds")
    # One row for each range.
    highest = {row["range"]: row["key"] for row in ranged.groupBy("range").agg(F.max("key").alias("key")).collect()}
    order = sorted(highest)
    hosts = [(highest[r], order[(bisect.bisect(order, r)) % len(order)]) for r in order]
    hosts = spark.createDataFrame(hosts, "key long, host int")
    ranged = ranged.join(F.broadcast(hosts), "key", "left")
    place = lambda at, guest: F.struct(at.alias("range"), F.lit(guest).alias("guest"))
    both = F.array_compact(F.array(place(F.col("range"), False), F.when(F.col("host").isNotNull(), place(F.col("host"), True))))
    return ranged.select("doc_id", "key", "text", F.explode(both).alias("place")).select("doc_id", "key", "text", "place.*")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next for every row of docs.

    The edited text has its last third replaced by as many characters of the next document's beginning.
    """
    words = lexicon(docs)
    ranges = in_ranges(docs)
    down = Window.partitionBy("range").orderBy("guest", F.col("key").desc(), F.xxhash64("text"))
    rows = ranges.select("*", F.row_number().over(down).alias("place"), F.lead("text").over(down).alias("next"))
    size = F.length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - cut), F.substring(F.coalesce("next", F.lit("")), F.lit(1), cut))
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text")), F.struct(F.lit(1).alias("side"), edited.alias("text"))))
    rows = rows.select("range", "place", "guest", "doc_id", sides.alias("of"))
    rows = rows.select("range", "place", "guest", "doc_id", "of.side", "of.text", terms(F.col("of.text")).alias("words"))
    whole = F.when(F.size("words") > 0, F.xxhash64(F.array_sort("words"))).otherwise(F.xxhash64("text"))
    told = F.struct(
        "doc_id", "guest", F.length("text").alias("n_chars"), F.sha2("text", 256).alias("sha256"), whole.alias("whole")
    )
    rows = rows.select("range", "place", "side", "words", told.alias("told"))
    rows = rows.select("range", "place", "side", "told", F.posexplode_outer("words").alias("at", "word"))
    # What is known of a text stays with its first term only.
    first = F.coalesce(F.col("at") == 0, F.lit(True))
    rows = rows.select("range", "place", "side", F.when(first, F.col("told")).alias("told"), F.xxhash64("word").alias("term"))
    held = rows.join(words.withColumn("known", F.lit(True)), "term", "left").filter("known OR told IS NOT NULL")

    def of(side: int, what: Column) -> Column:
        return F.when(F.col("side") == side, what)

    term = F.when(F.col("known"), F.col("term"))
    grouped = held.groupBy("range", "place").agg(
        F.sort_array(F.collect_list(of(0, term))).alias("own"),
        F.sort_array(F.collect_list(of(1, term))).alias("edited"),
        *[
            F.max(of(side, F.col("told")[name])).alias(f"{name}_{side}")
            for side in (0, 1)
            for name in ("doc_id", "guest", "n_chars", "sha256", "whole")
        ],
    )
    levels = range(len(LEVELS))
    hashed = grouped.select(
        "*",
        *[h.alias(f"own_{i}") for i, h in enumerate(part_hashes(F.col("own")))],
        *[h.alias(f"edited_{i}") for i, h in enumerate(part_hashes(F.col("edited")))],
    )
    own, changed = [F.col(f"own_{i}") for i in levels], [F.col(f"edited_{i}") for i in levels]
    hashed = hashed.select(
        "*",
        fingerprint(own, F.col("whole_0")).alias("fingerprint"),
        fingerprint(changed, F.col("whole_1")).alias("edited_fingerprint"),
    )
    along = Window.partitionBy("range").orderBy("place")
    after = F.lead(F.struct("fingerprint", *[f"own_{i}" for i in levels])).over(along)
    hashed = hashed.withColumn("after", after).filter(~F.col("guest_0"))
    following = [F.col("after")[f"own_{i}"] for i in levels]
    return hashed.select(
        F.col("doc_id_0").alias("doc_id"),
        F.col("n_chars_0").cast("long").alias("n_chars"),
        F.col("sha256_1").alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(own, changed, F.col("fingerprint") == F.col("edited_fingerprint")).alias("near_edited"),
        likeness(own, following, F.col("fingerprint") == F.col("after")["fingerprint"]).alias("near_next"),
    )
