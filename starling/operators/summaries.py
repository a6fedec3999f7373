"""Stored sums over ranges of users and times, from which topic scores of a request are put together.

The score of a word is ln(N / df) * sum of tf * ln(impact + 1). N, df and the sum add up over posts that do not overlap, so
they are stored for cells of users and times (a grid): N in all pairs of a few sizes of cell in each dimension, df and the sum
for the smallest cells, where they take no more rows than the posts have words. A request takes the largest cells that lie
inside it, then smaller ones towards its edges, and reads posts only in what is left: four strips along its edges, narrower
than the smallest cell.

Beside the sums an index of terms is stored: for each term its posts, with their impact, by cell. Posts with one of a
request's words are found in it, ranked by impact, and their texts are read last.

Posts are unique by tid. Texts are split once, when the sums are built.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.functions.text import tokens
from starling.operators import topics
from starling.operators.ranges import inside, range_join
from starling.session import materialize

# Posts in a smallest cell, about, if they were spread evenly.
CELL_POSTS = 64
# Bits between one size of cell and the next.
STEP = 3
CELL = ("u_level", "u", "t_level", "t")


class Grid(NamedTuple):
    """Bounds of the posts, and bits of the sizes of cells, largest first."""

    users: tuple[int, int]
    times: tuple[int, int]
    user_levels: tuple[int, ...]
    time_levels: tuple[int, ...]


class Summaries(NamedTuple):
    grid: Grid
    posts: DataFrame  # tid, sender_uid, timestamp, impact, words, terms (distinct, those of links too)
    sizes: DataFrame  # posts of each cell
    words: DataFrame | None  # weight and posts of each word of a smallest cell (u, t)
    index: DataFrame | None  # posts and impact of each term, by largest cell


def _levels(low: int, high: int, bits: int) -> tuple[int, ...]:
    width = (high - low).bit_length()
    fine = max(0, width - bits)
    return tuple(sorted({*range(max(0, width - STEP), fine, -STEP), fine}, reverse=True))


def grid_of(posts: DataFrame) -> Grid:
    """A grid for these posts, by their number and bounds."""
    bounds = [f(c) for c in ("sender_uid", "timestamp") for f in (F.min, F.max)]
    many, *found = posts.agg(F.count("*"), *bounds).first()
    users, times = ((0, 0), (0, 0)) if found[0] is None or found[2] is None else (tuple(found[:2]), tuple(found[2:]))
    bits = max(1, (many // CELL_POSTS).bit_length() // 2)
    return Grid(users, times, _levels(*users, bits), _levels(*times, bits))


def _cell(level_u: int, level_t: int, u: Column, t: Column) -> Column:
    return F.struct(F.lit(level_u).alias("u_level"), u.alias("u"), F.lit(level_t).alias("t_level"), t.alias("t"))


def _rolled_up(fine: DataFrame, grid: Grid, sums: Sequence[str]) -> DataFrame:
    """Sums of all sizes of cell from those of the smallest (u, t)."""
    low_u, low_t = grid.user_levels[-1], grid.time_levels[-1]
    cells = [
        _cell(lu, lt, F.shiftright("u", lu - low_u), F.shiftright("t", lt - low_t)) for lu in grid.user_levels for lt in grid.time_levels
    ]
    return fine.select(F.inline(F.array(*cells)), *sums).groupBy(*CELL).agg(*(F.sum(c).alias(c) for c in sums))


def _fine(posts: DataFrame, grid: Grid) -> DataFrame:
    """Posts in the bounds with their smallest cell (u, t)."""
    cell = [F.shiftright("sender_uid", grid.user_levels[-1]).alias("u"), F.shiftright("timestamp", grid.time_levels[-1]).alias("t")]
    return posts.where("sender_uid IS NOT NULL AND timestamp IS NOT NULL").select("*", *cell)


def _sizes(placed: DataFrame, grid: Grid) -> DataFrame:
    return materialize(_rolled_up(placed.groupBy("u", "t").agg(F.count("*").alias("n")), grid, ["n"]), "sizes")


def summarize_sizes(posts: DataFrame, grid: Grid | None = None) -> Summaries:
    """The numbers of posts alone, for requests that ask for no words: no text is read."""
    kept = materialize(posts.select("tid", "sender_uid", "timestamp"), "keys")
    grid = grid or grid_of(kept)
    return Summaries(grid, kept, _sizes(_fine(kept, grid), grid), None, None)


def summarize(posts: DataFrame, stop: topics.Terms, grid: Grid | None = None, with_index: bool = True) -> Summaries:
    """The stored sums and index of posts (tid, sender_uid, timestamp, content, counts of engagement).

    Without an index, which only the ranking of posts needs, the terms of posts are not stored either.
    """
    valued = topics.with_impact(posts, stop)
    terms = F.array_distinct(F.transform(tokens(F.col("content")), F.lower))
    kept = ["tid", "sender_uid", "timestamp", "impact", "words", *([terms.alias("terms")] if with_index else [])]
    valued = materialize(valued.select(*kept), "valued")
    grid = grid or grid_of(valued)
    placed = _fine(valued, grid)
    sizes, words = _sizes(placed, grid), materialize(topics.weights_of(placed, stop, ["u", "t"]), "cell-words")
    if not with_index:
        return Summaries(grid, valued, sizes, words, None)
    large = [F.shiftright("sender_uid", grid.user_levels[0]).alias("u"), F.shiftright("timestamp", grid.time_levels[0]).alias("t")]
    index = valued.select(F.explode("terms").alias("word"), *large, "sender_uid", "timestamp", "tid", "impact")
    return Summaries(grid, valued, sizes, words, materialize(index.sortWithinPartitions("word"), "index"))


def _inner(df: DataFrame, name: str, start: str, end: str, levels: Sequence[int]) -> DataFrame:
    """Add the cells inside a range (array `name` of level and cell), and the range that they fill: from name_a up to name_b."""
    empty = F.array().cast("array<bigint>")

    def run(low: Column, high: Column) -> Column:
        return F.when(low < high, F.sequence(low, high - 1)).otherwise(empty)

    cells, a, b = [], F.col(start), F.col(start)
    for i, level in enumerate(levels):
        low, high = F.shiftright(F.col(start) + ((1 << level) - 1), level), F.shiftright(F.col(end) + 1, level)
        found = run(low, high)
        if i:
            beside = F.concat(run(low, F.shiftright(a, level)), run(F.shiftright(b, level), high))
            found = F.when(a < b, beside).otherwise(found)
        # The level by value: the lambda is made before the loop goes on.
        cells.append(F.transform(found, lambda c: F.struct(F.lit(level).alias("level"), c.alias("cell"))))
        a, b = (F.when(low < high, F.shiftleft(x, level)).otherwise(old) for x, old in ((low, a), (high, b)))
        df = df.withColumns({f"_a{i}": a, f"_b{i}": b})
        a, b = F.col(f"_a{i}"), F.col(f"_b{i}")
    return df.withColumns({name: F.concat(*cells), f"{name}_a": a, f"{name}_b": b}).drop(*(f"_{x}{i}" for x in "ab" for i in range(len(levels))))


def split_requests(requests: DataFrame, grid: Grid) -> DataFrame:
    """Requests within the bounds of the grid, with their inner cells (users, times) and the range that these fill."""
    cut = requests.where("uid_start <= uid_end AND time_start <= time_end")
    sides = {"uid": (grid.users, grid.user_levels[0]), "time": (grid.times, grid.time_levels[0])}
    for name, ((low, high), level) in sides.items():
        # There are no posts beyond the bounds, so a request that reaches them ends with a whole cell.
        first, last = low >> level << level, ((high >> level) + 1 << level) - 1
        start, end = F.col(f"{name}_start"), F.col(f"{name}_end")
        cut = cut.where((start <= high) & (end >= low)).withColumns(
            {
                f"{name}_start": F.when(start <= low, F.lit(first)).otherwise(start),
                f"{name}_end": F.when(end >= high, F.lit(last)).otherwise(end),
            }
        )
    cut = cut.select("request_id", "uid_start", "uid_end", "time_start", "time_end")
    cut = _inner(cut, "users", "uid_start", "uid_end", grid.user_levels)
    return _inner(cut, "times", "time_start", "time_end", grid.time_levels)


def inner_cells(split: DataFrame) -> DataFrame:
    """request_id and the cells inside it."""
    users = split.select("request_id", "times", F.inline("users").alias("u_level", "u"))
    return users.select("request_id", "u_level", "u", F.inline("times").alias("t_level", "t"))


def smallest_cells(split: DataFrame, grid: Grid) -> DataFrame:
    """request_id and the smallest cells (u, t) inside it: no more than a grid has, one to some posts."""
    cells = inner_cells(split)
    for name, level in (("u", grid.user_levels[-1]), ("t", grid.time_levels[-1])):
        first, after = (F.expr(f"shiftleft({x}, {name}_level - {level})") for x in (name, f"{name} + 1"))
        cells = cells.withColumn(name, F.explode(F.sequence(first, after - 1)))
    return cells.select("request_id", "u", "t")


def edges_of(split: DataFrame) -> DataFrame:
    """The parts of each request outside its inner cells, as requests that do not overlap."""
    whole = [F.col(c) for c in ("uid_start", "uid_end", "time_start", "time_end")]
    u0, u1, t0, t1 = whole
    ua, ub, ta, tb = (F.col(c) for c in ("users_a", "users_b", "times_a", "times_b"))
    names = ("uid_start", "uid_end", "time_start", "time_end")

    def part(*bounds: Column) -> Column:
        return F.struct(*[b.cast("long").alias(n) for b, n in zip(bounds, names, strict=True)])

    strips = F.array(part(u0, ua - 1, t0, t1), part(ub, u1, t0, t1), part(ua, ub - 1, t0, ta - 1), part(ua, ub - 1, tb, t1))
    some = (ua < ub) & (ta < tb)
    parts = F.when(some, strips).otherwise(F.array(part(*whole)))
    found = split.select("request_id", F.inline(parts))
    return found.where("uid_start <= uid_end AND time_start <= time_end")


def edge_posts(split: DataFrame, stored: Summaries) -> DataFrame:
    """Posts of split requests that no inner cell covers, with their words and impact."""
    return range_join(edges_of(split), stored.posts.drop("terms"))


def asked(requests: DataFrame, stored: Summaries) -> tuple[DataFrame, DataFrame]:
    """Split requests and the posts at their edges, both stored: all that follows reads them."""
    split = materialize(split_requests(requests, stored.grid), "split")
    return split, materialize(edge_posts(split, stored), "edges")


def request_sizes(split: DataFrame, edges: DataFrame, stored: Summaries) -> DataFrame:
    """request_id and n, the posts of each request that has some."""
    parts = inner_cells(split).join(stored.sizes, list(CELL)).select("request_id", "n")
    parts = parts.unionByName(edges.groupBy("request_id").agg(F.count("*").alias("n")))
    return parts.groupBy("request_id").agg(F.sum("n").alias("n"))


def request_words(split: DataFrame, edges: DataFrame, stored: Summaries, stop: topics.Terms) -> DataFrame:
    """Per request and word: weight and df, summed over inner cells and edges."""
    inner = smallest_cells(split, stored.grid).join(stored.words, ["u", "t"]).select("request_id", "word", "weight", "df")
    parts = inner.unionByName(topics.weights_of(edges, stop, ["request_id"]))
    return parts.groupBy("request_id", "word").agg(F.sum("weight").alias("weight"), F.sum("df").alias("df"))


def request_scores(split: DataFrame, edges: DataFrame, stored: Summaries, stop: topics.Terms) -> DataFrame:
    """Score of each word of each request."""
    sizes = request_sizes(split, edges, stored)
    return topics.scored(request_words(split, edges, stored, stop).join(sizes, "request_id"), ["request_id"])


def posts_with_words(words: DataFrame, split: DataFrame, stored: Summaries) -> DataFrame:
    """request_id, tid and impact of the posts that have any of the request's words, by the index.

    A request looks its words up in the largest cells that it touches: at most 10 by 10.
    """
    cut = split.drop("users", "times")
    for name, (start, end, levels) in {
        "u": ("uid_start", "uid_end", stored.grid.user_levels),
        "t": ("time_start", "time_end", stored.grid.time_levels),
    }.items():
        cut = cut.withColumn(name, F.explode(F.sequence(F.shiftright(start, levels[0]), F.shiftright(end, levels[0]))))
    found = stored.index.join(words.select("request_id", "word").join(cut, "request_id"), ["word", "u", "t"]).where(inside())
    return found.select("request_id", "tid", "impact").distinct()
