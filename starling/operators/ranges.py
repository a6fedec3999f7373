"""Requests with a range of users and times, joined to the posts inside.

An inequality join compares every post with every request. Here each request is covered by cells in both dimensions, whose
sides are powers of four chosen by its own width in users and in time: at most 9 by 9 cells, whatever its shape. The join is
on equal cells, and the exact bounds are checked on what it finds. Only the key of a post takes part; its other columns are
fetched for what was found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What tells posts apart in the join.
KEY = ("tid", "sender_uid", "timestamp")
DIMENSIONS = {"u": ("uid_start", "uid_end", "sender_uid"), "t": ("time_start", "time_end", "timestamp")}


def _level(start: str, end: str) -> Column:
    """Bits by which a value is shifted to give its cell: even, so that requests need few different ones."""
    level = F.greatest(F.length(F.bin(F.col(end) - F.col(start))) - 3, F.lit(0))
    return level + level % 2


def cover(requests: DataFrame) -> DataFrame:
    """The cells (levels u_level and t_level, cells u and t) of each request, with its bounds."""
    cells = requests.where("uid_start <= uid_end AND time_start <= time_end")
    for name, (start, end, _) in DIMENSIONS.items():
        cells = cells.withColumn(f"{name}_level", _level(start, end))
        span = F.sequence(F.expr(f"shiftright({start}, {name}_level)"), F.expr(f"shiftright({end}, {name}_level)"))
        cells = cells.withColumn(name, F.explode(span))
    return cells


def inside() -> Column:
    """Whether a post is within the bounds of a request."""
    exact = [F.col(value).between(F.col(start), F.col(end)) for start, end, value in DIMENSIONS.values()]
    return exact[0] & exact[1]


def asked_posts(cells: DataFrame, posts: DataFrame) -> tuple[list, DataFrame]:
    """The pairs of levels in use, and the posts within the outermost bounds of all requests, by literals that reach the scan."""
    outer = [F.min("uid_start"), F.max("uid_end"), F.min("time_start"), F.max("time_end")]
    # At most 32 levels in each dimension, whatever the number of requests.
    pairs = F.array_sort(F.collect_set(F.struct("u_level", "t_level")))
    levels, low, high, early, late = cells.agg(pairs, *outer).first()
    within = F.col("sender_uid").between(low, high) & F.col("timestamp").between(early, late)
    return levels, posts.where(within if levels else F.lit(False))


def candidates(cells: DataFrame, levels: list, posts: DataFrame) -> DataFrame:
    """Keys of posts that share a cell with a request, with the bounds of the request."""
    each = [F.struct(F.lit(u).alias("u_level"), F.lit(t).alias("t_level")) for u, t in levels or [(0, 0)]]
    placed = posts.select(*(c for c in KEY if c in posts.columns)).distinct().select("*", F.inline(F.array(*each)))
    for name, (_, _, value) in DIMENSIONS.items():
        placed = placed.withColumn(name, F.expr(f"shiftright({value}, {name}_level)"))
    return placed.join(cells, ["u_level", "t_level", "u", "t"])


def range_join(requests: DataFrame, posts: DataFrame) -> DataFrame:
    """Posts of each request (request_id, uid_start, uid_end, time_start, time_end), bounds inclusive.

    Which side is broadcast is left to Spark. Requests that share an id must not overlap.
    """
    cells = cover(requests.select("request_id", "uid_start", "uid_end", "time_start", "time_end"))
    levels, asked = asked_posts(cells, posts)
    keys = [c for c in KEY if c in posts.columns]
    found = candidates(cells, levels, asked).where(inside()).select("request_id", *(F.col(c).alias(f"_{c}") for c in keys))
    condition = F.lit(True)
    for c in keys:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return found.join(asked, condition).select("request_id", *posts.columns)
