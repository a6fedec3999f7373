"""Totals of shared tags of all pairs of users of two blocks, by arrays.

The total of a pair is the sum over shared tags of both users' uses: the product of uses and presence of the one with presence
and uses of the other. Tags that many of both blocks have are multiplied as matrices, the others added one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

# Pairs, and meetings of two users at a tag, that are held at once.
CELLS = 1 << 21
# A tag is multiplied where more than one in so many pairs of the blocks share it: about as cheap then as adding these.
RARE = 100


class Block(NamedTuple):
    """The tags of some users, one place for each, in the order of the users' rows."""

    users: int
    row: np.ndarray
    tag: np.ndarray
    uses: np.ndarray

    def of(self, tags: np.ndarray) -> Block:
        """What belongs to these sorted tags, which are numbered from 0."""
        at = np.minimum(np.searchsorted(tags, self.tag), len(tags) - 1)
        kept = tags[at] == self.tag
        return Block(self.users, self.row[kept], at[kept], self.uses[kept])

    def where(self, kept: np.ndarray) -> Block:
        return Block(self.users, self.row[kept], self.tag[kept], self.uses[kept])

    def most(self) -> int:
        """No user has more uses than this."""
        return int(np.bincount(self.row, self.uses, self.users).max(initial=0)) + 1


def _exact(most: int) -> type:
    """The fastest kind of number that holds all whole numbers up to this."""
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


def _matrix(block: Block, tags: np.ndarray, kind: type, uses_first: bool) -> np.ndarray:
    """A row for each user: uses of and presence at these tags, or the other way round."""
    part = block.of(tags)
    out = np.zeros((block.users, 2, len(tags)), kind)
    out[part.row, 0 if uses_first else 1, part.tag] = part.uses
    out[part.row, 1 if uses_first else 0, part.tag] = 1
    return out.reshape(block.users, -1)


def _slices(sizes: np.ndarray) -> Iterator[slice]:
    """Runs of at most CELLS in all, or of one that is larger."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + CELLS, "right")))
        yield slice(start, stop)
        start = stop


def totals(left: Block, right: Block, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row in left, row in right and total of the pairs that reach `least` (at least 1), some at a time."""
    tags = np.intersect1d(left.tag, right.tag)
    if not len(tags):
        return
    kind = _exact(left.most() + right.most())
    left, right = left.of(tags), right.of(tags)
    here, there = (np.bincount(x.tag, minlength=len(tags)) for x in (left, right))
    common = here * there * RARE > left.users * right.users
    shared = np.flatnonzero(common)
    a, b = _matrix(left, shared, kind, True) if len(shared) else None, _matrix(right, shared, kind, False).T if len(shared) else None
    left, right = left.where(~common[left.tag]), right.where(~common[right.tag])
    order = np.argsort(right.tag, kind="stable")
    column, right_uses = right.row[order], right.uses[order].astype(kind)
    there = np.bincount(right.tag, minlength=len(tags))
    first = np.cumsum(there) - there
    left_uses, meetings = left.uses.astype(kind), there[left.tag]
    step = max(1, CELLS // right.users)
    for start in range(0, left.users, step):
        stop = min(start + step, left.users)
        sums = a[start:stop] @ b if len(shared) else np.zeros((stop - start, right.users), kind)
        flat = sums.reshape(-1)
        lo, hi = np.searchsorted(left.row, [start, stop])
        for part in _slices(meetings[lo:hi]):
            part = slice(lo + part.start, lo + part.stop)
            n = meetings[part]
            ends = np.cumsum(n)
            at = np.arange(ends[-1]) + np.repeat(first[left.tag[part]] - ends + n, n)
            cell = np.repeat((left.row[part] - start) * right.users, n) + column[at]
            np.add.at(flat, cell, np.repeat(left_uses[part], n) + right_uses[at])
        found = np.flatnonzero(flat >= least)
        yield start + found // right.users, found % right.users, flat[found].astype(np.int64)
