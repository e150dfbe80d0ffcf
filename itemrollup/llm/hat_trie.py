"""A HAT-trie over word ids: burstable containers of phrase counts under a shallow trie.

A phrase is a column of ``width`` 64-bit word ids, shorter phrases padded with id 0.  A trie
node branches on the word id at its depth, by ranges of ids; below a range lies a container
(runs of phrases with counts) or another node.  A full container is merged; if it is still
more than half full it bursts: it is split at its middle word id, or, when one word fills it, a
node over the next word takes its place.  So frequent first words get deep subtrees and rare
ones share containers.

Memory is bounded by ``budget`` rows: beyond it the largest subtrees below the root leave the
trie whole, as sorted runs with one row a phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U64 = np.uint64
Run = tuple[np.ndarray, np.ndarray]  # ids (width, rows), sorted by column; counts (rows)


def merge(runs: list[Run]) -> Run:
    """One sorted run with one row a phrase."""
    if len(runs) == 1:
        return runs[0]
    keys = np.concatenate([k for k, _ in runs], axis=1)
    counts = np.concatenate([c for _, c in runs])
    order = np.lexsort(keys[::-1])
    keys, counts = keys[:, order], counts[order]
    new = np.ones(len(counts), dtype=bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    at = np.flatnonzero(new)
    return keys[:, at], np.add.reduceat(counts, at) if len(at) else counts


class Container:
    def __init__(self, run: Run | None = None):
        self.runs: list[Run] = [run] if run else []
        self.rows = len(run[1]) if run else 0

    def merged(self) -> Run:
        run = merge(self.runs)
        self.runs, self.rows = [run], len(run[1])
        return run

    def drain(self) -> Iterator[Run]:
        if self.rows:
            yield self.merged()


class Node:
    """Branches on the word at ``depth``; kid i holds the ids from cuts[i] up to the next cut."""

    def __init__(self, depth: int, kid: Container | None = None):
        self.depth, self.cuts, self.kids = depth, [0], [kid or Container()]

    @property
    def rows(self) -> int:
        return sum(k.rows for k in self.kids)

    def add(self, keys: np.ndarray, counts: np.ndarray, capacity: int) -> None:
        bounds = [0, *np.searchsorted(keys[self.depth], np.array(self.cuts[1:], dtype=U64)).tolist(), len(counts)]
        for i in range(len(self.kids) - 1, -1, -1):  # from the right, as bursting adds kids behind
            lo, hi = bounds[i], bounds[i + 1]
            if lo == hi:
                continue
            kid = self.kids[i]
            if isinstance(kid, Node):
                kid.add(keys[:, lo:hi], counts[lo:hi], capacity)
                continue
            kid.runs.append((keys[:, lo:hi].copy(), counts[lo:hi].copy()))  # a view would keep its whole run alive
            kid.rows += hi - lo
            if kid.rows > capacity:
                kid.merged()
                if 2 * kid.rows > capacity:
                    self._burst(i, capacity)

    def _burst(self, i: int, capacity: int) -> None:
        keys, counts = self.kids[i].runs[0]
        words = keys[self.depth]
        middle = words[len(words) // 2]
        if words[0] != words[-1]:
            at = int(np.searchsorted(words, middle)) or int(np.searchsorted(words, middle, side="right"))
            parts, cuts = [slice(0, at), slice(at, None)], [self.cuts[i], int(words[at])]
            kids = [Container((keys[:, p].copy(), counts[p].copy())) for p in parts]
        elif self.depth + 1 < len(keys):  # one word: its range becomes its own and a node over the next word
            word, end = int(middle), self.cuts[i + 1] if i + 1 < len(self.cuts) else 1 << 64
            cuts, kids = [word], [Node(self.depth + 1, self.kids[i])]
            if self.cuts[i] < word:
                cuts, kids = [self.cuts[i], *cuts], [Container(), *kids]
            if word + 1 < end:
                cuts, kids = [*cuts, word + 1], [*kids, Container()]
        else:
            return
        self.cuts[i:i + 1], self.kids[i:i + 1] = cuts, kids

    def drain(self) -> Iterator[Run]:
        for kid in self.kids:
            yield from kid.drain()


class HatTrie:
    def __init__(self, width: int, capacity: int = 1 << 16, budget: int = 1 << 21):
        self.width, self.capacity, self.budget = width, capacity, budget
        self.root, self.rows = Node(0), 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> Iterator[Run]:
        """Add a sorted run; yields the runs of subtrees that had to leave."""
        self.root.add(keys, counts, self.capacity)
        self.rows += len(counts)
        if self.rows > self.budget:
            self.rows = self.root.rows  # merged rows count once
        while self.rows > self.budget:
            i = max(range(len(self.root.kids)), key=lambda k: self.root.kids[k].rows)
            kid, self.root.kids[i] = self.root.kids[i], Container()
            self.rows -= kid.rows
            yield from kid.drain()

    def drain(self) -> Iterator[Run]:
        """Everything that is left, in order; the trie is empty then."""
        root, self.root, self.rows = self.root, Node(0), 0
        yield from root.drain()
