"""The entries of one tenant's cache inside a task: bounded by ``max_size``."""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass

import numpy as np

from sembra.operators.blocks import RANK_DIGITS


@dataclass
class Entry:
    query_text: str
    embedding: np.ndarray
    dominant_cluster: int
    created_seq: int
    seq: int
    answer_seq: int


class Shelf:
    """Vectors of one cluster in insertion order, as one growing matrix with gaps."""

    def __init__(self, dim: int):
        self.rows = np.empty((8, dim))
        self.live = np.zeros(8, dtype=bool)
        self.keys: list[str] = []
        self.at: dict[str, int] = {}

    def add(self, key: str, vector: np.ndarray) -> None:
        if len(self.keys) == len(self.rows):
            self._make_room()
        used = len(self.keys)
        self.rows[used] = vector
        self.live[used] = True
        self.at[key] = used
        self.keys.append(key)

    def remove(self, key: str) -> None:
        self.live[self.at.pop(key)] = False

    def _make_room(self) -> None:
        """Close the gaps; double the matrix if it is still more than half full."""
        kept = np.flatnonzero(self.live)
        self.rows[: len(kept)] = self.rows[kept]
        self.keys = [self.keys[i] for i in kept]
        self.at = {k: i for i, k in enumerate(self.keys)}
        if len(kept) > len(self.rows) // 2:
            self.rows = np.vstack([self.rows, np.empty_like(self.rows)])
        self.live = np.arange(len(self.rows)) < len(kept)

    def nearest(self, vector: np.ndarray) -> tuple[str, float] | None:
        if not self.at:
            return None
        used = len(self.keys)
        sims = self.rows[:used] @ vector
        ranked = np.where(self.live[:used], np.round(sims, RANK_DIGITS), -np.inf)
        best = int(ranked.argmax())
        return self.keys[best], float(sims[best])


class TenantEntries:
    """Least-recently-used entries with one shelf per cluster; remembers what changed."""

    def __init__(self, threshold: float, max_size: int, depth: int):
        self.threshold, self.max_size, self.depth = threshold, max_size, depth
        self.entries: OrderedDict[str, Entry] = OrderedDict()
        self.shelves: dict[int, Shelf] = {}
        self.changed: set[str] = set()
        self.removed: set[str] = set()

    def load(self, items: list[tuple[str, Entry]]) -> None:
        for key, entry in sorted(items, key=lambda i: i[1].created_seq):
            self._shelve(key, entry)
        self.entries = OrderedDict(sorted(items, key=lambda i: i[1].seq))

    def _shelve(self, key: str, entry: Entry) -> None:
        shelf = self.shelves.get(entry.dominant_cluster)
        if shelf is None:
            shelf = self.shelves[entry.dominant_cluster] = Shelf(len(entry.embedding))
        shelf.add(key, entry.embedding)

    def _use(self, key: str, seq: int) -> Entry:
        entry = self.entries[key]
        entry.seq = seq
        self.entries.move_to_end(key)
        self.changed.add(key)
        return entry

    def _probes(self, dominant: int, distribution: dict[int, float] | None) -> list[int]:
        if distribution and len(distribution) > 1:
            return sorted(distribution, key=lambda c: (-distribution[c], c))[: self.depth]
        return [dominant]

    def lookup(
        self, key: str, vector: np.ndarray, dominant: int, distribution: dict[int, float] | None, seq: int
    ) -> tuple[str, Entry, float] | None:
        if key in self.entries:
            return key, self._use(key, seq), 1.0
        best: tuple[str, float] | None = None
        for cluster in self._probes(dominant, distribution):
            shelf = self.shelves.get(cluster)
            found = shelf.nearest(vector) if shelf else None
            if found and (best is None or round(found[1], RANK_DIGITS) > round(best[1], RANK_DIGITS)):
                best = found
        if best is None or best[1] < self.threshold:
            return None
        return best[0], self._use(best[0], seq), best[1]

    def store(self, key: str, text: str, vector: np.ndarray, dominant: int, seq: int) -> None:
        if key in self.entries:
            self._use(key, seq).answer_seq = seq
            return
        if self.max_size <= 0:
            return
        while len(self.entries) >= self.max_size:
            oldest, entry = self.entries.popitem(last=False)
            self.shelves[entry.dominant_cluster].remove(oldest)
            self.changed.discard(oldest)
            self.removed.add(oldest)
        entry = Entry(text, vector, dominant, seq, seq, seq)
        self.entries[key] = entry
        self._shelve(key, entry)
        self.changed.add(key)
        self.removed.discard(key)

    def clear(self) -> int:
        count = len(self.entries)
        self.removed |= set(self.entries)
        self.changed.clear()
        self.entries.clear()
        self.shelves.clear()
        return count
