"""Token ids of distinct pieces of text, kept end to end in one array."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa


class IdHeap:
    """Remembers the ids of pieces; asks for those it does not know.

    ``ask`` may put the pieces into another order, and gives (ids of all, one
    piece after the other; how many of each).  Beyond ``most`` pieces those seen
    in one batch alone are forgotten, and of the others the least seen beyond
    half of ``most``; what is needed again is asked for again.
    """

    def __init__(self, ask: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int) -> None:
        self.ask, self.most = ask, most
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.used = 0
        self.ids = np.empty(1 << 16, "<u4")
        self.starts = np.empty(1 << 14, np.int64)
        self.sizes = np.empty(1 << 14, np.int64)
        self.seen = np.empty(1 << 14, np.int32)

    def _forget(self) -> None:
        """Keep the pieces of several batches, at most half of what fits."""
        pieces, seen = list(self.number), self.seen[: len(self.number)]
        kept = np.flatnonzero(seen > 1)
        if len(kept) > self.most // 2:
            kept = np.sort(kept[np.argsort(seen[kept], kind="stable")[len(kept) - self.most // 2 :]])
        ids, sizes = self._ids(kept)
        pieces = [pieces[i] for i in kept.tolist()]
        self._clear()
        if pieces:
            self._add(pieces, ids, sizes)

    def _ids(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the pieces of these numbers, one after the other; how many of each)."""
        n = self.sizes[which]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.starts[which] - ends + n, n) + np.arange(total)], n

    def _add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, total, used = len(self.number), len(ids), self.used
        while used + total > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while n + len(pieces) > len(self.starts):
            self.starts, self.sizes, self.seen = (np.concatenate((x, np.empty_like(x))) for x in (self.starts, self.sizes, self.seen))
        self.ids[used : used + total] = ids
        ends = np.cumsum(sizes)
        self.starts[n : n + len(pieces)] = used + ends - sizes
        self.sizes[n : n + len(pieces)] = sizes
        self.seen[n : n + len(pieces)] = 0
        self.number.update(zip(pieces, range(n, n + len(pieces)), strict=True))
        self.used += total

    def numbers(self, pieces: list[str]) -> np.ndarray:
        """The numbers of distinct pieces."""
        if len(self.number) + len(pieces) > self.most and self.number:
            self._forget()
        found = list(map(self.number.get, pieces))
        if missing := [i for i, k in enumerate(found) if k is None]:
            new = [pieces[i] for i in missing]
            self._add(new, *self.ask(new))
            for i in missing:
                found[i] = self.number[pieces[i]]
        which = np.array(found, np.int64)
        self.seen[which] += 1
        return which

    def gather(self, flat: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces of an array of texts, one after the other; how many of each)."""
        coded = flat.dictionary_encode()
        # By way of NumPy, which makes the strings ten times as fast as to_pylist.
        which = self.numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()] if len(flat) else np.empty(0, np.int64)
        return self._ids(which)
