"""Suffix sorting of one shard by external induced sorting.

Suffixes are sorted by inducing: the leftmost S-suffixes (LMS) are sorted first, by naming their substrings and
sorting the shorter string of names, and every other suffix is then placed by a scan over sorted suffixes, each
of which hands the suffix before it to the queue of that suffix's first symbol. Since a scan visits symbols in
order and hands over in order, a priority queue is one first-in-first-out queue per symbol; queues and arrays
go to disk beyond the memory given, so a shard may be far larger than memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BLOCK = 1 << 20


class Store:
    """Arrays in memory up to `memory` bytes, beyond that in files of a folder that goes with `close`."""

    def __init__(self, memory: int):
        self.memory, self.held, self.folder, self.files, self.log, self.end = memory, 0, None, 0, None, 0

    def file(self) -> str:
        self.folder = self.folder or tempfile.TemporaryDirectory()
        self.files += 1
        return f"{self.folder.name}/{self.files}"

    def array(self, n: int, dtype) -> np.ndarray:
        size = n * np.dtype(dtype).itemsize
        if not n or self.held + size <= self.memory:
            self.held += size
            return np.zeros(n, dtype)
        return np.memmap(self.file(), dtype, "w+", shape=(n,))

    def append(self, block: np.ndarray) -> tuple[int, int]:
        """Writes a queue's block to the one file they share."""
        self.log = self.log or open(self.file(), "w+b")  # noqa: SIM115
        self.log.seek(self.end)
        self.log.write(np.ascontiguousarray(block, np.int64).tobytes())
        at, self.end = self.end, self.end + 8 * len(block)
        return at, len(block)

    def appended(self, at: int, n: int) -> np.ndarray:
        self.log.seek(at)
        return np.frombuffer(self.log.read(8 * n), np.int64)

    def close(self) -> None:
        if self.log:
            self.log.close()
        if self.folder:
            self.folder.cleanup()


class Queue:
    """First in, first out, of suffixes; blocks pushed while it is read are read too, and it can be read backwards."""

    def __init__(self, store: Store):
        self.store, self.blocks = store, []

    def push(self, block: np.ndarray) -> None:
        if self.store.held + block.nbytes <= self.store.memory:
            self.store.held += block.nbytes
            self.blocks.append(block)
        else:
            self.blocks.append(self.store.append(block))

    def size(self, i: int) -> int:
        return self.blocks[i][1] if isinstance(self.blocks[i], tuple) else len(self.blocks[i])

    def read(self, a: int, b: int) -> np.ndarray:
        blocks = [self.store.appended(*x) if isinstance(x, tuple) else x for x in self.blocks[a:b]]
        return blocks[0] if len(blocks) == 1 else np.concatenate(blocks)

    def __iter__(self) -> Iterator[np.ndarray]:
        """Small blocks are read together, as many as there are by then."""
        i = 0
        while i < len(self.blocks):
            j, size = i, 0
            while j < len(self.blocks) and size < BLOCK:
                size, j = size + self.size(j), j + 1
            yield self.read(i, j)
            i = j

    def __reversed__(self) -> Iterator[np.ndarray]:
        j = len(self.blocks)
        while j:
            i, size = j, 0
            while i and size < BLOCK:
                i -= 1
                size += self.size(i)
            yield self.read(i, j)
            j = i


def hand_over(queues: list[Queue], symbols: np.ndarray, suffixes: np.ndarray) -> None:
    order = np.argsort(symbols, kind="stable")
    sorted_symbols, suffixes = symbols[order].astype(np.int32), suffixes[order]
    edges = np.flatnonzero(np.diff(sorted_symbols, prepend=-1)) if len(order) else []
    for a, b in zip(edges, [*edges[1:], len(order)]):  # noqa: B905
        queues[sorted_symbols[a]].push(suffixes[a:b])


def parts(block: np.ndarray, backwards: bool = False) -> Iterator[np.ndarray]:
    starts = range(0, len(block), BLOCK)
    for a in reversed(starts) if backwards else starts:
        part = np.asarray(block[a : a + BLOCK])
        yield part[::-1] if backwards else part


def induce(s: np.ndarray, is_s: np.ndarray, seeds: list[Queue], sigma: int, store: Store) -> Iterator[np.ndarray]:
    """All suffixes in order, in blocks by falling symbol and falling order, from the order of the LMS suffixes."""
    larger, smaller = [Queue(store) for _ in range(sigma)], [Queue(store) for _ in range(sigma)]
    for c in range(sigma):
        for queue in (larger[c], seeds[c]):
            for block in queue:
                for part in parts(block):
                    before = part[part > 0] - 1
                    before = before[~is_s[before]]
                    hand_over(larger, s[before], before)
    for c in reversed(range(sigma)):
        for block in smaller[c]:
            for part in parts(block):
                before = part[part > 0] - 1
                before = before[is_s[before]]
                hand_over(smaller, s[before], before)
                yield part
        for block in reversed(larger[c]):
            for part in parts(block, backwards=True):
                before = part[part > 0] - 1
                before = before[is_s[before]]
                hand_over(smaller, s[before], before)
                yield part
    # the last suffix is the sentinel alone; no suffix induces it
    yield np.array([len(s) - 1])


def ranks_of_names(names: np.ndarray, depth: int, store: Store) -> np.ndarray:
    """Ranks of the suffixes of the shorter string by its first `depth` names, by doubling; ties keep one rank."""
    rank, step, n = names.astype(np.int64), 1, len(names)
    while step < depth:
        then = store.array(n, np.int64)
        then[: max(0, n - step)] = rank[step:] + 1
        then += rank * (n + 1)
        order = np.argsort(then)
        new = np.ones(n, bool)
        new[1:] = np.diff(then[order]) != 0
        fresh = store.array(n, np.int64)
        fresh[order] = np.cumsum(new) - 1
        rank, step = fresh, step * 2
        if new.all():
            break
    return rank


def sorted_suffixes(s: np.ndarray, sigma: int, depth: int, store: Store) -> Iterator[np.ndarray]:
    """Suffixes of `s` in falling order, by `depth` symbols at least. `s` ends with its only 0."""
    n = len(s)
    change = np.diff(s.astype(np.int32))
    at = np.where(change != 0, np.arange(n - 1), n)
    following = np.minimum.accumulate(at[::-1])[::-1]
    is_s = store.array(n, bool)
    is_s[:-1] = np.where(following < n, change[np.minimum(following, n - 2)] > 0, False)
    is_s[-1] = True
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1

    def seeded(order: np.ndarray) -> list[Queue]:
        queues = [Queue(store) for _ in range(sigma)]
        hand_over(queues, s[order], order)
        return queues

    is_lms = store.array(n, bool)
    is_lms[lms] = True
    held, end = store.held, store.end
    found = [part[is_lms[part]] for part in induce(s, is_s, seeded(lms), sigma, store)]
    store.held, store.end = held, end  # the queues are done with
    order = np.concatenate(found)[::-1]  # rising; the sentinel first
    _, first = np.unique(order, return_index=True)
    order = order[np.sort(first)]
    place = store.array(n, np.int64)
    place[lms] = np.arange(len(lms))
    ends = np.append(lms[1:], n - 1)
    end_of = ends[place[order]]
    sizes = end_of - order + 1
    same = np.zeros(len(order), bool)
    same[1:] = sizes[1:] == sizes[:-1]
    for size in np.unique(sizes[same]):  # equal substrings lie side by side
        k = np.flatnonzero(same & (sizes == size))
        view = np.lib.stride_tricks.sliding_window_view(s, size)
        step = max(1, (1 << 24) // int(size))
        for a in range(0, len(k), step):
            one = k[a : a + step]
            same[one] = (view[order[one]] == view[order[one - 1]]).all(1)
    names = store.array(len(lms), np.int64)
    names[place[order]] = np.cumsum(~same) - 1
    rank = names if not same.any() else ranks_of_names(names, depth, store)
    yield from induce(s, is_s, seeded(lms[np.argsort(rank, kind="stable")]), sigma, store)


def repeated_windows(fragments: list[bytes], owners: np.ndarray, size: int, memory: int = 256 << 20) -> list[np.ndarray]:
    """Per fragment, the starts of windows of `size` bytes that also lie in a fragment of a smaller owner."""
    store = Store(memory)
    try:
        lengths = np.array([len(f) + 1 for f in fragments], np.int64)
        edges = np.concatenate([[0], np.cumsum(lengths)])
        s = store.array(int(edges[-1]) + 1, np.uint16)
        for f, a in zip(fragments, edges, strict=False):
            s[a : a + len(f)] = np.frombuffer(f, np.uint8)
            s[a : a + len(f)] += 2
            s[a + len(f)] = 1  # sets fragments apart
        windows = np.lib.stride_tricks.sliding_window_view(s, size) if len(s) >= size else np.zeros((0, size))
        found: list[np.ndarray] = []
        group: list[np.ndarray] = []

        def told() -> None:
            """Of suffixes whose first `size` bytes are one string, those of larger owners."""
            if not group:
                return
            at = np.concatenate(group)
            of = owners[np.searchsorted(edges, at, "right") - 1]
            found.append(at[of > of.min()])
            group.clear()

        for part in sorted_suffixes(s, 258, size, store):
            inside = part[part < edges[-1]]
            home = np.searchsorted(edges, inside, "right") - 1
            inside = inside[edges[home + 1] - 1 - inside >= size]
            for a in range(0, len(inside), 1 << 16):
                at = inside[a : a + (1 << 16)]
                equal = np.zeros(len(at), bool)
                equal[1:] = (windows[at[1:]] == windows[at[:-1]]).all(1)
                equal[0] = bool(group) and bool((windows[at[0]] == windows[group[-1][-1]]).all())
                cuts = np.flatnonzero(~equal)
                if not len(cuts):
                    group.append(at)
                    continue
                if cuts[0]:
                    group.append(at[: cuts[0]])
                told()
                last = at[cuts[-1] :]
                whole = at[cuts[0] : cuts[-1]]
                if len(whole):
                    bounds = cuts[:-1] - cuts[0]
                    of = owners[np.searchsorted(edges, whole, "right") - 1]
                    least = np.minimum.reduceat(of, bounds)
                    found.append(whole[of > np.repeat(least, np.diff([*bounds, len(whole)]))])
                group.append(last)
        told()
        at = np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)
        home = np.searchsorted(edges, at, "right") - 1
        cut = np.searchsorted(home, np.arange(len(fragments) + 1))
        return [at[cut[i] : cut[i + 1]] - edges[i] for i in range(len(fragments))]
    finally:
        store.close()
