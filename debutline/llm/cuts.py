"""Ids of texts that are put together from the ids of their cuts, a stream of many texts at a time.

Texts stand one after the other in one stream of characters. It is cut where tokens surely end; equal cuts have equal ids, so each distinct one is
encoded once and the stream's ids are gathered from the table of cuts. All steps but the encoding work on whole arrays.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

# stands between texts: half of a surrogate pair, which no text holds
BREAK = "\ud800"
# odd numbers with bits all over
FACTORS = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5]
MOST_CUTS = 1_500_000
WINDOW = 1 << 18


class Cuts:
    """The cuts met so far: ids by a 64-bit hash of the characters, told apart by a second one."""

    def __init__(self, turn: int):
        # odd factors have an inverse, so the hash of a cut does not depend on its place in the stream
        self.factor = FACTORS[turn % len(FACTORS)]
        # an open table of 2 ** bits places, at most half of them taken; no key is 0
        self.bits = 12
        self.table, self.rows = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.int32)
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.powers = [np.ones(1, np.uint64)] * 2

    def _grown(self, size: int) -> list[np.ndarray]:
        if len(self.powers[0]) < size:
            self.powers = []
            for factor in (self.factor, pow(self.factor, -1, 1 << 64)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                self.powers.append(np.cumprod(steps))
        return self.powers

    def hashes(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(keys, checks) of cuts: a polynomial of the characters, and their sum with the length."""
        up, down = self._grown(len(points) + 1)
        values = points.astype(np.uint64) + np.uint64(1)
        plain = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
        values *= up[: len(points)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
        keys = (sums[ends] - sums[starts]) * down[starts]
        checks = (plain[ends] - plain[starts]) + ((ends - starts).astype(np.uint64) << np.uint64(40))
        return np.where(keys == 0, np.uint64(1), keys), checks

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(FACTORS[0])) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where it is not known."""
        out = np.full(len(keys), -1, np.int64)
        left, place, mask = np.arange(len(keys)), self._places(keys), (1 << self.bits) - 1
        while len(left):
            held = self.table[place]
            hit = held == keys[left]
            out[left[hit]] = self.rows[place[hit]]
            on = ~hit & (held != 0)
            left, place = left[on], (place[on] + 1) & mask
        return out

    def _insert(self, keys: np.ndarray, rows: np.ndarray) -> None:
        place, mask = self._places(keys), (1 << self.bits) - 1
        while len(keys):
            free = self.table[place] == 0
            self.table[place[free]] = keys[free]  # of several keys the last one has the place
            won = free & (self.table[place] == keys)
            self.rows[place[won]] = rows[won]
            keys, rows, place = keys[~won], rows[~won], (place[~won] + 1) & mask

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: list[bytes]) -> None:
        """New keys, each once."""
        sizes = np.array([len(row) // 4 for row in ids], np.int64)
        self.keys = np.concatenate([self.keys, keys])
        if 2 * len(self.keys) > len(self.table):
            self.bits = (4 * len(self.keys)).bit_length()
            self.table, self.rows = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
            self._insert(self.keys, np.arange(len(self.keys), dtype=np.int32))
        else:
            self._insert(keys, np.arange(len(self.keys) - len(keys), len(self.keys), dtype=np.int32))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.checks = np.concatenate([self.checks, checks])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(ids), np.uint32)])


class _Collision(Exception):
    """Two cuts have one hash; the next factors tell them apart."""


class CutStream:
    """Encodes streams; about `most` cuts are remembered between them."""

    def __init__(self, most: int = MOST_CUTS):
        self.most, self.turn, self.cuts = most, 0, Cuts(0)

    def encode(
        self,
        text: str,
        edges: Callable[[np.ndarray], np.ndarray],
        learn: Callable[[list[str]], list[bytes]],
        prepare: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray] | None = None,
        skip: Callable[[np.ndarray], np.ndarray] | None = None,
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of the stream and where the ids of its breaks begin.

        `edges` says between which neighbouring code points there is a cut, `learn` gives the ids (32 bits each) of new cuts, and `prepare` may bring the
        code points of cuts to the form by which they are known. `skip` says which cuts have no ids, by their first code points.
        """
        while True:
            try:
                return self._windows(text, edges, learn, prepare, skip)
            except _Collision:
                self.turn += 1
                self.cuts = Cuts(self.turn)

    def _windows(self, text, edges, learn, prepare, skip) -> tuple[np.ndarray, np.ndarray]:
        """Windows end at a cut, so no array is longer than a window and a cut, however long a text is."""
        at, ids, breaks, done = 0, [], [], 0
        if len(self.cuts.checks) > self.most:
            self.cuts = Cuts(self.turn)
        while at < len(text):
            end = at + WINDOW
            while end < len(text):
                # looks on in steps until a cut is found
                found = np.flatnonzero(edges(_points(text[end - 1 : end + 256])))
                if len(found):
                    end += int(found[0])
                    break
                end = min(end + 256, len(text))
            part, where = self._window(text[at:end], edges, learn, prepare, skip)
            ids.append(part)
            breaks.append(where + done)
            done, at = done + len(part), end
        return np.concatenate(ids) if ids else np.zeros(0, np.uint32), np.concatenate(breaks) if breaks else np.zeros(0, np.int64)

    def _window(self, text, edges, learn, prepare, skip) -> tuple[np.ndarray, np.ndarray]:
        points = _points(text)
        cut = np.flatnonzero(edges(points)) + 1
        starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(points)]])
        if skip is not None:
            kept = ~skip(points[starts])
            starts, ends = starts[kept], ends[kept]
        known_by = points if prepare is None else prepare(points, starts, ends)
        keys, checks = self.cuts.hashes(known_by, starts, ends)
        rows = self.cuts.find(keys)
        unknown = np.flatnonzero(rows < 0)
        if len(unknown):
            _, first, place = np.unique(keys[unknown], return_index=True, return_inverse=True)
            new = unknown[first]
            if (checks[unknown] != checks[new][place]).any():
                raise _Collision
            known = len(self.cuts.checks)
            self.cuts.add(keys[new], checks[new], learn([text[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]))
            rows[unknown] = known + place
        if (self.cuts.checks[rows] != checks).any():
            raise _Collision
        sizes = self.cuts.sizes[rows]
        before = np.cumsum(sizes) - sizes
        take = np.arange(int(sizes.sum())) + np.repeat(self.cuts.starts[rows] - before, sizes)
        return self.cuts.ids[take], before[points[starts] == ord(BREAK)]


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
