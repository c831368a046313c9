"""The n best scores of every line of a matrix, brought up to date tile by tile inside a task."""

from __future__ import annotations

import numpy as np

MANY = 8  # times n entries of a line; with more than these, a line's own n-th best is found before they are sorted


class Best:
    """At most n (score, name) a line: highest score first, then the smaller name. ``limit`` is what an entry must reach."""

    def __init__(self, lines: int, n: int, kind: type, limit: np.ndarray | None = None):
        low = np.iinfo(kind).min if np.issubdtype(kind, np.integer) else -np.inf
        self.n, self.low = n, low
        self.scores = np.full((lines, n), low, kind)
        self.names = np.full((lines, n), np.iinfo(np.int64).max)
        self.count = np.zeros(lines, np.int64)
        self.limit = np.full(lines, low, kind) if limit is None else limit.astype(kind)

    def reaching(self, lines: np.ndarray, tile: np.ndarray, limit: np.ndarray, hidden=None,
                 slack: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``lines``, column) of what reaches the limits. ``hidden`` gives the mask of entries that do not count.

        ``slack`` is by how much two entries of a line must differ to be told apart, if the tile is not exact.
        """
        some = np.flatnonzero(tile.max(axis=1) >= limit)
        part = tile if len(some) == len(tile) else tile[some]
        able = part >= limit[some, None]
        if part.shape[1] > self.n and np.count_nonzero(able) > MANY * self.n * len(some):
            if hidden is not None:
                part = np.where(hidden(lines[some]), -np.inf if part.dtype.kind == "f" else np.iinfo(part.dtype).min, part)
            cut = np.partition(part, -self.n, axis=1)[:, -self.n] - np.broadcast_to(slack, len(tile))[some]
            able &= part >= cut[:, None]
        at = np.flatnonzero(able)
        return some[at // part.shape[1]], at % part.shape[1]

    def keep(self, lines: np.ndarray, scores: np.ndarray, names: np.ndarray) -> None:
        """Take in entries, several of a line among them; an entry must come once."""
        full = self.count[lines] == self.n
        last = self.scores[lines, -1]
        fit = ~full | (scores > last) | ((scores == last) & (names < self.names[lines, -1]))
        lines, scores, names = lines[fit], scores[fit], names[fit]
        if not len(lines):
            return
        own = np.unique(lines)
        at, place = np.nonzero(np.arange(self.n) < self.count[own, None])
        old = own[at]
        lines = np.concatenate((old, lines))
        scores = np.concatenate((self.scores[old, place], scores))
        names = np.concatenate((self.names[old, place], names))
        falling = ~scores if scores.dtype.kind == "i" else -scores  # ~ reverses the order without overflow
        order = np.lexsort((names, falling, lines))
        lines = lines[order]
        rank = np.arange(len(lines)) - np.searchsorted(lines, lines)
        best = rank < self.n
        lines, rank, order = lines[best], rank[best], order[best]
        self.scores[lines, rank], self.names[lines, rank] = scores[order], names[order]
        self.count[own] = np.searchsorted(lines, own, "right") - np.searchsorted(lines, own)
        full = own[self.count[own] == self.n]
        self.limit[full] = np.maximum(self.limit[full], self.scores[full, -1])

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """(line, place) of everything kept."""
        return np.nonzero(np.arange(self.n) < self.count[:, None])
