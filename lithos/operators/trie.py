"""A dictionary of aliases as a trie of tokens in numpy arrays, walked for many texts at once inside a task."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa


class Trie:
    """Aliases as paths of tokens; an alias is split at single blanks."""

    def __init__(self, aliases: Iterable[str]):
        self.aliases = list(aliases)
        self.tokens: dict[str, int] = {}
        edges: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for i, alias in enumerate(self.aliases):
            node = 0
            for token in alias.split(" "):
                node = edges.setdefault((node, self.tokens.setdefault(token, len(self.tokens))), len(edges) + 1)
            ends[node] = i
        keys = np.fromiter((n << 32 | t for n, t in edges), np.int64, len(edges))
        order = np.argsort(keys)
        self.keys, self.children = keys[order], np.fromiter(edges.values(), np.int64, len(edges))[order]
        self.end = np.full(len(edges) + 1, -1)
        self.end[np.fromiter(ends, np.int64, len(ends))] = np.fromiter(ends.values(), np.int64, len(ends))

    def codes(self, flat: pa.Array) -> np.ndarray:
        """The number of each token, -1 for those in no alias and for nulls; every distinct token is looked up once."""
        coded = flat.dictionary_encode()
        known = np.fromiter((self.tokens.get(t, -1) for t in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        return np.append(known, -1)[coded.indices.fill_null(len(known)).to_numpy(zero_copy_only=False)]

    def _step(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The child of each node by a token, -1 where there is none."""
        if not len(self.keys):
            return np.full(len(nodes), -1)
        key = nodes << 32 | codes
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((codes >= 0) & (self.keys[at] == key), self.children[at], -1)

    def walk(self, texts: pa.ListArray, anywhere: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, position, tokens, alias number) of every alias, in order of place and length; without ``anywhere`` at the first position only."""
        lengths = texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        codes = self.codes(texts.flatten())
        past = np.cumsum(lengths)
        row = np.repeat(np.arange(len(lengths)), lengths)
        start = np.flatnonzero(codes >= 0) if anywhere else (past - lengths)[lengths > 0]
        end, at, node = past[row[start]], start, np.zeros(len(start), np.int64)
        found, n = [], 0
        while len(start):
            node = self._step(node, codes[at])
            on = node >= 0
            start, at, node, end, n = start[on], at[on] + 1, node[on], end[on], n + 1
            hit = self.end[node] >= 0
            found.append((start[hit], np.full(int(hit.sum()), n), self.end[node[hit]]))
            on = at < end
            start, at, node, end = start[on], at[on], node[on], end[on]
        places, sizes, numbers = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*found, strict=True)) if found else [np.zeros(0, np.int64)] * 3
        order = np.lexsort((sizes, places))
        places, sizes, numbers = places[order], sizes[order], numbers[order]
        return row[places], places - (past - lengths)[row[places]], sizes, numbers


def longest_only(row: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which hits, in order of place and length, no longer hit of their row covers."""
    if not len(row):
        return np.zeros(0, bool)
    last = np.append((row[1:] != row[:-1]) | (at[1:] != at[:-1]), True)  # the longest at its place
    end = (at + size) + row * (int((at + size).max()) + 1)  # ends of different rows never compare as covered
    before = np.maximum.accumulate(np.append(-1, end[last])[:-1])
    keep = np.zeros(len(row), bool)
    keep[np.flatnonzero(last)[end[last] > before]] = True
    return keep
