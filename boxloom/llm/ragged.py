"""Byte-pair merging of many short sequences at once, as ragged numpy arrays."""

from __future__ import annotations

import numpy as np

NONE = np.int64(2**62)


class PairTable:
    """rank and product of a pair of symbols, by binary search over the sorted pairs."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, product: np.ndarray) -> None:
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        order = np.argsort(keys)
        self.keys, self.rank, self.product = keys[order], rank[order].astype(np.int64), product[order].astype(np.int64)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """NONE where the two do not merge."""
        keys = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.rank[at], NONE)

    def products_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of pairs that do merge."""
        return self.product[np.searchsorted(self.keys, (left << 32) | right)]


def merge(symbols: np.ndarray, starts: np.ndarray, pairs: PairTable, watch=None, one_at_a_time: bool = False) -> np.ndarray:
    """Merge each sequence to its end; returns the length of each.

    `symbols` holds the sequences one after another, `starts` where each begins (none is empty). In a round every
    sequence merges all places of its lowest-ranked pair, from left to right; finished sequences leave the arrays.
    With `one_at_a_time` it merges only the leftmost place, for vocabularies in which a product may rank before a part.
    With `watch`, it is called as watch(sequence numbers, their symbols, their starts) when sequences finish.
    """
    n = len(starts)
    final = np.zeros(n, np.int64)
    symbols, starts, names = symbols.astype(np.int64), starts.astype(np.int64), np.arange(n)
    if not n:
        return final

    def ends_of(starts, size):
        return np.append(starts[1:], size)

    rank = np.full(len(symbols), NONE)
    if len(symbols) > 1:
        rank[:-1] = pairs.ranks_of(symbols[:-1], symbols[1:])
    rank[ends_of(starts, len(symbols)) - 1] = NONE
    while len(names):
        sizes = np.diff(np.append(starts, len(symbols)))
        lowest = np.minimum.reduceat(rank, starts)
        done = lowest == NONE
        if done.any():
            final[names[done]] = sizes[done]
            live = np.repeat(~done, sizes)
            if watch is not None:
                at = np.concatenate([[0], np.cumsum(sizes[done])[:-1]])
                watch(names[done], symbols[~live], at)
            symbols, rank, names, lowest, sizes = symbols[live], rank[live], names[~done], lowest[~done], sizes[~done]
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
            if not len(names):
                break
        hits = np.flatnonzero(rank == np.repeat(lowest, sizes))
        # neighbouring hits share a symbol: of a run, every other one merges, from the left
        fresh = np.ones(len(hits), bool)
        fresh[1:] = hits[1:] != hits[:-1] + 1
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(hits)), 0))
        hits = hits[(np.arange(len(hits)) - run_start) % 2 == 0]
        if one_at_a_time:
            hits = hits[np.unique(np.searchsorted(starts, hits, side="right"), return_index=True)[1]]
        symbols[hits] = pairs.products_of(symbols[hits], symbols[hits + 1])
        keep = np.ones(len(symbols), bool)
        keep[hits + 1] = False
        rank[hits] = NONE
        last = np.zeros(len(symbols), bool)  # a merged symbol takes the place of the last one of its sequence
        last[ends_of(starts, len(symbols)) - 1] = True
        last[hits] = last[hits + 1]
        before = np.cumsum(keep) - 1
        hits_at = before[hits]
        starts = before[starts]
        symbols, rank, last = symbols[keep], rank[keep], last[keep]
        again = np.concatenate([hits_at, hits_at - 1])
        again = again[(again >= 0)]
        again = again[~last[again]]
        rank[again] = pairs.ranks_of(symbols[again], symbols[again + 1])
    return final
