"""A tree of term vectors that share their beginnings, searched by branch and bound (op 12).

Terms are ranked by document frequency, the most frequent first, and a document's vector is the ascending list
of the ranks it holds. Sorted vectors that begin alike share a path, so every tree node stands for one run of
consecutive documents. A node keeps the largest frequency of its own term and the smallest ``m`` among its
documents: no document below can score more than these allow.
"""

from __future__ import annotations

import numpy as np

SCALE = 1_000_000_000
#: Runs of at most so many documents are scored one by one.
LEAF = 192


def gain(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return weight * ((SCALE * tf) // (1000 * tf + 20 * m))


def _spread(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All positions in the ranges [start, stop), and the number of the range each is from."""
    size = stop - start
    owner = np.repeat(np.arange(len(size)), size)
    return np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + start[owner], owner


class TermTree:
    """``vectors``: (ranks ascending, frequencies) of each document; ``m`` and ``ids`` of the documents.

    A missing id is masked in ``no_id``.
    """

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], m: np.ndarray, ids: np.ndarray, no_id: np.ndarray):
        order = sorted(range(len(vectors)), key=lambda i: vectors[i][0].tolist())
        self.m, self.ids, self.no_id = m[order], ids[order], no_id[order]
        vectors = [vectors[i] for i in order]
        self.size = len(vectors)
        entries = sum(len(r) for r, _ in vectors)
        term, start, end = (np.zeros(entries, np.int64) for _ in range(3))
        parent, most, least = np.full(entries, -1), np.zeros(entries, np.int64), np.full(entries, np.iinfo(np.int64).max)
        path = np.zeros(max((len(r) for r, _ in vectors), default=0), np.int64)  # nodes of the current document
        before, nodes = np.empty(0, np.int64), 0
        for doc, (ranks, tf) in enumerate(vectors):
            both = min(len(before), len(ranks))
            differs = np.flatnonzero(before[:both] != ranks[:both])
            same = int(differs[0]) if len(differs) else both
            end[path[same : len(before)]] = doc
            new = slice(nodes, nodes + len(ranks) - same)
            term[new], start[new] = ranks[same:], doc
            path[same : len(ranks)] = np.arange(new.start, new.stop)
            parent[new] = path[same - 1 : len(ranks) - 1] if same else np.concatenate([[-1], path[: len(ranks) - 1]])[: len(ranks)]
            nodes = new.stop
            own = path[: len(ranks)]
            most[own] = np.maximum(most[own], tf)
            least[own] = np.minimum(least[own], self.m[doc])
            before = ranks
        end[path[: len(before)]] = self.size
        self.term, self.start, self.end, self.most, self.least = (a[:nodes] for a in (term, start, end, most, least))
        # Children of every node (-1: the root) in the order of their documents.
        self.by_parent = np.argsort(parent[:nodes], kind="stable")
        self.child_from = np.searchsorted(parent[:nodes][self.by_parent], np.arange(-1, nodes + 1))
        # All nodes of a term in the order of their documents, and all its documents.
        width = self.size + 1
        self.width = width
        chain = np.lexsort((self.start, self.term))
        self.chain_key = self.term[chain] * width + self.start[chain]
        self.chain_most = self.most[chain]
        docs = np.repeat(np.arange(self.size), [len(r) for r, _ in vectors])
        ranks = np.concatenate([r for r, _ in vectors] or [np.empty(0, np.int64)])
        tfs = np.concatenate([t for _, t in vectors] or [np.empty(0, np.int64)])
        listed = np.lexsort((docs, ranks))
        self.post_key, self.post_doc, self.post_tf = (ranks * width + docs)[listed], docs[listed], tfs[listed]

    def exact(self, lo: int, hi: int, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of the documents in [lo, hi)."""
        at, owner = _spread(
            np.searchsorted(self.post_key, terms * self.width + lo), np.searchsorted(self.post_key, terms * self.width + hi)
        )
        doc = self.post_doc[at]
        scores = np.zeros(hi - lo, np.int64)
        np.add.at(scores, doc - lo, gain(weights[owner], self.post_tf[at], self.m[doc]))
        return scores

    def bounds(self, nodes: np.ndarray, above: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each node the most any document below can score, and the frequencies (terms x nodes) allowed.

        A term on the path is limited by the path's nodes, a deeper one by its nodes inside the subtree; a term
        that is in neither is absent from all documents below.
        """
        # Siblings follow one another without gaps, so every term's nodes below them are one stretch, cut by children.
        cuts = np.append(self.start[nodes], self.end[nodes[-1]])
        cut = np.searchsorted(self.chain_key, terms[:, None] * self.width + cuts[None, :])
        at, _ = _spread(cut[:, 0], cut[:, -1])
        size = cut[:, -1] - cut[:, 0]
        places = cut[:, :-1] + (np.cumsum(size) - size - cut[:, 0])[:, None]
        inside = np.maximum.reduceat(np.append(self.chain_most[at], 0), places.ravel()).reshape(places.shape)
        inside = np.where(cut[:, 1:] > cut[:, :-1], inside, 0)
        here = (terms[:, None] == self.term[nodes][None, :]) * self.most[nodes][None, :]
        # A document below holds a path term at most as often as the nodes on the path say.
        allowed = np.where(above[:, None] > 0, above[:, None], np.maximum(inside, here))
        return gain(weights[:, None], allowed, self.least[nodes][None, :]).sum(axis=0), allowed

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Offer ``best`` every document that may be among the best ones for the terms (ascending ranks)."""
        stack = [(np.iinfo(np.int64).max, -1, np.zeros(len(terms), np.int64))]
        while stack:
            bound, node, above = stack.pop()
            if bound < best.limit:
                continue
            lo, hi = (self.start[node], self.end[node]) if node >= 0 else (0, self.size)
            children = self.by_parent[self.child_from[node + 1] : self.child_from[node + 2]]
            stop = hi if hi - lo <= LEAF or not len(children) else self.start[children[0]]
            if stop > lo:  # a short run, or the documents whose vector ends here
                best.offer(self.exact(lo, stop, terms, weights), self.ids[lo:stop], self.no_id[lo:stop])
            if stop == hi:
                continue
            most, allowed = self.bounds(children, above, terms, weights)
            ascending = np.argsort(most, kind="stable")
            for i in ascending[np.searchsorted(most[ascending], best.limit) :]:
                child = children[i]
                on_path = np.where(terms == self.term[child], self.most[child], above)
                stack.append((int(most[i]), int(child), on_path))


class Best:
    """The ``keep`` best documents of one item: highest score first, then smallest id, a missing id before all."""

    def __init__(self, keep: int):
        self.keep, self.limit = keep, 1  # the least score that can still get in
        self.scores, self.ids, self.no_id = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def offer(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        good = scores >= self.limit
        if not good.any():
            return
        scores, ids, no_id = (
            np.concatenate([old, new[good]])
            for old, new in ((self.scores, scores), (self.ids, ids), (self.no_id, no_id))
        )
        first = np.lexsort((ids, ~no_id, -scores))[: self.keep]
        self.scores, self.ids, self.no_id = scores[first], ids[first], no_id[first]
        if len(first) == self.keep:
            self.limit = int(self.scores[-1])
