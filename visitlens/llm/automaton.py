"""Suffix automaton of a reference shard, with occurrence weights."""

from __future__ import annotations


class SuffixAutomaton:
    """Generalised suffix automaton over hashable symbols.

    ``add`` appends one weighted sequence; ``finish`` sums the weights, after
    which ``weight[v]`` is the total weight of the places where the strings
    of state ``v`` occur.
    """

    def __init__(self):
        self.next, self.link, self.size, self.weight = [{}], [-1], [0], [0]

    def _state(self, size, nxt, link):
        self.next.append(nxt)
        self.size.append(size)
        self.link.append(link)
        self.weight.append(0)
        return len(self.size) - 1

    def _split(self, p, q, c):
        """A copy of ``q`` for its strings of at most ``size[p] + 1`` symbols."""
        nxt, link = self.next, self.link
        clone = self._state(self.size[p] + 1, dict(nxt[q]), link[q])
        link[q] = clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    def add(self, seq, weight: int = 1) -> None:
        nxt, link, size, total = self.next, self.link, self.size, self.weight
        last = 0
        for c in seq:
            q = nxt[last].get(c)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self._split(last, q, c)
            else:
                cur = self._state(size[last] + 1, {}, 0)
                p = last
                while p != -1 and c not in nxt[p]:
                    nxt[p][c] = cur
                    p = link[p]
                if p != -1:
                    q = nxt[p][c]
                    link[cur] = q if size[q] == size[p] + 1 else self._split(p, q, c)
                last = cur
            total[last] += weight

    def finish(self) -> None:
        for v in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            if self.link[v] > 0:
                self.weight[self.link[v]] += self.weight[v]

    def matching(self, seq, least: int = 2) -> list[int]:
        """Matching statistics: at each position the length of the longest
        suffix whose places weigh at least ``least``."""
        nxt, link, size, total = self.next, self.link, self.size, self.weight
        v = length = 0
        out = []
        for c in seq:
            while True:
                q = nxt[v].get(c)
                if q is not None and total[q] >= least:
                    v = q
                    length += 1
                    break
                if v == 0:
                    length = 0
                    break
                v = link[v]
                length = size[v]
            out.append(length)
        return out
