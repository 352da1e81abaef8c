"""Suffix automaton of many symbol sequences, with the smallest owner of each of its substrings."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


class SuffixAutomaton:
    """All substrings of the sequences that were added; ``owners`` are comparable, the smallest counts.

    A state stands for the substrings that end at the same places. Its longest one has
    ``length`` symbols, and its suffix link leads to the state of the longest of its
    suffixes that also end elsewhere. ``finish`` must be called once after the last sequence.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [None]

    def add(self, symbols: Sequence[int], owner) -> None:
        follow, link, length, owners = self.next, self.link, self.length, self.owner
        last = 0
        for symbol in symbols:
            known = follow[last].get(symbol)
            if known is not None:
                last = known if length[known] == length[last] + 1 else self._split(last, symbol, known)
            else:
                state = len(follow)
                follow.append({})
                length.append(length[last] + 1)
                owners.append(None)
                link.append(0)
                at = last
                while at >= 0 and symbol not in follow[at]:
                    follow[at][symbol] = state
                    at = link[at]
                if at >= 0:
                    there = follow[at][symbol]
                    link[state] = there if length[there] == length[at] + 1 else self._split(at, symbol, there)
                last = state
            if owners[last] is None or owner < owners[last]:
                owners[last] = owner

    def _split(self, at: int, symbol: int, there: int) -> int:
        """A state of its own for the shorter substrings of ``there`` that come from ``at``."""
        follow, link, length = self.next, self.link, self.length
        state = len(follow)
        follow.append(dict(follow[there]))
        length.append(length[at] + 1)
        link.append(link[there])
        self.owner.append(None)
        link[there] = state
        while at >= 0 and follow[at].get(symbol) == there:
            follow[at][symbol] = state
            at = link[at]
        return state

    def finish(self, window: int) -> None:
        """Hand owners on to suffixes, and find for each state the one that holds its suffix of ``window`` symbols."""
        link, length, owners = self.link, self.length, self.owner
        order = np.argsort(np.array(length), kind="stable").tolist()
        for state in reversed(order[1:]):
            above = link[state]
            if owners[above] is None or owners[state] < owners[above]:
                owners[above] = owners[state]
        self.holder = [0] * len(link)
        for state in order[1:]:
            if length[state] >= window:
                above = link[state]
                self.holder[state] = state if length[above] < window else self.holder[above]

    def window_owners(self, symbols: Sequence[int], window: int) -> list:
        """Matching statistics of a stream, as the smallest owner of each of its windows; None where there is no match."""
        follow, link, length, holder, owners = self.next, self.link, self.length, self.holder, self.owner
        state, matched, out = 0, 0, []
        for symbol in symbols:
            while state and symbol not in follow[state]:
                state = link[state]
                matched = length[state]
            step = follow[state].get(symbol)
            if step is None:
                state, matched = 0, 0
            else:
                state, matched = step, matched + 1
            out.append(owners[holder[state]] if matched >= window else None)
        return out[window - 1:]
