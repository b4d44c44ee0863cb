"""A variable-order context tree run as an automaton over many stretches of text at once.

States are contexts: symbol strings closed under dropping the first or the last symbol. The state after
a text is the longest context that is a suffix of it, and depends on the last `depth` symbols alone. A
long text can therefore be cut anywhere: each stretch starts `depth` symbols early and so reaches the same
state as a run from the start. All stretches advance by one symbol per step, which makes numpy fast.
"""

from __future__ import annotations

import numpy as np

#: Symbols of a stretch, and symbols handled at once; they bound the temporary arrays.
STRETCH, AT_ONCE = 512, 1 << 20


class ContextTree:
    """`contexts`: tuples of symbols below `size`, closed under both suffixes and prefixes, with ()."""

    def __init__(self, contexts, size: int):
        order = sorted(contexts, key=lambda c: (len(c), c))
        self.size, self.contexts = size, order
        self.state = {c: i for i, c in enumerate(order)}
        self.depth = len(order[-1])
        self.link = np.array([self.state[c[1:]] if c else 0 for c in order], np.int32)
        # One more symbol, which starts anew and costs nothing, pads the stretches.
        step = np.zeros((len(order), size + 1), np.int32)
        below: dict[int, list[tuple[int, int]]] = {}
        for c, i in self.state.items():
            if c:
                below.setdefault(self.state[c[:-1]], []).append((c[-1], i))
        for i in range(len(order)):
            if i:
                step[i] = step[self.link[i]]
            for symbol, child in below.get(i, ()):
                step[i, symbol] = child
        self.step = step

    def _stretches(self, symbols: np.ndarray, offsets: np.ndarray):
        """Runs many stretches of the texts side by side. Yields their texts, and for each step the places
        (in symbols) and the index state * (size + 1) + symbol of those that have not ended."""
        lengths = np.diff(offsets)
        counts = -(-lengths // STRETCH)
        owner = np.repeat(np.arange(len(lengths)), counts)
        first = np.cumsum(counts) - counts
        begin = (np.arange(len(owner)) - first[owner]) * STRETCH
        length = np.minimum(lengths[owner] - begin, STRETCH)
        order = np.argsort(-length, kind="stable")
        flat, width = self.step.ravel(), self.size + 1

        def steps(part):
            places = offsets[owner[part]] + begin[part]
            state = np.zeros(len(part), np.int32)
            for k in range(-self.depth, int(length[part[0]])):
                # Longest first: those that go on are the first ones.
                n = len(part) if k < 0 else int(np.searchsorted(-length[part], -k, "left"))
                at = places[:n] + k
                if k < 0:
                    outside = begin[part] + k < 0
                    row = np.where(outside, self.size, symbols[np.where(outside, 0, at)])
                else:
                    row = symbols[at]
                index = state[:n] * width + row
                if k >= 0:
                    yield at, index
                state = flat[index]

        for at in range(0, len(order), AT_ONCE // STRETCH):
            part = order[at:at + AT_ONCE // STRETCH]
            yield owner[part], steps(part)

    def sums(self, symbols: np.ndarray, offsets: np.ndarray, costs: np.ndarray) -> np.ndarray:
        """Sum of costs[state, symbol] over each text symbols[offsets[i]:offsets[i + 1]].

        `costs` has the shape (states, size + 1, values)."""
        out = np.zeros((len(offsets) - 1, costs.shape[2]))
        flat = costs.reshape(-1, costs.shape[2])
        for owners, steps in self._stretches(symbols, offsets):
            total = np.zeros((len(owners), costs.shape[2]))
            for _, index in steps:
                total[:len(index)] += flat[index]
            np.add.at(out, owners, total)
        return out


def closed(contexts) -> set[tuple]:
    """The contexts with all their prefixes and suffixes."""
    out, todo = {()}, list(contexts)
    while todo:
        c = todo.pop()
        if c not in out:
            out.add(c)
            todo += [c[1:], c[:-1]]
    return out
