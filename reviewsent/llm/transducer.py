"""Sorted terms as a minimal acyclic transducer: term -> place in the sorted list.

The automaton is built term by term from the sorted list: the part of the last term that the next one does not
share is final, so its states are looked up among the known ones and merged. An edge carries how many
terms are passed over by taking it, and the sum of a path is the ordinal of its term.

As arrays, the edges of a state are contiguous and sorted by byte. Four 64-bit masks per state hold
which bytes it has; the edge of a byte is the number of lower bits set before it. Whole texts are streamed
through it, all terms of a stretch of text in step, one byte each at a time.
"""

from collections.abc import Iterable

import numpy as np

#: Bytes of terms: A-Z, a-z and all of other characters.
TERM_BYTES = np.zeros(256, bool)
TERM_BYTES[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Transducer:
    def __init__(self, masks: np.ndarray, firsts: np.ndarray, targets: np.ndarray, skips: np.ndarray, final: np.ndarray):
        self.masks, self.firsts, self.targets, self.skips, self.final = masks, firsts, targets, skips, final

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.masks, self.firsts, self.targets, self.skips, self.final

    def ordinals(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Ordinal of the term in each span of ``data``, -1 where it is not in the list."""
        out = np.full(len(starts), -1, np.int64)
        who, at = np.arange(len(starts)), starts
        state, total = np.full(len(starts), len(self.final) - 1, np.int64), np.zeros(len(starts), np.int64)
        while len(who):
            over = at == ends
            if over.any():
                good = over & self.final[state]
                out[who[good]] = total[good]
                more = ~over
                who, at, ends, state, total = who[more], at[more], ends[more], state[more], total[more]
            byte = data[at]
            word = state * 4 + (byte >> 6)
            bits, low = self.masks[word], (byte & 63).astype(np.uint64)
            hit = (bits >> low) & np.uint64(1) == 1
            word, bits, low = word[hit], bits[hit], low[hit]
            edge = self.firsts[word] + np.bitwise_count(bits & ((np.uint64(1) << low) - np.uint64(1)))
            who, at, ends = who[hit], at[hit] + 1, ends[hit]
            state, total = self.targets[edge], total[hit] + self.skips[edge]
        return out


def build(terms: Iterable[bytes]) -> Transducer:
    """The transducer of ``terms``, sorted and distinct."""
    known: dict[tuple, int] = {}  # final, edges -> state
    below: list[int] = []  # terms that can be read from a state
    path: list[tuple[list, list[bool]]] = [([], [False])]  # open states: edges (byte, state), final
    last = b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            edges, final = path.pop()
            key = (final[0], tuple(edges))
            state = known.get(key)
            if state is None:
                state = known[key] = len(below)
                below.append(final[0] + sum(below[target] for _, target in edges))
            path[-1][0].append((last[len(path) - 1], state))

    for term in terms:
        shared, most = 0, min(len(term), len(last))
        while shared < most and term[shared] == last[shared]:
            shared += 1
        close(shared)
        path.extend(([], [False]) for _ in range(len(term) - shared))
        path[-1][1][0] = True
        last = term
    close(0)
    states = [*known, (path[0][1][0], tuple(path[0][0]))]  # the root comes last
    final = np.array([key[0] for key in states], bool)
    below = np.array([*below, 0], np.int64)
    sizes = np.array([len(key[1]) for key in states], np.int64)
    flat = np.array([edge for key in states for edge in key[1]], np.int64).reshape(-1, 2)
    owner = np.repeat(np.arange(len(states)), sizes)
    word = owner * 4 + (flat[:, 0] >> 6)
    masks = np.zeros(4 * len(states), np.uint64)
    np.bitwise_or.at(masks, word, np.uint64(1) << (flat[:, 0] & 63).astype(np.uint64))
    passed = np.cumsum(below[flat[:, 1]]) - below[flat[:, 1]]  # terms below earlier edges, of all states
    first = np.cumsum(sizes) - sizes
    skips = passed - np.repeat(passed[np.minimum(first, max(0, len(flat) - 1))], sizes) + final[owner] if len(flat) else passed
    return Transducer(masks, np.searchsorted(word, np.arange(4 * len(states))).astype(np.int32), flat[:, 1].astype(np.int32),
                      skips.astype(np.int64), final)


def term_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms in ``data``, whose last byte belongs to none."""
    edge = np.diff(np.r_[False, TERM_BYTES[data]].astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
