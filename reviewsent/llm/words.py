"""Words of whole texts as numbers: numpy passes over the bytes of many documents at once."""

import numpy as np

from reviewsent.llm.suffix_dedup import mix, powers

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes per pass; a word never crosses a pass, as passes end at white space.
PASS = 1 << 18


def _hash_pass(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, up: np.ndarray, down: np.ndarray) -> np.ndarray:
    n = int(ends[-1])
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data[:n].astype(np.uint64) + np.uint64(1)) * down[:n], out=sums[1:])
    sizes = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * up[starts] + sizes * np.uint64(0xD6E8FEB86659FD93))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans are sorted and don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    longest = int((ends - starts).max())
    up, down = powers(min(PASS, len(data)) + longest + 2)
    out, first = [], 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + PASS, side="right")))
        base = int(starts[first])
        out.append(_hash_pass(data[base:int(ends[last - 1])], starts[first:last] - base, ends[first:last] - base, up, down))
        first = last
    return np.concatenate(out)


def hash_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word of ``texts``, in order, and the number of words of each text."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = SPACES[data]
    edge = np.diff(np.r_[True, space].astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    bounds = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    return hash_spans(data, starts, ends), np.diff(np.r_[0, np.searchsorted(starts, bounds)])


def hash_shingles(words: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``size``-word window of each text (fewer words: of all of them; none: nothing) and their counts."""
    ends = np.cumsum(counts)
    sizes = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = np.repeat(ends - counts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    have = np.repeat(np.minimum(counts, size), sizes)
    padded = np.r_[words, np.zeros(size, np.uint64)]
    total = have.astype(np.uint64)
    for k in range(size):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + np.where(have > k, padded[first + k], np.uint64(0)))
    return total, sizes


def lower_ascii(text: str | None) -> bytes:
    """UTF-8 bytes with A-Z in lower case; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").lower()
