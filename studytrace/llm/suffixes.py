"""Suffix arrays by induced sorting, on whole arrays at a time.

Suffixes are larger (L) or smaller (S) than their right neighbour; a leftmost S
suffix starts a substring that ends at the next one. Sorting these substrings
and then their sequence of names orders the leftmost suffixes; all others follow
in two passes over the buckets of first characters, each of which places, in
order, the left neighbours of what is already in place.
"""

from __future__ import annotations

import numpy as np

#: A sequence of names with more distinct ones than this is ranked by doubling:
#: passes over that many buckets would each handle a few elements.
BUCKET_PASSES = 512


def _smaller(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; the end is least."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1])
    step[-1] = -1
    nearest = np.where(step != 0, np.arange(n, dtype=np.int32), np.int32(n))
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    return step[nearest] > 0


def _placed(chars: np.ndarray, bucket: np.ndarray, sigma: int, back: bool) -> tuple:
    """A stable order by character, and where each goes; moves the bucket ends."""
    order = np.argsort(chars, kind="stable")
    sorted_chars = chars[order]
    counts = np.bincount(sorted_chars, minlength=sigma)
    first = np.cumsum(counts) - counts
    within = np.arange(len(chars)) - first[sorted_chars]
    if back:
        where = bucket[sorted_chars] - 1 - within
        bucket -= counts
    else:
        where = bucket[sorted_chars] + within
        bucket += counts
    return order, where


def _induced(
    text: np.ndarray, smaller: np.ndarray, leftmost: np.ndarray, sigma: int
) -> np.ndarray:
    """All suffixes in order, given the leftmost S suffixes in order."""
    n = len(text)
    sizes = np.bincount(text, minlength=sigma)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    out = np.zeros(n, np.int32)
    by_char = leftmost[np.argsort(text[leftmost], kind="stable")]
    edges = np.searchsorted(text[by_char], np.arange(sigma + 1))
    used = np.flatnonzero(sizes)

    heads = starts.copy()
    last = text[n - 1]
    out[heads[last]] = n - 1
    heads[last] += 1

    def forward(block: np.ndarray) -> None:
        left = block[block > 0] - 1
        left = left[~smaller[left]]
        if len(left):
            order, where = _placed(text[left], heads, sigma, False)
            out[where] = left[order]

    for c in used:
        done = starts[c]
        while done < heads[c]:
            block = out[done : heads[c]]
            done = heads[c]
            forward(block)
        if edges[c] < edges[c + 1]:
            forward(by_char[edges[c] : edges[c + 1]])

    tails = ends.copy()

    def backward(block: np.ndarray) -> None:
        left = block[block > 0] - 1
        left = left[smaller[left]]
        if len(left):
            order, where = _placed(text[left], tails, sigma, True)
            out[where] = left[order]

    for c in used[::-1]:
        done = ends[c]
        while tails[c] < done:
            block = out[tails[c] : done][::-1]
            done = tails[c]
            backward(block)
        if heads[c] > starts[c]:
            backward(out[starts[c] : heads[c]][::-1])
    return out


def _names(text: np.ndarray, ordered: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Numbers of sorted leftmost substrings, equal for equal ones.

    ``lengths`` are those of the ordered substrings; zero marks the last one,
    which ends with the text and equals no other.
    """
    same = (lengths[1:] == lengths[:-1]) & (lengths[1:] > 0)
    open_ = np.flatnonzero(same)
    at = 0
    while len(open_):
        open_ = open_[lengths[open_] > at]
        differs = text[ordered[open_] + at] != text[ordered[open_ + 1] + at]
        same[open_[differs]] = False
        open_ = open_[~differs]
        at += 1
    return np.concatenate([[0], np.cumsum(~same)])


def _by_doubling(names: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of a sequence in the order of their first ``depth`` elements."""
    n, rank, reach = len(names), names.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - reach] = rank[reach:] + 1
        key = rank * (rank.max() + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
        rank[order] = new
        reach *= 2
        if new[-1] == n - 1 or reach >= min(depth, n):
            return order


def suffix_array(text: np.ndarray, sigma: int, depth: int | None = None) -> np.ndarray:
    """The suffixes of ``text`` (numbers below ``sigma``) in ascending order.

    With ``depth``, only the first that many elements have to be in order.
    """
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int32)
    depth = depth or n
    smaller = _smaller(text)
    is_left = np.zeros(n, bool)
    is_left[1:] = smaller[1:] & ~smaller[:-1]
    places = np.flatnonzero(is_left).astype(np.int32)
    if len(places) > 1:
        rough = _induced(text, smaller, places, sigma)
        ordered = rough[is_left[rough]]
        length = np.zeros(n, np.int32)
        length[places[:-1]] = np.diff(places) + 1
        named = np.empty(n, np.int32)
        found = _names(text, ordered, length[ordered])
        named[ordered] = found
        if found[-1] < len(places) - 1:
            names = named[places]
            if found[-1] < BUCKET_PASSES:
                order = suffix_array(names, int(found[-1]) + 1, depth)
            else:
                # A substring advances by two characters at least.
                order = _by_doubling(names, depth // 2 + 1)
            ordered = places[order]
        places = ordered
    return _induced(text, smaller, places, sigma)


def repeats_predecessor(data: np.ndarray, suffixes: np.ndarray, length: int) -> np.ndarray:
    """Whether each suffix shares ``length`` bytes with the one before it.

    Computed in the order of the text (permuted common prefixes, cut at
    ``length``), eight bytes at a time.
    """
    out = np.zeros(len(suffixes), bool)
    if len(suffixes) < 2:
        return out
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.zeros(len(data), np.uint64)
    for i in range(8):
        words |= padded[i : i + len(data)].astype(np.uint64) << np.uint64(8 * i)
    before = np.full(len(data), -1, np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    here = np.flatnonzero(before >= 0)
    there = before[here]
    for at in [*range(0, length - 7, 8), length - 8]:
        equal = words[here + at] == words[there + at]
        here, there = here[equal], there[equal]
    shared = np.zeros(len(data), bool)
    shared[here] = True
    return shared[suffixes]
